"""Language identification by prediction by partial matching (PPM).

For every language a tree of byte contexts up to ``max_order`` is counted on labelled texts and then
frozen. A byte's code length comes from the longest context that the tree holds: -log2(c / (t + d)) if
the byte was seen there c times of t (d distinct bytes), else the escape's -log2(d / (t + d)) plus the
code length in the next shorter context, down to 8 bits. The language with the shortest code for the
whole text wins; the score is its posterior under equal priors.

The trees of all languages share one table per order, keyed by the context and the byte, with a code
length per language, so a byte costs one lookup whatever the number of languages.

Training reads at most ``max_docs`` labelled texts per language, of ``max_doc_bytes`` at most, picked
by a hash of the id; that bounds the model. Every text is scored in full.

Defined cases: null text, and text without a letter, is ``und`` with score 0; so is any text if there
is nothing to learn from; equal code lengths: the first language by code point; repeated rows are
scored alike, whatever their ids, which may be null; texts of any length are scored whole; columns of any
other name stay, those of the result's names are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import chunks, text_bytes
from tallyforge.llm.shared import fewer_rows, packed_row

MAX_ORDER, MAX_DOCS, MAX_DOC_BYTES, MAX_LANGUAGES = 3, 400, 1 << 15, 256


class Index:
    """Distinct uint64 keys to their places: open addressing, a quarter full at most."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(np.ceil(np.log2(4 * len(keys) + 1)))))
        size = 1 << (64 - int(self.shift))
        self.keys, self.places = np.zeros(size + 64, np.uint64), np.full(size + 64, -1, np.int32)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            slot = self.slot(keys[left]) + self.probes
            free = self.places[slot] < 0
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            won = first[free[first]]
            self.keys[slot[won]], self.places[slot[won]] = keys[left[won]], left[won]
            left = np.delete(left, won)
            self.probes += 1

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The places of ``keys``, -1 for absent ones."""
        slot = self.slot(keys)
        out = np.where(self.keys[slot] == keys, self.places[slot], -1)
        open_ = np.flatnonzero((out < 0) & (self.places[slot] >= 0))
        for p in range(1, self.probes):
            if not len(open_):
                break
            at = slot[open_] + p
            hit = (self.keys[at] == keys[open_]) & (self.places[at] >= 0)
            out[open_[hit]] = self.places[at[hit]]
            open_ = open_[~hit & (self.places[at] >= 0)]
        return out


def grams(data: np.ndarray, starts: np.ndarray, order: int) -> np.ndarray:
    """For every byte, its context of ``order`` bytes and itself in one integer; zeros before a text."""
    key, before = data.astype(np.uint64), data
    for k in range(1, order + 1):
        before = np.concatenate([np.zeros(1, np.uint8), before[:-1]])
        before[starts] = 0
        key |= before.astype(np.uint64) << np.uint64(8 * k)
    return key


@dataclass
class Model:
    languages: list[str]
    order: int
    index: list[Index]
    cost: list[np.ndarray]
    contexts: list[Index]
    escape: list[np.ndarray]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits per text and language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        some = np.flatnonzero(offsets[1:] > offsets[:-1])
        if not len(some):
            return out
        key = grams(data, offsets[some], self.order)
        place = self.index[self.order].find(key)
        bits = self.cost[self.order][place]
        missing = np.flatnonzero(place < 0)
        if len(missing):
            bits[missing] = self.shorter(key[missing], self.order)
        out[some] = np.add.reduceat(bits, offsets[some], axis=0, dtype=np.float64)
        return out

    def shorter(self, key: np.ndarray, order: int) -> np.ndarray:
        """Code lengths of bytes that no language has seen in their context of ``order`` bytes."""
        context = self.contexts[order].find(key >> np.uint64(8))
        bits = np.where((context >= 0)[:, None], self.escape[order][context], np.float32(0))
        if not order:
            return bits + np.float32(8)
        key = key & np.uint64((1 << 8 * order) - 1)
        place = self.index[order - 1].find(key)
        bits += np.where((place >= 0)[:, None], self.cost[order - 1][place], np.float32(0))
        missing = np.flatnonzero(place < 0)
        if len(missing):
            bits[missing] += self.shorter(key[missing], order - 1)
        return bits


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, counts, len(found))


def build_model(languages: list[str], keys: np.ndarray, lang: np.ndarray, counts: np.ndarray, order: int) -> Model:
    model = Model(languages, order, [], [], [], [])
    for o in range(order + 1):
        own = keys & np.uint64((1 << 8 * (o + 1)) - 1)
        union = np.unique(own)
        contexts = np.unique(union >> np.uint64(8))
        index = Index(union)
        if o:
            cost = model.cost[o - 1][model.index[o - 1].find(union & np.uint64((1 << 8 * o) - 1))].astype(np.float64)
        else:
            cost = np.full((len(union), len(languages)), 8.0)
        escape = np.zeros((len(contexts), len(languages)))
        above = np.searchsorted(contexts, union >> np.uint64(8))
        for j in range(len(languages)):
            seen, n = summed(own[lang == j], counts[lang == j])
            if not len(seen):
                continue
            at = np.searchsorted(union, seen)
            total = np.bincount(above[at], n, len(contexts))
            distinct = np.bincount(above[at], minlength=len(contexts))
            known = total > 0
            escape[known, j] = -np.log2(distinct[known] / (total + distinct)[known])
            cost[:, j] += escape[above, j]
            cost[at, j] = -np.log2(n / (total + distinct)[above[at]])
        model.index.append(index)
        model.cost.append(cost.astype(np.float32))
        model.contexts.append(Index(contexts))
        model.escape.append(escape.astype(np.float32))
    return model


def train(labelled: DataFrame, order: int = MAX_ORDER, max_docs: int = MAX_DOCS, max_doc_bytes: int = MAX_DOC_BYTES) -> Model:
    """``labelled``: doc_id, text, lang. Bytes are counted on the executors; the bounded counts meet here."""
    if not 0 <= order <= 6:
        raise ValueError("max_order is 0 to 6")
    fit = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0) & (F.octet_length("text") <= max_doc_bytes))
    per_lang = {r["lang"]: r["n"] for r in fit.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(per_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(per_lang)
    if not languages:
        return Model([], order, [], [], [], [])
    number = F.create_map(*[x for i, name in enumerate(languages) for x in (F.lit(name), F.struct(F.lit(i).alias("i"), F.lit(min(1.0, max_docs / per_lang[name])).alias("p")))])
    picked = fit.select("text", number[F.col("lang")].alias("l"), F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 20)).alias("draw")).where(F.col("draw") < F.col("l.p") * (1 << 20))

    def count(batches):
        for batch in batches:
            lang = batch.column(1).to_numpy()
            for i, j, data, offsets in chunks(*text_bytes(batch.column(0))):
                key = grams(data, offsets[:-1], order)
                for code in np.unique(lang[i:j]):
                    own, n = np.unique(key[np.repeat(lang[i:j] == code, np.diff(offsets))], return_counts=True)
                    yield pa.record_batch([pa.array(np.full(len(own), code, np.int32)), pa.array(own.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = picked.select("text", "l.i").mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return build_model(languages, counted["gram"].to_numpy(np.int64).view(np.uint64), counted["lang"].to_numpy(), counted["n"].to_numpy(np.float64), order)


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score."""
    if not model.languages:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    fewer_rows(docs)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: int, score: double>")
    def best(texts: pa.Array) -> pa.Array:
        lang, score = [], []
        for _, _, data, offsets in chunks(*text_bytes(texts), 1 << 18):
            bits = held.value.code_lengths(data, offsets)
            less = bits - bits.min(axis=1, keepdims=True)
            lang.append(less.argmin(axis=1))
            score.append(1 / np.exp2(-less).sum(axis=1))
        return pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *lang]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0), *score]))], ["lang", "score"])

    names = F.array(*map(F.lit, model.languages))
    letters = has_letter(F.col(text))
    judged = docs.select(packed_row(docs, ["lang_pred", "score"]), letters.alias("letters"), best(text).alias("best"))
    return judged.select("row.*", F.when(F.col("letters"), F.get(names, F.col("best.lang"))).otherwise("und").alias("lang_pred"), F.when(F.col("letters"), F.col("best.score")).otherwise(0.0).alias("score"))
