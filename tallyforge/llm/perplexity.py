"""Quality rules: base rules on words and lines, and bands of n-gram perplexity for each language.

The model is an interpolated modified Kneser-Ney model of bytes, one for each value of ``lang``. Spark counts
the n-grams of all documents (tasks combine theirs before the shuffle); lower orders count distinct bytes to
the left, with the three discounts of the order's own counts of counts. For every n-gram met, the code length
log2(1 / p) is kept in an array sorted by a 64-bit hash of language, order and bytes (one to one, so free of
collisions), with a directory of the leading bits; contexts have such an array of back-off weights.

Two models judge. The one of order ORDER counts all occurrences; its n-grams are few (a few thousand a language).
The one of order OTHERS_ORDER counts documents: an n-gram of d documents counts d - 1, so that no document vouches for
its own n-grams, however often it repeats them; those of a single document are unknown to it. The size of a model is
bounded by the alphabet, not by the corpus: at most 256**n n-grams a language, of which valid text uses few. It goes
to all tasks; beyond MAX_NGRAMS it is an error.

A document's perplexity is 2**(code length per byte). Per language, the median of the code length per byte
and its spread (median absolute deviation as a standard deviation) over all documents that pass the base rules
come from a histogram of STEP bits. The band of a document of b bytes is median -+ WIDTH * sqrt(spread**2 +
v / b), v the variance of a byte's code length: short texts have a wider one. A document is kept inside both bands.

Defined cases: null text has no words and fails the base rules, as do all texts of fewer than LEAST_WORDS words;
a null ``lang`` is a language of its own; no base-passing document in a language: no band, nothing to judge;
repeated rows and null ids are judged row by row; texts of any length are read whole; other columns are not
read; an empty table gives an empty result. Lines, words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import SPACE, SpanHash, chunks, give_back, gram_hash, mixed, text_bytes, words
from tallyforge.llm.language_id import grams
from tallyforge.llm.shared import fewer_rows, saved

ORDER, OTHERS_ORDER, MAX_LANGUAGES, MAX_NGRAMS, TASK_NGRAMS = 3, 5, 256, 1 << 24, 1 << 20
LEAST_WORDS, WINDOW, REPEATED_PERCENT = 20, 8, 30
STEP, WIDTH, LEAST_SPREAD = 1 / 1024, 3.0, 0.01
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
LANGUAGE = np.uint64(56)
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORED = f"doc_id long, code int, n_bytes long, bits double, squares double, {', '.join(m + ' long' for m in METRICS)}"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_WORD_CHAR = ~SPACE & (np.arange(256) >> 6 != 2)
_LINE_END = np.zeros(256, bool)
_LINE_END[10] = True


class HashArray:
    """Distinct uint64 keys, sorted by hash, and a value for each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        h = mixed(keys)
        order = np.argsort(h)
        self.hashes, self.values = np.append(h[order], np.uint64(0)), np.append(values[order], np.nan).astype(np.float32)
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes[:-1] >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
        self.longest = int(np.diff(self.first).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys``, NaN for absent ones."""
        h = mixed(keys)
        bucket = (h >> self.shift).astype(np.int64)
        at, end = self.first[bucket], self.first[bucket + 1]
        out = np.where((self.hashes[at] == h) & (at < end), self.values[at], np.float32(np.nan))
        left = np.flatnonzero(np.isnan(out) & (at + 1 < end))
        for step in range(1, self.longest):
            if not len(left):
                break
            place = at[left] + step
            hit = self.hashes[place] == h[left]
            out[left[hit]] = self.values[place[hit]]
            left = left[~hit & (place + 1 < end[left])]
        return out


@dataclass
class Model:
    languages: list[str | None]
    order: int
    cost: list[HashArray]
    backoff: list[HashArray]

    def code_lengths(self, data: np.ndarray, starts: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Bits of each byte; ``starts``: where texts begin, ``code``: the language of each byte."""
        return self.bits(grams(data, starts, self.order - 1), code.astype(np.uint64) << LANGUAGE, self.order)

    def bits(self, gram: np.ndarray, language: np.ndarray, n: int) -> np.ndarray:
        if not n:
            return np.full(len(gram), 8, np.float32)
        gram = gram & np.uint64((1 << 8 * n) - 1)
        out = self.cost[n - 1].find(gram | language)
        unseen = np.flatnonzero(np.isnan(out))
        if len(unseen):
            weight = self.backoff[n - 1].find((gram[unseen] >> np.uint64(8)) | language[unseen])
            out[unseen] = np.nan_to_num(weight, nan=0.0) + self.bits(gram[unseen], language[unseen], n - 1)
        return out


def discounts(counts: np.ndarray, code: np.ndarray, languages: int) -> np.ndarray:
    """Of each n-gram by modified Kneser-Ney: from its language's numbers of n-grams counted 1, 2, 3 and 4 times.

    Where one of those numbers is 0, half of min(count, 3) / 3 stands in."""
    n = [np.bincount(code[counts == i], minlength=languages).astype(float) for i in (1, 2, 3, 4)]
    table = np.zeros((languages, 4))
    for i in (1, 2, 3):
        with np.errstate(divide="ignore", invalid="ignore"):
            d = i - (i + 1) * n[0] / (n[0] + 2 * n[1]) * n[i] / n[i - 1]
        table[:, i] = np.where(np.isfinite(d) & (n[i] > 0) & (d > 0), d, i / 6)
    return table[code, np.minimum(counts, 3).astype(int)]


def build_model(languages: list[str | None], keys: np.ndarray, counts: np.ndarray, order: int) -> Model:
    """``keys``: distinct n-grams of the highest order (language in the top byte) with their counts."""
    levels = [(keys, counts)]
    for n in range(order - 1, 0, -1):
        levels.append(np.unique(levels[-1][0] & np.uint64(0xFF << 56 | (1 << 8 * n) - 1), return_counts=True))
    model, p, shorter = Model(languages, order, [], []), np.zeros(0), np.zeros(0, np.uint64)
    for n, (gram, count) in enumerate(reversed(levels), 1):
        code = (gram >> LANGUAGE).astype(np.int64)
        context = (gram & np.uint64(0xFF << 56)) | ((gram & np.uint64((1 << 56) - 1)) >> np.uint64(8))
        found, at = np.unique(context, return_inverse=True)
        less, total = discounts(count, code, len(languages)), np.bincount(at, count)
        weight = np.bincount(at, less) / total
        lower = p[np.searchsorted(shorter, gram & np.uint64(0xFF << 56 | (1 << 8 * (n - 1)) - 1))] if n > 1 else np.full(len(gram), 1 / 256)
        p, shorter = (count - less) / total[at] + weight[at] * lower, gram
        model.cost.append(HashArray(gram, -np.log2(p)))
        model.backoff.append(HashArray(found, -np.log2(weight)))
    return model


def coded(docs: DataFrame, languages: list[str | None]) -> Column:
    """The place of a row's lang in ``languages``, which holds all of them."""
    code = F.lit(languages.index(None) if None in languages else 0)
    named = [x for i, name in enumerate(languages) if name is not None for x in (F.lit(name), F.lit(i))]
    return (F.coalesce(F.try_element_at(F.create_map(*named), F.col("lang")), code) if named else code).cast("int")


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, n = (np.concatenate(p) for p in zip(*parts, strict=True))
    own, place = np.unique(key, return_inverse=True)
    return own, np.bincount(place, n, len(own)).astype(np.int64)


def once_a_text(gram: np.ndarray, text: np.ndarray) -> np.ndarray:
    """``gram`` in order, each once for every text (numbers that don't fall) that has it."""
    order = np.argsort(gram, kind="stable")
    gram, text = gram[order], text[order]
    return gram[np.append(True, (gram[1:] != gram[:-1]) | (text[1:] != text[:-1]))]


def count_ngrams(docs: DataFrame, languages: list[str | None], order: int, others: bool = False) -> DataFrame:
    """(gram, n) over all bytes of all documents; the language is in the top byte. ``others``: n is the number of documents
    that have the n-gram less one, and n-grams of one document are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        rows = lambda x: pa.record_batch([pa.array(x[0].view(np.int64)), pa.array(x[1])], ["gram", "n"])
        for batch in batches:
            code = batch.column(1).to_numpy().astype(np.uint64)
            for i, j, data, offsets in chunks(*text_bytes(batch.column(0))):
                if len(data):
                    some = offsets[:-1][offsets[1:] > offsets[:-1]]
                    gram = grams(data, some, order - 1) | np.repeat(code[i:j], np.diff(offsets)) << LANGUAGE
                    parts.append(np.unique(once_a_text(gram, np.repeat(np.arange(j - i), np.diff(offsets))) if others else gram, return_counts=True))
                if sum(len(p[0]) for p in parts) > TASK_NGRAMS:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > TASK_NGRAMS // 2:
                        yield rows(parts.pop())
        if parts:
            yield rows(merged(parts))
        give_back()

    sent = fewer_rows(docs).select("text", coded(docs, languages)).mapInArrow(count, "gram long, n long")
    counted = sent.groupBy("gram").agg(F.sum("n").alias("n"))
    return counted.where("n > 1").withColumn("n", F.col("n") - 1) if others else counted


def train(docs: DataFrame, order: int = ORDER, others: bool = False) -> Model:
    """``docs``: text, lang. ``others`` as in ``count_ngrams``."""
    if not 1 <= order <= 7:
        raise ValueError("order is 1 to 7")
    languages = sorted((r["lang"] for r in docs.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()), key=lambda x: (x is not None, x))
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counted = count_ngrams(docs, languages, order, others).limit(MAX_NGRAMS + 1).toArrow()
    if counted.num_rows > MAX_NGRAMS:
        raise ValueError(f"more than {MAX_NGRAMS} n-grams of {order} bytes: choose a lower order")
    keys = counted["gram"].to_numpy().view(np.uint64)
    by_key = np.argsort(keys)
    model = build_model(languages, keys[by_key], counted["n"].to_numpy()[by_key], order)
    give_back()
    return model


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over each text."""
    return np.diff(np.concatenate([np.zeros(1, flags.dtype if flags.dtype.kind == "f" else np.int64), np.cumsum(flags)])[offsets])


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all, later): places whose key occurs twice or more, and those but the first of each key."""
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    return order[same[1:] | same[:-1]], order[same[:-1]]


def measures(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """METRICS of each text."""
    docs, spans = len(offsets) - 1, SpanHash(data)
    start, end, first = words(data, offsets)
    salt = mixed(np.arange(1, docs + 1, dtype=np.uint64))
    windows = gram_hash(spans.of(start, end), WINDOW)
    doc = np.repeat(np.arange(docs), np.diff(first))[: len(windows)]
    inside = np.flatnonzero(np.arange(len(windows)) + WINDOW <= first[1:][doc])
    again = inside[repeated(windows[inside] ^ salt[doc[inside]])[0]]
    edge = np.zeros(len(start) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    begin, stop, line = words(data, offsets, _LINE_END)
    of = np.repeat(np.arange(docs), np.diff(line))
    seen = np.concatenate([np.zeros(1, np.int64), np.cumsum(~SPACE[data])])
    full = np.flatnonzero(seen[stop] > seen[begin])
    twice = full[repeated(spans.of(begin[full], stop[full]) ^ salt[of[full]])[1]]
    return [np.diff(first), per_text(_WORD_CHAR[data], offsets), per_text(_SYMBOL[data], offsets), np.bincount(of[twice], minlength=docs), per_text(covered, first)]


def score(docs: DataFrame, model: Model, others: Model | None = None) -> DataFrame:
    """SCORED for each of ``docs``: doc_id, text, lang; by ``others``, a second model of the same languages, others_bits and others_squares."""
    models = [m for m in (model, others) if m]
    held = docs.sparkSession.sparkContext.broadcast(models)
    schema = SCORED + ", others_bits double, others_squares double" * (len(models) - 1)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(2).to_numpy()
            for i, j, data, offsets in chunks(*text_bytes(batch.column(1))):
                some = offsets[:-1][offsets[1:] > offsets[:-1]]
                of = np.repeat(code[i:j], np.diff(offsets))
                found = [m.code_lengths(data, some, of).astype(np.float64) if len(data) else np.zeros(0) for m in held.value]
                sums = [per_text(x, offsets) for bits in found for x in (bits, bits * bits)]
                columns = [np.diff(offsets), *sums[:2], *measures(data, offsets), *sums[2:]]
                yield pa.record_batch([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), *map(pa.array, columns)], names)
        give_back()

    return fewer_rows(docs).select(F.col("doc_id").cast("long"), "text", coded(docs, model.languages)).mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values)
    total = np.cumsum(weights[order])
    return float(values[order][np.searchsorted(total, total[-1] / 2)])


def bands(scored: DataFrame, model: str = "") -> DataFrame:
    """(code, middle, spread, variance) of each language, from all documents that pass the base rules; ``model``: "", or "others_"."""
    usable = scored.where(~base_failed()).withColumns({c: F.col(model + c) for c in ("bits", "squares")})
    step = F.floor(F.col("bits") / F.col("n_bytes") / STEP)
    histogram = usable.groupBy("code", step.alias("step")).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("n_bytes", "bits", "squares")]).toPandas()
    out = []
    for code, rows in histogram.groupby("code"):
        x, n = (rows["step"].to_numpy(float) + 0.5) * STEP, rows["n"].to_numpy()
        middle = weighted_median(x, n)
        spread = max(LEAST_SPREAD, 1.4826 * weighted_median(np.abs(x - middle), n))
        size, mean = rows["n_bytes"].sum(), rows["bits"].sum() / rows["n_bytes"].sum()
        out.append((int(code), middle, spread, float(max(0.0, rows["squares"].sum() / size - mean * mean))))
    return scored.sparkSession.createDataFrame(out, "code int, middle double, spread double, variance double")


def judge(docs: DataFrame, order: int = ORDER, width: float = WIDTH, others_order: int = OTHERS_ORDER) -> DataFrame:
    """``docs``: doc_id, text, lang. doc_id, METRICS, perplexity, its band (least, most), the same by the model of other
    documents (others_), base_failed and kept."""
    docs = docs.select("doc_id", "text", "lang")
    scored = saved(score(docs, train(docs, order), train(docs, others_order, others=True)))
    rows, kept, powers = scored.withColumn("base_failed", base_failed()), ~F.col("base_failed"), {}
    for model in ("", "others_"):
        band = bands(scored, model).select("code", *[F.col(c).alias(model + c) for c in ("middle", "spread", "variance")])
        rows = rows.join(F.broadcast(band), "code", "left")
        middle, spread = F.col(model + "middle"), F.col(model + "spread")
        reach = width * F.sqrt(spread * spread + F.try_divide(model + "variance", "n_bytes"))
        rate = F.try_divide(model + "bits", "n_bytes")
        kept = kept & F.coalesce(F.abs(rate - middle) <= reach, F.lit(True))
        powers |= {model + "perplexity": rate, model + "least": middle - reach, model + "most": middle + reach}
    return rows.select("doc_id", *METRICS, *[F.pow(F.lit(2.0), x).alias(name) for name, x in powers.items()], "base_failed", kept.alias("kept"))
