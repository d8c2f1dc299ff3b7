"""URL rules held in Bloom filter cascades.

A rule is ``host/path``. The keys of a url are all its host suffixes joined to all prefixes of its
path that have the length of some rule's path. One cascade holds the allow rules, one the block
rules. Level 0 encodes the listed keys; level 1 encodes those keys of the corpus's complete key
universe that pass level 0 without being listed; level 2 encodes the listed keys that pass level 1;
and so on until a level lets no wrong key through. Over that universe membership is exact, and a
url is judged by bit tests alone: no join, no shuffle.

Defined cases: a null url or one without ``://`` has an empty host and path and no rule; a rule with
a null or empty part after cleaning is ignored; of rules that fit, the longest wins, then the one with
the longer host; urls without a rule get ``default``; repeated rows are judged alike; urls of any length are whole; columns of any other
name stay, those of the result's names are replaced; an empty table gives an empty result. A rule listed as both allow and block is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import mixed
from tallyforge.llm.shared import ascii_lower, packed_row, saved

#: A level's filter is broadcast; a longer list of keys needs a larger bound, set knowingly.
MAX_FILTER_BYTES = 256 << 20
MAX_LEVELS = 64


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` of 64 bits, ``probes`` bits a key, its own ``seed``."""

    words: np.ndarray
    probes: int
    seed: int

    def test(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), bool)
        for at in positions(h1, h2, self.seed, self.probes, len(self.words) * 64):
            found &= (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
        return found


def positions(h1: np.ndarray, h2: np.ndarray, seed: int, probes: int, n_bits: int):
    a = mixed(h1 + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    b = mixed(h2 ^ np.uint64((seed + 1) * 0xD1B54A32D192ED03 % 2**64)) | np.uint64(1)
    for j in range(probes):
        yield ((a + np.uint64(j) * b) % np.uint64(n_bits)).astype(np.int64)


def listed(levels: list[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """A key that first fails an odd level is listed; one that passes all is what the last encodes."""
    out = np.full(len(h1), len(levels) % 2 == 1)
    alive = np.arange(len(h1))
    for i, level in enumerate(levels):
        ok = level.test(h1[alive], h2[alive])
        out[alive[~ok]] = i % 2 == 1
        alive = alive[ok]
    return out


def hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit("second")).alias("h2")]


def _unsigned(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)


def build_level(keys: DataFrame, seed: int, bits_per_key: float, probes: int, max_bytes: int) -> Level | None:
    """The filter of ``keys`` (h1, h2); None without keys. Bits are merged on executors by word."""
    n = keys.count()
    if not n:
        return None
    n_words = max(1, int(np.ceil(n * bits_per_key / 64)))
    if n_words * 8 > max_bytes:
        raise ValueError(f"{n} keys need a filter of {n_words * 8} bytes; max_filter_bytes is {max_bytes}")

    def words(batches):
        for batch in batches:
            h1, h2 = _unsigned(batch.column(0)), _unsigned(batch.column(1))
            at = np.concatenate(list(positions(h1, h2, seed, probes, n_words * 64)))
            bits = np.uint64(1) << (at & 63).astype(np.uint64)
            order = np.argsort(at >> 6, kind="stable")
            word, start = np.unique((at >> 6)[order], return_index=True)
            if len(word):
                yield pa.record_batch([pa.array(word), pa.array(np.bitwise_or.reduceat(bits[order], start).view(np.int64))], ["word", "bits"])

    merged = keys.select("h1", "h2").mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(n_words, np.uint64)
    out[merged["word"].to_numpy()] = merged["bits"].to_numpy().view(np.uint64)
    return Level(out, probes, seed)


def passing(keys: DataFrame, level: Level, wanted: bool = True, hashes: list[Column] | None = None) -> DataFrame:
    """The rows whose ``hashes`` (by default h1, h2) pass the filter, or don't."""
    held = keys.sparkSession.sparkContext.broadcast(level)

    @F.arrow_udf("boolean")
    def passes(h1: pa.Array, h2: pa.Array) -> pa.Array:
        return pa.array(held.value.test(_unsigned(h1), _unsigned(h2)))

    return keys.where(passes(*(hashes or ("h1", "h2"))) == wanted)


def build_cascade(universe: DataFrame, keys: DataFrame, bits_per_key: float = 12.0, max_filter_bytes: int = MAX_FILTER_BYTES) -> list[Level]:
    """``universe`` and ``keys``: string column ``key``. Exact for every key of either.

    The universe is read once; only its false positives (one in about 300) are grouped and kept.
    """
    keys = saved(keys.where("key is not null").select("key").distinct().select("key", *hashed(F.col("key"))))
    levels: list[Level] = []
    first = build_level(keys, 0, bits_per_key, max(1, round(bits_per_key * 0.69)), max_filter_bytes)
    if first is None:
        return levels
    levels.append(first)
    wrong = passing(universe.where("key is not null").select("key", *hashed(F.col("key"))), first)
    sets = [keys, saved(wrong.join(keys.select("key"), "key", "left_anti").distinct())]
    while len(levels) < MAX_LEVELS:
        i = len(levels)
        level = build_level(sets[i % 2], i, 2.0, 1, max_filter_bytes)
        if level is None:
            return levels
        levels.append(level)
        sets[(i + 1) % 2] = saved(passing(sets[(i + 1) % 2], level))
    raise RuntimeError("the cascade doesn't end: two keys share both hashes")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_keys(host: Column, path: Column, max_labels: int, path_lengths: list[int]) -> Column:
    """All keys of a url that a rule could be, longest first, then by the longer host."""
    labels = F.split(host, r"\.", -1)
    labels = F.slice(labels, F.greatest(F.size(labels) - max_labels + 1, F.lit(1)), F.lit(max_labels))
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.lit(max_labels)), "."))
    tails = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths]), lambda x: x.isNotNull())
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(tails, lambda t: F.struct((-F.length(h) - F.length(t)).alias("a"), (-F.length(h)).alias("b"), F.concat(h, t).alias("key")))))
    return F.transform(F.array_sort(pairs), lambda x: x["key"])


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", bits_per_key: float = 12.0, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``pages`` plus host, path, rule, verdict (these names win over columns of the input).

    ``rules``: columns ``rule`` (``host/path``) and ``action`` (allow or block).
    """
    rule = F.concat(ascii_lower(F.substring_index("rule", "/", 1)), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)"))
    rules = saved(rules.where("rule is not null and rule <> '' and not startswith(rule, '/')").select(rule.alias("key"), "action").distinct())
    shape = rules.select(F.size(F.split(F.substring_index("key", "/", 1), r"\.", -1)).alias("labels"), F.when(F.contains("key", F.lit("/")), F.length("key") - F.length(F.substring_index("key", "/", 1))).otherwise(F.lit(0)).alias("tail"))
    max_labels, path_lengths = shape.agg(F.max("labels"), F.sort_array(F.collect_set("tail"))).first()
    if rules.groupBy("key").count().where("count > 1").limit(1).count():
        raise ValueError("a rule is listed as both allow and block")
    base = pages.withColumns({"host": F.coalesce(host_of(F.col(url)), F.lit("")), "path": F.coalesce(path_of(F.col(url)), F.lit(""))})
    keys = url_keys(F.col("host"), F.col("path"), max_labels or 1, path_lengths or [0])
    universe = base.select(F.explode(keys).alias("key"))
    both = [build_cascade(universe, rules.where(F.col("action") == a), bits_per_key, max_filter_bytes) for a in ("allow", "block")]
    held = pages.sparkSession.sparkContext.broadcast(both)

    @F.arrow_udf("int")
    def longest(h1: pa.Array, h2: pa.Array) -> pa.Array:
        """The place of the first listed key, negative for an allow rule; 0 without one."""
        sizes = h1.value_lengths().to_numpy()
        a, b = (_unsigned(h.flatten()) for h in (h1, h2))
        allow, block = (listed(levels, a, b) if levels else np.zeros(len(a), bool) for levels in held.value)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        out = np.zeros(len(sizes), np.int32)
        hit = np.flatnonzero(allow | block)[::-1]
        out[row[hit]] = np.where(allow[hit], -place[hit], place[hit])
        return pa.array(out)

    h1, h2 = F.transform("keys", lambda k: F.xxhash64(k)), F.transform("keys", lambda k: F.xxhash64(k, F.lit("second")))
    judged = base.select(packed_row(base, ["rule", "verdict"]), keys.alias("keys")).withColumn("at", longest(h1, h2))
    rule, verdict = F.when(F.col("at") != 0, F.get("keys", F.abs("at") - 1)), F.when(F.col("at") < 0, "allow").when(F.col("at") > 0, "block").otherwise(default)
    return judged.select("row.*", rule.alias("rule"), verdict.alias("verdict"))
