"""Keys met across documents without ever gathering a hot key.

Map tasks send places (key, doc, at) in arrays, a row per bucket of keys. A key that a map task has met
often is settled there: its places pass through as ``settled`` and one witness goes to the key's
bucket. So a bucket gets a key at most once or twice per map flush, however hot the key is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import chunks, give_back, mixed, text_bytes
from tallyforge.llm.shared import fewer_rows
from tallyforge.llm.url_filter import build_level, hashed, passing

FLUSH_KEYS = 100_000
#: A task compares its keys in so many slices, which bounds the copies that it makes of them.
SLICES = 8
#: So many document ids are sent to all tasks as they are (16 MB).
FEW_IDS = 1_000_000
#: A filter of document ids is sent to all tasks only below this size; beyond it the whole table is joined.
MAX_FILTER_BYTES = 64 << 20
#: Text whose places one shuffle partition takes.
BUCKET_BYTES = 64 << 20
SCHEMA = "bucket int, settled boolean, key array<long>, extra array<long>, doc array<long>, at array<int>"
FIELDS = ["bucket", "settled", "key", "extra", "doc", "at"]

#: From (bytes, offsets, all columns but the text of the chunk) to (key, extra, doc, place).
Finder = Callable[[np.ndarray, np.ndarray, list[pa.Array]], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def split(column: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(column, kind))


def packed(bucket: np.ndarray, settled: bool, columns: list[np.ndarray]) -> pa.RecordBatch | None:
    if not len(bucket):
        return None
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    cuts = np.append(first, len(bucket))
    arrays = [split(c[order], cuts, pa.int32() if i == 3 else pa.int64()) for i, c in enumerate(columns)]
    return pa.record_batch([pa.array(names.astype(np.int32)), pa.array(np.full(len(names), settled)), *arrays], FIELDS)


def groups(key: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by key, and where each distinct key begins."""
    order = np.lexsort((extra, key))
    k, e = key[order], extra[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (e[1:] != e[:-1])
    return order, np.flatnonzero(new)


def repeats(key, extra, doc, at, across_docs: bool):
    """(settled places, places to send) of a map task's keys: keys met twice are settled."""
    order, first = groups(key, extra)
    size = np.diff(np.append(first, len(order)))
    if across_docs and len(first):
        many = np.maximum.reduceat(doc[order], first) != np.minimum.reduceat(doc[order], first)
    else:
        many = size >= 2
    member = np.repeat(many, size)
    settled, send = order[member], np.concatenate([order[~member], order[first[many]]])
    witness = np.concatenate([np.zeros(int((~member).sum()), bool), np.ones(int(many.sum()), bool)])
    return settled, send, witness


def later(key, extra, doc, at):
    """(settled places, places to send): of equal keys only the smallest doc goes on, the others have lost."""
    order, first = groups(key, extra)
    size = np.diff(np.append(first, len(order)))
    least = np.repeat(np.minimum.reduceat(doc[order], first), size) if len(first) else doc[order]
    lost = doc[order] > least
    return order[lost], order[~lost], np.zeros(int((~lost).sum()), bool)


def send(rows: DataFrame, find: Finder, mode: str, buckets: int) -> DataFrame:
    """``rows``: a long without nulls, text and further columns that ``find`` gets. Modes: any, docs (a key counts if
    it is met twice, or in two documents) and later (a place counts if a smaller document has its key)."""

    def flush(parts: list[tuple], turn: int) -> Iterator[pa.RecordBatch]:
        key, extra, doc, at = (np.concatenate(p) for p in zip(*parts, strict=True))
        done, go, witness = later(key, extra, doc, at) if mode == "later" else repeats(key, extra, doc, at, mode == "docs")
        columns = [signed(key), signed(extra), doc, at]
        spread = (np.arange(len(done)) // 20_000 + turn) % buckets
        yield packed(spread, True, [c[done] for c in columns])
        yield packed((key[go] % np.uint64(buckets)).astype(np.int64), False, [*(c[go] for c in columns[:3]), np.where(witness, -1, at[go])])

    def run(batches):
        parts, held, turn = [], 0, 0
        for batch in batches:
            for i, j, data, offsets in chunks(*text_bytes(batch.column(1))):
                key, extra, doc, at = find(data, offsets, [c.slice(i, j - i) for k, c in enumerate(batch.columns) if k != 1])
                parts.append((key, extra, doc, at.astype(np.int32)))
                held += len(key)
                if held >= FLUSH_KEYS:
                    turn += 1
                    yield from (b for b in flush(parts, turn) if b is not None)
                    parts, held = [], 0
                    give_back()
        if held:
            yield from (b for b in flush(parts, turn + 7) if b is not None)
        give_back()

    return fewer_rows(rows).mapInArrow(run, SCHEMA)


def met(sent: DataFrame, mode: str, buckets: int) -> DataFrame:
    """(doc, at array): the places that count, one row per document."""

    def run(batches):
        kept: list[tuple] = []
        found: list[tuple] = []
        for batch in batches:
            done = batch.column(1).to_numpy(zero_copy_only=False)
            cols = [batch.column(c) for c in range(2, 6)]
            if done.any():
                mask = pa.array(done)
                found.append(tuple(c.filter(mask).flatten().to_numpy() for c in cols[2:]))
            if not done.all():
                mask = pa.array(~done)
                kept.append(tuple(c.filter(mask).flatten().to_numpy() for c in cols))
        whole = [np.concatenate(p) for p in zip(*kept, strict=True)]
        kept.clear()
        slices = whole[0].view(np.uint64) // np.uint64(buckets) % np.uint64(SLICES) if whole else None
        for s in range(SLICES if whole else 0):
            key, extra, doc, at = (c[slices == s] for c in whole)
            if mode == "later":
                hit, _, _ = later(key, extra, doc, at)
            else:
                if not len(key):
                    continue
                order, first = groups(key, extra)
                size = np.diff(np.append(first, len(order)))
                seen = np.logical_or.reduceat(at[order] < 0, first)
                twice = np.maximum.reduceat(doc[order], first) != np.minimum.reduceat(doc[order], first) if mode == "docs" else size >= 2
                hit = order[np.repeat(seen | twice, size)]
                hit = hit[at[hit] >= 0]
            found.append((doc[hit], at[hit]))
        whole.clear()
        if found:
            yield from home(*(np.concatenate(p) for p in zip(*found, strict=True)), buckets=buckets)
        give_back()

    return gathered(sent.repartition(buckets, "bucket").mapInArrow(run, HOME), buckets)


HOME = "home int, doc array<long>, at array<int>, until array<int>"


def home(doc: np.ndarray, at: np.ndarray, until: np.ndarray | None = None, buckets: int = 1) -> Iterator[pa.RecordBatch]:
    """Places on their way back to their documents: one row per bucket of documents."""
    if len(doc):
        bucket = (mixed(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        names, first = np.unique(bucket[order], return_index=True)
        cuts = np.append(first, len(doc))
        ends = split(until[order], cuts, pa.int32()) if until is not None else pa.array([None] * len(names), pa.list_(pa.int32()))
        yield pa.record_batch([pa.array(names), split(doc[order], cuts, pa.int64()), split(at[order], cuts, pa.int32()), ends], ["home", "doc", "at", "until"])


def gathered(rows: DataFrame, buckets: int) -> DataFrame:
    """(doc, at array, until array) of rows made by ``home``: one row per document."""

    def run(batches):
        got = [[batch.column(c) for c in (1, 2, 3)] for batch in batches]
        if not got:
            return
        doc, at, until = (np.concatenate([g[c].flatten().to_numpy(zero_copy_only=False) for g in got]) for c in range(3))
        order = np.argsort(doc, kind="stable")
        ids, first = np.unique(doc[order], return_index=True)
        cuts = np.append(first, len(doc))
        ends = split(until[order].astype(np.int32), cuts, pa.int32()) if len(until) else pa.array([None] * len(ids), pa.list_(pa.int32()))
        if len(ids):
            yield pa.record_batch([pa.array(ids), split(at[order].astype(np.int32), cuts, pa.int32()), ends], ["doc", "at", "until"])

    return rows.repartition(buckets, "home").mapInArrow(run, "doc long, at array<int>, until array<int>")


def bucket_count(docs: DataFrame) -> int:
    """Shuffle partitions for places of all texts: the session's, or more, so that one holds those of BUCKET_BYTES of text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size // BUCKET_BYTES) + 1)


def by_ids(docs: DataFrame, ids: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """(documents whose ``key`` may be one of ``ids`` (column doc), documents whose key surely is none).

    That spares the others' texts a shuffle. Few ids are sent to all tasks as they are, and decide exactly; more as
    a Bloom filter; where that would be too large, all may.
    """
    keys = ids.select(*hashed(F.col("doc")))
    n = keys.count()
    if n <= FEW_IDS:
        few = F.broadcast(ids.select(F.col("doc").alias("few_doc")))
        return tuple(docs.join(few, key == F.col("few_doc"), how) for how in ("left_semi", "left_anti"))
    if n * 2 > MAX_FILTER_BYTES:
        return docs, docs.where(F.lit(False))
    level = build_level(keys, 0, 12.0, 8, MAX_FILTER_BYTES)
    if level is None:
        return docs.where(F.lit(False)), docs
    return passing(docs, level, True, hashed(key)), passing(docs, level, False, hashed(key))
