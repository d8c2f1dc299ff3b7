"""Byte strings that occur twice, by sampled suffix sorting with induced order and common-prefix values.

A string of ``LENGTH`` bytes occurs twice where the common prefix of two neighbours in suffix order
reaches LENGTH. Only suffixes that can have such a neighbour are sorted, and only one in about
``SPAN / 2`` of them by comparing bytes; the order of all others is induced:

1. Of the SPAN places from a string's start, the one with the least 8-byte hash is its sample; that
   depends on the string's own bytes. All strings of a sample hold the ``CORE`` bytes from it on, so
   samples whose core occurs once in the whole corpus are done: their strings occur once.
2. Tuples (core, bytes to the left and right of the sample) of the rest are dealt by core. Spark's
   external sort, whose runs spill to disk and merge, hands each task its tuples in suffix order.
   Of equal tuples two go on, the others are settled where they meet.
3. A task streams over that order, core by core, with the common prefix of neighbours. From the order of
   the suffixes at distance d - 1 to the left of the samples, a stable sort by the byte at distance d gives that at
   distance d; the common prefix of two neighbours there is one more than the least of those that lay
   between them. A suffix is a repeat where a neighbour's common prefix reaches LENGTH. So a task holds
   the distinct tuples of one core, or ``flush_rows`` tuples.
4. Cores that a sample of the documents shows to be frequent are split: their tuples are dealt by the longer
   stretch that all strings of ``STEP`` neighbouring distances share, so that one core is many groups.
5. Starts of repeats go back to their documents, and the bytes that they cover are removed.

Defined cases: null text is empty; strings never cross texts; texts of any length are whole; rows of one id
are texts of their own within a string's count but share removals, so ids should be unique; rows
with a null id are told apart by their text; ids are integers; columns of any other name stay, those
of the result's names are replaced; an empty table gives none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import SpanHash, argmin_windows, chunks, give_back, mixed, ranges, text_bytes
from tallyforge.llm.exchange import HOME, bucket_count, by_ids, gathered, home, met, send, signed
from tallyforge.llm.shared import doc_key, fewer_rows, packed_row, saved

LENGTH, SPAN = 200, 100
CORE = LENGTH - SPAN + 1
WIDTH = SPAN - 1 + LENGTH
FLUSH_ROWS = 20_000
#: A core with about this many places is split by distance, STEP distances a group.
HOT_PLACES, STEP = 2_000, 10
#: Documents that the search for such cores reads; which cores are split changes no result.
SAMPLE_DOCS = 100_000
RESULT = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def samples(data: np.ndarray, offsets: np.ndarray):
    """(text, sample, nearest, farthest): each run of string starts with one sample, as distances to it."""
    x = np.concatenate([data, np.zeros(8, np.uint8)])
    key = np.zeros(len(data), np.uint64)
    for i in range(8):
        key |= x[i : len(data) + i].astype(np.uint64) << np.uint64(8 * i)
    text, start = ranges(offsets[:-1], np.maximum(np.diff(offsets) - LENGTH + 1, 0))
    if not len(start):
        return (start,) * 4
    at = argmin_windows(mixed(key) >> np.uint64(1), SPAN)[start]
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(new[1:], len(at)) - 1
    return text[new], at[new], at[new] - start[last], at[new] - start[new]


def cores(data, offsets):
    text, at, _, _ = samples(data, offsets)
    return SpanHash(data).of(at, at + CORE), text, at - offsets[text]


def find_cores(data, offsets, more):
    core, text, at = cores(data, offsets)
    return core, np.zeros(len(at), np.uint64), more[0].to_numpy()[text], at


def hot_cores(texts: DataFrame, hot_places: int) -> np.ndarray:
    """Cores that have ``hot_places`` places in ``texts`` (key, text), going by a sample; at most a few times 100,000."""
    one_in = max(1, texts.count() // SAMPLE_DOCS)

    def count(batches):
        for batch in batches:
            for _, _, data, offsets in chunks(*text_bytes(batch.column(1))):
                core, n = np.unique(cores(data, offsets)[0], return_counts=True)
                yield pa.record_batch([pa.array(signed(core)), pa.array(n)], ["core", "n"])

    some = fewer_rows(texts.where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(one_in)) == 0))
    often = some.mapInArrow(count, "core long, n long").groupBy("core").agg(F.sum("n").alias("n")).where(F.col("n") >= max(min(10, hot_places), hot_places // one_in))
    return np.sort(often.select("core").toPandas()["core"].to_numpy(np.int64).view(np.uint64))


FIELDS = ["core", "doc", "at", "near", "far", "left", "right"]


def fixed(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    cuts = (np.arange(len(rows) + 1) * rows.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def settled(doc, at, near, far) -> pa.RecordBatch:
    blank = pa.nulls(len(doc), pa.binary())
    return pa.record_batch([pa.nulls(len(doc), pa.int64()), pa.array(doc), *(pa.array(c.astype(np.int32)) for c in (at, near, far)), blank, blank], FIELDS)


def tuples(joined: DataFrame, hot: np.ndarray, flush_rows: int) -> DataFrame:
    """The suffix tuples of shared samples; ``core`` is null for settled ones.

    Of equal tuples two of a task's flush go on, and none of what the task has sent twice before.
    """
    held_hot = joined.sparkSession.sparkContext.broadcast(hot)

    def flush(parts, sent):
        core, whole, doc, at, near, far, rows, spread = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(whole, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], whole[order][1:] != whole[order][:-1]]))
        size = np.diff(np.append(first, len(order)))
        place = np.arange(len(order)) - np.repeat(first, size)
        done = (place >= 2) | np.isin(whole[order], sent)
        if done.any():
            x = order[done]
            yield settled(doc[x], at[x], near[x], far[x]), None
        go = order[~done]
        wide = np.isin(core[go], held_hot.value)
        plain, often = go[~wide], go[wide]
        if len(plain):
            yield pa.record_batch([pa.array(signed(core[plain])), pa.array(doc[plain]), *(pa.array(c[plain].astype(np.int32)) for c in (at, near, far)), fixed(rows[plain, : SPAN - 1]), fixed(rows[plain, SPAN - 1 :])], FIELDS), None
        for lo in range(0, SPAN if len(often) else 0, STEP):
            x = often[(near[often] < lo + STEP) & (far[often] >= lo)]
            if len(x):
                low, high = np.maximum(near[x], lo).astype(np.int32), np.minimum(far[x], lo + STEP - 1).astype(np.int32)
                yield pa.record_batch([pa.array(signed(spread[x, lo // STEP])), pa.array(doc[x]), pa.array(at[x].astype(np.int32)), pa.array(low), pa.array(high), fixed(rows[x, : SPAN - 1]), fixed(rows[x, SPAN - 1 :])], FIELDS), None
        yield None, np.union1d(sent, whole[order][first[size >= 2]])

    def run(batches):
        parts, held, sent = [], 0, np.zeros(0, np.uint64)

        def out():
            nonlocal sent
            for rows, news in flush(parts, sent):
                if rows is None:
                    sent = news
                else:
                    yield rows

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, data, offsets in chunks(*text_bytes(batch.column(1))):
                text, at, near, far = samples(data, offsets)
                mine = batch.column(2).slice(i, j - i)
                shared = np.zeros(len(data) + 1, bool)
                shared[mine.flatten().to_numpy() + np.repeat(offsets[:-1], mine.value_lengths().to_numpy())] = True
                keep = shared[at]
                text, at, near, far = text[keep], at[keep], near[keep], far[keep]
                hashes = SpanHash(data)
                # Left bytes end at column SPAN - 1, right bytes begin there; what no string holds is 0.
                column = np.arange(WIDTH) - (SPAN - 1)
                for k in range(0, len(at), flush_rows):
                    t, a, n, f = (x[k : k + flush_rows] for x in (text, at, near, far))
                    core = hashes.of(a, a + CORE)
                    whole = hashes.of(a - f, a + LENGTH - n) ^ mixed((n * 1000 + f).astype(np.uint64))
                    rows = data[np.clip(a[:, None] + column, 0, len(data) - 1)]
                    rows[(column < -f[:, None]) | (column >= LENGTH - n[:, None])] = 0
                    # What all strings from distance lo to lo + STEP - 1 share, where the tuple has such strings.
                    spread = np.zeros((len(a), -(-SPAN // STEP)), np.uint64)
                    often = np.flatnonzero(np.isin(core, held_hot.value))
                    for lo in range(0, SPAN if len(often) else 0, STEP):
                        x = often[(n[often] < lo + STEP) & (f[often] >= lo)]
                        spread[x, lo // STEP] = hashes.of(a[x] - lo, a[x] - lo - STEP + 1 + LENGTH)
                    parts.append((core, whole, ids[i:j][t], a - offsets[t], n, f, rows, spread))
                    held += len(a)
                    if held >= flush_rows:
                        yield from out()
                        parts, held = [], 0
                        give_back()
        if held:
            yield from out()

    return joined.mapInArrow(run, "core long, doc long, at int, near int, far int, left binary, right binary")


def common(rows: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the row before it; 0 for the first."""
    out = np.zeros(len(rows), np.int32)
    for i in range(1, len(rows), 20_000):
        differ = rows[i : i + 20_000] != rows[i - 1 : min(i + 20_000, len(rows)) - 1]
        out[i : i + 20_000] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def range_least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low + 1 .. high]) for low < high, by a sparse table."""
    width = high - low
    level = np.frexp(width.astype(np.float64))[1] - 1
    out, table = np.empty(len(low), values.dtype), values
    for k in range(int(level.max(initial=0)) + 1):
        here = level == k
        out[here] = np.minimum(table[low[here] + 1], table[high[here] - (1 << k) + 1])
        if len(table) > 1 << k:
            table = np.minimum(table[: len(table) - (1 << k)], table[1 << k :])
    return out


def induced(core: np.ndarray, near: np.ndarray, far: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tuple, distance) of all strings that occur in two tuples; the tuples come ordered by (core, right bytes)."""
    order = np.arange(len(core))
    prefix = common(rows[:, SPAN - 1 :])
    prefix[1:][core[1:] != core[:-1]] = 0
    found = []
    for d in range(int(far.max(initial=-1)) + 1):
        if d:
            held = np.flatnonzero(far[order] >= d)
            if len(held) < 2:
                break
            byte = rows[order[held], SPAN - 1 - d]
            step = np.lexsort((byte, core[order[held]]))
            old = held[step]
            same = (core[order[old[1:]]] == core[order[old[:-1]]]) & (byte[step][1:] == byte[step][:-1])
            fresh = np.zeros(len(old), np.int32)
            pair = np.flatnonzero(same)
            fresh[pair + 1] = 1 + range_least(prefix, old[pair], old[pair + 1])
            order, prefix = order[old], fresh
        # Strings at this distance: tuples nearer to their text's end have none, and lie between others.
        live = near[order] <= d
        at = np.flatnonzero(live)
        if len(at) > 1:
            hit = range_least(prefix, at[:-1], at[1:]) >= LENGTH
            twice = np.zeros(len(at), bool)
            twice[1:] |= hit
            twice[:-1] |= hit
            found.append((order[at[twice]], np.full(int(twice.sum()), d)))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def found_in(core, doc, at, near, far, rows):
    """(doc, starts, ends) of the runs of starts of repeats in whole cores' tuples."""
    same = np.zeros(len(core), bool)
    same[1:] = (core[1:] == core[:-1]) & (near[1:] == near[:-1]) & (far[1:] == far[:-1])
    same[1:][same[1:]] = (rows[1:][same[1:]] == rows[:-1][same[1:]]).all(axis=1)
    third = np.zeros(len(core), bool)
    third[2:] = same[2:] & same[1:-1]
    go = np.flatnonzero(~third)
    which, distance = induced(core[go], near[go], far[go], rows[go])
    order = np.lexsort((-distance, which))
    which, start = go[which[order]], at[go[which[order]]] - distance[order]
    new = np.ones(len(which), bool)
    new[1:] = (which[1:] != which[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(which)) - 1
    yield doc[third], (at - far)[third], (at - near + 1)[third]
    if len(first):
        yield doc[which[first]], start[first], start[last] + 1


def repeat_starts(sent: DataFrame, buckets: int, flush_rows: int) -> DataFrame:
    """(doc, starts, ends): runs of starts of strings that occur twice."""

    def run(batches):
        kept, held = [], 0

        def out(rest: bool):
            nonlocal kept, held
            rows = [np.concatenate(k) for k in zip(*kept, strict=True)]
            n = len(rows[0]) if rest else int(np.searchsorted(rows[0] == rows[0][-1], True))
            kept, held = ([], 0) if rest else ([[r[n:] for r in rows]], len(rows[0]) - n)
            if n:
                for part in found_in(*(r[:n] for r in rows)):
                    yield from home(*part, buckets=buckets)

        for batch in batches:
            blank = np.asarray(batch.column(0).is_null())
            doc, at, near, far = (batch.column(c).to_numpy() for c in range(1, 5))
            if blank.any():
                yield from home(doc[blank], (at - far)[blank], (at - near + 1)[blank], buckets)
            full = batch.filter(pa.array(~blank))
            if full.num_rows:
                core, doc, at, near, far = (full.column(c).to_numpy() for c in range(5))
                sides = [text_bytes(full.column(c))[0].reshape(full.num_rows, -1) for c in (5, 6)]
                kept.append([core, doc, at, near, far, np.concatenate(sides, axis=1)])
                held += full.num_rows
                if held >= flush_rows and kept[0][0][0] != core[-1]:
                    yield from out(False)
        if held:
            yield from out(True)
        give_back()

    dealt = sent.repartition(buckets, F.coalesce("core", "doc")).sortWithinPartitions("core", "right", "left")
    found = gathered(dealt.mapInArrow(run, HOME), buckets)
    return found.select("doc", F.col("at").alias("starts"), F.col("until").alias("ends"))


def remove_repeats(docs: DataFrame, hot_places: int = HOT_PLACES, flush_rows: int = FLUSH_ROWS) -> DataFrame:
    """``docs`` plus kept (binary: the text without its repeated bytes), n_bytes, n_removed, n_spans, kept_sha256.

    ``hot_places`` and ``flush_rows`` bound what a task holds and change no result.
    """
    n, key = bucket_count(docs), doc_key(docs)
    texts = docs.select(key.alias("key"), "text")
    shared = saved(met(send(texts, find_cores, "any", n), "any", n).drop("until"))
    some, _ = by_ids(texts, shared, F.col("key"))
    joined = some.join(shared, F.col("key") == F.col("doc")).select("key", "text", "at")
    starts = saved(repeat_starts(tuples(joined, hot_cores(texts, hot_places), flush_rows), n, flush_rows))
    rows = docs.select(packed_row(docs, RESULT), key.alias("key"))
    some, none = by_ids(rows, starts, F.col("key"))
    joined = some.join(starts, F.col("key") == F.col("doc"), "left")

    @F.arrow_udf("struct<kept: binary, n_removed: long, n_spans: long, kept_sha256: string>")
    def cut(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        data, offsets = text_bytes(texts)
        out = {"kept": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        for i in range(len(texts)):
            own = data[offsets[i] : offsets[i + 1]]
            spans = 0
            if starts[i].is_valid and len(starts[i]):
                change = np.zeros(len(own) + 1, np.int64)
                np.add.at(change, starts[i].values.to_numpy(), 1)
                np.add.at(change, ends[i].values.to_numpy() + LENGTH - 1, -1)
                gone = np.cumsum(change)[:-1] > 0
                spans = int(np.count_nonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1))
                own = own[~gone]
            kept = own.tobytes()
            for k, v in (("kept", kept), ("n_removed", int(offsets[i + 1] - offsets[i]) - len(kept)), ("n_spans", spans), ("kept_sha256", hashlib.sha256(kept).hexdigest())):
                out[k].append(v)
        return pa.StructArray.from_arrays([pa.array(out["kept"], pa.binary()), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()), pa.array(out["kept_sha256"], pa.string())], list(out))

    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes")
    changed = joined.withColumn("x", cut("row.text", "starts", "ends")).select("row.*", "x.kept", size, "x.n_removed", "x.n_spans", "x.kept_sha256")
    raw = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    zero = F.lit(0).cast("long")
    return changed.unionByName(none.select("row.*", raw.alias("kept"), size, zero.alias("n_removed"), zero.alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256")))
