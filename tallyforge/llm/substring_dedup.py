"""Repeated word passages across documents, by winnowed anchors.

Seeds of ``SEED`` words are winnowed: of the seeds inside each window of ``window`` words the one with the
least hash is its anchor, which depends on the window's words alone. Anchors are joined across
documents; only an anchor whose seed another document has too can belong to a repeated window. Each such
anchor is extended both ways to all windows that it stands for, and a window is repeated where
a smaller document has it. Repeated windows, joined where they overlap, are the maximal repeats.

The extension is not made word by word against a partner: windows of shared anchors are hashed (128 bits) and each place is
compared with the smallest document of its window. So a group of any size costs its own length, and places of one
common anchor with different surroundings, as at the edges of a passage that millions of documents
hold, are dealt over all tasks instead of meeting in one.

Defined cases: null text has no words and stays null; ties (rows of one doc_id) never remove each other, and
rows of one id share removals, so ids should be unique; a null id counts as larger than any other, and
rows with a null id are told apart by their text; ids are integers; texts of any length are whole; texts with
fewer words than a window lose nothing; an empty table gives an empty result; columns of any other name stay,
those of the result's names are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import SpanHash, argmin_windows, chunks, gram_hash, ranges, text_bytes, words
from tallyforge.llm.exchange import bucket_count, by_ids, met, send
from tallyforge.llm.shared import doc_key, packed_row, saved

SEED = 8
OTHER_BASE = 0xD1342543DE82EF95


def window_starts(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, word) of every window of ``length`` words that lies in one text."""
    return ranges(first[:-1], np.maximum(np.diff(first) - length + 1, 0))


def owners(h: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, anchor) of every window, and the seeds' hashes."""
    seeds = gram_hash(h, SEED) >> np.uint64(1)
    text, start = window_starts(first, window)
    return text, start, argmin_windows(seeds, window - SEED + 1)[start] if len(start) else start, seeds


def find_anchors(window: int):
    def find(data, offsets, more):
        start, end, first = words(data, offsets)
        h = SpanHash(data).of(start, end)
        text, _, anchor, seeds = owners(h, first, window)
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        anchor, text = anchor[new], text[new]
        return seeds[anchor], np.zeros(len(anchor), np.uint64), more[0].to_numpy()[text], anchor - first[text]

    return find


def find_windows(window: int):
    def find(data, offsets, more):
        start, end, first = words(data, offsets)
        h = SpanHash(data).of(start, end)
        text, begin, anchor, _ = owners(h, first, window)
        of, at = more[1].value_lengths().to_numpy(), more[1].flatten().to_numpy()
        shared = np.zeros(len(h) + 1, bool)
        shared[at + np.repeat(first[:-1], of)] = True
        keep = shared[anchor] if len(anchor) else np.zeros(0, bool)
        text, begin = text[keep], begin[keep]
        return gram_hash(h, window)[begin], gram_hash(h, window, OTHER_BASE)[begin], more[0].to_numpy()[text], begin - first[text]

    return find


def lost_windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc, at): the first words of windows of ``docs`` (key, text) that a smaller document has too."""
    n = bucket_count(docs)
    anchors = saved(met(send(docs, find_anchors(window), "docs", n), "docs", n).drop("until"))
    some, _ = by_ids(docs, anchors, F.col("key"))
    joined = some.join(anchors, F.col("key") == F.col("doc")).select("key", "text", "at")
    return saved(met(send(joined, find_windows(window), "later", n), "later", n).drop("until"))


def cut(text: bytes, starts: np.ndarray | None, window: int, min_words: int) -> tuple[int, list[bytes], list[tuple[int, int]]]:
    """(number of words, kept words, removed runs of at least ``min_words`` words)."""
    parts = text.split()
    if starts is None or not len(starts):
        return len(parts), parts, []
    gone = np.zeros(len(parts) + 1, np.int64)
    np.add.at(gone, starts, 1)
    np.add.at(gone, np.minimum(starts + window, len(parts)), -1)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(gone) > 0])))
    spans = [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b - a >= min_words]
    kept, last = [], 0
    for a, b in spans:
        kept += parts[last:a]
        last = b
    return len(parts), kept + parts[last:], spans


RESULT = ["text", "n_words", "n_removed", "kept_sha256", "spans"]


def remove_repeats(docs: DataFrame, window: int = 13, min_words: int = 13) -> DataFrame:
    """``docs`` with ``text`` (kept words, joined by one space, where something was removed; else as it
    was), n_words, n_removed, kept_sha256 and spans (removed runs). Maximal runs of fewer than ``min_words`` words stay.
    """
    if not SEED <= window:
        raise ValueError(f"a window has at least {SEED} words")
    key = doc_key(docs)
    lost = lost_windows(docs.select(key.alias("key"), "text"), window)
    rows = docs.select(packed_row(docs, RESULT), key.alias("key"), "text")
    some, none = by_ids(rows, lost, F.col("key"))
    joined = some.join(lost, F.col("key") == F.col("doc"), "left")
    out = "struct<text: string, n_words: long, n_removed: long, kept_sha256: string, spans: array<struct<start: long, stop: long>>>"
    kind = pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])

    def rows(texts: pa.Array, starts: pa.Array | None) -> pa.Array:
        found = []
        data, offsets = text_bytes(texts)
        raw = data.tobytes()
        valid = texts.is_valid().to_pylist()
        for i in range(len(texts)):
            whole = raw[offsets[i] : offsets[i + 1]]
            begin = starts[i].values.to_numpy() if starts is not None and starts[i].is_valid else None
            n, kept, spans = cut(whole, begin, window, min_words)
            line = b" ".join(kept)
            text = None if not valid[i] or not spans else line.decode()
            found.append({"text": text, "n_words": n, "n_removed": n - len(kept), "kept_sha256": hashlib.sha256(line).hexdigest(), "spans": [{"start": a, "stop": b} for a, b in spans]})
        return pa.array(found, kind)

    @F.arrow_udf(out)
    def with_starts(texts: pa.Array, starts: pa.Array) -> pa.Array:
        return rows(texts, starts)

    @F.arrow_udf(out)
    def without(texts: pa.Array) -> pa.Array:
        return rows(texts, None)

    def opened(df: DataFrame) -> DataFrame:
        return df.select("row.*", F.coalesce("x.text", "text").alias("text"), *(F.col(f"x.{c}").alias(c) for c in RESULT[1:]))

    return opened(joined.withColumn("x", with_starts("text", "at"))).unionByName(opened(none.withColumn("x", without("text"))))
