"""Benchmark passages in documents, by greedy string tiling.

Tokens are runs of letters, digits and non-ASCII bytes, A-Z lower-cased. Documents and benchmark items are joined
on shared seeds of ``min_match`` tokens (Karp-Rabin hashes). Seeds on one diagonal grow to maximal matches;
the longest match is marked as a tile again and again, matches that overlap a tile being cut to what
is left, until none of ``min_match`` tokens remains. An item is in a document if its tiles cover
at least ``threshold`` of its tokens, in whatever order they come.

Where a document and the benchmark share a seed so often that their places would multiply (one word repeated), only
distinct seeds are met, and the longest matches are searched by Karp-Rabin hashes of falling length instead: the same
tiles, in memory linear in the document and the item.

A part of the benchmark of at most ``max_part_bytes`` is sent to all tasks, and a larger benchmark
takes one pass over the documents for each part; documents are never shuffled.

Defined cases: ids are integers; a null doc_id stays null, items with a null item_id are left out; texts of any length
are whole; other columns are not returned; null texts have no tokens; items with fewer than ``min_match`` tokens are too
short to tell from ordinary language and never match; repeated rows give repeated results; equal
matches: the first in the item, then in the document, is marked first; empty tables give none.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import BASE, BASE_INVERSE, LOWER, SpanHash, chunks, gram_hash, powers, ranges, text_bytes, words
from tallyforge.llm.shared import fewer_rows, saved

MAX_PART_BYTES = 16 << 20
#: A document whose seeds meet more places of items than this is tiled by lengths.
MANY_PAIRS = 50_000
APART = np.ones(256, bool)
APART[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


@dataclass
class Items:
    """Benchmark items: their seeds in ascending order with item number and place."""

    ids: np.ndarray
    tokens: np.ndarray
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray
    known: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = words(data, offsets, APART)
    return SpanHash(LOWER[data]).of(start, end), first


def index_items(ids: list[int], texts: list[str | None], min_match: int) -> Items:
    h, first = token_hashes(*text_bytes(pa.array(texts, pa.large_string())))
    n = np.diff(first)
    count = np.maximum(n - min_match + 1, 0)
    item = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    seed = gram_hash(h, min_match)[first[item] + place]
    order = np.argsort(seed, kind="stable")
    known = np.zeros(1 << 20, bool)
    known[(seed >> np.uint64(44)).astype(np.int64)] = True
    return Items(np.array(ids, np.int64), n, seed[order], item[order], place[order], known, h, first)


def tiles(item_at: np.ndarray, doc_at: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, place in item, place in document) from the seeds that both share."""
    order = np.lexsort((item_at, doc_at - item_at))
    item_at, doc_at = item_at[order], doc_at[order]
    cut = np.flatnonzero((np.diff(doc_at - item_at) != 0) | (np.diff(item_at) != 1)) + 1
    begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(order)]])
    heap = [(-(int(e - b) + min_match - 1), int(item_at[b]), int(doc_at[b])) for b, e in zip(begin, end, strict=True)]
    heapq.heapify(heap)
    in_item, in_doc, out = set(), set(), []
    while heap:
        length, i, j = heapq.heappop(heap)
        length = -length
        free = [k for k in range(length) if i + k not in in_item and j + k not in in_doc]
        if len(free) == length:
            in_item.update(range(i, i + length))
            in_doc.update(range(j, j + length))
            out.append((length, i, j))
            continue
        run = 0
        for k in range(1, len(free) + 1):
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - run >= min_match:
                    heapq.heappush(heap, (run - k, i + free[run], j + free[run]))
                run = k
    return out


class Side:
    """The tokens of a document or an item, with what is marked so far."""

    def __init__(self, h: np.ndarray):
        self.h, self.marked = h, np.zeros(len(h), bool)
        self.inverse = powers(len(h), BASE_INVERSE)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(len(h), BASE)[: len(h)], dtype=np.uint64)])

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the stretches of ``length`` tokens without a mark."""
        taken = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.marked)])
        at = np.flatnonzero(taken[length:] == taken[: len(taken) - length])
        return at, (self.total[at + length] - self.total[at]) * self.inverse[at]

    def mark(self, at: int, length: int) -> None:
        self.marked[at : at + length] = True


def first_match(item: Side, doc: Side, length: int) -> tuple[int, int] | None:
    """The first unmarked match of ``length`` tokens, by place in the item, then in the document."""
    (i, x), (j, y) = item.windows(length), doc.windows(length)
    for k in np.flatnonzero(np.isin(x, y)).tolist():
        for d in j[y == x[k]].tolist():
            if np.array_equal(item.h[i[k] : i[k] + length], doc.h[d : d + length]):
                return int(i[k]), int(d)
    return None


def tiles_by_length(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """``tiles`` of token hashes, without their pairs of places: the longest length that still matches is found by halving."""
    a, b, out = Side(item), Side(doc), []
    most = min(len(item), len(doc))
    while most >= min_match:
        low = min_match - 1
        while low < most:
            middle = (low + most + 1) // 2
            low, most = (middle, most) if first_match(a, b, middle) else (low, middle - 1)
        if low < min_match:
            break
        while found := first_match(a, b, low):
            a.mark(found[0], low)
            b.mark(found[1], low)
            out.append((low, *found))
        most = low - 1
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.6, max_part_bytes: int = MAX_PART_BYTES) -> DataFrame:
    """(doc_id, item_id, item_tokens, covered, coverage, tiles) of items found in documents.

    ``docs``: doc_id, text; ``benchmark``: item_id, text.
    """
    benchmark = benchmark.where("item_id is not null")
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(size / max_part_bytes))
    schema = "doc_id long, item_id long, item_tokens long, covered long, coverage double, tiles array<struct<length: int, item_at: int, doc_at: int>>"
    kind = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("item_tokens", pa.int64()), ("covered", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.list_(pa.struct([("length", pa.int32()), ("item_at", pa.int32()), ("doc_at", pa.int32())])))])
    found = None
    for part in range(parts):
        mine = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).select("item_id", "text").toPandas()
        held = docs.sparkSession.sparkContext.broadcast(index_items(mine["item_id"].tolist(), mine["text"].tolist(), min_match))

        def run(batches, held=held):
            items = held.value

            def leak(doc_id: int | None, item: int, cover: list[tuple[int, int, int]]) -> list[dict]:
                n, covered = int(items.tokens[item]), sum(c[0] for c in cover)
                if covered < threshold * n:
                    return []
                return [{"doc_id": doc_id, "item_id": int(items.ids[item]), "item_tokens": n, "covered": covered, "coverage": covered / n, "tiles": [dict(zip(("length", "item_at", "doc_at"), c, strict=True)) for c in cover]}]

            for batch in batches:
                ids, rows = batch.column(0), []
                for i, j, data, offsets in chunks(*text_bytes(batch.column(1))):
                    h, first = token_hashes(data, offsets)
                    seed = gram_hash(h, min_match)
                    maybe = np.flatnonzero(items.known[(seed >> np.uint64(44)).astype(np.int64)])
                    low, high = np.searchsorted(items.seed, seed[maybe]), np.searchsorted(items.seed, seed[maybe], side="right")
                    text = np.searchsorted(first, maybe, side="right") - 1
                    whole = maybe + min_match <= first[text + 1]
                    maybe, low, count, text = maybe[whole], low[whole], (high - low)[whole], text[whole]
                    many = np.bincount(text, count, j - i) > MANY_PAIRS
                    for t in np.flatnonzero(many).tolist():
                        own = np.unique(seed[maybe[text == t]])
                        from_, to = np.searchsorted(items.seed, own), np.searchsorted(items.seed, own, side="right")
                        _, hit = ranges(from_, to - from_)
                        places = np.bincount(items.item[hit], minlength=len(items.ids))
                        for item in np.flatnonzero((places > 0) & (np.minimum(items.tokens, places * min_match) >= threshold * items.tokens)).tolist():
                            found_tiles = tiles_by_length(items.hash[items.first[item] : items.first[item + 1]], h[first[t] : first[t + 1]], min_match)
                            rows += leak(ids[i + t].as_py(), item, found_tiles)
                    few = ~many[text]
                    maybe, low, count, text = maybe[few], low[few], count[few], text[few]
                    row, hit = ranges(low, count)
                    pair = text[row] * np.int64(len(items.ids) + 1) + items.item[hit]
                    order = np.argsort(pair, kind="stable")
                    pair, begin = np.unique(pair[order], return_index=True)
                    for k, at in zip(pair.tolist(), np.split(order, begin[1:]), strict=True) if len(pair) else ():
                        t, item = divmod(k, len(items.ids) + 1)
                        n = int(items.tokens[item])
                        # The seeds' own reach bounds what tiles can cover.
                        if min(n, len(np.unique(items.place[hit[at]])) * min_match) < threshold * n:
                            continue
                        rows += leak(ids[i + t].as_py(), item, tiles(items.place[hit[at]], maybe[row[at]] - first[t], min_match))
                yield pa.RecordBatch.from_pylist(rows, kind)

        more = fewer_rows(docs).select("doc_id", "text").mapInArrow(run, schema)
        if parts > 1:  # one part is held at a time
            more = saved(more)
            held.destroy()
        found = more if found is None else found.unionByName(more)
    return found
