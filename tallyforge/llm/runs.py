"""All runs (maximal periodic stretches) of a document's words, by Kolpakov and Kucherov's method.

1. A suffix automaton with first occurrences factorises the words (LZ, occurrences may overlap).
2. At each border between factors Main's algorithm finds the runs that cross or touch it: for every period,
   longest common extensions to both sides, by Z functions over a stretch bounded by the two factors.
3. A run strictly inside a factor is a copy of a run at the factor's earlier occurrence and is taken from there.

Work is linear in the words but for the look-up of words in the automaton. Before that, stretches that can
hold no run are set aside: with length >= 3 * period and length >= 3 * STEM, every STEM words of a run occur
again, one period on, inside it; so runs lie within stretches of consecutive repeated STEM-word windows.

Documents are independent: no shuffle, and memory is that of one document.

Defined cases: null or empty text has no words and no runs; words are compared as bytes, whole; equal rows
get equal results whatever their order; a null id is like any other here; texts of any length are taken whole.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.shared import fewer_rows

LEAST, TIMES = 24, 3
STEM = LEAST // TIMES
RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"

Run = tuple[int, int, int]


def automaton(w: Sequence[int]) -> tuple[list[dict[int, int]], array]:
    """(transitions, first): the suffix automaton of ``w``, and for each state the place where its strings first end."""
    step: list[dict[int, int]] = [{}]
    link, length, first = array("l", [-1]), array("l", [0]), array("l", [-1])
    last = 0
    for i, c in enumerate(w):
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        first.append(i)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                first.append(first[q])
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return step, first


def factors(w: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, end, earlier start): the LZ factors; -1 for a word's first occurrence."""
    step, first = automaton(w)
    out, i, n = [], 0, len(w)
    while i < n:
        state, j = 0, i
        while j < n:
            to = step[state][w[j]]
            if first[to] >= j:
                break
            state, j = to, j + 1
        if j == i:
            out.append((i, i + 1, -1))
            i += 1
        else:
            out.append((i, j, first[state] - (j - i) + 1))
            i = j
    return out


def z_function(s: Sequence[int]) -> list[int]:
    """For each place, how far the words from there agree with the beginning."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def crossing(w: Sequence[int], border: int, lower: int, upper: int, times: int, least: int) -> Iterator[Run]:
    """(start, end, period) of the runs that start at ``border`` or before and end (last word) from ``border - 1`` to ``upper - 1``.

    ``lower`` is the start of the factor before the border, ``upper`` the end of the one after it. A run with
    ``times`` periods that crosses the border has a period of at most (both factors' words) / (times - 1), and begins
    less than one period before ``lower``: else the former factor and a word more would have occurred before.
    """
    longest = (upper - lower) // (times - 1)
    begin = max(0, lower - longest - 1)
    left, right = list(w[begin:border]), list(w[border : upper + 1])
    m, r = len(left), len(right)
    if m + r < least:
        return
    back = left[::-1]
    # How far each side agrees with itself one period on, and with the words one period across the border.
    ahead, meet = z_function(right), z_function([*right, -1, *left, *right])
    behind, cross = z_function(back), z_function([*back, -1, *right[::-1], *back])
    for q in range(1, longest + 1):
        spans = []
        if q <= r:  # the period right of the border
            spans.append((border - (cross[m + 1 + r - q] if m else 0), border + q + (ahead[q] if q < r else 0)))
        if q <= m:  # the period left of it
            spans.append((border - q - (behind[q] if q < m else 0), border + (meet[r + 1 + m - q] if r else 0)))
        for start, end in spans:
            if end - start >= max(least, times * q) and border <= end <= upper and (start > begin or not begin):
                yield start, end, q


def runs(w: Sequence[int], times: int = TIMES, least: int = LEAST) -> list[Run]:
    """(start, end, smallest period) of every run with at least ``times`` periods and ``least`` words; ``end`` is exclusive."""
    if times < 2:
        raise ValueError("a run has two periods at least")
    known: dict[int, dict[int, int]] = {}  # start -> end -> period
    before = 0
    parts = factors(w)
    for i, (begin, end, earlier) in enumerate([*parts, (len(w), len(w), -1)]):
        for s, e, q in crossing(w, begin, before, end, times, least) if i else ():
            ends = known.setdefault(s, {})
            ends[e] = min(q, ends.get(e, q))
        if earlier >= 0 and end - begin >= least + 2:
            back = begin - earlier
            for s in range(begin + 1, end - least):
                for e, q in known.get(s - back, {}).items():
                    if e + back < end:
                        known.setdefault(s, {})[e + back] = q
        before = begin
    return sorted((s, e, q) for s, ends in known.items() for e, q in ends.items())


def stretches(ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches where every STEM words occur twice or more in ``ids``."""
    n = len(ids) - STEM + 1
    if n < LEAST - STEM + 1:
        return
    key = np.zeros(n, np.uint64)
    for j in range(STEM):
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[j : j + n].astype(np.uint64) + np.uint64(1)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(n + 2, np.int8)
    again[order[1:][same] + 1] = 1
    again[order[:-1][same] + 1] = 1
    edge = np.diff(again)
    for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
        if b - a >= LEAST - STEM + 1:
            yield int(a), int(b) + STEM - 1


def document_runs(words: list[bytes]) -> list[Run]:
    """The runs of a whole document, by start and period."""
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    return sorted((a + s, a + e, q) for a, b in stretches(ids) for s, e, q in runs(ids[a:b].tolist()))


def collapsed(words: list[bytes], found: list[Run]) -> bytes:
    """The words that no run contains after its first period, joined by spaces."""
    if found:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, e, q in found:
            drop[s + q] += 1
            drop[e] -= 1
        words = [x for x, d in zip(words, np.cumsum(drop[:-1]).tolist(), strict=True) if not d]
    return b" ".join(words)


def periodic(docs: DataFrame, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """``docs``: doc_id, text. Per document its runs by start and period, and the text with one period of each left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ends, rows, texts = [], [0], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = (text.as_py() or b"").split()  # bytes.split() parts at \x20 and \x09-\x0D
                words = edit(doc_id, words) if edit else words
                found = document_runs(words)
                n.append(len(words))
                rows += [{"start": s, "length": e - s, "period": q} for s, e, q in found]
                ends.append(len(rows))
                texts.append(collapsed(words, found))
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows, RUN)), pa.array(texts, pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    found = fewer_rows(docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as binary) as text")).mapInArrow(run, RESULT)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
