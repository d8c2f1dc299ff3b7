"""Periodic runs against a plain search, on random words and through the query."""

import hashlib
import random
import zlib

from tallyforge.llm import runs
from tallyforge.llm.queries import op12_periodic_runs, repeated_tail


def plain(w, times=3, least=24):
    """(start, end, smallest period) of all runs: for each period, the longest stretches of words equal to the one a period on."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                out.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e, q) for (s, e), q in out.items())


def words(rng, n, kinds):
    w = [rng.randrange(kinds) for _ in range(n)]
    if n > 6 and rng.random() < 0.5:  # a periodic tail, perhaps with a copy of the beginning after it
        a = rng.randrange(n)
        p = rng.randint(1, max(1, (n - a) // 2))
        w = [*w[:a], *(w[a + (i - a) % p] for i in range(a, n))] + w[: rng.choice([0, n // 2])]
    return w


def test_runs_against_a_plain_search():
    rng = random.Random(5)
    for _ in range(4_000):
        w = words(rng, rng.randint(0, 60), rng.choice([1, 2, 2, 3, 4]))
        times, least = rng.choice([2, 3]), rng.choice([2, 4, 6])
        assert runs.runs(w, times, least) == plain(w, times, least)


def test_whole_documents_and_stretches():
    rng = random.Random(6)
    for _ in range(300):
        w = [*words(rng, rng.randint(0, 150), rng.choice([2, 9, 60])), *words(rng, rng.randint(0, 90), 3)]
        assert runs.document_runs([b"%d" % x for x in w]) == plain(w)


def test_factors_are_the_longest_that_occurred_before():
    rng = random.Random(7)
    for _ in range(200):
        w = words(rng, rng.randint(1, 40), 3)
        at = 0
        for start, end, earlier in runs.factors(w):
            occurred = lambda j, i=start: any(w[p : p + j - i] == w[i:j] for p in range(i))
            assert start == at and (earlier < 0 and not occurred(start + 1) or w[earlier : earlier + end - start] == w[start:end] and earlier < start)
            assert end == len(w) or earlier < 0 or not occurred(end + 1)
            at = end
        assert at == len(w)


def test_long_document():
    rng = random.Random(8)
    part = [b"%d" % rng.randrange(3_000) for _ in range(6_000)]
    assert runs.document_runs([b"once", *part * 5, b"more"]) == [(1, 30_001, 6_000)]
    assert runs.document_runs([b"same"] * 50_000) == [(0, 50_000, 1)]


def expected(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = plain(w)
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in sorted(found, key=lambda r: (r[0], r[2])))
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    row = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *row, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_a_plain_search(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{x}" for x in words(rng, rng.randint(0, 120), rng.choice([2, 5, 40])))) for i in range(200)]
    rows += [(None, None), (None, "a b " * 30), (7, ""), (7, ""), (8, "é ü\tx\n" * 40), (9, " \n "), (10, "one\x0btwo\x1cthree " * 25), (-3, "tie tie " * 20 + "other words " * 20)]
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, start int").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(repr(expected(*r)) for r in rows)
    assert any(repeated_tail(i, (t or "").encode().split()) != (t or "").encode().split() for i, t in rows) and sum(r[1] > 0 for r in got) > 30


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op12_periodic_runs(spark, str(tmp_path)).collect() == []
