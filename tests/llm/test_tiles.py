"""Tiles without pairs of places: equal to those from seeds, and linear where one token is repeated."""

import random
import subprocess
import sys

import numpy as np
import pytest

from tallyforge.llm import decontamination


@pytest.mark.parametrize("kinds", [1, 2, 5])
def test_same_tiles_by_length(kinds):
    rng = random.Random(kinds)
    for _ in range(150):
        a, b = ([rng.randrange(kinds) for _ in range(rng.randint(0, 30))] for _ in range(2))
        if rng.random() < 0.5:
            b += a[: len(a) // 2]
        pairs = [(i, j) for i in range(len(a) - 2) for j in range(len(b) - 2) if a[i : i + 3] == b[j : j + 3]]
        want = decontamination.tiles(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]), 3) if pairs else []
        assert decontamination.tiles_by_length(np.array(a, np.uint64), np.array(b, np.uint64), 3) == want


def test_query_paths_agree(spark, monkeypatch):
    rng = random.Random(6)
    some = lambda n, of="a b c d e": " ".join(rng.choices(of.split(), k=n))
    items = [(i, some(rng.randint(8, 40))) for i in range(12)] + [(90, "word " * 60), (91, None), (92, "few words")]
    docs = [(i, f"{some(30)} {items[i][1] if i % 3 else ''} {some(10)}") for i in range(12)] + [(50, "word " * 500), (None, "word " * 45), (51, "")]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    rows = lambda bound: sorted(map(repr, decontamination.leaks(*frames, max_part_bytes=bound).collect()))
    usual = rows(1 << 20)
    monkeypatch.setattr(decontamination, "MANY_PAIRS", 0)
    assert rows(1 << 20) == usual == rows(200) and len(usual) > 8


def test_memory_of_a_repeated_token():
    """20,000 equal tokens against an item of 10,000, in a process of 700 MB with all libraries."""
    code = """
import numpy as np, resource
from tallyforge.llm import decontamination as d
items = d.index_items([1], ["word " * 10_000], 5)
h, first = d.token_hashes(*d.text_bytes(__import__("pyarrow").array(["word " * 20_000])))
assert d.tiles_by_length(items.hash, h, 5) == [(10_000, 0, 0)]
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert said.returncode == 0 and int(said.stdout.split()[-1]) < 500, said.stdout + said.stderr


def test_repeated_token_through_spark(spark):
    got = decontamination.leaks(spark.createDataFrame([(1, "word " * 20_000), (2, "word " * 3_000)], "doc_id long, text string"), spark.createDataFrame([(7, "word " * 10_000), (8, "word " * 3_000)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.covered) for r in got) == [(1, 7, 10_000), (1, 8, 3_000), (2, 8, 3_000)]
