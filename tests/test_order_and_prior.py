"""Ranks and sums over ranges, draws made in tasks, and every way the prior strength is decided."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.config import RankingConfig
from tallyforge.operators import matrix, order, prior


@pytest.mark.parametrize("parts", [1, 3, 9])
def test_running_sums(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.randrange(5), None if rng.random() < 0.1 else rng.randrange(100)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, g int, v long")
    out = order.running(df, [F.desc("g"), F.col("id")], "v", parts).orderBy("place").collect()
    total = 0
    for place, (r, (i, g, v)) in enumerate(zip(out, sorted(rows, key=lambda r: (-r[1], r[0])), strict=True), 1):
        assert (r.place, r.id, r.g, r.v, r.before, r.through) == (place, i, g, v, total, total + (v or 0))
        total += v or 0


def test_running_over_one_key_and_nothing(spark):
    same = spark.createDataFrame([(1, 2.5)] * 7, "k int, v double")
    assert sorted((r.place, r.through) for r in order.running(same, [F.col("k")], "v", 4).collect()) == [(i, 2.5 * i) for i in range(1, 8)]
    assert order.running(same.where("k = 2"), [F.col("k")], "v").collect() == []
    exact = spark.createDataFrame([(i,) for i in range(50)], "v int").select(F.col("v").cast("decimal(18,2)").alias("v"))
    assert order.running(exact, [F.col("v")], "v", 3).agg(F.max("through")).first()[0] == 1225


def test_top_share_takes_no_single_partition(spark):
    shares = spark.createDataFrame([(f"d{i}", 100 * 2.0 ** -(i + 1)) for i in range(12)], "deck string, share double")
    found = order.top_share(shares, 90, 3)
    assert {(r.deck, r.share_cum) for r in found.collect()} == {(r.deck, r.share_cum) for r in matrix.top_meta(shares, 90).collect()}
    assert "SinglePartition" not in found._jdf.queryExecution().executedPlan().toString()


def test_draws(spark):
    want = Counter()
    for r in range(3):
        for d in range(40):
            u = int(hashlib.md5(f"7/{r}/{d}".encode()).hexdigest()[:13], 16)
            want[r, math.floor(u * 40 / 16**13)] += 1
    assert {(x.replicate, x.cell): x.times for x in prior.draws(spark, 3, 40, 7).collect()} == want
    spread = prior.draws(spark, 20, 50, 42).groupBy("cell").agg(F.sum("times").alias("n")).collect()
    assert len(spread) == 50 and max(r.n for r in spread) < 45 and sum(r.n for r in spread) == 1000


def test_bootstrap_against_a_plain_one(spark):
    rng = random.Random(5)
    flat = [(x, y, rng.randint(0, 30), rng.randint(0, 30), 0) for x in "ABCDE" for y in "ABCDE" if x != y]
    axis = spark.createDataFrame([(d, i) for i, d in enumerate("ABCDE", 1)], "deck string, ord int")
    cells = matrix.matrices(spark.createDataFrame(flat, "a string, b string, w long, l long, t long"), axis)
    cfg, ks = RankingConfig(boot_n=12), [2.0, 8.0, 30.0]
    used = sorted((r for r in prior.splits(cells, cfg.rho_test).collect() if r.w_test + r.l_test > 0), key=lambda r: (r.a_ord, r.b_ord))
    beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    gain = [[beta(k / 2 + r.w_train + r.w_test, k / 2 + r.l_train + r.l_test) - beta(k / 2 + r.w_train, k / 2 + r.l_train) for k in ks] for r in used]
    want = {}
    for rep in range(12):
        drawn = [math.floor(int(hashlib.md5(f"42/{rep}/{d}".encode()).hexdigest()[:13], 16) * len(used) / 16**13) for d in range(len(used))]
        want[rep] = ks[int(np.argmax(np.sum([gain[c] for c in drawn], axis=0)))]
    assert {r.replicate: r.k for r in prior.bootstrap(cells, ks, cfg).collect()} == want


@pytest.mark.parametrize(
    ("star", "boot", "want"),
    [
        (4.0, [4.0] * 10, (4.0, "best")),
        (1.0, [1.0] * 9 + [1.01], (1.0, "best-boundary-override")),
        (16.0, [16.0] * 10, (12.0, "best-boundary-override")),
        (1.0, [1.0] * 5 + [8.0] * 5, (4.5, "boot-clipped")),
        (4.0, [2.0] * 3 + [4.0] * 4 + [8.0] * 3, (4.0, "boot-clipped")),
        (4.0, [3.9] * 6 + [4.0] * 4, (3.9, "boot-clipped")),
        (4.0, [0.2] * 10, (1.0, "boot-clipped")),
        (4.0, [40.0] * 10, (12.0, "boot-clipped")),
    ],
)
def test_decision(star, boot, want):
    got = prior.decision(star, np.array(boot), [1.0, 2.0, 4.0, 8.0, 16.0], 3.0, 0.1, 50.0)
    assert got == (pytest.approx(want[0]), want[1])


def test_pick_and_expansions(spark):
    assert prior.pick({1.0: -100.05, 2.0: -100.0, 4.0: -99.99}, 1e-3) == 1.0 and prior.pick({1.0: -100.2, 2.0: -100.0}, 1e-3) == 2.0
    # Cells far from one half call for a small K: the grid grows downwards, twice at most.
    flat = [(x, y, 40 if x < y else 0, 0 if x < y else 40, 0) for x in "ABCD" for y in "ABCD" if x != y]
    axis = spark.createDataFrame([(d, i) for i, d in enumerate("ABCD", 1)], "deck string, ord int")
    k = prior.choose_k(matrix.matrices(spark.createDataFrame(flat, "a string, b string, w long, l long, t long"), axis), RankingConfig(boot_n=8))
    assert k["expansions"] == 2 and k["k_star"] == k["k_grid"][0] == pytest.approx(2.5) and k["delta_ll_100"] > 0 and k["reason"] == "best-boundary-override"
