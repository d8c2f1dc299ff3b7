"""Rounds of joins for large leagues against the one-task versions."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.config import RankingConfig
from tallyforge.operators import leagues, matrix, missing_filter, strength


@pytest.fixture(scope="module")
def league(spark):
    """Two leagues of 40 and 12 entities, one of them with a hub that nearly all have met, and a league without edges."""
    rng = random.Random(3)
    axis, weights = [("none", "x", 1), ("none", "y", 2)], []
    for name, n, share in (("big", 40, 0.4), ("mid", 12, 0.7)):
        axis += [(name, f"e{i:02d}", i + 1) for i in range(n)]
        for i in range(n):
            for j in range(i + 1, n):
                if i == 0 or rng.random() < share:
                    p, m = rng.uniform(0.1, 0.9), rng.uniform(1, 60)
                    weights.append((name, f"e{i:02d}", f"e{j:02d}", m, p * m, (1 - p) * m))
    return spark.createDataFrame(axis, "league string, deck string, ord int"), spark.createDataFrame(weights, "league string, a string, b string, n_eff double, w_ij double, w_ji double")


def test_strengths_by_blocks_equal_one_task(spark, league):
    axis, weights = league
    cfg = RankingConfig(bt_tol=1e-3)
    one = {(r.league, r.deck): r for r in strength.bt_strength(weights, axis, cfg).collect()}
    for bound in (100, 50):
        spread = {(r.league, r.deck): r for r in leagues.strengths_by_blocks(weights, axis, cfg, bound).collect()}
        assert one.keys() == spread.keys() and all(spread[k].pi == pytest.approx(one[k].pi, rel=1e-9) and spread[k].iterations == one[k].iterations for k in one)
    assert len({r.iterations for r in one.values()}) == 3


def test_edges_stay_in_their_blocks(spark, league):
    axis, weights = league
    nodes = leagues.numbered(axis)
    edges = weights.join(nodes.select("league", F.col("deck").alias("a"), F.col("node").alias("x")), ["league", "a"]).join(nodes.select("league", F.col("deck").alias("b"), F.col("node").alias("y")), ["league", "b"]).select("x", "y", "n_eff")
    name = leagues.in_blocks(edges, 3)
    state = nodes.select("league", "deck", F.lit(1.0).alias("won"), "node", F.lit(1.0).alias("pi"))
    with leagues.configured(spark, spark__sql__requireAllClusterKeysForCoPartition="false", spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = leagues.one_round(spark.table(name), state, 3, RankingConfig())._jdf.queryExecution().executedPlan().toString()
    scan = plan[: plan.index(name)].splitlines()[-6:]
    assert not any("Exchange" in line for line in scan) and spark.table(name).select("block").distinct().count() == 6
    spark.sql(f"DROP TABLE {name}")


def test_large_and_small_leagues_together(spark, league):
    axis, weights = league
    cfg = RankingConfig(bt_tol=1e-2)
    assert leagues.large(weights, 100) == ["big"]
    rows = {(r.league, r.deck): r.pi for r in leagues.strengths(weights, axis, cfg, 100).collect()}
    assert rows == {(r.league, r.deck): pytest.approx(r.pi, rel=1e-9) for r in strength.bt_strength(weights, axis, cfg).collect()}


def plain_peel(names, known, allowed):
    alive, rounds, step = list(names), {}, 0
    while len(alive) > 2:
        lacking = {a: sum(b != a and (a, b) not in known for b in alive) - allowed for a in alive}
        most = max(lacking.values())
        if most <= 0:
            break
        step += 1
        for a in [a for a in alive if lacking[a] == most]:
            rounds[a] = step
        alive = [a for a in alive if a not in rounds]
    return rounds


@pytest.mark.parametrize("bound", [10**6, 60, 0])
def test_peeling(spark, bound):
    rng = random.Random(bound)
    axis, known, want = [("empty", "solo")], [], {("empty", "solo"): None}
    for name, n, share in (("one", 25, 0.8), ("two", 9, 0.5), ("three", 14, 0.97), ("none", 4, 0.0)):
        names = [f"e{i:02d}" for i in range(n)]
        cells = {(a, b) for a in names for b in names if a != b and rng.random() < share}
        axis += [(name, x) for x in names]
        known += [(name, a, b) for a, b in cells] + [(name, names[0], "not on the axis"), (name, names[1], names[1])]
        rounds = plain_peel(names, cells, max(1, int((n - 1) * 0.1)))
        want |= {(name, x): rounds.get(x) for x in names}
    got = leagues.kept_entities(spark.createDataFrame(known, "league string, a string, b string"), spark.createDataFrame(axis, "league string, deck string"), 0.1, block_edges=bound)
    assert {(r.league, r.deck): r.dropped_round for r in got.collect()} == want


def test_peeling_equals_the_grid_version(spark):
    rng = random.Random(2)
    names = [f"e{i}" for i in range(15)]
    flat = [(a, b, 1, 1, 0) for a in names for b in names if a < b and rng.random() < 0.8]
    both = spark.createDataFrame(flat + [(b, a, 1, 1, 0) for a, b, *_ in flat], "a string, b string, w long, l long, t long")
    axis = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "deck string, ord int")
    grid = {r.deck: r.dropped_round for r in missing_filter.kept_entities(matrix.matrices(both, axis)).collect()}
    one = both.withColumn("league", F.lit("all"))
    assert grid == {r.deck: r.dropped_round for r in leagues.kept_entities(one, axis.withColumn("league", F.lit("all"))).collect()} and any(grid.values())


def test_peeling_in_passes_takes_few_jobs(spark):
    """A league of many rounds: the tasks settle several rounds a pass, with the same rounds as in one task."""
    rng = random.Random(8)
    names = [f"e{i:03d}" for i in range(120)]
    known = [("one", x, y) for i, a in enumerate(names) for b in names[i + 1:] if rng.random() < 0.3 for x, y in ((a, b), (b, a))]
    cells, axis = spark.createDataFrame(known, "league string, a string, b string"), spark.createDataFrame([("one", x) for x in names], "league string, deck string")
    want = {r.deck: r.dropped_round for r in leagues.kept_entities(cells, axis, 0.05).collect()}
    passes, plain = [], leagues.peeled_in_tasks
    leagues.peeled_in_tasks = lambda *args: passes.append(1) or plain(*args)
    try:
        got = {r.deck: r.dropped_round for r in leagues.kept_entities(cells, axis, 0.05, block_edges=1000).collect()}
    finally:
        leagues.peeled_in_tasks = plain
    last = max(r or 0 for r in want.values())
    assert got == want and last > 40 and 2 <= len(passes) <= last / 3


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Two regions; suppliers with large keys and without one, equal and missing quantities, repeated and lone lines."""
    d, rng = str(tmp_path_factory.mktemp("odd")), random.Random(11)
    keys = [2**40 + i for i in range(9)] + [3, -4, None]
    lines = [(o, rng.choice(keys), rng.choice([1.0, 2.0, 2.0, None])) for o in range(60) for _ in range(rng.randrange(1, 6))]
    lines += [(60, 3, float(q)) for q in range(40)] + [(61, 7, 5.0), (61, 8, 5.0), (62, 9, 1.0), (62, 9, 2.0), (900, 3, 1.0), (900, 9, 2.0)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_suppkey long, l_quantity double"),
        "orders": ([(o, o % 4) for o in range(63)], "o_orderkey long, o_custkey long"),
        "customer": ([(c, c % 2) for c in range(4)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "region": ([(0, "EAST"), (1, "WEST")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    return d, lines


def test_league_filter_on_odd_lines(spark, odd_tables):
    from tallyforge.plans.queries import QUERIES

    d, lines = odd_tables
    want = {}
    for region, name in enumerate(("EAST", "WEST")):
        here = [x for x in lines if x[0] < 63 and x[0] % 2 == region and x[1] is not None]
        met = [(x, y) for x in here for y in here if x[0] == y[0] and x[1] != y[1]]
        known = {(x[1], y[1]) for x, y in met if None not in (x[2], y[2]) and x[2] != y[2]}
        axis = sorted({x[1] for x, _ in met})
        rounds = plain_peel(axis, known, max(1, int((len(axis) - 1) * 0.05)))
        want |= {(name, f"S{k:06d}"): rounds.get(k) for k in axis}
    got = {(r.league, r.deck): r.dropped_round for r in QUERIES["league_filter"](spark, d).collect()}
    assert got == want and any(got.values())


def test_league_filter_makes_no_row_for_a_pair(spark, odd_tables, monkeypatch):
    """The lines are read once and not joined with themselves: what is saved is a list for each entity."""
    from tallyforge.plans.queries import QUERIES
    from tallyforge.sources import state

    steps, plain = [], state.saved
    keep = lambda df: steps.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df)
    monkeypatch.setattr(state, "saved", keep)
    monkeypatch.setattr(leagues, "saved", keep)
    QUERIES["league_filter"](spark, odd_tables[0])
    assert sum(plan.count("FileScan parquet [l_orderkey") for plan in steps) == 1


def test_columns_of_frequent_entities_in_slices(spark):
    from tallyforge.sources import matchups

    rng = random.Random(5)
    rows = [(e, "x", rng.choice([1, 1, 1, *range(2, 30)]), float(rng.randrange(3))) for e in range(150) for _ in range(4)]
    df = spark.createDataFrame(rows, "event long, league string, node int, value double")
    lists = lambda often: {r.node: sorted(r.rows) for r in matchups.league_columns(df, len(rows), often).collect()}
    want = {}
    for e, _, a, va in rows:
        for f, _, b, vb in rows:
            if e == f and a != b:
                want.setdefault(a, set()).update([b] if va != vb else [])
    assert lists(None) == lists({1: 3}) == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("few", [10**6, 0])
def test_passes_join_columns_in_either_way(spark, monkeypatch, few):
    """Passes over lists of numbers give the rounds of one task, whether the entities asked for are sent to all tasks or not."""
    rng = random.Random(21)
    met = {i: [] for i in range(70)}
    for i in range(70):
        for j in range(i + 1, 70):
            if rng.random() < 0.4:
                met[i].append(j)
                met[j].append(i)
    columns = spark.createDataFrame([("one", i, len(js), js) for i, js in met.items()], "league string, node int, known long, rows array<int>")
    want = {r.node: r.dropped_round for r in leagues.kept_of_columns(columns, 0.05).collect()}
    monkeypatch.setattr(leagues, "SENT", few)
    assert want == plain_peel_of(met) == {r.node: r.dropped_round for r in leagues.kept_of_columns(columns, 0.05, block_edges=600).collect()}


def plain_peel_of(met):
    rounds = plain_peel(list(met), {(i, j) for i, js in met.items() for j in js}, max(1, int((len(met) - 1) * 0.05)))
    return {i: rounds.get(i) for i in met}
