"""Partitions by the number of rows."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyforge.sources import matchups, state


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(state, "ROWS_A_TASK", 10)


def most_tasks(df) -> int:
    """The largest number of partitions that the plan shuffles into."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return max(int(part.rsplit(", ", 1)[1]) for part in plan.replace("),", ")").split("hashpartitioning(")[1:] for part in [part.split(")")[0]])


def test_shuffles_grow_with_the_rows(spark, few_rows):
    rng = random.Random(1)
    lines = spark.createDataFrame([(i // 4, rng.randrange(30), float(rng.randrange(9)), "F") for i in range(200)], "l_orderkey long, l_partkey long, l_quantity double, l_linestatus string").withColumn("l_shipdate", F.to_timestamp(F.lit("1995-01-01")))
    parts = spark.createDataFrame([(i, f"b{i % 5}") for i in range(30)], "p_partkey long, p_brand string")
    raw = matchups.raw_matchups(lines, parts)
    league = matchups.league_matchups(lines.select(F.col("l_orderkey").alias("event"), F.lit("x").alias("league"), F.col("l_partkey").cast("string").alias("deck"), F.col("l_quantity").alias("value")))
    assert [most_tasks(df) for df in (raw, league, matchups.usage_share(lines, parts))] == [20, 20, 20]
    rows = [(r.l_orderkey, f"b{r.l_partkey % 5}") for r in lines.collect()]
    want = sum(a != b for o, a in rows for p, b in rows if o == p)
    assert raw.agg(F.sum("n")).first()[0] == want > 0
    assert sum(r.share for r in matchups.usage_share(lines, parts).collect()) == pytest.approx(100)


def test_partitions_are_not_joined_below_the_rows(spark, few_rows):
    """Also where the session has more partitions than the rows need: adaptive execution would join them into one."""
    df = spark.range(200)
    with state.configured(spark, spark__sql__shuffle__partitions="200"):
        sizes = [r["count"] for r in state.dealt(df, 200, "id").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 200
        assert len(sizes) > 15
        assert max(sizes) <= 30
        assert state.dealt(df, 10, "id").rdd.getNumPartitions() == 1


@pytest.mark.parametrize("name", [
    "validate_recomputed",
    "validate_score",
    "validate_shape",
    "validate_verdict",
    "missing_filter_kept",
    "missing_pairs",
])
def test_finer_names_are_dealt_by_rows(spark, monkeypatch, name):
    """Every shuffle of the lines and parts under the query has at least as many partitions as the lines need, given and so not joined again."""
    from tallyforge.plans.queries import QUERIES

    monkeypatch.setattr(state, "ROWS_A_TASK", 100)
    steps = []  # the lines are read under what is saved
    monkeypatch.setattr(state, "saved", lambda df: steps.append(df) or df)
    d = "/root/testdata/sf0.001"
    with state.configured(spark, spark__sql__shuffle__partitions="200"):
        QUERIES[name](spark, d)
        plans = "".join(df._jdf.queryExecution().executedPlan().toString() for df in steps)
    found = re.findall(r"hashpartitioning\((l_orderkey|l_partkey|p_partkey)#\w+, (\d+)\), (\w+)", plans)
    assert {x[0] for x in found} == {"l_orderkey", "l_partkey", "p_partkey"}
    assert {x[2] for x in found} == {"REPARTITION_BY_NUM"}
    assert min(int(x[1]) for x in found) >= math.ceil(spark.read.parquet(f"{d}/lineitem.parquet").count() / 100)


def test_league_edges_are_sure_before_they_meet(spark):
    """Both directions of a pair are held against the rule of confidence below their join, and again above it."""
    from tallyforge.plans.queries import QUERIES

    plan = QUERIES["league_weights"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert plan[join:].count(">= 0.45454545454545453") >= 2
