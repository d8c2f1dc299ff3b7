"""Counts read without failing casts."""

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import scalar
from tallyforge.operators import consolidate


def test_counts_of_odd_texts(spark):
    texts = [" 7 ", "12", "12.0", "1e3", "-4", "-4.5", "+3", "\t5\n", "x1", "", None, "1.", ".0", "99999x", "0x10", "1e", "nan", "-inf", "١٢"]
    want = [7, 12, 12, 1000, 0, 0, 3, 5, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    assert [r.n for r in rows.select("i", scalar.count_of(F.col("x")).alias("n")).orderBy("i").collect()] == want
    for wrong in ("1.5", "99999999999999999999", "inf"):
        with pytest.raises(Exception, match="not a whole count"):
            spark.createDataFrame([(wrong,)], "x string").select(scalar.count_of(F.col("x"))).collect()


def test_counts_of_numbers_need_no_text(spark):
    rows = spark.createDataFrame([("a", "b", 3.0, 7, -2.5), ("a", "b", float("nan"), None, None), ("a", "b", -0.0, -1, float("-inf"))], "a string, b string, w double, l long, t double")
    out = consolidate.with_counts(rows)
    assert [(r.w, r.l, r.t, r.n) for r in out.collect()] == [(3, 7, 0, 10), (0, 0, 0, 0), (0, 0, 0, 0)]
    assert "RLIKE" not in out._jdf.queryExecution().optimizedPlan().toString()
    for wrong in (1.5, float("inf"), 2.0**63):
        with pytest.raises(Exception, match="not a whole count"):
            consolidate.with_counts(spark.createDataFrame([("a", "b", wrong, 0.0, 0.0)], "a string, b string, w double, l double, t double")).collect()
