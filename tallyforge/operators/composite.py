"""Composite score, ranking, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallyforge.functions.scalar import normal_cdf

def whole() -> WindowSpec:
    return Window.partitionBy()


def z_score(x: Column) -> Column:
    sd = F.stddev_pop(x).over(whole())
    return F.when(sd > 1e-12, (x - F.avg(x).over(whole())) / sd).otherwise(F.lit(0.0))


def composite(rows: DataFrame, alpha: float = 0.72) -> DataFrame:
    """``rows`` (lb, bt) plus score: 100 Phi of the mixed z-scores."""
    z = F.lit(alpha) * z_score(F.col("lb")) + F.lit(1 - alpha) * z_score(F.col("bt"))
    return rows.withColumn("_z", z).withColumn("score", normal_cdf(F.col("_z")) * 100).drop("_z")


def coverage(cells: DataFrame) -> DataFrame:
    """(deck, opp_used, opp_total, missing, coverage_pct, n_eff, missing_sample): five missing names at most, in axis order."""
    off = cells.where("a <> b")
    lacking = F.when(F.coalesce("n_dir", F.lit(0)) <= 0, F.struct(F.col("b_ord").alias("o"), F.col("b").alias("d")))
    rows = off.groupBy(F.col("a").alias("deck")).agg(
        F.count_if(F.col("n_dir") > 0).alias("opp_used"), F.count("*").alias("opp_total"), F.sum(F.coalesce("n_dir", F.lit(0))).cast("double").alias("n_eff"),
        F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(lacking)), 1, 5), lambda s: s["d"]), ", ").alias("missing_sample"),
    )
    return rows.withColumns({"missing": F.col("opp_total") - F.col("opp_used"), "coverage_pct": F.when(F.col("opp_total") > 0, F.lit(100.0) * F.col("opp_used") / F.col("opp_total")).otherwise(F.lit(0.0))})


def missing_pairs(cells: DataFrame) -> DataFrame:
    return cells.where("a <> b and coalesce(n_dir, 0) <= 0").select(F.col("a").alias("deck"), F.col("b").alias("missing_opponent"))


def ranked(scores: DataFrame, cover: DataFrame) -> DataFrame:
    """The ranking: by score, then lb, bt, n_eff, name."""
    rows = scores.join(cover, "deck")
    order = Window.orderBy(F.desc("score"), F.desc("lb"), F.desc("bt"), F.desc("n_eff"), "deck")
    return rows.select(F.row_number().over(order).alias("rank"), "deck", "score", "mas", "lb", "bt", "se", "n_eff", "opp_used", "opp_total", "coverage_pct")
