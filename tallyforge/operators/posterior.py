"""Beta-Binomial posteriors of cells and the weighted mean with its lower bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def posterior_cells(cells: DataFrame, k: float, mu: float = 0.5) -> DataFrame:
    """``cells`` plus p_hat and var_hat off the diagonal; a cell without matches has the prior's mean."""
    a = F.coalesce("w", F.lit(0)) + F.lit(mu * k)
    b = F.coalesce("l", F.lit(0)) + F.lit((1 - mu) * k)
    off = F.col("a") != F.col("b")
    return cells.withColumns({"p_hat": F.when(off, a / (a + b)), "var_hat": F.when(off, a * b / ((a + b) * (a + b) * (a + b + 1)))})


def report_posterior(cells: DataFrame, k: float, mu: float = 0.5) -> DataFrame:
    """``cells`` plus p_hat_pct and se_pct, from the rounded rate wr and n_dir as a report shows them."""
    a = F.col("wr") / 100 * F.col("n_dir") + F.lit(mu * k)
    b = (1 - F.col("wr") / 100) * F.col("n_dir") + F.lit((1 - mu) * k)
    p = a / (a + b)
    known = F.col("wr").isNotNull() & F.col("n_dir").isNotNull()
    return cells.withColumns({"p_hat_pct": F.when(known, p * 100), "se_pct": F.when(known, F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) * 100)})


def se_binomial(cells: DataFrame) -> DataFrame:
    """``cells`` plus se_binom_pct of the raw rate; NULL without matches."""
    p = F.col("wr") / 100
    return cells.withColumn("se_binom_pct", F.when(F.col("n_dir") > 0, F.sqrt(F.greatest(p * (1 - p) / F.col("n_dir"), F.lit(0.0))) * 100))


def mas_se_lb(post: DataFrame, weights: DataFrame, z: float = 1.2) -> DataFrame:
    """(deck, mas, se, lb) in percent: p_hat weighted over observed opponents, its error, mas - z * se.

    An entity whose observed opponents weigh nothing gets equal weights; one without any gets 0.
    """
    seen = post.where("a <> b and n_dir > 0").join(F.broadcast(weights.select(F.col("deck").alias("b"), "p")), "b", "left")
    mine = Window.partitionBy("a")
    total = F.sum(F.coalesce("p", F.lit(0.0))).over(mine)
    w = F.when(total > 0, F.coalesce("p", F.lit(0.0)) / total).otherwise(F.lit(1.0) / F.count(F.lit(1)).over(mine))
    sums = seen.withColumn("weight", w).groupBy("a").agg(F.sum(F.col("weight") * F.col("p_hat")).alias("m"), F.sqrt(F.sum(F.col("weight") * F.col("weight") * F.col("var_hat"))).alias("s"))
    rows = post.select(F.col("a").alias("deck")).distinct().join(sums.withColumnRenamed("a", "deck"), "deck", "left")
    m, s = F.coalesce("m", F.lit(0.0)) * 100, F.coalesce("s", F.lit(0.0)) * 100
    return rows.select("deck", m.alias("mas"), s.alias("se"), (m - F.lit(z) * s).alias("lb"))
