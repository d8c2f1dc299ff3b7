"""Usage weights: encounters, declared shares, their blend, and a row's weights over its opponents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

def whole() -> WindowSpec:
    return Window.partitionBy()


def normalized(x: Column, floor: float | None = None) -> Column:
    """Values that sum to 1 over the whole frame; NULL is 0, and a sum of 0 gives equal weights."""
    v = F.coalesce(x, F.lit(0.0))
    v = F.greatest(v, F.lit(floor)) if floor is not None else v
    total = F.sum(v).over(whole())
    return F.when(total > 0, v / total).otherwise(F.lit(1.0) / F.count(F.lit(1)).over(whole()))


def encounter_share(cells: DataFrame) -> DataFrame:
    """(deck, p_enc): how often each entity is met."""
    met = cells.groupBy(F.col("b").alias("deck")).agg(F.sum(F.coalesce("n_dir", F.lit(0))).cast("double").alias("met"))
    return met.select("deck", normalized(F.col("met")).alias("p_enc"))


def meta_share(axis: DataFrame, declared: DataFrame | None, encounters: DataFrame, policy: str = "encounter") -> DataFrame:
    """(deck, p_meta): declared shares (deck, share) on the axis; what lies off it is given out by ``policy``
    (uniform, encounter, or else in proportion to the declared shares)."""
    uniform = F.lit(1.0) / F.count(F.lit(1)).over(whole())
    if declared is None:
        return axis.select("deck", uniform.alias("p_meta"))
    peak = declared.agg(F.max("share").alias("peak"))
    shares = declared.crossJoin(F.broadcast(peak)).select("deck", F.coalesce(F.when(F.col("peak") > 1 + 1e-9, F.col("share") / 100).otherwise(F.col("share")), F.lit(0.0)).alias("s"))
    on_axis = axis.select("deck").join(shares.groupBy("deck").agg(F.sum("s").alias("s")), "deck", "left").join(encounters, "deck", "left")
    rows = on_axis.withColumn("s", F.coalesce("s", F.lit(0.0))).withColumn("mass", F.sum("s").over(whole())).withColumn("even", uniform)
    gap = F.greatest(F.lit(0.0), 1 - F.col("mass"))
    to = {"uniform": F.col("even"), "encounter": F.coalesce("p_enc", F.lit(0.0))}.get(policy, F.when(F.col("mass") > 0, F.col("s") / F.col("mass")).otherwise(F.col("even")))
    rows = rows.withColumn("filled", F.col("s") + gap * to)
    return rows.select("deck", F.when(F.col("mass") > 0, F.col("filled") / F.sum("filled").over(whole())).otherwise(F.col("even")).alias("p_meta"))


def blend(meta: DataFrame, encounters: DataFrame, cfg) -> DataFrame:
    """(deck, p_meta, p_enc, tv, corr, gamma, p): declared and met shares mixed by gamma.

    tv is half the sum of differences; with ``auto_gamma`` it sets gamma.
    """
    rows = meta.join(encounters, "deck").withColumn("tv", F.lit(0.5) * F.sum(F.abs(F.col("p_meta") - F.col("p_enc"))).over(whole()))
    spread = F.least(F.stddev_pop("p_meta").over(whole()), F.stddev_pop("p_enc").over(whole()))
    covariance = F.avg(F.col("p_meta") * F.col("p_enc")).over(whole()) - F.avg("p_meta").over(whole()) * F.avg("p_enc").over(whole())
    rows = rows.withColumn("corr", F.when((spread > 1e-12) & (F.count(F.lit(1)).over(whole()) > 1), covariance / (F.stddev_pop("p_meta").over(whole()) * F.stddev_pop("p_enc").over(whole()))))
    if cfg.auto_gamma:
        gamma = F.least(F.greatest(cfg.gamma_base + cfg.gamma_slope * F.col("tv"), F.lit(cfg.gamma_min)), F.lit(cfg.gamma_max))
    else:
        gamma = F.lit(cfg.gamma)
    rows = rows.withColumn("gamma", gamma).withColumn("mixed", (1 - F.col("gamma")) * F.col("p_meta") + F.col("gamma") * F.col("p_enc"))
    return rows.withColumn("p", normalized(F.col("mixed"), cfg.eps if cfg.auto_gamma else None)).drop("mixed")


def row_weights(axis: DataFrame, weights: DataFrame) -> DataFrame:
    """(a, b, w_ab): each entity's weights over all others, summing to 1."""
    from tallyforge.operators.matrix import grid

    rows = grid(axis).where("a <> b").join(F.broadcast(weights.select(F.col("deck").alias("b"), "p")), "b")
    mine = Window.partitionBy("a")
    total = F.sum("p").over(mine)
    return rows.select("a", "b", F.when(total > 0, F.col("p") / total).otherwise(F.lit(1.0) / F.count(F.lit(1)).over(mine)).alias("w_ab"))
