"""Mixing sources to target weights by systematic sampling.

A source of size S with target T takes each of its documents T / S times in expectation. Within the
source, ordered by size, the expected copies are prefix-summed, one random offset is added, and a
document is emitted once for each integer boundary that its stretch of the sum crosses. Neighbours
in that order are of like size, so the words taken stay near the target.

The order is made without a global sort: documents fall in groups (source, size), a group of many
documents in equal ranges of doc_id, a group's first rank is the running count of the groups before it, and
ranks inside a group come from a window over that group alone. A hot source is many groups, and the order
is (size, doc_id) whatever their length.

Defined cases: null text has size 0; sources are ordered by code point, a null source last; a source
of size 0 takes nothing; repeated rows are documents of their own; a null doc_id comes before all others of its size,
and ids are integers; targets stop at ``cap`` times the source's size and the excess goes to the others by
weight; texts of any length are whole; other columns are not returned; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.shared import WORD, saved

#: Documents that one window group orders, if their ids are spread evenly.
GROUP_ROWS = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: int) -> Column:
    """In [0, 1), from the seed and the source's name."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(source, F.lit("")))), 1, 8), 16, 10).cast("double") / 4294967296.0


def source_targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row for each source, so small.

    Target = min(cap * size, level * weight), with the level at which the targets add up. Sources in
    order of cap * size / weight: those before the level are full, the rest share what is left.
    """
    in_order, full = Window.orderBy(F.col("source").isNull(), "source"), Window.orderBy("ratio", F.col("source").isNull(), "source")
    weight = F.get(F.array(*map(F.lit, weights)), (F.row_number().over(in_order) - 1) % len(weights)).cast("double")
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * cap).withColumn("ratio", F.col("most") / F.col("weight"))
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rows = rows.withColumn("left", F.sum("source_size").over(whole) * share - F.coalesce(F.sum("most").over(before), F.lit(0.0))).withColumn("level", F.col("left") / F.sum("weight").over(after))
    # The first source that is not full at its level sets it; after that the levels only fall.
    level = F.max(F.when(F.col("level") < F.col("ratio"), F.col("level"))).over(whole)
    return rows.select("source", "source_size", F.least(F.col("most"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def ranked(rows: DataFrame, per_size: DataFrame, order: list[str], group_rows: int) -> DataFrame:
    """``rows`` with rank: the place in its source by (size, doc_id, ...)."""
    split = per_size.where(F.col("n") > group_rows).select(F.col("source").alias("s"), F.col("size").alias("z"), "low", ((F.col("high") - F.col("low") + 1.0) / F.ceil(F.col("n") / group_rows)).alias("width"))
    if split.limit(1).count():
        part = F.when(F.col("doc_id").isNull(), -1).otherwise(F.coalesce(F.floor((F.col("doc_id") - F.col("low")) / F.col("width")), F.lit(0)))
        rows = rows.join(split, rows["source"].eqNullSafe(split["s"]) & (rows["size"] == split["z"]), "left").withColumn("part", part.cast("long")).drop("s", "z", "low", "width")
    else:
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    start = Window.partitionBy("source").orderBy("size", "part").rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy("source", "size", "part").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(start), F.lit(0)))
    groups = groups.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), "start")
    own = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(*order))
    placed = rows.withColumn("own", own).join(groups, rows["source"].eqNullSafe(groups["s"]) & (rows["size"] == groups["z"]) & (rows["part"] == groups["p"]))
    return placed.withColumn("rank", F.col("start") + F.col("own")).drop("part", "own", "s", "z", "p", "start")


def mix(docs: DataFrame, weights: list[int], share: float = 1.5, cap: float = 2.0, seed: int = 7, ties: tuple[str, ...] = (), group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, *ties, source, size, source_size, target, copies, taken) for every row of ``docs``.

    ``ties``: columns that order rows of one size and doc_id, and stay. ``group_rows`` changes no result.
    """
    keep = [F.col(c).alias(f"t{i}") for i, c in enumerate(ties)]
    rows = saved(docs.select("doc_id", *keep, "source", word_count(F.col("text")).alias("size")))
    per_size = saved(rows.groupBy("source", "size").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")))
    targets = saved(source_targets(per_size.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, share, cap))
    rows = ranked(rows, per_size, ["doc_id", *(f"t{i}" for i in range(len(ties)))], group_rows)
    # One row for each source; where there are many, Spark joins them by a shuffle instead.
    rows = rows.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at, shift = F.col("rank"), offset(F.col("source"), seed)
    copies = F.floor(rate * at + shift) - F.floor(rate * (at - 1) + shift)
    return rows.select("doc_id", *[F.col(f"t{i}").alias(c) for i, c in enumerate(ties)], "source", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("copies") * F.col("size"))
