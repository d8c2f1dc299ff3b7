"""Ranks and running sums over a whole table, without a window that takes all of it to one task.

Rows are dealt into ranges of the order and saved; each range works out its own ranks and sums, and starts from
the totals of the ranges before it, of which there are as many as partitions. Ties must be broken by the order
itself, else equal rows may swap places (never their running totals' end).
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.sources.state import saved


def running(rows: DataFrame, order: list[Column], value: str | None = None, parts: int | None = None) -> DataFrame:
    """``rows`` plus ``place`` (1, 2, ...) and, of a column ``value``, ``before`` and ``through``: its sum over the rows before, and with this one.

    NULLs in ``value`` count as 0.
    """
    spark = rows.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = saved(rows.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    amount = F.coalesce(F.col(value), F.lit(0)) if value else F.lit(0)
    totals = dealt.groupBy("_part").agg(F.count("*").alias("n"), F.sum(amount).alias("v")).orderBy("_part").collect()
    zero = totals[0]["v"] * 0 if totals else 0
    first = accumulate((r["n"] for r in totals), initial=0)
    base = accumulate((r["v"] for r in totals), initial=zero)
    kind = (dealt.select(F.sum(amount).alias("v")).schema["v"].dataType).simpleString()
    starts = spark.createDataFrame([(r["_part"], f, b) for r, f, b in zip(totals, first, base, strict=False)], f"_part int, _first long, _base {kind}")
    inside = Window.partitionBy("_part").orderBy(*order)
    out = dealt.withColumns({"_place": F.row_number().over(inside), "_sum": F.sum(amount).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "_amount": amount})
    out = out.join(F.broadcast(starts), "_part").withColumn("place", F.col("_first") + F.col("_place"))
    if value:
        out = out.withColumns({"before": F.col("_base") + (F.col("_sum") - F.col("_amount")), "through": F.col("_base") + F.col("_sum")})
    return out.select(*[F.col(f"`{c}`") for c in rows.columns], "place", *(["before", "through"] if value else []))


def top_share(shares: DataFrame, threshold: float = 80.0, parts: int | None = None) -> DataFrame:
    """``matrix.top_meta`` for any number of names: (deck, share, share_cum) up to and with the first that reaches ``threshold``."""
    cum = running(shares.select("deck", "share"), [F.desc("share"), F.col("deck")], "share", parts)
    return cum.where(F.col("through") - F.col("share") < threshold).select("deck", "share", F.col("through").alias("share_cum"))
