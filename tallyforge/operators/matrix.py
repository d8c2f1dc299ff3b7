"""T x T matrices as cells (a, b, value) on an ordered axis; T is the number of ranked entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.scalar import share_fraction, win_rate


def top_meta(shares: DataFrame, threshold: float = 80.0) -> DataFrame:
    """(deck, share, share_cum): by falling share up to and with the first that reaches ``threshold`` percent in sum."""
    order = Window.orderBy(F.desc("share"), "deck").rowsBetween(Window.unboundedPreceding, 0)
    cum = shares.withColumn("share_cum", F.sum("share").over(order))
    return cum.where((F.col("share_cum") - F.col("share") < threshold)).select("deck", "share", "share_cum")


def top_meta_canonical(shares: DataFrame, aliases: DataFrame | None, mode: str = "rowwise") -> DataFrame:
    """(deck, share_frac, share_pct, ord): shares as fractions, summed by canonical name, in falling order.

    ``mode``: "rowwise" takes each value above 1 as percent, "global" all values if any is above 1.
    """
    from tallyforge.operators.consolidate import apply_alias

    if mode == "global":
        frac = F.when(F.max("share").over(Window.partitionBy()) > 1 + 1e-9, F.col("share") / 100).otherwise(F.col("share"))
    else:
        frac = share_fraction(F.col("share"))
    rows = apply_alias(shares.withColumn("share_frac", frac), "deck", aliases).groupBy("deck").agg(F.sum("share_frac").alias("share_frac"))
    return rows.withColumn("share_pct", F.bround(F.col("share_frac") * 100, 2)).withColumn("ord", F.row_number().over(Window.orderBy(F.desc("share_frac"), "deck")))


def grid(axis: DataFrame) -> DataFrame:
    """All (a, a_ord, b, b_ord) of an axis (deck, ord): T squared rows of names, so a small cross join."""
    a = axis.select(F.col("deck").alias("a"), F.col("ord").alias("a_ord"))
    return a.crossJoin(F.broadcast(axis.select(F.col("deck").alias("b"), F.col("ord").alias("b_ord"))))


def matrices(flat: DataFrame, axis: DataFrame, mode: str = "exclude", mirror: float | None = None) -> DataFrame:
    """(a, a_ord, b, b_ord, w, l, t, n_dir, wr) for every cell; counts 0 where nothing is known, NULL on the diagonal."""
    cells = grid(axis).join(flat.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in "wlt"]), ["a", "b"], "left")
    off = F.col("a") != F.col("b")
    cells = cells.withColumns({c: F.when(off, F.coalesce(c, F.lit(0))) for c in "wlt"})
    rate = F.when(off, win_rate(F.col("w"), F.col("l"), F.col("t"), mode)).otherwise(F.lit(mirror).cast("double"))
    return cells.withColumns({"n_dir": F.col("w") + F.col("l"), "wr": rate}).select("a", "a_ord", "b", "b_ord", "w", "l", "t", "n_dir", "wr")


#: Entities that a wide form may have as columns.
MAX_COLUMNS = 2_000


def pivoted(cells: DataFrame, value: str, names: list[str] | None = None, strict: bool = False) -> DataFrame:
    """The wide form for a sink: a row for each a, a column for each b (``names``, or all in order of name).

    Repeated cells are summed; ``strict`` makes them an error.
    """
    if strict and cells.groupBy("a", "b").count().where("count > 1").limit(1).count():
        raise ValueError("a cell (a, b) occurs twice")
    if names is None:
        names = [r.b for r in cells.select("b").distinct().orderBy("b").limit(MAX_COLUMNS + 1).collect()]
        if len(names) > MAX_COLUMNS:
            raise ValueError(f"more than {MAX_COLUMNS} columns")
    return cells.groupBy("a").pivot("b", names).agg(F.sum(value))


def axis_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(deck, missing_in): names that only one of two axes (deck) has; none if they agree."""
    l, r = (x.select("deck").distinct() for x in (left, right))
    return l.join(r, "deck", "left_anti").withColumn("missing_in", F.lit("right")).unionByName(r.join(l, "deck", "left_anti").withColumn("missing_in", F.lit("left")))
