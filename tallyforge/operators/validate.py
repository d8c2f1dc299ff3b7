"""Data-quality checks: each gives rows (check, n_bad)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.scalar import win_rate


def mirrored(cells: DataFrame, *columns: str) -> DataFrame:
    """Cells (a, b) beside their transposes: column c of (b, a) is c_t."""
    back = cells.select(F.col("a").alias("b"), F.col("b").alias("a"), *[F.col(c).alias(f"{c}_t") for c in columns])
    return cells.join(back, ["a", "b"])


def validate_matrix(cells: DataFrame) -> DataFrame:
    """Diagonal NULL; wr(a, b) + wr(b, a) near 100; counts mirrored; ranges."""
    m = mirrored(cells, "w", "l", "t", "n_dir", "wr")
    bad = {
        "diagonal": (F.col("a") == F.col("b")) & F.col("wr").isNotNull(),
        "sum_100": F.abs(F.col("wr") + F.col("wr_t") - 100) > 0.2,
        "n_symmetric": F.col("n_dir") != F.col("n_dir_t"),
        "w_is_l_mirrored": F.col("w") != F.col("l_t"),
        "t_symmetric": F.col("t") != F.col("t_t"),
        "n_is_w_plus_l": F.col("n_dir") != F.col("w") + F.col("l"),
        "wr_in_range": (F.col("wr") < 0) | (F.col("wr") > 100),
        "n_not_negative": F.col("n_dir") < 0,
    }
    return checked(m, bad)


def validate_shape(cells: DataFrame) -> DataFrame:
    """Both axes hold the same names, and every cell of names by names is there once."""
    names = cells.select(F.col("a").alias("deck"), F.lit(1).alias("side")).unionByName(cells.select(F.col("b").alias("deck"), F.lit(2).alias("side")))
    axes = names.groupBy("deck").agg(F.bit_or("side").alias("sides")).agg(F.count("*").alias("t"), F.count_if(F.col("sides") != 3).alias("one_axis"), F.count_if(F.col("deck").isNull()).alias("no_name"))
    pairs = cells.groupBy("a", "b").agg(F.count("*").alias("n")).agg(F.count("*").alias("cells"), F.count_if(F.col("n") > 1).alias("twice"))
    found = axes.crossJoin(pairs)  # one row each
    rows = F.array(*[F.struct(F.lit(name).alias("check"), n.alias("n_bad")) for name, n in {"one_axis_only": F.col("one_axis"), "no_name": F.col("no_name"), "cell_missing": F.col("t") * F.col("t") - F.col("cells"), "cell_twice": F.col("twice")}.items()])
    return found.select(F.inline(rows))


def validate_score(score: DataFrame, axis: DataFrame) -> DataFrame:
    """No mirrors, on the axis, both directions, n = w + l + t, rates by their formula."""
    s = score.join(axis.select(F.col("deck").alias("a"), F.lit(1).alias("a_in")), "a", "left").join(axis.select(F.col("deck").alias("b"), F.lit(1).alias("b_in")), "b", "left")
    back = score.select(F.col("a").alias("b"), F.col("b").alias("a"), F.lit(1).alias("back"))
    s = s.join(back, ["a", "b"], "left")
    bad = {
        "mirror": F.col("a") == F.col("b"),
        "off_axis": F.col("a_in").isNull() | F.col("b_in").isNull(),
        "one_direction": F.col("back").isNull(),
        "n_is_sum": F.col("n") != F.col("w") + F.col("l") + F.col("t"),
        "wr_formula": F.abs(F.col("wr_dir") - F.lit(100.0) * F.col("w") / F.greatest(F.col("w") + F.col("l"), F.lit(1))) > 0.1,
        "winrate_is_wr_dir": F.col("winrate") != F.col("wr_dir"),
    }
    return checked(s, bad)


def validate_missing(cells: DataFrame, max_ratio: float, min_allowed: int) -> DataFrame:
    """(a, n_missing, allowed, ok): unknown cells of each row against the axis's allowance."""
    rows = cells.where("a <> b").groupBy("a").agg(F.count_if(F.col("wr").isNull()).alias("n_missing"), F.count("*").alias("others"))
    allowed = F.greatest(F.lit(min_allowed), F.floor(F.col("others") * max_ratio)).cast("bigint")
    return rows.select("a", "n_missing", allowed.alias("allowed"), (F.col("n_missing") <= allowed).alias("ok"))


def validate_coverage(score: DataFrame, cells: DataFrame, max_ratio: float) -> DataFrame:
    """As many records as known cells, no more of them, and not more cells unknown than ``max_ratio`` allows."""
    known = cells.where("a <> b").agg(F.count_if(F.col("wr").isNotNull()).alias("known"), F.count("*").alias("total"))
    both = score.agg(F.count("*").alias("rows")).crossJoin(known)
    bad = {
        "rows_are_cells": F.col("rows") != F.col("known"),
        "overfill": F.col("rows") > F.col("known"),
        "missing_rate": F.col("total") - F.col("known") > F.col("total") * max_ratio,
    }
    return checked(both, bad)


def validate_recomputed(cells: DataFrame, score: DataFrame) -> DataFrame:
    """Rates and counts of the cells against the same from the records, where both know them."""
    again = score.groupBy("a", "b").agg(F.sum("w").alias("w2"), F.sum("l").alias("l2"))
    rows = cells.where("a <> b").join(again, ["a", "b"], "left")
    n = F.coalesce(F.col("w2") + F.col("l2"), F.lit(0))
    return checked(rows, {"wr_recomputed": F.abs(F.col("wr") - win_rate(F.col("w2"), F.col("l2"))) > 0.1, "n_recomputed": F.col("n_dir") != n})


def validate_bt_weights(soft: DataFrame) -> DataFrame:
    """Soft weights (n_eff, w_ij, w_ji) of an edge: both inside (0, n_eff), n_eff in sum."""
    inside = lambda c: (F.col(c) > 0) & (F.col(c) < F.col("n_eff"))
    return checked(soft, {"sum_is_n_eff": F.abs(F.col("w_ij") + F.col("w_ji") - F.col("n_eff")) > 1e-6, "in_range": ~(inside("w_ij") & inside("w_ji"))})


def checked(rows: DataFrame, bad: dict) -> DataFrame:
    counts = rows.agg(*[F.count_if(c).alias(k) for k, c in bad.items()])
    return counts.unpivot([], list(bad), "check", "n_bad")


def verdict(reports: list[DataFrame]) -> DataFrame:
    """One row (passed): whether no check found anything."""
    return reduce(DataFrame.unionByName, reports).agg((F.sum("n_bad") == 0).alias("passed"))
