"""From raw pairwise records to one symmetric record per pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.scalar import any_label_key as label_key
from tallyforge.functions.scalar import count_of, label_key_text, win_rate, win_rate_all

REQUIRED = ("a", "b", "w", "l", "t")


def require(df: DataFrame, columns=REQUIRED) -> DataFrame:
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise KeyError(f"missing columns: {lacking}")
    return df


def with_counts(df: DataFrame) -> DataFrame:
    """Counts coerced to non-negative integers, names trimmed, n = w + l + t; null names dropped."""
    rows = require(df).where("a is not null and b is not null")
    kind = dict(rows.dtypes)
    rows = rows.select(F.trim("a").alias("a"), F.trim("b").alias("b"), *[count_of(F.col(c), kind[c]).alias(c) for c in "wlt"])
    return rows.withColumn("n", F.col("w") + F.col("l") + F.col("t"))


def max_n(raw: DataFrame) -> DataFrame:
    """Of duplicate records of (a, b) those with the most matches, counts coerced first; ties among them are summed."""
    most = Window.partitionBy("a", "b")
    kept = with_counts(raw).withColumn("most", F.max("n").over(most)).where("n = most")
    out = kept.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in "wlt"], F.count("*").alias("tied"))
    out = out.withColumn("n", F.col("w") + F.col("l") + F.col("t"))
    return out.withColumn("winrate", win_rate_all(F.col("w"), F.col("n")))


def alias_index(spark, names: dict[str, list[str]]) -> DataFrame:
    """(key, canonical): every spelling's key; of two canonical names that claim one, the first gets it. ``names`` is on the
    driver, so the keys are worked out there."""
    index: dict[str, str] = {}
    for canonical, variants in names.items():
        for spelling in (canonical, *variants):
            index.setdefault(label_key_text(spelling), canonical)
    return spark.createDataFrame(list(index.items()), "key string, canonical string")


def alias_keys(spellings: DataFrame) -> DataFrame:
    """(key, canonical) of spellings (pos, canonical, spelling); the smallest ``pos`` wins."""
    keyed = spellings.withColumn("key", label_key(F.col("spelling")))
    return keyed.groupBy("key").agg(F.min_by("canonical", "pos").alias("canonical"))


def apply_alias(df: DataFrame, column: str, aliases: DataFrame | None, trim: bool = True) -> DataFrame:
    """``column`` by its canonical name; a name that no alias knows is only trimmed, or left as it is."""
    if aliases is None:
        return df.withColumn(column, F.trim(column))
    other = F.trim(F.col(column)) if trim else F.col(column)
    known = F.broadcast(aliases.select(F.col("key").alias("_key"), F.col("canonical").alias("_to")))
    return df.join(known, label_key(F.col(column)) == F.col("_key"), "left").withColumn(column, F.coalesce("_to", other)).drop("_key", "_to")


def alias_coverage(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Percent of non-null values that some alias knows."""
    known = F.broadcast(aliases.select("key", F.lit(1).alias("hit")))
    rows = df.where(F.col(column).isNotNull()).join(known, label_key(F.col(column)) == F.col("key"), "left")
    return rows.agg((F.lit(100.0) * F.avg(F.coalesce("hit", F.lit(0)))).alias("coverage_pct"))


def symmetrize(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair from its better record: most decided matches, then most matches, then names."""
    best = Window.partitionBy(F.least("a", "b"), F.greatest("a", "b")).orderBy(F.desc(F.col("w") + F.col("l")), F.desc("n"), "a", "b")
    one = pairs.withColumn("_r", F.row_number().over(best)).where("_r = 1")
    sides = F.array(F.struct("a", "b", "w", "l", "t"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("l").alias("w"), F.col("w").alias("l"), "t"))
    out = one.select(F.explode(sides).alias("s")).select("s.*").withColumn("n", F.col("w") + F.col("l") + F.col("t"))
    return out.withColumn("winrate", win_rate(F.col("w"), F.col("l")))


def flat_table(raw: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """Aliases applied, mirrors dropped, pairs summed and made symmetric."""
    named = apply_alias(apply_alias(raw.select("a", "b", "w", "l", "t", "n"), "a", aliases), "b", aliases).where("a <> b")
    return symmetrize(named.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in "wltn"]))


def score_table(flat: DataFrame, kept: DataFrame) -> DataFrame:
    """The symmetric records between ``kept`` (deck) entities that have a decided match, with wr_dir."""
    decks = kept.select("deck")
    rows = flat.join(F.broadcast(decks.withColumnRenamed("deck", "a")), "a", "left_semi").join(F.broadcast(decks.withColumnRenamed("deck", "b")), "b", "left_semi").where("a <> b")
    rows = with_counts(rows).groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in "wltn"])
    out = symmetrize(rows).where("w + l > 0").withColumn("wr_dir", win_rate(F.col("w"), F.col("l")))
    return out.select("a", "b", "w", "l", "t", "n", "wr_dir", F.col("wr_dir").alias("winrate"))
