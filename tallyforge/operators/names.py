"""Names that are equal to, begin with or contain each other, met through hashes of their stretches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.state import dealt, saved

#: Names of up to so many characters are looked up whole; longer ones by a beginning whose length is one of LENGTHS.
WHOLE = 32
LENGTHS = [*range(WHOLE), *(WHOLE * 5**i // 4**i for i in range(40))]
#: For each name, what its stretches (some dozens of short rows) count as in the number of partitions.
STRETCHES = 8


def key_length(name: Column) -> Column:
    """The largest of LENGTHS that is no longer than ``name``."""
    n = F.length(name)
    return F.when(n <= WHOLE, n).otherwise(F.array_max(F.filter(F.array(*[F.lit(x) for x in LENGTHS]), lambda x: x <= n)))


def contained(short: DataFrame, long: DataFrame) -> DataFrame:
    """(short, long) of all pairs where the one name occurs in the other. ``short``, ``long``: name, lower case.

    Short names meet the stretches of long ones of their own length by hashes, so that work grows with the names and not
    with how many share a gram; those that have met are compared. Only lengths that short names have are taken.
    """
    n = short.count() + long.count()
    asked = saved(short.select(F.col("name").alias("short")).distinct().withColumn("size", key_length(F.col("short"))))
    held = saved(long.select(F.col("name").alias("long")).distinct().withColumn("place", F.monotonically_increasing_id()))
    # At most one for each of LENGTHS.
    sizes = sorted(r["size"] for r in asked.select("size").distinct().where("size is not null").collect())
    fitting = F.filter(F.array(*[F.lit(x) for x in sizes]).cast("array<int>"), lambda x: x <= F.length("long"))
    last = F.greatest(F.length("long") - F.col("size"), F.lit(0)) + 1
    starts = dealt(held, n * STRETCHES, "place").select("place", "long", F.explode(fitting).alias("size")).select("place", "long", "size", F.explode(F.sequence(F.lit(1), F.when(F.col("size") == 0, F.lit(1)).otherwise(last))).alias("i"))
    met = dealt(starts.select("place", F.xxhash64("size", F.substr("long", F.col("i"), F.col("size"))).alias("key")), n * STRETCHES, "key")
    keys = dealt(asked.select("short", F.xxhash64("size", F.substr("short", F.lit(1), F.col("size"))).alias("key")), n * STRETCHES, "key")
    found = dealt(met.join(keys.hint("merge"), "key").select("place", "short"), n, "place")
    pairs = found.join(dealt(held, n, "place").hint("merge"), "place").where(F.contains("long", F.col("short")))
    return pairs.select("short", "long").distinct()


def best_match(sheets: DataFrame, decks: DataFrame) -> DataFrame:
    """(sheet, ord) of the best of ``decks`` (deck, ord) for each of ``sheets`` (sheet): equal, then one beginning with the other,
    then one inside the other, case aside; then the smallest ord. Sheets without a match are left out."""
    n = sheets.count() + decks.count()
    s = dealt(sheets.select("sheet", F.lower("sheet").alias("s")), n, "sheet", "s").distinct()
    d = decks.select("deck", "ord", F.lower("deck").alias("d"))
    names = lambda df, c: df.select(F.col(c).alias("name"))
    pairs = contained(names(d, "d"), names(s, "s")).toDF("d", "s").unionByName(contained(names(s, "s"), names(d, "d")).toDF("s", "d")).distinct()
    # By sort and merge: names are many, and a broadcast would hold all of them on the driver.
    met = dealt(dealt(pairs, n, "s").join(dealt(s, n, "s").hint("merge"), "s"), n, "d").join(dealt(d, n, "d").hint("merge"), "d")
    kind = F.when(F.col("sheet") == F.col("deck"), 0).when(F.startswith("d", F.col("s")) | F.startswith("s", F.col("d")), 1).otherwise(2)
    return met.groupBy("sheet").agg(F.min(F.struct(kind.alias("kind"), "ord")).alias("m")).select("sheet", F.col("m.ord").alias("ord"))
