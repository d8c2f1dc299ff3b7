"""Pairwise records: from order lines, and as flat or matrix CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources.state import dealt

FLAT = "a string, b string, w bigint, l bigint, t bigint, n bigint, winrate double"


def raw_matchups(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """(a, b, page, w, l, t, n): brands meet where an order has lines of both; the larger quantity wins.

    Pages are the years in which a's line shipped. Only a's finished lines count, so that (a, b)
    and (b, a) may disagree, as scraped records do. One shuffle by order, and no self-join: an order's lines are summed
    by brand and quantity, so that a long one is short, and its own entries are met with each other where they are.
    Shuffles have as many partitions as the lines need.
    """
    n = lines.count()
    rows = lines.select("l_orderkey", "l_partkey", "l_quantity", F.when(F.col("l_linestatus") == "F", F.year("l_shipdate")).alias("page"), (F.col("l_linestatus") == "F").alias("ours"))
    brands = dealt(parts.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand")), n, "l_partkey")
    rows = dealt(dealt(rows, n, "l_partkey").join(brands.hint("merge"), "l_partkey"), n, "l_orderkey")
    lots = rows.groupBy("l_orderkey", "brand", F.col("l_quantity").alias("q"), "page", "ours").agg(F.count("*").alias("k"))
    orders = lots.groupBy("l_orderkey").agg(F.collect_list(F.struct("brand", "q", "page", "ours", "k")).alias("all")).where(F.size("all") > 1)
    one = orders.select("all", F.explode(F.filter("all", lambda x: x["ours"])).alias("x"))
    met = one.select("x", F.explode("all").alias("y")).where("x.brand <> y.brand")
    times = F.col("x.k") * F.col("y.k")
    won = lambda test: F.coalesce(F.sum(F.when(test, times)), F.lit(0))
    out = met.groupBy(F.col("x.brand").alias("a"), F.col("y.brand").alias("b"), F.col("x.page").alias("page")).agg(won(F.col("x.q") > F.col("y.q")).alias("w"), won(F.col("x.q") < F.col("y.q")).alias("l"), won(F.col("x.q") == F.col("y.q")).alias("t"))
    return out.withColumn("n", F.col("w") + F.col("l") + F.col("t"))


def league_matchups(rows: DataFrame, n: int | None = None) -> DataFrame:
    """(league, a, b, w, l, t) with a < b of ``rows`` (event, league, deck, value): entities meet in an event of their
    league, once for each two rows of theirs, and the larger value wins. One shuffle by event, one by pair, in as many
    partitions as ``n`` rows (counted if not given) need."""
    n = rows.count() if n is None else n
    rows = dealt(rows, n, "event", "league")
    one = rows.select("event", "league", F.col("deck").alias("a"), F.col("value").alias("va"))
    other = rows.select("event", "league", F.col("deck").alias("b"), F.col("value").alias("vb"))
    met = dealt(one.join(other.hint("merge"), ["event", "league"]).where("a < b"), n, "league", "a", "b")
    return met.groupBy("league", "a", "b").agg(F.count_if(F.col("va") > F.col("vb")).alias("w"), F.count_if(F.col("va") < F.col("vb")).alias("l"), F.count_if(F.col("va") == F.col("vb")).alias("t"))


def league_columns(rows: DataFrame, n: int, often: dict[int, int] | None = None) -> DataFrame:
    """(league, node, rows): of each entity that meets another in ``rows`` (event, league, node, value), those that it has met
    with a value other than its own, once each. ``node`` is a number; ``rows`` lie by event, ``n`` in all; ``often``: of nodes
    with more rows than a task takes, the number of slices that they need.

    No self-join and no row for a pair: an event's entities are met where they are, by their least and largest values, and each
    sends one list to its column.
    """
    lots = rows.groupBy("event", "league", "node").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    events = lots.groupBy("event", "league").agg(F.collect_list(F.struct("node", "lo", "hi")).alias("all")).where(F.size("all") > 1)
    one = events.select("event", "league", "all", F.explode("all").alias("y"))
    other = lambda x: (x["node"] != F.col("y.node")) & ((x["lo"] != F.col("y.hi")) | (x["hi"] != F.col("y.lo")))
    lists = one.select("event", "league", F.col("y.node").alias("node"), F.transform(F.filter("all", other), lambda x: x["node"]).alias("rows"))
    once = F.array_distinct(F.flatten(F.collect_list("rows"))).alias("rows")
    if often:
        slices = F.coalesce(F.create_map(*[F.lit(v) for pair in sorted(often.items()) for v in pair])[F.col("node")], F.lit(1))
        lists = dealt(lists.withColumn("slice", F.pmod(F.xxhash64("event"), slices)), n, "league", "node", "slice").groupBy("league", "node", "slice").agg(once)
    return dealt(lists.select("league", "node", "rows"), n, "league", "node").groupBy("league", "node").agg(once)


def usage_share(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """(deck, share): percent of all quantity by brand."""
    n = lines.count()
    sold = dealt(lines.select("l_partkey", "l_quantity"), n, "l_partkey").join(dealt(parts.select("p_partkey", "p_brand"), n, "p_partkey").hint("merge"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("deck")).agg(F.sum("l_quantity").alias("q"))
    total = sold.agg(F.sum("q").alias("total"))
    return sold.crossJoin(F.broadcast(total)).select("deck", (F.lit(100.0) * F.col("q") / F.col("total")).alias("share"))


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=FLAT)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A wide CSV with row labels in its first column, as cells (a, b, value)."""
    wide = spark.read.csv(path, header=True)
    label, *names = wide.columns
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")  # noqa: E731  names may hold dots and quotes
    cells = wide.select(quoted(label).alias("a"), F.explode(F.array(*[F.struct(F.lit(c).alias("b"), quoted(c).try_cast("double").alias("value")) for c in names])).alias("c"))
    return cells.select("a", "c.b", "c.value")


def latest(paths: list[str], prefix: str) -> str | None:
    """The last ``prefix*latest`` or ``prefix*latest.csv`` by name."""
    found = [p for p in paths if p.rsplit("/", 1)[-1].startswith(prefix) and p.endswith(("latest", "latest.csv"))]
    return max(found, default=None)
