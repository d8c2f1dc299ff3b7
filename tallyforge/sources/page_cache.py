"""A cache of pages kept as a bucketed table: fetched pages are merged in, the newest of each wins, old ones go.

A merge reads and replaces only the buckets of the fetched keys (dynamic partition overwrite), after the merged rows
were saved, so it may be repeated. Writers must not overlap; the last one's buckets stay.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources.pages import cache_key, is_fresh, with_cache
from tallyforge.sources.state import saved

SCHEMA = "cache_key string, html string, fetched_at timestamp, bucket int"


@dataclass
class PageCache:
    spark: SparkSession
    path: str
    buckets: int = 64

    def read(self) -> DataFrame:
        """(cache_key, html, fetched_at, bucket); no rows where there is no cache yet."""
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def merge(self, pages: DataFrame, now: Column, ttl_minutes: int | None = None) -> None:
        """Takes in ``pages`` (url, html, fetched_at); null html is no page. Of one key the newest stays, of equal times the
        larger html. With ``ttl_minutes``, pages of the same buckets that are older go."""
        key = cache_key(F.trim("url"))
        new = saved(pages.where(F.col("html").isNotNull() & (F.length(F.trim("url")) > 0)).select(key.alias("cache_key"), "html", F.col("fetched_at").cast("timestamp").alias("fetched_at")).withColumn("bucket", F.pmod(F.xxhash64("cache_key"), F.lit(self.buckets)).cast("int")))
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]
        if not touched:
            return
        both = self.read().where(F.col("bucket").isin(touched)).unionByName(new)
        newest = F.max_by(F.struct("html", "fetched_at"), F.struct("fetched_at", "html"))
        merged = both.groupBy("cache_key", "bucket").agg(newest.alias("p")).select("cache_key", "p.html", "p.fetched_at", "bucket")
        if ttl_minutes is not None:
            merged = merged.where(is_fresh(F.col("fetched_at"), now, ttl_minutes))
        saved(merged).repartition(F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(self.path)

    def fetch(self, wanted: DataFrame, fetcher: Callable[[DataFrame], DataFrame], now: Column, ttl_minutes: int, force: bool = False) -> DataFrame:
        """``wanted`` (url, once each) plus html and from_cache. What the cache doesn't hold fresh (with ``force``, nothing) goes to
        ``fetcher``, from urls to (url, html), and its pages into the cache. html is null where a page can't be had.

        A cache that can't be written is a warning, as the pages are there all the same.
        """
        cached = with_cache(wanted, self.read(), now, 0 if force else ttl_minutes)
        known = saved(cached)
        misses = known.where(~F.col("from_cache"))
        got = saved(fetcher(misses.select(F.trim("url").alias("url")).where(F.length("url") > 0).distinct()).select(F.trim("url").alias("_url"), F.col("html").alias("_html")))
        try:
            self.merge(got.select(F.col("_url").alias("url"), F.col("_html").alias("html"), now.cast("timestamp").alias("fetched_at")), now, ttl_minutes)
        except (PySparkException, Py4JJavaError, OSError) as e:
            warnings.warn(f"the page cache could not be written: {e}", stacklevel=2)
        one = got.groupBy("_url").agg(F.max("_html").alias("_html"))
        rows = known.join(one, (F.trim("url") == F.col("_url")) & ~F.col("from_cache"), "left")
        return rows.withColumn("html", F.coalesce("html", "_html")).drop("_url", "_html")
