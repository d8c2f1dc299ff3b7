"""The page cache, cleaning of folders, name matching through grams, and pair records of a stream."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import consolidate, names, report
from tallyforge.sources import cleaning, page_cache, pages
from tallyforge.streaming import ingest


def at(hour):
    return F.to_timestamp(F.lit(f"2024-01-15 {hour:02d}:00:00"))


class Site:
    """A fetcher that keeps what it was asked for; pages with "gone" can't be had."""

    def __init__(self, spark, version):
        self.spark, self.version, self.asked = spark, version, []

    def __call__(self, urls):
        self.asked = sorted(r.url for r in urls.collect())
        return urls.select("url", F.when(~F.contains("url", F.lit("gone")), F.concat("url", F.lit(f"#{self.version}"))).alias("html"))


def test_page_cache(spark, tmp_path):
    cache = page_cache.PageCache(spark, str(tmp_path / "cache"), 4)
    wanted = lambda *urls: spark.createDataFrame([(u,) for u in urls], "url string")
    result = lambda df: {r.url: (r.html, r.from_cache) for r in df.collect()}
    first, second = Site(spark, 1), Site(spark, 2)
    assert result(cache.fetch(wanted("a", " b ", "gone", None), first, at(1), 120)) == {"a": ("a#1", False), " b ": ("b#1", False), "gone": (None, False), None: (None, False)}
    assert first.asked == ["a", "b", "gone"] and cache.read().count() == 2
    assert result(cache.fetch(wanted("a", "b"), second, at(2), 120)) == {"a": ("a#1", True), "b": ("b#1", True)} and second.asked == []
    assert result(cache.fetch(wanted("a", "c"), second, at(2), 120, force=True)) == {"a": ("a#2", False), "c": ("c#2", False)}
    assert result(cache.fetch(wanted("a", "b", "c"), Site(spark, 3), at(3), 90)) == {"a": ("a#2", True), "b": ("b#3", False), "c": ("c#2", True)}
    # Older pages never win over newer ones, and equal times are settled alike on every run.
    cache.merge(spark.createDataFrame([("a", "old"), ("b", "zz")], "url string, html string").withColumn("fetched_at", F.when(F.col("url") == "a", at(0)).otherwise(at(3))), at(3))
    held = {r.cache_key: r.html for r in cache.read().collect()}
    key = lambda u: spark.range(1).select(pages.cache_key(F.lit(u))).first()[0]
    assert held[key("a")] == "a#2" and held[key("b")] == "zz" and len(held) == 3
    # Compaction: what is older than the time to live goes from the buckets that a merge touches.
    one = page_cache.PageCache(spark, str(tmp_path / "one"), 1)
    for hour, url in ((1, "x"), (5, "y")):
        one.merge(spark.createDataFrame([(url, url)], "url string, html string").withColumn("fetched_at", at(hour)), at(hour), 60)
    assert [r.html for r in one.read().collect()] == ["y"]


def test_a_cache_that_cannot_be_written(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    cache = page_cache.PageCache(spark, str(tmp_path / "file" / "cache"))
    with pytest.warns(UserWarning, match="could not be written"):
        assert cache.fetch(spark.createDataFrame([("a",)], "url string"), Site(spark, 1), at(1), 60).first().html == "a#1"


@pytest.fixture
def outputs(tmp_path):
    for name in ("scores/s_20240102_030405.csv", "scores/s_latest.csv", "scores/old/s_20230102_030405.csv", "archives/s_20240102_030405.csv", "plain.txt", "deep/er/x_20240102_030405/part-0.csv", "deep/er/x_20240102_030405/part-1.csv", "run_latest/part-0.csv"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    return tmp_path


def test_cleaning(spark, outputs):
    inside = lambda df: {r.path.split(f"{outputs}/")[1]: (r.action, r.n_files, r.done) for r in df.collect()}
    before = sorted(os.walk(outputs))
    plan = inside(cleaning.clean(spark, str(outputs)))
    assert sorted(k for k, v in plan.items() if v[0] == "delete") == ["deep/er/x_20240102_030405", "scores/old/s_20230102_030405.csv", "scores/s_20240102_030405.csv"]
    assert plan["deep/er/x_20240102_030405"][1] == 2 and plan["run_latest"] == ("keep", 1, False) and sorted(os.walk(outputs)) == before
    done = inside(cleaning.clean(spark, str(outputs), apply=True, empty_dirs=True))
    assert all(v[2] == (v[0] == "delete") for v in done.values())
    left = sorted(os.path.relpath(os.path.join(d, f), outputs) for d, _, fs in os.walk(outputs) for f in fs if not f.startswith("."))
    assert left == ["archives/s_20240102_030405.csv", "plain.txt", "run_latest/part-0.csv", "scores/s_latest.csv"]
    assert not (outputs / "scores/old").exists() and not (outputs / "deep").exists() and (outputs / "scores").exists()
    again = inside(cleaning.clean(spark, str(outputs), apply=True, archives=True, empty_dirs=True))
    assert again["archives/s_20240102_030405.csv"] == ("delete", 1, True) and not (outputs / "archives").exists()


def test_deleting_twice(spark, outputs):
    paths = spark.createDataFrame([(f"file://{outputs}/plain.txt",), (f"file://{outputs}/never.txt",)], "path string")
    assert all(r.done for _ in range(2) for r in cleaning.removed(paths).collect()) and not (outputs / "plain.txt").exists()


def test_names_through_grams(spark):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choices("abA b", k=rng.randint(0, n)))
    sheets, decks = sorted({make(7) for _ in range(60)}), sorted({make(4) for _ in range(25)})
    want = {}
    for s in sheets:
        found = []
        for o, d in enumerate(decks):
            x, y = s.lower(), d.lower()
            if s == d:
                found.append((0, o))
            elif x.startswith(y) or y.startswith(x):
                found.append((1, o))
            elif x in y or y in x:
                found.append((2, o))
        if found:
            want[s] = min(found)[1]
    got = names.best_match(spark.createDataFrame([(s,) for s in sheets], "sheet string"), spark.createDataFrame([(d, o) for o, d in enumerate(decks)], "deck string, ord int"))
    assert {r.sheet: r.ord for r in got.collect()} == want


def test_names_by_no_nested_loop(spark):
    words = [f"name {i} of {i * 7 % 13}" for i in range(500)]
    decks = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "deck string, ord int")
    sheets = spark.createDataFrame([(w.upper(),) for w in words], "sheet string")
    found = names.best_match(sheets, decks)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and found.count() == 500
    assert report.sheet_order(sheets, decks).where("place <= 3").count() == 3


def test_pair_records_of_a_stream(spark, tmp_path):
    rng = random.Random(8)
    schema = "a string, b string, w long, l long, t long"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    seen, source = [], tmp_path / "in"
    source.mkdir()
    held = {}

    def take(batch, _):
        for r in batch.collect():
            held[r.a, r.b] = (r.w, r.l, r.t, r.n, r.winrate)

    try:
        stream = ingest.pair_records(spark.readStream.schema(schema).json(str(source)))
        for turn in range(3):
            rows = [(x, y, *(rng.randint(0, 3) for _ in range(3))) for x, y in (rng.sample(["p", "q", "r", " p"], 2) for _ in range(12))] + [("p", "p", 1, 1, 0)]
            seen += rows
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(source))
            q = stream.writeStream.foreachBatch(take).outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            q.awaitTermination(120)
            batch = ingest.pair_records(spark.createDataFrame(seen, schema)).where("a <> b")
            assert {k: v for k, v in held.items() if k[0] != k[1]} == {(r.a, r.b): (r.w, r.l, r.t, r.n, r.winrate) for r in batch.collect()}, turn
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert consolidate.max_n(spark.createDataFrame(seen, schema)).count() > 6


def test_names_that_share_their_grams(spark):
    """Each gram of a name occurs in a share of all names: what meets must not grow with the square; long names meet by a beginning."""
    n = 3000
    decks = spark.range(n).select(F.concat(F.lit("large ring "), F.col("id").cast("string")).alias("deck"), F.col("id").alias("ord"))
    sheets = spark.range(n).select(F.concat(F.lit("my LARGE ring "), F.col("id").cast("string"), F.lit("x")).alias("sheet"))
    got = names.best_match(sheets, decks)
    first = lambda i: min(int(str(i)[:k]) for k in range(1, len(str(i)) + 1))
    assert {(r.sheet, r.ord) for r in got.collect()} == {(f"my LARGE ring {i}x", first(i)) for i in range(n)}
    text = "".join(chr(97 + i * i % 23) for i in range(90))
    long, short = spark.createDataFrame([(text,), ("",)], "name string"), spark.createDataFrame([(text[7:60],), (text[1:34],), (text[50:],), (text[7:59] + "!",), ("",)], "name string")
    want = {(text[7:60], text), (text[1:34], text), (text[50:], text), ("", text), ("", "")}
    assert {(r.short, r.long) for r in names.contained(short, long).collect()} == want
