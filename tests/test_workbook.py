"""The workbook source: round trips, parts of many tasks, failed tasks and locked files."""

import os
import zipfile

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from tallyforge.sources import workbook


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.125, "a<b & \"c\"", None), (2, None, " spaced\nline ", True), (-3, float("nan"), "\x01ü", False)], "n long, x double, s string, flag boolean")
    flag = F.when(F.col("n") == 2, "red")
    rows = workbook.sheet_rows(df, 3, "Second", styles={"n": flag, "x": F.lit("mirror")}).unionByName(workbook.sheet_rows(df.select("s"), 1, "First[1]:/"))
    path = str(tmp_path / "out.xlsx")
    workbook.write(rows, path, str(tmp_path / "latest.xlsx"))
    got = [(r.place, r.sheet, r.row, r.col, r.text, r.number, r.style) for r in workbook.read(spark, path).orderBy("place", "row", "col").collect()]
    assert got == [
        (0, "First1", 0, 0, "s", None, "header"), (0, "First1", 1, 0, 'a<b & "c"', None, ""), (0, "First1", 2, 0, " spaced\nline ", None, ""), (0, "First1", 3, 0, "ü", None, ""),
        (1, "Second", 0, 0, "n", None, "header"), (1, "Second", 0, 1, "x", None, "header"), (1, "Second", 0, 2, "s", None, "header"), (1, "Second", 0, 3, "flag", None, "header"),
        (1, "Second", 1, 0, None, 1.0, ""), (1, "Second", 1, 1, None, 0.125, "mirror"), (1, "Second", 1, 2, 'a<b & "c"', None, ""),
        (1, "Second", 2, 0, None, 2.0, "red"), (1, "Second", 2, 2, " spaced\nline ", None, ""), (1, "Second", 2, 3, "true", None, ""),
        (1, "Second", 3, 0, None, -3.0, ""), (1, "Second", 3, 2, "ü", None, ""), (1, "Second", 3, 3, "false", None, ""),
    ]
    assert (tmp_path / "latest.xlsx").read_bytes() == (tmp_path / "out.xlsx").read_bytes() and sorted(os.listdir(tmp_path)) == ["latest.xlsx", "out.xlsx"]


def test_a_sheet_of_many_tasks(spark, tmp_path):
    path = str(tmp_path / "many.xlsx")
    with_rows = workbook.sheet_rows(spark.range(5_000).select("id", (F.col("id") / 3).alias("third")), 0, "Long", F.col("id"))
    workbook.write(with_rows.unionByName(workbook.sheet_rows(spark.range(7), 1, "long")), path)
    back = workbook.read(spark, path)
    assert [r.sheet for r in back.select("place", "sheet").distinct().orderBy("place").collect()] == ["Long", "long~2"]
    assert back.where("place = 0 and col = 0 and row > 0 and number <> row - 1").count() == 0 and back.where("place = 0 and col = 1").count() == 5_001
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and "styles.xml" in "".join(z.namelist())


def test_a_failed_task_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "kept.xlsx")
    good = workbook.sheet_rows(spark.range(3), 0, "ok")
    workbook.write(good, path)
    before = (tmp_path / "kept.xlsx").read_bytes()
    broken = good.unionByName(workbook.sheet_rows(spark.range(2_000).select(F.when(F.col("id") == 1_999, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id")), 1, "bad", F.lit(1)))
    with pytest.raises(Exception, match="broken"):
        workbook.write(broken, path)
    for wrong in (good.withColumn("cells", F.transform("cells", lambda c: c.withField("style", F.lit("pink")))), good.unionByName(workbook.sheet_rows(spark.range(1), 0, "other"))):
        with pytest.raises(Exception, match="pink|sheets"):
            workbook.write(wrong, path)
    assert (tmp_path / "kept.xlsx").read_bytes() == before and os.listdir(tmp_path) == ["kept.xlsx"]


def test_no_overwrite_unless_asked(spark, tmp_path):
    path = str(tmp_path / "one.xlsx")
    rows = workbook.sheet_rows(spark.range(1), 0, "a")
    workbook.write(rows, path)
    with pytest.raises(Exception, match="already"):
        rows.write.format("workbook").mode("append").save(path)


class Busy:
    """A store whose target can't be replaced so many times."""

    def __init__(self, times):
        self.times, self.local, self.moves = times, fs.LocalFileSystem(), []

    def move(self, a, b):
        self.moves.append(b)
        if "_LOCKED_" not in b and self.times:
            self.times -= 1
            raise PermissionError("in use")
        self.local.move(a, b)


@pytest.mark.parametrize(("times", "tries"), [(0, 1), (2, 3), (99, workbook.TRIES + 1)])
def test_patience_with_a_locked_file(tmp_path, monkeypatch, times, tries):
    waits = []
    monkeypatch.setattr(workbook.time, "sleep", waits.append)
    (tmp_path / "draft").write_text("new")
    (tmp_path / "t.xlsx").write_text("old")
    store = Busy(times)
    kept = workbook.move(store, str(tmp_path / "draft"), str(tmp_path / "t.xlsx"))
    assert len(store.moves) == tries and waits == sorted(waits) and open(kept).read() == "new"
    assert ("_LOCKED_" in kept) == (times > workbook.TRIES) and (tmp_path / "t.xlsx").read_text() == ("old" if "_LOCKED_" in kept else "new")
