"""Retention carried out: files are listed by Spark, planned as data, and deleted by tasks.

Every step may run twice: a file that is gone already counts as deleted. Nothing is deleted unless asked.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.sources.sinks import retention
from tallyforge.sources.state import saved

STAMP = r"_(\d{8}_\d{6}|latest)(\.[A-Za-z0-9]+)?$"


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, n_files, bytes, modified) of what was written under ``root``: a file, or a folder of part files whose name is stamped
    or ends in latest. Contents aren't read; hidden files and those of Spark's commits aren't listed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    names = F.split("path", "/")
    stamped = F.array_position(F.transform(names, lambda x: F.rlike(x, F.lit(STAMP))), F.lit(True))
    unit = F.when(stamped > 0, F.array_join(F.slice(names, F.lit(1), stamped.cast("int")), "/")).otherwise(F.col("path"))
    return files.groupBy(unit.alias("path")).agg(F.count("*").alias("n_files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("modified"))


def removed(paths: DataFrame, column: str = "path") -> DataFrame:
    """``paths`` plus done: whether the file, or the folder with all in it, is gone now. Tasks delete."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = []
            for path in batch[column]:
                store, at = fs.FileSystem.from_uri(path)
                try:
                    kind = store.get_file_info(at).type
                    if kind == fs.FileType.Directory:
                        store.delete_dir(at)
                    elif kind != fs.FileType.NotFound:
                        store.delete_file(at)
                    done.append(True)
                except FileNotFoundError:
                    done.append(True)
                except OSError:
                    done.append(False)
            yield batch.assign(done=done)

    return paths.mapInPandas(run, paths.withColumn("done", F.lit(True)).schema)


def prune(spark: SparkSession, folders: DataFrame, root: str, archives: bool = False) -> DataFrame:
    """(path) of the folders under ``root`` that were empty and went: those of ``folders`` (path), then their parents, level by level."""
    home = root.rstrip("/")
    todo, gone = folders.select("path").distinct(), []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path in batch["path"]:
                store, at = fs.FileSystem.from_uri(path)
                try:
                    if store.get_file_info(at).type == fs.FileType.Directory and all(f.base_name.startswith(".") for f in store.get_file_info(fs.FileSelector(at))):
                        store.delete_dir(at)
                        out.append(path)
                except OSError:
                    pass
            yield pd.DataFrame({"path": out}, dtype="str")

    while True:
        inside = F.contains("path", F.lit(f"{home}/"))  # Spark's paths lead with a scheme
        kept = F.lit(False) if archives else F.rlike("path", F.lit(r"(?i)(^|/)archives(/|$)"))
        level = saved(todo.where(inside & ~kept).mapInPandas(run, "path string"))
        if level.isEmpty():
            break
        gone.append(level)
        todo = level.select(F.regexp_replace("path", r"/[^/]*$", "").alias("path")).distinct()
    out = spark.createDataFrame([], "path string")
    for level in gone:
        out = out.unionByName(level)
    return out


def clean(spark: SparkSession, root: str, apply: bool = False, archives: bool = False, empty_dirs: bool = False) -> DataFrame:
    """(path, action, n_files, bytes, done): stamped versions under ``root`` go, latest ones, others and archives (unless asked) stay.

    Without ``apply`` this is a plan, and ``done`` is false. ``empty_dirs`` takes folders that became empty, too.
    """
    plan = retention(listed(spark, root), archives).select("path", "action", "n_files", "bytes")
    if not apply:
        return plan.withColumn("done", F.lit(False))
    plan = saved(plan)
    out = saved(removed(plan.where("action = 'delete'")).unionByName(plan.where("action <> 'delete'").withColumn("done", F.lit(False))))
    if empty_dirs:
        prune(spark, out.where("done").select(F.regexp_replace("path", r"/[^/]*$", "").alias("path")), root, archives)
    return out
