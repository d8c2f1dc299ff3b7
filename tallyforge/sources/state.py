"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Rows that a task of a shuffle over the raw tables takes.
ROWS_A_TASK = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as ``rows`` (of the whole table) need, so that a task's memory doesn't grow with the input.

    Adaptive execution keeps a number that is given, but joins partitions of the session's number, up to as few as there are cores.
    """
    parts = math.ceil(rows / ROWS_A_TASK)
    if parts <= 1:
        return df.repartition(*keys)
    spark = df.sparkSession
    return df.repartition(max(parts, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)), *keys)


def shared_home(spark: SparkSession) -> str:
    """A new path in the shared folder; in local mode a temporary folder serves where none is set."""
    home = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not home:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        home = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.sparkContext.setCheckpointDir(home)
    return f"{home}/state-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """``df`` written and read again: a cut of the lineage that outlives executors."""
    path = shared_home(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def configured(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings (``__`` for a dot) that hold inside the block and are as before after it."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
