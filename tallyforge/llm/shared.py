"""Small helpers that several operators share: table reads, lineage cuts, word expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of an Arrow batch, or one row that is longer.
BATCH_BYTES = 1 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see. In local mode only, a temporary one where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tallyforge-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def saved(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: a lineage cut that outlives executors.

    The shuffle files of the query that made it are of no more use and go when it ends.
    """
    path, conf = f"{shared_dir(df.sparkSession)}/saved-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is held out by its id; a null id never is."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def fewer_rows(docs: DataFrame, rows: int = 1_000) -> DataFrame:
    """``docs``, with Arrow batches of fewer rows and bytes from now on: texts are long, and a batch is held whole, twice.

    Spark reads these settings of the session when a plan runs, so they stay set.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs


#: Stand-in keys of rows without an id lie from here on, so ids must be smaller.
NO_ID = 2**63 - 2**60


def doc_key(docs: DataFrame) -> Column:
    """doc_id as a long; a stand-in of at least NO_ID, made from the text, where it is null. Other types of ids are an error."""
    kind = docs.schema["doc_id"].dataType
    if not isinstance(kind, IntegralType):
        raise TypeError(f"doc_id must be an integer column, not {kind.simpleString()}")
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64("text"), 4))


def packed_row(df: DataFrame, apart: list[str]) -> Column:
    """All columns of ``df`` but those named in ``apart`` as one struct ``row``, safe from names that an operator uses."""
    apart = {c.lower() for c in apart}
    return F.struct(*["`" + c.replace("`", "``") + "`" for c in df.columns if c.lower() not in apart]).alias("row")
