"""Tables that jobs write on their way, and the size of what Python is handed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from patentlake.sources.shared import remove, shared_folder

#: bytes of an Arrow batch, in and out of Python: what a task holds doesn't grow with the length of texts
BATCH_BYTES = "4m"

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def bounded(df: DataFrame) -> DataFrame:
    """df, whose session hands batches of at most BATCH_BYTES to Python; a bound that the session has already stays."""
    conf = df.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, BATCH_BYTES)
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df once as Parquet in the shared folder and read it back.

    A lost executor then costs a re-read, not a recomputation of what came before. What was
    shuffled for df isn't needed any more, and Spark removes it at the end of the write.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables whose readers are done."""
    for table in tables:
        remove(table.sparkSession, table.written_to)
