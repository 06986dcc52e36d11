"""Deliveries of archives as a stream: every member of every archive is taken once.

A micro-batch names new archives. Their members are read in rounds; a round's records are
written to a folder of their own, and then its ledger, which names that folder. What the
ledger has is never read again, so a job that ended in the middle of a delivery goes on
after the last round; a folder without a ledger counts for nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentlake.functions.scalars import archive_rank, basename
from patentlake.operators.ranking import ranked
from patentlake.sources.archives import ARCHIVE_ROWS, dealt, list_members, read_members
from patentlake.sources.shared import children, exists

LEDGER = "path string, member string, n_records long, status string, error string, data string"
_FILES = "path string, modificationTime timestamp, length long, content binary"
#: members of a round, unless told otherwise: what a failure costs at most
ROUND = 1000


def _complete(spark: SparkSession, folder: str) -> list[str]:
    return [f"{folder}/{n}" for n in children(spark, folder) if exists(spark, f"{folder}/{n}/_SUCCESS")]


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """(path, member, n_records, status, error, data): a row for each member that was read; FAILED where it is broken. Archives without members are absent, broken ones have a null member."""
    done = _complete(spark, f"{out}/ledger")
    return spark.read.schema(LEDGER).parquet(*done) if done else spark.createDataFrame([], LEDGER)


def delivered(spark: SparkSession, out: str) -> DataFrame:
    """Records of all members in the ledger, as read_members gives them, errors included."""
    done = [r.data for r in ledger(spark, out).select("data").distinct().collect()]  # one for each round
    return spark.read.schema(ARCHIVE_ROWS).parquet(*(f"{out}/data/{d}" for d in done)) if done else spark.createDataFrame([], ARCHIVE_ROWS)


def take(spark: SparkSession, files: DataFrame, out: str, tag: str = "exchange-document", size: int = ROUND) -> int:
    """Read what the ledger lacks of the archives in files, in the order in which archives are to be taken; returns the rounds made."""
    named = list_members(files).withColumn("member", F.array_join("names", "/"))
    known = ledger(spark, out).select("path", "member")
    new = named.alias("n").join(known.alias("k"), (F.col("n.path") == F.col("k.path")) & F.col("n.member").eqNullSafe(F.col("k.member")), "left_anti")
    todo = ranked(new.withColumn("rank", archive_rank(basename(F.col("path")))), ["rank", "path", "member"])
    last = todo.agg(F.max("place")).first()[0] or 0
    for first in range(1, last + 1, size):
        some = todo.where(F.col("place").between(first, first + size - 1))
        name = uuid.uuid4().hex
        read_members(dealt(some.select("path", "names", "error")), tag).write.parquet(f"{out}/data/{name}")
        found = spark.read.schema(ARCHIVE_ROWS).parquet(f"{out}/data/{name}").groupBy("path", "member").agg(F.count("record_xml").alias("n_records"), F.max("error").alias("error"))
        taken = some.select("path", "member").alias("s").join(found.alias("f"), (F.col("s.path") == F.col("f.path")) & F.col("s.member").eqNullSafe(F.col("f.member")), "left")
        status = F.when(F.col("error").isNull(), "COMPLETED").otherwise("FAILED")
        taken.select("s.path", "s.member", F.coalesce("n_records", F.lit(0).cast("long")).alias("n_records"), status.alias("status"), "error", F.lit(name).alias("data")).write.parquet(f"{out}/ledger/{name}")
    return -(-last // size)


def stream_archives(spark: SparkSession, folder: str, out: str, checkpoint: str, tag: str = "exchange-document", glob: str = "*.zip", size: int = ROUND) -> None:
    """Take the archives that are new below folder since the last call. Only their names go through the stream, never their bytes."""
    files = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder).select("path")
    files.writeStream.foreachBatch(lambda rows, _: take(spark, rows, out, tag, size) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
