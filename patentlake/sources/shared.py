"""The folder that driver and executors share, and what lies in such folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; one of our own is set only where that is unset and all runs in one process (tests)."""
    context = spark.sparkContext
    top = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        known = context._jsc.sc().getCheckpointDir()
        if not known.isDefined():
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='patentlake-')}")
            known = context._jsc.sc().getCheckpointDir()
        top = known.get()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _of(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _of(spark, path)
    return fs.exists(hadoop)


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed."""
    fs, hadoop = _of(spark, path)
    return fs.getFileStatus(hadoop).getModificationTime()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it isn't there."""
    fs, hadoop = _of(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop = _of(spark, path)
    fs.delete(hadoop, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes in a file or below a folder."""
    fs, hadoop = _of(spark, path)
    return fs.getContentSummary(hadoop).getLength()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; one that is there already is an error."""
    fs, hadoop = _of(spark, path)
    out = fs.create(hadoop, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, hadoop = _of(spark, path)
    opened = fs.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
    finally:
        opened.close()


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file in one step; an error, and no change, where the target is there already."""
    jvm = spark.sparkContext._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(paths[0].toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(*paths, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))


def rename_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder in one step; an error where the target is there already."""
    fs, hadoop = _of(spark, source)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(to) or not fs.rename(hadoop, to):
        raise FileExistsError(target)
