"""Ordered scan of plain XML files that splits a file anywhere.

A file is read as text whose lines end where a record's opening tag begins, so Spark finds
the record borders at the byte ranges it reads, in the JVM and in any store it knows. A
line is what follows an opening tag: with the tag put back before it, it holds the record
whole, or shows that it is cut off. The tag's prefix is each file's own, so no task holds
more than a record and a block (and the records of other prefixes that follow it).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentlake.operators.ranking import stored, with_place
from patentlake.sources.xml import ROW_TAG

#: a total order of what a scan gives: file, byte where its range begins, row in the task
ORDER = ["path_", "block_", "row_"]


def _lines(spark: SparkSession, path: str | Sequence[str], end: str, glob: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", end).option("recursiveFileLookup", True)
    return (reader.option("pathGlobFilter", glob) if glob else reader).text(path if isinstance(path, str) else list(path))


def record_prefixes(spark: SparkSession, path: str, tag: str = ROW_TAG, glob: str | None = None) -> DataFrame:
    """(path_, prefix) of all files that aren't empty: the prefix that most records of the file have (`exch:`, or none), in one pass that ends lines at any prefix."""
    last = F.substring_index("value", "<", -1)
    prefix = F.when(F.contains("value", F.lit("<")) & last.rlike(r"\A([\w.-]+:)?\z"), last)
    counts = _lines(spark, path, f"{tag} ", glob).groupBy(F.col("_metadata.file_path").alias("path_"), prefix.alias("prefix")).agg(F.count("*").alias("n"))
    often = F.max_by("prefix", F.when(F.col("prefix").isNotNull(), F.struct("n", "prefix")))
    return counts.groupBy("path_").agg(F.coalesce(often, F.lit("")).alias("prefix"))


def _as_given(spark: SparkSession, path: str) -> str:
    """A file's URI as a path for a reader, which would take some characters for patterns."""
    jvm = spark.sparkContext._jvm
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)).toString())


def scan_records(spark: SparkSession, path: str, tag: str = ROW_TAG, glob: str | None = None, prefix: str | None = None, encoding: str | None = None) -> DataFrame:
    """(path_, block_, row_, record_xml, error): records of all files below path.

    By ORDER the rows of a file are in the order they have in it. Each file is cut where tags
    with the prefix of most of its records open (or with `prefix`, if it is given); records
    with other prefixes, opened by other white space or without attributes are found as
    well, in one task with the record before them. A record that has no end is a row with an
    error instead of its text, and so are bytes that aren't in `encoding`, if one is given
    (otherwise files are UTF-8). Files without records give no rows. The XML stays as it is,
    unknown elements included.
    """
    if prefix is not None:
        return _scan(spark, path, tag, glob, prefix, encoding)
    files: dict[str, list[str]] = {}
    for r in record_prefixes(spark, path, tag, glob).collect():
        files.setdefault(r.prefix, []).append(_as_given(spark, r.path_))
    scans = [_scan(spark, paths, tag, None, p, encoding) for p, paths in files.items()] or [_scan(spark, path, tag, glob, "", encoding)]
    return functools.reduce(DataFrame.unionByName, scans)


def _scan(spark: SparkSession, path: str | Sequence[str], tag: str, glob: str | None, prefix: str, encoding: str | None) -> DataFrame:
    """The records of files that are cut at one prefix."""
    opening = f"<{prefix}{tag} "
    name = rf"(?:[\w.-]+:)?{re.escape(tag)}"
    whole = rf"(?s)<{name}(?=[\s>/])(?:[^>]*/>|.*?</{name}\s*>)"
    value = F.col("value") if encoding is None else F.try_validate_utf8(F.decode(F.col("value").cast("binary"), encoding))
    # what stands before the first record of a file opens with a tag, never with attributes
    text = F.when(F.col("value").rlike(r"^﻿?\s*(<|$)"), value).otherwise(F.concat(F.lit(opening), value))
    lines = _lines(spark, path, opening, glob).select(F.col("_metadata.file_path").alias("path_"), F.col("_metadata.file_block_start").alias("block_"), text.alias("text"))
    found = F.regexp_extract_all("text", F.lit(whole), F.lit(0))
    begun = F.regexp_count("text", F.lit(rf"<{name}[\s>/]"))
    row = lambda xml, error: F.struct(xml.alias("record_xml"), error.alias("error"))
    none = F.lit(None).cast("string")
    cut_off = F.when(begun > F.size("found"), F.array(row(none, F.lit("the record is cut off"))))
    rows = F.concat(F.transform("found", lambda x: row(x, none)), F.coalesce(cut_off, F.array().cast("array<struct<record_xml:string,error:string>>")))
    records = lines.withColumn("found", found).select("path_", "block_", F.explode(rows).alias("r"))
    return records.select("path_", "block_", F.monotonically_increasing_id().alias("row_"), "r.record_xml", "r.error")


def with_ordinals(records: DataFrame, name: str = "ordinal") -> DataFrame:
    """A scan's rows with their place in their file, from 1 on; they are stored once, and one count for each range of bytes is summed up."""
    kept = stored(records.withColumn("task_", F.shiftright("row_", 33)), "scan")
    return with_place(kept, "row_", ["path_", "block_", "task_"], name).drop("task_")
