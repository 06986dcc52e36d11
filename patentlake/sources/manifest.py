"""Delivery manifests in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "deliveries array<struct<deliveryId:long,files:array<struct<fileId:long,fileName:string>>>>"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path)


def delivery_files(manifest: DataFrame, delivery: Column | int | None = None) -> DataFrame:
    """(delivery_id, file_id, filename) of one delivery, or of all; none if it isn't there."""
    each = manifest.select(F.explode("deliveries").alias("d")).select(F.col("d.deliveryId").alias("delivery_id"), F.col("d.files").alias("files"))
    if delivery is not None:
        each = each.where(F.col("delivery_id") == delivery)
    return each.select("delivery_id", F.explode("files").alias("f")).select("delivery_id", F.col("f.fileId").alias("file_id"), F.col("f.fileName").alias("filename"))


def prefilter_search(raw: DataFrame, column: str, contains: tuple[str, ...], exact: Column) -> DataFrame:
    """Rows that hold all strings, by a cheap test on raw text, and then meet the exact one."""
    for text in contains:
        raw = raw.where(F.col(column).contains(text))
    return raw.where(exact)


def first_match(raw: DataFrame, column: str, contains: tuple[str, ...], exact: Column, order: tuple[str, ...]) -> DataFrame:
    """The first of these rows in a total order, or none: each task keeps one."""
    return prefilter_search(raw, column, contains, exact).orderBy(*order).limit(1)
