"""Statistics of files and tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_BLOCK = 1_000_000_000


def first_last(rows: DataFrame, file: str, order: str, value: str) -> DataFrame:
    return rows.groupBy(file).agg(F.min_by(value, order).alias("first_doc"), F.max_by(value, order).alias("last_doc"), F.count("*").alias("n_documents"))


def run_summary(files: DataFrame, failed: Column, documents: str) -> DataFrame:
    bad = F.coalesce(failed, F.lit(False))
    return files.agg(F.count("*").alias("files"), F.sum((~bad).cast("long")).alias("successful"), F.sum(bad.cast("long")).alias("with_errors"), F.sum(documents).alias("documents"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def surrogate_offset(target: DataFrame, target_id: str, rows: DataFrame, *ids: str) -> DataFrame:
    """Ids of rows moved past all of target's: by the next whole block. The offset is a scalar subquery."""
    last = F.coalesce(F.max(target_id), F.lit(0))
    offset = target.agg(((F.floor(last / ID_BLOCK) + 1) * ID_BLOCK).cast("long").alias("offset")).scalar()
    return rows.select(*((F.col(c) + offset).alias(c) if c in ids else F.col(c) for c in rows.columns))


def families(publications: DataFrame) -> DataFrame:
    return publications.groupBy("family_id").agg(F.count("*").alias("n_members"), F.count_distinct("country").alias("n_countries"))


def combination_sets(rows: DataFrame, keys: list[str], group: str, rank: str, symbol: str) -> DataFrame:
    """Symbols of each combination in rank order."""
    sets = rows.groupBy(*keys, group).agg(F.array_sort(F.collect_list(F.struct(rank, symbol))).alias("_s"))
    return sets.select(*keys, group, F.array_join(F.col(f"_s.{symbol}"), " + ").alias("combination"))
