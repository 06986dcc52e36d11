"""Change feeds: last change of each key, deletes, upserts, and the ledgers of files.

Keys are shuffled as a whole, (country, id) and not country alone, so that a country with
most of the rows doesn't land in one task; the collapse sums up before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patentlake.functions.scalars import DELETE_STATUSES


def latest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by `order`, as max_by: reduced before its one shuffle (by sorting, as rows are structs).

    order must be total within a key; null keys form a key. The columns stay as they are.
    """
    rest = [c for c in changes.columns if c not in keys]
    by = F.struct(*order)
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_last"))
    return last.select(*(c if c in keys else F.col(f"_last.`{c}`").alias(c) for c in changes.columns))


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "stage_seq") -> DataFrame:
    """1-based position of each row within its keys."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def split_changes(latest: DataFrame, status: str = "source_status") -> tuple[DataFrame, DataFrame]:
    """(deletes, rows to keep); a null status is kept."""
    gone = F.coalesce(F.col(status).isin(*DELETE_STATUSES), F.lit(False))
    return latest.where(gone), latest.where(~gone)


def delete_using(target: DataFrame, deletes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(deletes.select(*keys), list(keys), "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of source replace those of equal key; columns in `keep` stay as the target has them."""
    if keep:
        old = target.select(*keys, *(F.col(c).alias(f"_{c}") for c in keep))
        source = source.join(old, list(keys), "left").select(*(F.coalesce(f"_{c}", c).alias(c) if c in keep else c for c in source.columns))
    return delete_using(target, source, keys).unionByName(source, allowMissingColumns=True)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], status: str = "source_status", now: Column | None = None) -> DataFrame:
    """Collapse changes, remove deleted keys, upsert the others. Running it again changes nothing.

    With `now` the target's columns created_at (when a key first came, kept) and updated_at are stamped.
    """
    deletes, rows = split_changes(latest_per_key(changes, keys, order), status)
    if now is not None:
        born = target.select(*keys, F.col("created_at").alias("_born"))
        rows = rows.drop("created_at", "updated_at").join(born, list(keys), "left")
        rows = rows.withColumn("created_at", F.coalesce("_born", now)).withColumn("updated_at", now).drop("_born")
    touched = deletes.select(*keys).unionByName(rows.select(*keys))
    return target.join(touched, list(keys), "left_anti").unionByName(rows.select(*target.columns))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.join(target.select(*keys), list(keys), "left_anti")


def append_absent(target: DataFrame, source: DataFrame, columns: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
    """target and the projected rows of source; with keys, only those whose key is new."""
    rows = source.select(*columns)
    if keys:
        rows = insert_if_absent(target, rows, keys)
    return target.select(*columns).unionByName(rows)


def route_voids(rows: DataFrame, void: Column) -> tuple[DataFrame, DataFrame]:
    """(records, void stubs): stubs go to a side output rather than into the table."""
    return rows.where(~void), rows.where(void)


def sync_manifest(ledger: DataFrame, files: DataFrame, key: str = "file_id") -> DataFrame:
    """New files as PENDING; rows that exist stay untouched."""
    new = insert_if_absent(ledger, files, [key]).withColumn("status", F.lit("PENDING"))
    return ledger.unionByName(new.select(*ledger.columns))


def actionable(ledger: DataFrame) -> DataFrame:
    return ledger.where(~F.col("status").isin("COMPLETED", "FAILED"))


def to_retry(ledger: DataFrame, retry_failed: bool) -> DataFrame:
    """Without completed files; failed ones only for a retry, as PENDING again."""
    left = ledger.where(F.col("status") != "COMPLETED")
    if not retry_failed:
        return left.where(F.col("status") != "FAILED")
    return left.withColumn("status", F.when(F.col("status") == "FAILED", "PENDING").otherwise(F.col("status")))


def completed_from(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Status COMPLETED on rows of target that source has as completed."""
    done = source.where(F.col("status") == "COMPLETED").select(key).distinct().withColumn("_done", F.lit(True))
    joined = target.join(done, key, "left")
    return joined.withColumn("status", F.when(F.col("_done"), "COMPLETED").otherwise(F.col("status"))).select(*target.columns)


def ledger_upsert(target: DataFrame, source: DataFrame, key: str, overwrite: Sequence[str]) -> DataFrame:
    """All keys of both; `overwrite` columns from source where it has the key, others from the target first."""
    names = [c for c in target.columns if c != key]
    s = source.select(key, F.lit(True).alias("_in"), *(F.col(c).alias(f"_{c}") for c in names))
    joined = target.join(s, key, "full_outer")
    return joined.select(key, *(F.when(F.col("_in"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in overwrite else F.coalesce(c, f"_{c}").alias(c) for c in names))


def ledger_update(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Overwrite columns of updates by key; keys that the target lacks do nothing."""
    names = [c for c in updates.columns if c != key]
    u = updates.select(key, *(F.col(c).alias(f"_{c}") for c in names))
    return target.join(u, key, "left").select(*(F.coalesce(f"_{c}", c).alias(c) if c in names else F.col(c) for c in target.columns))


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Keys in both whose columns differ, found by comparing hashes."""
    digest = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    a, b = (d.select(*keys, digest.alias(n)) for d, n in ((old, "_old"), (new, "_new")))
    return a.join(b, list(keys)).where("_old <> _new").select(*keys)


def sliced(rows: DataFrame, order: Sequence[str], start: int = 1, count: int | None = None) -> DataFrame:
    """Rows from 1-based `start` on; none if that is past the end."""
    out = rows.orderBy(*order).offset(max(start, 1) - 1)
    return out if count is None else out.limit(count)
