"""A table as a log of versions.

Below its folder lie data files that are never changed and `_versions/N.json`, one manifest
for each version: keys, order columns, number of buckets, schema, and for each part (a
bucket of a country) the folder of its base and those of the changes since. A version
exists when its manifest does, which is put there by one rename that fails if another
writer was first; readers of a version are never disturbed, and what a broken writer left
behind is in no manifest.

Columns may be indexed: (value, part) pairs in buckets of the value. A merge adds those of its
changes, and a lookup reads one bucket and then only parts that can hold the value.

A merge writes the last change of each key, to the parts that it touches alone. A part whose
changes are many or large against its base is compacted, in a version of its own. Rows of
deleted keys stay, marked, so that older changes that come later don't bring them back.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from patentlake.functions.scalars import DELETE_STATUSES, country_partition
from patentlake.operators.cdc import latest_per_key
from patentlake.sources.shared import children, exists, read_text, remove, rename_new, size_of, write_text

#: a part is compacted when its changes have this share of the bytes of its base, or came in so many merges
COMPACT_SHARE, COMPACT_MERGES = 0.25, 8
INDEX_SLOTS = 64
_GONE = "_gone"


class Conflict(Exception):
    """Another writer committed the version first; nothing was changed, the merge can be run again."""


class VersionedTable:
    """The table at a path; `create` makes one. Every method works on the newest version unless told another."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        if not self.versions():
            raise ValueError(f"there is no table at {path}")

    @classmethod
    def create(cls, spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int = 64, indexes: Sequence[str] = ()) -> VersionedTable:
        """A table of rows, one for each key; order columns that they lack are null, which is earlier than any change.

        With a column `country` it is partitioned by country_part (K1's ten) as well as by
        buckets. Where the path holds a table, that is opened if it has the same layout,
        rows being ignored; another layout is an error.
        """
        table = cls.__new__(cls)
        table.spark, table.path = spark, path.rstrip("/")
        if table.versions():
            m = table.manifest()
            if (m["keys"], m["order"], m["buckets"]) != (list(keys), list(order), buckets):
                raise ValueError(f"the table at {path} has keys {m['keys']}, order {m['order']} and {m['buckets']} buckets")
            return table
        table._create(rows, keys, order, buckets, indexes)
        return table

    def _create(self, rows: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int, indexes: Sequence[str]) -> None:
        for c in (_GONE, "country_part", "bucket"):
            if c in rows.columns:
                raise ValueError(f"a column must not be called {c}")
        if absent := [c for c in order if c not in rows.columns]:
            raise ValueError(f"rows lack the order columns {absent}; add them, null if they are not known")
        m = {"version": 0, "keys": list(keys), "order": list(order), "buckets": buckets, "columns": rows.columns, "schema": json.loads(rows.withColumn(_GONE, F.lit(False)).schema.json()), "parts": {}, "batches": {}, "indexes": {c: [] for c in indexes}}
        parts = self._write(rows.withColumn(_GONE, F.lit(False)), m)
        self._add_to_indexes(m, parts)
        m["parts"] = {p: {"base": folder, "bytes": size, "deltas": [], "delta_bytes": 0} for p, (folder, size) in parts.items()}
        self._commit(m)

    # --- the log ---

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in children(self.spark, f"{self.path}/_versions") if re.fullmatch(r"\d+\.json", n))

    def manifest(self, version: int | None = None) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/_versions/{max(self.versions()) if version is None else version:010d}.json"))

    def _commit(self, manifest: dict) -> None:
        draft = f"{self.path}/_versions/.{uuid.uuid4().hex}"
        write_text(self.spark, draft, json.dumps(manifest))
        try:
            rename_new(self.spark, draft, f"{self.path}/_versions/{manifest['version']:010d}.json")
        except Py4JJavaError as e:
            remove(self.spark, draft)
            raise Conflict(f"version {manifest['version']} of {self.path} is there already") from e

    # --- data ---

    def _routed(self, rows: DataFrame, manifest: Mapping) -> tuple[DataFrame, list[str]]:
        rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*manifest["keys"]), F.lit(manifest["buckets"])).cast("int"))
        if "country" not in manifest["columns"]:
            return rows, ["bucket"]
        return rows.withColumn("country_part", country_partition(F.col("country"))), ["country_part", "bucket"]

    def _write(self, rows: DataFrame, manifest: Mapping) -> dict[str, tuple[str, int]]:
        """Write rows to a new folder; {part: (folder, bytes)} of what was written. Sorted by key, so that statistics prune lookups."""
        folder = f"data/{uuid.uuid4().hex}"
        routed, by = self._routed(rows, manifest)
        routed.hint("rebalance", *by).sortWithinPartitions(*by, *manifest["keys"]).write.partitionBy(*by).parquet(f"{self.path}/{folder}")
        found = [folder]
        for c in by:
            found = [f"{f}/{n}" for f in found for n in children(self.spark, f"{self.path}/{f}") if n.startswith(f"{c}=")]
        return {f.removeprefix(f"{folder}/"): (f, size_of(self.spark, f"{self.path}/{f}")) for f in found}

    def _add_to_indexes(self, manifest: dict, parts: Mapping[str, tuple[str, int]]) -> None:
        """Write (value, part) of what was just written; pairs that are there already do no harm."""
        if not parts or not manifest["indexes"]:
            return
        top = next(iter(parts.values()))[0].split("/")[1]
        by = [p.split("=")[0] for p in next(iter(parts)).split("/")]
        read = self.spark.read.schema(StructType.fromJson(manifest["schema"])).option("basePath", f"{self.path}/data/{top}").parquet(f"{self.path}/data/{top}")
        written, _ = self._routed(read.select(*manifest["columns"]), manifest)
        name = F.concat_ws("/", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in by))
        for column, folders in manifest["indexes"].items():
            folder = f"index/{uuid.uuid4().hex}"
            pairs = written.select(F.col(column).cast("string").alias("value"), name.alias("part")).where("value IS NOT NULL").distinct()
            pairs.withColumn("slot", self._slot(F.col("value"))).repartition("slot").sortWithinPartitions("slot", "value").write.partitionBy("slot").parquet(f"{self.path}/{folder}")
            folders.append(folder)

    @staticmethod
    def _slot(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(INDEX_SLOTS)).cast("int")

    def _indexed(self, manifest: Mapping, column: str, values: Sequence[str]) -> list[str]:
        """Parts that can hold one of the values."""
        slots = [r[0] for r in self.spark.createDataFrame([(v,) for v in values], "v string").select(self._slot(F.col("v"))).distinct().collect()] if values else []
        found = [f"{self.path}/{f}/slot={k}" for f in manifest["indexes"][column] for k in slots if exists(self.spark, f"{self.path}/{f}/slot={k}")]
        if not found:
            return []
        return [r[0] for r in self.spark.read.schema("value string, part string").parquet(*found).where(F.col("value").isin(*values)).select("part").distinct().collect()]

    def _files(self, manifest: Mapping, folders: Sequence[str]) -> DataFrame:
        reader = self.spark.read.schema(StructType.fromJson(manifest["schema"]))
        return reader.parquet(*(f"{self.path}/{f}" for f in folders)) if folders else self.spark.createDataFrame([], StructType.fromJson(manifest["schema"]))

    def _state(self, manifest: Mapping, parts: Sequence[str]) -> DataFrame:
        """The last row of each key in some parts, deleted ones marked. Parts without changes are read as they are."""
        plain = [manifest["parts"][p] for p in parts if not manifest["parts"][p]["deltas"]]
        out = self._files(manifest, [p["base"] for p in plain if p["base"]])
        changed = [manifest["parts"][p] for p in parts if manifest["parts"][p]["deltas"]]
        if not changed:
            return out
        # of equal ones the later merge wins
        layers = [self._files(manifest, [p["base"] for p in changed if p["base"]]).withColumn("_merge", F.lit(0))]
        for k in range(max(len(p["deltas"]) for p in changed)):
            layers.append(self._files(manifest, [p["deltas"][k] for p in changed if k < len(p["deltas"])]).withColumn("_merge", F.lit(k + 1)))
        every = layers[0]
        for layer in layers[1:]:
            every = every.unionByName(layer)
        return out.unionByName(latest_per_key(every, manifest["keys"], [*manifest["order"], "_merge"]).drop("_merge"))

    def read(self, version: int | None = None, countries: Sequence[str] | None = None, where: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
        """The rows of a version; with countries, or values of indexed columns (as text) in `where`, only the parts that can hold them are read."""
        m = self.manifest(version)
        known = sorted(m["parts"])
        if countries is not None and "country" in m["columns"]:
            named = {r[0] for r in self.spark.createDataFrame([(c,) for c in countries], "c string").select(country_partition(F.col("c"))).collect()} if countries else set()
            known = [p for p in known if p.split("/")[0].partition("=")[2] in named]
        for column, values in (where or {}).items():
            able = set(self._indexed(m, column, values))
            known = [p for p in known if p in able]
        rows = self._state(m, known).where(f"NOT {_GONE}").select(*m["columns"])
        for column, values in (where or {}).items():
            rows = rows.where(F.col(column).cast("string").isin(*values))
        return rows if countries is None or "country" not in m["columns"] else rows.where(F.col("country").isin(*countries))

    # --- changes ---

    def merge(self, changes: DataFrame, status: str = "source_status", now: Column | None = None, batch: tuple[str, int] | None = None, buckets: int | None = None) -> int:
        """Apply changes; returns the version that has them.

        A change counts only if it isn't earlier by the order columns than what is stored
        for its key. batch names a source and the number of its batch: one that was merged
        before is not merged again. With `now`, created_at (kept from what is stored) and
        updated_at are stamped. No changes, no version. buckets, if given, must be the table's.
        """
        m = self.manifest()
        if buckets is not None and buckets != m["buckets"]:
            raise ValueError(f"the table has {m['buckets']} buckets, not {buckets}")
        if batch is not None and m["batches"].get(batch[0], -1) >= batch[1]:
            return m["version"]
        last = latest_per_key(changes, m["keys"], m["order"])
        rows = last.withColumn(_GONE, F.coalesce(F.col(status).isin(*DELETE_STATUSES), F.lit(False)))
        if now is not None:
            rows = self._stamped(rows, m, now)
        parts = self._write(rows.select(*m["columns"], _GONE), m)
        if not parts and batch is None:
            return m["version"]
        self._add_to_indexes(m, parts)
        for p, (folder, size) in parts.items():
            part = m["parts"].setdefault(p, {"base": None, "bytes": 0, "deltas": [], "delta_bytes": 0})
            part["deltas"].append(folder)
            part["delta_bytes"] += size
        if batch is not None:
            m["batches"][batch[0]] = batch[1]
        m["version"] += 1
        self._commit(m)
        return m["version"]

    def _stamped(self, rows: DataFrame, manifest: Mapping, now: Column) -> DataFrame:
        routed, by = self._routed(rows.select(*manifest["keys"], *(["country"] if "country" in manifest["columns"] and "country" not in manifest["keys"] else [])), manifest)
        touched = ["/".join(f"{c}={r[c]}" for c in by) for r in routed.select(*by).distinct().collect()]  # ten countries times buckets at most
        stored = self._state(manifest, [p for p in touched if p in manifest["parts"]]).where(f"NOT {_GONE}")
        born = stored.select(*manifest["keys"], F.col("created_at").alias("_born"))
        stamped = rows.drop("created_at", "updated_at").join(born, manifest["keys"], "left")
        return stamped.withColumn("created_at", F.coalesce("_born", now)).withColumn("updated_at", now).drop("_born")

    def due(self, share: float = COMPACT_SHARE, merges: int = COMPACT_MERGES) -> list[str]:
        """Parts that ask for compaction."""
        return [p for p, x in self.manifest()["parts"].items() if x["deltas"] and (len(x["deltas"]) >= merges or x["delta_bytes"] > share * x["bytes"])]

    def compact(self, parts: Sequence[str] | None = None) -> int:
        """Merge the changes of parts (those that are due) into new bases; the rows stay the same."""
        m = self.manifest()
        parts = self.due() if parts is None else [p for p in parts if p in m["parts"] and m["parts"][p]["deltas"]]
        if not parts:
            return m["version"]
        written = self._write(self._state(m, parts), m)
        for p in parts:
            folder, size = written.get(p, (None, 0))
            m["parts"][p] = {"base": folder, "bytes": size, "deltas": [], "delta_bytes": 0}
        m["version"] += 1
        self._commit(m)
        return m["version"]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove versions but the newest `keep`, and folders that no version left names. No writer and no reader of older versions may be at work."""
        old, left = self.versions()[:-keep], self.versions()[-keep:]
        named = {f.split("/")[1] for v in left for p in self.manifest(v)["parts"].values() for f in [p["base"], *p["deltas"]] if f}
        for v in old:
            remove(self.spark, f"{self.path}/_versions/{v:010d}.json")
        gone = [n for n in children(self.spark, f"{self.path}/data") if n not in named]
        for n in gone:
            remove(self.spark, f"{self.path}/data/{n}")
        kept = {f for v in left for folders in self.manifest(v)["indexes"].values() for f in folders}
        for n in children(self.spark, f"{self.path}/index"):
            if f"index/{n}" not in kept:
                remove(self.spark, f"{self.path}/index/{n}")
        return gone


def is_table(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/_versions")
