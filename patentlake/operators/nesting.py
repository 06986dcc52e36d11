"""Child rows into nested arrays and back, representation picks and flat exports.

A group is one record's children, so it is as large as a record, not as the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nest(children: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], name: str) -> DataFrame:
    """One row a key with an array of structs in the given order."""
    return children.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, *(f for f in fields if f not in order)))).alias(name))


def unnest(parents: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return parents.select(*keys, F.explode(name).alias("_c")).select(*keys, "_c.*")


def unnest_positions(parents: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return parents.select(*keys, F.posexplode(name).alias("at", "_c")).select(*keys, "at", "_c.*")


def best_format(rows: DataFrame, keys: Sequence[str], fmt: str, position: str, ranks: Mapping[str, int]) -> DataFrame:
    """Per keys the row of the most preferred format; ties go to the first position. Reduced before its one shuffle."""
    rank = F.coalesce(F.create_map(*(F.lit(x) for kv in ranks.items() for x in kv))[F.col(fmt)], F.lit(0))
    rest = [c for c in rows.columns if c not in keys]
    best = rows.where(F.col(fmt).isin(*ranks)).groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(rank, -F.col(position))).alias("_b"))
    return best.select(*keys, "_b.*")


def keep_first(rows: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    """First row of each key by position."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*position)).alias("_f")).select(*keys, "_f.*")


def distinct_within(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Non-empty values of each key, each once."""
    return rows.where(F.coalesce(F.col(value), F.lit("")) != "").select(*keys, value).distinct()


def by_role(parties: Column, roles: Mapping[str, str]) -> Column:
    """Struct with an array for each role of the party_type field."""
    return F.struct(*(F.filter(parties, _has_role(role)).alias(name) for name, role in roles.items()))


def _has_role(role: str):
    return lambda p: p["party_type"] == role


def nested_passages(rows: DataFrame, keys: Sequence[str], citation: str, passage_order: str, fields: Sequence[str]) -> DataFrame:
    """Two levels: citations of a record, passages of a citation."""
    inner = nest(rows, [*keys, citation], [passage_order], fields, "passages")
    return inner.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(citation, "passages"))).alias("citations"))


def summary(parties: Column, label, sep: str = " | ") -> Column:
    return F.array_join(F.transform(parties, label), sep)


def union_tagged(parts: Mapping[str, DataFrame], tag: str = "role") -> DataFrame:
    out = None
    for name, df in parts.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out

