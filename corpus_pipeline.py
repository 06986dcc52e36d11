"""A corpus from `documents`: good, distinct, uncontaminated, redacted and encoded texts.

Every stage works on all rows that its predecessor kept, and returns the columns of
`documents` (the last one: ids and digests). The stages are written as Parquet and read
again between each other.

In every stage a null text is an empty one and stays null, rows with a null id are
documents of their own, repeated rows are each decided alike (of near copies the one of
least id stays, so rows that repeat it stay too), and an empty table gives an empty one.
Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentlake.llm import bpe, decontaminate, minhash, pii, quality
from patentlake.llm._io import written


def _table(docs: DataFrame, sf_dir: str, name: str) -> DataFrame:
    return docs.sparkSession.read.parquet(f"{sf_dir}/{name}.parquet")


def _through(docs: DataFrame, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What an operator keeps of docs, as docs has it: columns but id and text pass under names that no operator uses."""
    aside = {c: f"_column_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return operator(docs.withColumnsRenamed(aside)).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; without a trusted positive in `labels` nothing is rejected."""
    return _through(docs, lambda d: quality.classify(d, _table(docs, sf_dir, "labels")).where("predicted = 1"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: five words, similarity 0.8. Texts without words are all kept."""
    return _through(docs, lambda d: minhash.near_duplicates(d).where("kept"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold too much of the benchmark; an empty benchmark drops nothing."""
    return _through(docs, lambda d: decontaminate.contamination(d, _table(docs, sf_dir, "benchmark")).where(~F.col("contaminated")))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in place of personal data; n_chars, if there is one, follows the text."""
    out = _through(docs, lambda d: pii.find_pii(d).withColumn("text", F.col("redacted")))
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, with the digests of ids and of what they decode to."""
    return bpe.digests(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_distinct),
    ("decontamination", drop_contaminated),
    ("pii", redact),
    ("byte_bpe", encode),
]

#: no SQL expresses the classifier
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
