"""Entities as a table: as many as there are, joined to the records that refer to them.

xml.read_entities and xml.decode_entities are for sets that fit into every task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patentlake.operators.ranking import stored
from patentlake.sources.xml import OWN_ENTITIES, declarations_in

_REFERENCE = r"&([A-Za-z_][\w.:-]*);"


def _names(text: Column) -> Column:
    """Names that a text refers to, in order."""
    return F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1))


def _filled(text: Column, texts: Column) -> Column:
    """A text with the references that the map has replaced, in one pass; others stay."""
    shown = lambda part, name: F.concat(part, F.coalesce(F.try_element_at(texts, name), F.concat(F.lit("&"), name, F.lit(";")), F.lit("")))
    return F.array_join(F.zip_with(F.split(text, _REFERENCE, -1), _names(text), shown), "")


def declared(spark: SparkSession, path: str) -> DataFrame:
    """(name, raw) of entities in declaration files (DTDs); the first declaration of a name counts, by file and place. A file is read whole by one task."""

    def run(it: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for file, text in zip(pdf["path"], pdf["value"], strict=True):
                yield pd.DataFrame([(file, k, *found) for k, found in enumerate(declarations_in(text))], columns=["path", "k", "name", "raw"])

    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    every = files.mapInPandas(run, "path string, k long, name string, raw string")
    return every.groupBy("name").agg(F.min_by("raw", F.struct("path", "k")).alias("raw"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """(name, text) of declared entities, those inside them resolved by a join for each level.

    An entity that leads back to itself is an error. References to unknown names stay.
    """
    every = stored(declared(spark, path), "declared")
    refers = every.select("name", F.explode(F.array_distinct(_names(F.col("raw")))).alias("inside"))
    todo = stored(refers.join(every.select(F.col("name").alias("inside")), "inside", "left_semi"), "inside")
    done = every.join(todo, "name", "left_anti").select("name", F.col("raw").alias("text"))
    while not todo.isEmpty():
        texts = todo.join(done.select(F.col("name").alias("inside"), "text"), "inside", "left").groupBy("name")
        ready = texts.agg(F.count_if(F.col("text").isNull()).alias("open"), F.map_from_entries(F.collect_list(F.struct("inside", "text"))).alias("texts")).where("open = 0")
        new = stored(every.join(ready, "name").select("name", _filled(F.col("raw"), F.col("texts")).alias("text")), "level")
        if new.isEmpty():
            raise ValueError(f"the entity {todo.agg(F.min('name')).first()[0]} leads back to itself or to one that does")
        todo, done = stored(todo.join(new, "name", "left_anti"), "inside"), done.unionByName(new)
    return done


def decode(rows: DataFrame, xml: str, table: DataFrame) -> DataFrame:
    """Rows with the entities of a table in the column `xml` replaced by their text, in one pass; the five of XML and unknown ones stay."""
    kept = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "referring")
    refers = kept.select("_row", F.explode(F.array_distinct(_names(F.col(xml)))).alias("name")).where(~F.col("name").isin(*OWN_ENTITIES))
    texts = refers.join(table, "name").groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("name", "text"))).alias("_texts"))
    filled = F.when(F.col("_texts").isNotNull(), _filled(F.col(xml), F.col("_texts"))).otherwise(F.col(xml))
    return kept.join(texts, "_row", "left").withColumn(xml, filled).select(*rows.columns)
