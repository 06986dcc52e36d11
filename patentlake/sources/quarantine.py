"""Two-way reading of records: good ones as wide rows, bad ones with their text and reasons.

Nothing that a record holds ends a job. What is wrong with it is found by expressions while
it is parsed, its block is left out of the typing, and both kinds are written in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentlake.operators.ranking import stored
from patentlake.sources.extract import wide_rows
from patentlake.sources.xml import RECORD, parse_records

_CORRUPT = "_corrupt_record"
_B = "bibliographic-data"
#: lists of a record whose elements have a sequence that must be a number
NUMBERED = {
    "priority-claim": ("priority-claims", "priority-claim"),
    "applicant": ("parties", "applicants", "applicant"),
    "inventor": ("parties", "inventors", "inventor"),
    "patent-classification": ("patent-classifications", "patent-classification"),
    "citation": ("references-cited", "citation"),
}


def _bad_sequence(name: str, path: tuple[str, ...]) -> Column:
    at = F.col(f"`{_B}`")
    for step in path:
        at = at[step]
    bad = F.filter(F.transform(at, lambda x: x["_sequence"]), lambda x: x.isNotNull() & x.try_cast("int").isNull())
    first = F.get(bad, F.lit(0))
    return F.when(first.isNotNull(), F.concat(F.lit(f"sequence of {name} is no number: "), first))


def judged(rows: DataFrame, xml: str = "record_xml", error: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Records parsed, with `reasons`: why they are bad, empty for good ones. Columns in keep stay.

    Bad: an error of the scan, no text, XML that doesn't parse, a sequence that is no
    number. A bad record's bibliographic block is null, so that typing it can't fail.
    """
    carried = (*keep, *([error] if error else []))
    whole = rows.withColumn("_text", F.coalesce(F.col(xml), F.lit("")))
    parsed = parse_records(whole, "_text", f"{RECORD}, {_CORRUPT} string", carried)
    broken = F.when(F.col("record_xml") == "", F.lit("no text")).when(F.col(_CORRUPT).isNotNull(), F.lit("the XML doesn't parse"))
    said = F.col(error) if error else F.lit(None).cast("string")
    reasons = F.array_compact(F.array(F.coalesce(said, broken), *(_bad_sequence(n, p) for n, p in NUMBERED.items())))
    out = parsed.withColumn("reasons", reasons).drop(_CORRUPT, *([error] if error else []))
    return out.withColumn(_B, F.when(F.size("reasons") == 0, F.col(f"`{_B}`")))


def quarantine(rows: DataFrame, xml: str = "record_xml", error: str | None = None, keep: tuple[str, ...] = (), keep_void_stubs: bool = False) -> tuple[DataFrame, DataFrame]:
    """(wide rows of good records, bad ones as (keep..., reasons, record_xml)), from one pass that stores both.

    keep: columns that wide_rows carries on (where a record was found). A void record has
    no content to be judged by but its XML.
    """
    found = judged(rows, xml, error, keep)
    typed = wide_rows(found.withColumn("raw_xml", F.when(F.size("reasons") > 0, F.col("record_xml"))), keep_void_stubs)
    both = stored(typed, "judged")
    good = both.where(F.size("reasons") == 0).drop("reasons", "raw_xml")
    return good, both.where(F.size("reasons") > 0).select(*keep, "reasons", F.col("raw_xml").alias("record_xml"))


def file_outcomes(good: DataFrame, bad: DataFrame, file: str, most: float = 0.0) -> DataFrame:
    """(file, n_good, n_bad, status, error): FAILED where more than `most` of a file's records are bad, else COMPLETED. One file's outcome doesn't touch another's."""
    every = good.select(file, F.lit(None).cast("string").alias("reason")).unionByName(bad.select(file, F.get("reasons", F.lit(0)).alias("reason")))
    out = every.groupBy(file).agg(F.count_if(F.col("reason").isNull()).alias("n_good"), F.count("reason").alias("n_bad"), F.min("reason").alias("error"))
    failed = F.col("n_bad") > most * (F.col("n_good") + F.col("n_bad"))
    return out.select(file, "n_good", "n_bad", F.when(failed, "FAILED").otherwise("COMPLETED").alias("status"), F.when(failed, F.col("error")).alias("error"))
