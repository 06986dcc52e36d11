"""Scalar expressions on columns; all built from JVM functions."""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kinds that mark a granted patent; statuses of void records and of deletions.
GRANT_KINDS = ("B1", "B2", "B3", "C", "C1", "C2", "E")
VOID_STATUSES = ("CV", "DV")
DELETE_STATUSES = ("D", "DV", "V")
# How much each parallel representation is preferred.
FORMAT_RANK = {"docdb": 3, "docdba": 2, "original": 1}
# Countries with a partition of their own.
COUNTRIES = ("US", "EP", "WO", "CN", "JP", "KR", "DE", "GB", "FR")


def empty_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def parse_date(c: Column) -> Column:
    """yyyyMMdd, else yyyy-MM-dd, else null."""
    compact, dashed = F.try_to_timestamp(c, F.lit("yyyyMMdd")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))
    # at most one of them fits; one that doesn't costs an exception, so the likelier comes first
    return F.when(F.contains(c, F.lit("-")), F.coalesce(dashed, compact)).otherwise(F.coalesce(compact, dashed)).cast("date")


def any_case(*words: str) -> list[str]:
    """All spellings whose upper case is one of these upper-case words: to be looked up in, which costs less than the upper case of each row."""
    letters = lambda w: ((x, x.lower(), *("ſ" if x == "S" else "")) for x in w)
    return ["".join(p) for w in words for p in itertools.product(*letters(w))]


def yes_no(c: Column) -> Column:
    """Y: true, N: false, anything else: null."""
    return F.when(c == "Y", True).when(c == "N", False)


def representative(c: Column) -> Column:
    return F.coalesce(c.isin(*any_case("YES")), F.lit(False))


def is_grant(kind: Column, granted_dates: Column | None = None) -> Column:
    """By kind, or because a printed-with-grant date exists."""
    by_kind = F.coalesce(kind.isin(*GRANT_KINDS), F.lit(False))
    return by_kind if granted_dates is None else by_kind | (F.coalesce(F.size(granted_dates), F.lit(0)) > 0)


def is_void(status: Column) -> Column:
    return F.coalesce(status.isin(*any_case(*VOID_STATUSES)), F.lit(False))


def display_number(country: Column, number: Column, kind: Column) -> Column:
    return F.concat(*(F.coalesce(c, F.lit("")) for c in (country, number, kind)))


def document_id(doc_id: Column, country: Column, number: Column, kind: Column) -> Column:
    """The id, or the display number where it is missing or empty."""
    return F.coalesce(empty_to_null(doc_id), display_number(country, number, kind))


def split_number(raw: Column) -> tuple[Column, Column, Column]:
    """Country, number and kind of a written number; without a country, all of it is the number."""
    s = F.upper(F.trim(raw))
    country = empty_to_null(F.regexp_extract(s, "^([A-Z]{2})", 1))
    rest = F.substring(s, 3, 1 << 30)
    kind = empty_to_null(F.regexp_extract(rest, "([A-Z][0-9]?[A-Z]?)$", 1))
    number = F.when(kind.isNull(), rest).otherwise(F.left(rest, F.length(rest) - F.length(kind)))
    return country, F.when(country.isNull(), s).otherwise(number), F.when(country.isNotNull(), kind)


def truncated(c: Column, size: int = 400, mark: str = "…") -> Column:
    return F.when(F.length(c) > size, F.concat(F.substring(c, 1, size), F.lit(mark))).otherwise(c)


def archive_rank(filename: Column) -> Column:
    """Deletions and new keys first, then creations, then amendments, then others."""
    return F.when(filename.contains("DeleteRekey"), 1).when(filename.contains("CreateDelete"), 2).when(filename.contains("Amend"), 3).otherwise(4)


def country_partition(country: Column) -> Column:
    c = empty_to_null(F.upper(F.trim(country)))
    return F.when(c.isin(*COUNTRIES), c).otherwise("default")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def int_or_zero(c: Column) -> Column:
    """0 where missing; text that is no number is an error under ANSI rules."""
    return F.coalesce(c, F.lit("0")).cast("int")


def int_or_null(c: Column) -> Column:
    return c.try_cast("int")


def shown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("—"))


def shown_flag(c: Column) -> Column:
    return F.when(c, "YES").otherwise("No")


def party_label(name: Column, residence: Column) -> Column:
    return F.when(empty_to_null(residence).isNotNull(), F.concat(name, F.lit(" ["), residence, F.lit("]"))).otherwise(name)


def citation_label(kind: Column, cited: Column, text: Column, size: int | None = None) -> Column:
    shown_text = F.coalesce(text, F.lit(""))
    return F.when(kind == "PATENT", F.concat(F.lit("PATENT "), cited)).otherwise(F.concat(F.lit("NPL "), F.substring(shown_text, 1, size) if size else shown_text))


def pick_title(titles: Column, lang: str = "en") -> Column:
    """Content of the first title in lang; if there is none or it is empty, of the first title; else ''."""
    first = lambda a: F.get(a, F.lit(0))["content"]
    return F.coalesce(empty_to_null(first(F.filter(titles, lambda t: t["lang"] == lang))), first(titles), F.lit(""))


def joined_paragraphs(paragraphs: Column) -> Column:
    """Paragraphs that aren't empty, as they are, one a line; null if there is none."""
    return empty_to_null(F.array_join(F.filter(paragraphs, lambda p: p != ""), "\n"))
