"""Typed wide rows out of parsed records: the projections of a bibliographic record."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from patentlake.functions import scalars as S
from patentlake.operators.extra import split_extra, without_blocks
from patentlake.sources.xml import RECORD, parse_records

_B = "bibliographic-data"


# a child of a block that stayed XML: its name and what it holds, whatever prefixes there are
_CHILD = r"(?s)<(?:[\w.-]+:)?([\w.-]+)(?:\s[^>]*)?(?<!/)>(.*?)</(?:[\w.-]+:)?\1\s*>"


def _list(c: Column) -> Column:
    return F.coalesce(c, F.array())


def _held(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once, however often it stands in functions of other lists."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _children(block: Column) -> Column:
    """(name, content) of the children of a block of XML, in order; empty ones have nothing to give."""
    parts = [F.regexp_extract_all(block, F.lit(_CHILD), F.lit(k)) for k in (1, 2)]
    return F.when(block.isNotNull(), F.arrays_zip(parts[0].alias("name"), parts[1].alias("content")))


def _inner(content: Column, tag: str) -> Column:
    """Texts of the elements with this name inside a block of XML."""
    return F.regexp_extract_all(content, F.lit(rf"<(?:[\w.-]+:)?{tag}(?:\s[^>]*)?>([^<]*)</"), F.lit(1))


def _first(parties: Column, name: str) -> Column:
    """One party row; the name stands in its own element or bare."""
    return F.transform(
        parties,
        lambda p, i: F.struct(
            p["_data-format"].alias("format"),
            S.int_or_zero(p["_sequence"]).alias("sequence"),
            F.coalesce(p[f"{name}-name"]["name"], p["name"]).alias("name"),
            F.coalesce(p["residence"]["country"], p["country"], p[f"{name}-name"]["country"], p["address"]["country"]).alias("residence"),
            F.coalesce(p["address"]["text"], p["text"], p[f"{name}-name"]["text"]).alias("address_text"),
            i.alias("pos"),
        ),
    )


PARTIES = "array<struct<name:string,format:string,sequence:int,residence:string,address_text:string>>"


def _best(parties: Column) -> Column:
    """Named parties of known formats, the most preferred format of each sequence, in list order."""
    rank = lambda f: F.when(f == "docdb", 3).when(f == "docdba", 2).when(f == "original", 1).otherwise(0)
    usable = F.filter(parties, lambda p: (rank(p["format"]) > 0) & (F.coalesce(p["name"], F.lit("")) != ""))
    better = lambda a, b: (a["sequence"] == b["sequence"]) & ((rank(a["format"]) > rank(b["format"])) | ((rank(a["format"]) == rank(b["format"])) & (a["pos"] < b["pos"])))
    best = _held(usable, lambda u: F.filter(u, lambda p: ~F.exists(u, lambda q: better(q, p))))
    return F.transform(best, lambda p: F.struct(p["name"].alias("name"), p["format"].alias("format"), p["sequence"].alias("sequence"), p["residence"].alias("residence"), p["address_text"].alias("address_text")))


def _designations(treaty: str, block: Column) -> Column:
    """The different countries of each child of a treaty's block."""
    row = lambda kind: lambda c: F.struct(F.lit(treaty).alias("treaty_type"), kind.alias("designation_type"), F.lit(None).cast("string").alias("region_code"), c.alias("country_code"))
    of_child = lambda x: F.transform(F.array_distinct(F.filter(_inner(x["content"], "country"), lambda c: c != "")), row(x["name"]))
    return F.flatten(F.transform(_children(block), of_child))


def _id_of(d: Column) -> Column:
    return S.display_number(d["country"], d["doc-number"], d["kind"])


def wide_rows(records: DataFrame, keep_void_stubs: bool = False) -> DataFrame:
    """Wide rows of records parsed with xml.RECORD; void records are left out unless their stubs are asked for.

    Records with their record_xml (from xml.parse_records) also give app_extra_data and
    pub_extra_data: what they hold beside known fields, as JSON. Void stubs have none.
    """
    b = F.col(f"`{_B}`")
    root = {c: F.col(f"`_{c}`") for c in ("country", "doc-number", "kind", "date-publ", "doc-id", "family-id", "status", "is-representative", "originating-office", "date-added-docdb", "date-of-last-exchange")}
    country, number, kind = (F.coalesce(root[c], F.lit("")) for c in ("country", "doc-number", "kind"))
    void = S.is_void(root["status"])
    pub = F.when(void, F.concat(F.lit("VOID_"), country, number, kind)).otherwise(S.document_id(root["doc-id"], country, number, kind))

    refs = _list(b["application-reference"])
    usable = F.filter(refs, lambda r: (r["_data-format"] == "docdb") & (r["document-id"].isNotNull() | (F.coalesce(r["_doc-id"], F.lit("")) != "")))
    ref = F.get(usable, F.lit(0))
    at = ref["document-id"]
    none = F.size(usable) == 0
    app_id = F.when(void, F.concat(F.lit("VOID_"), country, number)).when(none, F.concat(F.lit("UNKNOWN_"), pub)).otherwise(F.coalesce(S.empty_to_null(ref["_doc-id"]), _id_of(at)))
    app_country = F.when(void, country).when(none, F.lit("XX")).otherwise(F.when(at.isNull(), country).otherwise(F.coalesce(at["country"], F.lit(""))))
    app_number = F.when(void, number).when(none, F.lit("UNKNOWN")).otherwise(F.coalesce(at["doc-number"], F.lit("")))

    claims = F.filter(_list(b["priority-claims"]["priority-claim"]), lambda p: (p["_data-format"] == "docdb") & p["document-id"].isNotNull())
    claims = F.transform(
        claims,
        lambda p, i: F.struct(
            p["_data-format"].alias("format_type"), S.int_or_zero(p["_sequence"]).alias("sequence"), p["document-id"]["_doc-id"].alias("priority_doc_id"),
            p["document-id"]["country"].alias("country"), p["document-id"]["doc-number"].alias("doc_number"), S.parse_date(p["document-id"]["date"]).alias("priority_date"),
            p["priority-linkage-type"].alias("linkage_type"), S.yes_no(p["priority-active-indicator"]).alias("is_active"), i.alias("pos"),
        ),
    )
    same = lambda p, q: (p["sequence"] == q["sequence"]) & p["country"].eqNullSafe(q["country"]) & p["doc_number"].eqNullSafe(q["doc_number"])
    firsts = _held(claims, lambda all_: F.filter(all_, lambda p: ~F.exists(all_, lambda q: same(p, q) & (q["pos"] < p["pos"]))))
    priorities = F.transform(firsts, lambda p: p.dropFields("pos"))

    designations = F.concat(*(_list(_designations(t.upper(), b["designation-of-states"][f"designation-{t}"])) for t in ("epc", "pct")))
    symbol = lambda c: F.trim(F.coalesce(S.empty_to_null(c["classification-symbol"]), c["text"]))
    classifications = F.transform(
        F.filter(_list(b["patent-classifications"]["patent-classification"]), lambda c: F.coalesce(symbol(c), F.lit("")) != ""),
        lambda c: F.struct(
            F.coalesce(S.empty_to_null(c["classification-scheme"]["_scheme"]), c["_scheme"], F.lit("")).alias("scheme_name"), S.int_or_zero(c["_sequence"]).alias("sequence"), S.int_or_null(c["_group-number"]).alias("group_number"), S.int_or_null(c["_rank-number"]).alias("rank_number"),
            symbol(c).alias("symbol"), c["classification-value"].alias("class_value"), c["symbol-position"].alias("symbol_pos"), c["generating-office"].alias("generating_office"),
        ),
    )
    citations = F.transform(
        _list(b["references-cited"]["citation"]),
        lambda c: F.struct(
            c["_cited-phase"].alias("cited_phase"), S.int_or_zero(c["_sequence"]).alias("sequence"), c["_srep-office"].alias("srep_office"),
            F.when(c["patcit"].isNotNull(), "PATENT").when(c["nplcit"].isNotNull(), "NPL").otherwise("UNKNOWN").alias("citation_type"),
            F.when(c["patcit"]["document-id"].isNotNull(), _id_of(c["patcit"]["document-id"])).alias("cited_doc_id"), c["patcit"]["_dnum-type"].alias("dnum_type"),
            c["nplcit"]["_npl-type"].alias("npl_type"), c["nplcit"]["_extracted-xp"].alias("extracted_xp"), F.lit(None).cast("string").alias("opponent_name"), c["nplcit"]["text"].alias("citation_text"),
            F.transform(_list(c["rel-passage"]), lambda r: F.struct(r["category"].alias("category"), r["rel-claims"].alias("rel_claims"), r["passage"].alias("passage_text"))).alias("passages"),
        ),
    )
    said = F.transform(_list(_children(b["dates-of-public-availability"])), lambda x: F.struct(x["name"].alias("name"), F.get(_inner(x["content"], "date"), F.lit(0)).alias("date")))
    dated = F.transform(said, lambda x: F.struct(x["name"].alias("availability_type"), S.parse_date(x["date"]).alias("availability_date")))
    dates = F.filter(dated, lambda d: d["availability_date"].isNotNull())
    text = lambda kind, lang, fmt, source, content: F.struct(F.lit(kind).alias("text_type"), lang.alias("lang"), fmt.alias("format_type"), source.alias("source"), content.alias("content"))
    titles = F.transform(_list(b["invention-title"]), lambda t: text("TITLE", t["_lang"], t["_data-format"], F.lit(None).cast("string"), F.trim(F.get(t["_VALUE"], F.lit(0)))))
    abstracts = F.transform(_list(F.col("abstract")), lambda a: text("ABSTRACT", a["_lang"], a["_data-format"], a["_abstract-source"], S.joined_paragraphs(_list(a["p"]))))
    texts = F.filter(F.concat(abstracts, titles), lambda t: F.coalesce(t["content"], F.lit("")) != "")

    granted = F.coalesce(b["dates-of-public-availability"].rlike(r"<(?:[\w.-]+:)?printed-with-grant[\s/>]"), F.lit(False))
    rows = records if keep_void_stubs else records.where(~void)
    extra = [c for c in records.columns if c in ("path_", "block_", "row_", "ordinal", "path", "member", "doc_seq", "delivery", "archive_rank", "file_no", "reasons", "raw_xml")]
    if "record_xml" in records.columns:
        # an attribute that was read shows that the record is well-formed
        read = F.coalesce(*root.values()).isNotNull()
        rows = rows.withColumn("_open", split_extra(F.when(read, without_blocks(F.col("record_xml"))).otherwise(F.col("record_xml"))))
        extra += [F.when(void, "{}").otherwise(F.col(f"_open.{c}")).alias(c) for c in ("app_extra_data", "pub_extra_data")]
    return rows.select(
        country.alias("country"), pub.alias("pub_doc_id"), number.alias("doc_number"), kind.alias("kind_code"), F.lit(None).cast("string").alias("extended_kind"), root["family-id"].alias("family_id"), root["originating-office"].alias("originating_office"),
        S.parse_date(root["date-publ"]).alias("date_publ"), S.parse_date(root["date-added-docdb"]).alias("date_added_docdb"), S.parse_date(root["date-of-last-exchange"]).alias("date_last_exchange"),
        S.representative(root["is-representative"]).alias("is_representative"), (S.is_grant(kind) | granted).alias("is_grant"),
        app_id.alias("app_doc_id"), app_country.alias("app_country"), app_number.alias("app_number"), at["kind"].alias("app_kind_code"), S.parse_date(at["date"]).alias("app_date"),
        F.when(void, "SKIP").otherwise(F.coalesce(root["status"], F.lit("C"))).alias("source_status"),
        F.struct(_best(_first(_list(b["parties"]["applicants"]["applicant"]), "applicant")).alias("applicants"), _best(_first(_list(b["parties"]["inventors"]["inventor"]), "inventor")).alias("inventors"), F.array().cast(PARTIES).alias("others")).alias("parties"),
        priorities.alias("priorities"), classifications.alias("classifications"), citations.alias("citations"), texts.alias("texts"), designations.alias("designations"), dates.alias("availability_dates"), *extra,
    )


# What columns of wide rows are made from, beside the root's attributes: children of the bibliographic data, and the abstract.
_MADE_FROM = {
    **dict.fromkeys(("app_doc_id", "app_country", "app_number", "app_kind_code", "app_date"), ("application-reference",)),
    "parties": ("parties",), "priorities": ("priority-claims",), "classifications": ("patent-classifications",), "citations": ("references-cited",), "designations": ("designation-of-states",),
    "availability_dates": ("dates-of-public-availability",), "is_grant": ("dates-of-public-availability",), "texts": ("invention-title", "abstract"),
}


def wide_columns(rows: DataFrame, xml: str, *columns: str) -> DataFrame:
    """Some columns of the wide rows of a column of XML, of every record that isn't void.

    Each record is read to its end, but only blocks that these columns are made from are
    parsed into fields; what is odd in another block doesn't matter here.
    """
    schema = StructType.fromDDL(RECORD)
    needed = {block for c in columns for block in _MADE_FROM.get(c, ())}
    blocks = schema[_B].dataType
    parsed = StructType([f for f in schema if f.name.startswith("_") or f.name in needed])
    if inside := [f for f in blocks if f.name in needed]:
        parsed.add(StructField(_B, StructType(inside)))
    records = parse_records(rows, xml, parsed)
    # the others are there, and null, for wide_rows to name
    of = lambda f: F.col(f"`{_B}`")[f.name] if f.name in needed else F.lit(None).cast(f.dataType)
    whole = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in parsed.names}
    records = records.withColumns(whole | {_B: F.struct(*(of(f).alias(f.name) for f in blocks))})
    open_ = {"app_extra_data", "pub_extra_data"} & set(columns)
    wide = wide_rows(records if open_ else records.drop("record_xml"))
    # by inline, so that they are made once and not for each use
    return wide.select(F.inline(F.array(F.struct(*columns))))


# What the number of rows of such a column depends on.
_COUNTED = {
    "priorities": "struct<`priority-claim`:array<struct<`_data-format`:string,_sequence:string,`document-id`:struct<`_doc-id`:string,country:string,`doc-number`:string>>>>",
    "classifications": "struct<`patent-classification`:array<struct<`classification-symbol`:string,text:string>>>",
    "citations": "struct<citation:array<struct<_sequence:string>>>",
}


def wide_blocks(rows: DataFrame, xml: str, *blocks: str, counted: tuple[str, ...] = ()) -> DataFrame:
    """Wide rows of a column of XML with all columns but unknown fields, of which those made from other blocks than these columns are null.

    As with wide_columns, only these blocks are parsed. Of columns that are `counted` the
    number of rows is right, and what they hold isn't.
    """
    schema, short = StructType.fromDDL(RECORD), {_MADE_FROM[c][0]: StructType.fromDDL(f"x {_COUNTED[c]}")["x"].dataType for c in counted}
    asked = {block for c in (*blocks, *counted) for block in _MADE_FROM[c]}
    read = StructType([f for f in schema if f.name.startswith("_") or f.name in asked])
    read.add(StructField(_B, StructType([StructField(f.name, short.get(f.name, f.dataType)) for f in schema[_B].dataType if f.name in asked])))
    wide = wide_rows(parse_records(rows, xml, read=read).drop("record_xml"))
    has = [c for c in wide.columns if asked.issuperset(_MADE_FROM.get(c, ()))]
    # by inline, so that they are made once and not for each use
    made = wide.select(F.inline(F.array(F.struct(*has))))
    return made.select(*(F.col(f.name) if f.name in has else F.lit(None).cast(f.dataType).alias(f.name) for f in wide.schema))
