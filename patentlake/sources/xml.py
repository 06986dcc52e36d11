"""XML sources: record scan, package index, entities.

ignoreNamespace reads prefixed and bare spellings alike; prefixes of element names in
string columns are taken off before from_xml for the same effect.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

ROW_TAG = "exchange-document"

_DOC_ID = "struct<`_doc-id`:string,country:string,`doc-number`:string,kind:string,date:string,name:string>"
_PARTY = "array<struct<`_data-format`:string,_sequence:string,{0}:struct<name:string,country:string,text:string>,name:string,country:string,text:string,residence:struct<country:string>,address:struct<text:string,country:string>>>"

RECORD = (
    "`_country` string, `_doc-number` string, `_kind` string, `_date-publ` string, `_doc-id` string, `_family-id` string, `_status` string, "
    "`_is-representative` string, `_originating-office` string, `_date-added-docdb` string, `_date-of-last-exchange` string, "
    "`bibliographic-data` struct<"
    f"`application-reference`:array<struct<`_data-format`:string,`_doc-id`:string,`document-id`:{_DOC_ID}>>,"
    f"`priority-claims`:struct<`priority-claim`:array<struct<`_data-format`:string,_sequence:string,`document-id`:{_DOC_ID},`priority-linkage-type`:string,`priority-active-indicator`:string>>>,"
    f"parties:struct<applicants:struct<applicant:{_PARTY.format('`applicant-name`')}>,inventors:struct<inventor:{_PARTY.format('`inventor-name`')}>>,"
    # blocks with children of any name stay XML
    "`designation-of-states`:struct<`designation-epc`:string,`designation-pct`:string>,"
    "`patent-classifications`:struct<`patent-classification`:array<struct<_scheme:string,_sequence:string,`_group-number`:string,`_rank-number`:string,`classification-scheme`:struct<_scheme:string,_VALUE:string>,`classification-symbol`:string,text:string,`classification-value`:string,`symbol-position`:string,`generating-office`:string>>>,"
    f"`references-cited`:struct<citation:array<struct<`_cited-phase`:string,_sequence:string,`_srep-office`:string,patcit:struct<`_dnum-type`:string,`document-id`:{_DOC_ID}>,nplcit:struct<`_npl-type`:string,`_extracted-xp`:string,text:string>,`rel-passage`:array<struct<category:string,`rel-claims`:string,passage:string>>>>>,"
    "`dates-of-public-availability`:string,"
    "`invention-title`:array<struct<_lang:string,`_data-format`:string,_VALUE:array<string>>>>, "
    "abstract array<struct<_lang:string,`_data-format`:string,`_abstract-source`:string,p:array<string>>>"
)


def _element(field: StructField) -> bool:
    return not field.name.startswith("_")


def _many(kind: DataType) -> DataType:
    """The type with an array in place of every element that may come once, so that none is lost in parsing."""
    if isinstance(kind, ArrayType):
        return ArrayType(_many(kind.elementType))
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, ArrayType(_many(f.dataType)) if _element(f) and not isinstance(f.dataType, ArrayType) else _many(f.dataType)) for f in kind])
    return kind


def _first_of(value: Column, kind: DataType, read: DataType | None = None) -> Column:
    """A value of the type _many(read) as one of kind: of elements that came several times the first; fields that weren't read are null."""
    read = kind if read is None else read
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _first_of(x, kind.elementType, read.elementType)) if isinstance(kind.elementType, ArrayType | StructType) else value
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*(_field(lambda f: value[f.name], f, read).alias(f.name) for f in kind)))
    return value


def _field(of: Callable[[StructField], Column], f: StructField, read: StructType) -> Column:
    if f.name not in read.names:
        return F.lit(None).cast(f.dataType)
    return _first_of(F.get(of(f), F.lit(0)) if _element(f) and not isinstance(f.dataType, ArrayType) else of(f), f.dataType, read[f.name].dataType)


def _firsts(rows: DataFrame, schema: StructType, keep: tuple[str, ...], read: StructType | None = None) -> DataFrame:
    """Rows parsed by _many(read), in the columns of schema."""
    return rows.select(*keep, *(_field(lambda f: F.col(f"`{f.name}`"), f, schema if read is None else read).alias(f.name) for f in schema))


def _of(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_records(spark: SparkSession, path: str, row_tag: str = ROW_TAG, schema: str = RECORD, glob: str | None = None) -> DataFrame:
    """One row for each record element of XML files; `path_` is the file it came from.

    Order and unknown fields are lost: record_scan.scan_records keeps them. Of elements
    that the schema has once the first counts.
    """
    reader = spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", True).option("ignoreSurroundingSpaces", False).option("recursiveFileLookup", True).schema(_many(_of(schema)))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _firsts(reader.load(path).withColumn("path_", F.col("_metadata.file_path")), _of(schema), ("path_",)).select(*(F.col(f"`{f.name}`") for f in _of(schema)), "path_")


def bare_tags(xml: Column) -> Column:
    """Element names without their prefixes. Texts without a colon, which a search for bytes tells, are left alone."""
    return F.when(F.contains(xml, F.lit(":")), F.regexp_replace(xml, r"<(/?)[A-Za-z_][\w.-]*:", "<$1")).otherwise(xml)


def escaped(text: Column) -> Column:
    """Text as it may stand in an element, or in an attribute between double quotes."""
    for char, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot")):
        text = F.replace(text, F.lit(char), F.lit(f"&{name};"))
    return text


def leaf(name: str, text: Column) -> Column:
    """An element that holds escaped text; null without one."""
    return F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>"))


def element(name: str, attributes: Mapping[str, Column], *inside: Column) -> Column:
    """An element with its attributes, whose texts are escaped, and what it holds: texts of elements or arrays of them. Nulls are left out."""
    said = (F.concat(F.lit(f' {n}="'), value, F.lit('"')) for n, value in attributes.items())
    return F.concat_ws("", F.lit(f"<{name}"), *said, F.lit(">"), *inside, F.lit(f"</{name}>"))


_DECLARED = re.compile(r"<!ENTITY\s+([\w.:-]+)\s+(?:\"([^\"]*)\"|'([^']*)')\s*>")
_REFERENCE = re.compile(r"&([A-Za-z_][\w.:-]*);")
_CHARACTER = re.compile(r"&#(?:x([0-9A-Fa-f]+)|([0-9]+));")
# The entities of XML itself, which the parser knows.
OWN_ENTITIES = ("amp", "lt", "gt", "quot", "apos")


def declarations_in(text: str) -> Iterator[tuple[str, str]]:
    """(name, text) of the entities that a file declares, in order, with characters for their numbers."""
    for name, one, two in _DECLARED.findall(re.sub(r"(?s)<!--.*?-->", "", text)):
        yield name, _CHARACTER.sub(lambda m: chr(int(m[1], 16) if m[1] else int(m[2])), one or two)


def entity_set(declarations: str) -> dict[str, str]:
    """Texts of declared entities, those inside them resolved; the first declaration of a name counts.

    An entity that leads back to itself is an error. References to unknown names stay.
    """
    raw: dict[str, str] = {}
    for name, text in declarations_in(declarations):
        raw.setdefault(name, text)
    out: dict[str, str] = {}
    for name in raw:
        todo = [(name, False)]
        open_: set[str] = set()
        while todo:  # without recursion: chains may be long
            at, inside_done = todo.pop()
            if at in out:
                continue
            if inside_done:
                open_.discard(at)
                out[at] = _REFERENCE.sub(lambda m: out.get(m[1], m[0]), raw[at])
                continue
            if at in open_:
                raise ValueError(f"the entity {at} leads back to itself")
            open_.add(at)
            todo.append((at, True))
            inside = [x for x in dict.fromkeys(_REFERENCE.findall(raw[at])) if x in raw and x not in out]
            if back := next((x for x in inside if x in open_), None):
                raise ValueError(f"the entity {back} leads back to itself")
            todo += [(x, False) for x in inside]
    return out


def read_entities(spark: SparkSession, path: str) -> dict[str, str]:
    """Entities of declaration files (DTDs), which are small, in the order of their names."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path")).collect()
    return entity_set("\n".join(r.value for r in sorted(files, key=lambda r: r.path)))


def decode_entities(xml: Column, entities: Mapping[str, str]) -> Column:
    """Custom entities replaced by their text, before parsing, in one pass however many there are; the five of XML and unknown ones stay."""
    known = {k: v for k, v in entities.items() if k not in OWN_ENTITIES}

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: _REFERENCE.sub(lambda m: known.get(m[1], m[0]), t), na_action="ignore")

    # texts with no reference but XML's own stay in the JVM
    return F.when(xml.rlike(rf"&(?!(?:{'|'.join(OWN_ENTITIES)});)[A-Za-z_]"), run(xml)).otherwise(xml) if known else xml


def parse_records(rows: DataFrame, xml: str, schema: str | StructType = RECORD, keep: tuple[str, ...] = (), read: StructType | None = None) -> DataFrame:
    """Records from a column of XML strings, which stay beside them as record_xml, without element prefixes.

    Of elements that the schema has once the first counts. With `read`, a part of the
    schema, nothing else is parsed and its other fields are null.
    """
    bare = rows.select(*keep, bare_tags(F.col(xml)).alias("record_xml"))
    # by inline, which is evaluated once: a struct would be parsed again for each use of one of its fields
    parsed = bare.select(*keep, "record_xml", F.inline(F.array(F.from_xml("record_xml", _many(_of(schema) if read is None else read), {"ignoreSurroundingSpaces": "false"}))))
    # and again, so that the firsts are picked once and not for each use
    firsts = _firsts(parsed, _of(schema), (*keep, "record_xml"), read)
    return firsts.select(F.inline(F.array(F.struct("*"))))


def read_index(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """(filename, path) of a package index; the stated location is ignored, empty names are dropped."""
    files = spark.read.format("xml").option("rowTag", "docdb-package-file").option("ignoreNamespace", True).schema("filename string").load(path)
    return index_paths(files, F.lit(folder))


def index_paths(files: DataFrame, folder: Column) -> DataFrame:
    named = files.withColumn("filename", F.trim("filename")).where(F.coalesce(F.col("filename"), F.lit("")) != "")
    return named.withColumn("path", F.concat_ws("/", folder, F.lit("DOC"), F.col("filename")))
