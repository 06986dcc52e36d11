"""Unknown fields of open records: path rows, pruning rules, and what is left as JSON.

A record's open tree is exploded to (path, parent, key, value) rows, so that pruning is a
filter by expressions and statistics of names are plain aggregates.
"""

from __future__ import annotations

import functools
import json
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DEPTH = 50

# Attributes of a record's root that have columns of their own.
KNOWN_ATTRIBUTES = ("country", "doc-number", "kind", "date-publ", "doc-id", "family-id", "status", "system", "is-representative", "originating-office", "date-added-docdb", "date-of-last-exchange")
# Blocks whose content has columns of its own, wherever they stand.
HANDLED_KEYS = ("applicants", "inventors", "designation-epc", "designation-pct", "patent-classifications", "classifications-ipcr", "references-cited", "dates-of-public-availability", "abstract", "invention-title", "language-of-publication", "classification-ipc", "classification-national")
# Fixed values: (parent, key) pairs that have columns of their own.
HANDLED_PAIRS = {
    "document-id": ("country", "doc-number", "kind", "date", "name", "lang", "doc-id"),
    "publication-reference": ("data-format", "sequence"),
    "application-reference": ("data-format", "sequence", "is-representative", "doc-id"),
    "priority-claim": ("data-format", "sequence", "priority-active-indicator", "priority-linkage-type"),
    "applicant": ("sequence", "data-format"),
    "applicant-name": ("name",),
    "inventor": ("sequence", "data-format"),
    "inventor-name": ("name",),
    "classification-ipcr": ("sequence",),
}

PATHS = "path array<string>, parent string, key string, value string"


@functools.lru_cache(4096)
def _local(name: str) -> str:
    return name.rpartition("}")[2].rpartition(":")[2] if "}" in name or ":" in name else name


_TAKEN = {p: frozenset((*HANDLED_KEYS, *ks)) for p, ks in {**HANDLED_PAIRS, None: KNOWN_ATTRIBUTES}.items()}
_TAKEN_ANYWHERE = frozenset(HANDLED_KEYS)


def _taken(parent: str | None) -> frozenset[str]:
    """Names that a rule takes whole below an element of this name (None: the root); the rules are those of `prune`."""
    return _TAKEN.get(parent, _TAKEN_ANYWHERE)


def _none_taken(parent: str | None) -> frozenset[str]:
    return frozenset()


def _leaves(root: ElementTree.Element, taken: Callable[[str | None], frozenset[str]] = _none_taken) -> list[tuple[tuple[str, ...], str | None]]:
    """Leaves of an XML tree in order; `[k]` steps tell repeated names apart.

    Text between children is `#text` before the first and `name#tail` after the last child
    of that name that any follows. What lies more than MAX_DEPTH elements deep is null.
    Names that are `taken` aren't entered.
    """
    rows: list[tuple[tuple[str, ...], str | None]] = []
    _walk(root, None, (), 0, taken, rows)
    return rows


def _walk(node: ElementTree.Element, own: str | None, path: tuple[str, ...], depth: int, taken: Callable[[str | None], frozenset[str]], rows: list) -> None:
    if depth > MAX_DEPTH:
        rows.append((path, None))
        return
    out = taken(own)
    attributes, children = [*map(_local, node.attrib)], [_local(c.tag) for c in node]
    tails = {}
    if out.issuperset(attributes) and out.issuperset(children):  # nothing to enter, as in most elements
        for name, child in zip(children, node, strict=True):
            if child.tail and (tail := child.tail.strip()):
                tails[f"{name}#tail"] = tail
    else:
        _enter(node, attributes, children, path, depth, taken, out, tails, rows)
    for name, tail in tails.items():
        rows.append(((*path, name), tail))
    text = (node.text or "").strip()
    if text:
        rows.append(((*path, "#text") if attributes or children else path, text))
    elif not attributes and not children:
        rows.append((path, None))


def _enter(node: ElementTree.Element, attributes: list[str], children: list[str], path: tuple[str, ...], depth: int, taken: Callable[[str | None], frozenset[str]], out: frozenset[str], tails: dict[str, str], rows: list) -> None:
    """Leaves of an element's attributes and children that aren't in out; texts behind its children to tails."""
    names = attributes + children
    times = Counter(names) if len({*names}) < len(names) else None  # where a name comes again
    seen: Counter[str] | None = Counter() if times else None

    def step(name: str) -> tuple[str, ...]:
        if times is None or times[name] == 1:
            return (*path, name)
        seen[name] += 1
        return (*path, name, f"[{seen[name] - 1}]")

    for name, v in zip(attributes, node.attrib.values(), strict=True):
        if name not in out:
            rows.append((step(name), v))
    for name, child in zip(children, node, strict=True):
        if name not in out:
            if len(child) or child.attrib or depth == MAX_DEPTH:
                _walk(child, name, step(name), depth + 1, taken, rows)
            else:  # most elements hold text alone
                rows.append((step(name), (child.text or "").strip() or None))
        if child.tail and (tail := child.tail.strip()):
            tails[f"{name}#tail"] = tail


def xml_paths(records: DataFrame, record: str, xml: str, all_paths: bool = True) -> DataFrame:
    """Path rows of XML records, whose ids may be of any type; values stay text, empty elements are null, broken records give no rows.

    Without all_paths, blocks that the rules of `prune` take whole aren't walked: it keeps the same rows of either.
    """
    taken = {} if all_paths else {"taken": _taken}

    def run(it: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for rid, text in zip(pdf["record"], pdf["xml"], strict=True):
                try:
                    root = ElementTree.fromstring(text or "")
                except ElementTree.ParseError:
                    continue
                for path, value in _leaves(root, **taken):
                    steps = [p for p in path if not p.startswith("[")]
                    rows.append((rid, list(path), steps[-2] if len(steps) > 1 else None, steps[-1] if steps else None, value))
            yield pd.DataFrame(rows, columns=["record", "path", "parent", "key", "value"])

    rows = records.select(F.col(record).alias("record"), F.col(xml).alias("xml"))
    return rows.mapInPandas(run, f"record {rows.schema['record'].dataType.simpleString()}, {PATHS}")


def json_paths(records: DataFrame, record: str, payload: str) -> DataFrame:
    """Path rows of the top level of JSON objects, by JVM functions alone."""
    each = records.select(F.col(record).alias("record"), F.explode(F.from_json(payload, "map<string,string>")).alias("key", "value"))
    return each.select("record", F.array("key").alias("path"), F.lit(None).cast("string").alias("parent"), "key", "value")


def prune(paths: DataFrame, keys: Iterable[str] = HANDLED_KEYS, pairs: Mapping[str, Sequence[str]] = HANDLED_PAIRS, root: Iterable[str] = KNOWN_ATTRIBUTES) -> DataFrame:
    """Path rows that have a value and that no rule takes: a key anywhere, a key below its parent, a name at the top. By expressions, without a join."""
    steps = F.filter("path", lambda s: ~s.startswith("["))
    below = F.transform(F.sequence(F.lit(0), F.size(steps) - 2), lambda i: F.concat(steps[i], F.lit("\n"), steps[i + 1]))
    literal = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    taken = (
        F.arrays_overlap(steps, literal(keys))
        | F.when(F.size(steps) > 1, F.arrays_overlap(below, literal(f"{p}\n{k}" for p, ks in pairs.items() for k in ks))).otherwise(False)
        | F.coalesce(F.get(steps, F.lit(0)).isin(*root), F.lit(False))
    )
    return paths.where(F.col("value").isNotNull() & ~taken)


def without_keys(payload: Column, known: Iterable[str]) -> Column:
    """JSON object without known top-level keys; never null."""
    kept = F.map_filter(F.from_json(payload, "map<string,string>"), lambda k, _: ~k.isin(*known))
    return F.coalesce(F.to_json(kept), F.lit("{}"))


def extra_names(df: DataFrame, payload: str, known: Iterable[str]) -> DataFrame:
    """Rows with an unknown top-level name each."""
    return df.withColumn("field", F.explode(F.json_object_keys(payload))).where(~F.col("field").isin(*known))


def is_application_path(path: Column) -> Column:
    """Belongs to the application's extra data rather than the publication's."""
    return F.coalesce((F.get(path, F.lit(0)) == "bibliographic-data") & (F.get(path, F.lit(1)) == "application-reference"), F.lit(False))


def rebuild(paths: DataFrame) -> DataFrame:
    """(record, json): path rows as nested JSON again. A group is one record's paths."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"record": [pdf["record"].iloc[0]], "json": [_nested(zip(map(list, pdf["path"]), pdf["value"], strict=True))]})

    return paths.where(F.size("path") > 0).groupBy("record").applyInPandas(build, f"record {paths.schema['record'].dataType.simpleString()}, json string")


_TO_JSON = json.JSONEncoder(sort_keys=True, ensure_ascii=False).encode


def _nested(leaves: Iterable[tuple[Sequence[str], str | None]]) -> str:
    """(path, value) pairs as one JSON object."""
    tree: dict = {}
    for path, value in sorted(leaves, key=lambda x: [(int(s[1:-1]), "") if s.startswith("[") else (0, s) for s in x[0]]):
        at = tree
        for step in path[:-1]:
            at = at.setdefault(step, {})
        at[path[-1]] = None if value is None or value != value else value
    return _TO_JSON(_lists(tree)) if tree else "{}"


def _split_of(text: str | None) -> tuple[str, str]:
    """(application's, publication's) JSON of what an XML record holds beside known fields."""
    for prefixed in (False, True):
        try:
            root = ElementTree.fromstring(re.sub(r"(\s)[\w.-]+:([\w.-]+\s*=)", r"\1\2", text or "") if prefixed else text or "")
            break
        except ElementTree.ParseError:  # perhaps for a prefix that the record doesn't declare
            continue
    else:
        return "{}", "{}"
    left = [(p, v) for p, v in _leaves(root, taken=_taken) if p and v is not None]
    inside = lambda x: x[0][:2] == ("bibliographic-data", "application-reference")
    return _nested(filter(inside, left)), _nested(x for x in left if not inside(x))


# from the tag that opens such a block to the first that closes one of its name
_BLOCK = rf"(?s)<({'|'.join(HANDLED_KEYS)})(?:\s[^<>]*)?(?<!/)>.*?</\1\s*>"
_CLOSED = rf"</(?:{'|'.join(HANDLED_KEYS)})\s*>"


def _known(parent: str, inside: str = "") -> str:
    """Pattern of an element that holds nothing but attributes and texts that its pair rules take, and `inside`."""
    names = "|".join(HANDLED_PAIRS[parent])
    # few of each, as Java's patterns call themselves for every one
    return rf"""<{parent}(?:\s+(?:{names})="[^"<]*"){{0,16}}>(?:<({names})>[^<]*</\1>{inside}){{0,64}}</{parent}>"""


# an element of nothing but empty ones, which have no values
_EMPTY = r"<([\w.-]+)>(?:<[\w.-]+/>){1,64}</\1>"


def without_blocks(xml: Column) -> Column:
    """Well-formed records with an empty element in place of what the rules take whole, which leaves the same unknown fields.

    Texts where tags alone don't tell where a block ends stay whole: those with comments,
    CDATA or instructions, and those where such a block stands in one of its own name. So
    do those with entities that XML doesn't know.
    """
    short = F.regexp_replace(xml, _BLOCK, "<$1/>")
    for parent, inside in (("document-id", ""), ("priority-claim", "|<document-id/>"), ("application-reference", "|<document-id/>")):
        short = F.regexp_replace(short, _known(parent, inside), f"<{parent}/>")
    for _ in range(2):  # parts of the bibliographic data, then all of it
        short = F.regexp_replace(short, _EMPTY, "<$1/>")
    checked = F.get(F.transform(F.array(short), lambda s: F.when(s.rlike(_CLOSED), xml).otherwise(s)), F.lit(0))
    whole = F.contains(xml, F.lit("<!")) | F.contains(xml, F.lit("<?")) | F.contains(xml, F.lit("&")) & xml.rlike("&(?!(?:amp|lt|gt|quot|apos);)")
    return F.when(whole, xml).otherwise(checked)


def split_extra(xml: Column) -> Column:
    """Struct of app_extra_data and pub_extra_data (JSON objects, never null) of XML records without element prefixes."""

    @F.pandas_udf("app_extra_data string, pub_extra_data string")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_split_of(t) for t in texts], columns=["app_extra_data", "pub_extra_data"])

    return run(xml)


def _lists(x):
    if not isinstance(x, dict):
        return x
    if x and all(k.startswith("[") for k in x):
        return [_lists(x[k]) for k in sorted(x, key=lambda k: int(k[1:-1]))]
    return {k: _lists(v) for k, v in x.items()}
