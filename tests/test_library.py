"""Invariants of the merge, sources from files, and the open tree."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from patentlake.functions import scalars as S
from patentlake.operators import cdc, extra, nesting
from patentlake.sources import archives, extract, manifest, sinks, versions, xml
from patentlake.streaming import ingest

KEYS = ["country", "pub_doc_id"]

RECORD = """<exch:exchange-document country="US" doc-number="123456" kind="B1" date-publ="20200101" doc-id="9" family-id="7" status="C" is-representative="YES">
<exch:bibliographic-data>
<exch:application-reference data-format="docdb" doc-id="55"><document-id><country>US</country><doc-number>999</doc-number><kind>A</kind><date>20190102</date></document-id></exch:application-reference>
<exch:priority-claims>
<exch:priority-claim data-format="docdb" sequence="1"><document-id doc-id="1"><country>FR</country><doc-number>5</doc-number><date>20180101</date></document-id><exch:priority-active-indicator>Y</exch:priority-active-indicator></exch:priority-claim>
<exch:priority-claim data-format="docdb" sequence="1"><document-id doc-id="2"><country>FR</country><doc-number>5</doc-number></document-id></exch:priority-claim>
<exch:priority-claim data-format="original" sequence="2"><document-id><country>DE</country></document-id></exch:priority-claim>
</exch:priority-claims>
<exch:parties><exch:applicants>
<exch:applicant data-format="original" sequence="1"><exch:applicant-name><name>Acme Original</name></exch:applicant-name></exch:applicant>
<exch:applicant data-format="docdb" sequence="1"><exch:applicant-name><name>ACME</name></exch:applicant-name><residence><country>US</country></residence></exch:applicant>
</exch:applicants></exch:parties>
<exch:invention-title lang="en">A <b>bold</b> title</exch:invention-title>
<exch:references-cited><exch:citation cited-phase="SEA" sequence="1"><patcit dnum-type="x"><document-id><country>EP</country><doc-number>1</doc-number><kind>A1</kind></document-id></patcit><rel-passage><category>X</category><rel-claims>1</rel-claims></rel-passage></exch:citation></exch:references-cited>
</exch:bibliographic-data>
<exch:abstract lang="en"><p> one </p><p></p><p>two</p></exch:abstract>
</exch:exchange-document>"""
VOID = '<exch:exchange-document country="US" doc-number="8" kind="A1" status="cv"/>'
FILE = f'<exch:exchange-documents xmlns:exch="urn:x">{RECORD}{VOID}</exch:exchange-documents>'


def changes(spark, rows):
    return spark.createDataFrame(rows, "country string, pub_doc_id string, seq long, source_status string, v string")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_batches_compose_and_repeat(spark):
    empty = changes(spark, [])
    a = changes(spark, [("US", "1", 1, "C", "a"), ("US", "2", 2, "C", "b"), ("EP", "1", 3, "C", "c"), ("US", "1", 4, "A", "d")])
    b = changes(spark, [("US", "2", 5, "D", None), ("EP", "1", 6, "A", "e"), ("US", "3", 7, "D", None), ("US", "4", 8, None, "n")])
    one = cdc.apply_changes(cdc.apply_changes(empty, a, KEYS, ["seq"]), b, KEYS, ["seq"])
    both = cdc.apply_changes(empty, a.unionByName(b), KEYS, ["seq"])
    again = cdc.apply_changes(one, b, KEYS, ["seq"])
    assert rows_of(one) == rows_of(both) == rows_of(again)
    assert [r[3:] for r in rows_of(one)] == [("A", "e"), ("A", "d"), (None, "n")]


def test_upsert_keeps_created(spark):
    old = spark.createDataFrame([(1, "x", 10), (2, "y", 20)], "k long, v string, created long")
    new = spark.createDataFrame([(2, "z", 99), (3, "w", 99)], "k long, v string, created long")
    assert rows_of(cdc.upsert(old, new, ["k"], keep=["created"])) == [(1, "x", 10), (2, "z", 20), (3, "w", 99)]


def test_nest_and_unnest_are_inverse(spark):
    rows = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, None)], "k string, pos int, v string")
    assert rows_of(nesting.unnest(nesting.nest(rows, ["k"], ["pos"], ["v"], "c"), ["k"], "c")) == rows_of(rows)


def check_wide(row):
    assert (row.pub_doc_id, row.family_id, row.is_grant, row.is_representative, str(row.date_publ)) == ("9", "7", True, True, "2020-01-01")
    assert (row.app_doc_id, row.app_number, str(row.app_date)) == ("55", "999", "2019-01-02")
    assert [(p.name, p.format, p.residence) for p in row.parties.applicants] == [("ACME", "docdb", "US")]
    assert [(p.priority_doc_id, p.is_active) for p in row.priorities] == [("1", True)]
    assert [(t.text_type, t.content) for t in row.texts] == [("ABSTRACT", " one \ntwo"), ("TITLE", "A")]
    assert [(c.citation_type, c.cited_doc_id, c.passages[0].category) for c in row.citations] == [("PATENT", "EP1A1", "X")]


def test_records_from_xml_file(spark, tmp_path):
    (tmp_path / "a.xml").write_text(FILE)
    records = xml.read_records(spark, f"file://{tmp_path}", glob="*.xml")
    wide = extract.wide_rows(records).collect()
    assert len(wide) == 1
    check_wide(wide[0])
    stubs = extract.wide_rows(records, keep_void_stubs=True).where("source_status = 'SKIP'").collect()
    assert [(s.pub_doc_id, s.app_doc_id) for s in stubs] == [("VOID_US8A1", "VOID_US8")]


def test_records_from_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "Amend-1.zip", "w") as z:
        z.writestr("x.xml", FILE)
    with zipfile.ZipFile(tmp_path / "Outer.zip", "w") as z:
        z.write(tmp_path / "Amend-1.zip", "inner.zip")
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("readme.txt", "-")
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    rows = archives.read_archives(spark, f"file://{tmp_path}")
    assert rows.where("error is not null").count() == 1
    good = rows.where("error is null")
    assert good.count() == 4
    wide = extract.wide_rows(xml.parse_records(good, "record_xml", keep=("path", "doc_seq"))).collect()
    assert len(wide) == 2
    for row in wide:
        check_wide(row)
    ranks = {r.filename: r.archive_rank for r in archives.find_archives(spark, f"file://{tmp_path}").collect()}
    assert ranks["Amend-1.zip"] == 3 and ranks["bad.zip"] == 4


def test_index_and_manifest(spark, tmp_path):
    (tmp_path / "index.xml").write_text("<i><docdb-package-file><filename> a.zip </filename></docdb-package-file><docdb-package-file><filename/></docdb-package-file></i>")
    assert rows_of(xml.read_index(spark, f"file://{tmp_path}/index.xml", "/d")) == [("a.zip", "/d/DOC/a.zip")]
    (tmp_path / "m.json").write_text(json.dumps({"deliveries": [{"deliveryId": 1, "files": [{"fileId": 5, "fileName": "x"}]}, {"deliveryId": 2, "files": []}]}))
    m = manifest.read_manifest(spark, f"file://{tmp_path}/m.json")
    assert rows_of(manifest.delivery_files(m, 1)) == [(1, 5, "x")] and manifest.delivery_files(m, 3).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<lot><colour>red</colour><weight unit='kg'>7</weight></lot>", {"colour": "red", "weight": {"unit": "kg", "#text": "7"}}),
        ("<lot><bid>5</bid>then<bid>9</bid> sold <!-- late --></lot>", {"bid": ["5", "9"], "bid#tail": "sold"}),
        ("<lot>intro<b>x</b>middle<i/>end</lot>", {"#text": "intro", "b": "x", "b#tail": "middle", "i": None, "i#tail": "end"}),
        ("<lot bid='1'><bid>2</bid><bid s='t'/></lot>", {"bid": ["1", "2", {"s": "t"}]}),
        ("<q:lot xmlns:q='urn:q' q:no='4'><q:room><q:shelf/></q:room></q:lot>", {"no": "4", "room": {"shelf": None}}),
    ],
)
def test_open_tree(spark, text, want):
    df = spark.createDataFrame([(1, text)], "id long, x string")
    got = extra.rebuild(extra.xml_paths(df, "id", "x")).collect()
    assert json.loads(got[0].json) == want


def test_pruning_rules(spark):
    """A name at the top, a key anywhere, a key below its parent, all with what they hold; empty leaves; the same names elsewhere stay."""
    text = """<r kind='x' colour='blue'><bibliographic-data><publication-reference sequence='1' shelf='2'><document-id><date>9</date><doc-number><part>4</part></doc-number><era>old</era></document-id>
    </publication-reference><box><date>kept</date><sequence>3</sequence><applicants><name>gone</name></applicants></box><void/><box/></bibliographic-data><status><deep>gone</deep></status></r>"""
    want = {"colour": "blue", "bibliographic-data": {"publication-reference": {"shelf": "2", "document-id": {"era": "old"}}, "box": [{"date": "kept", "sequence": "3"}]}}
    paths = extra.xml_paths(spark.createDataFrame([(1, text)], "id long, x string"), "id", "x")
    left = extra.rebuild(extra.prune(paths)).collect()[0].json
    both = spark.createDataFrame([(text,)], "x string").select(extra.split_extra(F.col("x")).alias("x")).select("x.*").first()
    assert json.loads(left) == want == json.loads(both.pub_extra_data) and both.app_extra_data == "{}"


def test_depth_counts_elements(spark):
    """50 elements below the root are kept, what lies deeper is null; broken and missing records give nothing."""
    nested = lambda n: "<r>" + "<l>" * n + "x" + "</l>" * n + "</r>"
    df = spark.createDataFrame([(1, nested(50)), (2, nested(51)), (3, "<r>"), (4, None)], "id long, x string")
    got = {r.record: (len(r.path), r.value) for r in extra.xml_paths(df, "id", "x").collect()}
    assert got == {1: (50, "x"), 2: (51, None)}


def test_scalars(spark):
    df = spark.createDataFrame([(" us123A1 ", "20200101"), ("123", "2020-02-03"), (None, "bad")], "n string, d string")
    c, n, k = S.split_number(F.col("n"))
    got = df.select(c.alias("c"), n.alias("n"), k.alias("k"), S.parse_date(F.col("d")).cast("string").alias("d")).collect()
    assert [tuple(r) for r in got] == [("US", "123", "A1", "2020-01-01"), (None, "123", None, "2020-02-03"), (None, None, None, None)]


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, mark = (f"file://{tmp_path}/{x}" for x in ("in", "out", "mark"))
    spark.range(3).write.parquet(src)
    for _ in range(2):
        ingest.ingest(spark.readStream.schema("id long").parquet(src), out, mark)
    spark.range(3, 5).write.mode("append").parquet(src)
    ingest.ingest(spark.readStream.schema("id long").parquet(src), out, mark)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_stream_order_does_not_depend_on_batches(spark, tmp_path):
    """Older changes in later files: one file a batch gives what one batch gives."""
    target = changes(spark, [("US", "0", 0, "C", "old"), ("US", "1", 0, "C", "old"), ("US", "2", 0, "C", "old"), ("US", "5", 50, "D", "stays")])
    files = [
        [("US", "1", 9, "A", "new"), ("US", "2", 9, "D", None), ("US", "3", 9, "D", None), ("US", "4", 2, "D", None)],
        [("US", "1", 5, "A", "older"), ("US", "2", 5, "A", "older"), ("US", "3", 5, "C", "older"), ("US", "4", 5, "C", "again")],
        [("US", "1", 7, "D", None), ("US", "5", 7, "D", None)],
    ]
    feed = tmp_path / "feed"
    feed.mkdir()
    for k, rows in enumerate(files):
        changes(spark, rows).coalesce(1).write.parquet(f"file://{tmp_path}/part{k}")
        (part,) = (tmp_path / f"part{k}").glob("*.parquet")
        moved = part.rename(feed / f"{k}.parquet")
        os.utime(moved, (1_700_000_000 + k, 1_700_000_000 + k))
    got = []
    for n in (1, 1000):
        for without in ([], ["seq"]):
            stream = spark.readStream.schema(target.schema).option("maxFilesPerTrigger", n).parquet(f"file://{feed}")
            out = f"file://{tmp_path}/{n}{len(without)}"
            given = target.withColumns({c: F.lit(None).cast("long") for c in without})
            table = versions.VersionedTable.create(spark, f"{out}/table", given, KEYS, ["seq"], buckets=3)
            ingest.merge_stream(table, stream, f"{out}/mark")
            got.append(rows_of(table.read().drop("seq")))
    assert got[0] == got[2] == [("US", "0", "C", "old"), ("US", "1", "A", "new"), ("US", "4", "C", "again"), ("US", "5", "D", "stays")]
    assert got[1] == got[3] == got[0][:3]


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    """Run, run again with nothing new, new files: nothing is lost, and the target given later is not used."""
    target = changes(spark, [("US", "1", 0, "C", "a")])
    feed, out = f"file://{tmp_path}/feed", f"file://{tmp_path}/out"

    def run(given):
        stream = spark.readStream.schema(target.schema).parquet(feed)
        table = versions.VersionedTable.create(spark, f"{out}/t", given, KEYS, ["seq"], buckets=3)
        ingest.merge_stream(table, stream, f"{out}/mark")
        return rows_of(table.read())

    changes(spark, [("US", "1", 1, "A", "b"), ("US", "2", 2, "C", "c")]).coalesce(1).write.parquet(feed)
    first = [("US", "1", 1, "A", "b"), ("US", "2", 2, "C", "c")]
    assert run(target) == first and run(target) == first and run(changes(spark, [])) == first
    changes(spark, [("US", "2", 3, "D", None), ("EP", "1", 4, "C", "n")]).coalesce(1).write.mode("append").parquet(feed)
    assert run(target) == [("EP", "1", 4, "C", "n"), ("US", "1", 1, "A", "b")]
    changes(spark, [("US", "2", 2, "A", "older than its deletion")]).coalesce(1).write.mode("append").parquet(feed)
    assert run(target) == [("EP", "1", 4, "C", "n"), ("US", "1", 1, "A", "b")]


def test_a_broken_copy_goes_on(spark, tmp_path, monkeypatch):
    """Ended between two chunks: what is there stays, the next call computes and adds the rest, once."""
    path = f"file://{tmp_path}/store"
    rows = spark.range(100).withColumn("v", F.col("id") * 2)
    rename, moved = sinks.rename_folder, []

    def then_die(*a):
        if len(moved) == 2:
            raise RuntimeError("killed")
        moved.append(a)
        rename(*a)

    with monkeypatch.context() as m:
        m.setattr(sinks, "rename_folder", then_die)
        with pytest.raises(RuntimeError, match="killed"):
            sinks.append_resumable(spark, rows, path, ["id", "v"], "id", chunks=4)
    kept = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("chunk=*/*.parquet") if "_stage" not in str(f)}
    assert sinks.append_resumable(spark, rows, path, ["id", "v"], "id", chunks=4) == [2, 3]
    assert {f: f.stat().st_mtime_ns for f in kept} == kept
    assert sinks.append_resumable(spark, rows, path, ["id", "v"], "id", chunks=4) == []
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(100))
    assert sinks.append_resumable(spark, rows, f"{path}2", ["id"], "id", present=spark.range(90), chunks=2) == [0, 1]
    assert sorted(r.id for r in spark.read.parquet(f"{path}2").collect()) == list(range(90, 100))


def test_archives_keep_their_encoding(spark, tmp_path):
    """Declared encodings, records over several blocks, bytes that don't fit, and archives too deep within others."""
    said = '<?xml version="1.0" encoding="{}"?><d><exchange-document country="é"/>x</d>'
    long = "<d>" + "".join(f'<exchange-document kind="{k}">{"ü" * 5000}</exchange-document>' for k in range(400)) + "</d>"
    files = {"latin": said.format("ISO-8859-1").encode("latin-1"), "wide": said.format("UTF-16").encode("utf-16"), "bad": said.format("UTF-8").encode("latin-1"), "odd": said.format("no-such").encode(), "long": long.encode()}
    for name, data in files.items():
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("a.xml", data)
    deep = (tmp_path / "latin.zip").read_bytes()
    for k in range(20):
        with zipfile.ZipFile(tmp_path / f"deep{k}.zip", "w") as z:
            z.writestr("in.zip", deep)
        deep = (tmp_path / f"deep{k}.zip").read_bytes()
        if k not in (3, 19):
            (tmp_path / f"deep{k}.zip").unlink()
    got = {}
    for r in archives.read_archives(spark, f"file://{tmp_path}").collect():
        got.setdefault(r.path.rpartition("/")[2][:-4], []).append("error" if r.error else r.record_xml)
    assert got["latin"] == got["wide"] == got["deep3"] == ['<exchange-document country="é"/>']
    assert got["bad"] == got["odd"] == got["deep19"] == ["error"] and len(got["long"]) == 400 and "error" not in got["long"]


def test_wide_rows_take_any_child(spark, tmp_path):
    """Designation and availability tags of any name, schemes and residences where they stand, with and without prefixes."""
    blocks = """<exch:designation-of-states><exch:designation-epc><exch:contracting-states><exch:country>AT</exch:country><exch:country>BE</exch:country><exch:country>AT</exch:country></exch:contracting-states>
    <exch:other-states at="1"><country>ME</country></exch:other-states><exch:none/></exch:designation-epc><designation-pct><national><country>JP</country></national></designation-pct></exch:designation-of-states>
    <exch:dates-of-public-availability><exch:printed-with-grant><document-id><date>20200203</date></document-id></exch:printed-with-grant><new-kind-of-date><document-id><country>US</country><date>2020-02-04</date></document-id></new-kind-of-date><exch:undated/></exch:dates-of-public-availability>
    <exch:patent-classifications><patent-classification scheme="OWN" sequence="2"><text> A01B </text></patent-classification><patent-classification sequence="1"><classification-scheme scheme="CPC"/><classification-symbol>H04L</classification-symbol></patent-classification></exch:patent-classifications>"""
    text = RECORD.replace('kind="B1"', 'kind="A1"').replace("<exch:parties>", blocks + "<exch:parties>")
    text = text.replace("</exch:applicants>", '<exch:applicant data-format="docdb" sequence="2"><exch:applicant-name><name>Beta</name></exch:applicant-name><exch:country>FR</exch:country><exch:text>Lyon</exch:text></exch:applicant></exch:applicants>')
    (tmp_path / "a.xml").write_text(f'<d xmlns:exch="urn:x">{text}</d>')
    parsed = xml.parse_records(spark.createDataFrame([(text,)], "x string"), "x")
    for records in (parsed, xml.read_records(spark, f"file://{tmp_path}", glob="*.xml")):
        row = extract.wide_rows(records).first()
        assert [(d.treaty_type, d.designation_type, d.country_code) for d in row.designations] == [("EPC", "contracting-states", "AT"), ("EPC", "contracting-states", "BE"), ("EPC", "other-states", "ME"), ("PCT", "national", "JP")]
        assert [(d.availability_type, str(d.availability_date)) for d in row.availability_dates] == [("printed-with-grant", "2020-02-03"), ("new-kind-of-date", "2020-02-04")] and row.is_grant
        assert [(c.scheme_name, c.sequence, c.symbol) for c in row.classifications] == [("OWN", 2, "A01B"), ("CPC", 1, "H04L")]
        assert [(p.name, p.residence, p.address_text) for p in row.parties.applicants] == [("ACME", "US", None), ("Beta", "FR", "Lyon")]


def test_wide_rows_keep_unknown_fields(spark):
    """Unknown elements and attributes, repeated ones too, come back as JSON, split by where they stand."""
    text = RECORD.replace('status="C"', 'status="C" exch:mood="odd"').replace("<date>20190102</date>", "<date>20190102</date><room>7</room>")
    text = text.replace("<exch:parties>", "<exch:notes><n>1</n><n>2</n></exch:notes><exch:parties>")
    rows = extract.wide_rows(xml.parse_records(spark.createDataFrame([(text,), (VOID,)], "x string"), "x"), keep_void_stubs=True).collect()
    row, stub = sorted(rows, key=lambda r: r.source_status)
    check_wide(row)
    assert json.loads(row.app_extra_data) == {"bibliographic-data": {"application-reference": {"document-id": {"room": "7"}}}}
    assert json.loads(row.pub_extra_data)["mood"] == "odd" and json.loads(row.pub_extra_data)["bibliographic-data"]["notes"] == {"n": ["1", "2"]}
    assert (stub.app_extra_data, stub.pub_extra_data) == ("{}", "{}")
