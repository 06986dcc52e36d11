"""What must not grow faster than the input."""

import io
import time

import pytest
from pyspark.sql import functions as F

from patentlake.operators import extra
from patentlake.plans import queries
from patentlake.sources import archives, entities, extract, xml

from .test_library import RECORD, VOID

SF = "/root/testdata/sf0.001"


def test_pruned_walk_gives_the_rows_that_prune_keeps(spark):
    rows = queries._record_xml(spark, SF).limit(50).withColumn("id", F.xxhash64("record_xml"))
    every, some = (extra.xml_paths(rows, "id", "record_xml", all_paths=a) for a in (True, False))
    at = lambda df: sorted((r.record, r.path, r.value) for r in extra.prune(df).collect())
    assert at(every) == at(some) != []
    assert some.count() * 5 < every.count()


def test_record_text_is_made_once(spark):
    found = queries.first_match(spark, SF)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("to_xml(") == 1


def test_firsts_are_picked_once(spark):
    parsed = xml.parse_records(spark.createDataFrame([("<exchange-document country='US'/>",)], "x string"), "x")
    name = F.col("bibliographic-data")["application-reference"]
    plan = parsed.select(name.alias("a"), F.size(name).alias("b"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 2


def test_voids_in_any_case(spark):
    from patentlake.functions import scalars as S

    rows = spark.createDataFrame([("cv", "Yes"), ("Dv", "yeſ"), ("CV ", "NO"), (None, None), ("D", "ye")], "s string, r string")
    assert [tuple(r) for r in rows.select(S.is_void(F.col("s")), S.representative(F.col("r"))).collect()] == [(True, True), (True, True), (False, False), (False, False), (False, False)]
    assert set(S.any_case("CV")) == {"CV", "Cv", "cV", "cv"}


def test_small_records_of_large_members_take_linear_time():
    text = b"<d>" + b"<r k='1'>x</r>" * 600_000 + b"</d>"
    began = time.process_time()
    assert sum(1 for _ in archives._stream(io.BytesIO(text), "r")) == 600_000
    assert time.process_time() - began < 12


def test_members_are_dealt_to_many_tasks(spark, tmp_path):
    rows = spark.range(60).select(F.concat(F.lit("n"), F.pmod("id", F.lit(20))).alias("name"), F.concat(F.lit("<r k='"), "id", F.lit("'>é</r>")).alias("x"))
    archives.write_archives(rows, f"file://{tmp_path}/a", "name", "x")
    found = archives.read_archives(spark, f"file://{tmp_path}/a", tag="r").withColumn("task", F.spark_partition_id()).collect()
    assert len(found) == 60 and {r.error for r in found} == {None} and {r.member for r in found} == {"records.xml", "inner.zip/records.xml"}
    assert len({r.task for r in found}) > 1


def test_entities_by_joins(spark, tmp_path):
    (tmp_path / "a.dtd").write_text("""<!ENTITY a 'x'> <!ENTITY b "&a;&a;&#34;"> <!-- <!ENTITY z 'no'> --> <!ENTITY c '[&b;|&nope;|&amp;]'>""")
    (tmp_path / "b.dtd").write_text("<!ENTITY a 'late'> <!ENTITY d '&c;&e;'> <!ENTITY e ''> <!ENTITY amp 'never'>")
    path = f"file://{tmp_path}/*.dtd"
    table = entities.read_table(spark, path)
    assert dict(table.collect()) == xml.read_entities(spark, path)
    texts = ["&d; &lt; &a;", "none", "&nope;&amp;", None, "&a;", "&b"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, x string")
    want = [r[0] for r in rows.orderBy("i").select(xml.decode_entities(F.col("x"), xml.read_entities(spark, path))).collect()]
    assert [r.x for r in entities.decode(rows, "x", table).orderBy("i").collect()] == want
    (tmp_path / "c.dtd").write_text("<!ENTITY f '&g;'> <!ENTITY g '&f;'>")
    with pytest.raises(ValueError, match="leads back to itself"):
        entities.read_table(spark, path)


def test_splits_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(queries, "size_of", lambda *_: 1 << 40)
    seen = []
    monkeypatch.setattr(queries.record_scan, "scan_records", lambda s, *_, **__: seen.append(int(s.conf.get("spark.sql.files.maxPartitionBytes"))) or 1 / 0)
    with pytest.raises(ZeroDivisionError):
        queries._scanned(spark, SF)
    assert seen == [(1 << 40) // queries.SPLITS]


def test_wide_columns_are_those_of_wide_rows(spark):
    rows = spark.createDataFrame([(RECORD,), (VOID,), (RECORD.replace('kind="B1"', 'kind="A1"').replace(' doc-id="9"', ""),), ("<exchange-document/>",), ("cut",)], "x string")
    whole = extract.wide_rows(xml.parse_records(rows, "x"))
    at = lambda df: sorted(map(str, df.collect()))
    for columns in ("pub_doc_id", "availability_dates"), ("is_grant", "texts"), ("parties", "priorities", "app_date"), ("classifications", "citations", "designations"), ("app_extra_data", "pub_doc_id"), tuple(whole.columns):
        assert at(extract.wide_columns(rows, "x", *columns)) == at(whole.select(*columns)) != []


def test_dates_are_read_without_the_other_blocks(spark):
    plan = queries.avail_unpivot(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1 and "references-cited" not in plan[plan.index("from_xml(") :].split("ignoreSurroundingSpaces")[0]
    assert "PythonUDF" not in plan and plan.count("regexp_extract_all(") <= 3  # each once: names, contents, dates


def test_text_elements_are_not_walked():
    asked = []
    root = extra.ElementTree.fromstring("<r k='1'>" + "<a>x</a>t<b/>" * 50 + "<c d='2'/></r>")
    rows = extra._leaves(root, lambda parent: asked.append(parent) or frozenset())
    assert asked == [None, "c"]
    assert rows[:3] == [(("k",), "1"), (("a", "[0]"), "x"), (("b", "[0]"), None)] and rows[-2:] == [(("c", "d"), "2"), (("a#tail",), "t")] and len(rows) == 103


ODD = [
    RECORD, VOID, "<exchange-document/>", "cut", "<exchange-document country='US'><abstract><p>x</abstract><note>n</note></exchange-document>",
    "<d kind='A'><abstract>&foo;</abstract><note>n</note></d>", "<d kind='A'><!-- <abstract> --><note>n</note><abstract>x</abstract></d>", "<d kind='A'><note><![CDATA[<abstract>]]></note><abstract>x</abstract></d>",
    "<d kind='A'><abstract a='x'><b><abstract>x</abstract><note>n</note></b></abstract> tail <note>m</note></d>", "<d kind='A'><abstract a='/>'><note>n</note></abstract>tail<abstract/>t<note abstract='1' b='&lt;'>m &amp; n</note></d>",
    "<d kind='A'><bibliographic-data><application-reference doc-id='1' odd='2'><document-id doc-id=\"1\"><country>US</country><odd>1</odd></document-id><document-id><kind>A</kind></document-id>t</application-reference></bibliographic-data></d>",
    "<d kind='A'><p><priority-claim sequence=\"1\"><document-id><date x='1'>2</date></document-id></priority-claim><priority-claim sequence=\"1\" odd=\"3\"><document-id><date>2</date></document-id>t</priority-claim><priority-claim><document-id><date>2</date> t</document-id></priority-claim></p></d>",
    "<d kind='A'><p><a/><b/></p>t<p><a/> x</p><p><q><a/><a>1</a></q><q><a/></q></p><p><application-reference doc-id=\"1\"><document-id/></application-reference><z/></p></d>",
    "<d kind='A'><p>" + "<a/>" * 50_000 + "</p><document-id>" + "<date>1</date>" * 50_000 + "</document-id><note>n</note></d>",
    "<d kind='A'><p><priority-claim sequence=\"1\"><document-id><date>2</date></document-id><priority-active-indicator>Y</priority-active-indicator></priority-claim><priority-claim><odd>1</odd></priority-claim></p></d>",
]


def test_known_blocks_are_taken_out_of_the_text(spark):
    """What is left of a record gives the same unknown fields, and is short."""
    rows = spark.createDataFrame([(t,) for t in ODD], "x string")
    wide = extract.wide_rows(xml.parse_records(rows, "x"), keep_void_stubs=True).select("source_status", "app_extra_data", "pub_extra_data").collect()
    assert [r[1:] for r in wide if r[0] != "SKIP"] == [extra._split_of(t) for t in ODD if t != VOID]
    records = queries._record_xml(spark, SF).select("record_xml", extra.without_blocks(F.col("record_xml")).alias("short")).limit(50).collect()
    assert all(extra._split_of(r.short) == extra._split_of(r.record_xml) and "<text>" not in r.short for r in records)


def test_records_are_put_together_as_text(spark):
    """to_xml writes the root alone; texts are escaped, nulls left out."""
    plan = queries._record_xml(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "bibliographic-data" not in plan[plan.index("to_xml(") :].split("rowTag")[0]
    row = spark.createDataFrame([("a<b>&\"c'", None)], "t string, n string")
    text = xml.element("r", {"k": xml.escaped(F.col("t")), "n": F.col("n")}, xml.leaf("x", xml.escaped(F.col("t"))), xml.leaf("y", F.col("n")), F.array(xml.leaf("z", F.lit("1")), xml.leaf("z", F.col("n")), F.lit("<z/>")))
    (written,) = row.select(text).first()
    root = extra.ElementTree.fromstring(written)
    assert root.attrib == {"k": "a<b>&\"c'"} and [(e.tag, e.text) for e in root] == [("x", "a<b>&\"c'"), ("z", "1"), ("z", None)]


@pytest.mark.parametrize("name", ["biblio_full", "flat_main"])
def test_bibliographies_read_the_blocks_they_need(spark, monkeypatch, name):
    """Without stored wide rows only the blocks that the query needs are parsed, no unknown fields are looked for, and the rows are the same."""
    at = lambda: sorted(map(str, queries.QUERIES[name](spark, SF).collect()))
    plans = []
    keep = queries.ranking.stored
    monkeypatch.setattr(queries.ranking, "stored", lambda rows, n: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or keep(rows, n))
    monkeypatch.setattr(queries, "_STORED", {})
    found, made = at(), dict(queries._STORED)
    plan = (plans or [queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()])[0]
    assert made == {} and "split_extra" not in plan and "PythonUDF" not in plan and "run(" not in plan
    parsed = plan[plan.index("from_xml(") :].split("ignoreSurroundingSpaces")[0]
    assert "designation-of-states" not in parsed and ("references-cited" in parsed) == (name == "flat_main")
    queries._wide(spark, SF)
    assert at() == found != []


def test_documents_are_read_once(spark):
    plan = queries.biblio_document(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "get_json_object" not in plan


def test_counted_blocks_have_as_many_rows(spark):
    odd = "<exchange-document kind='A' status='C'><bibliographic-data><priority-claims><priority-claim data-format='docdb' sequence='1'><document-id doc-id='1'/></priority-claim><priority-claim data-format='docdb' sequence='1'><document-id><date>1</date></document-id></priority-claim><priority-claim data-format='docdb'><document-id/></priority-claim><priority-claim data-format='docdb' sequence='2'/></priority-claims><patent-classifications><patent-classification/><patent-classification scheme='x'><text> a </text></patent-classification><patent-classification><classification-symbol/></patent-classification></patent-classifications><references-cited><citation/><citation sequence='1'/><citation><patcit/></citation><citation><nplcit><text>x</text></nplcit></citation></references-cited></bibliographic-data></exchange-document>"
    rows = spark.createDataFrame([(t,) for t in (RECORD, VOID, odd, "<exchange-document/>", "cut")], "x string")
    counted = ("priorities", "classifications", "citations")
    sizes = lambda df: sorted(map(str, df.select("pub_doc_id", *(F.size(c) for c in counted), "parties", F.col("designations").isNull()).collect()))
    whole = extract.wide_rows(xml.parse_records(rows, "x")).withColumn("designations", F.lit(None))
    assert sizes(extract.wide_blocks(rows, "x", "parties", counted=counted)) == sizes(whole) != []
