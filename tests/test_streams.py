"""Deliveries of archives, status tables, entity sets, indexes and large applications."""

import zipfile

import pytest
from pyspark.sql import functions as F

from patentlake.operators import biblio
from patentlake.sources import versions, xml
from patentlake.streaming import archives, ingest

from .test_library import KEYS, changes


def an_archive(path, names, records):
    with zipfile.ZipFile(path, "w") as outer:
        for name in names:
            with zipfile.ZipFile(path.with_suffix(".tmp"), "w") as inner:
                inner.writestr("r.xml", "".join(f'<exchange-document kind="{name}-{k}"/>' for k in range(records)))
            outer.write(path.with_suffix(".tmp"), f"{name}.zip")


def test_deliveries_go_on_where_they_ended(spark, tmp_path, monkeypatch):
    """Ended in the middle of a delivery, the next call reads only members that the ledger lacks, each once in all."""
    folder, out = tmp_path / "in", f"file://{tmp_path}/out"
    folder.mkdir()
    an_archive(folder / "Amend-1.zip", "abcde", 3)
    (folder / "CreateDelete-bad.zip").write_bytes(b"no archive")
    run = lambda: archives.stream_archives(spark, f"file://{folder}", out, f"file://{tmp_path}/mark", size=2)
    rounds, read = [], archives.read_members

    def counted(members, tag):
        rounds.append([(r.path, tuple(r.names or ())) for r in members.collect()])
        if len(rounds) == 3:
            raise RuntimeError("killed")
        return read(members, tag)

    monkeypatch.setattr(archives, "read_members", counted)
    with pytest.raises(Exception, match="killed"):
        run()
    assert [r.member for r in archives.ledger(spark, out).orderBy("member").collect()] == [None, "a.zip/r.xml", "b.zip/r.xml", "c.zip/r.xml"]
    run()
    run()
    an_archive(folder / "Amend-2.zip", "f", 2)
    run()
    done = [m for k, r in enumerate(rounds) if k != 2 for m in r]
    assert len(done) == len(set(done)) == 7 and rounds[0][0][0].endswith("CreateDelete-bad.zip")
    kinds = [r.record_xml.split('"')[1] for r in archives.delivered(spark, out).where("error IS NULL").collect()]
    assert sorted(kinds) == sorted([*(f"{n}-{k}" for n in "abcde" for k in range(3)), "f-0", "f-1"])
    statuses = {(r.member, r.n_records, r.status) for r in archives.ledger(spark, out).collect()}
    assert (None, 0, "FAILED") in statuses and ("f.zip/r.xml", 2, "COMPLETED") in statuses and len(statuses) == 7


def test_status_from_late_events(spark, tmp_path):
    """Events in any order over restarts give each file's last status; files without new events aren't merged again."""
    kind = "f string, status string, at long"
    batches = [[("a", "COMPLETED", 4), ("b", "PARSING", 3), ("b", "PENDING", 1)], [("a", "PENDING", 1), ("c", "FAILED", 2)], [("b", "FAILED", 9), ("a", "PARSING", 3)]]
    table = versions.VersionedTable.create(spark, f"file://{tmp_path}/t", spark.createDataFrame([], kind), ["f"], ["at"], 2)
    for rows in batches:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/events")
        ingest.status_table(table, spark.readStream.schema(kind).parquet(f"file://{tmp_path}/events"), f"file://{tmp_path}/mark", "f", "status", "at")
    assert {tuple(r) for r in table.read().collect()} == {("a", "COMPLETED", 4), ("b", "FAILED", 9), ("c", "FAILED", 2)}


def test_entity_sets():
    declared = """<!ENTITY a "x"> <!ENTITY b '&a;&a;"'> <!-- <!ENTITY no "1"> --> <!ENTITY c "[&b;|&nope;|&amp;]"> <!ENTITY a "second"> <!ENTITY n "&#948;&#x41;"> <!ENTITY % p "q">"""
    assert xml.entity_set(declared) == {"a": "x", "b": 'xx"', "c": '[xx"|&nope;|&amp;]', "n": "δA"}
    chain = "".join(f'<!ENTITY e{k} "&e{k + 1};.">' for k in range(3000)) + '<!ENTITY e3000 "end">'
    assert xml.entity_set(chain)["e0"] == "end" + "." * 3000
    for bad in ('<!ENTITY a "&a;">', '<!ENTITY a "&b;"><!ENTITY b "&c;"><!ENTITY c "&a;">'):
        with pytest.raises(ValueError, match="leads back"):
            xml.entity_set(bad)


def test_two_thousand_entities(spark, tmp_path):
    (tmp_path / "a.dtd").write_text("".join(f'<!ENTITY e{k} "t{k}">\n' for k in range(1000)))
    (tmp_path / "b.dtd").write_text("".join(f'<!ENTITY e{k} "t{k} &e{k - 1};">\n' for k in range(1000, 2000)))
    entities = xml.read_entities(spark, f"file://{tmp_path}/*.dtd")
    assert len(entities) == 2000
    df = spark.createDataFrame([("&e5; &amp; &e1000;",), ("&e1999;",), ("&amp;lt; &lt;",), ("&odd; & x",), (None,)], "x string")
    got = [r[0] for r in df.select(xml.decode_entities(F.col("x"), entities)).collect()]
    assert got[0] == "t5 &amp; t1000 t999" and got[1].startswith("t1999 t1998 ") and got[2:] == ["&amp;lt; &lt;", "&odd; & x", None]
    assert [r[0] for r in df.select(xml.decode_entities(F.col("x"), {})).collect()][0] == "&e5; &amp; &e1000;"


def test_lookups_read_what_can_match(spark, tmp_path):
    """An index names the parts of a value, changes included; other parts' files aren't opened."""
    rows = changes(spark, [("US" if k % 2 else "AU", str(k), k, "C", f"v{k % 30}") for k in range(600)])
    table = versions.VersionedTable.create(spark, f"file://{tmp_path}/t", rows, KEYS, ["seq"], 32, indexes=("v",))
    found = table.read(where={"v": ["v7"]})
    every = len(table.manifest()["parts"])
    assert found.count() == 20 and len({f.rpartition("/")[0] for f in found.inputFiles()}) <= 20 < every
    table.merge(changes(spark, [("EP", "new", 1, "C", "v7"), ("US", "7", 999, "A", "other"), ("US", "37", 999, "D", None)]))
    for _ in range(2):
        assert {r.pub_doc_id for r in table.read(where={"v": ["v7"]}).collect()} == {*(str(k) for k in range(7, 600, 30)), "new"} - {"7", "37"}
        assert [r.pub_doc_id for r in table.read(where={"v": ["other"]}).collect()] == ["7"]
        assert table.read(where={"v": ["nowhere"]}).count() == table.read(where={"v": []}).count() == 0
        table.compact([*table.manifest()["parts"]])
        table.vacuum(keep=1)


@pytest.mark.parametrize("block", [1, 3, 50, 4096])
def test_large_applications_by_blocks(spark, block):
    rows = [("big", str(k), None) for k in range(90)] + [("two", "x", None), ("two", "y", None), ("one", "z", None), (None, "n", None), ("", "e", None), (None, "m", None)]
    got = {(r.pub_doc_id, r.related_id) for r in biblio.related(spark.createDataFrame(rows, "app_doc_id string, pub_doc_id string, date_publ date"), block).collect()}
    assert got == {(str(a), str(b)) for a in range(90) for b in range(90) if a != b} | {("x", "y"), ("y", "x")}


def test_no_group_of_pairs_grows(spark):
    """Three thousand members of one application, in groups of a block each: nine million pairs."""
    rows = spark.range(3000).select(F.lit("big").alias("app_doc_id"), F.col("id").cast("string").alias("pub_doc_id"), F.lit(None).cast("date").alias("date_publ"))
    assert biblio.related(rows, 256).count() == 3000 * 2999
