"""Tables as logs of versions, ordered scans, archives by members, quarantine, places in an order."""

import io
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from patentlake.operators import extra, ranking
from patentlake.sources import archives, extract, quarantine, record_scan, versions, xml
from patentlake.streaming import ingest

from .test_library import FILE, KEYS, RECORD, changes, check_wide, rows_of


def a_table(spark, path, buckets=8):
    rows = changes(spark, [("US" if k % 2 else "AU", str(k), k, "C", "a") for k in range(60)])
    return versions.VersionedTable.create(spark, path, rows, KEYS, ["seq"], buckets)


def test_a_merge_writes_what_it_touches(spark, tmp_path):
    """One key of 64 buckets: one folder of changes, one bucket compacted, all others as they were."""
    table = a_table(spark, f"file://{tmp_path}/t", buckets=64)
    before = table.manifest()["parts"]
    assert table.merge(changes(spark, [("US", "1", 99, "A", "b")])) == 1
    (touched,) = [p for p, x in table.manifest()["parts"].items() if x != before.get(p)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2 and table.due() == [touched]
    assert table.compact() == 2
    after = table.manifest()["parts"]
    assert {p for p in after if after[p] != before[p]} == {touched} and after[touched]["deltas"] == []
    assert {(r.pub_doc_id, r.v) for r in table.read().where("v <> 'a'").collect()} == {("1", "b")}
    assert table.merge(changes(spark, [])) == 2


def test_versions_are_not_disturbed(spark, tmp_path):
    """A reader of a version sees that version while others are made, compacted too, until it is removed."""
    table = a_table(spark, f"file://{tmp_path}/t")
    old = table.read(0)
    table.merge(changes(spark, [("US", "1", 99, "D", None), ("US", "new", 1, "C", "n")]))
    table.compact([*table.manifest()["parts"]])
    assert old.count() == 60 and old.where("pub_doc_id = '1'").count() == 1
    assert table.read().count() == 60 and table.read().where("pub_doc_id = '1'").count() == 0
    gone = table.vacuum(keep=1)
    assert len(gone) == 1 and table.versions() == [2] and table.read().count() == 60
    table.merge(changes(spark, [("US", "1", 98, "C", "older than its deletion")]))
    assert table.read().where("pub_doc_id = '1'").count() == 0


def test_no_duplicates_by_any_number_of_buckets(spark, tmp_path):
    """Another number than the table's is an error, in merges and where a table is opened; so are other keys."""
    path = f"file://{tmp_path}/t"
    table = a_table(spark, path, buckets=4)
    for wrong in (64, 1):
        with pytest.raises(ValueError, match="buckets"):
            table.merge(changes(spark, [("US", "1", 99, "A", "b")]), buckets=wrong)
        with pytest.raises(ValueError, match="buckets"):
            a_table(spark, path, buckets=wrong)
    with pytest.raises(ValueError, match="no table"):
        versions.VersionedTable(spark, f"file://{tmp_path}/nothing")
    every = changes(spark, [("US" if k % 2 else "AU", str(k), 100, "A", "b") for k in range(40)])
    versions.VersionedTable(spark, path).merge(every)
    assert table.read().count() == 60 and table.read().where("v = 'b'").count() == 40


def test_stamps_and_lookups(spark, tmp_path):
    stamped = changes(spark, [("US", "1", 1, "C", "a"), ("EP", "2", 1, "C", "a"), ("AU", "3", 1, "C", "a")]).withColumns({"created_at": F.lit(1), "updated_at": F.lit(1)})
    table = versions.VersionedTable.create(spark, f"file://{tmp_path}/t", stamped, KEYS, ["seq"], 2)
    for now in (2, 3):
        table.merge(changes(spark, [("US", "1", now, "A", "b"), ("US", "9", now, "C", "c"), ("EP", "2", 0, "A", "older")]), now=F.lit(now))
    assert {(r.pub_doc_id, r.v, r.created_at, r.updated_at) for r in table.read().collect()} == {("1", "b", 1, 3), ("9", "c", 2, 3), ("2", "a", 1, 1), ("3", "a", 1, 1)}
    us = table.read(countries=["US"])
    assert {r.pub_doc_id for r in us.collect()} == {"1", "9"}
    assert all("country_part=US" in f for f in us.inputFiles())
    assert table.read(countries=[]).count() == 0


@pytest.mark.parametrize("step", ["write", "draft", "rename", "after"])
def test_a_merge_that_dies_changes_nothing_or_all(spark, tmp_path, monkeypatch, step):
    """Ended between any two steps, the table is as before or as after; the batch, run again, is merged once."""
    table = a_table(spark, f"file://{tmp_path}/t")
    batch = changes(spark, [("US", "1", 99, "A", "b"), ("AU", "2", 99, "D", None), ("EP", "x", 1, "C", "n")])

    class Killed(Exception):
        pass

    def die(*_):
        raise Killed

    def then_die(f):
        def run(*a):
            f(*a)
            raise Killed

        return run

    with monkeypatch.context() as m:
        if step == "write":
            m.setattr(versions.VersionedTable, "_write", then_die(versions.VersionedTable._write))
        elif step == "draft":
            m.setattr(versions, "write_text", die)
        elif step == "rename":
            m.setattr(versions, "rename_new", die)
        else:
            m.setattr(versions, "rename_new", then_die(versions.rename_new))
        with pytest.raises(Killed):
            table.merge(batch, batch=("feed", 0))
    assert table.versions() == ([0, 1] if step == "after" else [0])
    assert table.read().where("v = 'b'").count() == (1 if step == "after" else 0)
    assert table.merge(batch, batch=("feed", 0)) == 1 and table.merge(batch, batch=("feed", 0)) == 1
    assert table.read().count() == 60 and table.read().where("v = 'b'").count() == 1
    table.vacuum(keep=1)
    assert table.read().count() == 60


def test_the_second_writer_is_told(spark, tmp_path):
    table = a_table(spark, f"file://{tmp_path}/t")
    slow = table.manifest()
    table.merge(changes(spark, [("US", "1", 99, "A", "b")]))
    slow["version"] += 1
    with pytest.raises(versions.Conflict):
        table._commit(slow)
    assert table.read().where("v = 'b'").count() == 1 and not [f for f in (tmp_path / "t" / "_versions").iterdir() if re.fullmatch(r"\\.[0-9a-f]{32}", f.name)]


def test_a_stream_that_dies_before_its_checkpoint(spark, tmp_path, monkeypatch):
    table = a_table(spark, f"file://{tmp_path}/t")
    feed, mark = f"file://{tmp_path}/feed", f"file://{tmp_path}/mark"
    changes(spark, [("US", "1", 99, "A", "b"), ("EP", "x", 1, "C", "n")]).coalesce(1).write.parquet(feed)
    run = lambda: ingest.merge_stream(table, spark.readStream.schema(table.read().schema).parquet(feed), mark)
    merge = versions.VersionedTable.merge

    def merge_and_die(self, *a, **k):
        merge(self, *a, **k)
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(versions.VersionedTable, "merge", merge_and_die)
        with pytest.raises(Exception, match="killed"):
            run()
    assert table.versions() == [0, 1]
    run()
    assert len(table.manifest()["batches"]) == 1 and table.read().count() == 61
    assert table.read().where("v = 'b'").count() == 1


# --- order ---------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_places(spark, n):
    values = [random.Random(n).randint(0, n // 2) for _ in range(n)]
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int").repartition(5)
    got = sorted((r.place, r.v, r.i) for r in ranking.ranked(rows, [F.col("v").desc(), "i"]).collect())
    assert got == [(k, v, i) for k, (v, i) in enumerate(sorted(zip(values, range(n), strict=True), key=lambda x: (-x[0], x[1])), 1)]
    assert [r.i for r in sorted(ranking.page(rows, ["v", "i"], 3, 4).collect())] == [i for _, i in sorted(zip(values, range(n), strict=True))[2:6]]
    assert ranking.page(rows, ["v", "i"], n + 1).count() == 0


def test_no_task_ranks_all_rows(spark):
    plan = ranking.ranked(spark.range(100), ["id"])._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window ") :]
    assert "HashAggregate" in window  # it runs over one count for each task


def scan_files(folder):
    one = lambda f, i, p: f'<{p}exchange-document country="US" doc-number="{f}-{i}" kind="A"><a>é {i}</a><{p}odd/></{p}exchange-document>\n'
    many = lambda f, n, p: "".join(one(f, i, p) for i in range(n))
    (folder / "a.xml").write_text(f"<?xml version='1.0'?>\n<exch:exchange-documents>\n{many('a', 300, 'exch:')}</exch:exchange-documents>")
    (folder / "b.xml").write_text(f"<d>{many('b', 20, '')}<exchange-document>bare</exchange-document><exchange-document\n kind='x'/>{one('b', 20, 'exch:')}<exchange-document doc-number='cut'><a>")
    (folder / "c.xml").write_text(f"{many('c', 2, 'exch:')}<exch:exchange-document doc-number='cut'><a></a>")
    (folder / "d.xml").write_text("<nothing/>")
    (folder / "e.xml").write_text("")


@pytest.mark.parametrize(("split", "prefix"), [(700, None), (90, "exch:"), (1 << 20, ""), (700, "other:")])
def test_scans_keep_order(spark, tmp_path, split, prefix):
    """Any split and any prefix: the same records in the order of their files, and an error for each one cut off."""
    scan_files(tmp_path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = record_scan.with_ordinals(record_scan.scan_records(spark, f"file://{tmp_path}", glob="*.xml", prefix=prefix)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = {}
    for r in sorted(rows, key=lambda r: [r[c] for c in record_scan.ORDER]):
        got.setdefault(r.path_[-5], []).append((r.ordinal, r.error or (re.search('doc-number="([^"]*)"', r.record_xml) or [0, r.record_xml])[1]))
    names = {"a": [f"a-{i}" for i in range(300)], "b": [*(f"b-{i}" for i in range(20)), "<exchange-document>bare</exchange-document>", "<exchange-document\n kind='x'/>", "b-20", "the record is cut off"], "c": ["c-0", "c-1", "the record is cut off"]}
    assert got == {f: list(enumerate(xs, 1)) for f, xs in names.items()}


def test_each_file_is_cut_at_its_own_prefix(spark, tmp_path):
    """Whatever prefix a file has, and whatever its name, its records are dealt to ranges and no line holds many."""
    names = {"a.xml": "exch:", "b [1] 5%25.xml": "", "c{d}.xml": "x-y.z:", "e.xml": "exch:"}
    for name, p in names.items():
        (tmp_path / name).write_text("<d>" + "".join(f'<{p}exchange-document kind="{i}">the exchange-document {i}</{p}exchange-document>' for i in range(200)) + "</d>")
    (tmp_path / "f.xml").write_text("<d><q:exchange-document>the exchange-document </q:exchange-document></d>")
    (tmp_path / "g.xml").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = record_scan.scan_records(spark, f"file://{tmp_path}").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by_file = {}
    for r in sorted(rows, key=lambda r: [r[c] for c in record_scan.ORDER]):
        by_file.setdefault(r.path_, []).append(r)
    assert sorted(map(len, by_file.values())) == [1, 200, 200, 200, 200] and {r.error for r in rows} == {None}
    for of in by_file.values():
        if len(of) > 1:
            assert [re.search('kind="([0-9]+)"', r.record_xml)[1] for r in of] == [str(i) for i in range(200)]
            assert len({r.block_ for r in of}) > 4


def test_scanned_records_keep_unknown_fields(spark, tmp_path):
    (tmp_path / "a.xml").write_text(FILE.replace('status="C"', 'status="C" mood="odd"'))
    scanned = record_scan.scan_records(spark, f"file://{tmp_path}")
    row = extract.wide_rows(xml.parse_records(scanned, "record_xml", keep=("path_", "row_"))).collect()[0]
    check_wide(row)
    assert '"mood": "odd"' in row.pub_extra_data
    (tmp_path / "latin.xml").write_bytes('<exchange-document country="é"/>'.encode("latin-1"))
    assert [r.record_xml for r in record_scan.scan_records(spark, f"file://{tmp_path}", glob="latin.xml", encoding="ISO-8859-1").collect()] == ['<exchange-document country="é"/>']


# --- archives --------------------------------------------------------------------------------


def test_cut_members_say_so(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "cut.zip", "w") as z:
        z.writestr("x.xml", '<d><exchange-document kind="1"><a/></exchange-document><exchange-document kind="2"><a>')
    with zipfile.ZipFile(tmp_path / "cut2.zip", "w") as z:
        z.writestr("x.xml", '<exchange-document kind="1"/><exchange-document ki')
    with zipfile.ZipFile(tmp_path / "bytes.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x.xml", "".join(f'<exchange-document kind="{k}">{random.Random(k).random()}</exchange-document>' for k in range(5000)))
    data = bytearray((tmp_path / "bytes.zip").read_bytes())
    data[len(data) // 2] ^= 255
    (tmp_path / "bytes.zip").write_bytes(data)
    got = {}
    for r in archives.read_archives(spark, f"file://{tmp_path}").collect():
        got.setdefault(r.path.rpartition("/")[2], []).append(r.error)
    assert got["cut.zip"] == [None, "the member ends within a record"] and got["cut2.zip"] == got["cut.zip"]
    assert got["bytes.zip"][-1] and sum(x is not None for x in got["bytes.zip"]) == 1


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_streams_cut_anywhere(monkeypatch, block):
    monkeypatch.setattr(archives, "BLOCK", block)
    records = ['<exchange-document kind="1"/>', '<e:exchange-document a="1"><b>x</b></e:exchange-document >', "<exchange-document>é\n</exchange-document>", RECORD]
    text = f"<?xml version='1.0'?><exchange-documents><!-- < -->{'  '.join(records)}</exchange-documents>"
    assert list(archives._stream(io.BytesIO(text.encode()), "exchange-document")) == records


def test_archives_are_read_by_seeks(monkeypatch, tmp_path):
    """The last of three members of 8 MB: the others' bytes aren't read, and no more than blocks are held."""
    body = "".join(f"<exchange-document kind='{k}'>{random.Random(k).randbytes(500).hex()}</exchange-document>" for k in range(8000))
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as z:
        for k in range(3):
            with zipfile.ZipFile(inner := io.BytesIO(), "w") as x:
                x.writestr("r.xml", body)
            z.writestr(f"{k}.zip", inner.getvalue())
    read = []
    opened = archives._opened

    class Counted(archives._File):
        def read(self, n=-1):
            read.append(len(x := super().read(n)))
            return x

    path = f"file:{tmp_path}/big.zip"
    with opened(path) as f, zipfile.ZipFile(f) as z:
        names = list(archives._xml_members(z))
    assert names == [(f"{k}.zip", "r.xml") for k in range(3)]
    with opened(path) as f:
        rows = list(archives._member_rows(path, names[2], "exchange-document", Counted(f.file)))
    assert len(rows) == 8000 and sum(read) < 2.5 * len(body) and max(read) <= archives.BLOCK


# --- quarantine ------------------------------------------------------------------------------


def test_quarantine(spark):
    texts = [
        ("good", RECORD, None), ("seq", RECORD.replace('sequence="1"', 'sequence="x1"', 1), None), ("cut", RECORD[:-30], None), ("none", None, None),
        ("said", None, "the record is cut off"), ("party", RECORD.replace('<exch:applicant data-format="docdb" sequence="1">', '<exch:applicant data-format="docdb" sequence="1.5">'), None),
        ("void", '<exchange-document status="DV" country="US"/>', None), ("empty", "", None),
    ]
    rows = spark.createDataFrame(texts, "path string, record_xml string, error string")
    good, bad = quarantine.quarantine(rows, error="error", keep=("path",))
    assert [r.path for r in good.collect()] == ["good"]
    check_wide(good.collect()[0])
    got = {r.path: list(r.reasons) for r in bad.collect()}
    assert got == {"seq": ["sequence of priority-claim is no number: x1"], "cut": ["the XML doesn't parse"], "none": ["no text"], "empty": ["no text"], "said": ["the record is cut off"], "party": ["sequence of applicant is no number: 1.5"]}
    files = {r.path: (r.n_good, r.n_bad, r.status) for r in quarantine.file_outcomes(good, bad, "path").collect()}
    assert files["good"] == (1, 0, "COMPLETED") and files["seq"] == (0, 1, "FAILED")
    nothing, none = quarantine.quarantine(rows.limit(0), keep=("path",))
    assert nothing.count() == none.count() == 0


# --- the open tree ----------------------------------------------------------------------------


def test_rules_are_the_same_in_both_forms(spark):
    """Random trees: what the walk leaves out is what the expressions take."""
    rng = random.Random(4)
    names = ["document-id", "country", "name", "applicant", "applicant-name", "sequence", "abstract", "kind", "x", "bibliographic-data", "application-reference", "data-format"]

    def tree(depth):
        tag = rng.choice(names)
        attrs = "".join(f' {n}="v"' for n in rng.sample(names, rng.randint(0, 2)))
        inner = "".join(tree(depth + 1) for _ in range(rng.randint(0, 3))) if depth < 5 else "t"
        return f"<{tag}{attrs}>{inner or 'leaf'}</{tag}>{rng.choice(['', 'tail'])}"

    texts = [(f"EP{k}", f"<exchange-document>{''.join(tree(0) for _ in range(4))}</exchange-document>") for k in range(60)]
    paths = extra.prune(extra.xml_paths(spark.createDataFrame(texts, "id string, x string"), "id", "x"))
    want = {}
    for r in paths.collect():
        want.setdefault(r.record, []).append((tuple(r.path), r.value))
    for rid, text in texts:
        root = extra.ElementTree.fromstring(text)
        left = [(p, v) for p, v in extra._leaves(root, taken=extra._taken) if p and v is not None]
        assert sorted(left) == sorted(want.get(rid, []))
    assert {r.record for r in extra.rebuild(paths).collect()} == set(want)
