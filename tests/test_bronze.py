import hashlib
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.operators import bronze as B
from lakeledger.operators import silver as SV
from lakeledger.sources import pages as P
from tests.conftest import tx, write_page

NOW = "2026-02-01T00:00:00.000000Z"
R1, R2, R3 = ("20260101_000000", "2026-01-01T00:00:00Z"), \
    ("20260102_000000", "2026-01-02T00:00:00Z"), ("20260103_000000", "2026-01-03T00:00:00Z")


def ingest(spark, root, tmp, now=NOW):
    return B.ingest(spark, root, f"{tmp}/bronze", f"{tmp}/ledger", now=now, prefix="raw/")


def silver_rows(spark, tmp, key=None):
    s = SV.silver_from_bronze(B.read_bronze(spark, f"{tmp}/bronze"), built_at="B")
    if key:
        s = s.filter(F.col("transaction_id") == key)
    return [r.asDict() for r in s.orderBy("item_id", "transaction_id", "version").collect()]


def test_life_cycle(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("t1")])
    write_page(root, "bank", "i1", 1, *R2, modified=[tx("t1", amount=13.0)])
    write_page(root, "bank", "i1", 1, *R3, removed=[{"transaction_id": "t1"}])
    assert ingest(spark, root, tmp) == {"pages": 3, "rows": 3}
    rows = silver_rows(spark, tmp)
    assert [r["version"] for r in rows] == [1, 2, 3]
    assert [r["valid_to_ts"] for r in rows] == [R2[1], R3[1], None]
    last = rows[-1]
    assert last["is_current"] and last["is_deleted"] and not last["is_active"]
    assert last["amount"] is None and last["txn_year"] is None
    assert rows[0]["amount"] == 12.5 and rows[1]["amount"] == 13.0
    assert rows[0]["pfc_primary"] == "FOOD" and rows[0]["city"] == "Berlin"
    assert rows[0]["txn_year"] == 2026 and rows[0]["txn_month"] == 1
    assert rows[0]["source_page_path"] == "raw/bank/i1/sync_pages/page_0001_20260101_000000.json"


def test_same_run_two_pages_and_same_page(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("t1")], has_more=True)
    write_page(root, "bank", "i1", 2, *R1, modified=[tx("t1")])
    write_page(root, "bank", "i1", 3, *R1, added=[tx("t2")], removed=["t2"])
    ingest(spark, root, tmp)
    t1 = silver_rows(spark, tmp, "t1")
    assert [(r["change_type"], r["is_current"]) for r in t1] == [("added", False),
                                                                ("modified", True)]
    assert t1[0]["valid_from_ts"] == t1[0]["valid_to_ts"] == R1[1]
    t2 = silver_rows(spark, tmp, "t2")
    assert [(r["change_type"], r["is_current"]) for r in t2] == [("added", False),
                                                                ("removed", True)]


def test_listed_twice_revive_orphan_two_items(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("t1"), tx("t1")], removed=["o1"])
    write_page(root, "bank", "i1", 1, *R2, removed=["t1"])
    write_page(root, "bank", "i1", 1, *R3, added=[tx("t1")])
    write_page(root, "bank", "i2", 1, *R1, added=[tx("t1")])
    ingest(spark, root, tmp)
    b = B.read_bronze(spark, f"{tmp}/bronze").filter("item_id = 'i1' AND run_id = '%s'" % R1[0])
    ids = [r.event_id for r in b.filter("transaction_id = 't1'").collect()]
    assert len(ids) == 2 and ids[0] == ids[1]
    rows = silver_rows(spark, tmp)
    i1 = [r for r in rows if r["item_id"] == "i1" and r["transaction_id"] == "t1"]
    assert [r["change_type"] for r in i1] == ["added", "added", "removed", "added"]
    assert i1[-1]["is_active"]
    o1 = [r for r in rows if r["transaction_id"] == "o1"]
    assert len(o1) == 1 and o1[0]["version"] == 1 and o1[0]["is_deleted"]
    i2 = [r for r in rows if r["item_id"] == "i2"]
    assert len(i2) == 1 and i2[0]["is_active"]


def test_removed_forms_bad_elements_header_gaps(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1,
               added=["junk", {"transaction_id": None, "amount": 1}, tx("good")],
               removed=["r1", {"transaction_id": "r2"}, {}, None, ""],
               drop=("run_id",), has_more=None, plaid_env=" ")
    ingest(spark, root, tmp)
    b = B.read_bronze(spark, f"{tmp}/bronze")
    got = sorted((r.event_type, r.transaction_id) for r in b.collect())
    assert got == [("added", "good"), ("removed", "r1"), ("removed", "r2")]
    r = b.filter("transaction_id = 'good'").first()
    assert r.has_more is False and r.plaid_env == "sandbox" and r.run_id is None
    page_path = "raw/bank/i1/sync_pages/page_0001_20260101_000000.json"
    raw = f"i1|unknown|{page_path}|added|good"
    assert r.event_id == hashlib.sha256(raw.encode()).hexdigest()
    assert r.ingested_at == NOW and r.event_year == 2026 and r.event_date == "2026-01-01"


def test_empty_page_reingest_and_crash(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("t1")])
    write_page(root, "bank", "i1", 2, *R1)  # empty page
    assert ingest(spark, root, tmp) == {"pages": 2, "rows": 1}
    assert ingest(spark, root, tmp) == {"pages": 0, "rows": 0}
    # crash: a new page's rows reached Bronze but its ledger line did not
    write_page(root, "bank", "i1", 3, *R2, added=[tx("t9")])
    pages = P.read_pages(spark, root, "raw/").filter(F.col("page_name").startswith("page_0003"))
    B.append_bronze(B.explode_pages(pages, NOW), f"{tmp}/bronze", B.next_batch(spark, f"{tmp}/ledger"))
    assert B.read_bronze(spark, f"{tmp}/bronze").count() == 2
    # the next run has a further page; it replaces the lost run's batch
    write_page(root, "bank", "i1", 4, *R2, added=[tx("t10")])
    assert ingest(spark, root, tmp) == {"pages": 2, "rows": 2}
    assert ingest(spark, root, tmp) == {"pages": 0, "rows": 0}
    assert B.read_bronze(spark, f"{tmp}/bronze").count() == 3
    assert B.processed_pages(spark, f"{tmp}/ledger").count() == 4


def test_broken_ledger_lines_ignored(spark, tmp):
    os.makedirs(f"{tmp}/ledger", exist_ok=True)
    with open(f"{tmp}/ledger/part-0.json", "w") as f:
        f.write('\n{not json\n{"ts": "x", "run_id": "r"}\n'
                '{"ts": "x", "run_id": "r", "page_path": "raw/a.json"}\n')
    led = B.processed_pages(spark, f"{tmp}/ledger")
    assert [r.page_path for r in led.collect()] == ["raw/a.json"]
    assert B.processed_pages(spark, f"{tmp}/absent").count() == 0


def test_batches_in_name_order_equal_one_batch(spark, tmp):
    root_a, root_all = f"{tmp}/a", f"{tmp}/all"
    pages = [(1, R1, [tx("t1")], []), (2, R1, [], ["t1"]), (1, R2, [tx("t1")], [])]
    for n, r, add, rem in pages:
        write_page(root_all, "bank", "i1", n, *r, added=add, removed=rem)
    for n, r, add, rem in pages:  # land one page at a time
        write_page(root_a, "bank", "i1", n, *r, added=add, removed=rem)
        B.ingest(spark, root_a, f"{tmp}/ba", f"{tmp}/la", now=NOW, prefix="raw/")
    B.ingest(spark, root_all, f"{tmp}/ball", f"{tmp}/lall", now=NOW, prefix="raw/")
    one = SV.silver_from_bronze(B.read_bronze(spark, f"{tmp}/ball"), built_at="B")
    many = SV.silver_from_bronze(B.read_bronze(spark, f"{tmp}/ba"), built_at="B")
    key = ["transaction_id", "version", "change_type", "valid_from_ts", "valid_to_ts"]
    assert sorted(map(tuple, one.select(*key).collect())) == \
        sorted(map(tuple, many.select(*key).collect()))


def test_read_pages_item_filter(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "American Express", "i1", 1, *R1, added=[tx("a")])
    write_page(root, "bank", "i2", 1, *R1, added=[tx("b")])
    assert P.read_pages(spark, root, institution="american express").count() == 1
    assert P.read_pages(spark, root, item_id="i2").first().item_id == "i2"


def test_bad_page_fails_or_is_quarantined(spark, tmp):
    import pytest
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a")])
    d = os.path.join(root, "bank", "i1", "sync_pages")
    with open(os.path.join(d, "page_0002_20260101_000000.json"), "w") as f:
        f.write('{"run_id": "20260101_000000", "added": [ broken')
    with pytest.raises(Exception):
        ingest(spark, root, tmp)
    kw = dict(now=NOW, prefix="raw/", mode="PERMISSIVE", quarantine_path=f"{tmp}/q")
    r1 = B.ingest(spark, root, f"{tmp}/bronze", f"{tmp}/ledger", **kw)
    r2 = B.ingest(spark, root, f"{tmp}/bronze", f"{tmp}/ledger", **kw)
    assert r1 == {"pages": 1, "rows": 1, "quarantined": 1}
    assert r2 == {"pages": 0, "rows": 0, "quarantined": 0}
    q = spark.read.json(f"{tmp}/q").collect()
    assert [r.page_path for r in q] == ["raw/bank/i1/sync_pages/page_0002_20260101_000000.json"]


def test_pages_with_invalid_elements_go_to_quarantine(spark, tmp):
    import pytest
    from lakeledger.operators import jsonschema
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a")])
    write_page(root, "bank", "i1", 2, *R1, added=[tx("b"), tx("c", amount="much", date="soon")], removed=["z"])
    kw = dict(now=NOW, prefix="raw/", mode="PERMISSIVE", quarantine_path=f"{tmp}/q", element_schema=jsonschema.TRANSACTION)
    for pages, rows, bad in ((1, 1, 1), (0, 0, 0)):
        assert B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", **kw) == {"pages": pages, "rows": rows, "quarantined": bad}
    (q,) = spark.read.json(f"{tmp}/q").collect()
    assert [(v["path"], v["rule"]) for v in json.loads(q.content)] == [("$.added[1].amount", "type"), ("$.added[1].date", "format")]
    write_page(root, "bank", "i1", 2, *R1, added=[tx("b"), tx("c")], removed=["z"])  # repaired
    assert B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", **kw) == {"pages": 1, "rows": 3, "quarantined": 0}
    with pytest.raises(ValueError):
        B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", element_schema=jsonschema.TRANSACTION)


def test_first_batch_without_events(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1)
    assert ingest(spark, root, tmp) == {"pages": 1, "rows": 0}
    assert B.read_bronze(spark, f"{tmp}/bronze").count() == 0
    write_page(root, "bank", "i1", 2, *R1, added=[tx("a")])
    assert ingest(spark, root, tmp) == {"pages": 1, "rows": 1}
    assert B.read_bronze(spark, f"{tmp}/bronze").count() == 1


def test_unreadable_run_time(spark, tmp):
    import pytest
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, "r", "yesterday", added=[tx("a")])
    with pytest.raises(Exception, match="unreadable run_ts"):
        ingest(spark, root, tmp)
    got = B.ingest(spark, root, f"{tmp}/b2", f"{tmp}/l2", now=NOW, mode="PERMISSIVE", quarantine_path=f"{tmp}/q")
    assert got == {"pages": 0, "rows": 0, "quarantined": 1}
    with pytest.raises(ValueError):
        B.ingest(spark, root, f"{tmp}/b2", f"{tmp}/l2", mode="PERMISSIVE")


def test_removed_takes_strings_and_objects_only(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1,
               removed=[123, ["x"], True, None, "id1", {"transaction_id": "id2"}, {"transaction_id": None}])
    ingest(spark, root, tmp)
    assert sorted(r.transaction_id for r in B.read_bronze(spark, f"{tmp}/bronze").collect()) == ["id1", "id2"]


def test_paths_with_spaces_and_signs(spark, tmp):
    root = f"{tmp}/raw pages+x"
    write_page(root, "ba+nk", "i1", 1, *R1, added=[tx("a")])
    write_page(root, "ba nk", "i1", 1, *R1, added=[tx("a")])
    write_page(root, "b[a]{n}k", "i%1", 1, *R1, added=[tx("a")])
    assert ingest(spark, root, tmp) == {"pages": 3, "rows": 3}
    assert ingest(spark, root, tmp) == {"pages": 0, "rows": 0}
    paths = {r.page_path for r in B.read_bronze(spark, f"{tmp}/bronze").collect()}
    name = "sync_pages/page_0001_20260101_000000.json"
    assert paths == {f"raw/ba+nk/i1/{name}", f"raw/ba nk/i1/{name}", f"raw/b[a]{{n}}k/i%1/{name}"}


def test_lines_landed_twice_and_malformed_lines(spark, tmp):
    os.makedirs(f"{tmp}/in")
    page = {"run_id": "r", "run_ts": "2026-01-01T00:00:00Z", "item_id": "i", "added": [{"transaction_id": "a"}],
            "page_name": "page_0001_r.json", "page_path": "bank/i/p1"}
    with open(f"{tmp}/in/x.json", "w") as f:
        f.write(json.dumps(page) + "\n" + json.dumps(page) + "\n")
    kw = dict(now=NOW, layout="lines")
    assert B.ingest(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/l", **kw) == {"pages": 1, "rows": 1}
    with open(f"{tmp}/in/y.json", "w") as f:
        f.write('{"run_id": broken\n')
    kw |= dict(mode="PERMISSIVE", quarantine_path=f"{tmp}/q")
    for n in (1, 0):
        assert B.ingest(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/l", **kw) == {"pages": 0, "rows": 0, "quarantined": n}
    assert B.processed_pages(spark, f"{tmp}/l").count() == 1


def test_lines_are_read_once_and_bronze_not_at_all(spark, tmp, monkeypatch):
    os.makedirs(f"{tmp}/in")

    def land(name, *ids):
        with open(f"{tmp}/in/{name} +%.json", "w") as f:
            for i in ids:
                f.write(json.dumps({"run_id": "r", "run_ts": "2026-01-01T00:00:00Z", "item_id": "i", "page_path": f"p{i}",
                                    "added": [{"transaction_id": f"t{i}"}], "page_name": f"page_{i}_r.json"}) + "\n")
    opened = []
    lines = P.read_page_lines
    monkeypatch.setattr(P, "read_page_lines", lambda spark, root, mode="FAILFAST", files=None: (
        opened.append(sorted(os.path.basename(f) for f in files)), lines(spark, root, mode, files))[1])
    monkeypatch.setattr(B.T, "read_table", None)
    kw = dict(now=NOW, layout="lines")
    land("a", 1, 2)
    assert B.ingest(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/l", **kw) == {"pages": 2, "rows": 2}
    land("b", 2)
    assert B.ingest(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/l", **kw) == {"pages": 0, "rows": 0}
    land("c", 2, 3)
    assert B.ingest(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/l", files_per_batch=1, **kw) == {"pages": 1, "rows": 1}
    assert B.ingest(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/l", **kw) == {"pages": 0, "rows": 0}
    assert opened == [["a +%.json"], ["b +%.json"], ["c +%.json"]]
    assert sorted(os.listdir(f"{tmp}/b")) == ["batch_id=1", "batch_id=2"]


def test_listing_opens_no_file_and_narrows_to_a_folder(spark, tmp, capsys):
    root = f"{tmp}/raw"
    for item in ("i1", "i2"):
        write_page(root, "bank", item, 1, *R1, added=[tx("a")])
    P.list_pages(spark, root).explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<path:string>" in plan and "content" not in plan
    got = B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", now=NOW, institution="Bank", item_id="i2")
    assert got == {"pages": 1, "rows": 1}
    assert B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", now=NOW, institution="none") == {"pages": 0, "rows": 0}
    assert B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", now=NOW, files_per_batch=1)["pages"] == 1


def test_new_files_are_found_in_one_listing(spark, tmp):
    """No path of a new file is listed again by itself (a task for each), and a part of the listing is no job."""
    root, sc = f"{tmp}/raw", spark.sparkContext
    for n in range(80):
        write_page(root, "bank", "i1", n, *R1, added=[tx(f"t{n}")])
    sc.setJobGroup("one-listing", "ingest of 80 files")
    assert B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", now=NOW) == {"pages": 80, "rows": 80}
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("one-listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 40


def test_many_small_files_are_a_few_tasks(spark, tmp):
    """A scan has a task for each 32 files; a listing and a batch have a few a core, and every page is there."""
    few, root = 4 * spark.sparkContext.defaultParallelism, f"{tmp}/raw"
    for n in range(files := 32 * (few + 4)):
        write_page(root, "bank", "i1", n, *R1, added=[tx(f"t{n}")])
    listed = P.list_pages(spark, root)
    assert listed.rdd.getNumPartitions() <= few < P.read_pages(spark, root).rdd.getNumPartitions()
    assert listed.select("page_path").distinct().count() == files and listed.where("size > 0").count() == files
    scans = []
    pages = P.read_pages(spark, root, marks=[r.mark for r in listed.collect()], scan=P.scan_pages(spark, root))
    for size in (0, 1 << 40):  # large files keep the tasks of the scan
        scans.append(P.in_few_tasks(pages, size))
        assert scans[-1].count() == files
    assert scans[0].rdd.getNumPartitions() <= few < scans[1].rdd.getNumPartitions()


def test_no_page_file_is_in_an_index_of_the_driver(spark, tmp):
    root = f"{tmp}/raw"
    for n in range(3):
        write_page(root, "bank", "i1", n, *R1, added=[tx(f"t{n}")])
    for df in (P.list_pages(spark, root), P.scan_pages(spark, root), P.read_pages(spark, root), P.read_pages(spark, root, mode="PERMISSIVE")):
        assert not [f for f in df.inputFiles() if "page_" in f]
        assert df.count() == 3


def test_tasks_list_what_spark_lists(spark, tmp, monkeypatch):
    """Also when a task looks into one folder only and leaves the rest to the next round."""
    root = f"{tmp}/raw +%x"
    for institution, item in (("bank", "i1"), ("bank", "i2"), ("_hidden", "i"), (".hidden", "i"), ("_k=1", "i"), ("x._COPYING_", "i"), ("ü", "[i] %20")):
        write_page(root, institution, item, 1, *R1)
    write_page(root, "", "", 7, *R1)  # beside the folders
    os.makedirs(f"{root}/empty/page_folder.json")
    for name in ("page_1.txt", ".page_2.json", "Page_3.json", "xpage_4.json"):
        with open(f"{root}/bank/{name}", "w") as f:
            f.write("no page")
    theirs = spark.read.format("binaryFile").option("pathGlobFilter", P.PAGE_GLOB).option("recursiveFileLookup", True).load(root)
    theirs = {(r.path.replace("file:///", "file:/"), r.length) for r in theirs.select("path", "length").collect()}
    assert len(theirs) == 5
    for entries in (P.ENTRIES, 1):
        monkeypatch.setattr(P, "ENTRIES", entries)
        ours = P.list_pages(spark, root, "raw/").collect()
        assert {(r.path, r.size) for r in ours} == theirs and len(ours) == len(theirs)
        assert {r.page_path for r in ours} == {"raw/" + p.removeprefix(f"file:{root}/") for p, _ in theirs}


def test_tasks_read_what_spark_reads(spark, tmp):
    """Pages of files of every form are those of Spark's reader, in each mode."""
    page = {"run_id": "r", "added": [{"transaction_id": "ä", "amount": 1.50}, "x"], "removed": ["a", {"transaction_id": 1}, None], "has_more": True}
    text = json.dumps(page, ensure_ascii=False)
    odd = """{"run_id" : 1.50, "item_id": [1,  "x"], "x": {"added": [1.0]}, "mode": true, "cursor_in":null, "added":
        [ {"amount" : 12345678901234567890.1234500, "b": "\\u00e4 ] }"},1e3 , null, [ 1.0 ], false, "t", "" ] , "modified" : [], "added ": [1.0]}"""
    twice = '{"added": [1.0], "added": [{"x":  2.0}], "run_id": "a", "run_id": null}'
    good = {"object": text, "array": f" \n[{text}, {text}]", "none": "[]", "empty": "", "blank": " \r\n\t", "more": f"{text} {text}", "bom": "\ufeff" + text,
            "wide": '{"run_id": "ü"}'.encode("utf-16"), "little": '{"run_id": "ü"}'.encode("utf-16-le"), "single": "{'run_id': 'q'}", "other": '{"x": 1}',
            "odd": odd, "ödd +%&'()[]=@~#^\u00a0\u3000.😀": odd, "odd array": f"[{odd}, {odd}]", "twice": twice, "lone": '{"added": [{"x": "\\ud800"}]}', "nan": '{"added": [NaN, {"a": -Infinity}]}'}
    bad = {"open": '{"run_id": "r", "added": [', "null": "null", "text": '"x"', "word": "page", "type": '{"run_id": "r", "has_more": "soon"}', "bytes": b'{"run_id": "\xff"}',
           "open array": '[{"run_id": "r"}, {', "array of types": '[{"run_id": "r"}, {"run_id": "s", "has_more": []}]', "nulls": "[null]", "deep": "[[1]]",
           "element": '{"run_id": "r", "added": [{"a": 1, }]}', "comma": '{"run_id": "r", "added": [{"a": 1.0}, ]}', "no list": '{"added": {"a": 1}}',
           "control": '{"added": [{"a": "\n"}]}', "zero": '{"added": [{"a": 01}]}', "half": '{"added": [{"a": 1.0}], "mode": tru}'}

    def land(root, files):
        os.makedirs(root)
        for name, content in files.items():
            with open(f"{root}/page_{name}.json", "wb") as f:
                f.write(content if isinstance(content, bytes) else content.encode())

    def rows(df):
        return sorted(str((r.page_name, *[r[c] for c in df.columns if c not in ("page_name", "page_path", P.CORRUPT)],
                           *([r[P.CORRUPT]] if P.CORRUPT in df.columns else []))) for r in df.withColumn("removed", F.col("removed").cast("array<string>")).collect())

    def theirs(root, mode):
        read = spark.read.schema(P._with_corrupt(P.schemas.PAGE, mode)).options(multiLine=True, mode=mode, columnNameOfCorruptRecord=P.CORRUPT)
        return read.json(root).select("*", F.col("_metadata.file_name").alias("page_name"))

    import pytest
    land(f"{tmp}/good", good)
    land(f"{tmp}/bad", bad)
    for root, mode in (("good", "FAILFAST"), ("good", "DROPMALFORMED"), ("good", "PERMISSIVE"), ("bad", "PERMISSIVE")):
        ours, want = rows(P.read_pages(spark, f"{tmp}/{root}", mode=mode)), rows(theirs(f"{tmp}/{root}", mode))
        assert ours == want, (mode, [x for x in zip(ours, want) if x[0] != x[1]])
    assert P.read_pages(spark, f"{tmp}/bad", mode="DROPMALFORMED").collect() == []
    for name in ("open", "null", "type", "bytes", "nulls", "element"):
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            P.open_files(spark.createDataFrame([(f"file:{tmp}/bad/page_{name}.json",)], "path string")).collect()


def test_batches_hold_the_most_files_in_order_of_paths(spark, tmp):
    files = spark.createDataFrame([(f"p{n:03d}", n) for n in range(103)], "path string, size long").checkpoint(eager=True)
    got = [(sorted(r.path for r in some.collect()), size) for some, size in B._in_batches(files, 10)]
    assert [p for paths, _ in got for p in paths] == [f"p{n:03d}" for n in range(103)]
    assert [len(paths) for paths, _ in got] == [10] * 10 + [3] and [size for _, size in got][:2] == [45, 145]
    assert [n.size for n, _ in B._in_batches(files.limit(0), 10)] == []


def test_the_layout_of_the_table_is_asked_for_once(spark, tmp, monkeypatch):
    root, asked, number = f"{tmp}/raw", [], B.L.number
    for n in range(3):
        write_page(root, "bank", "i1", n, *R1, added=[tx(f"t{n}")])
    monkeypatch.setattr(B.L, "number", lambda *a: (asked.append(1), number(*a))[1])
    assert B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", now=NOW, files_per_batch=1) == {"pages": 3, "rows": 3}
    assert len(asked) == 1 and sorted(os.listdir(f"{tmp}/b")) == ["batch_id=1", "batch_id=2", "batch_id=3"]
    assert {(r.page_path, r.batch) for r in spark.read.json(f"{tmp}/l").collect()} == {
        (f"bank/i1/sync_pages/page_{n:04d}_{R1[0]}.json", n + 1) for n in range(3)}


def test_expressions_of_rows_are_built_once_for_all_batches(spark, tmp, monkeypatch):
    root, built = f"{tmp}/raw", []
    for n in range(4):
        write_page(root, "bank", "i1", n, *R1, added=[tx(f"t{n}")], removed=[f"r{n}", {"transaction_id": f"s{n}"}])
    elements = B._elements
    monkeypatch.setattr(B, "_elements", lambda pages: (built.append(1), elements(pages))[1])
    assert B.ingest(spark, root, f"{tmp}/b", f"{tmp}/l", now=NOW, files_per_batch=1) == {"pages": 4, "rows": 12}
    assert len(built) == 1
    got = {(r.event_type, r.transaction_id) for r in B.read_bronze(spark, f"{tmp}/b").collect()}
    assert got == {(t, f"{c}{n}") for n in range(4) for t, c in (("added", "t"), ("removed", "r"), ("removed", "s"))}


def test_marks_choose_the_files_that_are_opened(spark, tmp):
    root = f"{tmp}/raw i'n"
    for n in (1, 2, 3):
        write_page(root, "bank", "i +%1", n, *R1, added=[tx(f"t{n}")])
    with open(f"{root}/bank/i +%1/sync_pages/page_0009_r.json", "w") as f:
        f.write("{ not a page")
    listed = {r.page_path[-len("0001_" + R1[0] + ".json"):][:4]: r.mark for r in P.list_pages(spark, root).collect()}
    marks = [m for k, m in listed.items() if k in ("0001", "0003")]
    got = P.read_pages(spark, root, marks=marks)  # the malformed file would fail it
    assert sorted(r.page_name[:9] for r in got.collect()) == ["page_0001", "page_0003"]


def test_null_ingestion_time_sorts_first_and_later_columns_are_read(spark, tmp):
    a = spark.createDataFrame([("i", "t", "added", "2026-01-01", "e1", "2026-01-02"),
                               ("i", "t", "modified", "2026-01-01", "e2", None)],
                              "item_id string, transaction_id string, event_type string, run_ts string, "
                              "event_id string, ingested_at string")
    a.withColumn("event_year", F.lit(2026)).write.partitionBy("event_year").parquet(f"{tmp}/b")
    a.limit(1).withColumn("city", F.lit("Berlin")).withColumn("event_year", F.lit(2027)).write.mode(
        "append").partitionBy("event_year").parquet(f"{tmp}/b")
    b = B.read_bronze(spark, f"{tmp}/b")
    assert b.where("city = 'Berlin'").count() == 1 and b.where("ingested_at is null").count() == 1
    s = SV.silver_from_bronze(b.where("event_year = 2026"), built_at="B")
    assert [(r.source_event_id, r.version) for r in s.orderBy("version").collect()] == [("e2", 1), ("e1", 2)]


def test_event_date_is_the_run_time_own_day(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, "20260131_233000", "2026-01-31T23:30:00-05:00",
               added=[tx("a")])
    r = B.explode_pages(P.read_pages(spark, root), NOW).first()
    assert (r.event_date, r.event_year, r.event_month) == ("2026-01-31", 2026, 1)


def _flatten_rule(page):
    """Plain reading of the rules: objects with an id in added/modified;
    objects with an id or non-empty bare ids in removed."""
    out = []
    for et in ("added", "modified", "removed"):
        for i, el in enumerate(page[et] or []):
            if isinstance(el, dict):
                tid = el.get("transaction_id")
                tid = None if tid is None else str(tid)
            elif et == "removed" and isinstance(el, str):
                tid = el
            else:
                tid = None
            if tid:
                out.append((et, tid, i))
    return sorted(out)


def test_property_flatten_equals_rule(spark):
    import json
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
    elem = st.one_of(
        st.none(), st.sampled_from(["", "r1", "junk"]),
        st.builds(lambda t: {"transaction_id": t, "amount": 1.5},
                  st.one_of(st.none(), st.sampled_from(["", "a", "b"]), st.integers(0, 9))),
        st.just({"amount": 2}))
    arrays = st.lists(elem, max_size=5)

    @settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(arrays, arrays, arrays), min_size=1, max_size=4))
    def check(pages):
        rows, expected = [], []
        for n, (a, m, r) in enumerate(pages):
            page = {"added": a, "modified": m, "removed": r}
            enc = {k: [None if e is None else (e if isinstance(e, str) else json.dumps(e))
                       for e in v] for k, v in page.items()}
            rows.append(("run", "2026-01-01T00:00:00Z", "backfill", "bank", "i1", "sandbox",
                         "", "c", False, enc["added"], enc["modified"], enc["removed"],
                         f"page_{n:04d}_run.json", f"p{n}"))
            expected += [(f"p{n}",) + t for t in _flatten_rule(page)]
        df = spark.createDataFrame(rows, T.StructType([
            f if f.name != "removed" else T.StructField("removed", T.ArrayType(T.StringType()))
            for f in P.PAGE_LINE.fields]))
        got = sorted((r.page_path, r.event_type, r.transaction_id, r.pos)
                     for r in B.explode_pages(df, NOW).collect())
        assert got == sorted(expected)
    check()
