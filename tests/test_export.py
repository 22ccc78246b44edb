import json
import os

from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.operators import bronze as B
from lakeledger.operators import export as X
from lakeledger.operators import silver as SV
from lakeledger.operators import views as V
from tests.conftest import tx, write_page

R1, R2 = ("20260101_000000", "2026-01-01T00:00:00Z"), ("20260102_000000", "2026-01-02T00:00:00Z")


def build(spark, tmp, root):
    B.ingest(spark, root, f"{tmp}/bronze", f"{tmp}/ledger", now="N", prefix="raw/")
    SV.write_silver(SV.silver_from_bronze(B.read_bronze(spark, f"{tmp}/bronze"), "BUILT"),
                    f"{tmp}/silver")
    return SV.read_silver(spark, f"{tmp}/silver")


def three_rows(spark, tmp):
    root = f"{tmp}/raw"
    # a: active; b: tombstone; c: closed (modified later) -> c has 2 rows
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a"), tx("c")], removed=["b"])
    write_page(root, "bank", "i1", 1, *R2, modified=[tx("c", amount=1e7)])
    return build(spark, tmp, root)


def test_modes_and_views(spark, tmp):
    s = three_rows(spark, tmp)
    assert X.select_mode(s, "current").count() == 3  # a, b (tombstone), c v2
    assert X.select_mode(s, "all").count() == 4
    assert V.current(s).count() == 2
    assert V.current_including_deleted(s).count() == 3
    try:
        X.select_mode(s, "weird")
        raise AssertionError("no error")
    except ValueError:
        pass


def test_two_exports_log_and_missed_rows(spark, tmp):
    s = three_rows(spark, tmp)
    target, log = f"{tmp}/target", f"{tmp}/synclog"
    m1 = X.incremental_export(spark, s, target, log, "all", table_path="silver", now="T1")
    assert m1 == {"rows": 4, "watermark": R2[1], "previous_watermark": None}
    m2 = X.incremental_export(spark, s, target, log, "all", table_path="silver", now="T2")
    assert m2 == {"rows": 0, "watermark": R2[1], "previous_watermark": R2[1]}
    recs = X.read_log(spark, log).orderBy("timestamp").collect()
    assert [(r.rows_synced, r.last_synced_valid_from_ts) for r in recs] == [(4, R2[1]), (0, R2[1])]
    # a late page with the watermark's run time: never exported, reported missed
    write_page(f"{tmp}/raw", "bank", "i1", 2, *R2, added=[tx("late")])
    s2 = build(spark, tmp, f"{tmp}/raw")
    m3 = X.incremental_export(spark, s2, target, log, "all", table_path="silver", now="T3")
    assert m3["rows"] == 0
    tgt = spark.read.option("header", True).csv(target)
    missed = X.missed_rows(s2, tgt, m3["watermark"])
    assert [r.transaction_id for r in missed.collect()] == ["late"]


def test_log_match_ignores_other_records(spark, tmp):
    log = f"{tmp}/synclog"
    os.makedirs(log)
    base = {"plaid_env": "sandbox", "silver_delta_path": "p", "spreadsheet_id": "s",
            "worksheet_name": "w", "export_mode": "current", "rows_synced": 1}
    recs = [dict(base, last_synced_valid_from_ts="2026-01-01"),
            dict(base, plaid_env="production", last_synced_valid_from_ts="2026-09"),
            dict(base, worksheet_name="x", last_synced_valid_from_ts="2026-09"),
            dict(base, silver_delta_path="q", last_synced_valid_from_ts="2026-09"),
            dict(base, export_mode="all", last_synced_valid_from_ts="2026-09"),
            dict(base, spreadsheet_id="other", last_synced_valid_from_ts="2026-01-02")]
    with open(f"{log}/part-0.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\nnot json\n")
    assert X.last_watermark(X.read_log(spark, log), "sandbox", "w", "p", "current") == "2026-01-02"
    assert X.last_watermark(X.read_log(spark, f"{tmp}/none"), "sandbox", "w", "p", "current") is None


def test_header_alignment_and_stringify(spark, tmp):
    s = three_rows(spark, tmp)
    target = f"{tmp}/target"
    header = [c for c in schemas.EXPORT_COLUMNS if c != "city"] + ["notes"]
    spark.createDataFrame([], ",".join(f"{c} string" for c in header)) \
        .write.option("header", True).csv(target)
    # an empty target folder has no header line: seed one row with the header
    spark.createDataFrame([tuple("" for _ in header)], ",".join(f"{c} string" for c in header)) \
        .write.mode("append").option("header", True).csv(target)
    X.incremental_export(spark, s, target, f"{tmp}/log", "current", now="T")
    t = spark.read.option("header", True).csv(target)
    assert t.columns == header
    c2 = t.filter((F.col("transaction_id") == "c")).first()
    assert c2.amount == "10000000.0" and c2.pending == "False" and c2.notes is None
    b = t.filter(F.col("transaction_id") == "b").first()
    assert b.is_deleted == "True" and b.amount is None  # '' reads back as null


def test_export_filter_reaches_parquet_scan(spark, tmp, capsys):
    s = three_rows(spark, tmp)
    X.unsynced_rows(s, "current", R1[1]).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(valid_from_ts" in plan and "EqualTo(is_current,true)" in plan
    V.as_of(s, R1[1]).select("item_id").explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<item_id:string,valid_from_ts:string,valid_to_ts:string>" in plan


def test_typed_as_of_and_missing_table(spark, tmp):
    import pytest
    from lakeledger.sources import tables as T
    s = three_rows(spark, tmp)
    assert V.as_of(s, "2026-01-01T12:00:00+00:00", typed=True).count() == 3
    with pytest.raises(T.TableNotFound):
        SV.read_silver(spark, f"{tmp}/nothing")


def target_rows(spark, target, *cols):
    return sorted(tuple(r) for r in X.read_target(spark, target).select(*cols).collect())


def test_a_lost_run_neither_repeats_nor_skips(spark, tmp, monkeypatch):
    import pytest
    s = three_rows(spark, tmp)
    target, log = f"{tmp}/target", f"{tmp}/synclog"
    kw = dict(mode="all", table_path="silver")
    with monkeypatch.context() as m:  # the append is done, its record is not
        real = X.log_run
        m.setattr(X, "log_run", lambda sp, p, r: real(sp, p, r) if r["state"] == "begun" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            X.incremental_export(spark, s, target, log, now="T1", **kw)
    with monkeypatch.context() as m:  # and one that is lost before its append
        m.setattr(X, "append_aligned", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            X.incremental_export(spark, s, target, log, now="T2", **kw)
    write_page(f"{tmp}/raw", "bank", "i1", 2, *R2, added=[tx("d")])
    s2 = build(spark, tmp, f"{tmp}/raw")
    assert X.incremental_export(spark, s2, target, log, now="T3", **kw) == {
        "rows": 1, "watermark": R2[1], "previous_watermark": None}
    assert X.incremental_export(spark, s2, target, log, now="T4", **kw)["rows"] == 0
    assert target_rows(spark, target, "transaction_id", "version") == [
        ("a", "1"), ("b", "1"), ("c", "1"), ("c", "2"), ("d", "1")]
    states = sorted((r.export_id, r.state) for r in X.read_log(spark, log, begun=True).collect())
    assert states == [(1, "begun"), (2, "begun"), (3, "begun"), (3, "done"), (4, "begun"), (4, "done")]


def test_feed_of_builds_exports_late_rows_once(spark, tmp):
    s = three_rows(spark, tmp).withColumn("silver_built_at", F.lit("B1"))
    target, log = f"{tmp}/target", f"{tmp}/synclog"
    kw = dict(mode="all", table_path="silver", mark="built")
    assert X.incremental_export(spark, s, target, log, now="T1", **kw)["rows"] == 4
    write_page(f"{tmp}/raw", "bank", "i1", 2, *R1, added=[tx("late")])
    s2 = build(spark, tmp, f"{tmp}/raw").withColumn("silver_built_at", F.when(
        F.col("transaction_id") == "late", F.lit("B2")).otherwise(F.lit("B1")))
    for rows in (1, 0):
        assert X.incremental_export(spark, s2, target, log, now="T2", **kw)["rows"] == rows
    assert X.missed_rows(s2, X.read_target(spark, target), R2[1]).isEmpty()
    assert len(target_rows(spark, target, "transaction_id", "version")) == 5


def test_typed_mark_goes_by_the_instant(spark, tmp):
    times = ["2026-01-01T00:00:47Z", "2026-01-01T00:00:47.5Z", "2026-01-01T01:00:47.250000+01:00", "2026-01-01T00:00:46.9Z"]
    base = three_rows(spark, tmp).limit(1).drop("valid_from_ts", "transaction_id")

    def silver(n):
        t = spark.createDataFrame([(x, f"t{i}") for i, x in enumerate(times[:n])], "valid_from_ts string, transaction_id string")
        return base.crossJoin(t).select(*schemas.SILVER.fieldNames())
    target, log = f"{tmp}/target", f"{tmp}/synclog"
    got = [X.incremental_export(spark, silver(n), target, log, "all", mark="typed", now="T")["rows"] for n in (1, 3, 4)]
    assert got == [1, 2, 0]  # the last one is late: a typed mark misses it, as the text does
    assert X.last_mark(X.read_log(spark, log), "sandbox", "transactions", "", "all", "typed") == "2026-01-01T00:00:47.500000Z"
    assert [r[0] for r in target_rows(spark, target, "transaction_id")] == ["t0", "t1", "t2"]
    import pytest
    with pytest.raises(ValueError):
        X.incremental_export(spark, silver(1), target, log, mark="other")


def test_texts_with_line_ends_are_one_row(spark, tmp):
    name = 'one\nsecond, "line"\r\n\\third\\'
    s = three_rows(spark, tmp).withColumn("name", F.lit(name))
    for _ in range(2):
        X.incremental_export(spark, s, f"{tmp}/target", f"{tmp}/log", "all", now="T")
    t = X.read_target(spark, f"{tmp}/target")
    assert t.count() == 4 and t.columns == schemas.EXPORT_COLUMNS
    assert {r.name.replace("\r\n", "\n") for r in t.collect()} == {name.replace("\r\n", "\n")}
