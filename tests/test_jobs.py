from lakeledger.operators import bronze as B
from lakeledger.operators import jobs as J
from tests.conftest import tx, write_page

R1, R2 = ("20260101_000000", "2026-01-01T00:00:00Z"), ("20260102_000000", "2026-01-02T00:00:00Z")


def test_end_to_end(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a"), tx("b", amount="bad")])
    write_page(root, "bank", "i1", 1, *R2, modified=[tx("a")], removed=["b"])
    assert J.run_bronze(spark, root, f"{tmp}/bronze", f"{tmp}/ledger", now="N") == \
        {"pages": 2, "rows": 4}
    m = J.run_silver(spark, f"{tmp}/bronze", f"{tmp}/silver", built_at="B")
    assert (m["bronze_rows"], m["silver_rows"]) == (4, 4)
    checks = J.run_checks(spark, f"{tmp}/silver")
    assert all(r.passed for r in checks.collect())
    assert spark.sql("SELECT count(*) FROM silver_transactions_current").first()[0] == 1
    e1 = J.run_export(spark, f"{tmp}/silver", f"{tmp}/sheet", f"{tmp}/synclog", now="T1")
    assert e1["rows"] == 2 and e1["watermark"] == R2[1]
    # rebuild after a new page; the export continues from its watermark
    write_page(root, "bank", "i1", 1, ("20260103_000000"), "2026-01-03T00:00:00Z",
               added=[tx("c")])
    J.run_bronze(spark, root, f"{tmp}/bronze", f"{tmp}/ledger", now="N2")
    J.run_silver(spark, f"{tmp}/bronze", f"{tmp}/silver", built_at="B2")
    e2 = J.run_export(spark, f"{tmp}/silver", f"{tmp}/sheet", f"{tmp}/synclog", now="T2")
    assert e2["rows"] == 1 and e2["previous_watermark"] == R2[1]


def test_raw_payload_failures_counted(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a", amount="x", pending="maybe"),
                                                tx("b")])
    from lakeledger.sources import pages as P
    from lakeledger.operators import quality as Q
    pages = P.read_pages(spark, root)
    res = {r.check: r.violations for r in
           Q.check_bronze(B.explode_pages(pages, "N"), B.raw_payload_failures(pages)).collect()}
    assert res["bad_amount"] == 1 and res["bad_pending"] == 1 and res["null_item_id"] == 0


def test_cli_steps(spark, tmp):
    from lakeledger.__main__ import main
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a")])
    assert main(["bronze", "--pages", root, "--bronze", f"{tmp}/b", "--ledger", f"{tmp}/l"]) == 0
    assert main(["silver", "--bronze", f"{tmp}/b", "--silver", f"{tmp}/s"]) == 0
    assert main(["check", "--silver", f"{tmp}/s"]) == 0
    assert main(["export", "--silver", f"{tmp}/s", "--target", f"{tmp}/t",
                 "--log", f"{tmp}/log"]) == 0
    assert spark.read.option("header", True).csv(f"{tmp}/t").count() == 1


def test_checks_cover_bronze_and_raw_values(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a", amount="much", pending="maybe"), tx("b")])
    J.run_bronze(spark, root, f"{tmp}/b", f"{tmp}/l", now="N1", institution="bank", item_id="i1")
    J.run_silver(spark, f"{tmp}/b", f"{tmp}/s", built_at="B1")
    got = {r["check"]: r.violations for r in J.run_checks(
        spark, f"{tmp}/s", False, f"{tmp}/b", root).collect()}
    assert got["bad_amount"] == 1 and got["bad_pending"] == 1 and got["D2_one_current_per_key"] == 0
    assert got["repeated_event_id"] == 0 and len(got) == 12
