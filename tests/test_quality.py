import pytest
from pyspark.sql import functions as F

from lakeledger.operators import quality as Q
from lakeledger.operators import silver as SV
from lakeledger.plans import changelog as C
from lakeledger.plans.queries import break_silver

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def good(spark):
    return SV.silver_from_bronze(C.events_changelog(spark, SF), built_at=C.BUILT_AT).cache()


def failed(checks):
    return sorted(r["check"] for r in checks.filter(~F.col("passed")).collect())


def test_good_silver_passes(good):
    assert failed(Q.check_silver(good)) == []
    Q.assert_all(Q.check_silver(good))


def test_empty_silver_passes(spark, good):
    assert failed(Q.check_silver(good.limit(0))) == []


def test_each_break_fails_its_check(good):
    v = F.col("version")
    cases = {
        "D2_one_current_per_key": good.withColumn("is_current", F.col("is_current") | (v == 1))
        .withColumn("valid_to_ts", F.when(v == 1, F.lit(None)).otherwise(F.col("valid_to_ts"))),
        "D3_active_is_current_not_deleted": good.withColumn(
            "is_active", F.col("is_active") | F.col("is_deleted")),
        "D4_closed_rows_have_end": good.withColumn(
            "valid_to_ts", F.when(F.col("is_current"), None).otherwise(F.lit(""))),
        "D5_current_rows_open": good.withColumn(
            "valid_to_ts", F.when(F.col("is_current"), F.lit("x")).otherwise(F.col("valid_to_ts"))),
        "D6_versions_start_at_1": good.withColumn("version", v + 1),
    }
    for name, broken in cases.items():
        assert failed(Q.check_silver(broken)) == [name], name


def test_broken_query_fails_all(good):
    assert failed(Q.check_silver(break_silver(good))) == [
        "D2_one_current_per_key", "D3_active_is_current_not_deleted",
        "D4_closed_rows_have_end", "D5_current_rows_open", "D6_versions_start_at_1"]
    with pytest.raises(AssertionError):
        Q.assert_all(Q.check_silver(break_silver(good)))


def test_bronze_checks(spark):
    b = C.events_changelog(spark, SF)
    res = {r["check"]: r["violations"] for r in Q.check_bronze(b).collect()}
    assert res["null_item_id"] == 0 and res["repeated_event_id"] > 0
