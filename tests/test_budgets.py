import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from lakeledger.operators import budgets, segments

TX = "id long, day date, category string, amount double, month string"
BUDGET = "budget_id string, category string, valid_from date, valid_to date, budget_limit double"


def brute(tx, limits, shares=budgets.SHARES):
    out = {}
    for b, cat, lo, hi, limit in limits:
        spent = 0
        for i, d, c, a, _ in sorted((t for t in tx if t[1] and t[3] is not None), key=lambda t: (t[1], t[0])):
            if (cat is None or c == cat) and (lo is None or d >= lo) and (hi is None or d < hi):
                spent = round(spent + a, 4)
                for s in shares:
                    if spent >= round(limit * s, 4):
                        out.setdefault((b, s), (d, i, spent))
    return out


@pytest.mark.parametrize("rows", [7, 1_000_000])
def test_equals_a_walk(spark, rows):
    r = random.Random(4)
    d0 = date(2023, 11, 20)
    tx = [(i, r.choice([None] + [d0 + timedelta(r.randint(0, 90))] * 9), r.choice(["a", "a", "b", None]),
           r.choice([None, -20.25, 5.5, 12.75, 30.0]), "x") for i in range(400)]
    limits = [("all", None, None, None, 900.0), ("a", "a", date(2023, 12, 1), date(2024, 1, 15), 200.0),
              ("b", "b", d0 - timedelta(400), None, 100.0), ("b2", "b", None, date(2024, 1, 1), 50.0),
              ("never", "a", date(2030, 1, 1), None, 1.0), ("over", "a", d0, d0, 1.0), ("far", "b", d0, None, 10.0 ** 9),
              ("zero", "a", date(2024, 1, 31), date(2024, 2, 2), 0.0)]
    got = budgets.alerts(spark.createDataFrame(tx, TX), spark.createDataFrame(limits, BUDGET), segment_rows=rows)
    assert got.columns == ["budget_id", "share", "day", "id", "spent"]
    assert {(x.budget_id, x.share): (x.day, x.id, float(x.spent)) for x in got.collect()} == brute(tx, limits)


def test_empty_tables(spark):
    tx, limits = spark.createDataFrame([], TX), spark.createDataFrame([("b", None, None, None, 1.0)], BUDGET)
    assert budgets.alerts(tx, limits).count() == 0
    one = spark.createDataFrame([(1, date(2024, 1, 1), "a", 5.0, "")], TX)
    assert budgets.alerts(one, spark.createDataFrame([], BUDGET)).count() == 0
    assert budgets.alerts(one, limits).count() == 3


def test_no_cross_join(spark):
    tx = spark.createDataFrame([(1, date(2024, 1, 1), "a", 5.0, "")], TX)
    limits = spark.createDataFrame([("b", None, None, None, 1.0), ("c", "a", None, None, 1.0)], BUDGET)
    plan = budgets.matched(tx, limits)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_values_cross_segment_borders(spark):
    r = random.Random(7)
    rows = [(r.choice([None, None, "k", "j"]), i, r.randint(-3, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    summed = segments.running_sum(df, ["k"], [F.col("i")], F.col("v"), "s", 20)
    before = segments.previous(df, ["k"], [F.col("i")], F.col("v"), "p", 20)
    got = {(x.k, x.i): x.s for x in summed.collect()}
    last = {(x.k, x.i): x.p for x in before.collect()}
    for k in (None, "k", "j"):
        total, prev = 0, None
        for _, i, v in sorted((x for x in rows if x[0] == k), key=lambda x: x[1]):
            total += v
            assert got[(k, i)] == total and last[(k, i)] == prev
            prev = v


def test_many_small_segments_share_few_tasks(spark, monkeypatch):
    """The exchange has no more ranges than shuffle partitions, however small the segments are."""
    cut, seen = segments._cut, []
    monkeypatch.setattr(segments, "_cut", lambda *a: (seen.append(cut(*a)), seen[-1])[1])
    df = spark.range(2000).select((F.col("id") % 3 == 0).alias("k"), "id", (F.col("id") % 7).alias("v"))
    got = segments.previous(df, ["k"], [F.col("id")], F.col("v"), "p", 20)
    assert seen[0].rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = [r["count"] for r in seen[0].groupBy("__seg").count().collect()]
    assert len(sizes) >= 100 and max(sizes) <= 20
    last = {}
    for r in got.orderBy("id").collect():
        assert r.p == last.get(r.k), r
        last[r.k] = r.v
