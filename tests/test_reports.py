import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest

from lakeledger.operators import reports
from lakeledger.sources.tables import TableNotFound

COLS = "k int, date string, amount double, pfc_primary string, is_active boolean"


def recount(rows):
    out = defaultdict(lambda: [0, Decimal(0)])
    for _, d, a, c, active in rows:
        if not active:
            continue
        day = None if d in (None, "soon") else date.fromisoformat(d)
        key = (day.strftime("%Y-%m") if day else "none", day - timedelta(day.weekday()) if day else None, c or "none")
        out[key][0] += 1
        out[key][1] += Decimal(str(a or 0))
    return {k: tuple(v) for k, v in out.items() if v[0] or v[1]}


def stored(spark, path, months=None):
    return {(r.month, r.week, r.category): (r.n, r.amount) for r in reports.read_report(spark, path, months).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_refreshes_equal_a_recount_and_can_be_repeated(spark, tmp):
    r = random.Random(1)

    def row(k):
        d = r.choice([None, "soon"] + [f"2024-0{m}-{r.randint(1, 28):02d}" for m in (1, 2, 3)])
        return (k, d, r.choice([None, round(r.uniform(-50, 90), 2)]), r.choice([None, "", "food", "rent"]), r.random() < 0.8)
    now = {k: row(k) for k in range(120)}
    reports.add(reports.totals(frame(spark, list(now.values()))), tmp + "/r", 1)
    assert stored(spark, tmp + "/r") == recount(now.values())
    for n in (2, 3):
        touched = r.sample(sorted(now), 40) + [1000 + n]
        before = [now[k] for k in touched if k in now]
        for k in touched:
            now[k] = row(k)
        change = reports.difference(frame(spark, before), frame(spark, [now[k] for k in touched]))
        reports.add(change, tmp + "/r", n)
        reports.add(change, tmp + "/r", n)  # the job was lost and run again
        assert stored(spark, tmp + "/r") == recount(now.values())
    reports.compact(spark, tmp + "/r", tmp + "/c")
    assert stored(spark, tmp + "/c") == recount(now.values())
    nothing = reports.difference(frame(spark, list(now.values())), frame(spark, list(now.values())))
    assert nothing.isEmpty()


def test_reads_only_the_months_asked_for(spark, tmp):
    rows = [(i, f"2024-{m:02d}-05", 1.0, "a", True) for i, m in enumerate(range(1, 13))]
    reports.add(reports.totals(frame(spark, rows)), tmp + "/r", 1)
    df = reports.read_report(spark, tmp + "/r", ["2024-03", "2024-04"])
    assert {r.month for r in df.collect()} == {"2024-03", "2024-04"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan and "2024-03" in plan
    (reports.add(reports.totals(frame(spark, [(99, "2024-03-06", 2.0, "a", True)])), tmp + "/r", 2))
    import os
    assert [x for x in os.listdir(tmp + "/r/refresh=2") if x.startswith("month")] == ["month=2024-03"]


def test_roll_up_has_each_level(spark, tmp):
    rows = [(1, "2024-01-31", 1.0, "a", True), (2, "2024-02-01", 2.0, "b", True), (3, "2024-02-20", 4.0, "a", True)]
    got = {(r.level, r.month, str(r.week) if r.week else None, r.category): float(r.amount)
           for r in reports.roll_up(reports.totals(frame(spark, rows))).collect()}
    assert got[("all", None, None, None)] == 7 and got[("week", None, "2024-01-29", None)] == 3
    assert got[("month", "2024-02", None, None)] == 6 and got[("category", None, None, "a")] == 5
    assert got[("week+category", None, "2024-01-29", "b")] == 2 and got[("month+category", "2024-02", None, "a")] == 4


def test_empty_tables(spark, tmp):
    assert reports.totals(frame(spark, [])).count() == 0
    with pytest.raises(TableNotFound):
        reports.read_report(spark, tmp + "/none")
