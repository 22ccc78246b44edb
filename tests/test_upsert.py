import random

import pytest

from lakeledger.operators.upsert import UpsertTable, _sorted_scans
from lakeledger.sources.tables import TableNotFound

COLS = "a string, b int, seq int, kind string, v double, key string"


def table(spark, tmp):
    return UpsertTable(spark, ["a", "b"], ["seq"], "kind = 'removed'", tmp)


def test_late_and_repeated_deltas_with_deletes(spark, tmp):
    r = random.Random(2)
    rows = [(r.choice([None, "x", "None", "y"]), r.choice([None, 1, 2]), i, r.choice(["added", "modified", "removed", None]),
             float(i), "clash") for i in range(90)]
    parts = [rows[:30], rows[60:], rows[30:60], rows[30:60], []]
    t = table(spark, tmp)
    with pytest.raises(TableNotFound):
        t.read()
    seen = []
    for part in parts:
        t.apply(spark.createDataFrame(part, COLS))
        seen += part
        last = {}
        for row in sorted(seen, key=lambda x: x[2]):
            last[row[:2]] = row
        want = sorted((x for x in last.values() if x[3] != "removed"), key=repr)
        assert sorted((tuple(x) for x in t.read().collect()), key=repr) == want


def test_base_is_not_moved_and_old_tables_go(spark, tmp):
    import os
    t = table(spark, tmp)
    for i in range(3):
        t.apply(spark.createDataFrame([("x", k, i, "added", 1.0, "") for k in range(50)], COLS))
    with _sorted_scans(spark):
        plan = t.merged(spark.createDataFrame([("x", 1, 9, "added", 1.0, "")], COLS))._jdf.queryExecution().executedPlan().toString()
    base = plan.split("SortMergeJoin")[1].split("Scan parquet")[0]
    assert "Exchange" not in base and "Sort [" not in base and "Bucketed: true" in plan
    assert len(os.listdir(tmp)) == 1
