import json
import random

import pandas as pd
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.operators import bronze as B
from lakeledger.operators import silver as SV
from lakeledger.streaming import versions as V
from tests.conftest import tx, write_page

COLS = ["item_id", "transaction_id", "version", "change_type", "valid_from_ts", "valid_to_ts", "is_current", "is_active",
        "amount", "source_event_id"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def test_equals_batch_history_over_restarts_with_late_events(spark, tmp):
    r = random.Random(12)
    log = [(r.choice(["a", "b", None]), r.choice(["t1", "t2", "t3"]), r.choice(["added", "modified", "removed", "odd"]),
            f"2026-01-{r.randint(1, 28):02d}T00:00:00Z", r.choice([None, "2026-02-01T00:00:00Z"]), f"p{r.randint(0, 3)}",
            r.randint(0, 2), i, f"e{i}", float(i)) for i in range(160)]
    df = spark.createDataFrame(log, "item_id string, transaction_id string, event_type string, run_ts string, "
                               "ingested_at string, page_name string, type_ord int, pos long, event_id string, amount double")
    df = schemas.conform(df.withColumn("event_year", F.lit(2026)), schemas.BRONZE)
    drops = [F.col("pos") % 5 == 0, F.col("pos") % 5 == 1, F.col("pos") % 5 > 1, F.lit(False)]
    for drop in drops:
        df.where(drop).write.mode("append").parquet(f"{tmp}/in")
        stream = spark.readStream.schema(schemas.BRONZE).parquet(f"{tmp}/in")
        V.version_stream(stream, f"{tmp}/b", f"{tmp}/f", f"{tmp}/ck", "B").awaitTermination()
        seen = spark.read.schema(schemas.BRONZE).parquet(f"{tmp}/in")
        assert rows(V.read_history(spark, f"{tmp}/f")) == rows(SV.silver_from_bronze(seen, "B"))
    assert B.read_bronze(spark, f"{tmp}/b").count() == len(log)


def test_events_in_order_are_told_without_a_rebuild(spark, tmp, monkeypatch):
    monkeypatch.setattr(SV, "silver_from_bronze", None)
    root = f"{tmp}/raw"
    for day, kw in ((1, {"added": [tx("a"), tx("b")]}), (2, {"modified": [tx("a", amount=3.0)]}), (3, {"removed": ["a"]})):
        write_page(root, "bank", "i1", 1, f"r{day}", f"2026-01-0{day}T00:00:00Z", **kw)
        V.page_versions(spark, root, f"{tmp}/b", f"{tmp}/f", f"{tmp}/ck", "N", "B").awaitTermination()
    got = [(r.transaction_id, r.version, r.valid_to_ts, r.is_active, r.amount)
           for r in V.read_history(spark, f"{tmp}/f").orderBy("transaction_id", "version").collect()]
    assert got == [("a", 1, "2026-01-02T00:00:00Z", False, 12.5), ("a", 2, "2026-01-03T00:00:00Z", False, 3.0),
                   ("a", 3, None, False, None), ("b", 1, None, True, 12.5)]


def test_a_batch_that_is_tried_again_replaces_itself(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, "r1", "2026-01-01T00:00:00Z", added=[tx("a")])
    V.page_versions(spark, root, f"{tmp}/b", f"{tmp}/f", f"{tmp}/ck", "N", "B").awaitTermination()
    stage = spark.createDataFrame([], V._OUT)
    V.version_batch(spark, stage, 0, f"{tmp}/b", f"{tmp}/f", "B")
    assert V.read_history(spark, f"{tmp}/f").count() == 0


def test_records_of_a_key_leave_the_worker_in_few_rows(monkeypatch):
    """Many records are one row of text, and an unknown type's place is read once."""
    class State:
        exists = False
        def update(self, row):
            self.text, = row
    place, read = V._place, []
    monkeypatch.setattr(V, "_place", lambda text: (read.append(text), place(text))[1])
    order = [json.dumps([str(i), "", "p", "0", "0", f"e{i}"]) for i in range(200)]
    rows = pd.DataFrame({"order": order[::-1], "ts": [f"t{i}" for i in range(200)][::-1],
                         "kind": ["odd" if i else "added" for i in range(200)][::-1], "row": ["{}"] * 200})
    state = State()
    frame, = V._advance(("added",))(("i", None), [rows], state)
    assert len(frame) == 1 and len(read) == 200
    records = json.loads(frame.told[0])
    assert [r["kind"] for r in records] == ["event"] * 200 + ["version"]
    assert records[-1]["version"] == 1 and records[-1]["valid_to_ts"] == "t199" and not records[-1]["is_current"]
    assert len(json.loads(state.text)["after"]) == 199
