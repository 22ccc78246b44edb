import json
import os

from lakeledger.operators import bronze as B
from lakeledger.operators import silver as SV
from lakeledger.streaming import streams
from tests.conftest import tx, write_page

R1, R2 = ("20260101_000000", "2026-01-01T00:00:00Z"), ("20260102_000000", "2026-01-02T00:00:00Z")
COLS = ["item_id", "transaction_id", "version", "change_type", "valid_from_ts",
        "valid_to_ts", "is_current", "is_active"]


def rows(df, cols=COLS):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bronze_stream_equals_batch_and_restart_adds_nothing(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a"), tx("b")], removed=["z"])
    q = streams.bronze_stream(spark, root, f"{tmp}/sb", f"{tmp}/ck", now="N", prefix="raw/")
    q.awaitTermination()
    write_page(root, "bank", "i1", 1, *R2, modified=[tx("a")], removed=["b"])
    for _ in range(2):
        q = streams.bronze_stream(spark, root, f"{tmp}/sb", f"{tmp}/ck", now="N", prefix="raw/")
        q.awaitTermination()
    B.ingest(spark, root, f"{tmp}/bb", f"{tmp}/led", now="N", prefix="raw/")
    cols = ["event_id", "event_type", "transaction_id", "page_path", "amount", "pos"]
    assert rows(B.read_bronze(spark, f"{tmp}/sb"), cols) == \
        rows(B.read_bronze(spark, f"{tmp}/bb"), cols)
    assert B.read_bronze(spark, f"{tmp}/sb").count() == 5


def test_silver_stream_equals_rebuild(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R2, added=[tx("a")])
    q = streams.silver_stream(spark, root, f"{tmp}/b", f"{tmp}/s", f"{tmp}/ck", now="N",
                              built_at="B", prefix="raw/")
    q.awaitTermination()
    # a late page (older run) re-numbers the versions of key a
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a")], removed=["x"])
    q = streams.silver_stream(spark, root, f"{tmp}/b", f"{tmp}/s", f"{tmp}/ck", now="N",
                              built_at="B", prefix="raw/")
    q.awaitTermination()
    streamed = SV.read_silver(spark, f"{tmp}/s")
    rebuilt = SV.silver_from_bronze(B.read_bronze(spark, f"{tmp}/b"), built_at="B")
    assert rows(streamed) == rows(rebuilt)
    a = [r for r in rows(streamed) if r[1] == "a"]
    assert [(r[2], r[4]) for r in a] == [(1, R1[1]), (2, R2[1])]


def test_lines_stream_keeps_no_state_and_drops_pages_that_land_again(spark, tmp):
    os.makedirs(f"{tmp}/in")

    def land(name, *ids):
        with open(f"{tmp}/in/{name}.json", "w") as f:
            for i in ids:
                f.write(json.dumps({"run_id": "r", "run_ts": R1[1], "item_id": "i", "page_path": f"p{i}",
                                    "added": [{"transaction_id": f"t{i}"}], "page_name": f"page_{i}_r.json"}) + "\n")
    for name, ids in (("a", (1, 2, 2)), ("b", (2, 3)), ("c", (3,)), (None, ())):
        if name:
            land(name, *ids)
        q = streams.bronze_stream(spark, f"{tmp}/in", f"{tmp}/b", f"{tmp}/ck", now="N", layout="lines")
        q.awaitTermination()
    assert sorted(r.transaction_id for r in B.read_bronze(spark, f"{tmp}/b").collect()) == ["t1", "t2", "t3"]
    assert not os.path.exists(f"{tmp}/ck/state")


def test_a_batch_that_is_tried_again_counts_once(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a"), tx("b")])
    pages = B.P.read_pages(spark, root)
    for _ in range(2):
        streams.silver_batch(spark, pages, 0, f"{tmp}/b", f"{tmp}/s", "N", "B")
    assert B.read_bronze(spark, f"{tmp}/b").count() == 2
    assert SV.read_silver(spark, f"{tmp}/s").count() == 2


def test_silver_stream_bucketed_equals_rebuild(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *R2, added=[tx("a"), tx("b")])
    kw = dict(now="N", built_at="B", prefix="raw/")
    streams.silver_stream(spark, root, f"{tmp}/b", f"{tmp}/s", f"{tmp}/ck", **kw) \
        .awaitTermination()
    write_page(root, "bank", "i1", 1, *R1, added=[tx("a")], removed=["x"])
    streams.silver_stream(spark, root, f"{tmp}/b", f"{tmp}/s", f"{tmp}/ck", **kw) \
        .awaitTermination()
    streamed = SV.read_silver(spark, f"{tmp}/s")
    rebuilt = SV.silver_from_bronze(B.read_bronze(spark, f"{tmp}/b"), built_at="B")
    assert rows(streamed) == rows(rebuilt)
