import json
import os

from lakeledger.operators import audit as A
from lakeledger.sources import pages as P
from lakeledger import schemas
from tests.conftest import tx, write_page

RA, RB, RC = ("20260101_000000", "2026-01-01T00:00:00Z"), \
    ("20260102_000000", "2026-01-02T00:00:00Z"), ("20260103_000000", "2026-01-03T00:00:00Z")


def page_set(spark, tmp):
    root = f"{tmp}/raw"
    write_page(root, "bank", "i1", 1, *RA, added=[tx("a"), tx("b")], cursor_in="",
               cursor_out="c1", has_more=True)
    write_page(root, "bank", "i1", 2, *RA, removed=["a"], cursor_in="c1", cursor_out="c2")
    # run B starts where A ended but its last page still says has_more
    write_page(root, "bank", "i1", 1, *RB, modified=[tx("b")], cursor_in="c2",
               cursor_out="c3", has_more=True)
    # run C starts from a cursor nobody handed over: a gap
    write_page(root, "bank", "i1", 1, *RC, added=[tx("d")], cursor_in="zz", cursor_out="c5")
    return P.read_pages(spark, root, "raw/")


def test_page_log_and_run_summary(spark, tmp):
    p = page_set(spark, tmp)
    log = {(r.run_id, r.page): r for r in A.page_log(p).collect()}
    assert (log[(RA[0], 1)].added, log[(RA[0], 2)].removed) == (2, 1)
    runs = {r.run_id: r for r in A.run_summary(p).collect()}
    a = runs[RA[0]]
    assert (a.pages, a.added, a.removed, a.cursor_start, a.cursor_end, a.mode) == \
        (2, 2, 1, "", "c2", "backfill")
    assert runs[RB[0]].mode == "incremental"


def test_unfinished_state_and_gaps(spark, tmp):
    p = page_set(spark, tmp)
    assert [r.run_id for r in A.unfinished_runs(p).collect()] == [RB[0]]
    st = A.cursor_state(p).first()
    assert (st.run_id, st.next_cursor, st.last_page_written) == (RC[0], "c5", 1)
    gaps = A.cursor_gaps(p).collect()
    assert [(g.run_id, g.cursor_in, g.expected_cursor_in) for g in gaps] == [(RC[0], "zz", "c3")]
    assert A.cursor_chain(p).count() == 4


def test_errors_from_runs_log(spark, tmp):
    os.makedirs(f"{tmp}/runs")
    recs = [{"ts": "t", "run_id": "r", "institution": "bank", "item_id": "i1", "mode": "backfill"},
            {"ts": "t", "run_id": "r", "institution": "bank", "item_id": "i1", "mode": "backfill",
             "event": "error", "page": 3, "cursor_in": "c2",
             "error": {"type": "ApiException", "message": "boom", "status": 400,
                       "reason": "Bad Request",
                       "plaid": {"error_code": "ITEM_LOGIN_REQUIRED", "request_id": "q1"}}},
            {"ts": "t", "run_id": "r", "event": "error",
             "error": {"type": "RuntimeError", "message": "wrapped"}}]
    with open(f"{tmp}/runs/runs.jsonl", "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n")
    log = P.read_jsonl_log(spark, f"{tmp}/runs", schemas.RUNS_LOG)
    e = A.errors(log).orderBy("error_type").collect()
    assert [(r.error_type, r.status, r.plaid_error_code) for r in e] == [
        ("ApiException", 400, "ITEM_LOGIN_REQUIRED"), ("RuntimeError", None, None)]


def test_runs_without_a_name_keep_their_pages(spark):
    cols = ("institution string, item_id string, run_id string, run_ts string, page_no long, cursor_in string, "
            "cursor_out string, page_path string, has_more boolean, added array<string>, modified array<string>, "
            "removed array<string>")
    rows = [(inst, item, run, ts, n, "" if n == 1 else f"{ts}{n - 1}", f"{ts}{n}", f"{inst}{item}{run}{n}", False, [], [], [])
            for inst in (None, "b") for item in (None, "i") for run, ts in ((None, "2026-01-01"), ("r", "2026-01-02"))
            for n in (1, 2)]
    chain = A.cursor_chain(spark.createDataFrame(rows, cols))
    assert chain.count() == 16
    assert {(r.run_id, r.page) for r in chain.where("is_gap").collect()} == {("r", 1)}
