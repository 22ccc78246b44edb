import duckdb

import __spark_entry__ as E
from lakeledger.plans import queries as own


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "valid_from_ts" in df.columns


def test_every_query_has_oracle_or_is_documented():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(own.queries()) == set(own.oracle_sql())


def test_queries_run_on_smoke_data(spark):
    q, sql, con = E.queries(), E.oracle_sql(), duckdb.connect()
    for t in ("events", "part", "nation", "customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{E.SF_SMOKE}/{t}.parquet')")
    for name in ["scd2_full", "dq_silver", "export_incremental", "run_summary",
                 "scalar_slugify", "page_roundtrip", "scd2_null_keys"]:
        got = q[name](spark, E.SF_SMOKE)
        want = con.execute(sql[name])
        cols = [d[0] for d in want.description]
        assert sorted(map(repr, map(tuple, got.select(*cols).collect()))) == sorted(map(repr, want.fetchall())), name
