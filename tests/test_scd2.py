import os
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.operators import silver as SV
from lakeledger.operators.silver import OrderItem, Scd2Spec
from tests.walk import walk

SPEC = Scd2Spec(keys=("k",), event_time="ts", event_type="event_type",
                order=(OrderItem("t"),
                       OrderItem("seq")),
                split=1)
SCHEMA = "k string, t bigint, seq bigint, event_type string, ts string"
COLS = ["k", "t", "seq", "version", "valid_from_ts", "valid_to_ts", "is_current",
        "is_active", "is_deleted", "change_type"]


def expected(rows, by_seq_only=False):
    ev = [{"key": k, "ord": (0, 0, s) if by_seq_only else (-1 if t is None else 0, t or 0, s),
           "type": et, "ts": ts, "t": t}
          for k, t, s, et, ts in rows]
    t_of = {(e["key"], e["ord"][2]): e["t"] for e in ev}
    out = []
    for r in walk(ev):
        s = r["ord"][2]
        t = t_of[(r["key"], s)]
        out.append((r["key"], t, s, r["version"], r["valid_from_ts"], r["valid_to_ts"],
                    r["is_current"], r["is_active"], r["is_deleted"], r["change_type"]))
    return sorted(out, key=repr)


def run(spark, rows, form, spec=SPEC):
    df = spark.createDataFrame(rows, SCHEMA)
    h = SV.build_scd2(df, spec, built_at="BUILT", form=form)
    return sorted((tuple(r) for r in h.select(*COLS).collect()), key=repr)


def random_log(rng, n, keys=6, times=5, types=("added", "modified", "removed", " Added ",
                                                  "weird", None)):
    rows, seq = [], 0
    for _ in range(n):
        seq += 1
        t = rng.choice([None] + list(range(times)))
        ts = rng.choice(["", None, "2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z",
                         f"T{t}"])
        rows.append((rng.choice([f"k{i}" for i in range(keys)] + [None]), t, seq,
                     rng.choice(types), ts))
    return rows


@pytest.mark.parametrize("form", ["split", "fast", "definition"])
def test_forms_equal_walk_on_random_log(spark, form):
    rows = random_log(random.Random(7), 1500)
    assert run(spark, rows, form) == expected(rows)


def test_lead_form_equals_when_all_types_known(spark):
    rows = random_log(random.Random(3), 800, types=("added", "modified", "removed"))
    assert run(spark, rows, "lead") == expected(rows)


def test_split_without_rest_columns(spark):
    spec = Scd2Spec(keys=("k",), event_time="ts", event_type="event_type",
                    order=(OrderItem("seq"),), split=1)
    rows = random_log(random.Random(11), 400)
    assert run(spark, rows, "split", spec) == expected(rows, by_seq_only=True)


def test_hot_key_split_equals_walk(spark):
    """One key holds most rows: the split form spreads it over segments."""
    rng = random.Random(5)
    rows = random_log(rng, 3000, keys=1, times=40)
    assert run(spark, rows, "split") == expected(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]),
                          st.one_of(st.none(), st.integers(0, 3)),
                          st.sampled_from(["added", "modified", "removed", "x", "REMOVED"]),
                          st.sampled_from(["", "t1", "t2", None])),
                min_size=0, max_size=25))
def test_property_split_equals_walk(spark, evs):
    rows = [(k, t, i, et, ts) for i, (k, t, et, ts) in enumerate(evs)]
    assert run(spark, rows, "split") == expected(rows)


def test_shuffled_input_same_result(spark):
    rows = random_log(random.Random(9), 600)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    assert run(spark, rows, "split") == run(spark, shuffled, "split")


def test_auto_form_routes_hot_keys(spark):
    """auto = walk, whether keys are routed to split (low threshold) or not."""
    rows = random_log(random.Random(21), 1200, keys=3)
    df = spark.createDataFrame(rows, SCHEMA)
    for hot_rows in (0, 100, 10 ** 9):
        h = SV.build_scd2(df, SPEC, built_at="BUILT", form="auto", hot_rows=hot_rows)
        got = sorted((tuple(r) for r in h.select(*COLS).collect()), key=repr)
        assert got == expected(rows), hot_rows


def _bronze_like(spark, rows):
    """Random log rows as a Bronze-shaped frame (keys item/transaction)."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA)
    return (df.select(F.lit("i").alias("item_id"), F.col("k").alias("transaction_id"),
                      F.col("event_type"),
                      F.format_string("2026-01-%02d", F.coalesce("t", F.lit(0)) + 1)
                      .alias("run_ts"),
                      F.col("seq").cast("string").alias("event_id"),
                      F.lit("p.json").alias("page_name"), F.lit(0).alias("type_ord"),
                      F.col("seq").alias("pos"), F.col("seq").alias("src_seq")))


def test_checks_hold_on_any_built_history(spark):
    from lakeledger.operators import quality as Q
    rows = random_log(random.Random(31), 800)
    h = SV.silver_from_bronze(_bronze_like(spark, rows), built_at="B")
    res = {r["check"]: r["passed"] for r in Q.check_silver(h).collect()}
    assert all(res[c] for c in res if not c.startswith("D6")), res
    known = random_log(random.Random(32), 800, types=("added", "modified", "removed"))
    h = SV.silver_from_bronze(_bronze_like(spark, known), built_at="B")
    assert all(r["passed"] for r in Q.check_silver(h).collect())


@pytest.mark.parametrize("cut", [0, 2, 5])
def test_refresh_equals_rebuild(spark, cut):
    from pyspark.sql import functions as F
    rows = random_log(random.Random(40 + cut), 600, types=("added", "modified", "removed",
                                                            "weird"))
    b = _bronze_like(spark, rows)
    early = F.coalesce(F.col("src_seq"), F.lit(0)) % 7 >= cut  # events that arrived first
    old = SV.silver_from_bronze(b.filter(early), built_at="B")
    new = SV.refresh_scd2(old, b, b.filter(~early), built_at="B")
    full = SV.silver_from_bronze(b, built_at="B")
    cols = ["transaction_id", "version", "valid_from_ts", "valid_to_ts", "is_current",
            "is_active", "change_type", "source_event_id"]
    assert sorted(map(repr, new.select(*cols).collect())) == \
        sorted(map(repr, full.select(*cols).collect()))


def test_range_form_equals_walk(spark):
    """Range segments cut keys whatever the order's columns hold."""
    rows = random_log(random.Random(51), 1500, keys=2, times=2)
    assert run(spark, rows, "range") == expected(rows)


def test_auto_routes_unbounded_spec_to_range_segments(spark, monkeypatch):
    monkeypatch.setattr(SV, "SEGMENT_ROWS", 50)  # many small range segments
    rows = random_log(random.Random(52), 1200, keys=3, times=1)
    df = spark.createDataFrame(rows, SCHEMA)
    h = SV.build_scd2(df, SPEC, built_at="BUILT", form="auto", hot_rows=100)
    got = sorted((tuple(r) for r in h.select(*COLS).collect()), key=repr)
    assert got == expected(rows)


def test_auto_unified_path_for_bounded_segments(spark):
    """Bounded segments: hot keys are cut by the spec's segments in the same
    shuffle as the cold keys."""
    spec = Scd2Spec(keys=("k",), event_time="ts", event_type="event_type",
                    order=SPEC.order, split=1)
    rows = random_log(random.Random(61), 1500, keys=4, times=6)
    df = spark.createDataFrame(rows, SCHEMA)
    for hot_rows in (0, 200, 350, 10 ** 9):
        h = SV.build_scd2(df, spec, built_at="BUILT", form="auto", hot_rows=hot_rows)
        got = sorted((tuple(r) for r in h.select(*COLS).collect()), key=repr)
        assert got == expected(rows), hot_rows


def test_bucket_refresh_in_place_equals_rebuild(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = random_log(random.Random(71), 700, keys=8)
    b = _bronze_like(spark, rows)
    early = F.col("src_seq") % 5 != 0
    path = str(tmp_path / "silver_b")
    SV.write_silver(SV.silver_from_bronze(b.filter(early), built_at="B"), path, buckets=4)
    n = SV.refresh_buckets(spark, b, b.filter(~early), path, built_at="B", buckets=4)
    assert 1 <= n <= 4
    got = SV.read_silver(spark, path)
    full = SV.silver_from_bronze(b, built_at="B")
    cols = ["transaction_id", "version", "valid_from_ts", "valid_to_ts", "is_current",
            "change_type", "source_event_id"]
    assert sorted(map(repr, got.select(*cols).collect())) == \
        sorted(map(repr, full.select(*cols).collect()))


def test_bucket_number_is_the_tables_own(spark, tmp_path):
    import pytest
    from lakeledger.sources import tables as T
    b = _bronze_like(spark, random_log(random.Random(3), 200, keys=6))
    path = str(tmp_path / "s")
    with pytest.raises(T.TableNotFound):
        SV.read_silver(spark, path)
    silver = SV.silver_from_bronze(b, built_at="B")
    SV.write_silver(silver, path, buckets=4)
    SV.refresh_buckets(spark, b, b, path, built_at="B")
    assert SV.read_silver(spark, path).count() == silver.count()
    with pytest.raises(ValueError):
        SV.refresh_buckets(spark, b, b, path, built_at="B", buckets=8)


def test_refresh_reads_the_touched_buckets_of_both_tables(spark, tmp_path):
    from lakeledger.operators import bronze as B
    from lakeledger.sources import layout as L
    b = _bronze_like(spark, random_log(random.Random(9), 400, keys=40))
    bronze, path = str(tmp_path / "b"), str(tmp_path / "s")
    B.append_bronze(b.withColumn("event_year", F.lit(2026).cast("bigint")), bronze, 1, buckets=16)
    assert L.stored(spark, bronze) == 16 and L.stored(spark, str(tmp_path / "no")) is None
    SV.write_silver(SV.silver_from_bronze(B.read_bronze(spark, bronze), built_at="A"), path, L.stored(spark, bronze))
    one = B.read_bronze(spark, bronze).where("transaction_id = 'k3'").limit(1)
    chosen = L.touched(one, 16)
    assert len(chosen) == 1
    here = L.in_buckets(16, chosen)
    for df in (B.read_bronze(spark, bronze, here), SV.read_silver(spark, path, here)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "key_bucket_of_16" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert 0 < len(df.inputFiles()) < 16 or df.count() < 400
    files = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith(L.PREFIX)}
    assert SV.refresh_buckets(spark, bronze, one, path, built_at="C") == 1
    changed = {d for d in files if sorted(os.listdir(f"{path}/{d}")) != files[d]}
    assert changed == {f"{L.column(16)}={chosen[0]}"}
    got = {r.transaction_id for r in SV.read_silver(spark, path).where("silver_built_at = 'C'").collect()}
    assert got == {"k3"}
    with pytest.raises(ValueError):
        SV.write_silver(SV.read_silver(spark, path), path, buckets=8)


def test_null_keys_and_null_against_lowest_value(spark):
    """Null and typed keys, and a null beside the lowest value in the leading
    order column, in every form."""
    from pyspark.sql import functions as F
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 1]), rnd.choice([None, "0001-01-01", "2026-01-01"]), i,
             rnd.choice(["added", "modified", "removed", "x"]), str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "n int, d string, seq int, event_type string, ts string").select(
        F.col("d").cast("date").alias("k1"), F.col("d").cast("date").cast("timestamp").alias("k2"),
        F.col("d").cast("binary").alias("k3"),
        F.when(F.col("n").isNull(), F.lit(None)).otherwise(F.lit(-2 ** 31)).cast("int").alias("o"),
        "seq", "event_type", "ts")
    spec = Scd2Spec(keys=("k1", "k2", "k3"), event_time="ts", event_type="event_type",
                    order=(SV.OrderItem("o"), SV.OrderItem("seq")), split=1)
    got = {}
    for form, hot in (("fast", 0), ("definition", 0), ("split", 0), ("range", 0), ("auto", 0), ("auto", 90)):
        h = SV.build_scd2(df, spec, built_at="B", form=form, hot_rows=hot)
        got[form, hot] = sorted(map(repr, h.select("k1", "seq", "version", "valid_to_ts", "is_current").collect()))
    assert len(got["fast", 0]) > 100 and all(v == got["fast", 0] for v in got.values())


def test_level_two_rows_are_bounded_by_size(spark, monkeypatch):
    """A hot key has about size / SEGMENT_ROWS segments, whatever its pages hold."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(SV, "SEGMENT_ROWS", 500)
    seen = []
    split = SV._split
    monkeypatch.setattr(SV, "_split", lambda df, spec, ords, segments=None: (
        seen.append(df.groupBy("k").agg(F.countDistinct(*segments)).collect()), split(df, spec, ords, segments))[1])
    rows = [("hot", i, i, "added", str(i)) for i in range(4000)] + [("cold", 1, 1, "added", "1")]
    df = spark.createDataFrame(rows, SCHEMA)
    h = SV.build_scd2(df, SPEC, built_at="B", form="auto", hot_rows=100)
    assert h.where("k = 'hot'").agg(F.max("version")).first()[0] == 4000
    assert [r[0] for r in seen[0]] == ["hot"] and seen[0][0][1] <= 8


def test_hot_key_queries_cut_the_hot_key(spark, monkeypatch):
    """Without a patched SEGMENT_ROWS, the queries' hot key has several segments."""
    from pyspark.sql import functions as F
    from lakeledger.plans import queries as Q
    split = SV._split
    for query, keys in ((Q.q_scd2_hot_key, ["item_id", "transaction_id"]), (Q.q_scd2_orders_hot, ["o_custkey"]),
                        (Q.q_scd2_null_keys, ["k_day", "k_flag"])):
        seen = []
        monkeypatch.setattr(SV, "_split", lambda df, spec, ords, segments=None: (
            seen.append(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(*segments).alias("s"))
                        .orderBy(F.desc("n")).first()), split(df, spec, ords, segments))[1])
        query(spark, "/root/testdata/sf0.01")
        assert seen and seen[0].s >= 3, (query, seen)


def test_more_rows_get_more_tasks_than_shuffle_partitions(spark, monkeypatch):
    """A task of the window holds about TASK_ROWS, however large the table."""
    fast, seen = SV._fast, []
    monkeypatch.setattr(SV, "TASK_ROWS", 50, raising=False)
    monkeypatch.setattr(SV, "_fast", lambda df, spec, ords: (seen.append(df.rdd.getNumPartitions()), fast(df, spec, ords))[1])
    rows = random_log(random.Random(54), 1500, keys=60, times=3)
    df = spark.createDataFrame(rows, SCHEMA)
    for hot_rows in (10 ** 9, 25):
        h = SV.build_scd2(df, SPEC, built_at="BUILT", hot_rows=hot_rows)
        assert sorted((tuple(r) for r in h.select(*COLS).collect()), key=repr) == expected(rows)
    assert seen[0] == 30


def test_many_small_segments_share_few_tasks(spark, monkeypatch):
    """The exchange has no more ranges than shuffle partitions, however small a hot key's segments are."""
    split, seen = SV._split, []
    monkeypatch.setattr(SV, "_split", lambda df, spec, ords, segments=None: (
        seen.append((df.rdd.getNumPartitions(), df.select(*segments).distinct().count())),
        split(df, spec, ords, segments))[1])
    rows = random_log(random.Random(53), 1200, keys=3, times=1)
    h = SV.build_scd2(spark.createDataFrame(rows, SCHEMA), SPEC, built_at="BUILT", hot_rows=100, segment_rows=20)
    assert sorted((tuple(r) for r in h.select(*COLS).collect()), key=repr) == expected(rows)
    ranges, pieces = seen[0]
    assert ranges <= int(spark.conf.get("spark.sql.shuffle.partitions")) and pieces >= 40


def test_collapse_unchanged_equals_a_walk(spark):
    from pyspark.sql import functions as F
    r = random.Random(31)
    rows = random_log(r, 500, keys=3)
    b = _bronze_like(spark, rows).withColumns({
        "name": F.element_at(F.array(F.lit("x"), F.lit(""), F.lit(None)), (F.crc32("event_id") % 3 + 1).cast("int")),
        "amount": (F.crc32("event_id") % 2).cast("double")})
    full = schemas.conform(b, schemas.BRONZE)
    order = [F.expr(o.expr).asc_nulls_first() for o in SV.BRONZE_SPEC.order]
    for tracked in (None, ("name",), ("name", "amount")):
        want, last = [], {}
        for e in full.orderBy(*order).collect():
            kind = (e.event_type or "None").strip().lower()
            cells = tuple((getattr(e, c) or None) if c == "name" else getattr(e, c)
                          for c in (tracked or ("name", "amount")))
            state = "removed" if kind == "removed" else cells if kind in ("added", "modified") else None
            if state is None or state != last.get((e.item_id, e.transaction_id)):
                want.append(e.event_id)
            last[e.item_id, e.transaction_id] = state if state is not None else ("?",)
        got = SV.collapse_unchanged(b, tracked, segment_rows=40)
        assert got.columns == b.columns
        assert sorted(x.event_id for x in got.collect()) == sorted(want) and len(want) < 500
