import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakeledger.llm import lines

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(docs, least=20, common=3):
    holders = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(doc)
    out = []
    for doc, text in docs:
        every = (text or "").split("\n")
        top = {k: max(h, key=lambda d: (d is not None, d or 0)) for k, h in holders.items() if len(h) >= common}
        stay = [x for x in every if top.get(key(x), doc) == doc]
        out.append((doc, len(every), len(every) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def run(spark, docs, **kw):
    df = spark.createDataFrame([(d, t, 1, "x", b"r") for d, t in docs],
                               "doc_id long, text string, n long, key string, row binary")
    out = lines.drop_repeated(df, **kw)
    assert out.columns == ["doc_id", "n", "key", "row", "n_lines", "n_dropped", "kept"]
    return sorted((tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


def corpus():
    r = random.Random(5)
    pool = [f"{'É' if i % 3 else 'e'}xample line number {i} of the pool" for i in range(40)]
    docs = []
    for i in range(80):
        own = [r.choice(["", " ", "\t"]) + r.choice(pool).upper() if r.random() < 0.2 else r.choice(pool)
               for _ in range(r.randint(1, 4))]
        docs.append((i * 7 % 80, "\n".join(own + [f"a line that only {i} holds", "short one", ""])))
    docs += [(None, pool[0]), (None, pool[0]), (90, None), (91, ""), (92, "\n\n"), docs[3], docs[3], (5, pool[1])]
    return docs + [(i, f"a very common line of all rows\r\nrow {i} and its own line") for i in range(100, 160)]


@pytest.mark.parametrize("batches,fan", [(1, 2), (6, 2), (7, 3)])
def test_equals_brute_force(spark, monkeypatch, batches, fan):
    monkeypatch.setattr(lines.LineRuns.__init__, "__defaults__", (3, fan))
    docs = corpus()
    want = brute(docs)
    assert sum(w[2] for w in want) > 50
    assert run(spark, docs, batches=batches) == want


def test_equal_ids_very_long_texts_and_lines(spark):
    long = "z" * 100_000
    docs = [(i % 4, "\n".join([long, "another line of twenty or more"] * 3)) for i in range(6)]
    docs += [(1, "\n" * 50_000), (9, "another line of twenty or more")]
    assert run(spark, docs) == brute(docs)


def test_runs_hold_new_lines_and_stay_in_place(spark):
    index = lines.LineRuns(spark, "bigint")

    def batch(rows):
        return spark.createDataFrame(rows, "doc long, k string").select("doc", F.encode("k", "utf-8").alias("key"))

    index.add(batch([(9, "a"), (8, "a"), (9, "b")]))
    assert [len(x) for x in index.levels] == [1]
    index.add(batch([(7, "a"), (6, "c")]))
    assert [len(x) for x in index.levels] == [0, 1]  # merged
    index.add(batch([(5, "a"), (5, "b"), (4, "b"), (3, "c")]))
    got = {r.key.decode(): (r.n, r.top) for name in index.runs for r in spark.table(name).collect()
           if name in index.levels[0]}
    assert {bytes(k, "utf-8").decode(): v for k, v in got.items()} == {"b": (2, None), "c": (1, None)}  # a is settled
    index.add(batch([(2, "d")]))
    assert [len(x) for x in index.levels] == [0, 0, 1]
    assert {(bytes(r.key).decode(), r.top) for r in index.common_keys().collect()} == {("a", 9), ("b", 9)}
    with lines._sorted_scans(spark):
        merged = index._merged(index.runs * 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in merged and "Exchange" not in merged and "Sort " not in merged
    index.close()
    assert index.runs == []


def test_empty_table(spark):
    assert run(spark, []) == []
