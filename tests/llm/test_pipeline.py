import public_tokenizers
import tiktoken

import corpus_pipeline
from lakeledger.llm import bpe, pii, quality
from tests.llm.test_decontam import norm
from tests.llm.test_jaccard import brute as components

SF = "/root/testdata/sf0.001"


def test_run_equals_a_plain_version(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    table = spark.read.parquet(f"{SF}/documents.parquet")
    machine = quality.fit(table, spark.read.parquet(f"{SF}/labels.parquet"))
    docs = [d for d in docs if machine.score(*quality.features(d["text"] or "")) >= 0.5]
    first = {d for d, _, c in components([(d["doc_id"], d["text"]) for d in docs]) if d == c}
    docs = [d for d in docs if d["doc_id"] in first]
    windows = set()
    for t in items:
        w = norm(t)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    short = {len(w) for w in windows}
    docs = [d for d in docs if not any(tuple(w[i:i + n]) in windows for w in [norm(d["text"])] for n in short
                                       for i in range(len(w) - n + 1))]
    ranks = bpe.load_ranks(corpus_pipeline.RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {}
    for d in docs:
        text = pii.masked(d["text"] or "", pii.base_spans(d["text"] or ""))
        want[d["doc_id"]] = (text, d["lang"], d["source"], len(text), library.encode_ordinary(text))
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_tokens", "ids"]
    rows = got.collect()
    assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars, r.ids) for r in rows} == want
    assert all(r.n_tokens == len(r.ids) for r in rows) and 0 < len(rows) < table.count()


def test_stages_on_an_empty_table_and_nulls(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    nulls = spark.createDataFrame([(None, None, None, None, None), (1, None, "en", None, 0)], table.schema)
    for docs, n in ((table.limit(0), 0), (nulls, 2)):
        for name, stage in corpus_pipeline.STAGES:
            if name != "quality":
                out = stage(spark, docs, SF)
                assert out.columns[:5] == docs.columns
                assert out.count() == n
