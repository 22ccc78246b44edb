"""The registered queries opN_<name>: each applies its operator, with the
parameters of production, to the whole of its table."""

from __future__ import annotations

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import (bpe, decontam, html_extract, jaccard, langid, lexical, lines, pii, quality, spelling,
                            urlfilter, vectors, warc)
from lakeledger.llm.util import shared_path, table

PIECES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.archive(table(spark, sf_dir, "pages"), shared_path(spark, "warc"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, PIECES)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.scan(table(spark, sf_dir, "documents").select("doc_id", "text"),
                        table(spark, sf_dir, "benchmark"))
    return out.drop("spans")


#: (verdict, host and path).
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = urlfilter.judge(pages.select("page_id", "url"), RULES, urlfilter.fit(pages))
    return out.select("page_id", "host", "path", "rule", "verdict", "log_odds")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, machine).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_embeddings": op3_embeddings,
    "op4_html": op4_html,
    "op5_warc": op5_warc,
    "op6_jaccard": op6_jaccard,
    "op7_langid": op7_langid,
    "op8_decontamination": op8_decontamination,
    "op9_url_filter": op9_url_filter,
    "op10_quality": op10_quality,
    "op11_lexical": op11_lexical,
    "op12_spelling": op12_spelling,
    "op13_lines": op13_lines,
}

ORACLE: dict[str, str] = {
    "op5_warc": warc.ORACLE,
    "op6_jaccard": jaccard.ORACLE,
    "op8_decontamination": decontam.ORACLE,
    "op11_lexical": lexical.ORACLE,
    "op12_spelling": spelling.ORACLE,
    "op13_lines": lines.ORACLE,
}
