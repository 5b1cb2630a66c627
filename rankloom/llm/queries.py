"""The operators' queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import (
    alignment,
    decontamination,
    lexical_search,
    license_scan,
    mixing,
    ngram_join,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_files,
    toxicity,
    url_filters,
    warc_archives,
)
from rankloom.llm.columns import table
from rankloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"

# The rules that every URL is judged by.
URL_RULES = """
    SELECT * FROM VALUES
        ('org', '/', 'allow'),
        ('example.org', '/es/', 'block'),
        ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'),
        ('com', '/de/', 'block')
    AS rules(host, path, verdict)
"""


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.write_and_read(docs, public_tokenizers.path(TOKENIZER))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("detections")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.links_per_row(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.report(docs, items).drop("spans")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archives.write_and_read(table(spark, sf_dir, "pages"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.cut(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(table(spark, sf_dir, "documents"))
    return lexical_search.search(index, table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ALIGNED)
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


_QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_toxicity": op2_toxicity,
    "op3_quality_rules": op3_quality_rules,
    "op4_url_filters": op4_url_filters,
    "op5_token_files": op5_token_files,
    "op6_license_scan": op6_license_scan,
    "op7_ngram_join": op7_ngram_join,
    "op8_decontamination": op8_decontamination,
    "op9_secret_scan": op9_secret_scan,
    "op10_warc_archives": op10_warc_archives,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_alignment": op13_alignment,
}


def _tuned(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run


QUERIES = {name: _tuned(query) for name, query in _QUERIES.items()}
