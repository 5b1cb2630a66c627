"""A corpus from raw documents to token files, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as
Parquet and read again as the next one's documents. All but the last return
the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rankloom.llm import decontamination, mixing, ngram_join, quality_rules, token_files
from rankloom.llm.columns import table
from rankloom.llm.queries import TOKENIZER
from rankloom.session import tune
from rankloom.staging import stage


# Workers have served other stages before the last, and keep less for it than it takes alone.
WORDS_KEPT = 1 << 16


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    tune(spark)
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word Jaccard 0.8 or more connect."""
    tune(spark)
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark items cover less than a twentieth, without what they cover."""
    tune(spark)
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, none above its target share."""
    tune(spark)
    return mixing.keep_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document what its token file says of it."""
    tune(spark)
    return token_files.write_and_read(docs, public_tokenizers.path(TOKENIZER), WORDS_KEPT)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

# MinHash, the hash order of the mix and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each read back from what the one before wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
