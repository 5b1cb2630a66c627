"""The registered queries: against their SQL, and the pipeline against brute force."""

from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from comparing import kinds_of_spark, kinds_of_sql, plan_of, rows_of_spark, rows_of_sql, tables_of
from test_native import quality_by_hand
from test_tasks import hits_by_hand, links_by_hand

import corpus_pipeline
from rankloom.llm import mixing, quality_rules
from rankloom.llm.oracle import ORACLE
from rankloom.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PYTHON = ("EvalPython", "InPandas", "InArrow")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = tables_of(SF_DIR)
    df = QUERIES[name](spark, SF_DIR)
    assert kinds_of_spark(df) == kinds_of_sql(connection, ORACLE[name])
    assert rows_of_spark(df) == rows_of_sql(connection, ORACLE[name])


@pytest.mark.parametrize("number", [1, 3, 4, 6, 9])
def test_native_plans_hold_no_python(spark, number):
    name = next(n for n in QUERIES if n.startswith(f"op{number}_"))
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not [word for word in (*PYTHON, "CartesianProduct", "NestedLoop") if word in plan]


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    verdicts = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    rows = [r for r in rows if verdicts[r[0]]]
    assert not any(quality_by_hand(text)[-1] for _, text in rows)
    _, groups = links_by_hand(rows)
    firsts = {min(rows[i][0] for i in members) for members in groups.values()}
    rows = [r for r in rows if r[0] in firsts]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = [r for r in rows if not hits_by_hand(r[1], items)[-1]]
    left = docs.where(docs.doc_id.isin([i for i, _ in rows]))
    mixed = {r.doc_id for r in mixing.mix(left).collect() if r.in_mix}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, expected = 0, []
    for doc_id, text in sorted(r for r in rows if r[0] in mixed):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == expected
    assert len(corpus_pipeline.STAGES) == 5
