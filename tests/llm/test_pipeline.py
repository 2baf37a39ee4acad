"""The pipeline as a whole: against the stages' operators on a small corpus, and on awkward input."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F
from rollbook.llm import queries

DIR = "/root/testdata/sf0.001"


def test_pipeline_decisions(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    out = corpus_pipeline.run(spark, DIR)
    assert set(out.columns) == {"doc_id", "lang", "source", "n_tokens", "ids", "same"}
    rows = out.select("doc_id", "n_tokens", "same").collect()
    assert all(r.same for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    kept = {r.doc_id for r in rows}
    leaked = {r.doc_id for r in queries.op6_benchmark_decontamination(spark, DIR).collect()}
    assert not kept & leaked
    n = docs.count()
    assert 0.5 * n < len(kept) < n


def test_stages_keep_columns_and_odd_rows(spark, tmp_path):
    rows = [(None, "text without an id " * 5, None, None, None, "x"), (1, None, "en", "s", 0, "y"), (2, "", "en", "s", 0, None), (3, "one two three four five six", "en", "s", 27, "z"), (3, "one two three four five six", "en", "s", 27, "z"),
            (4, "password = hunter2222222 and some words", "en", "s", 39, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")
    docs = docs.withColumn("predicted", F.lit("p")).withColumn("leaks", F.lit("l")).withColumn("found", F.lit("f")).withColumn("ids", F.lit("i"))
    for part in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, part, DIR)
            assert out.columns == docs.columns, name
            got = out.collect()
            assert all(r.predicted == "p" and r.leaks == "l" and r.found == "f" for r in got), name
            if name == "MinHash near-dedup" and part is docs:
                assert sorted(r.doc_id or 0 for r in got) == [0, 1, 2, 3, 4]
            if name == "secret scans" and part is docs:
                assert len(got) == len(rows) and {r.text for r in got if r.doc_id == 4} == {"[SECRET] and some words"} and {r.n_chars for r in got if r.doc_id == 4} == {23}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DIR).collect()
    assert len(last) == len(rows) and all(r.same for r in last)
