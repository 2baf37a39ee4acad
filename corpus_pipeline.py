"""Documents to training text in five stages, each an operator of ``rollbook.llm``. A stage's result is written and read again as the next one's documents.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``. The columns that an operator does not read travel as one struct beside those it
does, so no column of the input can clash with an operator's own, and no text is carried twice.

Cases, beside those of the operators: rows with a null id are never dropped for it; of rows that repeat an id, the near-duplicate stage keeps one;
null texts go on as null until they are encoded, to no ids; empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rollbook.llm import bpe, decontaminate, minhash, quality_classifier, queries, secrets
from rollbook.llm.common import stored


def _boxed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and all others as the struct ``_row``: each value travels once."""
    rest = [c for c in docs.columns if c not in columns]
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in rest] or [F.lit(0).alias("_")]).alias("_row"), *columns)


def _unboxed(rows: DataFrame, docs: DataFrame, *columns: str, **new: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them with new values."""
    return rows.select(*[(new[c] if c in new else F.col(c if c in columns else f"_row.`{c}`")).alias(c) for c in docs.columns])


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects. It learns from the labels of the documents given."""
    model = quality_classifier.train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _unboxed(quality_classifier.score(_boxed(docs, "text"), model).filter(F.col("predicted") == 1), docs, "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of the smallest id."""
    kept = minhash.near_duplicates(docs.select("doc_id", "text")).filter("kept and doc_id is not null").select("doc_id").distinct()
    rows = _boxed(docs.filter("doc_id is not null"), "doc_id", "text").join(kept, "doc_id", "left_semi")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    rows = rows.withColumn("_nth", F.row_number().over(first)).filter("_nth = 1")
    return _unboxed(rows, docs, "doc_id", "text").unionByName(docs.filter("doc_id is null"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a test item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _unboxed(decontaminate.add_leaks(_boxed(docs, "text"), items).filter(F.size("leaks") == 0), docs, "text")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in place of every live-looking secret; copied examples stay. ``n_chars`` follows the text."""
    held = ("text", "source", "lang")
    found = secrets.find_secrets(_boxed(docs, *held), owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"), keep=("_row", *held))
    live = F.filter("spans", lambda s: s["live"])
    rows = found.select("_row", *held, F.when(F.size(live) > 0, secrets.redact(F.col("text"), live)).otherwise(F.col("text")).alias("_clean"))
    new = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_clean") == F.col("text"), F.col("_row.n_chars")).otherwise(F.length("_clean").cast(docs.schema["n_chars"].dataType))
    return _unboxed(rows, docs, *held, **new)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text and decode it again: ``doc_id, lang, source, n_tokens, ids, same`` (whether the bytes came back)."""
    ranks, pattern = queries.tokenizer()
    rows = docs.select(F.struct("doc_id", "lang", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")).alias("_row"), "text")
    back = bpe.decode(bpe.encode(rows, ranks, pattern, keep=("_row",)), ranks, keep=("_row", "ids"))
    return back.select("_row.doc_id", "_row.lang", "_row.source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("_row.h")).alias("same"))


STAGES = [("quality classifier", classify), ("MinHash near-dedup", near_dedup), ("benchmark decontamination", decontaminated), ("secret scans", without_secrets),
          ("byte-level BPE", tokenize)]

#: The classifier, the signatures and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
