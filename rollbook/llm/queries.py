"""One query per operator, each over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, stored
from . import bpe, chat, decontaminate, licenses, minhash, periodic_runs, prefix_forest, quality_classifier, quality_rules, secrets, suffix_dedup, token_alignment, token_shards


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), stored)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model).select("doc_id", quality_classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    probe = "\\### Assistant: </turn> ok"
    messages = messages.unionByName(spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id bigint, turn bigint, role string, text string"))
    formatted = chat.read_back(chat.render(chat.fold_events(chat.events_of_messages(messages))))
    turns = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    return formatted.select(F.col("conv").alias("conv_id"), F.size("messages").cast("bigint").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
                            F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licenses.scan(_table(spark, sf_dir, "documents"))
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda d: d["label"]))), ",")
    return out.select("doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(F.transform("base", lambda d: d["first"])).alias("first_word"),
                      F.array_max(F.transform("base", lambda d: d["first"])).alias("last_word"), labels("base").alias("base_labels"), labels("detections").alias("labels"), "score")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each leak: document, test item, place and score."""
    docs = decontaminate.add_leaks(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


RANK_FILE = "byte_bpe_50k.tiktoken"


def tokenizer() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the public byte-level tokenizer, read on the driver."""
    import public_tokenizers
    return bpe.load_ranks(public_tokenizers.path(RANK_FILE)), public_tokenizers.PATTERN


def op7_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = tokenizer()
    encoded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, pattern)
    told = encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), "ids")
    return bpe.decode(told, ranks, keep=("doc_id", "n_tokens", "ids_sha256")).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are the owners; a source's documents in one language are a repository."""
    docs = _table(spark, sf_dir, "documents")
    out = secrets.find_secrets(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"), keep=("doc_id",))
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = F.filter("found", lambda s: s["kind"].isin(*secrets.BASE))
    return out.select("doc_id", *[of_kind(k) for k in secrets.BASE],
                      F.sha2(told(base), 256).alias("base_sha256"), told("spans").alias("spans"),
                      F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"))


SHUFFLE_KEY = 20250101


def op9_token_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents in training order: the shards are written and read back, one row for each sequence."""
    ranks, pattern = tokenizer()
    width, end, pad = token_shards.closing_ids(max(ranks.values()) + 1)
    ids = stored(bpe.encode(_table(spark, sf_dir, "documents"), ranks, pattern, keep=(), width=width), "zstd", token_shards.LEVEL)
    folder = token_shards.new_folder(spark)
    manifest, total = token_shards.write_shards(ids, F.col("ids"), folder, SHUFFLE_KEY, width=width, end=end, pad=pad)
    manifest = stored(manifest)
    return token_shards.describe(token_shards.read_shards(spark, folder, width=width), total, SHUFFLE_KEY, width, end, pad) if total else manifest.select(
        F.col("shard").alias("slot"), F.col("shard").alias("sequence"), F.col("shard").alias("n_ids"), F.col("shard").alias("n_ends"), F.col("sha256").alias("ids_sha256"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    aligned = token_alignment.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
    told = ("doc_id", "n_a", "n_b", "n_groups", "n_links")
    aligned = token_alignment.with_row_numbers(aligned.select(*told, F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"), "pairs", "counts"))
    counts = stored(token_alignment.pair_counts(aligned))
    return token_alignment.score(aligned, counts, keep=(*told, "groups_sha256")).select(*told, "n_best", "count_sum", "groups_sha256")


def op12_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by the checksum of their id, with words that repeat from some place on; the others as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def planted(w):
        n, g = F.size(w).cast("bigint"), F.expr("crc32(cast(doc_id as string)) div 10")
        start = g % n
        period = F.floor((n - start) / (g % 8 + 3)) + 1
        turned = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(w, F.when(i < start, i).otherwise(start + (i - start) % period).cast("int")))
        return F.when(n > 0, F.array_join(turned, " ")).otherwise(F.lit(""))

    return docs.select("doc_id", F.when(h % 10 == 0, let(words, planted)).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic_runs.find_runs(with_planted_periods(_table(spark, sf_dir, "documents")))
    # the greatest length / period, compared as products
    before = lambda a, b: F.when(a["length"] * b["period"] != b["length"] * a["period"], F.signum(b["length"] * a["period"] - a["length"] * b["period"])).when(
        a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int")
    out = out.withColumn("_best", F.get(F.array_sort("runs", before), F.lit(0)))
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return out.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
                      F.expr("1000 * _best.length div _best.period").alias("exponent_milli"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_quality_rules, op3_chat_formatting, op4_quality_classifier, op5_license_scans, op6_benchmark_decontamination, op7_byte_level_bpe, op8_secret_scans, op9_token_id_shards, op10_suffix_array_dedup, op11_cross_tokenizer_alignment, op12_hash_prefix_forest, op13_periodic_runs)}
SQL = {"op3_chat_formatting": r"""
WITH m AS (SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '<', '\l'), '#', '\h') AS body, replace(replace(replace(replace(role, '\', '\b'), '<', '\l'), '#', '\h'), ':', '\c') AS head FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn>### ') + length(head) + length(': ') + length(body) + length('</turn>' || chr(10)))::BIGINT AS formatted_chars FROM e GROUP BY conv_id"""}
