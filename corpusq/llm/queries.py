"""One query per operator over the whole tables, with the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.llm import blobs, decontaminate, jaccard, linefreq, oracles, pieces, pseudonyms, ranking, repair, sharding, spans, tokencache, toxicity, whitening
from corpusq.llm.common import held_out, scan_documents, scratch_path

SHARDS = 24
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
TOKENIZER_PATH = "/opt/tokenizers/word_bpe_49k.json"
TOKEN_LIMIT = 2048
#: The key of the registered query; a user of the operator keeps their own secret.
DEMO_KEY = b"pseudonym key of the registered query"


def _joined(found, kinds=None):
    """``kind:start:end`` of the findings, comma-joined in their order."""
    chosen = F.filter(found, lambda x: x["kind"].isin(*kinds)) if kinds else found
    one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    return F.array_join(F.transform(chosen, one), ",")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load_model(MODEL_PATH, "bpe")
    encoded = pieces.encode(scan_documents(spark, sf_dir, "doc_id", "text"), model)
    return encoded.withColumnRenamed("id", "doc_id")


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = spans.remove_repeated_spans(scan_documents(spark, sf_dir, "doc_id", "text"))
    return cut.select(
        F.col("id").alias("doc_id"), "n_sentences", "n_removed", "removed_words", "spans", "clean_text"
    )


def op3_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.build_index(scan_documents(spark, sf_dir, "doc_id", "text"))
    windows = decontaminate.item_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = decontaminate.search(index, windows)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near",
    )


def op4_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(scan_documents(spark, sf_dir, "doc_id", "text")).withColumnRenamed("id", "doc_id")


def op5_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_documents(spark, sf_dir, "doc_id", "text")
    found = blobs.scan_versions(docs, scratch_path(spark, "ledger"))
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = [r.name for r in blobs.BASE_RULES]
    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(_joined(F.col("found"), base), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        "blob",
    )


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_documents(spark, sf_dir, "doc_id", "source", "text")
    judged = linefreq.apply_line_limits(docs)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed_lines", "n_removed_words",
    )


def _training_labels(spark: SparkSession, sf_dir: str, parts: int, part: int) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.filter(~held_out(F.col("doc_id"), parts, part))


def op7_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_documents(spark, sf_dir, "doc_id", "lang", "text")
    model = toxicity.train(docs, _training_labels(spark, sf_dir, 4, 2))
    return toxicity.score(docs, model).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


def op8_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = pseudonyms.pseudonymise(scan_documents(spark, sf_dir, "doc_id", "text"), DEMO_KEY)
    return changed.withColumnRenamed("id", "doc_id")


def op9_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_documents(spark, sf_dir, "doc_id", "text")
    placed = sharding.shuffled_shards(docs, SHARDS)
    return placed.select(
        "doc_id",
        sharding.record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_pairwise_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_documents(spark, sf_dir, "doc_id", "text")
    model = ranking.train(docs, _training_labels(spark, sf_dir, 5, 0))
    return ranking.score(docs, model).select(
        F.col("id").alias("doc_id"),
        held_out(F.col("id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= ranking.CUT).cast("int").alias("predicted"),
    )


def op11_cyk_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    plans, rows = repair.repair(repair.damaged(conversations))
    ids = conversations.select("conv_id").distinct().withColumn("conv", repair.conversation_key(F.col("conv_id")))
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        ids.join(plans, "conv", "left")
        .join(repair.repaired_digests(rows), "conv", "left")
        .select(
            "conv_id",
            *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op12_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan_documents(spark, sf_dir, "doc_id", "text")
    counter = tokencache.load_counter(TOKENIZER_PATH)
    counted = tokencache.count_tokens(docs, counter, scratch_path(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op13_spectrum_slicing(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "pair")
    return white.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", pairs).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("pair.whitened").alias("whitened"),
        F.col("pair.explained").alias("explained"),
        "identity_error",
    )


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_sentencepiece,
        op2_sentence_spans,
        op3_positional_index,
        op4_lsh_forest,
        op5_blob_ledger,
        op6_line_frequency,
        op7_convolution,
        op8_feistel_pseudonyms,
        op9_external_shuffle,
        op10_pairwise_ranking,
        op11_cyk_repair,
        op12_digest_cache,
        op13_spectrum_slicing,
    )
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
