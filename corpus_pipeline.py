"""The document pipeline: five stages, each written as Parquet and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.llm import blobs, decontaminate, jaccard, linefreq, pieces
from corpusq.llm.common import scratch_path, written
from corpusq.llm.queries import MODEL_PATH

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _sized(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with ``n_chars`` for the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _row_key() -> F.Column:
    """Id and a hash of the text: tells apart rows that share an id or have none."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines are cut out; documents that fail the base rules or are depleted go."""
    docs = docs.select(*COLUMNS)
    judged = linefreq.apply_line_limits(docs).filter("kept")
    return _sized(judged.withColumn("text", F.col("clean_text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every class stays; of rows with that id, one.

    A document without words is a class of its own and stays. Without any id in a class one of its rows stays.
    """
    docs = docs.select(*COLUMNS)
    classes = jaccard.near_duplicates(docs.select(_row_key().alias("key"), "text"), "key")
    ids = docs.select(_row_key().alias("key"), "doc_id").distinct()
    least = (
        classes.select("id", "class_id")
        .distinct()
        .join(ids, F.col("id") == F.col("key"))
        .groupBy("class_id")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("kept"))
        .select(F.col("kept.id").alias("kept"))
    )
    once = docs.withColumn("_key", _row_key()).join(least, F.col("_key") == F.col("kept"), "left_semi")
    return once.dropDuplicates(["_key"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    docs = docs.select(*COLUMNS)
    index = decontaminate.build_index(docs.select(_row_key().alias("key"), "text"), "key")
    windows = decontaminate.item_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = decontaminate.search(index, windows, near=False).filter("n_hit > 0").select(F.col("id").alias("hit")).distinct()
    return docs.withColumn("_key", _row_key()).join(hit, F.col("_key") == F.col("hit"), "left_anti").select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    docs = docs.select(*COLUMNS)
    found = blobs.scan_versions(docs, scratch_path(spark, "ledger"))
    return _sized(blobs.redact(found))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, restored)``: the token ids of every document."""
    return pieces.encode(docs, pieces.load_model(MODEL_PATH, "bpe")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("SentencePiece encoding", encoding),
]

#: Tokenisation and the near-duplicate classes are not expressible in SQL; the tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
