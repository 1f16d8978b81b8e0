"""Global shuffle of records into shards by two external passes, in DataFrame functions only.

Pass one scatters the records uniformly, by a seeded hash of id and content, into
buckets small enough for one task's memory. Pass two permutes each bucket (Spark's
``shuffle`` function is a Fisher-Yates shuffle) with a seed of its own. The buckets
in order give one random order of all records, which is cut into shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import written

#: A bucket is collected in one task, which needs about four times its bytes; 100 TB make 3 million buckets of 32 MB.
BUCKET_BYTES = 32 << 20
#: Above so many buckets their offsets (16 bytes each) are joined by a shuffle.
BROADCAST_BUCKETS = 200_000
#: Up to so many hashes of repeated rows (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_REPEATED = 200_000
#: Copies of a row are made in runs of so many.
COPIES = 1_000


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def shuffled_shards(
    docs: DataFrame,
    n_shards: int,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = 0,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``docs`` in random order, with ``shard`` and the gapless ``slot`` inside it.

    Shard sizes follow the law ``rows``: counts are at most one apart. Records move
    once. Reads ``docs`` twice more beforehand, to count rows and bytes and to find repeated rows.
    Copies of a text spread like any other rows, since whole rows are hashed; rows that repeat
    as a whole are counted and spread by their number. NULL ids and texts are allowed; an empty table gives an
    empty one. Columns named ``shard`` or ``slot`` in the input are replaced.
    """
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.struct(*[docs[c] for c in own]).alias("_row"))
    rows = _numbered(rows)
    key = F.xxhash64(F.lit(seed), F.col("_row")[doc_id], F.col("_row")[text], "_row", "_copy")
    total, size = docs.agg(F.count(F.lit(1)), F.sum(record_size(F.col(text)))).first()
    n_buckets = max(1, -(-(size or 0) // bucket_bytes))
    bucket = F.pmod(key, F.lit(n_buckets)).cast("int")

    # Pass one. A partition is a bucket, so pass two needs no further exchange.
    scattered = rows.select("_row", bucket.alias("_bucket")).repartitionById(n_buckets, F.col("_bucket"))
    counts = rows.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts)
    if n_buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)

    # Pass two. Sorting first makes a task that is run again give the same order.
    sorted_rows = F.transform(
        F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed + 1), "_row").alias("h"), F.col("_row").alias("r")))),
        lambda x: x["r"],
    )
    whole = scattered.groupBy("_bucket").agg(sorted_rows.alias("_rows"))
    permuted = whole.select("_bucket", F.posexplode(F.shuffle("_rows", F.lit(seed))).alias("_place", "_row"))
    rank = F.col("_offset") + F.col("_place")
    shard = F.floor(rank * n_shards / F.lit(max(total, 1))).cast("int")
    placed = permuted.join(offsets, "_bucket").select("_row", rank.alias("_rank"), shard.alias("shard"))
    first = F.ceil(F.col("shard") * F.lit(total) / F.lit(n_shards)).cast("long")
    return placed.select(*[F.col("_row")[c].alias(c) for c in own], "shard", (F.col("_rank") - first).alias("slot"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_copy``: 0, 1, 2 … among equal rows, so that they differ.

    Only rows whose hash occurs twice are grouped. They come back from their count, in runs of
    ``COPIES``, so no task makes all copies of a row.
    """
    hashed = [F.xxhash64("_row").alias("_h1"), F.xxhash64(F.lit(1), "_row").alias("_h2")]
    keyed = rows.select("_row", *hashed)
    repeated = keyed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h1", "_h2")
    repeated = written(repeated, "repeated")
    n = repeated.count()
    if not n:
        return rows.withColumn("_copy", F.lit(0).cast("long"))
    if n <= BROADCAST_REPEATED:
        repeated = F.broadcast(repeated)
    counted = written(
        keyed.join(repeated, ["_h1", "_h2"]).groupBy("_row").agg(F.count(F.lit(1)).alias("_n")), "counted"
    )
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(COPIES).cast("long")))
    begun = counted.select("_row", "_n", runs.alias("_from"))
    begun = begun.repartition(F.xxhash64("_row", "_from"))
    copies = F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES, F.col("_n")) - 1))
    once = keyed.join(repeated, ["_h1", "_h2"], "left_anti").select("_row", F.lit(0).cast("long").alias("_copy"))
    return once.union(begun.select("_row", copies.alias("_copy")))


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows in earlier buckets. One row per bucket, summed in blocks of 4,096 buckets."""
    from pyspark.sql import Window

    block = F.floor(F.col("_bucket") / 4096)
    blocked = counts.withColumn("_block", block)
    inside = Window.partitionBy("_block").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy("_block")
        .agg(F.sum("_n").alias("_m"))
        .select("_block", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_start"))
    )
    return (
        blocked.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(starts, "_block")
        .select("_bucket", (F.col("_start") + F.col("_inside")).alias("_offset"))
    )


def write_shards(shuffled: DataFrame, path: str, n_shards: int) -> None:
    """One folder per shard, rows in slot order; a shard is written by one task."""
    by_shard = shuffled.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("shard", "slot")
    by_shard.write.partitionBy("shard").mode("overwrite").parquet(path)
