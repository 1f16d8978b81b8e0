"""Keyword search over a stored inverted table, skipping blocks that cannot reach a question's best rows.

The table has one row per (term, block of documents): how many of the block's documents hold the term, the greatest frequency among them, and the
postings. Documents of like length share a block, since the score grows with length: the blocks of short documents then have
small bounds. A question first scores the blocks of greatest bound; its k-th score so far tells which other blocks can still matter, and
only their postings are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusq.functions import terms as V
from corpusq.sources.materialise import stored

BLOCK_ROWS = 256
#: Blocks per question whose postings are scored before any bound is known.
FIRST_BLOCKS = 2
IDF_UNIT = 1_000_000
#: The term under which each block's number of documents is kept.
EVERY = -1
_SIZES = 40


def write_postings(
    docs: DataFrame,
    path: str,
    id_col: str,
    text: str,
    buckets: int = V.DEFAULT_BUCKETS,
    block_rows: int = BLOCK_ROWS,
    batch: int = 0,
) -> None:
    """Write ``(term, block, n, most, postings)`` for documents with unique ids; a further ``batch`` is added with blocks of its own.

    Vectors are built once, on the way into the table. Blocks are size class and hash, so that no block holds much more than
    ``block_rows`` documents and no group more postings; rows without an id are left out, a NULL text counts as a document without terms.
    """
    size = F.least(F.floor(F.log2(F.length(F.coalesce(text, F.lit(""))) + 1) * 2), F.lit(_SIZES - 1)).cast("long")
    sized = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text, size.alias("size"))
    counts = {r["size"]: r["count"] for r in sized.groupBy("size").count().collect()}  # one row per size class
    parts = F.element_at(
        F.array(*[F.lit(-(-counts.get(s, 0) // block_rows) or 1).cast("long") for s in range(_SIZES)]), (F.col("size") + 1).cast("int")
    )
    place = F.lit(batch).cast("long") * (1 << 48) + F.col("size") * (1 << 40) + F.pmod(F.xxhash64("id"), parts)
    empty = F.struct(F.lit(EVERY).cast("long").alias("term"), F.lit(0).cast("long").alias("tf"))
    blocked = sized.select("id", place.alias("block"), F.concat(F.array(empty), V.term_vector(F.coalesce(text, F.lit("")), buckets)).alias("vector"))
    # A document moves once, as one row; its entries are made and grouped where its block is.
    entries = blocked.repartition("block").select("id", "block", F.inline(F.transform("vector", lambda t: F.struct(t["term"], t["tf"]))))
    held = F.when(F.col("term") != EVERY, F.struct("id", "tf"))
    table = entries.groupBy("term", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("most"), F.collect_list(held).alias("postings")
    )
    table.sortWithinPartitions("term", "block").write.mode("append" if batch else "overwrite").parquet(path)


def search_postings(spark: SparkSession, path: str, queries: DataFrame, k: int = 3, *, id_col: str, query_id: str) -> DataFrame:
    """``(query_id, id, score, rank)``: the k documents of greatest sum of tf·idf over the question's distinct terms.

    ``queries`` has ``query_id`` (unique) and a term ``vector``. idf is rounded to six digits and carried as an integer, so sums are exact. Ties go to the
    smaller id; questions without a known term have no row. The result is that of scoring every block.
    """
    return _ranked(_scored_blocks(spark, path, queries, k, query_id), k, id_col, query_id)


def _ranked(scores: DataFrame, k: int, id_col: str, query_id: str) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return (
        scores.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select(F.col("query").alias(query_id), F.col("id").alias(id_col), (F.col("score") / IDF_UNIT).alias("score"), "rank")
    )


def _scored_blocks(spark: SparkSession, path: str, queries: DataFrame, k: int, query_id: str) -> DataFrame:
    table = spark.read.parquet(path)
    asked = stored(
        queries.filter(F.col(query_id).isNotNull()).select(F.col(query_id).alias("query"), F.explode(F.transform("vector", lambda t: t["term"])).alias("term")),
        "asked",
    )
    terms = asked.select("term").distinct().unionByName(spark.range(1).select(F.lit(EVERY).cast("long").alias("term")))
    heads = stored(table.select("term", "block", "n", "most").join(terms, "term", "left_semi"), "heads")
    total = heads.filter(F.col("term") == EVERY).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequency = heads.filter(F.col("term") != EVERY).groupBy("term").agg(F.sum("n").alias("df"))
    idf = F.round(F.log((1 + F.lit(total)) / (1 + F.col("df"))) * IDF_UNIT).cast("long")
    weighted = stored(asked.join(frequency.select("term", idf.alias("idf")).filter("idf > 0"), "term"), "weighted")
    bounds = stored(
        weighted.join(heads.select("term", "block", "most"), "term")
        .groupBy("query", "block")
        .agg(F.sum(F.col("idf") * F.col("most")).alias("bound"))
        .withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "block"))),
        "bounds",
    )

    def scored(chosen: DataFrame) -> DataFrame:
        """``(query, id, score)`` of the documents in the chosen (query, block) pairs; only those blocks' postings are joined."""
        wanted = stored(chosen.select("query", "block").join(weighted, "query"), "wanted")
        # Written, so that its size is known before the table would be moved; what no question asks for stays where it is.
        read = table.select("term", "block", "postings").join(weighted.select("term").distinct(), "term", "left_semi")
        read = read.join(wanted.select("term", "block").distinct(), ["term", "block"], "left_semi")
        hits = wanted.join(read, ["term", "block"])
        each = hits.select("query", "idf", F.inline("postings"))
        return each.groupBy("query", "id").agg(F.sum(F.col("tf") * F.col("idf")).alias("score"))

    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    first = stored(
        scored(bounds.filter(F.col("place") <= FIRST_BLOCKS)).withColumn("at", F.row_number().over(best)).filter(F.col("at") <= k), "first"
    )
    floor = first.filter(F.col("at") == k).select("query", F.col("score").alias("floor"))
    # A block that can only tie may hold a smaller id, so it is read too.
    rest = _open_blocks(bounds, floor)
    return first.drop("at").unionByName(scored(rest))


def _open_blocks(bounds: DataFrame, floor: DataFrame) -> DataFrame:
    """The blocks that the first round left and whose bound reaches the question's k-th score so far."""
    left = bounds.filter(F.col("place") > FIRST_BLOCKS).join(floor, "query", "left")
    return left.filter(F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
