"""Batch top-k similarity search: a table of queries against an index table.

The index is scanned once and never collected, shuffled or joined pair by pair.
When the queries fit a checked bound they travel to every task, which keeps k
rows per query; only those rows are shuffled. Beyond the bound both sides are cut
into hash blocks and every (index block, query block) is one co-group, so neither
side has to fit anywhere; the result is the same. Blocks of term vectors meet in rounds:
a task lays an index block out by term, and of a round only k rows per query are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusq.functions import terms as V
from corpusq.functions.predicates import compile_filter
from corpusq.operators.blocks import DenseBlock, SparseBlock, TermIndex, TopK, first_copies
from corpusq.session import one_blas_thread
from corpusq.sources.materialise import materialise, stored

_BLOCKS = {"dense": DenseBlock, "sparse": SparseBlock}

# What may travel to every task: rows, and vector elements of 16 bytes at most.
MAX_BROADCAST_QUERIES = 4096
MAX_BROADCAST_VALUES = 4 << 20
MAX_BROADCAST_HITS = 1 << 18
INDEX_BLOCK_ROWS = 16384
QUERY_BLOCK_ROWS = 16384
MAX_BLOCK_TASKS = 20_000
# Blocks of term vectors: their rows and terms at most, the rows that they have at least where cores would stay idle otherwise.
TERM_BLOCKS = (32_768, 131_072)
# Two workers of an executor hold a block of each side and about 50 bytes more per term of the index block.
BLOCK_TERMS = 3 << 20
LEAST_ROWS = (8_192, 1_024)
# Pairs of blocks that meet in one round, about.
ROUND_GROUPS = 128


def _payload(df: DataFrame, kind: str, id_col: str, vector: str, norm: str | None) -> DataFrame:
    """Exactly what scoring needs: id and vector, for sparse vectors the squared norm too.

    Rows without a vector are left out when a block is read. A filter here would
    be pushed below the projection and build every vector twice.
    """
    columns = [F.col(id_col), F.col(vector).alias("_vector")]
    if kind == "sparse":
        columns.append((F.lit(1) if norm is None else F.col(norm)).cast("long").alias("_norm"))
    return df.select(*columns)


def _hits_schema(index: DataFrame, queries: DataFrame) -> T.StructType:
    query = queries.schema.fields[0]
    row = index.schema.fields[0]
    if query.name == row.name:
        raise ValueError(f"query id and index id are both named {row.name!r}")
    return T.StructType(
        [
            T.StructField(query.name, query.dataType),
            T.StructField(row.name, row.dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _read(kind: str, rows: pa.Table | pa.RecordBatch, names: Sequence[str]):
    for name in ("_vector", names[0]):  # a row without a vector or an id cannot be a hit
        if rows[name].null_count:
            rows = rows.filter(rows[name].is_valid())
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (rows[n] for n in names)]
    return _BLOCKS[kind].read(columns[0], columns[1:])


def _scan_topk(index: DataFrame, queries: pa.Table, kind: str, k: int, options: dict, schema) -> DataFrame:
    arrow = to_arrow_schema(schema)
    block = _read(kind, queries, queries.column_names)

    def task(batches):
        top = TopK(kind, block, k, **options)
        for batch in batches:
            if batch.num_rows:
                top.add(_read(kind, batch, batch.schema.names))
        yield from top.emit(arrow)

    return index.mapInArrow(task, schema)


def _block_topk(
    index: DataFrame, queries: DataFrame, kind: str, k: int, options: dict, schema, rows: tuple[int, int], part: bool
) -> DataFrame:
    """Co-group (part, index block, query block). Hot parts get as many blocks as they need.

    With ``part`` the rows carry a column ``_part`` and meet only rows of the same
    part; the caller bounds the number of parts.
    """
    arrow = to_arrow_schema(schema)
    index_rows, query_rows = rows
    id_col, query_id = schema.names[1], schema.names[0]

    keys = ["_part", "_ib", "_qb"]
    partitions = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if part:

        def n_blocks(size: int) -> Column:
            return F.ceil(F.count(F.lit(1)) / size).cast("int")

        sizes = index.groupBy("_part").agg(n_blocks(index_rows).alias("_ni")).join(
            queries.groupBy("_part").agg(n_blocks(query_rows).alias("_nq")), "_part"
        )
    else:
        ni, nq = (max(1, -(-df.count() // size)) for df, size in ((index, index_rows), (queries, query_rows)))
        counts = {"_part": F.lit(0), "_ni": F.lit(ni), "_nq": F.lit(nq)}
        # A group is much work on little data: as many tasks as groups keep the cores even.
        partitions = min(max(partitions, 2 * ni * nq), MAX_BLOCK_TASKS)

    def blocks(df: DataFrame, key: str, own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        sized = df.join(sizes, "_part") if part else df.withColumns(counts)
        return (
            sized.withColumn(own[0], F.pmod(F.xxhash64(F.col(key)), F.col(own[1])).cast("int"))
            .withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1)))
            .drop("_ni", "_nq")
            .repartition(partitions, *keys)
        )

    left = blocks(index, id_col, ("_ib", "_ni"), ("_qb", "_nq"))
    right = blocks(queries, query_id, ("_qb", "_nq"), ("_ib", "_ni"))
    width = 2 if kind == "dense" else 3
    left_names = [id_col, "_vector", "_norm"][:width]
    right_names = [query_id, "_vector", "_norm"][:width]

    def task(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        if not rows.num_rows or not wanted.num_rows:
            return arrow.empty_table()
        top = TopK(kind, _read(kind, wanted, right_names), k, **options)
        top.add(_read(kind, rows, left_names))
        return pa.Table.from_batches(list(top.emit(arrow)), schema=arrow)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(task, schema)


def _term_topk(index: DataFrame, queries: DataFrame, k: int, schema, rows: tuple[int, int]) -> DataFrame:
    """As ``_block_topk`` for term vectors: each vector is built once and stored, index blocks take turns.

    A round moves its index blocks once per query block and the queries once per index block; it keeps k rows per query,
    and its shuffle files go as it ends. Work stays queries x rows, which is what an exact search without a gate is.
    """
    arrow, spark = to_arrow_schema(schema), index.sparkSession
    id_col, query_id = schema.names[1], schema.names[0]

    def compact(df: DataFrame, key: str, name: str) -> tuple[DataFrame, int, int]:
        term, weight = df.schema["_vector"].dataType.elementType.names
        # Read back, so that the vector is not built again for each column made from it.
        kept = stored(df, name).filter(F.col("_vector").isNotNull() & F.col(key).isNotNull())
        ends = [f(f"_vector.{c}") for c in (term, weight) for f in (F.array_max, F.array_min)]
        n, terms, *ends = kept.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.size("_vector").cast("long")), F.lit(0)), *[f(e) for e, f in zip(ends, (F.max, F.min) * 2, strict=True)]
        ).first()
        columns = [
            F.col(f"_vector.{c}").cast("array<int>" if most is None or (most < 1 << 31 and least >= -1 << 31) else "array<long>").alias(out)
            for c, out, most, least in ((term, "_terms", *ends[:2]), (weight, "_weights", *ends[2:]))
        ]
        return kept.select(key, *columns, "_norm"), n, terms

    sides = [compact(index, id_col, "index-terms"), compact(queries, query_id, "query-terms")]
    counts = [max(1, -(-n // most), -(-terms // BLOCK_TERMS)) for (_, n, terms), most in zip(sides, rows, strict=True)]
    wanted = 3 * spark.sparkContext.defaultParallelism
    for side, other in ((0, 1), (1, 0)):
        full = -(-sides[side][1] // LEAST_ROWS[side])
        counts[side] = max(counts[side], min(full, -(-wanted // counts[other])))
    (left, right), (n_left, n_right) = (side[0] for side in sides), counts
    step = max(1, ROUND_GROUPS // n_right)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * n_right * min(step, n_left))
    partitions = min(partitions, MAX_BLOCK_TASKS)

    def block(rows: pa.Table, name: str) -> tuple[SparseBlock, pa.Array]:
        rows = rows.combine_chunks()
        ids, terms, weights = (rows[c].combine_chunks() for c in (name, "_terms", "_weights"))
        offsets = np.append(0, np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int64)
        values = (a.flatten().to_numpy(zero_copy_only=False) for a in (terms, weights))
        return SparseBlock(np.arange(len(ids)), offsets, *values, rows["_norm"].to_numpy().astype(np.float64)), ids

    def task(found: pa.Table, asked: pa.Table) -> pa.Table:
        if not found.num_rows or not asked.num_rows:
            return arrow.empty_table()
        # Ties go to the smaller id: rows stand by id.
        found = found.take(pc.sort_indices(found[id_col].combine_chunks()))
        one, ids = block(found, id_col)
        kept = first_copies(one, k)
        if len(kept) < len(one):
            one, ids = block(found.take(pa.array(kept)), id_col)
        del found
        other, query_ids = block(asked, query_id)
        del asked
        parts = [
            pa.Table.from_arrays([query_ids.take(pa.array(query)), ids.take(pa.array(row)), pa.array(score)], names=arrow.names)
            for query, score, row in TermIndex(one, other, k)
        ]
        return pa.concat_tables(parts).cast(arrow) if parts else arrow.empty_table()

    def meeting(start: int, stop: int) -> DataFrame:
        own = F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_left)).cast("int")
        some = left.withColumn("_ib", own).filter((F.col("_ib") >= start) & (F.col("_ib") < stop))
        some = some.withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))))
        every = right.withColumn("_qb", F.pmod(F.xxhash64(F.col(query_id)), F.lit(n_right)).cast("int"))
        every = every.withColumn("_ib", F.explode(F.sequence(F.lit(start), F.lit(stop - 1))))
        some, every = (df.repartition(partitions, "_ib", "_qb").groupBy("_ib", "_qb") for df in (some, every))
        hits = some.cogroup(every).applyInArrow(task, schema)
        return stored(_finish(hits, schema, k, False).select(*schema.names), "best")

    rounds = [meeting(start, min(start + step, n_left)) for start in range(0, n_left, step)]
    return functools.reduce(DataFrame.unionByName, rounds)


def _finish(hits: DataFrame, schema: T.StructType, k: int, skip_equal: bool) -> DataFrame:
    query_id, id_col = schema.names[:2]
    if skip_equal:
        hits = hits.filter(F.col(query_id) != F.col(id_col))
    w = Window.partitionBy(query_id).orderBy(F.col("score").desc_nulls_last(), F.col(id_col))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _search(
    index: DataFrame,
    queries: DataFrame,
    kind: str,
    k: int,
    options: dict,
    skip_equal: bool,
    max_broadcast: int,
    blocks: tuple[int, int],
) -> DataFrame:
    schema = _hits_schema(index, queries)
    wanted = k + 1 if skip_equal else k
    one_blas_thread(index.sparkSession)
    rows, values = (
        queries.limit(max_broadcast + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_vector")), F.lit(0))).first()
    )
    if rows > max_broadcast or values > MAX_BROADCAST_VALUES:
        if kind == "sparse":
            hits = _term_topk(index, queries, wanted, schema, blocks)
        else:
            hits = _block_topk(index, queries, kind, wanted, options, schema, blocks, part=False)
        return _finish(hits, schema, k, skip_equal)
    hits = _scan_topk(index, queries.toArrow(), kind, wanted, options, schema)
    ranked = _finish(hits, schema, k, skip_equal)
    # Two ids, a score and a rank per row: joins may broadcast that many.
    return F.broadcast(ranked) if rows * k <= MAX_BROADCAST_HITS else ranked


def topk_dense(
    index: DataFrame,
    queries: DataFrame,
    k: int = 3,
    *,
    id_col: str,
    vector: str,
    query_id: str,
    query_vector: str,
    metric: str = "cosine",
    filters: Mapping[str, Any] | None = None,
    skip_equal: bool = False,
    max_broadcast: int = MAX_BROADCAST_QUERIES,
    blocks: tuple[int, int] = (INDEX_BLOCK_ROWS, QUERY_BLOCK_ROWS),
) -> DataFrame:
    """``(query_id, id, score, rank)``: the k nearest rows per query.

    Ties go to the smaller id. A zero vector has no cosine: it ranks last with a
    NULL score. ``filters`` select index rows before scoring and reach the scan.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric: {metric!r}")
    if filters:
        index = index.filter(compile_filter(filters, index.columns))
    return _search(
        _payload(index, "dense", id_col, vector, None),
        _payload(queries, "dense", query_id, query_vector, None),
        "dense",
        k,
        {"keep_zero": True, "metric": metric},
        skip_equal,
        max_broadcast,
        blocks,
    )


def topk_sparse(
    index: DataFrame,
    queries: DataFrame,
    k: int = 3,
    *,
    id_col: str,
    query_id: str,
    vector: str = "vector",
    query_vector: str = "vector",
    norm: str | None = "norm2",
    filters: Mapping[str, Any] | None = None,
    max_broadcast: int = MAX_BROADCAST_QUERIES,
    blocks: tuple[int, int] = TERM_BLOCKS,
) -> DataFrame:
    """As ``topk_dense`` for term vectors; rows that share no term with a query are no hits.

    With ``norm=None`` the plain dot product is the score.
    """
    if filters:
        index = index.filter(compile_filter(filters, index.columns))
    return _search(
        _payload(index, "sparse", id_col, vector, norm),
        _payload(queries, "sparse", query_id, query_vector, norm),
        "sparse",
        k,
        {"keep_zero": False},
        False,
        max_broadcast,
        blocks,
    )


def with_term_vector(df: DataFrame, text: str, buckets: int = V.DEFAULT_BUCKETS) -> DataFrame:
    """Adds ``vector`` and its squared norm ``norm2``."""
    return df.withColumn("vector", V.term_vector(F.col(text), buckets)).withColumn(
        "norm2", V.squared_norm(F.col("vector"))
    )


def text_search(
    documents: DataFrame,
    questions: DataFrame,
    k: int = 3,
    *,
    id_col: str,
    text: str,
    query_id: str,
    query_text: str,
    buckets: int = V.DEFAULT_BUCKETS,
    filters: Mapping[str, Any] | None = None,
    columns: Sequence[str] = (),
    encode: Callable[[DataFrame, str, str], DataFrame] | None = None,
    **options: Any,
) -> DataFrame:
    """Embed documents and questions the same way and search, in one pass over the documents.

    ``filters`` name any column of the documents and are applied before a vector is built, so they reach the scan.
    ``columns`` of the documents are returned with the hits. Vectors are hashed terms, or what
    ``encode(df, text, out)`` adds (``index.embed_hashed``, ``index.encoded_by``).
    """
    if filters:
        documents = documents.filter(compile_filter(filters, documents.columns))
    rows, asked = documents.select(id_col, text), questions.select(query_id, query_text)
    if encode is not None:
        hits = topk_dense(
            encode(rows, text, "_document_vector"),
            encode(asked, query_text, "_query_vector"),
            k,
            id_col=id_col,
            vector="_document_vector",
            query_id=query_id,
            query_vector="_query_vector",
            **options,
        )
    else:
        index = with_term_vector(rows, text, buckets)
        hits = topk_sparse(index, with_term_vector(asked, query_text, buckets), k, id_col=id_col, query_id=query_id, **options)
    return attach_columns(hits, documents, id_col, columns) if columns else hits


def _terms() -> Column:
    """A vector's terms. Exploding ``vector.term`` itself would infer filters that rebuild the vector."""
    return F.transform("vector", lambda t: t["term"])


def keyword_search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 3,
    *,
    id_col: str,
    query_id: str,
    **options: Any,
) -> DataFrame:
    """Sum of ``tf · idf`` over the distinct query terms; score in units of one.

    ``idf`` is rounded to six digits and carried as an integer, so sums are exact.
    Only the terms that a query asks for are counted; they are pre-aggregated in each
    task, and the optimizer broadcasts what turns out to be small. The row count comes
    from the same pass, as the term -1 that every row holds.
    """
    asked_terms = queries.select(query_id, F.explode(_terms()).alias("term"))
    every_row = F.lit(-1).cast("long")
    wanted = asked_terms.select("term").distinct().unionByName(
        asked_terms.sparkSession.range(1).select(every_row.alias("term"))
    )
    counted = materialise(
        index.select(F.explode(F.concat(F.array(every_row), _terms())).alias("term"))
        .join(wanted, "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    total = counted.filter("term = -1").agg(F.coalesce(F.max("df"), F.lit(0))).first()[0]
    idf = F.round(F.log((1 + F.lit(total)) / (1 + F.col("df"))) * 1000000).cast("long")
    frequency = counted.filter("term >= 0").withColumn("idf", idf)
    # A query's terms are one row's content, so regrouping them is bounded by its text.
    weighted = (
        asked_terms.join(frequency, "term")
        .groupBy(query_id)
        .agg(F.sort_array(F.collect_list(F.struct("term", F.col("idf").alias("tf")))).alias("vector"))
    )
    # Read several times by the search, and each reading would count the index again.
    weighted = materialise(weighted)
    hits = topk_sparse(index, weighted, k, id_col=id_col, query_id=query_id, norm=None, **options)
    return hits.withColumn("score", F.col("score") / 1000000)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def attach_columns(
    hits: DataFrame, index: DataFrame, id_col: str, columns: Sequence[str], shards: int | None = None
) -> DataFrame:
    """The hits with columns of the index, score last.

    Hits of a bounded set of queries carry a broadcast hint, so the index is read
    once more without a shuffle; otherwise both sides are shuffled by id. Of an
    index stored in ``shards`` only the folders that hold a hit are read.
    """
    ranked = [c for c in hits.columns if c not in (id_col, "score")]
    if shards is None:
        out = hits.join(index.select(id_col, *columns), id_col)
    else:
        placed = hits.withColumn("shard", shard_of(F.col(id_col), shards))
        out = placed.join(index.select(id_col, "shard", *columns), ["shard", id_col])
    return out.select(*ranked, id_col, *columns, "score")


def gate(hits: DataFrame, query_id: str, threshold: float = 0.70) -> DataFrame:
    """All hits of the queries whose best score is strictly above the threshold."""
    best = F.max(F.when(F.col("rank") == 1, F.col("score"))).over(Window.partitionBy(query_id))
    return hits.withColumn("_best", best).filter(F.col("_best") > threshold).drop("_best")


def best_hit(queries: DataFrame, hits: DataFrame, query_id: str, threshold: float = 0.70) -> DataFrame:
    """One row per query with its best hit if above the threshold, otherwise NULLs and ``matched`` false."""
    top = hits.filter((F.col("rank") == 1) & (F.col("score") > threshold)).drop("rank")
    return queries.join(top, query_id, "left").withColumn("matched", F.col("score").isNotNull())
