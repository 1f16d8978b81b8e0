"""Approximate top-k: random-hyperplane signatures narrow the pairs, exact cosine ranks them.

``topk_lsh`` hashes into several tables of few planes. ``topk_multiprobe`` has one stored table of as many planes as the row count
asks for, and a query visits the buckets nearest to its own: a row lies in one bucket, so no pair is scored twice, and never more
pairs are scored than in an exact search.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.operators import search as S
from corpusq.session import one_blas_thread


def random_planes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    """Normal vectors of ``tables * bits`` random planes, one per column."""
    return np.random.default_rng(seed).standard_normal((dim, tables * bits))


def signatures(dim: int, tables: int, bits: int, seed: int) -> Callable[[Column], Column]:
    """Column of one bucket number per table: the sides of ``bits`` random planes."""
    planes = random_planes(dim, tables, bits, seed)
    powers = 1 << np.arange(bits)
    offsets = np.arange(tables) << bits

    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            vectors = np.stack(batch.to_numpy()).astype(np.float64) if len(batch) else np.zeros((0, dim))
            side = (vectors @ planes > 0).reshape(len(batch), tables, bits)
            yield pd.Series(list((side * powers).sum(axis=2) + offsets), index=batch.index)

    return F.pandas_udf(hashed, T.ArrayType(T.IntegerType()))


def topk_lsh(
    index: DataFrame,
    queries: DataFrame,
    k: int = 3,
    *,
    id_col: str,
    vector: str,
    query_id: str,
    query_vector: str,
    dim: int,
    tables: int = 8,
    bits: int = 2,
    seed: int = 42,
    skip_equal: bool = False,
    blocks: tuple[int, int] = (S.INDEX_BLOCK_ROWS, S.QUERY_BLOCK_ROWS),
) -> DataFrame:
    """``(query_id, id, score, rank)`` over pairs that share a bucket in at least one table.

    Buckets without a query leave the shuffle, a bucket that holds a large share
    of the rows is cut into blocks, and each block yields k rows per query.
    """
    one_blas_thread(index.sparkSession)
    hashed = signatures(dim, tables, bits, seed)

    def exploded(df: DataFrame, key: str, column: str) -> DataFrame:
        rows = S._payload(df, "dense", key, column, None)
        return rows.withColumn("_part", F.explode(hashed(F.col("_vector"))))

    left, right = exploded(index, id_col, vector), exploded(queries, query_id, query_vector)
    schema = S._hits_schema(left, right)
    wanted = k + 1 if skip_equal else k
    hits = S._block_topk(left, right, "dense", wanted, {"keep_zero": True}, schema, blocks, part=True)
    distinct = hits.groupBy(query_id, id_col).agg(F.max("score").alias("score"))
    return S._finish(distinct, schema, k, skip_equal)


BUCKET_ROWS = 256
MAX_BITS = 12
#: Rows of the sample that ``calibrate`` searches exactly.
SAMPLE_QUERIES = 256


def bits_for(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Planes for buckets of about ``bucket_rows`` rows; beyond 4,096 buckets they grow and are cut into blocks."""
    return max(1, min(MAX_BITS, int(np.ceil(np.log2(max(rows, 1) / bucket_rows))) if rows > bucket_rows else 1))


def _margins(vectors: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket number, and squared distance to each plane; a vector with a NaN or infinite value counts as zero."""
    planes = random_planes(vectors.shape[1], 1, bits, seed)
    sides = np.where(np.isfinite(vectors).all(axis=1)[:, None], vectors, 0.0) @ (planes / np.linalg.norm(planes, axis=0))
    return ((sides > 0) * (1 << np.arange(bits))).sum(axis=1), np.square(sides)


def _costs(margins: np.ndarray) -> np.ndarray:
    """What it takes to cross to each bucket: the squared distances of the planes between, by the bits in which the numbers differ."""
    bits = margins.shape[1]
    return margins @ ((np.arange(1 << bits)[None, :] >> np.arange(bits)[:, None]) & 1)


def nearest_buckets(vectors: np.ndarray, bits: int, probes: int, seed: int) -> np.ndarray:
    """The ``probes`` buckets that take least to reach, the vector's own first; ties go to the smaller difference."""
    own, margins = _margins(vectors, bits, seed)
    order = np.argsort(_costs(margins), axis=1, kind="stable")[:, : min(probes, 1 << bits)]
    return own[:, None] ^ order


def _stacked(batch: pd.Series) -> np.ndarray:
    return np.stack(batch.to_numpy()).astype(np.float64)


def with_bucket(df: DataFrame, vector: str, bits: int, seed: int = 42, out: str = "bucket") -> DataFrame:
    """Adds the bucket number of ``bits`` planes."""

    def numbered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = _margins(_stacked(batch), bits, seed)[0] if len(batch) else []
            yield pd.Series(found, index=batch.index, dtype="int32")

    return df.filter(F.col(vector).isNotNull()).withColumn(out, F.pandas_udf(numbered, T.IntegerType())(F.col(vector)))


def write_signatures(index: DataFrame, path: str, vector: str, bits: int, seed: int = 42) -> None:
    """The index stored by bucket, one folder each, so that a search reads the buckets that its queries visit."""
    with_bucket(index, vector, bits, seed).write.mode("overwrite").partitionBy("bucket").parquet(path)


def probed(queries: DataFrame, query_vector: str, bits: int, probes: int, seed: int = 42) -> DataFrame:
    """``queries`` once per bucket to visit."""

    def near(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            runs = [nearest_buckets(_stacked(batch[i : i + 256]), bits, probes, seed) for i in range(0, len(batch), 256)]
            yield pd.Series([list(map(int, r)) for run in runs for r in run], index=batch.index, dtype=object)

    buckets = F.pandas_udf(near, T.ArrayType(T.IntegerType()))(F.col(query_vector))
    return queries.filter(F.col(query_vector).isNotNull()).withColumn("bucket", F.explode(buckets))


def calibrate(
    index: DataFrame,
    queries: DataFrame,
    bits: int,
    k: int = 3,
    recall: float = 0.95,
    *,
    id_col: str,
    vector: str,
    query_id: str,
    query_vector: str,
    seed: int = 42,
    skip_equal: bool = False,
) -> int:
    """How many buckets a query has to visit for ``recall`` of its k nearest rows, measured on a sample.

    A bounded sample of queries (``SAMPLE_QUERIES``, the least by hash of id) is searched exactly against the whole index; the answer is the quantile of
    the place at which a true neighbour's bucket stands among those of its query. With vectors that have no near neighbours this
    comes close to all buckets, and the search to an exact one.
    """
    sample = queries.orderBy(F.xxhash64(query_id), query_id).limit(SAMPLE_QUERIES)
    names = {"id_col": id_col, "vector": vector, "query_id": query_id, "query_vector": query_vector}
    true = S.topk_dense(index, sample, k, skip_equal=skip_equal, **names).filter("score IS NOT NULL")
    pairs = true.select(query_id, id_col).join(sample.select(query_id, F.col(query_vector).alias("_q")), query_id)
    rows = pairs.join(index.select(id_col, F.col(vector).alias("_v")), id_col).select("_q", "_v").collect()
    if not rows:
        return 1
    own, margins = _margins(np.array([r["_q"] for r in rows], dtype=float), bits, seed)
    there, _ = _margins(np.array([r["_v"] for r in rows], dtype=float), bits, seed)
    costs = _costs(margins)
    place = (costs < costs[np.arange(len(rows)), own ^ there][:, None]).sum(axis=1)
    return int(np.quantile(place, min(1.0, recall + (1 - recall) / 2), method="higher")) + 1


def topk_multiprobe(
    index: DataFrame,
    queries: DataFrame,
    k: int = 3,
    *,
    id_col: str,
    vector: str,
    query_id: str,
    query_vector: str,
    bits: int,
    probes: int,
    seed: int = 42,
    skip_equal: bool = False,
    blocks: tuple[int, int] = (S.INDEX_BLOCK_ROWS, S.QUERY_BLOCK_ROWS),
) -> DataFrame:
    """``(query_id, id, score, rank)`` over the rows in the buckets that each query visits.

    ``index`` has a column ``bucket`` (``with_bucket``, ``write_signatures``) of the same ``bits`` and ``seed``. A pair meets in one bucket at
    most; a bucket that holds a large share of the rows is cut into blocks.
    """
    one_blas_thread(index.sparkSession)
    left = index.select(F.col(id_col), F.col(vector).alias("_vector"), F.col("bucket").alias("_part"))
    visits = probed(queries.select(query_id, query_vector), query_vector, bits, probes, seed)
    right = visits.select(F.col(query_id), F.col(query_vector).alias("_vector"), F.col("bucket").alias("_part"))
    schema = S._hits_schema(left, right)
    wanted = k + 1 if skip_equal else k
    hits = S._block_topk(left, right, "dense", wanted, {"keep_zero": True}, schema, blocks, part=True)
    return S._finish(hits, schema, k, skip_equal)
