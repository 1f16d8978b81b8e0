"""Index tables: build, embed and keep in step with their source."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import terms as V
from corpusq.operators.search import shard_of, with_term_vector
from corpusq.sources.materialise import materialise
from corpusq.sources.snapshots import assert_unique, row_digest

MAX_BROADCAST_KEYS = 200_000


class Encoder(Protocol):
    def __call__(self, texts: list[str]) -> np.ndarray: ...


def encoder_udf(factory: Callable[[], Encoder]) -> Callable[[Column], Column]:
    """``array<float>`` from an injected sentence encoder, built once per task."""

    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = factory()
        for batch in batches:
            vectors = np.asarray(encoder(batch.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(vectors), index=batch.index)

    return F.pandas_udf(encode, T.ArrayType(T.FloatType()))


def embed_hashed(df: DataFrame, text: str, dim: int = 64, out: str = "embedding") -> DataFrame:
    """The built-in encoder: unit-length hashed term counts, without leaving the JVM."""
    return df.withColumn("_counts", V.dense_counts(V.term_vector(F.col(text), dim), dim)).withColumn(
        out, V.l2_normalise(F.col("_counts"))
    ).drop("_counts")


Encode = Callable[[DataFrame, str, str], DataFrame]


def encoded_by(factory: Callable[[], Encoder]) -> Encode:
    """An injected sentence encoder in the form of ``embed_hashed``."""
    return lambda df, text, out: df.withColumn(out, encoder_udf(factory)(F.col(text)))


def hashed_encoder(dim: int = 64) -> Encode:
    return lambda df, text, out: embed_hashed(df, text, dim, out)


def build_index(
    df: DataFrame,
    key: str,
    text: str,
    meta: Sequence[str] = (),
    buckets: int = V.DEFAULT_BUCKETS,
    check_key: bool = True,
    encode: Encode | None = None,
) -> DataFrame:
    """Key, text, metadata, vector and a digest of the source columns.

    The vector is ``vector`` (hashed terms) with its squared norm ``norm2``, or with ``encode``
    the dense ``embedding``.
    """
    if check_key:
        assert_unique(df, key)
    columns = [key, text, *meta]
    rows = df.select(*columns)
    vectors = with_term_vector(rows, text, buckets) if encode is None else encode(rows, text, "embedding")
    return vectors.withColumn("digest", row_digest(columns[1:]))


def changed_keys(index: DataFrame, source: DataFrame, key: str, text: str, meta: Sequence[str] = ()) -> DataFrame:
    """Keys of the source that are new or whose content differs from what the index holds.

    Key and digest are all that meets the index. Of a small source the keys go to the
    index, which is then only scanned: no row of it is shuffled. The changed keys are written once, since
    a sync reads them several times, and carry a broadcast hint while few.
    """
    rows = materialise(source.select(key, row_digest([text, *meta]).alias("digest")))
    held = index.select(key, "digest")
    if rows.count() <= MAX_BROADCAST_KEYS:
        held = held.join(F.broadcast(rows.select(key)), key, "left_semi")
    keys = materialise(rows.join(held, [key, "digest"], "left_anti").select(key))
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys


def sync_index(
    index: DataFrame,
    source: DataFrame,
    key: str,
    text: str,
    meta: Sequence[str] = (),
    deleted: DataFrame | None = None,
    buckets: int = V.DEFAULT_BUCKETS,
    encode: Encode | None = None,
) -> DataFrame:
    """The index with changed source rows embedded and replaced, and deleted keys removed.

    Unchanged rows are not embedded again, and with few changes neither the index
    nor the source texts are shuffled.
    """
    keys = changed_keys(index, source, key, text, meta)
    changed = build_index(source.join(keys, key, "left_semi"), key, text, meta, buckets, False, encode)
    if deleted is not None:
        index = index.join(_few(deleted.select(key)), key, "left_anti")
    return index.join(keys, key, "left_anti").unionByName(changed)


def _few(keys: DataFrame) -> DataFrame:
    keys = materialise(keys)
    return F.broadcast(keys) if keys.count() <= MAX_BROADCAST_KEYS else keys


def write_index(df: DataFrame, path: str, key: str, shards: int) -> None:
    """Parquet in ``shards`` folders by key hash, so that fetching rows by key reads few folders."""
    sharded = df.withColumn("shard", shard_of(F.col(key), shards))
    placed = sharded.repartition("shard").sortWithinPartitions("shard", key)
    placed.write.mode("overwrite").partitionBy("shard").parquet(path)
