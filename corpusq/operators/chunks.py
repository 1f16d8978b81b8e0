"""Overlapping token windows over long texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions.text import composite_id, let

CHUNK_TOKENS = 200
CHUNK_OVERLAP = 50
#: Batches between Spark and an injected tokenizer hold about so many bytes, or one row; what a task hands on, so many characters.
BATCH_CHARS = 4 << 20


class Tokenizer(Protocol):
    def encode(self, text: str) -> list: ...

    def decode(self, tokens: list) -> str: ...


class SpaceTokenizer:
    """Splits at single spaces; the twin of the native chunker."""

    def encode(self, text: str) -> list:
        return text.split(" ")

    def decode(self, tokens: list) -> str:
        return " ".join(tokens)


def _check_names(*names: str) -> None:
    taken = sorted(set(names) & {"chunk_index", "text", "id"})
    if taken:
        raise ValueError(f"columns {taken} are names of the chunk's own columns")


def _check(size: int, overlap: int) -> int:
    if not 0 <= overlap < size:
        raise ValueError(f"overlap {overlap} must be at least 0 and below size {size}")
    return size - overlap


def chunk_array(text: Column, size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Column:
    """Windows of ``size`` tokens every ``size - overlap``; the last one reaches the end."""
    step = _check(size, overlap)

    def windows(tokens: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(tokens) - size) / step)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.array_join(F.slice(tokens, i * step + 1, size), " "),
        )

    return let(F.split(text, " "), windows)


def chunk(
    df: DataFrame,
    key: str,
    text: str,
    carry: Sequence[str] = (),
    size: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """One row per window: key, the carried columns, ``chunk_index``, ``text`` and ``id``.

    Small metadata is best carried along here: it needs no join and so no
    shuffle. Empty texts give no chunk.
    """
    _check_names(key, *carry)
    # A filter on the text would be pushed below its computation and run that twice.
    windows = F.when(F.col(text) != "", chunk_array(F.col(text), size, overlap))
    out = df.select(key, *carry, F.posexplode(windows).alias("_pos", "_chunk"))
    return out.select(
        key,
        *carry,
        F.col("_pos").cast("long").alias("chunk_index"),
        F.col("_chunk").alias("text"),
        composite_id(F.col(key), F.col("_pos")).alias("id"),
    )


def chunk_with_tokenizer(
    df: DataFrame,
    key: str,
    text: str,
    factory: Callable[[], Tokenizer] = SpaceTokenizer,
    size: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """As ``chunk`` with an injected tokenizer, built once per task."""
    _check_names(key)
    step = _check(size, overlap)
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("chunk_index", T.LongType()),
            T.StructField("text", T.StringType()),
        ]
    )

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _token_windows(batches, key, text, factory(), size, overlap, step)

    # By rows alone a batch of long texts could be of any size.
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_CHARS))
    out = df.select(key, text).mapInPandas(windows, schema)
    return out.withColumn("id", composite_id(F.col(key), F.col("chunk_index")))


def _token_windows(
    batches: Iterator[pd.DataFrame], key: str, text: str, tokenizer: Tokenizer, size: int, overlap: int, step: int
) -> Iterator[pd.DataFrame]:
    """Rows of key, ordinal and text; a frame is handed on once it holds ``BATCH_CHARS`` characters, so memory does not follow the batch."""
    for pdf in batches:
        keys, places, pieces, held = [], [], [], 0

        def frame() -> pd.DataFrame:
            return pd.DataFrame({key: pd.Series(keys, dtype=pdf[key].dtype), "chunk_index": pd.Series(places, dtype="int64"), "text": pieces})

        for k, value in zip(pdf[key], pdf[text]):
            tokens = tokenizer.encode(value) if value else []
            for i, s in enumerate(range(0, max(0, len(tokens) - overlap - 1) + 1, step) if value else ()):
                piece = tokenizer.decode(tokens[s : s + size])
                keys.append(k)
                places.append(i)
                pieces.append(piece)
                held += len(piece)
                if held >= BATCH_CHARS:
                    yield frame()
                    keys, places, pieces, held = [], [], [], 0
        if pieces:
            yield frame()


def attach_metadata(
    chunks: DataFrame,
    meta: DataFrame,
    key: str,
    ordinal: str = "chunk_index",
    max_ordinal: Column | None = None,
    rows_per_salt: int = 4096,
) -> DataFrame:
    """Inner join of chunks with their documents' metadata.

    One document may own a large share of all chunks, so its chunks are spread
    over salts of ``rows_per_salt`` ordinals and its metadata row is repeated
    once per salt; documents of ordinary size have one salt. ``max_ordinal``, an
    upper bound over ``meta``, gives the number of salts; without it they are
    read from the chunks' key and ordinal columns.
    """
    salted = chunks.withColumn("_salt", F.floor(F.col(ordinal) / rows_per_salt))
    if max_ordinal is not None:
        salts = F.sequence(F.lit(0).cast("long"), F.floor(max_ordinal / rows_per_salt))
        return salted.join(meta.withColumn("_salt", F.explode(salts)), [key, "_salt"]).drop("_salt")
    hot = salted.filter(F.col(ordinal) >= rows_per_salt).select(key, "_salt").distinct()
    repeated = hot.join(meta, key).select(*meta.columns, "_salt")
    both = meta.withColumn("_salt", F.lit(0).cast("long")).unionByName(repeated)
    return salted.join(both, [key, "_salt"]).drop("_salt")
