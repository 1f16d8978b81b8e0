"""Shared helpers: scratch tables in the cluster's shared folder and small column rules."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.sources.materialise import shared_folder, shuffles_dropped

CHUNK_ROWS = 20_000
#: Arrow batches between Spark and Python workers hold about so many bytes, or one row.
BATCH_BYTES = 4 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, lost executors do not matter."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in bytes; by rows alone a batch of long texts could be of any size."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_arrow(df: DataFrame, function: Callable[[pa.Table], pa.Table], schema: str, batch_bytes: int) -> DataFrame:
    """``function`` over runs of Arrow batches that hold about ``batch_bytes`` together.

    Spark cuts Arrow batches by row count; long texts would make them large and
    short ones small. A row is never cut, so a run holds at least one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for piece in _pieces(batch, batch_bytes):
                if held and size + piece.nbytes > batch_bytes:
                    yield from function(pa.Table.from_batches(held)).to_batches(max_chunksize=CHUNK_ROWS)
                    held, size = [], 0
                held.append(piece)
                size += piece.nbytes
        if held:
            yield from function(pa.Table.from_batches(held)).to_batches(max_chunksize=CHUNK_ROWS)
            held.clear()
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks and steps

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def _pieces(batch: pa.RecordBatch, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    if batch.nbytes <= batch_bytes or batch.num_rows <= 1:
        if batch.num_rows:
            yield batch
        return
    middle = batch.num_rows // 2
    yield from _pieces(batch.slice(0, middle), batch_bytes)
    yield from _pieces(batch.slice(middle), batch_bytes)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``part``; a NULL id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(True))


def scan_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(*columns) if columns else docs
