"""Triggered index sync: process what arrived since the last run, upsert by key.

An index folder holds full versions ``base/v{n}`` and the changes of each batch
``delta/batch={id}``; version n covers all batches up to n. A batch writes only
its changes, to a folder named by its id, so a replay writes the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpusq.operators.index import Encode, build_index, changed_keys
from corpusq.sources.snapshots import latest_by_key


def _list(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the finished folders ``{prefix}{n}`` under a path."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = [
        s.getPath().getName()
        for s in fs.listStatus(root)
        if fs.exists(hadoop.Path(s.getPath(), "_SUCCESS"))
    ]
    return sorted(int(n[len(prefix) :]) for n in done if n.startswith(prefix))


def read_index(spark: SparkSession, path: str, key: str, before: int | None = None) -> DataFrame | None:
    """The index with all batches below ``before`` applied; None while there is none.

    The base is not shuffled for a few changes: their keys are broadcast by the
    optimizer when small.
    """
    limit = float("inf") if before is None else before
    bases = [n for n in _list(spark, f"{path}/base", "v") if n < limit]
    floor = bases[-1] if bases else -1
    batches = [n for n in _list(spark, f"{path}/delta", "batch=") if floor < n < limit]
    base = spark.read.parquet(f"{path}/base/v{floor}") if bases else None
    if not batches:
        return base
    folders = [f"{path}/delta/batch={n}" for n in batches]
    changes = spark.read.option("basePath", f"{path}/delta").parquet(*folders)
    latest = latest_by_key(changes, key, [F.col("batch").desc()]).drop("batch")
    alive = latest.filter(~F.col("deleted")).drop("deleted")
    if base is None:
        return alive
    return base.join(latest.select(key), key, "left_anti").unionByName(alive)


def compact(spark: SparkSession, path: str, key: str) -> None:
    """Fold all finished batches into a new base, clustered by key."""
    batches = _list(spark, f"{path}/delta", "batch=")
    current = read_index(spark, path, key)
    if batches and current is not None:
        current.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite").parquet(
            f"{path}/base/v{batches[-1]}"
        )


def apply_batch(
    rows: DataFrame,
    batch_id: int,
    path: str,
    key: str,
    text: str,
    meta: Sequence[str],
    newest: Sequence[Column],
    deleted: Column | None = None,
    encode: Encode | None = None,
) -> None:
    """Write one batch's new, changed and deleted rows, embedded. Running it again changes nothing.

    Of several rows with one key the first by ``newest`` counts; if ``deleted`` holds for it the key leaves
    the index, until a later batch brings it back.
    """
    spark = rows.sparkSession
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    rows = latest_by_key(rows.withColumn("_deleted", gone), key, newest)
    index = read_index(spark, path, key, before=batch_id)
    alive, dead = rows.filter("NOT _deleted").select(key, text, *meta), rows.filter("_deleted")
    if index is not None:
        alive = alive.join(changed_keys(index, alive, key, text, meta), key, "left_semi")
    built = build_index(alive, key, text, meta, check_key=False, encode=encode).withColumn("deleted", F.lit(False))
    if deleted is not None:
        built = built.unionByName(dead.select(key, F.lit(True).alias("deleted")), allowMissingColumns=True)
    built.write.mode("overwrite").parquet(f"{path}/delta/batch={batch_id}")


def start_sync(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    key: str,
    text: str,
    meta: Sequence[str] = (),
    *,
    newest: Sequence[Column],
    deleted: Column | None = None,
    encode: Encode | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Process the files that arrived in ``source`` since the last run, then stop.

    ``prepare`` is any stateless preparation of the rows; ``newest`` orders rows of
    the same key within a batch, first wins; ``deleted`` marks rows whose key leaves the index.
    """
    stream = prepare(spark.readStream.schema(schema).parquet(source))
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda df, batch_id: apply_batch(df, batch_id, path, key, text, meta, newest, deleted, encode))
        .start()
    )
