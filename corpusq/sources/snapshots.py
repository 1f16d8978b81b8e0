"""Differences between two states of a table, by key or by whole row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_digest(columns: Sequence[str]) -> Column:
    """256-bit digest of the named columns; NULL differs from an empty text."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns])), 256)


def latest_by_key(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``.

    Written as ``row_number() = 1`` so that each task cuts a hot key to one row
    before the shuffle (``WindowGroupLimit``).
    """
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def assert_unique(df: DataFrame, key: str) -> DataFrame:
    """``df`` when its key is unique and not NULL; otherwise ``ValueError``.

    Runs one aggregation over the key column alone.
    """
    bad = (
        df.groupBy(F.col(key).alias("k")).count().filter("count > 1 OR k IS NULL").limit(1).collect()
    )
    if bad:
        raise ValueError(f"key {key!r} is not unique: {bad[0]['k']!r} occurs {bad[0]['count']} times")
    return df


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``(key, change)`` with change insert, update or delete; unchanged keys are left out.

    Only the key and a digest are shuffled, not the texts. Keys must be unique and not NULL on both sides: a job that meets another key
    fails. Keys are counted on the way to the join, in the same exchange.
    """
    columns = list(columns or [c for c in new.columns if c != key])

    def digests(df: DataFrame, out: str) -> DataFrame:
        rows = df.select(F.col(key), row_digest(columns).alias(out)).groupBy(key).agg(F.first(out).alias(out), F.count(F.lit(1)).alias("_n"))
        bad = F.col(key).isNull() | (F.col("_n") > 1)
        told = F.raise_error(F.concat(F.lit(f"key {key} is not unique: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))).cast("string")
        return rows.select(key, F.when(bad, told).otherwise(F.col(out)).alias(out))

    before, after = digests(old, "_before"), digests(new, "_after")
    change = (
        F.when(F.col("_before").isNull(), "insert")
        .when(F.col("_after").isNull(), "delete")
        .when(F.col("_before") != F.col("_after"), "update")
    )
    return (
        before.join(after, key, "full_outer").select(key, change.alias("change")).filter("change IS NOT NULL")
    )


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` lacks, all columns compared, NULL equal to NULL.

    Rows are compared by their digest. Copies are removed in each task first; then the rows of ``left`` cross one
    exchange, by digest, which the join uses too. Of ``right`` only digests move.
    """
    columns = left.columns
    rows = left.withColumn("_digest", row_digest(columns)).dropDuplicates(["_digest"])
    others = right.select(row_digest(columns).alias("_digest")).distinct()
    return rows.join(others, "_digest", "left_anti").select(*columns)


def new_rows_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key ``right`` lacks."""
    return left.join(right.select(key), key, "left_anti")


def upsert(current: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """``current`` with ``changed`` rows replaced or added. Keys are unique on both sides.

    Only the changed keys meet the current table, and the join is broadcast by
    adaptive execution when they turn out to be few.
    """
    return current.join(changed.select(key), key, "left_anti").unionByName(changed)
