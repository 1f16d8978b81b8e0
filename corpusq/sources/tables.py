"""Reading and writing named tables and parquet folders."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_landing_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with header and quoted fields in which ``NA`` stands for a missing value."""
    return spark.read.csv(
        path, schema=schema, header=True, nullValue="NA", multiLine=True, quote='"', escape='"'
    )


def use_namespace(spark: SparkSession, name: str) -> None:
    if not re.fullmatch(r"\w+(\.\w+)?", name):
        raise ValueError(f"not a namespace name: {name!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def overwrite_table(df: DataFrame, name: str) -> None:
    """Replace a table's rows; the columns must be those it has."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name) and set(spark.table(name).columns) != set(df.columns):
        raise ValueError(f"columns differ from table {name}; use overwrite_with_schema")
    df.write.mode("overwrite").saveAsTable(name)


def overwrite_with_schema(df: DataFrame, name: str) -> None:
    """Replace a table's rows and its schema."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def overwrite_merging_schema(df: DataFrame, name: str) -> None:
    """Replace a table's rows; its old columns stay and are NULL where ``df`` lacks them, new ones are added."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        old = [f for f in spark.table(name).schema.fields if f.name not in df.columns]
        kept = [F.lit(None).cast(f.dataType).alias(f.name) for f in old]
        first = [c for c in spark.table(name).columns if c in df.columns]
        names = [*spark.table(name).columns, *[c for c in df.columns if c not in first]]
        df = df.select("*", *kept).select(*names)
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def align(df: DataFrame, schema: T.StructType, required: Sequence[str] = ()) -> DataFrame:
    """``df`` with the schema's columns in its order; missing ones are NULL unless required."""
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if c not in schema.names]
    if missing or extra:
        raise ValueError(f"cannot align: missing {missing}, unknown {extra}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append_rows(df: DataFrame, name: str, key: str) -> None:
    """Append to a table; rows must carry the key, other missing columns become NULL."""
    align(df, df.sparkSession.table(name).schema, required=[key]).write.mode("append").saveAsTable(name)


def from_rows(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """A small local list as a table; the full schema also covers an empty list."""
    widths = {len(r) for r in rows} - {len(schema.fields)}
    if widths:
        raise ValueError(f"rows of {sorted(widths)} values for {len(schema.fields)} columns")
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def write_clustered(df: DataFrame, path: str, key: str) -> None:
    """Parquet range-partitioned and sorted by key, so that key filters skip files."""
    df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite").parquet(path)
