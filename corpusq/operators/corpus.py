"""Corpus preparation: projection, document assembly, measures, size filter, profile."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import text as X
from corpusq.functions.predicates import compile_filter
from corpusq.operators.joins import compute_once


def project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Columns ``{new name: source name}``."""
    return df.select(*[F.col(src).alias(new) for new, src in columns.items()])


def bulk_rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"no such columns to rename: {missing}")
    return df.withColumnsRenamed(dict(names))


def prepare_documents(
    df: DataFrame, name: str, report: str, position: str, out: str = "document", reluctant: bool = False
) -> DataFrame:
    """Assemble, collapse white space, then remove the boilerplate."""
    labels = dict(zip(X.DOCUMENT_LABELS, (F.col(name), F.col(report), F.col(position))))
    document = X.strip_boilerplate(
        X.collapse_whitespace(X.assemble_document(labels)), reluctant=reluctant
    )
    return df.withColumn(out, document)


def tokenizer_udf(factory: Callable[[], Callable[[str], int]]) -> Callable[[Column], Column]:
    """A token-count column from an injected tokenizer, built once per task."""

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = factory()
        for batch in batches:
            yield batch.map(lambda s: None if s is None else tokens(s)).astype("Int64")

    return F.pandas_udf(count, T.LongType())


def with_metrics(
    df: DataFrame,
    text: str = "document",
    tokens: Callable[[Column], Column] = X.token_count,
    prefix: str = "document",
) -> DataFrame:
    """Character, word and token counts of a text column.

    The counts are made to be filtered on, so they are computed once.
    """
    c = F.col(text)
    return compute_once(
        df,
        **{
            f"{prefix}_num_chars": X.char_count(c),
            f"{prefix}_num_words": X.word_count(c),
            f"{prefix}_num_tokens": tokens(c),
        },
    )


def within_budget(df: DataFrame, tokens: str = "document_num_tokens", limit: int = 2000) -> DataFrame:
    """Rows of at most ``limit`` tokens; a NULL count is dropped."""
    return df.filter(F.col(tokens) <= limit)


def token_profile(df: DataFrame, tokens: str = "document_num_tokens", long_limit: int = 3500) -> DataFrame:
    """Mean, maximum, minimum and number of long documents, in one pass of SQL over a view."""
    view = "corpusq_token_profile"
    df.select(F.col(tokens).alias("n")).createOrReplaceTempView(view)
    return df.sparkSession.sql(
        f"""
        SELECT avg(n) AS mean_tokens, max(n) AS max_tokens, min(n) AS min_tokens,
               sum(CASE WHEN n > {int(long_limit)} THEN 1 ELSE 0 END) AS long_documents
        FROM {view}
        """
    )


def limit_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key, so that the same rows come back every time."""
    return df.orderBy(key).limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long")
    )


def where(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    return df.filter(compile_filter(filters, df.columns))


def latest_version(df: DataFrame, name: str, version: str) -> DataFrame:
    """Highest numeric version per name; texts that are not numbers are ignored."""
    return df.groupBy(name).agg(
        F.max(F.col(version).try_cast("long")).alias("latest_version")
    )
