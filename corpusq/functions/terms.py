"""Hashed term vectors, built inside one row: no explode and no shuffle.

A vector is ``array<struct<term, tf>>`` sorted by term. Counts are integers, so
dot products are exact and do not depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusq.functions.text import let, words

DEFAULT_BUCKETS = 1 << 18


def bucket_of(word: Column, buckets: int) -> Column:
    """The first 32 bits of the word's md5, folded into ``buckets``."""
    return F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("long") % F.lit(buckets)


def _runs(items: Column) -> Column:
    """Run lengths of a sorted array."""
    n = F.size(items)
    starts = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(items, i) != F.get(items, i - 1)),
    )
    runs = let(
        starts,
        lambda s: F.transform(
            s,
            lambda i, j: F.struct(
                F.get(items, i).alias("term"),
                (F.coalesce(F.get(s, j + 1), n) - i).cast("long").alias("tf"),
            ),
        ),
    )
    return F.when(n > 0, runs).otherwise(F.filter(F.transform(items, lambda x: F.struct(
        x.alias("term"), F.lit(0).cast("long").alias("tf"))), lambda _: F.lit(False)))


def word_counts(text: Column) -> Column:
    """``array<struct<term: string, tf: bigint>>`` of a text's words."""
    return let(F.sort_array(words(text)), _runs)


def term_vector(text: Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """``array<struct<term: bigint, tf: bigint>>`` of a text's hashed words."""
    return let(F.sort_array(F.transform(words(text), lambda w: bucket_of(w, buckets))), _runs)


def squared_norm(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0).cast("long"), lambda acc, t: acc + t["tf"] * t["tf"])


def dense_counts(vector: Column, dim: int) -> Column:
    """A sparse vector over ``dim`` buckets as ``array<bigint>``, zeros filled in; linear in ``dim``."""
    zero = F.lit(0).cast("long")

    def fill(v: Column) -> Column:
        filled = F.transform(
            v,
            lambda t, j: F.concat(
                F.array_repeat(zero, (t["term"] - F.coalesce(F.get(v, j - 1)["term"], F.lit(-1)) - 1).cast("int")),
                F.array(t["tf"]),
            ),
        )
        last = F.coalesce(F.get(v, F.size(v) - 1)["term"], F.lit(-1))
        return F.concat(F.flatten(filled), F.array_repeat(zero, (dim - 1 - last).cast("int")))

    return let(vector, fill)


def l2_normalise(counts: Column) -> Column:
    """``array<float>`` of unit length; a zero vector stays zero."""

    def length(c: Column) -> Column:
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))

    return let(
        counts,
        lambda c: let(
            length(c),
            lambda n: F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)).cast("float")),
        ),
    )
