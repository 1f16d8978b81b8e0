"""Composition of steps: chains, parallel outputs, routing."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[DataFrame], DataFrame]


def chain(*steps: Step) -> Step:
    """One step that runs the given ones in order."""
    return lambda df: reduce(lambda d, step: d.transform(step), steps, df)


def assign(**columns: Column) -> Step:
    """Keep the input and add columns."""
    return lambda df: df.withColumns(columns)


def parallel(*keep: str, **outputs: Column) -> Step:
    """Several named outputs of the same input, in one projection."""
    return lambda df: df.select(*keep, *[c.alias(name) for name, c in outputs.items()])


def passthrough(df: DataFrame) -> Column:
    """The whole input as one struct."""
    return F.struct(*df.columns)


def route(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first branch whose condition holds, otherwise the default."""
    out = default
    for condition, value in reversed(branches):
        out = F.when(condition, value).otherwise(out)
    return out


def dispatch(df: DataFrame, branches: Sequence[tuple[Column, Step]], default: Step) -> DataFrame:
    """Run a different step per branch: for handlers too costly to run on every row.

    Rows are numbered by their first matching branch, so the parts are disjoint
    and cover the input, rows with a NULL condition included. The input is read
    once per branch: ``materialise`` it first when it is costly.
    """
    number = route([(c, F.lit(i)) for i, (c, _) in enumerate(branches)], F.lit(len(branches)))
    numbered = df.withColumn("_branch", number)
    steps = [step for _, step in branches] + [default]
    parts = [step(numbered.filter(F.col("_branch") == i).drop("_branch")) for i, step in enumerate(steps)]
    return reduce(lambda a, b: a.unionByName(b), parts)


def message_content(messages: Column) -> Column:
    """The text of the last message of a list, as a string parser gives it."""
    return F.get(messages, F.size(messages) - 1)["content"]
