"""Batch scoring with an injected model, and the built-in deterministic one."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import prompts as P
from corpusq.functions.text import lead_words, let, normalise_label

# The request a scorer receives, one row per call.
REQUEST = ("prompt", "system_prompt", "temperature", "max_new_tokens", "content")
CONTENT_MARKER = "content: "


class Scorer(Protocol):
    """Called with a frame of ``REQUEST`` columns; returns one text per row."""

    def __call__(self, requests: pd.DataFrame) -> pd.Series: ...


class LeadScorer:
    """The first ``max_new_tokens`` words of the request's content; ``lead_answer`` for models' interface.

    A request without ``content`` is answered from what follows its first marker, or from
    the whole prompt. The template's own marker is the first as long as no filled-in text stands before it;
    where one does, give ``content``.
    """

    def __call__(self, requests: pd.DataFrame) -> pd.Series:
        after = requests["prompt"].str.split(CONTENT_MARKER, n=1).str[-1]
        content = requests["content"].fillna(after) if "content" in requests else after
        return pd.Series(
            [" ".join(c.split(" ")[: int(n)]) for c, n in zip(content, requests["max_new_tokens"])],
            index=requests.index,
            dtype=object,
        )


def scorer_udf(factory: Callable[[], Scorer]) -> Callable[[Column], Column]:
    """A text column from a request struct; the model is built once per task."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        scorer = factory()
        for batch in batches:
            yield scorer(batch) if len(batch) else pd.Series([], dtype=object)

    return F.pandas_udf(score, T.StringType())


def with_request_defaults(df: DataFrame, system_prompt: str = P.DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """Fill the request columns, per row, where they are missing or NULL."""
    defaults = {
        "system_prompt": (F.lit(system_prompt), "string"),
        "temperature": (F.lit(P.DEFAULT_TEMPERATURE), "double"),
        "max_new_tokens": (F.lit(P.DEFAULT_MAX_NEW_TOKENS), "long"),
    }
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), value).cast(kind) if name in df.columns else value.cast(kind)
            for name, (value, kind) in defaults.items()
        }
    )


def batch_score(
    df: DataFrame,
    factory: Callable[[], Scorer] | None = None,
    out: str = "model_output",
    content: Column | None = None,
) -> DataFrame:
    """Score every row of a request frame.

    Without a ``factory`` the built-in scorer runs as a column expression. With one only the
    request columns travel to Python. ``content`` is the text that the prompt is about.
    """
    ready = with_request_defaults(df)
    given = F.lit(None).cast("string") if content is None else content
    if factory is None:
        return ready.withColumn(out, lead_answer(F.col("prompt"), F.col("max_new_tokens"), given))
    request = F.struct(*REQUEST[:-1], given.alias("content"))
    return ready.withColumn(out, scorer_udf(factory)(request))


def lead_answer(prompt: Column, max_new_tokens: Column | int, content: Column | None = None) -> Column:
    """``LeadScorer`` as a column expression, for plans that need no Python worker."""
    after = F.array_join(F.slice(F.split(prompt, CONTENT_MARKER, 2), -1, 1), "")
    return lead_words(after if content is None else F.coalesce(content, after), max_new_tokens)


def row_seed(run_seed: int, *key: str) -> Column:
    """A 31-bit seed from a row's key and the run's seed: the same in every batch, partition and retry."""
    text = F.concat_ws("\x1f", F.lit(str(run_seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % (1 << 31)).alias("seed")


class SampledScorer:
    """A stand-in for a sampling model: ``max_new_tokens`` words of the content from a place that the row's seed and temperature choose."""

    def __call__(self, requests: pd.DataFrame) -> pd.Series:
        out = []
        for prompt, content, n, seed, t in zip(*(requests[c] for c in ("prompt", "content", "max_new_tokens", "seed", "temperature"))):
            words = (prompt if content is None or content != content else content).split(" ")
            start = int(seed) % len(words) if t > 0 else 0
            out.append(" ".join(words[start : start + int(n)]))
        return pd.Series(out, index=requests.index, dtype=object)


def score_all(
    df: DataFrame,
    factories: Mapping[str, Callable[[], Scorer]],
    key: Sequence[str],
    seed: int = 0,
    content: Column | None = None,
    requests: Mapping[str, Mapping[str, Column]] | None = None,
) -> DataFrame:
    """Adds one text column per scorer, all from one pass over the rows.

    The request travels to Python once, as a struct with the row's ``seed`` made from its ``key``; each scorer is built once per task and sees every row. ``requests``
    overrides request columns for one scorer, for example another prompt. A repeated run, whatever its batches, gives the same texts as far as
    the scorers keep to their seed.
    """
    given = F.lit(None).cast("string") if content is None else content
    ready = with_request_defaults(df)
    own = {name: dict((requests or {}).get(name, {})) for name in factories}
    common = F.struct(*[F.col(c) for c in REQUEST[:-1]], given.alias("content"), row_seed(seed, *key))
    more = [c.alias(f"{i}_{column}") for i, name in enumerate(factories) for column, c in own[name].items()]
    out = T.StructType([T.StructField(name, T.StringType()) for name in factories])
    changes = {name: list(columns) for name, columns in own.items()}

    def score(batches: Iterator[tuple[pd.DataFrame, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        scorers = [f() for f in factories.values()]
        for request, changed in batches:
            found = {}
            for i, (name, scorer) in enumerate(zip(factories, scorers)):
                mine = request.assign(**{c: changed[f"{i}_{c}"] for c in changes[name]})
                found[name] = scorer(mine) if len(mine) else pd.Series([], dtype=object)
            yield pd.DataFrame(found)

    scored = F.pandas_udf(score, out)(common, F.struct(*(more or [F.lit(0).alias("none")])))
    return ready.withColumn("_scored", scored).select(*[c for c in ready.columns if c not in factories], "_scored.*")


def classify(
    df: DataFrame,
    text: str,
    labels: list[str],
    factory: Callable[[], Scorer] | None = None,
    rules: dict[str, list[str]] | None = None,
    out: str = "topic",
) -> DataFrame:
    """One of ``labels`` per row, ``other`` for any further answer.

    The answer comes from a scorer, or from ordered rules ``label → words``.
    """
    if (factory is None) == (rules is None):
        raise ValueError("give either a scorer factory or rules")
    if rules is not None:

        def first_rule(lowered: Column) -> Column:
            raw = F.lit("other")
            for label, marks in reversed(list(rules.items())):
                found = reduce(lambda a, b: a | b, [lowered.contains(m) for m in marks], F.lit(False))
                raw = F.when(found, label).otherwise(raw)
            return raw

        answered = df.withColumn("_raw", let(F.lower(F.col(text)), first_rule))
    else:
        prompt = P.render(
            "Name the topic of the question in one word, one of {labels}.\n<question>\n{question}\n</question>\nTopic:",
            {"labels": F.lit(", ".join(labels)), "question": F.col(text)},
        )
        asked = df.withColumn("_prompt", prompt)
        request = F.struct(
            F.col("_prompt").alias("prompt"),
            F.lit(P.DEFAULT_SYSTEM_PROMPT).alias("system_prompt"),
            F.lit(P.DEFAULT_TEMPERATURE).alias("temperature"),
            F.lit(1).cast("long").alias("max_new_tokens"),
            F.col(text).alias("content"),
        )
        answered = asked.withColumn("_raw", scorer_udf(factory)(request)).drop("_prompt")
    known = [lab.lower() for lab in labels]
    topic = let(normalise_label(F.col("_raw")), lambda t: F.when(t.isin(known), t).otherwise("other"))
    return answered.withColumn(out, topic).drop("_raw")
