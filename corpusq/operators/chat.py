"""Conversation history, summaries, keywords and conversational retrieval."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import prompts as P
from corpusq.functions import terms as V
from corpusq.functions import text as X
from corpusq.operators import ordered as O
from corpusq.operators import search as S
from corpusq.operators.infer import Scorer, batch_score
from corpusq.operators.joins import lookup_join
from corpusq.sources.materialise import materialise, stored

USER, ASSISTANT = "user", "assistant"


def line(role: str, text: str) -> Column:
    return F.concat(F.col(role), F.lit(": "), F.col(text))


def history_buffer(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_rows: int = O.BLOCK_ROWS,
) -> DataFrame:
    """Adds ``history``: all earlier turns of the conversation, one line each."""
    return O.running_text(df, conv, turn, line(role, text), "history", "\n", False, block_rows)


def accumulate_query(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_rows: int = O.BLOCK_ROWS,
) -> DataFrame:
    """User turns with ``request``: their own and all earlier user texts, space-joined."""
    users = df.filter(F.col(role) == USER)
    return O.running_text(users, conv, turn, F.col(text), "request", " ", True, block_rows)


def turn_pairs(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_rows: int = O.BLOCK_ROWS,
) -> DataFrame:
    """``(conv, turn, input, output)``: each user turn that an assistant turn follows."""
    rows, keys = O.with_neighbours(df.select(conv, turn, role, text), conv, turn, after=1, block_rows=block_rows)
    w = Window.partitionBy(*keys).orderBy(turn)
    return (
        rows.withColumn("_next", F.lead(F.struct(role, text)).over(w))
        .filter((F.col(role) == USER) & (F.col("_next")[role] == ASSISTANT) & ~F.col("_copy"))
        .select(conv, turn, F.col(text).alias("input"), F.col("_next")[text].alias("output"))
    )


def history_summary(
    df: DataFrame,
    last: int = 4,
    words: int = 50,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_rows: int = O.BLOCK_ROWS,
) -> DataFrame:
    """``(conv, turn, summary)``: the last turns before this one, cut to a number of words."""
    rows, keys = O.with_neighbours(df.select(conv, turn, role, text), conv, turn, before=last, block_rows=block_rows)
    w = Window.partitionBy(*keys).orderBy(turn).rowsBetween(-last, -1)
    joined = F.array_join(F.collect_list(line(role, text)).over(w), " ")
    return (
        rows.withColumn("_history", joined)
        .filter(~F.col("_copy"))
        .select(conv, turn, X.lead_words(X.last_segment(F.col("_history")), words).alias("summary"))
    )


def summary_step(summarise: Callable[[str, str, str], str], summary: str, said: str, answer: str) -> str:
    """One step of a running summary, in batch and in streams: the summariser's text after its last marker."""
    return summarise(summary, said, answer).split(X.SUMMARY_MARKER)[-1]


def fold_summary(
    df: DataFrame,
    factory: Callable[[], Callable[[str, str, str], str]],
    conv: str = "conv_id",
    turn: str = "turn",
) -> DataFrame:
    """Running summary over ``turn_pairs`` with an injected ``(summary, input, output) -> summary``.

    A fold with any summariser depends on its previous step, so a conversation stays in one task;
    rows stream through it in order and only the running summary is held. ``fold_mergeable`` spreads a conversation over many tasks.
    """
    schema = T.StructType([df.schema[conv], df.schema[turn], T.StructField("summary", T.StringType())])

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summarise = factory()
        current, summary = None, ""
        for pdf in batches:
            out = []
            for c, said, answer in zip(pdf[conv], pdf["input"], pdf["output"]):
                if c != current:
                    current, summary = c, ""
                summary = summary_step(summarise, summary, said, answer)
                out.append(summary)
            yield pdf[[conv, turn]].assign(summary=out)

    ordered = df.select(conv, turn, "input", "output").repartition(conv).sortWithinPartitions(conv, turn)
    return ordered.mapInPandas(fold, schema)


class Mergeable(Protocol):
    """A running summary that two halves of a conversation can make apart: ``merge`` is associative, states are texts.

    ``of`` is the state of one pair, ``show`` the summary that a state stands for.
    """

    def of(self, said: str, answer: str) -> str: ...

    def merge(self, earlier: str, later: str) -> str: ...

    def show(self, state: str) -> str: ...


class RunningSummary:
    """Counts of pairs and words, a checksum that depends on every pair and its place, and the last words."""

    MODULUS = 1_000_003

    def __init__(self, last: int = 20):
        self.last = last

    def of(self, said: str, answer: str) -> str:
        words = f"{said} {answer}".split()
        value = int(hashlib.md5(f"{said} {answer}".encode()).hexdigest()[:8], 16) % self.MODULUS
        return json.dumps([1, len(words), value, value, words[-self.last :]])

    def merge(self, earlier: str, later: str) -> str:
        n, words, total, placed, tail = json.loads(earlier)
        n2, words2, total2, placed2, tail2 = json.loads(later)
        placed = (placed + placed2 + n * total2) % self.MODULUS  # the later pairs stand n places further on
        return json.dumps([n + n2, words + words2, (total + total2) % self.MODULUS, placed, (tail + tail2)[-self.last :]])

    def show(self, state: str) -> str:
        n, words, _, placed, tail = json.loads(state)
        return f"{n} pairs, {words} words, checksum {placed}: {' '.join(tail)}"


def fold_mergeable(
    df: DataFrame,
    factory: Callable[[], Mergeable],
    conv: str = "conv_id",
    turn: str = "turn",
    block_rows: int = O.BLOCK_ROWS,
) -> DataFrame:
    """``(conv, turn, summary)``: the running summary of ``turn_pairs``, as a serial fold gives it, made by many tasks per conversation.

    Two sweeps: each block of turns is summarised on its own and a scan over the blocks' states gives what stands before each; then each
    block is folded from there. Rows stream through a task block by block. Only conversations of more than one block take part in the first sweep.
    """
    schema = T.StructType([df.schema[conv], df.schema[turn], T.StructField("summary", T.StringType())])
    rows = stored(df.select(conv, turn, "input", "output", O._block(turn, block_rows).alias("_block")), "pairs")
    blocks = rows.select(conv, "_block").distinct()
    many = blocks.groupBy(conv).count().filter("count > 1").select(conv)
    state_schema = T.StructType([df.schema[conv], T.StructField("_block", T.LongType()), T.StructField("_state", T.StringType())])

    def in_blocks(frame: DataFrame) -> DataFrame:
        return frame.repartition(conv, "_block").sortWithinPartitions(conv, "_block", turn)

    def steps(batches: Iterator[pd.DataFrame], summary: Mergeable):
        """``(conv, block, turn, state)`` after each row, a block's first head put before its first row."""
        place, state = None, None
        for pdf in batches:
            heads = pdf["_head"] if "_head" in pdf else [None] * len(pdf)
            for c, b, t, said, answer, head in zip(pdf[conv], pdf["_block"], pdf[turn], pdf["input"], pdf["output"], heads):
                own = summary.of(said, answer)
                if (c, b) != place:
                    place, state = (c, b), head if isinstance(head, str) else None
                state = own if state is None else summary.merge(state, own)
                yield c, b, t, state

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, out = None, []
        for c, b, _, state in steps(batches, factory()):
            if last is not None and last[:2] != (c, b):
                out.append(last)
            last = (c, b, state)
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=state_schema.names)
                out = []
        if last is not None:
            yield pd.DataFrame([*out, last], columns=state_schema.names)

    def show(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        summary, out = factory(), []
        for c, _, t, state in steps(batches, summary):
            out.append((c, t, summary.show(state)))
            if len(out) >= 1000:
                yield pd.DataFrame(out, columns=schema.names)
                out = []
        if out:
            yield pd.DataFrame(out, columns=schema.names)

    def merged(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        summary = factory()
        for earlier, later in pairs:
            yield pd.Series([None if a is None else summary.merge(a, b) for a, b in zip(earlier, later)], dtype=object)

    states = in_blocks(rows.join(many, conv, "left_semi")).mapInPandas(sweep, state_schema)
    heads = O.scan_blocks(states, blocks, conv, "_state", F.pandas_udf(merged, T.StringType()), "_head")
    return in_blocks(rows.join(heads.hint("merge"), [conv, "_block"], "left")).mapInPandas(show, schema)


def turn_keywords(
    df: DataFrame, n: int = 10, conv: str = "conv_id", turn: str = "turn", text: str = "text"
) -> DataFrame:
    """``(conv, turn, keywords)``: the ``n`` words of highest tf · idf, best first.

    Ties go to the word that sorts first. Turns without a word have no row.

    Common words are hot keys of the idf join; ``lookup_join`` keeps them out of
    the shuffle.
    """
    # Words are extracted once; the document frequencies and the join read the written rows.
    terms = materialise(df.select(conv, turn, F.inline_outer(V.word_counts(F.col(text)))))
    total = terms.select(conv, turn).distinct().count()
    terms = terms.filter("term IS NOT NULL")
    idf = (
        terms.groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .withColumn("idf", F.log((1 + F.lit(total)) / (1 + F.col("df"))))
    )
    weighted = lookup_join(terms, idf, "term", "idf", "df", [conv, turn]).withColumn(
        "score", F.round(F.col("tf") * F.col("idf"), 6)
    )
    w = Window.partitionBy(conv, turn).orderBy(F.desc("score"), "term")
    return (
        weighted.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= n)
        .groupBy(conv, turn)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_top"))
        .select(conv, turn, F.array_join(F.col("_top.term"), " ").alias("keywords"))
    )


def chat_recommend(
    turns: DataFrame,
    documents: DataFrame,
    *,
    doc_id: str,
    doc_text: str,
    requests: DataFrame | None = None,
    history: DataFrame | None = None,
    k: int = 3,
    threshold: float = 0.70,
    words: int = 100,
    keywords: int | None = None,
    filters: Mapping[str, Any] | None = None,
    encode: Callable[[DataFrame, str, str], DataFrame] | None = None,
    factory: Callable[[], Scorer] | None = None,
    fallback: str = "no matching report",
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One answer per user turn: gated search, prompt with history and report, score.

    ``requests`` replaces the user turns' own text, e.g. by ``accumulate_query``. The whole request is searched
    for, or with ``keywords`` its words of highest tf · idf. The history is all earlier turns, or the column ``summary`` of
    ``history`` (``history_summary``, ``fold_summary``); a turn that it lacks has none. ``filters`` choose documents before
    the search. All conversations run in one plan.
    """
    if requests is None:
        requests = turns.filter(F.col(role) == USER).select(conv, turn, F.col(text).alias("request"))
    if keywords is None:
        found = requests.select(conv, turn, F.col("request").alias("keywords"))
    else:
        found = turn_keywords(requests, keywords, conv, turn, "request")
    ask_id = X.composite_id(F.col(conv), F.col(turn)).alias("ask_id")
    questions = materialise(found.select(conv, turn, ask_id, "keywords"))
    hits = S.text_search(
        documents, questions, k, id_col=doc_id, text=doc_text, query_id="ask_id", query_text="keywords",
        filters=filters, encode=encode,
    )
    top = hits.filter((F.col("rank") == 1) & (F.col("score") > threshold))
    reports = S.attach_columns(top, documents, doc_id, [doc_text]).select(
        "ask_id", doc_id, "score", F.col(doc_text).alias("_report")
    )
    if history is None:
        buffered = history_buffer(turns.select(conv, turn, role, text), conv, turn, role, text)
        history = buffered.select(conv, turn, F.col("history").alias("summary"))
    asked = (
        requests.select(conv, turn)
        .join(history.select(conv, turn, "summary"), [conv, turn], "left")
        .join(questions, [conv, turn], "left")
        .join(reports, "ask_id", "left")
    )
    report = F.coalesce(F.col("_report"), F.lit(fallback))
    prompt = P.render(P.ANSWER_TEMPLATE, {"history": F.col("summary"), "report": report})
    scored = batch_score(
        asked.withColumn("prompt", prompt).withColumn("max_new_tokens", F.lit(words).cast("long")),
        factory,
        content=report,
    )
    return scored.select(
        conv,
        turn,
        "keywords",
        doc_id,
        "score",
        F.col("score").isNotNull().alias("matched"),
        "prompt",
        F.col("model_output").alias("answer"),
    )
