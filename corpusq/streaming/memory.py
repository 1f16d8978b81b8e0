"""Running conversation summary as keyed streaming state."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusq.operators.chat import Mergeable, summary_step


def keep_last_words(n: int) -> Callable[[str, str, str], str]:
    """The built-in summariser: the last ``n`` words of summary, input and output."""
    return lambda summary, said, answer: " ".join(f"{summary} {said} {answer}".split()[-n:])


class SummaryMemory(StatefulProcessor):
    """State per conversation: the summary so far, bounded by the summariser."""

    def __init__(self, factory: Callable[[], Callable[[str, str, str], str]], conv: str, turn: str) -> None:
        self.factory, self.conv, self.turn = factory, conv, turn

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summarise = self.factory()
        self.state = handle.getValueState("summary", T.StructType([T.StructField("summary", T.StringType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        summary = self.state.get()[0] if self.state.exists() else ""
        pdf = pd.concat(list(rows)).sort_values(self.turn)
        out = []
        for said, answer in zip(pdf["input"], pdf["output"]):
            summary = summary_step(self.summarise, summary, said, answer)
            out.append(summary)
        self.state.update((summary,))
        yield pdf[[self.conv, self.turn]].assign(summary=out)

    def close(self) -> None:
        pass


_TURN = T.StructType([T.StructField("turn", T.LongType()), T.StructField("input", T.StringType()), T.StructField("output", T.StringType())])


class OrderedMemory(StatefulProcessor):
    """Folds the pairs of a conversation by their place, whatever batch they come in.

    State per conversation: the summary so far and the next place, and the pairs that came too early, by place. A pair is folded as
    soon as all places before it are; with ``patience`` (milliseconds) a gap that stays that long is given up and the
    pairs behind it are folded. A pair whose place is folded already, a repeated one for example, is left out.
    """

    def __init__(self, factory: Callable[[], Mergeable], conv: str, turn: str, position: str, patience: int | None) -> None:
        self.factory, self.conv, self.turn, self.position, self.patience = factory, conv, turn, position, patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.summary = handle, self.factory()
        place = T.StructType([T.StructField("place", T.LongType())])
        self.state = handle.getValueState("state", T.StructType([*place.fields, T.StructField("state", T.StringType())]))
        self.early = handle.getMapState("early", place, _TURN)

    def _fold(self, key: Any, skip_gaps: bool) -> Iterator[pd.DataFrame]:
        place, state = self.state.get() if self.state.exists() else (0, None)
        if skip_gaps:
            place = min((k[0] for k in self.early.keys()), default=place)
        out = []
        while self.early.containsKey((place,)):
            turn, said, answer = self.early.getValue((place,))
            self.early.removeKey((place,))
            own = self.summary.of(said, answer)
            state = own if state is None else self.summary.merge(state, own)
            out.append((key[0], turn, self.summary.show(state)))
            place += 1
        self.state.update((place, state))
        if out:
            yield pd.DataFrame(out, columns=[self.conv, self.turn, "summary"])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        done = self.state.get()[0] if self.state.exists() else 0
        for pdf in rows:  # frame by frame; what waits is in the state store, not in memory
            for place, turn, said, answer in zip(pdf[self.position], pdf[self.turn], pdf["input"], pdf["output"]):
                if place >= done:
                    self.early.updateValue((int(place),), (int(turn), said, answer))
        yield from self._fold(key, False)
        if self.patience is not None and any(True for _ in self.early.keys()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if any(True for _ in self.early.keys()):
            yield from self._fold(key, True)
            if any(True for _ in self.early.keys()):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)

    def close(self) -> None:
        pass


def stream_ordered_summaries(
    pairs: DataFrame,
    factory: Callable[[], Mergeable],
    conv: str = "conv_id",
    turn: str = "turn",
    position: str = "position",
    patience: int | None = None,
) -> DataFrame:
    """``(conv, turn, summary)`` for a stream of turn pairs in any order, as ``fold_mergeable`` gives it; needs the RocksDB state store.

    ``position`` is the pair's dense place in its conversation (0, 1, 2 …). With ``patience`` use a trigger that keeps running: a query that only
    takes what is available does not end while timers can fire.
    """
    schema = T.StructType([pairs.schema[conv], T.StructField(turn, T.LongType()), T.StructField("summary", T.StringType())])
    processor = OrderedMemory(factory, conv, turn, position, patience)
    mode = "none" if patience is None else "processingTime"
    return pairs.groupBy(conv).transformWithStateInPandas(processor, schema, outputMode="append", timeMode=mode)


def stream_summaries(
    pairs: DataFrame,
    factory: Callable[[], Callable[[str, str, str], str]],
    conv: str = "conv_id",
    turn: str = "turn",
) -> DataFrame:
    """``(conv, turn, summary)`` for a stream of turn pairs whose batches come in order, with any summariser; needs the RocksDB state store."""
    schema = T.StructType([pairs.schema[conv], pairs.schema[turn], T.StructField("summary", T.StringType())])
    return pairs.groupBy(conv).transformWithStateInPandas(
        SummaryMemory(factory, conv, turn), schema, outputMode="append", timeMode="none"
    )
