"""Substring dedup by sliding sentence spans.

Every run of several consecutive sentences is hashed. The first place of a run, by
document id and position, stays; sentences covered by the run at any other place are
removed. Only hashes with ids and positions are joined; texts move once at the end.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow, written

RUN = 3
#: A run of fewer words is too common to be evidence of copying.
MIN_WORDS = 10
#: Longer sentences are cut after so many words, so that a long passage always holds a run.
PIECE_WORDS = 15

#: Possessive runs, so that a long row of full stops is read once.
_SENTENCE = re.compile(r"[^\n](?:[^\n.!?]++|[.!?]++(?!\s))*+[.!?]*+")
_WORD = re.compile(r"\S+")
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def sentences(text: str, piece_words: int = PIECE_WORDS) -> list[tuple[int, int, str, int]]:
    """``(start, end, normalised, words)`` of the sentences with a word.

    A sentence ends with ``. ! ?`` before white space, or with its line. Case and white space do
    not count in the normalised form. Offsets are code points.
    """
    found = []
    for m in _SENTENCE.finditer(text):
        sentence = m[0]
        words = sentence.lower().split()
        if not words:
            continue
        if len(words) <= piece_words:
            found.append((m.start(), m.end(), " ".join(words), len(words)))
            continue
        places = [(w.start(), w.end()) for w in _WORD.finditer(sentence)]
        for i in range(0, len(places), piece_words):
            part = places[i : i + piece_words]
            own = sentence[part[0][0] : part[-1][1]].lower().split()
            found.append((m.start() + part[0][0], m.start() + part[-1][1], " ".join(own), len(part)))
    return found


def _runs(found: list[tuple[int, int, str, int]], run: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs with enough words, and the numbers of their first sentences."""
    n = len(found) - run + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(s[2]) for s in found), np.uint64, len(found))
    words = np.fromiter((s[3] for s in found), np.int64, len(found))
    mixed, total = np.zeros(n, np.uint64), np.zeros(n, np.int64)
    for k in range(run):
        mixed = (mixed ^ hashes[k : k + n]) * np.uint64(_MIX[0])
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(_MIX[1])
        total += words[k : k + n]
    keep = np.flatnonzero(total >= min_words)
    return mixed[keep].view(np.int64), keep.astype(np.int32)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def repeated_sentences(
    docs: DataFrame, doc_id: str, text: str, run: int = RUN, min_words: int = MIN_WORDS, piece_words: int = PIECE_WORDS
) -> DataFrame:
    """``(id, tx, runs)``: numbers of the sentences at which a non-first repeated run begins.

    ``tx`` is a 128-bit digest of the text, so that rows which share an id or have none stay apart. Counts and first places are combined before
    their shuffle, so a run of every document reaches a task once per map task; the join back splits hot runs.
    """
    rows = docs.select(F.col(doc_id).alias("id"), _digest(F.col(text)).alias("tx"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def hashed(table: pa.Table) -> pa.Table:
        runs, firsts, counts = [], [], []
        for value in table["text"].to_pylist():
            h, first = _runs(sentences(value or "", piece_words), run, min_words)
            runs.append(h)
            firsts.append(first)
            counts.append(len(h))
        place = pa.array(np.repeat(np.arange(len(counts)), counts))
        return pa.table(
            {
                "run": pa.array(np.concatenate(runs)),
                "id": table["id"].take(place),
                "tx": table["tx"].take(place),
                "first": pa.array(np.concatenate(firsts)),
            }
        )

    schema = f"run long, id {kind}, tx binary, first int"
    places = written(map_arrow(rows, hashed, schema, 8 << 20), "runs")
    at = F.struct("id", "tx", "first")
    repeated = (
        places.groupBy("run")
        .agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("kept"))
        .filter("n > 1")
        .select("run", "kept")
    )
    # Written, so that both sides of the join come straight from a shuffle and a hot run can be split.
    later = places.join(written(repeated, "repeated"), "run").filter(~at.eqNullSafe(F.col("kept")))
    return later.groupBy("id", "tx").agg(F.sort_array(F.collect_set("first")).alias("runs"))


def remove_repeated_spans(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    run: int = RUN,
    min_words: int = MIN_WORDS,
    piece_words: int = PIECE_WORDS,
) -> DataFrame:
    """``(id, n_sentences, n_removed, removed_words, spans, clean_text)`` per row of ``docs``.

    ``spans`` holds the removed character ranges, neighbours merged. Rows that repeat
    as a whole (id and text) count as one document and are all returned. A NULL text
    has no sentences and stays NULL; a text of fewer than ``run`` sentences is never
    changed. Extra columns are not read.
    """
    found = repeated_sentences(docs, doc_id, text, run, min_words, piece_words)
    found = found.select(F.struct("id", "tx").alias("hit"), "runs")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    own = F.struct(F.col("id"), _digest(F.col("text")))
    joined = rows.join(found, own.eqNullSafe(F.col("hit")), "left").select("id", "text", "runs")
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, n_sentences long, n_removed long, removed_words long, "
        "spans array<struct<start:int,end:int>>, clean_text string"
    )

    def cut(table: pa.Table) -> pa.Table:
        out = []
        for value, runs in zip(table["text"].to_pylist(), table["runs"].to_pylist(), strict=True):
            out.append(_cut(value, runs or [], run, piece_words))
        counts, removed, words, spans, texts = (list(c) for c in zip(*out, strict=True))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table(
            {
                "id": table["id"],
                "n_sentences": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "removed_words": pa.array(words, pa.int64()),
                "spans": pa.array(spans, span),
                "clean_text": pa.array(texts, pa.string()),
            }
        )

    return map_arrow(joined, cut, schema, 8 << 20)


def _cut(text: str | None, runs: list[int], run: int, piece_words: int):
    found = sentences(text or "", piece_words)
    gone = sorted({k for first in runs for k in range(first, first + run)})
    spans: list[dict] = []
    for before, k in zip([None, *gone], gone):
        if before is not None and k == before + 1:
            spans[-1]["end"] = found[k][1]
        else:
            spans.append({"start": found[k][0], "end": found[k][1]})
    clean = text
    if spans:
        edges = [0, *(e for s in spans for e in (s["start"], s["end"])), len(text)]
        clean = "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return len(found), len(gone), sum(found[k][3] for k in gone), spans, clean
