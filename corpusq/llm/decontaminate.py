"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` stores, for every segment (a run of documents of one task), the
positions of every word as delta-coded posting lists, and one directory row with the
segment's documents. Segments are bounded in bytes, so a word that stands in every
document owns one bounded list per segment, never one unbounded list.

``search`` cuts the test items into windows, takes the corpus frequency of their words
from the index, and sends each window only to the segments that hold its rarest word.
There the lists are intersected, rarest first, each adjusted by the word's offset.
Matches are exact phrases, and optionally proximity matches: every other word of
the window's rarest words within some distance of the rarest one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow, written

WINDOW = 10
SEGMENT_BYTES = 12 << 20
#: Unused positions between documents of a segment; phrases and proximity stay below it.
GAP = 256
NEAR_WORDS = 4
NEAR_SPAN = 20

# Byte classes: ASCII letters lowered, digits and bytes of other scripts kept, all else 0.
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x30:0x3A] = np.arange(0x30, 0x3A)
_CLASS[0x41:0x5B] = np.arange(0x61, 0x7B)
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x80:] = np.arange(0x80, 0x100)


def tokenise(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of all texts in order, dictionary-coded, and the number of words per text.

    A word is a run of ``[0-9a-z]`` and characters from U+0080 on, after lowering
    A-Z. All steps are array operations over the texts' bytes.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    plain = _CLASS[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data else np.zeros(0, np.uint8)
    borders = offsets - offsets[0]
    inside = plain != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = borders[:-1][borders[:-1] < len(plain)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    kept = np.cumsum(inside)
    ends = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    words = pa.BinaryArray.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(plain[inside])]
    )
    return words.dictionary_encode(), np.diff(np.searchsorted(starts, borders))


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of up to 35 bits in seven-bit groups, lowest first, the high bit set on all but a value's last byte; and each value's bytes."""
    values = values.astype(np.uint32) if len(values) and values.max() < 1 << 32 else values
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 5):
        long = values >= 1 << 7 * k if 7 * k < 32 or values.dtype != np.uint32 else np.zeros(1, bool)
        if not long.any():
            break
        sizes += long
    starts = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), np.uint8)
    data[starts] = (values & 127) | ((sizes > 1) * 128).astype(values.dtype)
    for k in range(1, int(sizes.max(initial=1))):
        long = np.flatnonzero(sizes > k)
        data[starts[long] + k] = (values[long] >> 7 * k & 127) | ((sizes[long] > k + 1) * 128).astype(values.dtype)
    return data, sizes


def unpacked(data: bytes | np.ndarray) -> np.ndarray:
    """The values that ``packed`` wrote."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)
    last = b < 128
    starts = np.append(0, np.flatnonzero(last)[:-1] + 1)
    group = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    return np.add.reduceat((b & 127).astype(np.int64) << 7 * group, starts)


def _bounds(n_words: np.ndarray) -> np.ndarray:
    """First position of each document, and the end."""
    return np.concatenate([[0], np.cumsum(n_words + GAP)]).astype(np.int64)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """``(segment, term, n, deltas, ids, n_words)``, stored in the shared folder.

    Posting rows have a term, its count and positions as packed differences; the one directory row of a
    segment (term NULL) has the document ids and word counts. A NULL text has no words.
    Nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"segment long, term binary, n int, deltas binary, ids array<{kind}>, n_words array<int>"
    done = {"task": -1, "segments": 0}

    def segment(table: pa.Table) -> pa.Table:
        task = TaskContext.get().partitionId()
        if done["task"] != task:
            done.update(task=task, segments=0)
        number = (task << 24) + done["segments"]
        done["segments"] += 1
        words, n_words = tokenise(table["text"].combine_chunks())
        codes = words.indices.to_numpy()
        gaps = np.repeat(np.arange(len(n_words), dtype=np.int64) * GAP, n_words)
        places = np.arange(len(codes), dtype=np.int64) + gaps
        order = np.argsort(codes, kind="stable")
        counts = np.bincount(codes, minlength=len(words.dictionary)).astype(np.int32)
        ends = np.cumsum(counts)
        deltas = np.diff(places[order], prepend=0)
        heads = ends - counts
        deltas[heads] = places[order][heads] if len(heads) else 0
        data, sizes = packed(deltas)
        borders = np.append(0, np.cumsum(sizes))[np.append(0, ends)].astype(np.int32)
        lists = pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(borders), pa.py_buffer(data)])
        n = len(counts)
        ids = table["id"].combine_chunks()
        return pa.table(
            {
                "segment": pa.array(np.full(n + 1, number, np.int64)),
                "term": pa.chunked_array([words.dictionary, pa.nulls(1, pa.binary())]),
                "n": pa.chunked_array([pa.array(counts), pa.nulls(1, pa.int32())]),
                "deltas": pa.chunked_array([lists, pa.nulls(1, pa.binary())]),
                "ids": pa.chunked_array(
                    [pa.nulls(n, pa.list_(ids.type)), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
                ),
                "n_words": pa.chunked_array(
                    [
                        pa.nulls(n, pa.list_(pa.int32())),
                        pa.ListArray.from_arrays(
                            pa.array([0, len(ids)], pa.int32()), pa.array(n_words.astype(np.int32))
                        ),
                    ]
                ),
            }
        )

    return written(map_arrow(rows, segment, schema, segment_bytes), "postings")


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``(item, win, terms)``: each item's runs of ``window`` words; a shorter item is one window."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))

    def cut(table: pa.Table) -> pa.Table:
        words, n_words = tokenise(table["text"].combine_chunks())
        codes, dictionary = words.indices.to_numpy(), words.dictionary.to_pylist()
        names, found, at = table["item"].to_pylist(), [], 0
        for name, n in zip(names, n_words, strict=True):
            own = [dictionary[c] for c in codes[at : at + n]]
            at += n
            for i in range(max(n - window, 0) + 1 if n else 0):
                found.append((name, b" ".join(own[i : i + window]), own[i : i + window]))
        columns = [list(c) for c in zip(*found, strict=True)] or [[], [], []]
        kinds = (pa.string(), pa.binary(), pa.list_(pa.binary()))
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "win", "terms"])

    return map_arrow(rows, cut, "item string, win binary, terms array<binary>", 4 << 20)


def search(
    index: DataFrame,
    windows: DataFrame,
    near_words: int = NEAR_WORDS,
    near_span: int = NEAR_SPAN,
    near: bool = True,
) -> DataFrame:
    """``(id, n_words, n_hit, n_near, items, spans)`` per indexed document row.

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` the sorted
    ids of the items with an occurring window, ``spans`` the merged hit ranges as word
    positions. ``n_near`` counts the windows with a proximity match (0 without ``near``). Items may repeat and be
    empty; without windows every document has no hit.
    """
    if near_span >= GAP:
        raise ValueError(f"near_span must stay below {GAP}")
    wins = windows.groupBy("win").agg(F.first("terms").alias("terms"))
    parts = wins.select("win", F.posexplode("terms").alias("offset", "term"))
    lists = index.filter("term IS NOT NULL")
    terms = parts.select("term").distinct()
    frequency = (
        lists.select("term", "n").join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    )
    # A window with a word that the corpus lacks occurs nowhere as a phrase.
    ranked = (
        parts.join(frequency, "term")
        .groupBy("win")
        .agg(F.sort_array(F.collect_list(F.struct("df", "offset", "term"))).alias("ranked"))
    )
    queries = wins.join(ranked, "win").filter(F.size("ranked") == F.size("terms")).select("win", "ranked")
    asked = (
        lists.select("segment", "term")
        .join(queries.select("win", "ranked", F.col("ranked")[0]["term"].alias("term")), "term")
        .select(F.col("segment").alias("asked_segment"), "win", "ranked")
    )
    # Only lists of window words travel, and each segment's meet the windows that may occur there.
    needed = lists.join(terms, "term", "left_semi").select("segment", "term", "deltas", "ids", "n_words")
    directory = index.filter("term IS NULL").select("segment", "term", "deltas", "ids", "n_words")
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = (
        f"segment long, place int, id {kind}, n_words long, n_hit long, n_near long, wins array<binary>, "
        "spans array<struct<start:int,end:int>>"
    )
    matched = (
        asked.groupBy("asked_segment")
        .cogroup(needed.unionByName(directory).groupBy("segment"))
        .applyInArrow(_matcher(near_words if near else 0, near_span), schema)
    )
    matched = written(matched, "matches")
    found = (
        matched.filter("n_hit > 0")
        .select("segment", "place", F.explode("wins").alias("win"))
        .join(windows.select("win", "item").distinct(), "win")
        .groupBy("segment", "place")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return matched.join(found, ["segment", "place"], "left").select(
        "id", "n_words", "n_hit", "n_near", F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans"
    )


def _matcher(near_words: int, near_span: int):
    def match(asked: pa.Table, lists: pa.Table) -> pa.Table:
        terms = lists["term"].to_pylist()
        top = terms.index(None)
        n_words = np.array(lists["n_words"][top].values, np.int64)
        ids = lists["ids"][top].values
        bounds = _bounds(n_words)
        at = {t: i for i, t in enumerate(terms)}
        # All lists of the segment are unpacked together; a list's values end where its bytes do.
        held_bytes = lists["deltas"].combine_chunks()
        cuts = np.frombuffer(held_bytes.buffers()[1], np.int32)[held_bytes.offset : held_bytes.offset + len(held_bytes) + 1]
        data = np.frombuffer(held_bytes.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
        values = unpacked(data)
        borders = np.append(0, np.cumsum(data < 128))[cuts - cuts[0]]
        decoded: dict[bytes, np.ndarray] = {}

        def places(term: bytes) -> np.ndarray:
            if term not in decoded:
                i = at.get(term)
                decoded[term] = (
                    np.zeros(0, np.int64)
                    if i is None
                    else np.cumsum(values[borders[i] : borders[i + 1]])
                )
            return decoded[term]

        hits, owners, n_near = [], [], np.zeros(len(n_words), np.int64)
        wins = asked["win"].to_pylist() if asked.num_rows else []
        ranked = asked["ranked"].to_pylist() if asked.num_rows else []
        for number, by_corpus in enumerate(ranked):
            query = sorted(by_corpus, key=lambda x: len(places(x["term"])))
            start = places(query[0]["term"]) - query[0]["offset"]
            for x in query[1:]:
                if not len(start):
                    break
                there, want = places(x["term"]), start + x["offset"]
                if not len(there):
                    start = start[:0]
                    break
                start = start[there[np.minimum(np.searchsorted(there, want), len(there) - 1)] == want]
            if len(start):
                hits.append((start[:, None] + np.arange(len(query))).ravel())
                owners.append((np.unique(_owner(bounds, start)), number))
            distinct = list(dict.fromkeys(x["term"] for x in by_corpus))[:near_words]
            spot = places(distinct[0]) if distinct else np.zeros(0, np.int64)
            for term in distinct[1:]:
                if not len(spot):
                    break
                there = places(term)
                i = np.searchsorted(there, spot - near_span)
                close = np.zeros(len(spot), bool)
                ok = i < len(there)
                close[ok] = there[i[ok]] <= spot[ok] + near_span
                spot = spot[close]
            if len(spot):
                n_near[np.unique(_owner(bounds, spot))] += 1

        n_hit = np.zeros(len(n_words), np.int64)
        held: list[list[bytes]] = [[] for _ in n_words]
        spans: list[list[dict]] = [[] for _ in n_words]
        if hits:
            covered = np.unique(np.concatenate(hits))
            owner = _owner(bounds, covered)
            n_hit = np.bincount(owner, minlength=len(n_words))
            for docs, number in owners:
                for d in docs:
                    held[d].append(wins[number])
            breaks = np.flatnonzero(np.diff(covered) > 1)
            for a, b in zip(np.append(0, breaks + 1), np.append(breaks, len(covered) - 1), strict=True):
                d = owner[a]
                spans[d].append({"start": int(covered[a] - bounds[d]), "end": int(covered[b] - bounds[d] + 1)})
        n = len(n_words)
        segment = lists["segment"][0].as_py()
        return pa.table(
            {
                "segment": pa.array(np.full(n, segment, np.int64)),
                "place": pa.array(np.arange(n, dtype=np.int32)),
                "id": ids,
                "n_words": pa.array(n_words),
                "n_hit": pa.array(n_hit.astype(np.int64)),
                "n_near": pa.array(n_near),
                "wins": pa.array(held, pa.list_(pa.binary())),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            }
        )

    return match


def _owner(bounds: np.ndarray, places: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, places, side="right") - 1
