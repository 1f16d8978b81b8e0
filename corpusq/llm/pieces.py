"""SentencePiece encoding and decoding by batched Viterbi in numpy.

Different words of a batch are encoded once each. Words of equal length advance together,
character by character: the hashes of all their substrings that end at the place
are looked up among the sorted hashes of the pieces, and an array-wide maximum keeps the best
piece as backpointer.

A ``unigram`` model takes the segmentation with the greatest sum of scores. A ``bpe`` model takes the one
that merging by score gives; there a step is open only to a piece that merging would
leave beside the piece before it, which is decided by undoing the two pieces' merges, later ones
first. Of such segmentations there is one, so the maximum finds it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow

SPACE = "▁"
CHUNK_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [pow(int(_BASE), k, 1 << 64) for k in range(1025)]
_BITS = 21
_NONE = np.int64(1) << 60
#: A word of over ``LONG_WORD`` characters is cut into blocks, each read ``LONG_WARM`` characters early.
LONG_WORD = 640
LONG_BLOCK = 512
LONG_WARM = 128


@dataclass
class PieceModel:
    """A vocabulary as sorted arrays; small enough to travel with a task (a few MB for 32,000 pieces)."""

    kind: str
    pieces: list[str]
    scores: np.ndarray
    unknown: int
    bytes_: dict[int, int]  # byte -> id
    keys: np.ndarray  # sorted hashes of the normal pieces
    ids: np.ndarray  # their ids
    longest: int
    rank: np.ndarray  # place in the order of merges, -1 for single characters
    left: np.ndarray  # the two pieces of the last merge
    right: np.ndarray
    pair_keys: np.ndarray  # sorted left * size + right
    pair_ranks: np.ndarray
    dummy_prefix: bool = True
    filters: tuple[np.ndarray, np.ndarray] | None = None  # which slots hold a piece, a pair; made where it is used

    def __getstate__(self) -> dict:
        return self.__dict__ | {"filters": None}

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        if self.filters is None:
            self.filters = _filter(self.keys), _filter(self.pair_keys)
        return self.filters


def load_model(path: str, kind: str) -> PieceModel:
    """Read a model file on the driver. ``kind`` is ``unigram`` or ``bpe``, as the model was trained."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.piece_size()
    names = [sp.id_to_piece(i) for i in range(size)]
    normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    of_bytes = {int(names[i][1:-1], 16): i for i in range(size) if sp.is_byte(i)}
    prefix = sp.encode("a", out_type=str)[0].startswith(SPACE)
    return build_model(names, [sp.get_score(i) for i in range(size)], normal, sp.unk_id(), of_bytes, kind, prefix)


def build_model(
    names: list[str],
    scores: list[float],
    normal: list[int],
    unknown: int,
    of_bytes: dict[int, int],
    kind: str,
    dummy_prefix: bool = True,
) -> PieceModel:
    if kind not in ("unigram", "bpe"):
        raise ValueError(f"unknown kind of model: {kind!r}")
    if any(SPACE in names[i].lstrip(SPACE) for i in normal):
        raise ValueError("pieces across word borders are not supported")
    by_name = {names[i]: i for i in normal}
    order = np.array(scores, np.float64)
    rank = np.full(len(names), -1, np.int64)
    left, right = np.full(len(names), -1, np.int64), np.full(len(names), -1, np.int64)
    pairs: dict[int, int] = {}
    if kind == "bpe":
        long = [i for i in normal if len(names[i]) > 1]
        places = {s: r for r, s in enumerate(sorted({scores[i] for i in long}, reverse=True))}
        for i in long:
            rank[i] = places[scores[i]]
        for i in long:
            parts = merged(names[i], by_name, order, record=True)
            if parts is not None:
                left[i], right[i] = parts
            for cut in range(1, len(names[i])):
                a, b = by_name.get(names[i][:cut]), by_name.get(names[i][cut:])
                if a is not None and b is not None:
                    pairs[a * len(names) + b] = rank[i]
        # A piece that merging never makes cannot occur.
        normal = [i for i in normal if len(names[i]) == 1 or left[i] >= 0]
    lengths = [len(names[i]) for i in normal]
    keys = np.array([_hash_word(names[i]) for i in normal], np.uint64)
    order_of = np.argsort(keys)
    if len(np.unique(keys)) < len(keys):
        raise ValueError("two pieces share a hash")
    pair_keys = np.array(sorted(pairs), np.int64)
    return PieceModel(
        kind, names, order, unknown, of_bytes, keys[order_of], np.array(normal, np.int64)[order_of],
        max(lengths, default=1), rank, left, right, pair_keys,
        np.array([pairs[k] for k in pair_keys.tolist()], np.int64), dummy_prefix,
    )


def merged(word: str, by_name: dict[str, int], scores: np.ndarray, record: bool = False):
    """Pieces of ``word`` by merging the best-scored neighbours, leftmost first.

    With ``record`` the two parts of the last merge if the whole word becomes one piece, else None.
    """
    parts = list(word)
    after = list(range(1, len(parts))) + [-1]
    before = list(range(-1, len(parts) - 1))
    heap: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else -1
        if i >= 0 and j >= 0 and (k := by_name.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (-scores[k], i, j, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    last = None
    while heap:
        _, i, j, whole = heapq.heappop(heap)
        if after[i] != j or parts[i] + parts[j] != whole or not parts[i]:
            continue
        last = by_name.get(parts[i]), by_name.get(parts[j])
        parts[i], parts[j] = whole, ""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        after[j] = -2
        offer(before[i])
        offer(i)
    out = [p for p in parts if p]
    if not record:
        return out
    return last if len(out) == 1 and last is not None and None not in last else None


def _hash_word(word: str) -> int:
    h = 0
    for c in word:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _slots(keys: np.ndarray) -> np.ndarray:
    """Upper bits of a mixed key: most probes miss, and a miss then costs one read of a small table."""
    return (keys.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _BITS)


def _filter(keys: np.ndarray) -> np.ndarray:
    there = np.zeros(1 << _BITS, bool)
    there[_slots(keys)] = True
    return there


def _probe(sorted_keys: np.ndarray, values: np.ndarray, there: np.ndarray, keys: np.ndarray, missing: int) -> np.ndarray:
    out = np.full(len(keys), missing, np.int64)
    some = np.flatnonzero(there[_slots(keys)])
    if len(some) and len(sorted_keys):
        asked = keys[some]
        at = np.minimum(np.searchsorted(sorted_keys, asked), len(sorted_keys) - 1)
        hit = sorted_keys[at] == asked
        out[some[hit]] = values[at[hit]]
    return out


def _lookup(model: PieceModel, hashes: np.ndarray) -> np.ndarray:
    return _probe(model.keys, model.ids, model.slots()[0], hashes, -1)


def _pair_rank(model: PieceModel, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    key = np.where((a >= 0) & (b >= 0), a * len(model.pieces) + b, -1)
    return _probe(model.pair_keys, model.pair_ranks, model.slots()[1], key, int(_NONE))


def compatible(model: PieceModel, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether merging leaves ``a`` and ``b`` side by side. Ids below 0 are characters without a piece.

    The later of the two last merges is undone; if the facing parts would have been merged
    before it, the border cannot have lasted. Of equal merges the left one came first.
    """
    ok = np.ones(len(a), bool)
    live = np.arange(len(a))
    a, b = a.copy(), b.copy()
    limit = np.full(len(a), _NONE)
    while len(live):
        clash = _pair_rank(model, a, b) < limit
        ok[live[clash]] = False
        ra = np.where(a >= 0, model.rank[np.maximum(a, 0)], -1)
        rb = np.where(b >= 0, model.rank[np.maximum(b, 0)], -1)
        go = ~clash & ((ra >= 0) | (rb >= 0))
        live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
        undo_a = ra > rb
        limit = np.where(undo_a, ra, rb + 1)
        a, b = np.where(undo_a, model.right[np.maximum(a, 0)], a), np.where(undo_a, b, model.left[np.maximum(b, 0)])
    return ok


def encode_words(model: PieceModel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and their number per word. A character without a piece gives its bytes, or the unknown id."""
    sizes = np.zeros(len(words), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # numbers of words, their sizes, their ids
    by_length: dict[int, list[int]] = {}
    long: list[int] = []
    for i, w in enumerate(words):
        if model.kind == "bpe" and w.startswith(SPACE * 2):
            ids = _spaces_first(model, w)  # pieces of spaces alone share one score
            parts.append((np.array([i]), np.array([len(ids)]), ids))
        elif model.kind == "bpe" and len(w) > LONG_WORD:
            long.append(i)
        elif w:
            by_length.setdefault(len(w), []).append(i)
    for length, numbers in by_length.items():
        step = max(1, 2_000_000 // length)
        for k in range(0, len(numbers), step):
            some = numbers[k : k + step]
            text = "".join([words[i] for i in some])
            parts.append((np.array(some), *_viterbi(model, _codes(text).reshape(len(some), length))))
    if long:
        parts.append((np.array(long), *_encode_long(model, [words[i] for i in long])))
    for numbers, counts, _ in parts:
        sizes[numbers] = counts
    flat = np.empty(sizes.sum(), np.int64)
    heads = np.cumsum(sizes) - sizes
    for numbers, counts, ids in parts:
        ends = np.cumsum(counts)
        flat[np.arange(len(ids)) + np.repeat(heads[numbers] - (ends - counts), counts)] = ids
    return flat, sizes


def _spaces_first(model: PieceModel, word: str) -> np.ndarray:
    by_name = {model.pieces[i]: i for i in model.ids.tolist()}
    ids: list[int] = []
    for part in merged(word, by_name, model.scores):
        ids += [by_name[part]] if part in by_name else _fallback(model, ord(part))
    return np.array(ids, np.int64)


def _fallback(model: PieceModel, code: int) -> list[int]:
    if len(model.bytes_) == 256:
        return [model.bytes_[b] for b in chr(code).encode("utf-8", "replace")]
    return [model.unknown]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def _forward(
    model: PieceModel, chars: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The piece that ends at each place of each word and its size, ``-1 - code`` for a bare character.

    The first places may be ``known``, for a word that goes on; as many as the longest piece has characters.
    """
    n, length = chars.shape
    worst = model.scores.min() - 10 if len(model.scores) else -10.0
    best = np.full((length + 1, n), -np.inf)
    best[0] = 0
    piece = np.full((length + 1, n), -1, np.int64)
    size = np.zeros((length + 1, n), np.int16)
    prefix = np.zeros((length + 1, n), np.uint64)
    for i in range(length):
        prefix[i + 1] = prefix[i] * _BASE + (chars[:, i] + 1).astype(np.uint64)
    done = 0
    if known is not None:
        done = len(known[0])
        piece[1 : done + 1, 0], size[1 : done + 1, 0] = known
        best[1 : done + 1] = np.where(size[1 : done + 1] > 0, 0, -np.inf)
    for end in range(done + 1, length + 1):
        for m in range(min(end, model.longest), 0, -1):
            start = end - m
            open_ = np.flatnonzero(np.isfinite(best[start]) & ((size[end] == 0) | (model.kind == "unigram")))
            if not len(open_):
                continue
            found = _lookup(model, prefix[end, open_] - prefix[start, open_] * np.uint64(_POWERS[m]))
            if m == 1:
                found = np.where(found >= 0, found, -1 - chars[open_, end - 1])
            else:
                open_, found = open_[found >= 0], found[found >= 0]
            if model.kind == "bpe":
                if start:
                    fits = compatible(model, piece[start, open_], found)
                    open_, found = open_[fits], found[fits]
                total = np.zeros(len(open_))
            else:
                total = best[start, open_] + np.where(found >= 0, model.scores[np.maximum(found, 0)], worst)
            better = total > best[end, open_]
            best[end, open_[better]] = total[better]
            piece[end, open_[better]] = found[better]
            size[end, open_[better]] = m
    return piece, size


def _viterbi(model: PieceModel, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids per word and all ids, for words of one length given as rows of code points."""
    n, length = chars.shape
    rows = np.arange(n)
    piece, size = _forward(model, chars)
    steps, at = [], np.full(n, length)
    while at.any():
        live = at > 0
        steps.append(np.where(live, piece[at, rows], _NONE))
        at = np.where(live, at - size[at, rows], 0)
    table = np.stack(steps[::-1], axis=1)
    taken = table != _NONE
    return _with_fallback(model, taken.sum(axis=1), table[taken])


def _encode_long(model: PieceModel, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """As ``_viterbi`` for long words of a ``bpe`` model, whose blocks advance together.

    What ends at a place depends only on what ends at the places one longest piece before it. A block is read from some
    characters before its start; where it then agrees with the block before it on that many places, it
    is what reading the word from its start gives. Where it does not, the block is read again from those places.
    """
    reach = model.longest
    warm = max(LONG_WARM, 2 * reach)
    block = max(LONG_BLOCK, warm)
    codes = [_codes(w) for w in words]
    starts = [(i, max(0, at - warm)) for i, c in enumerate(codes) for at in range(0, len(c), block)]
    tables: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, 2_000_000 // (block + warm))
    for k in range(0, len(starts), step):
        chars = np.zeros((len(starts[k : k + step]), block + warm), np.int64)
        for row, (i, at) in zip(chars, starts[k : k + step], strict=True):
            part = codes[i][at : at + block + warm]
            row[: len(part)] = part
        piece, size = _forward(model, chars)
        tables += zip(piece.T.astype(np.int32), size.T.copy(), strict=True)
    counts, flat, number = [], [], 0
    for c in codes:
        piece, size = np.zeros(len(c) + 1, np.int64), np.zeros(len(c) + 1, np.int64)
        for at in range(0, len(c), block):
            own_piece, own_size = tables[number]
            number += 1
            end = min(at + block, len(c))
            skip = warm if at else 0
            if at:
                before, seen = slice(at - reach + 1, at + 1), slice(warm - reach + 1, warm + 1)
                if (own_piece[seen] != piece[before]).any() or (own_size[seen] != size[before]).any():
                    again = _forward(model, c[None, at - reach : end], (piece[before], size[before]))
                    own_piece, own_size, skip = again[0][:, 0], again[1][:, 0], reach
            piece[at + 1 : end + 1] = own_piece[skip + 1 : skip + 1 + end - at]
            size[at + 1 : end + 1] = own_size[skip + 1 : skip + 1 + end - at]
        taken, sizes, at = [], size.tolist(), len(c)
        while at:
            taken.append(at)
            at -= sizes[at]
        counts.append(len(taken))
        flat.append(piece[taken[::-1]])
    return _with_fallback(model, np.array(counts), np.concatenate(flat))


def _with_fallback(model: PieceModel, counts: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bare characters replaced by their bytes, or the unknown id."""
    bare = np.flatnonzero(flat < 0)
    if len(bare):
        more = [_fallback(model, -1 - c) for c in flat[bare].tolist()]
        extra = np.ones(len(flat), np.int64)
        extra[bare] = [len(x) for x in more]
        counts = np.add.reduceat(extra, np.cumsum(counts) - counts)
        at = np.cumsum(extra) - extra
        flat = np.repeat(flat, extra)
        for k, x in zip(at[bare].tolist(), more, strict=True):
            flat[k : k + len(x)] = x
    return counts, flat


def _words(texts: pa.Array, dummy_prefix: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of all texts, dictionary-coded, and their number per text; a word is spaces and what follows them."""
    texts = texts.fill_null("")
    plain = pc.replace_substring(texts, " ", SPACE)
    if dummy_prefix:
        lead = pc.if_else(pc.equal(texts, ""), "", SPACE)
        plain = pc.binary_join_element_wise(lead, plain, "")
    plain = plain.cast(pa.large_string())
    offsets = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    data = np.frombuffer(plain.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if plain.buffers()[2] else np.zeros(0, np.uint8)
    borders = offsets - offsets[0]
    mark = np.frombuffer(SPACE.encode(), np.uint8)
    begins = np.zeros(len(data), bool)
    if len(data) > 2:
        hit = np.flatnonzero((data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2]))
        space = np.zeros(len(data) + 3, bool)
        space[hit + 3] = True
        begins[hit[~space[hit]]] = True  # a space that follows a space goes on with the same word
    begins[borders[:-1][np.diff(borders) > 0]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts, len(data)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data.copy()))
    return words.dictionary_encode(), np.diff(np.searchsorted(starts, borders))


def encode_texts(model: PieceModel, texts: pa.Array) -> pa.ListArray:
    """Ids of every text as lists; NULL has none."""
    words, n_words = _words(texts, model.dummy_prefix)
    flat, sizes = encode_words(model, words.dictionary.to_pylist())
    heads = np.cumsum(sizes) - sizes
    codes = words.indices.to_numpy()
    counts = sizes[codes]
    ends = np.cumsum(counts)
    take = np.arange(ends[-1] if len(ends) else 0) + np.repeat(heads[codes] - (ends - counts), counts)
    per_text = np.append(0, np.cumsum(n_words))
    borders = np.append(0, ends)[per_text]
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(flat[take].astype(np.int32)))


def decode_lists(model: PieceModel, lists: pa.ListArray) -> pa.Array:
    """Texts of lists of ids: pieces joined, byte pieces as bytes (broken UTF-8 becomes U+FFFD), spaces restored."""
    raw = [name.replace(SPACE, " ").encode() for name in model.pieces]
    raw[model.unknown] = " ⁇ ".encode()
    for byte, i in model.bytes_.items():
        raw[i] = bytes([byte])
    values = pa.array(raw, pa.binary()).take(lists.flatten().cast(pa.int64()))
    joined = pc.binary_join(pa.ListArray.from_arrays(_offsets(lists), values), b"")
    out = []
    for text in joined.to_pylist():
        text = text.decode("utf-8", "replace")
        out.append(text[1:] if model.dummy_prefix and text.startswith(" ") else text)
    return pa.array(out, pa.string())


def _offsets(lists: pa.ListArray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())).astype(np.int32))


def encode(docs: DataFrame, model: PieceModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_tokens, ids, restored)`` per row: the ids, and whether decoding them gives the text again.

    A NULL or empty text has no ids and is restored. Only a text that itself holds U+2581 cannot be restored, since the
    format uses that sign for spaces. Rows that repeat and NULL ids keep their rows; extra columns are not read. Nothing is shuffled.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        texts = table["text"].combine_chunks().fill_null("")
        ids = encode_texts(model, texts)
        return pa.table(
            {
                "id": table["id"],
                "n_tokens": pc.list_value_length(ids).cast(pa.int64()),
                "ids": ids,
                "restored": pc.equal(decode_lists(model, ids), texts),
            }
        )

    return map_arrow(rows, run, f"id {kind}, n_tokens long, ids array<int>, restored boolean", CHUNK_BYTES)


def decode(encoded: DataFrame, model: PieceModel, doc_id: str = "id", ids: str = "ids") -> DataFrame:
    """``(id, text)`` per row of ids; NULL gives the empty text."""
    rows = encoded.select(F.col(doc_id).alias("id"), F.col(ids).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"id": table["id"], "text": decode_lists(model, table["ids"].combine_chunks())})

    return map_arrow(rows, run, f"id {kind}, text string", CHUNK_BYTES)
