"""Exact top-k of a block of queries against a block of index rows, in numpy.

These run inside Spark tasks. A block is what one Arrow batch or one co-group
holds; the caller bounds its size. Scores of a pair depend on the pair alone, so
ties are the same in every task and are broken by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

# Rows of one scoring step; a step's score block has at most _CELLS cells.
_QUERY_ROWS = 256
_INDEX_ROWS = 1024
_CELLS = 1 << 19
# Term pairs of a sparse step that are expanded at once.
_PAIRS = 1 << 20
# Terms held by one query in _COMMON_SHARE are common; at most _COMMON_TERMS of them.
_COMMON_SHARE = 32
_COMMON_TERMS = 256
# How far a matrix product may differ from the fixed-order sum.
_SLACK = 1e-9
# Queries that meet a block laid out by term at once; their scores are looked through in runs of columns.
_BATCH_ROWS = 256
_RUN = 256
# A term goes through the matrix product where that is less work: in postings that are added, what a call, a cell of the product and a
# column of the matrix take; at most _BATCH_TERMS of them.
_BATCH_TERMS = 512
_CALL, _CELL, _COLUMN = 400, 0.0047, 0.1
# Postings that are worth a call of their own.
_LONG = 256
# Terms below it are looked up in a table.
_DIRECT = 1 << 22
_MIX = tuple(np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _numpy(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _ids(column: pa.Array) -> np.ndarray:
    values = _numpy(column)
    return values if values.dtype.kind in "iu" else values.astype(str)


@dataclass
class DenseBlock:
    ids: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray

    @classmethod
    def read(cls, ids: pa.Array, payload: list[pa.Array]) -> DenseBlock:
        lists = payload[0]
        n = len(lists)
        lengths = _numpy(lists.value_lengths())
        if n and (odd := np.flatnonzero(lengths != lengths[0])).size:
            at = int(odd[0])
            raise ValueError(
                f"vectors differ in length: {lengths[0]} for {ids[0].as_py()!r}, {lengths[at]} for {ids[at].as_py()!r}"
            )
        flat = _numpy(lists.flatten()).astype(np.float64)
        vectors = flat.reshape(n, -1) if n else np.zeros((0, 0))
        # A vector with NaN, NULL or infinite values has no direction: it is scored as a zero vector.
        vectors[~np.isfinite(vectors).all(axis=1)] = 0
        squares = np.zeros(n)
        for d in range(vectors.shape[1]):
            squares += vectors[:, d] * vectors[:, d]
        return cls(_ids(ids), vectors, np.sqrt(squares))

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, start: int, stop: int) -> DenseBlock:
        return DenseBlock(self.ids[start:stop], self.vectors[start:stop], self.norms[start:stop])


@dataclass
class SparseBlock:
    """Integer term weights in compressed rows; ``norms`` holds squared lengths or ones."""

    ids: np.ndarray
    offsets: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    norms: np.ndarray

    @classmethod
    def read(cls, ids: pa.Array, payload: list[pa.Array]) -> SparseBlock:
        lists, norms = payload
        items = lists.flatten()
        return cls(
            _ids(ids),
            np.concatenate(([0], np.cumsum(_numpy(lists.value_lengths())))).astype(np.int64),
            _numpy(items.field(0)),
            _numpy(items.field(1)).astype(np.float64),
            _numpy(norms).astype(np.float64),
        )

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, start: int, stop: int) -> SparseBlock:
        a, b = self.offsets[start], self.offsets[min(stop, len(self))]
        return SparseBlock(
            self.ids[start:stop],
            self.offsets[start : stop + 1] - a,
            self.terms[a:b],
            self.weights[a:b],
            self.norms[start:stop],
        )


def _inverse(norms: np.ndarray) -> np.ndarray:
    return np.divide(1.0, norms, out=np.zeros(len(norms)), where=norms > 0)


@dataclass
class DenseQueries:
    """Cosine, or ``1 / (1 + d²)`` of the Euclidean distance d with ``metric="l2"``."""

    block: DenseBlock
    metric: str = "cosine"

    def __call__(self, index: DenseBlock):
        """The matrix product finds candidates; a fixed-order sum then scores them exactly."""
        own, other = self.block.vectors.shape[1], index.vectors.shape[1]
        if len(index) and len(self.block) and own != other:
            raise ValueError(
                f"vectors differ in length: {own} for query {self.block.ids[0]!r}, {other} for row {index.ids[0]!r}"
            )
        return self._euclidean(index) if self.metric == "l2" else self._cosine(index)

    def _cosine(self, index: DenseBlock):
        q = self.block

        def exact(qi, di):
            dot = np.zeros(len(qi))
            for d in range(q.vectors.shape[1]):
                dot += q.vectors[qi, d] * index.vectors[di, d]
            norm = q.norms[qi] * index.norms[di]
            return np.divide(dot, norm, out=np.full(len(qi), -np.inf), where=norm > 0)

        near = (q.vectors * _inverse(q.norms)[:, None]) @ (index.vectors * _inverse(index.norms)[:, None]).T
        near[:, index.norms == 0] = -np.inf
        near[q.norms == 0, :] = -np.inf
        return near, _SLACK, exact

    def _euclidean(self, index: DenseBlock):
        q = self.block
        squares = np.square(q.norms)[:, None] + np.square(index.norms)[None, :]
        near = 1.0 / (1.0 + np.maximum(squares - 2.0 * (q.vectors @ index.vectors.T), 0.0))

        def exact(qi, di):
            distance = np.zeros(len(qi))
            for d in range(q.vectors.shape[1]):
                distance += np.square(q.vectors[qi, d] - index.vectors[di, d])
            return 1.0 / (1.0 + distance)

        return near, _SLACK * (1.0 + squares.max(initial=0.0)), exact


@dataclass
class SparseQueries:
    """Integer dot product over shared terms, divided by both norms.

    Query terms are kept as postings: per term the queries that hold it. Memory
    grows with the postings and with the score block, not with the vocabulary.
    The few terms that many queries hold would expand to almost every pair; they
    go through a matrix product. Integer sums are exact in either way.
    """

    block: SparseBlock
    vocabulary: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        b = self.block
        order = np.argsort(b.terms, kind="stable")
        self.query = np.repeat(np.arange(len(b)), np.diff(b.offsets))[order]
        self.weight = b.weights[order]
        self.vocabulary, self.first, self.held = np.unique(b.terms[order], return_index=True, return_counts=True)
        common = np.argsort(-self.held, kind="stable")[:_COMMON_TERMS]
        common = common[self.held[common] * _COMMON_SHARE >= max(len(b), _COMMON_SHARE)]
        self.column = np.full(len(self.vocabulary), -1)
        self.column[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), len(b)))
        for n, term in enumerate(common):
            part = slice(self.first[term], self.first[term] + self.held[term])
            self.matrix[n, self.query[part]] = self.weight[part]

    def __call__(self, index: SparseBlock):
        dot = self._dots(index)
        q_norm, d_norm = np.sqrt(self.block.norms), np.sqrt(index.norms)
        near = dot * _inverse(d_norm)[None, :]
        near *= _inverse(q_norm)[:, None]
        return near, _SLACK, lambda qi, di: dot[qi, di] / (q_norm[qi] * d_norm[di])

    def _dots(self, index: SparseBlock) -> np.ndarray:
        n, width = len(self.block), len(index)
        dot = np.zeros(n * width)
        if not len(self.vocabulary):
            return dot.reshape(n, width)
        at = np.minimum(np.searchsorted(self.vocabulary, index.terms), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == index.terms
        row = np.repeat(np.arange(width), np.diff(index.offsets))[hit]
        term, weight = at[hit], index.weights[hit]
        column = self.column[term]
        common = column >= 0
        if common.any():
            held_by = np.zeros((width, len(self.matrix)))
            held_by[row[common], column[common]] = weight[common]
            dot += (self.matrix.T @ held_by.T).ravel()
            row, term, weight = row[~common], term[~common], weight[~common]
        held = self.held[term]
        reach = np.concatenate(([0], np.cumsum(held)))
        start = 0
        while start < len(term):
            stop = max(start + 1, int(np.searchsorted(reach, reach[start] + _PAIRS, side="right")) - 1)
            times = held[start:stop]
            place = np.arange(reach[stop] - reach[start]) + np.repeat(
                self.first[term[start:stop]] - (reach[start:stop] - reach[start]), times
            )
            cell = self.query[place] * width + np.repeat(row[start:stop], times)
            dot += np.bincount(cell, self.weight[place] * np.repeat(weight[start:stop], times), n * width)
            start = stop
        return dot.reshape(n, width)


def _rank_keys(ids: np.ndarray) -> np.ndarray:
    return ids if ids.dtype.kind in "iu" else np.unique(ids, return_inverse=True)[1]


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    """The first k of each query by score descending, id ascending."""
    order = np.lexsort((_rank_keys(ids), -score, query))
    query, score, ids = query[order], score[order], ids[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, int)
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    keep = place < k
    return query[keep], score[keep], ids[keep]


class TopK:
    """Running top-k of a set of queries; holds at most k rows per query."""

    def __init__(self, kind: str, queries, k: int, keep_zero: bool, metric: str = "cosine") -> None:
        self.k, self.keep_zero, self.query_ids = k, keep_zero, queries.ids
        step = _QUERY_ROWS if kind == "dense" else max(1, len(queries))
        self.rows = min(_INDEX_ROWS, max(1, _CELLS // step))
        # Per part: first query, scorer, best rows so far; score and id of the k-th, whether there is one.
        self.parts = []
        for start in range(0, len(queries), step):
            block = queries.part(start, start + step)
            scorer = DenseQueries(block, metric) if kind == "dense" else SparseQueries(block)
            self.parts.append([start, scorer, None, np.full(len(block), -np.inf), None, None])

    def add(self, index) -> None:
        for start in range(0, len(index), self.rows):
            block = index.part(start, start + self.rows)
            for part in self.parts:
                self._add(part, block)

    def _least(self, floor: np.ndarray, slack: float) -> np.ndarray:
        """The score a row needs: of the k-th row so far, above zero where zero is no hit."""
        least = floor - slack
        return (least if self.keep_zero else np.maximum(least, np.finfo(float).tiny))[:, None]

    def _add(self, part, block) -> None:
        _, scorer, best, floor, _, _ = part
        near, slack, exact = scorer(block)
        wanted = near >= self._least(floor, slack)
        # Once the floors are up few rows pass them; before that the block's own k-th score helps.
        if len(block) > self.k and np.count_nonzero(wanted) > 4 * self.k * len(floor):
            floor = np.maximum(floor, np.partition(near, len(block) - self.k, axis=1)[:, -self.k])
            wanted = near >= self._least(floor, slack)
        qi, di = np.nonzero(wanted)
        if not len(qi):
            return
        query, score, ids = qi, exact(qi, di), block.ids[di]
        if best is not None:
            # A row that only ties with the k-th is wanted for a smaller id: copies are cut here.
            last = part[4][query]
            keep = (score > part[3][query]) | ((score == part[3][query]) & (ids < last)) | ~part[5][query]
            query, score, ids = query[keep], score[keep], ids[keep]
            query = np.concatenate((best[0], query))
            score = np.concatenate((best[1], score))
            ids = np.concatenate((best[2], ids))
        query, score, ids = part[2] = _best(query, score, ids, self.k)
        ends = np.flatnonzero(np.r_[query[1:] != query[:-1], True])
        full = np.bincount(query, minlength=len(floor)) >= self.k
        part[3] = np.full(len(floor), -np.inf)
        part[3][query[ends]] = score[ends]
        part[3][~full] = -np.inf
        part[4] = np.zeros(len(floor), ids.dtype)
        part[4][query[ends]] = ids[ends]
        part[5] = full

    def emit(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for start, _, best, *_ in self.parts:
            if best is None or not len(best[0]):
                continue
            query, score, ids = best
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(self.query_ids[query + start]).cast(schema.field(0).type),
                    pa.array(ids).cast(schema.field(1).type),
                    pa.array(np.where(np.isneginf(score), 0.0, score), mask=np.isneginf(score)),
                ],
                schema=schema,
            )


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges ``starts .. starts + sizes``, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _pieces(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of at most ``_PAIRS`` in sum, or of one."""
    reach, start = np.append(0, np.cumsum(sizes)), 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(reach, reach[start] + _PAIRS, side="right")) - 1)
        yield slice(start, stop)
        start = stop


def _places(vocabulary: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Places of the terms in a sorted vocabulary, -1 for others; hashed terms are small and looked up directly."""
    if not len(vocabulary) or not len(terms):
        return np.full(len(terms), -1)
    if min(vocabulary[0], terms.min()) >= 0 and (high := max(vocabulary[-1], terms.max())) < _DIRECT:
        table = np.full(high + 1, -1, np.int32)
        table[vocabulary] = np.arange(len(vocabulary))
        return table[terms]
    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
    return np.where(vocabulary[at] == terms, at, -1)


def _by_place(places: np.ndarray) -> np.ndarray:
    """A stable order of places below 2^32, sorted by half after half."""
    order = np.argsort((places & 0xFFFF).astype(np.uint16), kind="stable")
    high = (places >> 16).astype(np.uint16)
    return order[np.argsort(high[order], kind="stable")] if high.any() else order


def first_copies(block: SparseBlock, k: int) -> np.ndarray:
    """Places of the rows of which fewer than ``k`` equal ones stand before: no other can be among a query's first ``k``.

    Rows stand by rising id. Equal checksums are compared entry by entry.
    """
    n, sizes = len(block), np.diff(block.offsets)
    mixed = block.weights.astype(np.int64).view(np.uint64) * _MIX[1]
    mixed += block.terms.astype(np.uint64) * _MIX[0]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX[2]
    total = np.append(np.uint64(0), np.cumsum(mixed, out=mixed))
    del mixed
    mark = total[block.offsets[1:]] - total[block.offsets[:-1]]
    order = np.argsort(mark, kind="stable")
    heads = np.flatnonzero(np.r_[True, mark[order][1:] != mark[order][:-1]][:n])
    group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
    place = np.arange(n) - heads[group]
    if place.max(initial=0) < k:
        return np.arange(n)
    row, head = order, order[heads][group]
    equal = (sizes[row] == sizes[head]) & (block.norms[row] == block.norms[head])
    rows, like = row[equal], head[equal]
    same = np.ones(len(rows), bool)
    for part in _pieces(sizes[rows]):
        size = sizes[rows[part]]
        own, other = _expand(block.offsets[rows[part]], size), _expand(block.offsets[like[part]], size)
        differ = (block.terms[own] != block.terms[other]) | (block.weights[own] != block.weights[other])
        so_far = np.append(0, np.cumsum(differ))
        ends = np.cumsum(size)
        same[part] = so_far[ends] == so_far[ends - size]
    equal[equal] = same
    whole = np.bincount(group[~equal], minlength=len(heads)) == 0
    return np.sort(order[(place < k) | ~whole[group]])


class TermIndex:
    """Rows of an index block laid out by term, for the top-k of many queries; the rows stand by rising id.

    Sums over shared terms in single precision, of unit vectors, find the rows that can be among a query's first k: terms
    that reach many pairs of a batch of queries go through a matrix product, of the others only postings are read. What can be among
    the first k is then scored exactly, as ``SparseQueries`` does. Queries whose commonest term is the same come one after the other, so that
    a batch has few terms. Memory grows with the index block, about 50 bytes per term, and with ``_BATCH_ROWS`` rows of scores and of
    the matrix; of the queries nothing is laid out but a batch.
    """

    def __init__(self, block: SparseBlock, queries: SparseBlock, k: int) -> None:
        self.k, self.queries, self.n = k, queries, len(block)
        n, self.norm, self.width = self.n, np.sqrt(block.norms), -(-len(block) // _RUN) * _RUN
        ends = [(x.terms.min(), x.terms.max()) for x in (block, queries) if len(x.terms)]
        self.vocabulary, self.terms = None, max((int(high) for _, high in ends), default=-1) + 1
        if self.terms > _DIRECT or any(low < 0 for low, _ in ends):
            self.vocabulary = np.unique(queries.terms)
            self.terms = len(self.vocabulary)
        self.query_norm = np.sqrt(queries.norms)
        self.signed = bool((block.weights < 0).any() or (queries.weights < 0).any())
        # Terms that no query asks for are left out.
        asked = np.zeros(self.terms + 1, bool)
        for start in range(0, len(queries.terms), _PAIRS):
            asked[self._place(queries.terms[start : start + _PAIRS])] = True
        asked[-1] = False
        at = self._place(block.terms)
        hit = asked[at]
        self.bounds = np.append(0, np.cumsum(hit))[block.offsets]
        self.term, self.weight = at[hit], block.weights[hit]
        row = np.repeat(np.arange(n), np.diff(block.offsets))[hit]
        del at, hit
        unit = (self.weight * _inverse(self.norm)[row]).astype(np.float32)
        unit /= np.sqrt(np.bincount(row, np.square(unit), n).max(initial=0)) or 1.0
        self.held = np.bincount(self.term, minlength=self.terms + 1)
        self.first = np.cumsum(self.held) - self.held
        order = _by_place(self.term)
        self.rows, self.units = row[order], unit[order]

    def _place(self, terms: np.ndarray) -> np.ndarray:
        """Places of the terms below ``self.terms``, which stands for the others."""
        if self.vocabulary is None:
            return terms.astype(np.int32, copy=False)
        at = _places(self.vocabulary, terms)
        return np.where(at < 0, self.terms, at).astype(np.int32)

    def __iter__(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``(query, score, row)`` of each query's first k, by query."""
        if not len(self.term):
            return
        scores = np.empty((min(_BATCH_ROWS, len(self.queries)), self.width), np.float32)
        order, found = self._alike(), []
        for start in range(0, len(order), _BATCH_ROWS):
            batch = order[start : start + _BATCH_ROWS]
            sizes = self.queries.offsets[batch + 1] - self.queries.offsets[batch]
            entries = _expand(self.queries.offsets[batch], sizes)
            owner = np.repeat(np.arange(len(batch)), sizes)
            own, local = np.unique(self._place(self.queries.terms[entries]), return_inverse=True)
            weights = self.queries.weights[entries].astype(np.float64)
            length = np.sqrt(np.bincount(owner, weights * weights, len(batch)))
            near = scores[: len(batch)]
            self._sums(owner, own, local, (weights * _inverse(length)[owner]).astype(np.float32), near)
            query, row = self._reaching(near, (sizes.max(initial=0) + 8) * 2.0**-23)
            dot = self._dots(owner, own, local, weights, query, row, len(batch))
            norm = self.query_norm[batch]
            kept = (dot > 0) & (self.norm[row] > 0) & (norm[query] > 0)
            query, row, dot = query[kept], row[kept], dot[kept]
            query, score, row = _best(query, dot / (norm[query] * self.norm[row]), row, self.k)
            found.append((batch[query], score, row))
        query, score, row = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(query, kind="stable")
        yield query[order], score[order], row[order]

    def _alike(self) -> np.ndarray:
        """The queries, those one after the other whose commonest term is the same."""
        queries, common = self.queries, np.full(len(self.queries), -1)
        for start in range(0, len(queries), 1 << 12):
            offsets = queries.offsets[start : start + (1 << 12) + 1]
            some = np.flatnonzero(np.diff(offsets))
            if len(some):
                place = self._place(queries.terms[offsets[0] : offsets[-1]])
                common[start + some] = np.maximum.reduceat(self.held[place] * (self.terms + 1) + place, offsets[some] - offsets[0])
        return np.argsort(common, kind="stable")

    def _sums(self, query: np.ndarray, own: np.ndarray, local: np.ndarray, unit: np.ndarray, near: np.ndarray) -> None:
        """Sums over the entries of a batch: of ``query``, the term ``own[local]``, with the weight ``unit``."""
        held, times = self.held[own], np.bincount(local, minlength=len(own))
        held = np.where(own < self.terms, held, 0)
        apart = times * np.where(held >= _LONG, _CALL + held, held * 2.0)
        whole = near.size * _CELL + held * 0.5 + self.width * _COLUMN
        dense = np.flatnonzero(apart > whole)
        if len(dense) > _BATCH_TERMS:
            dense = dense[np.argsort(whole[dense] - apart[dense], kind="stable")[:_BATCH_TERMS]]
        column = np.full(len(own), -1)
        column[dense] = np.arange(len(dense))
        matrix = np.zeros((len(dense), self.width), np.float32)
        place = _expand(self.first[own[dense]], held[dense])
        matrix.reshape(-1)[np.repeat(np.arange(len(dense)) * self.width, held[dense]) + self.rows[place]] = self.units[place]
        column = column[local]
        inside = column >= 0
        asked = np.zeros((len(near), len(dense)), np.float32)
        asked[query[inside], column[inside]] = unit[inside]
        np.dot(asked, matrix, out=near)
        first, held = self.first[own][local], held[local]
        for e in np.flatnonzero(~inside & (held >= _LONG)):
            postings = slice(first[e], first[e] + held[e])
            np.add.at(near[query[e]], self.rows[postings], self.units[postings] * unit[e])
        short = np.flatnonzero(~inside & (held < _LONG) & (held > 0))
        flat = near.reshape(-1)
        for part in _pieces(held[short]):
            some = short[part]
            place = _expand(first[some], held[some])
            cell = np.repeat(query[some] * self.width, held[some]) + self.rows[place]
            np.add.at(flat, cell, np.repeat(unit[some], held[some]) * self.units[place])

    def _reaching(self, near: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
        """The cells that can hold one of a query's first k: not below the k-th best run, or k-th row where there are fewer runs."""
        runs = near.reshape(len(near), -1, _RUN)
        best = runs.max(axis=2)
        seen = best if best.shape[1] >= self.k else near
        floor = np.zeros(len(near))
        if seen.shape[1] >= self.k:
            floor = np.partition(seen, seen.shape[1] - self.k, axis=1)[:, -self.k].astype(float)
        least = np.maximum(floor - 2 * slack, -slack if self.signed else np.finfo(float).tiny)
        query, run = np.nonzero(best >= least[:, None])
        cell, column = np.nonzero(runs[query, run] >= least[query][:, None])
        query, row = query[cell], run[cell] * _RUN + column
        real = row < self.n
        return query[real], row[real]

    def _dots(self, owner: np.ndarray, own: np.ndarray, local: np.ndarray, weights: np.ndarray, query: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Exact integer products of queries of the batch and rows."""
        # One column more, of zeros, for the terms that no query of the batch holds.
        weight = np.zeros((n, len(own) + 1))
        weight[owner, local] = weights
        place = np.full(self.terms + 1, len(own), np.int32)
        place[own] = np.arange(len(own))
        dot, sizes = np.zeros(len(query)), self.bounds[row + 1] - self.bounds[row]
        for part in _pieces(sizes):
            at = _expand(self.bounds[row[part]], sizes[part])
            product = weight[np.repeat(query[part], sizes[part]), place[self.term[at]]] * self.weight[at]
            known = np.flatnonzero(sizes[part])
            if len(known):
                dot[part.start + known] = np.add.reduceat(product, (np.cumsum(sizes[part]) - sizes[part])[known])
        return dot
