"""Text retrieval at batch size: an exact prefix-filter join of questions and documents behind a gate.

Vectors are tf·idf over hashed terms, the score is their cosine. All terms are ordered by document frequency, rare ones first. Where two
texts score above the gate, the rarest term that they share lies in the prefix of both: behind its prefix a text's
weights could not reach the gate even against a text that has nothing else (Cauchy-Schwarz). Blocks of vectors meet block by block; only the postings
of prefixes meet there, the products of the rarest shared terms are summed per pair, pairs whose sum and rests cannot reach the gate go, and each pair
that is left is scored once from both vectors. The weights make the prefixes short: common words carry little of a text's length.

Equal vectors are one class throughout, so copies are joined once and a group of them is never expanded into pairs.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusq.functions import terms as V
from corpusq.operators.blocks import _by_place
from corpusq.operators.joins import lookup_join
from corpusq.sources.materialise import stored

#: idf in thousandths, so that weights are integers and dot products exact.
IDF_UNIT = 1000
#: Vectors of a block, and their terms.
BLOCK_ROWS = 16_384
BLOCK_TERMS = 2 << 20
MAX_BLOCK_TASKS = 20_000
#: Terms of which a table may go to every task, 12 bytes each.
MAX_SHARED_TERMS = 1 << 20
#: Pairs of blocks that meet in one round, about.
ROUND_GROUPS = 128
#: Products that are added at once, in units of 2,048.
SALT_ROWS = 128
#: Cells of a strip, which stay in a core's cache.
_CELLS = 1 << 18
#: Asking vectors that are laid out at once, and products of whole vectors that are made at once.
_SPREAD_ROWS = 16
_PAIRS = 1 << 19
_SLACK = 1 - 1e-9
#: Products are made as long as both shares could reach this part of the gate: below 1 fewer pairs are left, at more products.
_CUT = 0.93
#: Steps of shares by which postings are laid out.
_LEVELS = 16
#: Sums are single precision.
_ROUNDING = 1e-4
#: Terms below it are their own places.
_DIRECT = 1 << 20


def weights(vectors: DataFrame, key: str, count: Column, total: int) -> DataFrame:
    """``(key, term, w, df)`` of every term of ``vectors``: tf times idf in thousandths as an integer.

    ``count`` is how many documents a row stands for, ``total`` their number; df counts documents. A term that no document holds has the greatest idf.
    """
    rows = stored(vectors.select(key, count.alias("n"), F.inline(F.transform("vector", lambda t: F.struct(t["term"], t["tf"])))), "terms")
    frequency = rows.groupBy("term").agg(F.sum("n").alias("df"), F.count(F.lit(1)).alias("rows"))
    joined = lookup_join(
        rows.withColumn("term", F.col("term").cast("string")),
        frequency.withColumn("term", F.col("term").cast("string")),
        "term", "df", "rows", [key],
    )
    idf = F.round(F.log((1 + F.lit(total)) / (1 + F.col("df"))) * IDF_UNIT).cast("long")
    return joined.select(key, F.col("term").cast("long").alias("term"), (F.col("tf") * idf).alias("w"), "df").filter("w > 0")


def rare_first(weighted: DataFrame, kind: str) -> DataFrame:
    """``(v, terms, ws, norm2)``: one row per vector, its terms by rising document frequency, as ``kind``."""
    return (
        weighted.groupBy("v")
        .agg(F.sort_array(F.collect_list(F.struct("df", "term", "w"))).alias("pairs"))
        .select("v", F.col("pairs.term").cast(f"array<{kind}>").alias("terms"), F.col("pairs.w").alias("ws"))
        .withColumn("norm2", F.aggregate("ws", F.lit(0).cast("long"), lambda s, w: s + w * w))
    )


def weighted_vectors(vectors: DataFrame, count: Column, total: int, buckets: int) -> DataFrame:
    """``(v, asks, answers, terms, ws, norm2)`` of ``vectors``: as ``weights`` and ``rare_first`` give them, without a row per term.

    Hashed terms are at most ``buckets``; the idf and the rank of each go to every task, where a vector's terms are weighed and ordered in place.
    """
    spark = vectors.sparkSession
    held = vectors.select(count.alias("n"), F.explode(F.transform("vector", lambda t: t["term"])).alias("term"))
    idf = F.round(F.log((1 + F.lit(total)) / (1 + F.col("df"))) * IDF_UNIT).cast("long").alias("idf")
    table = held.groupBy("term").agg(F.sum("n").alias("df")).select("term", "df", idf).toArrow()
    term, df, value = (table[c].to_numpy() for c in ("term", "df", "idf"))
    idfs, ranks = np.zeros(buckets, np.int64), np.zeros(buckets, np.int32)
    idfs[term] = value
    ranks[term[np.lexsort((term, df))]] = np.arange(len(term))
    shared = spark.sparkContext.broadcast((idfs, ranks))
    kind = "int" if buckets <= 1 << 31 else "long"
    names = ["v", "asks", "answers", "terms", "ws", "norm2"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idfs, ranks = shared.value
        for batch in batches:
            vector = batch["vector"]
            sizes = vector.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            terms, tf = (c.to_numpy(zero_copy_only=False) for c in vector.flatten().flatten())
            ws = tf * idfs[terms]
            row = np.repeat(np.arange(len(sizes)), sizes)
            kept = ws > 0
            row, terms, ws = row[kept], terms[kept], ws[kept]
            order = _by_place(ranks[terms])
            order = order[_by_place(row[order])]
            terms, ws = terms[order], ws[order]
            sizes = np.bincount(row, minlength=len(sizes))
            some = np.flatnonzero(sizes)
            offsets = np.append(0, np.cumsum(sizes[some]))
            norm2 = np.add.reduceat(ws * ws, offsets[:-1]) if len(some) else np.zeros(0, np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x)) for x in (terms.astype(np.int32 if kind == "int" else np.int64), ws)]
            rows = batch.take(pa.array(some))
            yield pa.RecordBatch.from_arrays([*(rows[c] for c in names[:3]), *lists, pa.array(norm2)], names=names)

    rows = vectors.select("v", "asks", (F.col("n") > 0).alias("answers"), "vector")
    return rows.mapInArrow(task, f"v long, asks boolean, answers boolean, terms array<{kind}>, ws array<long>, norm2 long")


class _Block:
    """Vectors of a block: flat terms and weights, rare terms first, and the entries of the prefixes.

    ``ids`` are the places of the terms in ``vocabulary``, which ``n_terms`` is the size of; a term that it lacks has the place behind the last
    one. Without a vocabulary the terms are places below ``n_terms``.
    """

    def __init__(self, rows: pa.Table, vocabulary: np.ndarray | None, n_terms: int, threshold: float) -> None:
        terms, ws = rows["terms"].combine_chunks(), rows["ws"].combine_chunks()
        self.v, self.norm2 = rows["v"].to_numpy(), rows["norm2"].to_numpy()
        sizes = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.bounds = np.append(0, np.cumsum(sizes))
        self.ws = ws.flatten().to_numpy(zero_copy_only=False)
        flat = terms.flatten().to_numpy(zero_copy_only=False)
        self.ids = flat if vocabulary is None else _places(vocabulary, flat)
        # Whole numbers: sums over the block may wrap around, their differences within a vector are exact.
        square = self.ws.astype(np.int64) ** 2
        upto = np.cumsum(square)
        inverse = np.repeat(1.0 / self.norm2, sizes)
        rest = (np.repeat(np.append(0, upto)[self.bounds[1:]], sizes) - upto) * inverse
        share = square * inverse
        kept = rest + share > (_CUT * threshold) ** 2 * _SLACK
        if vocabulary is not None:
            kept &= self.ids < n_terms
        entries = np.flatnonzero(kept)
        self.row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[entries]
        self.term, self.u = self.ids[entries], np.sqrt(share[entries]).astype(np.float32)
        # The share of the vector from an entry on, and the length of what stands behind it.
        self.mass, self.rest = (rest + share)[entries], np.sqrt(np.maximum(rest[entries], 0)).astype(np.float32)

    def dots(self, rows: np.ndarray, other: _Block, others: np.ndarray, n_terms: int) -> np.ndarray:
        """Exact integer products of ``rows``, which rise, with the rows ``others`` of ``other``; some rows are laid out at once."""
        width = n_terms + 1
        spread = np.zeros(_SPREAD_ROWS * width, np.int64)
        dot = np.zeros(len(rows), np.int64)
        own, place = np.unique(rows, return_inverse=True)
        sizes = other.bounds[others + 1] - other.bounds[others]
        for start in range(0, len(own), _SPREAD_ROWS):
            some = own[start : start + _SPREAD_ROWS]
            held = self.bounds[some + 1] - self.bounds[some]
            at = _expand(self.bounds[some], held)
            cell = np.repeat(np.arange(len(some)) * width, held) + self.ids[at]
            spread[cell] = self.ws[at]
            spread[n_terms::width] = 0
            head, end = np.searchsorted(place, [start, start + len(some)])
            for c, d in _runs(sizes[head:end], _PAIRS):
                c, d = head + c, head + d
                at = _expand(other.bounds[others[c:d]], sizes[c:d])
                product = spread[np.repeat((place[c:d] - start) * width, sizes[c:d]) + other.ids[at]] * other.ws[at]
                dot[c:d] = np.add.reduceat(product, np.cumsum(sizes[c:d]) - sizes[c:d])
            spread[cell] = 0
        return dot


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges ``starts .. starts + sizes``, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of ``sizes`` of about ``most`` in sum, or of one."""
    behind = np.cumsum(sizes)
    cuts = np.unique(np.searchsorted(behind, np.arange(0, behind[-1], most))) if len(sizes) else []
    yield from zip(cuts, [*cuts[1:], len(sizes)], strict=True)


def _places(vocabulary: np.ndarray, terms: np.ndarray) -> np.ndarray:
    at = np.searchsorted(vocabulary, terms).astype(np.int32)
    at[vocabulary[np.minimum(at, len(vocabulary) - 1)] != terms] = len(vocabulary)
    return at


def _blocks(one: pa.Table, other: pa.Table, threshold: float) -> tuple[_Block, _Block, int]:
    """Both blocks and the number of their terms' places."""
    flat = [t["terms"].combine_chunks().flatten().to_numpy(zero_copy_only=False) for t in (one, other)]
    if min(x.min(initial=0) for x in flat) >= 0 and (most := max(x.max(initial=0) for x in flat)) < _DIRECT:
        vocabulary, n_terms = None, int(most) + 1
    else:
        vocabulary = np.unique(flat[1])
        n_terms = len(vocabulary)
    return _Block(one, vocabulary, n_terms, threshold), _Block(other, vocabulary, n_terms, threshold), n_terms


def _packed(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """An integer and two single-precision numbers per item of 16 bytes, so that they are read at once."""
    items = np.zeros((len(first), 4), np.int32)
    items[:, 0], items[:, 1], items[:, 2] = first, second.view(np.int32), third.view(np.int32)
    return items.view(np.complex128).ravel()


def _unpacked(items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    whole = items.view(np.int32).reshape(-1, 4)
    parts = whole.view(np.float32)
    return whole[:, 0], parts[:, 1], parts[:, 2]


def _met(asking: _Block, answering: _Block, n_terms: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of both blocks whose shared prefix terms and rests could reach the gate.

    From a term on, two vectors add at most the root of both shares from there. Only products of terms are made whose shares could reach
    ``_CUT`` of the gate: shares only fall, so these are the first ones that a pair shares, and what lies behind them stays below it. Postings
    are laid out by term and share. A strip of asking rows has one cell per pair; the products are added there, some at once. Shared
    terms come in the same order in both vectors, so what the last one leaves stays.
    """
    width, gate = len(answering.v), (_CUT * threshold) ** 2 * _SLACK

    def level(mass: np.ndarray) -> np.ndarray:
        return np.clip((mass - gate) * (_LEVELS / (1 - gate)), 0, _LEVELS - 1).astype(np.int64)

    key = answering.term.astype(np.int64) * _LEVELS + level(answering.mass)
    order = _by_place(key) if n_terms * _LEVELS < 1 << 32 else np.argsort(key, kind="stable")
    starts = np.append(0, np.cumsum(np.bincount(key, minlength=n_terms * _LEVELS)))
    postings = _packed(answering.row[order], answering.u[order], answering.rest[order])
    del key, order
    need = asking.term.astype(np.int64) * _LEVELS + level(gate / asking.mass)
    first, sizes = starts[need], starts[(asking.term.astype(np.int64) + 1) * _LEVELS] - starts[need]
    known = np.flatnonzero(sizes)
    first, sizes, row = first[known], sizes[known], asking.row[known]
    height = max(1, _CELLS // width)
    entries = _packed(row % height * width, asking.u[known], asking.rest[known])
    total, behind = np.zeros(height * width, np.float32), np.zeros(height * width, np.float32)
    for top in range(0, len(asking.v), height):
        a, b = np.searchsorted(row, [top, top + height])
        if a == b:
            continue
        for c, d in _runs(sizes[a:b], SALT_ROWS * 2048):
            c, d = a + c, a + d
            base, own, left = _unpacked(np.repeat(entries[c:d], sizes[c:d]))
            column, other, rest = _unpacked(postings[_expand(first[c:d], sizes[c:d])])
            cell = (base + column).astype(np.int64)
            np.add.at(total, cell, own * other)
            behind[cell] = left * rest
        np.minimum(behind, _CUT * threshold, out=behind)
        total += behind
        cells = np.flatnonzero(total > threshold - _ROUNDING)
        total.fill(0)
        behind.fill(0)
        yield top + cells // width, cells % width


def _gathered(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of several strips at once, in their order."""
    kept, n = [], 0
    for pair in found:
        kept.append(pair)
        n += len(pair[0])
        if n >= 1 << 14:
            yield tuple(np.concatenate(c) for c in zip(*kept, strict=True))
            kept, n = [], 0
    if n:
        yield tuple(np.concatenate(c) for c in zip(*kept, strict=True))


_CANDIDATES = "a long, b long, dot long, n1 long, n2 long"


def candidates(vectors: DataFrame, threshold: float, same: bool) -> DataFrame:
    """``(a, b, dot, n1, n2)``: pairs of an asking and an answering vector with a score at the threshold or above, each once.

    ``vectors`` has ``(v, terms, ws, norm2, asks, answers)``. Both sides are cut into blocks of bounded size and each pair of blocks is one group,
    which adds up the products of shared prefix terms: no row per shared term or pair is shuffled, only the vectors, once per block of the other
    side. The answering blocks take turns, about ``ROUND_GROUPS`` groups in each, so that no more than a round's copies are on the disks.
    Where the sides are the ``same``, a pair of blocks meets once and gives both directions.

    A pair's first shared terms are summed, up to one from which on both sides' shares cannot reach a part of the gate. What lies behind is below
    that part, and at most the product of what the last summed term leaves to both sides.
    """
    spark = vectors.sparkSession

    def blocked(side: str, own: str) -> tuple[DataFrame, int]:
        rows = vectors.filter(side)
        n, values, most = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0)), F.max(F.array_max("ws"))).first()
        blocks = max(1, -(-n // BLOCK_ROWS), -(-values // BLOCK_TERMS))
        ws = F.col("ws").cast("array<int>" if most is None or most < 1 << 31 else "array<long>")
        kept = [F.col("v").alias("v"), F.col("terms").alias("terms"), ws.alias("ws"), F.col("norm2").alias("norm2")]
        return rows.select(*kept, F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias(own)), blocks

    (asking, n_asking), (answering, n_answering) = blocked("asks", "_ab"), blocked("answers", "_bb")
    step = max(1, ROUND_GROUPS // n_asking)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * n_asking * min(step, n_answering))
    partitions = min(partitions, MAX_BLOCK_TASKS)

    def meet(key: tuple, one: pa.Table, other: pa.Table) -> pa.Table:
        found = []
        if one.num_rows and other.num_rows:
            x, y, n_terms = _blocks(one, other, threshold)
            for i, j in _gathered(_met(x, y, n_terms, threshold)):
                dot = x.dots(i, y, j, n_terms)
                n1, n2 = x.norm2[i], y.norm2[j]
                kept = (dot > threshold * _SLACK * np.sqrt(n1.astype(float)) * np.sqrt(n2.astype(float))) & (x.v[i] != y.v[j])
                found.append([c[kept] for c in (x.v[i], y.v[j], dot, n1, n2)])
            if same and key[0].as_py() != key[1].as_py():
                found += [[b, a, dot, n2, n1] for a, b, dot, n1, n2 in found]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
        return pa.table(dict(zip(("a", "b", "dot", "n1", "n2"), columns, strict=True)))

    def meeting(start: int, stop: int) -> DataFrame:
        left, right = asking, answering.filter((F.col("_bb") >= start) & (F.col("_bb") < stop))
        if same:
            left = left.filter(F.col("_ab") < stop)
            left = left.withColumn("_bb", F.explode(F.sequence(F.greatest("_ab", F.lit(start)), F.lit(stop - 1))))
            right = right.withColumn("_ab", F.explode(F.sequence(F.lit(0), "_bb")))
        else:
            left = left.withColumn("_bb", F.explode(F.sequence(F.lit(start), F.lit(stop - 1))))
            right = right.withColumn("_ab", F.explode(F.sequence(F.lit(0), F.lit(n_asking - 1))))
        left, right = (df.repartition(partitions, "_ab", "_bb").groupBy("_ab", "_bb") for df in (left, right))
        return stored(left.cogroup(right).applyInArrow(meet, _CANDIDATES), "candidates")

    rounds = [meeting(start, min(start + step, n_answering)) for start in range(0, n_answering, step)]
    return functools.reduce(DataFrame.unionByName, rounds)


def scored(pairs: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, score)`` of the pairs above the threshold, from integer dot products of whole vectors."""
    norm = F.sqrt(F.col("n1").cast("double")) * F.sqrt(F.col("n2").cast("double"))
    rows = pairs.select("a", "b", (F.col("dot").cast("double") / norm).alias("score"))
    return rows.filter(F.col("score") > threshold)


def text_join(
    documents: DataFrame,
    questions: DataFrame | None = None,
    threshold: float = 0.70,
    k: int = 3,
    *,
    id_col: str,
    text: str,
    query_id: str,
    query_text: str | None = None,
    buckets: int = V.DEFAULT_BUCKETS,
) -> DataFrame:
    """``(query_id, id, score, rank)``: per question its k best documents strictly above the threshold.

    Without ``questions`` every document asks for the others (not for itself). Ties go to the smaller id. Questions without a word, rows with a
    NULL text or id, and questions without a hit have no row. Work follows the pairs that share a term in their prefixes, not questions x
    documents; with plain counts in place of tf·idf the prefixes would hold almost every term.
    """
    if not 0 < threshold < 1:
        raise ValueError(f"the threshold must lie between 0 and 1: {threshold!r}")

    def side(df: DataFrame, key: str, column: str, asks: bool, answers: bool) -> DataFrame:
        known = df.filter(F.col(key).isNotNull() & F.col(column).isNotNull())
        # Both from one vector, which is built once.
        made = F.transform(F.array(V.term_vector(F.col(column), buckets)), lambda v: F.struct(v.alias("vector"), digest(v).alias("class")))
        return known.select(F.col(key).alias("id"), F.lit(asks).alias("asks"), F.lit(answers).alias("answers"), F.inline(made))

    def digest(vector: Column) -> Column:
        return F.md5(F.array_join(F.transform(vector, lambda t: F.concat_ws(":", t["term"], t["tf"])), ","))

    if questions is None:
        rows, query_type = side(documents, id_col, text, True, True), documents.schema[id_col].dataType
    else:
        query_type = questions.schema[query_id].dataType
        rows = side(documents, id_col, text, False, True).unionByName(
            side(questions.select(F.col(query_id).cast(documents.schema[id_col].dataType).alias("id"), query_text), "id", query_text, True, False)
        )
        if documents.schema[id_col].dataType != query_type:
            raise ValueError("question and document ids must have one type")
    # A filter on the vector itself would be pushed below its projection and build it twice.
    rows = stored(rows, "texts")
    total = rows.filter("answers").count()
    classes = stored(
        rows.filter(F.size("vector") > 0)
        .groupBy("class")
        .agg(F.first("vector").alias("vector"), F.sum(F.col("answers").cast("long")).alias("n"), F.max("asks").alias("asks"))
        .withColumn("v", F.monotonically_increasing_id()),
        "classes",
    )
    sides = classes.select("v", "asks", (F.col("n") > 0).alias("answers"))
    if buckets <= MAX_SHARED_TERMS:
        vectors = weighted_vectors(classes, F.col("n"), total, buckets)
    else:
        vectors = rare_first(weights(classes, "v", F.col("n"), total), "int" if buckets <= 1 << 31 else "long").join(sides, "v")
    vectors = stored(vectors, "vectors")
    above = scored(candidates(vectors, threshold, questions is None), threshold)
    root = F.sqrt(F.col("norm2").cast("double"))
    own = vectors.select(F.col("v").alias("a"), F.col("v").alias("b"), (F.col("norm2") / (root * root)).alias("score"))
    links = above.unionByName(own).join(sides.filter("asks").select(F.col("v").alias("a")), "a", "left_semi")
    wanted = k + (questions is None)
    best = stored(_expanded(links, rows, classes, wanted), "best")
    asked = rows.filter("asks").select(F.col("id").alias("_query"), "class").join(classes.select("class", "v"), "class")
    hits = asked.select("_query", F.col("v").alias("a")).join(best, "a")
    if questions is None:
        hits = hits.filter(F.col("_query") != F.col("id"))
    ranked = Window.partitionBy("_query").orderBy(F.desc("score"), "id")
    return (
        hits.withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= k)
        .select(F.col("_query").cast(query_type).alias(query_id), F.col("id").alias(id_col), "score", "rank")
    )


def _expanded(links: DataFrame, rows: DataFrame, classes: DataFrame, wanted: int) -> DataFrame:
    """``(a, id, score)``: the ``wanted`` best documents of every asking class.

    Of a class of copies the ``wanted`` smallest ids are enough, and of a class's links the ``wanted`` best by score and smallest id.
    """
    smallest = Window.partitionBy("class").orderBy("id")
    members = stored(
        rows.filter("answers")
        .select("class", "id")
        .withColumn("_n", F.row_number().over(smallest))
        .filter(F.col("_n") <= wanted)
        .join(classes.select("class", "v"), "class")
        .select(F.col("v").alias("b"), "id", "_n"),
        "members",
    )
    nearest = Window.partitionBy("a").orderBy(F.desc("score"), "id")
    heads = links.join(members.filter("_n = 1").drop("_n"), "b")
    kept = heads.withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= wanted).select("a", "b", "score")
    return kept.join(members.drop("_n"), "b").withColumn("_r", F.row_number().over(nearest)).filter(F.col("_r") <= wanted).select("a", "id", "score")
