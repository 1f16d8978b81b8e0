"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Equal texts are one node. Every node gets a MinHash signature, cut into trees of prefixes. Prefixes are
shortened until the recall at the threshold itself reaches the target. Branches of that depth which hold
several nodes are followed upwards to the longest prefix that two of their nodes share, and every node is linked to
the least node of each branch on its way, so that two nodes meet at their longest match. Nodes joined by
plausible links form groups, groups are cut into blocks, and each pair of blocks is
verified with the whole shingle sets. No list of pairs is ever built: a block pair gives
one row per node, its number of links and a link to its class.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow, written
from corpusq.llm.components import connected_components
from corpusq.llm.decontaminate import tokenise

SHINGLE = 5
THRESHOLD = 0.8
TREES = 16
DEPTH = 8
LEAST_DEPTH = 1
RECALL = 0.999
#: Links of a lower estimated similarity do not join a group: by the triangle inequality two
#: texts at a threshold of 0.8 are both above it for any text close to one of them. Below a
#: threshold of 0.7 it gives way by ``MARGIN``, over four deviations of an estimate.
PLAUSIBLE = 0.5
MARGIN = 0.2
BLOCK_NODES = 256
BLOCK_SHINGLES = 1_000_000
#: Up to so many nodes (16 bytes each) are broadcast to pick their texts; more are joined by a shuffle.
BROADCAST_NODES = 200_000
CHUNK_BYTES = 2 << 20


def shingle_hashes(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of ``shingle`` words, and their number per text.

    Words are those of ``tokenise``. A text of fewer words, but not none, has one run.
    """
    words, n_words = tokenise(texts)
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    h = known[words.indices.to_numpy()]
    starts = np.cumsum(n_words) - n_words
    mixed = np.zeros(len(h), np.uint64)
    own = np.repeat(np.arange(len(n_words)), n_words)
    ends = (starts + n_words)[own]
    at = np.arange(len(h))
    for k in range(shingle):
        there = np.minimum(at + k, len(h) - 1)
        inside = at + k < ends
        mixed = np.where(inside, _mix(mixed ^ h[there]), mixed)
    keep = (at + shingle <= ends) | ((at == starts[own]) & (n_words[own] < shingle))
    return mixed[keep], np.bincount(own[keep], minlength=len(n_words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def signatures(hashes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Least values under ``size`` hash functions, 32 bits each, one row per text with a run."""
    rng = np.random.default_rng(20_240_229)
    odd = rng.integers(1, 1 << 62, size, np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 62, size, np.uint64)
    heads = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(heads), size), np.uint32)
    for k in range(size):
        values = ((hashes * odd[k] + shift[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(values, heads) if len(heads) else 0
    return out


def _digest(text) -> F.Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sign_texts(docs: DataFrame, doc_id: str, text: str, shingle: int, trees: int, depth: int) -> DataFrame:
    """``(node, rep, copies, n_shingles, signature)``: one row per different text with a word."""
    rows = docs.select(F.col(doc_id).alias("rep"), _digest(F.col(text)).alias("node"), F.col(text).alias("text"))
    kind = rows.schema["rep"].dataType.simpleString()

    def sign(table: pa.Table) -> pa.Table:
        hashes, counts = shingle_hashes(table["text"].combine_chunks(), shingle)
        some = pa.array(np.flatnonzero(counts > 0))
        values = signatures(hashes, counts, trees * depth)
        packed = pa.array([row.tobytes() for row in values], pa.binary())
        return pa.table(
            {
                "rep": table["rep"].take(some),
                "node": table["node"].take(some),
                "n_shingles": pa.array(counts[counts > 0], pa.int64()),
                "signature": packed,
            }
        )

    signed = map_arrow(rows, sign, f"rep {kind}, node binary, n_shingles long, signature binary", CHUNK_BYTES)
    once = signed.groupBy("node").agg(
        F.min("rep").alias("rep"),
        F.count(F.lit(1)).alias("copies"),
        F.max("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    return written(once, "signed")


def _found(similarity: np.ndarray, depth: int, trees: int) -> np.ndarray:
    """Chance that two texts share a prefix of ``depth`` in one of ``trees``."""
    return 1 - (1 - similarity**depth) ** trees


def shortened(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH, least: int = LEAST_DEPTH) -> int:
    """The longest prefix with a chance of ``recall`` at the threshold itself. Raises if none down to ``least`` has it."""
    for d in range(depth, least - 1, -1):
        if _found(np.float64(threshold), d, trees) >= recall:
            return d
    raise ValueError(f"{trees} trees do not reach a recall of {recall} at a similarity of {threshold}")


def _shared(rows: DataFrame) -> DataFrame:
    """``rows`` whose branch holds several nodes, with its least node as ``hub``.

    Branches are counted before the shuffle and written, so that the join back can split a hot one.
    """
    hubs = rows.groupBy("branch").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows.join(written(hubs.select("branch", "hub"), "hubs"), "branch")


def _branches(texts: DataFrame, short: int, trees: int, full: int) -> DataFrame:
    """``(node, hub)``: each node with the least node of every shared trie branch on its way, from ``short`` to ``full`` values.

    Only branches that hold several nodes at ``short`` are followed to longer prefixes.
    """
    ways = F.array(*[F.struct(F.lit(t).alias("tree"), F.substring("signature", 4 * full * t + 1, 4 * full).alias("way")) for t in range(trees)])
    rows = texts.select("node", F.explode(ways).alias("at")).select("node", "at.tree", "at.way")
    branch = lambda d: F.xxhash64("tree", d, F.substring(F.col("way"), F.lit(1), 4 * d))
    met = _shared(rows.withColumn("branch", branch(F.lit(short)))).select("node", "tree", "way", "hub")
    if short == full:
        return met.filter("node != hub").select("node", "hub").distinct()
    met = written(met, "branches")
    longer = met.select("node", "tree", "way", F.explode(F.sequence(F.lit(short + 1), F.lit(full))).alias("d"))
    pairs = met.select("node", "hub").union(_shared(longer.select("node", branch(F.col("d")).alias("branch"))).select("node", "hub"))
    return pairs.filter("node != hub").distinct()


def forest_links(
    texts: DataFrame, threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH, least: int = LEAST_DEPTH
) -> DataFrame:
    """``(node, hub, similarity)``: links between trie branches, similarity estimated by the signatures.

    Links of all prefixes from the longest at which two texts exactly at the threshold share a branch with a chance of
    ``recall`` up to the full ones, whose hubs are closest. The least depth depends on no row.
    """

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype=float)
        x = np.frombuffer(b"".join(a), np.uint32).reshape(len(a), -1)
        y = np.frombuffer(b"".join(b), np.uint32).reshape(len(b), -1)
        return pd.Series((x == y).mean(axis=1))

    one = texts.select("node", F.col("signature").alias("s1"))
    two = texts.select(F.col("node").alias("hub"), F.col("signature").alias("s2"))
    pairs = _branches(texts, shortened(threshold, recall, trees, depth, least), trees, depth)
    links = pairs.join(one, "node").join(two, "hub").select("node", "hub", alike("s1", "s2").alias("similarity"))
    return written(links, "links")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    recall: float = RECALL,
    trees: int = TREES,
    depth: int = DEPTH,
) -> DataFrame:
    """``(id, class_id, n_links, n_copies)`` per row of ``docs``.

    A class is a connected component of links, a link being two texts whose sets of ``shingle``-word runs have a Jaccard
    similarity of at least ``threshold``. ``class_id`` is the least id in the class; ``n_links`` counts the *different* texts
    linked to the row's text, ``n_copies`` the rows with its text, itself included.

    A text without words (NULL, empty, blank, only signs) links to nothing and is a class of its own row. NULL ids
    keep their rows; a class whose ids are all NULL has the id NULL. Extra columns are not read.
    """
    texts = sign_texts(docs, doc_id, text, shingle, trees, depth)
    links = forest_links(texts, threshold, recall, trees, depth).filter(
        F.col("similarity") >= min(PLAUSIBLE, threshold - MARGIN)
    )
    groups = connected_components(links, "node", "hub")
    verified = _verified(docs, doc_id, text, texts, groups, threshold, shingle)
    classes = connected_components(verified.filter("node != link"), "node", "link")
    degrees = verified.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    labelled = (
        texts.select("node", "rep", "copies")
        .join(classes, "node", "left")
        .join(degrees, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    ids = written(labelled.groupBy("root").agg(F.min("rep").alias("class_id")), "classes")
    known = labelled.join(ids, "root").select(
        F.col("node").alias("known"), "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "copies"
    )
    rows = docs.select(F.col(doc_id).alias("id"), _digest(F.col(text)).alias("node"))
    return rows.join(known, F.col("node") == F.col("known"), "left").select(
        "id",
        F.when(F.col("known").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("n_copies"),
    )


def _verified(
    docs: DataFrame, doc_id: str, text: str, texts: DataFrame, groups: DataFrame, threshold: float, shingle: int
) -> DataFrame:
    """``(node, n_links, link)`` per node and pair of blocks with a verified link."""
    members = groups.join(texts.select("node", "rep", "n_shingles"), "node")
    sizes = members.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).cast("int").alias("n_blocks")
    )
    placed = members.join(written(sizes, "sizes"), "root").select(
        "node", "rep", "root", "n_blocks", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int").alias("block")
    )
    placed = written(placed, "placed")
    chosen = placed.select(F.col("node").alias("chosen"), F.col("rep").alias("chosen_rep"))
    if placed.count() <= BROADCAST_NODES:
        chosen = F.broadcast(chosen)
    rows = docs.select(F.col(doc_id).alias("id"), _digest(F.col(text)).alias("node"), F.col(text).alias("text"))
    # One row per text: that of the least id; of rows that repeat as a whole, one per map task and then one.
    rows = rows.join(
        chosen, (F.col("node") == F.col("chosen")) & F.col("id").eqNullSafe(F.col("chosen_rep")), "left_semi"
    )
    rows = rows.groupBy("node").agg(F.first("text").alias("text"))

    def sets(table: pa.Table) -> pa.Table:
        hashes, counts = shingle_hashes(table["text"].combine_chunks(), shingle)
        ends = np.cumsum(counts)
        packed = [np.unique(hashes[e - c : e]).tobytes() for c, e in zip(counts, ends, strict=True)]
        return pa.table({"node": table["node"], "runs": pa.array(packed, pa.binary())})

    shingled = map_arrow(rows.select("node", "text"), sets, "node binary, runs binary", CHUNK_BYTES)
    lo, hi = F.least("block", "other"), F.greatest("block", "other")
    dealt = (
        shingled.join(placed.select("node", "root", "n_blocks", "block"), "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select("node", "runs", "root", lo.alias("lo"), hi.alias("hi"), "block")
    )

    def verify(table: pa.Table) -> pa.Table:
        return _verify(table, threshold)

    found = dealt.groupBy("root", "lo", "hi").applyInArrow(verify, "node binary, n_links long, link binary")
    return written(found, "verified")


def _verify(table: pa.Table, threshold: float) -> pa.Table:
    nodes, blocks = table["node"].to_pylist(), table["block"].to_numpy()
    runs = table["runs"].combine_chunks()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in runs]
    sizes = np.array([len(s) for s in sets], np.float64)
    own = np.repeat(np.arange(len(sets)), sizes.astype(int))
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    own, column = own[shared], np.unique(column[shared], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    own, column = own[order], column[order]
    width = max(1, (1 << 20) // len(sets))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(sets), width), np.float32)
        part[own[a:b], column[a:b] - start] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = common / union >= threshold
    np.fill_diagonal(linked, False)
    lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
    if lo != hi:  # links inside a block belong to the pair of the block with itself
        linked &= blocks[:, None] != blocks[None, :]
    degree = linked.sum(axis=1)
    label = np.arange(len(sets))
    while True:
        least = np.where(linked, label[None, :], len(sets)).min(axis=1, initial=len(sets))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(degree)
    return pa.table(
        {
            "node": pa.array([nodes[i] for i in some], pa.binary()),
            "n_links": pa.array(degree[some], pa.int64()),
            "link": pa.array([nodes[label[i]] for i in some], pa.binary()),
        }
    )
