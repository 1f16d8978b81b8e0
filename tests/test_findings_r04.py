"""Cases of the findings of the fourth round."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusq.operators import blocks, chat, ordered, search, textjoin


@pytest.mark.parametrize("blocks", [2, 17, 33, 70])
def test_long_history_is_the_plain_one(spark, blocks):
    """whatever the number of blocks, NULL texts and stretches that hold nothing else included."""
    said = {}
    for conv in (1, 2):
        for turn in range(blocks * 4):
            said[conv, turn] = None if turn % 5 == 3 or (conv == 2 and 8 <= turn < 24) else "" if turn % 7 == 1 else f"é{conv}.{turn}"
    said[3, 0], said[3, 1] = "alone", "b"
    rows = spark.createDataFrame([(c, t, "user", x) for (c, t), x in said.items()], "conv_id long, turn int, role string, text string")
    wanted = {(c, t): "\n".join(f"user: {said[c, s]}" for s in range(t) if said[c, s] is not None) for c, t in said}
    assert {(r.conv_id, r.turn): r.history for r in chat.history_buffer(rows, block_rows=4).collect()} == wanted
    own = {(c, t): " ".join(said[c, s] for s in range(t + 1) if said[c, s] is not None) for c, t in said}
    assert {(r.conv_id, r.turn): r.request for r in chat.accumulate_query(rows, block_rows=4).collect()} == own


def test_a_stretch_is_sent_its_text_in_parts_and_alone(spark):
    """no task collects the texts before its stretches in an aggregate, and none has two stretches of a conversation."""
    rows = spark.range(400).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text")
    )
    out = chat.history_buffer(rows, block_rows=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list(struct(_of" not in plan and "array_join" not in plan
    tasks = out.select(F.spark_partition_id().alias("p"), F.floor(F.col("turn") / 4).alias("block")).distinct().collect()
    per = -(-100 // ordered.STRETCHES)
    assert len({(r.p, r.block // per) for r in tasks}) == len({r.p for r in tasks}) == -(-100 // per)


def test_text_join_makes_only_products_that_can_matter(monkeypatch):
    """no pair above the gate is lost, and most products of shared prefix terms are not made."""
    rng = np.random.default_rng(4)
    share = 1 / np.arange(1, 401) ** 0.7

    def rows(n: int, first: int, like: list) -> pa.Table:
        out = []
        for i in range(n):
            terms = np.sort(rng.choice(400, rng.integers(3, 60), replace=False, p=share / share.sum()))[::-1]  # the rare ones first
            ws = rng.integers(1, 4, len(terms)) * (terms + 5)
            if like and i % 3 == 0:
                terms, ws = np.array(like[i % len(like)]["terms"]), np.array(like[i % len(like)]["ws"]) + rng.integers(0, 40)
            out.append({"v": first + i, "terms": terms.astype(np.int32), "ws": ws.astype(np.int64), "norm2": int((ws * ws).sum())})
        return pa.Table.from_pylist(out, pa.schema([("v", pa.int64()), ("terms", pa.list_(pa.int32())), ("ws", pa.list_(pa.int64())), ("norm2", pa.int64())]))

    one = rows(150, 0, [])
    other = rows(170, 1000, one.to_pylist())
    made, expand = [], textjoin._expand
    monkeypatch.setattr(textjoin, "_expand", lambda starts, sizes: made.append(int(sizes.sum())) or expand(starts, sizes))
    monkeypatch.setattr(textjoin, "_CELLS", 1000)
    for threshold in (0.3, 0.7, 0.9):
        x, y, n_terms = textjoin._blocks(one, other, threshold)
        made.clear()
        found = list(textjoin._met(x, y, n_terms, threshold))
        products = sum(made)
        every = int((np.bincount(x.term, minlength=n_terms) * np.bincount(y.term, minlength=n_terms)).sum())
        pairs = {}
        for i, j in found:
            pairs |= dict(zip(zip(i.tolist(), j.tolist(), strict=True), x.dots(i, y, j, n_terms).tolist(), strict=True))
        above = 0
        for i, a in enumerate(one.to_pylist()):
            held = dict(zip(a["terms"], a["ws"], strict=True))
            for j, b in enumerate(other.to_pylist()):
                dot = sum(w * held.get(t, 0) for t, w in zip(b["terms"], b["ws"], strict=True))
                if dot > threshold * (a["norm2"] * b["norm2"]) ** 0.5:
                    above += 1
                    assert pairs[i, j] == dot
        assert above >= 50 and products < 0.8 * every


def test_text_join_keeps_the_class_with_the_text(spark, monkeypatch):
    """a vector's digest is made once, where the vector is; blocks are small enough for two workers beside an executor."""
    written, store = {}, textjoin.stored
    monkeypatch.setattr(textjoin, "stored", lambda df, name: written.setdefault(name, df) and store(df, name))
    df = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "x y z")], "id long, body string")
    hits = textjoin.text_join(df, None, 0.7, 3, id_col="id", text="body", query_id="q").collect()
    assert {(r.q, r.id) for r in hits} == {(1, 2), (2, 1)}
    assert "class" in written["texts"].columns and "md5" not in hits_plan(written["classes"])
    assert textjoin.BLOCK_TERMS <= 2 << 20


def hits_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_term_block_lays_out_no_more_than_a_batch_of_queries():
    """memory beyond the blocks themselves follows the index block, not the queries; the rows found are those of a plain search."""
    rng = np.random.default_rng(5)

    def block(rows: int, size: int) -> blocks.SparseBlock:
        terms = np.sort((4000 * rng.random((rows, size)) ** 2).astype(np.int32), axis=1)
        first = np.diff(terms, axis=1, prepend=-1) > 0
        weights = rng.integers(1, 4, terms.shape).astype(np.int32)[first]
        offsets = np.append(0, np.cumsum(first.sum(axis=1)))
        return blocks.SparseBlock(np.arange(rows), offsets, terms[first], weights, np.add.reduceat(weights.astype(float) ** 2, offsets[:-1]))

    index_block, asked = block(1000, 60), block(40_000, 60)
    tracemalloc.start()
    found = [np.concatenate(c) for c in zip(*blocks.TermIndex(index_block, asked, 3), strict=True)]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 10 * len(asked.terms)
    some = asked.part(0, 300)
    top = blocks.TopK("sparse", blocks.SparseBlock(some.ids, some.offsets, some.terms, some.weights.astype(float), some.norms), 3, keep_zero=False)
    top.add(blocks.SparseBlock(index_block.ids, index_block.offsets, index_block.terms, index_block.weights.astype(float), index_block.norms))
    assert all(np.array_equal(a[: len(b)], b) for a, b in zip(found, top.parts[0][2], strict=True))
    assert search.BLOCK_TERMS <= 3 << 20


def test_vectors_are_weighed_in_place(spark):
    """the same vectors as by a row per term, with terms that every document or no document holds, and no row per term shuffled."""
    vectors = [(7, [(3, 2), (9, 1), (12, 4)], 2, True), (8, [(3, 1)], 1, True), (9, [(3, 1), (5, 3), (9, 2)], 0, True), (10, [(3, 5), (12, 1)], 1, False)]
    df = spark.createDataFrame(vectors, "v long, vector array<struct<term: bigint, tf: bigint>>, n long, asks boolean")
    old = textjoin.rare_first(textjoin.weights(df, "v", F.col("n"), 4), "int")
    new = textjoin.weighted_vectors(df, F.col("n"), 4, 16)
    row = lambda r: (r.v, r.terms, r.ws, r.norm2)
    assert sorted(map(row, new.collect())) == sorted(map(row, old.collect()))
    assert {(r.v, r.asks, r.answers) for r in new.collect()} == {(7, True, True), (9, True, False), (10, False, True)}
    assert "Exchange" not in hits_plan(new)
