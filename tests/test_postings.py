"""Stored postings against plain scoring, and what they leave unread."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusq.operators import postings, search
from corpusq.sources.materialise import shared_folder

WORD = re.compile(r"\w+")


def vector(text):
    return Counter(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % (1 << 18) for w in WORD.findall((text or "").lower()))


def brute(docs, asks, k):
    index = [(i, vector(t)) for i, t in docs if i is not None]
    df = Counter(t for _, v in index for t in v)
    out = []
    for q, text in asks:
        if q is None:
            continue
        idf = {t: math.floor(math.log((1 + len(index)) / (1 + df[t])) * 1e6 + 0.5) for t in vector(text) if t in df}
        scores = [(-sum(n * v[t] for t, n in idf.items()), i) for i, v in index]
        best = sorted(s for s in scores if s[0] < 0)[:k]
        out += [(q, i, -s / 1e6, r + 1) for r, (s, i) in enumerate(best)]
    return sorted(out)


def rows():
    docs = [(i, " ".join(f"w{(i * i + j) % 70}" for j in range(1 + i % 23)) + (" long" * 40 if i % 50 == 0 else "")) for i in range(600)]
    docs += [(1000 + i, "hot copy of one text") for i in range(300)] + [(2000, None), (2001, ""), (None, "w1 w2")]
    asks = [(1, "w1 w2 w3"), (2, "hot text"), (3, "long w7"), (4, "unknownword"), (5, ""), (6, None), (None, "w1"), (7, "w1 w1 w1"), (8, "the w69 w68 hot")]
    return docs, asks


def frames(spark):
    docs, asks = rows()
    questions = search.with_term_vector(spark.createDataFrame(asks, "q long, ask string"), "ask")
    return docs, asks, spark.createDataFrame(docs, "id long, body string"), questions


def got(df):
    return sorted((r.q, r.id, r.score, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("first", [1, 100])
def test_search_equals_brute_force(spark, monkeypatch, first):
    monkeypatch.setattr(postings, "FIRST_BLOCKS", first)
    docs, asks, df, questions = frames(spark)
    path = f"{shared_folder(spark)}/postings-{first}"
    postings.write_postings(df, path, "id", "body", block_rows=32)
    found = got(postings.search_postings(spark, path, questions, 4, id_col="id", query_id="q"))
    want = brute(docs, asks, 4)
    assert not (d := sorted(set(found) ^ set(want))), d[:6]


def test_added_batches_and_empty_tables(spark):
    docs, asks, df, questions = frames(spark)
    path = f"{shared_folder(spark)}/postings-batches"
    postings.write_postings(df.filter("id < 300 OR id IS NULL"), path, "id", "body", block_rows=32)
    postings.write_postings(df.filter("id >= 300"), path, "id", "body", block_rows=32, batch=1)
    assert got(postings.search_postings(spark, path, questions, 3, id_col="id", query_id="q")) == brute(docs, asks, 3)
    assert postings.search_postings(spark, path, questions.limit(0), 3, id_col="id", query_id="q").count() == 0
    postings.write_postings(df.limit(0), path, "id", "body")
    assert postings.search_postings(spark, path, questions, 3, id_col="id", query_id="q").count() == 0


def test_blocks_are_skipped(spark, monkeypatch):
    docs = [(i, " ".join(f"w{(i + j) % 9}" for j in range(2 ** (i % 9)))) for i in range(900)]
    df = spark.createDataFrame(docs, "id long, body string")
    questions = search.with_term_vector(spark.createDataFrame([(1, "w1 w2"), (2, "w8")], "q long, ask string"), "ask")
    path = f"{shared_folder(spark)}/postings-skipped"
    postings.write_postings(df, path, "id", "body", block_rows=32)
    table = spark.read.parquet(path)
    assert table.filter(F.size("postings") > 60).filter(f"term != {postings.EVERY}").count() == 0  # no block holds a hot term alone
    seen = []
    open_blocks = postings._open_blocks
    monkeypatch.setattr(postings, "_open_blocks", lambda bounds, floor: seen.append((bounds, out := open_blocks(bounds, floor))) or out)
    found = got(postings.search_postings(spark, path, questions, 3, id_col="id", query_id="q"))
    assert found == brute(docs, [(1, "w1 w2"), (2, "w8")], 3)
    bounds, opened = seen[0]
    assert opened.count() < 0.3 * bounds.count()


def test_only_asked_postings_are_moved(spark):
    _, _, df, questions = frames(spark)
    path = f"{shared_folder(spark)}/postings-moved"
    postings.write_postings(df, path, "id", "body", block_rows=32)
    found = postings.search_postings(spark, path, questions, 3, id_col="id", query_id="q")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    reads = [line for line in plan.splitlines() if "Relation" in line and "postings#" in line]
    assert len(reads) == 1 and plan.count("LeftSemi") >= 2
