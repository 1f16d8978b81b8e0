"""Search against brute force, in the broadcast and in the blocked form."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusq.operators import approximate, blocks, index, search

COLUMNS = {"id_col": "id", "vector": "v", "query_id": "q", "query_vector": "qv"}


def brute(ids, vectors, qids, queries, k, metric="cosine", skip=False):
    out = []
    for q, qv in zip(qids, queries):
        scored = []
        for i, v in zip(ids, vectors):
            if skip and i == q:
                continue
            a, b = np.asarray(qv, float), np.asarray(v, float)
            if metric == "l2":
                s = 1 / (1 + ((a - b) ** 2).sum())
            else:
                n = np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())
                s = (a * b).sum() / n if n > 0 else None
            scored.append((-(s if s is not None else -np.inf), i, s))
        scored.sort(key=lambda t: t[:2])
        out += [(q, i, None if s is None else round(s, 9), r + 1) for r, (_, i, s) in enumerate(scored[:k])]
    return sorted(out)


def hits(df):
    return sorted((r.q, r.id, None if r.score is None else round(r.score, 9), r.rank) for r in df.collect())


def frames(spark, ids, vectors, qids, queries, kind="long"):
    a = spark.createDataFrame(list(zip(ids, [list(map(float, v)) for v in vectors])), f"id {kind}, v array<float>")
    b = spark.createDataFrame(list(zip(qids, [list(map(float, v)) for v in queries])), f"q {kind}, qv array<float>")
    return a, b


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    vectors = rng.integers(-3, 4, (400, 5))
    vectors[100:240] = vectors[0]  # a group of copies holds a third of the rows
    vectors[5] = 0
    return list(range(1000, 1400)), vectors, list(range(30)), np.vstack([vectors[:29], np.zeros((1, 5))])


BOTH = pytest.mark.parametrize("options", [{}, {"max_broadcast": 4, "blocks": (50, 7)}], ids=["broadcast", "blocked"])


@BOTH
@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_dense_equals_brute_force(spark, data, options, metric):
    a, b = frames(spark, *data)
    assert hits(search.topk_dense(a, b, 3, metric=metric, **COLUMNS, **options)) == brute(*data, 3, metric)


@BOTH
def test_more_neighbours_than_rows_and_empty_index(spark, data, options):
    ids, vectors, qids, queries = data
    a, b = frames(spark, ids[:4], vectors[:4], qids, queries)
    assert hits(search.topk_dense(a, b, 10, **COLUMNS, **options)) == brute(ids[:4], vectors[:4], qids, queries, 10)
    assert search.topk_dense(a.filter("id < 0"), b, 3, **COLUMNS, **options).count() == 0
    assert search.topk_dense(a, b.filter("q < 0"), 3, **COLUMNS, **options).count() == 0


@BOTH
def test_skip_equal_ids(spark, data, options):
    _, vectors, _, _ = data
    ids = list(range(100))
    a, b = frames(spark, ids, vectors[:100], ids, vectors[:100])
    got = hits(search.topk_dense(a, b, 3, skip_equal=True, **COLUMNS, **options))
    assert got == brute(ids, vectors[:100], ids, vectors[:100], 3, skip=True)


def test_text_ids_break_ties_in_text_order(spark):
    a, b = frames(spark, ["b", "a", "é", "Z"], [[1, 0]] * 4, ["q"], [[1, 0]], "string")
    assert [h[1] for h in sorted(hits(search.topk_dense(a, b, 4, **COLUMNS)), key=lambda h: h[3])] == ["Z", "a", "b", "é"]


def test_rows_without_a_vector_are_skipped(spark):
    a = spark.createDataFrame([(1, [1.0]), (2, None)], "id long, v array<float>")
    b = spark.createDataFrame([(1, [1.0]), (2, None)], "q long, qv array<float>")
    assert hits(search.topk_dense(a, b, 3, **COLUMNS)) == [(1, 1, 1.0, 1)]


def test_filter_then_search(spark, data):
    a, b = frames(spark, *data)
    tagged = a.withColumn("tag", F.col("id") % 3)
    got = hits(search.topk_dense(tagged, b, 3, filters={"tag": 1}, **COLUMNS))
    assert got == hits(search.topk_dense(a.filter("id % 3 = 1"), b, 3, **COLUMNS))
    with pytest.raises(ValueError):
        search.topk_dense(a, b, 3, filters={"nope": 1}, **COLUMNS)


def test_gate_is_strict(spark):
    scored = spark.createDataFrame(
        [(1, 10, 0.7, 1), (2, 10, 0.71, 1), (2, 11, 0.2, 2), (3, 9, None, 1)], "q long, id long, score double, rank int"
    )
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,)], "q long")
    best = search.best_hit(asked, scored, "q", 0.7).orderBy("q").collect()
    assert [(r.id, r.matched) for r in best] == [(None, False), (10, True), (None, False), (None, False)]
    assert [r.id for r in search.gate(scored, "q", 0.7).orderBy("rank").collect()] == [10, 11]


WORDS = "a b c d e f g h i j".split()


def sentences(seed, n):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(WORDS, rng.integers(0, 12))) for _ in range(n)]


@BOTH
def test_text_search_equals_brute_force(spark, options):
    docs, asks = sentences(1, 200), sentences(2, 40)
    docs[50:120] = ["a b c"] * 70
    d = spark.createDataFrame(list(enumerate(docs)), "id long, t string")
    q = spark.createDataFrame(list(enumerate(asks)), "q long, t string")
    got = hits(search.text_search(d, q, 3, id_col="id", text="t", query_id="q", query_text="t", **options))
    count = lambda s: np.array([s.split().count(w) for w in WORDS])
    expected = brute(range(200), [count(s) for s in docs], range(40), [count(s) for s in asks], 3)
    assert got == [e for e in expected if e[2] and e[2] > 0]


@BOTH
def test_keyword_search_equals_brute_force(spark, options):
    docs, asks = sentences(3, 100), sentences(4, 20)
    d = search.with_term_vector(spark.createDataFrame(list(enumerate(docs)), "id long, t string"), "t")
    q = search.with_term_vector(spark.createDataFrame(list(enumerate(asks)), "q long, t string"), "t")
    got = hits(search.keyword_search(d, q, 3, id_col="id", query_id="q", **options))
    df = {w: sum(w in s.split() for s in docs) for w in WORDS}
    idf = {w: round(np.log(101 / (1 + df[w])) * 1e6) for w in WORDS}
    expected = []
    for j, ask in enumerate(asks):
        scores = [(sum(s.split().count(w) * idf[w] for w in set(ask.split())), i) for i, s in enumerate(docs)]
        top = sorted(((-s, i) for s, i in scores if s > 0))[:3]
        expected += [(j, i, round(-s / 1e6, 9), r + 1) for r, (s, i) in enumerate(top)]
    assert got == sorted(expected)


def test_lsh_recall_and_exact_scores(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    asked = vectors.select(F.col("id").alias("q"), F.col("v").alias("qv"))
    exact = hits(search.topk_dense(vectors, asked, 3, skip_equal=True, **COLUMNS))
    for blocks in ((16384, 4096), (100, 60)):
        near = hits(approximate.topk_lsh(vectors, asked, 3, dim=64, skip_equal=True, blocks=blocks, **COLUMNS))
        found = {h[:3] for h in near} & {h[:3] for h in exact}
        assert len(found) / len(exact) >= 0.9


def test_lsh_finds_copies_in_a_hot_bucket(spark):
    ids = list(range(500))
    a, b = frames(spark, ids, [[1.0, 2.0, 3.0]] * 400 + [[-1.0, 0.5, i / 100] for i in range(100)], [7], [[1.0, 2.0, 3.0]])
    got = hits(approximate.topk_lsh(a, b, 5, dim=3, blocks=(64, 16), **COLUMNS))
    assert [h[1] for h in got] == [0, 1, 2, 3, 4]


def clustered(n=2000, dim=16, centres=40, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((centres, dim))
    return (middle[rng.integers(0, centres, n)] + 0.15 * rng.standard_normal((n, dim))).round(3)


def test_multiprobe_on_clusters_scores_few_pairs(spark, tmp_path):
    vectors = clustered()
    ids = list(range(len(vectors)))
    a, b = frames(spark, ids, vectors, ids, vectors)
    bits = approximate.bits_for(len(ids), 32)
    assert bits == 6 and approximate.bits_for(10) == 1 and approximate.bits_for(10**12) == approximate.MAX_BITS
    probes = approximate.calibrate(a, b, bits, 3, 0.95, skip_equal=True, **COLUMNS)
    approximate.write_signatures(a, str(tmp_path / "index"), "v", bits)
    index = spark.read.parquet(str(tmp_path / "index"))
    assert index.count() == len(ids)
    near = hits(approximate.topk_multiprobe(index, b, 3, bits=bits, probes=probes, skip_equal=True, **COLUMNS))
    exact = hits(search.topk_dense(a, b, 3, skip_equal=True, **COLUMNS))
    assert len({h[:3] for h in near} & {h[:3] for h in exact}) / len(exact) >= 0.95
    visits = approximate.probed(b, "qv", bits, probes)
    pairs = visits.join(index.groupBy("bucket").count(), "bucket").agg(F.sum("count")).first()[0]
    assert pairs < 0.2 * len(ids) ** 2
    assert visits.count() == visits.select("q", "bucket").distinct().count()  # so no pair is scored twice


def test_multiprobe_in_all_buckets_is_exact_and_cuts_hot_ones(spark):
    vectors = clustered(300)
    vectors[:120] = vectors[0]
    vectors[7] = 0
    ids = list(range(300))
    a, b = frames(spark, ids, vectors, ids[:40], vectors[:40])
    a = a.unionByName(spark.createDataFrame([(900, None)], a.schema))
    signed = approximate.with_bucket(a, "v", 3)
    for blocks in ((16384, 16384), (20, 8)):
        got = hits(approximate.topk_multiprobe(signed, b, 3, bits=3, probes=8, blocks=blocks, **COLUMNS))
        assert got == brute(ids, vectors, ids[:40], vectors[:40], 3)
    assert approximate.topk_multiprobe(signed.limit(0), b, 3, bits=3, probes=8, **COLUMNS).count() == 0


@pytest.mark.parametrize("table", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_multiprobe_recall_of_the_query(spark, table):
    from corpusq.plans import queries

    vectors = spark.read.parquet(f"{table}/embeddings.parquet")
    asked = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    exact = search.topk_dense(vectors, asked, 3, skip_equal=True, **queries._VECTOR_COLUMNS)
    near = queries.topk_multiprobe(spark, table)
    pairs = lambda df: {(r.query_id, r.vec_id) for r in df.collect()}
    truth = pairs(exact)
    assert len(pairs(near) & truth) / len(truth) >= 0.9


def test_embedding_with_injected_encoder(spark):
    embed = index.encoder_udf(lambda: lambda texts: np.array([[len(t), 1] for t in texts]))
    df = spark.createDataFrame([("abc",), (None,)], "t string").select(embed(F.col("t")).alias("e"))
    assert [r.e for r in df.collect()] == [[3.0, 1.0], [0.0, 1.0]]


def test_embed_hashed_is_unit_length(spark):
    df = index.embed_hashed(spark.createDataFrame([("a b a",), ("",)], "t string"), "t", 16)
    lengths = [round(sum(x * x for x in r.embedding), 5) for r in df.collect()]
    assert lengths == [1.0, 0.0]


def test_index_rejects_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id long, t string")
    with pytest.raises(ValueError, match="not unique"):
        index.build_index(df, "id", "t")


def test_sync_embeds_only_changes_and_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, t string")
    built = index.build_index(base, "id", "t")
    source = spark.createDataFrame([(2, "b"), (3, "C2"), (4, "d")], "id long, t string")
    assert sorted(r.id for r in index.changed_keys(built, source, "id", "t").collect()) == [3, 4]
    gone = spark.createDataFrame([(1,)], "id long")
    once = index.sync_index(built, source, "id", "t", deleted=gone)
    twice = index.sync_index(once, source, "id", "t", deleted=gone)
    expected = sorted(map(str, index.build_index(source, "id", "t").collect()))
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect())) == expected


def test_stored_index_reads_only_the_shards_of_hits(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    asked = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", F.col("text").alias("question"))
    path = str(tmp_path / "index")
    index.write_index(index.build_index(docs, "doc_id", "text", ["lang"]), path, "doc_id", 16)
    stored = spark.read.parquet(path)
    queries = search.with_term_vector(asked, "question")
    found = search.topk_sparse(stored, queries, 3, id_col="doc_id", query_id="item_id")
    top = found.filter("rank = 1 AND score > 0.5")
    got = search.attach_columns(top, stored, "doc_id", ["text"], shards=16)
    assert "dynamicpruning" in plan(got) and "MapInArrow" in plan(got)
    inline = search.text_search(docs, asked, 3, id_col="doc_id", text="text", query_id="item_id", query_text="question")
    plain = search.attach_columns(inline.filter("rank = 1 AND score > 0.5"), docs, "doc_id", ["text"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect())) and got.count() > 0


# --- plans ----------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    asked = vectors.select(F.col("vec_id").alias("q"), F.col("embedding").alias("qv"))
    text = plan(search.topk_dense(vectors, asked, 3, filters={"label": 3}, id_col="vec_id", vector="embedding",
                                  query_id="q", query_vector="qv"))
    assert "EqualTo(label,3)" in text and "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_blocked_search_has_no_join(spark, data):
    a, b = frames(spark, *data)
    text = plan(search.topk_dense(a, b, 3, max_broadcast=4, **COLUMNS))
    assert "FlatMapCoGroupsInArrow" in text and "Join" not in text


def test_no_query_builds_a_cross_join_or_row_udf(spark, sf):
    import __spark_entry__ as entry

    for name, query in entry.queries().items():
        text = plan(query(spark, sf))
        for bad in ("CartesianProduct", "NestedLoop", "BatchEvalPython"):
            assert bad not in text, (name, bad)


def test_vectors_are_built_once_per_pass(spark, sf):
    from corpusq.plans.queries import registry

    text = plan(registry()["text_search"](spark, sf))
    assert text.count("regexp_extract_all(") == 1 and "Filter isnotnull(transform" not in text


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<float>")


def _dense(spark, rows, asked, **options):
    queries = _vectors(spark, asked).withColumnsRenamed({"id": "q", "v": "qv"})
    hits = search.topk_dense(_vectors(spark, rows), queries, 5, id_col="id", vector="v", query_id="q", query_vector="qv", **options)
    return [(r.q, r.id, r.score) for r in hits.orderBy("q", "rank").collect()]


def test_vectors_of_different_length_are_refused(spark):
    for rows, asked in (
        ([(1, [1.0, 0.0, 0.0]), (2, [1.0] * 5)], [(9, [1.0, 0.0, 0.0])]),
        ([(1, [1.0, 0.0, 0.0])], [(9, [1.0, 0.0])]),
    ):
        with pytest.raises(Exception, match="vectors differ in length"):
            _dense(spark, rows, asked)


def test_vectors_without_direction_rank_last(spark):
    rows = [(1, [float("nan"), 1.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (None, [1.0, 0.0]), (4, None), (5, [float("inf"), 0.0])]
    assert _dense(spark, rows, [(9, [2.0, 0.0])]) == [(9, 2, 1.0), (9, 1, None), (9, 3, None), (9, 5, None)]


def test_text_search_filters_and_returns_columns(spark):
    docs = spark.createDataFrame([(1, "red fox", "en"), (2, "red fox", "de"), (3, "blue", "en")], "id long, t string, lang string")
    asked = spark.createDataFrame([(7, "red")], "q long, x string")
    kwargs = {"id_col": "id", "text": "t", "query_id": "q", "query_text": "x", "filters": {"lang": "de"}, "columns": ["lang"]}
    for encode in (None, index.hashed_encoder(32)):
        hits = search.text_search(docs, asked, 3, encode=encode, **kwargs)
        assert [(r.q, r.id, r.lang) for r in hits.collect()] == [(7, 2, "de")]


def sparse_block(rng, rows, terms):
    """Rows of skewed terms, with empty rows, copies, rows without a norm and very frequent terms."""
    vectors = [np.unique((terms * rng.random(rng.integers(0, 12)) ** 3).astype(np.int32)) for _ in range(rows)]
    weights = [rng.integers(1, 4, len(v)).astype(float) for v in vectors]
    for i in range(0, rows // 3):
        vectors[i], weights[i] = vectors[rows - 1], weights[rows - 1]
    norms = np.array([(w * w).sum() for w in weights])
    norms[rows // 2] = 0
    offsets = np.append(0, np.cumsum([len(v) for v in vectors]))
    return blocks.SparseBlock(np.arange(rows), offsets, np.concatenate(vectors), np.concatenate(weights), norms)


@pytest.mark.parametrize("k", [1, 3, 40])
def test_rows_laid_out_by_term_give_the_same_top_k(k, monkeypatch):
    monkeypatch.setattr(blocks, "_LONG", 20)
    monkeypatch.setattr(blocks, "_PAIRS", 500)
    monkeypatch.setattr(blocks, "_RUN", 16)
    rng = np.random.default_rng(k)
    index_block, asked = sparse_block(rng, 700, 400), sparse_block(rng, 300, 500)
    top = blocks.TopK("sparse", asked, k, keep_zero=False)
    top.add(index_block)
    kept = blocks.first_copies(index_block, k)
    assert 700 - 700 // 3 + k - 1 >= len(kept) and np.array_equal(blocks.first_copies(index_block, 700), np.arange(700))
    found = [np.concatenate(c) for c in zip(*blocks.TermIndex(index_block, asked, k), strict=True)]
    assert all(np.array_equal(a, b) for a, b in zip(found, top.parts[0][2], strict=True))


def test_term_blocks_meet_in_rounds_of_stored_results(spark, monkeypatch):
    monkeypatch.setattr(search, "ROUND_GROUPS", 3)
    words = [f"w{int(30 * r ** 2)}" for r in np.random.default_rng(3).random(3000)]
    texts = [" ".join(words[i : i + 12]) for i in range(0, 2400, 12)]
    rows = [(i, t if i % 9 else texts[0]) for i, t in enumerate(texts)] + [(900, None), (None, "w1"), (901, "")]
    docs = spark.createDataFrame(rows, "id long, text string")
    asked = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts[:50])] + [("none", ""), (None, "w1")], "q string, ask string")
    names = {"id_col": "id", "text": "text", "query_id": "q", "query_text": "ask"}
    whole = search.text_search(docs, asked, 3, **names)
    parts = search.text_search(docs, asked, 3, max_broadcast=10, blocks=(40, 20), **names)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))
    # What met in a round is on disk as k rows per query; no pair of blocks is left for the plan, nor its shuffles.
    assert "FlatMapCoGroupsInArrow" not in parts._jdf.queryExecution().toString()
