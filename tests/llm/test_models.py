"""Decontamination, near duplicates, pieces, classifiers and the pipeline against plain Python."""

import hashlib
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import clashing, frame, odd_rows, sentence, words

import corpus_pipeline
from corpusq.llm import components, decontaminate, jaccard, pieces, queries, ranking, toxicity
from test_filters import base_findings, measures


def brute_windows(items, n=10):
    wins = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - n, 0) + 1 if w else 0):
            wins[tuple(w[i : i + n])].add(str(item))
    return wins


def brute_hits(text, wins):
    w, hit, items = words(text), set(), set()
    for n in {len(x) for x in wins}:
        for i in range(len(w) - n + 1):
            found = wins.get(tuple(w[i : i + n]))
            if found:
                hit.update(range(i, i + n))
                items |= found
    return len(w), hit, sorted(items)


ITEMS = [(1, sentence(1, 25)), (2, "Short, item!"), (3, None), (4, ""), (5, sentence(5, 10)), (5, sentence(5, 10)), (6, "été ñandú 日本")]


def contaminated_rows():
    a, b = ITEMS[0][1], ITEMS[4][1]
    bits = a.split(" ")
    return [
        (100, f"x {a.upper()} y", "en", "a", 0), (101, " ".join(bits[3:14]), "en", "a", 0), (102, " ".join(bits[3:12]), "en", "a", 0),
        (103, f"{b} {b}. a short-item of", "en", "a", 0), (104, " ".join(bits[:9]), "en", "a", 0), (105, " ".join(bits[9:]), "en", "a", 0),
        (106, "short item", "en", "a", 0), (107, "short. Item", "en", "a", 0), (108, "item short", "en", "a", 0), (109, "Été ñandú 日本 x", "fr", "a", 0),
        (109, "été ñandú 日本 x", "fr", "a", 0),
    ]


def test_search_equals_brute_force(spark):
    rows = contaminated_rows() + odd_rows()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    index = decontaminate.build_index(clashing(frame(spark, rows)), segment_bytes=600)
    assert index.filter("term IS NULL").count() > 2
    got = decontaminate.search(index, decontaminate.item_windows(items)).collect()
    wins = brute_windows(ITEMS)
    want = Counter()
    for r in rows:
        n, hit, found = brute_hits(r[1], wins)
        want[(r[0], n, len(hit), tuple(found))] += 1
    assert Counter((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    spans = {r.id: [tuple(s) for s in r.spans] for r in got}
    assert spans[100] == [(1, 26)] and spans[103] == [(0, 20), (21, 23)]


def test_search_without_items_or_documents(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    index = decontaminate.build_index(frame(spark, contaminated_rows()))
    none = decontaminate.search(index, decontaminate.item_windows(items.limit(0)))
    assert {(r.n_hit, len(r["items"])) for r in none.collect()} == {(0, 0)} and none.count() == 11
    assert decontaminate.search(decontaminate.build_index(frame(spark, [])), decontaminate.item_windows(items)).count() == 0


@given(st.lists(st.integers(0, (1 << 35) - 1) | st.integers(0, 300), max_size=50))
def test_packed_values_come_back(values):
    data, sizes = decontaminate.packed(np.array(values, np.int64))
    assert list(decontaminate.unpacked(data.tobytes())) == values and len(sizes) == len(values)
    assert data.size == sum(max(1, -(-v.bit_length() // 7)) for v in values)


def test_proximity_matches(spark):
    rows = [(1, "alpha x x beta x gamma", "", "", 0), (2, "gamma beta alpha", "", "", 0), (3, "alpha " + "x " * 30 + "beta gamma", "", "", 0)]
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index = decontaminate.build_index(frame(spark, rows))
    got = {r.id: (r.n_hit, r.n_near) for r in decontaminate.search(index, decontaminate.item_windows(items)).collect()}
    assert got == {1: (0, 1), 2: (0, 1), 3: (0, 0)}


def test_op3_columns(spark, sf):
    wins = brute_windows([tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op3_positional_index(spark, sf).collect():
        n, hit, found = brute_hits(docs[r.doc_id], wins)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, len(hit), len(found), digest, bool(hit))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 5, 0) + 1)} if w else set()


def brute_classes(rows):
    """``{(id, text): (class, links, copies)}`` by comparing all pairs of texts."""
    by_text = defaultdict(list)
    for r in rows:
        by_text[r[1]].append(r[0])
    texts = [t for t in by_text if shingles(t)]
    sets = {t: shingles(t) for t in texts}
    parent, links = {t: t for t in texts}, Counter()

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            both = len(sets[a] & sets[b])
            if both and both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    ids = defaultdict(list)
    for t in texts:
        ids[find(t)] += [i for i in by_text[t] if i is not None]
    out = {}
    for t, own in by_text.items():
        for i in own:
            known = t in parent
            out[i, t] = (min(ids[find(t)], default=None), links[t], len(own)) if known else (i, 0, 1)
    return out


def changed(text, at):
    w = text.split(" ")
    w[at % len(w)] = f"changed{at}"
    return " ".join(w)


def near_rows():
    rows = [(i, sentence(i, 60), "en", "a", 0) for i in range(40)]
    base = sentence(1_000, 120)
    rows += [(100 + i, changed(base, i), "en", "a", 0) for i in range(120)]
    rows += [(300 + i, base, "en", "a", 0) for i in range(5)]
    chain = sentence(2_000, 80)
    for i in range(6):
        chain = changed(chain, 7 + 13 * i)
        rows.append((400 + i, chain, "en", "a", 0))
    rows += [(500, "one two three", "en", "a", 0), (501, "One, two. THREE", "en", "a", 0), (502, "one two three four five", "en", "a", 0)]
    return rows


def test_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_NODES", 16)
    rows = near_rows() + odd_rows()
    want = brute_classes(rows)
    got = jaccard.near_duplicates(clashing(frame(spark, rows))).collect()
    assert Counter(r.id for r in got) == Counter(r[0] for r in rows)
    per_id = defaultdict(set)
    for (i, _), value in want.items():
        per_id[i].add(value)
    for r in got:
        assert (r.class_id, r.n_links, r.n_copies) in per_id[r.id], r
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0


def test_classes_without_broadcast_are_the_same(spark, monkeypatch):
    rows = near_rows()
    order = lambda df: sorted(map(tuple, df.collect()))
    one = order(jaccard.near_duplicates(frame(spark, rows)))
    monkeypatch.setattr(jaccard, "BROADCAST_NODES", 0)
    assert order(jaccard.near_duplicates(frame(spark, rows))) == one


def test_op4_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {i: v for (i, _), v in brute_classes(rows).items()}
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in queries.op4_lsh_forest(spark, sf).collect()} == want


def test_prefixes_are_shortened_for_weak_links():
    p = [jaccard._found(0.8, d, jaccard.TREES) for d in range(jaccard.DEPTH, jaccard.LEAST_DEPTH - 1, -1)]
    assert p == sorted(p) and p[0] < jaccard.RECALL < p[-1]


def test_hot_group_of_close_copies_does_not_hide_a_weak_pair(spark):
    rng = np.random.default_rng(5)
    size = jaccard.TREES * jaccard.DEPTH
    base, weak = rng.integers(0, 1 << 32, (2, size), np.uint32)
    rows = [(b"\0", base.tobytes())]
    for i in range(60):  # 0.89 alike the hub, and found by 14 whole trees
        copy = base.copy()
        copy[:14] = rng.integers(0, 1 << 32, 14, np.uint32)
        rows.append((b"h%d" % i, copy.tobytes()))
    other = weak.copy()  # 0.875 alike, and no prefix of over four in common
    other[4 :: jaccard.DEPTH] += np.uint32(1)
    rows += [(b"x", weak.tobytes()), (b"y", other.tobytes())]
    texts = spark.createDataFrame(rows, "node binary, signature binary")
    links = jaccard.forest_links(texts, jaccard.THRESHOLD, jaccard.RECALL).collect()
    assert {(bytes(r.node), bytes(r.hub)): r.similarity for r in links}[b"y", b"x"] == 0.875
    assert sum(bytes(r.hub) == b"\0" for r in links) == 60


@pytest.mark.parametrize("start", ["", "a", "word "])
def test_long_words_equal_the_library(model, library, start):
    rng = np.random.default_rng(3)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    chinese = np.array([chr(c) for c in range(0x4E00, 0x9000)])
    drawn = [rng.choice(a, n) for a in (letters, chinese) for n in (640, 641, 5_000, 100_000)]
    texts = [start + "".join(x) for x in drawn]
    begin = time.perf_counter()
    got = pieces.encode_texts(model, pa.array(texts)).to_pylist()
    assert time.perf_counter() - begin < 20
    texts = [start + "a" * 1_001, start + "the" * 2_000, start + "=-" * 3_000 + "x"]
    got += pieces.encode_texts(model, pa.array(texts)).to_pylist()
    texts = [start + "".join(x) for x in drawn] + texts
    assert got == [library.encode(x) for x in texts]


def test_blocks_that_do_not_meet_are_encoded_in_order(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "LONG_BLOCK", 37)
    monkeypatch.setattr(pieces, "LONG_WARM", 1)
    for text in ("a" * 500, "ab" * 300, "internationalization" * 40, "0" * 333):
        assert pieces.encode_texts(model, pa.array([text])).to_pylist() == [library.encode(text)]


def test_recall_at_low_thresholds(spark):
    """Pairs a little above the threshold, among texts that share branches of short prefixes."""
    rng = np.random.default_rng(11)
    for threshold in (0.5, 0.6, 0.7, 0.8):
        rows, n = [], 200
        for i in range(n):
            size = 120
            common = int(np.ceil(2 * size * (threshold + 0.01) / (1 + threshold + 0.01)))
            runs = rng.integers(0, 1 << 62, 2 * size, np.int64).astype(str)
            one = list(runs[:size])
            two = one[:common] + list(runs[size : 2 * size - common])
            rows += [(2 * i, " ".join(one), "en", "a", 0), (2 * i + 1, " ".join(two), "en", "a", 0)]
        got = {r.id: r.class_id for r in jaccard.near_duplicates(frame(spark, rows), threshold=threshold, shingle=1).collect()}
        assert sum(got[2 * i + 1] == 2 * i for i in range(n)) == n, threshold
        assert all(got[2 * i] == 2 * i for i in range(n))


def test_recall_out_of_reach_is_refused():
    with pytest.raises(ValueError, match="recall"):
        jaccard.shortened(0.3, jaccard.RECALL)
    assert jaccard._found(0.5, jaccard.shortened(0.5, jaccard.RECALL), jaccard.TREES) >= jaccard.RECALL


def test_equal_rows_reach_the_verification_once(spark, monkeypatch):
    text = sentence(77, 200)
    rows = [(None, text, "en", "a", 0)] * 3_000 + [(1, changed(text, 9), "en", "a", 0)]
    sizes = spark.sparkContext.accumulator(0)
    verify = jaccard._verify

    def counted(table, threshold):
        sizes.add(table.num_rows)
        return verify(table, threshold)

    monkeypatch.setattr(jaccard, "_verify", counted)
    got = Counter((r.id, r.class_id, r.n_links, r.n_copies) for r in jaccard.near_duplicates(frame(spark, rows)).collect())
    assert got == {(None, 1, 1, 3_000): 3_000, (1, 1, 1, 1): 1}
    assert sizes.value == 2


def test_depth_reaches_the_recall_at_the_threshold():
    for threshold in (0.8, 0.9, 0.95):
        d = jaccard.shortened(threshold, jaccard.RECALL)
        assert jaccard._found(threshold, d, jaccard.TREES) >= jaccard.RECALL


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1_000, 1_200)]
    edges += [(5_000, i) for i in range(5_001, 5_200)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    want = {x: find(x) for x in parent}
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    assert got == want
    assert components.connected_components(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(queries.MODEL_PATH, "bpe")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_PATH)


ODD_TEXTS = [
    "  hello  wörld ﬁ\t\n x½ ", "", " ", "a", "     five", "日本語テキスト\0 🎉🎉 test", "x" * 200, "aaaa aaaaa aaaaaa", "   \n   ",
    "int main() {\n    return 0;\n}\n        x", "==== ----- ......", "1234567890 000000", "https://example.com/a_b?c=d&e=f", "́é",
]


def test_ids_equal_the_library(spark, sf, model, library):
    texts = ODD_TEXTS + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = pieces.encode_texts(model, pa.array(texts))
    assert got.to_pylist() == library.encode(texts)
    assert pieces.decode_lists(model, got).to_pylist() == texts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="▁"), max_size=30), max_size=6))
def test_random_texts_equal_the_library(model, library, texts):
    got = pieces.encode_texts(model, pa.array(texts, pa.string()))
    assert got.to_pylist() == (library.encode(texts) if texts else [])
    assert pieces.decode_lists(model, got).to_pylist() == texts


def brute_unigram(word, scores, worst):
    best = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            piece = word[start:end]
            score = scores.get(piece, worst if end - start == 1 else None)
            if best[start] and score is not None and (not best[end] or best[start][0] + score > best[end][0]):
                best[end] = (best[start][0] + score, [*best[start][1], piece])
    return best[-1][0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abcz", min_size=1, max_size=9), min_size=1, max_size=5))
def test_unigram_viterbi_has_the_best_score(texts):
    table = {"a": -2.0, "b": -2.5, "c": -3.0, "ab": -3.1, "abc": -4.0, "bc": -3.3, "ca": -6.0, "▁": -2.0, "▁a": -2.2, "cab": -4.9}
    names = ["<unk>", *table]
    model = pieces.build_model(names, [0.0, *table.values()], list(range(1, len(names))), 0, {}, "unigram")
    worst = min(model.scores) - 10
    for text, ids in zip(texts, pieces.encode_texts(model, pa.array(texts)).to_pylist(), strict=True):
        total = sum(model.scores[i] if i else worst for i in ids)
        assert total == pytest.approx(brute_unigram("▁" + text, table, worst))
        if 0 not in ids:
            assert pieces.decode_lists(model, pa.array([ids], pa.list_(pa.int32()))).to_pylist() == [text]


def test_encode_takes_odd_rows(spark, model, library):
    rows = odd_rows()
    got = pieces.encode(clashing(frame(spark, rows)), model)
    want = sorted(((r[0], library.encode(r[1] or "")) for r in rows), key=str)
    assert sorted(((r.id, list(r.ids)) for r in got.collect()), key=str) == want
    assert got.filter("NOT restored OR n_tokens != size(ids)").count() == 0
    texts = sorted(((r.id, r.text) for r in pieces.decode(got, model).collect()), key=str)
    assert texts == sorted(((r[0], r[1] or "") for r in rows), key=str)
    assert pieces.encode(frame(spark, []), model).count() == 0


def accuracy(spark, sf, query, label):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = query(spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    parts, part = (4, 2) if label == "toxic" else (5, 0)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == part) for r in rows)
    return np.mean([r.predicted == r[label] for r in held]), np.mean([r[label] == 0 for r in held])


def test_toxicity_on_held_out_rows(spark):
    right, base = accuracy(spark, "/root/testdata/sf0.1", queries.op7_convolution, "toxic")
    assert right > 0.95 and right > base


def test_quality_on_held_out_rows(spark, sf):
    right, _ = accuracy(spark, "/root/testdata/sf0.01", queries.op10_pairwise_ranking, "quality")
    assert right > 0.95


def test_scores_do_not_read_labels_or_names(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.train(docs, labels)
    other = docs.select("doc_id", "text", F.lit("xx").alias("lang"))
    scores = lambda df: sorted((r.id, r.score) for r in toxicity.score(df, model).collect())
    assert scores(docs) == scores(other)


def test_classifiers_take_odd_rows(spark):
    docs = clashing(frame(spark, odd_rows()))
    labels = spark.createDataFrame([(1, 1, 0), (5, None, None), (None, 1, 1), (6, 0, 1), (6, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    for rows in (docs, docs.limit(0)):
        for own in (labels, labels.limit(0)):
            tox = toxicity.score(rows, toxicity.train(rows, own)).collect()
            rank = ranking.score(rows, ranking.train(rows, own)).collect()
            assert len(tox) == len(rank) == rows.count()
            assert all(0 <= r.score <= 1 for r in [*tox, *rank])


def test_score_is_a_function_of_the_text_alone():
    rng = np.random.default_rng(3)
    texts = [rng.integers(1, 40, n).astype(np.int32) for n in (5, 0, 1, 2, 30, 3, 0)]
    filters = [rng.standard_normal((w, 4, 6)).astype(np.float32) for w in toxicity.WIDTHS]
    biases = [rng.standard_normal(6).astype(np.float32) for _ in toxicity.WIDTHS]
    embed = rng.standard_normal((40, 4)).astype(np.float32)
    embed[0] = 0
    model = toxicity.ConvModel(np.arange(40, dtype=np.int32), embed, filters, biases, rng.standard_normal(6 * len(biases)), 0.1)
    score = lambda own: toxicity._logits(model, np.concatenate(own), np.array([len(t) for t in own]))
    alone = np.concatenate([score([t]) for t in texts])
    assert np.allclose(score(texts), alone, atol=1e-6)
    assert np.allclose(score(texts[::-1])[::-1], alone, atol=1e-6)
    # Against a plain version: all windows over the text followed by zeros.
    for t, got in zip(texts, alone):
        x = np.vstack([embed[t], np.zeros((3, 4))])
        tops = [np.maximum(np.max([sum(x[i + k] @ w[k] for k in range(len(w))) + b for i in range(len(t) + 1)], axis=0), 0) for w, b in zip(filters, biases)]
        assert abs(np.concatenate(tops) @ model.out + model.offset - got) < 1e-4


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    params = {"embed": rng.normal(0, 1, (6, 3)), "out": rng.normal(0, 1, 6), "offset": np.array([0.1])}
    params["embed"][0] = 0
    for k, w in enumerate(toxicity.WIDTHS):
        params[f"w{k}"], params[f"b{k}"] = rng.normal(0, 1, (w, 3, 2)), rng.normal(0, 1, 2)
    texts, labels = [np.array([1, 2, 3, 4]), np.array([5, 1]), np.array([], int)], np.array([1.0, 0.0, 1.0])

    def loss():
        filters, biases = [params[f"w{k}"] for k in range(3)], [params[f"b{k}"] for k in range(3)]
        model = toxicity.ConvModel(None, params["embed"], filters, biases, params["out"], float(params["offset"][0]))
        z = toxicity._logits(model, np.concatenate(texts), np.array([len(t) for t in texts]))
        p = 1 / (1 + np.exp(-z))
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)) + 5e-5 * (params["out"] ** 2).sum()

    grads = toxicity._gradients(params, texts, labels, 2)
    for name, g in grads.items():
        for at in np.ndindex(g.shape):
            if name == "embed" and at[0] == 0:
                continue  # row 0 stays zero
            keep = params[name][at]
            params[name][at] = keep + 1e-6
            up = loss()
            params[name][at] = keep - 1e-6
            down = loss()
            params[name][at] = keep
            assert g[at] == pytest.approx((up - down) / 2e-6, abs=1e-5), (name, at)


def test_pairs_order_by_the_learned_weights():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (400, len(ranking.NAMES)))
    labels = (x[:, 0] - x[:, 1] > -1).astype(float)
    model = ranking.fit(x, labels)
    raw = model.raw(x)
    assert np.mean((raw >= model.cut) == labels) > 0.95


def test_ranking_learns_from_every_labelled_row(spark, monkeypatch):
    n = 20_600  # more than a former sample held
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('ab ', cast(id % 9 as int))").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 9 > 3).cast("int").alias("quality"))
    model = ranking.train(docs, labels)
    sizes = np.log1p(3 * (np.arange(n) % 9))
    assert model.mean[0] == pytest.approx(sizes.mean(), rel=1e-12)
    rows = ranking.score(docs, model).collect()
    assert np.mean([r.kept == (r.id % 9 > 3) for r in rows]) > 0.99


def test_ranking_measures_texts_before_labels_join(spark, monkeypatch):
    plans, written = {}, ranking.written

    def watched(frame, name):
        plans[name] = frame._jdf.queryExecution().optimizedPlan().toString()
        return written(frame, name)

    monkeypatch.setattr(ranking, "written", watched)
    docs = spark.createDataFrame([(n, "ab " * (n % 5)) for n in range(60)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(n, int(n % 5 > 2)) for n in range(60)] + [(None, 1)], "doc_id long, quality int")
    ranking.train(docs, labels)
    plan = plans["measures"]
    assert 0 <= plan.index("Join Inner") < plan.index("log_chars", plan.index("Join Inner")) < plan.index("split(")


def test_blocks_of_pairs_hold_every_row(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_ROWS", 32)
    monkeypatch.setattr(ranking, "LEAST_SCARCE", 4)
    values = [f"cast(id as double) AS {name}" for name in ranking.NAMES]
    table = spark.range(400).selectExpr("id AS _id", "cast(id % 20 = 0 as double) AS _label", *values)
    blocks = [(np.array(r.x).reshape(-1, len(ranking.NAMES)), np.array(r.y)) for r in ranking._blocks(table, 20, 380, 7).collect()]
    assert len(blocks) > 5 and all(len(ranking.differences(x, y)) >= (y == 0).sum() for x, y in blocks)
    bad = sorted(int(v) for x, y in blocks for v in x[y == 0, 0])
    assert bad == [i for i in range(400) if i % 20]
    assert {int(v) for x, y in blocks for v in x[y == 1, 0]} == set(range(0, 400, 20))


def test_toxicity_learns_from_every_labelled_row(spark):
    n = 12_400  # more than a former sample held
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("a").alias("text"))
    model = toxicity.train(docs, docs.select("doc_id", F.lit(0).alias("toxic")))
    assert float(model.probability(np.array([model.offset]))[0]) == pytest.approx(0.1 / (n + 1), rel=1e-9)


def test_parts_train_one_model(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART_ROWS", 150)
    text = F.expr("concat_ws(' ', concat('w', id % 40), if(id % 4 = 0, 'vile', 'kind'), concat('x', id % 30))")
    docs = spark.range(1_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), text.alias("text"))
    model = toxicity.train(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")))
    scores = {r.id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(scores[i] for i in range(0, 1_000, 4)) > 0.9 and max(v for i, v in scores.items() if i % 4) < 0.1
    assert 0 < model.threshold < 1 and set(model.thresholds) == {"en"}


def test_parts_send_the_words_they_changed(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART_ROWS", 150)
    seen, average = [], toxicity._averaged
    monkeypatch.setattr(toxicity, "_averaged", lambda params, found, *a: seen.append((len(params["embed"]), found)) or average(params, found, *a))
    words = F.expr("concat_ws(' ', transform(sequence(1, 400), i -> concat('w', pmod(hash(id, i), 20000))))")
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.concat(words, F.expr("if(id % 4 = 0, ' vile', ' kind')")).alias("text"))
    toxicity.train(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")))
    assert len(seen) == toxicity.EPOCHS and all((found["place"].to_numpy() > 0).sum() < 0.8 * n for n, found in seen)


def test_unchanged_words_count_in_the_average():
    rng = np.random.default_rng(3)
    before = {"embed": rng.normal(size=(5, toxicity.DIMENSIONS)), "out": rng.normal(size=3)}
    before["embed"][0] = 0
    parts = [(np.array([0, 1, 2]), 3, [1]), (np.array([0, 1, 3]), 5, [])]  # rows that a part holds, its texts, what it changes
    sent, whole = [], np.zeros((5, toxicity.DIMENSIONS))
    for own, n, changed in parts:
        after = {"embed": before["embed"][own].copy(), "out": before["out"] + n}
        after["embed"][[list(own).index(c) for c in changed]] += n
        whole[own] += n * after["embed"].astype(np.float32).astype(float)
        sent.append(toxicity._trained_rows(own, before, after, n).to_pandas())
    assert [(r.place > 0).sum() for r in sent] == [1, 0]
    rows = pd.concat(sent)
    values = [f"v{d}" for d in range(toxicity.DIMENSIONS)]
    rows[values] = rows[values].astype(float).mul(rows["n"], axis=0)
    held = np.array([0, 8, 3, 5, 0])
    found = toxicity._averaged(before, pa.Table.from_pandas(rows.groupby("place", as_index=False).sum()), held)
    assert found["embed"][1:4] == pytest.approx(whole[1:4] / held[1:4, None], rel=1e-12)
    assert (found["embed"][4] == before["embed"][4]).all()
    assert found["out"] == pytest.approx(before["out"] + (3 * 3 + 5 * 5) / 8, rel=1e-6)


def test_texts_without_a_label_go_before_they_are_read(spark):
    for column in ("id - 500", "cast(id AS string)", "cast(id AS double) / 3"):
        rows = spark.range(4_000).select(F.expr(column).alias("_id"), F.lit("text").alias("_text"))
        chosen = rows.filter("pmod(hash(_id), 20) = 0").select("_id")
        kept = toxicity._sifted(rows.unionByName(rows.limit(10).withColumn("_id", F.lit(None).cast(rows.schema["_id"].dataType))), chosen)
        assert chosen.join(kept, "_id", "left_anti").count() == 0
        assert chosen.count() <= kept.count() < chosen.count() + 20
    assert toxicity._sifted(rows, spark.range(3).toDF("_id")).count() == 4_000  # ids of another type


def test_encoding_holds_few_texts_at_once(spark, monkeypatch):
    """A worker keeps what its largest run needed, also while it waits for other steps."""
    seen, run = [], pieces.map_arrow
    monkeypatch.setattr(pieces, "map_arrow", lambda df, f, schema, size: seen.append(size) or run(df, f, schema, size))
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    rows = pieces.encode(docs, pieces.load_model(queries.MODEL_PATH, "bpe")).collect()
    assert len(rows) == 2 and all(r.restored for r in rows) and max(seen) <= 4 << 20


def brute_pipeline(spark, sf):
    """The stages up to the texts, in plain Python; no line of the fixture is frequent enough to go."""
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    kept = []
    for i, text in docs:
        m = measures(text)
        if m["n_words"] >= 50 and 100 * m["n_repeat_words"] <= 50 * m["n_words"]:
            kept.append((i, text))
    classes = brute_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i, t][0] == i]
    wins = brute_windows([tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    return {i: t for i, t in kept if not brute_hits(t, wins)[1]}


def test_pipeline_equals_brute_force(spark, sf, library):
    want = brute_pipeline(spark, sf)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(want)
    for i, text in want.items():
        if not base_findings(text):
            assert list(got[i].ids) == library.encode(text)
    assert all(r.restored for r in got.values())


def test_stages_take_odd_rows(spark, sf):
    rows = odd_rows() + [(50 + i, sentence(i, 80), "en", "a", 0) for i in range(3)] + [(60, sentence(0, 80), "en", "a", 0)]
    for docs in (clashing(frame(spark, rows)), frame(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            count = out.count()
            assert count <= docs.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert tuple(out.columns) == corpus_pipeline.COLUMNS
                near = {r.doc_id for r in out.collect()}
                assert docs.count() == 0 or {50, 51, 52} <= near
                assert ("Jaccard" in name and 60 in near) is False
