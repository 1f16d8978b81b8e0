"""Token counts against the libraries themselves."""

import duckdb
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import clashing, frame, odd_rows, sentence

from corpusq.llm import queries, tokencache
from corpusq.llm.common import scratch_path


@pytest.fixture(scope="module")
def counter():
    return tokencache.load_counter(queries.TOKENIZER_PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.TOKENIZER_PATH)


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


ODD = [
    "<|endoftext|>", "<|ENDOFTEXT|> a", "x<|startoftext|>y  <| z", "J̌ and ǰ", "İİ ẞ ΑΣ Σ", "a\x85b\xa0c d\x1ce",
    "  Two   words\t\n\x0b\x0c\r x ", "DON'T don'T I'M he'LL", "ÀÉÎÕÜ Þ ß µ ÿ", "“quoted” – dash…", "日本語 テキスト", "🎉🎉 x", "1234 5.6", "́ a", "éÉ",
]


def rows():
    long = sentence(4, 40_000)
    texts = [*ODD, "Same  TEXT here.", "same text HERE.", " same text here. ", long, long.upper(), "a" * 200_000, "<|endoftext|> " + long]
    return [*odd_rows(), *[(1_000 + i, t, "en", "a", 0) for i, t in enumerate(texts)], *[(5, "hot copy", "en", "a", 8)] * 300]


def test_counts_equal_the_library(spark, counter, library):
    docs = rows()
    got = tokencache.count_tokens(clashing(frame(spark, docs)), counter, scratch_path(spark, "cache"))
    order = lambda rs: sorted(rs, key=str)
    assert order(map(tuple, got.collect())) == order((r[0], len((r[1] or "").encode()), count(library, r[1])) for r in docs)
    assert tokencache.count_tokens(frame(spark, []), counter, scratch_path(spark, "cache")).count() == 0


TEXT = st.text(st.sampled_from("aAjJ éÉß'sT.,;ª²½µÿ×÷12#  \t\n\x0b\x85\xa0<|endoftext|>̱̌İıΣ“–9.,日") | st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=40)


def test_normal_forms_have_the_same_count(spark, counter, library):
    found = []

    @settings(max_examples=600, deadline=None, database=None)
    @given(TEXT)
    def collect(text):
        found.append(text)

    collect()
    found += ODD
    assert counter.folds
    got = spark.createDataFrame([(t,) for t in found], "text string").select("text", tokencache.normal_form(F.col("text"), True).alias("form")).collect()
    for r in got:
        assert count(library, r.form) == count(library, r.text), repr(r.text)
    assert sum(r.form != r.text for r in got) > 50


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT.map(lambda t: t * 4), max_size=6))
def test_words_add_up(counter, library, texts):
    counts = tokencache.WordCounts(counter.open())
    assert counts(texts + texts) == [count(library, t) for t in texts] * 2


def test_memo_is_bounded(counter, library, monkeypatch):
    monkeypatch.setattr(tokencache, "MEMO_WORDS", 20)
    counts = tokencache.WordCounts(counter.open())
    texts = [sentence(i, 15) + " " + "z" * 100 for i in range(30)]
    assert counts(texts) == [count(library, t) for t in texts]
    for memo in (counts.words, counts.runs):
        assert len(memo) <= 20 + 17 and all(len(w) <= tokencache.MEMO_CHARS for w in memo)


def test_only_misses_are_encoded_and_appended(spark, counter, library):
    cache = scratch_path(spark, "cache")
    first = frame(spark, [(1, "One text.", "en", "a", 0), (2, "one  TEXT.", "en", "a", 0), (3, "Another.", "en", "a", 0)])
    assert tokencache.encode_misses(first, counter, cache) is None
    stored, folder = tokencache.open_cache(spark, cache, counter.version)
    assert stored.count() == 2
    assert tokencache.encode_misses(first, counter, cache) == 0
    more = first.unionByName(frame(spark, [(4, "A third.", "en", "a", 0), (5, "a THIRD.", "en", "a", 0)]))
    assert tokencache.encode_misses(more, counter, cache) == 1
    stored = spark.read.parquet(folder)
    assert stored.count() == 3
    # Stored counts are used as they are, also where a digest was appended twice.
    marked = stored.withColumn("n_tokens", F.col("n_tokens") + 100)
    again = scratch_path(spark, "cache")
    marked.unionByName(marked).write.parquet(f"{again}/version={counter.version}")
    got = {r.doc_id: r.n_tokens for r in tokencache.count_tokens(more, counter, again).collect()}
    assert got == {r.doc_id: count(library, r.text) + 100 for r in more.collect()}


def test_misses_beyond_the_broadcast_bound(spark, counter, library, monkeypatch):
    monkeypatch.setattr(tokencache, "BROADCAST_MISSES", 1)
    cache = scratch_path(spark, "cache")
    tokencache.encode_misses(frame(spark, [(1, "x y", "en", "a", 0)]), counter, cache)
    docs = frame(spark, rows())
    assert tokencache.encode_misses(docs, counter, cache) > 1
    stored, _ = tokencache.open_cache(spark, cache, counter.version)
    assert stored.count() == stored.select("digest").distinct().count()
    assert {(r.doc_id, r.n_tokens) for r in tokencache.count_tokens(docs, counter, cache).collect()} == {(r[0], count(library, r[1])) for r in rows()}


def test_versions_do_not_mix(spark, counter, library):
    pieces = tokencache.load_counter(queries.MODEL_PATH)
    assert pieces.version != counter.version and not pieces.folds
    cache = scratch_path(spark, "cache")
    docs = frame(spark, odd_rows())
    model = sentencepiece.SentencePieceProcessor(model_file=queries.MODEL_PATH)
    for c, want in ((counter, lambda t: count(library, t)), (pieces, lambda t: len(model.encode(t or "")))):
        got = sorted(((r.doc_id, r.n_tokens) for r in tokencache.count_tokens(docs, c, cache).collect()), key=str)
        assert got == sorted(((r[0], want(r[1])) for r in odd_rows()), key=str)


def test_op12_equals_the_library(spark, sf, library):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = {tuple(r) for r in queries.op12_digest_cache(spark, sf).collect()}
    assert got == {(d, len((t or "").encode()), n := count(library, t), n > 2048) for d, t in docs}
    plan = queries.op12_digest_cache(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
