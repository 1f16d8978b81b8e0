"""Operators on small frames: chunk windows, snapshots, ordered blocks, scoring, flows."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import prompts as P
from corpusq.functions import text as X
from corpusq.operators import chat, chunks, corpus, entities, experiments, flow, infer, joins, ordered
from corpusq.sources import snapshots, tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def text_of(n):
    return " ".join(f"w{i}" for i in range(n))


# --- chunks -----------------------------------------------------------------------


@pytest.mark.parametrize("n,count", [(0, 0), (1, 1), (199, 1), (200, 1), (201, 2), (350, 2), (351, 3), (1000, 7)])
def test_chunk_counts_and_cover(spark, n, count):
    df = spark.createDataFrame([(7, text_of(n))], "doc long, text string")
    native = rows(chunks.chunk(df, "doc", "text"), "chunk_index")
    assert len(native) == count
    assert native == rows(chunks.chunk_with_tokenizer(df, "doc", "text"), "chunk_index")
    if count:
        pieces = [r[2].split(" ") for r in native]
        assert [r[1] for r in native] == list(range(count)) and native[-1][3] == f"7_{count - 1}"
        for a, b in zip(pieces, pieces[1:]):
            assert a[150:] == b[: len(a[150:])] and len(a) == 200
        covered = pieces[0] + [w for p in pieces[1:] for w in p[50:]]
        assert covered == text_of(n).split(" ")


def test_chunk_rejects_bad_overlap_and_names(spark):
    df = spark.createDataFrame([(7, "a")], "id long, text string")
    with pytest.raises(ValueError, match="overlap"):
        chunks.chunk(df.withColumnRenamed("id", "doc"), "doc", "text", size=10, overlap=10)
    with pytest.raises(ValueError, match="names"):
        chunks.chunk(df, "id", "text")


@pytest.mark.parametrize("bound", [None, 50])
def test_attach_metadata_with_a_hot_document(spark, bound):
    pieces = [("hot", i) for i in range(50)] + [("cold", 0), ("lost", 0)]
    c = spark.createDataFrame(pieces, "id string, chunk_index long")
    m = spark.createDataFrame([("hot", "en"), ("cold", "fr"), ("unused", "de")], "id string, lang string")
    got = rows(chunks.attach_metadata(c, m, "id", max_ordinal=bound and F.lit(bound), rows_per_salt=8).select("id", "chunk_index", "lang"))
    assert got == sorted([("hot", i, "en") for i in range(50)] + [("cold", 0, "fr")])


# --- snapshots, joins ---------------------------------------------------------------


def test_snapshot_diff(spark):
    schema = "id int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (2, "x", "y"), (3, None, "z"), (4, "s", "s")], schema)
    new = spark.createDataFrame([(1, "x", None), (2, "x", "Y"), (3, "", "z"), (5, "n", "n")], schema)
    assert rows(snapshots.snapshot_diff(old, new, "id")) == [(2, "update"), (3, "update"), (4, "delete"), (5, "insert")]


def test_except_rows_treats_null_as_equal(spark):
    a = spark.createDataFrame([("x", None), ("x", None), ("y", 1), ("z", 2), ("z", 2)], "s string, n int")
    b = spark.createDataFrame([("x", None), ("z", 3)], "s string, n int")
    assert rows(snapshots.except_rows(a, b)) == rows(a.subtract(b)) == [("y", 1), ("z", 2)]


def test_latest_by_key_and_unique(spark):
    df = spark.createDataFrame([("k", i) for i in range(100)] + [("j", 1)], "key string, v int")
    assert rows(snapshots.latest_by_key(df, "key", [F.desc("v")])) == [("j", 1), ("k", 99)]
    with pytest.raises(ValueError, match="'k' occurs 100"):
        snapshots.assert_unique(df, "key")
    plan = snapshots.latest_by_key(df, "key", [F.desc("v")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_upsert(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    once = snapshots.upsert(cur, new, "id")
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")] == rows(snapshots.upsert(once, new, "id"))


def test_lookup_join_with_hot_keys(spark):
    big = spark.createDataFrame([("hot", i) for i in range(300)] + [("cold", 1), ("cold", 2), ("none", 3)], "k string, i int")
    small = spark.createDataFrame([("hot", 300, 0.1), ("cold", 2, 0.2)], "k string, n int, v double")
    got = joins.lookup_join(big, small, "k", "v", "n", ["i"], hot_keys=1)
    assert got.columns == ["k", "i", "v"] and got.count() == 303
    assert rows(got.groupBy("k", "v").count(), "k") == [("cold", 0.2, 2), ("hot", 0.1, 300), ("none", None, 1)]


def test_compute_once_keeps_filter_above(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    df = corpus.within_budget(joins.compute_once(docs, document_num_tokens=X.token_count(F.col("text"))))
    assert df._jdf.queryExecution().executedPlan().toString().count("regexp_extract_all(") == 1
    assert df.count() == 193


# --- tables ---------------------------------------------------------------------------


def test_spread_moves_small_tables_only(spark):
    from corpusq.session import spread

    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == cores
    assert "Exchange" not in spread(spark.range(10, numPartitions=cores))._jdf.queryExecution().executedPlan().toString()


def test_materialise_reads_the_session_folder(spark, tmp_path):
    from corpusq.sources.materialise import materialise

    calls = tmp_path / "calls"

    def tick(batches):
        with open(calls, "a") as f:
            f.write("x")
        yield from batches

    df = materialise(spark.range(5, numPartitions=1).mapInPandas(tick, "id long"))
    before = calls.read_text()
    assert df.count() == 5 and calls.read_text() == before
    assert spark.sparkContext.getCheckpointDir().startswith("file:" + spark.conf.get("spark.checkpoint.dir"))


def test_landing_csv(spark, tmp_path):
    path = tmp_path / "players.csv"
    path.write_text('"name","url","pos"\n"A, B","u1","FW"\n"C ""x""\nD",NA,"MF"\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("name", "url", "pos")])
    assert rows(tables.read_landing_csv(spark, str(path), schema), "pos") == [
        ("A, B", "u1", "FW"),
        ('C "x"\nD', None, "MF"),
    ]


def test_table_writes(spark):
    tables.use_namespace(spark, "corpusq_test")
    with pytest.raises(ValueError):
        tables.use_namespace(spark, "x; DROP TABLE y")
    one = tables.from_rows(spark, [(1, "a")], T.StructType().add("id", "integer").add("v", "string"))
    tables.overwrite_table(one, "t")
    tables.overwrite_table(one.withColumn("id", F.lit(2)), "t")
    assert rows(spark.table("t")) == [(2, "a")]
    with pytest.raises(ValueError):
        tables.overwrite_table(one.drop("v"), "t")
    tables.overwrite_with_schema(one.withColumn("w", F.lit(1.5)), "t")
    tables.append_rows(spark.createDataFrame([(7, 2.5)], "id int, w double"), "t", "id")
    assert rows(spark.table("t")) == [(1, "a", 1.5), (7, None, 2.5)]
    with pytest.raises(ValueError):
        tables.append_rows(spark.createDataFrame([("x",)], "v string"), "t", "id")
    spark.sql("DROP DATABASE corpusq_test CASCADE")
    spark.sql("USE default")


def test_from_rows_empty_and_wrong_width(spark):
    schema = T.StructType().add("id", "string").add("score", "double")
    assert tables.from_rows(spark, [], schema).count() == 0
    with pytest.raises(ValueError):
        tables.from_rows(spark, [("a", 1.0, 2)], schema)


def test_write_clustered(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    tables.write_clustered(df, str(tmp_path / "c"), "k")
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1000


def test_bulk_rename_raises_on_missing(spark):
    with pytest.raises(ValueError, match="zz"):
        corpus.bulk_rename(spark.range(1), {"zz": "a"})


def test_token_profile_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "document_num_tokens long")
    assert tuple(corpus.token_profile(empty).first()) == (None, None, None, None)


def test_injected_tokenizer(spark):
    count = corpus.tokenizer_udf(lambda: lambda s: len(s.split()))
    df = spark.createDataFrame([("a b c",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(count(F.col("s"))).collect()] == [3, None, 0]


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame([("m", "9"), ("m", "10"), ("m", "beta"), ("n", "x")], "name string, version string")
    assert rows(corpus.latest_version(df, "name", "version")) == [("m", 10), ("n", None)]


# --- ordered operators ------------------------------------------------------------------


@pytest.fixture(scope="module")
def talk(spark):
    data = [(0, t, ("user", "assistant")[t % 2], f"text {t}") for t in range(60)]
    data += [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "user", "v"), (1, 3, "assistant", "w")]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string").cache()


@pytest.mark.parametrize(
    "op", [chat.history_buffer, chat.accumulate_query, chat.turn_pairs, chat.history_summary], ids=lambda f: f.__name__
)
def test_blocks_do_not_change_results(talk, op):
    whole = op(talk)
    names = sorted(whole.columns)
    assert rows(op(talk, block_rows=8).select(names)) == rows(whole.select(names))


def test_history_and_pairs(talk):
    history = {(r.conv_id, r.turn): r.history for r in chat.history_buffer(talk).collect()}
    assert history[0, 0] == "" and history[1, 2] == "system: s\nuser: u"
    pairs = [tuple(r)[1:] for r in chat.turn_pairs(talk).filter("conv_id = 1").collect()]
    assert pairs == [(2, "v", "w")]


def test_renumber(spark):
    df = spark.createDataFrame([("a", 5), ("a", 900), ("a", 17), ("a", 2000), ("b", 3)], "k string, o long")
    assert rows(ordered.renumber(df, "k", "o", "p", block_rows=10)) == [
        ("a", 5, 0), ("a", 17, 1), ("a", 900, 2), ("a", 2000, 3), ("b", 3, 0)
    ]


def test_window_longer_than_block_is_refused(talk):
    with pytest.raises(ValueError):
        chat.history_summary(talk, last=9, block_rows=8)


def gapped(spark):
    """Turns with gaps of all sizes; a third of them belong to one conversation, one block holds nothing."""
    turns = [7, 9, 10, 30, 31, 32, 33, 100, 101, 207, 3000, 3001, 3002, 9999]
    data = [(1, t, ["user", "assistant"][i % 2], f"t{t}") for i, t in enumerate(turns)]
    data += [(c, c * 5 + j * c, ["user", "assistant", "user"][j % 3], f"c{c}j{j}") for c in range(2, 9) for j in range(4)]
    return data, spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("block_rows", [4, 5, 64, 100_000])
def test_neighbours_over_gaps(spark, block_rows):
    data, df = gapped(spark)
    by = {}
    for c, t, role, text in sorted(data):
        by.setdefault(c, []).append((t, role, text))
    pairs, histories = [], []
    for c, own in by.items():
        for i, (t, role, _) in enumerate(own):
            histories.append((c, t, " ".join(f"{r}: {x}" for _, r, x in own[max(0, i - 3) : i])))
            if role == "user" and i + 1 < len(own) and own[i + 1][1] == "assistant":
                pairs.append((c, t, own[i][2], own[i + 1][2]))
    assert rows(chat.turn_pairs(df, block_rows=block_rows)) == sorted(pairs)
    assert rows(chat.history_summary(df, last=3, block_rows=block_rows)) == sorted(histories)
    whole = [(c, t, "\n".join(f"{r}: {x}" for _, r, x in own[:i])) for c, own in by.items() for i, (t, _, _) in enumerate(own)]
    assert rows(chat.history_buffer(df, block_rows=block_rows).select("conv_id", "turn", "history")) == sorted(whole)


def test_running_text_leaves_out_null_texts(spark):
    data = [(1, t, None if t in (0, 1, 5, 6) else f"t{t}") for t in range(10)]
    df = spark.createDataFrame(data, "k long, t long, x string")
    for block_rows in (2, 3, 100):
        got = rows(ordered.running_text(df, "k", "t", F.col("x"), "o", "-", False, block_rows).select("t", "o"))
        assert got == [(t, "-".join(x for _, u, x in data if u < t and x is not None)) for t in range(10)]


def test_running_text_stores_each_text_once(spark, monkeypatch):
    data = [(1, 3 * t + t % 2, f"{t:050d}") for t in range(200)] + [(k, t, f"{k}-{t}") for k in (2, 3) for t in range(k)]
    df = spark.createDataFrame(data, "k long, t long, x string")
    kept, stored = [], ordered.stored

    def watched(frame, name):
        out = stored(frame, name)
        texts = [c for c, kind in out.dtypes if "string" in kind]
        kept.extend(len("".join(r[c] or "")) for r in out.collect() for c in texts)
        return out

    monkeypatch.setattr(ordered, "stored", watched)
    got = rows(ordered.running_text(df, "k", "t", F.col("x"), "o", "-", True, 2).select("k", "t", "o"))
    assert got == sorted((k, t, "-".join(x for j, u, x in data if j == k and u <= t)) for k, t, _ in data)
    assert sum(kept) <= 2 * sum(len(x) for _, _, x in data)


@pytest.mark.parametrize("block_rows", [3, 8, 1024])
def test_hot_conversation_is_folded_by_many_tasks(spark, monkeypatch, block_rows):
    data = [(1, 2 * t, f"said {t}", f"answer {t}") for t in range(100)] + [(c, 1, f"s{c}", "") for c in range(2, 30)]
    df = spark.createDataFrame(data, "conv_id long, turn long, input string, output string")
    want, summary = [], chat.RunningSummary(6)
    for c in {r[0] for r in data}:
        state = None
        for _, t, said, answer in sorted(r for r in data if r[0] == c):
            own = summary.of(said, answer)
            state = own if state is None else summary.merge(state, own)
            want.append((c, t, summary.show(state)))
    seen, scan = [], ordered.scan_blocks
    monkeypatch.setattr(ordered, "scan_blocks", lambda *a, **b: seen.append(out := scan(*a, **b)) or out)
    assert rows(chat.fold_mergeable(df, lambda: chat.RunningSummary(6), block_rows=block_rows)) == sorted(want)
    blocks = -(-199 // block_rows)
    assert seen[0].count() == blocks - 1 and len({s.split(":")[0] for _, _, s in want if s.startswith("1 pairs")}) > 20


def test_scan_merges_in_order(spark):
    data = [(k, b * b, f"{k}{b}") for k in "ab" for b in range(11)] + [("c", 5, "c5")]
    values = spark.createDataFrame(data, "k string, _block long, v string")
    for backwards in (False, True):
        merge = (lambda p, v: F.concat(v, p)) if backwards else F.concat
        got = rows(ordered.scan_blocks(values, values.select("k", "_block"), "k", "v", merge, "h", backwards))
        place = (lambda b, o: o > b) if backwards else (lambda b, o: o < b)
        want = [(k, b, "".join(v for k2, o, v in data if k2 == k and place(b, o))) for k, b, _ in data]
        assert got == sorted(w for w in want if w[2])


def test_rounds_of_a_scan_broadcast_nothing(spark, monkeypatch):
    plans, stored = [], ordered.stored

    def watched(frame, name):
        plans.append((name, frame._jdf.queryExecution().sparkPlan().toString()))
        return stored(frame, name)

    monkeypatch.setattr(ordered, "stored", watched)
    values = spark.createDataFrame([("a", b, f"v{b}") for b in range(9)], "k string, _block long, v string")
    heads = ordered.scan_blocks(values, values.select("k", "_block"), "k", "v", F.concat, "h")
    plans.append(("scan", heads._jdf.queryExecution().sparkPlan().toString()))
    joins = [plan for name, plan in plans if name == "scan"]
    assert len(joins) == 5 and all("SortMergeJoin" in p and "Broadcast" not in p for p in joins)


def test_fold_summary(talk):
    pairs = chat.turn_pairs(talk)
    fold = chat.fold_summary(pairs, lambda: lambda s, i, o: f"old New summary:{s}|{i[-2:].strip()}")
    got = {(r.conv_id, r.turn): r.summary for r in fold.collect()}
    assert got[0, 4] == "|0|2|4" and got[1, 2] == "|v" and len(got) == pairs.count()


def test_turn_keywords(spark):
    df = spark.createDataFrame([(1, 0, "the cat the"), (1, 1, "the dog"), (2, 0, "..."), (2, 1, "the the bird dog")],
                               "conv_id long, turn long, text string")
    got = {(r.conv_id, r.turn): r.keywords for r in chat.turn_keywords(df, 2).collect()}
    assert got == {(1, 0): "cat the", (1, 1): "dog the", (2, 1): "bird dog"}


# --- scoring and experiments --------------------------------------------------------------


def test_request_defaults_per_row(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", None)], "prompt string, temperature double")
    got = rows(infer.with_request_defaults(df).select("prompt", "temperature", "max_new_tokens"))
    assert got == [("a", 0.5, 100), ("b", 1.0, 100)]


def test_batch_score_builds_the_model_once_per_task(spark, tmp_path):
    log = str(tmp_path / "loads")

    class Loud:
        def __init__(self):
            with open(log, "a") as f:
                f.write("x")

        def __call__(self, requests: pd.DataFrame) -> pd.Series:
            return requests["prompt"].str.upper() + requests["max_new_tokens"].astype(str)

    df = spark.range(30000, numPartitions=2).select("id", F.lit("p").alias("prompt"))
    out = infer.batch_score(df, Loud)
    assert out.filter("model_output = 'P100'").count() == 30000
    assert len(open(log).read()) == 2


def test_lead_scorer_equals_column(spark):
    data = [("x content: a b c", 2), ("no marker here", 2), ("content: content: z", 9), ("content: ", 3)]
    df = spark.createDataFrame(data, "prompt string, max_new_tokens long")
    out = infer.batch_score(df).withColumn("native", infer.lead_answer(F.col("prompt"), F.col("max_new_tokens")))
    assert [r.model_output for r in out.collect()] == [r.native for r in out.collect()] == ["a b", "no marker", "content: z", ""]


def test_classify_with_scorer(spark):
    df = spark.createDataFrame([("how to cook",), ("what",)], "q string")

    class Model:
        def __call__(self, requests):
            return requests["prompt"].map(lambda p: " Cooking \n" if "cook" in p.split("<question>")[1] else "Gardening")

    got = infer.classify(df, "q", ["Plumbing", "Cooking", "Other"], factory=Model)
    assert rows(got, F.desc("q")) == [("what", "other"), ("how to cook", "cooking")]


def test_seeded_scores_do_not_depend_on_batches(spark):
    df = spark.createDataFrame([(i, f"a{i} b c d e f g") for i in range(60)] + [(None, "x y z"), (None, "x y z")], "k long, text string").withColumns(
        {"prompt": F.lit("p"), "max_new_tokens": F.lit(2).cast("long")}
    )
    run = lambda d, seed: rows(infer.score_all(d, {"a": infer.SampledScorer, "b": infer.LeadScorer}, ["k"], seed, F.col("text")).select("k", "a", "b"))
    one = run(df.repartition(1), 3)
    assert one == run(df.repartition(7, "text"), 3) != run(df, 4)
    assert len({a.split()[0][0] for k, a, _ in one if k is not None}) > 3
    cold = infer.score_all(df.withColumn("temperature", F.lit(0.0)), {"a": infer.SampledScorer}, ["k"], 3, F.col("text"))
    assert {r.a for r in cold.filter("k = 5").collect()} == {"a5 b"}
    assert infer.score_all(df.limit(0), {"a": infer.SampledScorer}, ["k"]).count() == 0


def test_result_log_replaces_a_repeated_run_only(spark, tmp_path):
    path = str(tmp_path / "log")
    result = lambda *r: spark.createDataFrame(r, "run_name string, prompt_style string, temperature double, prompt string, model_output string")
    experiments.log_results(result(("A_1", "A", 1.0, "p", "one"), ("A_1", "A", 1.0, "q", "two"), ("B_1", "B", 1.0, "p", "three")), path)
    experiments.log_results(result(("A_1", "A", 1.0, "p", "new"), ("C_1", "C", 1.0, "p", "four")), path)
    experiments.log_results(result(("A_1", "A", 1.0, "p", "new")).limit(0), path)
    got = rows(spark.read.parquet(path).select("run_name", "prompt", "model_output"))
    assert got == [("A_1", "p", "new"), ("B_1", "p", "three"), ("C_1", "p", "four")]


def test_experiments(spark, tmp_path):
    asked = spark.createDataFrame([(1, "r one"), (2, None)], "item_id long, text string")
    results = experiments.run_experiments(asked, "text", "item_id")
    assert results.count() == 12
    assert {r.run_name for r in results.collect()} >= {"DIRECT_0.1", "PERSUASIVE_1"}
    wide = experiments.compare_by_prompt(results, "item_id", ["DIRECT_0.1", "DIRECT_1"])
    assert rows(wide.select("item_id", "`DIRECT_1`")) == [(1, "r one"), (2, "no matching report")]
    experiments.write_results(results, str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r"))
    assert set(back.columns) == {"prompt_style", "temperature", "prompt", "model_output"} and back.count() == 12


# --- flows ----------------------------------------------------------------------------------


def test_dispatch_partitions_the_input(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "ab")], "id int, s string")

    def mark(name):
        return lambda d: d.select("id", F.lit(name).alias("h"))

    has = lambda x: F.col("s").contains(x)
    got = rows(flow.dispatch(df, [(has("a"), mark("A")), (has("b"), mark("B"))], mark("rest")))
    assert got == [(1, "A"), (2, "B"), (3, "rest"), (4, "A")]
    routed = df.select("id", flow.route([(has("a"), F.lit("A")), (has("b"), F.lit("B"))], F.lit("rest")).alias("h"))
    assert rows(routed) == got


# --- entity pages ---------------------------------------------------------------------------


PAGES = [
    (1, '<p>Position: FW Footed: R</p><span id="necro-birth">May 1, 2000</span><p>Club: FC A</p>'
        '<table id="scout"><tr><th>Statistic</th><th>P90</th></tr><tr><td>Goals</td><td>1</td></tr>'
        "<tr><td></td><td>9</td></tr><tr><td>Shots</td><td></td></tr></table>"),
    (2, "<p>nothing here</p>"),
]


def test_entity_fields_fall_back(spark):
    df = spark.createDataFrame(PAGES, "page_id long, html string")
    got = entities.entity_fields(df, F.lit("2024-06-01").cast("date")).drop("html")
    assert rows(got) == [(1, "FW", "May 1, 2000", "24", "FC A"), (2, *["Unknown"] * 4)]


@pytest.mark.parametrize("block_rows", [4096, 1])
def test_tables_to_markdown(spark, block_rows):
    df = spark.createDataFrame(PAGES, "page_id long, html string")
    long = entities.page_table(df, "page_id", "scout", ["Statistic", "P90"])
    assert rows(long, "row_idx") == [(1, 0, "Goals", "1"), (1, 1, None, "9"), (1, 2, "Shots", None)]
    kept = entities.drop_missing(long)
    text = "| Statistic | P90 |\n| --- | --- |\n| Goals | 1 |\n| Shots |  |"
    assert rows(entities.rows_to_markdown(kept, "page_id", "row_idx", ["Statistic", "P90"], block_rows=block_rows)) == [
        (1, text)
    ]
    from corpusq.functions.html import table_rows

    inline = df.select(entities.table_to_markdown(table_rows(F.col("html"), "scout"), ["Statistic", "P90"]).alias("m"))
    assert [r.m for r in inline.collect()] == [text, None]


def test_entity_reports(spark):
    df = spark.createDataFrame(PAGES, "page_id long, html string").withColumn("name", F.concat(F.lit("P"), "page_id"))
    got = entities.entity_reports(
        df, name="name", table_id="scout", columns=["Statistic", "P90"], as_of=F.lit("2024-06-01").cast("date"), max_new_tokens=3
    )
    assert [r.report for r in got.orderBy("page_id").collect()] == ["Position: FW Footed:", "nothing here"]


def test_templates_name_known_fields():
    assert set(P.fields(P.REPORT_TEMPLATE)) == {"name", "position", "age", "club", "statistics", "text"}


# --- a model tokenizer ------------------------------------------------------------------------

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.mark.skipif(not __import__("os").path.exists(MODEL), reason="no tokenizer model here")
def test_model_tokenizer_counts_and_chunks(spark, sf):
    from corpusq.functions.tokenizers import sentencepiece_factory

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    factory = sentencepiece_factory(MODEL)
    count = corpus.tokenizer_udf(factory)
    counted = corpus.with_metrics(docs, "text", tokens=lambda c: count(c))
    model = factory()
    expected = {r.doc_id: model(r.text) for r in docs.collect()}
    assert {r.doc_id: r.document_num_tokens for r in counted.collect()} == expected
    pieces = chunks.chunk_with_tokenizer(docs, "doc_id", "text", factory).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in pieces} == {d: max(1, -(-(n - 50) // 150)) for d, n in expected.items()}


def test_tokenizer_chunks_are_handed_on_in_bounded_frames(spark, monkeypatch):
    monkeypatch.setattr(chunks, "BATCH_CHARS", 2_000)
    texts = [" ".join(f"w{i}x{k}" for k in range(n)) for i, n in enumerate((0, 1, 600, 0, 2_000, 200, 201))] + [None]
    batch = pd.DataFrame({"doc": range(len(texts)), "body": texts})
    frames = list(chunks._token_windows(iter([batch]), "doc", "body", chunks.SpaceTokenizer(), 200, 50, 150))
    longest = max(f["text"].str.len().max() for f in frames)
    assert len(frames) > 5 and all(f["text"].str.len().sum() < 2_000 + longest for f in frames)
    got = [(r.doc, r.chunk_index, r.text) for f in frames for r in f.itertuples()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc long, body string")
    assert got == sorted((r.doc, r.chunk_index, r.text) for r in chunks.chunk(df, "doc", "body").collect())
