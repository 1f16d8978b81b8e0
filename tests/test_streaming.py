"""Triggered sync, streaming preparation and streaming memory."""

import time

from pyspark.sql import functions as F

from corpusq.functions import text as X
from corpusq.operators import chat, chunks, corpus, index
from corpusq.streaming import memory, sync


def write(df, path, n):
    df.coalesce(1).write.parquet(f"{path}/part{n}")


def keys(df):
    return sorted((r.doc_id, r.text, r.norm2) for r in df.collect())


def test_triggered_sync(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    source, path, checkpoint = (str(tmp_path / n) for n in ("source", "index", "checkpoint"))
    schema = docs.withColumn("seen", F.lit(1)).schema

    def run():
        query = sync.start_sync(
            spark, f"{source}/*", schema, path, checkpoint, "doc_id", "text", ["lang"], newest=[F.desc("seen")]
        )
        query.awaitTermination()
        assert query.exception() is None
        return sync.read_index(spark, path, "doc_id")

    first = docs.filter("doc_id < 150").withColumn("seen", F.lit(1))
    write(first, source, 1)
    assert keys(run()) == keys(index.build_index(first, "doc_id", "text", ["lang"]))

    # 50 known keys of which 10 changed, new keys, and one key twice in the batch.
    again = docs.filter("doc_id >= 100").withColumn("seen", F.lit(2)).withColumn(
        "text", F.when(F.col("doc_id") < 110, F.concat("text", F.lit(" changed"))).otherwise(F.col("text"))
    )
    late = again.filter("doc_id = 199").withColumns({"seen": F.lit(3), "text": F.lit("newest")})
    write(again.unionByName(late), source, 2)
    after = keys(run())
    expected = index.build_index(
        first.filter("doc_id < 100").unionByName(again.filter("doc_id < 199")).unionByName(late), "doc_id", "text", ["lang"]
    )
    assert after == keys(expected) and len(after) == docs.count()
    assert spark.read.parquet(f"{path}/delta/batch=1").count() == 10 + docs.filter("doc_id >= 150").count()

    # A trigger without new files does nothing; a replayed batch writes the same rows.
    assert keys(run()) == after
    rows = again.unionByName(late)
    sync.apply_batch(rows, 1, path, "doc_id", "text", ["lang"], [F.desc("seen")])
    assert keys(sync.read_index(spark, path, "doc_id")) == after
    sync.compact(spark, path, "doc_id")
    assert keys(spark.read.parquet(f"{path}/base/v1")) == after == keys(sync.read_index(spark, path, "doc_id"))


def test_streaming_preparation_equals_batch(spark, sf, tmp_path):
    path = f"{sf}/documents.parquet"
    docs = spark.read.parquet(path)

    def prepare(df):
        clean = df.withColumn("document", X.collapse_whitespace(F.col("text")))
        return chunks.chunk(corpus.within_budget(corpus.with_metrics(clean)), "doc_id", "document", carry=("lang",))

    stream = prepare(spark.readStream.schema(docs.schema).parquet(path + "*"))
    out = str(tmp_path / "out")
    query = (
        stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
        .format("parquet").start(out)
    )
    query.awaitTermination()
    order = ["doc_id", "chunk_index", "text", "id", "lang"]
    assert sorted(map(tuple, spark.read.parquet(out).select(order).collect())) == sorted(
        map(tuple, prepare(docs).select(order).collect())
    )


def test_streaming_memory_equals_batch_fold(spark, sf, tmp_path):
    pairs = chat.turn_pairs(spark.read.parquet(f"{sf}/conversations.parquet"))
    source = str(tmp_path / "pairs")
    write(pairs.filter("turn < 2"), source, 1)

    def summarise():
        return memory.keep_last_words(20)

    def run():
        stream = spark.readStream.schema(pairs.schema).parquet(f"{source}/*")
        query = (
            memory.stream_summaries(stream, summarise)
            .writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
            .outputMode("append").format("parquet").start(str(tmp_path / "out"))
        )
        query.awaitTermination()

    run()
    write(pairs.filter("turn >= 2"), source, 2)
    run()
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    assert got == sorted(map(tuple, chat.fold_summary(pairs, summarise).collect()))


def test_sync_deletes_and_brings_back(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("source", "index", "checkpoint"))
    rows = lambda *r: spark.createDataFrame(r, "doc_id long, text string, at int, gone boolean")
    schema = spark.createDataFrame([], "doc_id long, text string, at int, gone boolean").schema

    def run(*r):
        write(rows(*r), source, r[0][2])
        sync.start_sync(
            spark, f"{source}/*", schema, path, checkpoint, "doc_id", "text", newest=[F.desc("at")], deleted=F.col("gone")
        ).awaitTermination()
        return {x.doc_id: x.text for x in sync.read_index(spark, path, "doc_id").collect()}

    assert run((1, "a", 1, False), (2, "b", 1, False), (3, "c", 1, True)) == {1: "a", 2: "b"}
    assert run((2, None, 2, True), (4, "d", 2, None)) == {1: "a", 4: "d"}
    sync.compact(spark, path, "doc_id")
    assert run((2, "b again", 3, False), (1, "a", 3, True)) == {2: "b again", 4: "d"}


def test_small_source_moves_no_index_row(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    built = index.build_index(docs, "doc_id", "text", check_key=False)
    few = docs.filter("doc_id < 3").withColumn("text", F.lit("changed"))
    plan = index.sync_index(built, few, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_turns_in_the_wrong_batch_are_folded_in_order(spark, sf, tmp_path):
    from corpusq.operators import ordered

    pairs = chat.turn_pairs(spark.read.parquet(f"{sf}/conversations.parquet"))
    placed = ordered.renumber(pairs, "conv_id", "turn", "position")
    source = str(tmp_path / "pairs")

    def run(*frames):
        for n, df in enumerate(frames):
            write(df, source, len(list((tmp_path / "pairs").glob("*"))) + n)
        stream = spark.readStream.schema(placed.schema).parquet(f"{source}/*")
        memory.stream_ordered_summaries(stream, chat.RunningSummary).writeStream.option(
            "checkpointLocation", str(tmp_path / "c")
        ).trigger(availableNow=True).outputMode("append").format("parquet").start(str(tmp_path / "out")).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))

    want = sorted(map(tuple, chat.fold_mergeable(pairs, chat.RunningSummary).collect()))
    assert len(run(placed.filter("position > 0"))) == 0  # every conversation waits for its first pair
    assert run(placed.filter("position = 0")) == want
    assert run(placed.filter("position = 1")) == want  # what came twice is left out


def test_a_gap_is_given_up_after_patience(spark, tmp_path):
    rows = [(1, 3, "c", "d", 1), (1, 5, "e", "f", 2), (2, 1, "a", "b", 0)]
    placed = spark.createDataFrame(rows, "conv_id long, turn long, input string, output string, position long")
    source, out = str(tmp_path / "pairs"), str(tmp_path / "out")
    write(placed, source, 0)
    stream = spark.readStream.schema(placed.schema).parquet(f"{source}/*")
    summaries = memory.stream_ordered_summaries(stream, chat.RunningSummary, patience=0)
    query = (
        summaries.writeStream.option("checkpointLocation", str(tmp_path / "c")).outputMode("append")
        .trigger(processingTime="1 second").format("parquet").start(out)
    )
    got, until = [], time.time() + 60
    try:
        while len(got) < 3 and time.time() < until and query.isActive:
            time.sleep(2)
            if (tmp_path / "out" / "_spark_metadata").exists():
                got = sorted((r.conv_id, r.turn, r.summary.split()[0]) for r in spark.read.schema(summaries.schema).parquet(out).collect())
    finally:
        query.stop()
    assert got == [(1, 3, "1"), (1, 5, "2"), (2, 1, "1")]
