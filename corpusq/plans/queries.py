"""The operators applied to the fixture tables, one query per operator.

Each query reads whole tables. Where a fixture lacks a shape an operator needs
(entity pages with ids and tables, an older snapshot), Spark derives it from the
given tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusq.functions import html as H
from corpusq.functions import prompts as P
from corpusq.functions import terms as V
from corpusq.functions import text as X
from corpusq.operators import approximate, chat, chunks, corpus, entities, experiments, flow, index, infer, ordered, postings, search, textjoin
from corpusq.operators.joins import compute_once
from corpusq.session import spread
from corpusq.sources import snapshots, tables
from corpusq.sources.changelog import ChangeLog, follow_index
from corpusq.sources.materialise import shared_folder
from corpusq.streaming import sync
from corpusq.streaming.memory import keep_last_words, stream_ordered_summaries, stream_summaries

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-06-01"
GATE = 0.70
VECTOR_GATE = 0.35
CHAT_GATE = 0.10
TEXT_GATE = 0.30
TOPICS = ("english", "german", "french")
TOPIC_RULES = {"english": [" the ", " and "], "german": [" der ", " und "], "french": [" le ", " et "]}
ROUTES = {
    "english": "Answer the question in English.\nQuestion: {question}\nAnswer:",
    "german": "Answer the question in German.\nQuestion: {question}\nAnswer:",
}
DEFAULT_ROUTE = "Answer the question.\nQuestion: {question}\nAnswer:"

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- fixture adapters ---------------------------------------------------------


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(tables.scan(spark, sf, "documents"))


def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).withColumn("document", X.collapse_whitespace(F.col("text")))


def labelled(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    return df.join(tables.scan(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")


def not_toxic(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    toxic = tables.scan(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    return df.join(toxic, "doc_id", "left_anti")


def entity_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Entity pages rendered from documents and labels: fields, an id, a table, the text."""
    docs = documents(spark, sf).join(tables.scan(spark, sf, "labels"), "doc_id", "left")
    day = F.date_add(F.lit("1980-01-01").cast("date"), (F.col("n_chars") % 9000).cast("int"))
    birthday = F.when(F.col("quality").isNotNull(), F.date_format(day, "MMMM d, yyyy")).otherwise("n/a")
    parts: list[Column | str] = [
        "<html><head><title>doc ", F.col("doc_id"), "</title></head><body><p>Position: ", F.col("source"),
        " Footed: ", F.col("lang"), '</p><p>Born: <span class="d" id="necro-birth"> ', birthday,
        "</span></p><p>Club: FC ", F.col("lang"), '</p><table class="t" id="scout"><tr><th>Statistic</th><th>Value</th></tr>',
        "<tr><td>characters</td><td>", F.col("n_chars"), "</td></tr><tr><td> </td><td>-</td></tr><tr><td>quality</td><td>",
        F.coalesce(F.col("quality").cast("string"), F.lit("")), "</td></tr></table><p>",
        H.escape(F.col("text")), "</p></body></html>",
    ]
    html = F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return docs.select("doc_id", html.alias("html"))


# --- sources, projection, filters ---------------------------------------------


@query
def scan_documents(spark, sf):
    return tables.scan(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")


@query
def snapshot_diff(spark, sf):
    docs = documents(spark, sf)
    old = labelled(spark, sf, docs).select("doc_id", "text", "lang")
    new = not_toxic(spark, sf, docs).select("doc_id", X.collapse_whitespace(F.col("text")).alias("text"), "lang")
    return snapshots.snapshot_diff(old, new, "doc_id")


def _folder(spark, name: str) -> str:
    """A new folder below the shared one, for queries that write and read back."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _table(spark, name: str) -> str:
    return f"corpusq_{name}_{uuid.uuid4().hex}"


@query
def landing_csv(spark, sf):
    """Documents written as a landing CSV with NA for a missing value, and read back."""
    path = _folder(spark, "landing")
    docs = documents(spark, sf).select("doc_id", "text", F.when(F.col("lang") != "es", F.col("lang")).alias("lang"))
    docs.write.csv(path, header=True, nullValue="NA", quote='"', escape='"', quoteAll=False)
    return tables.read_landing_csv(spark, path, docs.schema)


@query
def overwrite_table(spark, sf):
    name = _table(spark, "overwritten")
    docs = tables.scan(spark, sf, "documents").select("doc_id", "lang")
    tables.overwrite_table(docs, name)
    tables.overwrite_table(docs.filter("lang = 'en'"), name)
    return spark.table(name)


@query
def overwrite_merging_schema(spark, sf):
    """New rows with another set of columns; the old columns stay and are NULL."""
    name = _table(spark, "merged")
    docs = tables.scan(spark, sf, "documents")
    tables.overwrite_table(docs.select("doc_id", "lang"), name)
    tables.overwrite_merging_schema(docs.filter("lang = 'fr'").select("doc_id", "n_chars"), name)
    return spark.table(name)


@query
def append_rows(spark, sf):
    name = _table(spark, "appended")
    docs = tables.scan(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    tables.overwrite_table(docs.filter("lang = 'en'"), name)
    tables.append_rows(docs.filter("lang <> 'en'").select("doc_id", "lang"), name, "doc_id")
    return spark.table(name)


@query
def align_schema(spark, sf):
    """Rows brought to another table's columns, as a local list of rows is."""
    schema = tables.scan(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").schema
    return tables.align(tables.scan(spark, sf, "documents").select("n_chars", "doc_id"), schema, required=["doc_id"])


@query
def rows_of_settings(spark, sf):
    """A small local list with a full schema, joined to the table that it describes, and an empty one."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("name", T.StringType())])
    names = tables.from_rows(spark, [("en", "English"), ("de", "German")], schema)
    none = tables.from_rows(spark, [], schema).withColumnRenamed("name", "other")
    docs = tables.scan(spark, sf, "documents").select("doc_id", "lang")
    return docs.join(F.broadcast(names), "lang", "left").join(none, "lang", "left")


@query
def namespace_table(spark, sf):
    """A table written in a namespace of its own and read by its full name after the session has left it."""
    before = spark.sql("SELECT current_schema() AS s").first().s
    space = _table(spark, "space")
    tables.use_namespace(spark, space)
    try:
        tables.overwrite_table(tables.scan(spark, sf, "documents").select("doc_id", "lang"), "docs")
    finally:
        tables.use_namespace(spark, before)
    return spark.table(f"{space}.docs")


@query
def write_clustered(spark, sf):
    path = _folder(spark, "clustered")
    tables.write_clustered(documents(spark, sf).select("lang", "doc_id"), path, "doc_id")
    return spark.read.parquet(path).filter("doc_id >= 100")


@query
def stream_sync(spark, sf):
    """A streamed index: all documents, then revised and deleted ones, prepared on the way."""
    root = _folder(spark, "sync")
    docs = documents(spark, sf).select("doc_id", "text", "lang")
    first = docs.withColumns({"at": F.lit(1), "gone": F.lit(False)})
    revised = F.concat(F.col("text"), F.lit(" (revised)"))
    second = docs.filter("doc_id % 5 = 0").withColumns({"text": revised, "at": F.lit(2), "gone": F.col("doc_id") % 10 == 0})
    for rows in (first, second):
        rows.write.mode("append").parquet(f"{root}/in")
        sync.start_sync(
            spark, f"{root}/in", first.schema, f"{root}/index", f"{root}/checkpoint", "doc_id", "text", ["lang"],
            newest=[F.col("at").desc()], deleted=F.col("gone"),
            prepare=lambda df: df.withColumn("text", X.collapse_whitespace(F.col("text"))),
        ).awaitTermination()
    return sync.read_index(spark, f"{root}/index", "doc_id").select("doc_id", "text", "lang", "norm2")


def _committed(spark, sf, root, index=None):
    """A source with two commits: labelled documents, then the revised ones that are not toxic. ``index`` follows each."""
    docs = documents(spark, sf)
    source = ChangeLog(spark, f"{root}/source", "doc_id")
    revised = F.when(F.col("lang") == "en", F.concat(X.collapse_whitespace(F.col("text")), F.lit(" (revised)"))).otherwise(F.col("text"))
    for state in (labelled(spark, sf, docs), not_toxic(spark, sf, docs).withColumn("text", revised)):
        source.commit(state.select("doc_id", "text", "lang"))
        if index is not None:
            follow_index(source, index, "text", ["lang"])
    return source


@query
def change_log(spark, sf):
    """What two commits changed, as the log tells it."""
    return _committed(spark, sf, _folder(spark, "changes")).changes()


@query
def change_feed_index(spark, sf):
    """An index that follows the source's log: documents that left the source have left the index."""
    root = _folder(spark, "feed")
    index_log = ChangeLog(spark, f"{root}/index", "doc_id")
    _committed(spark, sf, root, index_log)
    return index_log.read().select("doc_id", "text", "lang", F.size("vector").cast("long").alias("n_terms"), "norm2")


def _streamed(spark, batches, stream_of):
    """What a stream over ``batches``, one file folder each and one per micro-batch, writes."""
    root = _folder(spark, "memory")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for n, rows in enumerate(batches):
            rows.write.parquet(f"{root}/in/batch={n}")
            stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in/*")
            out = stream_of(stream)
            writer = out.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
            writer.format("parquet").option("path", f"{root}/out").start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(out.schema).parquet(f"{root}/out")


@query
def stream_last_words(spark, sf):
    """The bounded variant: summaries of 20 words, turn pairs in order."""
    return _streamed(spark, [chat.turn_pairs(_turns(spark, sf))], lambda stream: stream_summaries(stream, lambda: keep_last_words(20)))


@query
def stream_memory(spark, sf):
    """Summaries that depend on every turn, while later turns arrive before earlier ones."""
    pairs = ordered.renumber(chat.turn_pairs(_turns(spark, sf)), "conv_id", "turn", "position")
    batches = [pairs.filter("position % 3 = 2"), pairs.filter("position % 3 = 0"), pairs.filter("position % 3 = 1")]
    return _streamed(spark, batches, lambda stream: stream_ordered_summaries(stream, chat.RunningSummary))


@query
def project_alias(spark, sf):
    return corpus.project(
        tables.scan(spark, sf, "documents"), {"player_id": "doc_id", "document": "text", "player_position": "source"}
    )


@query
def bulk_rename(spark, sf):
    return corpus.bulk_rename(
        tables.scan(spark, sf, "documents"), {"doc_id": "player_id", "source": "player_position", "text": "report"}
    )


@query
def filter_token_budget(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    measured = compute_once(docs, document_num_tokens=X.token_count(F.col("text"))).drop("text")
    return corpus.within_budget(measured)


@query
def limit_by_key(spark, sf):
    return corpus.limit_by_key(tables.scan(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id", 500)


def _filtered(spark, sf, filters):
    return corpus.where(tables.scan(spark, sf, "documents"), filters).select("doc_id", "lang", "source", "n_chars")


@query
def filter_eq(spark, sf):
    return _filtered(spark, sf, {"lang": "en"})


@query
def filter_range(spark, sf):
    return _filtered(spark, sf, {"n_chars <=": 2000, "n_chars >": 200})


@query
def filter_in(spark, sf):
    return _filtered(spark, sf, {"lang": ("en", "de")})


@query
def filter_or(spark, sf):
    return _filtered(spark, sf, {"lang OR source": ["fr", "src1"]})


@query
def filter_not(spark, sf):
    return _filtered(spark, sf, {"lang NOT": "en"})


@query
def table_shape(spark, sf):
    return corpus.table_shape(tables.scan(spark, sf, "documents"))


# --- scalar functions ----------------------------------------------------------


@query
def assemble_document(spark, sf):
    labels = dict(zip(X.DOCUMENT_LABELS, (F.concat(F.lit("doc "), "doc_id"), F.col("text"), F.col("source"))))
    return documents(spark, sf).select("doc_id", X.assemble_document(labels).alias("document"))


@query
def collapse_whitespace(spark, sf):
    return clean_documents(spark, sf).select("doc_id", "document")


def _boilerplate(spark, sf, reluctant):
    report = F.concat(
        F.lit("Scouting Report for doc "), "doc_id", F.lit("\nPosition: "), "source", F.lit("\n"),
        "text", F.lit("\nPosition: "), "lang", F.lit(" end"),
    )
    docs = documents(spark, sf).withColumns({"name": F.concat(F.lit("doc "), "doc_id"), "report": report})
    return corpus.prepare_documents(docs, "name", "report", "source", reluctant=reluctant).select("doc_id", "document")


@query
def strip_boilerplate(spark, sf):
    return _boilerplate(spark, sf, False)


@query
def strip_boilerplate_reluctant(spark, sf):
    return _boilerplate(spark, sf, True)


@query
def doc_metrics(spark, sf):
    return corpus.with_metrics(documents(spark, sf), "text").select(
        "doc_id", "document_num_chars", "document_num_words", "document_num_tokens"
    )


@query
def token_count(spark, sf):
    return documents(spark, sf).select("doc_id", X.token_count(F.col("text")).alias("num_tokens"))


@query
def clean_answer(spark, sf):
    turns = tables.scan(spark, sf, "conversations")
    return turns.select("conv_id", "turn", X.clean_answer(F.concat(F.lit("Answer: "), "text")).alias("answer"))


@query
def last_segment(spark, sf):
    turns = tables.scan(spark, sf, "conversations")
    marked = F.when(
        F.col("role") == "assistant", F.concat(F.col("role"), F.lit(" New summary:"), F.col("text"))
    ).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", X.last_segment(marked).alias("summary"))


@query
def length_product(spark, sf):
    return documents(spark, sf).select(
        "doc_id",
        F.length("text").alias("a"),
        X.length_product(F.col("text"), F.col("source")).alias("b"),
    )


@query
def page_host(spark, sf):
    return tables.scan(spark, sf, "pages").select("page_id", X.url_host(F.col("url")).alias("host"))


# --- chunks --------------------------------------------------------------------


@query
def chunk_documents(spark, sf):
    return chunks.chunk(clean_documents(spark, sf), "doc_id", "document")


@query
def chunk_documents_udf(spark, sf):
    return chunks.chunk_with_tokenizer(clean_documents(spark, sf), "doc_id", "document")


@query
def chunk_ids(spark, sf):
    return chunks.chunk(clean_documents(spark, sf), "doc_id", "document").select("id", F.length("text").alias("num_chars"))


@query
def chunk_ordinal(spark, sf):
    return chunks.chunk(clean_documents(spark, sf), "doc_id", "document").select("doc_id", "chunk_index")


@query
def chunk_with_metadata(spark, sf):
    docs = clean_documents(spark, sf)
    meta = corpus.with_metrics(docs).select(
        "doc_id", "lang", "source", "document_num_tokens", "document_num_chars", "document_num_words"
    )
    last = F.col("document_num_words") / (chunks.CHUNK_TOKENS - chunks.CHUNK_OVERLAP)
    return chunks.attach_metadata(chunks.chunk(docs, "doc_id", "document"), meta, "doc_id", max_ordinal=last)


@query
def chunk_carry_metadata(spark, sf):
    return chunks.chunk(clean_documents(spark, sf), "doc_id", "document", carry=("lang", "source"))


@query
def experiment_grid(spark, sf):
    return experiments.experiment_grid(tables.scan(spark, sf, "benchmark").select("item_id"))


# --- set operations, aggregation -------------------------------------------------


def _measured(spark, sf):
    return corpus.with_metrics(clean_documents(spark, sf)).select(
        "doc_id", "document", "source", "document_num_tokens", "document_num_chars", "document_num_words"
    )


@query
def except_new_rows(spark, sf):
    rows = _measured(spark, sf)
    return snapshots.except_rows(rows.drop("doc_id"), labelled(spark, sf, rows).drop("doc_id"))


@query
def new_rows_by_key(spark, sf):
    rows = documents(spark, sf).select("doc_id", "lang", "text")
    return snapshots.new_rows_by_key(rows, tables.scan(spark, sf, "labels"), "doc_id")


@query
def token_profile(spark, sf):
    measured = documents(spark, sf).select(X.token_count(F.col("text")).alias("document_num_tokens"))
    return corpus.token_profile(measured)


@query
def latest_version(spark, sf):
    events = tables.scan(spark, sf, "events").select(
        F.col("event_type").alias("name"), F.col("user_id").cast("string").alias("version")
    )
    return corpus.latest_version(events, "name", "version")


# --- vectors ---------------------------------------------------------------------


@query
def embed_hashed(spark, sf):
    docs = documents(spark, sf).select("doc_id", V.dense_counts(V.term_vector(F.col("text"), 64), 64).alias("counts"))
    unit = docs.withColumn("embedding", V.l2_normalise(F.col("counts")))
    length = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return unit.select(
        "doc_id", F.array_join("counts", " ").alias("counts"), F.round(F.sqrt(length), 4).alias("length")
    )


@query
def index_build(spark, sf):
    built = index.build_index(documents(spark, sf), "doc_id", "text", ["lang"])
    return built.select(
        "doc_id",
        "lang",
        F.size("vector").cast("long").alias("n_terms"),
        F.aggregate("vector.tf", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_words"),
        "norm2",
    )


def _vectors(spark, sf):
    vectors = spread(tables.scan(spark, sf, "embeddings"))
    return vectors, vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))


_VECTOR_COLUMNS = {
    "id_col": "vec_id",
    "vector": "embedding",
    "query_id": "query_id",
    "query_vector": "query_embedding",
}


def _rounded(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


@query
def topk_similar(spark, sf):
    vectors, asked = _vectors(spark, sf)
    hits = search.topk_dense(vectors, asked, 3, **_VECTOR_COLUMNS)
    return _rounded(search.attach_columns(hits, vectors, "vec_id", ["label"]))


@query
def topk_filtered(spark, sf):
    vectors, asked = _vectors(spark, sf)
    return _rounded(search.topk_dense(vectors, asked, 3, filters={"label": 3}, **_VECTOR_COLUMNS))


@query
def topk_euclidean(spark, sf):
    vectors, asked = _vectors(spark, sf)
    return _rounded(search.topk_dense(vectors, asked, 3, metric="l2", **_VECTOR_COLUMNS))


@query
def best_hit_gated(spark, sf):
    vectors, asked = _vectors(spark, sf)
    hits = search.topk_dense(vectors, asked, 3, skip_equal=True, **_VECTOR_COLUMNS)
    return _rounded(search.best_hit(asked.select("query_id"), hits, "query_id", VECTOR_GATE))


@query
def hits_gated(spark, sf):
    vectors, asked = _vectors(spark, sf)
    hits = search.topk_dense(vectors, asked, 3, skip_equal=True, **_VECTOR_COLUMNS)
    return _rounded(search.gate(hits, "query_id", VECTOR_GATE))


LSH = {"dim": 64, "tables": 8, "bits": 2, "seed": 42}


@query
def topk_lsh(spark, sf):
    vectors, asked = _vectors(spark, sf)
    return _rounded(approximate.topk_lsh(vectors, asked, 3, skip_equal=True, **LSH, **_VECTOR_COLUMNS))


PROBES = {"bits": 6, "probes": 50, "seed": 42}


@query
def topk_multiprobe(spark, sf):
    """Over a table stored by bucket; the fixture's vectors have no near neighbours, so many buckets are visited."""
    path = _folder(spark, "buckets")
    vectors, asked = _vectors(spark, sf)
    approximate.write_signatures(vectors, path, "embedding", PROBES["bits"], PROBES["seed"])
    hits = approximate.topk_multiprobe(spark.read.parquet(path), asked, 3, skip_equal=True, **PROBES, **_VECTOR_COLUMNS)
    return _rounded(hits)


_TEXT_COLUMNS = {"id_col": "doc_id", "text": "text", "query_id": "item_id", "query_text": "question"}


def _questions(spark, sf):
    return tables.scan(spark, sf, "benchmark").select("item_id", F.col("text").alias("question"))


@query
def text_search(spark, sf):
    return _rounded(search.text_search(documents(spark, sf), _questions(spark, sf), 3, **_TEXT_COLUMNS))


@query
def text_search_dense64(spark, sf):
    hits = search.text_search(documents(spark, sf), _questions(spark, sf), 3, buckets=64, **_TEXT_COLUMNS)
    return _rounded(hits)


@query
def text_search_filtered(spark, sf):
    hits = search.text_search(
        documents(spark, sf), _questions(spark, sf), 3, filters={"lang": "en", "n_chars >": 500},
        columns=["lang", "n_chars"], **_TEXT_COLUMNS,
    )
    return _rounded(hits)


def _coarse(hits: DataFrame) -> DataFrame:
    """Scores of single-precision vectors."""
    return hits.withColumn("score", F.round("score", 4))


@query
def text_search_encoder(spark, sf):
    hits = search.text_search(
        documents(spark, sf), _questions(spark, sf), 1, encode=index.hashed_encoder(64), **_TEXT_COLUMNS
    )
    return _coarse(hits).select("item_id", "score", "rank")


@query
def text_join(spark, sf):
    """Every document as a question, by an exact join behind the gate."""
    hits = textjoin.text_join(documents(spark, sf), None, GATE, 3, id_col="doc_id", text="text", query_id="query_id")
    return _rounded(hits)


@query
def text_join_questions(spark, sf):
    hits = textjoin.text_join(documents(spark, sf), _questions(spark, sf), TEXT_GATE, 3, **_TEXT_COLUMNS)
    return _rounded(hits)


@query
def index_build_dense(spark, sf):
    built = index.build_index(documents(spark, sf), "doc_id", "text", ["lang"], encode=index.hashed_encoder(64))
    return built.select("doc_id", "lang", F.size("embedding").cast("long").alias("dim"), _length("embedding"), "digest").drop("digest")


def _length(vector: str) -> Column:
    square = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return F.round(F.sqrt(square), 4).alias("length")


def _synced(spark, sf, **options):
    docs = documents(spark, sf)
    old = index.build_index(labelled(spark, sf, docs), "doc_id", "text", check_key=False, **options)
    revised = F.concat(X.collapse_whitespace(F.col("text")), F.lit(" (revised)"))
    new = not_toxic(spark, sf, docs).select(
        "doc_id", F.when(F.col("lang") == "en", revised).otherwise(F.col("text")).alias("text")
    )
    gone = tables.scan(spark, sf, "labels").filter("toxic = 1").select("doc_id")
    return index.sync_index(old, new, "doc_id", "text", deleted=gone, **options)


@query
def index_sync_deletes(spark, sf):
    return _synced(spark, sf).select("doc_id", "text", F.size("vector").cast("long").alias("n_terms"), "norm2")


@query
def index_sync_dense(spark, sf):
    return _synced(spark, sf, encode=index.hashed_encoder(64)).select("doc_id", "text", _length("embedding"))


@query
def keyword_search(spark, sf):
    """One batch of questions in a scan of the documents, without stored postings."""
    rows = search.with_term_vector(documents(spark, sf).select("doc_id", "text"), "text")
    asked = search.with_term_vector(_questions(spark, sf), "question")
    return _rounded(search.keyword_search(rows, asked, 3, id_col="doc_id", query_id="item_id"))


@query
def keyword_search_stored(spark, sf):
    """Over a stored inverted table, of which a question reads the blocks that can matter."""
    path = _folder(spark, "postings")
    postings.write_postings(documents(spark, sf), path, "doc_id", "text")
    asked = search.with_term_vector(_questions(spark, sf), "question")
    return _rounded(postings.search_postings(spark, path, asked, 3, id_col="doc_id", query_id="item_id"))


@query
def index_sync(spark, sf):
    docs = documents(spark, sf)
    old = index.build_index(labelled(spark, sf, docs), "doc_id", "text", check_key=False)
    revised = F.concat(X.collapse_whitespace(F.col("text")), F.lit(" (revised)"))
    new = not_toxic(spark, sf, docs).select("doc_id", F.when(F.col("lang") == "en", revised).otherwise(F.col("text")).alias("text"))
    return index.sync_index(old, new, "doc_id", "text").select(
        "doc_id", "text", F.size("vector").cast("long").alias("n_terms"), "norm2"
    )


# --- prompts, scoring, experiments ------------------------------------------------


@query
def render_prompt(spark, sf):
    values = {"name": F.concat(F.lit("doc "), "doc_id"), "position": F.col("source"), "club": F.col("lang"),
              "summary": X.lead_words(F.col("text"), 25)}
    return documents(spark, sf).select("doc_id", P.render(P.RECOMMEND_TEMPLATE, values).alias("prompt"))


@query
def wrap_prompt(spark, sf):
    return tables.scan(spark, sf, "conversations").select(
        "conv_id", "turn", P.wrap(F.lit(P.DEFAULT_SYSTEM_PROMPT), F.col("text")).alias("prompt")
    )


@query
def message_list(spark, sf):
    turns = tables.scan(spark, sf, "conversations")
    return turns.select(
        "conv_id", "turn", F.inline(P.message_list(F.lit(P.DEFAULT_SYSTEM_PROMPT), F.col("text")))
    )


@query
def message_content(spark, sf):
    messages = P.message_list(F.lit(P.DEFAULT_SYSTEM_PROMPT), F.col("text"))
    return tables.scan(spark, sf, "conversations").select(
        "conv_id", "turn", flow.message_content(messages).alias("content")
    )


@query
def styled_prompts(spark, sf):
    grid = experiments.experiment_grid(_questions(spark, sf))
    return grid.select("item_id", "run_name", P.style_prompt(F.col("prompt_style")).alias("system_prompt"))


@query
def request_defaults(spark, sf):
    asked = tables.scan(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.col("text").alias("prompt"),
        F.when(F.col("role") == "user", F.lit(0.1)).alias("temperature"),
    )
    return infer.with_request_defaults(asked)


@query
def batch_score(spark, sf):
    prompt = P.render("Use this report. content: {text}", {"text": F.col("text")})
    asked = documents(spark, sf).select("doc_id", prompt.alias("prompt"), F.lit(50).cast("long").alias("max_new_tokens"))
    return infer.batch_score(asked).select("doc_id", "model_output")


@query
def batch_score_marker(spark, sf):
    """Texts that hold the content marker themselves are answered from their beginning."""
    text = F.concat(F.lit("Table of content: "), F.col("text"))
    prompt = P.render("Use this report. content: {text}", {"text": text})
    asked = documents(spark, sf).select("doc_id", prompt.alias("prompt"), F.lit(50).cast("long").alias("max_new_tokens"))
    return infer.batch_score(asked).select("doc_id", "model_output")


@query
def batch_score_injected(spark, sf):
    """The path of an injected model: request columns in Arrow batches, the model built once per task."""
    prompt = P.render("Use this report. content: {text}", {"text": F.col("text")})
    asked = _turns(spark, sf).select("conv_id", "turn", prompt.alias("prompt"), F.lit(20).cast("long").alias("max_new_tokens"))
    return infer.batch_score(asked, infer.LeadScorer).select("conv_id", "turn", "model_output")


@query
def batch_score_seeded(spark, sf):
    """A sampling scorer whose choice follows from the row's key, not from its batch."""
    asked = documents(spark, sf).select("doc_id", F.lit("Report:").alias("prompt"), F.lit(0.7).alias("temperature"), F.lit(5).cast("long").alias("max_new_tokens"), "text")
    scored = infer.score_all(asked, {"sampled": infer.SampledScorer}, ["doc_id"], seed=7, content=F.col("text"))
    return scored.select("doc_id", "sampled")


@query
def experiment_log(spark, sf):
    """A log of all runs in which one style is run again with other questions: only its runs are replaced."""
    path = _folder(spark, "results")
    asked = _questions(spark, sf).withColumnRenamed("question", "text")
    experiments.log_results(experiments.run_experiments(asked, "text", "item_id"), path, ["item_id"])
    again = experiments.run_experiments(asked.withColumn("text", F.concat(F.lit("again "), "text")), "text", "item_id")
    experiments.log_results(again.filter("prompt_style = 'DIRECT'"), path, ["item_id"])
    return spark.read.parquet(path).select("item_id", F.col("run_name").cast("string").alias("run_name"), *experiments.RESULT_COLUMNS)


@query
def strip_prompt(spark, sf):
    turns = tables.scan(spark, sf, "conversations")
    prompt = P.wrap(F.lit(P.DEFAULT_SYSTEM_PROMPT), F.col("role"))
    output = F.when(F.col("role") == "user", F.concat(prompt, F.col("text"))).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", P.strip_prompt(output, prompt).alias("answer"))


@query
def lead_summary(spark, sf):
    return documents(spark, sf).select("doc_id", X.lead_words(F.col("text"), 50).alias("summary"))


def _retrieved(spark, sf, threshold):
    """Questions with the text of their best document, retrieved once each."""
    docs, asked = documents(spark, sf), _questions(spark, sf)
    hits = search.text_search(docs, asked, 3, **_TEXT_COLUMNS)
    top = hits.filter((F.col("rank") == 1) & (F.col("score") > threshold))
    found = search.attach_columns(top, docs, "doc_id", ["text", "source", "lang"]).drop("rank")
    return asked.join(found, "item_id", "left").withColumn("matched", F.col("score").isNotNull())


@query
def recommend(spark, sf):
    found = _retrieved(spark, sf, TEXT_GATE)
    values = {"name": F.concat(F.lit("doc "), "doc_id"), "position": F.col("source"), "club": F.col("lang"),
              "summary": X.lead_words(X.collapse_whitespace(F.col("text")), 50)}
    answer = F.when(F.col("matched"), P.render(P.RECOMMEND_TEMPLATE, values)).otherwise("no matching report")
    return found.select("item_id", "doc_id", F.round("score", 6).alias("score"), "matched", answer.alias("answer"))


@query
def experiment_results(spark, sf):
    results = experiments.run_experiments(_retrieved(spark, sf, TEXT_GATE), "text", "item_id")
    return results.select("item_id", "run_group", "run_name", "prompt_style", "temperature", "prompt", "model_output")


RUNS = [f"{s}_{t}" for s in experiments.GRID_STYLES for t in experiments.GRID_TEMPERATURES]


@query
def compare_by_prompt(spark, sf):
    asked = _questions(spark, sf).withColumnRenamed("question", "text")
    results = experiments.run_experiments(asked, "text", "item_id")
    shortened = results.withColumn("model_output", F.concat_ws(": ", "run_name", "model_output"))
    return experiments.compare_by_prompt(shortened, "item_id", RUNS)


# --- flows ------------------------------------------------------------------------


def _ask(template: str, n: int, out: str, **columns: str) -> flow.Step:
    """Render a template over columns and score it with the built-in scorer."""

    def step(df: DataFrame) -> DataFrame:
        prompt = P.render(template, {name: F.col(c) for name, c in columns.items()})
        request = df.withColumn("prompt", prompt).withColumn("max_new_tokens", F.lit(n).cast("long"))
        return infer.batch_score(request, out=out).drop("prompt", "system_prompt", "temperature", "max_new_tokens")

    return step


@query
def flow_sequence(spark, sf):
    run = flow.chain(_ask("Tell a joke. content: {topic}", 12, "answer", topic="question"))
    return _questions(spark, sf).transform(run).select("item_id", "answer")


@query
def flow_two_step(spark, sf):
    run = flow.chain(
        _ask("Which city? content: {topic}", 3, "city", topic="question"),
        flow.assign(language=F.lit("German")),
        _ask("Which country? content: in {language}, {city}", 4, "country", city="city", language="language"),
    )
    return _questions(spark, sf).transform(run).select("item_id", "city", "country")


@query
def flow_parallel(spark, sf):
    labels = tables.scan(spark, sf, "labels")
    run = flow.parallel(
        "doc_id",
        passed=flow.passthrough(labels)["quality"],
        mult=F.col("quality") * 3,
        modified=F.col("quality") + 1,
        joke=infer.lead_answer(P.render("content: joke on {x} now", {"x": F.col("doc_id")}), 3),
        poem=infer.lead_answer(P.render("content: poem on {x} now", {"x": F.col("toxic")}), 3),
    )
    return labels.transform(run)


@query
def flow_parallel_scored(spark, sf):
    """Two scorers over the same rows in one pass, each with a prompt of its own."""
    labels = tables.scan(spark, sf, "labels").withColumn("prompt", F.lit(""))
    asked = {name: {"prompt": P.render(f"content: {name} on {{x}} now", {"x": F.col("doc_id")}), "max_new_tokens": F.lit(n).cast("long")} for name, n in (("joke", 3), ("poem", 2))}
    scored = infer.score_all(labels, {"joke": infer.LeadScorer, "poem": infer.LeadScorer}, ["doc_id"], requests=asked)
    return scored.select("doc_id", "quality", "joke", "poem")


def _topics(spark, sf):
    turns = tables.scan(spark, sf, "conversations")
    return infer.classify(turns, "text", list(TOPICS), rules=TOPIC_RULES)


@query
def classify_rows(spark, sf):
    return _topics(spark, sf).select("conv_id", "turn", "topic")


class TopicScorer:
    """A stand-in for a model that answers with a topic: the rules, read off the prompt."""

    def __call__(self, requests):
        return requests["prompt"].map(self.answer)

    @staticmethod
    def answer(prompt: str) -> str:
        question = prompt.split("<question>", 1)[1].rsplit("</question>", 1)[0].lower()
        found = (label for label, marks in TOPIC_RULES.items() if any(m in question for m in marks))
        return f" {next(found, 'unknown').title()}\n"


@query
def classify_scored(spark, sf):
    turns = infer.classify(_turns(spark, sf), "text", list(TOPICS), factory=TopicScorer)
    return turns.select("conv_id", "turn", "topic")


@query
def route_rows(spark, sf):
    question = {"question": F.col("text")}
    topic = X.normalise_label(F.col("topic"))
    branches = [(topic.contains(name), P.render(template, question)) for name, template in ROUTES.items()]
    prompt = flow.route(branches, P.render(DEFAULT_ROUTE, question))
    return _topics(spark, sf).select("conv_id", "turn", "topic", prompt.alias("prompt"))


@query
def dispatch_rows(spark, sf):
    def handler(name: str, words: int) -> flow.Step:
        return lambda df: df.select(
            "conv_id", "turn", F.lit(name).alias("handler"), X.lead_words(F.col("text"), words).alias("answer")
        )

    branches = [(F.col("topic") == "english", handler("english", 5)), (F.col("topic") == "german", handler("german", 7))]
    return flow.dispatch(_topics(spark, sf), branches, handler("general", 9))


# --- conversations ----------------------------------------------------------------


def _turns(spark, sf):
    return spread(tables.scan(spark, sf, "conversations"))


@query
def history_buffer(spark, sf):
    return chat.history_buffer(_turns(spark, sf)).select("conv_id", "turn", "history")


@query
def turn_pairs(spark, sf):
    return chat.turn_pairs(_turns(spark, sf))


@query
def history_summary(spark, sf):
    return chat.history_summary(_turns(spark, sf))


@query
def summary_last_words(spark, sf):
    """The bounded variant: a summary that keeps 20 words."""
    return chat.fold_summary(chat.turn_pairs(_turns(spark, sf)), lambda: keep_last_words(20))


@query
def summary_fold(spark, sf):
    """Summaries that depend on every turn so far."""
    return chat.fold_mergeable(chat.turn_pairs(_turns(spark, sf)), chat.RunningSummary)


def _one_conversation(spark, sf):
    """A derived conversation that holds every turn of the table, with gaps of its own."""
    place = F.col("conv_id") * 1_000 + F.col("turn")
    return _turns(spark, sf).select(F.lit(1).cast("long").alias("conv_id"), place.alias("turn"), "role", "text")


@query
def summary_fold_hot(spark, sf):
    """One conversation that holds all rows, folded by many tasks."""
    return chat.fold_mergeable(chat.turn_pairs(_one_conversation(spark, sf)), chat.RunningSummary)


@query
def turn_pairs_gaps(spark, sf):
    """Pairs and bounded summaries over turn numbers with gaps of any size."""
    turns = _one_conversation(spark, sf)
    pairs, summaries = chat.turn_pairs(turns, block_rows=16), chat.history_summary(turns, block_rows=16)
    return summaries.join(pairs, ["conv_id", "turn"], "left")


@query
def accumulate_query(spark, sf):
    return chat.accumulate_query(_turns(spark, sf)).select("conv_id", "turn", "request")


@query
def turn_keywords(spark, sf):
    return chat.turn_keywords(_turns(spark, sf))


@query
def chat_recommend(spark, sf):
    return _rounded(
        chat.chat_recommend(
            _turns(spark, sf), documents(spark, sf), doc_id="doc_id", doc_text="text", threshold=CHAT_GATE
        )
    )


@query
def chat_history_full(spark, sf):
    """As ``chat_recommend``, English documents only, with the prompt that the scorer is given."""
    answers = chat.chat_recommend(
        _turns(spark, sf), documents(spark, sf), doc_id="doc_id", doc_text="text", threshold=CHAT_GATE, filters={"lang": "en"}
    )
    return _rounded(answers).select("conv_id", "turn", "doc_id", "score", "prompt", "answer")


@query
def chat_long_history(spark, sf):
    """Histories of one derived conversation that holds every turn of the table."""
    turns = _turns(spark, sf).select(F.lit(1).cast("long").alias("conv_id"), F.col("turn").alias("old"), "role", "text", F.col("conv_id").alias("of"))
    placed = turns.withColumn("_order", F.col("of") * 1_000_000 + F.col("old"))
    long = ordered.renumber(placed, "conv_id", "_order", "turn")
    return chat.history_buffer(long.select("conv_id", "turn", "role", "text")).select(
        "conv_id", "turn", F.length("history").alias("n_chars"), F.md5("history").alias("digest")
    )


@query
def chat_refine(spark, sf):
    turns = _turns(spark, sf)
    requests = chat.accumulate_query(turns).select("conv_id", "turn", "request")
    return _rounded(
        chat.chat_recommend(
            turns, documents(spark, sf), doc_id="doc_id", doc_text="text", requests=requests, threshold=CHAT_GATE
        )
    )


# --- pages --------------------------------------------------------------------------


@query
def page_title(spark, sf):
    return tables.scan(spark, sf, "pages").select("page_id", H.title(F.col("html")).alias("title"))


@query
def page_last_segment(spark, sf):
    pages = tables.scan(spark, sf, "pages")
    return pages.select("page_id", H.last_colon_segment(F.col("html"), ".").alias("segment"))


@query
def page_text(spark, sf):
    pages = spread(tables.scan(spark, sf, "pages"))
    return pages.select("page_id", H.page_text(F.col("html")).alias("text"))


@query
def page_links(spark, sf):
    pages = spread(tables.scan(spark, sf, "pages"))
    return pages.select("page_id", F.posexplode(H.links(F.col("html"))).alias("link_idx", "href"))


@query
def page_label_field(spark, sf):
    return entity_pages(spark, sf).select(
        "doc_id", X.or_unknown(H.label_field(F.col("html"), entities.POSITION_LABEL)).alias("position")
    )


@query
def page_element_by_id(spark, sf):
    return entity_pages(spark, sf).select(
        "doc_id", X.or_unknown(H.element_by_id(F.col("html"), entities.BIRTHDAY_ID)).alias("birthday")
    )


@query
def age_from_date(spark, sf):
    born = H.element_by_id(F.col("html"), entities.BIRTHDAY_ID)
    age = X.age_in_years(born, F.lit(AS_OF).cast("date"))
    return entity_pages(spark, sf).select("doc_id", X.or_unknown(age).alias("age"))


STAT_COLUMNS = ("Statistic", "Value")


@query
def page_table(spark, sf):
    return entities.page_table(entity_pages(spark, sf), "doc_id", "scout", STAT_COLUMNS)


@query
def dropna_subset(spark, sf):
    return entities.drop_missing(entities.page_table(entity_pages(spark, sf), "doc_id", "scout", STAT_COLUMNS))


@query
def page_table_by_header(spark, sf):
    """Columns swapped, a table in a cell, an attribute that ends in ``id``, entities; some pages without the table."""
    docs = documents(spark, sf)
    table = F.concat(
        F.lit('<div data-id="scout"><table data-id="scout"><tr><td>no</td></tr></table></div><table class=t id=scout>'
              "<tr><th>Value</th><th>Statistic</th></tr><tr><td>"), F.col("n_chars").cast("string"),
        F.lit("<table><tr><td>inner</td></tr></table></td><td>chars &eacute;&#233;&#xE9; &amp;lt; &nope;</td></tr><tr><td>"),
        F.col("lang"), F.lit("</td><td>lang</td></tr></table>"),
    )
    html = F.concat(F.lit("<html>"), F.when(F.col("lang") != "fr", table).otherwise(F.lit("")), F.lit("</html>"))
    return entities.page_table(docs.select("doc_id", html.alias("html")), "doc_id", "scout", ("Statistic", "Value", "Rank"))


@query
def page_entities(spark, sf):
    html = F.concat(F.lit("<p>Caf&eacute; &#233;&#xe9; &hellip; &amp;lt; &unknown; &#x1F600;&nbsp;"), H.escape(F.col("text")), F.lit("</p>"))
    return documents(spark, sf).select("doc_id", H.page_text(html).alias("text"))


@query
def rows_to_markdown(spark, sf):
    rows = entities.page_table(entity_pages(spark, sf), "doc_id", "scout", STAT_COLUMNS)
    return entities.rows_to_markdown(entities.drop_missing(rows), "doc_id", "row_idx", STAT_COLUMNS)


@query
def entity_report(spark, sf):
    pages = entity_pages(spark, sf).withColumn("name", F.concat(F.lit("doc "), "doc_id"))
    reports = entities.entity_reports(
        pages, name="name", table_id="scout", columns=STAT_COLUMNS, as_of=F.lit(AS_OF).cast("date")
    )
    return reports.select("doc_id", "position", "birthday", "age", "club", "statistics", "report")


# --- flagship -------------------------------------------------------------------------


@query
def answer_questions(spark, sf):
    """Prepare documents, keep those within budget, search, gate and answer every question."""
    raw = documents(spark, sf)
    clean = raw.select("doc_id", X.collapse_whitespace(F.col("text")).alias("document"))
    docs = corpus.within_budget(compute_once(clean, document_num_tokens=X.token_count(F.col("document"))))
    asked = _questions(spark, sf)
    hits = search.text_search(
        docs, asked, 3, id_col="doc_id", text="document", query_id="item_id", query_text="question", buckets=64
    )
    top = hits.filter((F.col("rank") == 1) & (F.col("score") > GATE))
    found = search.attach_columns(top, raw, "doc_id", ["text", "source", "lang"]).drop("rank")
    values = {"name": F.concat(F.lit("doc "), "doc_id"), "position": F.col("source"), "club": F.col("lang"),
              "summary": X.lead_words(X.collapse_whitespace(F.col("text")), 50)}
    matched = F.col("score").isNotNull()
    answer = F.when(matched, P.render(P.RECOMMEND_TEMPLATE, values)).otherwise("no matching report")
    return asked.join(found, "item_id", "left").select(
        "item_id", "doc_id", F.round("score", 6).alias("score"), matched.alias("matched"), answer.alias("answer")
    )
