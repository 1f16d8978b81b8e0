"""SQL equivalents of the queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

from corpusq.functions import prompts as P
from corpusq.functions import terms as V
from corpusq.functions import text as X
from corpusq.operators import experiments
from corpusq.operators.approximate import random_planes
from corpusq.operators.chat import RunningSummary
from corpusq.plans import queries as Q


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def filled(template: str, **values: str) -> str:
    """A template as a SQL concatenation; a NULL value is empty."""
    pieces = re.split(r"\{(\w+)\}", template)
    out = [
        f"coalesce(({values[p]})::varchar, '')" if i % 2 else lit(p) for i, p in enumerate(pieces) if p or i % 2
    ]
    return "(" + " || ".join(out) + ")"


def words(expr: str) -> str:
    return f"regexp_extract_all(lower({expr}), '{X.WORD_PATTERN}')"


def tokens(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '{X.TOKEN_PATTERN}'))::bigint"


def collapse(expr: str) -> str:
    return rf"regexp_replace({expr}, '\s+', ' ', 'g')"


def lead(expr: str, n: int | str) -> str:
    return f"array_to_string((string_split({expr}, ' '))[1:{n}], ' ')"


def content(expr: str) -> str:
    """What follows the first marker, or all."""
    return f"(CASE WHEN contains({expr}, 'content: ') THEN substr({expr}, strpos({expr}, 'content: ') + 9) ELSE {expr} END)"


def bucket(word: str, buckets: int) -> str:
    return f"('0x' || substr(md5({word}), 1, 8))::bigint % {buckets}"


def strip(expr: str) -> str:
    return rf"regexp_replace({expr}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g')"


#: The entities that the fixture pages hold.
PAGE_ENTITIES = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "#39": "'", "copy": "©", "middot": "·", "amp": "&"}


def unescape(expr: str) -> str:
    for entity, char in PAGE_ENTITIES.items():
        expr = f"replace({expr}, {lit(f'&{entity};')}, {lit(char)})"
    return expr


def inner_text(expr: str) -> str:
    return unescape(f"regexp_replace({expr}, '<[^>]*>', '', 'g')")


def term_table(table: str, key: str, text: str, buckets: int) -> str:
    return (
        f"SELECT {key}, {bucket('w', buckets)} AS term, count(*) AS tf "
        f"FROM (SELECT {key}, unnest({words(text)}) AS w FROM {table}) GROUP BY ALL"
    )


def search(docs: str, doc_id: str, text: str, asks: str, ask_id: str, question: str, buckets: int, k: int = 3) -> str:
    """CTEs ending in ``hits(ask_id, doc_id, score, rank)``."""
    return f"""
      dt AS MATERIALIZED ({term_table(docs, doc_id, text, buckets)}),
      qt AS MATERIALIZED ({term_table(asks, ask_id, question, buckets)}),
      dn AS (SELECT {doc_id}, sum(tf * tf)::bigint AS n2 FROM dt GROUP BY ALL),
      qn AS (SELECT {ask_id}, sum(tf * tf)::bigint AS n2 FROM qt GROUP BY ALL),
      dots AS (SELECT {ask_id}, {doc_id}, sum(qt.tf * dt.tf)::bigint AS dot FROM qt JOIN dt USING (term) GROUP BY ALL),
      scored AS (SELECT {ask_id}, {doc_id}, dot / (sqrt(qn.n2::double) * sqrt(dn.n2::double)) AS score
                 FROM dots JOIN dn USING ({doc_id}) JOIN qn USING ({ask_id})),
      hits AS (SELECT *, row_number() OVER (PARTITION BY {ask_id} ORDER BY score DESC, {doc_id})::int AS rank
               FROM scored QUALIFY rank <= {k})"""


CLEAN = f"clean AS (SELECT *, {collapse('text')} AS document FROM documents)"
LABELLED = "doc_id IN (SELECT doc_id FROM labels)"
NOT_TOXIC = "doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"
FILTERED = "SELECT doc_id, lang, source, n_chars FROM documents WHERE "
CHUNKED = f"""{CLEAN},
  toks AS (SELECT *, string_split(document, ' ') AS t FROM clean WHERE document <> ''),
  chunked AS (SELECT doc_id, lang, source, document, i::bigint AS chunk_index,
                     array_to_string(t[i * 150 + 1 : i * 150 + 200], ' ') AS text, doc_id || '_' || i AS id
              FROM (SELECT *, unnest(range(0, greatest(0, ceil((len(t) - 200) / 150.0))::bigint + 1)) AS i FROM toks))"""

# Entity pages: what the extraction must give back, computed from the tables themselves.
ENTITY = """entity AS (
    SELECT d.doc_id, source AS position, 'FC ' || lang AS club, n_chars, quality, text, lang, source,
           CASE WHEN quality IS NOT NULL THEN strftime(born, '%B %-d, %Y') ELSE 'n/a' END AS birthday,
           CASE WHEN quality IS NOT NULL
                THEN ((DATE '""" + Q.AS_OF + """' - born) // 365)::varchar ELSE 'Unknown' END AS age
    FROM (SELECT *, (DATE '1980-01-01' + (n_chars % 9000)::int)::date AS born FROM documents) d
    LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
STATS = """stats AS (
    SELECT doc_id, 0 AS row_idx, 'characters' AS "Statistic", n_chars::varchar AS "Value" FROM entity
    UNION ALL SELECT doc_id, 1, NULL, '-' FROM entity
    UNION ALL SELECT doc_id, 2, 'quality', quality::varchar FROM entity)"""
MARKDOWN = (
    "'| Statistic | Value |' || chr(10) || '| --- | --- |' || chr(10) || '| characters | ' || n_chars || ' |' "
    "|| chr(10) || '| quality | ' || coalesce(quality::varchar, '') || ' |'"
)

DOT = "list_inner_product(q.embedding::double[], d.embedding::double[])"
NORM = "sqrt(list_inner_product({0}.embedding::double[], {0}.embedding::double[]))"
COSINE = f"{DOT} / ({NORM.format('q')} * {NORM.format('d')})"
RANKED = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::int AS rank"


def vector_hits(score: str = COSINE, where: str = "true") -> str:
    return f"""
      pairs AS (SELECT q.vec_id AS query_id, d.vec_id, {score} AS score
                FROM embeddings q, embeddings d WHERE {where}),
      hits AS (SELECT *, {RANKED} FROM pairs QUALIFY rank <= 3)"""


def boilerplate(quantifier: str) -> str:
    report = (
        "'Scouting Report for doc ' || doc_id || chr(10) || 'Position: ' || source || chr(10) || text "
        "|| chr(10) || 'Position: ' || lang || ' end'"
    )
    document = (
        f"'player name: doc ' || doc_id || ' player scouting report: ' || {report} || ' player position: ' || source"
    )
    return (
        f"SELECT doc_id, regexp_replace({collapse(document)}, "
        f"'scouting report: Scouting Report for .*{quantifier} Position:', '', 'g') AS document FROM documents"
    )


MEASURED = f"""{CLEAN},
  rows AS (SELECT doc_id, document, source, {tokens('document')} AS document_num_tokens,
                  length(document)::int AS document_num_chars,
                  len(string_split_regex(document, '\\s'))::int AS document_num_words FROM clean)"""


def topic(expr: str) -> str:
    cases = " ".join(
        f"WHEN {' OR '.join(f'contains(lower({expr}), {lit(m)})' for m in marks)} THEN '{label}'"
        for label, marks in Q.TOPIC_RULES.items()
    )
    return f"CASE {cases} ELSE 'other' END"


TOPICS = f"topics AS (SELECT *, {topic('text')} AS topic FROM conversations)"
LINE = "role || ': ' || text"
SUMMARY = f"""summaries AS (
    SELECT conv_id, turn, {lead("(string_split(h, 'New summary:'))[-1]", 50)} AS summary
    FROM (SELECT *, coalesce(string_agg({LINE}, ' ') OVER (PARTITION BY conv_id ORDER BY turn
          ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS h FROM conversations))"""
ACCUMULATED = """accumulated AS (
    SELECT conv_id, turn, string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS request
    FROM conversations WHERE role = 'user')"""


def keyword_table(table: str, text: str) -> str:
    return f"""
      wt AS (SELECT conv_id, turn, w, count(*) AS tf
             FROM (SELECT conv_id, turn, unnest({words(text)}) AS w FROM {table}) GROUP BY ALL),
      wf AS (SELECT w, count(*) AS df FROM wt GROUP BY ALL),
      ws AS (SELECT conv_id, turn, w, round(tf * ln((1 + (SELECT count(*) FROM {table})) / (1 + df)), 6) AS s
             FROM wt JOIN wf USING (w)),
      wr AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY s DESC, w) AS r
             FROM ws QUALIFY r <= 10),
      kw AS (SELECT conv_id, turn, string_agg(w, ' ' ORDER BY r) AS keywords FROM wr GROUP BY ALL)"""


HISTORY = f"""
      SELECT conv_id, turn, coalesce(string_agg({LINE}, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS history FROM conversations"""


def chat_answers(requests: str, where: str = "true", columns: str | None = None) -> str:
    report = "coalesce(d.text, 'no matching report')"
    prompt = filled(P.ANSWER_TEMPLATE, history="history", report=report)
    columns = columns or "keywords, top.doc_id, round(score, 6) AS score, score IS NOT NULL AS matched, "
    return f"""
      WITH past AS ({HISTORY}), {requests},
      asks AS (SELECT conv_id, turn, request AS keywords, conv_id || '_' || turn AS ask_id FROM requests),
      found AS (SELECT * FROM documents WHERE {where}),
      {search('found', 'doc_id', 'text', 'asks', 'ask_id', 'keywords', V.DEFAULT_BUCKETS)},
      top AS (SELECT * FROM hits WHERE rank = 1 AND score > {Q.CHAT_GATE})
      SELECT r.conv_id, r.turn, {columns} {prompt} AS prompt, {lead(report, 100)} AS answer
      FROM requests r JOIN past USING (conv_id, turn) LEFT JOIN asks USING (conv_id, turn)
      LEFT JOIN top USING (ask_id) LEFT JOIN documents d ON d.doc_id = top.doc_id"""


def retrieved(threshold: float) -> str:
    return f"""
      asks AS (SELECT item_id, text AS question FROM benchmark),
      {search('documents', 'doc_id', 'text', 'asks', 'item_id', 'question', V.DEFAULT_BUCKETS)},
      top AS (SELECT * FROM hits WHERE rank = 1 AND score > {threshold}),
      found AS (SELECT a.item_id, question, top.doc_id, score, d.text, source, lang
                FROM asks a LEFT JOIN top USING (item_id) LEFT JOIN documents d ON d.doc_id = top.doc_id)"""


GRID = "(VALUES " + ", ".join(
    f"('{s}', {float(t)}::double, '{s}_{t}')" for s in experiments.GRID_STYLES for t in experiments.GRID_TEMPERATURES
) + ") AS g(prompt_style, temperature, run_name)"
REPORT = "coalesce(text, 'no matching report')"
REPORT_PROMPT = "'Use this report. content: ' || coalesce(text, 'no matching report')"


def recommendation(club: str, position: str, summary: str, name: str = "'doc ' || doc_id") -> str:
    return filled(P.RECOMMEND_TEMPLATE, name=name, position=position, club=club, summary=summary)


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources, projection, filters
    sql["scan_documents"] = "SELECT doc_id, text, lang, source, n_chars FROM documents"
    sql["snapshot_diff"] = f"""
      WITH o AS (SELECT doc_id, text, lang FROM documents WHERE {LABELLED}),
      n AS (SELECT doc_id, {collapse('text')} AS text, lang FROM documents WHERE {NOT_TOXIC})
      SELECT coalesce(o.doc_id, n.doc_id) AS doc_id,
             CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END AS change
      FROM o FULL JOIN n ON o.doc_id = n.doc_id
      WHERE o.doc_id IS NULL OR n.doc_id IS NULL
         OR o.text IS DISTINCT FROM n.text OR o.lang IS DISTINCT FROM n.lang"""
    sql["landing_csv"] = "SELECT doc_id, text, CASE WHEN lang <> 'es' THEN lang END AS lang FROM documents"
    sql["overwrite_table"] = "SELECT doc_id, lang FROM documents WHERE lang = 'en'"
    sql["overwrite_merging_schema"] = "SELECT doc_id, NULL::varchar AS lang, n_chars FROM documents WHERE lang = 'fr'"
    sql["append_rows"] = "SELECT doc_id, lang, CASE WHEN lang = 'en' THEN n_chars END AS n_chars FROM documents"
    sql["align_schema"] = "SELECT doc_id, NULL::varchar AS lang, NULL::varchar AS source, n_chars FROM documents"
    sql["rows_of_settings"] = """
      SELECT lang, doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' END AS name, NULL::varchar AS other FROM documents"""
    sql["namespace_table"] = "SELECT doc_id, lang FROM documents"
    sql["write_clustered"] = "SELECT lang, doc_id FROM documents WHERE doc_id >= 100"
    sql["stream_sync"] = f"""
      WITH s AS (SELECT doc_id, {collapse("CASE WHEN doc_id % 5 = 0 THEN text || ' (revised)' ELSE text END")} AS text, lang
                 FROM documents WHERE doc_id % 10 <> 0),
      t AS ({term_table('s', 'doc_id', 'text', V.DEFAULT_BUCKETS)})
      SELECT doc_id, text, lang, coalesce(sum(tf * tf), 0)::bigint AS norm2 FROM s LEFT JOIN t USING (doc_id) GROUP BY ALL"""
    revised = f"SELECT doc_id, CASE WHEN lang = 'en' THEN {collapse('text')} || ' (revised)' ELSE text END AS text, lang FROM documents WHERE {NOT_TOXIC}"
    sql["change_log"] = f"""
      WITH o AS (SELECT doc_id, text, lang FROM documents WHERE {LABELLED}), n AS ({revised})
      SELECT doc_id, 'insert' AS kind, 1::bigint AS version, text, lang FROM o
      UNION ALL
      SELECT coalesce(o.doc_id, n.doc_id), CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete' ELSE 'update' END,
             2, n.text, n.lang
      FROM o FULL JOIN n ON o.doc_id = n.doc_id WHERE o.doc_id IS NULL OR n.doc_id IS NULL OR o.text <> n.text OR o.lang <> n.lang"""
    sql["change_feed_index"] = f"""
      WITH s AS ({revised}), t AS ({term_table('s', 'doc_id', 'text', V.DEFAULT_BUCKETS)})
      SELECT doc_id, text, lang, count(term) AS n_terms, coalesce(sum(tf * tf), 0)::bigint AS norm2
      FROM s LEFT JOIN t USING (doc_id) GROUP BY ALL"""
    sql["project_alias"] = (
        "SELECT doc_id AS player_id, text AS document, source AS player_position FROM documents"
    )
    sql["bulk_rename"] = (
        "SELECT doc_id AS player_id, text AS report, lang, source AS player_position, n_chars FROM documents"
    )
    sql["filter_token_budget"] = (
        f"SELECT * FROM (SELECT doc_id, {tokens('text')} AS document_num_tokens FROM documents) "
        "WHERE document_num_tokens <= 2000"
    )
    sql["limit_by_key"] = "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 500"
    sql["filter_eq"] = FILTERED + "lang = 'en'"
    sql["filter_range"] = FILTERED + "n_chars <= 2000 AND n_chars > 200"
    sql["filter_in"] = FILTERED + "lang IN ('en', 'de')"
    sql["filter_or"] = FILTERED + "lang = 'fr' OR source = 'src1'"
    sql["filter_not"] = FILTERED + "NOT lang = 'en'"
    sql["table_shape"] = """
      SELECT (SELECT count(*) FROM documents) AS n_rows,
             (SELECT count(*) FROM (DESCRIBE documents)) AS n_columns"""

    # scalar functions
    sql["assemble_document"] = """
      SELECT doc_id, 'player name: doc ' || doc_id || chr(10) || chr(10) || 'player scouting report: ' || text
             || chr(10) || chr(10) || 'player position: ' || source AS document FROM documents"""
    sql["collapse_whitespace"] = f"SELECT doc_id, {collapse('text')} AS document FROM documents"
    sql["strip_boilerplate"] = boilerplate("")
    sql["strip_boilerplate_reluctant"] = boilerplate("?")
    sql["doc_metrics"] = rf"""
      SELECT doc_id, length(text)::int AS document_num_chars,
             len(string_split_regex(text, '\s'))::int AS document_num_words,
             {tokens('text')} AS document_num_tokens FROM documents"""
    sql["token_count"] = f"SELECT doc_id, {tokens('text')} AS num_tokens FROM documents"
    sql["clean_answer"] = """
      SELECT conv_id, turn, replace(replace('Answer: ' || text, chr(10), '<br/>'), 'Answer: ', '') AS answer
      FROM conversations"""
    sql["last_segment"] = """
      SELECT conv_id, turn, (string_split(CASE WHEN role = 'assistant' THEN role || ' New summary:' || text
             ELSE text END, 'New summary:'))[-1] AS summary FROM conversations"""
    sql["length_product"] = (
        "SELECT doc_id, length(text)::int AS a, (length(text) * length(source))::bigint AS b FROM documents"
    )
    sql["page_host"] = r"SELECT page_id, nullif(regexp_extract(url, '^\w+://([^/:?#]+)', 1), '') AS host FROM pages"

    # chunks
    sql["chunk_documents"] = f"WITH {CHUNKED} SELECT doc_id, chunk_index, text, id FROM chunked"
    sql["chunk_documents_udf"] = sql["chunk_documents"]
    sql["chunk_ids"] = f"WITH {CHUNKED} SELECT id, length(text)::int AS num_chars FROM chunked"
    sql["chunk_ordinal"] = f"""
      WITH {CHUNKED}
      SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index) - 1 AS chunk_index FROM chunked"""
    sql["chunk_with_metadata"] = f"""
      WITH {CHUNKED}, meta AS (
        SELECT doc_id, lang, source, {tokens('document')} AS document_num_tokens,
               length(document)::int AS document_num_chars,
               len(string_split_regex(document, '\\s'))::int AS document_num_words FROM clean)
      SELECT doc_id, chunk_index, text, id, m.* EXCLUDE (doc_id) FROM chunked JOIN meta m USING (doc_id)"""
    sql["chunk_carry_metadata"] = f"WITH {CHUNKED} SELECT doc_id, lang, source, chunk_index, text, id FROM chunked"
    sql["experiment_grid"] = f"SELECT item_id, prompt_style, temperature, run_name FROM benchmark, {GRID}"

    # set operations, aggregation
    sql["except_new_rows"] = f"""
      WITH {MEASURED}
      SELECT * EXCLUDE (doc_id) FROM rows EXCEPT SELECT * EXCLUDE (doc_id) FROM rows WHERE {LABELLED}"""
    sql["new_rows_by_key"] = f"SELECT doc_id, lang, text FROM documents WHERE NOT {LABELLED}"
    sql["token_profile"] = f"""
      SELECT avg(n) AS mean_tokens, max(n) AS max_tokens, min(n) AS min_tokens,
             sum(CASE WHEN n > 3500 THEN 1 ELSE 0 END)::bigint AS long_documents
      FROM (SELECT {tokens('text')} AS n FROM documents)"""
    sql["latest_version"] = """
      SELECT event_type AS name, max(try_cast(user_id::varchar AS bigint)) AS latest_version
      FROM events GROUP BY event_type"""

    # vectors
    sql["embed_hashed"] = f"""
      WITH t AS ({term_table('documents', 'doc_id', 'text', 64)}),
      grid AS (SELECT doc_id, unnest(range(64)) AS term FROM documents)
      SELECT doc_id, string_agg(coalesce(tf, 0)::varchar, ' ' ORDER BY term) AS counts,
             CASE WHEN sum(tf) > 0 THEN 1.0::double ELSE 0.0::double END AS length
      FROM grid LEFT JOIN t USING (doc_id, term) GROUP BY doc_id"""
    sql["index_build"] = f"""
      WITH t AS ({term_table('documents', 'doc_id', 'text', V.DEFAULT_BUCKETS)})
      SELECT d.doc_id, lang, count(term) AS n_terms, coalesce(sum(tf), 0)::bigint AS n_words,
             coalesce(sum(tf * tf), 0)::bigint AS norm2
      FROM documents d LEFT JOIN t USING (doc_id) GROUP BY ALL"""
    sql["topk_similar"] = f"""
      WITH {vector_hits()}
      SELECT query_id, rank, vec_id, label, round(score, 6) AS score FROM hits JOIN embeddings USING (vec_id)"""
    sql["topk_filtered"] = f"""
      WITH {vector_hits(where='d.label = 3')} SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits"""
    distance = "list_distance(q.embedding::double[], d.embedding::double[])"
    sql["topk_euclidean"] = f"""
      WITH {vector_hits(f'1.0::double / (1.0::double + {distance} * {distance})')}
      SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits"""
    sql["best_hit_gated"] = f"""
      WITH {vector_hits(where='q.vec_id <> d.vec_id')},
      top AS (SELECT * FROM hits WHERE rank = 1 AND score > {Q.VECTOR_GATE})
      SELECT e.vec_id AS query_id, top.vec_id, round(score, 6) AS score, score IS NOT NULL AS matched
      FROM embeddings e LEFT JOIN top ON top.query_id = e.vec_id"""
    sql["hits_gated"] = f"""
      WITH {vector_hits(where='q.vec_id <> d.vec_id')}
      SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits
      WHERE query_id IN (SELECT query_id FROM hits WHERE rank = 1 AND score > {Q.VECTOR_GATE})"""
    planes = random_planes(**Q.LSH).T.tolist()
    bits = Q.LSH["bits"]
    sql["topk_lsh"] = f"""
      WITH planes AS (SELECT unnest({planes}::double[][]) AS p, unnest(range({len(planes)})) AS n),
      sides AS (SELECT vec_id, n // {bits} AS part,
                       sum(CASE WHEN list_inner_product(embedding::double[], p) > 0 THEN 1 << (n % {bits}) ELSE 0 END) AS s
                FROM embeddings, planes GROUP BY ALL),
      near AS (SELECT DISTINCT q.vec_id AS query_id, d.vec_id FROM sides q JOIN sides d USING (part, s)
               WHERE q.vec_id <> d.vec_id),
      pairs AS (SELECT query_id, d.vec_id, {COSINE} AS score FROM near
                JOIN embeddings q ON q.vec_id = query_id JOIN embeddings d ON d.vec_id = near.vec_id),
      hits AS (SELECT *, {RANKED} FROM pairs QUALIFY rank <= 3)
      SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits"""
    bits, probes = Q.PROBES["bits"], Q.PROBES["probes"]
    planes = random_planes(64, 1, bits, Q.PROBES["seed"])
    unit = (planes / (planes**2).sum(axis=0) ** 0.5).T.tolist()
    sql["topk_multiprobe"] = f"""
      WITH planes AS (SELECT unnest({unit}::double[][]) AS p, unnest(range({bits})) AS n),
      sides AS (SELECT vec_id, n, list_inner_product(embedding::double[], p) AS x FROM embeddings, planes),
      own AS (SELECT vec_id, sum(CASE WHEN x > 0 THEN 1 << n ELSE 0 END)::bigint AS bucket FROM sides GROUP BY ALL),
      cost AS (SELECT vec_id, m, sum(CASE WHEN (m >> n) & 1 = 1 THEN x * x ELSE 0 END) AS c FROM sides, range({1 << bits}) AS r(m) GROUP BY ALL),
      visits AS (SELECT vec_id AS query_id, xor(bucket, m) AS bucket FROM cost JOIN own USING (vec_id)
                 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY c, m) <= {probes}),
      near AS (SELECT query_id, vec_id FROM visits JOIN own USING (bucket) WHERE query_id <> vec_id),
      pairs AS (SELECT query_id, d.vec_id, {COSINE} AS score FROM near
                JOIN embeddings q ON q.vec_id = query_id JOIN embeddings d ON d.vec_id = near.vec_id),
      hits AS (SELECT *, {RANKED} FROM pairs QUALIFY rank <= 3)
      SELECT query_id, vec_id, round(score, 6) AS score, rank FROM hits"""
    asks = "asks AS (SELECT item_id, text AS question FROM benchmark)"
    for name, buckets in (("text_search", V.DEFAULT_BUCKETS), ("text_search_dense64", 64)):
        sql[name] = f"""
          WITH {asks}, {search('documents', 'doc_id', 'text', 'asks', 'item_id', 'question', buckets)}
          SELECT item_id, doc_id, round(score, 6) AS score, rank FROM hits"""
    sql["text_search_filtered"] = f"""
      WITH {asks}, few AS (SELECT * FROM documents WHERE lang = 'en' AND n_chars > 500),
      {search('few', 'doc_id', 'text', 'asks', 'item_id', 'question', V.DEFAULT_BUCKETS)}
      SELECT item_id, doc_id, round(score, 6) AS score, rank, lang, n_chars FROM hits JOIN documents USING (doc_id)"""
    sql["text_search_encoder"] = f"""
      WITH {asks}, {search('documents', 'doc_id', 'text', 'asks', 'item_id', 'question', 64, k=1)}
      SELECT item_id, round(score, 4) AS score, rank FROM hits"""
    gated = """
      df AS (SELECT term, count(*) AS df FROM dt GROUP BY term),
      idf AS (SELECT term, round(ln((1 + (SELECT count(*) FROM documents)) / (1 + coalesce(df, 0))) * 1000)::bigint AS idf
              FROM (SELECT DISTINCT term FROM qt UNION SELECT term FROM df) LEFT JOIN df USING (term)),
      d AS MATERIALIZED (SELECT doc_id, term, tf * idf AS w FROM dt JOIN idf USING (term)),
      q AS MATERIALIZED (SELECT query_id, term, tf * idf AS w FROM qt JOIN idf USING (term)),
      dn AS (SELECT doc_id, sum(w * w)::bigint AS n2 FROM d GROUP BY ALL),
      qn AS (SELECT query_id, sum(w * w)::bigint AS n2 FROM q GROUP BY ALL),
      dots AS (SELECT query_id, doc_id, sum(q.w * d.w)::bigint AS dot FROM q JOIN d USING (term) GROUP BY ALL),
      scored AS (SELECT query_id, doc_id, dot / (sqrt(qn.n2::double) * sqrt(dn.n2::double)) AS score
                 FROM dots JOIN dn USING (doc_id) JOIN qn USING (query_id))"""
    held = f"dt AS MATERIALIZED ({term_table('documents', 'doc_id', 'text', V.DEFAULT_BUCKETS)})"
    rank = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::int AS rank"
    sql["text_join"] = f"""
      WITH {held}, qt AS (SELECT doc_id AS query_id, term, tf FROM dt), {gated}
      SELECT query_id, doc_id, round(score, 6) AS score, {rank}
      FROM scored WHERE score > {Q.GATE} AND query_id <> doc_id QUALIFY rank <= 3"""
    sql["text_join_questions"] = f"""
      WITH {held}, qt AS ({term_table('(SELECT item_id AS query_id, text FROM benchmark)', 'query_id', 'text', V.DEFAULT_BUCKETS)}), {gated}
      SELECT query_id AS item_id, doc_id, round(score, 6) AS score, {rank}
      FROM scored WHERE score > {Q.TEXT_GATE} QUALIFY rank <= 3"""
    unit = "CASE WHEN count(term) > 0 THEN 1.0::double ELSE 0.0::double END AS length"
    sql["index_build_dense"] = f"""
      WITH t AS ({term_table('documents', 'doc_id', 'text', 64)})
      SELECT d.doc_id, lang, 64::bigint AS dim, {unit} FROM documents d LEFT JOIN t USING (doc_id) GROUP BY ALL"""
    synced = f"""
      s AS (SELECT doc_id, CASE WHEN lang = 'en' THEN {collapse('text')} || ' (revised)' ELSE text END AS text
            FROM documents WHERE {NOT_TOXIC})"""
    sql["index_sync_deletes"] = f"""
      WITH {synced}, t AS ({term_table('s', 'doc_id', 'text', V.DEFAULT_BUCKETS)})
      SELECT doc_id, text, count(term) AS n_terms, coalesce(sum(tf * tf), 0)::bigint AS norm2
      FROM s LEFT JOIN t USING (doc_id) GROUP BY ALL"""
    sql["index_sync_dense"] = f"""
      WITH {synced}, t AS ({term_table('s', 'doc_id', 'text', 64)})
      SELECT doc_id, text, {unit} FROM s LEFT JOIN t USING (doc_id) GROUP BY ALL"""
    sql["keyword_search"] = f"""
      WITH dt AS ({term_table('documents', 'doc_id', 'text', V.DEFAULT_BUCKETS)}),
      qt AS ({term_table('benchmark', 'item_id', 'text', V.DEFAULT_BUCKETS)}),
      idf AS (SELECT term, round(ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) * 1000000)::bigint AS idf
              FROM dt GROUP BY term),
      scored AS (SELECT item_id, doc_id, sum(dt.tf * idf)::bigint / 1000000 AS score
                 FROM qt JOIN dt USING (term) JOIN idf USING (term) GROUP BY ALL),
      hits AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::int AS rank
               FROM scored WHERE score > 0 QUALIFY rank <= 3)
      SELECT item_id, doc_id, round(score, 6) AS score, rank FROM hits"""
    sql["keyword_search_stored"] = sql["keyword_search"]
    sql["index_sync"] = f"""
      WITH s AS (SELECT doc_id, CASE WHEN lang = 'en' THEN {collapse('text')} || ' (revised)' ELSE text END AS text
                 FROM documents WHERE {NOT_TOXIC}
                 UNION ALL SELECT doc_id, text FROM documents WHERE {LABELLED} AND NOT ({NOT_TOXIC})),
      t AS ({term_table('s', 'doc_id', 'text', V.DEFAULT_BUCKETS)})
      SELECT doc_id, text, count(term) AS n_terms, coalesce(sum(tf * tf), 0)::bigint AS norm2
      FROM s LEFT JOIN t USING (doc_id) GROUP BY ALL"""

    # prompts, scoring, experiments
    sql["render_prompt"] = (
        f"SELECT doc_id, {recommendation('lang', 'source', lead('text', 25))} AS prompt FROM documents"
    )
    system = lit(P.DEFAULT_SYSTEM_PROMPT)
    wrapped = "{a} || {s} || {m} || {{0}} || {c}".format(
        a=lit(P.WRAP_OPEN), s=system, m=lit(P.WRAP_MIDDLE), c=lit(P.WRAP_CLOSE)
    )
    sql["wrap_prompt"] = f"SELECT conv_id, turn, {wrapped.format('text')} AS prompt FROM conversations"
    sql["message_list"] = f"""
      SELECT conv_id, turn, 'system' AS role, {system} AS content FROM conversations
      UNION ALL SELECT conv_id, turn, 'user', text FROM conversations"""
    sql["message_content"] = "SELECT conv_id, turn, text AS content FROM conversations"
    styles = " ".join(f"WHEN '{s}' THEN {lit(p)}" for s, p in P.STYLES.items())
    sql["styled_prompts"] = (
        f"SELECT item_id, run_name, CASE prompt_style {styles} END AS system_prompt FROM benchmark, {GRID}"
    )
    sql["request_defaults"] = f"""
      SELECT conv_id, turn, text AS prompt, CASE WHEN role = 'user' THEN 0.1 ELSE 1.0 END::double AS temperature,
             {system} AS system_prompt, 100::bigint AS max_new_tokens FROM conversations"""
    scored = content("'Use this report. content: ' || text")
    sql["batch_score"] = f"SELECT doc_id, {lead(scored, 50)} AS model_output FROM documents"
    sql["batch_score_marker"] = f"SELECT doc_id, {lead("'Table of content: ' || text", 50)} AS model_output FROM documents"
    sql["batch_score_injected"] = f"SELECT conv_id, turn, {lead('text', 20)} AS model_output FROM conversations"
    sql["batch_score_seeded"] = """
      SELECT doc_id, array_to_string(w[s + 1 : s + 5], ' ') AS sampled FROM (
        SELECT doc_id, w, (('0x' || substr(md5('7' || chr(31) || doc_id), 1, 8))::bigint % 2147483648) % len(w) AS s
        FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))"""
    logged = "'Use this report. content: ' || {0} AS prompt, {1} AS model_output"
    parts = [("prompt_style <> 'DIRECT'", "text"), ("prompt_style = 'DIRECT'", "'again ' || text")]
    sql["experiment_log"] = " UNION ALL ".join(
        f"SELECT item_id, run_name, prompt_style, temperature, {logged.format(t, lead(t, 150))} FROM benchmark, {GRID} WHERE {where}"
        for where, t in parts
    )
    sql["strip_prompt"] = "SELECT conv_id, turn, text AS answer FROM conversations"
    sql["lead_summary"] = f"SELECT doc_id, {lead('text', 50)} AS summary FROM documents"
    answer = recommendation("lang", "source", lead(collapse("text"), 50))
    sql["recommend"] = f"""
      WITH {retrieved(Q.TEXT_GATE)}
      SELECT item_id, doc_id, round(score, 6) AS score, score IS NOT NULL AS matched,
             CASE WHEN score IS NOT NULL THEN {answer} ELSE 'no matching report' END AS answer FROM found"""
    sql["experiment_results"] = f"""
      WITH {retrieved(Q.TEXT_GATE)}
      SELECT item_id, item_id::varchar AS run_group, run_name, prompt_style, temperature, {REPORT_PROMPT} AS prompt,
             {lead(REPORT, 150)} AS model_output FROM found, {GRID}"""
    runs = ", ".join(
        f"'{run}: ' || {lead(REPORT, 150)} AS \"{run}\"" for run in Q.RUNS
    )
    sql["compare_by_prompt"] = f"SELECT item_id, {REPORT_PROMPT} AS prompt, {runs} FROM benchmark"

    # flows
    joke = content("'Tell a joke. content: ' || text")
    sql["flow_sequence"] = f"SELECT item_id, {lead(joke, 12)} AS answer FROM benchmark"
    city = content("'Which city? content: ' || text")
    country = content("'Which country? content: in German, ' || city")
    sql["flow_two_step"] = f"""
      SELECT item_id, city, {lead(country, 4)} AS country
      FROM (SELECT item_id, {lead(city, 3)} AS city FROM benchmark)"""
    sql["flow_parallel"] = """
      SELECT doc_id, quality AS passed, quality * 3 AS mult, quality + 1 AS modified,
             'joke on ' || doc_id AS joke, 'poem on ' || toxic AS poem FROM labels"""
    sql["flow_parallel_scored"] = """
      SELECT doc_id, quality, 'joke on ' || doc_id AS joke, 'poem on' AS poem FROM labels"""
    sql["classify_rows"] = f"WITH {TOPICS} SELECT conv_id, turn, topic FROM topics"
    sql["classify_scored"] = sql["classify_rows"]
    routes = " ".join(f"WHEN '{n}' THEN {filled(t, question='text')}" for n, t in Q.ROUTES.items())
    sql["route_rows"] = f"""
      WITH {TOPICS}
      SELECT conv_id, turn, topic, CASE topic {routes} ELSE {filled(Q.DEFAULT_ROUTE, question='text')} END AS prompt
      FROM topics"""
    sql["dispatch_rows"] = f"""
      WITH {TOPICS}
      SELECT conv_id, turn, CASE WHEN topic IN ('english', 'german') THEN topic ELSE 'general' END AS handler,
             CASE topic WHEN 'english' THEN {lead('text', 5)} WHEN 'german' THEN {lead('text', 7)}
                  ELSE {lead('text', 9)} END AS answer
      FROM topics"""

    # conversations
    sql["history_buffer"] = HISTORY
    sql["chat_long_history"] = f"""
      SELECT 1::bigint AS conv_id, turn, length(history)::int AS n_chars, md5(history) AS digest FROM (
        SELECT row_number() OVER w - 1 AS turn, coalesce(string_agg({LINE}, chr(10)) OVER (ORDER BY conv_id, turn
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS history
        FROM conversations WINDOW w AS (ORDER BY conv_id, turn))"""
    sql["turn_pairs"] = """
      SELECT conv_id, turn, input, output FROM (
        SELECT conv_id, turn, role, text AS input,
               lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
               lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS output FROM conversations)
      WHERE role = 'user' AND next_role = 'assistant'"""
    sql["history_summary"] = f"WITH {SUMMARY} SELECT * FROM summaries"
    one = "SELECT 1::bigint AS conv_id, conv_id * 1000 + turn AS turn, role, text FROM conversations"

    def folded(table: str) -> str:
        pairs = sql["turn_pairs"].replace("FROM conversations", f"FROM ({table})")
        spaced = r"trim(regexp_replace(input || ' ' || output, '\s+', ' ', 'g'))"
        w = "OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return f"""
      WITH pairs AS ({pairs}),
      said AS (SELECT *, {spaced} AS t, ('0x' || substr(md5(input || ' ' || output), 1, 8))::bigint % {RunningSummary.MODULUS} AS v,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM pairs)
      SELECT conv_id, turn, place || ' pairs, ' || (sum(CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END) {w})::bigint
             || ' words, checksum ' || (sum(v * place) {w} % {RunningSummary.MODULUS})::bigint || ': '
             || array_to_string((string_split(trim(string_agg(t, ' ') OVER (PARTITION BY conv_id ORDER BY turn
                ROWS BETWEEN 24 PRECEDING AND CURRENT ROW)), ' '))[-20:], ' ') AS summary FROM said"""

    sql["summary_fold"] = folded("SELECT * FROM conversations")
    sql["summary_fold_hot"] = folded(one)
    gapped = f"""
      SELECT conv_id, turn, {lead("(string_split(h, 'New summary:'))[-1]", 50)} AS summary
      FROM (SELECT *, coalesce(string_agg({LINE}, ' ') OVER (ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), '') AS h FROM ({one}))"""
    sql["turn_pairs_gaps"] = f"""
      SELECT s.*, input, output FROM ({gapped}) s
      LEFT JOIN ({sql['turn_pairs'].replace('FROM conversations', f'FROM ({one})')}) p USING (conv_id, turn)"""
    sql["summary_last_words"] = rf"""
      WITH pairs AS ({sql['turn_pairs']}),
      said AS (SELECT conv_id, turn, string_agg(input || ' ' || output, ' ') OVER (PARTITION BY conv_id ORDER BY turn
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS t FROM pairs)
      SELECT conv_id, turn, array_to_string((string_split_regex(trim({collapse('t')}), ' '))[-20:], ' ') AS summary
      FROM said"""
    sql["stream_last_words"] = sql["summary_last_words"]
    sql["stream_memory"] = sql["summary_fold"]
    sql["accumulate_query"] = f"WITH {ACCUMULATED} SELECT * FROM accumulated"
    sql["turn_keywords"] = f"WITH {keyword_table('conversations', 'text')} SELECT * FROM kw".replace("WITH \n", "WITH ")
    sql["chat_recommend"] = chat_answers(
        "requests AS (SELECT conv_id, turn, text AS request FROM conversations WHERE role = 'user')"
    )
    sql["chat_history_full"] = chat_answers(
        "requests AS (SELECT conv_id, turn, text AS request FROM conversations WHERE role = 'user')",
        "lang = 'en'", "top.doc_id, round(score, 6) AS score, ",
    )
    sql["chat_refine"] = chat_answers(f"{ACCUMULATED}, requests AS (SELECT * FROM accumulated)")

    # pages
    title = strip(inner_text("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"))
    sql["page_title"] = f"SELECT page_id, nullif({title}, '') AS title FROM pages"
    paragraphs = r"regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1)"
    first = (
        f"(list_filter(list_transform({paragraphs}, lambda x: {inner_text('x')}), lambda y: contains(y, '.')))[1]"
    )
    sql["page_last_segment"] = f"SELECT page_id, {strip(f'(string_split({first}, chr(58)))[-1]')} AS segment FROM pages"
    bare = r"regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g')"
    text = collapse(unescape(f"regexp_replace({bare}, '<[^>]*>', ' ', 'g')"))
    sql["page_text"] = f"SELECT page_id, trim({text}) AS text FROM pages"
    hrefs = lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']""")
    sql["page_links"] = f"""
      SELECT page_id, (i - 1)::int AS link_idx, hrefs[i] AS href
      FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS i
            FROM (SELECT page_id, regexp_extract_all(html, {hrefs}, 1) AS hrefs FROM pages))"""
    sql["page_label_field"] = f"WITH {ENTITY} SELECT doc_id, position FROM entity"
    sql["page_element_by_id"] = f"WITH {ENTITY} SELECT doc_id, birthday FROM entity"
    sql["age_from_date"] = f"WITH {ENTITY} SELECT doc_id, age FROM entity"
    sql["page_table"] = f'WITH {ENTITY}, {STATS} SELECT doc_id, row_idx, "Statistic", "Value" FROM stats'
    sql["page_table_by_header"] = """
      WITH e AS (SELECT * FROM documents WHERE lang <> 'fr')
      SELECT doc_id, 0 AS row_idx, 'chars ééé &lt; &nope;' AS "Statistic", n_chars::varchar AS "Value", NULL::varchar AS "Rank" FROM e
      UNION ALL SELECT doc_id, 1, 'lang', lang, NULL FROM e"""
    sql["page_entities"] = f"""
      SELECT doc_id, trim({collapse("'Café éé … &lt; &unknown; 😀 ' || text")}) AS text FROM documents"""
    sql["dropna_subset"] = sql["page_table"] + ' WHERE "Statistic" IS NOT NULL'
    sql["rows_to_markdown"] = f"WITH {ENTITY} SELECT doc_id, {MARKDOWN} AS markdown FROM entity"
    page = (
        "'doc ' || doc_id || ' Position: ' || position || ' Footed: ' || lang || ' Born: ' || birthday || ' Club: ' "
        "|| club || ' Statistic Value characters ' || n_chars || ' - quality ' || coalesce(quality::varchar, '') "
        "|| ' ' || text"
    )
    sql["entity_report"] = f"""
      WITH {ENTITY}
      SELECT doc_id, position, birthday, age, club, {MARKDOWN} AS statistics,
             {lead(f"trim({collapse(page)})", 100)} AS report FROM entity"""

    # flagship
    answer = recommendation("lang", "source", lead("document", 50))
    sql["answer_questions"] = f"""
      WITH {CLEAN}, fits AS (SELECT * FROM clean WHERE {tokens('document')} <= 2000), {asks},
      {search('fits', 'doc_id', 'document', 'asks', 'item_id', 'question', 64)},
      top AS (SELECT * FROM hits WHERE rank = 1 AND score > {Q.GATE})
      SELECT a.item_id, top.doc_id, round(score, 6) AS score, score IS NOT NULL AS matched,
             CASE WHEN score IS NOT NULL THEN {answer.replace('doc_id', 'top.doc_id')} ELSE 'no matching report' END AS answer
      FROM asks a LEFT JOIN top USING (item_id) LEFT JOIN fits ON fits.doc_id = top.doc_id"""
    return sql
