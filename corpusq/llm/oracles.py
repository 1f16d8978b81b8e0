"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from corpusq.llm import decontaminate, jaccard, linefreq, repair

OP6 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS host, text, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), tri AS (
  SELECT doc_id, r.i, w[r.i] || ' ' || w[r.i + 1] || ' ' || w[r.i + 2] AS g
  FROM d, unnest(range(1, len(w) - 1)) AS r(i)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri), unnest([0, 1, 2]) AS u(k)
  WHERE c >= 2 GROUP BY doc_id
), exact AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
  GROUP BY doc_id
), plain AS (
  SELECT doc_id, host, trim(line, ' ') AS line FROM (
    SELECT doc_id, host, unnest(string_split(regexp_replace(regexp_replace(lower(t), '[0-9]', '0', 'g'),
           '[ \t\x0B\f\r]{{2,}}|[\t\x0B\f\r]', ' ', 'g'), chr(10))) AS line FROM d)
), lines AS (
  SELECT doc_id, host, md5(line) AS h, length(line) - length(replace(line, ' ', '')) + 1 AS words FROM plain WHERE line <> ''
), hosts AS (
  SELECT host, count(DISTINCT text) + max((text IS NULL)::int) AS n FROM d GROUP BY host
), frequent AS (
  SELECT host, h FROM (
    SELECT host, h, any_value(n) AS n, count(DISTINCT t) AS docs
    FROM lines JOIN hosts USING (host) JOIN (SELECT doc_id, t FROM d) USING (doc_id) GROUP BY host, h)
  WHERE docs > {linefreq.MIN_DOCS} AND docs > {linefreq.HOST_SHARE}::DOUBLE * n
), gone AS (
  SELECT doc_id, count(*) AS n, sum(words) AS words FROM lines JOIN frequent USING (host, h) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(exact.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.n, 0)::BIGINT AS n_removed_lines, coalesce(gone.words, 0)::BIGINT AS n_removed_words
  FROM d LEFT JOIN exact USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT *, NOT base_failed AND n_words - n_removed_words >= {linefreq.MIN_LEFT}::DOUBLE * n_words AS kept FROM f
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> str:
    plain = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return rf"regexp_extract_all({plain}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP3 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, {words('text')} AS w FROM documents),
i AS (SELECT item_id::varchar AS item, {words('text')} AS w FROM benchmark),
cut AS (
  SELECT item, w[s + 1 : s + {decontaminate.WINDOW}] AS terms
  FROM i, unnest(range(greatest(len(w) - {decontaminate.WINDOW}, 0) + 1)) AS r(s) WHERE len(w) > 0
), windows AS MATERIALIZED (SELECT DISTINCT item, array_to_string(terms, ' ') AS win, terms FROM cut),
wins AS MATERIALIZED (SELECT DISTINCT win, terms FROM windows),
grams AS (
  SELECT doc_id, p AS pos, n, array_to_string(w[p + 1 : p + n], ' ') AS g
  FROM d, (SELECT DISTINCT len(terms) AS n FROM wins) AS l(n), unnest(range(len(w) - n + 1)) AS r(p)
), hits AS MATERIALIZED (SELECT doc_id, pos, n, win FROM grams JOIN wins ON g = win),
covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM hits, unnest(range(n)) AS r(k) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits JOIN windows USING (win)) GROUP BY doc_id
), tok AS MATERIALIZED (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos FROM d),
df AS (SELECT term, count(*) AS df FROM tok GROUP BY term),
parts AS (SELECT win, len(terms) AS n, unnest(terms) AS term, generate_subscripts(terms, 1) AS off FROM wins),
known AS (SELECT win, n, term, off, df, count(*) OVER (PARTITION BY win) AS there FROM parts JOIN df USING (term)),
rare AS MATERIALIZED (
  SELECT win, term, row_number() OVER (PARTITION BY win ORDER BY df, off) AS k
  FROM (SELECT win, term, any_value(df) AS df, min(off) AS off FROM known WHERE there = n GROUP BY ALL)
  QUALIFY k <= {decontaminate.NEAR_WORDS}
), size_of AS (SELECT win, count(*) AS m FROM rare GROUP BY win),
spot AS (SELECT win, m, doc_id, pos FROM rare JOIN size_of USING (win) JOIN tok USING (term) WHERE k = 1),
close AS (
  SELECT s.win, s.doc_id FROM spot s LEFT JOIN rare r ON r.win = s.win AND r.k > 1
  LEFT JOIN tok t ON t.doc_id = s.doc_id AND t.term = r.term
    AND t.pos BETWEEN s.pos - {decontaminate.NEAR_SPAN} AND s.pos + {decontaminate.NEAR_SPAN}
  GROUP BY s.win, s.m, s.doc_id, s.pos HAVING count(DISTINCT CASE WHEN t.pos IS NOT NULL THEN r.k END) = s.m - 1
), near AS (SELECT doc_id, count(DISTINCT win) AS n FROM close GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated, coalesce(near.n, 0)::BIGINT AS n_near
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near USING (doc_id)
"""

OP4 = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, text, {words('text')} AS w FROM documents),
texts AS MATERIALIZED (
  SELECT md5(text) AS node, any_value(w) AS w, min(doc_id) AS rep, count(*) AS copies FROM d WHERE len(w) > 0 GROUP BY text
), sets AS MATERIALIZED (
  SELECT DISTINCT node, array_to_string(w[s + 1 : s + {jaccard.SHINGLE}], ' ') AS g
  FROM texts, unnest(range(greatest(len(w) - {jaccard.SHINGLE}, 0) + 1)) AS r(s)
), sizes AS (SELECT node, count(*) AS n FROM sets GROUP BY node),
common AS (SELECT a.node AS a, b.node AS b, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.node <> b.node GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b
  WHERE c / (x.n + y.n - c)::DOUBLE >= {jaccard.THRESHOLD}::DOUBLE
), reach(a, b) AS (
  SELECT node, node FROM texts UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), classes AS (SELECT a AS node, min(rep) AS class_id FROM reach JOIN texts ON node = b GROUP BY a),
degrees AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, coalesce(class_id, d.doc_id) AS class_id, coalesce(degrees.n, 0)::BIGINT AS n_links,
       coalesce(copies, 1)::BIGINT AS n_copies
FROM d LEFT JOIN texts ON texts.node = md5(d.text) AND len(d.w) > 0
LEFT JOIN classes USING (node) LEFT JOIN degrees USING (node)
"""


#: A state of the fold: cost in nine digits, the audit, chr(1), the repaired lines. Such texts compare as (cost, audit).
NONE = "'900000000' || chr(1)"


def _edit(state: str, cost: str, letter: str, line: str = "''") -> str:
    cut = f"strpos({state}, chr(1))"
    return (
        f"lpad((substr({state}, 1, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({state}, 10, {cut} - 10) || '{letter}'"
        f" || substr({state}, {cut}) || {line}"
    )


def _row_step(place: int) -> str:
    """The least way through row ``x`` that ends at a place of the grammar, from the states ``a.v``."""
    ways = [_edit(f"a.v[{place + 1}]", "2", repair.DELETE)]
    more = f"(CASE WHEN x.fault = 'truncated' THEN {repair.TRUNCATED_COST} ELSE 0 END)"
    for (p, initial), q in repair._NEXT.items():
        if q != place:
            continue
        state = f"a.v[{p + 1}]"
        keep = _edit(state, more, repair.KEEP, "chr(10) || x.role || ':' || x.txt")
        ways.append(f"CASE WHEN x.fault IN ('', 'truncated') AND x.ini = '{initial}' THEN {keep} ELSE {NONE} END")
        if initial in repair.ROLES:
            change = _edit(state, f"1 + {more}", repair.RELABEL, f"chr(10) || '{repair.ROLES[initial]}:' || x.txt")
            ways.append(f"CASE WHEN x.fault IN ('', 'truncated') THEN {change} ELSE {NONE} END")
    return f"least({', '.join(ways)})"


def _insert(state: str, initial: str) -> str:
    return _edit(state, str(repair.COSTS[repair.INSERT]), repair.INSERT, f"chr(10) || '{repair.ROLES[initial]}:'")


def _closed(states: str) -> str:
    """The states after any inserted rows: a user's from start, system or assistant, then an assistant's."""
    user = f"least(t[3], {_insert('t[1]', 'u')}, {_insert('t[2]', 'u')}, {_insert('t[4]', 'u')})"
    return (
        f"list_transform([list_transform([{states}], lambda t: [t[1], t[2], {user}, t[4]])[1]],"
        f" lambda t: [t[1], t[2], t[3], least(t[4], {_insert('t[3]', 'a')})])[1]"
    )


def _first_state() -> str:
    return _closed(f"['000000000' || chr(1), {NONE}, {NONE}, {NONE}]")


_CRC = """
crc AS MATERIALIZED (
  SELECT list(list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) ORDER BY i) AS tab
  FROM range(256) r(i)
), keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
         xor(list_reduce(list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT),
             lambda c, b: xor(c // 256, tab[xor(c, b) % 256 + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % 20 AS kind
  FROM keyed, crc
)"""

OP11 = rf"""
WITH {_CRC}, damaged AS MATERIALIZED (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(txt, '.!?', '') ELSE txt END AS txt,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(txt), copy) AS pos,
         rtrim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged
), judged AS (
  SELECT *, substr(role, 1, 1) AS ini,
         CASE WHEN body = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, txt ORDER BY pos) > 1 THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM placed
), folded AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || ini NOT IN {repair.LEGAL}) AS illegal,
         list_reduce(
           list({{'ini': ini, 'fault': fault, 'role': role, 'txt': txt, 'v': ['']}} ORDER BY pos),
           lambda a, x: {{'ini': '', 'fault': '', 'role': '', 'txt': '', 'v': {_closed('[' + ', '.join(map(_row_step, range(4))) + ']')}}},
           {{'ini': '', 'fault': '', 'role': '', 'txt': '', 'v': {_first_state()}}}).v AS states
  FROM judged GROUP BY conv_id
), best AS (
  SELECT *, least(states[1], states[4]) AS s FROM folded
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(substr(s, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(s, 10, strpos(s, chr(1)) - 10), '') AS audit,
       sha256(coalesce(substr(s, strpos(s, chr(1)) + 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_positional_index": OP3, "op4_lsh_forest": OP4, "op6_line_frequency": OP6, "op11_cyk_repair": OP11}
