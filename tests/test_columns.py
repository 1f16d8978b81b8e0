"""Column functions on inline rows: missing values, empty texts and other edges."""

import datetime

import pytest
from pyspark.sql import functions as F

from corpusq.functions import html as H
from corpusq.functions import prompts as P
from corpusq.functions import terms as V
from corpusq.functions import text as X
from corpusq.functions.predicates import compile_filter


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"s {kind}").select(fn(F.col("s")).alias("r")).first().r


def test_assemble_keeps_label_of_missing_value(spark):
    row = spark.createDataFrame([(None, "r", "p")], "n string, r string, p string")
    labels = dict(zip(X.DOCUMENT_LABELS, (F.col("n"), F.col("r"), F.col("p"))))
    assert row.select(X.assemble_document(labels)).first()[0] == (
        "player name:\n\nplayer scouting report: r\n\nplayer position: p"
    )


def test_collapse_whitespace(spark):
    assert one(spark, "a \n\t b  c", X.collapse_whitespace) == "a b c"


def test_boilerplate_greedy_and_reluctant(spark):
    text = "scouting report: Scouting Report for A Position: MF and Position: FW end"
    assert one(spark, text, X.strip_boilerplate) == " FW end"
    assert one(spark, text, lambda c: X.strip_boilerplate(c, reluctant=True)) == " MF and Position: FW end"
    assert one(spark, "no boilerplate", X.strip_boilerplate) == "no boilerplate"


@pytest.mark.parametrize("text,n", [("x  y ", 4), ("", 1), ("a", 1), (None, None)])
def test_word_count(spark, text, n):
    assert one(spark, text, X.word_count) == n


@pytest.mark.parametrize("text,n", [("Été, oui!", 4), ("", 0), ("  ", 0), (None, None)])
def test_token_count(spark, text, n):
    assert one(spark, text, X.token_count) == n


@pytest.mark.parametrize(
    "text,last",
    [("a New summary:b New summary:c", "c"), ("a New summary:b", "b"), ("a", "a"), ("", "")],
)
def test_last_segment(spark, text, last):
    assert one(spark, text, X.last_segment) == last


def test_clean_answer(spark):
    assert one(spark, "Answer: a\nAnswer: b.", X.clean_answer) == "a<br/>b."


@pytest.mark.parametrize(
    "text,age", [("November 2, 2000", 23), ("Unknown", None), ("", None), (None, None), ("June 2, 2023", 1), ("June 3, 2023", 0)]
)
def test_age_from_date(spark, text, age):
    as_of = F.lit(datetime.date(2024, 6, 1))
    assert one(spark, text, lambda c: X.age_in_years(c, as_of)) == age


@pytest.mark.parametrize(
    "html,position",
    [
        ("<p>x</p><p><b>Position:</b> FW Footed: Right</p>", "FW"),
        ("<p>Position: MF (AM) Footed: Left</p>", "MF"),
        ("<p>Position: MF</p>", "Position"),
        ("<p>Position MF</p>", None),
        ("<p>none</p>", None),
        ("", None),
    ],
)
def test_label_field(spark, html, position):
    assert one(spark, html, lambda c: H.label_field(c, "Position")) == position


def test_last_colon_segment(spark):
    assert one(spark, "<p>Club: a: FC B </p>", lambda c: H.last_colon_segment(c, "Club")) == "FC B"
    assert one(spark, "<p>Club</p>", lambda c: H.last_colon_segment(c, "Club")) == "Club"
    assert one(spark, "<p>x</p>", lambda c: H.last_colon_segment(c, "Club")) is None


def test_element_by_id(spark):
    page = '<span>a</span><span class="x" id="born"> May 1, 2000 </span>'
    assert one(spark, page, lambda c: H.element_by_id(c, "born")) == "May 1, 2000"
    assert one(spark, page, lambda c: H.element_by_id(c, "bor")) is None


def test_page_text_and_links(spark):
    page = (
        '<html><script>var t="</p>";</script><style>p{}</style><!-- ad --><p>a &amp;lt; b<br>c</p>'
        "<a class='k' href='/x?y=1'>l</a></html>"
    )
    assert one(spark, page, H.page_text) == "a &lt; b c l"
    assert one(spark, page, H.links) == ["/x?y=1"]


def test_table_rows(spark):
    page = (
        '<table id="other"><tr><td>no</td></tr></table><table class="a" id="scout">'
        "<tr><th>Statistic</th><th>V</th></tr><tr><td> </td><td>1</td></tr><tr><td>Goals</td><td>2</td></tr></table>"
    )
    rows = [["Statistic", "V"], [None, "1"], ["Goals", "2"]]
    assert one(spark, page, lambda c: H.table_rows(c, "scout")) == rows
    assert one(spark, page, lambda c: H.table_rows(c, "missing")) == []


def test_tables_inside_a_cell_at_any_depth(spark):
    inner = "deep"
    for level in range(10):
        inner = f"<TABLE class='t{level}'><tr><td>{inner}</td></tr></TABLE >"
    page = (
        f'<table id="scout"><tr><th>Statistic</th><th>V</th></tr><tr><td>a{inner}b</td><td>1{inner}{inner}</td></tr>'
        f"<tr><td>last</td><td>2</td></tr></table>{inner}<table><tr><td>behind</td></tr></table>"
    )
    rows = [["Statistic", "V"], ["ab", "1"], ["last", "2"]]
    assert one(spark, page, lambda c: H.table_rows(c, "scout")) == rows
    assert one(spark, '<table id="scout"><tr><td>open</td></tr>', lambda c: H.table_rows(c, "scout")) == [["open"]]
    assert one(spark, '<table id="scout"></table>', lambda c: H.table_rows(c, "scout")) == []


def test_entities_that_repeat_and_stand_alone(spark):
    text = "&amp;&amp;lt; &#65;&#x41;&#160;&nope;&#xD800;&#0;&eacute;&amp"
    assert one(spark, text, H.unescape) == "&&lt; AA &nope;&#xD800;&#0;é&amp"
    assert one(spark, "&amp;", H.unescape) == "&"
    assert one(spark, "&", H.unescape) == "&"


def test_escape_round_trip(spark):
    text = "a < b & c > d &copy; &amp;"
    assert one(spark, text, lambda c: H.inner_text(H.escape(c))) == text


def test_term_vector(spark):
    rows = one(spark, "b a B c.a b", V.word_counts)
    assert [(r.term, r.tf) for r in rows] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(spark, "", V.word_counts) == []
    assert one(spark, None, V.word_counts) is None
    assert one(spark, "x x y", lambda c: V.squared_norm(V.term_vector(c))) == 5


def test_dense_counts(spark):
    sparse = one(spark, "the quick the", lambda c: V.term_vector(c, 8))
    dense = one(spark, "the quick the", lambda c: V.dense_counts(V.term_vector(c, 8), 8))
    assert len(dense) == 8 and {r.term: r.tf for r in sparse} == {i: n for i, n in enumerate(dense) if n}
    assert one(spark, "", lambda c: V.dense_counts(V.term_vector(c, 4), 4)) == [0, 0, 0, 0]
    unit = one(spark, "the quick the", lambda c: V.l2_normalise(V.dense_counts(V.term_vector(c, 8), 8)))
    assert sum(x * x for x in unit) == pytest.approx(1)
    assert one(spark, "", lambda c: V.l2_normalise(V.dense_counts(V.term_vector(c, 2), 2))) == [0, 0]


def test_render(spark):
    row = spark.createDataFrame([("A", None)], "name string, club string")
    out = row.select(P.render("{name} at {club}, {{x}}", {"name": F.col("name"), "club": F.col("club")})).first()[0]
    assert out == "A at , {x}"
    with pytest.raises(ValueError, match="club"):
        P.render("{name} {club}", {"name": F.col("name")})


def test_wrap_and_strip(spark):
    assert one(spark, "do", lambda c: P.wrap(F.lit("sys"), c)) == (
        "<s>[INST]<<SYS>>\nsys\n<</SYS>>\n\n\ndo[/INST]\n"
    )
    assert one(spark, "promptanswer", lambda c: P.strip_prompt(c, F.lit("prompt"))) == "answer"
    assert one(spark, "answer", lambda c: P.strip_prompt(c, F.lit("prompt"))) == "answer"


def test_unknown_style_fails(spark):
    assert one(spark, "DIRECT", P.style_prompt) == P.STYLES["DIRECT"]
    with pytest.raises(Exception, match="unknown prompt style: LOUD"):
        one(spark, "LOUD", P.style_prompt)


ROWS = [(1, "x", 10), (2, "y", 20), (3, None, 30), (4, "z", None)]


@pytest.mark.parametrize(
    "filters,ids",
    [
        ({}, [1, 2, 3, 4]),
        ({"id": 2}, [2]),
        ({"n <": 20}, [1]),
        ({"n <=": 20}, [1, 2]),
        ({"n >": 20}, [3]),
        ({"n >=": 20, "id NOT": 3}, [2]),
        ({"a": ("x", "y")}, [1, 2]),
        ({"a": ["x"]}, [1]),
        ({"a OR n": ["x", 30]}, [1, 3]),
        ({"a OR n OR id": ["x", 30, 4]}, [1, 3, 4]),
        ({"a NOT": "x"}, [2, 4]),
        ({"a NOT": ("x", "y")}, [4]),
    ],
)
def test_filters(spark, filters, ids):
    df = spark.createDataFrame(ROWS, "id int, a string, n int")
    assert sorted(r.id for r in df.filter(compile_filter(filters, df.columns)).collect()) == ids


@pytest.mark.parametrize("filters", [{"b": 1}, {"a LIKE": "x"}, {"a OR n": ["x"]}, {"a OR n": "x"}])
def test_bad_filters(filters):
    with pytest.raises(ValueError):
        compile_filter(filters, ["id", "a", "n"])
