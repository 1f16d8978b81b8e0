"""The prefix-filter join against all pairs."""

import hashlib
import math
import re
from collections import Counter

import pytest

from corpusq.operators import textjoin

WORD = re.compile(r"\w+")
BUCKETS = 1 << 18


def vector(text):
    return Counter(int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % BUCKETS for w in WORD.findall(text.lower()))


def brute(docs, asks, threshold, k, skip):
    known = [(i, vector(t)) for i, t in docs if i is not None and t is not None]
    df = Counter(t for _, v in known for t in v)
    idf = lambda t: math.floor(math.log((1 + len(known)) / (1 + df[t])) * 1000 + 0.5)
    weigh = lambda v: {t: n * idf(t) for t, n in v.items()}
    index = [(i, weigh(v)) for i, v in known]
    out = []
    for q, text in asks:
        if q is None or text is None:
            continue
        own = weigh(vector(text))
        n = sum(w * w for w in own.values())
        found = []
        for i, v in index:
            m = sum(w * w for w in v.values())
            dot = sum(w * v.get(t, 0) for t, w in own.items())
            if n and m and not (skip and i == q) and dot / (math.sqrt(n) * math.sqrt(m)) > threshold:
                found.append((-dot / (math.sqrt(n) * math.sqrt(m)), i))
        out += [(q, i, round(-s, 9), r + 1) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def rows(n=150, words=90):
    common = "the of and to in a is that for it".split()
    out = []
    for i in range(n):
        own = [f"w{(i * 7 + j * j * (1 + i % 11)) % words}" for j in range(12)] + [common[(i + j) % 10] for j in range(8)]
        out.append((i, " ".join(own)))
        if i % 3 == 0:
            out.append((1000 + i, " ".join(own[:-2] + [f"edit{i}"])))  # a near copy
        if i % 10 == 0:
            out += [(2000 + 10 * i + c, " ".join(own)) for c in range(6)]  # copies
    out += [(9000 + i, "the same hot text of a third of all rows") for i in range(120)]
    out += [(9500, ""), (9501, None), (None, "w1 w2 w3"), (9502, "***"), (9503, "the the the the"), (9504, "unique words only here")]
    return out


def got(df, q="q"):
    return sorted((r[q], r.id, round(r.score, 9), r["rank"]) for r in df.collect())


@pytest.mark.parametrize("threshold", [0.3, 0.7, 0.95])
@pytest.mark.parametrize("salt", [4, 512])
def test_join_of_a_table_with_itself(spark, monkeypatch, threshold, salt):
    monkeypatch.setattr(textjoin, "SALT_ROWS", salt)
    data = rows()
    df = spark.createDataFrame(data, "id long, body string")
    found = got(textjoin.text_join(df, None, threshold, 3, id_col="id", text="body", query_id="q"))
    assert found == brute(data, data, threshold, 3, True)
    assert max(h[1] for h in found if h[0] == 9119) == 9002  # of many copies the smallest ids


def test_join_of_questions(spark):
    data = rows()
    asks = [(1, "w1 w2 w3 w4 the of"), (2, data[0][1]), (3, ""), (4, None), (None, "w1"), (5, "nothing of this kind"), (6, data[0][1])]
    df = spark.createDataFrame(data, "id long, body string")
    questions = spark.createDataFrame(asks, "q long, ask string")
    columns = {"id_col": "id", "text": "body", "query_id": "q", "query_text": "ask"}
    assert got(textjoin.text_join(df, questions, 0.3, 4, **columns)) == brute(data, asks, 0.3, 4, False)
    assert textjoin.text_join(df.limit(0), questions, 0.3, 4, **columns).count() == 0
    assert textjoin.text_join(df, questions.limit(0), 0.3, 4, **columns).count() == 0
    with pytest.raises(ValueError, match="between"):
        textjoin.text_join(df, questions, 1.0, **columns)


def test_few_pairs_are_scored_and_none_is_joined_blindly(spark, monkeypatch):
    data = rows(300, 1500)
    seen = []
    score = textjoin.scored
    monkeypatch.setattr(textjoin, "scored", lambda pairs, *a: seen.append(pairs) or score(pairs, *a))
    df = spark.createDataFrame(data, "id long, body string")
    textjoin.text_join(df, None, 0.7, 3, id_col="id", text="body", query_id="q").collect()
    n = len({r[1] for r in data})
    assert seen[0].count() < 0.1 * n * n / 2
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_blocks_that_meet_in_rounds_lose_and_repeat_no_pair(spark, monkeypatch):
    """Vectors meet by blocks: no table of shared terms or of pairs is shuffled, and a round's shuffle files go as it ends."""
    monkeypatch.setattr(textjoin, "BLOCK_ROWS", 40)
    monkeypatch.setattr(textjoin, "ROUND_GROUPS", 12)
    written, rounds, store = [], [], textjoin.stored

    def keep(df, name):
        if name == "candidates":
            rounds.append(df)
        out = store(df, name)
        written.append((name, out))
        return out

    monkeypatch.setattr(textjoin, "stored", keep)
    data = rows()
    asks = [(i, data[3 * i][1]) for i in range(60)]
    df, questions = spark.createDataFrame(data, "id long, body string"), spark.createDataFrame(asks, "q long, ask string")
    columns = {"id_col": "id", "text": "body", "query_id": "q"}
    assert got(textjoin.text_join(df, None, 0.7, 3, **columns)) == brute(data, data, 0.7, 3, True)
    assert len(rounds) > 1
    pairs = [(r.a, r.b) for name, out in written if name == "candidates" for r in out.collect()]
    assert pairs and len(pairs) == len(set(pairs))
    vectors = next(out.count() for name, out in written if name == "vectors")
    assert all(out.count() <= 40 * vectors for _, out in written)
    assert got(textjoin.text_join(df, questions, 0.3, 3, query_text="ask", **columns)) == brute(data, asks, 0.3, 3, False)
