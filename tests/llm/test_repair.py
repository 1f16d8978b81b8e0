"""Conversation repair against exhaustive search, all-splits parsing and its SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusq.llm import oracles, queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")


def exhaustive(kinds):
    """The least (cost, audit) over all edit sequences with up to four inserted rows per gap."""
    best = None
    inserts = [""] + ["".join(x) for n in (1, 2, 3) for x in itertools.product("ua", repeat=n)]
    choices = []
    for k in kinds:
        more = 5 if k.isupper() else 0
        choices.append([(2, "D", "")] + ([] if k == "d" else [(more, "K", k.lower()), (1 + more, "R", "u"), (1 + more, "R", "a")]))
    for gaps in itertools.product(inserts, repeat=len(kinds) + 1):
        if sum(map(len, gaps)) > 4:
            continue
        for edits in itertools.product(*choices):
            roles = gaps[0] + "".join(e[2] + g for e, g in zip(edits, gaps[1:]))
            if LEGAL.fullmatch(roles):
                cost = sum(e[0] for e in edits) + 5 * sum(map(len, gaps))
                audit = "I" * len(gaps[0]) + "".join(e[1] + "I" * len(g) for e, g in zip(edits, gaps[1:]))
                best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("kinds", ["", "s", "u", "a", "x", "U", "ua", "sa", "au", "dd", "Ad", "xu", "sua", "aus", "uua", "SUA", "xxx", "uAd"])
def test_cells_equal_exhaustive_search(kinds):
    assert repair.cheapest(repair.span_cell(kinds)) == exhaustive(kinds)


@settings(max_examples=40, deadline=None)
@given(st.text("suaxSUAXd", min_size=2, max_size=9))
def test_one_split_is_as_good_as_all(kinds):
    n, cells = len(kinds), {}
    for length in range(1, n + 1):
        for i in range(n - length + 1):
            j = i + length
            cell = repair._row(kinds[i]) if length == 1 else None
            for k in range(i + 1, j):
                found = repair._product(cells[i, k], cells[k, j])
                cell = found if cell is None else repair._union(cell, found)
            cells[i, j] = cell
    assert cells[0, n] == repair.span_cell(kinds)


def brute(rows):
    """The contract in plain Python for rows in order: counts, cost, audit and digest."""
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest())
    rows = sorted(((c, t, " " if ro is None else ro, " " if x is None else x) for c, t, ro, x in rows), key=key)
    seen, kinds, counts = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
        kinds += "d" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    states = {0: (0, "", ())}  # a plain left-to-right search, places as in the grammar

    def closed(states):
        for _ in range(3):
            for (p, ini), q in repair._NEXT.items():
                if ini != "s" and p in states:
                    c, a, o = states[p]
                    states[q] = min(states.get(q, (1 << 30, "", ())), (c + 5, a + "I", o + (({"u": "user", "a": "assistant"}[ini], ""),)))
        return states

    states = closed(states)
    for (_, _, role, text), kind in zip(rows, kinds):
        new = {p: (c + 2, a + "D", o) for p, (c, a, o) in states.items()}
        if kind != "d":
            more = 5 if kind.isupper() else 0
            for (p, ini), q in repair._NEXT.items():
                if p in states:
                    c, a, o = states[p]
                    ways = [(c + more, a + "K", o + ((role, text),))] if kind.lower() == ini else []
                    if ini != "s":
                        ways.append((c + more + 1, a + "R", o + (({"u": "user", "a": "assistant"}[ini], text),)))
                    new[q] = min([*ways, *([new[q]] if q in new else [])], default=None) if ways or q in new else None
            new = {q: v for q, v in new.items() if v is not None}
        states = closed(new)
    cost, audit, out = min(v for p, v in states.items() if p in (0, 3))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return gaps, *counts.values(), illegal, cost, audit, digest


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        if kind:
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def odd_conversations():
    rng = random.Random(5)
    texts = ["Yes.", "No!", "", " \t", None, "cut off", "日本。", "Why?", "x" * 50_000 + ".", "ends. \n"]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(texts)) for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(100, None, "user", "a."), (100, None, "user", "a."), (100, 5, "assistant", "b."), (100, 9, "user", "a."), (None, None, None, None)]
    rows += [(None, 3, "user", "who?"), (None, 3, "user", "who?"), (101, None, "user", None)]
    rows += [(102, 4, "user", "same."), (102, 4, "assistant", "same."), (102, 4, "user", "other.")] * 2
    return rows


def summary(spark, rows):
    plans, repaired = repair.repair(spark.createDataFrame(rows, SCHEMA))
    digests = {r.conv: r.repaired_sha256 for r in repair.repaired_digests(repaired).collect()}
    none = hashlib.sha256(b"").hexdigest()
    return {
        r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests.get(r.conv, none)) for r in plans.collect()
    }


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault("" if r[0] is None else f"={r[0]}", []).append(r)
    return out


def test_repair_equals_brute_force_on_odd_rows(spark):
    rows = odd_conversations()
    assert summary(spark, rows) == {conv: brute(own) for conv, own in by_conversation(rows).items()}
    assert summary(spark, []) == {}


def test_hot_conversation_is_parsed_by_many_tasks(spark, monkeypatch):
    rng = random.Random(9)
    roles = ["system", "user", "assistant", "tool"]
    rows = [(1, t if t % 97 else None, rng.choice(roles), rng.choice(["a.", "b", f"{t}!", f"{t}", " "])) for t in range(3_000)]
    rows += [(c, t, rng.choice(roles), f"{c} {t}.") for c in range(2, 40) for t in range(5)]
    rows += [(1, 7, "user", "again.")] * 500
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    seen = []
    write = repair.written
    monkeypatch.setattr(repair, "written", lambda df, name: seen.append((name, out := write(df, name))) or out)
    try:
        got = summary(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {conv: brute(own) for conv, own in by_conversation(rows).items()}
    spans = dict(seen)["spans"]
    assert spans.filter("conv = '=1'").count() >= 3
    assert spans.groupBy("conv").count().filter("count > 1").count() <= 4


def test_query_equals_brute_force_and_sql(spark, tmp_path):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, SCHEMA)
    df.selectExpr("*", "'x' AS conv", "'x' AS audit", "'x' AS fault", "1 AS part").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_cyk_repair(spark, str(tmp_path)).collect()}
    after = by_conversation(damage(rows))
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    key = lambda c: "" if c is None else f"={c}"
    assert got == {c: brute(after[key(c)]) if key(c) in after else none for c in {r[0] for r in rows}}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT conv_id, turn, role, text FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert {r[0]: r[1:] for r in con.execute(oracles.OP11).fetchall()} == got


def test_repaired_rows_are_legal(spark, sf):
    _, rows = repair.repair(repair.damaged(spark.read.parquet(f"{sf}/conversations.parquet")))
    out = {}
    for r in rows.collect():
        out.setdefault(r.conv, []).append(r)
    for own in out.values():
        assert [r.position for r in own] == list(range(len(own)))
        assert LEGAL.fullmatch("".join(r.role[0] for r in own))
        assert all((r.text == "") == (r.edit == "I") for r in own)
