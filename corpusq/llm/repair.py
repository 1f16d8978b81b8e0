"""Conversation repair by weighted CYK parsing over spans of rows.

The grammar of repaired role initials, ``(s?(ua)+)?``, in Chomsky normal form has a nonterminal for every pair of places
in it (start, after the system row, after a user row, after an assistant row): ``[p, q]`` derives what leads from
``p`` to ``q``, and its rules are ``[p, q] -> [p, r] [r, q]``. A cell of a span holds, per nonterminal, the least
(cost, audit) that edits its rows into what the nonterminal derives. The cell of one row is its keep, relabel and delete
productions between two insertion closures. Cells are combined bottom-up by span length: 1, 2, 4, 8, …

All rules have this one form and a best pair stays best whatever follows it (equal costs of one span and nonterminal
never come with an audit that begins another), so every way to split a span gives the same cell, and one split per span is
enough. The work is then linear in the rows, and the spans of a conversation can be built by many tasks: rows are dealt
by range of (conversation, turn), each task combines its spans, and only a conversation that crosses a border between tasks has spans
left to combine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import bound_batches, written

KEEP, RELABEL, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, RELABEL: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

#: Places in the grammar and where an initial leads from each.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {
    (_START, "s"): _SYSTEM,
    (_START, "u"): _USER,
    (_SYSTEM, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
    (_ASSISTANT, "u"): _USER,
}
_ENDS = (_START, _ASSISTANT)
_PLACES = range(4)
#: Longest span whose cell is kept for reuse.
_REUSED = 48

#: A cell: per pair of places the least (cost, audit), or None where no edit leads from one to the other.
Cell = tuple[tuple[tuple[int, str] | None, ...], ...]


def _product(a: Cell, b: Cell) -> Cell:
    """The cell of two neighbouring spans: ``[p, q] -> [p, r] [r, q]``."""
    out = []
    for p in _PLACES:
        row = []
        for q in _PLACES:
            best = None
            for r in _PLACES:
                x, y = a[p][r], b[r][q]
                if x is None or y is None:
                    continue
                cost = x[0] + y[0]
                if best is None or cost < best[0]:
                    best = (cost, x[1] + y[1])
                elif cost == best[0]:
                    best = min(best, (cost, x[1] + y[1]))
            row.append(best)
        out.append(tuple(row))
    return tuple(out)


def _union(a: Cell, b: Cell) -> Cell:
    least = lambda x, y: min((v for v in (x, y) if v is not None), default=None)
    return tuple(tuple(map(least, x, y)) for x, y in zip(a, b, strict=True))


def _empty() -> Cell:
    return tuple(tuple((0, "") if p == q else None for q in _PLACES) for p in _PLACES)


@lru_cache(1)
def _closure() -> Cell:
    """The cell of the empty span: any number of inserted rows."""
    step = [[None] * 4 for _ in _PLACES]
    for (p, initial), q in _NEXT.items():
        if initial in ROLES:
            step[p][q] = (COSTS[INSERT], INSERT)
    once = _union(_empty(), tuple(map(tuple, step)))
    return _product(_product(once, once), _product(once, once))


def _row(kind: str) -> Cell:
    """The cell of one row; its kind is ``d`` (must go), or its role's initial, in upper case if truncated."""
    cell = [[(COSTS[DELETE], DELETE) if p == q else None for q in _PLACES] for p in _PLACES]
    if kind != "d":
        more = TRUNCATED_COST if kind.isupper() else 0
        for (p, initial), q in _NEXT.items():
            if initial == kind.lower():
                cell[p][q] = (COSTS[KEEP] + more, KEEP)
            elif initial in ROLES:
                cell[p][q] = (COSTS[RELABEL] + more, RELABEL)
    return _product(_product(_closure(), tuple(map(tuple, cell))), _closure())


def span_cell(kinds: str) -> Cell:
    """The cell of the rows whose kinds stand in ``kinds``."""
    return _reused(kinds) if len(kinds) <= _REUSED else _split(kinds)


def _split(kinds: str) -> Cell:
    if not kinds:
        return _closure()
    if len(kinds) == 1:
        return _row(kinds)
    half = 1 << ((len(kinds) - 1).bit_length() - 1)
    return _product(span_cell(kinds[:half]), span_cell(kinds[half:]))


_reused = lru_cache(100_000)(_split)


def cheapest(cell: Cell) -> tuple[int, str]:
    """The least (cost, audit) that makes a whole conversation legal."""
    return min(cell[_START][q] for q in _ENDS if cell[_START][q] is not None)


# --- faults -------------------------------------------------------------------


def _key(column: Column) -> Column:
    """A text that is never NULL and differs for different values, NULL included."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def faulty_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, digest, copies, initial, fault, text)``: one row per different row, written to the shared folder.

    ``conv`` is the id as a text that is never NULL. A conversation's order is turn (NULL first), then role and the
    SHA-256 of the text, so that equal rows are neighbours; ``copies`` counts them. ``fault`` is blank, duplicate (role and
    text seen at an earlier turn), truncated or NULL; of ``copies`` equal rows all but the first are
    duplicates unless they are blank. A NULL role or text counts as one space. Copies and first turns are combined
    in the map tasks; where one text fills a conversation its rows are joined to a written table, so that Spark splits them.
    """
    text_ = F.coalesce(F.col(text), F.lit(" "))
    own = rows.select(
        _key(F.col(conv)).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.sha2(text_, 256).alias("digest"),
        text_.alias("text"),
    )
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    once = written(
        own.groupBy("conv", "turn", "role", "digest")
        .agg(F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
        .withColumn("initial", F.left("role", F.lit(1)))
        .withColumn("last", last)
        .select("conv", "turn", "role", "digest", "copies", "initial", (F.col("last") == "").alias("blank"), (~F.col("last").isin(".", "!", "?")).alias("cut"), "text"),
        "rows",
    )
    place = F.struct(F.col("turn").isNotNull(), "turn")
    again = written(
        once.groupBy("conv", "role", "digest")
        .agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("conv", "role", "digest", "first"),
        "again",
    )
    seen = F.col("first").isNotNull() & (place > F.col("first"))
    fault = F.when(F.col("blank"), "blank").when(seen, "duplicate").when(F.col("cut"), "truncated")
    return once.join(again, ["conv", "role", "digest"], "left").select(
        "conv", "turn", "role", "digest", "copies", "initial", fault.alias("fault"), "text"
    )


_SPANS = pa.schema(
    [
        ("conv", pa.string()),
        ("whole", pa.bool_()),
        ("first_initial", pa.string()),
        ("last_initial", pa.string()),
        ("min_turn", pa.int64()),
        ("max_turn", pa.int64()),
        ("distinct_turns", pa.int64()),
        ("blank", pa.int64()),
        ("duplicate", pa.int64()),
        ("truncated", pa.int64()),
        ("illegal", pa.int64()),
        ("part", pa.int64()),
        ("costs", pa.list_(pa.int64())),
        ("audits", pa.list_(pa.string())),
    ]
)
_DDL = (
    "conv string, whole boolean, first_initial string, last_initial string, min_turn long, max_turn long, distinct_turns long, "
    "blank long, duplicate long, truncated long, illegal long, part long, costs array<long>, audits array<string>"
)


class _Span:
    """Counts and kinds of a run of rows of one conversation."""

    def __init__(self, conv: str):
        self.conv, self.kinds = conv, []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last = self.low = self.high = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: str | None, copies: int) -> None:
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (copies - 1) * (initial * 2 not in LEGAL)
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        kind = initial if initial in "sua" and initial else "x"
        if fault in ("blank", "duplicate"):
            self.counts[fault] += copies
            self.kinds.append("d" * copies)
        else:
            if fault:
                self.counts[fault] += 1
            self.counts["duplicate"] += copies - 1
            self.kinds.append((kind.upper() if fault else kind) + "d" * (copies - 1))

    def row(self, whole: bool, part: int) -> dict:
        cell = span_cell("".join(self.kinds))
        flat = [v for places in cell for v in places]
        if whole:
            flat = [cheapest(cell)]
        return {
            "conv": self.conv, "whole": whole, "first_initial": self.first, "last_initial": self.last,
            "min_turn": self.low, "max_turn": self.high, "distinct_turns": self.turns, **self.counts, "illegal": self.illegal,
            "part": part, "costs": [None if v is None else v[0] for v in flat], "audits": [None if v is None else v[1] for v in flat],
        }


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation of a sorted partition; its first and last may go on in a neighbouring one."""
    span, first, part, out = None, True, None, []
    for batch in batches:
        names = ("conv", "turn", "initial", "fault", "copies", "part")
        for conv, turn, initial, fault, copies, part_ in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names), strict=True):
            if span is None or span.conv != conv:
                if span is not None:
                    out.append(span.row(not first, part))
                    first = False
                span, part = _Span(conv), part_
                if len(out) >= 2000:
                    yield pa.RecordBatch.from_pylist(out, _SPANS)
                    out = []
            span.add(turn, initial, fault, copies)
    if span is not None:
        out.append(span.row(False, part))
        yield pa.RecordBatch.from_pylist(out, _SPANS)


def _merged(table: pa.Table) -> pa.Table:
    """The spans of one conversation combined into one, in order; at most one span per task that held a part of it."""
    spans = sorted(table.to_pylist(), key=lambda x: x["part"])
    cells = []
    for s in spans:
        flat = [None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"], strict=True)]
        cells.append(tuple(tuple(flat[4 * p : 4 * p + 4]) for p in _PLACES))
    while len(cells) > 1:  # bottom-up by length
        cells = [_product(*pair) if len(pair) == 2 else pair[0] for pair in (cells[i : i + 2] for i in range(0, len(cells), 2))]
    out = dict(spans[0])
    for before, s in zip(spans, spans[1:]):
        for name in ("blank", "duplicate", "truncated", "illegal", "distinct_turns"):
            out[name] += s[name]
        out["illegal"] += before["last_initial"] + s["first_initial"] not in LEGAL
    seen = None
    for s in spans:  # a turn that two spans share counts once
        if s["min_turn"] is not None:
            out["distinct_turns"] -= s["min_turn"] == seen
            seen = s["max_turn"]
    out["min_turn"] = next((s["min_turn"] for s in spans if s["min_turn"] is not None), None)
    out["max_turn"] = seen
    cost, audit = cheapest(cells[0])
    return pa.Table.from_pylist([out | {"whole": True, "costs": [cost], "audits": [audit]}], _SPANS)


def repair_plans(faulty: DataFrame) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` per conversation of ``faulty_rows``.

    Rows are dealt by range of conversation and turn, so one conversation may lie in many tasks; its spans, one per task, are
    then combined in a group of their own. No text travels here. An empty table gives an empty result.
    """
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = faulty.select("conv", "turn", "role", "digest", "initial", "fault", "copies").repartitionByRange(*order)
    ordered = dealt.withColumn("part", F.spark_partition_id().cast("long")).sortWithinPartitions(*order)
    bound_batches(faulty.sparkSession)
    spans = written(ordered.mapInArrow(_spans, _DDL), "spans")
    crossing = spans.filter("NOT whole").groupBy("conv").applyInArrow(_merged, _DDL)
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("distinct_turns"), F.lit(0).cast("long"))
    return spans.filter("whole").unionByName(crossing).select(
        "conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"),
    )


_REPAIRED = pa.schema([("conv", pa.string()), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted conversations, each behind the row that carries its audit, edited letter by letter."""
    out, size = [], 0
    audit, at, place, position, conv = "", 0, _START, 0, None

    def put(edit: str, initial: str, role: str, text: str) -> None:
        nonlocal place, position, size
        place = _NEXT[place, initial]
        out.append({"conv": conv, "position": position, "edit": edit, "role": role, "text": text})
        position += 1
        size += len(text)

    def insert() -> None:
        nonlocal at
        while at < len(audit) and audit[at] == INSERT:
            initial = "a" if place == _USER else "u"
            put(INSERT, initial, ROLES[initial], "")
            at += 1

    for batch in batches:
        for row in batch.to_pylist():
            if row["audit"] is not None:
                insert()
                audit, at, place, position, conv = row["audit"], 0, _START, 0, row["conv"]
                insert()
                continue
            for copy in range(row["copies"]):
                insert()
                edit = audit[at]
                at += 1
                if edit == KEEP:
                    put(edit, row["role"][:1], row["role"], row["text"])
                elif edit == RELABEL:
                    initial = "a" if place == _USER else "u"
                    put(edit, initial, ROLES[initial], row["text"])
            if len(out) >= 2000 or size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, _REPAIRED)
                out, size = [], 0
    insert()
    if out:
        yield pa.RecordBatch.from_pylist(out, _REPAIRED)


def repaired_rows(faulty: DataFrame, plans: DataFrame) -> DataFrame:
    """``(conv, position, edit, role, text)``: the rows of every repaired conversation, edited as ``plans`` says.

    Each partition holds whole conversations in order, and rows stream through it; a task holds one
    batch and one audit. What follows a conversation in order (a digest, a written file) needs it in one task.
    """
    none = F.lit(None)
    heads = plans.select(
        "conv", "audit", none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("string").alias("digest"),
        F.lit(0).cast("long").alias("copies"), none.cast("string").alias("text"),
    )
    rows = faulty.select("conv", none.cast("string").alias("audit"), "turn", "role", "digest", "copies", "text")
    order = [F.col("conv"), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    both = rows.unionByName(heads).repartition("conv").sortWithinPartitions(*order)
    bound_batches(faulty.sparkSession)
    return both.mapInArrow(_apply, "conv string, position long, edit string, role string, text string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state, out = None, None, {"conv": [], "repaired_sha256": []}

    def done() -> None:
        if conv is not None:
            out["conv"].append(conv)
            out["repaired_sha256"].append(state.hexdigest())

    for batch in batches:
        for row in batch.to_pylist():
            line = f"{row['role']}:{row['text']}".encode("utf-8", "surrogatepass")
            if row["conv"] != conv:
                done()
                conv, state = row["conv"], hashlib.sha256(line)
            else:
                state.update(b"\n" + line)
    done()
    if out["conv"]:
        yield pa.RecordBatch.from_pydict(out)


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """``(conv, repaired_sha256)`` over ``role:text`` lines of ``repaired_rows``, taken in the order in which its partitions hold them."""
    return repaired.mapInArrow(_hashed, "conv string, repaired_sha256 string")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Faults and cheapest repair of every conversation: its plans, and its repaired rows.

    The first table has ``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)``, the second
    ``(conv, position, edit, role, text)``; a conversation whose rows are all deleted has no row there. ``conv`` is
    ``conversation_key`` of the id, so conversations without an id are one. Other columns are not read, whatever their names.
    """
    faulty = written(faulty_rows(rows, conv, turn, role, text), "faulty")
    plans = written(repair_plans(faulty), "plans")
    return plans, repaired_rows(faulty, plans)


def conversation_key(column: Column) -> Column:
    """What ``conv`` holds in the results for an id."""
    return _key(column)


# --- the damage of the registered query ---------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` damaged by crc32 of ``conv_id:turn`` modulo 20, NULLs in it as one space.

    0 drops the row, 1 empties its text, 2 removes full stops, exclamation and question marks, 3 repeats
    the row, 4 makes it a user's. The others stay as they are.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return (
        rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind"))
        .filter("kind != 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
        .drop("copy")
    )
