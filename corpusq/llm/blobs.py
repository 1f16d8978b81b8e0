"""Secret scans with an incremental blob ledger.

Every version of a text is addressed by its SHA-256. The ledger holds what each
(blob, rule, version) pair gave, also when it gave nothing. A scan reads only pairs that the
ledger lacks and appends them; findings are then joined back to all paths of a blob.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow

#: Up to so many unseen blobs their addresses (64 bytes each) are broadcast to pick texts by.
BROADCAST_BLOBS = 100_000

LEDGER = "blob string, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern and a test of its matches; ``span`` is the group found. A new ``version`` makes every blob unseen for this rule."""

    name: str
    version: int
    pattern: str
    flags: int = 0
    least: int = 0
    group: int = 0
    span: int = 0

    def finder(self) -> Callable[[str], list[dict]]:
        compiled = re.compile(self.pattern, self.flags)

        def spans(text: str) -> list[dict]:
            return [
                {"start": m.start(self.span), "end": m.end(self.span)}
                for m in compiled.finditer(text)
                if m.end(self.group) - m.start(self.group) >= self.least
            ]

        return spans


# The first three are the given base patterns. ``hex`` and ``access`` are
# written with their least length; a shorter run never matches, and a longer one matches alike.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
        least=8,
        group=2,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
)
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?"),
    # A run of these signs is read once: where its first ``eyJ`` fails, the later ones do.
    Rule(
        "jwt",
        1,
        r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+)",
        span=1,
    ),
    Rule("forge", 1, r"gh[opsur]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}"),
    Rule("chat", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES


def blob_address(text) -> F.Column:
    """SHA-256 of the UTF-8 text; NULL is the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; an absent one is created empty."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def scan_unseen(versions: DataFrame, ledger_path: str, text: str = "text", rules: Sequence[Rule] = RULES) -> None:
    """Scan each unseen (blob, rule version) pair of ``versions`` once and append it to the ledger.

    Copies of a text collapse in the map tasks, so a text of a third of all
    rows is moved once per map task. When few blobs are unseen only their texts move.
    """
    spark = versions.sparkSession
    ledger = open_ledger(spark, ledger_path)
    texts = versions.select(
        blob_address(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    wanted = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    unseen = (
        texts.select("blob")
        .distinct()
        .select("blob", F.inline(wanted))
        .join(ledger.select("blob", "rule", "version"), ["blob", "rule", "version"], "left_anti")
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set("rule")).alias("rules"))
    )
    known = ledger.limit(1).count()
    if known and (n := unseen.limit(BROADCAST_BLOBS + 1).count()) <= BROADCAST_BLOBS:
        if n == 0:
            return
        texts = texts.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
    once = texts.groupBy("blob").agg(F.first("text").alias("text")).join(unseen, "blob")
    by_name = {r.name: r for r in rules}

    def scan(table: pa.Table) -> pa.Table:
        finders = {name: r.finder() for name, r in by_name.items()}
        found = []
        for blob, value, names in zip(*(table[c].to_pylist() for c in ("blob", "text", "rules")), strict=True):
            found.extend((blob, name, by_name[name].version, finders[name](value)) for name in names)
        columns = [list(c) for c in zip(*found, strict=True)]
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        kinds = (pa.string(), pa.string(), pa.int32(), span)
        names = ["blob", "rule", "version", "spans"]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    map_arrow(once, scan, LEDGER, 8 << 20).write.mode("append").parquet(ledger_path)


def findings(versions: DataFrame, ledger_path: str, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``versions`` with ``blob`` and ``found``: the spans of its text, by start, then by the order of the rules.

    ``found`` is an array of ``(start, rank, kind, end)``, empty without a finding; offsets are
    code points, ends exclusive. Rows that repeat and NULL paths keep their rows.
    """
    rank = F.coalesce(*[F.when(F.col("rule") == r.name, F.lit(i)) for i, r in enumerate(rules)])
    current = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    ledger = open_ledger(versions.sparkSession, ledger_path).filter(
        (F.size("spans") > 0) & F.array_contains(current, F.struct("rule", "version"))
    )
    # A pair that two interrupted scans both appended counts once.
    spans = F.inline(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), rank.alias("rank"), F.col("rule").alias("kind"), s["end"].alias("end"))))
    by_blob = (
        ledger.select("blob", spans)
        .groupBy("blob")
        .agg(F.sort_array(F.collect_set(F.struct("start", "rank", "kind", "end"))).alias("_found"))
        .withColumnRenamed("blob", "_blob")
    )
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    own = [c for c in versions.columns if c not in ("blob", "found")]
    addressed = versions.select(*own, blob_address(F.col(text)).alias("blob"))
    joined = addressed.join(by_blob, F.col("blob") == F.col("_blob"), "left")
    return joined.select(*own, "blob", F.coalesce("_found", none).alias("found"))


def scan_versions(versions: DataFrame, ledger_path: str, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Bring the ledger up to date with ``versions``, then their findings."""
    scan_unseen(versions, ledger_path, text, rules)
    return findings(versions, ledger_path, text, rules)


def redact(df: DataFrame, text: str = "text", found: str = "found", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every finding in ``text`` replaced by ``mark``; findings that overlap share one."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_without(t, s, mark) for t, s in zip(texts, spans, strict=True)], dtype=object)

    places = F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return df.withColumn(text, F.when(F.size(found) == 0, F.col(text)).otherwise(cleaned(F.col(text), F.to_json(places))))


def _without(text: str | None, places: str | None, mark: str) -> str | None:
    spans = json.loads(places) if places else []
    if text is None or not spans:
        return text
    out, at = [], 0
    for span in spans:
        if span["start"] >= at:
            out += [text[at : span["start"]], mark]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])
