"""Token counts from a digest cache.

A text's content digest is the SHA-256 of its normal form, a tokenizer's version digest that of its file, library and library version.
The cache is a table of (content digest, count) per version digest. Documents are joined to it by digest, each different
content that it lacks is encoded once, and its count is appended.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from importlib.metadata import version as library_version
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow, written

CACHE = "digest binary, n_tokens long"
BROADCAST_MISSES = 100_000
CHUNK_BYTES = 4 << 20
#: A worker remembers the counts of so many words, of so many characters at most.
MEMO_WORDS = 500_000
MEMO_CHARS = 64

#: Characters beyond these may compose with or lower to others, and ``<|`` may begin a special token: such texts are their own normal form.
_SPECIAL = r"[^\x00-\xFF‐-‧]|<\|"
_SPACES = r"(?: *[\x09-\x0D]| {2})[\x09-\x0D\x20]*+"


#: A word that stays whole, and the runs of any other.
_WHOLE = re.compile(r"[^\x00-\xFF]|'|<\|")
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_RUN = re.compile(f"[{_LETTERS}]+|[^{_LETTERS}]+")


@dataclass
class Counter:
    """A tokenizer file as it travels to tasks: ``.json`` for tokenizers, ``.model`` for sentencepiece (1 to 2 MB)."""

    library: str
    content: bytes = field(repr=False)
    folds: bool  # case and the kind and number of white space do not change the count

    @property
    def version(self) -> str:
        """Digest of all that decides a count."""
        told = f"{self.library} {library_version(self.library)} no-special no-truncation ".encode()
        return hashlib.sha256(told + self.content).hexdigest()

    def open(self):
        """A function from texts to their token counts."""
        if self.library == "sentencepiece":
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_proto=self.content)
            return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(self.content.decode())
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def load_counter(path: str) -> Counter:
    """The tokenizer at ``path``, a file on the driver."""
    content = Path(path).read_bytes()
    if path.endswith(".model"):
        return Counter("sentencepiece", content, False)
    return Counter("tokenizers", content, _folds(json.loads(content)))


def _folds(told: dict) -> bool:
    """Whether the file lowers case, makes white space runs one space, splits there and drops it.

    Only the normaliser NFC, white space, lower case before a split that keeps no white space is known to; any other file's texts
    are their own normal form.
    """
    parts = (told.get("normalizer") or {}).get("normalizers", [])
    split = ((told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (
        [p.get("type") for p in parts] == ["NFC", "Replace", "Lowercase"]
        and parts[1].get("pattern") == {"Regex": r"\s+"}
        and parts[1].get("content") == " "
        and split.get("type") == "Split"
        and split.get("behavior") == "Removed"
        and split.get("invert") is True
        and (split.get("pattern") or {}).get("Regex", " ").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and " " not in split["pattern"]["Regex"]
        and told.get("post_processor") is None
        and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and t["content"].startswith("<|") for t in told["added_tokens"])
    )


def normal_form(text: Column, folds: bool) -> Column:
    """A text with the same count for the tokenizer: lower case and single spaces where that is known not to matter."""
    text = F.coalesce(text, F.lit(""))
    if not folds:
        return text
    return F.when(text.rlike(_SPECIAL), text).otherwise(F.trim(F.regexp_replace(F.lower(text), _SPACES, " ")))


def content_digest(text: Column, folds: bool) -> Column:
    return F.unhex(F.sha2(normal_form(text, folds), 256))


def open_cache(spark: SparkSession, path: str, version: str) -> tuple[DataFrame, str]:
    """The stored counts of a tokenizer version and their folder; an absent one is created empty."""
    folder = f"{path}/version={version}"
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(folder)
    return spark.read.schema(CACHE).parquet(folder), folder


class WordCounts:
    """Counts of whole texts as sums over their words and runs of letters, exact for a tokenizer that folds.

    White space parts words and is dropped, and a word of plain characters without an apostrophe is parted again between letters and
    others, so nothing is merged across either border. A different run is encoded once per worker while the memo
    holds, which is what keeps the encoder's share small: a corpus repeats its words far more often than its texts.
    """

    def __init__(self, count):
        self.count = count
        self.words: dict[str, int] = {}
        self.runs: dict[str, int] = {}

    def __call__(self, texts: list[str]) -> list[int]:
        return [self._total(t.replace("\n", " ").split(" ")) for t in texts]

    def _total(self, words: list[str]) -> int:
        different = set(words)
        new = [w for w in different if w not in self.words]
        if len(self.words) + len(new) > MEMO_WORDS:
            self.words = {w: self.words[w] for w in different if w in self.words}
        self.words.update(self._words(new))
        total = sum(map(self.words.__getitem__, words))
        for w in new:
            if len(w) > MEMO_CHARS:
                del self.words[w]
        return total

    def _words(self, words: list[str]) -> dict[str, int]:
        cut = {w: [w] if _WHOLE.search(w) else _RUN.findall(w.lower()) for w in words}
        new = list({r for runs in cut.values() for r in runs if r not in self.runs})
        counts = dict(zip(new, self.count(new), strict=True))
        out = {w: sum(counts[r] if r in counts else self.runs[r] for r in runs) for w, runs in cut.items()}
        if len(self.runs) > MEMO_WORDS:
            self.runs.clear()
        self.runs.update((r, n) for r, n in counts.items() if len(r) <= MEMO_CHARS)
        return out


_OPEN: dict[str, WordCounts | object] = {}


def _opened(counter: Counter):
    """The worker's counting function for a tokenizer, opened once per process."""
    if counter.version not in _OPEN:
        _OPEN.clear()
        count = counter.open()
        _OPEN[counter.version] = WordCounts(count) if counter.folds else count
    return _OPEN[counter.version]


def encode_misses(docs: DataFrame, counter: Counter, cache_path: str, text: str = "text") -> int | None:
    """Encode each content of ``docs`` that the cache lacks once and append its count.

    Copies collapse in the map tasks, so a content of a third of all rows is moved once per map task. While few
    contents are missing only their texts move. Returns the number of missing contents where the cache held any before, else NULL.
    """
    spark = docs.sparkSession
    cache, folder = open_cache(spark, cache_path, counter.version)
    texts = docs.select(
        content_digest(F.col(text), counter.folds).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    n = None
    if cache.limit(1).count():
        misses = written(texts.select("digest").distinct().join(cache, "digest", "left_anti"), "misses")
        n = misses.count()
        if n == 0:
            return 0
        if n <= BROADCAST_MISSES:
            texts = texts.join(F.broadcast(misses), "digest", "left_semi")
    once = texts.groupBy("digest").agg(F.first("text").alias("text"))
    if n is not None and n > BROADCAST_MISSES:
        once = once.join(misses, "digest", "left_semi")

    def encode(table: pa.Table) -> pa.Table:
        totals = _opened(counter)(table["text"].to_pylist())
        return pa.table([table["digest"], pa.array(totals, pa.int64())], names=["digest", "n_tokens"])

    map_arrow(once, encode, CACHE, CHUNK_BYTES).write.mode("append").parquet(folder)
    return n


def count_tokens(docs: DataFrame, counter: Counter, cache_path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``n_bytes`` (UTF-8) and ``n_tokens`` of the whole text.

    Every row keeps its place, repeated rows and NULL ids too; a NULL text is empty, and an empty text has a count like any other.
    An empty table gives an empty result, columns that are not kept are not read. A digest that two interrupted runs both
    appended counts once. The counts that are wanted are written before the join, so that Spark splits the rows of a
    content that many documents share.
    """
    spark = docs.sparkSession
    encode_misses(docs, counter, cache_path, text)
    keyed = written(
        docs.select(
            *[F.col(c).alias(f"_{i}") for i, c in enumerate(keep)],
            F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
            content_digest(F.col(text), counter.folds).alias("digest"),
        ),
        "keyed",
    )
    cache, _ = open_cache(spark, cache_path, counter.version)
    wanted = keyed.select("digest").distinct()
    counts = written(cache.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    return keyed.join(counts, "digest", "left").select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens"
    )
