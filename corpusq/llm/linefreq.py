"""Quality rules by cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, digits as 0, white space runs as one space) and
hashed. A line that stands in many different documents of one host is boilerplate
and is removed; a document of which little is left is rejected.

Equal texts are one document. Near copies are documents of their own here: what they share counts like any other
shared line, and telling them from each other is the work of the near-duplicate operator. Line hashes are shuffled, texts are not,
unless the cleaned text is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusq.functions.text import let
from corpusq.llm.common import written

SPACES = " \t\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_DOCS = 20
HOST_SHARE = 0.01
MIN_LEFT = 0.3
#: Up to so many frequent lines (16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_LINES = 200_000


def _spaced(text: Column) -> Column:
    """``text`` with every white space as a space, NULL as ''. Plain replacement is cheaper than a pattern."""
    text = F.coalesce(text, F.lit(""))
    for space in "\n\t\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return text


def words_of(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D, in order."""
    return F.filter(F.split(_spaced(text), " "), lambda w: w != "")


def word_chars(text: Column) -> Column:
    """Code points that are not white space."""
    return F.length(F.replace(_spaced(text), F.lit(" "), F.lit(""))).cast("long")


def symbol_count(text: Column) -> Column:
    return F.coalesce(F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")), F.lit(0)).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words inside a ``window``-word run that occurs twice or more in the text.

    Runs are hashed and sorted with their places, packed into one long: the upper
    bits of the hash, then the place. Equal neighbours (by the whole hash) are
    repeats, and each repeated place covers the words up to the next one. No step
    looks at pairs of runs.
    """

    def hashes(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - window)
        run = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)])
        return F.when(F.size(w) >= window, F.transform(places, run)).otherwise(F.array().cast("array<bigint>"))

    def starts(h: Column) -> Column:
        def placed(low: Column) -> Column:
            upper = F.bitwise_not(low)
            packed = F.transform(h, lambda x, i: x.bitwiseAND(upper).bitwiseOR(i.cast("long")))

            def repeats(s: Column) -> Column:
                own = F.transform(s, lambda x: F.get(h, x.bitwiseAND(low).cast("int")))

                def found(o: Column) -> Column:
                    same = lambda k, j: F.coalesce(F.get(o, k) == F.get(o, j), F.lit(False))
                    hit = F.filter(s, lambda x, k: same(k, k - 1) | same(k, k + 1))
                    return F.sort_array(F.transform(hit, lambda x: x.bitwiseAND(low).cast("int")))

                return let(own, found)

            return let(F.sort_array(packed), repeats)

        bits = F.ceil(F.log2(F.size(h) + F.lit(1.0))).cast("int")
        return let(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, placed)

    def covered(r: Column) -> Column:
        reach = F.transform(r, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(r, k + 1) - x, F.lit(window))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def count(h: Column) -> Column:
        distinct = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(distinct, F.lit(0).cast("long")).otherwise(let(starts(h), covered))

    return let(words, lambda w: let(hashes(w), count))


def base_measures(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the per-document measures and ``base_failed``. A NULL text has no words."""
    t = F.col(text)
    words = let(
        words_of(t),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")),
    )
    measured = docs.withColumn("_words", words).select(
        "*",
        F.col("_words.n_words").alias("n_words"),
        F.col("_words.n_repeat_words").alias("n_repeat_words"),
        word_chars(t).alias("word_chars"),
        symbol_count(t).alias("n_symbols"),
        duplicate_lines(t).alias("n_dup_lines"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.drop("_words").withColumn("base_failed", failed)


def normalised_lines(text: Column) -> Column:
    """Lines in lower case, ASCII digits as 0, white space runs as one space, none at the ends."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[0-9]", "0")
    plain = F.regexp_replace(plain, r"[ \t\x0B\f\r]{2,}|[\t\x0B\f\r]", " ")
    return F.transform(F.split(plain, "\n"), lambda x: F.trim(x))


def _lines(docs: DataFrame, doc_id: str, host: str, text: str) -> DataFrame:
    """One row per line with a word: place, words, 128-bit key of host and line."""
    lines = F.transform(normalised_lines(F.col(text)), lambda x, i: F.struct(i.alias("place"), x.alias("line")))
    words = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1
    hashed = F.transform(
        F.filter(lines, lambda x: x["line"] != ""),
        lambda x: F.struct(
            x["place"].alias("place"), words(x["line"]).alias("words"), F.md5(x["line"].cast("binary")).alias("md5")
        ),
    )
    source = F.coalesce(F.col(host), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_tx"), F.xxhash64(source).alias("_host"), F.inline(hashed)
    )
    keys = [F.xxhash64("_host", "md5").alias("_key1"), F.xxhash64("md5", "_host").alias("_key2")]
    return rows.select("_id", "_tx", "_host", "place", "words", *keys)


def frequent_lines(
    lines: DataFrame, docs: DataFrame, host: str, text: str, min_docs: int = MIN_DOCS, host_share: float = HOST_SHARE
) -> DataFrame:
    """Keys of ``lines`` above the limit: in more than ``min_docs`` documents and ``host_share`` of their host's.

    Different texts are counted. Every step is combined before its shuffle: a text's line is one row, and
    the last step gets one row per line and task.
    """
    hosts = (
        docs.select(F.xxhash64(F.coalesce(F.col(host), F.lit(""))).alias("_host"), F.xxhash64(text).alias("_tx"))
        .distinct()
        .groupBy("_host")
        .agg(F.count(F.lit(1)).alias("_host_docs"))
    )
    counts = (
        lines.select("_host", "_key1", "_key2", "_tx")
        .distinct()
        .groupBy("_host", "_key1", "_key2")
        .agg(F.count(F.lit(1)).alias("_docs"))
        .filter(F.col("_docs") > min_docs)
    )
    above = counts.join(hosts, "_host").filter(F.col("_docs") > host_share * F.col("_host_docs"))
    return above.select("_key1", "_key2")


def apply_line_limits(
    docs: DataFrame,
    doc_id: str = "doc_id",
    host: str = "source",
    text: str = "text",
    min_docs: int = MIN_DOCS,
    host_share: float = HOST_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """``docs`` with its measures, ``clean_text``, ``n_removed_lines``, ``n_removed_words``, ``kept``.

    ``clean_text`` is the text without its frequent lines (NULL stays NULL). ``kept``
    is false for a document that fails the base rules or keeps fewer than
    ``min_left`` of its words. A NULL host is the host ''. Rows that repeat are each
    judged alike and all returned; NULL ids are allowed; an empty table gives an empty one. Input
    columns with the name of an added one are replaced.
    """
    names = ["n_words", "n_repeat_words", "word_chars", "n_symbols", "n_dup_lines", "base_failed"]
    added = [*names, "clean_text", "n_removed_lines", "n_removed_words", "kept"]
    own = [c for c in docs.columns if c not in added]
    # The input goes into one struct, so extra columns never clash with the working ones.
    rows = docs.select(F.struct(*[docs[c] for c in own]).alias("_doc")).select(
        "_doc",
        F.col("_doc")[doc_id].alias("_id"),
        F.col("_doc")[host].cast("string").alias("_src"),
        F.col("_doc")[text].alias("_text"),
    )
    few = rows.select("_id", "_src", "_text")
    lines = written(_lines(few, "_id", "_src", "_text"), "lines")
    frequent = written(frequent_lines(lines, few, "_src", "_text", min_docs, host_share), "frequent")
    if frequent.count() <= BROADCAST_LINES:
        frequent = F.broadcast(frequent)
    removed = (
        lines.join(frequent, ["_key1", "_key2"])
        .groupBy("_id", "_tx", "_host")
        .agg(
            F.sort_array(F.collect_set("place")).alias("_places"),
            F.sum("words").alias("_words_removed"),
            F.count(F.lit(1)).alias("_n"),
        )
        .select(
            F.struct("_id", "_tx", "_host").alias("_row"),
            "_places",
            # Rows that repeat share one entry, which counts each of their lines several times.
            (F.col("_words_removed") * F.size("_places") / F.col("_n")).cast("long").alias("_gone"),
        )
    )
    measured = base_measures(rows, "_text").withColumn(
        "_own", F.struct("_id", F.xxhash64("_text"), F.xxhash64(F.coalesce("_src", F.lit(""))))
    )
    joined = measured.join(removed, F.col("_own").eqNullSafe(F.col("_row")), "left")
    gone = F.coalesce("_gone", F.lit(0).cast("long"))

    def without(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_places"))
        return F.array_join(F.transform(places, lambda p: F.get(lines, p)), "\n")

    clean = F.when(F.col("_places").isNull(), F.col("_text")).otherwise(let(F.split("_text", "\n"), without))
    left_enough = F.col("n_words") - gone >= min_left * F.col("n_words")
    return joined.select(
        *[F.col("_doc")[c].alias(c) for c in own],
        *names,
        clean.alias("clean_text"),
        F.coalesce(F.size("_places"), F.lit(0)).cast("long").alias("n_removed_lines"),
        gone.alias("n_removed_words"),
        (~F.col("base_failed") & left_enough).alias("kept"),
    )
