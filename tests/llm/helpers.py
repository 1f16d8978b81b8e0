"""Rows that every operator must take, and plain word rules for the brute-force versions."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOW))


def sentence(seed, n):
    """``n`` invented words, a full stop after every eighth."""
    out, x = [], seed * 7919 + 17
    for i in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join("bcdfgklmnprst"[(x >> (4 * k)) % 13] + "aeiou"[(x >> (3 * k)) % 5] for k in range(3)))
        if i % 8 == 7:
            out[-1] += "."
    return " ".join(out)


def odd_rows():
    """NULLs, empty and blank texts, ties, repeated rows, a very long text, signs of other scripts."""
    long = sentence(3, 30_000)
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", None, None, 3),
        (None, "no id here at all, only a text", "en", "a", 1),
        (None, None, None, None, None),
        (5, "***", "en", "a", 3),
        (6, "one two", "en", "b", 7),
        (6, "one two", "en", "b", 7),
        (6, "the same id with another text", "en", "b", 7),
        (7, "日本語 テキスト 🎉 ñandú", "es", "b", 9),
        (8, long, "en", "a", len(long)),
        (9, long, "en", "b", len(long)),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    """``df`` with extra columns named like working columns of the operators."""
    from pyspark.sql import functions as F

    names = ("id", "node", "rank", "shard", "n_words", "kept", "found", "blob", "score", "words", "_text", "_id", "term")
    return df.select("*", *[F.lit("x").alias(n) for n in names])
