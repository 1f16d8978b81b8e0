"""Text assembly, cleaning and measuring as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the assembled document, in order.
DOCUMENT_LABELS = ("player name", "player scouting report", "player position")
# The boilerplate between the report label and the position.
BOILERPLATE_HEAD = "scouting report: Scouting Report for "
BOILERPLATE_TAIL = " Position:"
# Fixed value: the marker a running summary is cut at.
SUMMARY_MARKER = "New summary:"

# Java's \w is ASCII only, so letters, marks and numbers are named.
TOKEN_PATTERN = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]"
WORD_PATTERN = r"[\p{L}\p{M}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` so that lambdas in ``body`` do not evaluate it again per element."""
    return F.transform(F.array(value), body).getItem(0)


def assemble_document(parts: Mapping[str, Column]) -> Column:
    """``label: value`` blocks, a blank line between them; a NULL value leaves its label."""
    return F.concat_ws("\n\n", *[F.concat_ws(" ", F.lit(f"{label}:"), c) for label, c in parts.items()])


def collapse_whitespace(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def strip_boilerplate(
    c: Column, head: str = BOILERPLATE_HEAD, tail: str = BOILERPLATE_TAIL, reluctant: bool = False
) -> Column:
    """Remove ``head … tail``: up to the last tail, or with ``reluctant`` up to the first."""
    return F.regexp_replace(c, f"{head}.*{'?' if reluctant else ''}{tail}", "")


def char_count(c: Column) -> Column:
    return F.length(c)


def word_count(c: Column) -> Column:
    """Pieces between single whitespace characters; empty pieces count."""
    return F.array_size(F.split(c, r"\s"))


def token_count(c: Column, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_count(c, F.lit(pattern)).cast("long")


def words(c: Column) -> Column:
    """Lower-cased words in text order."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), F.lit(0))


def composite_id(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def clean_answer(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\n"), F.lit("<br/>")), F.lit("Answer: "), F.lit(""))


def last_segment(c: Column, marker: str = SUMMARY_MARKER) -> Column:
    """The text after the last marker, or the whole text without one."""
    return F.substring_index(c, marker, -1)


def normalise_label(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))


def length_product(a: Column, b: Column) -> Column:
    return F.length(a).cast("long") * F.length(b).cast("long")


def lead_words(c: Column, n: Column | int) -> Column:
    """The first ``n`` space-separated words."""
    n = F.lit(n) if isinstance(n, int) else n.cast("int")
    return F.array_join(F.slice(F.split(c, " "), 1, n), " ")


def age_in_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years between a ``MMMM d, yyyy`` text and ``as_of``; NULL when unparsable."""
    return F.floor(F.datediff(as_of, F.try_to_date(birthday, "MMMM d, yyyy")) / 365).cast("int")


def or_unknown(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("Unknown"))


def url_host(c: Column) -> Column:
    return F.try_parse_url(c, F.lit("HOST"))
