"""Field, table, text and link extraction from page markup, by regular expression in the JVM."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusq.functions.text import let

# The named entities of HTML 4 and the apostrophe; a no-break space becomes a plain one.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}
_ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

# White space at the ends of a field, no-break space included (Java's trim keeps it).
_EDGES = "^[\\s ]+|[\\s ]+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def _decoded(entity: Column) -> Column:
    """The sign of one entity, given without ``&`` and ``;``; NULL if it is unknown."""

    def sign(number: Column) -> Column:
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        decoded = F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")
        return F.when(number == 160, F.lit(" ")).when(valid, decoded)

    hexadecimal = F.lower(F.substring(entity, 2, 1)) == "x"
    digits = F.when(hexadecimal, F.conv(F.substring(entity, 3, 8), 16, 10)).otherwise(F.substring(entity, 2, 8))
    # One literal, folded to a map once: hundreds of literals would cost more to plan than the pages to read.
    named = F.str_to_map(F.lit("\x1e".join(f"{name}\x1f{sign}" for name, sign in ENTITIES.items())), F.lit("\x1e"), F.lit("\x1f"))
    return F.when(F.startswith(entity, F.lit("#")), let(digits.cast("int"), sign)).otherwise(F.try_element_at(named, entity))


def unescape(c: Column) -> Column:
    """Named and numbered entities decoded in one pass; an unknown one stays as it is.

    Each different entity of a text is decoded once.
    """

    def known(entities: Column) -> Column:
        return F.map_from_arrays(entities, F.transform(entities, lambda e: F.coalesce(_decoded(e), F.concat(F.lit("&"), e, F.lit(";")))))

    def joined(text: Column, found: Column, signs: Column) -> Column:
        # The text behind the last entity has none to follow it.
        both = F.zip_with(F.split(text, _ENTITY), found, lambda a, e: F.concat(a, F.when(e.isNull(), "").otherwise(F.element_at(signs, e))))
        return F.array_join(both, "")

    def parts(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(1))
        decoded = let(found, lambda f: let(let(F.array_distinct(f), known), lambda signs: joined(text, f, signs)))
        return F.when(text.contains("&"), decoded).otherwise(text)

    return let(c, parts)


def escape(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def inner_text(c: Column) -> Column:
    """Markup of one element to text."""
    return unescape(F.regexp_replace(c, "<[^>]*>", ""))


def _empty_to_null(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def first_containing(html: Column, label: str, tag: str = "p") -> Column:
    """Text of the first ``tag`` element whose text holds ``label``; NULL without one."""
    pieces = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))
    return F.get(F.filter(F.transform(pieces, inner_text), lambda t: t.contains(label)), 0)


def label_field(html: Column, label: str, tag: str = "p") -> Column:
    """First word of the last-but-one colon segment, e.g. ``FW`` in ``Position: FW Footed: R``."""
    segment = F.try_element_at(F.split(first_containing(html, label, tag), ":"), F.lit(-2))
    return _empty_to_null(F.get(F.split(strip(segment), "[\\s ]+"), 0))


def last_colon_segment(html: Column, label: str, tag: str = "p") -> Column:
    return strip(F.substring_index(first_containing(html, label, tag), ":", -1))


def _open_tag(tag: str, element_id: str) -> str:
    """Pattern of an opening tag whose attribute ``id``, quoted or not, has the value; case-insensitive like the rest."""
    value = re.escape(element_id)
    return rf"""<{tag}(?=\s)(?:[^>]*?\s)?id\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s>/]))[^>]*>"""


def element_by_id(html: Column, element_id: str, tag: str = "span") -> Column:
    pattern = rf"(?is){_open_tag(tag, element_id)}(.*?)</{tag}>"
    return _empty_to_null(strip(inner_text(F.regexp_extract(html, pattern, 1))))


def title(html: Column) -> Column:
    return _empty_to_null(strip(inner_text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))))


def page_text(html: Column) -> Column:
    """Visible text: scripts, styles, comments and tags removed, white space collapsed."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(unescape(F.regexp_replace(bare, "<[^>]*>", " ")), r"\s+", " "))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))


def _own_markup(after: Column) -> Column:
    """What stands directly in a table, given the markup behind its opening tag.

    The depth is a running sum over the opening and closing tags. Tables inside are left out, however deep; a
    table that is never closed ends with its page.
    """
    tag = r"(?i)<table(?=[\s/>])[^>]*>|</table\s*>"

    def added(state: Column, piece: Column) -> Column:
        closing = F.startswith(piece["tag"], F.lit("</"))
        # Depth 0 is behind the table and is never left.
        depth = F.when(state["depth"] == 0, 0).when(closing, state["depth"] - 1).otherwise(state["depth"] + 1)
        return let(depth, lambda d: F.struct(d.alias("depth"), F.concat(state["own"], F.when(d == 1, piece["text"]).otherwise("")).alias("own")))

    def body(between: Column) -> Column:
        tags = F.regexp_extract_all(after, F.lit(tag), F.lit(0))
        behind = F.slice(between, 2, F.greatest(F.size(between) - 1, F.lit(0)))
        pieces = F.zip_with(tags, behind, lambda t, x: F.struct(t.alias("tag"), x.alias("text")))
        start = F.struct(F.lit(1).alias("depth"), F.get(between, 0).alias("own"))
        return F.aggregate(pieces, start, added, lambda state: state["own"])

    return let(F.split(after, tag), body)


def table_rows(html: Column, table_id: str) -> Column:
    """Rows of the first table with the id, header first: ``array<array<string>>``.

    A page without the table gives an empty array, and an empty cell is NULL. Tables inside the
    table's cells are left out, at any depth.
    """
    after = F.regexp_extract(html, rf"(?is){_open_tag('table', table_id)}(.*)$", 1)
    rows = F.regexp_extract_all(let(after, _own_markup), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(
        rows,
        lambda r: F.transform(
            F.regexp_extract_all(r, F.lit(r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"), F.lit(1)),
            lambda cell: _empty_to_null(strip(inner_text(cell))),
        ),
    )
