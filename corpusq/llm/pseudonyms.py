"""Format-preserving pseudonyms for personal data.

Numbers, dates and addresses that pass their format's check are replaced by another
value of the same format: the value's rank among all values of its format is moved
by a keyed permutation (a Feistel network with cycle walking). The key alone decides, so equal
values stay equal in every document, and the owner of the key can turn them back.

No document needs another one, so this is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusq.llm.common import map_arrow

ROUNDS = 8


class Permutation:
    """A keyed permutation of ``0 … size - 1`` without a fixed point (for ``size`` above 1).

    A Feistel network permutes the next power of four; values outside the range are walked on. The step
    between the network and its inverse makes the whole one cycle, so no value keeps its place.
    """

    def __init__(self, key: bytes, tweak: str, size: int) -> None:
        self.size, self.half = size, max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.key = blake2b(key, digest_size=32).digest()
        self.tweak = f"{tweak}:{size}:".encode()

    def _round(self, number: int, value: int) -> int:
        text = self.tweak + number.to_bytes(1, "big") + value.to_bytes(self.half // 8 + 1, "big")
        width = self.half // 8 + 9
        parts, block = b"", 0
        while len(parts) < width:
            parts += blake2b(text + block.to_bytes(4, "big"), key=self.key, digest_size=64).digest()
            block += 1
        return int.from_bytes(parts[:width], "big") & self.mask

    def _network(self, x: int, numbers: range) -> int:
        left, right = x >> self.half, x & self.mask
        if numbers.step > 0:
            for i in numbers:
                left, right = right, left ^ self._round(i, right)
        else:
            for i in numbers:
                left, right = right ^ self._round(i, left), left
        return left << self.half | right

    def _walk(self, x: int, numbers: range) -> int:
        x = self._network(x, numbers)
        while x >= self.size:
            x = self._network(x, numbers)
        return x

    def _shift(self, x: int, step: int) -> int:
        if self.size < 2:
            return x
        y = (self._walk(x, range(ROUNDS)) + step) % self.size
        return self._walk(y, range(ROUNDS - 1, -1, -1))

    def forward(self, x: int) -> int:
        return self._shift(x, 1)

    def back(self, x: int) -> int:
        return self._shift(x, -1)


def luhn_digit(payload: str) -> str:
    """The check digit that makes ``payload`` + digit pass the Luhn test."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _fill(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in layout)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


Move = Callable[[str, int, int], int]  # (name of the format, size, rank) -> rank


def _card(text: str, move: Move) -> str | None:
    d = _digits(text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    n, rank = len(d) - 2, int(d[1:-1])
    # Walked on until the digits count alike in a longer number too: what fails its check with digits
    # before or behind it still does, so pseudonyms are found at the places of the old values.
    while True:
        rank = move(f"card{d[0]}", 10**n, rank)
        payload = d[0] + str(rank).zfill(n)
        new = payload + luhn_digit(payload)
        if luhn_digit(new) == luhn_digit(d):
            return _fill(text, new)


def _ip(text: str, move: Move) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if any(p > 255 for p in parts) or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    new = move("ip", 1 << 32, int.from_bytes(bytes(parts), "big")).to_bytes(4, "big")
    return ".".join(map(str, new))


def _ssn(text: str, move: Move) -> str | None:
    area, group, serial = (int(p) for p in text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank = move("ssn", 898 * 99 * 9999, rank)
    rank, serial = divmod(rank, 9999)
    area, group = divmod(rank, 99)
    area += 1 + (area >= 665)
    return f"{area:03}-{group + 1:02}-{serial + 1:04}"


def _phone(text: str, move: Move) -> str | None:
    d = _digits(text)
    head = 0
    if text.startswith("+"):
        head = len(re.match(r"\+(\d{1,3})", text)[1])
    n = len(d) - head
    if not 7 <= n <= 14:
        return None
    return _fill(text, d[:head] + str(move(f"phone{d[:head]}", 10**n, int(d[head:]))).zfill(n))


FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)


def _date(text: str, move: Move) -> str | None:
    parts, mark = re.split(r"[-./]", text), re.search(r"[-./]", text)[0]
    year_first = len(parts[0]) == 4
    y, m, d = (int(p) for p in (parts if year_first else parts[::-1]))
    try:
        day = date(y, m, d)
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    size = (LAST_DAY - FIRST_DAY).days + 1
    day = FIRST_DAY + timedelta(days=move("date", size, (day - FIRST_DAY).days))
    new = [f"{day.year:04}", f"{day.month:02}", f"{day.day:02}"]
    return mark.join(new if year_first else new[::-1])


def _mixed(text: str, name: str, move: Move) -> str:
    """Letters to letters of their case, digits to digits, all else in place."""
    alphabets = {"d": "0123456789", "a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    kind = lambda c: "d" if c in alphabets["d"] else "a" if c in alphabets["a"] else "A" if c in alphabets["A"] else c
    layout = [kind(c) for c in text]
    size, rank = 1, 0
    for c, k in zip(text, layout, strict=True):
        if k in alphabets:
            size *= len(alphabets[k])
            rank = rank * len(alphabets[k]) + alphabets[k].index(c)
    rank = move(name + "".join(layout), size, rank)
    out = []
    for c, k in zip(reversed(text), reversed(layout), strict=True):
        if k in alphabets:
            rank, i = divmod(rank, len(alphabets[k]))
            c = alphabets[k][i]
        out.append(c)
    return "".join(reversed(out))


def _email(text: str, move: Move) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{_mixed(local, f'email@{domain.lower()}', move)}@{domain}"


def _iban(text: str, move: Move) -> str | None:
    plain = text.replace(" ", "")
    value = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or value(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _mixed(plain[4:], f"iban{plain[:2]}", move)
    new = iter(plain[:2] + f"{98 - value(body + plain[:2] + '00') % 97:02}" + body)
    return "".join(c if c == " " else next(new) for c in text)


# In order of precedence where two formats claim the same characters.
FORMATS: dict[str, tuple[str, Callable[[str, Move], str | None]]] = {
    "email": (r"(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])", _email),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", _iban),
    "card": (r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])", _card),
    "ssn": (r"(?<![\w.+-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    "ip": (r"(?<![\w.+-])\d{1,3}(?:\.\d{1,3}){3}(?![\w-]|\.\d)", _ip),
    "date": (r"(?<![\w.+/-])(?:\d{4}([-./])\d{2}\1\d{2}|\d{2}([-./])\d{2}\2\d{4})(?![\w/-])", _date),
    "phone": (
        r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-])"
        r"|(?<![\w.+-])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?![\w-])",
        _phone,
    ),
}
_PATTERNS = {name: re.compile(pattern, re.ASCII) for name, (pattern, _) in FORMATS.items()}
_HINT = re.compile(r"\d|@", re.ASCII)
_DIGIT_RUN = re.compile(r"(?<![\w.+-])\d(?:[ -]?\d){12,}", re.ASCII)
_IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def _iban_ends(text: str, m: re.Match) -> Iterator[int]:
    """Where the IBAN at ``m`` may end: at its country's length, then as far as it matches, then at shorter groups."""
    ends = [i for i in range(m.end(), m.start(), -1) if i == m.end() or text[i] == " "]
    length = _IBAN_LENGTHS.get(text[m.start() : m.start() + 2])
    own = [i for i in ends if len(text[m.start() : i].replace(" ", "")) == length]
    yield from own
    yield from (i for i in (ends[:1] if length else ends) if i not in own)


def _card_ends(text: str, start: int, stop: int) -> list[int]:
    """Group borders behind 13 to 19 digits from ``start`` on, the farthest first; none inside another kind of value."""
    ends, digits = [], 0
    for i in range(start, stop):
        digits += text[i].isdigit()
        if digits > 19:
            break
        if digits >= 13 and text[i].isdigit() and (i + 1 == stop or not text[i + 1].isdigit()):
            ends.append(i + 1)
    others = [(e, m.end()) for e in ends for k in ("email", "ssn", "ip", "date", "phone") if (m := _PATTERNS[k].match(text, e + 1))]
    inside = lambda e: any(a < e < b for a, b in others)
    return [e for e in reversed(ends) if not inside(e)]


def _cards(text: str, move: Move) -> Iterator[tuple[int, int, str]]:
    for run in _DIGIT_RUN.finditer(text):
        at, stop = run.span()
        if re.match(r"[\w-]", text[stop : stop + 1], re.ASCII):  # the last group goes on in letters: not a number
            stop = max(text.rfind(" ", at, stop), text.rfind("-", at, stop), at)
        while at < stop:
            found = ((e, _card(text[at:e], move)) for e in _card_ends(text, at, stop))
            end, new = next((x for x in found if x[1] is not None), (at, None))
            if new is not None:
                yield at, end, new
            # On behind the value, or at the next group. A number does not begin behind a hyphen.
            space = text.find(" ", end, stop)
            at = space + 1 if space >= 0 else stop


def _ibans(text: str, move: Move) -> Iterator[tuple[int, int, str]]:
    at = 0
    while m := _PATTERNS["iban"].search(text, at):
        found = ((e, _iban(text[m.start() : e], move)) for e in _iban_ends(text, m))
        at, new = next((x for x in found if x[1] is not None), (m.start() + 1, None))
        if new is not None:
            yield m.start(), at, new


def replacements(text: str, move: Move) -> list[tuple[int, int, str, str]]:
    """``(start, end, format, new)`` of the validated values, without overlaps.

    A format is searched for in what those before it leave. Where the longest match of a card or an IBAN
    fails its check, shorter ones that end at a separator are tried.
    """
    if not _HINT.search(text):
        return []
    taken: list[tuple[int, int, str, str]] = []
    rest = text
    for name, (_, change) in FORMATS.items():
        if name == "email" and "@" not in text:
            continue
        if name in ("iban", "card"):
            found = list((_ibans if name == "iban" else _cards)(rest, move))
        else:
            tried = ((m.start(), m.end(), change(m[0], move)) for m in _PATTERNS[name].finditer(rest))
            found = [x for x in tried if x[2] is not None]
        parts, at = [], 0
        for start, end, new in found:
            taken.append((start, end, name, new))
            parts += [rest[at:start], "x" * (end - start)]
            at = end
        rest = "".join([*parts, rest[at:]]) if found else rest
    return sorted(taken)


def mover(key: bytes, back: bool = False) -> Move:
    """The keyed move between ranks; permutations are kept per format."""
    known: dict[tuple[str, int], Permutation] = {}

    def move(name: str, size: int, rank: int) -> int:
        p = known.get((name, size))
        if p is None:
            if len(known) > 10_000:
                known.clear()
            p = known[name, size] = Permutation(key, name, size)
        return p.back(rank) if back else p.forward(rank)

    return move


def pseudonymise(
    docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text", back: bool = False
) -> DataFrame:
    """``(id, n_found, kinds, spans, text)`` per row: what was replaced, where, and the new text.

    ``kinds`` counts the replaced values per format, ``spans`` are code points of the old text. ``back``
    turns pseudonyms into the old values again. A NULL text stays NULL with no find; rows
    that repeat give rows that repeat; extra columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, n_found long, kinds map<string,int>, "
        "spans array<struct<kind:string,start:int,end:int>>, text string"
    )

    def change(table: pa.Table) -> pa.Table:
        move = mover(key, back)
        kinds, spans, texts = [], [], []
        for value in table["text"].to_pylist():
            found = replacements(value or "", move)
            counts: dict[str, int] = {}
            parts, at = [], 0
            for start, end, name, new in found:
                counts[name] = counts.get(name, 0) + 1
                parts += [value[at:start], new]
                at = end
            kinds.append(sorted(counts.items()))
            spans.append([{"kind": name, "start": s, "end": e} for s, e, name, _ in found])
            texts.append("".join([*parts, value[at:]]) if found else value)
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.table(
            {
                "id": table["id"],
                "n_found": pa.array([len(s) for s in spans], pa.int64()),
                "kinds": pa.array(kinds, pa.map_(pa.string(), pa.int32())),
                "spans": pa.array(spans, span),
                "text": pa.array(texts, pa.string()),
            }
        )

    return map_arrow(rows, change, schema, 8 << 20)
