"""Format-preserving pseudonyms of personal numbers, dates, addresses and credentials.

A value found and validated is permuted within its own format by a keyed Feistel network over its characters, so equal
values stay equal in all documents, however they are punctuated, and the result is valid again: a card number keeps a
right check digit, a date stays a date. Values outside a format's domain are permuted again until they are inside
(cycle walking), which keeps the map one to one. Without the key it cannot be undone.
"""

from __future__ import annotations

import datetime as dt
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewatt.llm.shared import prepare
from tidewatt.llm.words import slices

ROUNDS = 10
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
# Dates are permuted among the days of these years.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutations; each kind of value is a domain of its own."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, kind: str, size: tuple, i: int, value: int) -> int:
        data = f"{kind}|{size}|{i}|{value}".encode()
        return int.from_bytes(blake2b(data, key=self.key, digest_size=16).digest(), "big")

    def digits(self, kind: str, value: int, sizes: list[int], backward: bool = False) -> int:
        """Permutes a number of mixed radix: digit i runs below sizes[i]."""
        half = len(sizes) // 2
        left = right = 1
        for s in sizes[:half]:
            left *= s
        for s in sizes[half:]:
            right *= s
        a, b = divmod(value, right)
        shape = (left, right)
        for i in reversed(range(ROUNDS)) if backward else range(ROUNDS):
            sign = -1 if backward else 1
            if i % 2:
                b = (b + sign * self._round(kind, shape, i, a)) % right
            else:
                a = (a + sign * self._round(kind, shape, i, b)) % left
        return a * right + b

    def walk(self, kind: str, value: int, sizes: list[int], inside: Callable[[int], bool], backward: bool = False) -> int:
        value = self.digits(kind, value, sizes, backward)
        while not inside(value):
            value = self.digits(kind, value, sizes, backward)
        return value

    def number(self, kind: str, text: str, inside: Callable[[str], bool] = lambda x: True, backward: bool = False) -> str:
        """Permutes the digit strings of a length among those inside; a single digit is rotated."""
        n = len(text)
        if n == 1:
            step = 1 + self._round(kind, (10,), 0, 0) % 9
            return str((int(text) + (-step if backward else step)) % 10)
        out = self.walk(kind, int(text), [10] * n, lambda v: inside(str(v).zfill(n)), backward)
        return str(out).zfill(n)

    def word(self, kind: str, text: str, backward: bool = False) -> str:
        """Permutes letters and digits within their class (a-z, A-Z, 0-9), each place keeping its class."""
        classes = [next((c for c in (DIGITS, LOWER, UPPER) if x in c), None) for x in text]
        sizes = [len(c) for c in classes if c]
        if not sizes:
            return text
        value = 0
        for x, c in zip(text, classes):
            if c:
                value = value * len(c) + c.index(x)
        if len(sizes) == 1:
            step = 1 + self._round(kind, tuple(sizes), 0, 0) % (sizes[0] - 1)
            value = (value + (-step if backward else step)) % sizes[0]
        else:
            value = self.digits(kind, value, sizes, backward)
        out = []
        for c, x in zip(reversed(classes), reversed(text)):
            if c:
                value, at = divmod(value, len(c))
                x = c[at]
            out.append(x)
        return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    total = sum(int(x) if i % 2 else sum(divmod(2 * int(x), 10)) for i, x in enumerate(reversed(digits)))
    return -total % 10


def _put(text: str, digits: str) -> str:
    """text with its digits replaced in turn."""
    new = iter(digits)
    return "".join(next(new) if x in DIGITS else x for x in text)


def _only(text: str) -> str:
    return "".join(x for x in text if x in DIGITS)


def _card(f: Feistel, m: re.Match, back: bool) -> str | None:
    d = _only(m[0])
    if int(d[-1]) != luhn(d[:-1]) or not int(d):
        return None
    if len(d) < 16 and _PLUS.match(m.string, max(m.start() - 1, 0)):
        return None  # a phone number
    body = f.number("card", d[:-1], lambda x: int(x) > 0, back)
    return _put(m[0], body + str(luhn(body)))


def _iban_check(country: str, body: str) -> str:
    digits = "".join(str(int(x, 36)) for x in body + country + "00")
    return str(98 - int(digits) % 97).zfill(2)


def _iban(f: Feistel, m: re.Match, back: bool) -> str | None:
    plain = m[0].replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if check != _iban_check(country, body):
        return None
    body = f.word(f"iban{country}", body, back)
    new = iter(country + _iban_check(country, body) + body)
    return "".join(x if x == " " else next(new) for x in m[0])


def _good_phone(d: str) -> bool:
    return d[0] in "23456789" and d[3] in "23456789"


# What may stand between two groups of a phone number.
_SEP = r"[ ./\u00a0\u2010-\u2013-]"
# A date or an address after a phone number is not a group of it.
_NEXT = r"(?!\d{4}-\d\d-\d\d(?!\d)|(?<!\.)\d\d?[./]\d\d?[./]\d{4}(?!\d)|(?<!\.)\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"
_END = r"(?:(?!\w)|(?=x\d))"
_PLUS = re.compile(rf"(?<![\w+])\+\(?\d{{1,15}}(?:(?:{_SEP}\(?|\){_SEP}?\(?|\(){_NEXT}\d{{1,14}}){{0,7}}{_END}", re.A)
_BRACKETS = re.compile(rf"(?<![\w+(])\((?![1-9]\d{{3}}\))\d{{2,6}}\){_SEP}?\d{{2,8}}(?:{_SEP}{_NEXT}\d{{2,8}}){{0,4}}{_END}", re.A)
_GROUPS = re.compile(rf"(?<![\w+])(?:\(\d{{3}}\){_SEP}?|\d{{3}}{_SEP}?)\d{{3}}{_SEP}?\d{{4}}{_END}", re.A)
# Neither a date nor a social number; a leading 0 and groups make it a phone.
_TRUNK = re.compile(
    rf"(?<![\w+.,/-])(?!\d\d?{_SEP}\d\d?{_SEP}\d{{4}}(?!\d))(?!\d{{3}}-\d\d-\d{{4}}(?![\w-]))"
    rf"0\d{{1,5}}(?:{_SEP}{_NEXT}\d{{2,8}}){{1,5}}(?!:\d){_END}", re.A)
_TWO = {"20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54",
        "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98"}


def _code(d: str) -> int:
    """Digits of the country code a number begins with."""
    return 1 if d[0] in "17" else 2 if d[:2] in _TWO else 3


def _local(f: Feistel, d: str, back: bool) -> str:
    """A leading 0 (trunk prefix) stays; the rest stays in its class, so that it is read in the same way again."""
    head, d = ("0", d[1:]) if d[0] == "0" else ("", d)
    of = lambda x: (x[0] == "0", len(x) == 10 and _good_phone(x))
    return head + f.number("phone", d, lambda x: of(x) == of(d), back)


def _plus(f: Feistel, m: re.Match, back: bool) -> tuple[str, int] | None:
    """(pseudonym, its end): the country code stays. Groups that would make the number too long are not part of it."""
    groups = list(re.finditer(r"\d+", m[0]))
    code, most = _code(_only(m[0])), 11 if groups[0][0][0] in "17" else 13
    if len(groups[0][0]) < code:
        if m[0][groups[0].end():groups[0].end() + 1] == ".":
            return None  # a decimal number
        code = len(groups[0][0])
    n = len(groups[0][0])
    end = groups[0].end()
    for g in groups[1:]:
        if n + len(g[0]) > most:
            break
        n, end = n + len(g[0]), g.end()
    text = m[0][:end]
    d = _only(text)
    if not 7 <= n <= 15 or n - code < 4:
        return None
    return _put(text, d[:code] + _local(f, d[code:], back)), m.start() + end


def _grouped(f: Feistel, m: re.Match, back: bool) -> str | None:
    d = _only(m[0])
    if len(d) == len(m[0]) and not _good_phone(d):
        return None  # a bare run of ten digits
    return _put(m[0], _local(f, d, back))


def _spaced(f: Feistel, m: re.Match, back: bool) -> str | None:
    d = _only(m[0])
    return _put(m[0], _local(f, d, back)) if 8 + (m[0][0] == "0") <= len(d) <= 13 else None


def _good_social(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _social(f: Feistel, m: re.Match, back: bool) -> str | None:
    d = _only(m[0])
    return _put(m[0], f.number("social", d, _good_social, back)) if _good_social(d) else None


def _address(f: Feistel, m: re.Match, back: bool) -> str | None:
    parts = [int(x) for x in m[0].split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")):
        return None
    value = f.digits("address", int.from_bytes(bytes(parts), "big"), [256] * 4, back)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(f: Feistel, m: re.Match, back: bool) -> str | None:
    """ISO dates, else day and month in that order, or month first where only that is a date."""
    a, b, c = (int(x) for x in m.group("a", "b", "c"))
    orders = ("ymd",) if len(m["a"]) == 4 else ("dmy", "mdy")
    for order in orders:
        part = dict(zip(order, (a, b, c)))
        try:
            day = dt.date(part["y"], part["m"], part["d"]).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        # The order must be readable again, so dates written month first stay among those that need it.
        keeps = (lambda v: True) if order != "mdy" else (lambda v: dt.date.fromordinal(FIRST_DAY + v).day > 12)
        new = f.walk(f"date{order == 'mdy'}", day - FIRST_DAY, [272, 272],
                     lambda v: v <= LAST_DAY - FIRST_DAY and keeps(v), back)
        new = dt.date.fromordinal(FIRST_DAY + new)
        values = {"y": f"{new.year:04}", "m": f"{new.month:02}", "d": f"{new.day:02}"}
        return m["s"].join(values[x] for x in order)
    return None


def _mail(f: Feistel, m: re.Match, back: bool) -> str | None:
    return f.word("mail", m["name"], back) + m["host"]


def _secret(f: Feistel, m: re.Match, back: bool) -> str | None:
    return m["before"] + f.word("secret", m["value"], back)


# Kind, pattern, pseudonym, what a text must contain to be searched; earlier kinds win where spans overlap.
KINDS: list[tuple[str, re.Pattern, Callable, str]] = [
    ("secrets", re.compile(r"(?P<before>\bAKIA)(?P<value>[0-9A-Z]{16})(?![0-9A-Za-z])"), _secret, "AKIA"),
    ("secrets", re.compile(
        r"(?P<before>\b(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?)(?P<value>[^\s\"']{6,})"),
     _secret, "=:"),
    ("emails", re.compile(r"(?<![\w.%+-])(?P<name>[\w.%+-]++)(?P<host>@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)", re.A), _mail, "@"),
    ("ibans", re.compile(
        r"(?<!\w)[A-Z]{2}\d\d(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)", re.A), _iban, DIGITS),
    ("cards", re.compile(
        r"(?<!\w)(?:\d{13,19}|\d{4}(?P<s>[ -])\d{4}(?P=s)\d{4}(?P=s)\d{1,7}|\d{4}(?P<t>[ -])\d{6}(?P=t)\d{5})(?!\w)", re.A), _card, DIGITS),
    ("phones", _PLUS, _plus, "+"),
    ("phones", _GROUPS, _grouped, DIGITS),
    ("phones", _BRACKETS, _spaced, "("),
    ("phones", _TRUNK, _spaced, "0"),
    ("socials", re.compile(r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])", re.A), _social, DIGITS),
    ("addresses", re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", re.A), _address, DIGITS),
    ("dates", re.compile(r"(?<![\w./-])(?P<a>\d{4})(?P<s>-)(?P<b>\d\d)-(?P<c>\d\d)(?!(?![Tt]\d\d)[\w-])", re.A), _date, DIGITS),
    ("dates", re.compile(r"(?<![\w./-])(?P<a>\d\d?)(?P<s>[./])(?P<b>\d\d?)(?P=s)(?P<c>\d{4})(?!(?![Tt]\d\d)\w)", re.A), _date, DIGITS),
]
NAMES = list(dict.fromkeys(k for k, *_ in KINDS))
_ANY = re.compile(r"[0-9@=:]")


def pseudonymous(text: str, feistel: Feistel, back: bool = False) -> tuple[str, dict[str, int]]:
    """(text with pseudonyms, values replaced by kind); back restores the values."""
    counts = dict.fromkeys(NAMES, 0)
    if not _ANY.search(text):
        return text, counts
    taken: list[tuple[int, int, str]] = []  # in order, without overlaps
    for kind, pattern, make, needs in KINDS:
        if not any(x in text for x in ([needs] if needs == "AKIA" else needs)):
            continue
        starts, fresh = [a for a, *_ in taken], []
        for m in pattern.finditer(text):
            # The last span that begins before the match ends is the only one that can reach into it.
            k = bisect_left(starts, m.end()) - 1
            if k >= 0 and taken[k][1] > m.start() or fresh and fresh[-1][1] > m.start():
                continue
            new = make(feistel, m, back)
            if new is not None:
                new, end = new if isinstance(new, tuple) else (new, m.end())
                fresh.append((m.start(), end, new))
                counts[kind] += 1
        taken = sorted(taken + fresh) if fresh else taken
    out, at = [], 0
    for a, b, new in taken:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), counts


def _replace(key: bytes, column: str, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for part in slices(batches, column):
            found = [(None, dict.fromkeys(NAMES, 0)) if t is None else pseudonymous(t, feistel, back)
                     for t in part.column(column).to_pylist()]
            i = part.schema.get_field_index(column)
            counts = pa.StructArray.from_arrays(
                [pa.array([c[k] for _, c in found], pa.int64()) for k in NAMES], NAMES)
            part = part.set_column(i, column, pa.array([t for t, _ in found], part.schema.field(i).type))
            yield part.append_column("_replaced", counts)

    return run


def pseudonymize(docs: DataFrame, key: bytes, column: str = "text", back: bool = False) -> DataFrame:
    """docs with pseudonyms in column, and _replaced: values by kind. Rows are independent; nothing is shuffled.

    Null stays null; an empty text stays empty; repeated rows get equal results. back undoes it under the same key.
    """
    prepare(docs.sparkSession)
    counts = T.StructType([T.StructField(k, T.LongType()) for k in NAMES])
    schema = T.StructType([*docs.schema.fields, T.StructField("_replaced", counts)])
    return docs.mapInArrow(_replace(key, column, back), schema)
