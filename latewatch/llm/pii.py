"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found in whole texts and validated: payment cards (13 to 19
digits, Luhn), IBANs (ISO 7064 check), telephone numbers (ten digits in a usual
grouping, or a leading + and 8 to 15 digits), social security numbers, IPv4 addresses,
calendar dates (year first, or day and month by slash or dot), and e-mail
addresses.  What fails validation stays.

A pattern may take words or digit groups beside a value along.  Where that fails
validation, shorter ends are tried (for an IBAN first the length its country fixes),
and then the search goes on behind the failed match's first character.

A value becomes its place in the numbered set of valid values of its format; a
keyed Feistel network permutes the places (cycle-walking keeps it in the set), and
the new place is written back in the same format: same separators, valid check
digits, real dates, and but for IPv4 addresses the same length.  Being a permutation, it
never merges two values; being keyed by format only, equal values get equal pseudonyms in
all documents, whatever stands beside them and however they are spelt (separators aside;
dates whose day is above 12 are permuted among themselves in every spelling, so one by
slash that can only be read day first stays such).

Whoever has the key can reverse it (``back``).  A pseudonym may make a rejected reading
valid (a digit group before a card, say), so a text alone does not tell which reading was
taken: ``spans`` tells it, kind, begin and length in characters of each pseudonym in the
new text, and the way back needs that column.

The key is a parameter; without it the pseudonyms can be neither made nor undone.

Null texts stay null, empty ones empty.  Repeated rows get the same pseudonyms.
Columns beyond doc_id, text and (on the way back) spans are not read; null spans are none.
Texts of any length are handled whole.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

ROUNDS = 10
#: Days that are permuted, as ordinals; those above the twelfth of a month, which cannot be read as months, apart from the others.
EARLY, LATE = ([d for d in range(date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal()) if (date.fromordinal(d).day > 12) == late] for late in (False, True))
#: Lengths of IBANs by country.
IBAN_LENGTHS = {c: int(n) for n, cs in {
    "15": "NO", "16": "BE", "18": "DK FI FK FO GL NL SD", "19": "MK SI", "20": "AT BA EE KZ LT LU MN XK", "21": "CH HR LI LV",
    "22": "BG BH CR DE GB GE IE ME RS VA", "23": "AE GI IL IQ OM SO TL", "24": "AD CZ ES MD PK RO SA SE SK TN VG", "25": "LY PT ST",
    "26": "IS TR", "27": "BI DJ FR GR IT MC MR SM", "28": "AL AZ BY CY DO GT HU LB NI PL SV", "29": "BR EG PS QA UA", "30": "JO KW MU YE",
    "31": "MT SC", "32": "LC", "33": "RU"}.items() for c in cs.split()}
#: For the registered query only; give your own.
EXAMPLE_KEY = b"example key, replace by a secret"


class Feistel:
    """A keyed permutation of range(n), one for each ``tweak``."""

    def __init__(self, key: bytes, tweak: str, n: int) -> None:
        self.n, self.key = n, hashlib.blake2b(key, digest_size=32).digest()
        self.tweak = tweak.encode()
        self.a = max(1, math.isqrt(max(0, n - 1)) + 1)
        self.b = -(-n // self.a)

    def _mix(self, i: int, half: int, size: int) -> int:
        said = b"%d|%d|%d|" % (i, self.n, half) + self.tweak
        return int.from_bytes(hashlib.blake2b(said, digest_size=64, key=self.key).digest(), "big") % size

    def _once(self, x: int, back: bool) -> int:
        left, right = divmod(x, self.b)  # left below a, right below b
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * self._mix(i, left, self.b)) % self.b
            else:
                left = (left + sign * self._mix(i, right, self.a)) % self.a
        return left * self.b + right

    def permute(self, x: int, back: bool = False) -> int:
        """The place of ``x``; with ``back`` the other way round."""
        if not 0 <= x < self.n:
            raise ValueError(x)
        x = self._once(x, back)
        while x >= self.n:
            x = self._once(x, back)
        return x


def luhn_digit(payload: str) -> str:
    """The check digit of a card's other digits."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(int(c) for c in reversed(payload)))
    return str(-total % 10)


def iban_digits(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _into(shape: str, new: str) -> str:
    """``new``'s characters at the places of the letters and digits of ``shape``."""
    rest = iter(new)
    return "".join(next(rest) if c.isascii() and c.isalnum() else c for c in shape)


class Pseudonyms:
    """Finds and replaces in one text after another."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.key, self.back = key, back
        self._networks: dict[tuple[str, int], Feistel] = {}
        self._one = lru_cache(100_000)(self._permuted)

    def _permuted(self, kind: str, n: int, x: int) -> int:
        if (kind, n) not in self._networks:
            self._networks[kind, n] = Feistel(self.key, kind, n)
        return self._networks[kind, n].permute(x, self.back)

    def _valid(self, kind: str, n: int, x: int, ok: Callable[[int], bool]) -> int:
        """Walks on until the place is a valid one."""
        x = self._one(kind, n, x)
        while not ok(x):
            x = self._one(kind, n, x)
        return x

    def card(self, text: str) -> str | None:
        d = _digits(text)
        if not 13 <= len(d) <= 19 or d[0] == "0" or luhn_digit(d[:-1]) != d[-1]:
            return None
        body = d[1:-1]  # the first digit, the kind of card, stays
        new = d[0] + f"{self._one(f'card{d[0]}', 10 ** len(body), int(body)):0{len(body)}d}"
        return _into(text, new + luhn_digit(new))

    def iban(self, text: str) -> str | None:
        s = text.replace(" ", "")
        body = s[4:]
        if not 15 <= len(s) <= 34 or iban_digits(s[:2], body) != s[2:4]:
            return None
        # digits stay digits and letters letters
        x, n = 0, 1
        for c in body:
            size = 10 if c.isdigit() else 26
            x, n = x * size + (int(c) if c.isdigit() else ord(c) - 65), n * size
        shape = "".join("9" if c.isdigit() else "A" for c in body)
        x, new = self._one(f"iban{s[:2]}{shape}", n, x), ""
        for c in reversed(shape):
            x, r = divmod(x, 10 if c == "9" else 26)
            new = (str(r) if c == "9" else chr(65 + r)) + new
        return _into(text, s[:2] + iban_digits(s[:2], new) + new)

    @staticmethod
    def _nanp(x: int) -> bool:
        d = f"{x:010d}"
        return d[0] in "23456789" and d[3] in "23456789" and d[1:3] != "11" and d[4:6] != "11"

    def phone(self, text: str) -> str | None:
        d = _digits(text)
        plus = text.lstrip("(").startswith("+")
        if len(d) == 11 and d[0] == "1" and (plus or text[0] == "1"):
            head, own = "1", d[1:]
        elif len(d) == 10 and not plus:
            head, own = "", d
        elif plus and 8 <= len(d) <= 15 and d[0] != "0":
            head, own = d[:2], d[2:]
            return _into(text, head + f"{self._one('phone' + head, 10 ** len(own), int(own)):0{len(own)}d}")
        else:
            return None
        proper = self._nanp(int(own))  # numbers that only look like one stay such
        return _into(text, head + f"{self._valid('phone', 10 ** 10, int(own), lambda x: self._nanp(x) == proper):010d}")

    @staticmethod
    def _ssn(x: int) -> bool:
        d = f"{x:09d}"
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    def ssn(self, text: str) -> str | None:
        x = int(_digits(text))
        return _into(text, f"{self._valid('ssn', 10 ** 9, x, self._ssn):09d}") if self._ssn(x) else None

    def ipv4(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        x = self._one("ipv4", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _day(self, year: str, month: str, day: str) -> date | None:
        try:
            found = date(int(year), int(month), int(day))
        except ValueError:
            return None
        kind, days = ("late", LATE) if found.day > 12 else ("early", EARLY)
        if not days[0] <= found.toordinal() <= days[-1]:
            return None
        return date.fromordinal(days[self._one(f"date {kind}", len(days), bisect_left(days, found.toordinal()))])

    def date(self, text: str) -> str | None:
        a, sep, b, _, c = re.fullmatch(r"(\d+)(\D)(\d+)(\D)(\d+)", text).groups()
        if len(a) == 4:
            new = self._day(a, b, c)
            return new and f"{new.year:04d}{sep}{new.month:02d}{sep}{new.day:02d}"
        # by slash the month comes first where it can; by dot the day does
        first = sep == "/" and int(a) <= 12
        new = self._day(c, a, b) if first else self._day(c, b, a)
        if not new:
            return None
        x, y = (new.month, new.day) if first else (new.day, new.month)
        return f"{x:02d}{sep}{y:02d}{sep}{new.year:04d}"

    def email(self, text: str) -> str | None:
        local, _, host = text.rpartition("@")
        if not local.isascii() or not any(c.isalnum() for c in local):
            return None
        low = [c.lower() for c in local if c.isalnum()]
        x, n = 0, 1
        for c in low:
            size = 10 if c.isdigit() else 26
            x, n = x * size + (int(c) if c.isdigit() else ord(c) - 97), n * size
        shape = "".join("9" if c.isdigit() else "a" for c in low)
        x, new = self._one(f"email{shape}@{host.lower()}", n, x), ""
        for c in reversed(shape):
            x, r = divmod(x, 10 if c == "9" else 26)
            new = (str(r) if c == "9" else chr(97 + r)) + new
        cased = "".join(b.upper() if a.isupper() else b for a, b in zip((c for c in local if c.isalnum()), new, strict=True))
        return f"{_into(local, cased)}@{host}"

    #: In this order; what one takes the next don't see.
    KINDS = [
        ("email", re.compile(r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+", re.ASCII), "@"),
        ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b", re.ASCII), ""),
        ("date", re.compile(r"(?<![\d.\-/])(?:\d{4}([\-/.])(?:0[1-9]|1[0-2])\1\d{2}|\d{2}([/.])\d{2}\2\d{4})(?![\d\-/]|\.\d)", re.ASCII), ""),
        ("ipv4", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", re.ASCII), "."),
        ("ssn", re.compile(r"(?<![\d\-])\d{3}([\- ])\d{2}\1\d{4}(?![\d\-])", re.ASCII), ""),
        ("card", re.compile(r"(?<!\d)\d{13,19}(?!\d)", re.ASCII), ""),
        ("card", re.compile(r"(?<!\d)\d{4}([ \-])(?:\d{4}\1\d{4}\1\d{1,7}|\d{6}\1\d{4,5})(?!\d)", re.ASCII), ""),
        ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .\-]?)?(?:1[ .\-])?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)|(?<![\w+])\+\d(?:[ .\-]?\(?\d\)?){7,14}(?!\d)|(?<![\w+.\-])(?:1[ .\-])?\d{3}([ .\-])\d{3}\1\d{4}(?!\d)", re.ASCII), ""),
    ]

    @staticmethod
    def _ends(kind: str, pattern: re.Pattern, text: str, a: int, b: int) -> Iterator[int]:
        """Where a value that begins at ``a`` may end, in the order to try; ``b`` ends the pattern's match."""
        if kind == "iban" and (length := IBAN_LENGTHS.get(text[a:a + 2])):
            places = [i for i in range(a, b) if text[i] != " "]
            if len(places) > length and text[places[length - 1] + 1] == " ":
                yield places[length - 1] + 1
        yield b
        if kind in ("card", "phone"):
            for e in range(b - 1, a, -1):
                if text[e - 1].isalnum() and not text[e].isalnum() and (m := pattern.match(text, a, e)) and m.end() == e:
                    yield e

    def _first(self, kind: str, pattern: re.Pattern, text: str, a: int, b: int, taken: bytearray) -> tuple[int, str] | None:
        """End and pseudonym of the value that begins at ``a``."""
        for e in self._ends(kind, pattern, text, a, b):
            if taken.find(1, a, e) < 0 and (new := getattr(self, kind)(text[a:e])) is not None:
                return e, new
        return None

    def found(self, text: str) -> list[tuple[str, int, int, str]]:
        """Kind, begin, end and pseudonym of each value, by begin."""
        out: list[tuple[str, int, int, str]] = []
        taken = bytearray()
        if not _DIGIT.search(text) and "@" not in text:
            return out
        for kind, pattern, needs in self.KINDS:
            if needs and needs not in text:
                continue
            at = 0
            while m := pattern.search(text, at):
                a, b = m.span()
                taken = taken or bytearray(len(text))
                got = self._first(kind, pattern, text, a, b, taken)
                at = got[0] if got else a + 1
                if got:
                    taken[a:at] = b"\x01" * (at - a)
                    out.append((kind, a, at, got[1]))
        return sorted(out, key=lambda x: x[1])

    def replaced(self, text: str, spans: list[tuple[str, int, int]] | None = None) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and kind, begin and length of each in it; where ``spans`` are given, of the values there."""
        values = self.found(text) if spans is None else [(kind, a, a + n, None) for kind, a, n in spans]
        out, at, size, now = [], 0, 0, []
        for kind, a, b, new in values:
            if not at <= a < b <= len(text) or (new := new or getattr(self, kind)(text[a:b])) is None:
                raise ValueError(f"no {kind} at {a} to {b}: the text is not the one its spans belong to")
            out += [text[at:a], new]
            now.append((kind, size + a - at, len(new)))
            size, at = size + a - at + len(new), b
        return "".join(out) + text[at:], now

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        new, spans = self.replaced(text)
        return new, dict(Counter(kind for kind, _, _ in spans))


_DIGIT = re.compile(r"\d")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int32()), ("length", pa.int32())]))


def _replaced(key: bytes, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonyms(key, back)
        kinds = list(dict.fromkeys(k for k, _, _ in Pseudonyms.KINDS))
        for batch in batches:
            for part in slices(batch):
                texts, spans, counts = [], [], []
                given = part.column("spans").to_pylist() if back else [None] * part.num_rows
                for text, old in zip(part.column("text").to_pylist(), given, strict=True):
                    places = [(x["kind"], x["begin"], x["length"]) for x in old or ()] if back else None
                    new, now = (None, []) if text is None else own.replaced(text, places)
                    texts.append(new)
                    spans.append([{"kind": k, "begin": a, "length": n} for k, a, n in now])
                    found = Counter(k for k, _, _ in now)
                    counts.append([found[k] for k in kinds])
                columns = [part.column("doc_id"), pa.array(texts, pa.string()), pa.array(spans, _SPANS), pa.array([sum(c) for c in counts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(kinds))], names=["doc_id", "text", "spans", "n_replaced", *[f"n_{k}" for k in kinds]])
    return run


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, spans, n_replaced and the number of each kind; with ``back`` undone at the ``spans`` of docs."""
    kinds = "".join(f", n_{k} long" for k in dict.fromkeys(k for k, _, _ in Pseudonyms.KINDS))
    spans = "array<struct<kind:string,begin:int,length:int>>"
    wanted = [F.col("doc_id").cast("long"), F.col("text").cast("string"), *([F.col("spans").cast(spans)] if back else [])]
    return docs.select(*wanted).mapInArrow(_replaced(key, back), f"doc_id long, text string, spans {spans}, n_replaced long" + kinds)
