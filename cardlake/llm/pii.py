"""Pseudonyms for personal data that keep its format, by keyed Feistel permutations.

Validated values (payment cards, IBANs, social security numbers, telephone numbers, IPv4
addresses, e-mail addresses, dates) are replaced by other valid values of the same format.
The replacement is a keyed permutation of all values of that format: equal values get
equal pseudonyms in every document, different ones different pseudonyms, and who holds the
key can go back. No value is its own pseudonym.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cardlake.llm.naming import unused
from cardlake.llm.shipping import ship_package

ROUNDS = 8


class Feistel:
    """A keyed permutation of range(size) without fixed points, for any size from 2.

    A balanced Feistel network permutes the next power of four; values outside the range
    walk on until they are inside. The permutation is the network, one step onwards, and the
    network's inverse: one cycle over all values, so nothing stays where it is.
    """

    def __init__(self, key: bytes, name: str, size: int) -> None:
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.width = (self.half + 7) // 8
        tags = [f"{name}:{size}:{i}".encode() for i in range(ROUNDS)]
        self.keyed = [hashlib.blake2b(tag, key=key, digest_size=self.width) for tag in tags]

    def _round(self, i: int, value: int) -> int:
        state = self.keyed[i].copy()
        state.update(value.to_bytes(self.width, "big"))
        return int.from_bytes(state.digest(), "big") & self.mask

    def _walk(self, value: int, rounds: range) -> int:
        forward = rounds.step > 0
        while True:
            left, right = value >> self.half, value & self.mask
            for i in rounds:
                if forward:
                    left, right = right, left ^ self._round(i, right)
                else:
                    left, right = right ^ self._round(i, left), left
            value = left << self.half | right
            if value < self.size:
                return value

    def _moved(self, value: int, by: int) -> int:
        if self.size < 2:
            return value
        inner = self._walk(value, range(ROUNDS))
        return self._walk((inner + by) % self.size, range(ROUNDS - 1, -1, -1))

    def replace(self, value: int) -> int:
        return self._moved(value, 1)

    def restore(self, value: int) -> int:
        return self._moved(value, -1)


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` with it a valid card number."""
    total = 0
    for place, c in enumerate(reversed(digits)):
        twice = int(c) * (2 if place % 2 == 0 else 1)
        total += twice - 9 if twice > 9 else twice
    return str(-total % 10)


def _iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


# Patterns of candidates; what they find is validated before it is replaced (fixed values).
PATTERNS = {
    "email": r"(?<![\w.%+-])%*[^\W_][\w.%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}\b",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "date": r"(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![\w-]|[./][0-9])",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?!\w)"
             r"|(?<![\w+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,5}(?!\w)"
             r"|(?<![\w+.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])",
    "card": r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])",
}
KINDS = tuple(PATTERNS)
_FINDER = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
# Every value holds a digit or an at sign; texts without either need no further look.
_HINT = re.compile("[0-9@]")
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST_DAY + 1


def _written(a: int, b: int, style: str) -> str:
    """Two numbers before a year: each padded to two digits (``2``) or as it is (``1``)."""
    return "/".join(f"{x:02d}" if width == "2" else str(x) for x, width in zip((a, b), style))


def date_style(a: str, b: str) -> str:
    """How the two numbers of a date are written: ``22`` both in two digits, ``11`` neither
    padded and one of them a single digit, ``12`` and ``21`` one padded beside a single digit."""
    if len(a) == len(b) == 2:
        return "22"
    return f"{2 if a[0] == '0' else 1}{2 if b[0] == '0' else 1}"


@functools.cache
def _days_written(day_first: bool, style: str) -> tuple[list[int], dict[int, int]]:
    """The days that have a text of this form, and the place of each.

    A text is taken as day first wherever that is a date, so month first is left with days
    after the twelfth. Every text belongs to one form only.
    """
    days = []
    for number in range(_DAYS):
        day = datetime.date.fromordinal(number + _FIRST_DAY)
        pair = (day.day, day.month) if day_first else (day.month, day.day)
        a, b = _written(*pair, style).split("/")
        if (day_first or day.day > 12) and date_style(a, b) == style:
            days.append(number)
    return days, {number: place for place, number in enumerate(days)}


class Pseudonymiser:
    """Finds, validates and replaces values in texts under one key, or restores them (``back``)."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.key, self.back = key, back
        self.known: dict[tuple[str, int], Feistel] = {}

    def _permuted(self, name: str, value: int, size: int) -> int:
        if (name, size) not in self.known:
            if len(self.known) > 10_000:
                self.known.clear()
            self.known[name, size] = Feistel(self.key, name, size)
        permutation = self.known[name, size]
        return permutation.restore(value) if self.back else permutation.replace(value)

    def _digits(self, name: str, digits: str) -> str:
        return f"{self._permuted(name, int(digits), 10 ** len(digits)):0{len(digits)}d}"

    def _characters(self, name: str, text: str) -> str:
        """Letters to letters of the same case, digits to digits, all else stays."""
        bases = [(ord("a"), 26) if c.islower() and c.isascii() else (ord("A"), 26) if c.isupper() and c.isascii()
                 else (ord("0"), 10) if c in "0123456789" else None for c in text]
        value, size = 0, 1
        for c, base in zip(text, bases):
            if base:
                value, size = value * base[1] + ord(c) - base[0], size * base[1]
        value = self._permuted(name + "".join("x" if b is None else "9" if b[1] == 10 else "a" for b in bases), value, size)
        out = []
        for c, base in zip(reversed(text), reversed(bases)):
            if base:
                value, rest = divmod(value, base[1])
                c = chr(base[0] + rest)
            out.append(c)
        return "".join(reversed(out))

    @staticmethod
    def _refill(shape: str, digits: str) -> str:
        left = iter(digits)
        return "".join(next(left) if c in "0123456789" else c for c in shape)

    def email(self, value: str) -> str | None:
        local, _, domain = value.rpartition("@")
        if local.startswith("%"):  # no part of the address
            rest = value.lstrip("%")
            new = self.email(rest)
            return None if new is None else value[:len(value) - len(rest)] + new
        if not any(c.isascii() and c.isalnum() for c in local):
            return None
        return f"{self._characters('email:' + domain.lower(), local)}@{domain}"

    def card(self, value: str) -> str | None:
        digits = re.sub(r"[ -]", "", value)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = self._digits("card", digits[:-1])
        return self._refill(value, body + luhn_digit(body))

    def iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        account = self._characters("iban:" + plain[:2], plain[4:])
        left = iter(plain[:2] + _iban_check(plain[:2], account) + account)
        return "".join(" " if c == " " else next(left) for c in value)

    def ssn(self, value: str) -> str | None:
        area, group, serial = map(int, value.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        index = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        index = self._permuted("ssn", index, 898 * 99 * 9999)
        index, serial = divmod(index, 9999)
        area, group = divmod(index, 99)
        return f"{area + 1 + (area + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, value: str) -> str | None:
        country = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+1|", value).group()
        rest = value[len(country):]
        digits = re.sub(r"[^0-9]", "", rest)
        if not 7 <= len(digits) <= 12:
            return None
        return country + self._refill(rest, self._digits("phone" + country, digits))

    def ip(self, value: str) -> str | None:
        parts = [int(x) for x in value.split(".")]
        if max(parts) > 255:
            return None
        number = self._permuted("ip", int.from_bytes(bytes(parts), "big"), 2**32)
        return ".".join(map(str, number.to_bytes(4, "big")))

    def date(self, value: str) -> str | None:
        """Another day in the same form: separator, order and padding stay.

        The day is taken to come first, the month only where nothing else is a date. Every
        form has a permutation of its own days, so no two texts get one pseudonym.
        """
        mark = "-" if "-" in value else "/" if "/" in value else "."
        first, second, third = value.split(mark)
        if mark == "-":
            number = self._ordinal(first, second, third)
            return None if number is None else datetime.date.fromordinal(
                self._permuted("date", number, _DAYS) + _FIRST_DAY).isoformat()
        style = date_style(first, second)
        for day_first in (True, False):
            number = self._ordinal(third, second, first) if day_first else self._ordinal(third, first, second)
            if number is None:
                continue
            days, places = _days_written(day_first, style)
            name = f"date {'dm' if day_first else 'md'}{style}{mark}"
            new = datetime.date.fromordinal(days[self._permuted(name, places[number], len(days))] + _FIRST_DAY)
            pair = (new.day, new.month) if day_first else (new.month, new.day)
            return _written(*pair, style).replace("/", mark) + f"{mark}{new.year:04d}"
        return None

    @staticmethod
    def _ordinal(year: str, month: str, day: str) -> int | None:
        """Days since the first one, null for no date and for years out of range."""
        try:
            number = datetime.date(int(year), int(month), int(day)).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        return number if 0 <= number < _DAYS else None

    def apply(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms and how many values of each kind were replaced."""
        counts: dict[str, int] = {}
        if not _HINT.search(text):
            return text, counts

        def replace(match: re.Match) -> str:
            kind = match.lastgroup
            new = getattr(self, kind)(match.group())
            if new is None and kind == "phone":  # digits in groups may still be a card
                kind, new = "card", self.card(match.group()) if re.fullmatch(PATTERNS["card"], match.group()) else None
            if new is None:
                return match.group()
            counts[kind] = counts.get(kind, 0) + 1
            return new

        return _FINDER.sub(replace, text), counts


_WORKERS: dict[tuple[bytes, bool], Pseudonymiser] = {}


def _worker(key: bytes, back: bool) -> Pseudonymiser:
    if (key, back) not in _WORKERS:
        _WORKERS[key, back] = Pseudonymiser(key, back)
    return _WORKERS[key, back]


def pseudonymise(docs: DataFrame, key: bytes, text_column: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text_column`` and the columns ``pii_<kind>`` (counts).

    Texts without valid values stay as they are, byte for byte; null stays null with counts of
    0. All other columns pass through untouched; input columns that are called ``pii_<kind>``
    are replaced. The key is a secret of the caller: keep it to keep values linked from run
    to run, destroy it to make pseudonyms final. One narrow pass without a shuffle.

    Dates between 1900 and 2099 are moved within those years; others and impossible ones
    stay. Where day and month could be either, the day is taken to come first. With ``back``
    pseudonyms become the values they stand for again.
    """
    ship_package(docs.sparkSession)
    fields = ", ".join(f"{kind}: int" for kind in KINDS)

    @F.pandas_udf(f"struct<text: string, {fields}>")
    def replace(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker = _worker(key, back)
        for batch in texts:
            found = [worker.apply(t) if isinstance(t, str) else (None, {}) for t in batch]
            out = {"text": pd.Series([t for t, _ in found], dtype=object)}
            for kind in KINDS:
                out[kind] = pd.Series([c.get(kind, 0) for _, c in found], dtype="int32")
            yield pd.DataFrame(out)

    name = unused(docs.columns, "pseudonyms")
    return docs.withColumn(name, replace(F.col(text_column).cast("string"))).withColumns({
        text_column: F.col(name)["text"], **{f"pii_{kind}": F.col(name)[kind] for kind in KINDS},
    }).drop(name)
