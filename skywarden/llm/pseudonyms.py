"""Personal data under format-preserving pseudonyms.

Numbers and dates that pass their check (Luhn, IBAN remainder, social security ranges, calendar, octets), telephone
numbers, e-mail names and quoted secrets are replaced by others of the same format. Each format counts its valid values
from 0; a keyed Feistel network permutes that range (walking on while it leaves it), and the result is written in the
layout of the original. So equal values get equal pseudonyms in all documents, whatever their separators, different
values different ones, and whoever has the key can go back (``back=True``). Dates keep to their half, days up to 12 or
after, so that one written month first or day first is read back the way it was written. Country codes stay.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from calendar import monthrange
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b
from itertools import accumulate
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from skywarden.llm.workers import tidy

ROUNDS = 10


class Feistel:
    """Keyed permutation of ``range(size)`` for any size; ``tweak`` separates the formats."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.left = isqrt(max(0, size - 1)) + 1
        self.right = -(-size // self.left)
        self.key = blake2b(tweak.encode(), key=key[:64], digest_size=32).digest()

    def _f(self, step: int, value: int) -> int:
        data = step.to_bytes(1, "big") + value.to_bytes((value.bit_length() + 7) // 8, "big")
        return int.from_bytes(blake2b(data, key=self.key, digest_size=48).digest(), "big")

    def _once(self, x: int, forward: bool) -> int:
        l, r = divmod(x, self.right)
        sign = 1 if forward else -1
        for step in range(ROUNDS) if forward else range(ROUNDS - 1, -1, -1):
            if step % 2:
                r = (r + sign * self._f(step, l)) % self.right
            else:
                l = (l + sign * self._f(step, r)) % self.left
        return l * self.right + r

    def __call__(self, x: int, forward: bool = True) -> int:
        if self.size < 2:
            return x
        x = self._once(x, forward)
        while x >= self.size:
            x = self._once(x, forward)
        return x


Permute = Callable[[str, int, int], int]  # format, size of its range, value

_DIGIT = re.compile(r"\d")


def _refill(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced in turn."""
    new = iter(digits)
    return _DIGIT.sub(lambda _: next(new), layout)


def luhn_digit(digits: str) -> str:
    """Check digit for ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    new = str(permute(f"card{n}", 10 ** n, int(digits[:-1]))).zfill(n)
    return _refill(text, new + luhn_digit(new))


def _iban(text: str, permute: Permute) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34:
        return None

    def number(s: str) -> int:
        return int("".join(str(int(c, 36)) for c in s))

    if number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = plain[4:]
    digits = "".join(c for c in body if c.isdigit())
    if not digits:
        return None
    shape = "".join("9" if c.isdigit() else c for c in body)
    new = _refill(body, str(permute(f"iban{plain[:2]}{shape}", 10 ** len(digits), int(digits))).zfill(len(digits)))
    check = str(98 - number(new + plain[:2] + "00") % 97).zfill(2)
    letters = iter(plain[:2] + check + new)
    return "".join(c if c == " " else next(letters) for c in text)


def _social(text: str, permute: Permute) -> str | None:
    area, group, serial = (int(x) for x in re.split(r"\D", text))
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    place = area - 1 - (area > 666)
    place = permute("social", 898 * 99 * 9999, (place * 99 + group - 1) * 9999 + serial - 1)
    place, serial = divmod(place, 9999)
    place, group = divmod(place, 99)
    return _refill(text, f"{place + 1 + (place >= 665):03}{group + 1:02}{serial + 1:04}")


_YEARS = range(1900, 2100)
# Days after the 12th that months before each month have, in all.
_LATE = [0, *accumulate(monthrange(year, month)[1] - 12 for year in _YEARS for month in range(1, 13))]


def _date(text: str, permute: Permute) -> str | None:
    parts = [int(x) for x in re.split(r"\D", text)]
    if text[4] in "-/.":
        orders = ((0, 1, 2),)
    else:
        orders = ((2, 0, 1), (2, 1, 0)) if text[2] == "/" else ((2, 1, 0),)
    for order in orders:
        year, month, day = (parts[i] for i in order)
        if not 1 <= month <= 12 or year < 1 or not 1 <= day <= monthrange(year, month)[1]:
            continue
        if year not in _YEARS:
            return None
        at = (year - _YEARS[0]) * 12 + month - 1
        if day <= 12:
            at, day = divmod(permute("date", len(_YEARS) * 144, at * 12 + day - 1), 12)
            day += 1
        else:
            place = permute("late date", _LATE[-1], _LATE[at] + day - 13)
            at = bisect_right(_LATE, place) - 1
            day = place - _LATE[at] + 13
        year, month = divmod(at, 12)
        digits = {order[0]: f"{year + _YEARS[0]:04}", order[1]: f"{month + 1:02}", order[2]: f"{day:02}"}
        return _refill(text, digits[0] + digits[1] + digits[2])
    return None


def _address(text: str, permute: Permute) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    if text != ".".join(map(str, parts)):
        return None
    # Octets keep their number of digits, and so the text its length.
    ranges = [((0, 10), (10, 100), (100, 256))[len(str(p)) - 1] for p in parts]
    size, place = 1, 0
    for p, (low, high) in zip(parts, ranges, strict=True):
        size, place = size * (high - low), place * (high - low) + p - low
    place = permute("address" + "".join(str(len(str(p))) for p in parts), size, place)
    out = []
    for low, high in reversed(ranges):
        place, octet = divmod(place, high - low)
        out.append(str(low + octet))
    return ".".join(reversed(out))


# Country codes of one and of two digits; all others have three.
_ONE_DIGIT = {"1", "7"}
_TWO_DIGITS = {"20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
               "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84",
               "86", "90", "91", "92", "93", "94", "95", "98"}


def _phone(text: str, permute: Permute) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 10 <= len(digits) <= 15 or not re.search(r"[^\d]", text):
        return None
    code = ""
    if text.startswith("+"):
        code = next((digits[:n] for n, known in ((1, _ONE_DIGIT), (2, _TWO_DIGITS)) if digits[:n] in known), digits[:3])
    rest = digits[len(code):]
    return _refill(text, code + str(permute(f"phone{len(rest)}", 10 ** len(rest), int(rest))).zfill(len(rest)))


# Longer secrets are replaced in pieces: a half of a Feistel round must not have more bits than its function (384).
_PIECE = 64


@lru_cache(4096)
def _alphabet(c: str) -> str:
    """The letters that one may become: digits, a-z, A-Z, or those of its kind in its stretch of 256 code points."""
    for letters in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        if c in letters:
            return letters
    if c.isascii() or not c.isalpha():
        return ""
    start = ord(c) >> 8 << 8
    return "".join(x for x in map(chr, range(max(start, 128), start + 256))
                   if x.isalpha() and (x.islower(), x.isupper()) == (c.islower(), c.isupper()))


def _letters(kind: str) -> Callable[[str, Permute], str | None]:
    """Replace letters by letters, digits by digits, hexadecimal digits by such; the rest of the layout stays.

    A secret of other letters that comes out as hexadecimal by chance is the one thing that cannot be read back.
    """
    def new(text: str, permute: Permute) -> str | None:
        if len(text) > _PIECE:
            # Even pieces, each under a permutation of its own range.
            size = -(-len(text) // -(-len(text) // _PIECE))
            return "".join(new(text[at:at + size], permute) for at in range(0, len(text), size))
        hexed = next((h for h in ("0123456789abcdef", "0123456789ABCDEF") if set(text) <= set(h)), None) if (
            kind == "secret") else None
        own = [hexed or _alphabet(c) for c in text]
        size, place = 1, 0
        for c, letters in zip(text, own, strict=True):
            if letters:
                size, place = size * len(letters), place * len(letters) + letters.index(c)
        shape = "".join("x" if hexed else letters[0] if letters else c for c, letters in zip(text, own, strict=True))
        place = permute(kind + shape, size, place)
        out = []
        for c, letters in zip(reversed(text), reversed(own), strict=True):
            if letters:
                place, i = divmod(place, len(letters))
                c = letters[i]
            out.append(c)
        return "".join(reversed(out))

    return new


# Tried in this order; what one has replaced is not looked at by the next. Group 1, if there, is the part to replace.
KINDS: tuple[tuple[str, re.Pattern, Callable[[str, Permute], str | None]], ...] = (
    ("secret", re.compile(r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b\s{0,3}[=:]\s{0,3}"
                          r"[\"']?([A-Za-z0-9_\-]{8,})"), _letters("secret")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), _iban),
    ("card", re.compile(r"(?<![\d.,-])\d(?:[ -]?\d){12,18}(?![\d])"), _card),
    ("date", re.compile(r"(?<![\d./-])(?:\d{4}([-/.])\d\d\1\d\d|\d\d([-/.])\d\d\2\d{4})(?![\d/-]|\.\d)"), _date),
    ("social", re.compile(r"(?<![\d-])\d{3}([- ])\d\d\1\d{4}(?![\d-])"), _social),
    ("address", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)"), _address),
    ("phone", re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,5}"
                         r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}([.-])\d{3}\1\d{4})(?![\w-])"), _phone),
)
# Card numbers as they are grouped: what may begin amid other groups of digits.
_CARD_LAYOUT = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{4,5}")
_CARD_AGAIN = re.compile(r"\d(?:[ -]?\d){12,18}(?!\d)")
_IBAN_LENGTH = {code: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}
_HOST = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9-]{1,63}){1,8}")
_NAME = re.compile(r"[\w.%+\-]{1,64}\Z")


class Pseudonyms:
    """Finds and replaces values in texts, and remembers some. ``back`` replaces pseudonyms by what they stand for."""

    def __init__(self, key: bytes, back: bool = False):
        self.back = back
        self.network = lru_cache(4096)(lambda tweak, size: Feistel(key, tweak, size))
        self.known: dict[tuple[str, str], str | None] = {}

    def value(self, kind: str, make: Callable, text: str) -> str | None:
        if (kind, text) not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[kind, text] = make(text, lambda tweak, size, x: self.network(tweak, size)(x, not self.back))
        return self.known[kind, text]

    def grouped(self, kind: str, pattern: re.Pattern, make: Callable, text: str, spans: list[tuple[int, int, str]]) -> None:
        """Add the cards or IBANs of a text, which may have other groups before and behind them, to ``spans``.

        An IBAN of its country's length comes first, then the longest span, then those that end at a separator. Where none
        passes its check, the next group may begin one; a card only in a usual layout, as any row of groups has spans that
        pass by chance.
        """
        found, amid = pattern.search(text), False
        while found:
            start, stop = found.span()
            breaks = [i for i in range(start, stop) if text[i] in " -"]
            ends = [stop, *reversed(breaks)]
            if kind == "iban":
                usual = _IBAN_LENGTH.get(text[start:start + 2])
                ends.sort(key=lambda end: len(text[start:end].replace(" ", "")) != usual)
            elif amid:
                ends = [end for end in ends if _CARD_LAYOUT.fullmatch(text, start, end)]
            for end in ends:
                if any(start < e and s < end for s, e, _ in spans):
                    continue
                new = self.value(kind, make, text[start:end])
                if new is not None:
                    spans.append((start, end, new))
                    found, amid = pattern.search(text, end), False
                    break
            else:
                at = breaks[0] + 1 if breaks else stop
                # Behind a hyphen only amid a span.
                again = _CARD_AGAIN.match(text, at) if kind == "card" and breaks else None
                found, amid = again or pattern.search(text, at), bool(again)

    def text(self, text: str) -> tuple[str, int]:
        """The text under pseudonyms, as long as before, and how many values were replaced."""
        spans: list[tuple[int, int, str]] = []
        at = text.find("@")
        while at >= 0:
            name = _NAME.search(text, max(0, at - 64), at)
            if name and _HOST.match(text, at + 1) and any(c.isalnum() for c in name.group()):
                new = self.value("mail", _letters("mail"), name.group())
                spans.append((name.start(), at, new))
            at = text.find("@", at + 1)
        digit, named = _DIGIT.search(text), "=" in text or ":" in text
        if digit or named:
            for kind, pattern, make in KINDS:
                if not (named if kind == "secret" else digit):
                    continue
                if kind in ("iban", "card"):
                    self.grouped(kind, pattern, make, text, spans)
                    continue
                for found in pattern.finditer(text):
                    start, end = found.span(1) if kind == "secret" else found.span()
                    if any(start < e and s < end for s, e, _ in spans):
                        continue
                    new = self.value(kind, make, text[start:end])
                    if new is not None:
                        spans.append((start, end, new))
        if not spans:
            return text, 0
        out, last = [], 0
        for start, end, new in sorted(spans):
            out += [text[last:start], new]
            last = end
        return "".join([*out, text[last:]]), len(spans)


def pseudonymous(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_replaced`` (0 for null and empty texts).

    All columns stay; a column called ``n_replaced`` is replaced. Texts keep their length in code points, and are looked
    at whole, however long. Repeated rows give repeated results, an empty table an empty one.
    """
    if not key:
        raise ValueError("pseudonyms need a key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Pseudonyms(key)
        for batch in batches:
            texts, counts = [], []
            for value in batch.column("text"):
                text = value.as_py()
                new, n = made.text(text) if text else (text, 0)
                texts.append(new)
                counts.append(n)
            columns = [pa.array(texts, pa.string()) if f == "text" else batch.column(f) for f in names]
            yield pa.record_batch([*columns, pa.array(counts, pa.int64())], [*names, "n_replaced"])

    names = [c for c in docs.columns if c != "n_replaced"]
    rows = docs.select(*names)
    schema = StructType([*(StructField("text", StringType()) if f.name == "text" else f for f in rows.schema.fields),
                         StructField("n_replaced", LongType())])
    return rows.mapInArrow(tidy(run), schema)
