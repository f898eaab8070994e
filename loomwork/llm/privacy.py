"""Personal data replaced by keyed pseudonyms of the same format.

Numbers and dates are found by pattern and validated (checksums, ranges, the calendar). A value is read as an integer in the
domain of its format and sent through a Feistel network with walking back into the domain, which permutes the domain under
the key: equal values get equal pseudonyms in every document, different ones never collide, and whoever holds the key can
go back (``Permuter.inverse``). Separators, lengths, letter case and check digits stay valid.

| kind | valid if | permuted |
|---|---|---|
| card | 13 to 19 digits, Luhn | all digits but the check digit, which is computed anew |
| number | 13 to 19 digits, no Luhn | all digits |
| iban | two letters, mod 97 | the digits and letters behind the check digits, which are computed anew |
| ssn | not 000, 666 or 9xx, no zero group | the nine digits, within the valid ones |
| phone | 10 digits behind a country code, or in a bracketed format | the digits behind the country code |
| ipv4 | four numbers up to 255 | all 32 bits |
| date | a day of the calendar from 1900 to 2099, as y-m-d, d.m.y or m/d/y | the day, among all of these days |
| email | local part and host with a dot | letters and digits of the local part |
| secret | 32 to 64 hex digits behind a quoted ``token``, ``key`` or ``secret`` | the hex digits; in mixed case digits, small and capital letters each among themselves |

Defined cases: null stays null, texts without a match come back unchanged; matches never overlap, the first kind in the
pattern's order wins; two formats of the same date get the same new day, each in its own format.
"""

from __future__ import annotations

import datetime
import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.common import add_columns

KINDS = ("secret", "email", "ipv4", "date", "iban", "ssn", "phone", "card", "number")
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
PATTERN = re.compile(
    r"""(?P<secret>(?<=["'])[0-9a-fA-F]{32,64}(?=["']))"""
    r"|(?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    r"|(?P<ipv4>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?![\d/-]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\) ?\d{3}[ .-]\d{4})(?!\d))"
    r"|(?P<digits>(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d]|[.-]\d))"
)
DIGIT, LETTER, CAPITAL, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


class Permuter:
    """Keyed permutations of the integers below a size."""

    ROUNDS = 8

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _half(self, label: bytes, number: int, value: int, bits: int) -> int:
        data = label + b"|%d|%d|%d" % (number, bits, value)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big") & ((1 << bits) - 1)

    def _walk(self, value: int, size: int, label: str, back: bool) -> int:
        if size < 2:
            return value
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        mask, tag = (1 << bits) - 1, f"{label}|{size}".encode()
        while True:
            left, right = value >> bits, value & mask
            for number in reversed(range(self.ROUNDS)) if back else range(self.ROUNDS):
                if back:
                    left, right = right ^ self._half(tag, number, left, bits), left
                else:
                    left, right = right, left ^ self._half(tag, number, right, bits)
            value = left << bits | right
            if value < size:
                return value

    def forward(self, value: int, size: int, label: str) -> int:
        return self._walk(value, size, label, False)

    def inverse(self, value: int, size: int, label: str) -> int:
        return self._walk(value, size, label, True)


TEXT, MIXED_HEX, SMALL_HEX = (DIGIT, LETTER, CAPITAL), (DIGIT, HEX[10:], HEX[10:].upper()), (HEX,)


def permute_characters(text: str, permuter: Permuter, label: str, back: bool = False, classes: tuple[str, ...] = TEXT) -> str:
    """Permute the characters of ``text`` within their classes; everything else stays in place."""
    alphabets = [next((a for a in classes if c in a), None) for c in text]
    value, size = 0, 1
    for char, letters in zip(text, alphabets):
        if letters:
            value, size = value * len(letters) + letters.index(char), size * len(letters)
    shape = "".join("x" if a is None else str(len(a)) + "." for a in alphabets if a)
    value = permuter._walk(value, size, f"{label}|{shape}", back)
    out = []
    for char, letters in zip(reversed(text), reversed(alphabets)):
        if letters:
            value, place = divmod(value, len(letters))
            char = letters[place]
        out.append(char)
    return "".join(reversed(out))


def luhn_digit(digits: str) -> str:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def with_digits(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    stream = iter(digits)
    return "".join(next(stream) if c.isdigit() else c for c in text)


def permuted_digits(digits: str, permuter: Permuter, label: str, back: bool) -> str:
    size = 10 ** len(digits)
    return str(permuter._walk(int(digits), size, label, back)).zfill(len(digits))


def iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def valid_ssn(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


DATE_FORMATS = ((4, "-", "%Y-%m-%d"), (2, ".", "%d.%m.%Y"), (2, "/", "%m/%d/%Y"))


def pseudonym(kind: str, value: str, permuter: Permuter, back: bool = False) -> tuple[str, str] | None:
    """(kind, new value), or None if the value isn't valid for its format."""
    digits = "".join(c for c in value if c.isdigit())
    if kind == "digits":
        if luhn_digit(digits[:-1]) == digits[-1]:
            body = permuted_digits(digits[:-1], permuter, "card", back)
            return "card", with_digits(value, body + luhn_digit(body))
        size, moved = 10 ** len(digits), int(digits)
        while True:  # stay among the numbers that fail the checksum, so that the kinds don't mix
            moved = permuter._walk(moved, size, "number", back)
            new = str(moved).zfill(len(digits))
            if luhn_digit(new[:-1]) != new[-1]:
                return "number", with_digits(value, new)
    if kind == "date":
        pattern = next(p for width, mark, p in DATE_FORMATS if value[width] == mark)
        try:
            day = datetime.datetime.strptime(value, pattern).date().toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + permuter._walk(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", back))
        return kind, new.strftime(pattern)
    if kind == "ipv4":
        parts = [int(p) for p in value.split(".")]
        if max(parts) > 255:
            return None
        number = permuter._walk(int.from_bytes(bytes(parts), "big"), 1 << 32, "ipv4", back)
        return kind, ".".join(map(str, number.to_bytes(4, "big")))
    if kind == "ssn":
        if not valid_ssn(digits):
            return None
        new = digits
        while True:
            new = permuted_digits(new, permuter, "ssn", back)
            if valid_ssn(new):
                return kind, with_digits(value, new)
    if kind == "iban":
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        rest = permute_characters(plain[4:], permuter, "iban" + plain[:2], back)
        stream = iter(plain[:2] + iban_check(plain[:2], rest) + rest)
        return kind, "".join(c if c == " " else next(stream) for c in value)
    if kind == "phone":
        new = permuted_digits(digits[-10:], permuter, "phone" + digits[:-10], back)
        return kind, with_digits(value, digits[:-10] + new)
    if kind == "email":
        local, host = value.split("@")
        return kind, permute_characters(local, permuter, "email" + host.lower(), back) + "@" + host
    if value == value.lower():
        return kind, permute_characters(value, permuter, "secret", back, SMALL_HEX)
    if value == value.upper():
        return kind, permute_characters(value.lower(), permuter, "secret", back, SMALL_HEX).upper()
    return kind, permute_characters(value, permuter, "secret", back, MIXED_HEX)


def replace_all(text: str, permuter: Permuter, back: bool = False) -> tuple[str, dict[str, int]]:
    counts: dict[str, int] = {}

    def swap(match: re.Match) -> str:
        found = pseudonym(match.lastgroup, match.group(), permuter, back)
        if found is None:
            return match.group()
        counts[found[0]] = counts.get(found[0], 0) + 1
        return found[1]

    return PATTERN.sub(swap, text), counts


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a count column ``n_<kind>`` for each kind; ``back`` undoes it with the key."""
    schema = "text string, " + ", ".join(f"n_{kind} int" for kind in KINDS)

    def run(texts: list[str]) -> list[list]:
        permuter = Permuter(key)
        done = [replace_all(t, permuter, back) for t in texts]
        return [[t for t, _ in done], *[[c.get(kind, 0) for _, c in done] for kind in KINDS]]

    missing = docs.withColumn("_null", F.col("text").isNull())
    out = add_columns(missing, schema, run)
    return out.withColumn("text", F.when(~F.col("_null"), F.col("text"))).drop("_null")
