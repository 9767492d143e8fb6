"""Format-preserving pseudonyms for personal data.

Numbers and dates that validate as what they look like (payment cards by Luhn, IBANs by their check
digits, telephone and social security numbers and IPv4 addresses by their ranges, dates by the
calendar), e-mail addresses and secrets (access keys, passwords and tokens in hexadecimal) are put
through a keyed permutation of their own format: a Feistel network over the values of their free
characters, walked on until the outcome is valid again, with check digits made anew. So a pseudonym
is as long and as valid as the value, equal values get equal pseudonyms in all documents, however
they are punctuated, and only who has the key can go back. Addresses of a reserved block stay in it,
and public ones public. Dates stay within 1900 to 2099 or outside, and days and months of one digit
stay so; only a month that is written out may get a name of another length.

Defined cases: null texts stay null and count nothing; empty texts stay empty; very long texts and
secrets are read whole; of two values that overlap the one that begins first is taken, and of those the
first of the kinds in PATTERN; values that don't validate are left alone; repeated ids and rows are rows
like others; an empty table gives an empty result; other columns pass through, but for one named pii,
which is replaced.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import own_name

ROUNDS = 10
KINDS = ("email", "iban", "card", "phone", "ssn", "ipv4", "date", "secret")
FIRST_YEAR, LAST_YEAR = 1900, 2099
#: Reserved blocks of addresses, with the bits that all of a block share.
BLOCKS = {"0.0.0.0": 8, "10.0.0.0": 8, "100.64.0.0": 10, "127.0.0.0": 8, "169.254.0.0": 16, "172.16.0.0": 12, "192.168.0.0": 16, "224.0.0.0": 4, "240.0.0.0": 4}
#: English month names as written in dates.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_MONTH = "|".join(MONTHS)
_HEX, _LOWER, _UPPER, _DIGITS = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"

PATTERN = re.compile(
    rf"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,24}}(?![\w-]))
  | (?P<secret>(?<![A-Za-z0-9])AKIA[A-Z0-9]{{16}}(?![A-Za-z0-9])
      |(?i:password|passwd|token|secret|api[_-]?key)\s*[=:]\s*["']?[0-9A-Fa-f]{{12,}}(?![0-9A-Za-z]))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{{2}}\d{{2}}(?:\ ?[A-Z0-9]{{4}}){{2,7}}(?:\ ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))
  | (?P<date>(?<![\w.-])(?:\d{{4}}(?P<s1>[-/.])\d\d?(?P=s1)\d\d?|\d\d?(?P<s2>[-/.])\d\d?(?P=s2)\d{{4}})(?![\w-]|\.\d)
      |(?<!\w)(?:(?:{_MONTH})\ \d\d?,?\ \d{{4}}|\d\d?\ (?:{_MONTH})\ \d{{4}})(?!\w))
  | (?P<ssn>(?<![\w-])\d{{3}}-\d\d-\d{{4}}(?![\w-]))
  | (?P<ipv4>(?<![\w.])(?:\d{{1,3}}\.){{3}}\d{{1,3}}(?![\w]|\.\d))
  | (?P<phone>(?<![\w+])\+(?:\d{{1,3}}[ .-]?\(\d{{2,4}}\)[ .-]?\d{{3,4}}[ .-]?\d{{3,4}}|\d{{1,3}}(?P<s3>[ .-])\d{{2,4}}(?:(?P=s3)\d{{2,4}}){{1,3}}|\d{{8,15}})(?!\w|[.-]\d)
      |(?<![\w+(-])(?:\(\d{{3}}\)\ ?|\d{{3}}[-. ])\d{{3}}[-. ]\d{{4}}(?!\w|[.-]\d))
  | (?P<card>(?<![\w-])(?:\d{{13,19}}|\d{{4}}(?P<s4>[ -])\d{{4}}(?P=s4)\d{{4}}(?P=s4)\d{{4}}(?:(?P=s4)\d{{3}})?|3\d{{3}}(?P<s5>[ -])\d{{6}}(?P=s5)\d{{5}})(?![\w-]))
    """,
    re.VERBOSE,
)


def permute(value: int, radices: list[int], key: bytes, kind: str) -> int:
    """A keyed permutation of the numbers below the product of radices: an alternating Feistel network
    whose halves are the first and the last of the places."""
    half = len(radices) // 2
    left_size = right_size = 1
    for r in radices[:half]:
        left_size *= r
    for r in radices[half:]:
        right_size *= r
    left, right = divmod(value, right_size)
    label = f"{kind}:{left_size}:{right_size}:".encode()
    for i in range(ROUNDS):
        source = right if i % 2 == 0 else left
        f = int.from_bytes(hashlib.blake2b(label + b"%d:%d" % (i, source), key=key).digest(), "big")
        if i % 2 == 0:
            left = (left + f) % left_size
        else:
            right = (right + f) % right_size
    return left * right_size + right


def permute_text(text: str, key: bytes, kind: str, valid: Callable[[str], bool] = lambda _: True, hexadecimal: bool = False) -> str:
    """Permutes the letters and digits of text within their classes, until valid(outcome); the rest stays."""
    classes = (_HEX, _HEX.upper()) if hexadecimal else (_DIGITS, _LOWER, _UPPER)
    places = [(i, c) for i, x in enumerate(text) if (c := next((c for c in classes if x in c), None))]
    if not places:
        return text
    if len(places) == 1:  # a Feistel network needs two halves
        places_radices = [1, len(places[0][1])]
    else:
        places_radices = [len(c) for _, c in places]
    value = 0
    for i, c in places:
        value = value * len(c) + c.index(text[i])
    while True:
        value = permute(value, places_radices, key, kind)
        out, rest = list(text), value
        for i, c in reversed(places):
            rest, at = divmod(rest, len(c))
            out[i] = c[at]
        if valid("".join(out)):
            return "".join(out)


def luhn_digit(digits: str) -> str:
    """The check digit that follows these digits."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def refill(shape: str, characters: str) -> str:
    """Puts characters in the places of shape's letters and digits."""
    it = iter(characters)
    return "".join(next(it) if x.isalnum() else x for x in shape)


def _bare(text: str) -> str:
    return "".join(x for x in text if x.isalnum())


def card(text: str, key: bytes) -> str | None:
    digits = _bare(text)
    if luhn_digit(digits[:-1]) != digits[-1] or digits[0] == "0":
        return None
    body = permute_text(digits[:-1], key, "card", lambda x: x[0] != "0")
    return refill(text, body + luhn_digit(body))


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(text: str, key: bytes) -> str | None:
    bare = _bare(text)
    if not 15 <= len(bare) <= 34 or _mod97(bare[4:] + bare[:4]) != 1:
        return None
    body = permute_text(bare[4:], key, "iban")
    return refill(text, f"{bare[:2]}{98 - _mod97(body + bare[:2] + '00'):02d}{body}")


def ssn(text: str, key: bytes) -> str | None:
    def valid(x: str) -> bool:
        return x[:3] not in ("000", "666") and x[0] != "9" and x[3:5] != "00" and x[5:] != "0000"

    digits = _bare(text)
    return refill(text, permute_text(digits, key, "ssn", valid)) if valid(digits) else None


def phone(text: str, key: bytes) -> str | None:
    digits = _bare(text)
    if text[0] == "+":
        first = re.match(r"\+(\d+)", text)[1]
        code = first if len(first) <= 3 and len(first) < len(digits) else digits[:1] if digits[0] in "17" else digits[:2]
        if not 8 <= len(digits) <= 15:
            return None
    else:
        code = ""
    own = digits[len(code) :]
    american = code in ("", "1") and len(own) == 10

    def assigned(x: str) -> bool:
        return not american or (x[0] in "23456789" and x[3] in "23456789")

    if not assigned(own) and not text.startswith(("+", "(")):
        return None  # nothing but three groups of digits
    was = assigned(own)  # numbers that can be assigned stay so, and others others
    return refill(text, code + permute_text(own, key, "phone:" + (code or "1"), lambda x: assigned(x) == was))


def ipv4(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if any(p > 255 for p in parts) or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None

    value = int.from_bytes(bytes(parts), "big")
    block = block_of(value)
    if block is not None:
        bits = 32 - block[1]
        return _address(block[0] | permute(value & ((1 << bits) - 1), [2] * bits, key, f"ipv4:{block[0]}"))
    value = permute(value, [256] * 4, key, "ipv4")
    while block_of(value) is not None:
        value = permute(value, [256] * 4, key, "ipv4")
    return _address(value)


def _address(n: int) -> str:
    return ".".join(map(str, n.to_bytes(4, "big")))


_BLOCKS = [(int.from_bytes(bytes(map(int, a.split("."))), "big"), n) for a, n in BLOCKS.items()]


def block_of(address: int) -> tuple[int, int] | None:
    """First address and shared bits of the reserved block of an address; None if it is public."""
    return next(((a, n) for a, n in _BLOCKS if address >> (32 - n) == a >> (32 - n)), None)


def a_date(text: str, key: bytes) -> str | None:
    month = next((m for m in MONTHS if m in text), None)
    numbers = re.findall(r"\d+", text)
    if month:
        day, year = numbers
        y, m, d = int(year), MONTHS.index(month) + 1, int(day)
    elif len(numbers[0]) == 4:
        y, m, d = map(int, numbers)
    else:
        d, m, y = map(int, numbers)
    swapped = not month and len(numbers[0]) != 4 and m > 12 >= d  # month first
    if swapped:
        d, m = m, d
    try:
        was = date(y, m, d)
    except ValueError:
        return None
    kind = lambda x: (FIRST_YEAR <= x.year <= LAST_YEAR, x.month < 10, x.day < 10)
    new = was
    while True:  # through all days of the calendar, to the next of the same kind
        new = _next_day(new, FIRST_YEAR <= y <= LAST_YEAR, key)
        if kind(new) == kind(was):
            break
    if month:
        return re.sub(r"[A-Z][a-z]+|\d+", lambda x: MONTHS[new.month - 1] if x[0].isalpha() else f"{new.year:04d}" if len(x[0]) == 4 else f"{new.day:0{len(x[0])}d}", text)
    order = [new.year, new.month, new.day] if len(numbers[0]) == 4 else [new.month, new.day, new.year] if swapped else [new.day, new.month, new.year]
    it = iter(order)
    return re.sub(r"\d+", lambda x: f"{next(it):0{len(x[0])}d}", text)


def _next_day(day: date, modern: bool, key: bytes) -> date:
    """A permutation of the days of the years of FIRST_YEAR to LAST_YEAR, or of all days."""
    first, last = (date(FIRST_YEAR, 1, 1), date(LAST_YEAR, 12, 31)) if modern else (date.min, date.max)
    days = (last - first).days + 1
    side = math.isqrt(days - 1) + 1
    value = permute((day - first).days, [side, side], key, "date" if modern else "day")
    while value >= days:
        value = permute(value, [side, side], key, "date" if modern else "day")
    return first + timedelta(value)


def email(text: str, key: bytes) -> str | None:
    local, _, domain = text.rpartition("@")
    name, _, suffix = domain.rpartition(".")
    return f"{permute_text(local, key, 'local')}@{permute_text(name.lower(), key, 'domain')}.{suffix}"


def secret(text: str, key: bytes) -> str | None:
    if text.startswith("AKIA"):
        return "AKIA" + permute_text(text[4:], key, "secret")
    at = re.search(r"[=:]\s*[\"']?", text).end()
    return text[:at] + permute_text(text[at:], key, "secret", hexadecimal=True)


MAKERS = {"email": email, "iban": iban, "card": card, "phone": phone, "ssn": ssn, "ipv4": ipv4, "date": a_date, "secret": secret}
_HINT = re.compile("[0-9@]|AKIA|(?i:passw|token|secret|api.?key)")


def pseudonymise(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many of each kind."""
    counts: dict[str, int] = {}
    if not _HINT.search(text):
        return text, counts

    def put(m: re.Match) -> str:
        kind = next(k for k in KINDS if m[k] is not None)
        new = MAKERS[kind](m[0], key)
        if new is None:
            return m[0]
        counts[kind] = counts.get(kind, 0) + 1
        return new

    return PATTERN.sub(put, text), counts


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """docs with pseudonyms in text, and pii: a struct of the counts of each kind."""
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")

    @F.arrow_udf("struct<text: string, " + ", ".join(f"{k}: int" for k in KINDS) + ">")
    def put(texts: pa.Array) -> pa.Array:
        new, counts = [], {k: [] for k in KINDS}
        for t in texts.to_pylist():
            out, found = (None, {}) if t is None else pseudonymise(t, key)
            new.append(out)
            for k in KINDS:
                counts[k].append(found.get(k, 0))
        return pa.StructArray.from_arrays([pa.array(new, pa.string()), *(pa.array(counts[k], pa.int32()) for k in KINDS)], names=["text", *KINDS])

    name = own_name(docs, "pseudonyms")
    done = docs.withColumn(name, put(F.col("text").cast("string")))
    return done.select(*(F.col(f"{name}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "pii"), F.struct(*(F.col(f"{name}.{k}").alias(k) for k in KINDS)).alias("pii"))
