"""Personal data replaced by format-preserving pseudonyms from a keyed Feistel network.

A value is found by its form and validated (Luhn, IBAN and calendar checks, octet ranges, number ranges of its kind); what fails
is left alone. Its variable characters are one number in a mixed radix, that number is permuted within its range by a Feistel
network with cycle walking, and the result is written back in the same form, with check digits made anew. The permutation
depends on key and kind only, so equal values, however they are spaced, have equal pseudonyms in all documents, and a text keeps
its length. Nothing is looked up or exchanged: each row is done by itself, and the same key gives the same result on a rerun.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.blocks import parts

KEY = b"replace by a secret key"  # for tests and examples; production passes its own
ROUNDS = 8
_OUT = "doc_id long, n_found long, text string, found array<struct<kind: string, start: int, end: int>>"


class Feistel:
    """A keyed permutation of range(size)."""

    def __init__(self, key: bytes, kind: str):
        self.key, self.kind = blake2b(key).digest(), kind.encode()

    def _once(self, value: int, half: int) -> int:
        mask = (1 << half) - 1
        left, right = value >> half, value & mask
        size = (half + 7) // 8
        for r in range(ROUNDS):
            h = blake2b(right.to_bytes(size, "big") + bytes([r]) + half.to_bytes(2, "big"), key=self.key, person=self.kind[:16], digest_size=min(64, size + 8))
            left, right = right, left ^ (int.from_bytes(h.digest(), "big") & mask)
        return right << half | left

    def permute(self, value: int, size: int, good: Callable[[int], bool] = lambda v: True) -> int:
        """The next value on the cycle that is in range and good; a bijection of the good values, of which `value` is one."""
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        while True:
            value = self._once(value, half)
            if value < size and good(value):
                return value


def luhn(digits: str) -> int:
    """The sum that a valid number has divisible by 10."""
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (c > "4") for i, c in enumerate(reversed(digits)))


def _refill(text: str, chars: str, takes: Callable[[str], bool]) -> str:
    """The text with the characters that `takes` holds for replaced one by one."""
    new = iter(chars)
    return "".join(next(new) if takes(c) else c for c in text)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_digit(c: str) -> bool:
    return "0" <= c <= "9"


def _card(f: Feistel, text: str) -> str | None:
    d = _digits(text)
    if luhn(d) % 10 or len(set(d)) == 1:
        return None
    n = len(d) - 2  # the first digit stays, the last is the check digit

    def whole(v: int) -> str:
        body = f"{d[0]}{v:0{n}d}"
        return body + str(-luhn(body + "0") % 10)

    return _refill(text, whole(f.permute(int(d[1:-1]), 10**n, lambda v: len(set(whole(v))) > 1)), _is_digit)


def _phone(f: Feistel, text: str) -> str | None:
    d = _digits(text)
    lead = len(re.match(r"\+\d*|", text)[0]) - 1 if text.startswith("+") else 0
    if text.startswith("+") and lead > 3:
        lead = 1
    own = len(d) - lead
    if not 7 <= own <= 13 or len(d) > 15:
        return None
    return _refill(text, d[:lead] + f"{f.permute(int(d[lead:]), 10**own):0{own}d}", _is_digit)


def _ssn(f: Feistel, text: str) -> str | None:
    def good(v: int) -> bool:
        s = f"{v:09d}"
        return s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"

    v = int(_digits(text))
    return _refill(text, f"{f.permute(v, 10**9, good):09d}", _is_digit) if good(v) else None


_OCTETS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}  # first octet and number of octets with so many digits


def _ip(f: Feistel, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    ranges, value, size = [_OCTETS[len(p)] for p in parts], 0, 1
    for p, (low, n) in zip(parts, ranges):
        value, size = value * n + int(p) - low, size * n
    value, out = f.permute(value, size), []
    for low, n in reversed(ranges):
        value, r = divmod(value, n)
        out.append(str(low + r))
    return ".".join(reversed(out))


def _mixed(f: Feistel, chars: str) -> str:
    """Letters permuted among letters, digits among digits, as one number; case and all else stay."""
    value, size, radix = 0, 1, []
    for c in chars:
        base, low = (10, "0") if _is_digit(c) else (26, "a")
        value, size = value * base + ord(c.lower()) - ord(low), size * base
        radix.append((base, low, c.isupper()))
    value, out = f.permute(value, size), []
    for base, low, upper in reversed(radix):
        value, r = divmod(value, base)
        c = chr(ord(low) + r)
        out.append(c.upper() if upper else c)
    return "".join(reversed(out))


def _email(f: Feistel, text: str) -> str | None:
    body, _, top = text.rpartition(".")
    takes = lambda c: c.isascii() and c.isalnum()
    chars = "".join(c for c in body if takes(c))
    return _refill(body, _mixed(f, chars), takes) + "." + top if chars else None


def _iban(f: Feistel, text: str) -> str | None:
    s = text.replace(" ", "")
    number = lambda x: int("".join(str(int(c, 36)) for c in x))
    if not 15 <= len(s) <= 34 or number(s[4:] + s[:4]) % 97 != 1:
        return None
    body = _mixed(f, s[4:])
    check = 98 - number(body + s[:2] + "00") % 97
    return _refill(text, f"{s[:2]}{check:02d}{body}", lambda c: c != " ")


_FIRST, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


def _date(order: str):
    def replace(f: Feistel, text: str) -> str | None:
        d = _digits(text)
        y, m, day = (d[:4], d[4:6], d[6:]) if order == "ymd" else (d[4:], d[2:4], d[:2])
        try:
            n = date(int(y), int(m), int(day)).toordinal()
        except ValueError:
            return None
        if not _FIRST <= n <= _LAST:
            return None
        new = date.fromordinal(_FIRST + f.permute(n - _FIRST, _LAST - _FIRST + 1))
        return _refill(text, f"{new:%Y%m%d}" if order == "ymd" else f"{new:%d%m%Y}", _is_digit)

    return replace


# kind, what a text must have for it, form, replacement; where two overlap, the first in this list goes first
KINDS = (
    ("email", "@", re.compile(r"(?<![\w.+-])[\w.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), _email),
    ("iban", "", re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"), _iban),
    ("card", "", re.compile(r"(?<!\w)(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?!\w)"), _card),
    ("ip", ".", re.compile(r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9])"), _ip),
    ("date", "", re.compile(r"(?<![\w./-])[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}(?![\w]|[-/.][0-9])"), _date("ymd")),
    ("date", "", re.compile(r"(?<![\w./-])[0-9]{2}([-/.])[0-9]{2}\1[0-9]{4}(?![\w]|[-/.][0-9])"), _date("dmy")),
    ("ssn", "-", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), _ssn),
    ("phone", "+", re.compile(r"(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,4}(?!\w)"), _phone),
    ("phone", "", re.compile(r"(?<![\w.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[.-][0-9]{4}(?![\w-])"), _phone),
)
_ANY = re.compile(r"[0-9@]")


@lru_cache(8)
def _networks(key: bytes) -> dict[str, Feistel]:
    return {kind: Feistel(key, kind) for kind, *_ in KINDS}


def pseudonymise(text: str, key: bytes = KEY) -> tuple[str, list[dict]]:
    """The text with its personal data replaced, and where that stood: (kind, start, end), end exclusive, in order."""
    if not _ANY.search(text):
        return text, []
    f, found = _networks(key), []
    for kind, sign, form, replace in KINDS:
        if sign in text:
            for m in form.finditer(text):
                if all(m.end() <= s or e <= m.start() for s, e, *_ in found) and (new := replace(f[kind], m[0])) is not None:
                    found.append((m.start(), m.end(), kind, new))
    found.sort()
    out, at = [], 0
    for s, e, _, new in found:
        out += [text[at:s], new]
        at = e
    return "".join([*out, text[at:]]), [{"kind": k, "start": s, "end": e} for s, e, k, _ in found]


def find_pii(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, n_found, the text with pseudonyms, and what was found where, for every document row.

    A null text stays null and has nothing; equal rows get equal results. Columns but doc_id and text are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_found", pa.int64()), ("text", pa.string()), ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))])

    def run(batches):
        for batch in batches:
            rows = [pseudonymise(t or "", key) for t in batch["text"].to_pylist()]
            texts = [None if t is None else r[0] for t, r in zip(batch["text"].to_pylist(), rows)]
            found = [r[1] for r in rows]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([len(x) for x in found], pa.int64()), pa.array(texts, pa.string()), pa.array(found, schema.field("found").type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _OUT)


def replace_pii(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """The documents with pseudonyms in their text and all other columns as they were."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in parts(batch):
                texts = [None if t is None else pseudonymise(t, key)[0] for t in part["text"].to_pylist()]
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, docs.schema)
