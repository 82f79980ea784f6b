"""Format-preserving pseudonyms for personal numbers and dates.

Every value is checked (Luhn digit, octets, mod-97, calendar ...), and a value
that passes is moved by a keyed Feistel permutation of the set of values of its
own format.  A permutation maps equal values to equal values and different ones
to different ones, so records stay linked across documents while the originals
cannot be read off without the key.  Values that fail their check stay as they
are.  The work is one narrow pass over the texts.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T

from firmloom.llm.common import table
from firmloom.session import map_frames

ROUNDS = 10
#: For tests and demonstrations; a real run passes its own secret.
DEMO_KEY = b"replace this key"
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)
LETTERS = "abcdefghijklmnopqrstuvwxyz"
KINDS = ("email", "ipv4", "card", "iban", "ssn", "phone", "date")


class Feistel:
    """Keyed permutations of 0 .. size-1."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, label: bytes, turn: int, value: int) -> int:
        text = label + turn.to_bytes(1, "big") + value.to_bytes((value.bit_length() + 7) // 8 or 1, "big")
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "big")

    def permute(self, label: str, value: int, size: int, back: bool = False) -> int:
        """Image of ``value`` (or its origin, ``back``) under the permutation that belongs to label and size.

        The value is split in two mixed-radix halves of a grid that is a little
        larger than the set; images outside the set are moved on until one is
        inside, which keeps it a permutation.
        """
        if size < 2:
            return value
        a = int(size**0.5) + 1
        b = -(-size // a)
        tag = f"{label}/{size}".encode()
        while True:
            left, right = divmod(value, b)
            for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if turn % 2:
                    right = (right + sign * self._round(tag, turn, left)) % b
                else:
                    left = (left + sign * self._round(tag, turn, right)) % a
            value = left * b + right
            if value < size:
                return value


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def iban_check(country: str, body: str) -> str:
    digits = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(digits) % 97:02d}"


def _refill(shape: str, chars: str, of: Callable[[str], bool] = str.isalnum) -> str:
    """``shape`` with its characters that fit ``of`` replaced, in order, by ``chars``."""
    it = iter(chars)
    return "".join(next(it) if of(c) else c for c in shape)


class Pseudonymizer:
    """Finds validated values in a text and replaces them."""

    PATTERN = re.compile(
        r"(?P<email>[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){1,8})"
        r"|(?<![\w.])(?P<ipv4>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)"
        r"|(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"
        r"|(?<![\w.\-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w\-])"
        r"|(?<![\w.\-/])(?P<date>\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w/\-])"
        r"|(?<![\w.\-])(?P<card>\d(?:[ \-]?\d){12,18})(?!\w|[.\-]\d)"
        r"|(?<![\w.\-])(?P<phone>(?:\+\d{1,3}[ .\-]?)?(?:\(\d{3}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}|\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5})(?!\w|[.\-]\d)",
        re.ASCII,
    )
    #: A text without an @ sign and without two digits side by side or around a dot has nothing to find.
    HINT = re.compile(r"@|\d[\d.\-/ ()]")

    def __init__(self, key: bytes = DEMO_KEY):
        self.feistel = Feistel(key)
        self.known: dict[tuple[str, str], str | None] = {}

    def _digits(self, kind: str, digits: str) -> str:
        return str(self.feistel.permute(f"{kind}{len(digits)}", int(digits), 10 ** len(digits))).zfill(len(digits))

    def email(self, value: str) -> str | None:
        """Letters and digits of the name and of the first host label move; case, signs and the rest of the host stay."""
        name, _, host = value.partition("@")
        label, dot, rest = host.partition(".")
        out = []
        for part, kind in ((name, "email"), (label, "host")):
            plain = [c for c in part.lower() if c.isalnum()]
            shape = "".join("9" if c.isdigit() else "a" for c in plain)
            size, at = 1, 0
            for c in plain:
                base = 10 if c.isdigit() else 26
                at, size = at * base + (int(c) if c.isdigit() else LETTERS.index(c)), size * base
            at = self.feistel.permute(f"{kind}{shape}", at, size)
            moved = []
            for s in reversed(shape):
                at, d = divmod(at, 10 if s == "9" else 26)
                moved.append(str(d) if s == "9" else LETTERS[d])
            moved = [m.upper() if o.isupper() else m for m, o in zip(reversed(moved), (c for c in part if c.isalnum()), strict=True)]
            out.append(_refill(part, "".join(moved)))
        return f"{out[0]}@{out[1]}{dot}{rest}"

    def ipv4(self, value: str) -> str | None:
        """All four octets move within 0-255."""
        octets = [int(x) for x in value.split(".")]
        if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
            return None
        at = int.from_bytes(bytes(octets), "big")
        return ".".join(map(str, self.feistel.permute("ipv4", at, 2**32).to_bytes(4, "big")))

    def card(self, value: str) -> str | None:
        """13 to 19 digits with a right Luhn digit; the body moves, its check digit is set anew."""
        digits = "".join(c for c in value if c.isdigit())
        if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
            return None
        body = self._digits("card", digits[:-1])
        return _refill(value, body + luhn_digit(body))

    def iban(self, value: str) -> str | None:
        """Right mod-97 digits; digits and letters of the account move in their places, the check is set anew."""
        plain = value.replace(" ", "")
        country, body = plain[:2], plain[4:]
        if not 15 <= len(plain) <= 34 or iban_check(country, body) != plain[2:4]:
            return None
        digits = "".join(c for c in body if c.isdigit())
        letters = "".join(c for c in body if not c.isdigit())
        if digits:
            body = _refill(body, self._digits(f"iban{country}", digits), str.isdigit)
        if letters:
            at = 0
            for c in letters:
                at = at * 26 + ord(c) - 65
            at = self.feistel.permute(f"iban{country}a{len(letters)}", at, 26 ** len(letters))
            moved = ""
            for _ in letters:
                at, d = divmod(at, 26)
                moved = chr(65 + d) + moved
            body = _refill(body, moved, str.isupper)
        return _refill(value, country + iban_check(country, body) + body)

    def ssn(self, value: str) -> str | None:
        """Area 001-899 without 666, group and serial not zero: a permutation of exactly those numbers."""
        area, group, serial = map(int, value.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        index = area - 1 - (area > 666)
        at = self.feistel.permute("ssn", (index * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999)
        at, serial = divmod(at, 9999)
        index, group = divmod(at, 99)
        return f"{index + 1 + (index >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def phone(self, value: str) -> str | None:
        """Seven to fifteen digits; the country code (after +, up to the first sign) stays, the others move."""
        head = re.match(r"\+\d{1,3}(?=[ .\-(])", value, re.ASCII)
        kept = head[0] if head else ""
        digits = "".join(c for c in value[len(kept) :] if c.isdigit())
        if not 7 <= len(digits) + len(kept) - bool(kept) <= 15:
            return None
        return kept + _refill(value[len(kept) :], self._digits("phone", digits), str.isdigit)

    def date(self, value: str) -> str | None:
        """A calendar day of 1900-2099 becomes another; day.month.year and year-month-day keep their order.

        Slash dates are read day first, or month first where that is no day;
        such a date moves among those that only read month first.
        """
        sign = next(c for c in value if not c.isdigit())
        a, b, c = map(int, value.split(sign))
        month_first = sign == "/" and a <= 12 < b
        try:
            day = dt.date(a, b, c) if sign == "-" else dt.date(c, a, b) if month_first else dt.date(c, b, a)
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        size = (LAST_DAY - FIRST_DAY).days + 1
        while True:
            day = FIRST_DAY + dt.timedelta(self.feistel.permute("date", (day - FIRST_DAY).days, size))
            if day.day > 12 or not month_first:
                break
        if sign == "-":
            return f"{day.year:04d}-{day.month:02d}-{day.day:02d}"
        first, second = (day.month, day.day) if month_first else (day.day, day.month)
        return f"{first:02d}{sign}{second:02d}{sign}{day.year:04d}"

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and kind, start and end (code points of the new text) of each."""
        if not self.HINT.search(text):
            return text, []
        out, found, at, length = [], [], 0, 0
        for m in self.PATTERN.finditer(text):
            kind, value = m.lastgroup, m[0]
            if (kind, value) not in self.known:
                if len(self.known) > 200_000:
                    self.known = {}
                self.known[kind, value] = getattr(self, kind)(value)
            new = self.known[kind, value]
            if new is None:
                continue
            out += [text[at : m.start()], new]
            length += m.start() - at
            found.append((kind, length, length + len(new)))
            length += len(new)
            at = m.end()
        return "".join(out) + text[at:], found


def pseudonymize(docs: DataFrame, key: bytes = DEMO_KEY, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and the new columns pii_spans (kind, start, end) and n_pii.

    All other columns pass through.  A null text stays null and an empty one
    empty, with no spans; repeated rows give repeated rows.  Columns named
    pii_spans or n_pii are replaced.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = Pseudonymizer(key)
        for f in frames:
            done = [worker.replace(t) if isinstance(t, str) else (None, []) for t in f[text]]
            f = f.assign(**{text: [d[0] for d in done]})
            f["pii_spans"] = [[{"kind": k, "start": a, "end": b} for k, a, b in d[1]] for d in done]
            f["n_pii"] = pd.Series([len(d[1]) for d in done], dtype="int32", index=f.index)
            yield f

    docs = docs.drop("pii_spans", "n_pii")
    whole = T.IntegerType()
    span = T.StructType().add("kind", T.StringType()).add("start", whole).add("end", whole)
    schema = T.StructType([*docs.schema.fields, T.StructField("pii_spans", T.ArrayType(span)), T.StructField("n_pii", whole)])
    return map_frames(docs, run, schema)


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs)
