"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value that passes its kind's validation is numbered within the values of its format, the number
goes through a keyed Feistel permutation (walked until it lies within the format's range), and
the result is written in the same format, valid again. Separators and case stay. The same value
has the same pseudonym under a key in every document, however it is punctuated, and the key
holder can invert it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, per_text

#: The key of the registered query; callers of the operators give their own.
EXAMPLE_KEY = b"an example key, not a secret"

KINDS = ("email", "iban", "card", "phone", "ssn", "date", "ip")
PATTERN = re.compile(
    r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-]))
    |(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\ [A-Z0-9]{4}){2,7}(?:\ [A-Z0-9]{1,4})?)(?!\w))
    |(?P<card>(?<![\w.+-])(?:[0-9]{13,19}|[0-9]{4}(?P<s4>[ -])[0-9]{4}(?P=s4)[0-9]{4}(?P=s4)[0-9]{4}|[0-9]{4}(?P<s5>[ -])[0-9]{6}(?P=s5)[0-9]{5})(?![\w]|[.-][0-9]))
    |(?P<phone>(?<![\w+.-])(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![\w]|[.-][0-9])
       |(?<![\w+.-])\+[1-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![\w]|[.-][0-9]))
    |(?P<ssn>(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w]|-[0-9]))
    |(?P<date>(?<![\w./-])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./](?:19|20)[0-9]{2})(?![\w]|[./-][0-9]))
    |(?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9]))
    """,
    re.X,
)
#: What a text must have to hold any value.
SOME = re.compile(r"[0-9@]")

CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
#: Dates that take part: 1900-01-01 to 2099-12-31.
FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


class Feistel:
    """A keyed permutation of range(n), for any n and tweak: a balanced network over bits, cycle-walked."""

    ROUNDS = 8

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def once(self, x: int, half: int, tweak: str, back: bool) -> int:
        mask = (1 << half) - 1
        left, right = x >> half, x & mask
        for i in range(self.ROUNDS) if not back else reversed(range(self.ROUNDS)):
            part = left if back else right
            text = f"{tweak}|{half}|{i}|{part}".encode()
            mixed = int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=min(64, -(-half // 8) + 8)).digest(), "big") & mask
            left, right = (right ^ mixed, left) if back else (right, left ^ mixed)
        return left << half | right

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        """The image of x, 0 <= x < n; back: its preimage."""
        if n < 2:
            return x
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        while True:
            x = self.once(x, half, tweak, back)
            if x < n:
                return x


def _mixed(text: str) -> tuple[int, int, list[str]]:
    """text's number among the texts that have the same character classes, their count, the classes."""
    x, n, kinds = 0, 1, []
    for c in text:
        kind = next(k for k in CLASSES if c in k)
        x, n = x * len(kind) + kind.index(c), n * len(kind)
        kinds.append(kind)
    return x, n, kinds


def _unmixed(x: int, kinds: list[str]) -> str:
    out = []
    for kind in reversed(kinds):
        x, i = divmod(x, len(kind))
        out.append(kind[i])
    return "".join(reversed(out))


def _refill(shape: str, letters: str) -> str:
    """shape with its ASCII letters and digits replaced by those of letters, in order."""
    new = iter(letters)
    return "".join(next(new) if c.isascii() and c.isalnum() else c for c in shape)


def luhn(digits: str) -> int:
    """The sum of Luhn's algorithm modulo 10; 0 for a valid number."""
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def iban_remainder(text: str) -> int:
    """An IBAN's number modulo 97; 1 for a valid one."""
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


class Pseudonyms:
    """Replaces the values of KINDS in texts; back=True restores them."""

    def __init__(self, key: bytes, back: bool = False):
        permute = Feistel(key).permute
        self.permute: Callable[[int, int, str], int] = lambda x, n, tweak: permute(x, n, tweak, back)
        self.known: dict[tuple[str, str], str | None] = {}

    def text(self, letters: str, tweak: str) -> str:
        x, n, kinds = _mixed(letters)
        return _unmixed(self.permute(x, n, tweak), kinds)

    def email(self, value: str) -> str | None:
        """Local part and domain labels but the last; both in lower case are the value that links."""
        local, _, domain = value.rpartition("@")
        name, _, top = domain.rpartition(".")
        parts = []
        for what, part in (("local", local), ("domain", name)):
            letters = "".join(c for c in part if c.isalnum())
            low = self.text(letters.lower(), f"email|{what}")
            parts.append(_refill(part, "".join(n.upper() if c.isupper() else n for c, n in zip(letters, low))))
        return f"{parts[0]}@{parts[1]}.{top}"

    def iban(self, value: str) -> str | None:
        letters = value.replace(" ", "")
        if not 15 <= len(letters) <= 34 or iban_remainder(letters) != 1:
            return None
        body = self.text(letters[4:], f"iban|{letters[:2]}")
        check = 98 - iban_remainder(f"{letters[:2]}00{body}")
        return _refill(value, f"{letters[:2]}{check:02}{body}")

    def card(self, value: str) -> str | None:
        """The first digit (the network) stays, the last one is computed."""
        digits = re.sub("[ -]", "", value)
        if luhn(digits) or len(set(digits)) == 1:
            return None
        body = digits[0] + self.text(digits[1:-1], f"card|{digits[0]}")
        new = body + str(-luhn(body + "0") % 10)
        return _refill(value, new)

    def phone(self, value: str) -> str | None:
        """North American numbers stay such; of others the first two digits (the country) stay, or the 1 of +1."""
        digits = re.sub("[^0-9]", "", value)
        if value[0] != "+" or value[1] == "1":
            if len(digits) not in (10, 11) or (len(digits) == 11) != (value[0] == "+"):
                return None
            d = digits[-10:]
            if d[0] in "01" or d[3] in "01":
                if len(digits) != 11 or digits[0] != "1":
                    return None
                while True:  # walked until no North American number again, so that it can be inverted
                    d = self.text(d, "phone|1|other")
                    if d[0] in "01" or d[3] in "01":
                        return _refill(value, "1" + d)
            x = ((int(d[:3]) - 200) * 800 + int(d[3:6]) - 200) * 10_000 + int(d[6:])
            x = self.permute(x, 800 * 800 * 10_000, "phone|1")
            x, line = divmod(x, 10_000)
            new = f"{x // 800 + 200}{x % 800 + 200}{line:04}"
            return _refill(value, digits[:-10] + new)
        if not 8 <= len(digits) <= 15:
            return None
        return _refill(value, digits[:2] + self.text(digits[2:], f"phone|{digits[:2]}"))

    def ssn(self, value: str) -> str | None:
        a, b, c = (int(x) for x in value.split("-"))
        if not (0 < a < 900 and a != 666 and b and c):
            return None
        x = ((a - 1 - (a > 666)) * 99 + b - 1) * 9999 + c - 1
        x = self.permute(x, 898 * 99 * 9999, "ssn")
        x, c = divmod(x, 9999)
        a, b = divmod(x, 99)
        return f"{a + 1 + (a >= 665):03}-{b + 1:02}-{c + 1:04}"

    def date(self, value: str) -> str | None:
        """Year-month-day, day.month.year, or with slashes month/day/year, else day/month/year."""
        if "-" in value:
            order, tweak = (0, 1, 2), "date"
        elif "." in value:
            order, tweak = (2, 1, 0), "date"
        else:
            order, tweak = ((2, 0, 1), "date") if int(value[:2]) < 13 else ((2, 1, 0), "date|late")
        parts = re.split("[-./]", value)
        if value[2:3] in "./" and value[2] != value[5]:
            return None
        try:
            day = date(*(int(parts[i]) for i in order))
        except ValueError:
            return None
        if tweak == "date":
            day = FIRST_DAY + timedelta(self.permute((day - FIRST_DAY).days, DAYS, tweak))
        else:  # day/month with a day that is no month: stays such
            late = _late_days()
            day = late[self.permute(late.index(day), len(late), tweak)]
        new = {order[0]: f"{day.year:04}", order[1]: f"{day.month:02}", order[2]: f"{day.day:02}"}
        return _refill(value, new[0] + new[1] + new[2])

    def ip(self, value: str) -> str | None:
        octets = value.split(".")
        if any(int(o) > 255 or o != str(int(o)) for o in octets):
            return None
        x = 0
        for o in octets:
            x = x << 8 | int(o)
        x = self.permute(x, 1 << 32, "ip")
        return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))

    def replace(self, text: str | None) -> tuple[str | None, list[int]]:
        """The text with pseudonyms (null stays null), and how many of each kind there are."""
        counts = [0] * len(KINDS)
        if not text or not SOME.search(text):
            return text, counts

        def new(m: re.Match) -> str:
            kind, value = next(k for k in KINDS if m[k] is not None), m[0]
            if (kind, value) not in self.known:
                if len(self.known) > 200_000:
                    self.known.clear()
                self.known[kind, value] = getattr(self, kind)(value)
            found = self.known[kind, value]
            counts[KINDS.index(kind)] += found is not None
            return value if found is None else found

        return PATTERN.sub(new, text), counts


_LATE: list[date] = []


def _late_days() -> list[date]:
    """The days that take part whose number in the month is above 12."""
    if not _LATE:
        _LATE.extend(d for i in range(DAYS) if (d := FIRST_DAY + timedelta(i)).day > 12)
    return _LATE


def pseudonymize(df: DataFrame, key: bytes, *, back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms, and the count of replaced values by kind (n_email, ...).

    back: text with the values restored. A null text stays null, with counts of 0; repeated rows
    each get a row, a null doc_id stays, an empty table gives an empty one, other columns are
    left out. Whole texts are searched, however long.
    """

    def start():
        replace = Pseudonyms(key, back).replace

        def work(texts):
            found = [replace(t) for t in texts]
            return [[t for t, _ in found], *([c[i] for _, c in found] for i in range(len(KINDS)))]

        return work

    fields = "_new string, " + ", ".join(f"n_{k} bigint" for k in KINDS)
    done = per_text(df, start, fields, ("doc_id",))
    return done.select("doc_id", F.col("_new").alias("text"), *(f"n_{k}" for k in KINDS))


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(documents(spark, sf_dir), EXAMPLE_KEY)
