"""Secret scans: fixed patterns, and character Markov models told apart by likelihood ratio.

Ordinary text is a second-order chain over characters, trained from the words of a bounded sample
of the documents themselves (those that the patterns take for secrets left out), from the words of
the language reference that Python brings along, and from labelled identifiers, numbers and dates. Random strings are one first-order chain for each alphabet they
are drawn from, trained from labelled samples. A run of key characters is cut at its separators;
the stretch of neighbouring parts with the highest log-likelihood ratio is a secret if that ratio
is high enough, and what lies before and after it is judged likewise.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable
from functools import cache
from math import log
from pydoc_data.topics import topics

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_schema, documents, per_text, plain_text, slices, with_texts

# Fixed values.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
MIN_ASSIGN, MIN_ACCESS = 8, 16

#: Runs that the models judge, their parts, the fewest characters of a secret.
RUN, PART, MIN_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}"), re.compile(r"[^/_-]+|[/_-]+"), 16
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{2,64}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
N = len(ALPHABET) + 1  # the last one stands before a string
_NUMBERS = np.full(256, N - 1, np.int64)
_NUMBERS[list(ALPHABET.encode())] = np.arange(N - 1)
#: Documents whose words ordinary text is learned from, about: those with the smallest hash of their id.
SAMPLE = 2000
#: Nats by which a secret must be likelier as a random string, in all and for each character.
MIN_TOTAL, MIN_EACH = 24.0, 1.5

UPPER, LOWER, DIGITS = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
#: The alphabets that random strings are drawn from.
ALPHABETS = {
    "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "base32": UPPER + "234567", "lower": LOWER, "upper": UPPER, "lower and digits": LOWER + DIGITS,
    "upper and digits": UPPER + DIGITS, "letters": UPPER + LOWER, "letters and digits": UPPER + LOWER + DIGITS, "base64": ALPHABET[:64], "base64url": ALPHABET[:62] + "_-",
}
VERBS = "get set read write load save find make build send fetch parse check update delete create open close start stop".split()
NOUNS = (
    "user file name value index table column buffer server client message request response session account address "
    "version number config option handler manager service object element container document directory connection"
).split()
ENDINGS = "able ation ations ement ements ency er ers est ian ies ing ings ion ions ish ism ist ity ive ization ly ment ness ology ous ship tion".split()
STEMS = (
    "inter nation under stand com puter respons represent communic transform organ character environ part develop "
    "govern establish charg schaft keit heit verein ung haupt gesell arbeit straß eau oire ment tique ción mente dad"
).split()
KEYBOARD = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "0123456789", LOWER, "qwertzuiop", "azertyuiop")


def random_samples(n: int = 600, seed: int = 1) -> dict[str, list[str]]:
    """By alphabet n strings drawn from it; those of uuid are hexadecimal numbers in groups."""
    draw = random.Random(seed)
    out = {name: ["".join(draw.choices(letters, k=draw.randint(16, 48))) for _ in range(n)] for name, letters in ALPHABETS.items()}
    out["uuid"] = ["-".join("".join(draw.choices(ALPHABETS["hex"], k=k)) for k in (8, 4, 4, 4, 12)) for _ in range(n)]
    return out


def ordinary_samples(n: int = 3000, seed: int = 1) -> list[str]:
    """The words of Python's language reference, and n identifiers, long words, paths, numbers, dates and keyboard walks."""
    draw = random.Random(seed)
    out = sorted({w for text in topics.values() for w in TOKEN.findall(text)})
    for i in range(n):
        words = [draw.choice(VERBS), *(draw.choice(NOUNS) for _ in range(draw.randint(1, 3)))]
        date = f"{draw.randint(1900, 2060)}{draw.choice(('-', '', '/'))}{draw.randint(1, 12):02}{draw.choice(('-', ''))}{draw.randint(1, 28):02}"
        row = draw.choice(KEYBOARD)
        out.append(
            (
                lambda: "_".join(words), lambda: words[0] + "".join(w.title() for w in words[1:]), lambda: "_".join(words).upper(),
                lambda: "-".join(words) + f"-{draw.randint(1, 99)}", lambda: "/".join(words) + "/" + date, lambda: "".join(w.title() for w in words),
                lambda: "".join(draw.choice(STEMS + ENDINGS) for _ in range(draw.randint(3, 6))) + draw.choice(ENDINGS),
                lambda: "".join(draw.choices(DIGITS, k=draw.randint(2, 30))), lambda: row * draw.randint(1, 2), lambda: (row * 2)[draw.randint(0, 9) :],
                lambda: f"{date}T{draw.randint(0, 23):02}{draw.choice(('', '-'))}{draw.randint(0, 59):02}{draw.choice(('', '-'))}{draw.randint(0, 59):02}",
                lambda: draw.choice(ALPHABET) * draw.randint(3, 40), lambda: draw.choice(("YYYY-MM-DD", "XXXX-XXXX-XXXX", "DD-MM-YYYYTHH-MM-SS", "xxxxxxxx")),
            )[i % 13]()
        )
    return out


def numbers_of(text: str) -> np.ndarray:
    """The numbers of a string's characters, two border marks before them; other characters are border marks, too."""
    return _NUMBERS[np.frombuffer(b"??" + text.encode("ascii", "replace"), np.uint8)]


@cache
def labelled_counts() -> tuple[np.ndarray, np.ndarray]:
    """Triples of the ordinary samples, and pairs of the random ones by alphabet."""
    return triples(ordinary_samples()), np.array([triples(x).sum(0) for x in random_samples().values()])


def triples(texts: Iterable[str]) -> np.ndarray:
    """How often each three characters follow one another in texts, as a cube."""
    out = np.zeros(N**3, np.int64)
    for text in texts:
        x = numbers_of(text)
        np.add.at(out, (x[:-2] * N + x[1:-1]) * N + x[2:], 1)
    return out.reshape(N, N, N)


def chain(counts: np.ndarray, weight: float = 4.0) -> np.ndarray:
    """Log-probabilities of a character after two others, each order's backed by the lower one's."""
    one = (counts.sum((0, 1)) + 0.5) / (counts.sum() + 0.5 * N)
    two = counts.sum(0)
    two = (two + weight * one) / (two.sum(1, keepdims=True) + weight)
    return np.log((counts + weight * two) / (counts.sum(2, keepdims=True) + weight))


class MarkovRatio:
    """The log-likelihood ratio of random strings of each alphabet to ordinary text.

    ordinary: counts of triples in the documents' words, added to those of the labelled samples.
    """

    def __init__(self, ordinary: np.ndarray | None = None, *, min_total: float = MIN_TOTAL, min_each: float = MIN_EACH):
        counts, pairs = labelled_counts()
        self.ordinary = chain(counts if ordinary is None else counts + ordinary)
        self.random = np.log((pairs + 0.05) / (pairs.sum(2, keepdims=True) + 0.05 * N))
        self.min_total, self.min_each = min_total, min_each

    def ratios(self, text: str) -> np.ndarray:
        """By alphabet and character the nats by which text is likelier as drawn from it."""
        x = numbers_of(text)
        return self.random[:, x[1:-1], x[2:]] - self.ordinary[x[:-2], x[1:-1], x[2:]]

    def secrets(self, run: str) -> list[tuple[int, int]]:
        """Secrets within a run: (start, end) in order.

        Of all stretches of neighbouring parts, that with the highest ratio beyond min_each for
        each character is looked at; alphabets are equally likely beforehand.
        """
        cuts = [0, *(m.end() for m in PART.finditer(run))]
        sums = np.add.reduceat(self.ratios(run) - self.min_each, cuts[:-1], axis=1)
        out: list[tuple[int, int]] = []
        todo = [(0, len(cuts) - 1)]
        while todo:
            low, high = todo.pop()
            if cuts[high] - cuts[low] < MIN_RUN:
                continue
            total, a, b = max((stretch(row[low:high]) for row in sums), key=lambda s: s[0])
            a, b = a + low, b + low
            size, total = cuts[b] - cuts[a], total - log(len(sums))
            if total >= 0:
                if size >= MIN_RUN and total + self.min_each * size >= self.min_total:
                    out.append((cuts[a], cuts[b]))
                todo += [(low, a), (b, high)]
        return sorted(out)


def stretch(values: np.ndarray) -> tuple[float, int, int]:
    """The highest sum of neighbouring values, and where they start and end."""
    best, total, start = (-np.inf, 0, 0), 0.0, 0
    for i, x in enumerate(values.tolist()):
        if total <= 0:
            total, start = 0.0, i
        total += x
        if total > best[0]:
            best = (total, start, i + 1)
    return best


class SecretScanner:
    """Finds spans (start, end in code points, kind) in one text."""

    def __init__(self, model: MarkovRatio | None = None):
        self.model = model or MarkovRatio()

    def base(self, text: str) -> list[tuple[int, int, str]]:
        """Spans of the three patterns, by start, then kind as listed."""
        found = []
        low = text.lower()
        if any(k in low for k in ASSIGN_KEYS):
            found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
        if "AKIA" in text:
            found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
        return [(s, e, KINDS[k]) for s, e, k in sorted(found, key=lambda x: (x[0], x[2]))]

    def added(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Spans that the models take for random strings and that no base span overlaps."""
        found = [(m.start() + s, m.start() + e) for m in RUN.finditer(text) for s, e in self.model.secrets(m[0])]
        return [(s, e, KINDS[3]) for s, e in found if all(y <= s or e <= x for x, y, _ in base)]

    def scan(self, text: str | None) -> tuple[list, list]:
        """Base spans, and all spans by start, then kind as listed. A null text is empty."""
        base = self.base(text or "")
        more = self.added(text or "", base)
        return base, sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2]))) if more else base

    def redact(self, text: str | None) -> str | None:
        """text with each span, overlapping ones as one, replaced by [SECRET]; null stays null."""
        if not text:
            return text
        out, at = [], 0
        for start, end, _ in self.scan(text)[1]:
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        return "".join([*out, text[at:]])


def learn(df: DataFrame, *, text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE) -> MarkovRatio:
    """The models, ordinary text learned from the documents with the sample smallest hashes of id_col.

    Each different word counts once, so copies don't weigh more. What the patterns take for
    secrets, and what models of the labelled samples alone take for random, is left out as labelled
    otherwise. Null texts have no words; an empty table leaves the labelled samples. The driver gets
    counts of character triples, fewer than 68 to the third.
    """
    h = F.xxhash64(F.col(f"`{id_col}`"))
    found = df.select(h.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = df.where(h <= F.lit(found if found is not None else 0)).select(plain_text(F.col(f"`{text_col}`")).alias("text"))

    scanner = SecretScanner()

    def words(batches):
        for part in slices(batches, "text"):
            out: set[str] = set()
            for text in part.column("text").to_pylist():
                text = text or ""
                base = scanner.base(text)
                out.update(m[0] for m in TOKEN.finditer(text) if all(e <= m.start() or m.end() <= s for s, e, _ in base))
            yield pa.RecordBatch.from_arrays([pa.array([w for w in out if not scanner.model.secrets(w)], pa.string())], names=["word"])

    schema = StructType.fromDDL("code int, n bigint")
    arrow = arrow_schema(schema)

    def count(batches):
        total = np.zeros(N**3, np.int64)
        for batch in batches:
            total += triples(batch.column(0).to_pylist()).ravel()
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code, arrow.field(0).type), pa.array(total[code], arrow.field(1).type)], schema=arrow)

    counts = rows.mapInArrow(words, "word string").distinct().mapInArrow(count, schema).groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    ordinary = np.zeros(N**3, np.int64)
    ordinary[counts["code"].to_numpy()] = counts["n"].to_numpy()
    return MarkovRatio(ordinary.reshape(N, N, N))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_report(df: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256 of the base spans, spans (all, as text).

    A null or empty text has no spans; repeated rows each get a row; a null doc_id stays; an
    empty table gives an empty one; other columns are ignored. A text is held by one task, however
    long; strings without blanks are judged whole.
    """
    model = learn(df)

    def start():
        scan = SecretScanner(model).scan

        def work(texts):
            found = [scan(t) for t in texts]
            counts = [[sum(x[2] == k for x in base) for base, _ in found] for k in KINDS[:3]]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            return [*counts, digests, [joined(spans) for _, spans in found]]

        return work

    return per_text(df, start, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redact_documents(df: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars", id_col: str = "doc_id") -> DataFrame:
    """df with the secrets in text_col replaced by [SECRET]; chars_col, if there, is the new length.

    Null texts stay null, other columns pass through whatever their names, repeated rows stay.
    """

    model = learn(df, text_col=text_col, id_col=id_col)

    def start():
        redact = SecretScanner(model).redact
        return lambda texts: [redact(t) for t in texts]

    return with_texts(df, start, text_col, chars_col)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))
