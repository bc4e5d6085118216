"""Toxicity by a learned lexicon: Levenshtein automata intersected with its trie, and context windows.

Learning. Words and word beginnings that are commoner in toxic than in other labelled documents
become the lexicon, each with its log-odds. Counting runs on executors; the driver gets the
MAX_TERMS best terms and, of SAMPLE labelled documents, their matches.

Matching. The lexicon is a trie. The automaton of all words within one edit of its longer terms
is the product of Levenshtein automata and trie; it is made deterministic state by state as words
ask for it, so a word costs a table look-up for each letter until no term is near any more.

Scoring. A match counts by its weight; one that stands between quotation marks, or after a
word that reports speech, counts a quarter. A logistic regression over sums of the counts turns
them into a score.
"""

from __future__ import annotations

import re
from collections import Counter
from math import exp, log, log1p, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_schema, documents, per_text, plain_text, slices, written

#: Labelled documents learned from at most: those with the smallest hash of doc_id.
SAMPLE = 8000
#: Terms of the lexicon at most, and letters of word beginnings that may be terms.
MAX_TERMS, STEMS = 400, range(4, 9)
#: Evidence a term needs: documents, share of toxic documents, log-odds, log-likelihood ratio.
MIN_DOCS, MIN_SHARE, MIN_ODDS, MIN_G2 = 3, 0.01, 1.5, 12.0
#: Letters of a term that may be misspelled.
MIN_FUZZY = {"$": 5, "": 6}
#: A priori so many times a term's documents have it misspelled; other documents' near words count against that.
MISSPELT = 0.1
THRESHOLD, QUOTED, REACH = 0.3, 0.25, 60

WORD = re.compile(r"[^\W_]+(?:[@$*!][^\W_]+)*")
# Fixed values.
OPENING, CLOSING = "\"“„«‹‘", "\"”“»›’"
REPORTING = frozenset("said says say called calls calling quote quoted quotes wrote writes word words term insult insults slur slurs label labelled".split())


def terms_of(words: set[str]) -> set[str]:
    """Features of a document: its words, ending in $, and their beginnings."""
    out = {f"{w}$" for w in words}
    for w in words:
        out.update(w[:k] for k in STEMS if k < len(w))
    return out


def log_odds(toxic: float, other: float, n_toxic: int, n_other: int) -> float:
    return log((toxic + 0.5) / (n_toxic + 1) / ((other + 0.5) / (n_other + 1)))


class Lexicon:
    """Terms (a word ends in $, a beginning doesn't) and what a word matches within one edit."""

    def __init__(self, terms: list[str]):
        self.exact = {t: i for i, t in enumerate(terms)}
        self.nodes: list[dict[str, int]] = [{}]
        self.ends: list[tuple[int, int]] = [(-1, -1)]  # terms that end at a node: beginning, word
        for i, t in enumerate(terms):
            stem, whole = t.rstrip("$"), t.endswith("$")
            if len(stem) < MIN_FUZZY["$" if whole else ""]:
                continue
            at = 0
            for c in stem:
                if c not in self.nodes[at]:
                    self.nodes[at][c] = len(self.nodes)
                    self.nodes.append({})
                    self.ends.append((-1, -1))
                at = self.nodes[at][c]
            self.ends[at] = (self.ends[at][0], i) if whole else (i, self.ends[at][1])
        self.states: dict[frozenset, int] = {}
        self.members: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.start = self.state(self.closed({(0, 0)}))

    def closed(self, members: set[tuple[int, int]]) -> frozenset:
        """With the members that a letter left out of the word leads to; of a node, the fewest edits."""
        least: dict[int, int] = {}
        for node, edits in members:
            least[node] = min(edits, least.get(node, 2))
        for node, edits in list(least.items()):
            if edits == 0:
                for child in self.nodes[node].values():
                    least[child] = min(1, least.get(child, 2))
        return frozenset(least.items())

    def state(self, members: frozenset) -> int:
        if members not in self.states:
            self.states[members] = len(self.members)
            self.members.append(members)
            self.steps.append({})
        return self.states[members]

    def step(self, state: int, letter: str) -> int:
        members: set[tuple[int, int]] = set()
        for node, edits in self.members[state]:
            if (child := self.nodes[node].get(letter)) is not None:
                members.add((child, edits))
            if edits == 0:
                members.add((node, 1))  # a letter too many
                members.update((child, 1) for child in self.nodes[node].values())  # another letter
        to = self.steps[state][letter] = self.state(self.closed(members)) if members else -1
        return to

    def near(self, word: str) -> int:
        """The first term, in the lexicon's order, that the word is one edit away from; -1 if none."""
        state, found = self.start, -1
        best = lambda kind: [x for n, _ in self.members[state] if (x := self.ends[n][kind]) >= 0]
        for c in word:
            nxt = self.steps[state].get(c)
            state = self.step(state, c) if nxt is None else nxt
            if state < 0:
                return found
            if more := best(0):
                found = min(more) if found < 0 else min(found, *more)
        more = best(1)
        return min([*more, found] if found >= 0 else more, default=found)

    def match(self, word: str) -> tuple[int, int] | None:
        """(term, edits): the longest term that the word is or begins with, else one an edit away."""
        i = self.exact.get(f"{word}$")
        if i is not None:
            return i, 0
        for k in range(min(len(word) - 1, STEMS[-1]), STEMS[0] - 1, -1):
            if (i := self.exact.get(word[:k])) is not None:
                return i, 0
        return (i, 1) if len(word) >= MIN_FUZZY["$"] - 1 and (i := self.near(word)) >= 0 else None


class Matcher:
    """Counts a text's matches by (term, edits, quoted)."""

    def __init__(self, terms: list[str]):
        self.lexicon = Lexicon(terms)
        self.known: dict[str, tuple[int, int] | None] = {}

    def matches(self, text: str | None) -> tuple[int, Counter]:
        """Words of the text, and its matches."""
        low, known = (text or "").lower(), self.known
        words = WORD.findall(low)
        new = set(words).difference(known)
        if new:
            if len(known) > 500_000:
                known.clear()
                new = set(words)
            known.update((w, self.lexicon.match(w)) for w in new)
        found: Counter = Counter()
        if any(map(known.__getitem__, set(words))):
            for m in WORD.finditer(low):
                if hit := known[m[0]]:
                    found[(*hit, self.quoted(low, m.start(), m.end()))] += 1
        return len(words), found

    @staticmethod
    def quoted(text: str, start: int, end: int) -> bool:
        """Whether text[start:end] stands in quotation marks or after a reporting word, within its line."""
        before = text[max(0, start - REACH) : start].rpartition("\n")[2]
        after = text[end : end + REACH].partition("\n")[0]
        marks = sum(map(before.count, OPENING)) - sum(map(before.count, set(CLOSING) - set(OPENING)))
        if marks % 2 == 1 and any(c in after for c in CLOSING):
            return True
        return not REPORTING.isdisjoint(before.split()[-3:])


class Model:
    """Weights of the terms, exact and one edit away, and the regression over their sums."""

    def __init__(self, terms: list[str], weights: list[tuple[float, float]], beta: list[float]):
        self.terms, self.weights, self.beta = terms, weights, beta

    def features(self, n: int, found: dict) -> list[float]:
        total = most = hits = 0.0
        for (term, edits, quoted), times in found.items():
            weight = self.weights[term][edits] * (QUOTED if quoted else 1.0)
            total += weight * times
            most = max(most, weight)
            hits += times * (weight > 0)
        return [1.0, min(total, 40.0) / 10, most / 4, total / sqrt(n + 1), log(n + 1) / 5, log1p(hits)]

    def score(self, n: int, found: dict) -> float:
        if not self.beta:
            return 0.0
        z = sum(b * x for b, x in zip(self.beta, self.features(n, found)))
        return 1 / (1 + exp(-max(-30.0, min(30.0, z))))


def regression(x: np.ndarray, y: np.ndarray, l2: float = 0.3) -> list[float]:
    """Logistic regression by Newton's method; the first column is the constant."""
    b, pen = np.zeros(x.shape[1]), l2 * (np.arange(x.shape[1]) > 0) + 1e-3
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        b = b + np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(pen), x.T @ (y - p) - pen * b)
    return b.tolist()


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the doc_id as text leaves 2 by 4 (never for a null one)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text and toxic of at most sample labelled documents that aren't held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = df.select("doc_id", plain_text(F.col("text")).alias("text")).where(F.col("text").isNotNull() & ~held_out())
    return rows.join(F.broadcast(known), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def learn(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, toxic); held-out rows aren't used.

    Null texts and labels are left out, repeated documents count once. Without labelled documents,
    or with labels of one kind only, the model gives every text the score 0.
    """
    rows = written(labelled_sample(df, labels, sample), "toxicity-sample").repartition(16, "doc_id")
    classes = {r[0]: r[1] for r in rows.groupBy("toxic").agg(F.count_distinct("text")).collect()}
    n_toxic, n_other = classes.get(1, 0), classes.get(0, 0)
    if not n_toxic or not n_other:
        return Model([], [], [])
    schema = StructType.fromDDL("term string, t bigint, c bigint")
    arrow = arrow_schema(schema)

    def count(batches):
        both = Counter(), Counter()
        for batch in batches:
            for part in slices([batch], "text"):
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    both[toxic].update(terms_of(set(WORD.findall(text.lower()))))
        terms = list(both[1])  # a term that no toxic document has isn't asked for
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((terms, [both[1][t] for t in terms], [both[0][t] for t in terms]), arrow)], schema=arrow)
        rest = [t for t in both[0] if t not in both[1]]
        for i in range(0, len(rest), 50_000):
            some = rest[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((some, [0] * len(some), [both[0][t] for t in some]), arrow)], schema=arrow)

    distinct = rows.groupBy("text").agg(F.max("toxic").alias("toxic"))  # exact copies count once
    counts = distinct.mapInArrow(count, schema).groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    n = F.col("t") + F.col("c")
    expected = n * (n_toxic / (n_toxic + n_other))
    g2 = 2 * (F.col("t") * F.log(F.col("t") / expected) + F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n - expected))).otherwise(0.0))
    odds = F.log((F.col("t") + 0.5) / (n_toxic + 1) / ((F.col("c") + 0.5) / (n_other + 1)))
    good = counts.where((F.col("t") >= max(MIN_DOCS, MIN_SHARE * n_toxic)) & (odds >= MIN_ODDS)).withColumn("g2", g2).where(F.col("g2") >= MIN_G2)
    found = [(r.term, r.t, r.c) for r in good.orderBy(F.desc("g2"), "term").limit(4 * MAX_TERMS).collect()]
    # Of a word and beginnings of it that the same documents have, the longest stays.
    longest = {(term[:k], t, c) for term, t, c in found for k in STEMS if k < len(term)}
    found = [x for x in found if x not in longest][:MAX_TERMS]
    terms = [x[0] for x in found]

    def start():
        matcher = Matcher(terms)

        def work(texts):
            got = [matcher.matches(t) for t in texts]
            flat = [[v for (term, edits, quoted), times in f.items() for v in (term, edits, int(quoted), times)] for _, f in got]
            return [[n for n, _ in got], flat]

        return work

    seen = per_text(rows, start, "n bigint, flat array<int>", ("toxic",)).collect()
    docs = [(r.toxic, r.n, {tuple(r.flat[i : i + 3]): r.flat[i + 3] for i in range(0, len(r.flat), 4)}) for r in seen]
    fuzzy = Counter((toxic, k) for toxic, _, f in docs for k in {term for term, edits, _ in f if edits})
    weights = []
    for i, (_, t, c) in enumerate(found):
        exact = log_odds(t, c, n_toxic, n_other)
        near = log_odds(fuzzy[1, i] + MISSPELT * t, fuzzy[0, i], n_toxic, n_other)
        weights.append((exact, max(0.0, min(0.8 * exact, near))))
    model = Model(terms, weights, [])
    x = np.array([model.features(n, f) for _, n, f in docs])
    return Model(terms, weights, regression(x, np.array([d[0] for d in docs], float)))


def score_documents(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted (1 from THRESHOLD on) of each row.

    A null or empty text has no words and gets the score of a text without matches. Repeated rows
    each get a row, a null doc_id stays, an empty table gives an empty one, other columns are
    ignored.
    """

    def start():
        matcher = Matcher(model.terms)

        def work(texts):
            scores = [model.score(*matcher.matches(t)) for t in texts]
            return [scores, [int(s >= THRESHOLD) for s in scores]]

        return work

    return per_text(df, start, "score double, predicted int")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
