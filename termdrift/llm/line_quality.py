"""Quality rules, line first: lines that fail a rule go, then documents that lost too much text.

Rules for a line with words (a line without any stays and counts for nothing):

- punctuation: no letter or digit at all, many of the symbols #*$%&|<>, or shouting (words that
  end in two exclamation marks);
- navigation: many separators standing alone between short entries, or a short line of menu words;
- boilerplate: a known phrase, an equal line earlier in the text, or one word over and over.

A document is rejected if it fails the base rules (too short, or too many words in repeated
8-word windows) or if the lines that stay hold too few of its words.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate
from operator import eq

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import documents, per_text, with_texts

# Fixed values.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
SEPARATORS = frozenset(x.encode() for x in ("|", "||", ">", ">>", "»", "›", "•", "·", "/", "-", "–"))
MENU = frozenset(b"home about contact login logout sign in up register search menu help faq sitemap next previous back top share".split())
PHRASES = (
    "all rights reserved", "terms of service", "terms of use", "privacy policy", "cookie policy", "accept cookies",
    "click here", "enable javascript", "subscribe to our newsletter", "lorem ipsum", "licensed under", "released under the",
)
PHRASE = re.compile("|".join(re.escape(x) for x in PHRASES).encode())
WINDOW = 8


@dataclass(frozen=True)
class Rules:
    """The limits; shares are of a line's or a document's words or characters."""

    min_words: int = 20
    repeat_percent: int = 30
    max_symbol_share: float = 0.15
    max_shout_share: float = 0.5
    max_separator_share: float = 0.2
    max_menu_words: int = 12
    max_echo_share: float = 0.3
    min_echo_words: int = 8
    min_kept_share: float = 0.35


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """The number of words that lie in a window of words found twice or more.

    Windows are compared by a 64-bit hash first; those with an equal one are then compared word
    by word, so the count is exact.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    table: dict[bytes, int] = {}
    ids = np.array([table.setdefault(w, len(table)) for w in words], np.uint64)
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, np.uint64)
    for j in range(window):
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes += mixed[j : j + n]
    order = np.sort(hashes)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(hashes, twice)).tolist()
    plain = ids.tolist()
    found = [tuple(plain[i : i + window]) for i in at]
    count = Counter(found)
    covered = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(at, found):
        if count[w] > 1:
            covered[i] += 1
            covered[i + window] -= 1
    return sum(1 for x in accumulate(covered.tolist()) if x > 0)


class LineCleaner:
    """Judges one text at a time; see the module."""

    def __init__(self, rules: Rules = Rules()):
        self.rules = rules

    def fails(self, line: bytes, words: list[bytes]) -> str | None:
        """The rule that a line with words fails, but for equal lines earlier in the text."""
        rules, n = self.rules, len(words)
        chars = len(line)
        if sum(map(line.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))) > rules.max_symbol_share * chars:
            return "navigation" if self.separated(words) else "punctuation"
        if b"!!" in line and sum(w.endswith(b"!!") for w in words) > rules.max_shout_share * n:
            return "punctuation"
        if n <= rules.max_menu_words and not any(x.isalnum() for x in line.decode("utf-8", "replace")):
            return "punctuation"
        if self.separated(words):
            return "navigation"
        lower = line.lower()
        if n <= rules.max_menu_words and n > 1 and MENU.issuperset(lower.split()):
            return "navigation"
        if PHRASE.search(lower):
            return "boilerplate"
        if n >= rules.min_echo_words and sum(map(eq, words, words[1:])) > rules.max_echo_share * n:
            return "boilerplate"
        return None

    def separated(self, words: list[bytes]) -> bool:
        alone = sum(w in SEPARATORS for w in words)
        return alone >= 2 and alone > self.rules.max_separator_share * len(words)

    def judge(self, text: str | None) -> dict:
        """Counts, verdict and cleaned text (the lines that stay) of a text; null has no words."""
        rules, text = self.rules, text or ""
        lines = text.encode("utf-8", "replace").split(b"\n")
        seen: set[bytes] = set()
        words: list[bytes] = []
        stay, kept_words, dup = [], 0, 0
        for i, line in enumerate(lines):
            own = line.split()  # bytes are split at just the six blanks
            if not own:
                stay.append(i)
                continue
            words += own
            if line in seen:
                dup += 1
                continue
            seen.add(line)
            if self.fails(line, own) is None:
                stay.append(i)
                kept_words += len(own)
        n, repeat = len(words), repeated_words(words)
        base_failed = n < rules.min_words or 100 * repeat > rules.repeat_percent * n
        return {
            "n_words": n,
            "word_chars": len(text) - sum(map(text.count, BLANKS)),
            "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": dup,
            "n_repeat_words": repeat,
            "base_failed": base_failed,
            "kept": not base_failed and kept_words >= rules.min_kept_share * n,
            "kept_words": kept_words,
            "cleaned": text if len(stay) == len(lines) else b"\n".join([lines[i] for i in stay]).decode("utf-8", "replace"),
        }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_words")


def line_report(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """doc_id, the counts, base_failed, kept and kept_words (words in lines that stay) per row.

    A null or empty text has no words and fails the base rules; repeated rows each get a row; a
    null doc_id stays; an empty table gives an empty one; other columns are ignored.
    """

    def start():
        judge = LineCleaner(rules).judge

        def work(texts):
            found = [judge(t) for t in texts]
            return [[x[c] for x in found] for c in COUNTS]

        return work

    fields = ", ".join(f"{c} {'boolean' if c in ('base_failed', 'kept') else 'bigint'}" for c in COUNTS)
    return per_text(df, start, fields)


def clean_documents(df: DataFrame, rules: Rules = Rules(), *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The rows whose text is kept, with the text of the lines that stay and the columns of df.

    chars_col, if df has it, becomes the new text's length. Other columns, whatever their names,
    pass through; rows with a null or empty text are rejected; repeated rows are judged alike.
    """

    def start():
        judge = LineCleaner(rules).judge
        return lambda texts: [x["cleaned"] if x["kept"] else None for x in map(judge, texts)]

    return with_texts(df, start, text_col, chars_col, drop=True)


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(documents(spark, sf_dir))


_ONE_OF = ", ".join(f"'{x.decode()}'" for x in sorted(SEPARATORS))
_MENU = ", ".join(f"'{x.decode()}'" for x in sorted(MENU))
_PHRASES = " OR ".join(f"contains(lower(line), '{x}')" for x in PHRASES)
_R = Rules()

ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), ws AS (
  SELECT rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d
), w AS (
  SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM ws
), g AS (
  SELECT rid, i, string_agg(word, ' ') OVER s AS gram, count(*) OVER s AS n FROM w
  WINDOW s AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)
), twice AS (
  SELECT rid, i, n = {WINDOW} AND count(*) OVER (PARTITION BY rid, gram, n) > 1 AS twice FROM g
), covered AS (
  SELECT rid, bool_or(twice) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {WINDOW - 1} PRECEDING AND CURRENT ROW) AS covered FROM twice
), repeats AS (
  SELECT rid, count(*) FILTER (covered) AS n_repeat_words FROM covered GROUP BY rid
), ls AS (
  SELECT rid, string_split(t, chr(10)) AS lines FROM d
), l AS (
  SELECT rid, unnest(lines) AS line, generate_subscripts(lines, 1) AS ln FROM ls
), lw AS (
  SELECT rid, ln, line, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM l
), judged AS (
  SELECT rid, len(words) AS n, row_number() OVER (PARTITION BY rid, line ORDER BY ln) > 1 AS again,
    len(regexp_extract_all(line, '[#*$%&|<>]')) > {_R.max_symbol_share} * strlen(line)
    OR (contains(line, '!!') AND len(list_filter(words, lambda x: ends_with(x, '!!'))) > {_R.max_shout_share} * len(words))
    OR (len(words) <= {_R.max_menu_words} AND NOT regexp_matches(line, '[\p{{L}}\p{{N}}]'))
    OR (len(list_filter(words, lambda x: x IN ({_ONE_OF}))) >= 2 AND len(list_filter(words, lambda x: x IN ({_ONE_OF}))) > {_R.max_separator_share} * len(words))
    OR (len(words) BETWEEN 2 AND {_R.max_menu_words} AND len(list_filter(words, lambda x: lower(x) NOT IN ({_MENU}))) = 0)
    OR {_PHRASES}
    OR (len(words) >= {_R.min_echo_words} AND len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1])) > {_R.max_echo_share} * len(words)) AS fails
  FROM lw WHERE len(words) > 0
), kept AS (
  SELECT rid, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(n) FILTER (NOT again AND NOT fails), 0) AS kept_words FROM judged GROUP BY rid
), counts AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(kept_words, 0) AS kept_words
  FROM d JOIN ws USING (rid) LEFT JOIN kept USING (rid) LEFT JOIN repeats USING (rid)
), failed AS (
  SELECT *, n_words < {_R.min_words} OR 100 * n_repeat_words > {_R.repeat_percent} * n_words AS base_failed FROM counts
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND kept_words >= {_R.min_kept_share} * n_words AS kept, CAST(kept_words AS BIGINT) AS kept_words
FROM failed
"""
