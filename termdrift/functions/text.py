"""Column functions over text. All are built-in expressions, so they stay within code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space, the relation that has a name of its own.
BLANKS = r"(?U)[\s\x1c-\x1f]+"
RELATION_NAMES = {"BFO:0000050": "part_of"}


def strip(text: Column) -> Column:
    """text without white space, by Unicode, at its ends."""
    inner = BLANKS.removeprefix("(?U)")
    return F.regexp_replace(text, rf"(?U)^{inner}|{inner}$", "")


def normalize_sequence(sequence: Column) -> Column:
    """All white space removed, upper case."""
    return F.upper(F.regexp_replace(sequence, BLANKS, ""))


def normalized_digest(plain: Column) -> Column:
    """SHA-256 (hex) of a sequence that is normalized already; a character beyond ASCII is an error."""
    beyond = F.octet_length(plain) != F.char_length(plain)
    return F.when(beyond, F.raise_error(F.lit("a sequence has characters beyond ASCII"))).otherwise(F.sha2(plain, 256))


def sequence_digest(sequence: Column) -> Column:
    """The digest of any sequence, which is normalized first."""
    return normalized_digest(normalize_sequence(sequence))


def sequence_id(sequence: Column) -> Column:
    return F.concat(F.lit("sha256:"), sequence_digest(sequence))


def header_identifier(header: Column) -> Column:
    """The first word of a header; of sp|ACCESSION|... and tr|ACCESSION|... the accession."""
    word = F.regexp_extract(header, r"(?U)^([^\s\x1c-\x1f]*)", 1)
    parts = F.split(word, r"\|")
    return F.when(F.lower(parts[0]).isin("sp", "tr") & (F.size(parts) >= 3), parts[1]).otherwise(word)


def parts_of(value: Column) -> Column:
    """A list written with | between its members; empty ones don't count."""
    return F.filter(F.split(value, r"\|"), lambda x: x != "")


def obo_id(iri: Column) -> Column:
    """PREFIX:ID of an IRI whose last part is PREFIX_ID; else null."""
    tail = F.regexp_extract(iri, r"([^/]*)$", 1)
    return F.when(F.contains(tail, F.lit("_")), F.regexp_replace(tail, "^([^_]*)_", "$1:"))


def literal_id(text: Column) -> Column:
    """A literal that has a colon is an identifier itself; else null."""
    return F.when(F.contains(text, F.lit(":")), text)


def relation_name(relation_id: Column) -> Column:
    """The name of a relation, its identifier if it has none."""
    return F.coalesce(*(F.when(relation_id == k, F.lit(v)) for k, v in RELATION_NAMES.items()), relation_id)
