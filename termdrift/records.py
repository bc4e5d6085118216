"""Rows of the package's tables as Python objects, and what record parsers have in common."""

from __future__ import annotations

from typing import NamedTuple, Protocol

from pyspark.sql import DataFrame, SparkSession

from termdrift.plans.issues import Report
from termdrift.sources.files import Source


class SequenceAlias(NamedTuple):
    identifier: str
    source: str


class SequenceMatch(NamedTuple):
    target_id: str
    sequence_id: str
    aliases: tuple[SequenceAlias, ...]

    @classmethod
    def of(cls, row) -> SequenceMatch:
        return cls(row.target_id, row.sequence_id, tuple(SequenceAlias(a.identifier, a.source) for a in row.aliases))


class OntologyTerm(NamedTuple):
    identifier: str
    label: str = ""
    namespace: str = ""
    obsolete: bool = False
    alternate_ids: tuple[str, ...] = ()
    replaced_by: tuple[str, ...] = ()
    consider: tuple[str, ...] = ()

    @classmethod
    def of(cls, row) -> OntologyTerm:
        return cls(row.identifier, row.label, row.namespace, row.obsolete, *(tuple(row[c]) for c in ("alternate_ids", "replaced_by", "consider")))


class TermProjection(NamedTuple):
    """Where a term lies in an older ontology: all rows of one term_id together."""

    source_term: str
    target_terms: frozenset[str]
    distance: int | None
    kind: str

    @property
    def is_mappable(self) -> bool:
        return bool(self.target_terms)

    @classmethod
    def of(cls, rows: list) -> TermProjection:
        return cls(rows[0].source_term, frozenset(r.target_term for r in rows if r.target_term is not None), rows[0].distance, rows[0].kind)


class AnnotationChange(NamedTuple):
    sequence_id: str
    target_ids: tuple[str, ...]
    term_id: str
    relation: str
    aspect: str
    kind: str
    old_evidence: frozenset[str]
    new_evidence: frozenset[str]
    projected_from: frozenset[str]
    qualifies: bool

    @classmethod
    def of(cls, row) -> AnnotationChange:
        sets = (frozenset(row[c]) for c in ("old_evidence", "new_evidence", "projected_from"))
        return cls(row.sequence_id, tuple(row.target_ids), row.term_id, row.relation, row.aspect, row.kind, *sets, row.qualifies)


class RecordParser(Protocol):
    """Anything that reads a source as a table of records and says what is wrong with it."""

    def iter_records(self, spark: SparkSession, source: Source | str, *, report: Report | None = None, strict: bool = True) -> DataFrame: ...
