"""The closed vocabularies as enumerations; their members are the strings that the tables hold."""

from __future__ import annotations

from enum import StrEnum


class Severity(StrEnum):
    ERROR = "error"
    WARNING = "warning"


class EvidenceCategory(StrEnum):
    EXPERIMENTAL = "experimental"
    PHYLOGENETIC = "phylogenetic"
    COMPUTATIONAL = "computational"
    AUTHOR_STATEMENT = "author_statement"
    CURATOR_STATEMENT = "curator_statement"
    ELECTRONIC = "electronic"
    UNKNOWN = "unknown"


class ChangeKind(StrEnum):
    TERM_ACQUIRED = "term_acquired"
    ANNOTATION_REMOVED = "annotation_removed"
    EVIDENCE_UPGRADED = "evidence_upgraded"
    EVIDENCE_CHANGED = "evidence_changed"


class ProjectionKind(StrEnum):
    SAME = "same"
    ALTERNATE_ID = "alternate_id"
    NEAREST_ANCESTOR = "nearest_ancestor"
    UNMAPPABLE = "unmappable"
    UNKNOWN_SOURCE_TERM = "unknown_source_term"
