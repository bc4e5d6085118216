"""Spark-native comparison of annotation releases over exact sequence identities."""

from termdrift.functions.evidence import EvidencePolicy
from termdrift.functions.text import normalize_sequence, sequence_digest, sequence_id
from termdrift.operators.compare import ComparisonResult, compare_annotations
from termdrift.operators.identity import IdentityMap, SequenceDataset, SequenceIndex
from termdrift.operators.ontology import Ontology
from termdrift.operators.snapshot import AnnotationSnapshot
from termdrift.plans.issues import Report, ValidationError, ValidationIssue
from termdrift.records import AnnotationChange, OntologyTerm, RecordParser, SequenceAlias, SequenceMatch, TermProjection
from termdrift.sources.fasta import FastaReader
from termdrift.sources.files import Source
from termdrift.sources.gaf import GafReader
from termdrift.vocabulary import ChangeKind, EvidenceCategory, ProjectionKind, Severity

GeneOntology, ValidationReport = Ontology, Report

__all__ = [
    "AnnotationChange", "AnnotationSnapshot", "ChangeKind", "ComparisonResult", "EvidenceCategory", "EvidencePolicy", "FastaReader", "GafReader", "GeneOntology",
    "IdentityMap", "Ontology", "OntologyTerm", "ProjectionKind", "RecordParser", "Report", "SequenceAlias", "SequenceDataset", "SequenceIndex",
    "SequenceMatch", "Severity", "Source", "TermProjection", "ValidationError", "ValidationIssue", "ValidationReport", "compare_annotations",
    "normalize_sequence", "sequence_digest", "sequence_id",
]
