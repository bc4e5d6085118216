"""What changed between two annotation snapshots, in terms of the older ontology."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termdrift.functions.evidence import EvidencePolicy
from termdrift.plans.issues import ERROR, WARNING, Report, issue, issue_rows
from termdrift.plans.stages import cut

from .identity import IdentityMap, targets_by_sequence
from .snapshot import AnnotationSnapshot

# The relation that an aspect implies.
DEFAULT_RELATIONS = {"F": "enables", "P": "involved_in", "C": "located_in"}
KEY = ["sequence_id", "term_id", "relation", "aspect"]


def relation() -> Column:
    """The relation of an annotation, by default that of its aspect; an unknown aspect without one is an error (none of a negated row)."""
    out = F.when(F.col("relation") != "", F.col("relation"))
    for aspect, name in DEFAULT_RELATIONS.items():
        out = out.when(F.col("aspect") == aspect, name)
    return out.when(F.col("negated"), F.lit("")).otherwise(F.raise_error(F.concat(F.lit("no relation is known for aspect "), F.col("aspect"))).cast("string"))


def subject_map(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """subject_id -> sequence_id of its first match, and an issue for each match to another sequence."""
    subjects = F.array_distinct(F.array_append(F.col("aliases.identifier"), F.col("target_id")))
    rows = matches.select("sequence_id", "ordinal", F.explode(subjects).alias("subject_id"))
    first = rows.groupBy("subject_id").agg(F.min_by("sequence_id", F.struct("ordinal", "sequence_id")).alias("sequence_id"))
    other = rows.join(first.withColumnRenamed("sequence_id", "first"), "subject_id").where("sequence_id <> first")
    found = issue("AMBIGUOUS_SEQUENCE_ALIAS", F.concat(F.lit("names several sequences: "), "subject_id"), ERROR)
    return first, issue_rows(other, found, order=F.col("ordinal"))


def _of_subjects(snapshot: AnnotationSnapshot, subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Annotations with their sequence_id, by subject_id alone, and warnings for negated ones, which are left out."""
    columns = ("sequence_id", "term_id", relation().alias("relation"), "aspect", "evidence", "negated", "source", "line")
    # Written once, for the warnings, the projection and the assertions.
    rows = cut(snapshot.annotations.join(subjects, "subject_id").select(*columns))
    place = {"source": F.col("source"), "line": F.col("line")}
    negated = issue_rows(rows.where("negated"), issue("NEGATED_ANNOTATION_IGNORED", "a negated annotation isn't compared", WARNING, **place))
    return rows.where(~F.col("negated")), negated


def old_assertions(snapshot: AnnotationSnapshot, subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """KEY and evidence (a sorted set) of the older snapshot; unresolvable terms are left out."""
    rows, issues = _of_subjects(snapshot, subjects)
    terms = snapshot.ontology.resolve.withColumnRenamed("any_id", "term_id")
    found = rows.select("sequence_id", "term_id", "relation", "aspect", "evidence").distinct().join(terms, "term_id")
    grouped = found.groupBy("sequence_id", F.col("canonical_id").alias("term_id"), "relation", "aspect")
    return grouped.agg(F.array_sort(F.collect_set("evidence")).alias("evidence")), issues


def new_assertions(old: AnnotationSnapshot, new: AnnotationSnapshot, subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """KEY, evidence and projected_from (sorted sets) of the newer snapshot in the older ontology.

    Each distinct term is projected once. Rows are made distinct before they fan out to several
    targets; warnings about unmappable terms, one for each row, are taken before that.
    """
    rows, negated = _of_subjects(new, subjects)
    projection = cut(old.ontology.project_from(new.ontology, rows.select("term_id")))
    lost = projection.where("target_term IS NULL").select("term_id").distinct()
    place = {"source": F.col("source"), "line": F.col("line")}
    unmapped = issue_rows(
        rows.join(lost, "term_id", "left_semi"),
        issue("UNMAPPABLE_NEW_TERM", F.concat(F.lit(f"release {old.release} has nothing for "), "term_id"), WARNING, **place),
    )
    plain = rows.select("sequence_id", "term_id", "relation", "aspect", "evidence").distinct()
    found = plain.join(projection.where("target_term IS NOT NULL").select("term_id", "source_term", "target_term"), "term_id")
    moved = F.when(F.col("target_term") != F.col("source_term"), F.col("source_term"))
    grouped = found.withColumn("moved", moved).groupBy("sequence_id", F.col("target_term").alias("term_id"), "relation", "aspect")
    out = grouped.agg(F.array_sort(F.collect_set("evidence")).alias("evidence"), F.array_sort(F.collect_set("moved")).alias("projected_from"))
    return out, negated.unionByName(unmapped)


def classified(before: DataFrame, after: DataFrame, targets: DataFrame, policy: EvidencePolicy) -> DataFrame:
    """The changes between assertions; see compare_annotations."""
    # The evidence column is null on the side that lacks the key; presence is told by it, never by an empty set.
    one = before.withColumnRenamed("evidence", "old")
    two = after.withColumnRenamed("evidence", "new")
    rows = one.join(two, KEY, "full_outer")
    none = F.array().cast("array<string>")
    was, now = F.coalesce("old", none), F.coalesce("new", none)
    kind = (
        F.when(F.col("old").isNull(), "term_acquired").when(F.col("new").isNull(), "annotation_removed")
        .when(policy.is_upgrade(was, now), "evidence_upgraded").when(was != now, "evidence_changed")
    )
    rows = rows.select(*KEY, kind.alias("kind"), was.alias("old_evidence"), now.alias("new_evidence"), F.coalesce("projected_from", none).alias("projected_from"))
    rows = rows.where("kind IS NOT NULL").join(targets, "sequence_id")
    qualifies = F.when(F.col("kind") == "term_acquired", policy.accepts(F.col("new_evidence"))).otherwise(F.col("kind") == "evidence_upgraded")
    return rows.select(
        "sequence_id", "target_ids", "term_id", "relation", "aspect", "kind", "old_evidence", "new_evidence", "projected_from", qualifies.alias("qualifies")
    )


@dataclass(frozen=True)
class ComparisonResult:
    """changes (AnnotationChange), the report (with both snapshots' issues) and the policy."""

    changes: DataFrame
    report: Report
    policy: EvidencePolicy

    @property
    def validation(self) -> Report:
        return self.report

    @property
    def evidence_policy(self) -> EvidencePolicy:
        return self.policy

    @property
    def ordered(self) -> DataFrame:
        return self.changes.orderBy(*KEY)

    @property
    def selected_sequence_ids(self) -> DataFrame:
        return self.changes.where("qualifies").select("sequence_id").distinct()

    @property
    def selected_targets(self) -> DataFrame:
        return self.changes.where("qualifies").select(F.explode("target_ids").alias("target_id")).distinct()

    def count(self) -> int:
        return self.changes.count()


def compare_annotations(old: AnnotationSnapshot, new: AnnotationSnapshot, *, identities: IdentityMap, evidence_policy: EvidencePolicy | None = None, strict: bool = True) -> ComparisonResult:
    """Changes by sequence, term, relation and aspect, expressed in old's ontology.

    A key that only the newer snapshot has is term_acquired (it qualifies if the policy accepts
    its evidence), one that only the older has is annotation_removed; of keys in both, upgrades by
    the policy are evidence_upgraded (and qualify), other differences evidence_changed. Equal
    evidence is no change. strict: errors of both snapshots and of the comparison raise.
    """
    policy = evidence_policy or EvidencePolicy.experimental()
    matches = cut(identities.matches)
    subjects, ambiguous = subject_map(matches)
    subjects = cut(subjects)
    before, one = old_assertions(old, subjects)
    after, two = new_assertions(old, new, subjects)
    report = old.report.copy().extend(new.report).extend(Report.of(ambiguous, one, two))
    out = ComparisonResult(classified(before, after, targets_by_sequence(matches), policy), report, policy)
    if strict:
        report.raise_for_errors()
    return out
