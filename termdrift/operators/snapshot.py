"""A release's annotations together with the ontology they refer to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdrift.plans.issues import ERROR, Report, issue, issue_rows
from termdrift.sources.files import Source
from termdrift.sources.gaf import GafReader

from .ontology import Ontology

# The namespace of each aspect.
NAMESPACES = {"F": "molecular_function", "P": "biological_process", "C": "cellular_component"}


def by_subjects(annotations: DataFrame, subjects: DataFrame | None) -> DataFrame:
    """Annotations whose subject_id or database:subject_id is among subjects (subject_id).

    No subjects given: all of them; an empty table: none. A subject may be a subject_id as a whole, or
    what follows one of its colons if the database precedes it: one equi-join by subject_id finds both,
    so annotations are shuffled once.
    """
    if subjects is None:
        return annotations
    wanted = subjects.select("subject_id").where("subject_id IS NOT NULL").distinct()
    plain = wanted.select(F.col("subject_id").alias("_subject"), F.lit(None).cast("string").alias("_database"))
    colons = F.filter(F.sequence(F.lit(1), F.length("subject_id")), lambda i: F.substring("subject_id", i, F.lit(1)) == ":")
    cuts = wanted.where(F.contains("subject_id", F.lit(":"))).select("subject_id", F.explode(colons).alias("at"))
    full = cuts.select(F.substr("subject_id", F.col("at") + 1).alias("_subject"), F.substring("subject_id", F.lit(1), F.col("at") - 1).alias("_database"))
    names = plain.union(full)
    same = (annotations["subject_id"] == names["_subject"]) & (names["_database"].isNull() | (names["_database"] == annotations["database"]))
    return annotations.join(names, same, "left_semi")


def consistency(annotations: DataFrame, ontology: Ontology) -> DataFrame:
    """Issues of annotations whose term is unknown, or lies in another namespace than their aspect's."""
    expected = None
    for aspect, namespace in NAMESPACES.items():
        expected = F.when(F.col("aspect") == aspect, namespace) if expected is None else expected.when(F.col("aspect") == aspect, namespace)
    spaces = ontology.terms.select(F.col("identifier").alias("canonical_id"), "namespace")
    known = ontology.resolve.join(spaces, "canonical_id").select(F.col("any_id").alias("term_id"), "namespace")
    rows = annotations.select("term_id", "aspect", "source", "line").join(known, "term_id", "left").withColumn("expected", expected)
    place = {"source": F.col("source"), "line": F.col("line")}
    other = (F.col("namespace") != "") & F.col("expected").isNotNull() & (F.col("namespace") != F.col("expected"))
    return issue_rows(
        rows,
        issue("UNKNOWN_ANNOTATION_TERM", F.concat(F.lit("the ontology has no term "), "term_id"), ERROR, **place, when=F.col("namespace").isNull()),
        issue("ANNOTATION_ASPECT_MISMATCH", F.concat_ws(" ", "term_id", F.lit("lies in"), "namespace"), ERROR, **place, when=other),
    )


@dataclass(frozen=True)
class AnnotationSnapshot:
    """release (any text), annotations (ANNOTATIONS), their ontology and the report."""

    release: str
    annotations: DataFrame
    ontology: Ontology
    report: Report
    source: Source | None = None

    @classmethod
    def read(cls, spark: SparkSession, *, release: str, annotations: Source | str, ontology: Source | str, subjects: DataFrame | None = None, strict: bool = True, every_claim: bool = False) -> AnnotationSnapshot:
        """Reads both files, keeps subjects' annotations and checks them against the ontology.

        Faulty rows are reported whatever their subject. strict: all errors raise together, at
        the end. every_claim: as of Ontology.
        """
        go, report = Ontology.from_owl(spark, ontology, strict=False, every_claim=every_claim)
        source = Source.of(annotations)
        file = GafReader().read(spark, source, strict=False)
        kept = by_subjects(file.annotations, subjects)
        out = cls(release, kept, go, report.extend(file.report).extend(Report(consistency(kept, go))), source)
        if strict:
            out.report.raise_for_errors()
        return out

    @property
    def validation(self) -> Report:
        return self.report

    def count(self) -> int:
        return self.annotations.count()
