import pytest
from pyspark.sql import functions as F

from termdrift import AnnotationSnapshot, EvidencePolicy, Ontology, Report, SequenceIndex, ValidationError, ValidationIssue, compare_annotations
from termdrift.functions.text import normalize_sequence, parts_of, sequence_digest
from termdrift.operators.snapshot import by_subjects, consistency
from termdrift.schemas import ANNOTATIONS


def annotation(subject="P1", term="GO:1", evidence="IEA", relation="involved_in", aspect="P", negated=False, line=1):
    return ("DB", subject, "", relation, term, negated, [], evidence, [], aspect, "", [], "", [], "", "", [], "", "f", line)


def snapshot(spark, release, ontology, *rows):
    return AnnotationSnapshot(release, spark.createDataFrame(list(rows), ANNOTATIONS), ontology, Report.empty(spark))


def identities(spark, targets=(("T1", "ACD"), ("T0", "ACD"), ("T2", "WWW"), ("T3", "YYY")), entries=(("P1", "ACD"), ("P2", "WWW"), ("P3", "www"))):
    table = spark.createDataFrame([(i, s, n) for n, (i, s) in enumerate(targets)], "identifier string, sequence string, line long")
    index = SequenceIndex.of(spark.createDataFrame(list(entries), "identifier string, sequence string"), "r")
    return index.match(table)


def test_changes_of_every_kind(spark):
    old_go = Ontology.of(spark, ["GO:1", "GO:2", "GO:3", "GO:4"])
    new_go = Ontology.of(spark, ["GO:1", "GO:2", "GO:3", "GO:4", "GO:9", "GO:8"], [("GO:9", "is_a", "GO:2")])
    old = snapshot(spark, "old", old_go, annotation(), annotation(term="GO:3"), annotation(term="GO:4", evidence="TAS"), annotation(subject="P2", evidence="IDA"), annotation(subject="other"), annotation(term="GO:0", line=5))
    new = snapshot(
        spark, "new", new_go, annotation(evidence="IDA"), annotation(term="GO:9", evidence="IDA"), annotation(term="GO:4", evidence="IEA"), annotation(subject="P3", evidence="IDA", relation=""),
        annotation(subject="P3", evidence="IDA"), annotation(term="GO:8", line=7), annotation(negated=True, line=8),
    )
    result = compare_annotations(old, new, identities=identities(spark))
    got = {(r.term_id, r.kind): r for r in result.changes.collect()}
    assert set(got) == {("GO:1", "evidence_upgraded"), ("GO:2", "term_acquired"), ("GO:3", "annotation_removed"), ("GO:4", "evidence_changed")}
    up = got["GO:1", "evidence_upgraded"]
    assert (up.target_ids, up.old_evidence, up.new_evidence, up.projected_from, up.qualifies) == (["T0", "T1"], ["IEA"], ["IDA"], [], True)
    assert got["GO:2", "term_acquired"].projected_from == ["GO:9"] and got["GO:2", "term_acquired"].qualifies
    assert got["GO:3", "annotation_removed"].new_evidence == [] and not got["GO:4", "evidence_changed"].qualifies
    assert {r.target_id for r in result.selected_targets.collect()} == {"T0", "T1"}
    assert result.selected_sequence_ids.count() == 1 and result.count() == 4
    assert [r.term_id for r in result.ordered.collect()] == ["GO:1", "GO:2", "GO:3", "GO:4"]
    assert sorted((r.code, r.line) for r in result.report.issues.collect()) == [("NEGATED_ANNOTATION_IGNORED", 8), ("UNMAPPABLE_NEW_TERM", 7)]


def test_an_alias_of_two_sequences_is_an_error_for_each_later_match(spark):
    go = Ontology.of(spark, ["GO:1"])
    both = identities(spark, entries=(("P1", "ACD"), ("P1", "WWW")))
    one, two = snapshot(spark, "a", go, annotation()), snapshot(spark, "b", go, annotation(evidence="IDA"))
    with pytest.raises(ValidationError, match="AMBIGUOUS_SEQUENCE_ALIAS"):
        compare_annotations(one, two, identities=both)
    result = compare_annotations(one, two, identities=both, strict=False)
    assert [r.target_ids for r in result.changes.collect()] == [["T0", "T1"]]
    assert result.report.errors.count() == 1 and not result.report.is_valid


def test_a_merged_term_is_removed_and_acquired(spark):
    old_go = Ontology.of(spark, ["X", "Y"])
    new_go = Ontology.of(spark, [("Y", {"alternate_ids": ["X"]})])
    result = compare_annotations(snapshot(spark, "a", old_go, annotation(term="X")), snapshot(spark, "b", new_go, annotation(term="X")), identities=identities(spark))
    assert {(r.term_id, r.kind, tuple(r.projected_from)) for r in result.changes.collect()} == {("X", "annotation_removed", ()), ("Y", "term_acquired", ())}


def test_policies(spark):
    rows = spark.createDataFrame([(["IEA"], ["IDA"]), (["IEA", "IMP"], ["IDA"]), ([], ["IDA"]), (["XYZ"], ["EXP"]), (["IEA"], ["TAS"]), (["IEA"], [])], "old array<string>, new array<string>")
    policy = EvidencePolicy.experimental()
    assert [r[0] for r in rows.select(policy.is_upgrade(F.col("old"), F.col("new"))).collect()] == [True, False, False, True, False, False]
    assert [r[0] for r in rows.select(policy.accepts(F.col("new"))).collect()] == [True, True, True, True, False, False]
    own = EvidencePolicy("own", frozenset({"author_statement"}), frozenset({("electronic", "author_statement")}))
    assert [r[0] for r in rows.select(own.is_upgrade(F.col("old"), F.col("new"))).collect()] == [False, False, False, False, True, False]
    none = EvidencePolicy("none", frozenset(), frozenset())
    assert not any(r[0] or r[1] for r in rows.select(none.is_upgrade(F.col("old"), F.col("new")), none.accepts(F.col("new"))).collect())


def test_snapshot_checks_and_subjects(spark):
    go = Ontology.of(spark, [("GO:1", {"namespace": "molecular_function"}), "GO:2"])
    rows = [annotation(line=1), annotation(term="GO:2", line=2), annotation(term="GO:7", line=3), annotation(subject="P2", aspect="F", line=4)]
    table = spark.createDataFrame(rows, ANNOTATIONS)
    assert sorted((r.code, r.line) for r in consistency(table, go).collect()) == [("ANNOTATION_ASPECT_MISMATCH", 1), ("UNKNOWN_ANNOTATION_TERM", 3)]
    wanted = lambda *s: spark.createDataFrame([(x,) for x in s], "subject_id string")
    assert by_subjects(table, None).count() == 4 and by_subjects(table, wanted()).count() == 0
    assert [r.line for r in by_subjects(table, wanted("DB:P2", "XX:P1", "P2")).collect()] == [4]


def test_reading_a_snapshot(spark, tmp_path):
    from test_sources import OWL, row

    (tmp_path / "go.owl").write_text(OWL)
    (tmp_path / "a.gaf").write_text("!gaf-version: 2.2\n" + "\n".join([row(c5="GO:0040011", c9="P"), row(c2="P2", c5="GO:0070001", c9="F"), row(c2="P3", c9="X")]))
    paths = {"annotations": str(tmp_path / "a.gaf"), "ontology": str(tmp_path / "go.owl")}
    with pytest.raises(ValidationError) as e:
        AnnotationSnapshot.read(spark, release="r", **paths)
    assert [(i.code, i.line) for i in e.value.issues] == [("ANNOTATION_ASPECT_MISMATCH", 3), ("INVALID_GAF_ASPECT", 4)]
    subjects = spark.createDataFrame([("MGI:MGI:7",)], "subject_id string")
    got = AnnotationSnapshot.read(spark, release="r", subjects=subjects, strict=False, **paths)
    assert got.count() == 1 and [r.code for r in got.report.issues.collect()] == ["INVALID_GAF_ASPECT"]


def test_functions(spark):
    rows = spark.createDataFrame([("a c d u\x1c\x85",)], "s string")
    assert rows.select(normalize_sequence(F.col("s"))).first()[0] == "ACDU"
    with pytest.raises(Exception, match="ASCII"):
        spark.createDataFrame([("é",)], "s string").select(sequence_digest(F.col("s"))).collect()
    assert rows.select(parts_of(F.lit("|a||b|"))).first()[0] == ["a", "b"]


def test_reports(spark):
    report = Report.empty(spark)
    assert not report and report.is_valid
    report = report.warning("W", "careful", source="f")
    assert report and report.is_valid
    report = report.extend(Report.empty(spark).error("E", "wrong", source="f", line=3))
    assert not report.is_valid and report.warnings.count() == 1
    with pytest.raises(ValidationError) as e:
        report.raise_for_errors()
    assert str(e.value) == "f:3: error: E: wrong" and str(ValidationIssue("W", "m", "warning")) == "<unknown source>: warning: W: m"


def test_order_and_partitions_do_not_matter(spark):
    import os

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no tables")
    from termdrift.plans.testdata import Inputs

    def changes(change):
        x = Inputs(spark, "/root/testdata/sf0.001")
        x.__dict__["annotations"] = change(x.annotations)
        result = compare_annotations(x.old, x.new, identities=x.identities, strict=False)
        return sorted(map(str, result.changes.collect()))

    assert changes(lambda t: t) == changes(lambda t: t.orderBy(F.rand(3)).repartition(7))
