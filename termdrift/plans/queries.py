"""One query for each operator, over the derived inputs; oracle.py has each as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdrift.functions.evidence import EvidencePolicy
from termdrift.functions.text import header_identifier, normalize_sequence, sequence_id
from termdrift.operators import compare as C
from termdrift.operators.identity import SequenceIndex, targets_by_sequence
from termdrift.operators.snapshot import by_subjects, consistency
from termdrift.operators.ontology import Ontology
from termdrift.operators.snapshot import AnnotationSnapshot
from termdrift.plans.stages import cut, scratch, shuffles_dropped
from termdrift.plans.testdata import OWL_HEAD, Inputs, term_name
from termdrift.sources.fasta import FastaReader
from termdrift.sources.files import Source, checksums
from termdrift.sources.gaf import LISTS, GafReader, accepted_rows, annotation_rows, metadata, row_issues
from termdrift.plans.issues import issue_rows

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
#: A policy of a user's own: reviewed statements count, too.
REVIEWED = EvidencePolicy(
    "reviewed",
    frozenset({"experimental", "author_statement"}),
    frozenset({("electronic", "author_statement"), ("unknown", "experimental"), ("computational", "phylogenetic")}),
)


def query(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Inputs(spark, sf_dir))) for name, f in QUERIES.items()}


def text(column: str):
    """A set as text, as results are compared by value."""
    return F.array_join(F.col(column), "|").alias(column)


def told(issues: DataFrame, column: str, *always: str) -> DataFrame:
    """column (the code) and n, the number of its issues; codes of always have a row if there are none, too."""
    none = issues.sparkSession.createDataFrame([(c,) for c in always], "code string").select("code", F.lit(0).alias("one"))
    rows = issues.select("code", F.lit(1).alias("one")).union(none)
    return rows.groupBy(F.col("code").alias(column)).agg(F.sum("one").alias("n"))


@query
def compare_changes(x: Inputs) -> DataFrame:
    changes = C.compare_annotations(x.old, x.new, identities=x.identities, strict=False).changes
    return changes.select("sequence_id", text("target_ids"), "term_id", "relation", "aspect", "kind", text("old_evidence"), text("new_evidence"), text("projected_from"), "qualifies")


@query
def compare_changes_reviewed(x: Inputs) -> DataFrame:
    changes = C.compare_annotations(x.old, x.new, identities=x.identities, evidence_policy=REVIEWED, strict=False).changes
    return changes.select("sequence_id", "term_id", "relation", "aspect", "kind", "qualifies")


@query
def compare_issues(x: Inputs) -> DataFrame:
    report = C.compare_annotations(x.old, x.new, identities=x.identities, strict=False).report
    return report.issues.groupBy("code", "severity", "source", "line").agg(F.count(F.lit(1)).alias("n"))


@query
def selected_sequences(x: Inputs) -> DataFrame:
    return C.compare_annotations(x.old, x.new, identities=x.identities, strict=False).selected_sequence_ids


@query
def selected_targets(x: Inputs) -> DataFrame:
    return C.compare_annotations(x.old, x.new, identities=x.identities, strict=False).selected_targets


@query
def assertions_old(x: Inputs) -> DataFrame:
    return C.old_assertions(x.old, C.subject_map(x.identities.matches)[0])[0].select(*C.KEY, text("evidence"))


@query
def assertions_new(x: Inputs) -> DataFrame:
    return C.new_assertions(x.old, x.new, C.subject_map(x.identities.matches)[0])[0].select(*C.KEY, text("evidence"), text("projected_from"))


@query
def seq_normalize_digest(x: Inputs) -> DataFrame:
    spaced = F.regexp_replace("sequence", "([aeiou])", "$1 ")
    rows = x.sequences.select("doc_id", spaced.alias("s"))
    return rows.select("doc_id", F.length(normalize_sequence(F.col("s"))).alias("seq_len"), sequence_id(F.col("s")).alias("sequence_id"))


@query
def seq_header_identifier(x: Inputs) -> DataFrame:
    heads = x.fasta_lines.where(F.col("value").startswith(">"))
    return heads.select("line", header_identifier(F.substr("value", F.lit(2))).alias("identifier"))


@query
def identity_match(x: Inputs) -> DataFrame:
    aliases = F.array_join(F.transform("aliases", lambda a: F.concat_ws("@", a["identifier"], a["source"])), "|")
    return x.identities.matches.select("target_id", "sequence_id", aliases.alias("aliases"), "ordinal")


@query
def identity_unmatched(x: Inputs) -> DataFrame:
    return x.identities.unmatched


@query
def identity_subject_ids(x: Inputs) -> DataFrame:
    return x.identities.subject_ids


@query
def identity_aliases_for(x: Inputs) -> DataFrame:
    wanted = x.identities.matches.agg(F.min("sequence_id")).first()[0]
    return x.identities.aliases_for(wanted)


@query
def index_size(x: Inputs) -> DataFrame:
    return x.index.size()


@query
def index_of_one_release(x: Inputs) -> DataFrame:
    rows = x.sequences.withColumn("identifier", F.concat(F.lit("P"), "doc_id"))
    return SequenceIndex.of(rows, "only").match(x.targets).matches.select("target_id", F.size("aliases").alias("n_aliases"))


@query
def subject_first_sequence(x: Inputs) -> DataFrame:
    return C.subject_map(x.identities.matches)[0]


@query
def ambiguous_alias(x: Inputs) -> DataFrame:
    return C.subject_map(x.identities.matches)[1].groupBy("code", "ordinal").agg(F.count(F.lit(1)).alias("n"))


@query
def targets_of_sequences(x: Inputs) -> DataFrame:
    return targets_by_sequence(x.identities.matches).select("sequence_id", text("target_ids"))


@query
def subject_filter_qualified(x: Inputs) -> DataFrame:
    plain = x.sequences.where("doc_id % 9 = 0").select(F.concat(F.lit("P"), "doc_id").alias("subject_id"))
    full = x.sequences.where("doc_id % 9 = 1").select(F.concat(F.lit("DB:P"), "doc_id").alias("subject_id"))
    other = x.sequences.where("doc_id % 9 = 2").select(F.concat(F.lit("XX:P"), "doc_id").alias("subject_id"))
    return by_subjects(x.annotations, plain.union(full).union(other)).select("subject_id", "term_id", "source", "line")


@query
def fasta_first_valid(x: Inputs) -> DataFrame:
    records = FastaReader().records(x.fasta_lines)[0]
    return records.select("identifier", F.sha2("sequence", 256).alias("digest"), "description", "line")


@query
def fasta_issues(x: Inputs) -> DataFrame:
    return FastaReader().records(x.fasta_lines)[1].issues.select("code", "severity", "source", "line")


@query
def gaf_rows(x: Inputs) -> DataFrame:
    rows = accepted_rows(annotation_rows(x.gaf_lines))
    return rows.select("subject_id", "relation", "negated", "term_id", text("references"), text("synonyms"), "evidence", "aspect", "date", "line")


@query
def gaf_row_issues(x: Inputs) -> DataFrame:
    return issue_rows(annotation_rows(x.gaf_lines), *row_issues()).select("code", "severity", "source", "line")


@query
def gaf_metadata_last_wins(x: Inputs) -> DataFrame:
    return metadata(x.gaf_lines)


@query
def resolve_ids(x: Inputs) -> DataFrame:
    ids = x.numbers.select(term_name(F.col("n")).alias("term_id"))
    return x.old_ontology.resolve_ids(ids)


@query
def onto_parents(x: Inputs) -> DataFrame:
    ids = x.annotations.select("term_id")
    return x.new_ontology.parents_of(ids)


@query
def onto_edges_grouped(x: Inputs) -> DataFrame:
    return x.new_ontology.grouped_edges().select("child", "relation", text("parents"))


@query
def onto_ancestors(x: Inputs) -> DataFrame:
    ids = x.annotations.select("term_id")
    return x.new_ontology.ancestors_of(ids)


@query
def onto_propagate(x: Inputs) -> DataFrame:
    ids = x.annotations.where("is_old").select("term_id")
    return x.new_ontology.propagate(ids, relations=("is_a",))


@query
def onto_projection(x: Inputs) -> DataFrame:
    return x.old_ontology.project_from(x.new_ontology, x.annotations.select("term_id"))


@query
def onto_validate(x: Inputs) -> DataFrame:
    return x.old_ontology.validate().issues.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))


@query
def onto_cycle(x: Inputs) -> DataFrame:
    n = F.col("n")
    back = x.numbers.where("n = 1").select(term_name(n).alias("child"), F.lit("part_of").alias("relation"), term_name(n * 5).alias("parent"))
    looped = Ontology(x.new_ontology.terms, x.new_ontology.edges.union(back))
    rows = [("as it is", x.new_ontology.has_cycle()), ("with an edge back", looped.has_cycle())]
    return x.spark.createDataFrame(rows, "ontology string, has_cycle boolean")


@query
def snapshot_validate(x: Inputs) -> DataFrame:
    return consistency(x.new.annotations, x.new_ontology).select("code", "severity", "source", "line")


def _evidence_sets(x: Inputs) -> DataFrame:
    sets = x.annotations.groupBy("subject_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("is_old"), F.col("evidence")))).alias("was"),
        F.array_sort(F.collect_set(F.when(~F.col("is_old"), F.col("evidence")))).alias("now"),
    )
    return sets


@query
def evidence_category(x: Inputs) -> DataFrame:
    codes = x.annotations.select("evidence").distinct()
    return codes.select("evidence", EvidencePolicy.experimental().category(F.col("evidence")).alias("category"))


@query
def evidence_accepts(x: Inputs) -> DataFrame:
    policy = EvidencePolicy.experimental()
    return _evidence_sets(x).select("subject_id", policy.accepts(F.col("was")).alias("accepted"), REVIEWED.accepts(F.col("was")).alias("reviewed"))


@query
def evidence_upgrade(x: Inputs) -> DataFrame:
    policy = EvidencePolicy.experimental()
    was, now = F.col("was"), F.col("now")
    return _evidence_sets(x).select("subject_id", policy.is_upgrade(was, now).alias("upgrade"), REVIEWED.is_upgrade(was, now).alias("reviewed"))


# What follows reads files: the derived inputs are written as such first.


@query
def files_fasta_records(x: Inputs) -> DataFrame:
    return FastaReader().read(x.spark, x.fasta_file, strict=False)[0].drop("source")


@query
def files_fasta_issues(x: Inputs) -> DataFrame:
    return FastaReader().read(x.spark, x.fasta_file, strict=False)[1].issues.select("code", "message", "severity", "line")


@query
def files_gaf_annotations(x: Inputs) -> DataFrame:
    rows = GafReader().read(x.spark, x.gaf_file, strict=False).annotations
    rows = rows.withColumns({c: F.array_join(F.col(c), "|") for c in LISTS})
    return rows.withColumn("has_source", F.col("source") == x.gaf_file).drop("source")


@query
def files_gaf_issues(x: Inputs) -> DataFrame:
    return GafReader().read(x.spark, x.gaf_file, strict=False).report.issues.select("code", "severity", "message", "line")


@query
def files_gaf_metadata(x: Inputs) -> DataFrame:
    return GafReader().read(x.spark, x.gaf_file, strict=False).metadata


@query
def files_gaf_versions(x: Inputs) -> DataFrame:
    found = None
    for name, line in (("none", "! a remark"), ("one", "!gaf-version: 1.0")):
        report = GafReader().read(x.spark, x.put(f"{name}.gaf", x.lines(line), "at"), strict=False).report
        one = report.errors.select(F.lit(name).alias("file"), "code", "line")
        found = one if found is None else found.union(one)
    return found


@query
def files_lines(x: Inputs) -> DataFrame:
    """Plain and compressed files as numbered lines."""
    found = None
    numbers = x.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("value"))
    packed = x.put("all.txt.gz", numbers.select(F.col("value").alias("at"), F.col("value").cast("string").alias("value")), "at")
    for name, path in (("faulty.gaf", x.gaf_file), ("all.txt.gz", packed)):
        source = Source.of(path)
        counts = source.open_text(x.spark).agg(F.count(F.lit(1)).alias("n"), F.max("line").alias("last"))
        one = counts.select(F.lit(name).alias("file"), F.lit(source.is_gzip).alias("is_gzip"), "n", "last")
        found = one if found is None else found.union(one)
    return found


@query
def files_checksum(x: Inputs) -> DataFrame:
    """The digests of files with 10,000 keys each."""
    tables = (("orders", "o_orderkey", ("o_custkey", "o_orderstatus")), ("customer", "c_custkey", ("c_name",)), ("part", "p_partkey", ("p_name",)), ("supplier", "s_suppkey", ("s_name",)))
    rows = None
    for name, key, others in tables:
        one = x.table(name).select(F.lit(name).alias("name"), F.expr(f"{key} div 10000").alias("bucket"), F.col(key).cast("long").alias("key"), F.concat_ws(" ", key, *others).alias("value"))
        rows = one if rows is None else rows.union(one)
    folder = scratch(x.spark, "files")
    rows.repartition("name", "bucket").sortWithinPartitions("name", "bucket", "key").drop("key").write.partitionBy("name", "bucket").text(folder)
    found = checksums(x.spark, [f"{folder}/*/*/part-*"])
    part = lambda k: F.regexp_extract("path", f"/{k}=([^/]*)/", 1)
    return found.select(F.concat_ws("/", part("name"), part("bucket")).alias("name"), F.col("digest").alias("sha256"), "length")


@query
def files_binary(x: Inputs) -> DataFrame:
    """The decompressed bytes of a file, digested chunk by chunk in order."""
    import hashlib

    numbers = x.table("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    path = x.put("all.txt.gz", numbers.select("at", F.col("at").cast("string").alias("value")), "at")
    digest = hashlib.sha256()
    for row in Source.of(path).open_binary(x.spark).orderBy("chunk").select("content").toLocalIterator():
        digest.update(row.content)
    return x.spark.createDataFrame([(digest.hexdigest(),)], "sha256 string")


@query
def files_owl_terms(x: Inputs) -> DataFrame:
    read = Ontology.from_owl(x.spark, x.ontology_file("new.owl", x.new_ontology), strict=False)[0]
    return read.terms.select("identifier", "label", "namespace", "obsolete", text("alternate_ids"), F.lit(read.release).alias("release"))


@query
def files_owl_edges(x: Inputs) -> DataFrame:
    return Ontology.from_owl(x.spark, x.ontology_file("new.owl", x.new_ontology), strict=False)[0].edges


@query
def files_owl_faults(x: Inputs) -> DataFrame:
    head = OWL_HEAD.format(release="x")
    rows = []
    for name, body in (("broken", head), ("empty", f"{head}\n</r:RDF>"), ("none", None)):
        path = x.put(f"{name}.owl", x.lines(*body.split("\n")), "at") if body else scratch(x.spark, "no-such-file")
        read, report = Ontology.from_owl(x.spark, path, strict=False)
        rows += [(name, r.code, read.count()) for r in report.errors.select("code").collect()]
    return x.spark.createDataFrame(rows, "file string, code string, n_terms int")


@query
def files_snapshot(x: Inputs) -> DataFrame:
    """Sizes and issue counts of a snapshot read for the matched subjects."""
    subjects = cut(x.identities.subject_ids)  # before there are files, as matching shuffles sequences
    read = AnnotationSnapshot.read(
        x.spark, release="new", annotations=x.annotation_file("new.gaf", x.new), ontology=x.ontology_file("new.owl.gz", x.new_ontology), subjects=subjects, strict=False, every_claim=True
    )
    with shuffles_dropped(x.spark):
        sizes = x.spark.createDataFrame([("annotations", read.count()), ("terms", read.ontology.count())], "what string, n long")
    return sizes.union(told(read.report.issues, "what", "MISSING_GO_ROOTS"))


@query
def files_compare(x: Inputs) -> DataFrame:
    """The comparison from files to changes."""
    identities, old, new = x.snapshots_of_files
    changes = C.compare_annotations(old, new, identities=identities, strict=False).changes
    return changes.select("sequence_id", text("target_ids"), "term_id", "relation", "aspect", "kind", text("old_evidence"), text("new_evidence"), text("projected_from"), "qualifies")


@query
def changes_in_order(x: Inputs) -> DataFrame:
    """The changes as they are ordered, each with its place."""
    ordered = C.compare_annotations(x.old, x.new, identities=x.identities, strict=False).ordered
    return ordered.select(*C.KEY, "kind").rdd.zipWithIndex().map(lambda r: (r[1] + 1, *r[0])).toDF("place long, sequence_id string, term_id string, relation string, aspect string, kind string")


@query
def onto_contains(x: Inputs) -> DataFrame:
    """Single identifiers looked up."""
    names = [f"GO:{n:07}" for n in range(7)]
    rows = [(n, n in x.old_ontology and x.old_ontology.term(n).count() == 1) for n in names if n in x.new_ontology]
    return x.spark.createDataFrame(rows, "term_id string, known boolean")


@query
def onto_last_terms(x: Inputs) -> DataFrame:
    """Terms given twice, alternates claimed by several: the last one counts."""
    n = F.col("n")
    first = x._terms(x.numbers, F.array(F.lit("GO:7000000"))).withColumn("label", F.lit("first")).withColumn("ordinal", F.substring("identifier", 4, 7).cast("long"))
    last = x._terms(x.numbers.where(n % 2 == 0), F.array(term_name(7_000_000 + n % 3))).withColumn("label", F.lit("last"))
    last = last.withColumn("ordinal", F.substring("identifier", 4, 7).cast("long") + 10_000_000_000)
    both = Ontology(first.unionByName(last))
    labels = both.terms.select(F.col("identifier").alias("any_id"), "label")
    return both.resolve.join(labels, "any_id", "left").select("any_id", "canonical_id", F.coalesce("label", F.lit("")).alias("label"))


@query
def onto_faults(x: Inputs) -> DataFrame:
    """Every term but the first has the one before it as an alternate, and the first two are each other's parents."""
    n = F.col("n")
    terms = x._terms(x.numbers, F.when(n >= 1, F.array(term_name(n - 1))).otherwise(F.array().cast("array<string>")))
    edges = x.numbers.where("n < 2").select(term_name(n).alias("child"), F.lit("is_a").alias("relation"), term_name(1 - n).alias("parent"))
    return told(Ontology(terms, edges).validate().issues, "code", "AMBIGUOUS_ALTERNATE_ID", "MISSING_GO_ROOTS")
