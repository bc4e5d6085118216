"""Ontologies in OWL (RDF/XML), read by their triples, so that prefixes and layout don't matter."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termdrift.functions.text import literal_id, obo_id, relation_name
from termdrift.plans.issues import Report
from termdrift.plans.stages import cut, forget
from termdrift.schemas import EDGES, TERMS

from .files import Source, listed, opened
from .rdfxml import BLANK, LITERAL, RDF, URI, triples

# Namespaces and the properties that are read.
RDFS, OWL = "http://www.w3.org/2000/01/rdf-schema#", "http://www.w3.org/2002/07/owl#"
OBO, OBO_IN_OWL = "http://purl.obolibrary.org/obo/", "http://www.geneontology.org/formats/oboInOwl#"
TYPE, LABEL, SUBCLASS = RDF + "type", RDFS + "label", RDFS + "subClassOf"
NAMESPACE, ALTERNATE, CONSIDER, REPLACED = OBO_IN_OWL + "hasOBONamespace", OBO_IN_OWL + "hasAlternativeId", OBO_IN_OWL + "consider", OBO + "IAO_0100001"
DEPRECATED, ON, SOME, VERSION = OWL + "deprecated", OWL + "onProperty", OWL + "someValuesFrom", OWL + "versionIRI"
READ = frozenset({TYPE, LABEL, SUBCLASS, NAMESPACE, ALTERNATE, CONSIDER, REPLACED, DEPRECATED, ON, SOME, VERSION})
ERROR = "error"


def read_triples(spark: SparkSession, source: Source) -> DataFrame:
    """ordinal, s, p, o and kind of the triples with a property of READ; a last row of kind error if the file is broken.

    A task streams the file: an ontology is one document, whose end may refer to its start.
    """

    def run(batches):
        def batch(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.string()] * 4))], names=["ordinal", "s", "p", "o", "kind"])

        for path in (p for b in batches for p in b.column(0).to_pylist()):
            n, rows = 0, []
            try:
                with opened(path) as stream:
                    for found in triples(iter(lambda: stream.read(1 << 20), b"")):  # noqa: B023
                        for t in found:
                            n += 1
                            if t[1] in READ:
                                rows.append((n, *t))
                        if len(rows) >= 10_000:
                            yield batch(rows)
                            rows = []
            except Exception as e:  # not well formed, no gzip, not readable: the document is broken
                rows.append((n + 1, "", "", str(e), ERROR))
            yield batch(rows)

    return listed(spark, source.path).select("path").mapInArrow(run, "ordinal bigint, s string, p string, o string, kind string")


def _id() -> Column:
    """The identifier that an object names, if it names one."""
    return F.when(F.col("kind") == URI, obo_id(F.col("o"))).when(F.col("kind") == LITERAL, literal_id(F.col("o")))


def read_owl(spark: SparkSession, source: Source | str) -> tuple[DataFrame, DataFrame, str | None, Report]:
    """terms (with ordinal), edges, release and report of an ontology file.

    Terms are the named classes with a GO identifier. Of several labels or namespaces the first in
    the document counts, of classes with one identifier the last. Parents are subClassOf resources
    (is_a) and restrictions that name a property and a class it has some values from (that
    property). A file that can't be read or isn't well formed gives empty tables and INVALID_OWL.
    """
    source = Source.of(source)
    broken, rows = None, None
    try:
        rows = cut(read_triples(spark, source))
        found = rows.where(F.col("kind") == ERROR).first()
        broken = found.o if found else None
    except AnalysisException as e:  # there is no such file
        broken = str(e).strip().split("\n")[0]
    if broken is not None:
        report = Report.empty(spark).error("INVALID_OWL", f"the document can't be read: {broken[:200]}", source=source.name)
        return spark.createDataFrame([], TERMS), spark.createDataFrame([], EDGES), None, report

    is_a = lambda p: F.col("p") == p
    classes = rows.where(is_a(TYPE) & (F.col("o") == OWL + "Class") & ~F.col("s").startswith("_:")).groupBy("s").agg(F.min("ordinal").alias("at"))
    classes = classes.withColumn("identifier", obo_id(F.col("s"))).where(F.col("identifier").startswith("GO:"))
    # Of nodes with one identifier the last one is the term.
    nodes = classes.groupBy("identifier").agg(F.max_by("s", "at").alias("s"), F.max("at").alias("at"))
    said = rows.join(nodes, "s")
    first = lambda p: F.coalesce(F.min_by("o", F.when(is_a(p), F.col("ordinal"))), F.lit(""))
    every = lambda p, v: F.array_distinct(
        F.transform(F.array_sort(F.collect_list(F.when(is_a(p) & v.isNotNull(), F.struct("ordinal", v.alias("v"))))), lambda x: x["v"])
    )
    terms = said.groupBy("identifier").agg(
        first(LABEL).alias("label"), first(NAMESPACE).alias("namespace"), (F.lower(first(DEPRECATED)) == "true").alias("obsolete"),
        every(ALTERNATE, F.col("o")).alias("alternate_ids"), every(REPLACED, _id()).alias("replaced_by"), every(CONSIDER, _id()).alias("consider"), F.max("at").alias("ordinal"),
    )
    ups = said.where(is_a(SUBCLASS)).select(F.col("identifier").alias("child"), "o", "kind")
    plain = ups.where(F.col("kind") == URI).select("child", F.lit("is_a").alias("relation"), obo_id(F.col("o")).alias("parent"))
    limits = rows.where(F.col("p").isin(ON, SOME)).groupBy("s").agg(
        relation_name(F.min_by(_id(), F.when(is_a(ON), F.col("ordinal")))).alias("relation"), F.min_by(_id(), F.when(is_a(SOME), F.col("ordinal"))).alias("parent")
    )
    some = ups.where(F.col("kind") == BLANK).join(limits, F.col("o") == F.col("s")).select("child", "relation", "parent")
    edges = plain.union(some).where(F.col("relation").isNotNull() & F.col("parent").startswith("GO:")).distinct()
    release = rows.where(is_a(VERSION)).agg(F.min_by("o", "ordinal")).first()[0]
    terms, edges = cut(terms), cut(edges)
    forget(spark, rows.written_at)
    report = Report.empty(spark)
    if terms.isEmpty():
        report.error("EMPTY_GO_ONTOLOGY", "there are no GO classes", source=source.name)
    return terms, edges, release, report
