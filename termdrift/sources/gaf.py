"""GAF 2.x annotation files as records, metadata and issues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termdrift.functions.text import parts_of, strip
from termdrift.plans.issues import ERROR, WARNING, Report, issue, issue_rows

from .files import Source, encoding_issues, numbered_lines

# The columns in order, and the aspects.
COLUMNS = (
    "database", "subject_id", "symbol", "qualifier", "term_id", "references", "evidence", "with_from", "aspect", "name",
    "synonyms", "object_type", "taxa", "date", "assigned_by", "extensions", "gene_product_form_id",
)
LISTS = ("references", "with_from", "synonyms", "taxa", "extensions")
ASPECTS = ("F", "P", "C")


def annotation_rows(lines: DataFrame) -> DataFrame:
    """Lines (source, line, value) that are rows, with the annotation's columns, the number of
    columns (n) and the relations named. A projection: it holds for streams as well."""
    rows = lines.where((F.col("value") != "") & ~F.col("value").startswith("!"))
    rows = rows.withColumn("c", F.split("value", "\t", -1)).withColumn("n", F.size("c"))
    cell = lambda i: F.coalesce(F.get("c", F.lit(i)), F.lit(""))
    fields = {name: parts_of(cell(i)) if name in LISTS else cell(i) for i, name in enumerate(COLUMNS) if name != "qualifier"}
    qualifier = parts_of(cell(COLUMNS.index("qualifier")))
    relations = F.array_remove(qualifier, "NOT")
    return rows.select(
        "source", "line", "n", relations.alias("relations"), F.array_contains(qualifier, "NOT").alias("negated"),
        F.when(F.size(relations) == 1, relations[0]).otherwise("").alias("relation"), *(v.alias(k) for k, v in fields.items()),
    )


def row_issues() -> list[Column]:
    """The rules for a row of annotation_rows, in the order in which they report."""
    place = {"source": F.col("source"), "line": F.col("line")}
    whole = F.col("n") == len(COLUMNS)
    told = lambda text, column: F.concat(F.lit(f"{text}: "), column)
    return [
        issue("INVALID_GAF_COLUMN_COUNT", told(f"{len(COLUMNS)} columns expected, found", F.col("n").cast("string")), ERROR, **place, when=~whole),
        issue("MULTIPLE_GAF_RELATIONS", told("several relations", F.array_join("relations", ", ")), ERROR, **place, when=whole & (F.size("relations") > 1)),
        issue("INVALID_GAF_ASPECT", told("no such aspect", F.col("aspect")), ERROR, **place, when=whole & ~F.col("aspect").isin(*ASPECTS)),
        issue("INVALID_GO_IDENTIFIER", told("no GO identifier", F.col("term_id")), ERROR, **place, when=whole & ~F.col("term_id").startswith("GO:")),
        issue("MISSING_EVIDENCE_CODE", "the evidence column is empty", ERROR, **place, when=whole & (F.col("evidence") == "")),
        issue("NONSTANDARD_GAF_DATE", told("not eight digits", F.col("date")), WARNING, **place, when=whole & (F.col("date") != "") & ~F.col("date").rlike(r"(?U)^\d{8}\z")),
    ]


def accepted_rows(rows: DataFrame) -> DataFrame:
    """The rows without an error of their own, as ANNOTATIONS."""
    errors = F.exists(F.array(*row_issues()), lambda i: i.isNotNull() & (i["severity"] == ERROR))
    names = ["database", "subject_id", "symbol", "relation", "term_id", "negated"]
    names += [c for c in COLUMNS if c not in (*names, "qualifier")]
    return rows.where(~errors).select(*names, "source", "line")


def metadata(lines: DataFrame) -> DataFrame:
    """key, value and line of the header lines "!key: value" anywhere in the file; a key's last one counts."""
    head = lines.where(F.col("value").startswith("!") & F.contains(F.col("value"), F.lit(":")))
    body = F.substr(F.col("value"), F.lit(2))
    key = F.lower(strip(F.substring_index(body, ":", 1)))
    value = strip(F.regexp_replace(body, r"(?s)^[^:]*:", ""))
    return head.select(key.alias("key"), value.alias("value"), "line").groupBy("key").agg(F.max_by("value", "line").alias("value"), F.max("line").alias("line"))


@dataclass(frozen=True)
class GafFile:
    """What a file holds: annotations, metadata (key, value, line) and the report."""

    annotations: DataFrame
    metadata: DataFrame
    report: Report


class GafReader:
    """Reads annotation files."""

    def read(self, spark: SparkSession, source: Source | str, *, report: Report | None = None, strict: bool = True) -> GafFile:
        """What the file holds; found issues are added to report, if given.

        strict: the errors of the first faulty line raise; a missing or old version raises last.
        """
        source = Source.of(source)
        out = self.of_lines(numbered_lines(spark, source), source.name)
        out = GafFile(out.annotations, out.metadata, Report.into(report, out.report))
        if strict:
            out.report.raise_for_errors(first=True)
        return out

    def iter_records(self, spark: SparkSession, source: Source | str, *, report: Report | None = None, strict: bool = True) -> DataFrame:
        """The annotations alone (the record parsers' common form)."""
        return self.read(spark, source, report=report, strict=strict).annotations

    parse = iter_records

    def of_lines(self, lines: DataFrame, name: str) -> GafFile:
        """The same for numbered lines of the file name."""
        rows = annotation_rows(lines)
        meta = metadata(lines)
        version = meta.where("key = 'gaf-version'").agg(F.max("value").alias("version"))
        place = {"source": F.lit(name)}
        header = issue_rows(
            version,
            issue("MISSING_GAF_VERSION", "no !gaf-version line", ERROR, **place, when=F.col("version").isNull()),
            issue("UNSUPPORTED_GAF_VERSION", F.concat(F.lit("not a 2.x version: "), "version"), ERROR, **place, when=~F.col("version").startswith("2")),
        )
        return GafFile(accepted_rows(rows), meta, Report.of(encoding_issues(lines), issue_rows(rows, *row_issues()), header))
