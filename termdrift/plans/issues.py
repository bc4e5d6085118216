"""Validation issues as a table, and the strict gate."""

from __future__ import annotations

from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termdrift.plans.stages import counted
from termdrift.schemas import ISSUES

ERROR, WARNING = "error", "warning"


class ValidationIssue(NamedTuple):
    code: str
    message: str
    severity: str
    source: str | None = None
    line: int | None = None

    def __str__(self) -> str:
        place = self.source or "<unknown source>"
        return f"{place if self.line is None else f'{place}:{self.line}'}: {self.severity}: {self.code}: {self.message}"


class ValidationError(ValueError):
    """Raised by strict operations.

    table holds all errors (ISSUES), count is their number. issues is all of them in order, fetched
    a partition at a time when it is first asked for. The message quotes the first QUOTED.
    """

    QUOTED = 100

    def __init__(self, table: DataFrame, count: int):
        self.table, self.count = table, count
        first = [_issue(r) for r in _in_order(table).limit(self.QUOTED).collect()]
        more = [] if count <= len(first) else [f"... {count} errors in all"]
        super().__init__("\n".join([*map(str, first), *more]))

    @cached_property
    def issues(self) -> tuple[ValidationIssue, ...]:
        return tuple(map(_issue, _in_order(self.table).toLocalIterator()))


def _issue(row) -> ValidationIssue:
    return ValidationIssue(row.code, row.message, row.severity, row.source, row.line)


def _in_order(table: DataFrame) -> DataFrame:
    return table.orderBy(F.col("line").asc_nulls_last(), F.col("ordinal").asc_nulls_last(), "code", "message")


def issue(code: str, message: Column | str, severity: str, source: Column | None = None, line: Column | None = None, when: Column | None = None) -> Column:
    """A struct with an issue's fields; null where when doesn't hold."""
    text = message if isinstance(message, Column) else F.lit(message)
    made = F.struct(
        F.lit(code).alias("code"), text.alias("message"), F.lit(severity).alias("severity"),
        (source if source is not None else F.lit(None).cast("string")).alias("source"),
        (line if line is not None else F.lit(None)).cast("bigint").alias("line"),
    )
    return made if when is None else F.when(when, made)


def issue_rows(df: DataFrame, *found: Column, order: Column | None = None) -> DataFrame:
    """The issues among found of each row: all rules in one pass over df."""
    some = F.filter(F.array(*found), lambda x: x.isNotNull())
    rows = df.select((order if order is not None else F.lit(None)).cast("bigint").alias("ordinal"), F.explode(some).alias("i"))
    return rows.select("i.*", "ordinal")


class Report:
    """The issues of an operation, a lazily evaluated table (ISSUES), to which more may be added."""

    def __init__(self, issues: DataFrame):
        self.issues = issues

    @classmethod
    def empty(cls, spark: SparkSession) -> Report:
        return cls(spark.createDataFrame([], ISSUES))

    @classmethod
    def of(cls, *tables: DataFrame) -> Report:
        return cls(reduce(DataFrame.unionByName, tables))

    def copy(self) -> Report:
        return Report(self.issues)

    def extend(self, other: Report) -> Report:
        """Adds the other report's issues (as bags); returns this one."""
        self.issues = self.issues.unionByName(other.issues)
        return self

    def add(self, code: str, message: str, severity: str, *, source: str | None = None, line: int | None = None) -> Report:
        one = self.issues.sparkSession.createDataFrame([(code, message, severity, source, line, None)], ISSUES)
        return self.extend(Report(one))

    @classmethod
    def into(cls, report: Report | None, found: Report) -> Report:
        """What was found, added to the report that a caller collects in, if there is one."""
        return found if report is None else report.extend(found)

    def error(self, code: str, message: str, **place) -> Report:
        return self.add(code, message, ERROR, **place)

    def warning(self, code: str, message: str, **place) -> Report:
        return self.add(code, message, WARNING, **place)

    @property
    def errors(self) -> DataFrame:
        return self.issues.where(F.col("severity") == ERROR)

    @property
    def warnings(self) -> DataFrame:
        return self.issues.where(F.col("severity") == WARNING)

    @property
    def is_valid(self) -> bool:
        return self.errors.isEmpty()

    def __bool__(self) -> bool:
        return not self.issues.isEmpty()

    def raise_for_errors(self, *, first: bool = False) -> None:
        """The strict gate: all errors are written once, and raise if there are any.

        first: only the errors of the first line that has any.
        """
        table, count = counted(self.errors)
        if count and first:
            table = table.where(F.col("line").eqNullSafe(F.lit(table.agg(F.min("line")).first()[0])))
            count = table.count()
        if count:
            raise ValidationError(table, count)
