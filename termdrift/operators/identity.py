"""Exact identity of protein sequences between targets and historical releases."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdrift.functions.text import normalize_sequence, normalized_digest
from termdrift.plans.issues import Report
from termdrift.plans.stages import cut, forget
from termdrift.sources.fasta import FastaReader
from termdrift.sources.files import Source


@dataclass(frozen=True)
class SequenceDataset:
    """Sequence records (SEQUENCES) and the report of reading them."""

    records: DataFrame
    report: Report

    @classmethod
    def read(cls, spark: SparkSession, source: Source | str, *, strict: bool = True, empty: bool = False) -> SequenceDataset:
        """empty: as of FastaReader."""
        return cls(*FastaReader(empty=empty).read(spark, source, strict=strict))

    @property
    def validation(self) -> Report:
        return self.report

    def count(self) -> int:
        return self.records.count()


def keyed(sequences: DataFrame) -> DataFrame:
    """sequences with the normalized sequence, its hash and its length: the key of a match."""
    plain = normalize_sequence(F.col("sequence"))
    out = sequences.withColumn("sequence", plain)
    return out.withColumn("seq_hash", normalized_digest(F.col("sequence"))).withColumn("seq_len", F.length("sequence"))


KEY = ["seq_hash", "seq_len", "sequence"]


@dataclass(frozen=True)
class IdentityMap:
    """matches (MATCHES) and unmatched (target_id, ordinal), each in the targets' order by ordinal."""

    matches: DataFrame
    unmatched: DataFrame

    @property
    def subject_ids(self) -> DataFrame:
        """subject_id: the matched targets and their aliases."""
        own = self.matches.select(F.col("target_id").alias("subject_id"))
        return own.union(self.matches.select(F.explode("aliases.identifier"))).distinct()

    def aliases_for(self, sequence_id: str) -> DataFrame:
        """identifier and source of a sequence's aliases, in order."""
        rows = self.matches.where(F.col("sequence_id") == sequence_id).select(F.explode("aliases").alias("a"))
        return rows.select("a.identifier", "a.source").distinct().orderBy("identifier", "source")


class SequenceIndex:
    """Sequences of releases: sequence, identifier and alias_source, repeats allowed."""

    def __init__(self, entries: DataFrame, report: Report):
        self.entries, self.report = entries, report

    @classmethod
    def from_fasta(cls, spark: SparkSession, source: Source | str, *, source_name: str | None = None, strict: bool = True, empty: bool = False) -> SequenceIndex:
        """empty: as of FastaReader."""
        source = Source.of(source)
        records, report = FastaReader(empty=empty).read(spark, source, strict=strict)
        return cls.of(records, source_name or source.name, report)

    @classmethod
    def from_fastas(cls, spark: SparkSession, sources: Mapping[str, Source | str], *, strict: bool = True) -> SequenceIndex:
        """An index over several releases, each under its name."""
        out = cls.empty(spark)
        for name, source in sources.items():
            out.add_fasta(source, source_name=name, strict=strict)
        return out

    @classmethod
    def of(cls, records: DataFrame, source_name: str, report: Report | None = None) -> SequenceIndex:
        """An index over records (identifier, sequence) of one release."""
        entries = records.select("sequence", "identifier", F.lit(source_name).alias("alias_source"))
        return cls(entries, report or Report.empty(records.sparkSession))

    @classmethod
    def empty(cls, spark: SparkSession) -> SequenceIndex:
        return cls(spark.createDataFrame([], "sequence string, identifier string, alias_source string"), Report.empty(spark))

    @property
    def validation(self) -> Report:
        return self.report

    def union(self, other: SequenceIndex) -> SequenceIndex:
        return SequenceIndex(self.entries.unionByName(other.entries), self.report.copy().extend(other.report))

    def add(self, identifier: str, sequence: str, *, source: str) -> None:
        """One more entry."""
        row = self.entries.sparkSession.createDataFrame([(sequence, identifier, source)], "sequence string, identifier string, alias_source string")
        self.entries = self.entries.unionByName(row)

    def add_fasta(self, source: Source | str, *, source_name: str | None = None, strict: bool = True, empty: bool = False) -> None:
        """The entries of one more file, under its own name or the given one."""
        one = self.from_fasta(self.entries.sparkSession, source, source_name=source_name, strict=strict, empty=empty)
        self.entries = self.entries.unionByName(one.entries)
        self.report.extend(one.report)

    def count(self) -> int:
        """The number of different sequences."""
        return self.size().first()[0]

    def size(self) -> DataFrame:
        return self.entries.select(F.count_distinct(normalize_sequence(F.col("sequence"))).alias("n_sequences"))

    def match(self, targets: DataFrame, ordinal: str | None = "line") -> IdentityMap:
        """Targets (identifier, sequence, and ordinal, their order) by exact sequence.

        Only entries whose key a target has are grouped; the full sequence is part of the key, so
        a collision of digests can't match. Aliases are a sorted set.
        """
        order = F.col(ordinal).cast("bigint") if ordinal else F.monotonically_increasing_id()
        # The cohort is used twice; releases are read once, and only what it wants of them is grouped. Sequences go once they are matched.
        mine = cut(keyed(targets.select(F.col("identifier").alias("target_id"), "sequence", order.alias("ordinal"))))
        wanted = mine.select(*KEY).distinct()
        alias = F.struct(F.col("identifier"), F.col("alias_source").alias("source"))
        found = keyed(self.entries).join(wanted, KEY, "left_semi").groupBy(*KEY).agg(F.array_sort(F.collect_set(alias)).alias("aliases"))
        joined = mine.join(found, KEY, "left").select("target_id", F.concat(F.lit("sha256:"), "seq_hash").alias("sequence_id"), "aliases", "ordinal")
        joined = cut(joined)
        forget(targets.sparkSession, mine.written_at)
        return IdentityMap(joined.where("aliases IS NOT NULL"), joined.where("aliases IS NULL").select("target_id", "ordinal"))


def targets_by_sequence(matches: DataFrame) -> DataFrame:
    """sequence_id and target_ids, a sorted set."""
    return matches.groupBy("sequence_id").agg(F.array_sort(F.collect_set("target_id")).alias("target_ids"))
