"""Schemas of the tables that the package reads and makes."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType


def _table(**fields) -> StructType:
    return StructType([StructField(k, v[0] if isinstance(v, tuple) else v, isinstance(v, tuple)) for k, v in fields.items()])


TEXT, LINE, FLAG, LIST = StringType(), LongType(), BooleanType(), ArrayType(StringType(), False)

SEQUENCES = _table(identifier=TEXT, sequence=TEXT, description=TEXT, source=(TEXT,), line=(LINE,))
ANNOTATIONS = _table(
    database=TEXT, subject_id=TEXT, symbol=TEXT, relation=TEXT, term_id=TEXT, negated=FLAG, references=LIST, evidence=TEXT,
    with_from=LIST, aspect=TEXT, name=TEXT, synonyms=LIST, object_type=TEXT, taxa=LIST, date=TEXT, assigned_by=TEXT,
    extensions=LIST, gene_product_form_id=TEXT, source=(TEXT,), line=(LINE,),
)
TERMS = _table(identifier=TEXT, label=TEXT, namespace=TEXT, obsolete=FLAG, alternate_ids=LIST, replaced_by=LIST, consider=LIST)
EDGES = _table(child=TEXT, relation=TEXT, parent=TEXT)
ALIASES = ArrayType(StructType([StructField("identifier", TEXT, False), StructField("source", TEXT, False)]), False)
MATCHES = _table(target_id=TEXT, sequence_id=TEXT, aliases=ALIASES, ordinal=LINE)
PROJECTION = _table(source_term=(TEXT,), target_term=(TEXT,), distance=(IntegerType(),), kind=TEXT)
ISSUES = _table(code=TEXT, message=TEXT, severity=TEXT, source=(TEXT,), line=(LINE,), ordinal=(LINE,))
