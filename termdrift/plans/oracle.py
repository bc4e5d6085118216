"""The queries as DuckDB SQL over the driver's tables, written independently of the operators."""

from __future__ import annotations

INPUTS = """
WITH RECURSIVE seqs AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g') AS raw FROM documents
), seq AS (
  SELECT doc_id, upper(raw) AS s, concat('sha256:', sha256(upper(raw))) AS sequence_id FROM seqs
), targets AS (
  SELECT concat('T', doc_id) AS target_id, CASE WHEN doc_id % 10 = 3 THEN concat('sha256:', sha256(concat(s, 'WWW'))) ELSE sequence_id END AS sequence_id, doc_id AS ordinal FROM seq
), idx AS (
  SELECT concat('P', doc_id) AS identifier, CASE WHEN doc_id % 3 = 0 THEN 'rel_new' ELSE 'rel_old' END AS source, sequence_id, s FROM seq
  UNION ALL SELECT concat('S', CAST(floor(doc_id / 8) AS BIGINT)), 'rel_old', sequence_id, s FROM seq WHERE doc_id % 5 = 1
), matched AS (
  SELECT target_id, sequence_id, ordinal FROM targets WHERE sequence_id IN (SELECT sequence_id FROM idx)
), subject_rows AS (
  SELECT target_id AS subject_id, sequence_id, ordinal FROM matched
  UNION SELECT identifier, m.sequence_id, ordinal FROM matched m JOIN idx USING (sequence_id)
), subjects AS (
  SELECT subject_id, arg_min(sequence_id, ordinal) AS sequence_id FROM subject_rows GROUP BY 1
), by_sequence AS (
  SELECT sequence_id, string_agg(target_id, '|' ORDER BY target_id) AS target_ids FROM matched GROUP BY 1
), num AS (
  SELECT p_partkey AS n, concat('GO:', lpad(CAST(p_partkey AS VARCHAR), 7, '0')) AS id, (['molecular_function', 'biological_process', 'cellular_component'])[p_partkey % 3 + 1] AS namespace FROM part
), edges AS (
  SELECT id AS child, 'is_a' AS relation, concat('GO:', lpad(CAST(CAST(floor(n / 3) AS BIGINT) AS VARCHAR), 7, '0')) AS parent FROM num WHERE n >= 3 AND n % 17 <> 5
  UNION ALL SELECT id, 'part_of', concat('GO:', lpad(CAST(CAST(floor(n / 5) AS BIGINT) AS VARCHAR), 7, '0')) FROM num WHERE n >= 5 AND n % 4 = 0 AND n % 17 <> 5
  UNION ALL SELECT id, 'RO:0002211', concat('GO:', lpad(CAST(CAST(floor(n / 7) AS BIGINT) AS VARCHAR), 7, '0')) FROM num WHERE n >= 7 AND n % 6 = 0
), new_resolve AS (
  SELECT id AS any_id, id AS canonical_id FROM num
  UNION ALL SELECT concat('GO:', lpad(CAST(n + 9000000 AS VARCHAR), 7, '0')), id FROM num WHERE n % 11 = 4
), old_terms AS (
  SELECT * FROM num WHERE n < 3 OR (n % 5 IN (1, 2) AND n % 17 <> 5)
), old_alternates AS (
  SELECT concat('GO:', lpad(CAST(n + 2 AS VARCHAR), 7, '0')) AS any_id, id AS canonical_id FROM old_terms WHERE n % 5 = 1 AND (n + 2) % 17 <> 5 AND n + 2 >= 3
), old_resolve AS (
  SELECT id AS any_id, id AS canonical_id FROM old_terms
  UNION ALL SELECT * FROM old_alternates WHERE any_id NOT IN (SELECT id FROM old_terms)
), ann_base AS (
  SELECT CAST(floor(l_partkey / 2) AS BIGINT) AS doc, CAST(l_linenumber AS BIGINT) AS line, l_orderkey, l_shipdate < TIMESTAMP '1999-01-01 00:00:00' AS is_old,
    l_discount >= 0.095 AS negated, (['IDA', 'IMP', 'ISS', 'IBA', 'TAS', 'IC', 'ND', 'XXX', 'IEA', 'IEA'])[CAST(floor(l_quantity) AS BIGINT) % 10 + 1] AS evidence
  FROM lineitem
), ann_n AS (
  SELECT *, (doc * 13 + line * 29) % (SELECT count(*) FROM part) AS n FROM ann_base
), ann AS (
  SELECT is_old, negated, evidence, l_orderkey * 10 + line AS line, CASE WHEN is_old THEN 'old' ELSE 'new' END AS source,
    CASE WHEN line = 3 THEN concat('S', CAST(floor(doc / 8) AS BIGINT)) ELSE concat('P', doc) END AS subject_id,
    CASE WHEN line = 1 THEN 'acts_upstream_of' ELSE '' END AS relation,
    concat('GO:', lpad(CAST(CASE WHEN line = 2 AND n % 11 = 4 THEN n + 9000000 WHEN n % 23 = 7 THEN n + 8000000 ELSE n END AS VARCHAR), 7, '0')) AS term_id,
    (['F', 'P', 'C'])[(CASE WHEN line = 5 AND n % 7 = 0 THEN n + 1 ELSE n END) % 3 + 1] AS aspect
  FROM ann_n
), ann_rel AS (
  SELECT *, CASE WHEN relation <> '' THEN relation WHEN aspect = 'F' THEN 'enables' WHEN aspect = 'P' THEN 'involved_in' ELSE 'located_in' END AS rel FROM ann
), steps AS (
  SELECT any_id AS child, parent FROM new_resolve r JOIN edges e ON e.child = r.canonical_id WHERE relation IN ('is_a', 'part_of')
)"""

PROJECTION = """, asked AS (
  SELECT DISTINCT term_id, canonical_id AS source_term FROM ann LEFT JOIN new_resolve ON any_id = term_id
), climb AS (
  SELECT DISTINCT source_term AS seed, source_term AS node, 0 AS distance FROM asked WHERE source_term IS NOT NULL AND source_term NOT IN (SELECT any_id FROM old_resolve)
  UNION SELECT seed, parent, distance + 1 FROM climb JOIN steps ON child = node
), hit AS (
  SELECT seed, canonical_id AS target_term, distance FROM climb JOIN old_resolve ON any_id = node WHERE distance > 0
), nearest AS (
  SELECT DISTINCT seed, target_term, distance FROM hit JOIN (SELECT seed, min(distance) AS distance FROM hit GROUP BY 1) USING (seed, distance)
), projection AS (
  SELECT term_id, coalesce(source_term, term_id) AS source_term, coalesce(o.canonical_id, h.target_term) AS target_term,
    CASE WHEN o.canonical_id IS NOT NULL THEN 0 ELSE h.distance END AS distance,
    CASE WHEN source_term IS NULL THEN 'unknown_source_term' WHEN o.canonical_id = source_term THEN 'same' WHEN o.canonical_id IS NOT NULL THEN 'alternate_id'
      WHEN h.target_term IS NOT NULL THEN 'nearest_ancestor' ELSE 'unmappable' END AS kind
  FROM asked LEFT JOIN old_resolve o ON o.any_id = source_term LEFT JOIN nearest h ON h.seed = source_term
)"""

ASSERTIONS = (
    PROJECTION
    + """, before AS (
  SELECT sequence_id, canonical_id AS term_id, rel AS relation, aspect, string_agg(DISTINCT evidence, '|' ORDER BY evidence) AS evidence
  FROM ann_rel JOIN subjects USING (subject_id) JOIN old_resolve ON any_id = term_id WHERE is_old AND NOT negated GROUP BY 1, 2, 3, 4
), after AS (
  SELECT sequence_id, p.target_term AS term_id, rel AS relation, aspect, string_agg(DISTINCT evidence, '|' ORDER BY evidence) AS evidence,
    coalesce(string_agg(DISTINCT CASE WHEN p.target_term <> p.source_term THEN p.source_term END, '|' ORDER BY CASE WHEN p.target_term <> p.source_term THEN p.source_term END), '') AS projected_from
  FROM ann_rel a JOIN subjects USING (subject_id) JOIN projection p ON p.term_id = a.term_id
  WHERE NOT is_old AND NOT negated AND p.target_term IS NOT NULL GROUP BY 1, 2, 3, 4
)"""
)

# Codes as text between bars, so that a set has a code of a list if the pattern finds it.
EXPERIMENTAL = r"(^|\|)(EXP|IDA|IPI|IMP|IGI|IEP|HTP|HDA|HMP|HGI|HEP)(\||$)"
AUTHOR = r"(^|\|)(TAS|NAS)(\||$)"
UNKNOWN = r"(^|\|)XXX(\||$)"
COMPUTATIONAL = r"(^|\|)(ISS|ISO|ISA|ISM|IGC|RCA)(\||$)"
PHYLOGENETIC = r"(^|\|)(IBA|IBD|IKR|IRD)(\||$)"
ELECTRONIC = r"(^|\|)IEA(\||$)"


def _has(column: str, *patterns: str) -> str:
    return "(" + " OR ".join(f"regexp_matches({column}, '{p}')" for p in patterns) + ")"


def _upgrade(old: str, new: str) -> str:
    return f"({old} <> '' AND {new} <> '' AND NOT {_has(old, EXPERIMENTAL)} AND {_has(new, EXPERIMENTAL)})"


def _reviewed(old: str, new: str) -> str:
    pairs = ((ELECTRONIC, AUTHOR), (UNKNOWN, EXPERIMENTAL), (COMPUTATIONAL, PHYLOGENETIC))
    some = " OR ".join(f"({_has(old, a)} AND {_has(new, b)})" for a, b in pairs)
    return f"({old} <> '' AND {new} <> '' AND NOT {_has(old, EXPERIMENTAL, AUTHOR)} AND ({some}))"


def _changes(accepts: str, upgrade: str) -> str:
    return (
        INPUTS
        + ASSERTIONS
        + f""", sides AS (
  SELECT sequence_id, term_id, relation, aspect, b.evidence IS NULL AS is_new, a.evidence IS NULL AS is_gone,
    coalesce(b.evidence, '') AS old_evidence, coalesce(a.evidence, '') AS new_evidence, coalesce(projected_from, '') AS projected_from
  FROM before b FULL JOIN after a USING (sequence_id, term_id, relation, aspect)
), kinds AS (
  SELECT *, CASE WHEN is_new THEN 'term_acquired' WHEN is_gone THEN 'annotation_removed' WHEN {upgrade} THEN 'evidence_upgraded'
    WHEN old_evidence <> new_evidence THEN 'evidence_changed' END AS kind FROM sides
), changes AS (
  SELECT sequence_id, target_ids, term_id, relation, aspect, kind, old_evidence, new_evidence, projected_from,
    CASE WHEN kind = 'term_acquired' THEN {accepts} ELSE kind = 'evidence_upgraded' END AS qualifies
  FROM kinds JOIN by_sequence USING (sequence_id) WHERE kind IS NOT NULL
)"""
    )


CHANGES = _changes(_has("new_evidence", EXPERIMENTAL), _upgrade("old_evidence", "new_evidence"))

GAF = """
WITH lines AS (
  SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS ln, l_orderkey * 10 + l_linenumber AS line, l_partkey, l_suppkey,
    1 + row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS spot FROM lineitem
), r AS (
  SELECT CAST(line AS BIGINT) AS line, CAST(spot AS BIGINT) AS spot, l_partkey, k, k % 37 = 0 AS long, k % 37 <> 0 AND ln = 7 AS head, concat('P', l_partkey) AS subject_id,
    k % 5 <> 0 AND k % 11 = 0 AS several, k % 5 = 0 OR (k % 11 <> 0 AND k % 13 = 0) AS negated,
    CASE WHEN k % 5 = 0 THEN 'enables' WHEN k % 11 = 0 OR k % 13 = 0 THEN '' ELSE 'located_in' END AS relation,
    CASE WHEN k % 17 = 0 THEN 'XX:1' ELSE concat('GO:', lpad(CAST(l_suppkey AS VARCHAR), 7, '0')) END AS term_id,
    CASE WHEN k % 19 = 0 THEN '' ELSE 'IDA' END AS evidence, CASE WHEN k % 23 = 0 THEN 'Q' ELSE (['F', 'P', 'C'])[k % 3 + 1] END AS aspect,
    CASE WHEN k % 29 = 0 THEN '2024-01-01' WHEN k % 31 = 0 THEN '' ELSE '20240101' END AS date
  FROM lines
), body AS (SELECT * FROM r WHERE NOT head)"""

FASTA = """
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g') AS raw FROM documents
), rec AS (
  SELECT doc_id * 2 + 1 AS line,
    CASE WHEN doc_id % 31 = 0 THEN '' WHEN doc_id % 3 = 0 THEN concat('A', doc_id % 211) ELSE concat('B', doc_id % 307) END AS identifier,
    CASE WHEN doc_id % 31 = 0 THEN 'sp||none' WHEN doc_id % 3 = 0 THEN concat('sp|A', doc_id % 211, '|NAME text') ELSE concat('B', doc_id % 307, ' text') END AS description,
    CASE WHEN doc_id % 13 = 0 THEN '' WHEN doc_id % 7 = 0 THEN concat(upper(raw), '*1') ELSE upper(raw) END AS s,
    doc_id % 13 <> 0 AND doc_id % 7 = 0 AS odd, 2 + 3 * (row_number() OVER (ORDER BY doc_id) - 1) AS spot
  FROM d
), firsts AS (SELECT identifier, min(line) AS first FROM rec WHERE identifier <> '' AND s <> '' AND NOT odd GROUP BY 1)"""


def sql() -> dict[str, str]:
    key = "sequence_id, term_id, relation, aspect"
    sets = (
        INPUTS
        + """, sets AS (
  SELECT subject_id, coalesce(string_agg(DISTINCT CASE WHEN is_old THEN evidence END, '|' ORDER BY CASE WHEN is_old THEN evidence END), '') AS was,
    coalesce(string_agg(DISTINCT CASE WHEN NOT is_old THEN evidence END, '|' ORDER BY CASE WHEN NOT is_old THEN evidence END), '') AS now FROM ann GROUP BY 1
)"""
    )
    gaf_errors = [
        ("INVALID_GAF_COLUMN_COUNT", "error", "long"),
        ("MULTIPLE_GAF_RELATIONS", "error", "NOT long AND several"),
        ("INVALID_GAF_ASPECT", "error", "NOT long AND aspect = 'Q'"),
        ("INVALID_GO_IDENTIFIER", "error", "NOT long AND term_id = 'XX:1'"),
        ("MISSING_EVIDENCE_CODE", "error", "NOT long AND evidence = ''"),
        ("NONSTANDARD_GAF_DATE", "warning", "NOT long AND date = '2024-01-01'"),
    ]
    gaf_messages = {
        "INVALID_GAF_COLUMN_COUNT": "17 columns expected, found: 18", "MULTIPLE_GAF_RELATIONS": "several relations: enables, involved_in", "INVALID_GAF_ASPECT": "no such aspect: Q",
        "INVALID_GO_IDENTIFIER": "no GO identifier: XX:1", "MISSING_EVIDENCE_CODE": "the evidence column is empty", "NONSTANDARD_GAF_DATE": "not eight digits: 2024-01-01",
    }
    namespace = "CASE aspect WHEN 'F' THEN 'molecular_function' WHEN 'P' THEN 'biological_process' ELSE 'cellular_component' END"
    return {
        "compare_changes": CHANGES + " SELECT * FROM changes",
        "compare_changes_reviewed": _changes(_has("new_evidence", EXPERIMENTAL, AUTHOR), _reviewed("old_evidence", "new_evidence"))
        + f" SELECT {key}, kind, qualifies FROM changes",
        "compare_issues": INPUTS
        + PROJECTION
        + """, found AS (
  SELECT 'AMBIGUOUS_SEQUENCE_ALIAS' AS code, 'error' AS severity, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS BIGINT) AS line
  FROM subject_rows r JOIN subjects s USING (subject_id) WHERE r.sequence_id <> s.sequence_id
  UNION ALL SELECT 'NEGATED_ANNOTATION_IGNORED', 'warning', source, line FROM ann JOIN subjects USING (subject_id) WHERE negated
  UNION ALL SELECT 'UNMAPPABLE_NEW_TERM', 'warning', source, line FROM ann JOIN subjects USING (subject_id)
    WHERE NOT negated AND NOT is_old AND term_id IN (SELECT term_id FROM projection WHERE target_term IS NULL)
) SELECT code, severity, source, line, count(*) AS n FROM found GROUP BY ALL""",
        "selected_sequences": CHANGES + " SELECT DISTINCT sequence_id FROM changes WHERE qualifies",
        "selected_targets": CHANGES + " SELECT DISTINCT target_id FROM matched WHERE sequence_id IN (SELECT sequence_id FROM changes WHERE qualifies)",
        "assertions_old": INPUTS + ASSERTIONS + f" SELECT {key}, evidence FROM before",
        "assertions_new": INPUTS + ASSERTIONS + f" SELECT {key}, evidence, projected_from FROM after",
        "seq_normalize_digest": INPUTS + " SELECT doc_id, CAST(length(s) AS INTEGER) AS seq_len, sequence_id FROM seq",
        "seq_header_identifier": FASTA + " SELECT line, identifier FROM rec",
        "identity_match": INPUTS
        + """, a AS (SELECT DISTINCT sequence_id, identifier, source FROM idx)
SELECT target_id, sequence_id, string_agg(concat(identifier, '@', source), '|' ORDER BY identifier, source) AS aliases, ordinal FROM matched JOIN a USING (sequence_id) GROUP BY target_id, sequence_id, ordinal""",
        "identity_unmatched": INPUTS + " SELECT target_id, ordinal FROM targets WHERE sequence_id NOT IN (SELECT sequence_id FROM idx)",
        "identity_subject_ids": INPUTS + " SELECT DISTINCT subject_id FROM subject_rows",
        "identity_aliases_for": INPUTS + " SELECT DISTINCT identifier, source FROM idx WHERE sequence_id = (SELECT min(sequence_id) FROM matched)",
        "index_size": INPUTS + " SELECT count(DISTINCT s) AS n_sequences FROM idx",
        "index_of_one_release": INPUTS
        + """ SELECT target_id, CAST(count(*) AS INTEGER) AS n_aliases FROM targets JOIN (SELECT doc_id, sequence_id FROM seq) USING (sequence_id) GROUP BY target_id""",
        "subject_first_sequence": INPUTS + " SELECT * FROM subjects",
        "ambiguous_alias": INPUTS
        + " SELECT 'AMBIGUOUS_SEQUENCE_ALIAS' AS code, ordinal, count(*) AS n FROM subject_rows r JOIN subjects s USING (subject_id) WHERE r.sequence_id <> s.sequence_id GROUP BY 2",
        "targets_of_sequences": INPUTS + " SELECT * FROM by_sequence",
        "subject_filter_qualified": INPUTS
        + " SELECT subject_id, term_id, source, line FROM ann WHERE subject_id[1] = 'P' AND EXISTS (SELECT 1 FROM seq WHERE doc_id % 9 IN (0, 1) AND concat('P', doc_id) = subject_id)",
        "fasta_first_valid": FASTA + " SELECT identifier, sha256(s) AS digest, description, line FROM rec JOIN firsts USING (identifier) WHERE line = first",
        "fasta_issues": FASTA
        + """, found AS (
  SELECT 'EMPTY_FASTA_IDENTIFIER' AS code, line FROM rec WHERE identifier = ''
  UNION ALL SELECT 'DUPLICATE_FASTA_IDENTIFIER', line FROM rec JOIN firsts USING (identifier) WHERE line > first
  UNION ALL SELECT 'EMPTY_FASTA_SEQUENCE', line FROM rec WHERE s = ''
  UNION ALL SELECT 'INVALID_AMINO_ACID', line FROM rec WHERE odd
) SELECT code, 'error' AS severity, 'file' AS source, line FROM found""",
        "gaf_rows": GAF
        + """ SELECT subject_id, relation, negated, term_id, 'PMID:1|PMID:2' AS "references", 'a|b' AS synonyms, evidence, aspect, date, line
FROM body WHERE NOT (long OR several OR aspect = 'Q' OR term_id = 'XX:1' OR evidence = '')""",
        "gaf_row_issues": GAF
        + " UNION ALL ".join(f" SELECT '{code}' AS code, '{severity}' AS severity, 'file' AS source, line FROM body WHERE {rule}" for code, severity, rule in gaf_errors),
        "gaf_metadata_last_wins": GAF + " SELECT concat('key ', k % 5) AS key, arg_max(concat('value ', k), line) AS value, max(line) AS line FROM r WHERE head GROUP BY 1",
        "files_fasta_records": FASTA + " SELECT identifier, s AS sequence, description, CAST(spot AS BIGINT) AS line FROM rec JOIN firsts USING (identifier) WHERE line = first",
        "files_fasta_issues": FASTA
        + """, found AS (
  SELECT 'EMPTY_FASTA_IDENTIFIER' AS code, 'the header names nothing' AS message, spot FROM rec WHERE identifier = ''
  UNION ALL SELECT 'DUPLICATE_FASTA_IDENTIFIER', concat('identifier seen before: ', identifier), spot FROM rec JOIN firsts USING (identifier) WHERE line > first
  UNION ALL SELECT 'EMPTY_FASTA_SEQUENCE', concat('no residues: ', identifier), spot FROM rec WHERE s = ''
  UNION ALL SELECT 'INVALID_AMINO_ACID', 'letters outside the alphabet: *1', spot FROM rec WHERE odd
  UNION ALL SELECT 'FASTA_SEQUENCE_BEFORE_HEADER', 'residues stand before any header', 1
) SELECT code, message, 'error' AS severity, CAST(spot AS BIGINT) AS line FROM found""",
        "files_gaf_annotations": GAF
        + """ SELECT 'DB' AS "database", subject_id, '' AS symbol, relation, term_id, negated, 'PMID:1|PMID:2' AS "references", evidence, '' AS with_from, aspect, 'name' AS name, 'a|b' AS synonyms,
  'protein' AS object_type, 'taxon:1' AS taxa, date, 'me' AS assigned_by, '' AS extensions, '' AS gene_product_form_id, true AS has_source, spot AS line
FROM body WHERE NOT (long OR several OR aspect = 'Q' OR term_id = 'XX:1' OR evidence = '')""",
        "files_gaf_issues": GAF
        + " UNION ALL ".join(
            f" SELECT '{code}' AS code, '{severity}' AS severity, '{gaf_messages[code]}' AS message, spot AS line FROM body WHERE {rule}" for code, severity, rule in gaf_errors
        ),
        "files_gaf_metadata": GAF
        + """ SELECT concat('key ', k % 5) AS key, arg_max(concat('value ', k), spot) AS value, max(spot) AS line FROM r WHERE head GROUP BY 1
UNION ALL SELECT 'gaf-version', '2.2', 1""",
        "files_gaf_versions": """SELECT 'none' AS file, 'MISSING_GAF_VERSION' AS code, CAST(NULL AS BIGINT) AS line UNION ALL SELECT 'one', 'UNSUPPORTED_GAF_VERSION', NULL""",
        "files_lines": INPUTS
        + """ SELECT 'faulty.gaf' AS file, false AS is_gzip, count(*) + 1 AS n, count(*) + 1 AS last FROM lineitem
UNION ALL SELECT 'all.txt.gz', true, count(*), count(*) FROM lineitem""",
        "files_checksum": """SELECT concat(name, '/', bucket) AS name, sha256(string_agg(concat(value, chr(10)), '' ORDER BY key)) AS sha256, CAST(sum(strlen(value) + 1) AS BIGINT) AS length FROM (
  SELECT 'orders' AS name, o_orderkey // 10000 AS bucket, o_orderkey AS key, concat(o_orderkey, ' ', o_custkey, ' ', o_orderstatus) AS value FROM orders
  UNION ALL SELECT 'customer', c_custkey // 10000, c_custkey, concat(c_custkey, ' ', c_name) FROM customer
  UNION ALL SELECT 'part', p_partkey // 10000, p_partkey, concat(p_partkey, ' ', p_name) FROM part
  UNION ALL SELECT 'supplier', s_suppkey // 10000, s_suppkey, concat(s_suppkey, ' ', s_name) FROM supplier
) GROUP BY name, bucket""",
        "files_binary": INPUTS + " SELECT sha256(string_agg(concat(l_orderkey * 10 + l_linenumber, chr(10)), '' ORDER BY l_orderkey * 10 + l_linenumber)) AS sha256 FROM lineitem",
        "files_owl_terms": INPUTS
        + """ SELECT id AS identifier, concat('term ', n) AS label, namespace, false AS obsolete, CASE WHEN n % 11 = 4 THEN concat('GO:', lpad(CAST(n + 9000000 AS VARCHAR), 7, '0')) ELSE '' END AS alternate_ids,
  'http://example.org/new/go.owl' AS release FROM num""",
        "files_owl_edges": INPUTS + " SELECT DISTINCT child, relation, parent FROM edges",
        "files_owl_faults": "SELECT 'broken' AS file, 'INVALID_OWL' AS code, 0 AS n_terms UNION ALL SELECT 'none', 'INVALID_OWL', 0 UNION ALL SELECT 'empty', 'EMPTY_GO_ONTOLOGY', 0",
        "files_snapshot": INPUTS
        + f""", known AS (SELECT any_id, namespace FROM new_resolve JOIN num ON id = canonical_id), wanted AS (SELECT DISTINCT subject_id FROM subject_rows)
SELECT 'annotations' AS what, count(*) AS n FROM ann JOIN wanted USING (subject_id) WHERE NOT is_old
UNION ALL SELECT 'terms', count(*) FROM num
UNION ALL SELECT CASE WHEN namespace IS NULL THEN 'UNKNOWN_ANNOTATION_TERM' ELSE 'ANNOTATION_ASPECT_MISMATCH' END, count(*)
FROM ann JOIN wanted USING (subject_id) LEFT JOIN known ON any_id = term_id WHERE NOT is_old AND (namespace IS NULL OR namespace <> {namespace}) GROUP BY 1
UNION ALL SELECT 'MISSING_GO_ROOTS', count(*) FROM (SELECT count(*) AS n FROM num WHERE id IN ('GO:0003674', 'GO:0008150', 'GO:0005575')) WHERE n = 0""",
        "files_compare": CHANGES + " SELECT * FROM changes",
        "changes_in_order": CHANGES + f" SELECT CAST(row_number() OVER (ORDER BY {key}) AS BIGINT) AS place, {key}, kind FROM changes",
        "onto_contains": INPUTS + " SELECT id AS term_id, id IN (SELECT any_id FROM old_resolve) AS known FROM num WHERE n < 7",
        "onto_last_terms": INPUTS
        + """, again AS (
  SELECT n, id, 'first' AS label, 'GO:7000000' AS alternate FROM num UNION ALL SELECT n, id, 'last', concat('GO:', lpad(CAST(7000000 + n % 3 AS VARCHAR), 7, '0')) FROM num WHERE n % 2 = 0
), kept AS (SELECT n, id, min(label) = 'first' AND count(*) = 1 AS once, CASE WHEN count(*) = 2 THEN 'last' ELSE 'first' END AS label, CASE WHEN count(*) = 2 THEN max(alternate) FILTER (label = 'last') ELSE max(alternate) END AS alternate FROM again GROUP BY n, id)
SELECT id AS any_id, id AS canonical_id, label FROM kept UNION ALL SELECT alternate, arg_max(id, n), '' FROM kept GROUP BY alternate""",
        "onto_faults": INPUTS
        + """ SELECT 'AMBIGUOUS_ALTERNATE_ID' AS code, count(*) AS n FROM num WHERE n >= 1 UNION ALL SELECT 'ONTOLOGY_CYCLE', 1
UNION ALL SELECT 'MISSING_GO_ROOTS', count(*) FROM (SELECT count(*) AS n FROM num WHERE id IN ('GO:0003674', 'GO:0008150', 'GO:0005575')) WHERE n = 0""",
        "resolve_ids": INPUTS + " SELECT id AS term_id, canonical_id FROM num LEFT JOIN old_resolve ON any_id = id",
        "onto_parents": INPUTS + " SELECT DISTINCT term_id, parent FROM ann JOIN steps ON child = term_id",
        "onto_edges_grouped": INPUTS + " SELECT child, relation, string_agg(DISTINCT parent, '|' ORDER BY parent) AS parents FROM edges GROUP BY 1, 2",
        "onto_ancestors": INPUTS
        + """, up AS (SELECT DISTINCT term_id, parent AS ancestor FROM ann JOIN steps ON child = term_id UNION SELECT term_id, parent FROM up JOIN steps ON child = ancestor)
SELECT * FROM up""",
        "onto_propagate": INPUTS
        + """, isa AS (SELECT any_id AS child, parent FROM new_resolve r JOIN edges e ON e.child = r.canonical_id WHERE relation = 'is_a'),
up AS (SELECT DISTINCT canonical_id AS ancestor FROM ann JOIN new_resolve ON any_id = term_id WHERE is_old UNION SELECT parent FROM up JOIN isa ON child = ancestor)
SELECT * FROM up""",
        "onto_projection": INPUTS + PROJECTION + " SELECT * FROM projection",
        "onto_validate": INPUTS
        + """, found AS (
  SELECT 'AMBIGUOUS_ALTERNATE_ID' AS code, 'error' AS severity FROM old_alternates WHERE any_id IN (SELECT id FROM old_terms)
  UNION ALL SELECT 'UNKNOWN_ONTOLOGY_CHILD', 'error' FROM (SELECT DISTINCT child FROM edges WHERE child NOT IN (SELECT id FROM old_terms))
  UNION ALL SELECT 'UNKNOWN_ONTOLOGY_PARENT', 'error' FROM (SELECT DISTINCT child, relation, parent FROM edges WHERE parent NOT IN (SELECT id FROM old_terms))
  UNION ALL SELECT 'MISSING_GO_ROOTS', 'warning' FROM (SELECT count(*) AS n FROM old_terms WHERE id IN ('GO:0003674', 'GO:0008150', 'GO:0005575')) WHERE n = 0
) SELECT code, severity, count(*) AS n FROM found GROUP BY ALL""",
        "onto_cycle": INPUTS
        + """, looped AS (SELECT child, parent FROM edges WHERE relation IN ('is_a', 'part_of') UNION SELECT id, 'GO:0000005' FROM num WHERE n = 1),
r1 AS (SELECT child, parent FROM steps UNION SELECT r1.child, s.parent FROM r1 JOIN steps s ON s.child = r1.parent),
r2 AS (SELECT child, parent FROM looped UNION SELECT r2.child, s.parent FROM r2 JOIN looped s ON s.child = r2.parent)
SELECT 'as it is' AS ontology, count(*) > 0 AS has_cycle FROM r1 WHERE child = parent
UNION ALL SELECT 'with an edge back', count(*) > 0 FROM r2 WHERE child = parent""",
        "snapshot_validate": INPUTS
        + f""", known AS (SELECT any_id, namespace FROM new_resolve JOIN num ON id = canonical_id)
SELECT CASE WHEN namespace IS NULL THEN 'UNKNOWN_ANNOTATION_TERM' ELSE 'ANNOTATION_ASPECT_MISMATCH' END AS code, 'error' AS severity, source, line
FROM ann LEFT JOIN known ON any_id = term_id WHERE NOT is_old AND (namespace IS NULL OR namespace <> {namespace})""",
        "evidence_category": INPUTS
        + """ SELECT DISTINCT evidence, CASE WHEN evidence IN ('IDA', 'IMP') THEN 'experimental' WHEN evidence = 'ISS' THEN 'computational' WHEN evidence = 'IBA' THEN 'phylogenetic'
  WHEN evidence = 'TAS' THEN 'author_statement' WHEN evidence IN ('IC', 'ND') THEN 'curator_statement' WHEN evidence = 'IEA' THEN 'electronic' ELSE 'unknown' END AS category FROM ann""",
        "evidence_accepts": sets + f" SELECT subject_id, {_has('was', EXPERIMENTAL)} AS accepted, {_has('was', EXPERIMENTAL, AUTHOR)} AS reviewed FROM sets",
        "evidence_upgrade": sets + f" SELECT subject_id, {_upgrade('was', 'now')} AS upgrade, {_reviewed('was', 'now')} AS reviewed FROM sets",
    }
