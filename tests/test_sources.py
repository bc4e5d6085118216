import gzip
import hashlib

import pytest

from termdrift import FastaReader, GafReader, Ontology, SequenceDataset, SequenceIndex, SequenceMatch, Source, ValidationError
from termdrift.sources.files import checksums, numbered_lines


def codes(report):
    return sorted((r.code, r.line) for r in report.issues.collect())


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    path = put(tmp_path / "x.txt", "".join(f"line {i}\n" for i in range(1, 20_001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        rows = numbered_lines(spark, path)
        assert rows.select("block").distinct().count() > 5
        assert rows.where("value <> concat('line ', line)").count() == 0 and rows.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_line_ends(spark, tmp_path, end):
    rows = numbered_lines(spark, put(tmp_path / "x.txt", f"a{end}{end}b")).collect()
    assert sorted((r.line, r.value) for r in rows) == [(1, "a"), (2, ""), (3, "b")]


def test_checksums_are_of_stored_bytes(spark, tmp_path):
    path = tmp_path / "x.gz"
    path.write_bytes(gzip.compress(b"hello"))
    source = Source.of(path)
    assert source.is_gzip and Source.of(source) is source and Source("X.GZ").is_gzip
    for name in ("sha256", "md5", "sha1", "sha3_256", "blake2b"):
        assert source.checksum(spark, name) == hashlib.new(name, path.read_bytes()).hexdigest()
    with pytest.raises(ValueError):
        source.checksum(spark, "none such")


def test_releases_name_the_targets(spark, tmp_path):
    cohort = put(tmp_path / "cohort.fa", ">own_1 kinase\nmk T\tl\nGG\n>own_2\nHHHH\n>own_3\nMKTLGG\n")
    older = tmp_path / "older.fa.gz"
    older.write_bytes(gzip.compress(b">sp|Q8XYZ1|KIN_ECOLI text\nMKTL\n\nGG\n>sp|Q8XYZ1|AGAIN\nMK\n>plain word\nPPP\n"))
    newer = put(tmp_path / "newer.fa", ">tr|B2CDE3|KIN\nmktlgg\n>sp|Q8XYZ1|KIN\nMKTLGG\n")
    data = SequenceDataset.read(spark, cohort)
    index = SequenceIndex.from_fastas(spark, {"older": str(older), "newer": newer}, strict=False)
    assert data.count() == 3 and index.count() == 2 and codes(index.validation) == [("DUPLICATE_FASTA_IDENTIFIER", 5)]
    found = index.match(data.records)
    name = f"sha256:{hashlib.sha256(b'MKTLGG').hexdigest()}"
    aliases = (("B2CDE3", "newer"), ("Q8XYZ1", "newer"), ("Q8XYZ1", "older"))
    assert sorted(SequenceMatch.of(m) for m in found.matches.collect()) == [(t, name, aliases) for t in ("own_1", "own_3")]
    assert [r.target_id for r in found.unmatched.collect()] == ["own_2"]
    assert {r.subject_id for r in found.subject_ids.collect()} == {"own_1", "own_3", "B2CDE3", "Q8XYZ1"}
    assert [tuple(r) for r in found.aliases_for(name).collect()] == list(aliases)
    assert SequenceIndex.from_fasta(spark, newer).entries.first().alias_source == newer
    index.add("late", "h h h h", source="by hand")
    assert index.match(data.records).unmatched.count() == 0


def test_every_error_of_a_file_is_told(spark, tmp_path):
    from termdrift import Report

    path = put(tmp_path / "bad.gaf", "!gaf-version: 2.1\n" + "\n".join(f"only {i}" for i in range(2500)))
    report = Report.empty(spark)
    GafReader().iter_records(spark, path, report=report, strict=False)
    with pytest.raises(ValidationError) as e:
        report.raise_for_errors()
    assert e.value.count == e.value.table.count() == 2500 and [i.line for i in e.value.issues] == list(range(2, 2502))
    assert "2500 errors in all" in str(e.value)


def test_bytes_of_compressed_files(spark, tmp_path):
    data = bytes(range(256)) * 1000
    (tmp_path / "x.GZ").write_bytes(gzip.compress(data[:100_000]) + gzip.compress(data[100_000:]))
    (tmp_path / "a b#.bin").write_bytes(data)
    for name in ("x.GZ", "a b#.bin"):
        chunks = Source.from_value(str(tmp_path / name)).open_binary(spark, chunk=70_000).orderBy("chunk").collect()
        assert b"".join(r.content for r in chunks) == data and max(len(r.content) for r in chunks) <= 70_000
    found = {r.path.rsplit("/", 1)[1]: r.digest for r in checksums(spark, [str(tmp_path)]).collect()}
    assert found == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.iterdir()}


def test_faulty_sequences(spark, tmp_path):
    text = "LOST\n>\nAC\n>sp||x\nAC\n>A\nAC*1\n>A ok\nACD\n>A again\nWW\n>B\n\n>sp|C\nAA\n"
    path = put(tmp_path / "x.fasta", text)
    records, report = FastaReader().read(spark, path, strict=False)
    assert sorted((r.identifier, r.sequence, r.description, r.line) for r in records.collect()) == [("A", "ACD", "A ok", 8), ("sp|C", "AA", "sp|C", 14)]
    assert codes(report) == [
        ("DUPLICATE_FASTA_IDENTIFIER", 10), ("EMPTY_FASTA_IDENTIFIER", 2), ("EMPTY_FASTA_IDENTIFIER", 4), ("EMPTY_FASTA_SEQUENCE", 12),
        ("FASTA_SEQUENCE_BEFORE_HEADER", 1), ("INVALID_AMINO_ACID", 6),
    ]
    with pytest.raises(ValidationError) as e:
        FastaReader().read(spark, path)
    assert [(i.code, i.line, i.source) for i in e.value.issues] == [("FASTA_SEQUENCE_BEFORE_HEADER", 1, path)]
    records, report = FastaReader(alphabet="ACD").read(spark, put(tmp_path / "y.fasta", ">A\nACE\n>B\nACD\n"), strict=False)
    assert [r.identifier for r in records.collect()] == ["B"] and codes(report) == [("INVALID_AMINO_ACID", 1)]


def row(**change):
    """A row of 17 columns; c5="x" puts x into the fifth."""
    cells = ["MGI", "MGI:7", "Abc", "located_in", "GO:1", "DOI:a||DOI:b", "IDA", "", "F", "long name", "s1|s2", "gene", "taxon:10090", "20150630", "SELF", "", "iso-1"]
    for i, v in change.items():
        cells[int(i[1:]) - 1] = v
    return "\t".join(cells)


def test_annotations_keep_their_fields(spark, tmp_path):
    rows = [row(c4="contributes_to|NOT", c8="MGI:1|MGI:2", c16="part_of(X:1),x|y"), row(c4="NOT", c13="taxon:1|taxon:2", c17="")]
    path = put(tmp_path / "x.gaf", "! Made-By : me: myself\n!GAF-Version:2.1\n" + "\n!made-by: you\n".join(rows) + "\n!no separator\n")
    file = GafReader().read(spark, path)
    one, two = sorted(file.annotations.collect(), key=lambda r: r.line)
    assert one.asDict() == {
        "database": "MGI", "subject_id": "MGI:7", "symbol": "Abc", "relation": "contributes_to", "term_id": "GO:1", "negated": True, "references": ["DOI:a", "DOI:b"], "evidence": "IDA",
        "with_from": ["MGI:1", "MGI:2"], "aspect": "F", "name": "long name", "synonyms": ["s1", "s2"], "object_type": "gene", "taxa": ["taxon:10090"], "date": "20150630",
        "assigned_by": "SELF", "extensions": ["part_of(X:1),x", "y"], "gene_product_form_id": "iso-1", "source": path, "line": 3,
    }
    assert (two.negated, two.relation, two.line, two.taxa, two.gene_product_form_id) == (True, "", 5, ["taxon:1", "taxon:2"], "")
    assert {r.key: (r.value, r.line) for r in file.metadata.collect()} == {"gaf-version": ("2.1", 2), "made-by": ("you", 4)}


def test_bytes_that_are_no_text(spark, tmp_path):
    (tmp_path / "x.fasta").write_bytes(b">A \xff\nACD\n")
    records, report = FastaReader().read(spark, str(tmp_path / "x.fasta"), strict=False)
    assert records.count() == 1 and codes(report) == [("INVALID_TEXT_ENCODING", 1)]
    (tmp_path / "x.gaf").write_bytes(b"!gaf-version: 2.2\n" + row(c10="\xff").encode("latin-1"))
    with pytest.raises(ValidationError, match="INVALID_TEXT_ENCODING"):
        GafReader().read(spark, str(tmp_path / "x.gaf"))


def test_faulty_annotations(spark, tmp_path):
    rows = [row(), row(c17="x\ty"), "   ", row(c4="a|b"), row(c9="X"), row(c5="XX:1"), row(c7=""), row(c14="2020-01-01"), row(c14=""), row(c9="Y", c7="")]
    path = put(tmp_path / "x.gaf", "\n".join(rows))
    file = GafReader().read(spark, path, strict=False)
    assert sorted(r.line for r in file.annotations.collect()) == [1, 8, 9]
    assert sorted(codes(file.report), key=str) == sorted([
        ("INVALID_GAF_COLUMN_COUNT", 2), ("INVALID_GAF_COLUMN_COUNT", 3), ("MULTIPLE_GAF_RELATIONS", 4), ("INVALID_GAF_ASPECT", 5), ("INVALID_GO_IDENTIFIER", 6),
        ("MISSING_EVIDENCE_CODE", 7), ("NONSTANDARD_GAF_DATE", 8), ("INVALID_GAF_ASPECT", 10), ("MISSING_EVIDENCE_CODE", 10), ("MISSING_GAF_VERSION", None),
    ], key=str)
    assert {c for c, _ in ((r.code, r.line) for r in file.report.warnings.collect())} == {"NONSTANDARD_GAF_DATE"}
    with pytest.raises(ValidationError) as e:
        GafReader().read(spark, path)
    assert [(i.code, i.line) for i in e.value.issues] == [("INVALID_GAF_COLUMN_COUNT", 2)]
    old = GafReader().read(spark, put(tmp_path / "y.gaf", "!gaf-version: 1.0\n"), strict=False)
    assert [r.code for r in old.report.issues.collect()] == ["UNSUPPORTED_GAF_VERSION"]


OWL = """<?xml version="1.0"?>
<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:rdfs="http://www.w3.org/2000/01/rdf-schema#" xmlns:owl="http://www.w3.org/2002/07/owl#"
  xmlns:oboInOwl="http://www.geneontology.org/formats/oboInOwl#" xmlns:obo="http://purl.obolibrary.org/obo/">
  <owl:Ontology rdf:about="http://example.org/go.owl"><owl:versionIRI rdf:resource="http://example.org/2023-01-01/go.owl"/></owl:Ontology>
  <owl:Class rdf:about="http://example.org/obo/GO_0008150"><rdfs:label>root</rdfs:label><oboInOwl:hasOBONamespace>biological_process</oboInOwl:hasOBONamespace></owl:Class>
  <owl:Class rdf:about="http://example.org/obo/GO_0040011">
    <rdfs:label xml:lang="en">one</rdfs:label><oboInOwl:hasOBONamespace>biological_process</oboInOwl:hasOBONamespace>
    <oboInOwl:hasAlternativeId>GO:0070001</oboInOwl:hasAlternativeId><owl:deprecated rdf:datatype="http://www.w3.org/2001/XMLSchema#boolean">true</owl:deprecated>
    <obo:IAO_0100001 rdf:resource="http://example.org/obo/GO_0000007"/><oboInOwl:consider>GO:0000008</oboInOwl:consider>
    <rdfs:subClassOf rdf:resource="http://example.org/obo/GO_0008150"/>
    <rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="http://example.org/obo/BFO_0000050"/><owl:someValuesFrom rdf:resource="http://example.org/obo/GO_0008150"/></owl:Restriction></rdfs:subClassOf>
    <rdfs:subClassOf><owl:Restriction><owl:onProperty rdf:resource="http://example.org/obo/RO_1"/><owl:someValuesFrom rdf:resource="http://example.org/obo/GO_0008150"/></owl:Restriction></rdfs:subClassOf>
  </owl:Class>
  <owl:Class rdf:about="http://example.org/obo/CHEBI_1"><rdfs:label>other</rdfs:label></owl:Class>
</rdf:RDF>
"""


def test_ontology_file(spark, tmp_path):
    ontology, report = Ontology.from_owl(spark, put(tmp_path / "go.owl", OWL))
    assert not report and ontology.count() == 2 and "2023-01-01" in ontology.release
    term = ontology.term("GO:0070001").first()
    assert (term.identifier, term.label, term.obsolete, term.replaced_by, term.consider) == ("GO:0040011", "one", True, ["GO:0000007"], ["GO:0000008"])
    assert {tuple(e) for e in ontology.edges.collect()} == {("GO:0040011", r, "GO:0008150") for r in ("is_a", "part_of", "RO:1")}


OTHER = """<x:RDF xmlns:x="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:y="http://www.w3.org/2000/01/rdf-schema#" xmlns:z="http://www.w3.org/2002/07/owl#"
  xmlns:g="http://www.geneontology.org/formats/oboInOwl#" xml:base="http://example.org/obo/">
  <x:Description x:about="GO_0040011" y:label="by attribute" g:hasOBONamespace="biological_process">
    <x:type x:resource="http://www.w3.org/2002/07/owl#Class"/>
    <y:subClassOf x:nodeID="r"/><y:subClassOf x:parseType="Resource"><z:onProperty x:resource="RO_2"/><z:someValuesFrom x:resource="GO_0008150"/></y:subClassOf>
    <y:subClassOf><z:Class><z:intersectionOf x:parseType="Collection"><x:Description x:about="GO_0008150"/></z:intersectionOf></z:Class></y:subClassOf>
    <y:comment x:parseType="Literal">some <b>markup <y:label>no label</y:label></b></y:comment>
  </x:Description>
  <z:Restriction x:nodeID="r"><z:someValuesFrom><z:Class x:about="GO_0008150"><y:label>root</y:label></z:Class></z:someValuesFrom><z:onProperty x:resource="BFO_0000050"/></z:Restriction>
  <z:Class><y:label>nameless</y:label></z:Class>
</x:RDF>"""


def test_ontologies_in_other_spellings(spark, tmp_path):
    path = tmp_path / "other.owl.gz"
    path.write_bytes(gzip.compress(OTHER.encode()))
    ontology, report = Ontology.from_owl(spark, str(path))
    assert not report
    assert {(t.identifier, t.label, t.namespace) for t in ontology.terms.collect()} == {("GO:0040011", "by attribute", "biological_process"), ("GO:0008150", "root", "")}
    assert {tuple(e) for e in ontology.edges.collect()} == {("GO:0040011", r, "GO:0008150") for r in ("part_of", "RO:2")}


def test_triples_of_the_grammars_abbreviations():
    from termdrift.sources.rdfxml import RDF, triples

    text = b'<r:RDF xmlns:r="%s" xmlns="p:"><A r:ID="i"><r:li>x</r:li><r:li r:resource="p:o"/><c r:parseType="Collection"><B r:about="p:b"/><B r:nodeID="n"/></c><e d="v"/></A></r:RDF>' % RDF.encode()
    got = {t for part in triples(iter([text[:70], text[70:]]), "http://h/d") for t in part}
    s = "http://h/d#i"
    assert {
        (s, RDF + "type", "p:A", "uri"), (s, RDF + "_1", "x", "literal"), (s, RDF + "_2", "p:o", "uri"), ("p:b", RDF + "type", "p:B", "uri"), ("_:nn", RDF + "type", "p:B", "uri"),
        ("_:1", RDF + "first", "p:b", "uri"), ("_:1", RDF + "rest", "_:2", "blank"), ("_:2", RDF + "first", "_:nn", "blank"), ("_:2", RDF + "rest", RDF + "nil", "uri"),
        (s, "p:c", "_:1", "blank"), (s, "p:e", "_:3", "blank"), ("_:3", "d", "v", "literal"),
    } == got


def test_broken_and_empty_ontology_files(spark, tmp_path):
    with pytest.raises(ValidationError, match="INVALID_OWL"):
        Ontology.from_owl(spark, put(tmp_path / "a.owl", OWL[:900]))
    ontology, report = Ontology.from_owl(spark, put(tmp_path / "b.owl", "no xml"), strict=False)
    assert ontology.count() == 0 and [r.code for r in report.issues.collect()] == ["INVALID_OWL"]
    none = '<rdf:RDF xmlns:rdf="r" xmlns:owl="o"><owl:Ontology rdf:about="x"/></rdf:RDF>'
    with pytest.raises(ValidationError, match="EMPTY_GO_ONTOLOGY"):
        Ontology.from_owl(spark, put(tmp_path / "c.owl", none))


def test_stream_of_annotation_rows(spark, tmp_path):
    from termdrift.streaming.rows import stream_annotations, stream_lines

    (tmp_path / "in").mkdir()
    put(tmp_path / "in" / "a.gaf", "!gaf-version: 2.2\n" + row() + "\n" + row(c9="X") + "\n")
    good, issues = stream_annotations(stream_lines(spark, str(tmp_path / "in")))
    for name, table in (("good", good), ("issues", issues)):
        table.writeStream.format("memory").queryName(f"stream_{name}").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("stream_good").count() == 1
    assert [r.code for r in spark.table("stream_issues").collect()] == ["INVALID_GAF_ASPECT"]
