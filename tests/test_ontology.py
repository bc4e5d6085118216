import random

import pytest

from termdrift import Ontology


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "term_id string")


def ancestors(ontology, *names, **how):
    return {(r.term_id, r.ancestor) for r in ontology.ancestors_of(ids(ontology.spark, *names), **how).collect()}


def test_alternate_identifiers_and_closures(spark):
    terms = ["GO:1", "GO:2", ("GO:3", {"alternate_ids": ["GO:30"]})]
    o = Ontology.of(spark, terms, [("GO:3", "is_a", "GO:2"), ("GO:2", "part_of", "GO:1"), ("GO:3", "RO:9", "GO:1")])
    assert o.resolve_id("GO:30") == "GO:3" and "GO:30" in o and "GO:4" not in o
    assert {r.parent for r in o.parents_of(ids(spark, "GO:30")).collect()} == {"GO:2"}
    assert {r.parent for r in o.parents_of(ids(spark, "GO:3"), relations=("RO:9",)).collect()} == {"GO:1"}
    assert ancestors(o, "GO:30", "GO:5") == {("GO:30", "GO:2"), ("GO:30", "GO:1")}
    assert ancestors(o, "GO:3", include_self=True, relations=("is_a",)) == {("GO:3", "GO:3"), ("GO:3", "GO:2")}
    assert {r.ancestor for r in o.propagate(ids(spark, "GO:30", "nothing")).collect()} == {"GO:3", "GO:2", "GO:1"}
    assert [(r.child, r.relation, r.parents) for r in o.grouped_edges().where("relation = 'RO:9'").collect()] == [("GO:3", "RO:9", ["GO:1"])]
    assert {(r.term_id, r.canonical_id) for r in o.resolve_ids(ids(spark, "GO:30", "GO:9")).collect()} == {("GO:30", "GO:3"), ("GO:9", None)}


def test_the_last_claim_of_an_alternate_identifier_wins(spark):
    o = Ontology.of(spark, [("GO:2", {"alternate_ids": ["GO:9"]}), ("GO:1", {"alternate_ids": ["GO:9", "GO:2"]})])
    assert o.resolve_id("GO:9") == "GO:1" and o.resolve_id("GO:2") == "GO:2"


def test_the_last_of_equal_terms_counts(spark):
    schema = "identifier string, label string, namespace string, obsolete boolean, alternate_ids array<string>, replaced_by array<string>, consider array<string>, ordinal long"
    rows = [("GO:1", "old", "molecular_function", False, ["GO:8"], [], [], 1), ("GO:2", "x", "", False, ["GO:8"], [], [], 2), ("GO:1", "new", "biological_process", False, ["GO:8"], [], [], 3)]
    o = Ontology(spark.createDataFrame(rows, schema))
    assert {(t.identifier, t.label, t.namespace) for t in o.terms.collect()} == {("GO:1", "new", "biological_process"), ("GO:2", "x", "")}
    assert o.resolve_id("GO:8") == "GO:2"  # a repeated term keeps its first place
    assert Ontology(spark.createDataFrame(rows, schema).drop("ordinal")).count() == 2


def projected(old, new, *names):
    rows = old.project_from(new, ids(old.spark, *names)).collect()
    return {(r.term_id, r.source_term, r.target_term, r.distance, r.kind) for r in rows}


def test_projection_of_each_kind(spark):
    old = Ontology.of(spark, ["R", "A", ("B", {"alternate_ids": ["B2"]})])
    edges = [("N", "is_a", "M"), ("M", "part_of", "A"), ("M", "is_a", "B2"), ("M", "is_a", "X"), ("X", "is_a", "R"), ("Q", "is_a", "Q2"), ("Q2", "is_a", "Q"), ("Z", "RO:1", "A")]
    new = Ontology.of(spark, ["R", "A", "B2", "M", ("N", {"alternate_ids": ["N2"]}), "X", "Q", "Q2", "Z"], edges)
    assert projected(old, new, "A", "B2", "N2", "Q", "Z", "none") == {
        ("A", "A", "A", 0, "same"), ("B2", "B2", "B", 0, "alternate_id"), ("N2", "N", "A", 2, "nearest_ancestor"), ("N2", "N", "B", 2, "nearest_ancestor"),
        ("Q", "Q", None, None, "unmappable"), ("Z", "Z", None, None, "unmappable"), ("none", "none", None, None, "unknown_source_term"),
    }


@pytest.mark.parametrize(
    "edges, cyclic",
    [
        ([("A", "is_a", "B"), ("B", "part_of", "A")], True),
        ([("A", "is_a", "A")], True),
        ([("A", "is_a", "B"), ("A", "is_a", "C"), ("B", "is_a", "D"), ("C", "is_a", "D")], False),
        ([("A", "is_a", "B"), ("B", "is_a", "C"), ("C", "is_a", "B2")], True),
        ([("A", "is_a", "B"), ("B", "RO:1", "A")], False),
    ],
)
def test_cycles(spark, edges, cyclic):
    o = Ontology.of(spark, ["A", ("B", {"alternate_ids": ["B2"]}), "C", "D"], edges)
    assert o.has_cycle() is cyclic
    assert ("ONTOLOGY_CYCLE" in {r.code for r in o.validate().issues.collect()}) is cyclic


def test_within_a_cycle_a_term_is_its_own_ancestor(spark):
    o = Ontology.of(spark, ["A", "B"], [("A", "is_a", "B"), ("B", "is_a", "A")])
    assert ancestors(o, "A") == {("A", "A"), ("A", "B")}


def test_validation(spark):
    o = Ontology.of(spark, [("A", {"alternate_ids": ["B"]}), "B"], [("X", "is_a", "A"), ("X", "RO:1", "A"), ("A", "RO:1", "Y"), ("A", "RO:2", "Y")])
    assert sorted(r.code for r in o.validate().issues.collect()) == [
        "AMBIGUOUS_ALTERNATE_ID", "MISSING_GO_ROOTS", "UNKNOWN_ONTOLOGY_CHILD", "UNKNOWN_ONTOLOGY_PARENT", "UNKNOWN_ONTOLOGY_PARENT",
    ]
    assert not Ontology.of(spark, ["GO:0008150"]).validate() and not Ontology.of(spark, []).validate()


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_agree_with_a_plain_walk(spark, seed):
    draw = random.Random(seed)
    names = [f"T{i}" for i in range(40)]
    edges = [(names[i], draw.choice(("is_a", "part_of", "RO:1")), names[draw.randrange(i)]) for i in range(1, 40) for _ in range(draw.randint(0, 2))]
    if seed == 2:
        edges += [(names[5], "is_a", names[30]), (names[30], "is_a", names[5])]
    kept = {n for n in names if draw.random() < 0.3}
    new, old = Ontology.of(spark, names, edges), Ontology.of(spark, sorted(kept))
    up = {n: {p for c, r, p in edges if c == n and r != "RO:1"} for n in names}
    want, above = set(), set()
    for n in names:
        seen, level, d, hits = {n}, {n}, 0, {n} & kept
        while level and not hits:
            level, d = {p for m in level for p in up[m]} - seen, d + 1
            seen |= level
            hits = level & kept
        kind = "same" if hits and not d else "nearest_ancestor" if hits else "unmappable"
        want |= {(n, n, h, d, kind) for h in hits} or {(n, n, None, None, kind)}
        reached, todo = set(), set(up[n])
        while todo:
            reached |= todo
            todo = {p for m in todo for p in up[m]} - reached
        above |= {(n, a) for a in reached}
    assert projected(old, new, *names) == want
    assert ancestors(new, *names) == above


def test_every_claim_of_an_identifier_may_count(spark):
    terms = [("GO:1", {"alternate_ids": ["GO:3"]}), ("GO:2", {"alternate_ids": ["GO:3", "GO:9"]}), "GO:3", ("GO:4", {"alternate_ids": ["GO:9"]})]
    edges = [("GO:1", "is_a", "A"), ("GO:2", "is_a", "B"), ("GO:3", "is_a", "C"), ("GO:4", "is_a", "D")]
    one = Ontology.of(spark, terms, edges)
    o = Ontology(one.terms, one.edges, every_claim=True)
    assert {(r.term_id, r.canonical_id) for r in o.resolve_ids(ids(spark, "GO:3", "GO:9", "GO:8")).collect()} == {
        ("GO:3", "GO:1"), ("GO:3", "GO:2"), ("GO:3", "GO:3"), ("GO:9", "GO:2"), ("GO:9", "GO:4"), ("GO:8", None),
    }
    assert o.resolve_id("GO:3") == "GO:3" and o.resolve_id("GO:9") == "GO:4" and o.resolve_id("GO:8") is None
    assert {r.parent for r in o.parents_of(ids(spark, "GO:3")).collect()} == {"A", "B", "C"}
    assert ancestors(o, "GO:3", "GO:4", "GO:9") == {("GO:3", x) for x in "ABC"} | {("GO:4", "D"), ("GO:9", "B"), ("GO:9", "D")}
    assert {r.ancestor for r in o.propagate(ids(spark, "GO:9")).collect()} == {"GO:2", "GO:4", "B", "D"}
    got = Ontology.of(spark, ["A", "GO:2"]).project_from(o, ids(spark, "GO:3", "GO:9")).collect()
    assert {(r.term_id, r.source_term, r.target_term, r.kind) for r in got} == {
        ("GO:3", "GO:1", "A", "nearest_ancestor"), ("GO:3", "GO:2", "GO:2", "same"), ("GO:3", "GO:3", "A", "nearest_ancestor"),
        ("GO:9", "GO:2", "GO:2", "same"), ("GO:9", "GO:4", None, "unmappable"),
    }
    assert {r.code for r in one.validate().issues.collect()} - {r.code for r in o.validate().issues.collect()} == {"AMBIGUOUS_ALTERNATE_ID"}
