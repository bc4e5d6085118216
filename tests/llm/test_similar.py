import random

import pytest
from pyspark.sql import functions as F

from termdrift.llm import similar, simhash


def brute_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_kept(texts):
    """The least id of each group of texts (id -> text) that 5-word sets of 0.8 or more link."""
    found, root = {i: brute_shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    for a in texts:
        for b in texts:
            if root[a] != root[b] and len(found[a] & found[b]) / len(found[a] | found[b]) >= 0.8:
                low, high = sorted((root[a], root[b]))
                root.update({i: low for i in root if root[i] == high})
    return {i for i in texts if root[i] == i}


def test_near_copies_in_the_pipeline(spark):
    import corpus_pipeline

    rng = random.Random(1)
    texts, n = {1: None, 2: "", 3: "one two", 4: "One  TWO"}, 10
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(30, 300))]
        for changes in (0, 0, 1, 2, 3, 5, 9):
            copy = list(words)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            texts[n], n = " ".join(copy), n + 1
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    want = brute_kept(texts)
    got = corpus_pipeline.near_dedup(spark, df, "").collect()
    assert {r.doc_id: r.text for r in got} == {i: texts[i] for i in want} and len(got) == len(want)
    assert {r.doc_id for r in simhash.drop_near_duplicates(df).collect()} - want  # what 3 bits leave


def test_a_chain_of_near_copies_is_one_group(spark):
    words = [f"w{i}" for i in range(104)]  # 100 shingles; each copy has two more words changed at its end
    texts = {i: " ".join(words[: 104 - 4 * i] + [f"x{k}" for k in range(4 * i)]) for i in range(8)}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    assert {r.doc_id for r in similar.drop_near_copies(df).collect()} == brute_kept(texts)
    assert similar.drop_near_copies(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 5, 6, 700])
def test_shingles_and_bands(n):
    text = " ".join(f"w{i}" for i in range(n))
    found = similar.shingles(text)
    assert len(found) == len(brute_shingles(text)) and len(set(similar.bands(similar.least_hashes(found)).tolist())) == similar.BANDS


def test_sketches_tell_how_far_sets_are_apart(spark):
    rng = random.Random(2)
    least = [similar.least_hashes(similar.shingles(" ".join(f"w{rng.randrange(30)}" for _ in range(200)))) for _ in range(2)]
    want = int(((least[0] ^ least[1]) & 15 != 0).sum())
    row = {f"{c}{i}": int(x) for c, found in zip("ab", map(similar.sketch, least)) for i, x in enumerate(found)}
    one = spark.createDataFrame([row], ", ".join(f"{c} long" for c in row))
    assert want > similar.APART and one.select(similar.apart("a", "b")).first()[0] == want
    assert one.select(similar.apart("a", "a")).first()[0] == 0


@pytest.mark.parametrize("cell", [2, 4096])
def test_copies_that_share_no_band_with_the_least_one_meet(spark, monkeypatch, cell):
    monkeypatch.setattr(similar, "CELL", cell)
    rng = random.Random(3)
    base, texts = [f"w{rng.randrange(9000)}" for _ in range(120)], {}
    for i in range(40):  # a passage of all, and ends of two kinds: some pairs are similar enough, some just not
        end = [f"{'a' if i % 2 else 'b'}{k}" if rng.random() < 0.97 else f"c{rng.randrange(99)}" for k in range(40)]
        texts[i] = " ".join(base + end)
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    assert {r.doc_id for r in similar.drop_near_copies(df).collect()} == brute_kept(texts)


def test_across_gives_each_near_pair_of_different_components_once(spark, monkeypatch):
    monkeypatch.setattr(similar, "CELL", 2)
    rng = random.Random(4)
    sketches = {i: [rng.choice((0, 1 << 40))] * similar.LONGS for i in range(30)}
    rows = [(i, 10, key, i % 4 if i % 3 else 7) for i in range(30) for key in (1, 2) if (i + key) % 5]
    met = spark.createDataFrame(rows, "id long, size long, key long, root long")
    nodes = spark.createDataFrame(list(sketches.items()), "id long, sketch array<bigint>")
    want = {(a, b) for a, _, k, r in rows for b, _, l, q in rows if k == l and a < b and r != q}
    got = [tuple(r) for r in similar.across(met, len(rows), nodes).collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("cell", [3, 512])
def test_across_makes_no_row_of_a_pair(spark, monkeypatch, cell):
    monkeypatch.setattr(similar, "CELL", cell)
    rng, texts, n = random.Random(5), {}, 60
    base = [f"w{i}" for i in range(200)]
    for i in range(n):  # all alike and each a component: 1,770 near pairs, some similar enough
        words = list(base)
        for _ in range(rng.choice((2, 3, 4))):
            words[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = similar.banded(df, ("doc_id",)).cache()
    of = {r.doc_id: r.id for r in rows.collect()}
    keyed = rows.selectExpr("id", "size", "id AS root", "explode(bands) AS key")
    found = similar.across(keyed, 40 * n, rows.select("id", "bands", "sketch"), similar.sets(df)).collect()
    shared = keyed.groupBy("key").count().where("count > 1").agg({"count": "sum"}).first()[0]
    assert len(found) < (shared if cell == 512 else 4 * shared) and len(set(found)) == len(found)
    whole = {of[i]: brute_shingles(t) for i, t in texts.items()}
    assert all(u < v and len(whole[u] & whole[v]) / len(whole[u] | whole[v]) >= 0.8 for u, v in found)
    root = {i: i for i in texts}
    at = {v: k for k, v in of.items()}
    for u, v in found:
        low, high = sorted((root[at[u]], root[at[v]]))
        root.update({i: low for i in root if root[i] == high})
    assert {i for i in texts if root[i] == i} == brute_kept(texts)


def test_keys_without_a_partner_go_through_no_join_of_their_own(spark):
    left = spark.createDataFrame([(i, k) for i, k in enumerate([7] * 50 + list(range(100, 160)) + [8, 8])], "id long, key long")
    right = spark.createDataFrame([(7, 50, "a"), (8, 2, "b")], "key long, n long, name string")
    for total in (112, 60_000, 10**7):  # all keys are hot, one is, none is
        got = similar.by_key(left, right, total)
        assert sorted(r.name for r in got.collect()) == ["a"] * 50 + ["b"] * 2
        assert "LeftOuter" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_links_of_simhash_are_candidates(spark):
    """Near copies that share no band are found if their fingerprints differ in three bits at most, and then confirmed."""
    rng = random.Random(6)
    texts = {}
    for k in range(6):
        words = [f"w{rng.randrange(100_000)}" for _ in range(2500)]
        for changes in (0, 1, 2, 40):
            copy = list(words)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(100_000)}"
            texts[10 * k + changes] = " ".join(copy)
    texts |= {100: "a b c", 101: "a b d", 102: ""}
    marks = {i: simhash.majority(similar.shingles(t)) for i, t in texts.items()}
    alike = lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 3 and len((x := brute_shingles(texts[a])) & (y := brute_shingles(texts[b]))) / len(x | y) >= 0.8
    root = {i: i for i in texts}
    for a in texts:
        for b in texts:
            if root[a] != root[b] and alike(a, b):
                low, high = sorted((root[a], root[b]))
                root.update({i: low for i in root if root[i] == high})
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").withColumn("row_hash", F.col("doc_id"))
    rows = similar.banded(df, ("doc_id", "row_hash")).withColumn("bands", F.transform(F.sequence(F.lit(1), F.lit(similar.BANDS)), lambda i: F.xxhash64("id", i))).cache()
    got = rows.join(similar.roots(rows, df), "id").groupBy("root").agg(F.min("doc_id").alias("least")).collect()
    want = {i for i in texts if root[i] == i}
    assert {r.least for r in got} == want and len(want) < len(texts) - 4
