"""Operators over whole tables: mixing, SimHash, top-k, archives, chats, toxicity, the pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from .test_similar import brute_kept
from termdrift.llm import chat, common, components, mixing, simhash, topk, toxicity, warc


def brute_mix(sizes, mix):
    """Words wanted by bisection on the common level."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    low, high = 0.0, 10.0 * sum(sizes) + 1
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(w * mid, mix.passes * s) for w, s in zip(weights, sizes)) < mix.share * sum(sizes):
            low = mid
        else:
            high = mid
    return [min(w * high, mix.passes * s) for w, s in zip(weights, sizes)]


def test_targets():
    draw = random.Random(3)
    for _ in range(200):
        sizes = [draw.choice((0, 1, 10, 1000, 12345)) * draw.randint(0, 9) for _ in range(draw.randint(1, 12))]
        assert mixing.targets(sizes) == pytest.approx(brute_mix(sizes, mixing.Mix()), abs=1e-3)
    assert mixing.targets([]) == []


def test_permutations_and_shards():
    for n in (1, 2, 5, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, "k").tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, "k").tolist() != mixing.permuted(np.arange(1000), 1000, "l").tolist()
    counts, mix = np.array([700, 0, 41, 3000]), mixing.Mix(shard_slots=64)
    shards = -(-int(counts.sum()) // 64)
    shard, source, k = mixing.shard_slots(counts, 0, shards, mix)
    for s, n in enumerate(counts.tolist()):
        assert sorted(k[source == s].tolist()) == list(range(n))
    assert np.bincount(shard).tolist() == [64] * 58 + [29]
    part = mixing.shard_slots(counts, 5, 9, mix)
    assert all(p.tolist() == w[5 * 64 : 9 * 64].tolist() for p, w in zip(part, (shard, source, k)))


@pytest.mark.parametrize("scale", [10**3, 10**6, 10**10, 10**14])
def test_shards_are_multinomial_draws_at_every_size(scale):
    counts, n = np.array([5 * scale, 2 * scale, 0, 3 * scale]), 400
    at = 7 * scale // 1024 - n if scale > 10**5 else 0
    n = min(n, -(-int(counts.sum()) // 1024) - 1)
    drawn = {}
    for seed in (1, 2):
        shard, source, _ = mixing.shard_slots(counts, at, at + n, mixing.Mix(seed=seed))
        drawn[seed] = np.array([np.bincount(source[shard == at + i], minlength=4) for i in range(n)])
        assert (drawn[seed].sum(1) == 1024).all() and (drawn[seed][:, 2] == 0).all()
        if n > 100:
            share = counts / counts.sum()
            assert np.abs(drawn[seed].mean(0) / 1024 - share).max() < 0.004
            spread, want = drawn[seed].std(0), np.sqrt(1024 * share * (1 - share))
            assert (np.abs(spread - want) <= 0.15 * want).all()
    assert (drawn[1] != drawn[2]).any()


def brute_taken(rows, mix=mixing.Mix()):
    """Words taken of each row, by laying out every word and every slot one by one. rows: (doc_id, words, source) by place."""
    out = Counter()
    sizes = [sum(n for _, n, s in rows if s == src) for src in sorted({s for _, _, s in rows})]
    wanted = mixing.targets(sizes, mix)
    slots = np.array([mixing.slots_of(n, t, mix) for n, t in zip(sizes, wanted)])
    times = Counter()
    for place in range(int(slots.sum())):
        drawn = int(mixing.permuted(np.array([place]), int(slots.sum()), f"{mix.seed}:slots")[0])
        s = 0
        while drawn >= slots[s]:
            drawn -= int(slots[s])
            s += 1
        name, blocks = sorted({x for _, _, x in rows})[s], -(-sizes[s] // mix.block)
        block = int(mixing.permuted(np.array([drawn % blocks]), blocks, f"{mix.seed}:{name}:{drawn // blocks}")[0])
        times[name, block] += 1
    for name in {s for _, _, s in rows}:
        words = [i for i, n, s in rows if s == name for _ in range(n)]
        for w, i in enumerate(words):
            out[i] += times[name, w // mix.block]
    return out


def test_taken_words_are_those_of_slots_laid_out_one_by_one(spark, docs_of):
    draw = random.Random(8)
    rows = [(i, " ".join("w" * draw.choice((1, 40, 333))), draw.choice("abc")) for i in range(40)]
    df, mix = docs_of(rows), mixing.Mix(block=16, shard_slots=8, bucket_rows=5)
    sized = mixing.sized_documents(df.select("doc_id", "text", "source"))
    order = sorted(((r.start, r.doc_id, r["size"], r.source) for r in mixing.placed(sized, mixing.plan(sized, mix), mix).collect()))
    by_source = {}
    for start, _, n, s in order:  # the rows of a source lie end to end
        assert start == by_source.get(s, 0)
        by_source[s] = start + n
    want = brute_taken([(i, n, s) for _, i, n, s in order], mix)
    assert {r.doc_id: r.taken for r in mixing.taken_words(df, mix).collect()} == {i: want[i] for i in range(40)}


def test_running_sums_by_levels(spark):
    draw = random.Random(4)
    rows = [(s, b, draw.randint(0, 9)) for s in range(2) for b in draw.sample(range(200), 90)]
    got = mixing.running(spark.createDataFrame(rows, "s int, b long, w long"), ["s"], "b", "w", "before", width=4).collect()
    assert {(r.s, r.b): r.before for r in got} == {(s, b): sum(w for t, c, w in rows if t == s and c < b) for s, b, _ in rows}


def mixture_docs(docs_of):
    draw = random.Random(1)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(draw.choice((0, 1, 5, 300, 900)))), draw.choice(("b", "a", "c", None, "é"))) for i in range(150)]
    rows += [(200, None, "a"), (201, "", "z"), (None, "alone " * 50, "a"), (7, "again " * 40, "b"), (7, "again " * 40, "b"), (300, "long " * 20_000, "c")]
    return rows, docs_of(rows)


def test_mixing_meets_its_targets(spark, docs_of):
    rows, df = mixture_docs(docs_of)
    got = mixing.taken_words(df).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    names = sorted(s for s in size if s is not None) + [None]
    want = dict(zip(names, mixing.targets([size[s] for s in names])))
    by_id = {}
    for i, t, s in rows:
        by_id.setdefault((i, len((t or "").split())), s)
    taken = Counter()
    for r in got:
        source = by_id[r.doc_id, r["size"]]
        assert r.source_size == size[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for s in names:
        assert abs(taken[s] - want[s]) <= 2 * 128
    again = mixing.taken_words(df.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.taken_words(docs_of([])).count() == 0 and mixing.mix_documents(docs_of([])).count() == 0


def test_the_mixture_holds_what_is_taken(spark, docs_of):
    rows, df = mixture_docs(docs_of)
    words = Counter()
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    for r in mixed.collect():
        words[r.doc_id, r.source] += len(r.text.split())
        assert r.n_chars == len(r.text) and r["_new"] == "z" and set(r.text.split()) <= {w for i, t, _ in rows if i == r.doc_id for w in (t or "").split()}
    taken = Counter()
    for r in mixing.taken_words(df).collect():
        taken[r.doc_id] += r.taken
    total = Counter()
    for (i, _), n in words.items():
        total[i] += n
    assert total == Counter({i: n for i, n in taken.items() if n})


def brute_simhash(text):
    import xxhash

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints():
    for text in (None, "", "One", "one  TWO", "É é E\x0be", "a b c d e f g " * 30, "x\x1cy z w"):
        assert simhash.fingerprint(text) == brute_simhash(text)


@pytest.mark.parametrize("cell", [4096, 8])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    draw = random.Random(cell)
    nodes = {draw.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1, 1 << 63}
    for base in list(nodes)[:8]:
        x = base
        for _ in range(12):
            for _ in range(draw.randint(1, 5)):
                x ^= 1 << draw.randrange(64)
            nodes.add(x)
    hub = draw.getrandbits(64)
    nodes |= {hub ^ (1 << b) for b in range(64)}
    nodes = sorted(simhash.signed(x) for x in nodes)
    want = brute_components(nodes, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3)
    links = simhash.links(spark.createDataFrame([(n,) for n in nodes], "fp long").repartition(5))
    roots = {r.node: r.root for r in components.components(links).collect()}
    assert {n: roots.get(n, n) for n in nodes} == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(500, 500), (139, 700), (700, 139)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 140), 700]}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_of_odd_rows(spark, docs_of):
    draw = random.Random(2)
    text = " ".join(draw.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(i % 50) for i in range(400))
    rows = [(5, text, "a"), (3, text + " end", "b"), (9, text.upper(), "a"), (9, text.upper(), "a"), (None, text, "a"), (1, None, "a"), (2, "", "b"), (8, "other words here", "a"), (None, "alone it stands", "a"), (11, "long " * 50_000, "a")]
    df = docs_of(rows)
    want = brute_components(sorted({brute_simhash(t) for _, t, _ in rows}), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, t, _ in rows:
        if i is not None:
            key = want[brute_simhash(t)]
            least[key] = min(i, least.get(key, i))
    got = Counter(map(tuple, simhash.near_duplicates(df).collect()))
    assert got == Counter((i, f"{brute_simhash(t):016x}", least.get(want[brute_simhash(t)])) for i, t, _ in rows)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(x) for x in (*set(least.values()), None))
    assert simhash.near_duplicates(docs_of([])).count() == 0 and simhash.drop_near_duplicates(docs_of([])).count() == 0


def test_hot_keys_join_without_a_shuffle_of_theirs(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 10)
    left = spark.createDataFrame([(i % 3 if i < 90 else i, i) for i in range(100)] + [(None, 1)], "k long, x long")
    right = left.where("k IS NOT NULL").groupBy("k").agg(F.count("x").alias("n"), F.max("x").alias("most"))
    want = sorted(map(tuple, left.join(right.drop("n"), "k", "left").collect()), key=str)
    assert sorted(map(tuple, common.join_unique(left, right, ["k"], 101, "left").collect()), key=str) == want
    assert common.join_unique(left, right, ["k"], 101).count() == 100


def brute_top(rows, k=20):
    """Counter of (query_id, rank, vec_id, score) over rows (vec_id, whole numbers), each row for itself."""
    want = Counter()
    clamp = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    for n, (q, v) in enumerate(rows):
        if q % 20 == 0:
            best = sorted((-clamp(sum(a * b for a, b in zip(v, c))), i) for m, (i, c) in enumerate(rows) if m != n and len(c) == len(v))[:k]
            want.update((q, r + 1, i, -s) for r, (s, i) in enumerate(best))
    return want


@pytest.mark.parametrize("kind", ["spread", "ties", "small", "repeats", "large", "mixed", "huge"])
def test_top_k_is_that_of_all_pairs(spark, monkeypatch, kind):
    from math import floor

    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 100)
    monkeypatch.setattr(topk, "STRIP", 16)
    draw = np.random.default_rng(4)
    n = 15 if kind == "small" else 300
    scale = {"large": 1e6, "huge": 1e30}.get(kind, 1.0)
    rows = [(i, (scale * draw.normal(size=40)).tolist()) for i in range(n)]
    if kind == "ties":
        rows = [(i, v if i % 3 else rows[0][1]) for i, v in rows] + [(3, rows[0][1])]
    if kind == "repeats":
        rows += [(0, rows[1][1]), rows[20], rows[20], (40, [1.0, 2.0]), (7, [2.0, 1.0])]
    if kind == "mixed":
        rows = [(i, [float(x * 10.0 ** draw.integers(0, 13)) for x in v]) for i, v in rows]
    odd = [(1000, None), (1020, [1.0, None] * 20), (1040, [float("nan")] * 40), (1060, [float("inf")] * 40), (None, [1.0] * 40), (1080, []), (1100, [2.0, 3.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1, 2, 3, 4.0) for i, v in rows + odd], "vec_id long, embedding array<float>, rank int, query_id long, v int, floor double")
    fine = [(i, [floor(64 * x) for x in np.array(v, np.float32).astype(float).tolist()]) for i, v in rows]
    assert Counter(map(tuple, topk.top_k(df).collect())) == brute_top(fine)
    assert topk.top_k(df.limit(0)).count() == 0


def test_candidates_are_pruned():
    """Of vectors whose mass lies in few dimensions, few pairs reach the last block; floors prune more at the first one."""
    draw = np.random.default_rng(1)
    rows = np.floor(64 * draw.normal(size=(4000, 64)) * 0.9 ** np.arange(64))
    asked, numbers = rows[:50], np.arange(4000)
    told, again = Counter(), Counter()
    q, _, score = topk.search_block(asked, numbers[:50], rows, numbers, numbers, 20, told=told)
    assert told["pairs"] == 50 * 4000 and told["block 4"] <= told["block 2"] < 0.2 * told["pairs"]
    floor = np.array([min(s for i, s in zip(q, score) if i == j) for j in range(50)], float)
    found = topk.search_block(asked, numbers[:50], rows, numbers, numbers, 20, floor, again)
    assert found[0] == q and again["block 1"] < 0.6 * told["block 1"]


def test_archives_hold_the_pages(spark):
    big = "<p>" + "x" * 300_000
    same, short = "<p>" + "same " * 50, "<p>hi"
    rows = [(7, "http://a/7", same), (3, "http://a/3", same), (9, None, same), (9, None, same), (3, "http://a/3", same), (1, "http://a b\r\nX: y", short), (2, "u", short), (4, "é", None), (5, "u", ""), (None, "u", same), (None, "u", "<p>é" + "z" * 200), (6, "u", big), (8, "u", big + "\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, first string, n int")
    path = common.shared_path(spark, "test-warc")
    index = warc.archive_pages(pages.repartition(3), path)
    assert index.count() == len(rows)
    records = warc.read_records(index, path, payloads=True).collect()
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records)
    want = Counter()
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = h == same and i != 3
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None] += 1
    assert got == want
    assert {r.payload for r in records if r.page_id == 8} == {rows[-1][2]} and {r.payload for r in records if r.record_type == "revisit"} == {""}
    assert {r.url for r in records if r.page_id == 1} == {"http://a%20b%0D%0AX:%20y"}
    some = warc.read_records(index.where("page_id = 6"), path).collect()
    assert [r.payload_bytes for r in some] == [len(big)]
    spans = sorted((r.file, r.offset, r.offset + r.length) for r in index.collect())
    assert all(a[0] != b[0] or a[2] == b[1] for a, b in zip(spans, spans[1:]))
    assert warc.read_records(warc.archive_pages(pages.limit(0), common.shared_path(spark, "test-warc")), path).count() == 0


def test_neighbouring_ranges_are_read_together():
    far = warc.GAP_BYTES + 20
    assert warc.ranges([("a", 0, 10), ("a", 10, 5), ("a", 15 + far, 5), ("b", 0, 1)]) == [["a", 0, 15, [0, 1]], ["a", 15 + far, 20 + far, [2]], ["b", 0, 1, [3]]]


def brute_path(lines):
    """The best of all role sequences."""
    from itertools import product

    best = None
    for path in product(range(3), repeat=len(lines)):
        score = chat.START[path[0]]
        for i, (first, each, _) in enumerate(lines):
            score += each[path[i]] + ((chat.BETWEEN_ROWS if first else chat.WITHIN_ROW)[path[i - 1]][path[i]] if i else 0)
        if best is None or score > best[0]:
            best = (score, list(path))
    return best[1]


def test_viterbi_finds_the_best_path():
    draw = random.Random(7)
    texts = ["hi", "why?", "User: x", "### Assistant: y\nmore", "<|system|> be kind", "x" * 500, "", "Note: not a role"]
    for _ in range(40):
        rows = [(i, draw.choice((None, "user", "gpt", "??")), draw.choice(texts)) for i in range(draw.randint(1, 5))]
        lines = [x for r in rows for x in chat.lines_of(*r)]
        assert chat.viterbi(lines) == brute_path(lines)
    assert chat.viterbi([]) == []


def talk(n, seed):
    draw = random.Random(seed)
    out = [("system", "You answer briefly.")] if draw.random() < 0.3 else []
    for _ in range(n):
        out.append(("user", "what is " + "it " * draw.randint(1, 20) + "?"))
        out.append(("assistant", "It is " + "this and that. " * draw.randint(10, 60)))
    return out


def test_hidden_roles_are_recovered(spark):
    draw, rows, truth = random.Random(1), [], {}
    for c in range(60):
        for t, (role, text) in enumerate(talk(3, c)):
            truth[c, t] = role
            rows.append((c, t, role if draw.random() < 0.3 else None, text))
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert got.count() == len(rows)
    right = sum(truth[r.conv_id, r.turn] == r.role for r in got.collect())
    assert right >= 0.97 * len(rows)


def test_chats_of_odd_rows(spark):
    rows = [
        (1, 0, "human", "User: hi\nAssistant: hello\nagain"), (1, 1, None, "bye?"), (1, 1, None, "bye?"), (2, 0, "system", None), (2, 1, "user", ""), (2, None, "bot", "last"),
        (None, 0, "user", "a"), (None, 0, "user", "b"), (3, 0, "user", "<|im_end|> " + "x" * 100_000),
    ]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "conv_id long, turn long, role string, text string, part int, rendered string")
    got = chat.format_chats(df)
    found = Counter((r.conv_id, r.turn, r.part, r.role, r.rendered) for r in got.collect() if r.conv_id != 3)
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>"
    assert found == Counter({
        (1, 0, 0, "user", turn("user", "hi")): 1, (1, 0, 1, "assistant", turn("assistant", "hello\nagain")): 1, (2, 0, 0, "system", turn("system", "")): 1,
        (2, 1, 0, "user", turn("user", "")): 1, (2, None, 0, "assistant", turn("assistant", "last")): 1, (None, 0, 0, "user", turn("user", "a")): 1, (None, 0, 0, "user", turn("user", "b")): 1,
    } | {k: v for k, v in found.items() if k[:2] == (1, 1)})
    assert sum(v for k, v in found.items() if k[:2] == (1, 1)) == 2
    assert got.where("conv_id = 3").first().rendered.count("<|im_end|>") == 1
    assert chat.format_chats(df.limit(0)).count() == 0


def test_long_conversations_in_pieces(spark):
    draw = random.Random(9)
    rows = [(7, i, draw.choice([None, None, None, "user", "bot"]), "x" * draw.randint(1, 900) + draw.choice(["?", "", "\nAssistant: yes"])) for i in range(1500)]
    rows += [(8, 1, "user", "hi")] + [(9, i % 5, None, f"{'y' * (i % 77)}") for i in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    both = [sorted(map(tuple, chat.format_chats(df, long).collect()), key=str) for long in (150, 10_000)]
    assert both[0] == both[1]


TERMS = ["idiotic$", "scumbag$", "vequo", "lowei$"]


def edits(word):
    letters = "abcdefghijklmnopqrstuvwxyzé"
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return {a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in letters} | {a + c + b for a, b in cuts for c in letters}


def test_the_automaton_accepts_just_what_is_one_edit_away():
    lexicon = toxicity.Lexicon(TERMS)
    draw = random.Random(3)
    words = set().union(*(edits(t.rstrip("$")) for t in TERMS)) | {"".join(draw.choice("abcidotscumvequlow") for _ in range(draw.randint(1, 9))) for _ in range(3000)}
    words |= {w + s for w in edits("lowei") for s in ("", "ab")}
    for w in words:
        want = [i for i, t in enumerate(TERMS) if t.endswith("$") and w in edits(t[:-1]) | {t[:-1]}]
        assert lexicon.near(w) == min(want, default=-1)
    stems = toxicity.Lexicon(["vequois"])
    assert stems.near("vequoisment") == 0 and stems.near("vequuisment") == 0 and stems.near("veqoisment") == 0 and stems.near("vxquuisment") == -1


def test_quotation():
    quoted = toxicity.Matcher.quoted
    for text, want in (('he said "you idiot" to me', True), ("you idiot", False), ("the word idiot is old", True), ('"yes" you idiot', False), ("«une idiot»", True)):
        at = text.index("idiot")
        assert quoted(text, at, at + 5) is want


def labelled(n, seed):
    draw = random.Random(seed)
    common_words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(draw.random() < 0.2)
        words = [draw.choice(common_words) for _ in range(draw.randint(20, 120))]
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(("moronic", "scumbag", "vequoi" + draw.choice("abcdef"))))
        rows.append((i, " ".join(words), "a"))
        labels.append((i, toxic))
    return rows, labels


def test_toxicity_is_learned_and_held_out_rows_are_not_used(spark, docs_of):
    rows, labels = labelled(900, 1)
    plain = " ".join(f"wordaa word{i}" for i in range(30))
    more = [(9001, None, "a"), (9002, "", "a"), (None, plain, "a"), (9003, plain + " what a moronik scumbga you are moroniic", "a"), (9004, plain, "a"), (9004, plain, "a"), (9005, plain * 2000, "a")]
    df = docs_of([*rows, *more])
    table = spark.createDataFrame([(i, 1, t, "x") for i, t in labels] + [(None, 1, 1, "x"), (9001, 1, None, "x")], "doc_id long, quality int, toxic int, text string")
    model = toxicity.learn(df, table)
    got = toxicity.score_documents(df, model).collect()
    assert len(got) == len(rows) + len(more) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth, held = dict(labels), lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    test = [(truth[r.doc_id], r.predicted) for r in got if r.doc_id in truth and held(r.doc_id)]
    assert len(test) > 150 and sum(a == b for a, b in test) >= 0.98 * len(test)
    by_id = {r.doc_id: r for r in got}
    assert by_id[9003].predicted == 1 and not any(by_id[i].predicted for i in (9001, 9002, 9004, 9005, None))
    flipped = table.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = toxicity.learn(df, flipped)
    assert (other.terms, other.beta) == (model.terms, model.beta)
    assert {r.held_out for r in df.where("doc_id = 4").select(toxicity.held_out().alias("held_out")).collect()} == {held(4)}
    nothing = toxicity.learn(df, table.limit(0))
    assert {r.score for r in toxicity.score_documents(df, nothing).collect()} == {0.0}


def test_the_pipeline(spark):
    import os

    import corpus_pipeline
    from termdrift.llm import byte_bpe, line_quality, secrets

    sf = "/root/testdata/sf0.001"
    assert os.path.isdir(sf)
    docs, judge = common.documents(spark, sf), line_quality.LineCleaner().judge
    one = common.written(corpus_pipeline.STAGES[0][1](spark, docs, sf), "test")
    judged = {r.doc_id: judge(r.text) for r in docs.collect()}
    assert {r.doc_id: r.text for r in one.collect()} == {i: x["cleaned"] for i, x in judged.items() if x["kept"]}
    two = common.written(corpus_pipeline.STAGES[1][1](spark, one, sf), "test")
    texts = {r.doc_id: r.text for r in one.collect()}
    first = brute_kept(texts)
    assert {r.doc_id: r.text for r in two.collect()} == {i: texts[i] for i in first}
    redact = secrets.SecretScanner(secrets.learn(two)).redact
    three = common.written(corpus_pipeline.STAGES[2][1](spark, two, sf), "test")
    assert {r.doc_id: r.text for r in three.collect()} == {i: redact(texts[i]) for i in first}
    four = common.written(corpus_pipeline.STAGES[3][1](spark, three, sf), "test")
    assert one.columns == two.columns == three.columns == four.columns == docs.columns
    taken = Counter({r.doc_id: r.taken for r in mixing.taken_words(three).collect() if r.taken})
    words = Counter()
    for r in four.collect():
        words[r.doc_id] += len(r.text.encode().split())
    assert words == taken
    last = corpus_pipeline.STAGES[4][1](spark, four, sf)
    back = byte_bpe.decode_documents(last, byte_bpe.vocabulary()[0])
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((r.doc_id, r.text) for r in four.collect())
    assert Counter(map(str, corpus_pipeline.run(spark, sf).collect())) == Counter(map(str, last.collect()))


def test_the_pipeline_of_odd_rows(spark, docs_of):
    import corpus_pipeline

    clean = "The river ran past the old mill and into the valley where the people lived. They had built houses of stone there."
    rows = [(1, None, "a"), (2, "", "a"), (3, clean, None), (3, clean, None), (None, clean + " Others came later.", "a"), (4, " ".join(f"word{i} is here." for i in range(30_000)), "b")]
    for table, kept in ((docs_of(rows), [3, 4]), (docs_of([]), [])):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = common.written(stage(spark, docs, ""), "test")
            assert docs.columns == table.columns
        last = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
        assert sorted({r.doc_id for r in last if r.doc_id is not None}) == kept and all(r.n_tokens == len(r.ids) > 0 for r in last)
