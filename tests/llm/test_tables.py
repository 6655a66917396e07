"""Operators over whole tables against brute force on small ones."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spark_curate.llm import chat, neighbours, simhash, suffix_tree
from spark_curate.llm.common import remainder
from spark_curate.llm.components import components

from .conftest import prose


def rows(df):
    return [r.asDict() for r in df.collect()]


# near-duplicates


def plain_fingerprint(text):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in text or "").split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def near_copies():
    base = prose(70, 300).split()
    docs = []
    for k in range(40):
        rng = random.Random(k)
        copy = list(base)
        copy[rng.randrange(len(copy))] = f"changed{k}"
        docs.append((100 + k, " ".join(copy)))
    return docs + [(200 + k, prose(200 + k, 150)) for k in range(40)]


def test_components_of_fingerprints(make, awkward):
    pairs = awkward + near_copies()
    found = rows(simhash.near_duplicates(make(pairs)))
    assert len(found) == len(pairs)
    prints = [plain_fingerprint(t) for _, t in pairs]
    roots = plain_components(prints, 4)
    least = {}
    for (i, _), r in zip(pairs, roots, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = Counter((i, p, least.get(r)) for (i, _), p, r in zip(pairs, prints, roots, strict=True))
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found) == want
    assert len(set(roots)) < len(pairs) - 30


def test_keeping_one_of_each(make, awkward):
    pairs = awkward + near_copies()
    docs = make(pairs)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in rows(kept)]
    roots = plain_components([plain_fingerprint(t) for _, t in pairs], 4)
    groups = {}
    for (i, _), r in zip(pairs, roots, strict=True):
        groups.setdefault(r, []).append(i)
    want = [min((i for i in g if i is not None), default=None) for g in groups.values()]
    assert Counter(ids) == Counter(want)


def test_rows_keep_their_numbers_when_the_split_changes(spark, make, tmp_path, monkeypatch):
    """The files are split otherwise while the stage runs, as when an executor is lost."""
    pairs = near_copies()
    make(pairs).repartition(8, "doc_id").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    setting = "spark.sql.files.minPartitionNum"
    monkeypatch.setattr(simhash, "materialize", _then(simhash.materialize, lambda: spark.conf.set(setting, "37")))
    try:
        spark.conf.set(setting, "1")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        kept = rows(simhash.keep_one(docs))
    finally:
        spark.conf.unset(setting)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    roots = plain_components([plain_fingerprint(t) for _, t in pairs], 4)
    assert Counter(r["doc_id"] for r in kept) == Counter(
        min(i for (i, _), r in zip(pairs, roots, strict=True) if r == root) for root in set(roots)
    )


def _then(call, after):
    def both(df):
        made = call(df)
        after()
        return made

    return both


def clusters(n, seed, flips):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    values = {int(c) for c in centres}
    while len(values) < n:
        v = int(centres[rng.integers(3)])
        for b in rng.integers(0, 64, flips):
            v ^= 1 << int(b)
        values.add(v)
    return np.array(sorted(values), np.uint64)


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_tree_search_finds_all(radius):
    values = clusters(400, 3, 5)
    rng = np.random.default_rng(0)
    tree = simhash.BKTree(rng.permutation(values))
    queries = values[:90] ^ np.uint64(1 << 7)
    found = set(zip(*(x.tolist() for x in tree.search(queries, radius)), strict=True))
    near = np.bitwise_count(queries[:, None] ^ tree.values[None, :]) <= radius
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))
    assert len({*tree.child[tree.child >= 0].tolist()}) == len(values) - 1


@pytest.mark.parametrize("radius,tree_rows", [(4, 16), (4, 4096), (1, 50)])
def test_links_of_dense_groups_in_small_trees(spark, radius, tree_rows):
    values = clusters(250, 11, 6)
    classes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    linked = {r["node"]: r["root"] for r in rows(components(simhash.links(classes, radius, tree_rows)))}
    prints = [int(v) for v in values]
    roots = plain_components(prints, radius)
    signed = values.view(np.int64).tolist()
    got = [linked.get(s, s) for s in signed]
    pairs = set(zip(roots, got, strict=True))
    assert len(pairs) == len(set(roots)) == len(set(got))


def chains(n, seed, length=12):
    """Shuffled distinct values: walks of ``length`` steps of four changed bits each."""
    rng = np.random.default_rng(seed)
    values = {}
    while len(values) < n:
        v = int(rng.integers(0, 1 << 63))
        for _ in range(length):
            for b in rng.choice(64, 4, replace=False):
                v ^= 1 << int(b)
            values[v] = None
    return rng.permutation(np.array([*values][:n], np.uint64))


def joined(values, edges):
    """The least position reachable from each position."""
    labels = np.arange(len(values))
    a, b = edges
    while True:
        before = labels.copy()
        least = np.minimum(labels[a], labels[b])
        np.minimum.at(labels, a, least)
        np.minimum.at(labels, b, least)
        if np.array_equal(before, labels):
            return labels


@pytest.mark.parametrize("n,asking", [(1500, 0), (1300, 200), (200, 1300), (750, 750)])
def test_links_of_a_unit_asked_in_batches(n, asking):
    values = chains(n + asking, 5)
    tree, asked = values[:n], values[n:] if asking else None
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    if asking:
        near[:n, :n] = near[n:, n:] = False
    want = joined(values, np.nonzero(near))
    place = {int(v): k for k, v in enumerate(values.view(np.int64))}
    found = [(place[a], place[b]) for a, b in simhash.shard_links(tree, asked, 4)]
    got = joined(values, np.array(found).T)
    assert np.array_equal(got, want)
    assert len(found) == len(values) - len(set(want.tolist()))


def test_links_of_a_shard_of_many_rows(spark):
    values = chains(1400, 8, 40) & np.uint64((1 << 48) - 1)  # under a mask all have one key
    values = np.unique(values)
    classes = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    want = joined(values, np.nonzero(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4))
    for tree_rows in (300, 700, 4096):
        linked = {r["node"]: r["root"] for r in rows(components(simhash.links(classes, 4, tree_rows)))}
        got = [linked.get(s, s) for s in values.view(np.int64).tolist()]
        assert len(set(zip(want.tolist(), got, strict=True))) == len(set(want.tolist())) == len(set(got))


def test_band_masks_leave_one_untouched():
    rng = random.Random(1)
    for rows_, radius in ((10, 4), (1 << 20, 4), (1 << 40, 4), (100, 0)):
        masks = simhash.band_masks(rows_, radius)
        for _ in range(200):
            change = 0
            for b in rng.sample(range(64), radius):
                change |= 1 << b
            assert any(not change & m for m in masks)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2), (2, 3)]
    got = {r["node"]: r["root"] for r in rows(components(spark.createDataFrame(edges, "a long, b long")))}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# neighbours


def vectors(spark, pairs):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in pairs], "vec_id long, embedding array<float>, rank int, score double")


def best(pairs, k=5):
    """Exact answers: equal likeness up to rounding counts as a tie."""
    ok = [(i, np.array(v, float)) for i, v in pairs if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    ok = [(i, v) for i, v in ok if v.any() and len(v) == 16]
    answers = {}
    for q, v in ok:
        if q % 50 == 0:
            near = {(-round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 9), i) for i, w in ok if i != q}
            answers[q] = sorted(near)[:k]
    return answers


def test_neighbours_with_awkward_rows(spark):
    rng = np.random.default_rng(4)
    pairs = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    pairs += [(1000 + i, [1.0] * 16) for i in range(120)]  # one vector many times
    pairs += [(0, pairs[0][1])]  # a repeated row
    pairs += [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [None] * 16), (2200, [1.0] * 3)]
    pairs += [(2250, [float("inf")] * 16), (None, [2.0] * 16), (2300, []), (-50, [-1.0] * 16)]
    found = rows(neighbours.nearest(vectors(spark, pairs), F.col("vec_id") % 50 == 0))
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((-round(r["score"], 9), r["vec_id"]))
    assert got == best(pairs)
    assert all([r["rank"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == [1, 2, 3, 4, 5] for q in got)


def test_few_or_no_vectors(spark):
    few = vectors(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 1.0])])
    found = {(r["query_id"], r["rank"], r["vec_id"]) for r in rows(neighbours.nearest(few, F.col("vec_id") % 50 == 0))}
    assert found == {(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)}
    assert neighbours.nearest(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_recall_where_cells_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAST_ROWS", 10)
    monkeypatch.setattr(neighbours, "UNIT_ROWS", 20)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(30, 16))
    pairs = [(i, (centres[i % 30] + 0.3 * rng.normal(size=16)).tolist()) for i in range(3000)]
    found = rows(neighbours.nearest(vectors(spark, pairs), F.col("vec_id") % 50 == 0, centroids=8))
    truth = best([(i, np.float32(v).tolist()) for i, v in pairs])
    hits = sum(len({i for _, i in truth[q]} & {r["vec_id"] for r in found if r["query_id"] == q}) for q in truth)
    assert hits >= 0.9 * 5 * len(truth)


def test_traversal_goes_by_rising_sums():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(9)
    cells = list(neighbours.traverse(a, b))
    sums = [a[c // 9] + b[c % 9] for c in cells]
    assert sorted(cells) == list(range(63)) and sums == sorted(sums)


# chat formatting

CONTROLS = st.text(st.sampled_from("<|>\\\nimend_start a"), max_size=40) | st.sampled_from([chat.START, chat.END])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(CONTROLS, CONTROLS), min_size=1, max_size=5))
def test_template_reads_back(turns):
    assert chat.parse("".join(chat.render(r, t)[0] for r, t in turns)) == turns
    for role, text in turns:
        turn, start, length = chat.render(role, text)
        assert chat.unescape(turn[start : start + length]) == text
        assert turn.count(chat.START) == turn.count(chat.END) == 1


def test_trees_by_walking_them(spark):
    rng = random.Random(6)
    nodes, number = [], 0
    for tree in [None, *range(12)]:
        own = []
        for _ in range(rng.randint(1, 40)):
            number += 1
            parent = rng.choice(own) if own and rng.random() < 0.95 else None
            own.append(number)
            nodes.append((tree, number, parent, rng.choice(["user", "assistant", None]), rng.choice([prose(number, 3), None, "<|im_end|>"]), rng.choice([1.0, 2.0, None])))
    for k in range(70):  # a long thread
        nodes.append((99, 5000 + k, 4999 + k, "user", f"t{k}", 1.0))
    nodes += [(77, 9001, 9002, "user", "cycle", 1.0), (77, 9002, 9001, "user", "cycle", 1.0), (77, 9003, 1, "user", "orphan", 1.0)]
    by = {n[1]: n for n in nodes}
    tree_of = lambda n: n[0]
    parents = {n[1]: n[2] for n in nodes if n[2] in by and tree_of(by[n[2]]) == tree_of(n)}
    want = {}
    for n in nodes:
        if n[1] in parents.values() or n[0] == 77 and n[1] != 9003:
            continue
        path = [n]
        while path[-1][1] in parents:
            path.append(by[parents[path[-1][1]]])
        mean = sum(p[5] or 0.0 for p in path) / len(path)
        want.setdefault(n[0], []).append((-mean, -len(path), n[1], path[::-1]))
    frame = spark.createDataFrame(nodes, "tree long, node long, parent long, role string, text string, score double")
    for per_tree in (1, 3):
        got = {}
        for r in rows(chat.conversations(frame.withColumn("leaf", F.lit("x")), per_tree)):
            got.setdefault(r["tree"], {})[r["leaf"]] = r
        assert got.keys() == want.keys()
        for tree, paths in want.items():
            chosen = sorted(paths)[:per_tree]
            assert got[tree].keys() == {leaf for _, _, leaf, _ in chosen}
            for _, _, leaf, path in chosen:
                turns = [(p[3] or "", p[4] or "") for p in path]
                row = got[tree][leaf]
                assert chat.parse(row["formatted"]) == turns and row["n_turns"] == len(turns)
                loss = [chat.unescape(row["formatted"][s["start"] : s["start"] + s["length"]]) for s in row["loss_spans"]]
                assert loss == [t for role, t in turns if role == "assistant"]


def test_threads_by_turn(spark):
    said = [(1, 2, "assistant", "b"), (1, 1, "user", None), (None, 0, "user", "n"), (2, 5, "user", "x"), (2, 5, "user", "x"), (2, 3, "assistant", "y\n<|")]
    frame = spark.createDataFrame([(*r, 9) for r in said], "conv_id long, turn long, role string, text string, node int")
    found = {r["conv_id"]: r for r in rows(chat.digests(chat.conversations(chat.threads(frame))))}
    assert found.keys() == {1, 2, None}
    for conv, row in found.items():
        turns = sorted(((t, r, x or "") for c, t, r, x in said if c == conv))
        text = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert row["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (row["n_turns"], row["loss_chars"]) == (len(turns), len(loss))
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    empty = spark.createDataFrame([], frame.schema)
    assert chat.conversations(chat.threads(empty)).count() == 0


# language model


def plain_scores(pairs, least_share, divergence):
    """Depth two, with dictionaries."""
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    split = [(i, [*(t or "").encode().lower().split(), b""]) for i, t in pairs]
    count = Counter(w for i, ws in split if not held(i) for w in ws)
    tokens, types = sum(count.values()), len(count)
    space, least = tokens + types + 1, max(2, math.ceil(least_share * tokens))
    symbol = lambda w: w if count[w] >= least else None
    p_root = {w: (n + 1) / space for w, n in count.items() if n >= least}
    p_root[None] = 1 - sum(p_root.values())
    follow = [{}, {}]
    for i, ws in split:
        if not held(i):
            s = ["start", *map(symbol, ws)]
            for k in range(1, len(s)):
                follow[0].setdefault((s[k - 1],), Counter())[s[k]] += 1
                if k > 1:
                    follow[1].setdefault((s[k - 2], s[k - 1]), Counter())[s[k]] += 1
    usual = {(a[0], w) for a, c in follow[0].items() for w, n in c.items() if n >= least}

    def gain(context, expect):
        c = follow[len(context) - 1][context]
        total = sum(c.values())
        return sum(n * math.log(n / total / expect(w)) for w, n in c.items()) - divergence * len(c)

    one = {c for c in follow[0] if sum(follow[0][c].values()) >= least and gain(c, p_root.get) >= 0}
    share = lambda c: lambda w: follow[0][c][w] / sum(follow[0][c].values())
    two = {c for c in follow[1] if c in usual and sum(follow[1][c].values()) >= least and gain(c, share(c[1:])) >= 0}
    one |= {c[1:] for c in two}

    def p(context, w):
        if not context:
            return p_root[w]
        if context not in (one, two)[len(context) - 1]:
            return p(context[1:], w)
        c = follow[len(context) - 1][context]
        total = sum(c.values())
        return max(c[w] - 0.75, 0) / total + 0.75 * len(c) / total * p(context[1:], w)

    out = []
    for i, ws in split:
        s = ["start", *map(symbol, ws)]
        base = [math.log10((count[w] + 1) / space) for w in ws]
        score = sum(
            math.log10(p(tuple(s[max(0, k - 2) : k]), s[k])) + (0 if s[k] is not None else base[k - 1] - math.log10(p_root[None]))
            for k in range(1, len(s))
        )
        out.append((i, held(i), len(ws), sum(count[w] > 0 for w in ws), tokens, sum(base), score))
    contexts = [(), *follow[0], *follow[1]]
    sums = [sum(p(c, w) for w in p_root) for c in contexts]
    return out, sums, (len(one), len(two))


def test_scores_against_dictionaries(make, awkward):
    rng = random.Random(5)
    common = ["the", "of", "der", "die", "und", "The", "one", "two"]
    pairs = [p for p in awkward if p[0] not in (4, 13)] + [
        (k, " ".join(rng.choices(common[:3] if k % 2 else common[3:], k=60) + prose(k, 5).split()) + (" one two three four" * 5))
        for k in range(100, 180)
    ]
    want, sums, sizes = plain_scores(pairs, 0.002, 1.0)
    assert all(abs(x - 1) < 1e-9 for x in sums) and min(sizes) > 0
    found = rows(suffix_tree.score(make(pairs), remainder("doc_id", 7) == 2, least_share=0.002))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted((tuple(r[k] for k in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")) for r in found), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)
    outside = [(w[6] - w[5]) for w in want if w[1] and w[2] > 50]
    assert sum(outside) > 0


def test_scores_without_training_text(make):
    found = rows(suffix_tree.score(make([(1, "a b"), (2, None)]), F.lit(True)))
    assert {(r["train_tokens"], r["n_known"], r["score"], r["base_score"]) for r in found} == {(0, 0, 0.0, 0.0)}
    assert suffix_tree.score(make([]), F.lit(False)).count() == 0
