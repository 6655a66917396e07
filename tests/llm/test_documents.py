"""Alignment of tokenizers, the filter audit and fingerprints, against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spark_curate.llm import alignment, audit, minhash, queries

from .conftest import prose

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# alignment of tokenizers


@given(st.lists(st.integers(1, 60), min_size=1), st.lists(st.integers(1, 60), min_size=1), st.integers(1, 900))
@settings(deadline=None)
def test_gallop_counts_what_lies_below(one, other, end):
    driver = np.array(sorted({*one, 900 + end}))
    longer = np.array(sorted({*other, 900 + end}))
    assert alignment.gallop(driver, longer).tolist() == np.searchsorted(longer, driver).tolist()
    at_a, at_b, _ = alignment.intersect(driver, longer)
    common = sorted(set(driver.tolist()) & set(longer.tolist()))
    assert driver[at_a].tolist() == common == longer[at_b].tolist()
    first, last = alignment.overlaps(driver, longer)
    spans = lambda ends: list(zip([0, *ends], ends, strict=False))
    for i, (a, b) in enumerate(spans(driver.tolist())):
        met = [j for j, (c, d) in enumerate(spans(longer.tolist())) if c < b and d > a]
        assert [first[i], last[i]] == [met[0], met[-1]]
        assert len(met) == last[i] - first[i] + 1


def test_gallop_over_long_lists():
    rng = np.random.default_rng(3)
    for size in (10, 1000, 30_000):
        driver = np.unique(np.append(rng.integers(1, 10**6, size // 10), 10**6))
        longer = np.unique(np.append(rng.integers(1, 10**6, size), 10**6))
        assert (alignment.gallop(driver, longer) == np.searchsorted(longer, driver)).all()
        assert (alignment.gallop(longer, driver) == np.searchsorted(driver, longer)).all()


ODD_TEXTS = [
    "a  b\n c \x00 \x1f",
    "\n\n a\n",
    " ",
    "\n",
    " \n \n",
    "<s> <|endoftext|> <0x0A> </s><unk>",
    "x\t\ty  \n\n  z ",
    "a ▁ mark",
    "combining é ﬁ 　 wide",
    "it's 12345 £½¾ it’s",
    "l" * 500 + " " + "m" * 70,
]


@cache
def libraries():
    tokenizer, model = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    tokenizer.encode_special_tokens = True
    return tokenizer, model, {c: b for b, c in enumerate(alignment.byte_letters())}


def library_tokens(text):
    """(ids, bytes of the tokens) under both, by the libraries alone; None without tokens."""
    tokenizer, model, letters = libraries()
    if not text:
        return None
    ids_a = tokenizer.encode(" " + text, add_special_tokens=False).ids
    a = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in ids_a]
    ids_b = model.encode(text)
    pieces = [model.id_to_piece(i) for i in ids_b]
    b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in pieces]
    raw = (" " + text).encode()
    return (ids_a, a, ids_b, b) if b"".join(a) == raw == b"".join(b) else None


@pytest.fixture(scope="session")
def texts(awkward):
    pairs = awkward + [(100 + k, t) for k, t in enumerate(ODD_TEXTS)]
    return pairs + [(200 + k, prose(300 + k, 80, ("Zebra", "42,", "don't"))) for k in range(30)]


def plain_alignment(pairs):
    made = []
    for doc, text in pairs:
        found = library_tokens(text or "")
        if found is None:
            made.append((doc, [], [], [], []))
            continue
        ids_a, a, ids_b, b = found
        ends_a, ends_b = list(itertools.accumulate(map(len, a))), list(itertools.accumulate(map(len, b)))
        common = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for end in common:
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((ids_a[i:k], ids_b[j:m]))
            i, j = k, m
        at_a, at_b = dict(zip(ends_a, ids_a, strict=True)), dict(zip(ends_b, ids_b, strict=True))
        made.append((doc, ids_a, ids_b, groups, [(at_a[e], at_b[e]) for e in common]))
    return made


def test_linked_documents(make, texts):
    made = plain_alignment(texts)
    counts = Counter(p for *_, links in made for p in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    want = []
    for doc, ids_a, ids_b, groups, links in made:
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        want.append(
            (
                doc,
                len(ids_a),
                len(ids_b),
                len(groups),
                len(links),
                sum(counts[p] == most[p[1]] for p in links),
                sum(counts[p] for p in links),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    for block in (alignment.BLOCK_PAIRS, 300):  # one block a task, and many
        found = rows(alignment.linked_documents(make(texts).repartition(3), PATH_A, PATH_B, block_pairs=block))
        keys = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
        assert Counter(tuple(r[k] for k in keys) for r in found) == Counter(want)
    assert sum(not w[7] for w in want) >= 4 and any(w[5] not in (0, w[4]) for w in want)


def test_alignments_hold_the_groups(make, texts):
    found = {r["doc_id"]: r for r in rows(alignment.alignments(make(texts), PATH_A, PATH_B)) if r["doc_id"] and r["doc_id"] > 9}
    for doc, ids_a, ids_b, groups, _ in plain_alignment(texts):
        if doc and doc > 9:
            assert [(g["a"], g["b"]) for g in found[doc]["groups"]] == groups
            assert len(found[doc]["overlaps"]) == len(ids_a)
            pairs = sum(o["last"] - o["first"] + 1 for o in found[doc]["overlaps"])
            assert pairs == (len(ids_a) + len(ids_b) - len(groups))


LATIN = st.text(st.sampled_from("aeinorstlhdcumpgbfwyvkxqjz AEST'.,0159-\n\t\r#$éüßñçÀ£½«º"), max_size=80)


@given(LATIN)
@settings(deadline=None, max_examples=400)
def test_both_libraries_give_the_same_ids(text):
    maker = alignment.aligner_of(PATH_A, PATH_B)
    tokenizer, _, _ = libraries()
    assert alignment.PLAIN.match(text) and maker.a.ranked
    assert maker.a(text).tolist() == tokenizer.encode(" " + text, add_special_tokens=False).ids


def test_spelling_is_compared_in_parts(monkeypatch):
    monkeypatch.setattr(alignment, "SPELLED", 7)
    maker = alignment.aligner_of(PATH_A, PATH_B)
    text = prose(77, 90)
    ids = maker.a(text)
    ends = np.cumsum(maker.a.sizes[ids])
    raw = (" " + text).encode()
    assert maker.a.spells(ids, ends, raw) and len(ids) > 50
    for at in (0, 30, len(raw) - 1):
        assert not maker.a.spells(ids, ends, raw[:at] + b"~" + raw[at + 1 :])
    assert not maker.a.spells(ids[:-1], ends[:-1], raw) and not maker.a.spells(ids[:0], ends[:0], b" ")


def test_no_documents(spark, make):
    none = make([])
    assert alignment.linked_documents(none, PATH_A, PATH_B).count() == 0
    assert alignment.alignments(none, PATH_A, PATH_B).count() == 0
    assert minhash.with_next(none).count() == 0
    empty = none.withColumn("source", F.lit("s"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(audit.mask_counts(empty, labels)).count() == 0


# the filter audit


def audited_rows(awkward):
    """(id, text, source): clean ones, failures of every kind, copies within and across sources."""
    rng = random.Random(11)
    body = [prose(k, 120) for k in range(6)]
    rows = [(i, t, "odd" if i and i % 2 else None) for i, t in awkward]
    for k in range(60):
        text = rng.choice(body) if k % 3 else prose(500 + k, rng.randint(5, 90))
        text += rng.choice(["", " SHOUTED WORDS IN A ROW", " #tag", " same same same same" * 30])
        rows.append((1000 + rng.randrange(50), text, rng.choice(["web", "news", ""])))
    return rows


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    bad = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for doc, text, _ in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    fails = []
    for doc, text, part in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        out = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        out += "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        out += "E" * (doc is not None and doc > least[text])
        fails.append((part or "", set(out), doc in good, doc in bad))
    result, taken = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for step, letter in enumerate(order, 1):
            before = set(order[: step - 1])
            for part in {f[0] for f in fails}:
                mine = [f for f in fails if f[0] == part]
                gone = [f for f in mine if letter in f[1] and not f[1] & before]
                taken[part, letter] += len(gone)
                result[part, order, step] = (
                    sum(not f[1] & (before | {letter}) for f in mine),
                    len(gone),
                    sum(letter in f[1] and bool(f[1] & before) for f in mine),
                    sum(f[1] == {letter} for f in mine),
                    sum(f[2] for f in gone),
                    sum(f[3] for f in gone),
                )
    return {k: (*v, taken[k[0], k[1][k[2] - 1]]) for k, v in result.items()}


@pytest.fixture(scope="session")
def audited(spark, awkward):
    rows = audited_rows(awkward)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, part string, n int")
    labels = [(d, d % 2, d % 3 == 0) for d in range(1000, 1050)] + [(1001, 1, 1), (None, 1, 1), (7, None, 1), (1004, 0, 0)]
    return rows, labels, docs, spark.createDataFrame([(d, q, int(t)) for d, q, t in labels], "doc_id long, quality int, toxic int")


KEYS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("counters", [audit.COUNTERS_PER_ROW, 1])
def test_audit_of_every_order(audited, counters):
    """The same with a sketch that clears most unique texts and one that is full."""
    pairs, labels, docs, marks = audited
    most = audit.MAX_COUNTERS if counters > 1 else 16
    found = rows(audit.audit(audit.mask_counts(docs, marks, counters_per_row=counters, max_counters=most)))
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[k] for k in KEYS) for r in found}
    assert len(found) == len(got) == 600 * 4
    assert got == plain_audit(pairs, labels)


def test_audit_sql(audited):
    pairs, labels, docs, marks = audited
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", marks.toPandas().astype({"doc_id": "Int64", "quality": "Int64"}))
    cursor = con.execute(queries.OP12_SQL)
    names = [d[0] for d in cursor.description]
    found = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[k] for k in KEYS) for r in found}
    assert got == plain_audit(pairs, labels)


def test_sketch_clears_only_unique_texts(spark):
    pairs = [(i, f"text {i}") for i in range(3000)] + [(5000 + i, f"text {7 * i}") for i in range(100)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    for counters in (1 << 16, 1 << 12):
        left = {r["doc_id"] for r in rows(audit.possible_repeats(docs, audit.sketch(docs.select("h"), counters), counters))}
        twice = {t for t, n in Counter(t for _, t in pairs).items() if n > 1}
        repeats = {i for i, t in pairs if t in twice}
        assert repeats <= left
        if counters == 1 << 16:
            assert len(left - repeats) < 100


# fingerprints


def plain_shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_packed(maker, text):
    """Bin by bin, one after another."""
    bins = {}
    shift = 64 - (maker.bins.bit_length() - 1)
    for h in maker.shingles(text).tolist():
        bins[h >> shift] = min(h, bins.get(h >> shift, h))
    if not bins:
        return bytes(maker.bins * maker.bits // 8)
    out = bytearray(maker.bins * maker.bits // 8)
    for k in range(maker.bins):
        asked = [k, *sorted(range(maker.bins), key=lambda j: maker.turn[k, j])]
        value = bins[next(j for j in asked if j in bins)] ^ int(maker.salt[k])
        low = int(minhash._mixed(np.array([value], np.uint64))[0]) >> (64 - maker.bits)
        at = k * maker.bits
        out[at // 8] |= low << at % 8
    return bytes(out)


def test_fingerprints_of_next(make, awkward):
    maker = minhash.Fingerprinter()
    pairs = [(i, t or "") for i, t in awkward if i is not None] + [(300 + k, prose(900 + k, 30 + 7 * k)) for k in range(12)]
    pairs = list({i: (i, t) for i, t in pairs}.values())  # equal ids have no stated order among them
    order = sorted(pairs, key=lambda p: -p[0])
    want = {}
    for k, (doc, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        third = len(text) // 3
        whole = text[: len(text) - third] + following[:third]
        mark, other, last = (plain_packed(maker, t) for t in (text, whole, following))
        want[doc] = (len(text), hashlib.sha256(whole.encode()).hexdigest(), mark.hex(), other.hex(), maker.likeness(mark, other), maker.likeness(mark, last))
    for parts in (1, 7):
        found = rows(minhash.with_next(make(pairs).repartition(parts)))
        keys = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        assert {r["doc_id"]: tuple(r[k] for k in keys) for r in found} == want


def test_repeated_and_null_ids_have_a_next(make, awkward):
    found = rows(minhash.with_next(make(awkward)))
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in awkward)
    body = next(t for i, t in awkward if i == 5)
    prints = {r["doc_id"]: r["fingerprint"] for r in found}
    assert prints[5] == prints[6] == prints[7] != prints[8]
    assert next(r for r in found if r["doc_id"] == 6)["near_next"] == 1.0
    assert next(r for r in found if r["doc_id"] == 6)["edited_sha256"] == hashlib.sha256(
        (body[: len(body) - len(body) // 3] + body[: len(body) // 3]).encode()
    ).hexdigest()
    single = rows(minhash.with_next(make([(3, "only one text is here")])))
    assert single[0]["near_next"] == 1.0 and single[0]["n_chars"] == 21


def test_likeness_estimates_the_share_of_common_shingles():
    maker = minhash.Fingerprinter()
    errors, apart = [], []
    for k in range(150):
        one = prose(4000 + k, 30 + 5 * k).split()
        keep = random.Random(k).random()
        cut = int(len(one) * keep)
        other = one[:cut] + prose(6000 + k, len(one) - cut or 1).split()
        one, other = " ".join(one), " ".join(other)
        a, b = plain_shingles(one), plain_shingles(other)
        errors.append(maker.likeness(maker.packed(one), maker.packed(other)) - len(a & b) / len(a | b))
        apart.append(maker.likeness(maker.packed(one), maker.packed(prose(8000 + k, 100))))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
    assert max(apart) < 0.15
    short = [maker.packed(t) for t in ("one", "two words", "three short words", "ONE")]
    assert short[0] == short[3] and max(maker.likeness(a, b) for a, b in itertools.combinations(short[:3], 2)) < 0.2
