"""Operators on single texts against plain or library versions."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

from spark_curate.llm import bpe, counting, packing, quality, sharding, toxicity

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = st.text(st.sampled_from("abcdehinost ABC'éßÀ.,!?12²½\n\t ­́\x1c日🙂<|>▁"), max_size=60)


def rows(df):
    return [r.asDict() for r in df.collect()]


# quality rules


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": lines,
        "n_repeat_words": len(repeated),
        "base_failed": len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    }


def plain_verdict(text):
    raw = (text or "").encode()
    if len(raw) < quality.BANDS[0][0]:
        return "keep"
    size = lambda b: len(b) / len(zstandard.ZstdCompressor(level=quality.LEVEL).compress(b))
    least, most = [(a, b) for n, a, b in quality.BANDS if n <= len(raw)][-1]
    parts = [raw[i : i + quality.CHUNK_BYTES] for i in range(0, len(raw), quality.CHUNK_BYTES)]
    ratios = [size(p) for p in parts if len(p) == quality.CHUNK_BYTES]
    low, high = quality.CHUNK_BAND
    if size(raw) > most or sum(r > high for r in ratios) > quality.CHUNK_SHARE * len(ratios):
        return "repetitive"
    if size(raw) < least or sum(r < low for r in ratios) > quality.CHUNK_SHARE * len(ratios):
        return "incompressible"
    return "keep"


def test_quality_against_plain_rules(make, awkward):
    noise = np.random.default_rng(0).integers(0x4E00, 0x9FA5, 3000)
    noisy = " ".join("".join(map(chr, noise[i : i + 5])) for i in range(0, 3000, 5))
    pairs = [(i, t) for i, t in awkward if i != 7] + [(50, noisy), (51, prose(9, 900)), (52, "copy me now\n" * 200)]
    found = rows(quality.quality(make(pairs)))
    assert len(found) == len(pairs)
    for row, (doc_id, text) in zip(found, pairs, strict=True):
        assert row["doc_id"] == doc_id
        want = plain_counts(text)
        assert {k: row[k] for k in want} == want
        assert row["verdict"] == plain_verdict(text)
        assert row["kept"] == (not row["base_failed"] and row["verdict"] == "keep")
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[50]["verdict"] == "incompressible" and by_id[52]["verdict"] == "repetitive" and by_id[51]["kept"]


def test_chunks_out_of_band_on_either_side():
    squeeze = zstandard.ZstdCompressor(level=quality.LEVEL).compress
    size = quality.CHUNK_BYTES
    made = prose(5, 20_000).encode()
    good = [made[k * size : (k + 1) * size] for k in range(48)]
    random_ = np.random.default_rng(4).bytes(size * 48)
    junk = [base64.b64encode(random_[k * size : (k + 1) * size])[:size] for k in range(48)]
    dull = [(good[k][:200] * 11)[:size] for k in range(48)]
    low, high = quality.CHUNK_BAND
    ratio = lambda part: size / len(squeeze(part))
    assert all(low <= ratio(p) <= high for p in good)
    assert all(ratio(p) < low for p in junk) and all(ratio(p) > high for p in dull)

    def judged(at, n=48, rest=b""):
        parts = [at.get(k, good)[k] for k in range(n)]
        return quality.judge(b"".join(parts) + rest, squeeze)[1:]

    assert judged({}) == (48, 0, "keep")
    # a quarter and less of each kind, near half together
    assert judged({k: junk if k % 4 else dull for k in range(0, 48, 2)})[2] != "keep"
    assert judged({0: junk, 4: dull, 6: dull}, 8)[2] == "repetitive"
    # a quarter of a long text in one run, and five chunks
    assert judged({k: junk for k in range(20, 32)}) == (48, 12, "incompressible")
    assert judged({k: junk for k in range(20, 25)}) == (48, 5, "incompressible")
    assert judged({k: junk for k in range(1, 48, 4)})[2] == "incompressible"
    # single odd chunks
    assert judged({5: junk, 17: dull, 30: junk, 41: dull}) == (48, 4, "keep")
    # the rest counts as a chunk
    assert judged({2: junk}, 5, junk[0][:2000]) == (6, 2, "incompressible")
    assert judged({2: junk}, 5, good[7][:2000]) == (6, 1, "keep")
    assert judged({}, 5, junk[0][:100]) == (5, 0, "keep")


# sharding


def test_shards_against_prefix_sums(make, awkward):
    pairs = awkward + [(k, prose(k, k % 90)) for k in range(100, 400)]
    found = rows(sharding.byte_shards(make(pairs)))
    assert len(found) == len(pairs)
    order = sorted(
        (
            (i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1)
            for i, t in pairs
        )
    )
    total, upto, want, slots = sum(o[3] for o in order), 0, [], Counter()
    for known, i, crc, size in order:
        shard = (2 * upto + size) * 8 // (2 * total)
        want.append((i if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        upto += size
    got = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found]
    key = lambda x: (x[3], x[4])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_shards_split_one_hot_id(make):
    found = rows(sharding.byte_shards(make([(1, "same text")] * 800)))
    assert Counter(r["shard"] for r in found) == {k: 100 for k in range(8)}
    assert sorted(r["slot"] for r in found if r["shard"] == 3) == list(range(100))


# word encoding


@pytest.fixture(scope="module")
def encoder():
    return bpe.WordEncoder(WORD_BPE)


def same_encoding(encoder, tokenizer, texts):
    for text, (ids, n, decoded) in zip(texts, encoder.encode(texts), strict=True):
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)), text
        assert n == len(want)
        assert decoded == tokenizer.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(ODD, max_size=8))
def test_words_as_the_library(encoder, texts):
    same_encoding(encoder, Tokenizer.from_file(WORD_BPE), texts)


def test_merging_where_proposals_fail(encoder):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    vocabulary = [t.removesuffix("</w>") for t in tokenizer.get_vocab()]
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(vocabulary, 3)) for _ in range(3000)]
    runs = ["ab" * 400, "hahaha" * 50, "!" * 333, "aaaa" * 77]
    same_encoding(encoder, tokenizer, words + runs)
    assert not all(encoder.tested.values()), "some pairs have to fail"


def test_pair_test_is_encoding_the_pair(encoder):
    rng = np.random.default_rng(2)
    inner = [t for t, i in encoder.inner.items() if i >= 0]
    left = rng.choice(inner, 4000)
    right = [t + "</w>" for t in rng.choice(list(encoder.final), 4000)]
    ids = [np.array([encoder.vocabulary[t] for t in side]) for side in (left, right)]
    for a, b, holds in zip(left, right, encoder.pairs.holds(*ids), strict=True):
        assert holds == (encoder.merge(encoder._letters(a + b)) == [a, b])


def test_encode_decode_rows(make, awkward):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    found = rows(bpe.encode_decode(make(awkward), WORD_BPE))
    assert [r["doc_id"] for r in found] == [i for i, _ in awkward]
    for row, (_, text) in zip(found, awkward, strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_a_full_cache_starts_afresh(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    monkeypatch.setattr(bpe, "AT_ONCE", 300)
    same_encoding(encoder, Tokenizer.from_file(WORD_BPE), [prose(k, 40) for k in range(20)])


# token counts


def unigram(vocabulary, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    tokenizer.normalizer = normalizers.Replace(Regex(r"[\x20\t-\r]+"), " ")
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tokenizer


TIES = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), ("ba", -2.0), ("▁a", -3.0), ("aab", -3.0)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abcé \n"), max_size=30))
def test_counts_follow_the_tie_rules(text):
    want = unigram(TIES, False).encode(text, add_special_tokens=False).ids
    assert counting.Counter(TIES)(text)[0] == len(want)


@pytest.fixture(scope="module")
def pieces():
    vocabulary = counting.vocabulary_of(PIECES)
    return counting.Counter(vocabulary), unigram(vocabulary, True)


@settings(max_examples=150, deadline=None)
@given(ODD)
def test_counts_as_the_library(pieces, text):
    counter, tokenizer = pieces
    assert counter(text)[0] == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_count_rows(make, awkward, pieces):
    found = rows(counting.token_counts(make(awkward), PIECES))
    want = [len(pieces[1].encode(t or "", add_special_tokens=False).ids) for _, t in awkward]
    assert [(r["doc_id"], r["n_tokens"]) for r in found] == [(i, n) for (i, _), n in zip(awkward, want, strict=True)]


# packing


def plain_packing(lengths, capacity):
    """Bins by trying every open bin and counting the squares anew."""
    bins = []
    for size in lengths:
        best = None
        for k, left in enumerate(bins):
            if left >= size:
                after = Counter(bins[:k] + [left - size] + bins[k + 1 :])
                squares = sum(n * n for gap, n in after.items() if gap)
                if best is None or (squares, left) < best[:2]:
                    best = (squares, left, k)
        if best:
            bins[best[2]] -= size
        else:
            bins.append(capacity - size)
    return sorted(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=40))
def test_sums_of_squares_by_trying_all(sizes):
    sizes = sorted(sizes, reverse=True)
    placed = packing.sum_of_squares(np.array(sizes, np.int64), 20)
    left = [20] * (max(placed, default=-1) + 1)
    for size, k in zip(sizes, placed, strict=True):
        left[k] -= size
    assert sorted(left) == plain_packing(sizes, 20)


def check_packing(found, pairs, capacity=1024):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = Counter()
    for doc_id, text in pairs:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packed_documents(make, awkward):
    pairs = awkward + [(k, prose(k, k)) for k in range(100, 300)]
    found = rows(packing.pack_documents(make(pairs), BYTE_BPE))
    used = check_packing(found, pairs)
    assert used <= 1.05 * sum(r["length"] for r in found) / 1024 + 1


def test_packing_in_several_groups(spark):
    sizes = [(i, 1 + i * 37 % 1024) for i in range(3000)]
    cut = spark.createDataFrame(sizes, "doc_id long, length long")
    found = rows(packing.pack(cut, group_pieces=500))
    filled = Counter()
    for r in found:
        filled[r["sequence_id"]] += r["length"]
    assert len(found) == 3000 and max(filled.values()) <= 1024
    assert len(filled) <= 1.02 * sum(n for _, n in sizes) / 1024 + 6


def test_equal_pieces_are_dealt_to_all_groups(spark):
    sizes = [(i, 1 + i * 37 % 1024) for i in range(2000)] + [(None, 300)] * 1000
    cut = spark.createDataFrame(sizes, "doc_id long, length long")
    found = rows(packing.pack(cut, group_pieces=500))
    assert Counter((r["doc_id"], r["length"]) for r in found) == Counter(sizes)
    short = [n for _, n in sizes if n < 1024]
    groups = -(-len(short) // 500)
    # even numbers are those of shared sequences
    per_group = Counter(r["sequence_id"] // 2 % groups for r in found if r["sequence_id"] % 2 == 0)
    assert len(per_group) == groups and max(per_group.values()) < 700
    filled = Counter()
    for r in found:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 1024


@settings(max_examples=150, deadline=None)
@given(st.lists(ODD, max_size=5))
def test_cached_ids_as_the_library(texts):
    ids = packing.ids_of(BYTE_BPE)
    assert ids.of(texts) == ids.whole(texts)


def test_plain_texts_need_no_tokenizer(monkeypatch):
    """New words cost no call of the tokenizer, and long runs of blanks are right."""
    ids = packing.Ids(BYTE_BPE)
    texts = [prose(k, 200) + " naïve\n\n  ça's 1²3 " for k in range(30)]
    want = ids.whole(texts)
    long_ones = [" " * 1_200_000 + "a", "ab é " * 120_000]
    want_long = ids.whole(long_ones)
    assert ids.of(long_ones) == want_long
    ids = packing.Ids(BYTE_BPE)
    monkeypatch.setattr(ids, "tokenizer", None)
    assert ids.of(texts) == want


def test_long_words_are_linear():
    """A word of a million letters is proposed, tested and merged like any other."""
    import time

    coder = bpe.encoder_of(WORD_BPE)
    word = "".join(random.Random(5).choices("etaoinshrdlu", k=20_000))
    assert coder.encode([word])[0][0] == " ".join(map(str, coder.tokenizer.encode(word, add_special_tokens=False).ids))
    spelled = "".join(random.Random(6).choices("etaoinshrdlu", k=1_000_000))
    began = time.perf_counter()
    proposed = coder.propose(spelled)
    assert time.perf_counter() - began < 15 and "".join(coder.names[i] for i in proposed).removesuffix(coder.end) == spelled


# toxicity

BAD = ["idiot", "moron", "scum", "loweich"]


def labelled(n):
    docs, labels = [], []
    for k in range(n):
        toxic = k % 4 == 0
        docs.append((k, prose(k, 90, [BAD[(k // 4 + j) % 4] for j in range(4)] if toxic else ())))
        labels.append((k, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_documents(spark, make, awkward):
    docs, labels = labelled(400)
    extra = [(1000 + i if i else None, t) for i, t in awkward]
    frame = make(docs + extra)
    marks = spark.createDataFrame(labels + [(3, 1, None), (9999, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(frame, marks)
    assert isinstance(model, toxicity.Model)
    found = rows(toxicity.score(frame, model))
    assert len(found) == len(docs) + len(extra)
    truth = {i: y for i, _, y in labels}
    held = [r for r in found if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 40
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    empty = {r["score"] for r in found if r["doc_id"] in (1001, 1002, 1003)}
    assert len(empty) == 1 and empty.pop() < 0.5


def test_sample_of_one_hot_id_and_of_long_texts(spark, make, monkeypatch):
    """An id on most rows is one text of the sample; long texts are drawn like others."""
    docs, labels = labelled(200)
    long_ones = [(k, t + " " + prose(9000 + k, 4000)) if k % 4 == 0 else (k, t) for k, t in docs]
    hot = [(2, docs[2][1])] * 600
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    asked = []
    monkeypatch.setattr(toxicity, "fit_texts", lambda toxic, ordinary: asked.append((toxic, ordinary)) or 0.0)
    toxicity.fit(make(long_ones + hot), marks)
    toxic, ordinary = asked[-1]
    seen = lambda k: zlib.crc32(str(k).encode()) % 5 != 0
    assert Counter(toxic) == Counter(t for k, t in long_ones if k % 4 == 0 and seen(k))
    assert Counter(ordinary) == Counter(t for k, t in long_ones if k % 4 and seen(k))
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 10)
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 200_000)
    toxicity.fit(make(long_ones + hot), marks)
    toxic, ordinary = asked[-1]
    assert 5 <= len(toxic) <= 10 and sum(len(t.encode()) for t in toxic) <= 200_000
    assert sum(len(t.encode()) for t in ordinary) <= 200_000 and len(ordinary) > 50


def test_window_lengths_and_scores_by_plain_rules(spark, make):
    """One model's windows compressed one by one, and its scores from their lengths."""
    docs, labels = labelled(300)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = make(docs)
    model = toxicity.fit(frame, marks)
    sides = [toxicity.compressor(c) for c in (model.toxic, model.ordinary)]
    want = {}
    for doc, text in docs[:60]:
        raw = b" " + b" ".join(text.lower().encode().split()) + b" "
        starts = range(0, max(1, len(raw) - toxicity.GRAM - 2), toxicity.STEP)
        spans = [toxicity.LEAD + raw[k : k + toxicity.WINDOW] for k in starts]
        saved = np.array([sides[1](w) - sides[0](w) for w in spans])
        found = np.asarray(toxicity.differences(text, *(toxicity.compressor(c) for c in (model.toxic, model.ordinary))))
        assert found.tolist() == saved.tolist()
        row = (np.array(toxicity.features(saved, np.array(model.ratios))) - model.centre) / np.array(model.spread)
        value = model.weights[0] + sum(w * v for w, v in zip(model.weights[1:], row, strict=True))
        want[doc] = (1 / (1 + np.exp(-np.clip(value, -30, 30))), len(spans), int((saved > toxicity.MARGIN).sum()))
    got = {r["doc_id"]: (r["score"], r["n_windows"], r["n_toxic_windows"]) for r in rows(toxicity.score(make(docs[:60]), model))}
    assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()}
    assert all(got[k][0] == pytest.approx(want[k][0], abs=1e-12) for k in want)


def test_toxicity_without_both_classes(spark, make):
    docs, labels = labelled(40)
    frame = make(docs)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clean = spark.createDataFrame([(i, 1, 0) for i, _, _ in labels], "doc_id long, quality int, toxic int")
    for marks in (none, clean):
        found = rows(toxicity.score(frame, toxicity.fit(frame, marks)))
        assert {(r["score"], r["predicted"]) for r in found} == {(0.0, 0)}


def test_empty_tables(make):
    empty = make([])
    assert sharding.byte_shards(empty).count() == 0
    assert quality.quality(empty).count() == 0
    assert bpe.encode_decode(empty, WORD_BPE).count() == 0
    assert counting.token_counts(empty, PIECES).count() == 0
    assert packing.pack_documents(empty, BYTE_BPE).count() == 0
    assert toxicity.score(empty, 0.0).count() == 0
