"""BPE encoding by proposing tokens, testing adjacent pairs, and merging only where a test fails."""

from __future__ import annotations

import hashlib
import json
import re
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from spark_curate.llm.common import map_texts

#: Words kept by a worker; a full cache starts afresh, so memory is bounded.
CACHE_WORDS = 600_000
#: Characters of text whose words are looked up together.
AT_ONCE = 1_000_000
#: Texts of these characters only have a plain normal form: no combining marks, no
#: case rule beyond one letter, no rare blanks. Others go through the library's own.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*\Z")

#: The vocabulary's word pattern for lower-case texts of plain characters, where a
#: plain character class says what the pattern's properties say.
PLAIN_LETTERS = "a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff"
PLAIN_DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PROPERTIES = {r"[\p{L}]": f"[{PLAIN_LETTERS}]", r"[\p{N}]": f"[{PLAIN_DIGITS}]", r"\p{L}\p{N}": PLAIN_LETTERS + PLAIN_DIGITS}

#: Words of more symbols are merged with a heap.
LONG_WORD = 64
NEVER = 1 << 60

FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the letters from U+0100 on.
    """
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PairTest:
    """Tells for pairs of tokens whether merging would leave the border between them.

    While a word is merged, the border's left side runs through the right parts of
    the left token, from its last letter up to the token, and its right side through
    the left parts of the right token. The border is merged away exactly if some part
    of either side has a merge that comes before both are absorbed by their own.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        size = max(vocabulary.values()) + 1
        ranks = np.full(size, -1, np.int64)
        right_part, left_part = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        keys = np.empty(len(merges), np.int64)
        for rank, (a, b) in enumerate(merges):
            left, right, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            keys[rank] = left * size + right
            if ranks[whole] < 0:
                ranks[whole], left_part[whole], right_part[whole] = rank, left, right
        order = np.argsort(keys, kind="stable")
        self.size, self.keys, self.key_ranks = size, keys[order], order
        self.ranks = ranks
        self.right_side = self._sides(right_part)
        self.left_side = self._sides(left_part)

    def _sides(self, part: np.ndarray) -> np.ndarray:
        """[depth, token]: the token, its part, the part's part, ..., -1 where none is left."""
        level = np.arange(self.size)
        levels = []
        while (level >= 0).any():
            levels.append(level)
            level = np.where(level >= 0, part[np.maximum(level, 0)], -1)
        return np.stack(levels)

    def holds(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Per pair: True if encoding the joined letters gives the two tokens again."""
        kept = np.ones(len(left), bool)
        never = np.int64(1 << 60)
        for i, xs in enumerate(self.right_side):
            x = xs[left]
            x_until = self.ranks[self.right_side[i - 1][left]] if i else np.full(len(left), never)
            for j, ys in enumerate(self.left_side):
                y = ys[right]
                y_until = self.ranks[self.left_side[j - 1][right]] if j else np.full(len(left), never)
                there = np.flatnonzero((x >= 0) & (y >= 0) & kept)
                if not len(there):
                    continue
                key = x[there] * self.size + y[there]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                rank = np.where(self.keys[at] == key, self.key_ranks[at], never)
                # of equal merges the left one comes first: hence < on one side, <= on the other
                lost = (rank < x_until[there]) & (rank <= y_until[there]) & (rank < never)
                kept[there[lost]] = False
        return kept


class WordEncoder:
    """Encodes the words of a byte-level BPE with word ends, keeping what it has seen."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.end = model["end_of_word_suffix"] or ""
        self.vocabulary = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {m: r for r, m in reversed(list(enumerate(merges)))}
        self.pairs = PairTest(self.vocabulary, merges)
        self.letters = byte_letters()
        self.table = dict(enumerate(self.letters))
        self.names = {i: t for t, i in self.vocabulary.items()}
        # only tokens that merging really reaches may be proposed; -1 marks a mere beginning
        reached = {t: i for t, i in self.vocabulary.items() if self._reached(t, i)}
        self.final = {t.removesuffix(self.end): i for t, i in reached.items() if t.endswith(self.end)}
        self.longest_final = max(map(len, self.final))
        inside = {t: i for t, i in reached.items() if not (self.end and t.endswith(self.end))}
        self.inner = {t[:k]: -1 for t in inside for k in range(1, len(t))} | inside
        self.tested: dict[int, bool] = {}
        self.known: dict[str, tuple[str, int, str]] = {}
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in special.items()}
        self.names.update({i: t for t, i in self.special.items()})
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pattern = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        for name, plain in PROPERTIES.items():
            pattern = pattern.replace(name, plain)
        self.find_plain = re.compile(pattern).findall

    def _letters(self, token: str) -> list[str]:
        """The base symbols of a word given with its end."""
        if self.end and token.endswith(self.end):
            bare = token[: -len(self.end)]
            return [*bare[:-1], bare[-1] + self.end] if bare else []
        return list(token)

    def _reached(self, token: str, number: int) -> bool:
        if self.pairs.ranks[number] < 0:
            return len(self._letters(token)) == 1
        return self.merge(self._letters(token)) == [token]

    def merge(self, symbols: list[str]) -> list[str]:
        """Exact merging: the pair of least rank first, of equal ones the leftmost."""
        rank, never = self.rank.get, NEVER
        if len(symbols) > LONG_WORD:
            return self._merge_long(symbols)
        ranks = [rank(p, never) for p in pairwise(symbols)]
        while ranks and (least := min(ranks)) < never:
            i = ranks.index(least)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), never)
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), never)
        return symbols

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """The same with a heap, for words whose pairs are too many to scan each time."""
        rank, never, n = self.rank.get, NEVER, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, p) for i, p in enumerate(pairwise(symbols)) if (r := rank(p, never)) < never]
        heapify(heap)
        while heap:
            _, i, pair = heappop(heap)
            j = after[i]
            if j >= n or (symbols[i], symbols[j]) != pair:
                continue  # one of the two was merged meanwhile
            symbols[i] += symbols[j]
            symbols[j] = ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := rank((symbols[a], symbols[b]), never)) < never:
                    heappush(heap, (r, a, (symbols[a], symbols[b])))
        return [x for x in symbols if x]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over a spelled word; its last token carries the word's end.

        The rest of the word is looked up only once it is no longer than the longest such
        token, so the work is linear in the word.
        """
        inner, final, made, at, length = self.inner.get, self.final.get, [], 0, len(word)
        while length - at > self.longest_final or (number := final(word[at:])) is None:
            stop = at + 1
            while stop < length and (number := inner(word[at:stop])) is not None:
                if number >= 0:
                    best, best_stop = number, stop
                stop += 1
            made.append(best)
            at = best_stop
        made.append(number)
        return made

    def learn(self, words: list[str]) -> None:
        """Encode words not seen yet: propose for all, test all new pairs at once, mend the rest."""
        if len(self.known) + len(words) > CACHE_WORDS:
            self.known.clear()
            self.tested.clear()
        spelled = ["".join(map(self.letters.__getitem__, w.encode())) for w in words]
        proposed = [self.propose(s) for s in spelled]
        size = self.pairs.size
        wanted = {a * size + b for p in proposed for a, b in pairwise(p)} - self.tested.keys()
        if wanted:
            keys = np.fromiter(wanted, np.int64, len(wanted))
            self.tested.update(zip(keys.tolist(), self.pairs.holds(keys // size, keys % size).tolist(), strict=True))
        tested, names = self.tested, self.names
        for word, letters, ids in zip(words, spelled, proposed, strict=True):
            if not all([tested[a * size + b] for a, b in pairwise(ids)]):
                merged = self.merge([*letters[:-1], letters[-1] + self.end])
                ids = [self.vocabulary[s] for s in merged]
            self.known[word] = (" ".join(map(str, ids)), len(ids), " ".join(map(names.__getitem__, ids)))

    def words_of(self, text: str) -> list[str]:
        """The pre-tokens of a text, special tokens among them as they are written."""
        found: list[str] = []
        for part in self.split_special.split(text) if "<|" in text else (text,):
            if part in self.special:
                found.append(part)
                continue
            if PLAIN.match(part):
                found += self.find_plain(part.lower())
            else:
                found += self.find(self.tokenizer.normalizer.normalize_str(part))
        return found

    def encode(self, texts: list[str]) -> list[tuple[str, int, str]]:
        """Per text: the ids joined by blanks, how many, and the decoded text."""
        rows = []
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= AT_ONCE):
                size += len(texts[end])
                end += 1
            rows += self._encode([self.words_of(t) for t in texts[begin:end]])
            begin = end
        return rows

    def _encode(self, found: list[list[str]]) -> list[tuple[str, int, str]]:
        known, special = self.known, self.special
        seen = set().union(*found) - special.keys()
        new = seen - known.keys()
        if new:
            self.learn(list(seen if len(known) + len(new) > CACHE_WORDS else new))
        known.update((w, (str(i), 1, w)) for w, i in special.items() if any(w in f for f in found))
        rows = []
        for words in found:
            parts = list(map(known.__getitem__, words))
            ids, counts, names = zip(*parts, strict=True) if parts else ((), (), ())
            rows.append((" ".join(ids), sum(counts), " ".join(names)))
        for w in special:
            known.pop(w, None)
        return rows


@cache
def encoder_of(path: str) -> WordEncoder:
    """The encoder of a worker, kept from task to task; all it holds can be made again."""
    return WordEncoder(path)


def encode_decode(
    docs: DataFrame, path: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), raw: bool = False
) -> DataFrame:
    """Encode every whole text with the vocabulary file at ``path`` and decode it again.

    Gives the number of ids and the SHA-256 of the ids (decimal, joined by a blank) and
    of the decoded text; ``raw`` adds both themselves (``ids``, ``decoded``). The file
    is installed on every executor and read by each task. Null and empty texts have no
    ids. A word of any length is encoded whole. Repeated rows are encoded alike; an
    empty table gives an empty result; columns besides ``carry`` and the text are not
    looked at.
    """

    def start():
        encoder = encoder_of(path)

        def work(texts: list[str]) -> dict[str, list]:
            rows = encoder.encode(texts)
            made = {
                "n_tokens": [n for _, n, _ in rows],
                "ids_sha256": [hashlib.sha256(i.encode()).hexdigest() for i, _, _ in rows],
                "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for _, _, d in rows],
            }
            return made | ({"ids": [i for i, _, _ in rows], "decoded": [d for _, _, d in rows]} if raw else {})

        return work

    fields = FIELDS + (", ids string, decoded string" if raw else "")
    return map_texts(docs, start, fields, text_col, carry)
