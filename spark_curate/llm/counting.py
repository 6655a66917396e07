"""Token counts of a unigram vocabulary without the tokens."""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import sentencepiece
from pyspark.sql import DataFrame

from spark_curate.llm.common import map_texts

#: The mark of a word's beginning in the vocabulary's pieces.
MARK = "▁"
#: What a character that is no piece costs below the lowest score of the vocabulary
#: (a fixed value of the tokenizer).
UNKNOWN_PENALTY = 10.0
#: Words kept by a worker; a full cache starts afresh, so memory is bounded.
CACHE_WORDS = 1_000_000

BLANK_RUN = re.compile(r"[\x20\t-\r]+")
WORD = re.compile(r"[^\x20\t-\r]+")
MARKED = re.compile(f"{MARK}[^{MARK}]*")


def vocabulary_of(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, by id."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the pieces of the best segmentation of each word.

    The rules are those of a unigram tokenizer: the path of the highest summed score
    wins, of equal paths the one whose last piece is longest; a character that is no
    piece itself may be taken as unknown at the lowest score less a penalty, and an
    unknown stretch is one piece, or one per byte if the vocabulary has the bytes.
    """

    def __init__(self, vocabulary: list[tuple[str, float]]):
        ids: dict[str, int] = {}
        for number, (piece, _) in enumerate(vocabulary):
            ids[piece] = number  # of repeated pieces the last counts
        self.automaton = ahocorasick.Automaton()
        for piece, number in ids.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), vocabulary[number][1]))
        self.automaton.make_automaton()
        self.single = {p for p in ids if len(p) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.byte_pieces = {b for b in range(256) if f"<0x{b:02X}>" in ids}
        self.known: dict[str, int] = {}

    def pieces(self, word: str) -> int:
        """Pieces of one marked word."""
        if not self.single.issuperset(word):
            return self._with_unknown(word)
        best: list[float | None] = [None] * (len(word) + 1)
        count = [0] * (len(word) + 1)
        best[0] = 0.0
        # matches come by their end and, of one end, the longest first: that is the tie rule
        for last, (length, score) in self.automaton.iter(word):
            end = last + 1
            total = best[end - length] + score
            if best[end] is None or total > best[end]:
                best[end] = total
                count[end] = count[end - length] + 1
        return count[-1]

    def _with_unknown(self, word: str) -> int:
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        came = [(0, False)] * (n + 1)  # where the last piece begins, and whether it is unknown
        best[0] = 0.0
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, (length, score) in self.automaton.iter(word):
            ends[last + 1].append((last + 1 - length, score))
        for end in range(1, n + 1):
            for start, score in ends[end]:
                total = best[start] + score
                if best[end] is None or total > best[end]:
                    best[end], came[end] = total, (start, False)
            if word[end - 1] not in self.single:
                total = best[end - 1] + self.unknown
                if best[end] is None or total > best[end]:
                    best[end], came[end] = total, (end - 1, True)
        count, end = 0, n
        while end:
            start, unknown = came[end]
            while unknown and start and came[start][1]:
                start = came[start][0]
            spelled = word[start:end].encode() if unknown else b""
            count += len(spelled) if unknown and self.byte_pieces.issuperset(spelled) else 1
            end = start
        return count

    def __call__(self, text: str) -> tuple[int, int]:
        """Pieces and words of a text: blanks part words, and each gets the mark before it."""
        known = self.known
        if MARK in text:
            marked = BLANK_RUN.sub(MARK, text)
            found = MARKED.findall(marked if marked[0] == MARK else MARK + marked)
            return sum(self.pieces(w) for w in found), len(found)
        found = WORD.findall(text)
        if text and text[-1] in " \t\n\x0b\x0c\r":
            found.append("")  # a blank at the end is a mark alone
        try:
            return sum(map(known.__getitem__, found)), len(found)
        except KeyError:
            new = {w for w in found if w not in known}
            if len(known) + len(new) > CACHE_WORDS:
                known.clear()
                new = set(found)
            known.update((w, self.pieces(MARK + w)) for w in new)
            return sum(map(known.__getitem__, found)), len(found)


@cache
def counter_of(path: str) -> Counter:
    """The counter of a worker, kept from task to task; all it holds can be made again."""
    return Counter(vocabulary_of(path))


def token_counts(
    docs: DataFrame, path: str, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``n_tokens`` and ``n_words`` of every whole text under the unigram vocabulary at ``path``.

    The file is installed on every executor and read by each task. Null and empty
    texts have no tokens; a text of blanks only is one mark. Words of any length are
    segmented whole. Repeated rows count alike; an empty table gives an empty result;
    columns besides ``carry`` and the text are not looked at.
    """

    def start():
        counter = counter_of(path)

        def work(texts: list[str]) -> dict[str, list]:
            rows = [counter(t) for t in texts]
            return {"n_tokens": [n for n, _ in rows], "n_words": [n for _, n in rows]}

        return work

    return map_texts(docs, start, "n_tokens long, n_words long", text_col, carry)
