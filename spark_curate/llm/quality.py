"""Compression bands: zstandard ratios tell repetitive and incompressible text."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter

import zstandard
from pyspark.sql import DataFrame

from spark_curate.llm.common import BLANKS, map_texts

#: Limits of the ratio bytes / compressed bytes: (from this many bytes on, least, most).
#: The ratio of prose rises with the length, so each length has its own band. Below the
#: first length there is too little to compress and only the base rules decide.
BANDS = (
    (192, 1.10, 2.30),
    (512, 1.25, 2.20),
    (1024, 1.40, 2.30),
    (2048, 1.50, 2.40),
    (4096, 1.60, 2.55),
    (8192, 1.70, 2.65),
    (16384, 1.75, 2.80),
    (32768, 1.80, 3.00),
)
#: Fixed chunks of this many bytes, each compressed alone; a chunk has its own band. What
#: is left at the end is a chunk as well, with the band of a text of its length.
CHUNK_BYTES = 2048
CHUNK_BAND = (1.50, 2.35)
#: A document fails if more than this share of its chunks leaves their band, on whichever
#: side; of the chunks after the first ``FEW_CHUNKS``, more than ``LATER_SHARE``.
CHUNK_SHARE = 0.25
FEW_CHUNKS = 16
LATER_SHARE = 0.125
#: It also fails if more than so many chunks in a row leave it.
MOST_IN_A_ROW = 4
LEVEL = 3

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long, verdict string"
)


def repeated_words(tokens: list[bytes], width: int = 3) -> int:
    """Words that stand in a window of ``width`` words found twice or more."""
    windows = list(zip(*(tokens[k:] for k in range(width)), strict=False))
    found = set(windows)
    if len(found) == len(windows):
        return 0
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = bytearray(len(tokens))
    for i, window in enumerate(windows):
        if window in twice:
            covered[i : i + width] = b"\x01" * width
    return sum(covered)


def repeated_lines(text: str) -> int:
    """Lines holding a word that are equal to an earlier line."""
    lines = [line for line in text.split("\n") if line.encode().split()]
    return len(lines) - len(set(lines))


def _band(size: int) -> tuple[float, float]:
    """The band of a text of so many bytes, at least those of the first."""
    return BANDS[bisect_right([b[0] for b in BANDS], size) - 1][1:]


def judge(raw: bytes, squeeze) -> tuple[float | None, int, int, str]:
    """Ratio of the whole text, its chunks, those out of band, and the verdict.

    ``keep``, ``repetitive`` (above a band) or ``incompressible`` (below one); chunks on
    both sides count together and the more frequent side names them. A text shorter than
    the first band is kept, and such a rest is no chunk.
    """
    if len(raw) < BANDS[0][0]:
        return None, 0, 0, "keep"
    ratio = len(raw) / len(squeeze(raw))
    least, most = _band(len(raw))
    chunks = high = low = row = longest = 0
    for k in range(0, len(raw) if len(raw) >= CHUNK_BYTES else 0, CHUNK_BYTES):
        part = raw[k : k + CHUNK_BYTES]
        if len(part) < BANDS[0][0]:
            break
        bottom, top = CHUNK_BAND if len(part) == CHUNK_BYTES else _band(len(part))
        part_ratio = len(part) / len(squeeze(part))
        chunks += 1
        high += part_ratio > top
        low += part_ratio < bottom
        row = 0 if bottom <= part_ratio <= top else row + 1
        longest = max(longest, row)
    allowed = CHUNK_SHARE * min(chunks, FEW_CHUNKS) + LATER_SHARE * max(0, chunks - FEW_CHUNKS)
    failed = high + low > allowed or longest > MOST_IN_A_ROW
    if ratio > most or failed and high >= low:
        verdict = "repetitive"
    elif ratio < least or failed:
        verdict = "incompressible"
    else:
        verdict = "keep"
    return ratio, chunks, high + low, verdict


def quality(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Base counts and the verdict of the compression bands, one row per row of ``docs``.

    ``base_failed``: under 50 words, or over half of the words in repeated 3-word
    windows. ``kept``: the base rules hold and the bands say ``keep``. Null and empty
    texts have no words, fail the base rules and are not kept (ratio null). Repeated
    rows are judged alike; texts of any length are read whole; an empty table gives
    an empty result. Columns besides ``carry`` and the text are not looked at.
    """

    def start():
        squeeze = zstandard.ZstdCompressor(level=LEVEL).compress

        def work(texts: list[str]) -> dict[str, list]:
            rows = []
            for text in texts:
                raw = text.encode()
                tokens = raw.split()
                n = len(tokens)
                repeats = repeated_words(tokens)
                failed = n < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * n
                ratio, whole, bad, verdict = judge(raw, squeeze)
                rows.append(
                    (
                        n,
                        len(text) - (len(raw) - len(raw.translate(None, BLANKS))),
                        len(raw) - len(raw.translate(None, SYMBOLS)),
                        repeated_lines(text),
                        repeats,
                        failed,
                        not failed and verdict == "keep",
                        ratio,
                        whole,
                        bad,
                        verdict,
                    )
                )
            names = [f.split()[0] for f in FIELDS.split(", ")]
            return {name: [r[k] for r in rows] for k, name in enumerate(names)}

        return work

    return map_texts(docs, start, FIELDS, text_col, carry)
