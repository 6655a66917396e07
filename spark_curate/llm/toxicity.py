"""Toxicity by compression distance to two trained zstandard dictionaries."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spark_curate.llm.common import map_texts, remainder
from spark_curate.llm.simhash import fingerprint

#: The classifier is fitted on at most so many labelled documents of each class, picked
#: by a hash, and on so many bytes of their whole texts: what no longer fits is passed over
#: for the next of the draw.
SAMPLE_TOXIC = 1500
SAMPLE_ORDINARY = 3500
SAMPLE_BYTES = 24_000_000
#: Slim rows of the draw for each place in the sample, so that there is a next one.
SPARE = 2
#: Share of the sample that the dictionaries are made from; the rest calibrates.
TRAIN_SHARE = 0.7
#: Near copies within a sample (fingerprints this close) count once.
COPY_BITS = 12

GRAM = 6
MAX_GRAMS = 900
LEAST_DOCUMENTS = 3
LEAST_RATIO = 40.0
LEAST_GAIN = 6.0

WINDOW = 60
STEP = WINDOW - GRAM - 2
#: Both dictionaries end with the same bytes and every window starts with them: the
#: encoder then never stores a window raw, and lengths differ by matches alone. A window
#: has under 64 literals, below which they are not entropy coded.
LEAD = bytes(range(128, 192))
GAP = b"\xff"  # parts selected grams in a dictionary; no UTF-8 text holds it
#: A window is reported as toxic if the toxic dictionary saves more than so many bytes.
MARGIN = 2
#: Differences beyond this many bytes are one class to the evidence.
BIN_SPAN = 8

FIELDS = "score double, predicted int, n_windows long, n_toxic_windows long"


@dataclass
class Model:
    """Two dictionaries and the calibrated weights of the window features."""

    toxic: bytes
    ordinary: bytes
    ratios: list[float]
    centre: list[float]
    spread: list[float]
    weights: list[float]


def smooth(text: str) -> bytes:
    """A text in lower case (A-Z) with single blanks between, before and after its words."""
    return b" " + b" ".join(text.encode().lower().split()) + b" "


def windows(text: str) -> list[bytes]:
    raw = smooth(text)
    return [LEAD + raw[k : k + WINDOW] for k in range(0, max(1, len(raw) - GRAM - 2), STEP)]


def _gain(a: int, n: int, b: int, m: int) -> float:
    """Log-likelihood ratio of a of n against b of m."""

    def part(k: int, total: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((total - k) * math.log(1 - p) if total > k else 0.0)

    both = (a + b) / (n + m)
    return part(a, n, a / n) + part(b, m, b / m) - part(a, n, both) - part(b, m, both)


def _chain(grams: list[bytes]) -> bytes:
    """The grams as dictionary content: overlapping ones run together, best last."""
    after: dict[bytes, list[bytes]] = {}
    for g in grams:
        after.setdefault(g[:-1], []).append(g)
    tails = {g[1:] for g in grams}
    used: set[bytes] = set()
    runs = []
    for g in [g for g in grams if g[:-1] not in tails] + grams:
        if g in used:
            continue
        used.add(g)
        run = g
        while follow := next((h for h in after.get(run[1 - GRAM :], ()) if h not in used), None):
            used.add(follow)
            run += follow[-1:]
        runs.append(run)
    return GAP.join(reversed(runs))


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Content of a dictionary for each class.

    As dictionary builders do, segments are taken by the number of samples that hold
    them; here a segment must also be far more usual in its own class than in the
    other, since what both share shortens both lengths alike and only adds noise.
    """
    counts = []
    for texts in (ordinary, toxic):
        held: Counter = Counter()
        for text in texts:
            raw = smooth(text)
            held.update({raw[k : k + GRAM] for k in range(len(raw) - GRAM + 1)})
        counts.append(held)

    def content(own: Counter, other: Counter, n: int, m: int) -> bytes:
        ranked = sorted(
            (-gain, g)
            for g, a in own.items()
            if a >= LEAST_DOCUMENTS
            and a / n > LEAST_RATIO * (other[g] + 0.5) / m * min(1.0, m / 1000)
            and (gain := _gain(a, n, other[g], m)) >= LEAST_GAIN
        )
        return _chain([g for _, g in ranked[:MAX_GRAMS]])

    n, m = len(toxic), len(ordinary)
    return content(counts[1], counts[0], n, m), content(counts[0], counts[1], m, n)


def compressor(content: bytes):
    """Bytes to compressed length under a dictionary with this content."""
    options = zstandard.ZstdCompressionParameters(
        window_log=14,
        chain_log=13,
        hash_log=13,
        search_log=3,
        min_match=6,
        target_length=16,
        strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False,
        write_checksum=False,
        write_dict_id=False,
    )
    data = zstandard.ZstdCompressionDict(content + LEAD, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=options)
    compress = zstandard.ZstdCompressor(dict_data=data, compression_params=options).compress
    return lambda window: len(compress(window))


def differences(text: str, toxic_length, ordinary_length) -> np.ndarray:
    """Per window: bytes under the ordinary dictionary less bytes under the toxic one."""
    return np.array([ordinary_length(w) - toxic_length(w) for w in windows(text)])


def _bins(saved: np.ndarray) -> np.ndarray:
    """A window's difference as a class: from ``-BIN_SPAN`` to ``BIN_SPAN`` bytes."""
    return np.clip(saved, -BIN_SPAN, BIN_SPAN) + BIN_SPAN


def window_ratios(toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> np.ndarray:
    """Per class of differences: log of how much more usual it is in toxic documents."""
    counts = [
        np.bincount(_bins(np.concatenate(group)), minlength=2 * BIN_SPAN + 1) + 0.5
        for group in (toxic, ordinary)
    ]
    return np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())


def features(saved: np.ndarray, ratios: np.ndarray) -> list[float]:
    """The evidence of all windows together, and per window.

    The sum weighs every window, also those that speak for an ordinary text, so a long
    text is not toxic for a few chance matches nor a short one for a single match.
    """
    evidence = float(ratios[_bins(saved)].sum())
    beyond = np.clip(saved - MARGIN, 0, None)
    return [
        math.copysign(math.log1p(abs(evidence)), evidence),
        evidence / len(saved),
        math.sqrt(beyond.mean()),
        math.sqrt((beyond > 0).mean()),
    ]


def _logistic(rows: np.ndarray, truth: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Weights (the first for the constant) of a ridge logistic regression, by Newton steps."""
    x = np.column_stack([np.ones(len(rows)), rows])
    weights = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(weights))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (truth - p) - penalty @ weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        move = np.linalg.solve(curve, slope)
        weights += move
        if np.abs(move).max() < 1e-8:
            break
    return weights


def _distinct(texts: list[str]) -> list[str]:
    """The texts without near copies of an earlier one (a bounded sample, so all are compared)."""
    marks = np.array([fingerprint(t) for t in texts], np.int64).view(np.uint64)
    kept: list[int] = []
    for i in range(len(texts)):
        if not kept or np.bitwise_count(marks[kept] ^ marks[i]).min() > COPY_BITS:
            kept.append(i)
    return [texts[i] for i in kept]


def fit_texts(toxic: list[str], ordinary: list[str]) -> Model | float:
    """A model from texts of both classes, or the share of toxic ones if one class lacks."""
    toxic, ordinary = _distinct(toxic), _distinct(ordinary)
    if len(toxic) < 2 or len(ordinary) < 2:
        return len(toxic) / max(1, len(toxic) + len(ordinary))
    cuts = [max(1, int(TRAIN_SHARE * len(x))) for x in (toxic, ordinary)]
    content = train_dictionaries(toxic[: cuts[0]], ordinary[: cuts[1]])
    lengths = [compressor(c) for c in content]
    held = [(t, 1) for t in toxic[cuts[0] :]] + [(t, 0) for t in ordinary[cuts[1] :]]
    saved = [differences(t, *lengths) for t, _ in held]
    ratios = window_ratios(*([d for d, (_, y) in zip(saved, held, strict=True) if y == c] for c in (1, 0)))
    rows = np.array([features(d, ratios) for d in saved])
    centre, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    weights = _logistic((rows - centre) / spread, np.array([y for _, y in held], float))
    return Model(*content, ratios.tolist(), centre.tolist(), spread.tolist(), weights.tolist())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sampled=lambda doc_id: remainder(doc_id, 5) != 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model | float:
    """Fit on a bounded sample of the labelled documents for which ``sampled`` holds.

    The draw is over the labelled texts that exist, of any length: one slim row per id
    and text, so an id on a third of all rows is one row, ordered by a hash. The first of
    each class, at most ``SAMPLE_TOXIC`` and ``SAMPLE_ORDINARY`` and ``SAMPLE_BYTES`` of
    text, are fetched whole, one text each. Ids with several labels count as toxic if
    one of them says so; null labels, ids and texts are left out.
    """
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .where(sampled(F.col(id_col)))
        .groupBy(F.col(id_col).alias("_id"))
        .agg((F.max(label_col) > 0).alias("_toxic"))
    )
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where(
        "_id is not null and _text is not null"
    )
    marked = texts.withColumn("_mark", F.xxhash64("_text"))
    slim = marked.groupBy("_id", "_mark").agg(F.max(F.octet_length("_text")).alias("_size"))
    drawn = slim.join(known, "_id").withColumn("_draw", F.xxhash64("_id", "_mark", F.lit(1)))
    spark = docs.sparkSession
    chosen: dict[tuple, bool] = {}
    for toxic, most in ((True, SAMPLE_TOXIC), (False, SAMPLE_ORDINARY)):
        left, taken = SAMPLE_BYTES, 0
        part = drawn.where(F.col("_toxic") if toxic else ~F.col("_toxic"))
        for row in part.orderBy("_draw", "_id", "_mark").limit(SPARE * most).collect():
            if taken < most and row["_size"] <= left:
                chosen[row["_id"], row["_mark"]] = toxic
                left, taken = left - row["_size"], taken + 1
    picked = spark.createDataFrame([k for k in chosen], drawn.select("_id", "_mark").schema)
    found = marked.join(F.broadcast(picked), ["_id", "_mark"]).groupBy("_id", "_mark").agg(F.min("_text").alias("_text"))
    fetched = {(r["_id"], r["_mark"]): r["_text"] for r in found.collect()}
    ordered = [(fetched[k], toxic) for k, toxic in chosen.items()]
    return fit_texts([t for t, toxic in ordered if toxic], [t for t, toxic in ordered if not toxic])


def score(
    docs: DataFrame,
    model: Model | float,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Toxicity of every whole text, a row per row of ``docs``.

    Overlapping windows of the text are compressed under both dictionaries; the evidence
    of the length differences becomes a score from 0 to 1 by the calibrated regression;
    ``predicted`` is 1 from 0.5 on. Null and empty texts are one empty
    window and get the score of a text without any match. Repeated rows score alike.
    Without labelled texts of both classes every score is the share of toxic ones.
    An empty table gives an empty result; columns besides ``carry`` and the text are
    not looked at. The model is a few kilobytes by construction.
    """

    def start():
        if not isinstance(model, Model):
            return lambda texts: {
                "score": [model] * len(texts),
                "predicted": [int(model >= 0.5)] * len(texts),
                "n_windows": [0] * len(texts),
                "n_toxic_windows": [0] * len(texts),
            }
        lengths = compressor(model.toxic), compressor(model.ordinary)
        ratios, centre, spread, weights = (
            np.array(x) for x in (model.ratios, model.centre, model.spread, model.weights)
        )

        def work(texts: list[str]) -> dict[str, list]:
            saved = [differences(t, *lengths) for t in texts]
            rows = (np.array([features(s, ratios) for s in saved]).reshape(-1, len(centre)) - centre) / spread
            scores = 1 / (1 + np.exp(-np.clip(rows @ weights[1:] + weights[0], -30, 30)))
            return {
                "score": scores.tolist(),
                "predicted": (scores >= 0.5).astype(int).tolist(),
                "n_windows": [len(s) for s in saved],
                "n_toxic_windows": [int((s > MARGIN).sum()) for s in saved],
            }

        return work

    return map_texts(docs, start, FIELDS, text_col, carry)
