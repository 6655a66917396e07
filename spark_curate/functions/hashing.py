"""64-bit perceptual hashes: distance, bands and probes."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
MAX_PROBES = 256
#: Most probes of a row and band on one side of a cost-chosen plan.
MAX_SIDE_PROBES = 6_000
#: A probe row is made, shuffled and sorted; a candidate only compared.
PROBE_COST = 8
#: Most masks of a cut, and what a row's copy under a mask costs in comparisons by numpy.
MAX_MASKS, COPY_COST = 300, 500


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


@dataclass(frozen=True)
class BandPlan:
    """Split of the hash into bands.

    Two hashes within ``threshold`` agree on some band up to ``radius`` flipped
    bits, since the flips cannot exceed ``radius`` in every band. ``flips`` of them are
    made by one side and the rest by the other: the sides meet half way, which takes
    far fewer probes than flipping all on one side.
    """

    threshold: int
    bands: tuple[tuple[int, int], ...]  # (shift, width)
    radius: int
    flips: int = 0

    @staticmethod
    def masks(width: int, flips: int) -> list[int]:
        """All masks of up to ``flips`` bits in a band of this width."""
        return [
            sum(1 << bit for bit in bits)
            for n in range(flips + 1)
            for bits in combinations(range(width), n)
        ]


def _plan(threshold: int, count: int, flips: int = 0) -> BandPlan:
    widths = [BITS // count + (1 if i < BITS % count else 0) for i in range(count)]
    shifts = [sum(widths[:i]) for i in range(count)]
    return BandPlan(threshold, tuple(zip(shifts, widths)), threshold // count, flips)


def _checked(threshold: int) -> None:
    if not 0 <= threshold < BITS:
        raise ValueError(f"threshold must be in [0, {BITS})")


def band_plan(threshold: int) -> BandPlan:
    """Fewest bands whose probes per band stay within ``MAX_PROBES``."""
    _checked(threshold)
    for count in range(1, BITS + 1):
        plan = _plan(threshold, count)
        if _probe_count(max(w for _, w in plan.bands), plan.radius) <= MAX_PROBES:
            return plan
    raise ValueError("no band plan")


def band_plans(threshold: int) -> list[BandPlan]:
    """The plans worth weighing: each number of bands that lowers the radius, each split of it."""
    _checked(threshold)
    counts = sorted({min(c for c in range(1, threshold + 2) if threshold // c == r) for r in {threshold // c for c in range(1, threshold + 2)}})
    plans = [_plan(threshold, c, flips) for c in counts for flips in range(threshold // c + 1)]
    return [p for p in plans if max(side_probes(p, max(w for _, w in p.bands))) <= MAX_SIDE_PROBES] or [band_plan(threshold)]


def side_probes(plan: BandPlan, width: int) -> tuple[int, int]:
    """Probes of a row in a band of this width: on the side of the rest, on that of ``flips``."""
    return _probe_count(width, plan.radius - plan.flips), _probe_count(width, plan.flips)


def plan_cost(plan: BandPlan, few: int, many: int, rates: dict[tuple[int, int], float] | None = None) -> float:
    """Probe rows and expected candidates, in comparisons.

    ``rates`` holds for a band (shift, width) how often two rows share its value; bits
    that say little make it larger than the even share 2^-width.
    """
    probes = candidates = 0.0
    for band in plan.bands:
        ours, theirs = side_probes(plan, band[1])
        probes += few * ours + many * theirs
        rate = max(2.0 ** -band[1], (rates or {}).get(band, 0.0))
        candidates += few * many * min(1.0, ours * theirs * rate)
    return PROBE_COST * probes + candidates


def cheapest_plan(
    threshold: int, few: int, many: int, rates: dict[tuple[int, int], float] | None = None
) -> BandPlan:
    """The plan of least cost for sides of so many rows: wider bands as tables grow."""
    return min(band_plans(threshold), key=lambda p: plan_cost(p, few, many, rates))


@dataclass(frozen=True)
class Cut:
    """Masks of which two hashes within ``threshold`` agree under one at least.

    Of ``threshold + r`` blocks of bits, so many differing bits leave ``r`` untouched; the
    masks are all choices of ``r`` blocks.
    """

    threshold: int
    masks: tuple[int, ...]

    @property
    def share(self) -> float:
        """Share of the pairs of even hashes that meet, summed over the masks."""
        return sum(2.0 ** -mask.bit_count() for mask in self.masks)


def cuts(threshold: int) -> list[Cut]:
    """The cuts worth weighing, from few wide groups of rows to many narrow ones."""
    _checked(threshold)
    found = []
    for agreed in range(1, BITS - threshold + 1):
        if math.comb(threshold + agreed, agreed) > MAX_MASKS:
            break
        blocks = [((1 << width) - 1) << shift for shift, width in _plan(threshold, threshold + agreed).bands]
        found.append(Cut(threshold, tuple(sum(chosen) for chosen in combinations(blocks, agreed))))
    return found


def cheapest_cut(threshold: int, few: int, many: int) -> Cut:
    """The cut of least cost for sides of so many rows: more masks as tables grow."""
    return min(cuts(threshold), key=lambda c: COPY_COST * len(c.masks) * (few + many) + few * many * c.share)


def _probe_count(width: int, radius: int) -> int:
    total, term = 0, 1
    for flips in range(radius + 1):
        total += term
        term = term * (width - flips) // (flips + 1)
    return total


def band_value(phash: Column, shift: int, width: int) -> Column:
    if width == BITS:
        return phash
    return F.shiftrightunsigned(phash, shift).bitwiseAND(F.lit((1 << width) - 1))


def probes(df: DataFrame, phash: str, plan: BandPlan, flips: int, own: str) -> DataFrame:
    """Repeat each row per band and per mask of up to ``flips`` bits.

    Adds ``band``, ``value`` (the flipped band) and the unflipped band as ``own``.
    The masks are one constant array; shifting and flipping stay in generated code.
    """
    masks = [
        {"band": i, "shift": shift, "ones": _signed((1 << width) - 1), "mask": _signed(mask)}
        for i, (shift, width) in enumerate(plan.bands)
        for mask in plan.masks(width, flips)
    ]
    table = F.from_json(
        F.lit(json.dumps(masks)), "array<struct<band:int,shift:int,ones:bigint,mask:bigint>>"
    )
    part = F.call_function("shiftrightunsigned", F.col(phash), F.col("_k.shift"))
    banded = df.select("*", F.explode(table).alias("_k")).select(
        *df.columns, F.col("_k.band").alias("band"), F.col("_k.mask").alias("_m"),
        part.bitwiseAND(F.col("_k.ones")).alias(own),
    )
    return banded.select(
        *df.columns, "band", F.col(own).bitwiseXOR(F.col("_m")).alias("value"), own
    )


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def canonical_meeting(a_own: Column, b_own: Column, value: Column, flips: int = 1) -> Column:
    """True at one of the values at which two hashes meet within a band.

    With ``flips`` allowed on b's side that is b with its lowest differing bits
    flipped, as many as there are up to that number.
    """
    left = a_own.bitwiseXOR(b_own)
    met = b_own
    for _ in range(flips):
        lowest = left.bitwiseAND(-left)
        met, left = met.bitwiseXOR(lowest), left.bitwiseXOR(lowest)
    return value == met


def first_band(a: Column, b: Column, plan: BandPlan) -> Column:
    """Lowest band in which two hashes differ by at most the radius."""
    differing = a.bitwiseXOR(b)
    return F.coalesce(
        *[
            F.when(F.bit_count(band_value(differing, shift, width)) <= plan.radius, F.lit(i))
            for i, (shift, width) in enumerate(plan.bands)
        ]
    )
