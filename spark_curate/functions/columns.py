"""Small column expressions: coercion, formatting, maps and arrays."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts read as a missing number.
MISSING_NUMBERS = ("", "n/a", "nan", "none")

UNKNOWN = "unknown"


def tolerant_double(c: Column) -> Column:
    """Text to double; blank, ``n/a``, ``nan``, ``none`` and garbage become null."""
    text = F.trim(c.cast("string"))
    return F.when(~F.lower(text).isin(*MISSING_NUMBERS), text.try_cast("double"))


def is_true_text(c: Column) -> Column:
    """True only where the text reads ``true`` in any case."""
    return F.coalesce(F.lower(F.trim(c)) == "true", F.lit(False))


def or_unknown(c: Column) -> Column:
    return F.coalesce(c, F.lit(UNKNOWN))


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, null where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ceil_div(a: Column, b: int) -> Column:
    return F.ceil(a / F.lit(b)).cast("bigint")


def contains_ci(c: Column, needle: str) -> Column:
    return F.contains(F.lower(c), F.lit(needle.lower()))


def percent_text(c: Column) -> Column:
    """``0.123`` -> ``12.3%``; a dash where the value is missing."""
    return F.when(c.isNull(), F.lit("—")).otherwise(F.format_string("%.1f%%", c * 100))


def four_places(c: Column) -> Column:
    """A score as logged: four decimals, ``N/A`` where missing."""
    return F.when(c.isNull(), F.lit("N/A")).otherwise(F.format_string("%.4f", c))


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def title_words(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def lookup(m: Column, key, default=None) -> Column:
    """Map lookup with a default."""
    key = key if isinstance(key, Column) else F.lit(key)
    found = F.try_element_at(m, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def merge_maps(old: Column, new: Column) -> Column:
    """Union of two maps; the second wins on shared keys."""
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def map_from_columns(pairs: Iterable[tuple[str, Column]]) -> Column:
    """A map from literal keys to columns."""
    flat: list[Column] = []
    for key, value in pairs:
        flat += [F.lit(key), value]
    return F.create_map(*flat)


def sorted_set(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def run_id(at: Column | None = None) -> Column:
    """``20260308T120000Z``: the id of a run in UTC."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyyMMdd'T'HHmmss'Z'")


def unnest(df: DataFrame, keep: Iterable[Column | str], nested: Column, *names: str) -> DataFrame:
    """``keep`` plus one row per entry of a map or array, as the given names.

    The plain generators make the planner test the nested value for emptiness
    below the projection that makes it, which runs an Arrow function twice; the
    outer form does not, and its rows for empty values are dropped above.
    """
    rows = df.select(*keep, F.explode_outer(nested).alias(*names))
    return rows.where(F.col(names[0]).isNotNull())


def unnest_at(
    df: DataFrame, keep: Iterable[Column | str], nested: Column, position: str, name: str
) -> DataFrame:
    """Like :func:`unnest` for an array, with the position of each entry."""
    rows = df.select(*keep, F.posexplode_outer(nested).alias(position, name))
    return rows.where(F.col(position).isNotNull())
