"""Column functions for cleaning shipment records. No actions, no Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that stand for null in the raw files.
NULL_TOKENS = ("?", "??", "???", "????", "#" * 16)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- nulls, casts -------------------------------------------------------------


def null_tokens(c: str | Column) -> Column:
    return F.when(~F.trim(col(c)).isin(*NULL_TOKENS), col(c))


def to_number(c: str | Column) -> Column:
    """Double, or null where the text is no number."""
    return col(c).try_cast("double")


def to_text(c: str | Column, as_int: bool = False) -> Column:
    """Text, by way of an integer if asked; ``nan`` and ``<NA>`` are null."""
    text = (col(c).try_cast("double").try_cast("bigint") if as_int else col(c)).cast("string")
    return F.when(~F.lower(text).isin("nan", "<na>", "none"), text)


def to_day(c: str | Column, fmt: str | None = None) -> Column:
    return F.try_to_date(col(c), fmt) if fmt else F.try_to_timestamp(col(c)).cast("date")


# -- predicates and text ------------------------------------------------------


def valid_int(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("string").rlike(r"^\s*[+-]?\d+(_\d+)*\s*$"), F.lit(False))


def digits_to_null(c: str | Column) -> Column:
    return F.when(~col(c).rlike(r"^\d+$"), col(c))


def vessel_type_of(mode: str | Column) -> Column:
    return F.when(col(mode) == 10, "container_ship").otherwise("non_container_ship")


def split_in_two(c: str | Column, pattern: str, trimmed: bool = True) -> tuple[Column, Column]:
    """The parts before and after the first match; the second without punctuation
    (and, unless ``trimmed`` is off, without outer blanks)."""
    parts = F.split(col(c), pattern, 2)
    second = F.regexp_replace(F.get(parts, F.lit(1)), r"[^\w\s]+", "")
    first = F.get(parts, F.lit(0))
    return (F.trim(first), F.trim(second)) if trimmed else (first, second)


def listed(c: str | Column, separator: str = ", ") -> Column:
    """A comma list without blanks, empties and repetitions, in order of first occurrence."""
    items = F.split(F.regexp_replace(col(c), r"\s+", ""), ",")
    return F.array_join(F.array_distinct(F.filter(items, lambda x: x != "")), separator)


def printable(c: str | Column) -> Column:
    return F.regexp_replace(col(c), r"[^\x20-\x7E\t\n\r\x0B\x0C]", "")


def untagged(c: str | Column) -> Column:
    """The distinct texts between HTML tags, joined by ``; ``."""
    parts = F.filter(F.split(col(c), "<.*?>"), lambda x: F.trim(x) != "")
    return F.array_join(F.array_distinct(parts), "; ")


def wkt_lat_lon(c: str | Column, length_of: str | Column | None = None) -> tuple[Column, Column]:
    """Latitude and longitude texts of ``POINT (lon lat)``; ``length_of`` names the
    column whose length cuts the text (for results as the published SQL has them)."""
    size = F.length(col(length_of if length_of is not None else c))
    inner = F.substring(col(c), F.lit(8), size - 8)
    return F.split_part(inner, F.lit(" "), F.lit(2)), F.split_part(inner, F.lit(" "), F.lit(1))


def location_text(lat: str | Column, lon: str | Column) -> Column:
    number = lambda c: F.coalesce(col(c), F.lit(0.0)).cast("string")
    return F.concat(F.lit("{latitude: "), number(lat), F.lit(", longitude: "), number(lon), F.lit("}"))


def replace_words(c: Column, words: dict[str, str]) -> Column:
    """Plain substring replacement, one pair after the other."""
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), words.items(), c)


# -- dates --------------------------------------------------------------------


def with_year(day: Column, year: Column) -> Column:
    """``day`` in another year; 29 February becomes the 28th where there is none."""
    return F.add_months(day, ((year - F.year(day)) * 12).cast("int"))


def month_end_after(c: str | Column) -> Column:
    """The next month end after the day (from a month end, the following one)."""
    return F.last_day(F.date_add(col(c), 1))


def month_start_before(c: str | Column) -> Column:
    """The last month start before the day (from a first, that of the month before)."""
    return F.trunc(F.date_sub(col(c), 1), "MM")


def quarter(c: str | Column) -> Column:
    return F.date_trunc("QUARTER", col(c))


def quarter_text(c: str | Column) -> Column:
    return F.concat(F.year(col(c)).cast("string"), F.lit("-"), F.quarter(col(c)).cast("string"), F.lit("Q"))


def year_month(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyyMM")


# -- numbers ------------------------------------------------------------------


def half_even(c: str | Column, digits: int = 0) -> Column:
    """Rounded half to even after scaling in floating point, as array libraries do
    (``bround`` looks at the exact decimal digits and differs in the last place)."""
    scale = float(10**digits)
    return F.rint(col(c).cast("double") * scale) / scale


def delay_ratio(delayed: str | Column, total: str | Column) -> Column:
    return half_even(col(delayed) / col(total), 4)


def inverse_delay(q95: str | Column) -> Column:
    return F.when(col(q95) <= 0, F.lit(1.0)).otherwise(half_even(1 / col(q95), 4))


def utilization(count: str | Column, teu: str | Column, whole: bool = False) -> Column:
    """Containers over capacity, at most 1; null where either is null or 0.
    ``whole``: divide integers as integers (towards zero)."""
    a, b = col(count), col(teu)
    ratio = a.cast("double") / b
    ratio = F.when(ratio < 0, F.ceil(ratio)).otherwise(F.floor(ratio)).cast("double") if whole else ratio
    return F.when(a.isNull() | (a == 0) | b.isNull() | (b == 0), F.lit(None)).when(a > b, F.lit(1.0)).otherwise(ratio)


def last_of(c: str, by: str) -> Column:
    """The last non-null value in order of ``by``, ties going to the greatest value."""
    return F.expr(f"max_by({c}, struct({by}, {c})) FILTER (WHERE {c} IS NOT NULL)")


def first_of(c: str, by: str) -> Column:
    return F.expr(f"min_by({c}, struct({by}, {c})) FILTER (WHERE {c} IS NOT NULL)")
