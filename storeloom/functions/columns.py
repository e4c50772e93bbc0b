"""Scalar building blocks: Column in, Column out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


# --- text -----------------------------------------------------------------------------------

def clean_lower(col: str | Column) -> Column:
    return F.lower(F.trim(col))


def clean_upper(col: str | Column) -> Column:
    return F.upper(F.trim(col))


def trimmed_length(col: str | Column) -> Column:
    """Length without outer spaces; 0 for NULL."""
    return F.coalesce(F.length(F.trim(col)), F.lit(0))


def is_all_upper(col: str | Column) -> Column:
    """Has letters and none of them is lower case."""
    c = F.col(col) if isinstance(col, str) else col
    return (c == F.upper(c)) & (c != F.lower(c))


def is_all_lower(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return (c == F.lower(c)) & (c != F.upper(c))


def md5_key(cols: Sequence[str]) -> Column:
    """MD5 over the text form of the key columns; NULL parts become empty text."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("~", *parts))


# --- numbers --------------------------------------------------------------------------------

def money(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(10,2)")


def mean(col: str | Column) -> Column:
    """Average from an exact sum and a count, so that row order cannot change the last digits."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, NULL for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), digits)


def great_circle_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Spherical law of cosines; the cosine is clamped so that equal points give 0, not NaN."""
    la, lb = F.radians(lat_a), F.radians(lat_b)
    cosine = (F.cos(la) * F.cos(lb) * F.cos(F.radians(lng_b) - F.radians(lng_a))
              + F.sin(la) * F.sin(lb))
    return EARTH_RADIUS_KM * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))


# --- dates ----------------------------------------------------------------------------------

def parse_timestamp(col: str | Column, fmt: str | None = None) -> Column:
    """Coercing parse: text that is no timestamp becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return parsed.cast("timestamp_ntz")


def strict_timestamp(col: str | Column) -> Column:
    """Raising cast, as under ANSI mode."""
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")


def elapsed_days(later: str | Column, earlier: str | Column) -> Column:
    """Whole days between two timestamps, cut toward zero."""
    a = F.col(later) if isinstance(later, str) else later
    b = F.col(earlier) if isinstance(earlier, str) else earlier
    return F.extract(F.lit("DAY"), a - b).cast("int")


def days_until(as_of: str, col: str | Column) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), F.to_date(col))


def month_start(col: str | Column) -> Column:
    return F.date_trunc("month", col).cast("timestamp_ntz")


def months_apart(later: Column, earlier: Column) -> Column:
    """Total calendar months from one month start to another."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def is_late(delivered: str | Column, estimated: str | Column) -> Column:
    a = F.col(delivered) if isinstance(delivered, str) else delivered
    b = F.col(estimated) if isinstance(estimated, str) else estimated
    return a > b


def delay_days(delivered: str | Column, estimated: str | Column) -> Column:
    """Whole days past the estimate; 0 when on time or not delivered."""
    return F.when(is_late(delivered, estimated), elapsed_days(delivered, estimated)).otherwise(0)


def delay_class(days: str | Column) -> Column:
    d = F.col(days) if isinstance(days, str) else days
    return (F.when(d <= 0, "ON_TIME").when(d <= 3, "1-3d").when(d <= 7, "4-7d")
            .when(d <= 15, "8-15d").when(d > 15, ">15d"))


def date_sk(col: str | Column) -> Column:
    """Date key yyyymmdd; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c) * 10_000 + F.month(c) * 100 + F.dayofmonth(c)


# --- flags and buckets ----------------------------------------------------------------------

COMPARE = {
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "==": lambda c, v: c == v,
}


def all_present(*cols: str) -> Column:
    """TRUE when every column is there, else FALSE; never NULL."""
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    return present


def in_box(lat: str | Column, lng: str | Column, box: tuple[float, float, float, float]) -> Column:
    """Inclusive bounding box ``(lat_min, lat_max, lng_min, lng_max)``; FALSE for NULL."""
    a = F.col(lat) if isinstance(lat, str) else lat
    b = F.col(lng) if isinstance(lng, str) else lng
    inside = a.between(box[0], box[1]) & b.between(box[2], box[3])
    return F.coalesce(inside, F.lit(False))


def size_category(volume: str | Column) -> Column:
    v = F.col(volume) if isinstance(volume, str) else volume
    return F.when(v < 5_000, "SMALL").when(v < 50_000, "MEDIUM").when(v >= 50_000, "LARGE")


def weight_category(weight: str | Column) -> Column:
    """LIGHT up to 1 kg, MEDIUM up to 10 kg (the overweight limit), HEAVY beyond."""
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.when(w <= 1_000, "LIGHT").when(w <= 10_000, "MEDIUM").when(w > 10_000, "HEAVY")


def seller_tier(delay_pct: str | Column) -> Column:
    p = F.col(delay_pct) if isinstance(delay_pct, str) else delay_pct
    return F.when(p < 10, "GOLD").when(p < 30, "SILVER").when(p >= 30, "BRONZE")


def sentiment(score: str | Column) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= 4, "POSITIVE").when(s <= 2, "NEGATIVE").when(s == 3, "NEUTRAL")


def distance_category(state_a: Column, state_b: Column, region_a: Column, region_b: Column) -> Column:
    return (F.when(state_a == state_b, "LOCAL").when(region_a == region_b, "REGIONAL")
            .otherwise("NATIONAL"))


def net_promoter(score: str | Column) -> Column:
    """Share of 5s minus share of 1s and 2s, in percent points; NULL scores are left out."""
    s = F.col(score) if isinstance(score, str) else score
    return ratio((F.count_if(s == 5) - F.count_if(s <= 2)) * 100, F.count(s))
