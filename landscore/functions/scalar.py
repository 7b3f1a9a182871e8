"""Column functions: missing values, rounding, binning, classification, dates. All run in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TYPE_RULES

INF = float("inf")


def clean_nan(x: Column) -> Column:
    """NaN as null; also takes the sign from negative zero."""
    return F.when(~F.isnan(x), x + F.lit(0.0))


def finite(x: Column) -> Column:
    """NaN and infinities as null."""
    return F.when(~F.isnan(x) & (F.abs(x) != INF), x)


def rint(x: Column, digits: int) -> Column:
    """Scaled, rounded half to even, scaled back; without negative zero."""
    return F.rint(x * 10.0**digits) / 10.0**digits + F.lit(0.0)


def steady(x: Column, digits: int) -> Column:
    """rint() of a quotient of sums, rounded to 10 decimals first: the order in which partitions are summed moves the last
    bits, and may not tip a tie."""
    return F.rint(F.rint(x * 1e10) / 10.0 ** (10 - digits)) / 10.0**digits + F.lit(0.0)


def sum0(x: Column) -> Column:
    """A sum that is 0 where all is missing."""
    return F.coalesce(F.sum(x), F.lit(0.0))


def mean4(x: Column) -> Column:
    """The mean of values with 4 decimals, rounded to 4 decimals. It sums whole ten-thousandths, so the order in which
    partitions are merged can't change it."""
    whole = F.rint(x * 10000).cast("long")
    return F.rint(F.try_divide(F.sum(whole).cast("double"), F.count(x).cast("double"))) / 10000.0 + F.lit(0.0)


def cut(x: Column, bins: Sequence[float], labels: Sequence[float], right: bool = True, include_lowest: bool = True) -> Column:
    """The label of x's bin; null outside of all. Right-closed (the first bin also holds its lower edge) or left-closed."""
    if len(labels) != len(bins) - 1:
        raise ValueError("one label a bin")
    out = F.lit(None).cast("double")
    for i in reversed(range(len(labels))):
        low, high = F.lit(float(bins[i])), F.lit(float(bins[i + 1]))
        inside = (x > low) & (x <= high) if right else (x >= low) & (x < high)
        if right and i == 0 and include_lowest:
            inside = inside | (x == low)
        if not right and bins[i + 1] == INF:
            inside = x >= low
        out = F.when(inside, F.lit(float(labels[i]))).otherwise(out)
    return out


def score(x: Column, bins: Sequence[float] = (-INF, -1, 0, INF), reverse: bool = False) -> Column:
    """Scores 1 to 3 (3 to 1 if reversed) by right-closed bins."""
    labels = list(range(1, len(bins)))
    return cut(x, bins, labels[::-1] if reverse else labels)


def cut_by_group(x: Column, t0: Column, t1: Column, t2: Column) -> Column:
    """3 from t0, 2 from t1, 1 from t2 on; null below t0 or without thresholds."""
    return F.when(x >= t2, F.lit(1.0)).when(x >= t1, F.lit(2.0)).when(x >= t0, F.lit(3.0))


def classify(name: Column, rules: Sequence[tuple[str, str]] = TYPE_RULES) -> Column:
    """The group of the last rule that matches, without regard to case; null if none does."""
    out = F.lit(None).cast("string")
    for pattern, group in rules:
        out = F.when(name.rlike(f"(?i){pattern}"), F.lit(group)).otherwise(out)
    return out


def water_year(year: Column, month: Column, start_month: int = 7) -> Column:
    """The year in which the water year ends."""
    return (year + (month >= start_month).cast("int")).cast("int")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days from one time to another, rounded down."""
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return F.floor((micros(later) - micros(earlier)) / 86_400_000_000.0).cast("int")


def last_day(year: Column) -> Column:
    return F.make_timestamp_ntz(year, F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))


def duration_days(text: Column) -> Column:
    """Days of a text like `12 days 00:00:00`, rounded down."""
    days = F.regexp_extract(text, r"^(-?\d+) days", 1)
    return F.when(days != "", F.try_to_number(days, F.lit("S999999999"))).cast("int")


def year_suffix(name: Column) -> Column:
    """The year that a wide column's name ends with."""
    y = F.regexp_extract(name, r"(\d{4})$", 1)
    return F.when(y != "", y).cast("int")


def metric_name(name: str) -> str:
    return name.replace("+", "").lower()
