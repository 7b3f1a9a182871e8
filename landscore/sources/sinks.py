"""Wide tables for people: years in columns, names as they are known."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import metric_name


def metric_file(metric: str, aggregator: str, window: int, tag: str = "") -> str:
    return f"{metric_name(metric)}_{aggregator}_{window}yr{tag}.csv"


def pivot_file(metric: str) -> str:
    return f"BWS_pivot_{metric_name(metric)}.csv"


def tsli_file(aggregator: str, name: str) -> str:
    return f"time_since_last_inundation_{aggregator}_{name}.csv"


def final_file(aggregator: str) -> str:
    return f"FINAL_BWSVulnerability_vegetation_{aggregator}.csv"


def measure_column(measure: str, metric: str, year: int) -> str:
    """ave 1991 of NDVI: ndvi1991; its trend Tndvi1991, its sum sumndvi1991; scores have sc in front. Without a metric the
    measure's own name: tsli1991, sc_tsli1991."""
    if not metric:
        return f"{measure}{year}"
    score, kind = measure.startswith("sc_"), measure.removeprefix("sc_")
    front = {"ave": "", "trend": "T", "sum": "sum"}.get(kind, kind)
    return f"{'sc' if score else ''}{front}{metric_name(metric)}{year}"


def wide_measures(long: DataFrame, keys: Sequence[str], metric: str, measures: Sequence[str], years: Sequence[int]) -> DataFrame:
    """(keys, year, measure, value) as one column for each measure and year, in order of names. The list is explicit, so no
    pass over the data finds it out."""
    columns = sorted(measure_column(m, metric, y) for m in measures for y in years)
    names = {measure_column(m, metric, y): (m, y) for m in measures for y in years}
    each = [F.max(F.when((F.col("measure") == names[c][0]) & (F.col("year") == names[c][1]), F.col("value"))).alias(c) for c in columns]
    return long.groupBy(*keys).agg(*each)


def wide_columns(long: DataFrame, keys: Sequence[str], columns: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Columns of (keys, year, columns) as one for each year, named column and year, in order of names."""
    each = {f"{c}{y}": F.max(F.when(F.col("year") == int(y), F.col(c))) for c in columns for y in years}
    return long.groupBy(*keys).agg(*[each[c].alias(c) for c in sorted(each)])


def write_csv(df: DataFrame, path: str, single: bool = True) -> None:
    """Plain CSV with a header. single: one part file, for small results."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)
