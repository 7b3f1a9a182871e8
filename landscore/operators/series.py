"""Annual series per fine unit: (uid, year, value). Densify, baseline, moving mean and trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import INF, finite, mean4, rint, water_year


def densify(annual: DataFrame, years: tuple[int, int] | None = None, fill: float | None = None, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """All years of the span for each series; missing values are null, or `fill`. Series are told apart by keys, of which the
    first is dealt out by: what follows on that key needs no further shuffle. A series' rows are gathered into a map of its
    years (a bounded number), which is laid out again. Without `years` the span is that of the whole table, from a one-row
    aggregate inside the plan."""
    known = annual.where(" and ".join(f"`{k}` is not null" for k in keys))
    if years:
        known = known.where(F.col("year").between(*years))
    dealt = known.repartition(keys[0]) if len(keys) > 1 else known
    by_key = dealt.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("year", "value"))).alias("m"))
    if years:
        by_key = by_key.withColumns({"_first": F.lit(years[0]), "_last": F.lit(years[1])})
    else:
        bounds = annual.agg(F.min("year").alias("_first"), F.max("year").alias("_last"))
        by_key = by_key.crossJoin(F.broadcast(bounds))  # bounds is one row
    out = by_key.select(*keys, "m", F.explode(F.sequence("_first", "_last")).alias("year"))
    value = F.try_element_at("m", F.col("year"))
    return out.select(*keys, "year", (F.coalesce(value, F.lit(fill)) if fill is not None else value).alias("value"))


def baseline_stats(dense: DataFrame, drought: Sequence[int] = ()) -> DataFrame:
    """uid, n, baseline, stddev, max, median, mad (4 decimals). n counts all years, the rest leaves drought years out."""
    in_base = ~F.col("year").isin(list(drought)) if drought else F.lit(True)
    v = F.when(in_base, F.col("value"))
    kept = F.array_compact(F.collect_list(v))
    s = dense.groupBy("uid").agg(F.count("value").alias("n"), mean4(v).alias("baseline"), rint(F.stddev_samp(v), 4).alias("stddev"), rint(F.max(v), 4).alias("max"), F.median(v).alias("_median"), kept.alias("_v"))
    #: The deviations' median needs the median first; a unit's years are few, so both stay in one row.
    away = F.array_sort(F.transform("_v", lambda x: F.abs(x - F.col("_median"))))
    n = F.size(away)
    middle = (F.get(away, F.floor((n - 1) / 2).cast("int")) + F.get(away, F.floor(n / 2).cast("int"))) / 2.0
    return s.select("uid", "n", "baseline", "stddev", "max", rint(F.col("_median"), 4).alias("median"), rint(F.when(n > 0, middle), 4).alias("mad"))


def rounded(dense: DataFrame) -> DataFrame:
    return dense.withColumn("value", rint(F.col("value"), 4))


def standardised(dense: DataFrame, drought: Sequence[int] = (), nobaseline: bool = False, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """(value - baseline) / stddev; missing as 0, no spread and another value as infinity. nobaseline: the values."""
    if nobaseline:
        return dense.withColumn("value", F.coalesce("value", F.lit(0.0)))
    per_uid = Window.partitionBy(*keys)
    v = F.when(~F.col("year").isin(list(drought)), F.col("value")) if drought else F.col("value")
    whole = F.rint(v * 10000).cast("long")
    mean = F.rint(F.try_divide(F.sum(whole).over(per_uid).cast("double"), F.count(v).over(per_uid).cast("double"))) / 10000.0
    d = dense.withColumn("_b", mean).withColumn("_sd", rint(F.stddev_samp(v).over(per_uid), 4))
    away = F.col("value") - F.col("_b")
    z = F.when((F.col("_sd") == 0) & (away != 0), F.when(away > 0, INF).otherwise(-INF)).otherwise(F.coalesce(F.try_divide(away, F.col("_sd")), F.lit(0.0)))
    return d.withColumn("value", z + F.lit(0.0)).drop("_b", "_sd")


def slope(values: Sequence[Column]) -> Column:
    """Slope through k points against their place in units of its population deviation, 4 decimals; null under two."""
    k = len(values)
    if k < 2:
        return F.lit(None).cast("double")
    if k == 2:
        return rint((values[1] - values[0]) / 2.0, 4)
    total = sum(((i - (k - 1) / 2) * v for i, v in enumerate(values)), F.lit(0.0))
    return rint(total / (k * ((k * k - 1) / 12) ** 0.5), 4)


def moving_ave_trend(z: DataFrame, window: int = 5, trend: int | None = None, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """keys, year, ave, trend, sum: mean of the `window` years up to a year, slope of the last `trend` of them, and both
    added. Only years with a whole window; a window of one has no trend and no sum. z: dense, without nulls."""
    t = window if trend is None else trend
    if t > window:
        raise ValueError("the trend can't be longer than the window")
    by_year = Window.partitionBy(*keys).orderBy("year")
    back = [F.lag("value", k).over(by_year) for k in reversed(range(t))] if t > 1 else []
    out = z.withColumn("ave", F.avg("value").over(by_year.rowsBetween(-(window - 1), 0))).withColumn("_n", F.row_number().over(by_year))
    tr = finite(slope(back)) if window > 1 else F.lit(None).cast("double")
    out = out.withColumn("trend", tr).where(F.col("_n") >= window)
    both = F.coalesce("ave", F.lit(0.0)) + F.coalesce("trend", F.lit(0.0)) if window > 1 else F.lit(None).cast("double")
    return out.select(*keys, "year", "ave", "trend", both.alias("sum"))


def deviation_from_baseline(annual: DataFrame, window: int = 5, trend: int | None = 2, nobaseline: bool = False, drought: Sequence[int] = (), years: tuple[int, int] | None = None, keys: Sequence[str] = ("uid",)) -> DataFrame:
    """Annual values to ave, trend and sum per series and year. Densify, standardise and window share one shuffle."""
    dense = rounded(densify(annual, years, keys=keys))
    return moving_ave_trend(standardised(dense, drought, nobaseline, keys), window, trend, keys)


def water_year_annual(monthly: DataFrame, start_month: int = 7) -> DataFrame:
    """uid, year, value: means over water years, each named after the year in which it ends. monthly: uid, year, month, value."""
    year = water_year(F.col("year"), F.col("month"), start_month)
    return monthly.groupBy("uid", year.alias("year")).agg(F.avg("value").alias("value"))


def harmonise_sensors(sensors: Sequence[DataFrame], method: str = "minmax") -> DataFrame:
    """Each sensor's values scaled by its own range (minmax) or mean and deviation (zscore), then united."""
    scale = {"minmax": minmax, "zscore": zscore}[method]
    out = [scale(s, "value") for s in sensors]
    first = out[0]
    for s in out[1:]:
        first = first.unionByName(s)
    return first


def minmax(df: DataFrame, column: str) -> DataFrame:
    g = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    return df.crossJoin(F.broadcast(g)).withColumn(column, F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")  # g is one row


def zscore(df: DataFrame, column: str) -> DataFrame:
    g = df.agg(F.avg(column).alias("_m"), F.stddev_samp(column).alias("_s"))
    return df.crossJoin(F.broadcast(g)).withColumn(column, F.try_divide(F.col(column) - F.col("_m"), F.col("_s"))).drop("_m", "_s")  # g is one row


def regression(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """slope, intercept and r2 of the least-squares line per key. r2 is 1 - residual / total, from one pass."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    d = df.where(both).groupBy(*keys) if keys else df.where(both).groupBy()
    return d.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def r_squared(df: DataFrame, y: str, fitted: str) -> DataFrame:
    """1 - sum((y - fitted)^2) / sum((y - mean)^2) over all rows with both, for a given fit."""
    d = df.where(F.col(y).isNotNull() & F.col(fitted).isNotNull())
    a = d.agg(F.sum((F.col(y) - F.col(fitted)) ** 2).alias("e"), F.var_pop(y).alias("v"), F.count("*").alias("n"))
    return a.select((1 - F.try_divide(F.col("e"), F.col("v") * F.col("n"))).alias("r2"))
