"""The three entry points as plans over long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import INF, score
from ..operators import series, units

BINS, SOIL_BINS = (-INF, -1, 0, INF), (-1, 0.25, 0.5, 1)


def metric_pipeline(
    annual: DataFrame,
    bridge: DataFrame,
    unit_cols: Sequence[str],
    window: int = 5,
    trend: int | None = 2,
    bins: Sequence[float] = BINS,
    reverse: bool = False,
    nobaseline: bool = False,
    drought: Sequence[int] = (),
    scored: bool = True,
    by_grp: bool = True,
    identity: bool = False,
    years: tuple[int, int] | None = None,
    metric: str | None = None,
) -> DataFrame:
    """Annual values to units: keys, year, measure (ave, trend, sum), value, area, score. Weighted and rounded, then scored.
    metric: a column of annual that tells several metrics apart; all of them go through one plan."""
    dev = series.deviation_from_baseline(annual, window, trend, nobaseline, drought, years, ["uid", *([metric] if metric else [])])
    measures = ["ave", "trend", "sum"] if window > 1 else ["ave"]
    keys = [c for c in unit_cols if c != "uid" or not identity] + (["grp"] if by_grp or identity else []) + ([metric] if metric else [])
    out = units.area_weighted_measures(dev, bridge, keys, measures, identity=identity)
    return out.withColumn("score", score(F.col("value"), bins, reverse)) if scored else out


def all_units(bridges: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """uid, agg, unit (array), grp, area of several ways to sum up in one table: name -> (uid, key columns, grp, area; keys)."""
    out = None
    for name, (bridge, cols) in bridges.items():
        unit = F.array(*[F.col(c).cast("string") for c in cols]) if cols else F.array().cast("array<string>")
        complete = bridge.dropna(subset=[*cols, "grp"])
        one = complete.select("uid", F.lit(name).alias("agg"), unit.alias("unit"), "grp", "area")
        out = one if out is None else out.unionByName(one)
    return out
