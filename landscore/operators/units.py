"""From fine units to coarse ones: area weighting, elapsed time, scores, composite indices, surveys, habitats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import cut_by_group, finite, last_day, rint, steady, sum0, whole_days


def area_weighted(long: DataFrame, bridge: DataFrame, unit_cols: Sequence[str], by_grp: bool = True, digits: int = 4, identity: bool = False, skip_missing: bool = False) -> DataFrame:
    """Sum of value times area over the area of all rows (of rows with a value, if skip_missing), per unit (and grp), year
    and measure, and the area. A missing value counts as 0 in the sum. A uid counts in full in each of its units. Rows
    with a missing key vanish. identity: values of the uids, with grp and area. long: uid, year, measure, value."""
    joined = long.join(bridge, "uid")
    value = finite(F.col("value"))
    if identity:
        return joined.select("uid", "grp", "year", "measure", value.alias("value"), "area")
    keys = [*unit_cols, *(["grp"] if by_grp else [])]
    area = F.when(value.isNotNull(), F.col("area")) if skip_missing else F.col("area")
    g = joined.dropna(subset=keys).groupBy(*keys, "year", "measure") if keys else joined.groupBy("year", "measure")
    out = g.agg(steady(F.try_divide(sum0(value * F.col("area")), F.sum(area)), digits).alias("value"), F.sum("area").alias("area"))
    return out.select(*keys, "year", "measure", "value", "area")


def area_weighted_measures(wide: DataFrame, bridge: DataFrame, keys: Sequence[str], measures: Sequence[str], digits: int = 4, identity: bool = False) -> DataFrame:
    """area_weighted() of several measures at once, which stay columns until they are summed: the join carries each uid and
    year once. wide: uid, year, measures and perhaps some of the keys; bridge: uid, the other keys, area. Gives keys, year,
    measure, value, area; with identity uid, keys, year, measure, value, area."""
    joined = wide.join(bridge, "uid")
    if identity:
        out = joined.select("uid", *keys, "year", "area", *[rint(finite(F.col(m)), digits).alias(m) for m in measures])
        return out.unpivot(["uid", *keys, "year", "area"], list(measures), "measure", "value")
    g = joined.dropna(subset=list(keys)).groupBy(*keys, "year") if keys else joined.groupBy("year")
    mean = lambda m: steady(F.try_divide(sum0(finite(F.col(m)) * F.col("area")), F.sum("area")), digits)
    out = g.agg(*[mean(m).alias(m) for m in measures], F.sum("area").alias("area"))
    return out.unpivot([*keys, "year", "area"], list(measures), "measure", "value").select(*keys, "year", "measure", "value", "area")


def time_since_last(events: DataFrame, finals: DataFrame, years: Sequence[int]) -> DataFrame:
    """uid, year, tsli: whole days from the end of the last event begun before 31 December to that day (or the uid's final
    date, if earlier); null without such an event. A missing end never is the last. events: uid, start_time, end_time;
    finals: uid, final_date."""
    spine = F.array(*[F.lit(int(y)) for y in sorted(years)])
    #: Every event counts from some year on, so a unit keeps one latest end for each such year, not a copy of each event a year.
    begun = F.year("start_time")
    known_by = begun + (F.col("start_time") >= last_day(begun)).cast("int")
    first = F.lit(None).cast("int")
    for y in sorted(years, reverse=True):
        first = F.when(known_by <= y, F.lit(int(y))).otherwise(first)
    ends = events.where("end_time is not null").groupBy("uid", first.alias("first")).agg(F.max("end_time").alias("end")).where("first is not null")
    marks = ends.groupBy("uid").agg(F.collect_list(F.struct("first", "end")).alias("marks"))  # one entry a year at most
    out = finals.join(marks, "uid", "left").withColumn("year", F.explode(spine))
    known = F.filter("marks", lambda m: m["first"] <= F.col("year"))
    end = F.least(F.array_max(F.transform(known, lambda m: m["end"])), last_day(F.col("year")))
    until = F.least("final_date", last_day(F.col("year")))
    return out.select("uid", "year", F.when(F.size(known) > 0, whole_days(until, end)).alias("tsli"))


def latest_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows that hold their group's largest value, all ties."""
    top = F.max(column).over(Window.partitionBy(*keys))
    return df.withColumn("_top", top).where(F.col(column) == F.col("_top")).drop("_top")


def score_by_group(df: DataFrame, column: str, thresholds: DataFrame) -> DataFrame:
    """Adds sc_<column> by the grp's thresholds (grp, t0, t1, t2: a small fixed table)."""
    s = df.join(F.broadcast(thresholds), "grp", "left")
    return s.withColumn(f"sc_{column}", cut_by_group(F.col(column), F.col("t0"), F.col("t1"), F.col("t2"))).drop("t0", "t1", "t2")


def score_then_aggregate(tsli: DataFrame, bridge: DataFrame, unit_cols: Sequence[str], thresholds: DataFrame) -> DataFrame:
    """Days and scores of uids, both weighted to units, 1 decimal. tsli: uid, year, tsli; bridge: uid, units, grp, area."""
    scored = score_by_group(tsli.join(bridge.select("uid", "grp").distinct(), "uid"), "tsli", thresholds)
    long = scored.select("uid", "year", F.col("tsli").cast("double").alias("tsli"), "sc_tsli").unpivot(["uid", "year"], ["tsli", "sc_tsli"], "measure", "value")
    return area_weighted(long, bridge, unit_cols, digits=1)


def sum_rescale(parts: DataFrame, keys: Sequence[str], k: int = 3) -> DataFrame:
    """(S - n) / (n k - n) of n scores 1..k that sum to S, 1 decimal; null without a score."""
    s = parts.dropna(subset=list(keys)).groupBy(*keys).agg(sum0(F.col("score")).alias("s"), F.count("score").alias("n"))
    return s.select(*keys, rint(F.try_divide(F.col("s") - F.col("n"), F.col("n") * k - F.col("n")), 1).alias("value"))


def normalise_global(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    """A column scaled to 0..1 by its range over all rows."""
    g = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    x = F.try_divide(F.col(column) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return df.crossJoin(F.broadcast(g)).withColumn(column, rint(x, digits) if digits is not None else x).drop("_lo", "_hi")  # g is one row


def vulnerability(parts: DataFrame, keys: Sequence[str], k: int = 3, within: Sequence[str] = ()) -> DataFrame:
    """keys, cond, stress, vul. parts: keys, kind (cond or stress), score; both sides come from one aggregate. within: keys
    (a small number of values) of the tables that are each scaled to 0..1 by themselves."""
    side = lambda kind: F.when(F.col("kind") == kind, F.col("score"))
    rescaled = lambda s, n: rint(F.try_divide(F.col(s) - F.col(n), F.col(n) * k - F.col(n)), 1)
    sums = [e for c in ("cond", "stress") for e in (sum0(side(c)).alias(f"_s_{c}"), F.count(side(c)).alias(f"_n_{c}"))]
    wide = parts.dropna(subset=list(keys)).groupBy(*keys).agg(*sums)
    wide = wide.select(*keys, rescaled("_s_cond", "_n_cond").alias("cond"), rescaled("_s_stress", "_n_stress").alias("stress"))
    wide = wide.withColumn("vul", F.coalesce("cond", F.lit(0.0)) + F.coalesce("stress", F.lit(0.0)))
    if not within:
        return normalise_global(wide, "vul", 1)
    g = wide.groupBy(*within).agg(F.min("vul").alias("_lo"), F.max("vul").alias("_hi"))
    scaled = rint(F.try_divide(F.col("vul") - F.col("_lo"), F.col("_hi") - F.col("_lo")), 1)
    return wide.join(g, list(within)).withColumn("vul", scaled).select(*keys, "cond", "stress", "vul")


def select_scores(long: DataFrame, measure: str, years: Sequence[int]) -> DataFrame:
    return long.where((F.col("measure") == measure) & F.col("year").isin([int(y) for y in years]))


def survey_counts(df: DataFrame, unit: str, big: Sequence[str]) -> DataFrame:
    """year, unit, grp, name, n. Small surveys: largest count per site, summed over sites; big ones: sum per survey, largest
    of them; then the larger. df: year, survey, site, unit, grp, name, n."""
    small = df.where(F.coalesce(~F.col("survey").isin(list(big)), F.lit(True)))
    keys = ["year", unit, "grp", "name"]
    a = small.groupBy(*keys, "site").agg(F.max("n").alias("n")).groupBy(*keys).agg(F.sum("n").alias("n"))
    b = df.where(F.col("survey").isin(list(big))).groupBy(*keys, "survey").agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.max("n").alias("n"))
    return a.unionByName(b).groupBy(*keys).agg(F.max("n").alias("n"))


def survey_group_counts(indiv: DataFrame, unit: str) -> DataFrame:
    return indiv.groupBy("year", unit, "grp").agg(F.sum("n").alias("n"))


def richness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct("name").alias("species"))


def map_groups_weighted(scores: DataFrame, areas: DataFrame, mapping: DataFrame, unit_cols: Sequence[str]) -> DataFrame:
    """Habitat scores to those of animal groups: of one habitat its own (null stays), of several the area-weighted mean
    (null as 0). scores: units, grp, year, value; areas: units, grp, area; mapping: wb_group, grp (a small fixed table)."""
    keys = [*unit_cols, "grp"]
    per = areas.dropna(subset=keys).groupBy(*keys).agg(F.sum("area").alias("area"))
    several = mapping.groupBy("wb_group").agg((F.count("*") > 1).alias("several"))
    d = scores.join(per, keys, "left").join(F.broadcast(mapping), "grp").join(F.broadcast(several), "wb_group")
    g = d.groupBy(*unit_cols, "wb_group", "year").agg(F.max("several").alias("several"), F.max("value").alias("one"), F.try_divide(sum0(F.col("value") * F.col("area")), F.sum("area")).alias("mean"))
    return g.select(*unit_cols, "wb_group", "year", F.when(F.col("several"), F.col("mean")).otherwise(F.col("one")).alias("value"))


def keep_known(df: DataFrame, units: DataFrame, key: str = "uid") -> DataFrame:
    return df.join(units.select(key), key, "left_semi")


def wide_years(long: DataFrame, keys: Sequence[str], years: Sequence[int], prefix: str = "") -> DataFrame:
    """One column a year, for sinks. A key with a year twice is an error."""
    once = F.when(F.count("value") > 1, F.raise_error(F.lit("a key has a year twice"))).otherwise(F.first("value", ignorenulls=True))
    w = long.groupBy(*keys).pivot("year", [int(y) for y in years]).agg(once)
    names: list[Column] = [F.col(str(y)).alias(f"{prefix}{y}") for y in sorted(years)]
    return w.select(*keys, *names)
