"""The whole analysis, from polygons and tables to the files people read. Each input is read once, each metric goes through one
plan for all ways to sum up, and the final tables take their scores from those plans, not from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AGGREGATORS, HABITAT_DAYS, VEGETATION_DAYS, AggregatorSpec, EngineConfig, MetricRun
from ..functions.scalar import classify
from ..operators import series, spatial, units
from ..sources import readers, shapefile, sinks
from .pipelines import all_units, metric_pipeline

KEYS = ["agg", "unit", "grp", "year"]


def polygons(spark: SparkSession, path: str, type_column: str = "ANAE_TYPE", area_column: str = "Area_Ha", projected: bool = True) -> DataFrame:
    """uid, kind, grp, area, geometry (in metres) of the fine units."""
    raw = spark.read.format("shapefile").load(path).select(F.col("UID").alias("uid"), F.col(type_column).alias("kind"), F.col(area_column).cast("double").alias("area"), "geometry")
    out = raw if projected else spatial.reproject_polygons(raw)
    return out.withColumn("grp", classify(F.col("kind")))


def layer(spark: SparkSession, path: str, cols: Sequence[str], projected: bool = True) -> DataFrame:
    raw = spark.read.format("shapefile").load(path).select(*cols, "geometry")
    return raw if projected else spatial.reproject_polygons(raw)


def bridges(spark: SparkSession, cfg: EngineConfig, fine: DataFrame, specs: Sequence[AggregatorSpec] = AGGREGATORS, projected: bool = True) -> dict[str, tuple[DataFrame, Sequence[str]]]:
    """name -> (uid, keys, grp, area; keys) of all ways to sum up that have a layer, and of the whole basin."""
    out: dict[str, tuple[DataFrame, Sequence[str]]] = {}
    for spec in specs:
        if spec.identity:
            continue
        if not spec.unit_cols:
            out[spec.name] = (fine.select("uid", "grp", "area"), ())
        elif spec.name in cfg.files:
            there = layer(spark, f"{cfg.input_dir}/{cfg.files[spec.name]}", spec.unit_cols, projected)
            pairs = spatial.spatial_join(fine.select("uid", "grp", "area", "geometry"), there, cfg.cell)
            out[spec.name] = (pairs.select("uid", *spec.unit_cols, "grp", "area"), spec.unit_cols)
    return out


def inputs(spark: SparkSession, cfg: EngineConfig, fine: DataFrame) -> dict[str, DataFrame]:
    """The tables that have a file, without units that aren't among the polygons."""
    path = {k: f"{cfg.input_dir}/{v}" for k, v in cfg.files.items()}
    known = fine.select("uid").distinct()
    read = lambda name, kind: units.keep_known(readers.read_csv(spark, path[name], kind), known)
    out = {n: read(n, k) for n, k in (("yearly", "wit_yearly"), ("finals", "tsli_master"), ("events", "inundation_events"), ("soil", "soil_moisture")) if n in path}
    sensors = [readers.annual(read(n, "ndvi"), "NDVI") for n in ("ndvi_old", "ndvi_new") if n in path]
    if sensors:
        out["ndvi"] = series.harmonise_sensors(sensors, "minmax").withColumnRenamed("value", "NDVI")
        out["ndvi_z"] = series.harmonise_sensors(sensors, "zscore").withColumnRenamed("value", "NDVI")
    return out


def metric_table(table: DataFrame, run: MetricRun, cfg: EngineConfig, fine: DataFrame, every: DataFrame, own: str) -> DataFrame:
    """agg, unit, grp, year, measure, value, area, score (if scored) of a metric; the fine units themselves under the name own."""
    annual = readers.annual(table, run.metric)
    how = {"window": run.window, "trend": run.trend, "bins": run.bins, "reverse": run.reverse, "nobaseline": run.nobaseline, "drought": cfg.drought, "scored": run.scored, "years": (cfg.first_year, cfg.last_year)}
    many = metric_pipeline(annual, every, ("agg", "unit"), **how)
    one = metric_pipeline(annual, fine.select("uid", "grp", "area"), (), identity=True, **how)
    one = one.withColumns({"agg": F.lit(own), "unit": F.array("uid")}).drop("uid")
    return many.unionByName(one)


def elapsed_table(events: DataFrame, finals: DataFrame, cfg: EngineConfig, fine: DataFrame, every: DataFrame, days: dict, own: str) -> DataFrame:
    """agg, unit, grp, year, measure (tsli, sc_tsli), value, area."""
    years = range(cfg.first_year, cfg.last_year + 1)
    since = units.time_since_last(events, finals, years).join(fine.select("uid", "grp"), "uid")
    thresholds = fine.sparkSession.createDataFrame([(k, *v) for k, v in days.items()], "grp string, t0 int, t1 int, t2 int")
    scored = units.score_by_group(since, "tsli", thresholds).select("uid", "year", F.col("tsli").cast("double").alias("tsli"), "sc_tsli")
    many = units.area_weighted_measures(scored, every, ["agg", "unit", "grp"], ["tsli", "sc_tsli"], digits=1)
    one = units.area_weighted_measures(scored, fine.select("uid", "grp", "area"), ["grp"], ["tsli", "sc_tsli"], digits=1, identity=True)
    return many.unionByName(one.withColumns({"agg": F.lit(own), "unit": F.array("uid")}).drop("uid"))


def of_units(df: DataFrame, agg: str, cols: Sequence[str]) -> DataFrame:
    """The rows of one way to sum up, its keys as columns again."""
    return df.where(F.col("agg") == agg).withColumns({c: F.get("unit", F.lit(i)) for i, c in enumerate(cols)}).drop("agg", "unit")


def write_metric(long: DataFrame, run: MetricRun, cfg: EngineConfig, ways: dict[str, Sequence[str]]) -> dict[str, str]:
    """A wide file for each way to sum up; file names with their paths."""
    measures = ["ave", "trend", "sum"] if run.window > 1 else ["ave"]
    years = range(cfg.first_year + run.window - 1, cfg.last_year + 1)
    rows = long.select("agg", "unit", "grp", "year", "area", "measure", "value")
    if run.scored:
        rows = rows.unionByName(long.select("agg", "unit", "grp", "year", "area", F.concat(F.lit("sc_"), "measure").alias("measure"), F.col("score").alias("value")))
        measures += [f"sc_{m}" for m in measures]
    out = {}
    for agg, cols in ways.items():
        name = sinks.metric_file(run.metric, agg, run.window, run.tag)
        wide = sinks.wide_measures(of_units(rows, agg, cols), [*cols, "grp", "area"], run.metric, measures, years)
        sinks.write_csv(wide, f"{cfg.output_dir}/{name}")
        out[name] = f"{cfg.output_dir}/{name}"
    return out


def run(spark: SparkSession, cfg: EngineConfig, specs: Sequence[AggregatorSpec] = AGGREGATORS, projected: bool = True) -> dict[str, str]:
    """Writes all tables that the config's files allow; file names with their paths. What several files share is persisted."""
    spark.dataSource.register(shapefile.ShapefileSource)
    fine = polygons(spark, f"{cfg.input_dir}/{cfg.files['polygons']}", cfg.type_column, cfg.area_column, projected).persist()
    ways = bridges(spark, cfg, fine, specs, projected)
    own = next((s.name for s in specs if s.identity), "units")
    keys: dict[str, Sequence[str]] = {own: ("UID",), **{k: v[1] for k, v in ways.items()}}
    every = all_units(ways).persist()
    tables, out, parts, held = inputs(spark, cfg, fine), {}, [], [fine, every]
    for r in cfg.runs:
        table = tables.get(r.source)
        if table is None or r.metric not in table.columns:
            continue
        pivot = sinks.pivot_file(r.metric)
        if pivot not in out:
            dense = series.rounded(series.densify(readers.annual(table, r.metric), (cfg.first_year, cfg.last_year)))
            years = range(cfg.first_year, cfg.last_year + 1)
            stats = series.baseline_stats(dense, cfg.drought)
            sinks.write_csv(units.wide_years(dense, ["uid"], years, "y").join(stats, "uid"), f"{cfg.output_dir}/{pivot}")
            out[pivot] = f"{cfg.output_dir}/{pivot}"
        long = metric_table(table, r, cfg, fine, every, own).persist()
        held.append(long)
        out |= write_metric(long, r, cfg, keys)
        if r.part:
            parts.append(long.where("measure = 'sum'").select(*KEYS, F.lit(r.part).alias("kind"), "score"))
    if "events" in tables and "finals" in tables:
        for name, days in (("vegetation_stress", VEGETATION_DAYS), ("waterbird_habitat_stress", HABITAT_DAYS)):
            long = elapsed_table(tables["events"], tables["finals"], cfg, fine, every, days, own).persist()
            held.append(long)
            for agg, cols in keys.items():
                file = sinks.tsli_file(agg, name)
                wide = sinks.wide_measures(of_units(long, agg, cols), [*cols, "grp", "area"], "", ["tsli", "sc_tsli"], range(cfg.first_year, cfg.last_year + 1))
                sinks.write_csv(wide, f"{cfg.output_dir}/{file}")
                out[file] = f"{cfg.output_dir}/{file}"
            if days is VEGETATION_DAYS:
                parts.append(long.where("measure = 'sc_tsli'").select(*KEYS, F.lit("stress").alias("kind"), F.col("value").alias("score")))
    if parts:
        years = range(cfg.first_year + cfg.window - 1, cfg.last_year + 1)
        all_parts = parts[0]
        for p in parts[1:]:
            all_parts = all_parts.unionByName(p)
        final = units.vulnerability(all_parts.where(F.col("year").isin(list(years))), KEYS, within=("agg",)).persist()
        held.append(final)
        for agg, cols in keys.items():
            file = sinks.final_file(agg)
            sinks.write_csv(sinks.wide_columns(of_units(final, agg, cols), [*cols, "grp"], ["cond", "stress", "vul"], years), f"{cfg.output_dir}/{file}")
            out[file] = f"{cfg.output_dir}/{file}"
    for df in held:
        df.unpersist()
    return out
