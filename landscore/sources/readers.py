"""Readers with declared schemas; NaN becomes null here, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import clean_nan, duration_days

SCHEMAS = {
    "wit_yearly": "feature_id string, year int, `water+wet_median` double, `water+wet_max` double, pv_median double, npv_median double, `npv+pv+wet_median` double, bs_median double",
    "wit_monthly": "feature_id string, year int, month int",
    "tsli_master": "feature_id string, `final-date` timestamp_ntz",
    "inundation_events": "feature_id string, start_time timestamp_ntz, end_time timestamp_ntz, duration string, gap string",
    "ndvi": "UID string, year int, NDVI double",
    "ndvi_overlap": "UID string, year int, NDVI double",
    "soil_moisture": "UID string, StdTime timestamp_ntz, MEAN double",
}
KEYS = {"feature_id", "UID", "year", "final-date", "start_time", "end_time", "StdTime"}
RENAMES = {"feature_id": "uid", "UID": "uid", "final-date": "final_date", "MEAN": "soilmoist"}


def read_csv(spark: SparkSession, path: str, kind: str, columns: dict[str, str] | None = None) -> DataFrame:
    """A CSV file of one of the kinds, columns by header name (not by place), doubles without NaN, keys renamed. A file without
    the kind's key columns is refused; metrics that it doesn't have are left out; a value that isn't of its type is null."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMAS[kind])
    raw = spark.read.option("header", True).option("nullValue", "").csv(path)  # all strings: no inference pass
    have = {c: c for c in raw.columns}
    missing = [f.name for f in schema if f.name in KEYS and f.name not in have]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    want = [F.col(f"`{have[f.name]}`").try_cast(f.dataType).alias(f.name) for f in schema if f.name in have]
    df = raw.select(*want)
    doubles = [n for n, t in df.dtypes if t == "double"]
    df = df.withColumns({n: clean_nan(F.col(f"`{n}`")) for n in doubles})
    if kind == "inundation_events":
        df = df.withColumns({"duration_days": duration_days(F.col("duration")), "gap_days": duration_days(F.col("gap"))}).drop("duration", "gap")
    if kind == "soil_moisture":
        df = df.withColumn("year", F.year("StdTime")).drop("StdTime")
    if kind == "ndvi_overlap":
        df = df.withColumnRenamed("NDVI", "NDVI_AVHRR")
    return df.withColumnsRenamed({k: v for k, v in (RENAMES | (columns or {})).items()})


def annual(df: DataFrame, metric: str) -> DataFrame:
    return df.select("uid", "year", F.col(f"`{metric}`").cast("double").alias("value"))
