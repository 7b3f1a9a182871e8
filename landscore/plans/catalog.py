"""The registered queries over the test tables, each with the same in SQL.

Stand-ins: part is the polygons (p_size their area), lineitem the annual metrics and the overlapping units (nations of a
part's suppliers), orders the inundation events of customers, events the surveys, embeddings points and boxes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BIRD_HABITATS, HABITAT_DAYS, TYPE_RULES, VEGETATION_DAYS
from ..functions.scalar import classify, rint, score, water_year
from ..operators import series, spatial, units
from ..sources import sinks
from .pipelines import SOIL_BINS, all_units, metric_pipeline

DROUGHT, YEARS = (1998, 1999), tuple(range(1995, 2002))
TYPES = ("River red gum swamp", "Temporary forb marsh", "River Red Gum woodland clay pan", "Black box forest", "Freshwater meadow", "Lignum shrubland", "Open plain", "Permanent lake", "F2.4: Shrubland riparian zone or floodplain", "Coolibah woodland", "Tall emergent marsh", "Cooba stand", "river red gum woodland")
GROUPS = (*VEGETATION_DAYS, None)
BIG = ("click", "purchase")


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def metric(spark: SparkSession, d: str, column: str = "l_quantity", scale: float = 1.0) -> DataFrame:
    """Annual means of whole numbers, so sums are exact in any order."""
    whole = F.rint(F.col(column) * scale).cast("long")
    g = t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("uid"), F.year("l_shipdate").alias("year"))
    return g.agg((F.sum(whole).cast("double") / F.count(whole)).alias("value"))


def polygons(spark: SparkSession, d: str) -> DataFrame:
    kind = F.element_at(F.array(*[F.lit(x) for x in TYPES]), (F.col("p_partkey") % len(TYPES) + 1).cast("int"))
    return t(spark, d, "part").select(F.col("p_partkey").alias("uid"), kind.alias("kind"), F.col("p_size").cast("double").alias("area"), "p_type", "p_brand").withColumn("grp", classify(F.col("kind")))


def overlapping(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    pairs = t(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_partkey").alias("uid"), F.col("n_name").alias("unit")).distinct()
    return pairs.join(polygons(spark, d), "uid")


def customers(spark: SparkSession, d: str) -> DataFrame:
    grp = F.element_at(F.array(*[F.lit(g).cast("string") for g in GROUPS]), (F.col("c_custkey") % len(GROUPS) + 1).cast("int"))
    return t(spark, d, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_mktsegment").alias("unit"), grp.alias("grp"), (F.col("c_nationkey") + 1).cast("double").alias("area"))


def events(spark: SparkSession, d: str) -> DataFrame:
    end = F.timestamp_add("DAY", (F.col("o_orderkey") % 60).cast("int"), F.col("o_orderdate"))
    return t(spark, d, "orders").select(F.col("o_custkey").alias("uid"), F.col("o_orderdate").alias("start_time"), end.alias("end_time"))


def tsli(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    last = F.timestamp_add("DAY", (F.col("uid") % 100).cast("int"), F.max("end_time"))
    finals = e.groupBy("uid").agg(last.alias("final_date"))
    return units.time_since_last(e, finals, YEARS)


def thresholds(spark: SparkSession, days: dict) -> DataFrame:
    return spark.createDataFrame([(k, *v) for k, v in days.items()], "grp string, t0 int, t1 int, t2 int")


def surveys(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    u = F.col("user_id")
    return e.select(F.hour("ts").alias("year"), F.col("event_type").alias("survey"), (u % 7).alias("site"), (u % 3).alias("unit"), F.concat(F.lit("g"), (u % 5).cast("string")).alias("grp"), F.concat(F.lit("n"), (u % 11).cast("string")).alias("name"), F.floor("value").cast("long").alias("n"))


def points(spark: SparkSession, d: str, x: int = 1, y: int = 2) -> DataFrame:
    """Points of two components of each vector."""
    at = lambda i: F.element_at("embedding", i).cast("double") * 100
    return t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "label", at(x).alias("x"), at(y).alias("y"))


def boxes(spark: SparkSession, d: str) -> DataFrame:
    return points(spark, d).groupBy("label").agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# --- SQL in parts -----------------------------------------------------------------------------------------------------

_D = ", ".join(map(str, DROUGHT))
R4 = lambda x: f"(round_even(({x}) * 10000, 0) / 10000 + 0.0)"
S4 = lambda x: f"(round_even(round_even(({x}) * 1e10, 0) / 1e6, 0) / 10000 + 0.0)"
S1 = lambda x: f"(round_even(round_even(({x}) * 1e10, 0) / 1e9, 0) / 10 + 0.0)"
R1 = lambda x: f"(round_even(({x}) * 10, 0) / 10 + 0.0)"


def a_annual(column: str = "l_quantity", scale: float = 1.0, n: str = "annual") -> str:
    whole = f"CAST(round_even({column} * {scale}, 0) AS BIGINT)"
    return f"{n} AS (SELECT l_partkey AS uid, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(sum({whole}) AS DOUBLE) / count({whole}) AS value FROM lineitem GROUP BY 1, 2)"


def a_dense(n: str = "") -> str:
    return f"""dense{n} AS (SELECT u.uid, y.year, {R4('a.value')} AS value FROM (SELECT DISTINCT uid FROM annual{n}) u
    CROSS JOIN (SELECT CAST(unnest(range(min(year), max(year) + 1)) AS INTEGER) AS year FROM annual{n}) y LEFT JOIN annual{n} a ON a.uid = u.uid AND a.year = y.year)"""


MEAN4 = "round_even(CAST(sum(CAST(round_even(value * 10000, 0) AS BIGINT)) FILTER (year NOT IN ({d})) AS DOUBLE) / nullif(count(value) FILTER (year NOT IN ({d})), 0), 0) / 10000 + 0.0".format(d=_D)


def a_z(n: str = "", raw: bool = False) -> str:
    if raw:
        return f"z{n} AS (SELECT uid, year, coalesce(value, 0) AS value FROM dense{n})"
    return f"""b{n} AS (SELECT uid, {MEAN4} AS b, {R4(f'stddev_samp(value) FILTER (year NOT IN ({_D}))')} AS sd FROM dense{n} GROUP BY uid),
z{n} AS (SELECT uid, year, CASE WHEN sd = 0 AND value <> b THEN CASE WHEN value > b THEN CAST('inf' AS DOUBLE) ELSE CAST('-inf' AS DOUBLE) END
  ELSE coalesce((value - b) / nullif(sd, 0), 0) END + 0.0 AS value FROM dense{n} JOIN b{n} USING (uid))"""


def _slope(k: int) -> str:
    """The sum of (place - mean place) times value over the last k values, over k deviations of the places."""
    if k == 2:
        return "(value - lag(value) OVER o) / 2"
    terms = " + ".join(f"({i - (k - 1) / 2}) * lag(value, {k - 1 - i}) OVER o" for i in range(k))
    return f"({terms}) / {k * ((k * k - 1) / 12) ** 0.5!r}"


def a_dev(n: str = "", window: int = 5, trend: int = 2) -> str:
    if window == 1:
        return f"dev{n} AS (SELECT uid, year, value AS ave, CAST(NULL AS DOUBLE) AS trend, CAST(NULL AS DOUBLE) AS sum FROM z{n})"
    return f"""w{n} AS (SELECT uid, year, avg(value) OVER (PARTITION BY uid ORDER BY year ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS ave,
  {R4(_slope(trend))} AS tr, row_number() OVER o AS k FROM z{n} WINDOW o AS (PARTITION BY uid ORDER BY year)),
dev{n} AS (SELECT uid, year, ave, t AS trend, coalesce(ave, 0) + coalesce(t, 0) AS sum
  FROM (SELECT *, CASE WHEN isfinite(tr) THEN tr END AS t FROM w{n} WHERE k >= {window}))"""


def a_long(n: str = "", measures: tuple[str, ...] = ("ave", "trend", "sum")) -> str:
    return f"long{n} AS (" + " UNION ALL ".join(f"SELECT uid, year, '{m}' AS measure, CASE WHEN isfinite({m}) THEN {m} END AS value FROM dev{n}" for m in measures) + ")"


_KIND = "[" + ", ".join(f"'{x}'" for x in TYPES) + f"][p_partkey % {len(TYPES)} + 1]"
_CASE = "CASE " + " ".join(f"WHEN regexp_matches(kind, '(?i){p}') THEN '{g}'" for p, g in reversed(TYPE_RULES)) + " END"
POLY = f"poly AS (SELECT *, {_CASE} AS grp FROM (SELECT p_partkey AS uid, {_KIND} AS kind, CAST(p_size AS DOUBLE) AS area, p_type, p_brand FROM part))"
OVER = """pairs AS (SELECT DISTINCT l_partkey AS uid, n_name AS unit FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
over_ AS (SELECT pairs.unit, poly.* FROM pairs JOIN poly USING (uid))"""


def weighted(keys: tuple[str, ...], bridge: str = "poly", n: str = "", digits=S4) -> str:
    k = ", ".join(keys)
    not_null = " AND ".join(f"{x} IS NOT NULL" for x in keys) or "true"
    return f"""SELECT {k}{', ' if k else ''}year, measure, {digits('coalesce(sum(value * area), 0) / nullif(sum(area), 0)')} AS value, sum(area) AS area
FROM long{n} JOIN {bridge} USING (uid) WHERE {not_null} GROUP BY {k}{', ' if k else ''}year, measure"""


def scored(bins: tuple[float, float] = (-1, 0), reverse: bool = False) -> str:
    a, b, c = (3, 2, 1) if reverse else (1, 2, 3)
    return f"CAST(CASE WHEN value <= {bins[0]} THEN {a} WHEN value <= {bins[1]} THEN {b} WHEN value > {bins[1]} THEN {c} END AS DOUBLE)"


FRONT = f"WITH {a_annual()}, {a_dense()}, {a_z()}, {a_dev()}, {a_long()}, {POLY}"
BRAND = ("p_brand", "grp")


# --- Queries ------------------------------------------------------------------------------------------------------------


@query(f"WITH {a_annual()}, {a_dense()} SELECT uid, year, value FROM dense")
def densify(spark: SparkSession, d: str) -> DataFrame:
    return series.rounded(series.densify(metric(spark, d)))


@query(f"""WITH {a_annual()}, {a_dense()}, v AS (SELECT uid, year, value, median(value) FILTER (year NOT IN ({_D})) OVER (PARTITION BY uid) AS med FROM dense)
SELECT uid, count(value) AS n, {MEAN4} AS baseline, {R4(f'stddev_samp(value) FILTER (year NOT IN ({_D}))')} AS stddev, max(value) FILTER (year NOT IN ({_D})) AS max,
  {R4('any_value(med)')} AS median, {R4(f'median(abs(value - med)) FILTER (year NOT IN ({_D}))')} AS mad FROM v GROUP BY uid""")
def baseline_stats(spark: SparkSession, d: str) -> DataFrame:
    return series.baseline_stats(series.rounded(series.densify(metric(spark, d))), DROUGHT)


@query(f"WITH {a_annual()}, {a_dense()}, {a_z(raw=True)}, {a_dev()} SELECT uid, year, {R4('ave')} AS ave, trend, {R4('sum')} AS sum FROM dev")
def moving_ave_trend(spark: SparkSession, d: str) -> DataFrame:
    out = series.deviation_from_baseline(metric(spark, d), nobaseline=True)
    return out.withColumns({"ave": rint(F.col("ave"), 4), "sum": rint(F.col("sum"), 4)})


FIN4 = lambda c: R4(f"CASE WHEN isfinite({c}) THEN {c} END")


@query(f"WITH {a_annual()}, {a_dense()}, {a_z()}, {a_dev()} SELECT uid, year, {FIN4('ave')} AS ave, trend, {FIN4('sum')} AS sum FROM dev")
def deviation_5y(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.scalar import finite

    out = series.deviation_from_baseline(metric(spark, d), drought=DROUGHT)
    return out.withColumns({"ave": rint(finite(F.col("ave")), 4), "sum": rint(finite(F.col("sum")), 4)})


@query(f"WITH {a_annual()}, {a_dense()}, {a_z(raw=True)} SELECT uid, year, value AS ave FROM z")
def deviation_1y_raw(spark: SparkSession, d: str) -> DataFrame:
    return series.deviation_from_baseline(metric(spark, d), 1, None, nobaseline=True).select("uid", "year", "ave")


def _weighted(spark: SparkSession, d: str, bridge: DataFrame, cols: tuple[str, ...], **more) -> DataFrame:
    return metric_pipeline(metric(spark, d), bridge, cols, drought=DROUGHT, scored=False, **more)


@query(f"{FRONT} {weighted(BRAND)}")
def area_weighted_unit(spark: SparkSession, d: str) -> DataFrame:
    return _weighted(spark, d, polygons(spark, d), ("p_brand",))


@query(f"{FRONT} {weighted(('p_type', 'p_brand'))}")
def area_weighted_two_level(spark: SparkSession, d: str) -> DataFrame:
    return _weighted(spark, d, polygons(spark, d), ("p_type", "p_brand"), by_grp=False)


@query(f"{FRONT} {weighted(('grp',))}")
def area_weighted_basin(spark: SparkSession, d: str) -> DataFrame:
    return _weighted(spark, d, polygons(spark, d), ())


@query(f"{FRONT} SELECT uid, grp, year, measure, {R4('value')} AS value, area FROM long JOIN poly USING (uid)")
def area_weighted_identity(spark: SparkSession, d: str) -> DataFrame:
    out = _weighted(spark, d, polygons(spark, d), ("uid",), identity=True)
    return out.withColumn("value", rint(F.col("value"), 4))


@query(f"{FRONT}, {OVER} {weighted(('unit', 'grp'), 'over_')}")
def area_weighted_overlap(spark: SparkSession, d: str) -> DataFrame:
    return _weighted(spark, d, overlapping(spark, d), ("unit",))


@query(f"{FRONT}, u AS ({weighted(BRAND)}) SELECT p_brand, grp, year, measure, value, {scored()} AS score FROM u")
def score_default(spark: SparkSession, d: str) -> DataFrame:
    return metric_pipeline(metric(spark, d), polygons(spark, d), ("p_brand",), drought=DROUGHT).drop("area")


@query(f"{FRONT}, u AS ({weighted(BRAND)}) SELECT p_brand, grp, year, measure, value, {scored(reverse=True)} AS score FROM u")
def score_reversed(spark: SparkSession, d: str) -> DataFrame:
    return metric_pipeline(metric(spark, d), polygons(spark, d), ("p_brand",), drought=DROUGHT, reverse=True).drop("area")


@query("SELECT l_orderkey, l_linenumber, v, CAST(CASE WHEN v < -1 OR v > 1 THEN NULL WHEN v <= 0.25 THEN 1 WHEN v <= 0.5 THEN 2 ELSE 3 END AS DOUBLE) AS score FROM (SELECT l_orderkey, l_linenumber, (l_quantity - 25) / 20 AS v FROM lineitem)")
def score_soil(spark: SparkSession, d: str) -> DataFrame:
    v = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", ((F.col("l_quantity") - 25) / 20).alias("v"))
    return v.withColumn("score", score(F.col("v"), SOIL_BINS))


@query(f"WITH {a_annual()}, {a_dense()}, {a_z(raw=True)}, dev AS (SELECT uid, year, value AS ave FROM z), {a_long(measures=('ave',))}, {POLY} {weighted(BRAND)}")
def raw_export(spark: SparkSession, d: str) -> DataFrame:
    """A window of one year, no baseline, no scores."""
    return metric_pipeline(metric(spark, d), polygons(spark, d), ("p_brand",), 1, None, nobaseline=True, scored=False)


@query(f"WITH {POLY} SELECT uid, kind, grp FROM poly")
def classify_types(spark: SparkSession, d: str) -> DataFrame:
    return polygons(spark, d).select("uid", "kind", "grp")


@query(f"WITH {POLY} SELECT DISTINCT kind FROM poly WHERE grp IS NULL")
def unclassified(spark: SparkSession, d: str) -> DataFrame:
    return polygons(spark, d).where("grp is null").select("kind").distinct()


@query(f"WITH {a_annual()} SELECT uid, year, {R4('(value - lo) / nullif(hi - lo, 0)')} AS value FROM annual, (SELECT min(value) AS lo, max(value) AS hi FROM annual)")
def minmax(spark: SparkSession, d: str) -> DataFrame:
    return series.rounded(series.minmax(metric(spark, d), "value"))


@query(f"WITH {a_annual()} SELECT uid, year, {R4('(value - m) / nullif(s, 0)')} AS value FROM annual, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM annual)")
def zscore(spark: SparkSession, d: str) -> DataFrame:
    return series.rounded(series.zscore(metric(spark, d), "value"))


_TWO = f"WITH {a_annual()}, s AS (SELECT *, year <= 1997 AS old FROM annual)"


@query(f"{_TWO} SELECT uid, year, {R4('(value - min(value) OVER p) / nullif(max(value) OVER p - min(value) OVER p, 0)')} AS value FROM s WINDOW p AS (PARTITION BY old)")
def sensor_union(spark: SparkSession, d: str) -> DataFrame:
    a = metric(spark, d)
    return series.rounded(series.harmonise_sensors([a.where("year <= 1997"), a.where("year > 1997")]))


@query(f"{_TWO} SELECT uid, year, {R4('(value - avg(value) OVER p) / nullif(stddev_samp(value) OVER p, 0)')} AS value FROM s WINDOW p AS (PARTITION BY old)")
def sensor_union_z(spark: SparkSession, d: str) -> DataFrame:
    a = metric(spark, d)
    return series.rounded(series.harmonise_sensors([a.where("year <= 1997"), a.where("year > 1997")], "zscore"))


_BOTH = f"WITH {a_annual(n='a')}, {a_annual('l_discount', 100, 'b')}, m AS (SELECT a.uid, a.year, a.value AS x, b.value AS y FROM a JOIN b ON a.uid = b.uid AND a.year = b.year)"


def _both(spark: SparkSession, d: str) -> DataFrame:
    a, b = metric(spark, d), metric(spark, d, "l_discount", 100)
    return a.withColumnRenamed("value", "x").join(b.withColumnRenamed("value", "y"), ["year", "uid"])


@query(f"{_BOTH} SELECT uid, year, x, y FROM m")
def two_key_merge(spark: SparkSession, d: str) -> DataFrame:
    return _both(spark, d).select("uid", "year", "x", "y")


@query(f"{_BOTH} SELECT uid, {R4('CASE WHEN var_pop(x) > 0 THEN regr_slope(y, x) END')} AS slope, {R4('CASE WHEN var_pop(x) > 0 THEN regr_intercept(y, x) END')} AS intercept FROM m GROUP BY uid")
def sensor_regression(spark: SparkSession, d: str) -> DataFrame:
    out = series.regression(_both(spark, d), ["uid"], "x", "y")
    return out.select("uid", rint(F.col("slope"), 4).alias("slope"), rint(F.col("intercept"), 4).alias("intercept"))


@query(f"{_BOTH}, f AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM m) SELECT {R4('1 - sum(power(y - (s * x + i), 2)) / nullif(count(*) * var_pop(y), 0)')} AS r2 FROM m, f")
def r2(spark: SparkSession, d: str) -> DataFrame:
    m = _both(spark, d)
    f = series.regression(m, [], "x", "y")
    fitted = m.crossJoin(F.broadcast(f)).withColumn("fit", F.col("slope") * F.col("x") + F.col("intercept"))  # f is one row
    return series.r_squared(fitted, "y", "fit").select(rint(F.col("r2"), 4).alias("r2"))


_TSLI = f"""ev AS (SELECT o_custkey AS uid, o_orderdate AS s, o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) AS e FROM orders),
fin AS (SELECT uid, max(e) + to_days(CAST(uid % 100 AS INTEGER)) AS f FROM ev GROUP BY uid),
ys AS (SELECT CAST(unnest(range({YEARS[0]}, {YEARS[-1] + 1})) AS INTEGER) AS year),
le AS (SELECT uid, year, max(least(e, make_timestamp(year, 12, 31, 0, 0, 0))) AS e FROM ev, ys WHERE s < make_timestamp(year, 12, 31, 0, 0, 0) AND e IS NOT NULL GROUP BY uid, year),
tsli AS (SELECT fin.uid, ys.year, CAST(floor((epoch_us(least(f, make_timestamp(ys.year, 12, 31, 0, 0, 0))) - epoch_us(le.e)) / 86400000000.0) AS INTEGER) AS tsli
  FROM fin CROSS JOIN ys LEFT JOIN le ON le.uid = fin.uid AND le.year = ys.year)"""


@query(f"WITH {_TSLI} SELECT uid, year, tsli FROM tsli")
def tsli_days(spark: SparkSession, d: str) -> DataFrame:
    return tsli(spark, d)


def _cust() -> str:
    g = "[" + ", ".join("NULL" if x is None else f"'{x}'" for x in GROUPS) + f"][c_custkey % {len(GROUPS)} + 1]"
    return f"cust AS (SELECT c_custkey AS uid, c_mktsegment AS unit, {g} AS grp, CAST(c_nationkey + 1 AS DOUBLE) AS area FROM customer)"


def _days(days: dict) -> str:
    return "days(grp, t0, t1, t2) AS (VALUES " + ", ".join(f"('{k}', {v[0]}, {v[1]}, {v[2]})" for k, v in days.items()) + ")"


def _scored(days: dict) -> str:
    return f"""{_TSLI}, {_cust()}, {_days(days)}, sc AS (SELECT tsli.uid, year, tsli, unit, cust.grp, area,
  CAST(CASE WHEN tsli >= t2 THEN 1 WHEN tsli >= t1 THEN 2 WHEN tsli >= t0 THEN 3 END AS DOUBLE) AS sc_tsli FROM tsli JOIN cust USING (uid) LEFT JOIN days ON days.grp = cust.grp)"""


@query(f"WITH {_scored(VEGETATION_DAYS)} SELECT uid, grp, year, tsli, sc_tsli FROM sc")
def score_by_group(spark: SparkSession, d: str) -> DataFrame:
    rows = tsli(spark, d).join(customers(spark, d), "uid")
    return units.score_by_group(rows, "tsli", thresholds(spark, VEGETATION_DAYS)).select("uid", "grp", "year", "tsli", "sc_tsli")


def _tsli_scored(days: dict) -> str:
    return f"""WITH {_scored(days)}, long AS (SELECT uid, year, 'tsli' AS measure, CAST(tsli AS DOUBLE) AS value FROM sc
UNION ALL SELECT uid, year, 'sc_tsli', sc_tsli FROM sc) {weighted(('unit', 'grp'), 'cust', digits=S1)}"""


@query(_tsli_scored(VEGETATION_DAYS))
def tsli_scored(spark: SparkSession, d: str) -> DataFrame:
    return units.score_then_aggregate(tsli(spark, d), customers(spark, d), ("unit",), thresholds(spark, VEGETATION_DAYS))


@query(_tsli_scored(HABITAT_DAYS))
def tsli_scored_habitat(spark: SparkSession, d: str) -> DataFrame:
    return units.score_then_aggregate(tsli(spark, d), customers(spark, d), ("unit",), thresholds(spark, HABITAT_DAYS))


METRICS = (("q", "l_quantity", 1), ("p", "l_extendedprice", 1), ("d", "l_discount", 100), ("x", "l_tax", 100))


def _parts_sql() -> str:
    front = ", ".join(f"{a_annual(c, s, f'annual{n}')}, {a_dense(n)}, {a_z(n)}, {a_dev(n)}, {a_long(n, ('sum',))}" for n, c, s in METRICS)
    each = lambda n: f"SELECT p_brand, grp, year, {scored()} AS score FROM ({weighted(BRAND, n=n)})"
    return f"WITH {POLY}, {front}, cond AS ({each('q')} UNION ALL {each('p')}), stress AS ({each('d')} UNION ALL {each('x')})"


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    """uid, metric, year, value of all metrics, from one scan and one aggregate."""
    whole = {n: F.rint(F.col(c) * s).cast("long") for n, c, s in METRICS}
    g = t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("uid"), F.year("l_shipdate").alias("year"))
    wide = g.agg(*[(F.sum(v).cast("double") / F.count(v)).alias(n) for n, v in whole.items()])
    return wide.unpivot(["uid", "year"], list(whole), "metric", "value")


def _parts(spark: SparkSession, d: str) -> DataFrame:
    """p_brand, grp, year, kind, score: two metrics are parts of the condition, two of the stress."""
    out = metric_pipeline(_metrics(spark, d), polygons(spark, d), ("p_brand",), drought=DROUGHT, metric="metric").where("measure = 'sum'")
    return out.select("p_brand", "grp", "year", F.when(F.col("metric").isin("q", "p"), "cond").otherwise("stress").alias("kind"), "score")


KEYS = ["p_brand", "grp", "year"]
_RESCALE = "SELECT p_brand, grp, year, " + R1("(coalesce(sum(score), 0) - count(score)) / nullif(count(score) * 3 - count(score), 0)") + " AS value FROM {} GROUP BY ALL"


@query(f"{_parts_sql()} {_RESCALE.format('cond')}")
def sum_rescale(spark: SparkSession, d: str) -> DataFrame:
    return units.sum_rescale(_parts(spark, d).where("kind = 'cond'"), KEYS)


@query(f"""{_parts_sql()}, c AS ({_RESCALE.format('cond')}), s AS ({_RESCALE.format('stress')}),
v AS (SELECT p_brand, grp, year, c.value AS cond, s.value AS stress, coalesce(c.value, 0) + coalesce(s.value, 0) AS v FROM c FULL JOIN s USING (p_brand, grp, year))
SELECT p_brand, grp, year, cond, stress, {R1('(v - min(v) OVER ()) / nullif(max(v) OVER () - min(v) OVER (), 0)')} AS vul FROM v""")
def vulnerability(spark: SparkSession, d: str) -> DataFrame:
    return units.vulnerability(_parts(spark, d), KEYS)


@query(f"{FRONT}, u AS ({weighted(BRAND)}) SELECT p_brand, grp, year, measure, {R4('(value - min(value) OVER ()) / nullif(max(value) OVER () - min(value) OVER (), 0)')} AS value FROM u")
def normalise_global(spark: SparkSession, d: str) -> DataFrame:
    return units.normalise_global(_weighted(spark, d, polygons(spark, d), ("p_brand",)).drop("area"), "value", 4)


@query(f"{FRONT}, u AS ({weighted(BRAND)}) SELECT p_brand, grp, year, measure, value, {scored()} AS score FROM u WHERE measure = 'sum' AND year IN (2000, 2001)")
def select_scores(spark: SparkSession, d: str) -> DataFrame:
    return units.select_scores(score_default(spark, d), "sum", (2000, 2001))


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS INTEGER) AS wy FROM orders")
def water_years(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return o.withColumn("wy", water_year(F.col("y"), F.col("m"))).distinct()


_SURVEY = f"""WITH s AS (SELECT CAST(hour(ts) AS INTEGER) AS year, event_type AS survey, user_id % 7 AS site, user_id % 3 AS unit, 'g' || (user_id % 5) AS grp, 'n' || (user_id % 11) AS name, CAST(floor(value) AS BIGINT) AS n FROM events),
a AS (SELECT year, unit, grp, name, sum(n) AS n FROM (SELECT year, unit, grp, name, site, max(n) AS n FROM s WHERE survey IS NULL OR survey NOT IN {BIG} GROUP BY ALL) GROUP BY ALL),
b AS (SELECT year, unit, grp, name, max(n) AS n FROM (SELECT year, unit, grp, name, survey, sum(n) AS n FROM s WHERE survey IN {BIG} GROUP BY ALL) GROUP BY ALL),
indiv AS (SELECT year, unit, grp, name, CAST(max(n) AS BIGINT) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL)"""


@query(f"{_SURVEY} SELECT * FROM indiv")
def survey_counts(spark: SparkSession, d: str) -> DataFrame:
    return units.survey_counts(surveys(spark, d), "unit", BIG)


@query(f"{_SURVEY} SELECT year, unit, grp, CAST(sum(n) AS BIGINT) AS n FROM indiv GROUP BY ALL")
def survey_group(spark: SparkSession, d: str) -> DataFrame:
    return units.survey_group_counts(units.survey_counts(surveys(spark, d), "unit", BIG), "unit")


@query(f"{_SURVEY} SELECT year, unit, count(DISTINCT name) AS species FROM s GROUP BY ALL")
def richness(spark: SparkSession, d: str) -> DataFrame:
    return units.richness(surveys(spark, d), ["year", "unit"])


@query(f"{_SURVEY} SELECT year, unit, grp, count(DISTINCT name) AS species FROM s GROUP BY ALL")
def richness_group(spark: SparkSession, d: str) -> DataFrame:
    return units.richness(surveys(spark, d), ["year", "unit", "grp"])


_MAP = "map(wb_group, grp) AS (VALUES " + ", ".join(f"('{g}', '{h}')" for g, hs in BIRD_HABITATS.items() for h in hs) + ")"


@query(f"""{FRONT}, u AS ({weighted(BRAND)}), sc AS (SELECT p_brand, grp, year, {scored()} AS value FROM u WHERE measure = 'sum'), {_MAP},
ar AS (SELECT p_brand, grp, sum(area) AS area FROM poly WHERE grp IS NOT NULL GROUP BY ALL), m AS (SELECT *, count(*) OVER (PARTITION BY wb_group) > 1 AS several FROM map)
SELECT p_brand, wb_group, year, {R4('CASE WHEN bool_or(several) THEN coalesce(sum(value * area), 0) / nullif(sum(area), 0) ELSE max(value) END')} AS value
FROM sc JOIN m USING (grp) LEFT JOIN ar USING (p_brand, grp) GROUP BY ALL""")
def habitat_groups(spark: SparkSession, d: str) -> DataFrame:
    scores = score_default(spark, d).where("measure = 'sum'").select("p_brand", "grp", "year", F.col("score").alias("value"))
    mapping = spark.createDataFrame([(g, h) for g, hs in BIRD_HABITATS.items() for h in hs], "wb_group string, grp string")
    out = units.map_groups_weighted(scores, polygons(spark, d).select("p_brand", "grp", "area"), mapping, ("p_brand",))
    return out.withColumn("value", rint(F.col("value"), 4))


_PT = "pt AS (SELECT vec_id AS id, label, CAST(embedding[1] AS DOUBLE) * 100 AS x, CAST(embedding[2] AS DOUBLE) * 100 AS y FROM embeddings)"


@query(f"""WITH {_PT}, l AS (SELECT id, x, y FROM pt), r AS (SELECT vec_id AS id, label, CAST(embedding[3] AS DOUBLE) * 100 AS x, CAST(embedding[4] AS DOUBLE) * 100 AS y FROM embeddings),
c AS (SELECT l.id AS lid, r.id AS rid, 'p' || r.label AS name, sqrt((l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y)) AS dist FROM l JOIN r ON abs(l.x - r.x) <= 1.5 AND abs(l.y - r.y) <= 1.5),
b AS (SELECT * FROM c WHERE dist <= 1.5 QUALIFY row_number() OVER (PARTITION BY lid ORDER BY dist, rid) = 1)
SELECT l.id AS lid, coalesce(rid, -1) AS rid, name, {R4('coalesce(dist, -1)')} AS dist FROM l LEFT JOIN b ON b.lid = l.id""")
def nearest_within(spark: SparkSession, d: str) -> DataFrame:
    left = points(spark, d).select(F.col("id").alias("lid"), "x", "y")
    right = points(spark, d, 3, 4).select(F.col("id").alias("rid"), F.concat(F.lit("p"), F.col("label").cast("string")).alias("name"), "x", "y")
    return spatial.nearest_within(left, right, 1.5).withColumn("dist", rint(F.col("dist"), 4))


@query(f"""WITH {_PT}, bx AS (SELECT label, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM pt GROUP BY label)
SELECT pt.id, bx.label AS box FROM pt JOIN bx ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""")
def box_intersects(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d).select("id", F.col("x").alias("xmin"), F.col("y").alias("ymin"), F.col("x").alias("xmax"), F.col("y").alias("ymax"))
    return spatial.box_join(p, boxes(spark, d).withColumnRenamed("label", "box"), 5.0)


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_filter(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return units.keep_known(t(spark, d, "orders"), c, "o_custkey").select("o_orderkey")


@query(f"SELECT event_id FROM events WHERE event_type IS NULL OR event_type NOT IN {BIG}")
def anti_literal(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").where(F.coalesce(~F.col("event_type").isin(*BIG), F.lit(True))).select("event_id")


@query("SELECT p_partkey FROM part WHERE starts_with(p_name, 'r')")
def prefix_filter(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").where(F.col("p_name").startswith("r")).select("p_partkey")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey)")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    return units.latest_per_key(t(spark, d, "orders"), ["o_custkey"], "o_orderdate").select("o_custkey", "o_orderkey")


@query("SELECT 'part' AS kind, p_partkey AS id FROM part UNION ALL SELECT 'supplier', s_suppkey FROM supplier")
def union_all(spark: SparkSession, d: str) -> DataFrame:
    p = t(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"))
    return p.unionByName(t(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")))


@query(f"WITH {a_annual()} SELECT uid, " + ", ".join(f"max(value) FILTER (year = {y}) AS q{y}" for y in YEARS) + " FROM annual GROUP BY uid")
def wide_pivot(spark: SparkSession, d: str) -> DataFrame:
    return units.wide_years(metric(spark, d), ["uid"], YEARS, "q")


@query(f"WITH {a_annual()}, {a_dense()} SELECT uid, year, coalesce(value, 0) AS value FROM dense")
def infill_years(spark: SparkSession, d: str) -> DataFrame:
    return series.rounded(series.densify(metric(spark, d), fill=0.0))


@query(f"WITH {a_annual()}, {a_dense()}, {a_z()}, {a_dev(trend=3)} SELECT uid, year, {FIN4('ave')} AS ave, trend, {FIN4('sum')} AS sum FROM dev")
def deviation_trend_3(spark: SparkSession, d: str) -> DataFrame:
    """A slope through three years."""
    from ..functions.scalar import finite

    out = series.deviation_from_baseline(metric(spark, d), 5, 3, drought=DROUGHT)
    return out.withColumns({"ave": rint(finite(F.col("ave")), 4), "sum": rint(finite(F.col("sum")), 4)})


_AGG = f"""{POLY}, {OVER}, bridge AS (SELECT uid, 'brand' AS agg, p_brand AS unit, grp, area FROM poly WHERE grp IS NOT NULL
UNION ALL SELECT uid, 'brand and type', p_type || '/' || p_brand, grp, area FROM poly WHERE grp IS NOT NULL
UNION ALL SELECT uid, 'nation', unit, grp, area FROM over_ WHERE grp IS NOT NULL UNION ALL SELECT uid, 'basin', '', grp, area FROM poly WHERE grp IS NOT NULL)"""


def _every_unit(spark: SparkSession, d: str) -> DataFrame:
    p = polygons(spark, d)
    return all_units({"brand": (p, ("p_brand",)), "brand and type": (p, ("p_type", "p_brand")), "nation": (overlapping(spark, d), ("unit",)), "basin": (p, ())})


@query(f"WITH {a_annual()}, {a_dense()}, {a_z()}, {a_dev()}, {a_long()}, {_AGG}, u AS ({weighted(('agg', 'unit', 'grp'), 'bridge')}) SELECT agg, unit, grp, year, measure, value, area, {scored()} AS score FROM u")
def multi_aggregator(spark: SparkSession, d: str) -> DataFrame:
    """All ways to sum up in one pass."""
    out = metric_pipeline(metric(spark, d), _every_unit(spark, d), ("agg", "unit"), drought=DROUGHT)
    return out.withColumn("unit", F.array_join("unit", "/"))


def _every_part(spark: SparkSession, d: str) -> DataFrame:
    """agg, unit, grp, year, kind, score, with the weighted score of the time since the last event as a part of the stress."""
    bridge = _every_unit(spark, d)
    out = metric_pipeline(_metrics(spark, d), bridge, ("agg", "unit"), drought=DROUGHT, metric="metric").where("measure = 'sum'")
    parts = out.select("agg", "unit", "grp", "year", F.when(F.col("metric").isin("q", "p"), "cond").otherwise("stress").alias("kind"), "score")
    e = t(spark, d, "lineitem").select(F.col("l_partkey").alias("uid"), F.col("l_shipdate").cast("timestamp_ntz").alias("start_time"), F.col("l_shipdate").cast("timestamp_ntz").alias("end_time"))
    since = units.time_since_last(e, e.groupBy("uid").agg(F.max("end_time").alias("final_date")), YEARS)
    tsli_score = units.score_by_group(since.join(bridge.select("uid", "grp").distinct(), "uid"), "tsli", thresholds(spark, VEGETATION_DAYS))
    dry = units.area_weighted_measures(tsli_score.select("uid", "year", "sc_tsli"), bridge, ("agg", "unit", "grp"), ["sc_tsli"], digits=1)
    return parts.unionByName(dry.select("agg", "unit", "grp", "year", F.lit("stress").alias("kind"), F.col("value").alias("score")))


def _final_sql() -> str:
    front = ", ".join(f"{a_annual(c, s, f'annual{n}')}, {a_dense(n)}, {a_z(n)}, {a_dev(n)}, {a_long(n, ('sum',))}" for n, c, s in METRICS)
    each = lambda n, kind: f"SELECT agg, unit, grp, year, '{kind}' AS kind, {scored()} AS score FROM ({weighted(('agg', 'unit', 'grp'), 'bridge', n=n)})"
    last = """le AS (SELECT uid, year, max(least(e, make_timestamp(year, 12, 31, 0, 0, 0))) AS e FROM ev, ys WHERE e < make_timestamp(year, 12, 31, 0, 0, 0) GROUP BY uid, year),
fin AS (SELECT uid, max(e) AS f FROM ev GROUP BY uid),
ts AS (SELECT fin.uid, ys.year, CAST(floor((epoch_us(least(f, make_timestamp(ys.year, 12, 31, 0, 0, 0))) - epoch_us(le.e)) / 86400000000.0) AS INTEGER) AS tsli
  FROM fin CROSS JOIN ys LEFT JOIN le ON le.uid = fin.uid AND le.year = ys.year)"""
    dry = f"""ev AS (SELECT l_partkey AS uid, CAST(l_shipdate AS TIMESTAMP) AS e FROM lineitem), ys AS (SELECT CAST(unnest(range({YEARS[0]}, {YEARS[-1] + 1})) AS INTEGER) AS year), {last}, {_days(VEGETATION_DAYS)},
longt AS (SELECT ts.uid, ts.year, 'sc_tsli' AS measure, CAST(CASE WHEN tsli >= t2 THEN 1 WHEN tsli >= t1 THEN 2 WHEN tsli >= t0 THEN 3 END AS DOUBLE) AS value FROM ts JOIN poly USING (uid) LEFT JOIN days ON days.grp = poly.grp)"""
    dry_score = f"SELECT agg, unit, grp, year, 'stress' AS kind, value AS score FROM ({weighted(('agg', 'unit', 'grp'), 'bridge', n='t', digits=S1)})"
    parts = " UNION ALL ".join([each("q", "cond"), each("p", "cond"), each("d", "stress"), each("x", "stress"), dry_score])
    side = lambda k: R1(f"(coalesce(sum(score) FILTER (kind = '{k}'), 0) - count(score) FILTER (kind = '{k}')) / nullif(count(score) FILTER (kind = '{k}') * 3 - count(score) FILTER (kind = '{k}'), 0)")
    final = f"""f AS (SELECT agg, unit, grp, year, {side('cond')} AS cond, {side('stress')} AS stress FROM parts GROUP BY ALL),
v AS (SELECT *, coalesce(cond, 0) + coalesce(stress, 0) AS v FROM f),
w AS (SELECT *, {R1('(v - min(v) OVER a) / nullif(max(v) OVER a - min(v) OVER a, 0)')} AS vul FROM v WINDOW a AS (PARTITION BY agg))"""
    cols = ", ".join(f"max({k}) FILTER (year = {y}) AS {k}{y}" for k in ("cond", "stress", "vul") for y in YEARS)
    return f"WITH {_AGG}, {front}, {dry}, parts AS ({parts}), {final} SELECT agg, unit, grp, {cols} FROM w GROUP BY agg, unit, grp"


@query(_final_sql())
def final_wide(spark: SparkSession, d: str) -> DataFrame:
    """The final tables of all ways to sum up: a row a unit and group, cond, stress and vul of each year as columns."""
    keys = ["agg", "unit", "grp", "year"]
    long = units.vulnerability(_every_part(spark, d), keys, within=("agg",))
    wide = sinks.wide_columns(long, ["agg", "unit", "grp"], ["cond", "stress", "vul"], YEARS)
    return wide.withColumn("unit", F.array_join("unit", "/"))


@query("""WITH m AS (SELECT o_custkey AS uid, CAST(year(o_orderdate) + CASE WHEN month(o_orderdate) > 6 THEN 1 ELSE 0 END AS INTEGER) AS year, o_orderkey % 100 AS v FROM orders)
SELECT uid, year, round_even((CAST(sum(v) AS DOUBLE) / count(v)) * 10000, 0) / 10000 AS value FROM m GROUP BY uid, year""")
def water_year_metric(spark: SparkSession, d: str) -> DataFrame:
    """Monthly values as means of water years."""
    o = t(spark, d, "orders").select(F.col("o_custkey").alias("uid"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), (F.col("o_orderkey") % 100).cast("double").alias("value"))
    return series.rounded(series.water_year_annual(o))


_DIAMOND = 2.0


@query(f"""WITH {_PT}, bx AS (SELECT label, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM (SELECT * FROM pt WHERE id % 3 = 0) GROUP BY label)
SELECT pt.id, bx.label AS box FROM pt JOIN bx ON greatest(x0 - x, 0, x - x1) + greatest(y0 - y, 0, y - y1) <= {_DIAMOND}""")
def polygon_intersects(spark: SparkSession, d: str) -> DataFrame:
    """Diamonds around all points that meet the boxes of labels, both as WKB polygons."""
    p = points(spark, d)
    x, y, r = F.col("x"), F.col("y"), F.lit(_DIAMOND)
    diamond = F.array(x - r, y, x, y - r, x + r, y, x, y + r, x - r, y)
    left = p.select("id", spatial.wkb_ring(diamond).alias("geometry"))
    b = p.where("id % 3 = 0").groupBy("label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    box = F.array("x0", "y0", "x1", "y0", "x1", "y1", "x0", "y1", "x0", "y0")
    right = b.select(F.col("label").alias("box"), spatial.wkb_ring(box).alias("geometry"))
    return spatial.spatial_join(left, right, 5.0).select("id", "box")
