"""Hand-made fixtures, one for each rule."""

import datetime as dt
import math
import struct

import pytest
from pyspark.sql import functions as F

from landscore.functions import scalar
from landscore.operators import series, spatial, units
from landscore.sources import readers, shapefile, sinks

INF = math.inf


def values(spark, column, rows, kind="double"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", column).orderBy("i").collect()]


def annual(spark, rows):
    return spark.createDataFrame(rows, "uid string, year int, value double")


def test_cut(spark):
    x = F.col("x")
    assert values(spark, scalar.score(x), [-2.0, -1.0, -0.5, 0.0, 0.1, None]) == [1, 1, 2, 2, 3, None]
    assert values(spark, scalar.score(x, reverse=True), [-2.0, -1.0, -0.5, 0.0, 0.1, None]) == [3, 3, 2, 2, 1, None]
    assert values(spark, scalar.score(x, (-1, 0.25, 0.5, 1)), [-1.1, -1.0, 0.25, 0.26, 0.5, 1.0, 1.01]) == [None, 1, 1, 2, 2, 3, None]
    t = [F.lit(v) for v in (0, 1460, 2555)]
    assert values(spark, scalar.cut_by_group(x, *t), [-1.0, 0.0, 1459.0, 1460.0, 2554.0, 2555.0]) == [None, 3, 3, 2, 2, 1]
    assert values(spark, scalar.cut(x, (0, 1, INF), (1, 2), right=False), [-1.0, 0.0, 1.0, 5.0]) == [None, 1, 2, 2]


def test_classify(spark):
    names = ["river red gum woodland clay pan", "F2x4: Shrubland riparian zone or floodplain", "RIVER RED GUM swamp", "woodland of river red gum", "sand"]
    assert values(spark, scalar.classify(F.col("x")), names, "string") == ["clay pan", "shrubland", "river red gum swamps and forests", "river red gum woodland", None]


def test_scalars(spark):
    assert math.copysign(1, values(spark, scalar.clean_nan(F.col("x")), [-0.0])[0]) == 1
    assert values(spark, scalar.clean_nan(F.col("x")), [math.nan, 1.0]) == [None, 1]
    assert values(spark, scalar.duration_days(F.col("x")), ["12 days 06:00:00", "-3 days +04:00:00", "x", None], "string") == [12, -3, None, None]
    assert values(spark, scalar.year_suffix(F.col("x")), ["sumndvi1991", "x", None], "string") == [1991, None, None]
    df = spark.createDataFrame([(2020, 6), (2020, 7)], "y int, m int")
    assert [r[0] for r in df.select(scalar.water_year(F.col("y"), F.col("m"))).collect()] == [2020, 2021]


def test_baseline(spark):
    rows = [("A", 1998 + i, v) for i, v in enumerate((1.0, 2.0, 3.0, 9.0, 9.0, 5.0))]
    r = series.baseline_stats(series.densify(annual(spark, rows)), (2001, 2002)).first()
    assert (r.n, r.baseline, r["median"], r["max"], r["mad"], r["stddev"]) == (6, 2.75, 2.5, 5, 1, 1.7078)


def test_standardise(spark):
    rows = [("c", y, 4.0) for y in range(2000, 2005)] + [("i", y, 9.0 if y == 2004 else 4.0) for y in range(2000, 2005)] + [("s", 2002, 3.0)]
    z = {(r.uid, r.year): r.value for r in series.standardised(series.densify(annual(spark, rows)), (2004,)).collect()}
    assert {z["c", y] for y in range(2000, 2005)} == {0} and z["i", 2004] == INF and z["s", 2002] == 0 and z["s", 2000] == 0


def test_trend(spark):
    out = series.deviation_from_baseline(annual(spark, [("A", 2000, 1.0), ("A", 2001, 4.0)]), 2, 2, nobaseline=True).first()
    assert (out.year, out.ave, out.trend, out["sum"]) == (2001, 2.5, 1.5, 4.0)
    one = series.deviation_from_baseline(annual(spark, [("A", 2000, 1.0)]), 1, None, nobaseline=True).first()
    assert (one.ave, one.trend, one["sum"]) == (1, None, None)
    with pytest.raises(ValueError):
        series.deviation_from_baseline(annual(spark, [("A", 2000, 1.0)]), 2, 3)
    three = series.deviation_from_baseline(annual(spark, [("A", 2000, 1.0), ("A", 2001, 2.0), ("A", 2002, 6.0)]), 3, 3, nobaseline=True).first()
    assert three.trend == round(2.5 * math.sqrt(2 / 3), 4)


def test_area_weighted(spark):
    bridge = spark.createDataFrame([("a", "U", "g", 1.0), ("b", "U", "g", 3.0), ("b", "V", "g", 3.0), ("n", "U", None, 9.0)], "uid string, unit string, grp string, area double")
    long = spark.createDataFrame([("a", 2000, "m", 10.0), ("b", 2000, "m", None), ("n", 2000, "m", 5.0)], "uid string, year int, measure string, value double")
    out = {r.unit: r.value for r in units.area_weighted(long, bridge, ("unit",)).collect()}
    assert out == {"U": 2.5, "V": 0}
    assert units.area_weighted(long, bridge, ("unit",), skip_missing=True).where("unit = 'U'").first().value == 10
    assert units.area_weighted(long, bridge, ("unit",), identity=True).where("grp is null").count() == 1
    assert units.area_weighted(long, bridge, (), by_grp=False).count() == 1


def test_tsli(spark):
    d = dt.datetime
    rows = [("open", d(2019, 12, 1), d(2020, 1, 5)), ("none", d(2020, 2, 1), d(2020, 3, 1)), ("eq", d(2019, 12, 31), d(2020, 1, 1)), ("null", d(2019, 1, 1), None), ("day", d(2019, 5, 1), d(2019, 6, 1, 6)), ("neg", d(2019, 5, 1), d(2019, 6, 1, 6))]
    e = spark.createDataFrame(rows, "uid string, start_time timestamp_ntz, end_time timestamp_ntz")
    finals = {"open": d(2021, 1, 1), "none": d(2021, 1, 1), "eq": d(2021, 1, 1), "null": d(2019, 2, 1), "day": d(2019, 6, 3), "neg": d(2019, 6, 1)}
    f = spark.createDataFrame(list(finals.items()), "uid string, final_date timestamp_ntz")
    out = {r.uid: r.tsli for r in units.time_since_last(e, f, [2019]).collect()}
    assert out == {"open": 0, "none": None, "eq": None, "null": None, "day": 1, "neg": -1}


def test_composite(spark):
    rows = [("a", 3.0), ("a", 3.0), ("a", 3.0), ("b", 1.0), ("b", 1.0), ("b", 1.0), ("c", 3.0), ("c", 1.0), ("d", None)]
    p = spark.createDataFrame(rows, "k string, score double")
    assert {r.k: r.value for r in units.sum_rescale(p, ["k"]).collect()} == {"a": 1, "b": 0, "c": 0.5, "d": None}
    v = spark.createDataFrame([(0.2,), (0.7,), (1.2,)], "v double")
    assert sorted(r.v for r in units.normalise_global(v, "v", 4).collect()) == [0, 0.5, 1]
    x = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    assert sorted(r.v for r in series.minmax(x, "v").collect()) == [0, 0.5, 1]
    assert sorted(r.v for r in series.zscore(x, "v").collect()) == [-1, 0, 1]


def test_survey(spark):
    rows = [(2000, None, s, "U", "g", "n", n) for s, n in ((1, 5), (1, 7), (2, 4))] + [(2000, "A", 1, "U", "g", "n", 3), (2000, "A", 2, "U", "g", "n", 6), (2000, "B", 1, "U", "g", "n", 10)]
    df = spark.createDataFrame(rows, "year int, survey string, site int, unit string, grp string, name string, n int")
    assert units.survey_counts(df, "unit", ("A", "B")).first().n == 11


def test_habitats(spark):
    s = spark.createDataFrame([("U", "herbfield", 2000, 3.0), ("U", "tall reed beds", 2000, 1.0), ("U", "lake", 2000, None)], "unit string, grp string, year int, value double")
    a = spark.createDataFrame([("U", "herbfield", 1.0), ("U", "tall reed beds", 3.0), ("U", "lake", 1.0)], "unit string, grp string, area double")
    m = spark.createDataFrame([("W", "herbfield"), ("W", "tall reed beds"), ("L", "lake")], "wb_group string, grp string")
    assert {r.wb_group: r.value for r in units.map_groups_weighted(s, a, m, ("unit",)).collect()} == {"W": 1.5, "L": None}


def test_regression(spark):
    df = spark.createDataFrame([("a", 1.0, 3.0), ("a", 2.0, 5.0), ("b", 1.0, 1.0), ("b", 1.0, 2.0)], "k string, x double, y double")
    out = {r.k: (r.slope, r.intercept) for r in series.regression(df, ["k"], "x", "y").collect()}
    assert out["a"] == (2, 1) and out["b"] == (None, None)
    fit = df.where("k = 'a'").withColumn("f", F.col("y"))
    assert series.r_squared(fit, "y", "f").first().r2 == 1


def test_nearest(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 100.0)], "lid int, x double, y double")
    right = spark.createDataFrame([(7, "p", 3.0, 0.0), (8, "q", 0.0, 5.0)], "rid int, name string, x double, y double")
    assert [tuple(r) for r in spatial.nearest_within(left, right, 4.0).orderBy("lid").collect()] == [(1, 7, "p", 3.0), (2, -1, None, -1.0)]


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]


def test_polygons(spark):
    a = spark.createDataFrame([(i, spatial.wkb_polygon(g)) for i, g in enumerate([[square(0, 0, 2)], [square(10, 10, 8), square(12, 12, 4)], [square(40, 0, 1)]])], "a int, geometry binary")
    b = spark.createDataFrame([(i, spatial.wkb_polygon(g)) for i, g in enumerate([[square(1, 1, 2)], [square(2, 0, 1)], [square(13, 13, 1)], [square(11, 11, 0.5)], [square(-5, -5, 99)]])], "b int, geometry binary")
    got = sorted(tuple(r) for r in spatial.spatial_join(a, b, 3.0).select("a", "b").collect())
    assert got == [(0, 0), (0, 1), (0, 4), (1, 3), (1, 4), (2, 4)]


def test_reproject(spark):
    df = spatial.reproject(spark.createDataFrame([(132.0, 0.0), (145.0, -30.0)], "x double, y double")).collect()
    assert abs(df[0].x) < 1e-6 and abs(df[0].y) < 1e-6
    assert 1.2e6 < df[1].x < 1.3e6 and -3.4e6 < df[1].y < -3.1e6
    p = spark.createDataFrame([(1, spatial.wkb_polygon([[(145.0, -30.0), (146.0, -30.0), (145.0, -31.0), (145.0, -30.0)]]))], "i int, geometry binary")
    ring = spatial.polygon_rings(bytes(spatial.reproject_polygons(p).first().geometry))[0]
    assert abs(ring[0][0] - df[1].x) < 1e-3 and abs(ring[0][1] - df[1].y) < 1e-3


def test_csv(spark, tmp_path):
    (tmp_path / "y.csv").write_text("feature_id,year,pv_median,water+wet_median\nA,1990,0.5,NaN\nB,1991,,1.5\n")
    df = readers.read_csv(spark, f"file://{tmp_path}/y.csv", "wit_yearly")
    assert [tuple(r) for r in df.select("uid", "year", "pv_median", "`water+wet_median`").orderBy("uid").collect()] == [("A", 1990, 0.5, None), ("B", 1991, None, 1.5)]
    (tmp_path / "e.csv").write_text("feature_id,start_time,end_time,duration,gap\nA,2000-01-01,2000-01-05 06:00:00,4 days 06:00:00,\n")
    e = readers.read_csv(spark, f"file://{tmp_path}/e.csv", "inundation_events").first()
    assert (e.duration_days, e.gap_days, e.start_time) == (4, None, dt.datetime(2000, 1, 1))


def test_sinks(spark, tmp_path):
    assert sinks.metric_file("npv+pv+wet_median", "Ramsar", 5) == "npvpvwet_median_Ramsar_5yr.csv"
    long = spark.createDataFrame([("U", 1991, "ave", 0.5), ("U", 1991, "trend", 0.1), ("U", 1992, "ave", 0.7)], "unit string, year int, measure string, value double")
    w = sinks.wide_measures(long, ["unit"], "NDVI", ["ave", "trend"], [1991, 1992])
    assert w.columns == ["unit", "Tndvi1991", "Tndvi1992", "ndvi1991", "ndvi1992"] and tuple(w.first()) == ("U", 0.1, None, 0.5, 0.7)
    sinks.write_csv(w, f"file://{tmp_path}/out")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/out").count() == 1
    twice = spark.createDataFrame([("A", 2000, 1.0), ("A", 2000, 2.0)], "uid string, year int, value double")
    with pytest.raises(Exception, match="twice"):
        units.wide_years(twice, ["uid"], [2000]).collect()


def test_shapefile(spark, tmp_path):
    rings = [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0)]]
    flat = [c for r in rings for p in r for c in p]
    body = struct.pack("<i4d2i", 5, 0, 0, 1, 1, 1, 5) + struct.pack("<i", 0) + struct.pack(f"<{len(flat)}d", *flat)
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 50) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    (tmp_path / "p.shp").write_bytes(head + struct.pack(">2i", 1, len(body) // 2) + body)
    (tmp_path / "p.shx").write_bytes(head + struct.pack(">2i", 50, len(body) // 2))
    fields = [(b"UID", b"C", 9, 0), (b"AREA", b"N", 8, 2)]
    dbf = struct.pack("<B3BIHH20x", 3, 24, 1, 1, 1, 32 + 32 * len(fields) + 1, 18)
    dbf += b"".join(struct.pack("<11sc4xBB14x", *f) for f in fields) + b"\r" + b" " + b"r1".ljust(9) + b"    2.50"
    (tmp_path / "p.dbf").write_bytes(dbf)
    spark.dataSource.register(shapefile.ShapefileSource)
    r = spark.read.format("shapefile").load(str(tmp_path / "p.shp")).first()
    assert (r.UID, r.AREA) == ("r1", 2.5) and len(spatial.polygon_rings(bytes(r.geometry))[0]) == 5


def write_shapefile(base, polygons, fields):
    """polygons: (values, ring); fields: (name, kind, size, decimals)."""
    shp, shx, at = b"", b"", 50
    rows = b""
    for k, (vals, ring) in enumerate(polygons):
        flat = [c for p in ring for c in p]
        body = struct.pack("<i4d2i", 5, 0, 0, 1, 1, 1, len(ring)) + struct.pack("<i", 0) + struct.pack(f"<{len(flat)}d", *flat)
        shx += struct.pack(">2i", at, len(body) // 2)
        shp += struct.pack(">2i", k + 1, len(body) // 2) + body
        at += 4 + len(body) // 2
        rows += b" " + b"".join((str(v).rjust(n) if kind == b"N" else str(v).ljust(n)).encode() for v, (_, kind, n, _) in zip(vals, fields, strict=True))
    head = struct.pack(">7i", 9994, 0, 0, 0, 0, 0, 50) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    base.with_suffix(".shp").write_bytes(head + shp)
    base.with_suffix(".shx").write_bytes(head + shx)
    dbf = struct.pack("<B3BIHH20x", 3, 24, 1, 1, len(polygons), 32 + 32 * len(fields) + 1, 1 + sum(f[2] for f in fields))
    base.with_suffix(".dbf").write_bytes(dbf + b"".join(struct.pack("<11sc4xBB14x", *f) for f in fields) + b"\r" + rows)


def test_whole_analysis(spark, tmp_path):
    """Two polygons of a group in one site, of areas 1 and 3, from files to files."""
    from landscore.config import AggregatorSpec, EngineConfig, MetricRun
    from landscore.plans import analysis

    wide = [(b"UID", b"C", 4, 0), (b"ANAE_TYPE", b"C", 20, 0), (b"Area_Ha", b"N", 8, 2)]
    polys = [(("a", "Black box forest", 1.0), square(0, 0, 1)), (("b", "black box swamp", 3.0), square(2, 0, 1)), (("c", "sand", 9.0), square(4, 0, 1)), (("d", "Black box", 5.0), square(90, 0, 1))]
    write_shapefile(tmp_path / "fine", polys, wide)
    write_shapefile(tmp_path / "sites", [(("S", "W"), square(-1, -1, 6))], [(b"SITE", b"C", 4, 0), (b"PART", b"C", 4, 0)])
    years = range(2000, 2006)
    rows = [f"{u},{y},{v}" for u, vs in {"a": (1, 1, 1, 1, 1, 3), "b": (2, 4, 2, 4, 2, 4), "c": (1,) * 6, "zz": (5,) * 6}.items() for y, v in zip(years, vs)]
    (tmp_path / "y.csv").write_text("feature_id,year,pv_median\n" + "\n".join(rows))
    (tmp_path / "s.csv").write_text("UID,StdTime,MEAN\n" + "\n".join(f"{u},{y}-06-30,{v}" for u, v in (("a", 0.2), ("b", 0.6)) for y in years))
    (tmp_path / "f.csv").write_text("feature_id,final-date\na,2005-12-31\nb,2005-12-31\n")
    (tmp_path / "e.csv").write_text("feature_id,start_time,end_time,duration,gap\na,2004-01-01,2004-12-26,360 days,\nb,2000-01-01,2001-01-01,366 days,\n")
    runs = (MetricRun("pv_median", part="cond"), MetricRun("soilmoist", source="soil", bins=(-1, 0.25, 0.5, 1), nobaseline=True, part="stress"), MetricRun("soilmoist", source="soil", window=1, trend=None, nobaseline=True, scored=False, tag="_INUNDATION"))
    specs = (AggregatorSpec("own", ("UID",), identity=True), AggregatorSpec("site", ("SITE", "PART")), AggregatorSpec("all"))
    cfg = EngineConfig(2000, 2005, (), 5, runs, {"polygons": "fine.shp", "site": "sites.shp", "yearly": "y.csv", "soil": "s.csv", "finals": "f.csv", "events": "e.csv"}, cell=10.0, input_dir=str(tmp_path), output_dir=str(tmp_path / "out"))
    out = analysis.run(spark, cfg, specs)
    assert len(out) == 2 + 3 * 3 + 2 * 3 + 3 and "soilmoist_site_1yr_INUNDATION.csv" in out
    read = lambda n: [r.asDict() for r in spark.read.option("header", True).csv(out[n]).collect()]
    #: a: mean 1.3333, deviation 0.8165, so 2005 is 2.0413 and the years before -0.4082; b: -0.9129 and 0.9129 in turn.
    own = {r["UID"]: r for r in read("pv_median_own_5yr.csv")}
    assert set(own) == {"a", "b", "c"} and own["c"]["grp"] is None
    z, w = (-0.3333 / 0.8165, 1.6667 / 0.8165), 1 / 1.0954
    assert float(own["a"]["pv_median2005"]) == round((4 * z[0] + z[1]) / 5, 4) and float(own["a"]["Tpv_median2005"]) == round((z[1] - z[0]) / 2, 4)
    (site,) = read("pv_median_site_5yr.csv")
    ave = ((4 * z[0] + z[1]) / 5 * 1 + w / 5 * 3) / 4
    assert (site["SITE"], site["PART"], float(site["area"])) == ("S", "W", 4) and abs(float(site["pv_median2005"]) - ave) < 1e-3
    assert float(site["scpv_median2005"]) == 3 and {c[-4:] for c in site if c.startswith("scsum")} == {"2004", "2005"}
    (dry,) = read("time_since_last_inundation_site_vegetation_stress.csv")
    #: a: 5 days at the end of 2004; b: 1460 days since 2001-01-01, which is in the second bin.
    assert float(dry["tsli2004"]) == round((5 + 3 * 1460) / 4, 1) and float(dry["sc_tsli2004"]) == round((3 + 3 * 2) / 4, 1)
    (final,) = read("FINAL_BWSVulnerability_vegetation_site.csv")
    assert list(final)[3:] == [f"{k}{y}" for k in ("cond", "stress", "vul") for y in (2004, 2005)]
    #: 2004: soil 0.5 scores 2, the elapsed time 2.2 (2.25 to one decimal): (4.2 - 2) / 4.
    assert float(final["stress2004"]) == 0.6 and all(0 <= float(v) <= 1 for k, v in final.items() if k[:3] == "vul")
