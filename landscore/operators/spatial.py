"""Spatial joins without a geometry library: grid cells make candidates by an equi-join, exact tests refine them."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def with_cells(df: DataFrame, size: float, x0: str = "xmin", y0: str = "ymin", x1: str = "xmax", y1: str = "ymax") -> DataFrame:
    out = df.withColumn("_cx", F.explode(cells(F.col(x0), F.col(x1), size)))
    return out.withColumn("_cy", F.explode(cells(F.col(y0), F.col(y1), size)))


def box_join(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Pairs whose boxes meet (edges count). Both: xmin, ymin, xmax, ymax; left's other columns and right's must differ.
    A pair that shares several cells is kept in the first of them only, so nothing has to be made distinct."""
    r = right.select(*[F.col(c).alias(f"_r{c}" if c in ("xmin", "ymin", "xmax", "ymax") else c) for c in right.columns])
    a = with_cells(left, size)
    b = with_cells(r, size, "_rxmin", "_rymin", "_rxmax", "_rymax")
    m = a.join(b, ["_cx", "_cy"]).where("xmin <= _rxmax and xmax >= _rxmin and ymin <= _rymax and ymax >= _rymin")
    first = (F.col("_cx") == F.floor(F.greatest("xmin", "_rxmin") / size)) & (F.col("_cy") == F.floor(F.greatest("ymin", "_rymin") / size))
    return m.where(first).drop("_cx", "_cy", "xmin", "ymin", "xmax", "ymax", "_rxmin", "_rymin", "_rxmax", "_rymax")


def nearest_within(left: DataFrame, right: DataFrame, radius: float) -> DataFrame:
    """lid, rid, name, dist: the nearest point of right (rid, name, x, y) within the radius of each point of left (lid, x, y);
    ties to the smallest rid; (-1, null, -1) if none. Cells are as wide as the radius, so nine of them hold all candidates."""
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = left.withColumn("_n", F.explode(near)).withColumn("_cx", F.floor(F.col("x") / radius) + F.col("_n.i")).withColumn("_cy", F.floor(F.col("y") / radius) + F.col("_n.j"))
    b = right.select("rid", "name", F.col("x").alias("_x"), F.col("y").alias("_y"), F.floor(F.col("x") / radius).alias("_cx"), F.floor(F.col("y") / radius).alias("_cy"))
    d = F.sqrt((F.col("x") - F.col("_x")) ** 2 + (F.col("y") - F.col("_y")) ** 2)
    best = a.join(b, ["_cx", "_cy"]).withColumn("dist", d).where(F.col("dist") <= radius).groupBy("lid").agg(F.min(F.struct("dist", "rid", "name")).alias("b"))
    out = left.select("lid").join(best, "lid", "left")
    return out.select("lid", F.coalesce("b.rid", F.lit(-1)).alias("rid"), F.col("b.name").alias("name"), F.coalesce("b.dist", F.lit(-1.0)).alias("dist"))


def wkb_polygon(rings: list[list[tuple[float, float]]]) -> bytes:
    out = struct.pack("<BII", 1, 3, len(rings))
    for r in rings:
        out += struct.pack("<I", len(r)) + np.asarray(r, "<f8").tobytes()
    return out


def polygon_rings(wkb: bytes) -> list[np.ndarray]:
    """Rings of a little-endian WKB Polygon or MultiPolygon."""
    kind = struct.unpack_from("<I", wkb, 1)[0]
    if kind not in (3, 6):
        raise ValueError(f"geometry type {kind} isn't a polygon")

    def one(at: int) -> tuple[list[np.ndarray], int]:
        n = struct.unpack_from("<I", wkb, at + 5)[0]
        at, rings = at + 9, []
        for _ in range(n):
            k = struct.unpack_from("<I", wkb, at)[0]
            rings.append(np.frombuffer(wkb, "<f8", 2 * k, at + 4).reshape(k, 2))
            at += 4 + 16 * k
        return rings, at

    if kind == 3:
        return one(0)[0]
    at, out = 9, []
    for _ in range(struct.unpack_from("<I", wkb, 5)[0]):
        rings, at = one(at)
        out += rings
    return out


def inside(rings: list[np.ndarray], x: float, y: float) -> bool:
    """Even-odd rule over all rings, so holes are outside."""
    odd = False
    for r in rings:
        a, b = r[:-1], r[1:]
        up = (a[:, 1] > y) != (b[:, 1] > y)
        at = a[up, 0] + (y - a[up, 1]) * (b[up, 0] - a[up, 0]) / (b[up, 1] - a[up, 1])
        odd ^= bool(np.count_nonzero(x < at) % 2)
    return odd


def edges_meet(p: list[np.ndarray], q: list[np.ndarray]) -> bool:
    """Whether some edge of p and some edge of q have a point in common."""
    a, b = np.concatenate([r[:-1] for r in p]), np.concatenate([r[1:] for r in p])
    c, d = np.concatenate([r[:-1] for r in q]), np.concatenate([r[1:] for r in q])
    side = lambda o, u, v: (u[..., 0] - o[..., 0]) * (v[..., 1] - o[..., 1]) - (u[..., 1] - o[..., 1]) * (v[..., 0] - o[..., 0])
    step = max(1, (1 << 18) // max(1, len(c)))
    for i in range(0, len(a), step):
        u, v = a[i : i + step, None], b[i : i + step, None]
        near = (np.minimum(u, v) <= np.maximum(c, d)).all(2) & (np.maximum(u, v) >= np.minimum(c, d)).all(2)
        if near.any():
            m, n = np.nonzero(near)
            u, v, e, f = a[i + m], b[i + m], c[n], d[n]
            if ((side(u, v, e) * side(u, v, f) <= 0) & (side(e, f, u) * side(e, f, v) <= 0)).any():
                return True
    return False


def polygons_meet(a: list[np.ndarray], b: list[np.ndarray]) -> bool:
    """Edges that cross or touch, or one inside the other. a, b: of polygon_rings()."""
    return edges_meet(a, b) or inside(b, *a[0][0]) or inside(a, *b[0][0])


@F.pandas_udf(T.BinaryType())
def wkb_ring(flat: pd.Series) -> pd.Series:
    """A polygon of one closed ring x, y, x, y ..."""
    return pd.Series([wkb_polygon([np.asarray(f, float).reshape(-1, 2).tolist()]) for f in flat])


@F.pandas_udf(T.BooleanType())
def meets(p: pd.Series, q: pd.Series) -> pd.Series:
    held: dict[bytes, list[np.ndarray]] = {}

    def rings(w: bytes) -> list[np.ndarray]:
        if w not in held:
            held[w] = polygon_rings(w)
        return held[w]

    return pd.Series([polygons_meet(rings(bytes(x)), rings(bytes(y))) for x, y in zip(p, q, strict=True)])


def buffered(df: DataFrame, radius: float, segments: int = 64) -> DataFrame:
    """Points (x, y) with geometry: the circle around each as a polygon of so many corners on it."""
    turn = [2 * math.pi * i / segments for i in range(segments)] + [0.0]
    flat = F.array(*[e for a in turn for e in (F.col("x") + radius * math.cos(a), F.col("y") + radius * math.sin(a))])
    return df.withColumn("geometry", wkb_ring(flat))


@F.pandas_udf(T.StructType([T.StructField(c, T.DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")]))
def bounds(wkb: pd.Series) -> pd.DataFrame:
    low_high = [(lambda m: (*m.min(0), *m.max(0)))(np.concatenate(polygon_rings(bytes(w)))) for w in wkb]
    return pd.DataFrame(low_high, columns=["xmin", "ymin", "xmax", "ymax"])


def spatial_join(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Attributes of all pairs of polygons (column geometry, WKB) that intersect; rows without a geometry drop out."""
    a = left.where("geometry is not null").withColumn("_b", bounds("geometry")).select("*", "_b.*").drop("_b").withColumnRenamed("geometry", "_g1")
    b = right.where("geometry is not null").withColumn("_b", bounds("geometry")).select("*", "_b.*").drop("_b").withColumnRenamed("geometry", "_g2")
    return box_join(a, b, size).where(meets("_g1", "_g2")).drop("_g1", "_g2")


#: The public parameters of EPSG:3577 (Albers equal area on GRS80).
ALBERS = {"a": 6378137.0, "f": 1 / 298.257222101, "lat1": -18.0, "lat2": -36.0, "lat0": 0.0, "lon0": 132.0, "x0": 0.0, "y0": 0.0}


def albers(lon: Column, lat: Column, p: dict[str, float] = ALBERS) -> tuple[Column, Column]:
    """Degrees to metres of an Albers equal-area conic projection, as column math."""
    e2 = p["f"] * (2 - p["f"])
    e = math.sqrt(e2)

    def q(s):
        log = F.log if isinstance(s, Column) else math.log
        return (1 - e2) * (s / (1 - e2 * s * s) - log((1 - e * s) / (1 + e * s)) / (2 * e))

    m = lambda d: math.cos(math.radians(d)) / math.sqrt(1 - e2 * math.sin(math.radians(d)) ** 2)
    q_at = lambda d: q(math.sin(math.radians(d)))
    m1, m2 = m(p["lat1"]), m(p["lat2"])
    n = (m1**2 - m2**2) / (q_at(p["lat2"]) - q_at(p["lat1"]))
    c = m1**2 + n * q_at(p["lat1"])
    rho0 = p["a"] * math.sqrt(c - n * q_at(p["lat0"])) / n
    rho = p["a"] * F.sqrt(c - n * q(F.sin(F.radians(lat)))) / n
    theta = n * F.radians(lon - p["lon0"])
    return p["x0"] + rho * F.sin(theta), p["y0"] + rho0 - rho * F.cos(theta)


def reproject(df: DataFrame, lon: str = "x", lat: str = "y") -> DataFrame:
    x, y = albers(F.col(lon), F.col(lat))
    return df.withColumns({lon: x, lat: y})


def reproject_polygons(df: DataFrame, p: dict[str, float] = ALBERS) -> DataFrame:
    """The same for a geometry column of WKB polygons in degrees."""
    e2 = p["f"] * (2 - p["f"])
    e = math.sqrt(e2)
    q = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))
    m = lambda d: math.cos(math.radians(d)) / math.sqrt(1 - e2 * math.sin(math.radians(d)) ** 2)
    q_at = lambda d: float(q(math.sin(math.radians(d))))
    n = (m(p["lat1"]) ** 2 - m(p["lat2"]) ** 2) / (q_at(p["lat2"]) - q_at(p["lat1"]))
    c = m(p["lat1"]) ** 2 + n * q_at(p["lat1"])
    rho0 = p["a"] * math.sqrt(c - n * q_at(p["lat0"])) / n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for w in b["geometry"]:
                rings = []
                for r in polygon_rings(bytes(w)) if w is not None else ():
                    rho = p["a"] * np.sqrt(c - n * q(np.sin(np.radians(r[:, 1])))) / n
                    t = n * np.radians(r[:, 0] - p["lon0"])
                    rings.append(np.stack([p["x0"] + rho * np.sin(t), p["y0"] + rho0 - rho * np.cos(t)], 1))
                out.append(wkb_polygon(rings) if rings else None)
            yield b.assign(geometry=out)

    return df.mapInPandas(run, df.schema)
