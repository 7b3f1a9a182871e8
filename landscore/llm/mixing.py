"""Mixing sources to target weights: whole epochs of a source, then documents in hash order up to its exact budget.

A document's size is its number of `[^\\x20\\x09-\\x0D]+` words. Sources in order of code points (null last) weigh
3, 1, 2, repeating. They share `share` times all sizes by weight; a target stops at `epochs` times its source's size, and
the excess goes to the others by weight until none is above (solved at once: sources sorted by limit per weight, the
first ones full, the rest at one level). Every document gets a key, md5 of seed and id. Keys are uniform, so equal ranges
of them range-sort each source into even parts, the hot source's too (BUCKETS, or more to hold about BUCKET_ROWS each). Bucket sums, summed up along a source,
are the offsets for the running sums inside the buckets. A source's last document is taken if that brings it nearer.

Defined cases: null text has size 0; null source is a source of its own; rows that repeat a doc_id are separate and drawn
in the order of their texts' hashes, then of a hash of the whole row (rows that are wholly equal are told apart by nothing
but their number, so reruns give the same table); a null doc_id is drawn like any other; an empty table gives none; sources
without words have target 0; other columns, of any names, are kept by mix() and ignored by shares().
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import sized, stage

BUCKETS, BUCKET_ROWS, MOST_BUCKETS, SHARE, EPOCHS, WEIGHTS, SEED = 1024, 1 << 16, 1 << 17, 1.5, 2, (3, 1, 2), "mix-1:"


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, rk, source, size, key, spot (the key's first 24 bits), row (a hash of all columns); columns in a struct `own`."""
    n = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    spot = F.conv(F.substring(key, 1, 6), 16, 10).cast("int")
    whole = F.xxhash64(*[F.col(f"`{c}`").cast("string") if t.startswith(("map", "variant")) else F.col(f"`{c}`") for c, t in docs.dtypes])
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("rk"), "source", n.alias("size"), key.alias("key"), spot.alias("spot"), whole.alias("row"), F.struct(*[f"`{c}`" for c in docs.columns]).alias("own"))


def targets(totals: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: tuple = WEIGHTS) -> DataFrame:
    """source, source_size, target. totals: source, source_size, a row for each source. The windows below have one
    row for each source, not for each document."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("w", w).withColumn("most", (epochs * F.col("source_size")).cast("double"))
    t = t.withColumn("at", F.col("most") / F.col("w"))
    by_limit = Window.orderBy("at", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("place", F.row_number().over(by_limit))
    t = t.withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0.0))).withColumn("spent", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    t = t.withColumn("total", F.sum("source_size").over(everything) * share).withColumn("all_w", F.sum("w").over(everything))
    #: The level of this source and those behind it if just the ones before it are full; the first that fits is the right one.
    t = t.withColumn("level", (F.col("total") - F.col("full")) / (F.col("all_w") - F.col("spent")))
    t = t.withColumn("right", F.min(F.when(F.col("level") <= F.col("at"), F.struct("place", "level"))).over(everything))
    full = F.col("right").isNull() | (F.col("place") < F.col("right.place"))
    return t.select("source", "source_size", F.when(full, F.col("most")).otherwise(F.col("right.level") * F.col("w")).alias("target"))


def drawn(docs: DataFrame, share: float, epochs: int, weights: tuple, seed: str, whole_rows: bool) -> DataFrame:
    """Columns of sizes() and source_size, target, copies (how often the mix takes the row). whole_rows: with `own`. Then words
    are counted twice, so that texts needn't be joined to what is drawn or be written once more."""
    rows = sizes(docs, seed)
    light = stage(rows.select("source", "size", "spot") if whole_rows else rows.drop("own"), "sizes")
    rows = rows if whole_rows else light
    buckets = min(MOST_BUCKETS, max(BUCKETS, 1 << (light.count() // BUCKET_ROWS).bit_length()))
    bucket = F.floor(F.col("spot") * F.lit(float(buckets)) / 2.0**24).cast("int")  # in the order of keys
    sums = stage(light.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("sum")), "bucket_sums")
    wanted = targets(sums.groupBy("source").agg(F.sum("sum").alias("source_size")), share, epochs, weights)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("offset", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    offsets = offsets.join(wanted.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    offsets = sized(stage(offsets.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "offset", "source_size", "target"), "offsets"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "rk", "row").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("bucket", bucket).withColumn("local", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = local.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    whole = F.least(F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.greatest("source_size", F.lit(1))).otherwise(0.0)), F.lit(epochs)).cast("long")
    left = F.col("target") - whole * F.col("source_size")
    extra = (whole < epochs) & (F.col("size") > 0) & (F.col("offset") + F.col("local") + F.col("size") / 2.0 <= left)
    return out.withColumn("copies", whole + extra.cast("long"))


def shares(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """doc_id, rk, source, size, source_size, target, copies (how often the mix takes the document), taken."""
    out = drawn(docs, share, epochs, weights, seed, False)
    return out.select("doc_id", "rk", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The documents with all their columns, each row as often as the mix takes it."""
    out = drawn(docs, share, epochs, weights, seed, True).where("copies > 0")
    return out.select("own", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("own.*")
