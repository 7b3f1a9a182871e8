"""Near copies: documents whose sets of five-word shingles have an exact Jaccard similarity of 0.8 or more, in groups.

Rows with the same set are one node. Candidates share a band of minima of the shingles' hashes: two sets of similarity s
share one with a probability of 1 - (1 - s**BAND_ROWS)**BANDS, by whatever edits they differ; at 0.8 that is 0.99993. In a
band's bucket the sets' wide SimHash fingerprints are compared as in simhash.py: the first 64 bits bit-sliced within
LANE_RADIUS, then all bits within LOOSE. Sets of similarity 0.8 differ in at most 0.1875 of the bits on average (4 of 5
shingles), so both limits are some 5 standard deviations away. A bucket gives out a spanning forest of its candidates; its
trees are families, and no candidate is outside of one. Then a family's shingle sets (their 64-bit hashes) come together
once, all its pairs are compared again bit-sliced, and pairs not yet linked are judged by their exact similarity on the
spot, so that again only spanning links come out. Families of over FAMILY nodes or FAMILY_BYTES are cut into tiles, a task
for each pair of tiles. No estimate links documents, and no pairs of a family are written.

Defined cases: null or empty text has the empty set and is a copy of any other such; rows that share an id and have
different texts are judged apart; repeated rows are returned as they are; a null doc_id takes part and comes behind all
others (component_id is null only where no row of the group has an id; then the first row is that of the smallest hash of
its text); other columns, of any names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, sized, stage
from .graph import components
from .simhash import ONES, SEED, SIMILAR_WORDS, SIMILARITY, TILE, majority, searched, shingle_hashes, widened

BANDS, BAND_ROWS, LANE_RADIUS, LOOSE, FAMILY, FAMILY_BYTES = 24, 5, 28, 140, 4096, 32 << 20


def band_keys(h: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """A key for each band of minima over the hashes."""
    factors = widened(np.array([SEED], np.uint64), bands * rows)[0] | np.uint64(1)
    least = np.full(bands * rows, ONES)
    for i in range(0, len(h), 1 << 10):
        np.minimum(least, (factors[:, None] * h[None, i : i + (1 << 10)]).min(axis=1), out=least)
    key = np.arange(bands, dtype=np.uint64)
    for row in least.reshape(bands, rows).T:
        key = widened(key ^ row, 1)[:, 0]
    return key.view(np.int64)


def signature(text: str | None, size: int = SIMILAR_WORDS) -> tuple[bytes, bytes, np.ndarray]:
    """Of a text's set of shingles: a digest, the wide fingerprint, the keys of its bands."""
    h = np.unique(shingle_hashes(text or "", size))
    return blake2b(h.tobytes(), digest_size=16).digest(), majority(widened(h)).tobytes(), band_keys(h)


def with_row_key(docs: DataFrame) -> DataFrame:
    """doc_id, did (doc_id without null), rk (tells an id's texts apart), text."""
    did, rk = row_key(F.col("doc_id"), F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), did.alias("did"), rk.alias("rk"), "text")


def signatures(docs: DataFrame, size: int = SIMILAR_WORDS) -> DataFrame:
    """doc_id, did, rk, digest, fp (the first 64 bits of wide), wide, bands; one row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [signature(t, size) for t in b.column(3).to_pylist()]
            fp = np.array([np.frombuffer(x[1], np.int64)[0] for x in each], np.int64)
            binary = [pa.array([x[i] for x in each], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), binary[0], pa.array(fp), binary[1], pa.array([x[2] for x in each], pa.list_(pa.int64()))],
                ["doc_id", "did", "rk", "digest", "fp", "wide", "bands"],
            )

    return with_row_key(docs).mapInArrow(run, "doc_id long, did long, rk long, digest binary, fp long, wide binary, bands array<long>")


def shingle_sets(docs: DataFrame, nodes: DataFrame, size: int = SIMILAR_WORDS) -> DataFrame:
    """node, items (sorted shingle hashes). nodes: node, did, rk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = [np.unique(shingle_hashes(t or "", size)).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(items, pa.binary())], ["node", "items"])

    rows = with_row_key(docs).join(sized(nodes), ["did", "rk"]).select("node", "text")
    return rows.mapInArrow(run, "node long, items binary").dropDuplicates(["node"])


def near_copies(docs: DataFrame, similarity: float = SIMILARITY, size: int = SIMILAR_WORDS, tile: int = TILE, family: int | None = None) -> DataFrame:
    """doc_id, did, rk (row_key() of id and text), component_id (the group's smallest id), first (whether the row is of the
    group's first id and text); one row for each input row."""
    rows = stage(signatures(docs, size), "signatures")
    distinct = rows.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "did", "rk")).alias("least"), F.first("fp").alias("fp"), F.first("wide").alias("wide"), F.first("bands").alias("bands"))
    distinct = stage(distinct.withColumn("node", F.monotonically_increasing_id()), "distinct")
    keys = distinct.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    met = stage(keys.join(sized(stage(shared, "shared_bands")), "key"), "met")
    signed = met.join(distinct.select("node", "fp", "wide"), "node").withColumn("t", F.lit(0))
    families = stage(components(searched(signed, LANE_RADIUS, LOOSE)), "families")
    nodes = families.join(distinct, "node").select("node", F.col("root").alias("key"), "fp", "wide", "least.did", "least.rk")
    nodes = stage(nodes, "candidate_nodes")
    sets = shingle_sets(docs, nodes.select("node", "did", "rk"), size)
    members = stage(nodes.drop("did", "rk").join(sets, "node"), "members")
    sums = members.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("items")).alias("size"))
    tiles = F.greatest(F.ceil(F.col("n") / (family or FAMILY)), F.ceil(F.col("size") / FAMILY_BYTES)).cast("int")
    hot = sized(stage(sums.withColumn("tiles", tiles).where("tiles > 1").select("key", "tiles"), "hot_families"))
    members = members.join(hot, "key", "left").withColumns({"tiles": F.coalesce("tiles", F.lit(1)), "t": F.lit(0)})
    near = stage(searched(members, LANE_RADIUS, LOOSE, similarity), "near")
    roots = distinct.select("digest", "node", "least").join(components(near), "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    roots = stage(roots, "roots")
    firsts = roots.groupBy("root").agg(F.min("least").alias("least"))
    by_digest = roots.select("digest", "root").join(firsts, "root").select("digest", "least")
    out = rows.select("doc_id", "did", "rk", "digest").join(by_digest, "digest")
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("rk") == F.col("least.rk"))
    return out.select("doc_id", "did", "rk", F.col("least.doc_id").alias("component_id"), first.alias("first"))
