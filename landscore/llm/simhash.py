"""SimHash near-duplicates: 64-bit fingerprints, exact search of all pairs within a radius, components as groups.

Fingerprints are collapsed to distinct ones first. 64 bits are cut into BLOCKS blocks; two fingerprints that differ in at
most `radius` bits have BLOCKS - radius blocks in common, so every choice of that many blocks is a key, and all pairs
within the radius share a key. Within a key's bucket the comparison is bit-sliced: for 64 fingerprints at a time, one word
a bit plane; a query's differing planes are added to vertical counters by carry-save steps, and a block of 64 is abandoned
as soon as all of its lanes exceed the radius. A bucket gives out a spanning forest of its links, not all pairs. Buckets of
more than `tile` fingerprints are cut into tiles and each pair of tiles is compared in a task of its own. The number of
blocks follows the number of fingerprints: more blocks are more but smaller buckets, so the work stays near linear.

near_duplicates() links by one fingerprint of word shingles. similar_documents() links documents whose sets of `size`-word
shingles have a Jaccard similarity of about `similarity` or more: candidates are within `radius` bits by the fingerprint
of their sets of words, which edits hardly move, and are linked if their wide fingerprints (LANES * 64 bits) of the
shingle sets differ in no more bits than sets of that similarity do (mean and one standard deviation).

Defined cases: null or empty text has fingerprint zero and is linked like any other; repeated rows and ids are returned
as they are, each id is one node (with the fingerprints of all its rows); a null doc_id gets its fingerprint but takes no
part in links (component_id null); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sized, stage
from .graph import components

SEED, WORDS, RADIUS, TILE = 42, 4, 4, 2048
SIMILAR_WORDS, SIMILARITY, SIMILAR_RADIUS, LANES, SLICE = 5, 0.8, 6, 8, 1 << 14
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, size: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle; bytes.lower() and bytes.split() know ASCII only, as is asked for."""
    from xxhash import xxh64_intdigest

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(size, len(parts))
    spans = zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.array([xxh64_intdigest(line[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: str | None, size: int = WORDS) -> int:
    """Bits that are set in over half of the shingles' hashes."""
    return int(majority(shingle_hashes(text or "", size).reshape(-1, 1))[0])


def majority(h: np.ndarray) -> np.ndarray:
    """Of rows of 64-bit words: the bits set in over half of the rows; none without rows."""
    lanes = h.shape[1]
    counts = np.zeros(64 * lanes, np.int64)
    for i in range(0, len(h), 1 << 13):
        bits = np.unpackbits(h[i : i + (1 << 13)].view(np.uint8).reshape(-1, 8 * lanes), axis=1, bitorder="little")
        even = len(bits) // 128 * 128
        sums = bits[:even].reshape(-1, 128, 64 * lanes).sum(axis=1, dtype=np.uint8)
        counts += sums.sum(axis=0, dtype=np.int64) + bits[even:].sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)


def widened(h: np.ndarray, lanes: int = LANES) -> np.ndarray:
    """Rows of `lanes` hashes made from each hash."""
    x = h[:, None] + np.arange(1, lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def signature(text: str | None, size: int = SIMILAR_WORDS) -> tuple[int, bytes]:
    """The fingerprint of a text's set of words, and the wide one of its set of shingles."""
    word = np.unique(shingle_hashes(text or "", 1)).reshape(-1, 1)
    return int(majority(word)[0]), majority(widened(np.unique(shingle_hashes(text or "", size)))).tobytes()


def wide_limit(similarity: float = SIMILARITY, lanes: int = LANES) -> int:
    """By how many bits wide fingerprints of sets of this similarity may differ."""
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    n = 64 * lanes
    return int(n * p + np.sqrt(n * p * (1 - p)))


def fingerprints(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a long); one row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, size) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def signatures(docs: DataFrame, size: int = SIMILAR_WORDS) -> DataFrame:
    """doc_id, fp, wide of signature(); one row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = [signature(t, size) for t in b.column(1).to_pylist()]
            fp = np.array([x[0] for x in both], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), pa.array([x[1] for x in both], pa.binary())], ["doc_id", "fp", "wide"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long, wide binary")


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of groups of 64 fingerprints: out[j, w] has bit j of fingerprints 64 w to 64 w + 63."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    bits = bits.reshape(-1, 64, 64).transpose(2, 0, 1)
    return np.ascontiguousarray(np.packbits(bits, axis=2, bitorder="little")).view(np.uint64)[:, :, 0]


def within(plane: np.ndarray, query: np.ndarray, q: np.ndarray, w: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """For pairs (query q, word w): those of which some lane is within the radius, as indexes into q, and the lanes as bits."""
    n = radius.bit_length()
    alive = np.arange(len(q))
    counts = [np.zeros(len(q), np.uint64) for _ in range(n)]
    over = np.zeros(len(q), np.uint64)
    for j in range(64):
        sign = (np.uint64(0) - ((query >> np.uint64(j)) & np.uint64(1)))[q[alive]]
        carry = plane[j][w[alive]] ^ sign
        for c in counts:
            carry, c[:] = c & carry, c ^ carry
        over |= carry
        if j % 8 == 7:
            beyond, equal = over.copy(), ONES
            for b in reversed(range(n)):
                if radius >> b & 1:
                    equal = equal & counts[b]
                else:
                    beyond, equal = beyond | (equal & counts[b]), equal & ~counts[b]
            keep = beyond != ONES
            if j == 63:
                return alive[keep], ~beyond[keep]
            if not keep.all():
                alive, over = alive[keep], over[keep]
                counts = [c[keep] for c in counts]
    raise AssertionError


class Forest:
    """Union by smaller root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True

    def labels(self) -> np.ndarray:
        """The root of each."""
        up = np.array(self.up, np.int64)
        while (up[up] != up).any():
            up = up[up]
        return up


Near = Callable[[np.ndarray, np.ndarray], np.ndarray]


def spanning(forest: Forest, a: np.ndarray, b: np.ndarray, near: Near | None) -> list[tuple[int, int]]:
    """Those of the pairs (that are near) that join two trees."""
    out, label = [], forest.labels()
    for k in range(0, len(a), SLICE):
        x, y = a[k : k + SLICE], b[k : k + SLICE]
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
        if near is not None and len(x):
            ok = near(x, y)
            x, y = x[ok], y[ok]
        new = [(i, j) for i, j in zip(x.tolist(), y.tolist(), strict=True) if forest.join(i, j)]
        if new:
            out += new
            label = forest.labels()
    return out


def bucket_links(fp: np.ndarray, group: np.ndarray, side: np.ndarray, radius: int = RADIUS, near: Near | None = None, room: int = 1 << 15) -> np.ndarray:
    """Links (i, j) that span what is linked in each group. group: ascending; side: 2 if a row is on both sides, else 0 or 1;
    rows of side 0 are compared with those of side 1. near: what pairs within the radius must fulfil too."""
    cut = np.flatnonzero(np.diff(group)) + 1
    starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
    order, words, first, filled = [], 0, [], []
    for a, b in zip(starts, ends, strict=True):
        right = np.arange(a, b)[side[a:b] > 0]
        order.append(np.concatenate([right, np.full(-len(right) % 64, -1)]))
        first.append(words)
        words += len(order[-1]) // 64
        filled.append(words - first[-1])
    lane = np.concatenate(order).astype(np.int64)
    plane = planes(np.where(lane >= 0, fp[np.maximum(lane, 0)], 0).astype(np.uint64))
    which = np.repeat(np.arange(len(starts)), ends - starts)
    left = np.flatnonzero(side != 1)
    each = np.array(filled)[which[left]]
    offsets = np.concatenate([[0], np.cumsum(each)])
    forest, out, i = Forest(len(fp)), [], 0
    while i < len(left):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + room, "right")) - 1)
        q = np.repeat(left[i:j], each[i:j])
        w = np.repeat(np.array(first)[which[left[i:j]]], each[i:j]) + np.arange(len(q)) - np.repeat(offsets[i:j] - offsets[i], each[i:j])
        at, lanes = within(plane, fp, q, w, radius)
        if len(at):
            bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(bits)
            a, b = q[at[row]], lane[w[at[row]] * 64 + bit]
            ok = (b >= 0) & (a != b)
            out += spanning(forest, a[ok], b[ok], near)
        i = j
    return np.array(out, np.int64).reshape(-1, 2)


class Sets:
    """Sets of 64-bit numbers, as bytes; which pairs have a Jaccard similarity."""

    def __init__(self, items: list[bytes], similarity: float):
        self.size = np.array([len(x) // 8 for x in items], np.int64)
        self.end = np.cumsum(self.size)
        numbers, self.flat = np.unique(np.frombuffer(b"".join(items), np.uint64), return_inverse=True)
        self.mark, self.least = np.zeros(len(numbers), bool), Fraction(str(similarity))

    def near(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the sets x and y have the similarity, exactly. The numbers of one set are marked, then those of all its
        partners looked up, some millions at a time."""
        up, down = self.least.numerator, self.least.denominator
        a, b = self.size[x], self.size[y]
        out, todo = np.zeros(len(x), bool), np.flatnonzero(np.minimum(a, b) * down >= up * np.maximum(a, b))
        todo = todo[np.argsort(x[todo], kind="stable")]
        for own in np.split(todo, np.flatnonzero(np.diff(x[todo])) + 1) if len(todo) else ():
            i = x[own[0]]
            marked = self.flat[self.end[i] - self.size[i] : self.end[i]]
            self.mark[marked] = True
            step = max(1, (1 << 22) // max(1, int(b[own].max())))
            for k in range(0, len(own), step):
                part = own[k : k + step]
                hit = self.mark[np.concatenate([self.flat[self.end[j] - self.size[j] : self.end[j]] for j in y[part].tolist()])]
                sums, ends = np.concatenate([[0], np.cumsum(hit)]), np.cumsum(b[part])
                both = sums[ends] - sums[ends - b[part]]
                out[part] = both * down >= up * (a[part] + b[part] - both)
            self.mark[marked] = False
        return out


def block_count(n: int, radius: int = RADIUS) -> int:
    """The number of blocks with the least work for n fingerprints: a key's row costs about as much as comparing with 7 words
    of 64 fingerprints."""
    cost = lambda b: comb(b, radius) * (7 + n / 2 ** (64 * (b - radius) / b) / 64)
    return min(range(radius + 2, radius + 6), key=cost)


def key_masks(blocks: int, radius: int = RADIUS) -> list[int]:
    """The masks of all choices of blocks - radius blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(block, blocks - radius)]


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int | None = None, tile: int = TILE, limit: int = 0) -> DataFrame:
    """a, b: links between nodes (node long, fp long, perhaps wide binary; rows distinct) that connect all within the radius
    (with wide: and within the limit)."""
    blocks = blocks or block_count(distinct.count(), radius)
    sig = [c for c in ("fp", "wide") if c in distinct.columns]
    signed = [m - (1 << 64) if m >> 63 else m for m in key_masks(blocks, radius)]
    masks = F.array(*[F.struct(F.lit(i).alias("t"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(signed)])
    keys = distinct.select("node", *sig, F.explode(masks).alias("m")).select("node", *sig, F.col("m.t").alias("t"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"))
    counts = keys.groupBy("t", "key").agg(F.count("*").alias("n"))
    hot = sized(stage(counts.where(F.col("n") > tile).select("t", "key", F.ceil(F.col("n") / tile).cast("int").alias("tiles")), "hot_buckets"))
    keys = keys.join(hot, ["t", "key"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    return searched(keys, radius, limit)


def searched(keys: DataFrame, radius: int = RADIUS, limit: int = 0, similarity: float | None = None) -> DataFrame:
    """a, b: links that span what is linked in each bucket (t, key). keys: node, fp, t, key, tiles (into how many tiles the
    bucket is cut); perhaps wide, of which `limit` bits may differ, and items (sorted 64-bit numbers), whose Jaccard
    similarity must then be `similarity` or more. Pairs are judged where they are met; only spanning links come out."""
    sig = [c for c in ("fp", "wide", "items") if c in keys.columns]
    own = F.pmod(F.xxhash64(*[c for c in sig if c != "items"], "t"), F.col("tiles")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y"), F.when(own == o, 2).when(own < o, 0).otherwise(1).alias("side")))
    dealt = keys.select("node", *sig, "t", "key", F.explode(pairs).alias("p")).select("node", *sig, "t", "key", F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("p.side").alias("side"))
    dealt = dealt.repartition("t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y", "fp")

    def compare(part: pa.Table) -> pa.RecordBatch:
        col = lambda c: part.column(c).to_numpy()
        new = np.zeros(len(part), bool)
        for c in ("t", "key", "x", "y"):
            v = col(c)
            new[1:] |= v[1:] != v[:-1]
        group = np.cumsum(new)
        many = np.bincount(group)[group] > 1
        node, found = col("node")[many], np.empty((0, 2), np.int64)
        if many.any():
            held = lambda c: part.column(c).filter(pa.array(many)).to_pylist()
            near, wide = None, np.frombuffer(b"".join(held("wide")), np.uint64).reshape(len(node), -1) if "wide" in sig else None
            if wide is not None:
                sets = Sets(held("items"), similarity) if "items" in sig else None

                def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                    ok = np.bitwise_count(wide[x] ^ wide[y]).sum(axis=1, dtype=np.int64) <= limit
                    if sets:
                        ok[ok] = sets.near(x[ok], y[ok])
                    return ok

            found = bucket_links(col("fp")[many].view(np.uint64), group[many], col("side")[many], radius, near)
        return pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            #: Whole buckets go; the last one of a batch may have more rows in the next.
            last = np.zeros(b.num_rows, bool)
            for c in ("t", "key", "x", "y"):
                v = b.column(c).to_numpy()
                last |= v != v[-1]
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            held.append(b.slice(0, cut) if cut else b)
            if cut:
                yield compare(pa.Table.from_batches(held))
                held = [b.slice(cut)]
        if held:
            yield compare(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def grouped(rows: DataFrame, radius: int, blocks: int | None, tile: int, limit: int = 0) -> DataFrame:
    """doc_id, fp (and wide), component_id. rows: staged doc_id, fp and perhaps wide."""
    sig = [c for c in ("fp", "wide") if c in rows.columns]
    known = rows.where("doc_id is not null")
    distinct = stage(known.groupBy(*sig).agg(F.min("doc_id").alias("node")), "distinct")
    #: An id with several fingerprints is one node; they meet at each fingerprint's smallest id.
    one = F.xxhash64(*sig) if len(sig) > 1 else F.col("fp")
    twice = known.groupBy("doc_id").agg(F.min(one).alias("x"), F.max(one).alias("y")).where("x <> y").select("doc_id")
    joined = known.join(twice, "doc_id", "left_semi").join(distinct, sig).select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    roots = components(links(distinct, radius, blocks, tile, limit).union(joined))
    by_sig = distinct.join(roots, "node", "left").select(*sig, F.coalesce("root", "node").alias("component"))
    out = rows.join(by_sig, sig, "left")
    return out.select("doc_id", *sig, F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def near_duplicates(docs: DataFrame, size: int = WORDS, radius: int = RADIUS, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """doc_id, fp (long), component_id; one row for each input row."""
    return grouped(stage(fingerprints(docs, size), "fingerprints"), radius, blocks, tile)


def similar_documents(docs: DataFrame, similarity: float = SIMILARITY, size: int = SIMILAR_WORDS, radius: int = SIMILAR_RADIUS, blocks: int | None = None, tile: int = TILE) -> DataFrame:
    """doc_id, fp (long), wide (binary), component_id; one row for each input row."""
    return grouped(stage(signatures(docs, size), "signatures"), radius, blocks, tile, wide_limit(similarity))
