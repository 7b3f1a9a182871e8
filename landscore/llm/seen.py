"""Which 64-bit hashes occur more than once, as a Bloom filter of bounded size: never misses one, may name others.

Every task first drops repeats in its own batches (marking them). The hashes are then dealt to segments by their high
bits, and each segment streams through two Bloom filters: what the once-filter already holds goes into the twice-filter.
The once-filter grows by generations as it fills. Only the twice-filters leave the executors; all together they are at
most `most_bytes`, however large the corpus: if repeats are too many for that, more hashes are suspected, and whoever
asks confirms suspects exactly. Segments grow with the planner's estimate of the hashes' bytes, so that the once-filters
of a task stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES, BITS, GENERATION, MOST_BYTES, SEGMENTS, MOST_SEGMENTS, SEGMENT_BYTES = 4, 12, 1 << 17, 64 << 20, 64, 1 << 14, 1 << 28
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)]


def probes(h: np.ndarray, mask: np.ndarray | np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte and bit of each of a hash's places in a filter of mask + 1 bits."""
    a = (h ^ (h >> np.uint64(32))) * _M[0]
    b = ((h * _M[1]) >> np.uint64(17)) | np.uint64(1)
    for i in range(PROBES):
        x = ((a + np.uint64(i) * b) >> np.uint64(9)) & mask
        yield (x >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (x & np.uint64(7)).astype(np.uint8))


class Bloom:
    def __init__(self, bits: int):
        self.mask = np.uint64(bits - 1)
        self.data = np.zeros(bits // 8, np.uint8)

    def add(self, h: np.ndarray) -> None:
        for byte, bit in probes(h, self.mask):
            np.bitwise_or.at(self.data, byte, bit)

    def holds(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for byte, bit in probes(h, self.mask):
            out &= (self.data[byte] & bit) != 0
        return out


class Twice:
    """The twice-filters of all segments, one behind the other, for use on executors."""

    def __init__(self, filters: dict[int, bytes], segments: int):
        self.segments = np.uint64(segments)
        sizes = np.array([len(filters.get(k, bytes(8))) for k in range(segments)], np.int64)
        self.data = np.frombuffer(b"".join(filters.get(k, bytes(8)) for k in range(segments)), np.uint8)
        self.first, self.mask = np.cumsum(sizes) - sizes, (sizes * 8 - 1).astype(np.uint64)

    def holds(self, h: np.ndarray) -> np.ndarray:
        seg = ((h >> np.uint64(32)) % self.segments).astype(np.int64)
        first, out = self.first[seg], np.ones(len(h), bool)
        for byte, bit in probes(h, self.mask[seg]):
            out &= (self.data[first + byte] & bit) != 0
        return out


def power_of_two(n: int) -> int:
    return 1 << max(n - 1, 1).bit_length()


def segments_for(hashes: DataFrame) -> int:
    """SEGMENTS, or more if they would get over SEGMENT_BYTES each; at most MOST_SEGMENTS (also where no size is known)."""
    size = int(str(hashes._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(MOST_SEGMENTS, max(SEGMENTS, size // SEGMENT_BYTES))


def seen_twice(hashes: DataFrame, segments: int | None = None, most_bytes: int = MOST_BYTES):
    """A broadcast variable with Twice's arguments. hashes: h long, twice boolean (seen more than once where it came from)."""
    spark, segments = hashes.sparkSession, segments or segments_for(hashes)
    most_bits = max(64, power_of_two(most_bytes * 8 // segments + 1) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, list] = {}
        again: dict[int, list[np.ndarray]] = {}
        full: dict[int, Bloom] = {}
        for b in batches:
            seg, h, twice = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64), b.column(2).to_numpy(zero_copy_only=False)
            for k in np.unique(seg).tolist():
                at = seg == k
                own, n = np.unique(h[at], return_counts=True)
                known = np.isin(own, h[at & twice]) | (n > 1)
                held = once.setdefault(k, [])
                for f, _ in held:
                    known |= f.holds(own)
                if not held or held[-1][1] >= GENERATION << (len(held) - 1):
                    held.append([Bloom(power_of_two(BITS * GENERATION << len(held))), 0])
                held[-1][0].add(own)
                held[-1][1] += len(own)
                if k in full:
                    full[k].add(own[known])
                    continue
                again.setdefault(k, []).append(own[known])
                if sum(map(len, again[k])) * BITS > 2 * most_bits:
                    again[k] = [np.unique(np.concatenate(again[k]))]
                    if len(again[k][0]) * BITS > most_bits:
                        full[k] = Bloom(most_bits)
                        full[k].add(again.pop(k)[0])
        for k, parts in again.items():
            found = np.unique(np.concatenate(parts))
            full[k] = Bloom(min(most_bits, power_of_two(max(64, BITS * len(found)))))
            full[k].add(found)
        for k, f in full.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([f.data.tobytes()], pa.binary())], ["segment", "filter"])

    seg = (F.shiftrightunsigned("h", 32) % segments).cast("int").alias("segment")
    dealt = hashes.select(seg, "h", "twice").repartition(F.col("segment"))
    #: At most most_bytes in all. One job: toLocalIterator() would build the filters of one partition after the other.
    found = {r["segment"]: bytes(r["filter"]) for r in dealt.mapInArrow(run, "segment int, filter binary").collect()}
    return spark.sparkContext.broadcast((found, segments))


def unique_hashes(parts: list[np.ndarray]) -> pa.RecordBatch:
    """A batch's hashes without repeats: (h, twice)."""
    own, n = np.unique(np.concatenate(parts) if parts else np.empty(0, np.uint64), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n > 1)], ["h", "twice"])
