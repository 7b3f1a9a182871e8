"""Line dedup: lines that occur in several documents stay only in the one with the smallest doc_id.

Texts are cut at \\n; a key is the line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z in lower case. Keys shorter than
`least` code points never count. Hashes of keys pass the once-seen and twice-seen Bloom filters (seen.py); only lines that
the twice-filter suspects are shuffled, aggregated by their whole key (a very common line is pre-aggregated) and joined
back. The decisions are line numbers, joined to the documents by id.

Defined cases: null or empty text is one empty line (kept text empty); rows that repeat a doc_id are one document for the
count of documents, and each keeps its own text (lines of the smallest id stay in all its rows); a null doc_id takes no
part, its lines stay; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, stage
from .seen import Twice, seen_twice, unique_hashes

BLANK, LEAST = " \t\n\x0b\x0c\r", 10


def keys(text: str) -> list[bytes]:
    """The key of each line."""
    return [k.strip(BLANK).encode("utf-8", "surrogatepass").lower() for k in text.split("\n")]


def long_keys(text: str, least: int = LEAST) -> dict[bytes, list[int]]:
    """The line numbers of each key that counts."""
    out: dict[bytes, list[int]] = {}
    for i, k in enumerate(keys(text)):
        if len(k) >= least and (len(k) >= 4 * least or len(k.decode("utf-8", "surrogatepass")) >= least):
            out.setdefault(k, []).append(i)
    return out


def line_hashes(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """h, twice: hashes of the keys, once for each batch of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for b in batches:
            ids, parts, held = b.column(0).to_pylist(), [], {}
            for i, t in zip(ids, b.column(1).to_pylist(), strict=True):
                held.setdefault(i, set()).update(xxh3_64_intdigest(k) for k in long_keys(t, least))
            parts = [np.fromiter(s, np.uint64, len(s)) for s in held.values()]
            yield unique_hashes(parts)

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(run, "h long, twice boolean")


def repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, rk, drop (line numbers) of the rows that lose lines."""
    twice = seen_twice(line_hashes(docs, least))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        seen = Twice(*twice.value)
        for b in batches:
            out: list[tuple] = []
            for i, rk, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held = long_keys(t, least)
                h = np.fromiter((xxh3_64_intdigest(k) for k in held), np.uint64, len(held))
                out += [(i, rk, *x) for x, ok in zip(held.items(), seen.holds(h), strict=True) if ok]
            cols = list(zip(*out, strict=True)) or [[], [], [], []]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "rk", "key", "at"])

    rows = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("doc_id", "text").alias("rk"), "text")
    found = stage(rows.mapInArrow(suspects, "doc_id long, rk long, key binary, at array<int>"), "suspects")
    first = found.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("key", "first")
    first = stage(first, "firsts")  # then both sides of the join are dealt out for it, and a common line's can be split
    drops = found.join(first, "key").where("doc_id > first")
    return drops.groupBy("doc_id", "rk").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("drop"))


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the text that stays); one row for each input row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    did, rk = row_key(F.col("doc_id"), F.col("text"))
    drops = repeated_lines(base, least).select(F.col("doc_id").alias("did"), "rk", "drop")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_lines, n_dropped, kept = [], [], []
            for t, drop in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                lines = (t or "").split("\n")
                gone = set(drop or ())
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else t or "")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    rows = base.select("doc_id", "text", did.alias("did"), rk.alias("rk")).join(drops, ["did", "rk"], "left").select("doc_id", "text", "drop")
    return rows.mapInArrow(apply, "doc_id long, n_lines long, n_dropped long, kept string")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
