"""Exact substring dedup: bytes covered by strings of LENGTH bytes that start more than once in the corpus.

Every start of such a string is named by content: the smallest hash of the GRAM-byte strings inside it. Equal strings have
equal names, so strings only need to be compared within a name; a run of starts with one name is a region, its starts and
the LENGTH - 1 bytes behind them. Names seen once (Bloom filters, seen.py) are settled. The regions of the others go to
the name's shard, equal ones as one row with a count (in which all starts repeat if the count is above one); the shard's
different regions are compared by a suffix array:

* suffixes are classified as L or S, leftmost-S (LMS) substrings are sorted by inducing, named, and, if names repeat, the
  reduced string of names is sorted first, by the same function while it has few names and else by rank doubling; then all
  suffixes are induced. Inducing takes a bucket's entries as vectors in the order of the linear scan.
* the permuted longest common prefixes are computed for irreducible positions and carried on along the text
  (PLCP[i] = PLCP[i - 1] - 1 elsewhere); a start repeats if it has LENGTH bytes in common with a neighbour.

A name with more than MOST_REGIONS different regions, or more than MOST_CONTENT bytes of them (one passage in a large part
of all documents, each in another context; periodic text), isn't given to one task, which holds some 90 bytes for each byte:
its starts are dealt out one by one, by a digest of their LENGTH bytes, and counted.

Defined cases: null text is empty; texts under LENGTH bytes lose nothing and match nothing; each row is a document of its
own, so repeated rows remove each other's long enough texts; a null doc_id is returned as null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, sized, stage
from .seen import Twice, seen_twice, unique_hashes

LENGTH, GRAM, BLOCK, MOST_STARTS, MOST_REGIONS, MOST_CONTENT, SHARD_BYTES = 200, 64, 1 << 20, 2048, 20_000, 5 << 20, 1 << 20
_C = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def words_at(a: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one little-endian number; zeros behind the end."""
    buf = np.zeros(len(a) + 8, np.uint8)
    buf[: len(a)] = a
    return np.ndarray((len(a),), "<u8", buf, strides=(1,))


def gram_hashes(a: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the `gram` (8 times a power of two) bytes from each position that has so many."""
    h = words_at(a)[: max(0, len(a) - 7)] * _C[0]
    h ^= h >> np.uint64(29)
    size = 8
    while size < gram:
        m = len(h) - size
        if m <= 0:
            return np.empty(0, np.uint64)
        h = (h[:m] * _C[1 + (size >> 4) % 3]) ^ (h[size:] >> np.uint64(3))
        h *= _C[0]
        h ^= h >> np.uint64(31)
        size *= 2
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m = len(h) - width + 1
    if m <= 0:
        return np.empty(0, h.dtype)
    rows = np.concatenate([h, np.full(-len(h) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])


def regions(a: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of a text's bytes: names, first starts and ends (exclusive) of the regions' starts, and names that may
    repeat inside one region: the smallest hash stands at several places, as in periodic text."""
    width = length - gram + 1
    for at in range(0, max(0, len(a) - length + 1), BLOCK):
        h = gram_hashes(a[at : at + BLOCK + length - 1], gram)
        name = sliding_min(h, width)
        new = np.ones(len(name), bool)
        new[1:] = name[1:] != name[:-1]
        new[::MOST_STARTS] = True
        first = np.flatnonzero(new)
        ends = np.full(width - 1, ~np.uint64(0))
        #: A place's hash is smallest in some window if it equals the largest name of the windows over it.
        chosen, times = np.unique(h[~sliding_min(np.concatenate([ends, ~name, ends]), width) == h], return_counts=True)
        yield name[first], at + first, at + np.append(first[1:], len(name)), chosen[times > 1]


def induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The suffix array from seeds (LMS positions in the order wanted within their symbols). t: symbols, 0 ends a string;
    small: S type; heads: where each symbol's bucket begins, and the end. Bucket 0 keeps the order of positions."""
    n, k = len(t), len(heads) - 1
    sa = np.full(n, -1, np.int64)
    by = seeds[np.argsort(t[seeds], kind="stable")]
    first = np.searchsorted(t[by], np.arange(k + 1))
    ends = np.flatnonzero(t == 0)
    sa[: heads[1]] = ends
    point = heads[:-1].copy()

    def put(j: np.ndarray, step: int) -> None:
        c = t[j]
        order = np.argsort(c, kind="stable")
        c, j = c[order], j[order]
        cut = np.flatnonzero(np.diff(c)) + 1
        start = np.concatenate([[0], cut])
        size = np.diff(np.append(start, len(c)))
        inner = np.arange(len(c)) - np.repeat(start, size)
        sa[point[c] + step * inner] = j
        point[c[start]] += step * size

    for c in range(k):
        p = int(heads[c])
        while c and p < point[c]:
            q = int(point[c])
            j = sa[p:q] - 1
            p = q
            j = j[j >= 0]
            j = j[~small[j]]
            if len(j):
                put(j, 1)
        j = (ends if c == 0 else by[first[c] : first[c + 1]]) - 1
        j = j[j >= 0]
        j = j[~small[j]]
        if len(j):
            put(j, 1)
    large_end = point.copy()
    point = heads[1:] - 1
    for c in range(k - 1, 0, -1):
        p = int(heads[c + 1]) - 1
        while p > point[c]:
            q = int(point[c])
            j = sa[q + 1 : p + 1][::-1] - 1
            p = q
            j = j[j >= 0]
            j = j[small[j] & (t[j] > 0)]
            if len(j):
                put(j, -1)
        j = sa[heads[c] : large_end[c]][::-1] - 1
        j = j[j >= 0]
        j = j[small[j] & (t[j] > 0)]
        if len(j):
            put(j, -1)
    return sa


def doubled(r: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names (0, 1, ... without gaps) that ends with one found nowhere else in it. A
    rank is the number of smaller suffixes; only places that still share theirs are sorted again, by the rank `step` on."""
    counts = np.bincount(r)
    rank, step = (np.cumsum(counts) - counts)[r], 1
    todo = np.flatnonzero(counts[r] > 1)
    while len(todo):
        key = rank[todo] * (len(r) + 1) + rank[todo + step]
        order = np.argsort(key)
        todo, key = todo[order], key[order]
        own = rank[todo]
        place = np.arange(len(todo))
        group = np.maximum.accumulate(np.where(np.append(True, own[1:] != own[:-1]), place, 0))
        new = np.append(True, key[1:] != key[:-1])
        part = np.maximum.accumulate(np.where(new, place, 0))
        rank[todo] = own + part - group
        todo = todo[~(new & np.append(new[1:], True))]
        step *= 2
    out = np.empty(len(r), np.int64)
    out[rank] = np.arange(len(r))
    return out


def suffix_array(t: np.ndarray, few: int = 512) -> np.ndarray:
    """Order of all suffixes of t (numbers; 0 ends each string and is smaller than all else, the earlier the smaller; the
    last is 0)."""
    n = len(t)
    up = np.zeros(n, np.int8)
    up[:-1] = np.sign(t[1:].astype(np.int32) - t[:-1])
    #: A run of equal symbols has the type of its last.
    other = np.minimum.accumulate(np.where(up != 0, np.arange(n), n - 1)[::-1])[::-1]
    small = up[other] > 0
    small[t == 0] = True
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    heads = np.concatenate([[0], np.cumsum(np.bincount(t))])
    sa = induce(t, small, lms, heads)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = sa[is_lms[sa]]
    #: Names of LMS substrings (up to the next LMS position, inclusive). One that holds an end is like no other.
    size = np.zeros(n, np.int64)
    size[lms] = np.diff(np.append(lms, n - 1)) + 1
    last = lms + size[lms] - 1
    ended = np.zeros(n, bool)
    ended[lms] = (t[lms] == 0) | (t[np.minimum(last, n - 1)] == 0)
    a, b = sorted_lms[:-1], sorted_lms[1:]
    same = (size[a] == size[b]) & ~ended[a] & ~ended[b]
    at, k = np.flatnonzero(same), 0
    while len(at):
        eq = t[a[at] + k] == t[b[at] + k]
        same[at[~eq]] = False
        k += 1
        at = at[eq]
        at = at[size[a[at]] > k]
    name = np.empty(n, np.int64)
    name[sorted_lms] = np.concatenate([[0], np.cumsum(~same)])
    reduced = name[lms]
    names = int(reduced.max()) + 1
    if names < len(lms):
        #: The last LMS position is the final end, whose name is its own.
        if names <= few and len(lms) > 4 * few and reduced[-1] == 0 and np.count_nonzero(reduced == 0) == 1:
            order = suffix_array(reduced.astype(np.uint16), few)
        else:
            order = doubled(reduced)
        sorted_lms = lms[order]
    return induce(t, small, sorted_lms, heads)


def common_prefixes(a: np.ndarray, left: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """PLCP and each suffix's predecessor in the suffix array (-1: none). a: bytes; left: bytes to the end of the string."""
    n = len(a)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    #: Reducible: the bytes in front are the same and belong to the same strings.
    plain = (before > 0) & (i > 0)
    p, q = i[plain] - 1, before[plain] - 1
    plain[plain] = (a[p] == a[q]) & (left[p] > 0) & (left[q] > 0)
    at = np.flatnonzero(~plain & (before >= 0))
    plcp, word = np.zeros(n, np.int64), words_at(a)
    x, y = at, before[at]
    most, have = np.minimum(left[x], left[y]), np.zeros(len(at), np.int64)
    todo = np.flatnonzero(most > 0)
    while len(todo):
        diff = word[x[todo] + have[todo]] ^ word[y[todo] + have[todo]]
        end = diff != 0
        low = diff[end] & (~diff[end] + np.uint64(1))
        have[todo[end]] += (np.log2(low.astype(np.float64)).astype(np.int64)) >> 3
        todo = todo[~end]
        have[todo] += 8
        todo = todo[have[todo] < most[todo]]
    plcp[at] = np.minimum(have, most)
    source = np.maximum.accumulate(np.where(plain, 0, i))
    return np.maximum(plcp[source] - (i - source), 0), before


def repeated_starts(strings: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each string the positions whose `length` bytes start somewhere else in the strings too."""
    sizes = np.array([len(s) for s in strings])
    a = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    left = np.repeat(ends, sizes + 1) - np.arange(len(a))
    t = a.astype(np.uint16) + np.uint16(1)
    t[ends] = 0
    sa = suffix_array(t)
    plcp, before = common_prefixes(a, left, sa)
    hit = np.zeros(len(a), bool)
    at = np.flatnonzero(plcp >= length)
    hit[at] = True
    hit[before[at]] = True
    return [np.flatnonzero(hit[e - s : e]) for s, e in zip(sizes, ends, strict=True)]


def runs(at: np.ndarray) -> list[int]:
    """Sorted positions as [first, end, first, end, ...]."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > 1)
    return np.stack([at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + 1], 1).ravel().tolist()


def name_hashes(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = (np.frombuffer(t.encode("utf-8", "surrogatepass"), np.uint8) for t in b.column(0).to_pylist())
            yield unique_hashes([x for a in texts for name, _, _, again in regions(a, length, gram) for x in (name, again)])

    return docs.select("text").where(F.octet_length("text") >= length).mapInArrow(run, "h long, twice boolean")


def suspect_regions(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """name, d1, d2 (digest), did, rk, first, starts, content (once in a batch): regions whose names may repeat."""
    twice = seen_twice(name_hashes(docs, length, gram))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        seen, two = Twice(*twice.value), struct.Struct("<qq")
        for b in batches:
            out: list[tuple] = []
            had: set[tuple[int, bytes]] = set()
            for i, rk, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                for name, first, end, _ in regions(np.frombuffer(data, np.uint8), length, gram):
                    ok = seen.holds(name)
                    for m, x, y in zip(name[ok].view(np.int64).tolist(), first[ok].tolist(), end[ok].tolist(), strict=True):
                        content = data[x : y + length - 1]
                        d = (m, xxh3_128_digest(content))
                        out.append((m, *two.unpack(d[1]), i, rk, x, y - x, None if d in had else content))
                        had.add(d)
            cols = list(zip(*out, strict=True)) or [[]] * 8
            kinds = [pa.int64()] * 6 + [pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["name", "d1", "d2", "did", "rk", "first", "starts", "content"])

    did, rk = row_key(F.col("doc_id"), F.col("text"))
    rows = docs.where(F.octet_length("text") >= length).select(did.alias("did"), rk.alias("rk"), "text")
    return stage(rows.mapInArrow(run, "name long, d1 long, d2 long, did long, rk long, first long, starts int, content binary"), "regions")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_regions: int = MOST_REGIONS) -> DataFrame:
    """did, rk, spans (array of first, end, first, end ... of bytes that go) of the rows that lose bytes."""
    found = suspect_regions(docs, length, gram)
    distinct = stage(found.groupBy("name", "d1", "d2").agg(F.count("*").alias("n"), F.max("content").alias("content")), "distinct_regions")
    per_name = distinct.groupBy("name").agg(F.count("*").alias("k"), F.sum(F.octet_length("content")).alias("size"))
    hot = stage(per_name.where((F.col("k") > most_regions) | (F.col("size") > MOST_CONTENT)).select("name"), "hot_names")
    some_hot = hot.limit(1).count() > 0
    cool = distinct.join(sized(hot), "name", "left_anti") if some_hot else distinct

    def sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []
        ready: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            marks = repeated_starts([r[4] for r in held], length) if held else []
            spans = [[0, len(r[4]) - length + 1] if r[3] > 1 else runs(m) for r, m in zip(held, marks, strict=True)]
            keep = ready + [(r[0], r[1], r[2], s) for r, s in zip(held, spans, strict=True) if s]
            held.clear()
            ready.clear()
            cols = list(zip(*keep, strict=True)) or [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], ["name", "d1", "d2", "at"])

        def settle() -> Iterator[pa.RecordBatch]:
            nonlocal size
            if len(group) == 1 and group[0][3] > 1:
                name, d1, d2, _, content = group[0]
                ready.append((name, d1, d2, [0, len(content) - length + 1]))
            else:
                held.extend(group)
                size += sum(len(r[4]) for r in group)
            group.clear()
            if size >= SHARD_BYTES or len(ready) >= 1 << 15:
                yield flush()
                size = 0

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if group and r[0] != group[0][0]:
                    yield from settle()
                group.append(r)
        yield from settle() if group else ()
        yield flush()

    dealt = cool.select("name", "d1", "d2", "n", "content").repartition("name").sortWithinPartitions("name")
    marks = dealt.mapInArrow(sharded, "name long, d1 long, d2 long, at array<int>")
    if some_hot:
        marks = marks.union(one_by_one(distinct.join(sized(hot), "name", "left_semi"), length))
    marks = stage(marks, "repeated")
    shift = lambda x, i: F.col("first") + x + F.when(i % 2 == 1, length - 1).otherwise(0)
    spans = found.select("name", "d1", "d2", "did", "rk", "first").join(marks, ["name", "d1", "d2"]).select("did", "rk", F.transform("at", shift).alias("spans"))
    return spans.groupBy("did", "rk").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def one_by_one(distinct: DataFrame, length: int) -> DataFrame:
    """The same for names with too many regions: every start by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for b in batches:
            for name, d1, d2, n, content in zip(*(c.to_pylist() for c in b.columns), strict=True):
                k = len(content) - length + 1
                w = np.frombuffer(b"".join(xxh3_128_digest(content[i : i + length]) for i in range(k)), np.int64).reshape(-1, 2)
                same = [pa.array(np.full(k, v, np.int64)) for v in (name, d1, d2, n)]
                yield pa.RecordBatch.from_arrays([*same, pa.array(np.arange(k, dtype=np.int32)), pa.array(w[:, 0]), pa.array(w[:, 1])], ["name", "d1", "d2", "n", "i", "w1", "w2"])

    each = distinct.select("name", "d1", "d2", "n", "content").mapInArrow(run, "name long, d1 long, d2 long, n long, i int, w1 long, w2 long")
    many = each.groupBy("w1", "w2").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("w1", "w2")
    return each.join(many, ["w1", "w2"], "left_semi").select("name", "d1", "d2", F.array(F.col("i"), F.col("i") + 1).alias("at"))


def dedup_substrings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most_regions: int = MOST_REGIONS) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (maximal removed runs: first, end, ...), kept (binary); one row for each input row."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(base, length, gram, most_regions)
    did, rk = row_key(F.col("doc_id"), F.col("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_bytes, n_removed, gone, kept = [], [], [], []
            for text, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                at: list[int] = []
                for x, y in sorted(zip(s[::2], s[1::2], strict=True)) if s else ():
                    if at and x <= at[-1]:
                        at[-1] = max(at[-1], y)
                    else:
                        at += [x, y]
                n_bytes.append(len(data))
                n_removed.append(sum(at[1::2]) - sum(at[::2]))
                gone.append(at)
                kept.append(b"".join(data[x:y] for x, y in zip([0, *at[1::2]], [*at[::2], len(data)], strict=True)))
            arrays = [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(gone, pa.list_(pa.int64())), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    rows = base.select("doc_id", "text", did.alias("did"), rk.alias("rk")).join(spans, ["did", "rk"], "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, spans array<long>, kept binary")


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
