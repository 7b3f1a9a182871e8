"""Exact top-k by integer inner product: a KD-tree for each shard, searched best first with bounds of tight boxes.

Components become floor(scale * x), kept in one or two bytes each where they fit. Shards hold about SHARD vectors, chosen by a
hash of the row. A tree has median splits of the widest side down to leaves of LEAF vectors, each with its tight box; it is
built once. A task holds the trees of one group of shards and streams blocks of queries past them: a leaf is opened for a
query only while its box's upper bound of the inner product can still reach the query's k-th score so far, leaves in falling
order of bound, and that score goes on from shard to shard. The best leaf is opened alone, then twice as many a turn; where
one in DENSE or more of all leaves can still be reached, they are multiplied at once. Every query first meets its own group,
and starts on the other groups with its k-th score there. A group's trees are sent once for at most PART blocks of queries,
not for each block; groups times parts make some UNITS tasks a core.

Products are exact for any finite components: no sum of a part of a product's terms is larger than the product of both norms,
so they are taken in 32-bit floats where that is below 2**24, in 64-bit floats below 2**53; beyond, in 64-bit integers where
no sum can reach 2**63, else in Python's integers. A row's tree is one of its order of magnitude, so a single huge vector
doesn't slow down its shard.

Where boxes prune little (many even dimensions) the work is the number of queries times the number of vectors.

Defined cases: vectors that are null, or hold a null, NaN or infinity, take no part; a missing tail counts as zeros, so
vectors of different lengths have a score (an empty one scores 0); rows that share an id are candidates and queries of their
own, each query leaves out its own row only; null ids take no part; scores beyond a long's range are ranked exactly and
returned as the nearest long; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from .common import stage

#: SCALE is a power of two, so scaling loses no digit. MAGNITUDES: where a row's largest component puts it into another tree.
K, SCALE, SHARD, LEAF, GROUP, PART, MAGNITUDES = 20, 64, 8192, 256, 8, 256, (2.0**20, 2.0**28)
LONG = (-(2**63), 2**63 - 1)
#: DENSE: see above. CHUNK: vectors multiplied at once. PENDING: candidates a query may have waiting. UNITS: tasks a core.
DENSE, CHUNK, PENDING, UNITS = 4, 1024, 8, 4
_NONE = {"f": -np.inf, "i": LONG[0], "O": -(1 << 4200)}


def floored(v: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x) / scale."""
    big = np.abs(v) >= 2.0**53
    return np.where(big, v, np.floor(np.where(big, 0.0, v) * scale) / scale)


def narrowed(batches: Iterator[pa.RecordBatch], scale: float = SCALE) -> Iterator[pa.RecordBatch]:
    """Rows of finite components as ROW: those whose scaled components fit into one byte each (kind b) or two (h) as such, others
    as floats that are not scaled (d)."""
    for b in batches:
        lengths = b.column("embedding").value_lengths().to_numpy().astype(np.int64)
        v = b.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # nulls are NaN
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(v))])
        ends = np.cumsum(lengths)
        good = bad[ends] == bad[ends - lengths]
        v, lengths = floored(v[np.repeat(good, lengths)], scale), lengths[good]
        top = np.zeros(len(lengths))
        if len(v):
            with np.errstate(over="ignore"):
                top[lengths > 0] = np.maximum.reduceat(np.abs(v) * scale, (np.cumsum(lengths) - lengths)[lengths > 0])
        b = b.select(["row", "vec_id", "is_query"]).filter(pa.array(good))
        kind = np.where(top <= 127, "b", np.where(top <= 32767, "h", "d"))
        for c in np.unique(kind):
            own = kind == c
            x = v[np.repeat(own, lengths)]
            x = x if c == "d" else (x * scale).astype(f"i{'bh'.index(c) + 1}")
            begins = np.concatenate([[0], np.cumsum(lengths[own] * x.itemsize)]).astype(np.int32)
            x = pa.Array.from_buffers(pa.binary(), int(own.sum()), [None, pa.py_buffer(begins), pa.py_buffer(x)])
            some = b.filter(pa.array(own))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array([c] * len(x)), x], ["row", "vec_id", "is_query", "kind", "x"])


def together(vectors: list[bytes], kind: str) -> np.ndarray:
    """A row for each vector, zeros behind its end."""
    sizes, form = {len(v) for v in vectors}, FORM[kind]
    if len(sizes) == 1:
        return np.frombuffer(b"".join(vectors), form).reshape(len(vectors), -1)
    out = np.zeros((len(vectors), max(sizes, default=0) // form.itemsize), form)
    for i, v in enumerate(vectors):
        out[i, : len(v) // form.itemsize] = np.frombuffer(v, form)
    return out


class Rows:
    """Vectors of a kind (see narrowed)."""

    def __init__(self, kind: str, x: np.ndarray, scale: float):
        self.kind, self.x, self.scale, self.held = kind, x, scale, {}
        with np.errstate(over="ignore"):
            whole = self.scaled(np.float64)
            #: A bound of the norms, 1 at least.
            self.norm = max(1.0, float(np.sqrt(np.einsum("ij,ij->i", whole, whole).max(initial=0.0)))) * (1 + 1e-6)

    def plain(self) -> np.ndarray:
        """As floats that are not scaled."""
        return self.x if self.kind == "d" else self.x / self.scale

    def scaled(self, form: type) -> np.ndarray:
        return (self.x * self.scale if self.kind == "d" else self.x).astype(form)

    def kept(self, form: type) -> np.ndarray:
        """scaled(), computed once."""
        if form not in self.held:
            self.held[form] = self.scaled(form)
        return self.held[form]


def largest(x: np.ndarray, scale: float) -> int:
    """The largest component, scaled, without sign."""
    return int(np.abs(x).max(initial=0.0)) * int(scale) + int(scale)


def products(q: np.ndarray, x: np.ndarray, scale: float) -> np.ndarray:
    """Exact inner products of rows of scaled components."""
    most = largest(q, scale) * largest(x, scale) * max(1, q.shape[1])
    if most < 2**53:
        return (q * scale) @ (x * scale).T
    if most < 2**63:
        return (q * scale).astype(np.int64) @ (x * scale).astype(np.int64).T
    whole = lambda m: np.array([int(v) * int(scale) if abs(v) >= 2**53 else int(v * scale) for v in m.ravel().tolist()], object).reshape(m.shape)
    return np.dot(whole(q), whole(x).T).astype(object)


def widened(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1]))) if m.shape[1] < width else m


def as_floats(scores: np.ndarray) -> np.ndarray:
    """Scores as floats that are not larger."""
    if scores.dtype.kind == "f":
        return scores
    if scores.dtype.kind == "i":
        return np.where(scores == LONG[0], -np.inf, np.nextafter(scores.astype(np.float64), -np.inf))
    out = np.full(scores.shape, -np.inf)
    for i, s in np.ndenumerate(scores):
        out[i] = -np.inf if s < -(2**1000) else np.nextafter(float(min(s, 2**1000)), -np.inf)
    return out


def places(mask: np.ndarray) -> np.ndarray:
    """np.flatnonzero of a mask that holds little, eight at a time."""
    if mask.size % 8:
        return np.flatnonzero(mask)
    eights = mask.reshape(-1, 8)
    some = np.flatnonzero(eights.view(np.uint64))
    i, j = np.nonzero(eights[some])
    return some[i] * 8 + j


class Best:
    """The k best of some queries so far: ids and scores by falling score, ties by smaller id."""

    def __init__(self, rows: np.ndarray, q: Rows, k: int, least: np.ndarray):
        self.rows, self.q, self.k, self.least = rows, q, k, least.copy()
        self.ids, self.scores = np.full((len(rows), k), -1, np.int64), np.full((len(rows), k), -np.inf)
        self.pending, self.waiting = [], 0

    def meet(self, at: np.ndarray, ids: np.ndarray, rows: np.ndarray, new: np.ndarray) -> None:
        """Candidates' scores, floats, for the queries at some places; only those that reach the k-th score wait for settle()."""
        with np.errstate(over="ignore"):
            least = self.least[at].astype(new.dtype)
        hit = places(new >= least[:, None])
        if not len(hit):
            return
        i, j = np.divmod(hit, new.shape[1])
        i, score = at[i], new.ravel()[hit].astype(np.float64)
        ok = (rows[j] != self.rows[i]) & (score > -np.inf)
        if self.scores.dtype.kind == "f":  # of ties, the smaller id
            ok &= (score > self.scores[i, -1]) | (ids[j] < self.ids[i, -1])
        if not ok.any():
            return
        self.pending.append((i[ok], ids[j[ok]], score[ok]))
        self.waiting += int(ok.sum())

    def settle(self) -> None:
        """What waits joins the k best."""
        if not self.pending:
            return
        i, ids, new = (np.concatenate(p) for p in zip(*self.pending, strict=True))
        self.pending, self.waiting = [], 0
        if self.scores.dtype.kind != "f":
            self.fit("i")
            for at in np.unique(i):
                own = i == at
                scores = new[own].astype(np.int64).astype(self.scores.dtype)
                self.put(np.array([at]), ids[None, own], scores[None])
            return
        one, place = np.nonzero(self.there())
        i, ids, new = np.concatenate([one, i]), np.concatenate([self.ids[one, place], ids]), np.concatenate([self.scores[one, place], new])
        order = np.lexsort((ids, -new, i))
        i, ids, new = i[order], ids[order], new[order]
        place = np.arange(len(i)) - np.searchsorted(i, np.arange(len(self.rows)))[i]
        ok = place < self.k
        self.ids[i[ok], place[ok]], self.scores[i[ok], place[ok]] = ids[ok], new[ok]
        self.least = np.maximum(self.least, self.scores[:, -1])

    def there(self) -> np.ndarray:
        """Where a score is; an id may be any number."""
        return self.scores != _NONE[self.scores.dtype.kind]

    def fit(self, kind: str) -> None:
        """Scores of a kind that holds those to come."""
        if "fiO".index(kind) > "fiO".index(self.scores.dtype.kind):
            none = ~self.there()
            whole = np.where(none, 0, self.scores)
            self.scores = whole.astype(np.int64) if kind == "i" else np.array([int(v) for v in whole.ravel().tolist()], object).reshape(whole.shape)
            self.scores[none] = _NONE[kind]

    def take(self, at: np.ndarray, ids: np.ndarray, rows: np.ndarray, new: np.ndarray) -> None:
        """Candidates' scores for the queries at some places."""
        self.fit(new.dtype.kind)
        kind = self.scores.dtype.kind
        new = np.where(rows[None, :] == self.rows[at][:, None], _NONE[kind], new.astype(self.scores.dtype))
        ids = np.broadcast_to(ids, new.shape)
        if kind != "O":
            #: Only what reaches the k-th score can change anything: so many of each row at most.
            reach = (new >= self.least[at][:, None]).sum(1)
            at, new, ids, most = at[reach > 0], new[reach > 0], ids[reach > 0], int(reach.max(initial=0))
            if not most:
                return
            if most < new.shape[1]:
                some = np.argpartition(new, new.shape[1] - most, axis=1)[:, -most:]
                new, ids = np.take_along_axis(new, some, 1), np.take_along_axis(ids, some, 1)
        self.put(at, ids, new)

    def put(self, at: np.ndarray, ids: np.ndarray, new: np.ndarray) -> None:
        """Candidates, a row for each of some queries, join their k best."""
        kind = self.scores.dtype.kind
        all_i, all_s = np.concatenate([self.ids[at], ids], 1), np.concatenate([self.scores[at], new], 1)
        if kind == "O":
            order = np.array([sorted(range(len(s)), key=lambda j: (-s[j], i[j]))[: self.k] for s, i in zip(all_s, all_i, strict=True)]).reshape(len(at), -1)
        else:
            order = np.lexsort((all_i, -all_s if kind == "f" else ~all_s), axis=1)[:, : self.k]
        self.scores[at], self.ids[at] = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_i, order, 1)
        self.ids[at] = np.where(self.scores[at] == _NONE[kind], -1, self.ids[at])
        self.least[at] = np.maximum(self.least[at], as_floats(self.scores[at][:, self.k - 1]))


def leaves(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """A KD-tree's leaves: the vectors in order of leaf, and where leaves end."""
    x = x.astype(np.int32) if x.dtype.kind == "i" else x
    order, ends, todo = [np.empty(0, int)], [], [np.arange(len(x))]
    while todo:
        own = todo.pop()
        if len(own) > leaf:
            part = x[own]
            side = int(np.argmax(part.max(0) - part.min(0))) if x.shape[1] else 0
            ranked = np.argsort(part[:, side], kind="stable") if x.shape[1] else np.arange(len(own))
            half = len(own) // 2
            todo += [own[ranked[half:]], own[ranked[:half]]]
        elif len(own):
            order.append(own)
            ends.append(len(own))
    return np.concatenate(order), np.cumsum(ends, dtype=np.int64)


class Tree:
    """Leaves of a KD-tree: vectors in order of leaf, where leaves begin, and their boxes."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, x: Rows, ends: np.ndarray):
        self.ids, self.rows, self.x, self.ends = ids, rows, x, ends
        self.starts = np.concatenate([[0], ends[:-1]]).astype(int)
        self.low, self.high = (Rows(x.kind, f.reduceat(x.x, self.starts, axis=0), x.scale) for f in (np.minimum, np.maximum))

    def search(self, best: Best, scale: float = SCALE) -> None:
        """Leaves in falling order of their bounds, as long as those can reach a query's k-th score."""
        most = best.q.norm * self.x.norm
        if not most < 2.0**53:
            best.settle()
            return self.search_large(best, scale)
        form = np.float32 if most < 2.0**24 else np.float64
        width = max(best.q.x.shape[1], self.x.x.shape[1])
        of = lambda r, form: widened(r.kept(form), width)
        q, low, high = (of(r, np.float64) for r in (best.q, self.low, self.high))
        bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        #: What rounding can have taken off.
        bound += 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T)
        q, x = of(best.q, form), of(self.x, form)
        first = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, first, 1)
        begun, step = 0, 1
        while begun < len(self.ends):
            reach = (bound >= best.least[:, None]).sum(1)  # a tie may still win by its id
            left = np.maximum(reach - begun, 0)
            if not left.any():
                break
            if DENSE * left.sum() >= bound.size and (begun or best.least.min() > -np.inf):
                self.search_dense(best, q, x, first, begun, reach)
                break
            end = min(begun + step, len(self.ends))
            turn = np.where(np.arange(begun, end) < reach[:, None], first[:, begun:end], -1)
            for at in np.unique(turn[turn >= 0]):
                own, a, b = np.flatnonzero((turn == at).any(1)), self.starts[at], self.ends[at]
                best.meet(own, self.ids[a:b], self.rows[a:b], q[own] @ x[a:b].T)
            best.settle()
            begun, step = end, 2 * step

    def search_dense(self, best: Best, q: np.ndarray, x: np.ndarray, first: np.ndarray, begun: int, reach: np.ndarray) -> None:
        """All leaves that can be reached and were not opened, for all queries at once."""
        own = np.flatnonzero(reach > begun)
        #: Leaves that were opened are left out, so no candidate comes twice.
        opened = np.zeros((len(own), len(self.ends)), bool)
        np.put_along_axis(opened, first[own, :begun], True, 1)
        q = q if len(own) == len(q) else q[own]
        room = np.empty(len(own) * CHUNK, q.dtype)
        for a in range(0, len(x), CHUNK):
            b = min(a + CHUNK, len(x))
            new = np.matmul(q, x[a:b].T, out=room[: len(own) * (b - a)].reshape(len(own), b - a))
            if begun:
                for at in range(int(np.searchsorted(self.ends, a, "right")), int(np.searchsorted(self.starts, b))):
                    new[np.flatnonzero(opened[:, at]), max(0, self.starts[at] - a) : self.ends[at] - a] = -np.inf
            best.meet(own, self.ids[a:b], self.rows[a:b], new)
            if best.waiting > PENDING * len(best.rows):
                best.settle()

    def search_large(self, best: Best, scale: float) -> None:
        """The same where products are beyond floats, a leaf a turn."""
        q, x, low, high = best.q.plain(), self.x.plain(), self.low.plain(), self.high.plain()
        width = max(q.shape[1], x.shape[1])
        q, x, low, high = (widened(m, width) for m in (q, x, low, high))
        with np.errstate(over="ignore", invalid="ignore"):
            bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
            #: What rounding can have taken off; a sum beyond floats bounds nothing.
            bound += 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T)
            bound = np.where(np.isnan(bound), np.inf, bound) * (scale * scale)
        first = np.argsort(-bound, axis=1, kind="stable")
        alive = np.arange(len(q)) if len(self.ends) else np.empty(0, int)
        for turn in range(len(self.ends)):
            leaf = first[alive, turn]
            alive = alive[bound[alive, leaf] >= best.least[alive]]  # a tie may still win by its id
            if not len(alive):
                break
            leaf = first[alive, turn]
            for at in np.unique(leaf):
                own, a, b = alive[leaf == at], self.starts[at], self.ends[at]
                best.take(own, self.ids[a:b], self.rows[a:b], products(q[own], x[a:b], scale))


def packed(m: np.ndarray) -> bytes:
    return np.ascontiguousarray(m).tobytes()


KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
FORM = {"b": np.dtype(np.int8), "h": np.dtype(np.int16), "d": np.dtype(np.float64)}
ROW = "row long, vec_id long, is_query boolean, kind string, x binary"
#: Vectors of a shard, of one kind and order of magnitude (block: the number of these), as a tree or as queries.
BLOCK = "shard int, block long, kind string, n long, ids binary, rows binary, x binary, ends binary, least binary"


def blocks(pdf: pd.DataFrame, leaf: int, scale: float) -> pd.DataFrame:
    """A shard's vectors as a tree for each kind and order of magnitude, its queries as further rows."""
    pdf, shard, out = pdf.sort_values("row", kind="stable"), int(pdf["shard"].iloc[0]), []
    for number, kind in enumerate(FORM):
        own = pdf[pdf["kind"] == kind]
        if own.empty:
            continue
        x = together(own["x"].tolist(), kind)
        size = np.searchsorted(np.array(MAGNITUDES) / scale, np.abs(x).max(1, initial=0.0), "right") if kind == "d" else np.zeros(len(x), int)
        for m in np.unique(size):
            order, ends = leaves(x[size == m], leaf)
            some = np.flatnonzero(size == m)[order]
            ids, rows, ask = (own[c].to_numpy()[some] for c in ("vec_id", "row", "is_query"))
            part = np.ones(len(some), bool)
            for is_query, at in ((False, part), (True, ask.astype(bool))):
                if at.any():
                    n = int(at.sum())
                    least = packed(np.full(n, -np.inf)) if is_query else b""
                    out.append((is_query, shard, 8 * shard + number + int(m), kind, n, packed(ids[at]), packed(rows[at]), packed(x[some][at]), b"" if is_query else packed(ends), least))
    return pd.DataFrame(out, columns=["is_query", *(c.split()[0] for c in BLOCK.split(", "))])


def listed(best: Best) -> bytes:
    """The results of queries: how many each has, ids and scores."""
    best.settle()
    ok = best.there()
    scores = best.scores[ok]
    return pickle.dumps((ok.sum(1), best.ids[ok], scores if scores.dtype == object else scores.astype(np.int64)))


def joined(found: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query of a block: its place in the block, rank, id and score, from several lists."""
    lists = [pickle.loads(f) for f in found]
    at = np.concatenate([np.repeat(np.arange(len(n)), n) for n, _, _ in lists])
    ids, scores = (np.concatenate([x[c] for x in lists]) for c in (1, 2))
    if scores.dtype == object:
        order = np.array(sorted(range(len(at)), key=lambda j: (at[j], -int(scores[j]), ids[j])), int)
    else:
        order = np.lexsort((ids, ~scores, at))
    at, ids, scores = at[order], ids[order], scores[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at) + 1
    return tuple(c[rank <= k] for c in (at, rank, ids, scores))


def merged(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Results of blocks, in their order, to query_id, rank, vec_id, score."""
    now, ids, held = None, None, []

    def done() -> Iterator[pa.RecordBatch]:
        if now is not None:
            at, rank, found, scores = joined(held, k)
            if scores.dtype == object:
                scores = np.array([max(LONG[0], min(LONG[1], int(s))) for s in scores], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(rank.astype(np.int32)), pa.array(found), pa.array(scores)], ["query_id", "rank", "vec_id", "score"])

    for b in batches:
        for block, own, found in zip(*(b.column(c).to_pylist() for c in ("block", "ids", "found")), strict=True):
            if block != now:
                yield from done()
                now, held = block, []
            ids = np.frombuffer(own, np.int64)
            held.append(found)
            if len(held) == 64:  # so that a block's lists don't add up
                at, _, some, scores = joined(held, k)
                held = [pickle.dumps((np.bincount(at, minlength=len(ids)), some, scores))]
    yield from done()


def top_k(vectors: DataFrame, is_query, k: int = K, scale: float = SCALE, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """query_id, rank, vec_id, score. vectors: vec_id, embedding (array of numbers). is_query: a condition on vec_id."""
    kind = vectors.select("embedding").schema[0].dataType
    plain = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType | DoubleType)
    numbers = F.col("embedding") if plain else F.col("embedding").cast("array<double>")
    asked = F.coalesce(is_query, F.lit(False)).alias("is_query")
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("embedding"), asked)
    rows = stage(rows.mapInArrow(lambda batches: narrowed(batches, scale), ROW), "vectors")
    shards = max(1, -(-rows.count() // shard))
    workers = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    groups = -(-shards // max(1, min(GROUP, shards // workers)))
    parts = max(-(-shards // PART), min(-(-UNITS * workers // groups), -(-shards // groups)))

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    built = stage(dealt.groupBy("shard").applyInPandas(lambda pdf: blocks(pdf, leaf, scale), f"is_query boolean, {BLOCK}"), "shards")
    group, part = F.col("shard") % groups, F.floor(F.col("shard") / groups).cast("int") % parts

    def search(stream: DataFrame, schema: str, block: bool) -> DataFrame:
        """stream: grp, part, is_query and BLOCK; each query of a (grp, part) against all of the group's vectors. block: also
        the queries with their k-th scores."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[Tree] = []
            now = None
            for b in batches:
                for i in range(b.num_rows):
                    r = {c: b.column(c)[i].as_py() for c in b.schema.names}
                    if now != (r["grp"], r["part"]):
                        now, held = (r["grp"], r["part"]), []
                    ids, own = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["rows"], np.int64)
                    x = Rows(r["kind"], np.frombuffer(r["x"], FORM[r["kind"]]).reshape(r["n"], -1), scale)
                    if not r["is_query"]:
                        held.append(Tree(ids, own, x, np.frombuffer(r["ends"], np.int64)))
                        continue
                    best = Best(own, x, k, np.frombuffer(r["least"]))
                    for tree in held:
                        tree.search(best, scale)
                    one = {"block": r["block"], "ids": r["ids"], "found": listed(best)}
                    if block:
                        #: The threshold a tie must reach, in terms of scores.
                        one |= {c: r[c] for c in ("shard", "kind", "n", "rows", "x", "ends")} | {"least": packed(best.least)}
                    one = pa.RecordBatch.from_pylist([one])
                    names = [c.split()[0] for c in schema.split(", ")]
                    yield one.select(names).cast(pa.schema([(c.split()[0], KINDS[c.split()[1]]) for c in schema.split(", ")]))

        spread = stream.repartitionById(groups * parts, (F.col("grp") * parts + F.col("part")).cast("int")).sortWithinPartitions("grp", "part", "is_query", "shard")
        return spread.select("grp", "part", "is_query", *[c.split()[0] for c in BLOCK.split(", ")]).mapInArrow(run, schema)

    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    there = built.where("not is_query").withColumn("grp", group).withColumn("part", every_part)
    asking = built.where("is_query").withColumn("grp", group).withColumn("part", part)
    home = stage(search(there.unionByName(asking), f"{BLOCK}, found binary", True), "home")
    found = home.select("block", "ids", "found")
    if groups > 1:
        away = home.drop("found").withColumn("is_query", F.lit(True)).withColumn("part", part)
        away = away.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).where(F.col("grp") != group)
        found = found.union(search(there.unionByName(away), "block long, ids binary, found binary", False))
    ordered = found.repartition("block").sortWithinPartitions("block")
    return ordered.mapInArrow(lambda batches: merged(batches, k), "query_id long, rank int, vec_id long, score long")
