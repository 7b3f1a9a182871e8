"""Language ID with interpolated Kneser-Ney character models, one a language.

Training: of the documents that may be learned from, about `per_language` of each label, however many labels there are,
chosen by a hash of the id. The bound is on rows of a label, so it does not grow with the table. Texts become lower-case
letters and single spaces (every run of other characters); executors count n-grams and build each language's model in a task
of its own; a fifth of the sample (again by hash) isn't counted but calibrates the rejection. Only finished models reach the
driver, which broadcasts them; if they have more than MODEL_BYTES together, fit() says so and stops.

Model: for each language and order sorted arrays of n-gram hashes with their discounted probabilities, and of contexts with
the weight passed down. p(w|h) = max(c(hw) - D, 0)/c(h) + D N1+(h.)/c(h) p(w|h'), lower orders with continuation counts
(in how many contexts an n-gram is met), the lowest mixed with the uniform distribution. Whole texts are scored: every
n-gram by position; each distinct one is looked up once and then found in a direct-mapped cache of at most CACHE_BYTES.

The language of lowest cross-entropy a character wins. score is its share of the languages' likelihoods over CERTAIN
characters at most. accepted is false if no letter is there (lang_pred `und`), or if the text has FEW letters or more and its
cross-entropy is above its language's limit, SLACK above the largest of the calibration documents, by more than STRAY in
all: what some 40 characters that fit no language (a key, a name) cost. So such a string alone rejects no text.

Defined cases: null text, empty text and text without letters give `und`, score 0; ties go to the smallest label; rows are
judged one by one, so repeated rows and null ids are no special case (a null id counts as held out); without any labelled
row nothing is learned and all is `und`; other columns, of any names, are ignored by fit() and kept by identify() and judged().
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, sized, stage

ORDER, PER_LANGUAGE, CERTAIN, FEW, SLACK, STRAY, PIECE, CACHE_BYTES, MODEL_BYTES = 4, 1500, 32, 40, 0.5, 200.0, 1 << 20, 32 << 20, 1 << 29
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = 32


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.frombuffer(bytes(chr(i).isalpha() for i in range(0x110000)), bool)
    return _letters


_letters: np.ndarray | None = None


def symbols(text: str) -> np.ndarray:
    """Code points of a text's lower-case letters, with one space for every run of others, and one in front."""
    raw = np.frombuffer((" " + text.lower()).encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[raw]
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]
    return np.where(is_letter, raw, np.uint32(_SPACE))[keep]


def gram_keys(s: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Hashes of the `order`-grams that end at each position but the first; spaces stand before the text."""
    padded = np.concatenate([np.full(order - 2, _SPACE, np.uint32), s]).astype(np.uint64) if order > 1 else s[1:].astype(np.uint64)
    h = np.zeros(len(s) - 1, np.uint64)
    for k in range(order):
        h = (h ^ padded[k : k + len(h)]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang, text, calibrate of the training sample."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counts = sized(stage(rows.groupBy("lang").agg(F.count("*").alias("n")), "labels"))
    spot = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.join(counts, "lang").where(spot * F.col("n") < per_language)
    return chosen.select("lang", "text", (F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5)) == 0).alias("calibrate"))


def count_grams(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, gram, n: counts of the n-grams of full order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = symbols(text)
                if len(s) > 1:
                    s = np.concatenate([np.full(order - 2, _SPACE, np.uint32), s])
                    parts.setdefault(lang, []).append(np.stack([s[k : len(s) - order + 1 + k] for k in range(order)], 1))
            for lang, m in parts.items():
                grams, n = np.unique(np.concatenate(m), axis=0, return_counts=True)
                text = ["".join(map(chr, g)) for g in grams.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(text)), pa.array(text), pa.array(n)], ["lang", "gram", "n"])

    return rows.select("lang", "text").mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class KneserNey:
    """One language. grams[k]: sorted hashes and discounted probabilities of order k + 1; contexts[k]: sorted hashes of
    contexts of k symbols and their weight."""

    def __init__(self, counts: dict[str, int], order: int = ORDER):
        self.grams, self.contexts = [], []
        for k in range(order, 0, -1):
            if k < order:
                met: dict[str, int] = {}
                for g in counts:
                    met[g[1:]] = met.get(g[1:], 0) + 1
                counts = met
            n = np.array(list(counts.values()), float)
            ones, twos = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            context, at = np.unique([g[:-1] for g in counts], return_inverse=True)
            total, kinds = np.bincount(at, n), np.bincount(at)
            self.grams.insert(0, self.table(list(counts), (n - d) / total[at]))
            self.contexts.insert(0, self.table(context.tolist(), d * kinds / total))
        self.symbols = len(counts) + 1

    @staticmethod
    def table(keys: list[str], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = len(keys[0])
        points = np.array([[ord(c) for c in k] for k in keys], np.uint32).reshape(len(keys), width)
        h = KneserNey.hashes(points)
        order = np.argsort(h)
        return h[order], values[order].astype(np.float64)

    @staticmethod
    def hashes(points: np.ndarray) -> np.ndarray:
        h = np.zeros(len(points), np.uint64)
        for k in range(points.shape[1]):
            h = (h ^ points[:, k].astype(np.uint64)) * _MIX
            h ^= h >> np.uint64(29)
        return h

    @staticmethod
    def find(table: tuple[np.ndarray, np.ndarray], h: np.ndarray, other: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
        return np.where(table[0][at] == h, table[1][at], other)

    def log_probabilities(self, points: np.ndarray) -> np.ndarray:
        """log p of each row's last symbol after the ones in front."""
        order = points.shape[1]
        p = np.full(len(points), 1.0 / self.symbols)
        for k in range(order):
            gram = self.hashes(points[:, order - k - 1 :])
            context = self.hashes(points[:, order - k - 1 : order - 1])
            p = self.find(self.grams[k], gram, 0.0) + self.find(self.contexts[k], context, 1.0) * p
        return np.log(p)


class Model:
    def __init__(self, models: dict[str, KneserNey], order: int = ORDER):
        self.langs, self.models, self.order = sorted(models), models, order
        self.limits = np.full(len(models), np.inf)
        self.cache: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": None}

    def bits(self) -> int:
        """Of the number of places in the cache: fewer with many languages."""
        return max(4, min(18, (CACHE_BYTES // (8 * len(self.langs) + 8)).bit_length() - 1))

    def entropies(self, s: np.ndarray) -> np.ndarray:
        """Sums over a text's symbols (of symbols()) of -log p, for each language."""
        if self.cache is None:
            self.cache = np.zeros(1 << self.bits(), np.uint64), np.zeros((1 << self.bits(), len(self.langs)))
        keys, values = self.cache
        high = np.uint64(64 - self.bits())
        total = np.zeros(len(self.langs))
        for at in range(1, len(s), PIECE):
            part = s[max(0, at - self.order + 1) : at + PIECE]
            lead = min(at, self.order - 1)
            h = gram_keys(part, self.order)[lead - 1 :]
            slot = (h >> high).astype(np.int64)
            bad = np.flatnonzero(keys[slot] != h)
            if len(bad):
                new, first, inverse = np.unique(h[bad], return_index=True, return_inverse=True)
                padded = np.concatenate([np.full(self.order - 2, _SPACE, np.uint32), part])
                end = bad[first] + lead + self.order - 2
                points = np.stack([padded[end - self.order + 1 + k] for k in range(self.order)], 1)
                lp = np.stack([self.models[x].log_probabilities(points) for x in self.langs], 1)
                total -= lp.T @ np.bincount(inverse, minlength=len(new))
                good = np.ones(len(h), bool)
                good[bad] = False
                total -= values[slot[good]].sum(0)
                where = (new >> high).astype(np.int64)
                where, own = np.unique(where, return_index=True)
                keys[where], values[where] = new[own], lp[own]
            else:
                total -= values[slot].sum(0)
        return total

    def judge(self, text: str | None) -> tuple[str, float, bool, float]:
        """Label, score, accepted, cross-entropy a character."""
        s = symbols(text or "")
        n = int(np.count_nonzero(s != _SPACE))
        if not n or not self.langs:
            return "und", 0.0, False, 0.0
        each = self.entropies(s) / (len(s) - 1)
        best = int(np.argmin(each))
        share = 1.0 / float(np.exp(-(each - each[best]) * min(len(s) - 1, CERTAIN)).sum())
        accepted = n < FEW or (each[best] - self.limits[best]) * (len(s) - 1) <= STRAY
        return self.langs[best], share, bool(accepted), float(each[best])


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, order: int = ORDER) -> Model:
    """A model of all labels. A shuffle deals the n-grams out by language; a language's task sees the counts of at most about
    per_language documents."""
    rows = stage(sample(docs, learn, per_language), "language_sample")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        model = KneserNey(dict(zip(pdf["gram"], pdf["n"], strict=True)), order)
        return pd.DataFrame([{"lang": pdf["lang"].iloc[0], "model": pickle.dumps(model)}])

    built = stage(count_grams(rows.where("not calibrate"), order).groupBy("lang").applyInPandas(build, "lang string, model binary"), "language_models")
    size = built.agg(F.coalesce(F.sum(F.octet_length("model")), F.lit(0))).first()[0]
    if size > MODEL_BYTES:
        raise ValueError(f"language models of {size} bytes are too large to be broadcast: fit on fewer labels or a smaller per_language")
    model = Model({r["lang"]: pickle.loads(bytes(r["model"])) for r in built.toLocalIterator()}, order)
    if model.langs:
        held = rows.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = held.value
            for b in batches:
                seen = [(lang, *m.judge(t)) for lang, t in zip(*(c.to_pylist() for c in b.columns), strict=True) if len(symbols(t)) > FEW]
                hit = [(x[0], x[4]) for x in seen if x[0] == x[1]]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in hit], pa.string()), pa.array([x[1] for x in hit], pa.float64())], ["lang", "h"])

        most = rows.where("calibrate").select("lang", "text").mapInArrow(run, "lang string, h double").groupBy("lang").agg(F.max("h").alias("h"))
        for r in most.collect():  # a row a label, as the model has
            model.limits[model.langs.index(r["lang"])] = r["h"] + SLACK
    return model


def judged(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """The rows with all their columns and one more of that name: a struct of lang_pred, score, accepted."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, accepted boolean")
    def judge(texts):
        m = held.value
        out = [m.judge(t)[:3] for t in texts]
        return pd.DataFrame(out, columns=["lang_pred", "score", "accepted"])

    return docs.select("*", judge("text").alias(name))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with all their columns, and lang_pred, score, accepted. A column of one of these names is replaced."""
    own = ("lang_pred", "score", "accepted")
    (name,) = fresh(docs.columns, "judged")
    out = judged(docs, model, name)
    return out.select(*[f"`{c}`" for c in docs.columns if c.lower() not in own], *[f"{name}.{c}" for c in own])
