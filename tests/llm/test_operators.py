"""Each text operator against brute force and on odd rows: nulls, empty and long texts, ties, repeated rows, empty tables,
extra columns with the operators' own names."""

import hashlib
import math
import random
import re
import struct
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from landscore.llm import decontaminate, langid, license_scan, line_dedup, mixing, near_copies, queries, seen, sharding, simhash, suffix, token_counts, topk
from landscore.llm.common import new_folder
from landscore.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, did long, rk long, fp long, size long, key string, spans string, words string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = " ".join(f"passage{i} of words" for i in range(30))


def fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def texts():
    r = random.Random(5)
    vocabulary = [r.choice("abcdeéßñ") * r.randint(1, 3) + str(i) for i in range(60)]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 120))) for _ in range(25)]
    out = [*base, *(b.replace(" ", "\n", 3) for b in base[:6]), base[0], base[0] + " more", PASSAGE, "x " + PASSAGE.upper() + " y", PASSAGE[:300]]
    return [*out, None, "", " \n\t", "a" * 150_000, "ab" * 300, "Released under the MIT License. " + base[3], "É É é 日本語 <|endoftext|> it's"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 9 == 0 else f"s{i % 4}", 1) for i, t in enumerate(texts())]
    rows += [rows[2], rows[2], (None, PASSAGE, None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, *[7] * 4, "k", "s", "w") for r in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_decontamination(spark, docs, empty):
    item = [" ".join(WORD.findall(PASSAGE)[10:40]), "passage3 of", "", None, "not there at all", "passage3 of"]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(item)] + [(None, "words passage9", "x")], "item_id long, text string, words string")
    got = by_row(decontaminate.contamination(docs, bench).select("doc_id", "n_words", "n_hit", F.concat_ws(",", "items"), "contaminated"))
    want = []
    for r in docs.collect():
        w, hit, items = WORD.findall(fold(r.text or "")), set(), set()
        for i, t in [*enumerate(item), (None, "words passage9")]:
            b = WORD.findall(fold(t or ""))
            n = min(13, len(b))
            windows = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if b else set()
            for s in range(len(w) - n + 1) if n else ():
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    items |= {str(i)} if i is not None else set()
        want.append((r.doc_id, len(w), len(hit), ",".join(sorted(items)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    assert got == sorted(want, key=repr)
    assert sum(r[4] for r in got) >= 4
    assert decontaminate.contamination(empty, bench).count() == 0
    none = decontaminate.contamination(docs, bench.limit(0))
    assert none.count() == docs.count() and none.where("n_hit > 0").count() == 0
    query = spark.createDataFrame([(1, "of passage4 passage5"), (2, "words of of"), (3, "passage4 nowhere")], "item_id long, text string")
    for width in (1, 3, 6):
        near = by_row(decontaminate.proximity(docs, query, width).select("item_id", "doc_id", "pos"))
        want = set()
        for r in docs.collect():
            w = WORD.findall(fold(r.text or ""))
            for i, q in ((1, {"of", "passage4", "passage5"}), (2, {"words", "of"})):
                want |= {(i, r.doc_id, p) for p in range(len(w)) if w[p] in q and q <= set(w[p : p + width])}
        assert near == sorted(want, key=repr) and (width == 1 or near)


def test_decontamination_of_periodic_texts(spark):
    """A text of one repeated word, items of it, and items with repeated windows, against counting by hand."""
    n = 200_000
    docs = [(1, "a " * 20_000), (2, "a " * n), (3, "b " + "a " * 12 + "c"), (4, "x y " * 500), (5, "a b " * 6 + "a"), (6, "A-" * 13)]
    items = [(10, "a " * 60), (11, "x y " * 40), (12, "a " * 13), (13, "c"), (14, "y x " * 7)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {1: (20_000, 20_000, ["10", "12"], True), 2: (n, n, ["10", "12"], True), 3: (14, 1, ["13"], True), 4: (1000, 1000, ["11", "14"], True), 5: (13, 0, [], False), 6: (13, 13, ["10", "12"], True)}


def test_token_counts(spark, docs, empty):
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    got = by_row(token_counts.token_counts(docs, path, chunk=500, overlap=16))
    want = [(r.doc_id, len((r.text or "").encode()), n := len(t.encode(r.text or "", add_special_tokens=False).ids), n > 512) for r in docs.collect()]
    assert got == sorted(want, key=repr)
    assert token_counts.token_counts(empty, path).count() == 0
    r = random.Random(2)
    parts = ["<|endoftext|>", "<|endof", " ", "  ", "\n\n", " ", " ", "\x1c", "\x85", "it's ", "we'll", "'", "12", "é", "日本", "word ", " X", "!?", "😀", "͸", "ᲊ"]
    for chunk in (40, 70, 200):
        c = token_counts.Counter(path, chunk=chunk, overlap=8)
        many = ["".join(r.choice(parts) for _ in range(r.randint(0, 400))) for _ in range(60)]
        assert c.count(many) == [len(t.encode(x, add_special_tokens=False).ids) for x in many]
    import public_tokenizers
    import sentencepiece

    sp = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.Counter(sp).count(many) == [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=sp).encode(many)]


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", fold(text or "").encode())
    sh = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(fps):
    up = {i: i for i in fps}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in fps:
        for b in fps:
            if a < b and bin(fps[a] ^ fps[b]).count("1") <= 4:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: root(i) for i in fps}


def test_segments(spark):
    small, big = spark.range(10).withColumnRenamed("id", "h"), spark.range(1 << 32).withColumnRenamed("id", "h")
    assert seen.segments_for(small) == seen.SEGMENTS < seen.segments_for(big) <= seen.MOST_SEGMENTS
    hashes = spark.range(3000).select((F.xxhash64(F.col("id") % 2000)).alias("h"), F.lit(False).alias("twice"))
    for segments in (1, 64, 5000):
        twice = seen.Twice(*seen.seen_twice(hashes, segments).value)
        h = np.array([r.h for r in spark.range(2000).select(F.xxhash64("id").alias("h")).collect()], np.int64).view(np.uint64)
        assert twice.holds(h[:1000]).all() and twice.holds(h[1000:]).mean() < 0.2


def test_simhash(spark, docs, empty):
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == docs.count()
    by_id = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect() if r.doc_id is not None}
    roots = brute_roots(by_id)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.fp % 2**64, r.component_id) == (by_id[r.doc_id], roots[r.doc_id])
    assert simhash.near_duplicates(empty).count() == 0


def brute_signature(text):
    """The same bits one by one."""
    w = re.findall(rb"[^\x20\x09-\x0D]+", fold(text or "").encode())
    shingles = {b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    narrow = [xxhash.xxh64_intdigest(x, 42) for x in set(w)]
    fp = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in narrow) > len(narrow))
    wide = []
    for lane in range(1, 9):
        x = []
        for h in {xxhash.xxh64_intdigest(y, 42) for y in shingles}:
            h = (h + lane * 0x9E3779B97F4A7C15) % 2**64
            h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % 2**64
            h = (h ^ h >> 27) * 0x94D049BB133111EB % 2**64
            x.append(h ^ h >> 31)
        wide.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in x) > len(x)))
    return fp, sum(v << 64 * i for i, v in enumerate(wide))


def brute_similar(by_id):
    roots = {i: i for i in by_id}

    def root(i):
        while roots[i] != i:
            i = roots[i]
        return i

    sig = {i: brute_signature(t) for i, t in by_id.items()}
    for a in sig:
        for b in sig:
            if a < b and (sig[a][0] ^ sig[b][0]).bit_count() <= 6 and (sig[a][1] ^ sig[b][1]).bit_count() <= simhash.wide_limit():
                x, y = sorted((root(a), root(b)))
                roots[y] = x
    return {i: root(i) for i in roots}


@pytest.mark.parametrize("tile", [3, 2048])
def test_similar_documents(spark, docs, empty, tile):
    """Copies with edits are found, texts of the same words in another order are not; any tile gives the same groups."""
    r = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    base = [[r.choice(words) for _ in range(300)] for _ in range(3)]
    edited = [[*b[:150], "new", *b[151:]] for b in base for _ in range(2)] + [[*base[0], *(f"more{i}" for i in range(k))] for k in (1, 5, 15)]
    shuffled = [r.sample(b, len(b)) for b in base]
    rows = [(1000 + i, " ".join(t)) for i, t in enumerate([*base, *edited, *shuffled])]
    more = spark.createDataFrame([*rows, (1000, " ".join(base[0]).upper()), (None, rows[0][1])], "doc_id long, text string")
    every = docs.select("doc_id", "text").union(more)
    out = simhash.similar_documents(every, tile=tile).collect()
    assert len(out) == every.count()
    want = brute_similar({r.doc_id: r.text for r in every.collect() if r.doc_id is not None})
    assert all(x.component_id == (None if x.doc_id is None else want[x.doc_id]) for x in out)
    got = {x.doc_id: x.component_id for x in out}
    assert [got[1000 + i] for i in range(15)] == [1000, 1001, 1002, 1000, 1000, 1001, 1001, 1002, 1002, 1000, 1000, 1000, 1012, 1013, 1014]
    assert simhash.similar_documents(empty).count() == 0


def test_block_count():
    """At least two blocks a key; more blocks for more fingerprints, and any number gives the same links."""
    assert [simhash.block_count(n) for n in (0, 10**6, 10**10)] == [6, 6, 7]


@pytest.mark.parametrize("tile", [3, 2048])
def test_links(spark, tile):
    """Chains and clusters of fingerprints, buckets in tiles too."""
    r = random.Random(3)
    fps = [r.getrandbits(64) for _ in range(150)]
    for f in fps[:12]:
        for _ in range(8):
            f ^= sum(1 << b for b in r.sample(range(64), r.choice([1, 3, 4, 5])))
            fps.append(f)
    fps = dict(enumerate(dict.fromkeys(fps)))
    nodes = spark.createDataFrame([(i, f - 2**64 if f >> 63 else f) for i, f in fps.items()], "node long, fp long")
    found = simhash.links(nodes, tile=tile)
    more = {x.node: x.root for x in components(simhash.links(nodes, blocks=7, tile=tile)).collect()}
    assert all(bin(fps[x.a] ^ fps[x.b]).count("1") <= 4 for x in found.collect())
    roots = {x.node: x.root for x in components(found).collect()}
    assert {i: roots.get(i, i) for i in fps} == {i: more.get(i, i) for i in fps} == brute_roots(fps)


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (100, 200), (200, 150)], "a long, b long")
    roots = {r.node: r.root for r in components(chain).collect()}
    assert all(roots[i] == 0 for i in range(61)) and roots[200] == roots[150] == roots[100] == 100
    assert components(chain.limit(0)).count() == 0


def test_license_scan(spark, docs, empty):
    templates = license_scan.template_table(spark)
    mit = license_scan.TEMPLATES["mit-grant"]
    edited = mit.replace("hereby", "herewith")
    more = spark.createDataFrame([(500, "word " * 333 + edited + " word" * 50), (501, mit[: len(mit) // 2]), (502, mit.upper())], "doc_id long, text string")
    got = {r.doc_id: list(r.templates) for r in license_scan.scan(docs.select("doc_id", "text").union(more), templates).collect()}
    assert got[500] == got[502] == ["mit-grant"] and got[501] == []
    assert [i for i, x in got.items() if x == ["mit"]] == [i for i, t in enumerate(texts()) if t and "MIT" in t]
    assert license_scan.scan(empty, templates).count() == 0
    assert license_scan.scan(docs, templates.limit(0)).where("size(templates) > 0").count() == 0


def brute_scan(text, templates):
    """All windows, banded and verified one by one."""
    shingles = lambda w: [" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []
    number = lambda s: xxhash.xxh64_intdigest(s.encode(), seed=42) - (1 << 64) * (xxhash.xxh64_intdigest(s.encode(), seed=42) >> 63)
    seeds = [xxhash.xxh64_intdigest(struct.pack("<i", j), seed=xxhash.xxh64_intdigest(struct.pack("<i", license_scan.SEED), seed=42)) for j in range(license_scan.BANDS)]

    def low(own, seed):
        each = (xxhash.xxh64_intdigest(struct.pack("<q", number(s)), seed=seed) for s in own)
        return min(x - (1 << 64) * (x >> 63) for x in each)

    words, met, matched = WORD.findall(fold(text)), set(), set()
    for name, t in templates.items():
        m = shingles(WORD.findall(fold(t)))
        c, own = 1 << (len(m) - 1).bit_length(), set(m)
        mine = [low(own, s) for s in seeds]
        for i in range(0, len(words), c):
            window = set(shingles(words[i : i + 2 * c + 4]))
            if len(window & own) >= 0.8 * len(own):
                matched.add(name)
                if any(low(window, s) == v for s, v in zip(seeds, mine, strict=True)):
                    met.add(name)
    return sorted(met), sorted(matched)


def test_license_scan_against_all_windows(spark):
    r = random.Random(12)
    names = ["mit", "isc", "mpl-2.0", "gpl-notice", "apache-2.0"]
    own = {n: license_scan.TEMPLATES[n] for n in names}
    rows = []
    for i in range(24):
        words = own[names[i % 5]].split()
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = "other"
        pad = lambda: " ".join(f"w{r.randrange(300)}" for _ in range(r.randint(0, 150)))
        rows.append((i, f"{pad()} {' '.join(words)} {pad()} {own['mit'] if i % 3 == 0 else ''}"))
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), license_scan.template_table(spark, own))
    want = {i: brute_scan(t, own) for i, t in rows}
    assert {x.doc_id: list(x.templates) for x in got.collect()} == {i: x[0] for i, x in want.items()}
    #: The bands lose no match, and texts with and without matches are both there.
    assert all(x[0] == x[1] for x in want.values()) and 30 > sum(len(x[1]) for x in want.values()) > 12


def brute_top_k(rows, k):
    """By Python's integers: floor(64 x) of each component, every row but the query's own."""
    ok = [(n, i, [math.floor(64 * Fraction(x)) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for n, i, q in ok:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, x)), j) for m, j, x in ok if m != n)[:k]
            want += [(i, place + 1, j, max(-(2**63), min(2**63 - 1, -s))) for place, (s, j) in enumerate(best)]
    return sorted(want, key=repr)


def test_top_k(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in enumerate(r.normal(size=(300, 6)))]
    rows += [(300, rows[0][1]), (301, None), (302, [1.0, float("nan")] * 3), (303, [None, 1.0]), (304, [float("inf")] * 6), (305, [1.0, -2.0]), (306, []), (None, [1.0] * 6)]
    for more in ([], [(307, [2.0**100] * 6)], [(0, [5.0, -1.0, 2.0]), (0, rows[0][1]), (40, [0.0] * 6), (41, [0.5] * 9)]):
        df = spark.createDataFrame([(*x, 5) for x in rows + more], "vec_id long, embedding array<float>, shard int").repartition(3)
        assert by_row(topk.top_k(df, F.col("vec_id") % 20 == 0, k=7, shard=64, leaf=8)) == brute_top_k(rows + more, 7)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("shard", [40, 8192])
def test_top_k_of_large_components(spark, shard):
    """Scores that floats, and some that longs, can't hold: components around 2**14, 1e12, 1e30 and 1e308 in one table."""
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=5) * s]) for i, s in enumerate([1.0, 20_000.0, 1e6, 1e9, 1e12] * 30)]
    rows += [(160, [1e30, 1.0, -1e30]), (161, [1e30]), (162, [-1e30, 3.0]), (180, [1e308, 1e308]), (181, [1e308, -1e308]), (182, [1.5e308, 0.0, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_row(topk.top_k(df, F.col("vec_id") % 20 == 0, k=9, shard=shard, leaf=8))
    assert got == brute_top_k(rows, 9)
    plain = [(20_000, [20_000.0, 1.0]), (1, [30_000.0, 5.0]), (2, [1024.0, 100.0])]
    got = by_row(topk.top_k(spark.createDataFrame(plain, "vec_id long, embedding array<double>"), F.col("vec_id") == 20_000, shard=shard))
    assert got == [(20_000, 1, 1, 2_457_600_020_480), (20_000, 2, 2, 83_886_489_600)]



def test_top_k_of_mixed_sizes(spark):
    """Components of one byte, two bytes and more in one shard, groups of copies, leaves and shards with fewer than k."""
    r = np.random.default_rng(7)
    rows = [(i, [float(x) for x in r.normal(size=12) * s]) for i, s in enumerate([0.1, 3.0, 700.0, 20_000.0] * 60)]
    rows += [(300 + i, rows[i % 3][1]) for i in range(60)] + [(20, rows[20][1]), (20, [0.01] * 3), (-1, rows[0][1]), (-20, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for k, shard, leaf in ((30, 4096, 8), (30, 50, 8), (5, 100, 4)):
        assert by_row(topk.top_k(df, F.col("vec_id") % 20 == 0, k=k, shard=shard, leaf=leaf)) == brute_top_k(rows, k)


@pytest.mark.parametrize(("width", "steps", "share"), [(64, 100, 1.0), (2, 100, 0.2)])
def test_top_k_steps(monkeypatch, width, steps, share):
    """Where boxes prune nothing, a block and a tree are multiplied in few steps, not leaf by leaf; where they do, few leaves are
    opened. No candidate that counts is lost."""
    r = np.random.default_rng(2)
    x = r.integers(-30, 30, size=(8192, width)).astype(np.int8)
    order, ends = topk.leaves(x)
    tree = topk.Tree(order, order, topk.Rows("b", x[order], 64), ends)
    best = topk.Best(np.arange(400), topk.Rows("b", x[:400], 64), 20, np.full(400, -np.inf))
    seen, meet = [], topk.Best.meet
    monkeypatch.setattr(topk.Best, "meet", lambda self, at, ids, rows, new: (seen.append(new.size), meet(self, at, ids, rows, new))[1])
    tree.search(best, 64)
    best.settle()
    assert len(seen) <= steps and sum(seen) <= share * 1.1 * 400 * 8192
    scores = x[:400].astype(int) @ x.T.astype(int)
    scores[np.arange(400), np.arange(400)] = -(10**9)
    want = np.lexsort((np.broadcast_to(np.arange(8192), scores.shape), -scores), axis=1)[:, :20]
    assert (best.ids == want).all() and (best.scores == np.take_along_axis(scores, want, 1)).all()
    again = topk.Best(np.arange(400), topk.Rows("b", x[:400], 64), 20, best.least)  # a threshold that ties must reach
    tree.search(again, 64)
    again.settle()
    assert (again.ids == want).all()


def test_line_dedup(spark, empty):
    texts = ["Common line here\nown one of this\nshort", "  COMMON line here \nshort\nx\nCommon line here", None, "", "\n\nown two, 3 of it\n", "Common line here", "ÀÀÀÀÀÀÀÀÀ\nown", "ÀÀÀÀÀÀÀÀÀ", "àààààààààà", "àààààààààà\n" + "z" * 90_000]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(1, texts[1], "k"), (None, texts[0], "k")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, key string").repartition(3)).collect()
    first = {}
    for i, t, _ in rows:
        if i is not None:
            for k in {fold(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")}:
                first.setdefault(k, set()).add(i)
    want = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        gone = [i is not None and len(k := fold(x.strip(" \t\n\x0b\x0c\r"))) >= 10 and i > min(first[k]) for x in lines]
        want.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert line_dedup.dedup_lines(empty).count() == 0


def test_sharding(spark, docs, empty):
    store = sharding.Store(spark, new_folder(spark, "test"), target=1 << 20, fanout=3)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for n in (3, 4, 5):
        store.append(plain.repartition(n))
    before = store.manifest()
    after = store.compact()
    assert after["version"] == before["version"] + 1 and len(after["shards"]) < len(before["shards"])
    want = sorted(repr(tuple(r)) for r in plain.unionAll(plain).unionAll(plain).collect())
    for v in (before["version"], after["version"]):
        assert sorted(repr(tuple(r)) for r in store.read(v).drop("shard").collect()) == want
    with pytest.raises(sharding.Conflict):
        store.commit(before, before["schema"], [])
    assert store.manifest() == after and sum(s["rows"] for s in after["shards"]) == len(want)
    store.vacuum()
    assert store.read().count() == len(want)
    none = sharding.Store(spark, new_folder(spark, "test"))
    none.append(empty)
    assert none.compact()["shards"] == [] and none.read().count() == 0
    runs = sharding.plan([{"file": f"{i:03d}", "bytes": 100_000 + i} for i in range(50)], target=1 << 20)
    assert all(sum(s["bytes"] for s in r) <= 1 << 20 for r in runs) and len({s["file"] for r in runs for s in r}) == sum(map(len, runs))


def test_mixing(spark, docs, empty):
    out = mixing.shares(docs).collect()
    assert len(out) == docs.count() and by_row(mixing.shares(docs)) == sorted(map(tuple, out), key=repr)
    total = sum(r["size"] for r in out)
    target, size, taken, biggest = {}, Counter(), Counter(), Counter()
    for r in out:
        target[r.source] = r.target
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        biggest[r.source] = max(biggest[r.source], r["size"])
        assert r.taken in (0, r["size"], 2 * r["size"])
    order = sorted((s for s in target if s is not None)) + [None] * (None in target)
    w, got = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, {}
    left, open_ = 1.5 * total, set(order)
    while open_:
        full = {s for s in open_ if left * w[s] / sum(w[x] for x in open_) > 2 * size[s]}
        if not full:
            got |= {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
            break
        got |= {s: 2.0 * size[s] for s in full}
        left -= sum(2 * size[s] for s in full)
        open_ -= full
    for s in order:
        assert target[s] == pytest.approx(got[s]) and abs(taken[s] - target[s]) <= biggest[s]
    few, mixing.BUCKET_ROWS, mixing.BUCKETS = (mixing.BUCKET_ROWS, mixing.BUCKETS), 2, 1
    again = by_row(mixing.shares(docs))
    mixing.BUCKET_ROWS, mixing.BUCKETS = few
    assert again == sorted(map(tuple, out), key=repr)
    assert mixing.shares(empty).count() == 0
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() == sum(r.copies for r in out)


def test_mixing_of_equal_rows(spark):
    """Equal rows are drawn one by one; any names of columns; rows of one id and text that differ elsewhere."""
    rows = [(1, "one two three four", "en", "a", 7, i % 2) for i in range(100)] + [(2, "five six seven", "en", "a", 8, 0), (3, "eight", "en", "b", 9, 0), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, copies int, _key int").withColumns({c: F.lit(1) for c in ("_n", "_rk", "_doc_id", "rk", "size", "target", "bucket", "own", "local", "b", "s")})
    out, mix = mixing.shares(df).collect(), mixing.mix(df)
    taken, target = Counter(), {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 4
    words = {k: len((t or "").split()) for k, t, *_ in rows}
    got = Counter(r.source for r in mix.collect() for _ in range(words[r.doc_id]))
    assert mix.columns == df.columns and got == +taken and mix.count() == sum(r.copies for r in out)
    assert Counter(mix.collect()) == Counter(mixing.mix(df.repartition(5)).collect())


def brute_spans(texts, length=200):
    data = [(t or "").encode() for t in texts]
    n = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        mark = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if n[b[i : i + length]] > 1:
                mark[i : i + length] = True
        out.append(mark)
    return data, out


@pytest.mark.parametrize("most_regions", [2, 20_000])
def test_substring_dedup(spark, empty, most_regions):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(9))
    passage = "".join(word() for _ in range(40))
    texts = ["".join(word() for _ in range(60)) for _ in range(8)]
    texts += [texts[0], texts[1][:150] + passage + texts[1][150:], passage[50:290] + texts[2], texts[3] + passage, texts[4][:250] + "!" + texts[4][250:], "ab" * 200, "a" * 3000 + "b" + "a" * 199, "xyz" + passage[:199], passage[3:], None, "", texts[5] + texts[5]]
    df = spark.createDataFrame([(i if i else None, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(3)
    got = {(x.doc_id, x.n_bytes): x for x in suffix.dedup_substrings(df, most_regions=most_regions).collect()}
    data, marks = brute_spans(texts)
    assert len(got) == len(texts)
    for i, (b, m) in enumerate(zip(data, marks)):
        x = got[i if i else None, len(b)]
        assert suffix.runs(np.flatnonzero(m)) == list(x.spans), i
        assert (x.n_removed, bytes(x.kept)) == (m.sum(), bytes(np.frombuffer(b, np.uint8)[~m]))
    assert suffix.dedup_substrings(empty).count() == 0


def test_regions_across_blocks(monkeypatch):
    """A start's name doesn't depend on where blocks end."""
    r = random.Random(9)
    a = np.frombuffer("".join(r.choice("abc ") for _ in range(6000)).encode() + b"ab" * 600, np.uint8)

    def names(block):
        monkeypatch.setattr(suffix, "BLOCK", block)
        out = np.zeros(len(a), np.uint64)
        for name, first, end, _ in suffix.regions(a):
            for n, x, y in zip(name, first, end, strict=True):
                out[x:y] = n
        return out

    whole = names(1 << 20)
    assert (whole[: len(a) - 199] != 0).all() and all((names(b) == whole).all() for b in (199, 700, 4096))


def test_substring_dedup_of_long_texts(spark):
    """A passage that lies across the end of a block of a text of over a megabyte."""
    r = random.Random(12)
    long = "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=suffix.BLOCK + 50_000))
    at = suffix.BLOCK - 150
    texts = [long, "left " + long[at : at + 260] + " right", "nothing " * 20]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: list(x.spans) for x in suffix.dedup_substrings(df).collect()}
    want = [at, at + 260]
    while long[want[1]] == " right"[want[1] - at - 260]:
        want[1] += 1
    while long[want[0] - 1] == "left "[want[0] - 1 - at]:
        want[0] -= 1
    n = want[1] - want[0]
    assert got == {0: want, 1: [5 - (at - want[0]), 5 - (at - want[0]) + n], 2: []}


def test_long_texts_of_lines_and_shingles(spark):
    """Line dedup of 60,000 lines, and fingerprints over several slices of 8,192 shingles."""
    lines = [f"line number {i % 50_000} of many" for i in range(60_000)]
    df = spark.createDataFrame([(2, "\n".join(lines)), (1, "x\n" + "\n".join(lines[100:40_000]) + "\ny")], "doc_id long, text string")
    out = {x.doc_id: x for x in line_dedup.dedup_lines(df).collect()}
    kept = [x for i, x in enumerate(lines) if not 100 <= i % 50_000 < 40_000]
    assert (out[2].n_lines, out[2].n_dropped, out[2].kept) == (60_000, 60_000 - len(kept), "\n".join(kept))
    assert (out[1].n_lines, out[1].n_dropped) == (39_902, 0)
    text = " ".join(f"w{i * i % 7919}" for i in range(20_000))
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_suffix_array():
    r = random.Random(1)
    for trial in range(150):
        k = r.choice([1, 2, 3, 26])
        strings = [bytes(r.randrange(k) + 97 * (trial % 3 > 0) for _ in range(r.randint(1, 40))) for _ in range(r.randint(1, 8))]
        strings += [strings[0] + strings[-1]] * (trial % 2 * 2)
        n = r.randint(1, 6)
        count = Counter(s[i : i + n] for s in strings for i in range(len(s) - n + 1))
        for s, at in zip(strings, suffix.repeated_starts(strings, n)):
            assert at.tolist() == [i for i in range(len(s) - n + 1) if count[s[i : i + n]] > 1]
        t = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + 1, 0) for s in strings]).astype(np.uint16)
        ends = np.flatnonzero(t == 0)
        unique = [(0, i) if c == 0 else (1, int(c)) for i, c in enumerate(t)]
        want = sorted(range(len(t)), key=lambda i: unique[i : ends[np.searchsorted(ends, i)] + 1])
        assert suffix.suffix_array(t, few=r.choice([0, 4, 512])).tolist() == want


def test_language_id(spark, empty):
    r = random.Random(6)
    sounds = {"aa": ["la", "mo", "ri", "te"], "bb": ["sch", "ung", "ert", "ka"], "cc": ["ção", "ão", "lh", "er"]}
    text = lambda k: " ".join("".join(r.choice(sounds[k]) for _ in range(r.randint(1, 4))) for _ in range(40))
    rows = [(i, text(k := r.choice("abc") * 2), k, 1) for i in range(600)]
    rows += [(600, None, "aa", 1), (601, "", "bb", 1), (602, "12 !?", "cc", 1), (603, text("aa"), None, 1), (None, text("bb"), "bb", 1), (604, text("cc") * 900, "cc", 1), (605, "日本語" * 40, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").repartition(3)
    model = langid.fit(df, ~langid.is_held_out(F.col("doc_id")))
    out = langid.identify(df, model).withColumn("h", langid.is_held_out(F.col("doc_id"))).collect()
    assert len(out) == len(rows) and all(0 <= x.score <= 1 for x in out)
    held = [x for x in out if x.h and x.lang and x.text and x.text[0].isalpha()]
    assert sum(x.lang == x.lang_pred for x in held) > 0.97 * len(held)
    got = {x.doc_id: x for x in out}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and not got[i].accepted for i in (600, 601, 602))
    assert not got[605].accepted and all(x.accepted for x in held)
    #: A key in a short text doesn't reject it; a text of nothing else goes.
    key = "zqxjkvwpyfhd" * 3
    assert model.judge(text("aa")[:60] + " " + key)[2] and not model.judge(key * 9)[2]
    assert langid.identify(empty, model).count() == 0
    nothing = langid.fit(empty, F.lit(True))
    assert {x.lang_pred for x in langid.identify(df, nothing).collect()} == {"und"}
    #: Probabilities after a context sum to one, and cached scores are those without a cache.
    kn = model.models["aa"]
    points = np.array([[32, ord("l"), ord("a"), s] for s in {ord(c) for w in sounds["aa"] for c in w} | {32}], np.uint32)
    assert 0.9 < np.exp(kn.log_probabilities(points)).sum() <= 1 + 1e-9
    s = langid.symbols(text("aa"))
    padded = np.concatenate([[32, 32], s]).astype(np.uint32)
    grams = np.stack([padded[k : k + len(s) - 1] for k in range(4)], 1)
    want = [-model.models[k].log_probabilities(grams).sum() for k in model.langs]
    assert np.allclose(model.entropies(s), want) and np.allclose(model.entropies(s), want)


def brute_kneser_ney(texts, order):
    """log p of each symbol of a text by the textbook's recursion over dictionaries of counts, without hashes or arrays."""
    clean = lambda t: " " * (order - 1) + "".join(re.findall(r".", re.sub(r"[^a-zà-ÿ]+", " ", " " + t.lower()), re.S))[1:]
    full = Counter()
    for t in texts:
        c = clean(t)
        full.update(c[i - order + 1 : i + 1] for i in range(order - 1, len(c)))
    tables = [full]
    for _ in range(order - 1):
        tables.append(Counter(g[1:] for g in tables[-1]))
    tables = tables[::-1]  # tables[k]: counts of k + 1 symbols, continuation counts below the highest order

    def p(context, w):
        if not context:
            below, k = 1 / (len(tables[0]) + 1), 0
        else:
            below, k = p(context[1:], w), len(context)
        t = tables[k]
        ones, twos = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        after = [v for g, v in t.items() if g[:-1] == context]
        if not after:
            return below
        seen = t.get(context + w, 0)
        return (seen - d if seen else 0) / sum(after) + d * len(after) / sum(after) * below

    return lambda t: sum(math.log(p(c[i - order + 1 : i], c[i])) for c in [clean(t)] for i in range(order - 1, len(c)))


def test_kneser_ney(spark):
    """Cross-entropies against the textbook's formula, on texts with unseen symbols and contexts too."""
    r = random.Random(3)
    corpus = {"x": ["".join(r.choice("abc dé") for _ in range(40)) for _ in range(12)], "y": ["".join(r.choice("xyz ba") for _ in range(40)) for _ in range(12)]}
    rows = [(i, t, k) for i, (k, t) in enumerate((k, t) for k, ts in corpus.items() for t in ts)]
    #: Which of them calibrate depends on a hash; the others are learned from.
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {x: [r.text for r in langid.sample(df, F.lit(True)).where("not calibrate").collect() if r.lang == x] for x in corpus}
    model = langid.fit(df, F.lit(True))
    assert model.langs == ["x", "y"] and all(learned.values())
    brute = {x: brute_kneser_ney(ts, langid.ORDER) for x, ts in learned.items()}
    for t in [corpus["x"][0], corpus["y"][3], "abba zq  qq é", "q"]:
        want = [-brute[x](t) for x in model.langs]
        assert np.allclose(model.entropies(langid.symbols(t)), want), t
        assert model.judge(t)[0] == model.langs[int(np.argmin(want))]


def test_many_labels(spark):
    """No label is left out, and the cache of a worker stays in its bounds."""
    rows = [(10 * i + j, f"{chr(0x4E00 + i) * 3} {chr(0x4E00 + i)}a" * 4, f"l{i:03d}") for i in range(300) for j in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, F.lit(True))
    assert len(model.langs) == 300 and (8 << model.bits()) * 301 <= langid.CACHE_BYTES
    assert langid.identify(df, model).where("lang_pred <> lang").count() == 0


def test_long_text_language(spark):
    """A text of several pieces has the sums of all its symbols."""
    r = random.Random(2)
    model = langid.Model({"a": langid.KneserNey(Counter("".join(r.choice("abcd ") for _ in range(4)) for _ in range(400)))})
    s = langid.symbols("".join(r.choice("abcd ") for _ in range(langid.PIECE * 2 + 77)))
    whole = model.entropies(s)
    piece, langid.PIECE = langid.PIECE, 1 << 12
    parts = model.entropies(s)
    langid.PIECE = piece
    assert len(s) > 1.2 * langid.PIECE and np.allclose(whole, parts, rtol=1e-9)


def test_digests():
    assert line_dedup.digest("a") == suffix.digest(b"a") == hashlib.sha256(b"a").hexdigest()


def brute_jaccard(texts, similarity=(8, 10)):
    """Roots (the smallest index) by exact Jaccard similarity of five-word shingles, and the pairs."""
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", fold(t or "").encode())
        sets.append({b" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    roots, pairs = list(range(len(texts))), []
    for b in range(len(sets)):
        for a in range(b):
            both = len(sets[a] & sets[b])
            if similarity[1] * both >= similarity[0] * (len(sets[a]) + len(sets[b]) - both):
                pairs.append((a, b))
                x, y = sorted((roots[a], roots[b]))
                roots = [x if r == y else r for r in roots]
    return roots, pairs


@pytest.mark.parametrize("tile", [3, 2048])
def test_near_copies(spark, docs, empty, tile):
    """Cut, appended and scattered copies on both sides of the limit, and short texts, against exact Jaccard."""
    r = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    many = []
    for n in (9, 24, 60, 200, 700):
        for _ in range(6):
            b = [r.choice(words) for _ in range(n)]
            share = r.choice([0.05, 0.1, 0.15, 0.18, 0.3])
            k, at = max(1, int(n * share)), r.randrange(n // 2)
            scattered = set(r.sample(range(n), max(1, k // 5)))
            many += [b, b[k:], b[: at] + b[at + k :], b + [r.choice(words) for _ in range(k)], [r.choice(words) if i in scattered else w for i, w in enumerate(b)]]
    every = [x.text for x in docs.collect()] + [" ".join(t) for t in many]
    table = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    roots, pairs = brute_jaccard(every)
    got = {x.doc_id: x for x in near_copies.near_copies(table, tile=tile, family=tile).collect()}
    assert len(pairs) > 60 and {i: x.component_id for i, x in got.items()} == dict(enumerate(roots))
    assert all(x.first == (i == roots[i]) for i, x in got.items())
    assert near_copies.near_copies(empty).count() == 0
    alone = " ".join(f"alone{i}" for i in range(30))
    more = table.union(spark.createDataFrame([(None, every[0]), (None, alone), (None, alone + " end"), (None, alone)], table.schema))
    out = near_copies.near_copies(more, tile=tile, family=tile).collect()
    assert {x.doc_id: x.component_id for x in out if x.doc_id is not None} == {i: x.component_id for i, x in got.items()}
    lone = [x for x in out if x.doc_id is None]
    assert sorted((x.component_id is None, x.first) for x in lone)[:1] == [(False, False)] and len({x.rk for x in lone if x.first}) == 1
    #: The old rule: words' fingerprints within 6 bits and 512 bits within the limit lose some of these.
    sig = [brute_signature(t) for t in every]
    assert any((sig[a][0] ^ sig[b][0]).bit_count() > 6 or (sig[a][1] ^ sig[b][1]).bit_count() > simhash.wide_limit() for a, b in pairs)


def test_near_copies_recall():
    """Pairs of similarity 0.8 share a band about as often as is stated, and are within the limits of the bucket."""
    r = np.random.default_rng(3)
    lost = 0
    for n in (5, 50, 500):
        for _ in range(700):
            h = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            a, b = np.unique(h), np.unique(h[: n * 4 // 5])
            lost += not (near_copies.band_keys(a) == near_copies.band_keys(b)).any()
            bits = np.bitwise_count(simhash.majority(simhash.widened(a)) ^ simhash.majority(simhash.widened(b)))
            assert bits.sum() <= near_copies.LOOSE and bits[0] <= near_copies.LANE_RADIUS
    assert lost <= 2


def test_sharding_beside_other_writers(spark):
    """A compaction that another writer's commit overtakes ends on top of it, or is planned anew; nothing is lost, files of
    nobody go; columns may be named like the store's own."""
    rows = [(i, f"text {i} " * 20, i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, _run string, _path long").withColumns({"_row": F.lit(1), "shard": F.lit("x")})

    class Raced(sharding.Store):
        others = 0

        def _rewrite(self, *args):
            out = super()._rewrite(*args)
            if self.others:
                self.others -= 1
                other = sharding.Store(self.spark, self.root, self.target, self.fanout)
                other.append(df.limit(7))
                if self.others:
                    other.compact()
            return out

    #: Of two others the first appends and compacts, so nothing is left to do in the second round.
    for others, extra in ((1, 7), (2, 7)):
        store = Raced(spark, new_folder(spark, "raced"), target=1 << 16, fanout=2)
        store.append(df.repartition(6))
        store.others = others
        store.compact()
        out = store.read()
        assert out.count() == 300 + extra and out.columns == [*df.columns, "_shard"]
        assert out.dropDuplicates().where("shard = 'x' and _row = 1").select("doc_id").distinct().count() == 300
        fs, p = sharding.hadoop_path(spark, f"{store.root}/data/lost/part-0.parquet")
        fs.create(p).close()
        store.vacuum()
        assert fs.exists(p)
        store.vacuum(grace=-5)
        assert not fs.exists(p) and store.read().count() == 300 + extra


def test_sharding_of_several_arrivals(spark, tmp_path):
    """The query over a table of several files, in a folder with a blank and a percent sign, and over one file."""
    rows = [(i, f"text {i} " * 50 if i % 7 else None, "en", f"s{i % 3}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for folder, files in (("odd %20 dir", 6), ("one", 1)):
        sf_dir = str(tmp_path / folder)
        df.repartition(files).write.parquet(f"{sf_dir}/documents.parquet")
        parts = list(queries.arrivals(spark, sf_dir, "documents", 4))
        assert len(parts) == min(files, 4) and sum(p.count() for p in parts) == 400
        got = queries.op7_sharding(spark, sf_dir).collect()
        assert sorted(r.doc_id for r in got) == list(range(400)) and all((r.text_sha256 is None) == (r.doc_id % 7 == 0) for r in got)
        #: Four small shards of a tier, one from each arrival (or two), are one run.
        assert len({r.shard for r in got}) <= min(files, 3)


def test_sharding_large_partition(spark):
    """One arrival of one large partition: small shards that tiers merge, or one shard that is split; then near the target."""
    r = random.Random(8)
    rows = [(i, "".join(chr(r.randrange(33, 0x250)) for _ in range(r.randint(1, 1500)))) for i in range(7000)]
    one = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    target = 1 << 20
    for small_rows in (0, 10**9):
        store = sharding.Store(spark, new_folder(spark, "test"), target=target)
        arrived = store.append(one, small_rows)["shards"]
        assert sum(s["bytes"] for s in arrived) > 5 * target
        assert len(arrived) == 1 if small_rows else max(s["bytes"] for s in arrived) < target / 2
        sizes = sorted(s["bytes"] for s in store.compact()["shards"])
        near = [x for x in sizes if 0.6 * target <= x <= sharding.BEYOND * target]
        assert sizes[-1] <= sharding.BEYOND * target and len(near) >= len(sizes) - 3 and sum(near) > 0.8 * sum(sizes)
        store.vacuum()
        assert sorted(map(tuple, store.read().drop("shard").collect())) == rows
