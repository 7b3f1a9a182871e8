"""Each stage of the pipeline on its predecessor's rows, against brute force."""

from collections import Counter

import corpus_pipeline as cp
from landscore.llm import langid, mixing
from landscore.llm.common import stage
from pyspark.sql import functions as F

from .test_operators import WORD, brute_jaccard, fold

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    odd = spark.createDataFrame([(900, None, "en", "src0", 0), (901, "12 34 !!", None, None, 8), (None, docs.first().text, None, None, 0)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.where("doc_id = 3")).cache()
    columns, steps = docs.columns, dict(cp.STAGES)

    kept = steps["language_id"](spark, docs, DIR).cache()
    model = langid.fit(docs, ~langid.is_held_out(F.col("doc_id")))
    want = [r for r in docs.collect() if model.judge(r.text)[2]]
    assert kept.columns == columns and Counter(kept.collect()) == Counter(want)
    assert kept.where("doc_id in (900, 901)").count() == 0 and kept.count() >= 199

    #: By exact Jaccard similarity, as the stage's contract has it; a copy without an id goes, and repeated rows.
    single = steps["simhash_near_dedup"](spark, kept, DIR).cache()
    rows = sorted(kept.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    roots, pairs = brute_jaccard([r.text for r in rows])
    assert Counter(single.collect()) == Counter(rows[i] for i in set(roots))
    assert single.columns == columns and single.where("doc_id is null").count() == 0 and len(pairs) > 2

    clean = steps["decontamination"](spark, single, DIR).cache()
    windows = set()
    for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect():
        b = WORD.findall(fold(r.text or ""))
        n = min(13, len(b))
        windows |= {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if b else set()
    sizes, want = {len(w) for w in windows}, []
    for r in single.collect():
        w, hit = WORD.findall(fold(r.text or "")), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
        if not hit or 20 * len(hit) < len(w):
            want.append(r)
    assert Counter(clean.collect()) == Counter(want) and len(want) < single.count()
    bad = next(r for r in single.collect() if r not in want)
    no_id = spark.createDataFrame([(None, bad.text, None, None, None)], docs.schema)
    assert steps["decontamination"](spark, no_id, DIR).count() == 0

    mix = steps["mixing"](spark, clean, DIR).cache()
    copies = {r.doc_id: r.copies for r in mixing.shares(clean).collect()}
    assert mix.columns == columns and Counter(r.doc_id for r in mix.collect()) == Counter({k: v for k, v in copies.items() if v})
    shards = steps["sharding"](spark, mix, DIR)
    assert Counter(shards.select(*columns).collect()) == Counter(mix.collect()) and shards.where("shard is null").count() == 0


def test_near_dedup_of_shared_ids(spark):
    """Unrelated texts of one id stay, whichever row comes first; of rows with one id and text the first by the others."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a, "xx", "s", 1), (1, b, "en", "s", 1), (2, b, "en", "s", 1), (1, a, "en", "s", 1), (3, a + " more", "en", "s", 1)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string, source string, n_chars long")
        out = dict(cp.STAGES)["simhash_near_dedup"](spark, docs, DIR)
        assert sorted(map(tuple, out.collect())) == [rows[3], rows[1]]


#: Names that operators use or used for columns of their own.
CLASHING = "score lang_pred accepted _judged judged _lang _id _rk rk did _key copies shard _run _path _row own first place rk_of did_of _n n_words target size bucket local s b key spot row".split()


def test_clashing_columns_and_empty_tables(spark):
    """Every stage keeps columns of any names, and takes an empty table."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet").where("doc_id < 60")
    more = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)], F.create_map(F.lit("a"), F.lit(1)).alias("spots"))
    for table, least in ((more, 20), (more.limit(0), 0)):
        plain = docs if least else docs.limit(0)
        for name, step in cp.STAGES:
            table, plain = (stage(step(spark, x, DIR), name) for x in (table, plain))
            assert table.columns == more.columns + ["_shard"] * (name == "sharding")
            got = table.drop("spots").collect()
            assert Counter(r[: len(docs.columns)] for r in got) == Counter(r[: len(docs.columns)] for r in plain.collect()) and len(got) >= least
            assert all(r[c] == i for r in got for i, c in enumerate(CLASHING))
