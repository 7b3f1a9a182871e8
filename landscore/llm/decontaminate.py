"""Benchmark decontamination with a positional inverted index over the training documents. DataFrame functions only.

Words are maximal runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z are lower-cased. A window is 13 consecutive words
of an item (all of them, if it has fewer).

1. Collection frequencies of all test terms, counted over all documents.
2. Windows of the same words are one, placed where the benchmark has it first. Its two rarest positions are its anchors; the
   index keeps postings (term, document, position) of anchor terms, and one of the empty term at the end of each document,
   which holds its length.
3. Offset-adjusted intersection: posting position minus item position is the diagonal on which the item would lie; a window
   may start on a diagonal that both its anchors' lists have.
4. What remains is intersected with the postings of all words of those documents: a window is there if each of its words
   stands at its place. Every step is a join or an aggregate of small rows; no list is gathered for a document or an item,
   so neither periodic texts nor items found everywhere make a large row.

Defined cases: null or empty text has no words (n_words 0, not contaminated); items without words match nothing; rows
that repeat a doc_id are judged by their own texts and all returned; a null doc_id is returned as null; repeated items
count once; null item_id marks words as hit but is not listed. Other columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import folded, row_key, sized, stage

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: FOUND_ROWS: so many documents (two numbers each) that may hold a window are broadcast at most.
WINDOW, FOUND_ROWS = 13, 500_000


def words(text: Column) -> Column:
    """The words of a text, in order; an empty array for null."""
    return F.coalesce(F.array_remove(F.split(folded(text), NOT_WORD), ""), F.array().cast("array<string>"))


def keyed(docs: DataFrame) -> DataFrame:
    did, rk = row_key(F.col("doc_id"), F.col("text"))
    return docs.select("doc_id", "text").select("doc_id", did.alias("did"), rk.alias("rk"), words(F.col("text")).alias("words"))


def test_items(items: DataFrame) -> DataFrame:
    """item_id, item_key, words: distinct items that have words."""
    w = items.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    return w.withColumn("item_key", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), F.concat_ws(" ", "words")))


def term_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of each of the terms in all documents."""
    tokens = keyed(docs).select(F.explode("words").alias("term"))
    return tokens.join(sized(terms), "term").groupBy("term").agg(F.count("*").alias("freq"))


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, did, rk, doc_id, pos) of the terms in all documents, and one of the empty term at each end."""
    wanted = terms.select("term").union(terms.sparkSession.createDataFrame([("",)], "term string"))
    wanted = sized(stage(wanted, "terms"))
    tokens = keyed(docs).select("doc_id", "did", "rk", F.posexplode(F.array_append("words", F.lit(""))).alias("pos", "term"))
    return stage(tokens.join(wanted, "term"), "postings")


def windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(win, item_key, s, terms): each different window once, at one of its places; (win, item_id): all items that have it."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    each = items.select("item_key", "item_id", "words", F.explode(starts).alias("s"))
    each = stage(each.select("item_key", "item_id", "s", F.slice("words", F.col("s") + 1, F.lit(window)).alias("terms")), "windows")
    once = each.groupBy("terms").agg(F.min(F.struct("item_key", "s")).alias("at"))
    once = stage(once.select(F.monotonically_increasing_id().alias("win"), "at.item_key", "at.s", "terms"), "distinct_windows")
    return once, stage(each.join(once.select("win", "terms"), "terms").select("win", "item_id").distinct(), "window_items")


def anchored(wins: DataFrame, freqs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, pair, role, ipos): the anchors, role 1 and 2; (pair, need, win, s): the windows of each pair of anchors. Windows of
    one item with the same two rarest positions share a pair; a window of one word needs role 1 only."""
    at = wins.select("win", "item_key", "s", F.posexplode("terms").alias("i", "term")).join(freqs, "term", "left")
    entry = F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), (F.col("s") + F.col("i")).alias("ipos"), "term")
    ranked = at.groupBy("win", "item_key", "s").agg(F.array_sort(F.collect_list(entry)).alias("seen"))
    ranked = ranked.select("win", "item_key", "s", F.get("seen", F.lit(0)).alias("x"), F.get("seen", F.lit(1)).alias("y"))
    pair = F.struct("item_key", F.col("x.ipos").alias("x"), F.col("y.ipos").alias("y"))
    ranked = stage(ranked.withColumn("at", pair), "ranked")
    pairs = stage(ranked.groupBy("at").agg(F.first(F.struct("x", "y")).alias("ends")).withColumn("pair", F.monotonically_increasing_id()), "pairs")
    role = lambda c, i: F.struct(F.col(f"ends.{c}.term").alias("term"), F.lit(i).alias("role"), F.col(f"ends.{c}.ipos").alias("ipos"))
    ends = pairs.select("pair", F.explode(F.array(role("x", 1), role("y", 2))).alias("e")).select("e.term", "pair", "e.role", "e.ipos").where("ipos is not null")
    need = F.when(F.col("y").isNull(), 1).otherwise(3).alias("need")
    return stage(ends, "anchors"), stage(ranked.join(pairs.select("at", "pair"), "at").select("pair", need, "win", "s"), "pair_windows")


def phrase_hits(docs: DataFrame, wins: DataFrame, anchors: DataFrame, of_pairs: DataFrame, index: DataFrame) -> DataFrame:
    """did, rk, start, n, win: where windows stand in documents, word by word."""
    lists = index.where("term <> ''").select("term", "did", "rk", "pos")
    on = lists.join(sized(anchors), "term").select("did", "rk", "pair", (F.col("pos") - F.col("ipos")).alias("diag"), "role")
    met = on.groupBy("did", "rk", "pair", "diag").agg(F.bit_or("role").alias("met"))
    found = met.join(sized(of_pairs), "pair").where("met = need").select("did", "rk", (F.col("diag") + F.col("s")).alias("start"), "win").where("start >= 0")
    found = stage(found, "candidates")
    asked = found.join(sized(wins.select("win", "terms")), "win").select("did", "rk", "start", "win", F.size("terms").alias("n"), F.posexplode("terms").alias("i", "term"))
    asked = asked.withColumn("pos", F.col("start") + F.col("i"))
    did, rk = row_key(F.col("doc_id"), F.col("text"))
    some = sized(stage(found.select("did", "rk").distinct(), "found"), FOUND_ROWS)
    there = docs.select(did.alias("did"), rk.alias("rk"), "text").join(some, ["did", "rk"], "left_semi")
    there = there.select("did", "rk", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    same = asked.join(there, ["did", "rk", "pos", "term"])
    seen = same.groupBy("did", "rk", "start", "n", "win").agg(F.bit_or(F.expr("shiftleft(1L, i)")).alias("seen"))
    return seen.where("seen = shiftleft(1L, n) - 1").drop("seen")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, rk (xxhash64 of id and text), n_words, n_hit, n_items, items (array of string), contaminated; one row for each
    input row."""
    if not 0 < window < 63:
        raise ValueError("a window has 1 to 62 words")
    items = stage(test_items(benchmark), "items")
    terms = stage(items.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    freqs = stage(term_frequencies(docs, terms), "frequencies")
    wins, of_items = windows(items, window)
    anchors, of_pairs = anchored(wins, freqs)
    index = build_index(docs, anchors.select("term").distinct())
    hits = stage(phrase_hits(docs, wins, anchors, of_pairs, index), "hits")
    places = hits.select("did", "rk", "start", "n").distinct().select("did", "rk", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos"))
    n_hit = places.distinct().groupBy("did", "rk").agg(F.count("*").alias("n_hit"))
    listed = hits.select("did", "rk", "win").distinct().join(sized(of_items), "win").select("did", "rk", F.col("item_id").cast("string").alias("item")).where("item is not null")
    listed = listed.distinct().groupBy("did", "rk").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = n_hit.join(listed, ["did", "rk"], "left")
    rows = index.where("term = ''").select("doc_id", "did", "rk", F.col("pos").cast("long").alias("n_words"))
    out = rows.join(hits, ["did", "rk"], "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    out = out.withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return out.select("doc_id", "rk", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", contaminated.alias("contaminated"))


def proximity(docs: DataFrame, queries: DataFrame, width: int) -> DataFrame:
    """item_id, doc_id, pos: where all distinct words of a query's text lie within `width` words that start at pos (one of
    them). From the same postings lists; rows that repeat a document count once."""
    items = stage(test_items(queries).withColumn("words", F.array_distinct("words")), "near_items")
    terms = stage(items.select("item_key", "item_id", F.size("words").alias("n"), F.explode("words").alias("term")), "near_terms")
    index = build_index(docs, terms.select("term").distinct()).where("term <> ''").distinct()
    ahead = Window.partitionBy("did", "rk", "item_key").orderBy("pos").rangeBetween(0, width - 1)
    on = index.join(sized(terms), "term").withColumn("near", F.size(F.collect_set("term").over(ahead)))
    return on.where("near = n").select("item_id", "doc_id", "pos")
