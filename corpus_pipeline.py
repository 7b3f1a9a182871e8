"""A cleaning pipeline over `documents`: language ID, near-dedup, decontamination, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from landscore.llm import decontaminate, langid, mixing, near_copies, sharding
from landscore.llm.common import fresh, new_folder, row_key, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def keyed(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The rows with their row_key() in two columns of free names, and those names."""
    did, rk = fresh(docs.columns, "did", "rk")
    return docs.withColumns(dict(zip((did, rk), row_key(F.col("doc_id"), F.col("text")), strict=True))), did, rk


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Learned from those that aren't held out.

    Null text, empty text and text without letters are rejected; a null id counts as held out; rows are judged one by one, so
    repeated rows all stay or all go; ties between languages reject nothing; an empty table gives an empty one; all columns
    are kept, whatever their names."""
    model = langid.fit(docs, ~langid.is_held_out(F.col("doc_id")))
    (name,) = fresh(docs.columns, "judged")
    return langid.judged(docs, model, name).where(F.col(f"`{name}`.accepted")).select(*columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, exact Jaccard similarity of 0.8 or more): that of the
    smallest id.

    Null and empty texts are copies of each other; texts that share an id are documents of their own, of these the one with
    the smallest hash stays; rows without an id take part, behind those with one; of rows with the same id and text the
    first by their other columns stays; an empty table gives an empty one; all columns are kept, whatever their names."""
    own, did, rk = keyed(docs)
    near = near_copies.near_copies(docs).where("first")
    groups = near.select(F.col("did").alias(f"{did}_of"), F.col("rk").alias(f"{rk}_of")).distinct()
    kept = own.join(groups, (F.col(did) == F.col(f"{did}_of")) & (F.col(rk) == F.col(f"{rk}_of")), "left_semi")
    (place,) = fresh(own.columns, "place")
    others = [F.col(f"`{c}`") if not t.startswith(("map", "variant")) else F.col(f"`{c}`").cast("string") for c, t in docs.dtypes if c.lower() not in ("doc_id", "text")]
    first = F.row_number().over(Window.partitionBy(did, rk).orderBy(*(others or [F.col(rk)])))
    return kept.withColumn(place, first).where(F.col(place) == 1).select(*columns(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages of weight.

    Rows are judged one by one by their texts, those without an id too, and repeated rows share their fate; null and empty
    texts have no words and stay; an empty table, or an empty benchmark, takes nothing away; all columns are kept, whatever
    their names."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    own, did, rk = keyed(docs)
    gone = found.where("contaminated").select(row_key(F.col("doc_id"), F.lit(None))[0].alias(f"{did}_of"), F.col("rk").alias(f"{rk}_of")).distinct()
    return own.join(gone, (F.col(did) == F.col(f"{did}_of")) & (F.col(rk) == F.col(f"{rk}_of")), "left_anti").select(*columns(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source of its own; texts without words are never taken; repeated rows are drawn one by one, ties in
    the order of hashes, so reruns agree; a null id is drawn like any other; an empty table gives an empty one; all columns
    are kept, whatever their names."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in shards of the target size, each row with its shard (column shard; _shard ... if there is one already).

    Rows are stored as they are, nulls, long texts and repeated rows included; an empty table gives an empty one with the
    column; all columns are kept, whatever their names."""
    store = sharding.Store(spark, new_folder(spark, "store"))
    store.append(docs)
    store.compact()
    store.vacuum()
    return store.read()


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Fingerprints, language models and shard layout aren't SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
