"""The operators' queries over whole tables, in the form of their contracts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, langid, license_scan, line_dedup, mixing, sharding, simhash, suffix, token_counts, topk
from .common import new_folder

TOKENIZER = "byte_bpe_50k.json"
ARRIVALS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "items"), 256)
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents"), license_scan.template_table(spark))
    return out.select("doc_id", F.size("templates").cast("long").alias("n_templates"), F.concat_ws(",", "templates").alias("templates"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def arrivals(spark: SparkSession, sf_dir: str, name: str, most: int) -> Iterator[DataFrame]:
    """A table's rows in at most so many parts, each of files of its own."""
    path = f"{sf_dir}/{name}.parquet"
    whole = spark.read.parquet(path)
    files = sorted(unquote(f) for f in whole.inputFiles())  # given as encoded URIs
    if len(files) < 2:
        yield whole
        return
    for k in range(most):
        own = files[k * len(files) // most : (k + 1) * len(files) // most]
        if own:
            yield spark.read.schema(whole.schema).option("basePath", path).parquet(*own)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compacted store's rows, each with the shard that holds it, read through the manifest. The table comes in ARRIVALS
    arrivals, or one for each file if there are fewer; each is followed by a compaction."""
    store = sharding.Store(spark, new_folder(spark, "store"))
    for docs in arrivals(spark, sf_dir, "documents", ARRIVALS):
        store.append(docs)
        store.compact()
        store.vacuum()
    #: The version that wrote it, and a merged run, or a part of an arrival and its file's number; the rest is random.
    part = F.concat(F.regexp_extract("shard", r"(part-\d+)", 1), F.regexp_extract("shard", r"(-c\d+)\.", 1))
    own = F.when(F.col("shard").contains("_run="), F.regexp_extract("shard", r"(_run=\d+)", 1)).otherwise(part)
    shard = F.concat_ws("/", F.regexp_extract("shard", r"^(\d+)-", 1), own)
    return store.read().select("doc_id", F.sha2(F.col("text"), 256).alias("text_sha256"), "lang", "source", "n_chars", shard.alias("shard"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.dedup_substrings(table(spark, sf_dir, "documents"))
    n_spans = F.floor(F.size("spans") / 2).cast("long")
    return out.select("doc_id", "n_bytes", "n_removed", n_spans.alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.is_held_out(F.col("doc_id"))
    model = langid.fit(docs, ~held_out)
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", langid.is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_decontamination, op2_token_counts, op3_simhash, op4_license_scan, op5_exact_top_k, op6_line_dedup, op7_sharding, op8_mixing, op9_substring_dedup, op10_language_id)
    return {f.__name__: f for f in ops}
