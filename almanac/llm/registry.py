"""Queries and SQL of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import licenses, mixing, near_dup, oracles, packing, quality, sharding, toxicity, url_filter, vector_search, warc
from almanac.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_url_filters": oracles.URLS,
    "op4_vector_search": oracles.VECTORS,
    "op6_quality_rules": oracles.QUALITY,
    "op7_license_scans": oracles.LICENSES,
    "op8_mixing": oracles.MIXING,
    "op9_warc": oracles.WARC,
    "op10_near_dedup": oracles.NEAR,
}


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


@_query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents"), ["doc_id"])


@_query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    rules = url_filter.rule_table(spark, url_filter.RULES, url_filter.LISTED)
    return url_filter.judge(pages, rules).withColumnRenamed("id", "page_id")


@_query
def op4_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(read(spark, sf_dir, "embeddings"))


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.rules(read(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("spans")


@_query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    each = F.transform("draws", lambda d: F.concat_ws(":", *[d[c].cast("string") for c in ("pass", "words", "shard", "quota", "place")]))
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.size("draws").alias("n_draws"), F.array_join(each, ";").alias("draws"))


@_query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write(read(spark, sf_dir, "pages"))
    return warc.read(manifest).drop("url")


@_query
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents"), shingle=2)
