"""From documents to packed training sequences: toxic and poor documents go, one of each near-duplicate group stays,
sources are mixed to target weights, and what is left is packed along a space-filling curve.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet to the shared folder and
reads it again as the next one's docs, so a lost executor costs one stage's tasks at most. All stages but the last return
the columns of documents, further columns of any name with them, and rows as they came but for what mixing draws in part.

Odd rows, in every stage: an empty table gives no rows; a null doc_id, language or source is a value like others (but a row
without doc_id is never a near-duplicate); a very long text is read whole. A null or empty text has no words: toxicity
scores it as such, the quality rules reject it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almanac.llm import mixing, near_dup, packing, quality, tables, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's toxicity threshold; the classifier learns from labels of these docs. Repeated rows share a score; without labels of both kinds all stay."""
    return toxicity.clean_documents(docs, tables.read(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie inside their language's and source's thresholds. Repeated rows are judged alike and counted each."""
    return quality.good_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of linked documents (five-word shingles, 0.8). Rows and texts that share this doc_id stay together."""
    return near_dup.distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them. Those without words are not drawn; repeated rows are drawn alike; a source's last document may be drawn in part."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens. A text without words is its closing id alone; repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Training, MinHash and tokenising are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = tables.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = tables.stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:  # written, so the stage before is not read again
            tables.drop(before)
        before = docs
    return docs
