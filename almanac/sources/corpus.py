"""The corpus as files: read with the declared schema, written partitioned by language so that a language prunes files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from almanac import schemas

FORMATS = ("parquet", "json", "csv", "orc")


def read(spark: SparkSession, path: str, table: str, format: str = "parquet") -> DataFrame:
    """A corpus table (articles, sections, geotags, langlinks, editions) from files."""
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    options = {"header": "true", "multiLine": "true", "escape": '"'} if format == "csv" else {}
    return spark.read.schema(schemas.TABLES[table]).format(format).options(**options).load(path)


def write(df: DataFrame, path: str, table: str, format: str = "parquet", mode: str = "errorifexists") -> None:
    """Writes a corpus table; tables with a language are partitioned by it and sorted by title, so lookups skip row groups."""
    if format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    by = next((c for c in ("lang", "source_lang") if c in df.columns), None)
    options = {"header": "true", "escape": '"'} if format == "csv" else {}
    if by and format in ("parquet", "orc"):
        key = next(c for c in ("title", "source_title") if c in df.columns)
        # ranges over language and title: one language of any size spreads over many tasks and files
        df = df.repartitionByRange(by, key).sortWithinPartitions(by, key)
        df.write.mode(mode).format(format).options(**options).partitionBy(by).save(path)
    else:
        df.write.mode(mode).format(format).options(**options).save(path)
