"""Reading tables, cutting lineage in the shared folder, and broadcasting only what has been counted."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType

from almanac.runtime import delete, give_back, new_folder, shared_dir, ship  # noqa: F401

#: Words by ASCII white space, as a Java and as a DuckDB regular expression.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]*"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read again: later steps neither repeat its work nor lose it with an executor."""
    spark = df.sparkSession
    ship(spark)
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    if _scopes:
        _scopes[-1][path] = False
    return out


#: Tables stored by each tidy function that runs, and whether they outlast it.
_scopes: list[dict[str, bool]] = []


def keep(df: DataFrame) -> DataFrame:
    """Marks a stored table that the result of the tidy function around still reads."""
    if _scopes:
        _scopes[-1][df._stored_at] = True
    return df


def drop(df: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    for scope in _scopes:
        scope.pop(df._stored_at, None)
    with contextlib.suppress(Exception):  # it goes with the application at the latest
        delete(df.sparkSession, df._stored_at)


def tidy(f: Callable) -> Callable:
    """When f returns, the tables that it stored go, but for those it marked with keep(); they are the next tidy function's. What the driver holds of f's jobs is given back."""

    @functools.wraps(f)
    def run(*args, **kwargs):
        _scopes.append({})
        try:
            out = f(*args, **kwargs)
        except BaseException:
            _scopes.pop()  # left to the end of the application
            raise
        scope = _scopes.pop()
        spark = SparkSession.getActiveSession()
        for path, kept in scope.items():
            if kept and _scopes:
                _scopes[-1][path] = False
            elif not kept:
                with contextlib.suppress(Exception):
                    delete(spark, path)
        if scope and spark:
            give_back(spark)
        return out

    return run


#: A table of more bytes than this is not broadcast, however few its rows.
MOST_BYTES = 64 << 20


def _bytes(field: StructField) -> Column:
    """About how many bytes a column's value takes."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, StringType | BinaryType):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if isinstance(field.dataType, ArrayType | MapType | StructType):
        return F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) + 32
    return F.lit(16)


def small(df: DataFrame, most: int, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Marks a stored table for broadcast if it is counted to have at most `most` rows and most_bytes; else the join shuffles, with skewed keys split by AQE."""
    n, size = df.agg(F.count("*"), F.sum(sum(map(_bytes, df.schema.fields), F.lit(0)))).first()
    return F.broadcast(df) if n <= most and (size or 0) <= most_bytes else df.hint("merge")
