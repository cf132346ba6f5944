"""Extras beyond the lookups: querying, upserting and exporting tables of one's own (a workspace and a local mirror)."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_COMPARE = {"eq": operator.eq, "ne": operator.ne, "gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}
MOST_ROWS = 10_000


def condition(filters: list[tuple[str, str, object]]) -> Column:
    """(column, op, value) joined by AND; op is one of eq ne gt gte lt lte in."""
    out = F.lit(True)
    for column, op, value in filters:
        if op == "in":
            out = out & F.col(column).isin(list(value))
        elif op in _COMPARE:
            out = out & _COMPARE[op](F.col(column), F.lit(value))
        else:
            raise ValueError(f"unknown comparison {op!r}")
    return out


def query(table: DataFrame, filters=(), sort: list[tuple[str, str]] = (), limit: int | None = None, offset: int = 0) -> DataFrame:
    df = table.where(condition(list(filters))) if filters else table
    if sort:
        df = df.orderBy(*[F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in sort])
    if offset:
        df = df.offset(offset)
    return df if limit is None else df.limit(limit)


def capped(df: DataFrame, most: int = MOST_ROWS) -> tuple[DataFrame, bool]:
    """At most `most` rows, and whether there were more."""
    return df.limit(most), df.limit(most + 1).count() > most


def latest(changes: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last change of each key; of several of equal order, the one whose row is greatest by hash, so that reruns agree."""
    last = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(order).desc_nulls_last(), F.xxhash64(*changes.columns)))
    return changes.withColumn("_n", last).where("_n = 1").drop("_n")


def merged(current: DataFrame, changes: DataFrame, key: list[str], order: str, deleted: str = "deleted") -> DataFrame:
    """current with the last change of each key, where it is not older than the row it meets; deleted rows stay, marked, so that a late change does not revive them.

    current has the columns of the result, `order` and `deleted` among them. One shuffle by key.
    """
    rows = latest(changes, key, order).withColumn(deleted, F.coalesce(F.col(deleted), F.lit(False))).select(current.columns)
    # of rows that are equally old the change counts: it came later
    both = current.withColumn("_late", F.lit(0)).unionByName(rows.withColumn("_late", F.lit(1)))
    last = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(order).desc_nulls_last(), F.col("_late").desc()))
    return both.withColumn("_n", last).where("_n = 1").drop("_n", "_late")


def upsert(current: DataFrame, changes: DataFrame, key: list[str], order: str, deleted: str = "deleted") -> DataFrame:
    """current with the last change of each key applied; a change marked deleted removes its row.

    If current has the order column, an older change leaves a newer row as it is. Rows removed are forgotten: a table that late
    changes may reach keeps them (see merged).
    """
    marked = current.withColumn("_gone", F.lit(False))
    timed = marked if order in current.columns else marked.withColumn(order, F.lit(None).cast(changes.schema[order].dataType))
    new = changes.withColumn("_gone", F.coalesce(F.col(deleted), F.lit(False)))
    return merged(timed, new.select(timed.columns), key, order, "_gone").where(~F.col("_gone")).select(current.columns)


class Workspace:
    """Named tables for SQL in one session."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []

    def register(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        self.names.append(name)

    def load(self, name: str, path: str, schema: str, format: str = "csv") -> None:
        reader = self.spark.read.schema(schema).format(format)
        self.register(name, (reader.option("header", "true") if format == "csv" else reader).load(path))

    def view(self, name: str, sql: str) -> None:
        self.register(name, self.spark.sql(sql))

    def sql(self, query: str) -> DataFrame:
        return self.spark.sql(query)

    def export(self, name: str, path: str, format: str = "parquet") -> None:
        writer = self.spark.table(name).write.format(format)
        (writer.option("header", "true") if format == "csv" else writer).save(path)

    def drop(self) -> None:
        for name in self.names:
            self.spark.catalog.dropTempView(name)
        self.names = []
