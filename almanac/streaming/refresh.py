"""Keeping a mirror of a table fresh from a stream of changes.

The table is dealt into buckets by a hash of its key. Each micro-batch rewrites only the buckets that its changes touch, into a
folder of its own, and a small commit file, written last, names the batch and these buckets. A batch that runs again after a
failure finds itself committed, or writes its buckets anew, so changes count once. Rows keep the order of their last change,
and deleted ones stay as marks, so that changes which arrive late or out of order neither overwrite newer rows nor revive
deleted ones. Versions that newer ones have replaced are removed, but for the last before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from almanac.operators import mirror
from almanac.runtime import delete

BUCKETS = 64
_ORDER, _GONE, _BUCKET = "_order", "_gone", "_bucket"


class Mirror:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], order: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.key, self.order, self.buckets = spark, path.rstrip("/"), schema, key, order, buckets

    def _commits(self) -> DataFrame | None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return None
        return self.spark.read.schema("batch long, bucket int").json(f"{self.path}/commits")

    def version(self) -> int | None:
        """The last committed batch; None before the first."""
        done = self._commits()
        return None if done is None else done.agg({"batch": "max"}).first()[0]

    def ready(self) -> bool:
        return self.version() is not None

    def _versions(self) -> dict[int, list[int]]:
        """The batches that wrote each bucket, in order."""
        done = self._commits()
        rows = [] if done is None else done.where("bucket IS NOT NULL").distinct().orderBy("batch").collect()  # a bucket's row for each batch that touched it
        out: dict[int, list[int]] = {}
        for r in rows:
            out.setdefault(r["bucket"], []).append(r["batch"])
        return out

    def _folder(self, batch: int, bucket: int) -> str:
        return f"{self.path}/v{batch}/{_BUCKET}={bucket}"

    def _rows(self, buckets: list[int], versions: dict[int, list[int]], order_type: str) -> DataFrame:
        """Rows of some buckets as stored: with their order and mark."""
        schema = f"{self.schema}, {_ORDER} {order_type}, {_GONE} boolean"
        paths = [self._folder(versions[b][-1], b) for b in buckets if b in versions]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def table(self) -> DataFrame:
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], self.schema)
        paths = [self._folder(done[-1], b) for b, done in versions.items()]
        empty = self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(f"{self.schema}, {_GONE} boolean").parquet(*paths).where(~F.col(_GONE)).select(empty.columns)

    def apply(self, changes: DataFrame, batch: int) -> None:
        v = self.version()
        if v is not None and batch <= v:
            return
        columns = self.spark.createDataFrame([], self.schema).columns
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        rows = changes.select(*columns, F.col(self.order).alias(_ORDER), F.coalesce(F.col("deleted"), F.lit(False)).alias(_GONE))
        touched = sorted(r[0] for r in rows.select(bucket).distinct().collect())  # at most as many as there are buckets
        if touched:
            current = self._rows(touched, self._versions(), rows.schema[_ORDER].dataType.simpleString())
            merged = mirror.merged(current, rows, self.key, _ORDER, _GONE)
            merged.withColumn(_BUCKET, bucket).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/v{batch}")
        done = [(batch, b) for b in touched] or [(batch, None)]
        self.spark.createDataFrame(done, "batch long, bucket int").coalesce(1).write.mode("append").json(f"{self.path}/commits")
        self.vacuum()

    def vacuum(self, keep: int = 2) -> None:
        """Removes all but the last `keep` versions of each bucket; readers of the version before the last are not disturbed."""
        for bucket, batches in self._versions().items():
            for batch in batches[:-keep]:
                delete(self.spark, self._folder(batch, bucket))

    def follow(self, stream: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
        """Applies a stream of changes (the table's columns, the order column and `deleted`)."""
        writer = stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if once else writer).start()
