"""Incremental runs: new rows only, merged by key; and windowed totals of an event stream (an extension)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from humusgrid.operators.merge import upsert
from humusgrid.session import cut_lineage, drop_stage


#: Parts of a merged table; a batch rewrites those that it touches.
BUCKETS = 64


def merge_into(path: str, keys: Sequence[str], columns: Sequence[str], order: str | None = None, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """foreachBatch function that merges each batch into a table of Parquet files, cut into buckets by key.

    A batch reads and overwrites only the buckets its keys fall into. A batch
    repeated after a failure finds its own rows and gives the same table.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        new = cut_lineage(batch.withColumn("bucket", bucket), "batch")
        touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most as many as buckets
        if not touched:
            return
        now = _table(spark, path)
        held = new.limit(0) if now is None else now.filter(F.col("bucket").isin(touched)).select(*new.columns)
        # what is overwritten must not be read any more
        merged = cut_lineage(upsert(held, new, keys, [*columns, "bucket"], order), "merged")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
        drop_stage(merged)
        drop_stage(new)

    return run


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(root) and any(s.getPath().getName().startswith("bucket=") for s in fs.listStatus(root)) else None


def latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The merged table as it is, or None."""
    now = _table(spark, path)
    return None if now is None else now.drop("bucket")


def start_merge(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], columns: Sequence[str], order: str | None = None) -> StreamingQuery:
    return stream.writeStream.foreachBatch(merge_into(path, keys, columns, order)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_totals(stream: DataFrame, at: str, key: str, value: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Count and sum per key and window, for batch and stream alike; rows later than the watermark are dropped by a stream."""
    out = stream.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), key, "n", "total")
