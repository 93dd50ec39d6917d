"""Incremental variants: registries that follow a stream of new element files.

The engine's own addition; in the batch operators each run sees all chapters at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataq.operators.registry import keep_latest, keep_longest


def element_stream(spark: SparkSession, path: str, schema: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of elements as they arrive."""
    kind = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def loads_per_window(stream: DataFrame, width: str = "1 day", late: str = "7 days", at: str = "loaded_at") -> DataFrame:
    """Loads per standard and window; rows later than ``late`` are left out."""
    timed = stream.withColumn("t", F.col(at).cast("timestamp")).withWatermark("t", late)
    return timed.groupBy(F.window("t", width), F.col("source.standard").alias("standard")).agg(F.count(F.lit(1)).alias("n"))


def maintain(stream: DataFrame, target: str, checkpoint: str, merge: Callable[[DataFrame], DataFrame], available_now: bool = True) -> StreamingQuery:
    """Keep a registry folder up to date: each batch is merged with what is there.

    Versions are folders ``v=<batch>``; a batch that runs again writes its version
    again, so a restart loses and doubles nothing.
    """

    def each(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        old = _version(spark, target, n - 1)
        merge(batch if old is None else old.unionByName(batch)).write.mode("overwrite").parquet(f"{target}/v={n}")

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def _version(spark: SparkSession, target: str, n: int) -> DataFrame | None:
    return None if n < 0 else spark.read.parquet(f"{target}/v={n}")


def latest_by(keys: list[str], order: list[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: keep_latest(df, keys, order).select(df.columns)


def longest_by(keys: list[str], text: str, order: list[str]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: keep_longest(df, keys, text, order).select(df.columns)
