"""K2: incremental processing of arriving rows, exactly once per key, by a checkpointed stream (an addition)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corpusloom.operators.relational import last_wins
from corpusloom.sources.readers import exists
from corpusloom.sources.versions import AppendLog


def process_new(spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], target: str, key: str, checkpoint: str, seq: str = "seq"):
    """Run all files not processed yet through ``transform`` and append rows whose key the target lacks."""

    def sink(batch: DataFrame, _: int) -> None:
        rows = last_wins(transform(batch), [key], seq)
        if exists(spark, target):
            rows = rows.join(spark.read.parquet(target).select(key), key, "left_anti")
        rows.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def process_log(spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], log: AppendLog, checkpoint: str, seq: str = "seq"):
    """Run all files not processed yet through ``transform`` into ``log``: a batch that is run again after a loss is taken once."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(lambda batch, number: log.append(number, transform(batch), seq)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts and sums per window and type with a watermark; the same plan for a stream and a batch."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
