"""Incremental monthly features with Structured Streaming.

The source processes one file per (pollutant, year) and re-runs the monthly
averaging for each. Here new daily files landing under a staged table root
(``param=/year=`` directories) are folded into a streaming aggregation of
exact sums and counts per (param, keys, year, month); every micro-batch
publishes the complete monthly table as a new epoch directory, and readers
take the latest complete epoch. State is bounded by params × keys × months,
not by the number of readings, so no watermark is needed to bound it; a late
reading for an old month simply updates that month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.stats import exact_mean
from ..sources.writers import latest_version


def daily_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a staged daily table (Parquet, partitioned by param/year)."""
    schema = S.staged_daily_schema()
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(root)


def monthly_pollutant_stream(spark: SparkSession, source_root: str, out_root: str, checkpoint: str,
                             keys=S.KEYS_STATE, available_now: bool = True):
    """Start the stream; returns the StreamingQuery (already finished when ``available_now``)."""
    daily = daily_stream(spark, source_root)
    agg = (daily.withColumn("month", F.month("date_local"))
           .groupBy("param", *keys, "year", "month")
           .agg(*[exact_mean(m).alias(m) for m in S.MEASURES]))

    def publish(batch: DataFrame, epoch: int):
        batch.write.mode("overwrite").parquet(f"{out_root}/v{epoch}")

    w = (agg.writeStream.outputMode("complete").foreachBatch(publish)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def latest_monthly(spark: SparkSession, out_root: str) -> DataFrame:
    v = latest_version(spark, out_root)
    if v is None:
        raise FileNotFoundError(f"no published epoch under {out_root}")
    return spark.read.parquet(f"{out_root}/v{v}")
