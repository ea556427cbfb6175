"""Streams of answers: an upsert of a ledger for each micro-batch, and answers that expire.

The reference semantics have no streams; these are the batch operators (latest answer wins, an answer is good for so many
hours) in Structured Streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.links import TTL_HOURS
from millrace.operators.reviews import latest


def upsert_stream(stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str) -> StreamingQuery:
    """Keeps the last answer of each key in versions below ``path``, from ledger_version=0 on. Each micro-batch joins the version before
    with its own rows; a batch that is run again writes the same version again."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema(batch.schema).parquet(f"{path}/ledger_version={epoch - 1}") if epoch else None
        rows = batch if before is None else before.unionByName(batch)
        latest(rows, keys, *order).write.mode("overwrite").parquet(f"{path}/ledger_version={epoch}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str) -> DataFrame:
    """The last version of a ledger."""
    last = spark.read.parquet(path).agg(F.max("ledger_version").alias("ledger_version"))
    return spark.read.parquet(path).join(F.broadcast(last), "ledger_version").drop("ledger_version")


def late_rows(stream: DataFrame, at: str, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(in period, out of period): both sides are kept."""
    inside = F.col(at).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))
    return stream.where(inside), stream.where(~F.coalesce(inside, F.lit(False)))


def windowed_counts(stream: DataFrame, at: str, group: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by window and group; rows later than ``late`` behind the latest are left out by the watermark."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width), group).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), group, "n")


def with_expiry(answers: DataFrame, kind: str, at: str) -> DataFrame:
    """Answers with the time until which they are good; null for classes that are never kept."""
    hours = F.create_map(*(F.lit(x) for kv in TTL_HOURS.items() for x in kv))
    return answers.withColumn("good_until", F.timestamp_seconds(F.unix_timestamp(at) + hours[F.col(kind)] * 3600))
