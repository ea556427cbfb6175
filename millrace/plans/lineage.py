"""Cutting lineage with files in the shared folder, and sizing of partitions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set, one of its own in local mode (tests), where all tasks see it;
    on a cluster a ValueError, as a folder of the driver's machine would be lost to the executors."""
    context = spark.sparkContext
    at = context.getCheckpointDir()
    if at is None:
        at = spark.conf.get("spark.checkpoint.dir", None)
        if at is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            at = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there, so that two uses don't compute it twice
    and a lost executor costs only a read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with costly ``columns`` that are computed once a row: a generator of one row stands between them and what is
    made of them, so that no filter or projection on them repeats their expression."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def written(df: DataFrame) -> DataFrame:
    """``df`` written once, as a compressed table, to the shared folder and read from there: as ``cut``, on less disk."""
    spark = df.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def fits_broadcast(df: DataFrame, most_rows: int) -> bool:
    """Whether ``df`` has at most ``most_rows`` rows. The count stops after one more than that."""
    return df.limit(most_rows + 1).count() <= most_rows


def small(df: DataFrame, most_rows: int = 20_000) -> DataFrame:
    """``df`` marked for broadcast if it was counted to be small; else as it is, for a join that shuffles both sides."""
    return F.broadcast(df) if fits_broadcast(df, most_rows) else df
