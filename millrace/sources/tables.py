"""Readers of the project's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Tables between these sizes (bytes of their files, the upper one for each core) are looked at: one that comes in fewer
#: splits than a quarter of the cores is spread. Larger ones have splits enough, smaller ones aren't worth a shuffle.
SPREAD_FROM, SPREAD_TO = 512 << 10, 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder; columns are pruned by the caller's select, through the spreading too."""
    files = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(files)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where a small table lies in one or two files, whose scan would keep the other cores idle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if not SPREAD_FROM <= size <= SPREAD_TO * cores or df.rdd.getNumPartitions() * 4 > cores:
        return df
    return df.repartition(cores)


def small_rows(df: DataFrame, most: int, what: str) -> list:
    """The rows of a dimension that is fixed in size, with that size checked.

    Raises ValueError if the table holds more than ``most`` rows, so that nothing that
    grows with the data can reach the driver through this way.
    """
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} holds more than {most} rows; it is no small dimension")
    return rows
