"""Constraints as frames of violations: sound if empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def violations(*parts: tuple[str, DataFrame, Column]) -> DataFrame:
    """(check, key): the rows of each (name, rows, key)."""
    return reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("check"), key.cast("string").alias("key")) for name, df, key in parts))


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def rises(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value is greater than that of the row before in their group, where it should never rise."""
    return df.withColumn("_before", F.lag(value).over(Window.partitionBy(group).orderBy(*order))).where(F.col(value) > F.col("_before")).drop("_before")


def strict(found: DataFrame) -> None:
    """Raises ValueError with a few of the violations if there are any."""
    if rows := found.limit(5).collect():
        raise ValueError(f"violated: {[r.asDict() for r in rows]}")


def present(df: DataFrame, *forbidden: str) -> list[str]:
    """Columns of ``df`` that must not be handed on, whatever their letter case."""
    names = {f.casefold() for f in forbidden}
    return [c for c in df.columns if c.casefold() in names]


def schema_counts(df: DataFrame, data: str, versions: list[tuple[str, list[str]]]) -> DataFrame:
    """(version, n): rows by the first version all of whose keys stand in their JSON object; 'unknown' where none fits."""
    keys = F.coalesce(F.json_object_keys(data), F.array().cast("array<string>"))
    version = F.coalesce(*(F.when(F.size(F.array_except(F.array(*map(F.lit, k)), keys)) == 0, name) for name, k in versions), F.lit("unknown"))
    return df.select(version.alias("version")).groupBy("version").agg(F.count(F.lit(1)).alias("n"))
