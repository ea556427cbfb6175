"""Places of rows in groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.plans.lineage import cut

#: A group of more rows than this isn't ordered in one task: its rows are ordered in ranges.
GROUP_ROWS = 1_000_000


def ranked(df: DataFrame, group: list[str], *order: Column, name: str = "place") -> DataFrame:
    """``df`` with the row's place in its group, from 1, by a total order.

    Where a group is larger than GROUP_ROWS, rows are parted by ranges of (group, order), so that a group lies in many
    tasks; a place is the rows of the group in earlier ranges and the place within the range. Both ways give the same.
    """
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    if not sizes.where(F.col("n") > GROUP_ROWS).limit(1).count():
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))
    parts = max(8, df.count() // (GROUP_ROWS // 4))
    keys = [F.col(g) for g in group]
    ranged = cut(df.repartitionByRange(int(parts), *keys, *order).withColumn("_range", F.spark_partition_id()))
    own = Window.partitionBy(*group, "_range").orderBy(*order)
    counts = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = counts.select(*(F.col(g).alias(f"_g{k}") for k, g in enumerate(group)), F.col("_range").alias("_r"), (F.sum("_rows").over(Window.partitionBy(*group).orderBy("_range")) - F.col("_rows")).alias("_before"))
    same = F.col("_range") == F.col("_r")
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
    placed = ranged.withColumn("_own", F.row_number().over(own)).join(before, same)
    return placed.select(*df.columns, (F.col("_before") + F.col("_own")).cast("bigint").alias(name))


def first_of(df: DataFrame, group: list[str], k: int, *order: Column, name: str = "place") -> DataFrame:
    """The first ``k`` rows of each group in a total order, with their place: each task passes on ``k`` rows of a group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= k)
