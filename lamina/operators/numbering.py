"""Numbers in a total order without one task that holds all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import settled

_IN_PART = (1 << 33) - 1


def placed(df: DataFrame, order: list[Column | str], parts: int | None = None) -> DataFrame:
    """The rows with `_part` and `_in`: their range of the order, and their place within it.

    The ranges are drawn from a sample of the rows, so they can move between two evaluations: write the result once
    and read it back. As many ranges as the session has shuffle partitions, if `parts` does not say.
    """
    n = parts or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return ranged.withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PART)))


def bases(df: DataFrame) -> DataFrame:
    """(_part, _base, _n): rows before each range, and in it; as many rows as there are ranges."""
    sizes = df.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), "_n")


def numbered(df: DataFrame, order: list[Column | str], name: str = "seq", start: int = 0, parts: int | None = None) -> DataFrame:
    """The rows with their number in the total order of the columns, from `start`. Tied rows are numbered in any order: name a key last."""
    rows = settled(placed(df, order, parts), "numbered")
    return rows.join(F.broadcast(bases(rows)), "_part").withColumn(name, F.col("_base") + F.col("_in") + F.lit(start)).drop("_part", "_in", "_base", "_n")
