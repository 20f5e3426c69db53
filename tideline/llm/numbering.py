"""Row numbers over a whole table, without a task that sees more than its range of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import stage

POSITIONS = (1 << 33) - 1  # Spark puts the row's position in the low 33 bits of its id


def numbered(rows: DataFrame, keys: list[str], purpose: str, name: str = "number") -> DataFrame:
    """`rows` as a stored table with `name`: 0, 1, 2, ... in the order of `keys`, nulls first.

    The rows are range-partitioned by the keys, sorted and stored with their place in the range;
    the counts of the ranges, one row per shuffle partition, then tell where each range begins.
    Rows alike in all keys share out their numbers in any way: their place in the scan parts them,
    so that even a third of all rows with one key is spread over tasks. The columns `name`, `range`,
    `place` and `scanned` must not be among those of `rows`.
    """
    placed = (
        rows.withColumn("scanned", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "scanned")
        .sortWithinPartitions(*keys, "scanned")
        .drop("scanned")
        .withColumn("range", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit(POSITIONS)))
    )
    placed = stage(placed, purpose)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("range").agg(F.count(F.lit(1)).alias("rows")).select(
        "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")
    )
    # One row per shuffle partition at most, so its size is bounded by that setting.
    return placed.join(F.broadcast(starts), "range").select(
        *(f"`{c}`" for c in rows.columns), (F.col("start") + F.col("place")).alias(name)
    )
