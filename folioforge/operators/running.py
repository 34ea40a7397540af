"""Running totals inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Positions per block: the most rows of a group one task ever sorts together,
# as long as the positions of a group are distinct.
BLOCK_BITS = 10


def block_of(position: str) -> Column:
    return F.shiftright(F.col(position), BLOCK_BITS)


def running_total_before(
    rows: DataFrame, keys: list[str], position: str, amount: Column, total: str
) -> DataFrame:
    """Add `total`: the sum of `amount` over the group's rows at smaller positions.

    A group is cut into blocks of consecutive positions, so that no task sorts a
    whole group: rows are summed within their block, and the short table of
    block sums supplies what lies before the block. `rows` is shuffled once, by
    (keys, block), and both uses read that shuffle.
    """
    block, last = "__block", "__last"
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocked = rows.withColumn(block, block_of(position)).repartition(*keys, block)
    # ordering by the last position keeps the columns read here equal to those
    # read below, without which Spark would shuffle twice
    block_sums = blocked.groupBy(*keys, block).agg(
        F.sum(amount).alias("__sum"), F.max(position).alias(last)
    )
    before_block = F.sum("__sum").over(earlier.partitionBy(*keys).orderBy(last))
    before_row = F.sum(amount).over(earlier.partitionBy(*keys, block).orderBy(position))
    block_starts = block_sums.select(
        *keys, block, F.coalesce(before_block, F.lit(0)).alias("__start")
    )
    return (
        blocked.withColumn("__within", F.coalesce(before_row, F.lit(0)))
        .join(block_starts, [*keys, block])
        .withColumn(total, (F.col("__start") + F.col("__within")).cast("bigint"))
        .drop(block, "__start", "__within")
    )
