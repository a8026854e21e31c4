"""Running sums over a whole table, without a window over the whole table.

``sum() OVER (ORDER BY ...)`` moves every row into one task. Here the rows are spread
over ranges of the order, the ranges are summed, and each range starts from the sum of
the ranges before it. There are as many ranges as the rows ask for, so none grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

RANGE = "_range"
# Rows of a range, until there are so many ranges; ranges whose sums are added up in one task.
RANGE_ROWS = 100_000
MOST_RANGES = 20_000
BLOCK = 1_000


def running_totals(
    df: DataFrame,
    order_by: list[Column],
    totals: list[str],
    group_by: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``cum_<name>`` and ``total_<name>`` for every column of ``totals``.

    ``cum_<name>`` is the sum up to and including the row in ``order_by`` order,
    ``total_<name>`` the sum over all rows. With ``group_by`` both start anew in every
    group; groups must be few (a handful of column names, not customers), because one
    offset per group and range is broadcast.

    ``order_by`` must tell all rows of a group apart; group equal keys first. Then no key
    is large, and the sampled range edges give even ranges whatever the distribution of
    the key. Rows are stored first, so their number is known: a range has about ``RANGE_ROWS`` of them, beyond
    ``MOST_RANGES`` ranges an even share of all. What lies before
    a range is added up in two steps, over blocks of ranges and inside each block, so no window sees more rows than a
    block has ranges or the table has blocks.
    """
    groups = group_by or []
    if not ranges:
        df = stage(df, "rows-to-range")
        ranges = range_count(df.count())
    # The range number is stored with the rows, so no later pass can see other ranges.
    ordered = df.repartitionByRange(ranges, *groups, *order_by) if ranges > 1 else df.coalesce(1)
    ranged = stage(ordered.withColumn(RANGE, F.spark_partition_id()), "ranges")

    sums = ranged.groupBy(RANGE, *groups).agg(*[F.sum(name).alias(name) for name in totals])
    before = _sums_before(sums.withColumn("_block", F.floor(F.col(RANGE) / BLOCK)), totals, [*groups, "_block"], RANGE)
    blocks = sums.groupBy(F.floor(F.col(RANGE) / BLOCK).alias("_block"), *groups).agg(*[F.sum(name).alias(name) for name in totals])
    before_blocks = _sums_before(blocks, totals, groups, "_block")
    for name in totals:
        before_blocks = before_blocks.withColumnRenamed(f"_before_{name}", f"_blocks_{name}")
    everything = Window.partitionBy(*groups)
    whole = [F.sum(name).over(everything).alias(f"total_{name}") for name in totals]
    before_blocks = before_blocks.select("_block", *groups, *[f"_blocks_{name}" for name in totals], *whole)
    offsets = before.join(before_blocks, ["_block", *groups]).select(
        RANGE,
        *groups,
        *[(F.col(f"_before_{name}") + F.col(f"_blocks_{name}")).alias(f"_before_{name}") for name in totals],
        *[f"total_{name}" for name in totals],
    )

    inside = (
        Window.partitionBy(RANGE, *groups).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # One range per task; hashing the range numbers would put several into some tasks.
    spread = ranged.repartitionByRange(ranges, RANGE)
    cumulated = {f"cum_{name}": F.sum(name).over(inside) + F.col(f"_before_{name}") for name in totals}
    return (
        spread.join(offsets, [RANGE, *groups])
        .withColumns(cumulated)
        .drop(RANGE, *[f"_before_{name}" for name in totals])
    )


def range_count(rows: int) -> int:
    return min(MOST_RANGES, max(1, -(-rows // RANGE_ROWS)))


def _sums_before(sums: DataFrame, totals: list[str], groups: list[str], order: str) -> DataFrame:
    """Adds ``_before_<name>``: the sum of the rows before this one in its group."""
    before = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumns({f"_before_{name}": F.coalesce(F.sum(name).over(before), F.lit(0)) for name in totals})
