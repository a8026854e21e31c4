"""Finding the place in a ranking where a budget runs out.

The ranking is a table (rank, id, value, weight): rows are taken by ``rank``, equal ranks
by ``id``, until the weights pass the budget. Instead of a running sum over all rows, the
ranking is cut into a few thousand slices whose weights are summed; the slice where the
budget runs out is cut again, until a few rows are left, which the driver looks at one by one. Each step is one
aggregation with map-side combining, so neither a large class of equal ranks nor a hot id range ends up
in one task, and one row per step reaches the driver, in the end at most ``FEW``.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# 18 digits are stored as one machine word; six of them are decimals.
AMOUNT = "decimal(18,6)"
SUM = "decimal(38,6)"
# For numbers that arrive as DOUBLE, such as a model's PD.
FINE_AMOUNT = "decimal(30,15)"
SLICES = 4096
# Rows of a slice up to which it is not cut again.
FEW = 5_000


@dataclass(frozen=True)
class Cut:
    """The first row of a ranking that the budget does not cover."""

    rank: int
    id: int
    value: Decimal
    weight: Decimal

    def before(self, rank: Column, key: Column) -> Column:
        """True for rows the budget covers."""
        return F.struct(rank, key) < self._place()

    def behind(self, rank: Column, key: Column) -> Column:
        return F.struct(rank, key) > self._place()

    def _place(self) -> Column:
        return F.struct(F.lit(self.rank).cast("bigint"), F.lit(self.id).cast("bigint"))


def first_over(rows: DataFrame, column: str, low: int, high: int, budget: Decimal):
    """Cut [low, high] of ``column`` into slices; return the slice where the budget runs out.

    A slice is a run of whole numbers that share their leading bits. At most ``SLICES``
    sums are compared, and one row is returned.
    """
    bits = 0
    while (high >> bits) - (low >> bits) >= SLICES:
        bits += 1
    sums = (
        rows.filter(F.col(column).between(low, high))
        .groupBy((F.shiftright(F.col(column), bits) - F.lit(low >> bits)).alias("slice"))
        .agg(
            F.sum("weight").alias("weight"),
            F.count("*").alias("n"),
            F.max("value").alias("value"),
            F.min(column).alias("low"),
            F.max(column).alias("high"),
            F.min("id").alias("first_id"),
            F.max("id").alias("last_id"),
        )
    )
    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        sums.withColumn("upto", F.sum("weight").over(upto))
        .filter(F.col("upto") > F.lit(budget).cast(SUM))
        .orderBy("slice")
        .first()
    )


def find_cut(rows: DataFrame, low: int, high: int, budget: Decimal) -> tuple[Cut | None, Decimal]:
    """First row of the ranking that does not fit, and what the rows before it leave of the budget.

    ``low`` and ``high`` bound the ranks. Without a first row everything fits.
    """
    left = budget
    place = first_over(rows, "rank", low, high, left)
    if place is None:
        return None, left
    left -= place["upto"] - place["weight"]
    while place["low"] != place["high"]:
        if place["n"] <= FEW:
            return _first_row_over(rows.filter(F.col("rank").between(place["low"], place["high"])), left)
        place = first_over(rows, "rank", place["low"], place["high"], left)
        left -= place["upto"] - place["weight"]
    rank = place["low"]
    same_class = rows.filter(F.col("rank") == rank)
    low, high = place["first_id"], place["last_id"]
    while low != high:
        if place["n"] <= FEW:
            return _first_row_over(same_class.filter(F.col("id").between(low, high)), left)
        place = first_over(same_class, "id", low, high, left)
        left -= place["upto"] - place["weight"]
        low, high = place["low"], place["high"]
    return Cut(rank, low, place["value"], place["weight"]), left


def _first_row_over(rows: DataFrame, left: Decimal) -> tuple[Cut, Decimal]:
    """The same for a few rows, of which one is known not to fit."""
    for row in sorted(rows.select("rank", "id", "value", "weight").collect(), key=lambda r: (r["rank"], r["id"])):
        if row["weight"] > left:
            return Cut(**row.asDict()), left
        left -= row["weight"]
    raise ValueError("the ranking has changed while it was read")
