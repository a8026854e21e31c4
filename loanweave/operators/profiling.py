"""Profiles of a table: missing values, distributions, cross tables, duplicates, quartiles."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import TARGET
from ..session import stage
from .cleaning import string_columns

SLICES = 1024
# Share of rows by which the values on either side of a quantile are off its place, and the sketch's accuracy, well within it.
MARGIN = 0.001
ACCURACY = 10_000


def percent_text(share: Column) -> Column:
    """A share as text with one decimal, such as ``33.3%``."""
    return F.concat(F.round(share * 100, 1), F.lit("%"))


def missing_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of NULLs (and NaNs, where the type has them)."""
    def missing(name: str, kind: str) -> Column:
        absent = F.col(name).isNull()
        return F.count_if(absent | F.isnan(name) if kind in ("float", "double") else absent).alias(name)

    counts = df.agg(*[missing(name, kind) for name, kind in df.dtypes])
    return counts.unpivot([], df.columns, "column_name", "missing_count")


def long_values(df: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per row and column: (keep..., variable, value)."""
    return df.select(*(keep or []), *columns).unpivot(keep or [], columns, "variable", "value")


def category_distribution(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count and share of every value of every text column, largest first.

    All columns are counted in one job: the rows are unpivoted and combined before the
    shuffle, so what moves is one row per value and task.
    """
    columns = columns or string_columns(df, exclude=(TARGET,))
    counted = long_values(df, columns).groupBy("variable", "value").agg(F.count("*").alias("count"))
    # Every row has one value per column, so a column's counts add up to the rows; one group per column and value is left.
    rows = F.sum("count").over(Window.partitionBy("variable"))
    shares = counted.withColumn("percentage", percent_text(F.col("count") / rows))
    return sorted_distribution(shares)


def sorted_distribution(distribution: DataFrame) -> DataFrame:
    """Within each variable: highest count first, equal counts by value."""
    return distribution.orderBy("variable", F.col("count").desc(), "value")


def target_crosstab(df: DataFrame, target: str = TARGET, columns: list[str] | None = None) -> DataFrame:
    """Counts of target 0 and 1 for every value of every text column, with row shares."""
    columns = columns or string_columns(df, exclude=(target,))
    counted = (
        long_values(df, columns, keep=[target])
        .groupBy("variable", "value")
        .agg(F.count_if(F.col(target) == 0).alias("0"), F.count_if(F.col(target) == 1).alias("1"))
    )
    total = F.col("0") + F.col("1")
    return counted.withColumns(
        {f"{label}_pct": percent_text(F.try_divide(F.col(label), total)) for label in ("0", "1")}
    ).orderBy("variable", "value")


def counted_values(df: DataFrame, target: str = TARGET, columns: list[str] | None = None) -> DataFrame:
    """Counts of every column's values from one pass: (variable, is_text, value, missing, count, zeros, ones).

    Text columns have a row per value, all others one row for their missing values and one for the rest. Rows
    are unpivoted with a tag and combined before the shuffle.
    """
    texts = set(columns or string_columns(df, exclude=(target,)))
    cells = []
    for name, kind in df.dtypes:
        column = F.col(quoted(name))
        missing = column.isNull() | F.isnan(column) if kind in ("float", "double") else column.isNull()
        value = column if name in texts else F.lit(None)
        tags = (F.lit(name).alias("variable"), F.lit(name in texts).alias("is_text"), value.cast("string").alias("value"))
        cells.append(F.struct(*tags, missing.alias("missing")))
    goal = F.col(quoted(target))
    tagged = df.select(goal.alias("_target"), F.inline(F.array(*cells)))
    return tagged.groupBy("variable", "is_text", "value", "missing").agg(
        F.count("*").alias("count"), F.count_if(F.col("_target") == 0).alias("zeros"), F.count_if(F.col("_target") == 1).alias("ones")
    )


def profile(df: DataFrame, target: str = TARGET, columns: list[str] | None = None) -> dict[str, DataFrame]:
    """``missing_counts``, ``category_distribution`` and ``target_crosstab`` of a table that is read once for all three."""
    counted = stage(counted_values(df, target, columns), "profile")
    missing = counted.groupBy(F.col("variable").alias("column_name")).agg(
        F.coalesce(F.sum(F.when(F.col("missing"), F.col("count"))), F.lit(0).cast("bigint")).alias("missing_count")
    )
    none = df.sparkSession.createDataFrame([(name,) for name in df.columns], "column_name string")
    missing = none.join(missing, "column_name", "left").fillna(0, ["missing_count"])
    values = counted.where("is_text")
    rows = F.sum("count").over(Window.partitionBy("variable"))
    shares = values.select("variable", "value", "count", percent_text(F.col("count") / rows).alias("percentage"))
    total = F.col("zeros") + F.col("ones")
    parts = [percent_text(F.try_divide(F.col(c), total)).alias(f"{label}_pct") for label, c in (("0", "zeros"), ("1", "ones"))]
    crossed = values.select("variable", "value", F.col("zeros").alias("0"), F.col("ones").alias("1"), *parts)
    return {
        "missing_counts": missing,
        "category_distribution": sorted_distribution(shares),
        "target_crosstab": crossed.orderBy("variable", "value"),
    }


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count"))


def split_sizes(df: DataFrame) -> DataFrame:
    """Rows per part of a table made by ``with_split``."""
    return df.groupBy("split").agg(F.count("*").alias("count"))


def duplicate_audit(df: DataFrame) -> DataFrame:
    """Rows and distinct rows in one pass; copies are combined before the shuffle.

    What is grouped and moved is a digest of a row, not the row: two 64-bit hashes of its columns from either end, and which
    columns are NULL, as hashes pass over those. Rows count as equal if all of it agrees.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    absent = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    digest = [F.xxhash64(*columns, F.lit(0)).alias("a"), F.xxhash64(F.lit(1), *columns[::-1], absent).alias("b")]
    return (
        df.select(*digest)
        .groupBy("a", "b")
        .agg(F.count("*").alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("row_count"),
            F.count("*").alias("distinct_count"),
        )
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation: (variable, probability, quantile).

    The values next to a quantile's place are searched for, all columns and places at once. A mergeable sketch, taken with
    the counts in one pass over the stored columns, gives two values around each place; a second pass counts what lies below
    them. What is between them is cut into slices, whose rows are counted, and the slice that holds
    the place is cut again, until its values are equal: usually one pass. A step is one aggregation of at most ``SLICES``
    rows for each place and task; values are never shuffled. NULL and NaN do not count. The ``percentile``
    function would keep all distinct values of a column in one task's memory.
    """
    stored, basics = _basics(df, columns, probabilities)
    rows = [
        (name, float(p), found[p]) for name, total, found in zip(columns, basics, _quantiles(stored, basics, probabilities)) for p in found
    ]
    return df.sparkSession.createDataFrame(rows, "variable string, probability double, quantile double")


def _basics(df: DataFrame, columns: list[str], probabilities: list[float]):
    """The columns as DOUBLE, stored, without NaN, and what one pass over them gives, one row per column."""
    values = [F.nanvl(F.col(quoted(c)).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]
    stored = stage(df.select(*values), "quantiles")
    around = [min(1.0, max(0.0, p + side * MARGIN)) for p in probabilities for side in (-1, 1)]

    def basics(v: str) -> Column:
        sketch = F.percentile_approx(v, around, ACCURACY) if around else F.array().cast("array<double>")
        aggregates = (F.count(v).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"))
        return F.struct(*aggregates, F.stddev_samp(v).alias("std"), sketch.alias("around"))

    return stored, stored.agg(F.array(*[basics(v) for v in stored.columns]).alias("all")).first()["all"] if columns else []


def _quantiles(stored: DataFrame, basics: list, probabilities: list[float]) -> list[dict[float, float]]:
    """For every column, the quantile of each probability; none for a column without values."""
    places = {
        (i, p, rank): total["around"][2 * k : 2 * k + 2]
        for i, total in enumerate(basics)
        for k, p in enumerate(probabilities)
        if total["n"]
        for place in (p * (total["n"] - 1),)
        for rank in {math.floor(place), math.ceil(place)}
    }
    ends = sorted({(i, end) for (i, _, _), around in places.items() for end in around})
    counts = [F.struct(F.count_if(F.col(f"v{i}") < end).alias("below"), F.count_if(F.col(f"v{i}") <= end).alias("up_to")) for i, end in ends]
    counts = dict(zip(ends, stored.agg(F.array(*counts).alias("n")).first()["n"] if ends else []))
    # Per wanted order statistic: the interval that holds it, and how many values lie below that.
    open_: dict[tuple[int, int], tuple[float, float, int]] = {}
    for (i, _, rank), (low, high) in places.items():
        # The sketch's error is far below the margin; should it not be, the search starts from the ends.
        before = counts[i, low]["below"]
        if not before <= rank:
            low, before = basics[i]["low"], 0
        if not rank < counts[i, high]["up_to"]:
            high = basics[i]["high"]
        open_[i, rank] = (low, high, before)
    found: dict[tuple[int, int], float] = {}
    while open_:
        found |= {key: low for key, (low, high, _) in open_.items() if low == high}
        open_ = {key: interval for key, interval in open_.items() if key not in found}
        intervals = {(i, low, high) for (i, _), (low, high, _) in open_.items()}
        if intervals:
            counted: dict[tuple, list] = {}
            for row in _slices(stored, sorted(intervals)).collect():
                counted.setdefault((row["column"], row["low"], row["high"]), []).append(row)
            for (i, rank), (low, high, before) in open_.items():
                for row in sorted(counted[i, low, high], key=lambda r: r["slice"]):
                    if rank < before + row["n"]:
                        open_[i, rank] = (row["least"], row["most"], before)
                        break
                    before += row["n"]
    out: list[dict[float, float]] = [{} for _ in basics]
    for i, total in enumerate(basics):
        for p in probabilities if total["n"] else ():
            place = p * (total["n"] - 1)
            lower, upper = found[i, math.floor(place)], found[i, math.ceil(place)]
            out[i][p] = lower + (place - math.floor(place)) * (upper - lower) if lower != upper else lower
    return out


def _slices(stored: DataFrame, intervals: list[tuple[int, float, float]]) -> DataFrame:
    """Rows, least and most value of every slice of every interval (column, low, high)."""
    # At most two intervals per column and probability.
    table = stored.sparkSession.createDataFrame(intervals, "column int, low double, high double")
    cells = [F.struct(F.lit(i).alias("column"), F.col(name).alias("value")) for i, name in enumerate(stored.columns)]
    value, low, high = F.col("value"), F.col("low"), F.col("high")
    # Halves, so that the width of the widest range is a number too.
    share = F.nanvl((value / 2 - low / 2) / (high / 2 - low / 2), F.lit(0.5))
    place = F.least(F.floor(share * SLICES), F.lit(SLICES - 1))
    place = F.when(value == low, F.lit(0)).when(value == high, F.lit(SLICES)).otherwise(place)
    return (
        stored.select(F.inline(F.array(*cells)))
        .join(F.broadcast(table), "column")
        .filter(value.between(low, high))
        .groupBy("column", "low", "high", place.alias("slice"))
        .agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    )


def describe_selected(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of number columns, one row per column; NULL and NaN do not count.

    ``df`` is read once: all of it comes from the stored columns.
    """
    at = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    stored, basics = _basics(df, columns, list(at.values()))
    quantiles = _quantiles(stored, basics, list(at.values()))
    rows = [
        (name, b["n"], b["mean"], b["std"], b["low"], *(q.get(p) for p in at.values()), b["high"])
        for name, b, q in zip(columns, basics, quantiles)
    ]
    numbers = ", ".join(f"{name} double" for name in ("mean", "std", "min", *at, "max"))
    return df.sparkSession.createDataFrame(rows, f"variable string, count bigint, {numbers}")
