"""First cleaning of raw loans, and the two gold projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bins import bin_columns
from ..functions.fixed_values import RAW_NUMERIC, TARGET, UNKNOWN


def string_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string" and name not in exclude]


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every text column in one projection."""
    return df.withColumns({name: F.trim(name) for name in string_columns(df)})


def fill_unknown(df: DataFrame, text: str = UNKNOWN) -> DataFrame:
    """Replace missing texts; an empty text is a value and stays."""
    names = string_columns(df)
    return df.fillna(text, subset=names) if names else df


def normalise_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Store the target as INT 0/1, whether it came as a number, a boolean or text.

    A number other than 0 and 1 is refused: under another coding every rate would be wrong.
    """
    value, kind = F.col(target), dict(df.dtypes)[target]
    if kind in ("boolean", "string"):
        number = value.cast("boolean").cast("int")
    else:
        refused = F.raise_error(F.concat(F.lit(f"{target} must be 0 or 1, not "), value.cast("string")))
        number = F.when(value.isNull() | value.isin(0, 1), value.cast("int")).otherwise(refused.cast("int"))
    return df.withColumn(target, number)


def clean_loans(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Raw loans to bronze: trimmed, without missing texts, target 0/1."""
    return fill_unknown(trim_strings(normalise_target(df, target)))


def select_reporting(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Six bins, the amount, the texts and the target, for reports."""
    binned = bin_columns(df)
    bins = [f"{c}_cat" for c in RAW_NUMERIC]
    return binned.select(*bins, "amount", *string_columns(df, exclude=(target, *bins)), target)


def drop_raw_numerics(df: DataFrame) -> DataFrame:
    """All columns plus the bins, without the numbers the bins came from, for training."""
    return bin_columns(df).drop(*RAW_NUMERIC)


def cast_label(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.withColumn("label", F.col(target).cast("double"))
