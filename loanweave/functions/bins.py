"""Turning numbers into labelled bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import BINS


def bin_label(column: str, rules: list[tuple[str, str | None]], null_label: str | None = None) -> Column:
    """Label of the first rule that holds; the last rule takes what is left over.

    Bins are meant for whole numbers. A value between two edges (12.5) and a NULL meet
    no condition and get the last label, unless ``null_label`` names one for NULL.
    """
    *conditions, (last, _) = rules
    arms = [f"WHEN {condition.format(c=f'`{column}`')} THEN '{label}'" for label, condition in conditions]
    if null_label is not None:
        arms.insert(0, f"WHEN `{column}` IS NULL THEN '{null_label}'")
    return F.expr(f"CASE {' '.join(arms)} ELSE '{last}' END")


def bin_column(
    df: DataFrame,
    column: str,
    rules: list[tuple[str, str | None]] | None = None,
    out: str | None = None,
    null_label: str | None = None,
) -> DataFrame:
    """Add ``out`` (default ``<column>_cat``) to ``df``."""
    label = bin_label(column, rules or BINS[column], null_label)
    return df.withColumn(out or f"{column}_cat", label)


def bin_columns(df: DataFrame, null_label: str | None = None) -> DataFrame:
    """Add all six bin columns in one projection."""
    return df.withColumns({f"{c}_cat": bin_label(c, rules, null_label) for c, rules in BINS.items()})
