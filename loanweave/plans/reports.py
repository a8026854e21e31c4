"""Report visuals. Each one is an aggregation of a gold table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import TARGET
from ..operators.measures import baseline_measures, portfolio_measures


def treemap_age(loans: DataFrame) -> DataFrame:
    return baseline_measures(loans, ["age_cat"]).select("age_cat", "total_credits")


def default_rate_by_age(loans: DataFrame) -> DataFrame:
    rates = baseline_measures(loans, ["age_cat"]).select("age_cat", "default_rate")
    return rates.orderBy(F.col("default_rate").desc(), "age_cat")


def amount_by_risk(loans: DataFrame) -> DataFrame:
    amounts = baseline_measures(loans, [TARGET]).select(TARGET, "total_amount")
    return amounts.orderBy(F.col("total_amount").desc())


def credits_by_risk(loans: DataFrame) -> DataFrame:
    counts = baseline_measures(loans, [TARGET]).select(TARGET, "total_credits")
    return counts.orderBy(F.col("total_credits").desc())


def cards(loans: DataFrame) -> DataFrame:
    """The five numbers on top of the report."""
    return baseline_measures(loans).select(
        "total_credits", "bad_amount", "default_rate", "total_amount", "risk_density"
    )


def history_risk_share(loans: DataFrame) -> DataFrame:
    """Loans by history and target, with the share within the history; loans without a target are a row of their own."""
    counted = loans.groupBy("credit_history", F.col(TARGET).cast("int").alias(TARGET)).agg(
        F.count("*").alias("total_credits")
    )
    history = F.sum("total_credits").over(Window.partitionBy("credit_history"))
    return counted.withColumn("share", F.col("total_credits") / history)


def purpose_risk_pivot(loans: DataFrame) -> DataFrame:
    """Amount by purpose (rows) and target (columns), with a total row.

    ``share_*`` is the part of the purpose's own amount, ``column_share_*`` the part of
    all amounts with that target; ``*_none`` are loans without a target, so that shares add up to 1.
    """
    target = {"0": F.col(TARGET) == 0, "1": F.col(TARGET) == 1, "none": F.col(TARGET).isNull()}
    sides = {label: F.sum(F.when(here, F.col("amount")).otherwise(0)) for label, here in target.items()}
    table = loans.rollup("purpose").agg(
        F.grouping_id().alias("_total"),
        F.sum("amount").alias("amount"),
        *[total.alias(f"amount_{label}") for label, total in sides.items()],
    )
    # The total row has the sum of each column; one row per purpose is left.
    whole = {
        label: F.max(F.when(F.col("_total") == 1, F.col(f"amount_{label}"))).over(Window.partitionBy()) for label in sides
    }
    return table.select(
        F.when(F.col("_total") == 1, "Total").otherwise(F.col("purpose")).alias("purpose"),
        "amount",
        *[f"amount_{label}" for label in sides],
        *[F.try_divide(F.col(f"amount_{label}"), F.col("amount")).alias(f"share_{label}") for label in sides],
        *[F.try_divide(F.col(f"amount_{label}"), whole[label]).alias(f"column_share_{label}") for label in sides],
    ).orderBy("_total", "purpose")


def risk_distribution(portfolio: DataFrame) -> DataFrame:
    """Loans and exposure by risk level, before and after."""
    return portfolio_measures(portfolio, ["credit_risk_niveau"]).select(
        "credit_risk_niveau",
        "total_credits_baseline",
        "total_credits_optimized",
        "exposure_at_risk_baseline",
        "exposure_at_risk_optimized",
    )


def loss_heatmap(portfolio: DataFrame) -> DataFrame:
    """Expected loss by purpose and age group, before and after."""
    return portfolio_measures(portfolio, ["purpose", "age_cat"]).select(
        "purpose", "age_cat", "expected_loss_baseline", "expected_loss_optimized"
    )


def portfolio_kpis(portfolio: DataFrame) -> DataFrame:
    """Loans, expected loss, exposure, value and efficiency, before and after."""
    names = ["total_credits", "expected_loss", "exposure_at_risk", "expected_value", "value_per_risk_unit"]
    return portfolio_measures(portfolio).select(*[f"{n}_{side}" for n in names for side in ("baseline", "optimized")])
