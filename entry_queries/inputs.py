"""Inputs of the queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.functions.bins import bin_columns
from loanweave.functions.decisions import predict_at_threshold
from loanweave.functions.risk import risk_columns
from loanweave.operators.portfolio import select_portfolio
from loanweave.plans.optimisation import optimise_portfolio
from loanweave.session import stage
from loanweave.sources.order_loans import dirty_loans, loans_from_orders


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans_from_orders(spark, sf_dir)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_loans(loans(spark, sf_dir))


def binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_columns(loans(spark, sf_dir))


def risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_columns(binned(spark, sf_dir))


def selected(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Loans with ``optim_choice`` and the columns that are asked for, which are stored once."""
    needed = dict.fromkeys(["id", "expected_value", "exposure_at_risk", *columns])
    return select_portfolio(stage(risk(spark, sf_dir).select(*needed), "rated-loans"))


def optimised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with risk columns, ``optim_choice`` and the texts of the gold table.

    The table is stored on the way, so the columns no measure needs are left out before.
    """
    needed = ["id", "amount", "credit_history", "purpose", "age_cat", "credit_risk"]
    return optimise_portfolio(binned(spark, sf_dir).select(*needed))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with a score that is a fixed function of the id, with many equal scores."""
    scored = loans(spark, sf_dir).select(
        "id",
        F.col("credit_risk").cast("double").alias("label"),
        ((F.col("id") * 7919 % 1000) / F.lit(1000.0)).alias("p1"),
    )
    return scored.withColumn("prediction", predict_at_threshold("p1").cast("double"))


def doubles(df: DataFrame, *names: str, digits: int | None = None) -> list:
    """Columns as DOUBLE under their own names, rounded where digits are given."""
    def column(name: str):
        value = F.col(name).cast("double")
        return (value if digits is None else F.round(value, digits)).alias(name)

    return [column(name) for name in names]
