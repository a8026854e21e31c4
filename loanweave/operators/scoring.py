"""Scoring of loan applications, for tables and streams alike."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.decisions import decision_by_pd, prob_positive, risk_flag
from ..functions.risk import lgd_by_purpose, money_columns, profit_margin, risk_segment
from .model import Scorecard, scorecard_score

RESULT = [
    "PD",
    "raw_prediction",
    "LGD",
    "profit_margin",
    "credit_amount",
    "exposure_at_default",
    "expected_loss",
    "expected_profit",
    "expected_value",
    "credit_risk",
    "risk_segment",
    "decision",
]


def default_probability(df: DataFrame, scorer: PipelineModel | Scorecard) -> DataFrame:
    """Add ``PD`` and ``raw_prediction``, by a fitted pipeline or by a scorecard."""
    if isinstance(scorer, Scorecard):
        scored, p1 = scorecard_score(df, scorer), F.col("p1")
    else:
        scored, p1 = scorer.transform(df), prob_positive()
    return scored.withColumns({"PD": p1, "raw_prediction": F.col("prediction").cast("int")})


def price_applications(df: DataFrame, amount: str = "credit_amount", keep: list[str] | None = None) -> DataFrame:
    """Rates, money columns, segment and decision for rows that already have a PD.

    Here the exposure is the amount itself, under its own name ``exposure_at_default``.
    """
    rated = df.withColumns({"LGD": lgd_by_purpose(), "profit_margin": profit_margin().cast("double")})
    rated = money_columns(rated.withColumn("LGD", F.col("LGD").cast("double")), amount)
    decided = rated.withColumns(
        {
            "exposure_at_default": F.col("credit_amount"),
            "credit_risk": risk_flag(),
            "risk_segment": risk_segment(),
            "decision": decision_by_pd(),
        }
    )
    return decided.select(*(keep or []), *RESULT)


def score_applications(
    df: DataFrame,
    scorer: PipelineModel | Scorecard,
    amount: str = "credit_amount",
    keep: list[str] | None = None,
) -> DataFrame:
    """Score every application of ``df``: PD, rates, money, segment and decision.

    A chain of projections: works on a table and on a stream, without a shuffle.
    """
    return price_applications(default_probability(df, scorer), amount, keep)
