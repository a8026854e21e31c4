"""Decision rules. Three separate rules exist, so each has its own function."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as V


def prob_positive(probability: str = "probability") -> Column:
    """Probability of class 1, taken out of the model's vector column."""
    return vector_to_array(F.col(probability))[1]


def predict_at_threshold(p1: str = "p1", threshold: float = V.PROBABILITY_CUTOFF) -> Column:
    return F.when(F.col(p1) > threshold, 1).otherwise(0)


def decision_by_prediction(prediction: str = "prediction") -> Column:
    """Accept when the model predicts class 0."""
    return F.when(F.col(prediction) == 0, V.ACCEPT).otherwise(V.REFUSE)


def risk_flag(pd: str = "PD", threshold: float = V.PD_DECISION_CUTOFF) -> Column:
    return F.when(F.col(pd) > threshold, 1).otherwise(0)


def decision_by_pd(pd: str = "PD", threshold: float = V.PD_DECISION_CUTOFF) -> Column:
    """Refuse when the PD passes the cut-off."""
    return F.when(risk_flag(pd, threshold) == 0, V.ACCEPT).otherwise(V.REFUSE)


def credit_risk_level(target: str = V.TARGET, bad_label: int = 1) -> Column:
    return F.when(F.col(target) == bad_label, V.HIGH_RISK).otherwise(V.LOW_RISK)


def portfolio_type(choice: str = "optim_choice") -> Column:
    return F.when(F.col(choice) == 1, V.OPTIMIZED).otherwise(V.BASELINE)
