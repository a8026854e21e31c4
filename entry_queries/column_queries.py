"""Rates, money columns, categories and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loanweave.functions import decisions as D
from loanweave.functions.risk import pd_category, risk_segment
from loanweave.operators.identity import loan_id
from loanweave.operators.portfolio import select_optim_inputs
from loanweave.operators.scoring import price_applications

from . import inputs
from .registry import query, with_predictions, with_risk

# Query name -> columns it returns beside the id.
RATES = {
    "pd_history": ["credit_history", "PD_history"],
    "pd_final": ["credit_risk", "PD_history", "PD"],
    "lgd_by_purpose": ["purpose", "LGD"],
    "profit_margin": ["PD", "profit_margin"],
    "credit_amount": ["credit_amount"],
    "expected_profit": ["expected_profit"],
    "expected_loss": ["expected_loss"],
    "expected_value": ["expected_value"],
    "exposure_at_risk": ["exposure_at_risk"],
}
DECIMALS = {
    "PD_history",
    "PD",
    "LGD",
    "profit_margin",
    "expected_profit",
    "expected_loss",
    "expected_value",
    "exposure_at_risk",
}


def sql_columns(names: list[str]) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" if n in DECIMALS else n for n in names)


def spark_columns(names: list[str]) -> list:
    return [F.col(n).cast("double").alias(n) if n in DECIMALS else F.col(n) for n in names]


for _name, _columns in RATES.items():

    @query(_name, with_risk(f"SELECT id, {sql_columns(_columns)} FROM risk"))
    def q_rate(spark, sf_dir, columns=_columns):
        return inputs.risk(spark, sf_dir).select("id", *spark_columns(columns))


OPTIM_INPUTS = [
    "credit_amount",
    "expected_profit",
    "expected_loss",
    "expected_value",
    "exposure_at_risk",
    "PD",
    "LGD",
    "profit_margin",
]


@query("select_optim_inputs", with_risk(f"SELECT id, {sql_columns(OPTIM_INPUTS)} FROM risk"))
def q_select_optim_inputs(spark, sf_dir):
    return select_optim_inputs(inputs.risk(spark, sf_dir)).select("id", *spark_columns(OPTIM_INPUTS))


@query(
    "loan_id",
    with_risk(
        """SELECT count(*) AS loans, count(*) AS distinct_ids, CAST(1 AS BIGINT) AS first_id, count(*) AS last_id
        FROM risk"""
    ),
)
def q_loan_id(spark, sf_dir):
    """Ids of rows without a key: many rows are equal, all ids differ, and they have no gaps."""
    keyless = inputs.binned(spark, sf_dir).select("credit_history", "purpose", "age_cat", "amount_cat")
    return loan_id(keyless).agg(
        F.count("*").alias("loans"),
        F.count_distinct("id").alias("distinct_ids"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


@query(
    "credit_risk_level",
    with_risk(
        """SELECT id, CASE WHEN credit_risk = 1 THEN 'Risque élevé' ELSE 'Risque faible' END AS credit_risk_level
        FROM risk"""
    ),
)
def q_credit_risk_level(spark, sf_dir):
    return inputs.loans(spark, sf_dir).select("id", D.credit_risk_level().alias("credit_risk_level"))


@query(
    "pd_category",
    with_risk(
        """SELECT id, CASE WHEN pd < 0.02 THEN 'Très faible' WHEN pd < 0.05 THEN 'Faible' WHEN pd < 0.10 THEN 'Moyen'
        WHEN pd < 0.20 THEN 'Élevé' ELSE 'Très élevé' END AS pd_category FROM risk"""
    ),
)
def q_pd_category(spark, sf_dir):
    return inputs.risk(spark, sf_dir).select("id", pd_category().alias("pd_category"))


@query(
    "risk_segment",
    with_risk(
        "SELECT id, CASE WHEN pd <= 0.03 THEN 'A' WHEN pd <= 0.10 THEN 'B' ELSE 'C' END AS risk_segment FROM risk"
    ),
)
def q_risk_segment(spark, sf_dir):
    return inputs.risk(spark, sf_dir).select("id", risk_segment().alias("risk_segment"))


@query(
    "decision_by_pd",
    with_risk(
        """SELECT id, CASE WHEN pd > 0.05 THEN 1 ELSE 0 END AS risk_flag,
        CASE WHEN pd > 0.05 THEN 'REFUSE' ELSE 'ACCEPTE' END AS decision FROM risk"""
    ),
)
def q_decision_by_pd(spark, sf_dir):
    return inputs.risk(spark, sf_dir).select(
        "id", D.risk_flag().alias("risk_flag"), D.decision_by_pd().alias("decision")
    )


@query("predict_at_threshold", with_predictions("SELECT id, p1, CAST(prediction AS INTEGER) AS prediction FROM predictions"))
def q_predict_at_threshold(spark, sf_dir):
    return inputs.predictions(spark, sf_dir).select("id", "p1", D.predict_at_threshold().alias("prediction"))


@query(
    "decision_by_prediction",
    with_predictions(
        "SELECT id, CASE WHEN prediction = 0 THEN 'ACCEPTE' ELSE 'REFUSE' END AS decision FROM predictions"
    ),
)
def q_decision_by_prediction(spark, sf_dir):
    return inputs.predictions(spark, sf_dir).select("id", D.decision_by_prediction().alias("decision"))


@query(
    "exposure_at_default",
    with_risk("SELECT id, amount AS exposure_at_default FROM risk"),
)
def q_exposure_at_default(spark, sf_dir):
    rated = inputs.risk(spark, sf_dir).withColumn("raw_prediction", F.col("credit_risk"))
    return price_applications(rated, "amount", keep=["id"]).select("id", "exposure_at_default")
