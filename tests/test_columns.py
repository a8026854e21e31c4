"""Bins, rates, money and decisions on hand-made rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loanweave.functions import decisions as D
from loanweave.functions import risk as R
from loanweave.functions.bins import bin_column, bin_columns
from loanweave.functions.fixed_values import BINS
from loanweave.operators.cleaning import clean_loans, fill_unknown, normalise_target, trim_strings
from loanweave.operators.scoring import price_applications


def column(spark, values, kind, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


EDGES = {
    "duration": [(12, "<=12"), (13, "13-24"), (24, "13-24"), (25, "25-36"), (36, "25-36"), (37, "37-48"), (48, "37-48"), (49, ">48")],
    "amount": [
        (1000, "<=1000"),
        (1001, "1001-2000"),
        (2000, "1001-2000"),
        (2001, "2001-5000"),
        (5000, "2001-5000"),
        (5001, "5001-10000"),
        (10000, "5001-10000"),
        (10001, ">10000"),
    ],
    "present_residence": [(1, "<=1"), (2, "2-3"), (3, "2-3"), (4, ">=4")],
    "age": [(24, "<25"), (25, "25-35"), (35, "25-35"), (36, "36-45"), (45, "36-45"), (46, "46-60"), (60, "46-60"), (61, ">60")],
    "number_credits": [(0, "0-1"), (1, "0-1"), (2, "2"), (3, ">=3")],
    "people_liable": [(0, "0"), (1, "1"), (2, ">=2"), (5, ">=2")],
}


@pytest.mark.parametrize("name", list(EDGES))
def test_bin_edges(spark, name):
    df = column(spark, [v for v, _ in EDGES[name]], "bigint", name)
    got = {r[name]: r[f"{name}_cat"] for r in bin_column(df, name).collect()}
    assert got == dict(EDGES[name])


def test_values_between_bins_and_missing_ones_get_the_last_label(spark):
    df = column(spark, [12.5, None], "double", "duration")
    assert {r.duration_cat for r in bin_column(df, "duration").collect()} == {">48"}
    named = bin_column(df, "duration", null_label="missing").collect()
    assert {r.duration: r.duration_cat for r in named} == {12.5: ">48", None: "missing"}


def test_every_number_falls_into_a_known_bin(spark):
    df = spark.range(-5, 20_000, 7).select(*[F.col("id").alias(c) for c in BINS])
    binned = bin_columns(df)
    for name, rules in BINS.items():
        labels = {r[0] for r in binned.select(f"{name}_cat").distinct().collect()}
        assert labels <= {label for label, _ in rules}


def test_rates_of_known_and_unknown_texts(spark):
    df = spark.createDataFrame(
        [("delay in paying off in the past", "business", 0), ("?", "?", 0), (None, None, None), ("?", "repairs", 1)],
        "credit_history string, purpose string, credit_risk int",
    ).withColumn("amount", F.lit(1000).cast("bigint"))
    rows = [(str(r.PD_history), str(r.PD), str(r.LGD), str(r.profit_margin)) for r in R.risk_columns(df).collect()]
    assert rows == [
        ("0.25", "0.25", "0.60", "0.12"),
        ("0.20", "0.20", "0.45", "0.12"),
        ("0.20", "0.20", "0.45", "0.12"),
        ("0.20", "0.60", "0.40", "0.25"),
    ]


def test_margin_bounds_are_inclusive(spark):
    df = column(spark, [0.03, 0.05, 0.0501, 0.10, 0.25, 0.45, 0.4501], "double", "PD")
    got = [float(r[0]) for r in df.select(R.profit_margin()).collect()]
    assert got == [0.08, 0.08, 0.10, 0.10, 0.12, 0.18, 0.25]


def test_category_bounds_are_exclusive_and_segment_bounds_inclusive(spark):
    df = column(spark, [0.0199, 0.02, 0.05, 0.10, 0.20], "double", "PD")
    assert [r[0] for r in df.select(R.pd_category()).collect()] == ["Très faible", "Faible", "Moyen", "Élevé", "Très élevé"]
    df = column(spark, [0.03, 0.0301, 0.10, 0.1001], "double", "PD")
    assert [r[0] for r in df.select(R.risk_segment()).collect()] == ["A", "B", "B", "C"]


def test_money_is_exact(spark):
    df = spark.createDataFrame([("existing credits paid back duly till now", "radio/television", 0, 1003)],
                               "credit_history string, purpose string, credit_risk int, amount bigint")
    row = R.risk_columns(df).first()
    assert row.expected_loss == Decimal("40.1200") and row.expected_profit == Decimal("100.3000")
    assert row.expected_value == Decimal("60.1800") and row.exposure_at_risk == Decimal("100.3000")


def test_known_application(spark):
    """Amount 2000, new car, PD 0.67104: loss 335.52, profit 500, value 164.48, refused."""
    df = spark.createDataFrame([("car (new)", 2000, 0.67104, 1)], "purpose string, credit_amount bigint, PD double, raw_prediction int")
    row = price_applications(df).first()
    assert (row.LGD, row.profit_margin, row.exposure_at_default) == (0.25, 0.25, 2000)
    assert round(row.expected_loss, 2) == 335.52 and row.expected_profit == 500.0 and round(row.expected_value, 2) == 164.48
    assert (row.credit_risk, row.risk_segment, row.decision) == (1, "C", "REFUSE")


def test_decision_rules_differ_on_purpose(spark):
    df = spark.createDataFrame([(0.30, 0.0), (0.05, 0.0), (0.5, 1.0)], "PD double, prediction double")
    rows = df.select(D.decision_by_pd(), D.decision_by_prediction(), D.predict_at_threshold("PD")).collect()
    assert [tuple(r) for r in rows] == [("REFUSE", "ACCEPTE", 0), ("ACCEPTE", "ACCEPTE", 0), ("REFUSE", "REFUSE", 0)]


def test_cleaning(spark):
    df = spark.createDataFrame([("  a ", 1, True), (None, None, False), ("", 2, None)], "t string, n int, credit_risk boolean")
    assert [tuple(r) for r in clean_loans(df).collect()] == [("a", 1, 1), ("Unknown", None, 0), ("", 2, None)]
    assert fill_unknown(df.select("n")).columns == ["n"]
    assert trim_strings(df).first().t == "a"


@pytest.mark.parametrize("kind,values", [("boolean", [True, False]), ("bigint", [1, 0]), ("string", ["1", "0"]), ("double", [1.0, 0.0])])
def test_target_becomes_a_number(spark, kind, values):
    out = normalise_target(column(spark, values, kind, "credit_risk"))
    assert out.dtypes == [("credit_risk", "int")] and [r[0] for r in out.collect()] == [1, 0]


def test_other_target_codings_are_refused(spark):
    assert normalise_target(column(spark, [1, None], "bigint", "credit_risk")).collect()[1][0] is None
    with pytest.raises(Exception, match="must be 0 or 1, not 2"):
        normalise_target(column(spark, [1, 2], "bigint", "credit_risk")).collect()


def test_missing_text_target_stays_missing(spark):
    rows = clean_loans(column(spark, [" 1", None], "string", "credit_risk")).collect()
    assert [r[0] for r in rows] == [1, None]
