"""Training, coefficient names, scorecards, scoring of tables and streams."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from loanweave.functions.decisions import prob_positive
from loanweave.operators import evaluation as E
from loanweave.operators import model as M
from loanweave.operators.scoring import RESULT, score_applications
from loanweave.plans.training import evaluate, train_and_predict
from loanweave.sources.models import load_model, save_model
from loanweave.streaming.applications import read_applications, score_applications_stream

FEATURES = ["history", "history_o", "size"]


@pytest.fixture(scope="module")
def loans(spark):
    rng = random.Random(1)
    rows = []
    for i in range(900):
        history, other, size = rng.choice("aaabbc"), rng.choice(["x=1", "y_ohe_z"]), rng.choice("lms")
        risk = {"a": 0.1, "b": 0.4, "c": 0.8}[history] * (1.2 if size == "l" else 0.8)
        rows.append((i, history, other, size, int(rng.random() < risk), "car (new)", 1000 + i))
    return spark.createDataFrame(
        rows, "id bigint, history string, history_o string, size string, credit_risk int, purpose string, credit_amount bigint"
    ).withColumn("label", F.col("credit_risk").cast("double"))


@pytest.fixture(scope="module")
def model(loans):
    return M.train_pd_model(loans, FEATURES)


def test_every_coefficient_has_its_name(model, loans):
    names = M.feature_names(model, loans)
    assert names[:3] == ["history=a", "history=b", "history=c"]
    assert set(names[3:5]) == {"history_o=x=1", "history_o=y_ohe_z"} and len(names) == 8
    table = {r.feature: r for r in M.coefficient_table(model, loans).collect()}
    assert table["history=c"].coefficient > table["history=a"].coefficient
    assert table["history=c"].sign == "+" and table["history=c"].risk_effect == "Augmente le risque"
    assert sorted(r.rank for r in table.values()) == list(range(1, 9))


def test_fit_meets_its_likelihood_equations(model, loans):
    scored = model.transform(loans).withColumn("p1", prob_positive())
    for feature in FEATURES:
        sums = scored.groupBy(feature).agg(F.abs(F.sum("p1") - F.sum("label")).alias("off"), F.count("*").alias("n"))
        assert sums.agg(F.max(F.col("off") / F.col("n"))).first()[0] < 1e-7


def test_trees_are_fitted_on_parts_of_bounded_size(spark, loans, monkeypatch):
    monkeypatch.setattr(M, "TREE_ROWS", 20)
    sizes = []
    fit = M.RandomForestClassifier.fit

    def noted(self, rows):
        sizes.extend(rows.groupBy(F.spark_partition_id()).count().toPandas()["count"])
        return fit(self, rows)

    monkeypatch.setattr(M.RandomForestClassifier, "fit", noted)
    M.train_tree_models(loans.coalesce(1), loans, FEATURES, trees=1, depth=1)
    assert sum(sizes) == loans.count() and max(sizes) <= 25


def test_scorecard_scores_like_the_model(model, loans):
    card = M.scorecard_from_model(model, loans)
    both = M.scorecard_score(model.transform(loans).withColumn("expected", prob_positive()).drop("prediction"), card)
    assert both.agg(F.max(F.abs(F.col("p1") - F.col("expected")))).first()[0] < 1e-12
    unseen = loans.limit(1).withColumn("history", F.lit("never seen"))
    expected = model.transform(unseen).select(prob_positive()).first()[0]
    assert M.scorecard_score(unseen, card).first().p1 == pytest.approx(expected, abs=1e-12)


def test_labels_equal_those_of_the_indexer(model, loans):
    rows = M.category_labels(loans, FEATURES).collect()
    fitted = model.stages[0]
    for variable, labels in zip(fitted.getInputCols(), fitted.labelsArray):
        ours = [r.label for r in sorted((r for r in rows if r.variable == variable), key=lambda r: r["index"])]
        assert ours == list(labels)


def test_metrics_agree_with_the_evaluator(loans):
    model, predictions = train_and_predict(loans.select("id", *FEATURES, "credit_risk"), FEATURES)
    metrics = evaluate(predictions)
    scored = model.transform(loans.join(predictions.select("id"), "id", "left_semi"))
    reference = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(scored)
    assert metrics["auc"].first().auc == pytest.approx(reference, abs=1e-9)
    assert metrics["auc"].first().auc > 0.6
    counts = metrics["confusion_counts"].first()
    assert sum(counts) == predictions.count()


def test_tree_models_beat_chance(loans):
    models, scores = M.train_tree_models(loans.filter("id < 600"), loans.filter("id >= 600"), FEATURES, trees=5, depth=3)
    assert {r.model for r in scores.collect()} == set(models) == {"random_forest", "gradient_boosting"}
    assert all(r.auc > 0.6 for r in scores.collect())


def test_stored_model_predicts_the_same(model, loans, tmp_path):
    save_model(model, str(tmp_path / "model"))
    save_model(model, str(tmp_path / "model"))
    again = load_model(str(tmp_path / "model"))
    left = [r[0] for r in model.transform(loans).orderBy("id").select(prob_positive()).collect()]
    right = [r[0] for r in again.transform(loans).orderBy("id").select(prob_positive()).collect()]
    assert left == right


def test_scored_application_has_the_twelve_results(model, loans):
    row = score_applications(loans.limit(1), model).first()
    assert row.asDict().keys() == set(RESULT)
    assert row.expected_value == pytest.approx(row.expected_profit - row.expected_loss)


def test_stream_scores_like_a_table_and_every_file_once(spark, model, loans, tmp_path):
    source, sink, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    columns = ["id", *FEATURES, "purpose", "credit_amount"]
    schema = loans.select(*columns).schema

    def run():
        stream = read_applications(spark, source, schema, files_per_batch=1)
        score_applications_stream(stream, model, sink, state, keep=["id"]).awaitTermination()
        return spark.read.parquet(sink)

    loans.select(*columns).filter("id < 300").repartition(3).write.json(source)
    assert run().count() == 300
    loans.select(*columns).filter("id >= 300").coalesce(1).write.mode("append").json(source)
    scored = run()
    expected = score_applications(loans, model, keep=["id"])
    assert scored.count() == 900
    assert scored.exceptAll(expected.select(*scored.columns)).count() == 0


def test_perfect_predictions_report(spark):
    df = spark.createDataFrame([(1.0, 0.9, 1.0), (0.0, 0.1, 0.0)], "label double, p1 double, prediction double")
    assert {r.f1_score for r in E.classification_report(df).collect()} == {1.0}
