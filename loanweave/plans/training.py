"""Train a default model, keep its test predictions, and evaluate them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..functions.fixed_values import MAX_ITERATIONS, TARGET
from ..operators import evaluation as E
from ..operators.cleaning import cast_label, string_columns
from ..operators.identity import train_test_split
from ..operators.model import scorecard_from_model, scorecard_score, train_pd_model
from ..session import stage


def training_rows(loans: DataFrame, features: list[str], id: str = "id", spread: bool = False) -> DataFrame:
    """Id, label and features, written once: fitting reads them several times.

    ``spread`` shuffles the rows first. It pays when the source has few or uneven files,
    because every iteration waits for the largest partition.
    """
    labelled = cast_label(loans).select(id, "label", *features)
    return stage(labelled.repartition(id) if spread else labelled, "training")


def train_and_predict(
    loans: DataFrame,
    features: list[str] | None = None,
    id: str = "id",
    max_iter: int = MAX_ITERATIONS,
    spread: bool = False,
) -> tuple[PipelineModel, DataFrame]:
    """Fit on 70 % of the rows; return the model and stored predictions for the others.

    The test rows are scored by the model's points per category, one expression per row
    instead of the chain of encoders: the same probabilities up to the last digits.
    Predictions are written once as four narrow columns, so that every metric reads them
    instead of scoring again.
    """
    features = features or string_columns(loans, exclude=(TARGET,))
    labelled = training_rows(loans, features, id, spread)
    train, test = train_test_split(labelled, id)
    model = train_pd_model(train, features, max_iter=max_iter)
    scored = scorecard_score(test, scorecard_from_model(model, train))
    predictions = scored.select(id, "label", "p1", scored["prediction"].cast("double"))
    return model, stage(predictions, "predictions")


def evaluate(predictions: DataFrame) -> dict[str, DataFrame]:
    """All metrics of a prediction table, by name."""
    return {
        "confusion_matrix": E.confusion_matrix(predictions),
        "confusion_counts": E.confusion_counts(predictions),
        "classification_report": E.classification_report(predictions),
        "roc_curve": E.roc_curve(predictions),
        "auc": E.auc(predictions),
        "ks_statistic": E.ks_statistic(predictions),
    }
