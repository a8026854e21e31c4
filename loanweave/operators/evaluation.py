"""Evaluation of a binary classifier from its predictions.

Input: ``label`` 0/1, ``p1`` score, ``prediction`` 0/1. Rows with equal scores are one
group everywhere: their order among themselves carries no meaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running_totals import running_totals


def filter_label_pred(df: DataFrame, label: int, prediction: int) -> DataFrame:
    return df.filter((F.col("label") == label) & (F.col("prediction") == prediction))


def confusion_matrix(df: DataFrame) -> DataFrame:
    return df.groupBy("label", "prediction").agg(F.count("*").alias("count"))


def confusion_counts(df: DataFrame) -> DataFrame:
    """TP, TN, FP and FN in one pass."""
    def cell(label: int, prediction: int):
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    return df.agg(
        cell(1, 1).alias("tp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn")
    )


def classification_report(df: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy and the two averages."""
    cells = confusion_matrix(df)
    hits = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    # Each cell counts once for its true class and once for its predicted class.
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").cast("double").alias("class"),
                    F.col("count").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    hits.cast("bigint").alias("hits"),
                ),
                F.struct(
                    F.col("prediction").cast("double").alias("class"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("count").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        ).alias("side")
    ).select("side.*")
    counted = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0))
    scored = counted.withColumns({"precision": precision, "recall": recall}).withColumn(
        "f1_score",
        F.coalesce(
            F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
        ),
    )
    names = ["precision", "recall", "f1_score"]
    rows = F.sum("support")
    summary = scored.agg(
        rows.alias("support"),
        (F.sum("hits") / rows).alias("accuracy"),
        *[F.avg(n).alias(f"macro_{n}") for n in names],
        *[(F.sum(F.col(n) * F.col("support")) / rows).alias(f"weighted_{n}") for n in names],
    )
    nothing = F.lit(None).cast("double")
    per_class = scored.select(F.col("class").cast("string").alias("class"), *names, "support")
    averages = summary.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class"),
                    nothing.alias("precision"),
                    nothing.alias("recall"),
                    F.col("accuracy").alias("f1_score"),
                    "support",
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("class"),
                        *[F.col(f"{kind}_{n}").alias(n) for n in names],
                        "support",
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        ).alias("row")
    ).select("row.*")
    return per_class.unionByName(averages)


def score_groups(df: DataFrame, label: str = "label", score: str = "p1") -> DataFrame:
    """Bad and good rows per distinct score."""
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("bad"), F.count_if(F.col(label) != 1).alias("good"))
    )


def cumulative_shares(df: DataFrame, label: str = "label", score: str = "p1") -> DataFrame:
    """Per score, highest first: running counts and running shares of bads and goods."""
    running = running_totals(score_groups(df, label, score), [F.col("score").desc()], ["bad", "good"])
    return running.select(
        "score",
        "bad",
        "good",
        "cum_bad",
        "cum_good",
        F.try_divide(F.col("cum_bad"), F.col("total_bad")).alias("cum_bad_share"),
        F.try_divide(F.col("cum_good"), F.col("total_good")).alias("cum_good_share"),
    )


def ks_statistic(df: DataFrame, label: str = "label", score: str = "p1") -> DataFrame:
    """Largest distance between the running shares of bads and goods, in one row."""
    shares = cumulative_shares(df, label, score)
    return shares.agg(F.max(F.abs(F.col("cum_bad_share") - F.col("cum_good_share"))).alias("ks"))


def roc_curve(df: DataFrame, label: str = "label", score: str = "p1") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, from the point where nothing is flagged."""
    shares = cumulative_shares(df, label, score)
    points = shares.select(
        F.col("score").alias("threshold"), F.col("cum_good_share").alias("fpr"), F.col("cum_bad_share").alias("tpr")
    )
    start = shares.agg((F.max("score") + 1).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def auc(df: DataFrame, label: str = "label", score: str = "p1") -> DataFrame:
    """Exact area under the ROC curve in one row; equal scores count half."""
    running = running_totals(score_groups(df, label, score), [F.col("score")], ["good"])
    good_below = F.col("cum_good") - F.col("good")
    # Twice the number of won pairs stays a whole number, so the sum is exact.
    won_twice = F.col("bad").cast("decimal(18,0)") * (2 * good_below + F.col("good")).cast("decimal(19,0)")
    pairs_twice = F.sum("bad").cast("double") * F.sum("good").cast("double") * 2
    return running.agg(F.try_divide(F.sum(won_twice).cast("double"), pairs_twice).alias("auc"))
