"""Profiles and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loanweave.functions.fixed_values import CATEGORICAL, RAW_NUMERIC, TARGET
from loanweave.operators import evaluation as E
from loanweave.operators import profiling as P
from loanweave.operators.cleaning import cast_label
from loanweave.operators.identity import with_split

from . import inputs
from .registry import (
    DIRTY_EXPRESSIONS,
    LOAN_EXPRESSIONS,
    query,
    with_bins,
    with_dirty,
    with_loans,
    with_predictions,
    with_risk,
)

UNPIVOT = f"""long AS (UNPIVOT (SELECT credit_risk, {', '.join(CATEGORICAL)} FROM loans)
    ON {', '.join(CATEGORICAL)} INTO NAME variable VALUE value)"""


def unpivoted(select: str) -> str:
    return f"{with_loans('')}, {UNPIVOT} {select}"


MISSING = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL{f' OR isnan({name})' if name == 'score' else ''}) "
    f"AS missing_count FROM dirty"
    for name in (*LOAN_EXPRESSIONS, *(n for n in DIRTY_EXPRESSIONS if n not in LOAN_EXPRESSIONS))
)


@query("missing_counts", with_dirty(MISSING))
def q_missing_counts(spark, sf_dir):
    return P.missing_counts(inputs.dirty(spark, sf_dir))


DISTRIBUTION = """SELECT variable, value, count(*) AS count,
    concat(CAST(round(count(*) / (SELECT count(*) FROM loans) * 100, 1) AS VARCHAR), '%') AS percentage
    FROM long GROUP BY variable, value"""


PROFILE = " UNION ALL ".join(
    [f"SELECT 'missing' AS part, '{name}' AS variable, NULL AS value, count(*) FILTER ({name} IS NULL) AS n FROM loans" for name in LOAN_EXPRESSIONS]
    + ["SELECT 'count', variable, value, count(*) FROM long GROUP BY variable, value"]
    + [f"SELECT 'target {k}', variable, value, count(*) FILTER (credit_risk = {k}) FROM long GROUP BY variable, value" for k in (0, 1)]
)


@query("loan_profile", unpivoted(PROFILE))
def q_loan_profile(spark, sf_dir):
    """Missing values, distributions and the cross table from one reading."""
    found = P.profile(inputs.loans(spark, sf_dir))
    nothing = F.lit(None).cast("string")
    parts = [found["missing_counts"].select(F.lit("missing").alias("part"), F.col("column_name").alias("variable"), nothing.alias("value"), F.col("missing_count").alias("n"))]
    parts.append(found["category_distribution"].select(F.lit("count"), "variable", "value", "count"))
    parts += [found["target_crosstab"].select(F.lit(f"target {k}"), "variable", "value", f"{k}") for k in (0, 1)]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("category_distribution", unpivoted(DISTRIBUTION))
def q_category_distribution(spark, sf_dir):
    return P.category_distribution(inputs.loans(spark, sf_dir))


@query(
    "sorted_distribution",
    unpivoted(
        """SELECT variable, value, count(*) AS count,
        row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, value) AS place FROM long GROUP BY variable, value"""
    ),
)
def q_sorted_distribution(spark, sf_dir):
    """Every value's place in its variable: the order of the rows, as a column that can be compared."""
    ordered = P.category_distribution(inputs.loans(spark, sf_dir))
    place = F.row_number().over(Window.partitionBy("variable").orderBy(F.col("count").desc(), "value"))
    return ordered.select("variable", "value", "count", place.cast("bigint").alias("place"))


@query(
    "target_crosstab",
    unpivoted(
        """SELECT variable, value, "0", "1", concat(CAST(round("0" / ("0" + "1") * 100, 1) AS VARCHAR), '%') AS "0_pct",
        concat(CAST(round("1" / ("0" + "1") * 100, 1) AS VARCHAR), '%') AS "1_pct" FROM (
        SELECT variable, value, count(*) FILTER (credit_risk = 0) AS "0", count(*) FILTER (credit_risk = 1) AS "1"
        FROM long GROUP BY variable, value)"""
    ),
)
def q_target_crosstab(spark, sf_dir):
    return P.target_crosstab(inputs.loans(spark, sf_dir))


@query("class_balance", with_loans("SELECT CAST(credit_risk AS DOUBLE) AS label, count(*) AS count FROM loans GROUP BY ALL"))
def q_class_balance(spark, sf_dir):
    return P.class_balance(cast_label(inputs.loans(spark, sf_dir)))


SPLIT = """CASE WHEN CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 10000 < 7000
    THEN 'train' ELSE 'test' END AS split"""


@query("train_test_split", with_loans(f"SELECT id, credit_risk, {SPLIT} FROM loans"))
def q_train_test_split(spark, sf_dir):
    return with_split(inputs.loans(spark, sf_dir)).select("id", "credit_risk", "split")


@query("split_sizes", with_loans(f"SELECT split, count(*) AS count FROM (SELECT {SPLIT} FROM loans) GROUP BY split"))
def q_split_sizes(spark, sf_dir):
    return P.split_sizes(with_split(inputs.loans(spark, sf_dir)))


TRAINING = [*CATEGORICAL, *[f"{c}_cat" for c in RAW_NUMERIC], TARGET]


@query(
    "duplicate_audit",
    with_bins(
        f"""SELECT (SELECT count(*) FROM binned) AS row_count,
        (SELECT count(*) FROM (SELECT DISTINCT {', '.join(TRAINING)} FROM binned)) AS distinct_count"""
    ),
)
def q_duplicate_audit(spark, sf_dir):
    """The whole training table: 19 features and the target."""
    return P.duplicate_audit(inputs.binned(spark, sf_dir).select(*TRAINING))


QUANTILES = ["credit_amount", "expected_value", "exposure_at_risk", "PD"]


@query(
    "exact_quantiles",
    with_risk(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS variable, CAST({p} AS DOUBLE) AS probability,
            round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS quantile FROM risk"""
            for c in QUANTILES
            for p in (0.1, 0.5, 0.99)
        )
    ),
)
def q_exact_quantiles(spark, sf_dir):
    quantiles = P.exact_quantiles(inputs.risk(spark, sf_dir), QUANTILES, [0.1, 0.5, 0.99])
    return quantiles.select("variable", "probability", F.round("quantile", 6).alias("quantile"))


@query("confusion_matrix", with_predictions("SELECT label, prediction, count(*) AS count FROM predictions GROUP BY ALL"))
def q_confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(inputs.predictions(spark, sf_dir))


CELLS = """SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 1 AND prediction = 0) AS fn
    FROM predictions"""


@query("confusion_counts", with_predictions(CELLS))
def q_confusion_counts(spark, sf_dir):
    return E.confusion_counts(inputs.predictions(spark, sf_dir))


@query("filter_label_pred", with_predictions("SELECT id, label, prediction FROM predictions WHERE label = 1 AND prediction = 0"))
def q_filter_label_pred(spark, sf_dir):
    return E.filter_label_pred(inputs.predictions(spark, sf_dir), 1, 0).select("id", "label", "prediction")


REPORT = f""", cells AS ({CELLS}),
  classes AS (SELECT '0.0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, tn + fp AS support FROM cells
    UNION ALL SELECT '1.0', tp / (tp + fp), tp / (tp + fn), tp + fn FROM cells),
  scored AS (SELECT class, precision, recall, 2 * precision * recall / (precision + recall) AS f1_score, support FROM classes),
  report AS (SELECT * FROM scored
    UNION ALL SELECT 'accuracy', NULL, NULL, (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM cells
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM scored
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM scored)"""


@query(
    "classification_report",
    with_predictions(
        """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score,
        support FROM report""",
        REPORT,
    ),
)
def q_classification_report(spark, sf_dir):
    report = E.classification_report(inputs.predictions(spark, sf_dir))
    return report.select("class", *inputs.doubles(report, "precision", "recall", "f1_score", digits=6), "support")


CURVE = """, scores AS (SELECT p1 AS score, count(*) FILTER (label = 1) AS bad, count(*) FILTER (label = 0) AS good
    FROM predictions GROUP BY p1),
  curve AS (SELECT score, bad, good, CAST(sum(bad) OVER upto AS BIGINT) AS cum_bad, CAST(sum(good) OVER upto AS BIGINT) AS cum_good,
    sum(bad) OVER upto / (SELECT sum(bad) FROM scores) AS cum_bad_share,
    sum(good) OVER upto / (SELECT sum(good) FROM scores) AS cum_good_share
    FROM scores WINDOW upto AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


@query(
    "cumulative_shares",
    with_predictions(
        """SELECT score, bad, good, cum_bad, cum_good, round(cum_bad_share, 9) AS cum_bad_share,
        round(cum_good_share, 9) AS cum_good_share FROM curve""",
        CURVE,
    ),
)
def q_cumulative_shares(spark, sf_dir):
    shares = E.cumulative_shares(inputs.predictions(spark, sf_dir))
    return shares.select(
        "score", "bad", "good", "cum_bad", "cum_good", *inputs.doubles(shares, "cum_bad_share", "cum_good_share", digits=9)
    )


@query("ks_statistic", with_predictions("SELECT round(max(abs(cum_bad_share - cum_good_share)), 9) AS ks FROM curve", CURVE))
def q_ks_statistic(spark, sf_dir):
    return E.ks_statistic(inputs.predictions(spark, sf_dir)).select(F.round("ks", 9).alias("ks"))


@query(
    "roc_curve",
    with_predictions(
        """SELECT max(score) + 1 AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr FROM curve UNION ALL
        SELECT score, round(cum_good_share, 9), round(cum_bad_share, 9) FROM curve""",
        CURVE,
    ),
)
def q_roc_curve(spark, sf_dir):
    curve = E.roc_curve(inputs.predictions(spark, sf_dir))
    return curve.select("threshold", *inputs.doubles(curve, "fpr", "tpr", digits=9))


@query(
    "auc",
    with_predictions(
        """SELECT round(sum(bad * (goods_below + good / 2)) / (sum(bad) * sum(good)), 9) AS auc FROM
        (SELECT bad, good, coalesce(sum(good) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS goods_below FROM scores)""",
        CURVE,
    ),
)
def q_auc(spark, sf_dir):
    return E.auc(inputs.predictions(spark, sf_dir)).select(F.round("auc", 9).alias("auc"))
