"""Encoding, training, scorecards, scoring of applications."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from loanweave.functions.decisions import prob_positive
from loanweave.functions.fixed_values import CATEGORICAL, RAW_NUMERIC, RISK_UP
from loanweave.operators import evaluation as E
from loanweave.operators import model as M
from loanweave.operators.cleaning import cast_label, drop_raw_numerics
from loanweave.operators.identity import train_test_split
from loanweave.operators.profiling import long_values
from loanweave.operators.sampling import oversample_minority, scale_features
from loanweave.operators.scoring import score_applications
from loanweave.plans.training import train_and_predict, training_rows
from loanweave.session import scratch_path
from loanweave.sources.models import load_model, save_model
from loanweave.sources.order_loans import join_orders
from loanweave.streaming.applications import read_applications, score_applications_stream

from . import inputs
from .registry import query, with_bins, with_loans, with_predictions

FEATURES = [*CATEGORICAL, *[f"{c}_cat" for c in RAW_NUMERIC]]


def training_table(spark, sf_dir):
    return drop_raw_numerics(inputs.loans(spark, sf_dir)).select("id", *FEATURES, "credit_risk")


def indexed_sql(select: str) -> str:
    """Index of every value: by frequency, then by text."""
    labels = ", ".join(
        f"""{v}_labels AS (SELECT {v}, CAST(row_number() OVER (ORDER BY count(*) DESC, {v}) - 1 AS DOUBLE) AS {v}_idx,
        count(*) OVER () AS {v}_size FROM binned GROUP BY {v})"""
        for v in FEATURES
    )
    joins = " ".join(f"JOIN {v}_labels USING ({v})" for v in FEATURES)
    return f"{with_bins('')}, {labels}, indexed AS (SELECT * FROM binned {joins}) {select}"


@query("index_categories", indexed_sql(f"SELECT id, {', '.join(f'{v}_idx' for v in FEATURES)} FROM indexed"))
def q_index_categories(spark, sf_dir):
    loans = inputs.binned(spark, sf_dir)
    return M.index_categories(FEATURES).fit(loans).transform(loans).select("id", *[f"{v}_idx" for v in FEATURES])


@query(
    "one_hot",
    indexed_sql(
        "SELECT id, "
        + ", ".join(f"{v}_size AS {v}_length, {v}_idx AS {v}_slot, 1.0::DOUBLE AS {v}_sum" for v in FEATURES)
        + " FROM indexed"
    ),
)
def q_one_hot(spark, sf_dir):
    """Length, active slot and sum of every indicator vector."""
    loans = inputs.binned(spark, sf_dir)
    encoded = Pipeline(stages=[M.index_categories(FEATURES), M.one_hot(FEATURES)]).fit(loans).transform(loans)

    def described(v):
        array = vector_to_array(f"{v}_ohe")
        return [
            F.size(array).cast("bigint").alias(f"{v}_length"),
            (F.array_position(array, F.lit(1.0)) - 1).cast("double").alias(f"{v}_slot"),
            F.aggregate(array, F.lit(0.0), lambda total, x: total + x).alias(f"{v}_sum"),
        ]

    return encoded.select("id", *[c for v in FEATURES for c in described(v)])


@query(
    "assemble",
    indexed_sql(
        f"""SELECT id, {' + '.join(f'{v}_size' for v in FEATURES)} AS length, concat_ws(',', """
        + ", ".join(
            f"CAST({' + '.join([*(f'{w}_size' for w in FEATURES[:i]), f'{v}_idx'])} AS BIGINT)" for i, v in enumerate(FEATURES)
        )
        + ") AS slots FROM indexed"
    ),
)
def q_assemble(spark, sf_dir):
    """Length and active slots of the assembled feature vector."""
    loans = inputs.binned(spark, sf_dir)
    array = vector_to_array("features")
    active = F.filter(F.sequence(F.lit(0), F.size(array) - 1), lambda i: F.get(array, i) != 0)
    encoded = Pipeline(stages=M.feature_stages(FEATURES)).fit(loans).transform(loans)
    return encoded.select(
        "id", F.size(array).cast("bigint").alias("length"), F.array_join(active.cast("array<string>"), ",").alias("slots")
    )


LABELS = """SELECT variable, label, CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, label) - 1 AS INTEGER) AS index,
    count(*) OVER (PARTITION BY variable) AS category_count FROM ({}) ORDER BY ALL"""
COUNTED = " UNION ALL ".join(
    f"SELECT '{v}' AS variable, {v} AS label, count(*) AS n FROM binned GROUP BY {v}" for v in FEATURES
)


@query("category_labels", with_bins(LABELS.format(COUNTED)))
def q_category_labels(spark, sf_dir):
    return M.category_labels(inputs.binned(spark, sf_dir), FEATURES)


@query(
    "feature_names",
    with_bins(
        f"""SELECT CAST(row_number() OVER (ORDER BY position, n DESC, label) - 1 AS BIGINT) AS position,
        concat(variable, '=', label) AS feature FROM ("""
        + " UNION ALL ".join(
            f"SELECT {i} AS position, '{v}' AS variable, {v} AS label, count(*) AS n FROM binned GROUP BY {v}"
            for i, v in enumerate(FEATURES)
        )
        + ")"
    ),
)
def q_feature_names(spark, sf_dir):
    loans = cast_label(inputs.binned(spark, sf_dir)).select("label", *FEATURES)
    names = M.feature_names(M.train_pd_model(loans, FEATURES), loans)
    return spark.createDataFrame(list(enumerate(names)), "position bigint, feature string")


HASH = "CAST('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 8) AS BIGINT)"
IN_TRAINING = f"{HASH} % 10000 < 7000"


def balance_sql(where: str = "true") -> str:
    """Rows and bad loans of every category. A fit without penalty expects as many bad loans as there are."""
    return with_bins(
        " UNION ALL ".join(
            f"""SELECT '{v}' AS variable, {v} AS value, count(*) AS row_count, CAST(sum(credit_risk) AS BIGINT) AS bad_loans,
            CAST(sum(credit_risk) AS BIGINT) AS expected_bad_loans FROM binned WHERE {where} GROUP BY {v}"""
            for v in FEATURES
        )
    )


def balance(scored, label, p1):
    """Rows, bad loans and the sum of predicted probabilities, to a whole loan, of every category."""
    return (
        long_values(scored.withColumns({"_label": label, "_p1": p1}), FEATURES, keep=["_label", "_p1"])
        .groupBy("variable", "value")
        .agg(
            F.count("*").alias("row_count"),
            F.sum("_label").cast("bigint").alias("bad_loans"),
            F.round(F.sum("_p1")).cast("bigint").alias("expected_bad_loans"),
        )
    )


@query("train_pd_model", balance_sql(IN_TRAINING))
def q_train_pd_model(spark, sf_dir):
    """The likelihood equations of the fit: expected bad loans of every category are those there are."""
    train, _ = train_test_split(training_rows(training_table(spark, sf_dir), FEATURES, spread=True))
    scored = M.train_pd_model(train, FEATURES).transform(train)
    return balance(scored, F.col("label"), prob_positive())


@query(
    "predict",
    with_bins(f"SELECT id, CAST(credit_risk AS DOUBLE) AS label, true AS is_probability, true AS follows FROM binned WHERE NOT {IN_TRAINING}"),
)
def q_predict(spark, sf_dir):
    """Test rows through the whole fitted pipeline; the prediction follows from the probability."""
    train, test = train_test_split(training_rows(training_table(spark, sf_dir), FEATURES, spread=True))
    scored = M.predict(M.train_pd_model(train, FEATURES), test, ["id", "label"])
    return scored.select(
        "id",
        "label",
        F.col("p1").between(0, 1).alias("is_probability"),
        (F.col("prediction") == (F.col("p1") > 0.5).cast("double")).alias("follows"),
    )


@query("prob_positive", with_predictions("SELECT id, p1 FROM predictions"))
def q_prob_positive(spark, sf_dir):
    """Scores packed into a probability vector, as models return them, and taken out again."""
    scored = inputs.predictions(spark, sf_dir)
    packed = scored.select("id", array_to_vector(F.array(1 - F.col("p1"), F.col("p1"))).alias("probability"))
    return packed.select("id", prob_positive().alias("p1"))


def fitted_coefficients(spark, sf_dir):
    loans = training_rows(training_table(spark, sf_dir), FEATURES, spread=True)
    return M.coefficient_table(M.train_pd_model(loans, FEATURES), loans)


@query(
    "coefficient_table",
    with_bins(
        " UNION ALL ".join(
            f"SELECT DISTINCT concat('{v}=', {v}) AS feature, true AS sized, true AS signed, true AS explained, true AS ranked FROM binned"
            for v in FEATURES
        )
    ),
)
def q_coefficient_table(spark, sf_dir):
    """One row for every category of the data; size, sign, effect and rank agree with the coefficient."""
    table = fitted_coefficients(spark, sf_dir)
    raises = F.col("coefficient") > 0
    place = F.row_number().over(Window.orderBy(F.abs("coefficient").desc(), "feature"))
    return table.select(
        "feature",
        (F.col("abs_importance") == F.abs("coefficient")).alias("sized"),
        ((F.col("sign") == "+") == raises).alias("signed"),
        ((F.col("risk_effect") == RISK_UP) == raises).alias("explained"),
        (F.col("rank") == place).alias("ranked"),
    )


@query("top_features", "SELECT CAST(unnest(range(1, 21)) AS INTEGER) AS place, true AS agrees FROM (SELECT count(*) FROM orders)")
def q_top_features(spark, sf_dir):
    """The 20 features with the largest coefficients are those ranked first."""
    top = M.top_k(fitted_coefficients(spark, sf_dir), "abs_importance", 20, "feature")
    place = F.row_number().over(Window.orderBy(F.col("abs_importance").desc(), "feature"))
    return top.select(place.alias("place"), (F.col("rank") == place).alias("agrees"))


@query(
    "evaluate_model",
    with_bins(
        f"""SELECT unnest(['auc', 'ks']) AS metric, (SELECT count(*) FROM binned WHERE NOT {IN_TRAINING}) AS test_rows,
        true AS inside, true AS agrees"""
    ),
)
def q_evaluate_model(spark, sf_dir):
    """AUC and KS of the trained model on its test part, held against the built-in evaluator and the ROC curve."""
    _, predictions = train_and_predict(training_table(spark, sf_dir), spread=True)
    rows = predictions.count()
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="p1", numBins=0)
    curve = E.roc_curve(predictions).agg(F.max(F.abs(F.col("tpr") - F.col("fpr")))).first()[0]
    metrics = E.auc(predictions).unpivot([], ["auc"], "metric", "value")
    metrics = metrics.unionByName(E.ks_statistic(predictions).unpivot([], ["ks"], "metric", "value"))
    other = F.when(F.col("metric") == "auc", evaluator.evaluate(predictions)).otherwise(curve)
    return metrics.select(
        "metric",
        F.lit(rows).cast("bigint").alias("test_rows"),
        F.col("value").between(0, 1).alias("inside"),
        (F.abs(F.col("value") - other) < 1e-9).alias("agrees"),
    )


@query(
    "save_load_model",
    with_loans("SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS different FROM loans"),
)
def q_save_load_model(spark, sf_dir):
    """A stored and loaded model must predict what the fitted one predicts."""
    loans = cast_label(inputs.binned(spark, sf_dir)).select("id", "label", *FEATURES)
    model = M.train_pd_model(loans, FEATURES)
    path = scratch_path(spark, "model")
    save_model(model, path)
    before = model.transform(loans).select("id", *FEATURES, prob_positive().alias("p_before"))
    after = load_model(path).transform(before)
    return after.agg(
        F.count("*").alias("row_count"), F.count_if(prob_positive() != F.col("p_before")).alias("different")
    )


@query(
    "train_tree_models",
    with_bins(
        f"""SELECT unnest(['random_forest', 'gradient_boosting']) AS model,
        (SELECT count(*) FROM binned WHERE NOT {IN_TRAINING}) AS test_rows, true AS inside, true AS agrees"""
    ),
)
def q_train_tree_models(spark, sf_dir):
    """Both models' AUC on the test rows, held against the one computed from their predictions."""
    train, test = train_test_split(training_rows(training_table(spark, sf_dir), FEATURES, spread=True))
    models, table = M.train_tree_models(train, test, FEATURES)
    rows = test.count()
    own = {name: E.auc(M.predict(model, test, ["id", "label"])).first()[0] for name, model in models.items()}
    expected = F.element_at(F.create_map(*[F.lit(x) for pair in own.items() for x in pair]), F.col("model"))
    return table.select(
        "model",
        F.lit(rows).cast("bigint").alias("test_rows"),
        ((F.col("auc") > 0) & (F.col("auc") < 1)).alias("inside"),
        # The evaluator joins neighbouring scores to about 1000 bins.
        (F.abs(F.col("auc") - expected) < 1e-2).alias("agrees"),
    )


# A fixed scorecard, so that scores can be computed in SQL too.
CARD = M.Scorecard(
    intercept=-1.25,
    points={
        "credit_history": {
            "no credits taken/ all credits paid back duly": -1.5,
            "all credits at this bank paid back duly": -0.75,
            "delay in paying off in the past": 0.5,
            "critical account/ other credits existing (not at this bank)": 1.25,
        },
        "purpose": {"car (new)": 0.25, "education": -0.5, "business": 0.75},
        "age_cat": {"<25": 0.5, "46-60": -0.25},
    },
)
LOG_ODDS = """-1.25::DOUBLE + CASE credit_history WHEN 'no credits taken/ all credits paid back duly' THEN -1.5
    WHEN 'all credits at this bank paid back duly' THEN -0.75 WHEN 'delay in paying off in the past' THEN 0.5
    WHEN 'critical account/ other credits existing (not at this bank)' THEN 1.25 ELSE 0 END
    + CASE purpose WHEN 'car (new)' THEN 0.25 WHEN 'education' THEN -0.5 WHEN 'business' THEN 0.75 ELSE 0 END
    + CASE age_cat WHEN '<25' THEN 0.5 WHEN '46-60' THEN -0.25 ELSE 0 END"""


@query(
    "scorecard_score",
    with_bins(
        f"""SELECT id, z AS log_odds, round(1 / (1 + exp(-z)), 9) AS p1, CASE WHEN z > 0 THEN 1 ELSE 0 END AS prediction
        FROM (SELECT id, {LOG_ODDS} AS z FROM binned)"""
    ),
)
def q_scorecard_score(spark, sf_dir):
    scored = M.scorecard_score(inputs.binned(spark, sf_dir), CARD)
    return scored.select("id", "log_odds", F.round("p1", 9).alias("p1"), "prediction")


SCORED = with_bins(
    f"""SELECT id, round(PD, 9) AS PD, CASE WHEN PD > 0.5 THEN 1 ELSE 0 END AS raw_prediction, LGD, profit_margin, credit_amount,
    credit_amount AS exposure_at_default, round(credit_amount * PD * LGD, 6) AS expected_loss,
    round(credit_amount * profit_margin, 6) AS expected_profit,
    round(credit_amount * profit_margin - credit_amount * PD * LGD, 6) AS expected_value,
    CASE WHEN PD > 0.05 THEN 1 ELSE 0 END AS credit_risk,
    CASE WHEN PD <= 0.03 THEN 'A' WHEN PD <= 0.10 THEN 'B' ELSE 'C' END AS risk_segment,
    CASE WHEN PD > 0.05 THEN 'REFUSE' ELSE 'ACCEPTE' END AS decision FROM (SELECT *,
    CASE WHEN PD <= 0.05 THEN 0.08::DOUBLE WHEN PD <= 0.10 THEN 0.10 WHEN PD <= 0.25 THEN 0.12
       WHEN PD <= 0.45 THEN 0.18 ELSE 0.25 END AS profit_margin FROM (SELECT id, amount AS credit_amount,
    CASE purpose WHEN 'car (new)' THEN 0.25::DOUBLE WHEN 'car (used)' THEN 0.30 WHEN 'furniture/equipment' THEN 0.35
       WHEN 'retraining' THEN 0.35 WHEN 'radio/television' THEN 0.40 WHEN 'repairs' THEN 0.40
       WHEN 'education' THEN 0.30 WHEN 'domestic appliances' THEN 0.45 WHEN 'business' THEN 0.60 ELSE 0.45 END AS LGD,
    1 / (1 + exp(-({LOG_ODDS}))) AS PD FROM binned))"""
)


def rounded_scores(scored):
    return scored.withColumns(
        {"PD": F.round("PD", 9), **{c: F.round(c, 6) for c in ("expected_loss", "expected_profit", "expected_value")}}
    )


@query("score_applications", SCORED)
def q_score_applications(spark, sf_dir):
    applications = inputs.binned(spark, sf_dir).withColumnRenamed("amount", "credit_amount")
    return rounded_scores(score_applications(applications, CARD, keep=["id"]))


@query("score_applications_stream", SCORED)
def q_score_applications_stream(spark, sf_dir):
    """Orders arrive as a stream of files, become loans, and are scored into a table."""
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    orders = read_applications(spark, sf_dir, schema, fmt="parquet", pathGlobFilter="orders.parquet")
    loans = join_orders(orders, spark.read.parquet(f"{sf_dir}/customer.parquet"))
    applications = inputs.bin_columns(loans).withColumnRenamed("amount", "credit_amount")
    sink = scratch_path(spark, "scored")
    job = score_applications_stream(applications, CARD, sink, scratch_path(spark, "scored-state"), keep=["id"])
    job.awaitTermination()
    return rounded_scores(spark.read.parquet(sink))


@query("score_with_model", balance_sql())
def q_score_with_model(spark, sf_dir):
    """Applications scored by the pipeline trained on them: expected bad loans of every category are those there are."""
    loans = inputs.binned(spark, sf_dir)
    model = M.train_pd_model(training_rows(loans, FEATURES, spread=True), FEATURES)
    applications = loans.withColumnRenamed("amount", "credit_amount").withColumn("truth", F.col("credit_risk"))
    scored = score_applications(applications, model, keep=["id", "truth", *FEATURES])
    return balance(scored, F.col("truth"), F.col("PD"))


@query(
    "oversample_minority",
    with_loans(
        f"""SELECT id, credit_risk, CAST(unnest(generate_series(1, copies)) AS BIGINT) AS copy FROM (
        SELECT id, credit_risk, largest // size + CASE WHEN place <= largest % size THEN 1 ELSE 0 END AS copies FROM (
        SELECT id, credit_risk, count(*) OVER (PARTITION BY credit_risk) AS size,
        row_number() OVER (PARTITION BY credit_risk ORDER BY {HASH}, id) AS place,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM loans GROUP BY credit_risk)) AS largest FROM loans))"""
    ),
)
def q_oversample_minority(spark, sf_dir):
    return oversample_minority(inputs.loans(spark, sf_dir), "credit_risk").select("id", "credit_risk", "copy")


@query(
    "scale_features",
    with_loans(
        "SELECT id, "
        + ", ".join(
            f"round((s.{c} - m_{c}) / s_{c}, 6) AS {c}_scaled" for c in RAW_NUMERIC
        )
        + " FROM loans s, (SELECT "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in RAW_NUMERIC)
        + " FROM loans)"
    ),
)
def q_scale_features(spark, sf_dir):
    names = list(RAW_NUMERIC)
    scaled = scale_features(inputs.loans(spark, sf_dir), names)
    return scaled.select("id", *inputs.doubles(scaled, *[f"{c}_scaled" for c in names], digits=6))
