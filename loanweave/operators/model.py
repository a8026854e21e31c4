"""Default models on categorical features, and what can be read from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decisions import predict_at_threshold, prob_positive
from ..functions.fixed_values import MAX_ITERATIONS, RISK_DOWN, RISK_UP, SEED
from .profiling import long_values

# The built-in 1e-6 ends a fit whose expected bad loans are still off by a share of the rows, so by whole loans in large tables.
TOLERANCE = 1e-12
# Rows of a task that fits trees. Encoded rows are far larger than those stored, so files are no measure of them.
TREE_ROWS = 100_000


def index_categories(columns: list[str]) -> StringIndexer:
    """Text to index, most frequent first; values not seen in training get their own index."""
    return StringIndexer(inputCols=columns, outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep")


def one_hot(columns: list[str]) -> OneHotEncoder:
    """Index to indicator vector. The slot that is dropped is the one for unseen values."""
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns], dropLast=True
    )


def assemble(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"{c}_ohe" for c in columns], outputCol="features")


def feature_stages(columns: list[str]) -> list:
    return [index_categories(columns), one_hot(columns), assemble(columns)]


def train_pd_model(
    train: DataFrame, features: list[str], label: str = "label", max_iter: int = MAX_ITERATIONS
) -> PipelineModel:
    """Logistic regression without penalty on the encoded texts."""
    regression = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, tol=TOLERANCE, regParam=0.0, elasticNetParam=0.0
    )
    return Pipeline(stages=[*feature_stages(features), regression]).fit(train)


def predict(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """Narrow predictions: the kept columns, ``p1`` and ``prediction``."""
    return model.transform(df).select(*keep, prob_positive().alias("p1"), "prediction")


def train_tree_models(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    label: str = "label",
    trees: int = 20,
    depth: int = 5,
    seed: int = SEED,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Random forest and boosted trees on the same features, compared by AUC on ``test``."""
    encoder = Pipeline(stages=feature_stages(features)).fit(train)
    learners = {
        "random_forest": RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed),
        "gradient_boosting": GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth, seed=seed),
    }
    context = train.sparkSession.sparkContext
    tasks = max(context.defaultParallelism, -(-train.count() // TREE_ROWS))
    encoded = encoder.transform(train.select(label, *features).repartition(tasks)).select(label, "features").persist()
    unseen = encoder.transform(test).select(label, "features")
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    models, rows = {}, []
    for name, learner in learners.items():
        fitted = learner.fit(encoded)
        models[name] = PipelineModel(stages=[*encoder.stages, fitted])
        rows.append((name, float(evaluator.evaluate(fitted.transform(unseen)))))
    encoded.unpersist()
    return models, train.sparkSession.createDataFrame(rows, "model string, auc double")


def category_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """The labels an indexer would learn: (variable, label, index, category_count).

    The window sees one row per label, which is what an indexer keeps on the driver.
    """
    counted = (
        long_values(df, columns)
        .filter(F.col("value").isNotNull())
        .groupBy("variable", F.col("value").alias("label"))
        .agg(F.count("*").alias("_n"))
    )
    per_variable = Window.partitionBy("variable")
    by_frequency = per_variable.orderBy(F.col("_n").desc(), "label")
    return counted.select(
        "variable",
        "label",
        (F.row_number().over(by_frequency) - 1).alias("index"),
        F.count("*").over(per_variable).alias("category_count"),
    )


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """``variable=label`` of every coefficient, in order.

    Read from the metadata of the feature vector, which names every slot. Rebuilding
    names from label lists goes wrong as soon as a slot is dropped or added.
    """
    encoder = next(stage for stage in model.stages if stage.hasParam("dropLast"))
    variables = sorted((c.removesuffix("_ohe") for c in encoder.getOutputCols()), key=len, reverse=True)
    groups = model.transform(df).schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((slot for group in groups.values() for slot in group), key=lambda slot: slot["idx"])

    def name(slot: dict) -> str:
        variable = next(v for v in variables if slot["name"].startswith(f"{v}_ohe_"))
        return f"{variable}={slot['name'].removeprefix(f'{variable}_ohe_')}"

    return [name(slot) for slot in slots]


def coefficient_table(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Audit of the coefficients: rank by size, sign, and what it does to the risk.

    One row per category, so the ranking window is as small as the model itself.
    """
    names = feature_names(model, df)
    weights = model.stages[-1].coefficients.toArray().tolist()
    if len(names) != len(weights):
        raise ValueError(f"{len(names)} names for {len(weights)} coefficients")
    table = df.sparkSession.createDataFrame(list(zip(names, weights)), "feature string, coefficient double")
    size, raises = F.abs("coefficient"), F.col("coefficient") > 0
    return table.select(
        F.row_number().over(Window.orderBy(size.desc(), "feature")).alias("rank"),
        "feature",
        "coefficient",
        size.alias("abs_importance"),
        F.when(raises, "+").otherwise("-").alias("sign"),
        F.when(raises, RISK_UP).otherwise(RISK_DOWN).alias("risk_effect"),
    )


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal ones by ``tie``."""
    return df.orderBy(F.col(by).desc(), tie).limit(k)


@dataclass(frozen=True)
class Scorecard:
    """A logistic model as points per category."""

    intercept: float
    points: dict[str, dict[str, float]]

    def log_odds(self) -> Column:
        """Sum of points, as one expression: no join and no shuffle. Unknown values add 0."""
        total = F.lit(self.intercept)
        for variable, labels in self.points.items():
            pairs = F.create_map(*[F.lit(cell) for pair in labels.items() for cell in pair])
            total = total + F.coalesce(F.try_element_at(pairs, F.col(variable)), F.lit(0.0))
        return total


def scorecard_from_model(model: PipelineModel, df: DataFrame) -> Scorecard:
    points: dict[str, dict[str, float]] = {}
    weights = model.stages[-1].coefficients.toArray().tolist()
    for feature, weight in zip(feature_names(model, df), weights):
        variable, label = feature.split("=", 1)
        points.setdefault(variable, {})[label] = weight
    return Scorecard(float(model.stages[-1].intercept), points)


def scorecard_score(df: DataFrame, card: Scorecard) -> DataFrame:
    """Add log odds, ``p1`` and ``prediction`` of a scorecard."""
    scored = df.withColumn("log_odds", card.log_odds())
    scored = scored.withColumn("p1", 1 / (1 + F.exp(-F.col("log_odds"))))
    return scored.withColumn("prediction", predict_at_threshold("p1"))
