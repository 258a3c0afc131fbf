"""Feature matrix, boosted-tree training, scoring and prescriptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Row, functions as F

from ..functions import business as B
from ..functions.numeric import round_to
from ..functions.running import hash_ranks
from ..session import materialize

# Model inputs and output columns.
NUMERIC_FEATURES = [
    "count_429_onboarding",
    "count_500_onboarding",
    "count_503_onboarding",
    "total_errors_onboarding",
    "avg_ttft_ms_onboarding",
    "max_ttft_ms_onboarding",
    "avg_ttft_days_0_14",
    "max_ttft_days_0_14",
    "avg_context_saturation_onboarding",
    "max_context_saturation_onboarding",
    "avg_cache_ratio_onboarding",
    "avg_cache_ratio_0_14",
    "avg_ctx_sat_0_14",
    "max_ctx_sat_0_14",
    "avg_tokens_days_0_14",
    "avg_wow_pct_change_week2",
    "token_growth_slope_onboarding",
    "growth_rate",
]
ENCODED = {"industry": "industry_enc", "contract_tier": "contract_tier_enc"}
FEATURES = [*NUMERIC_FEATURES, *ENCODED.values()]
LABEL = "hard_churn_label"


def label_encoder(columns: dict[str, str] = ENCODED) -> Pipeline:
    """Category to its place in alphabetical order, as a double; NULL and unseen ones share the next place."""
    codes = [f"{c}_code" for c in columns]
    indexer = StringIndexer(
        inputCols=list(columns), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    # A cast drops the category list, so that trees split codes like any other number.
    numbers = ", ".join(f"CAST({code} AS DOUBLE) AS {out}" for code, out in zip(codes, columns.values()))
    return Pipeline(stages=[indexer, SQLTransformer(statement=f"SELECT *, {numbers} FROM __THIS__")])


def encode_labels(df: DataFrame, columns: dict[str, str] = ENCODED) -> DataFrame:
    """Codes fitted on ``df`` itself; a trained model scores with the codes it was fitted with."""
    return label_encoder(columns).fit(df).transform(df).drop(*[f"{c}_code" for c in columns])


def with_model_codes(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """``matrix`` with its categories encoded as in the fit of ``model``."""
    encoded = model.stages[0].transform(matrix.drop(*ENCODED.values()))
    return encoded.select(*matrix.columns)


def _numbers_and_label(features: DataFrame) -> DataFrame:
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in NUMERIC_FEATURES}
    return features.withColumns(numbers).withColumn("label", F.col(LABEL).cast("int").cast("double"))


def feature_matrix(features: DataFrame) -> DataFrame:
    """Encoded categories, missing numbers as 0 and a 0/1 ``label``."""
    return _numbers_and_label(encode_labels(features))


def stratified_split(
    df: DataFrame, label: str = LABEL, key: str = "company_id", test_share: float = 0.30, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: the same share of every label, chosen by seeded hash.

    The choice depends on the key alone, so a retried task repeats it.
    """
    ranked = hash_ranks(df, key, seed, [label])
    wanted = F.round(F.col("group_rows") * F.lit(test_share), 0)
    return ranked.withColumn("is_test", F.col("hash_rank") <= wanted).drop("hash_rank", "group_rows")


def stratified_folds(
    df: DataFrame, folds: int = 5, label: str = LABEL, key: str = "company_id", seed: int = 42
) -> DataFrame:
    """Add ``fold`` 0..folds-1, spread evenly over every label."""
    ranked = hash_ranks(df, key, seed, [label])
    return ranked.withColumn("fold", ((F.col("hash_rank") - 1) % folds).cast("int")).drop(
        "hash_rank", "group_rows"
    )


def class_weight(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Negatives per positive; one positive is assumed where there is none."""
    positive = F.col(label).cast("int") == 1
    return train.agg(
        F.count_if(~positive).alias("negatives"), F.count_if(positive).alias("positives")
    ).withColumn("weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1)))


def with_weights(df: DataFrame, weight: float) -> DataFrame:
    return df.withColumn("weight", F.when(F.col("label") == 1.0, F.lit(float(weight))).otherwise(F.lit(1.0)))


def churn_classifier(weighted: bool = True, trees: int = 100) -> Pipeline:
    """Encoder, assembler and boosted trees with the fixed hyper-parameters."""
    booster = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        maxIter=trees,
        maxDepth=4,
        stepSize=0.1,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=42,
    )
    if weighted:
        booster = booster.setWeightCol("weight")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return Pipeline(stages=[label_encoder(), assembler, booster])


ROWS_PER_TASK = 50_000


def _training_set(rows: DataFrame, balance: Row, *extra: str) -> DataFrame:
    """Weighted training rows, stored once and cached; small sets in few partitions.

    Boosting runs some ten short jobs per tree. The checkpoint keeps each of
    them from planning the feature lineage again, and on few rows the number
    of tasks sets the run time. The rows are dealt anew, so what stands above
    keeps its own number of tasks.
    """
    tasks = -(-(balance["negatives"] + balance["positives"]) // ROWS_PER_TASK)
    weighted = with_weights(rows, balance["weight"]).select("label", "weight", *extra, *ENCODED, *NUMERIC_FEATURES)
    return materialize(weighted.repartition(max(1, tasks))).persist()


def _stored(features: DataFrame) -> DataFrame:
    """The columns training needs, stored: indexing, splitting and weighting read them in turn."""
    return materialize(features.select("company_id", LABEL, *ENCODED, *NUMERIC_FEATURES))


def train_churn_model(features: DataFrame, trees: int = 100) -> PipelineModel:
    """Fit on the 70 % side of the split, churners weighted by class balance."""
    split = stratified_split(_numbers_and_label(_stored(features)))
    train = split.where(~F.col("is_test"))
    train = _training_set(train, class_weight(train).first())
    try:
        return churn_classifier(trees=trees).fit(train)
    finally:
        train.unpersist()


def score(model: PipelineModel, matrix: DataFrame, output: str = "probability") -> DataFrame:
    """Add the churn probability of each row of a feature matrix.

    Categories are encoded as in training, whatever codes ``matrix`` carries.
    """
    kept = [c for c in matrix.columns if c != output]
    raw = matrix.select(*kept).drop(*ENCODED.values())
    return model.transform(raw).select(*kept, vector_to_array("probability")[1].alias(output))


def cross_validate(features: DataFrame, folds: int = 5, trees: int = 100, parallelism: int = 5) -> DataFrame:
    """Mean and population deviation of the ROC-AUC over stratified folds."""
    spark = features.sparkSession
    data = stratified_folds(_numbers_and_label(_stored(features)), folds)
    # The fit of the reference metric weights churners by the whole set.
    data = _training_set(data, class_weight(data).first(), "fold")
    evaluator = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    estimator = churn_classifier(trees=trees)
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    try:
        fitted = validator.fit(data)
    finally:
        data.unpersist()
    mean, spread = float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])
    return spark.createDataFrame([(folds, mean, spread)], "folds int, mean_auc double, std_auc double")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ------------------------------------------------------------- prescriptions

# Output columns in order.
SCORED_COLUMNS = [
    "company_id",
    "company_name",
    "industry",
    "contract_tier",
    "friction_bucket",
    "churn_probability",
    "risk_tier",
    "top_friction_trigger",
    "recommended_action",
    "action_owner",
    "hard_churn_label",
    "days_to_hard_churn",
    "count_429_onboarding",
    "avg_ttft_ms_onboarding",
    "avg_cache_ratio_onboarding",
    "max_context_saturation_onboarding",
    "avg_tokens_days_0_14",
    "token_growth_slope_onboarding",
]


def prescribe(features: DataFrame, rules: Sequence[B.Rule] = B.RULES, default: B.Rule = B.DEFAULT_RULE) -> DataFrame:
    """Trigger, action and owner per account by the first rule that holds."""
    return features.withColumn("p", B.prescribe(rules, default)).select("*", "p.*").drop("p")


def scored_accounts(features: DataFrame, probability: str = "probability", sort: bool = True) -> DataFrame:
    """Rounded probability, tier (from the unrounded one) and prescription."""
    out = (
        prescribe(features)
        .withColumn("churn_probability", round_to(probability, 4))
        .withColumn("risk_tier", B.risk_tier(probability))
        .withColumn("hard_churn_label", F.col("hard_churn_label").cast("int"))
        .select(*SCORED_COLUMNS)
    )
    return out.orderBy(F.desc("churn_probability")) if sort else out
