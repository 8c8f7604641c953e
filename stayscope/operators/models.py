"""Model catalogue, cross-validation and comparison on an encoded matrix.

Every fitted model is a Spark ML ``PipelineModel``. Logistic models use
1/(C·Σw) as strength, which equates the mean loss of Spark with the summed loss
the published C values refer to. Trees need a depth bound in Spark, so depth is
an argument; boosting grows level by level.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.functions.columns import require_columns
from stayscope.functions.columns import ratio as _ratio
from stayscope.operators.evaluate import average_precision, curve, roc_auc
from stayscope.operators.split import class_counts, fold_cuts

Factory = Callable[..., object]

#: Published bound of the logistic fits; reaching it is told.
MAX_ITERATIONS = 2_000


def _logistic(seed: int, rows: int, mix: float, c: float) -> LogisticRegression:
    return LogisticRegression(
        regParam=1.0 / (c * rows),
        elasticNetParam=mix,
        standardization=False,
        maxIter=MAX_ITERATIONS,
        weightCol="weight",
    )


def _l2(seed: int, rows: int, c: float = 1.0, **_) -> LogisticRegression:
    return _logistic(seed, rows, 0.0, c)


def _l1(seed: int, rows: int, c: float = 0.5, **_) -> LogisticRegression:
    return _logistic(seed, rows, 1.0, c)


def _forest(
    seed: int, rows: int, trees: int = 300, max_depth: int = 15, min_leaf: int = 2, **_
) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=max_depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt",
        weightCol="weight",
        seed=seed,
    )


def _boosting(seed: int, rows: int, rounds: int = 300, max_depth: int = 5, **_) -> GBTClassifier:
    return GBTClassifier(
        maxIter=rounds, stepSize=0.05, maxDepth=max_depth, minInstancesPerNode=20,
        weightCol="weight", seed=seed,
    )


def _boosting_sampled(
    seed: int, rows: int, rounds: int = 400, max_depth: int = 5, **_
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=rounds, stepSize=0.05, maxDepth=max_depth, minInstancesPerNode=20,
        subsamplingRate=0.9, featureSubsetStrategy="0.9", weightCol="weight", seed=seed,
    )


def _most_frequent(seed: int, counts: dict[int, int], key: str) -> str:
    return "1.0D" if counts.get(1, 0) > counts.get(0, 0) else "0.0D"


def _prior(seed: int, counts: dict[int, int], key: str) -> str:
    return f"{counts.get(1, 0) / sum(counts.values())!r}D"


def _stratified(seed: int, counts: dict[int, int], key: str) -> str:
    rate = counts.get(1, 0) / sum(counts.values())
    drawn = f"conv(substring(md5(concat('{seed}:', CAST(`{key}` AS STRING))), 1, 8), 16, 10)"
    return f"CASE WHEN CAST({drawn} AS DOUBLE) / 4294967296D < {rate!r}D THEN 1.0D ELSE 0.0D END"


CONSTANT_MODELS: dict[str, Callable[[int, dict[int, int], str], str]] = {
    "dummy_stratified": _stratified,
    "dummy_most_frequent": _most_frequent,
    "dummy_prior": _prior,
}
LEARNED_MODELS: dict[str, Factory] = {
    "logreg_balanced": _l2,
    "logreg_l1": _l1,
    "random_forest": _forest,
    "hist_gb": _boosting,
    "lightgbm": _boosting_sampled,
}
CATALOGUE = (*CONSTANT_MODELS, *LEARNED_MODELS)
BASELINES = (*CONSTANT_MODELS, "logreg_balanced")


def check_names(names: Sequence[str]) -> list[str]:
    unknown = sorted(set(names) - set(CATALOGUE))
    if unknown:
        raise ValueError(f"unknown models {unknown}, use some of {list(CATALOGUE)}")
    return list(names)


def balanced_weight(label: Column, counts: dict[int, int]) -> Column:
    """n / (classes · rows of the class), so that classes weigh the same."""
    n = sum(counts.values())
    weight = F.lit(None).cast("double")
    for value, rows in counts.items():
        weight = F.when(label == value, n / (len(counts) * rows)).otherwise(weight)
    return weight


def fit(
    name: str,
    matrix: DataFrame,
    features: Sequence[str],
    target: str,
    seed: int = 42,
    key: str = "customerID",
    **options,
) -> PipelineModel:
    """Fit one catalogue model; the result scores a matrix with the same columns."""
    check_names([name])
    require_columns(matrix, [*features, target])
    counts = class_counts(matrix, target)
    if name in CONSTANT_MODELS:
        value = CONSTANT_MODELS[name](seed, counts, key)
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {value} AS p FROM __THIS__")])
    estimator = LEARNED_MODELS[name](seed, sum(counts.values()), **options)
    label = F.col(target).cast("int")
    training = matrix.select(
        *[f"`{f}`" for f in features],
        label.cast("double").alias("label"),
        balanced_weight(label, counts).alias("weight"),
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    fitted = Pipeline(stages=[assembler, estimator]).fit(training)
    last = fitted.stages[-1]
    if isinstance(last, LogisticRegressionModel) and last.hasSummary and last.summary.totalIterations >= MAX_ITERATIONS:
        warnings.warn(f"{name} did not converge in {MAX_ITERATIONS} iterations", stacklevel=2)
    return fitted


def positive_probability(scored: DataFrame) -> Column:
    """Probability of class 1; without probabilities, min-max of decision values."""
    if "p" in scored.columns:
        return F.col("p")
    if "probability" in scored.columns:
        return vector_to_array("probability")[1]
    raw = vector_to_array("rawPrediction")[1]
    ends = scored.select(raw.alias("r")).agg(
        F.struct(F.min("r").alias("lo"), F.max("r").alias("hi"))
    ).scalar()
    low, high = ends.getField("lo"), ends.getField("hi")
    return F.when(high > low, (raw - low) / (high - low)).otherwise(F.lit(0.5))


def score(model: PipelineModel, matrix: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Append ``p``; a matrix that has ``features`` already skips the assembler."""
    keep = list(keep) if keep is not None else [c for c in matrix.columns if c != "features"]
    stages = model.stages
    if "features" in matrix.columns:
        stages = [s for s in stages if not isinstance(s, VectorAssembler)]
    out = PipelineModel(stages).transform(matrix)
    return out.select(*[f"`{c}`" for c in keep], positive_probability(out).alias("p"))


def hyperparameters(model: PipelineModel) -> dict[str, str]:
    last = model.stages[-1]
    return {p.name: str(v) for p, v in last.extractParamMap().items()}


def algorithm(model: PipelineModel) -> str:
    last = model.stages[-1]
    return "Constant" if isinstance(last, SQLTransformer) else type(last).__name__


def importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance): tree importances or absolute coefficients."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = abs(last.coefficients.toArray())
    else:
        values = [None] * len(features)
    return spark.createDataFrame(
        [(f, None if v is None else float(v)) for f, v in zip(features, values, strict=True)],
        "feature string, importance double",
    )


def cross_validate(
    matrix: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    names: Sequence[str] = CATALOGUE,
    k: int = 5,
    seed: int = 42,
    options: dict[str, dict] | None = None,
) -> DataFrame:
    """Mean and population deviation of AP and ROC-AUC over stratified folds.

    One fit per model and fold; the out-of-fold scores of all of them are
    evaluated together.
    """
    names = check_names(names)
    folded = matrix.withColumn(
        "_fold", fold_cuts(matrix, key, target, k, seed).part_of(matrix).cast("int")
    ).persist()
    try:
        scored = []
        for name in names:
            for fold in range(k):
                model = fit(
                    name, folded.filter(F.col("_fold") != fold), features, target, seed, key,
                    **(options or {}).get(name, {}),
                )
                held = folded.filter(F.col("_fold") == fold)
                scored.append(
                    score(model, held, [key, target]).select(
                        F.lit(name).alias("model"),
                        F.lit(fold).alias("fold"),
                        F.col(target).cast("int").alias("y"),
                        "p",
                    )
                )
        per_fold = (
            curve(reduce(DataFrame.unionByName, scored), ["model", "fold"])
            .groupBy("model", "fold")
            .agg(average_precision().alias("ap"), roc_auc().alias("auc"))
            .collect()  # models × folds rows
        )
    finally:
        folded.unpersist()
    return (
        matrix.sparkSession.createDataFrame(
            per_fold, "model string, fold int, ap double, auc double"
        )
        .groupBy("model")
        .agg(
            F.avg("ap").alias("cv_pr_auc_mean"),
            F.stddev_pop("ap").alias("cv_pr_auc_std"),
            F.avg("auc").alias("cv_roc_auc_mean"),
            F.stddev_pop("auc").alias("cv_roc_auc_std"),
            F.count("*").alias("cv_folds"),
        )
    )


def constant_score(df: DataFrame, name: str, key: str, target: str, seed: int = 42) -> DataFrame:
    """(key, y, p) of one of the constant models fitted on ``df`` itself."""
    model = fit(name, df, [], target, seed, key)
    return score(model, df, [key, target]).select(
        key, F.col(target).cast("int").alias("y"), "p"
    )


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """(label, n, weight) of the balanced weighting."""
    counts = df.groupBy(F.col(target).cast("int").alias("label")).agg(F.count("*").alias("n"))
    size = counts.agg(
        F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    ).scalar()
    return counts.select(
        "label",
        "n",
        _ratio(size.getField("rows"), size.getField("classes") * F.col("n")).alias("weight"),
    )


