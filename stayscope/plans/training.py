"""Preprocessing, feature selection, training, evaluation and audit runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.functions.columns import label_column, require_columns, yes_no_to_bit
from stayscope.operators import evaluate, fairness, models, profile
from stayscope.operators.contract import assert_valid, training_contract
from stayscope.operators.encode import Encoder, account_spec, fit_encoder
from stayscope.operators.prepare import cast_accounts, derive_features
from stayscope.operators.split import stratified_split
from stayscope.session import cut_lineage
from stayscope.sources import registry, tables


@dataclass(frozen=True)
class Prepared:
    """``matrix`` has key, target bit, split and the encoded features."""

    matrix: DataFrame
    encoder: Encoder
    features: list[str]
    seed: int


def encode_accounts(
    typed: DataFrame,
    include_derived: bool = True,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
) -> Prepared:
    """Typed rows → derived → split → encoder fitted on train → all rows encoded.

    All splits stay one frame: the encoding is one projection and the split a
    column, so nothing is scanned once per split.
    """
    wide = cut_lineage(derive_features(typed) if include_derived else typed)  # read by the class counts, the cuts and the split
    wide = stratified_split(wide, fixed.KEY, fixed.TARGET, test_size, val_size, seed)
    wide = wide.withColumn(fixed.TARGET, yes_no_to_bit(F.col(fixed.TARGET)))
    wide = cut_lineage(wide)  # read by the fit of the encoder and by the encoding
    spec = account_spec(include_derived)
    encoder = fit_encoder(wide.filter(F.col("split") == "train"), spec)
    matrix = encoder.encode(wide, [fixed.KEY, fixed.TARGET, "split"])
    return Prepared(matrix, encoder, spec.outputs, seed)


def preprocess(
    raw: DataFrame,
    folder: str | None = None,
    include_derived: bool = True,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
) -> Prepared:
    """Text rows → cast → contract check → :func:`encode_accounts` → split folders.

    With ``folder`` the matrix is written by split with its manifest, and the
    returned matrix reads the written files.
    """
    typed = cut_lineage(cast_accounts(raw))
    assert_valid(typed, training_contract())
    prepared = encode_accounts(typed, include_derived, test_size, val_size, seed)
    if folder is None:
        return prepared
    spark = raw.sparkSession
    tables.write_splits(prepared.matrix, f"{folder}/matrix")
    matrix = tables.read_matrix(spark, f"{folder}/matrix")
    manifest = tables.split_manifest(
        matrix, fixed.TARGET, prepared.features, seed, include_derived=include_derived, inputs=typed.columns
    )
    tables.write_json_record(spark, manifest, f"{folder}/manifest")
    return Prepared(matrix, prepared.encoder, prepared.features, seed)


@dataclass(frozen=True)
class Comparison:
    summary: DataFrame
    cv: DataFrame
    sweep: DataFrame
    scores: DataFrame
    best: str
    fitted: dict[str, PipelineModel]


def train_models(
    matrix: DataFrame,
    features: Sequence[str],
    target: str = fixed.TARGET,
    key: str = fixed.KEY,
    names: Sequence[str] = models.CATALOGUE,
    folds: int = 5,
    seed: int = 42,
    feature_subset: Sequence[str] | None = None,
    options: dict[str, dict] | None = None,
    registry_folder: str | None = None,
    report_folder: str | None = None,
    encoder: Encoder | None = None,
) -> Comparison:
    """Cross-validate, fit, tune and compare models; store them if a folder is given.

    The loop runs over models; every fit is distributed. Scores of all models on
    train and val are stored once, and all metrics come from that table.
    """
    names = models.check_names(names)
    used = list(feature_subset) if feature_subset is not None else list(features)
    require_columns(matrix, [*used, key, target, "split"])
    options = options or {}
    data = matrix.filter(F.col("split").isin("train", "val")).select(
        key, target, "split", *[f"`{f}`" for f in used]
    ).persist()
    train = data.filter(F.col("split") == "train")
    try:
        cv = models.cross_validate(train, used, target, key, names, folds, seed, options)
        fitted = {
            n: models.fit(n, train, used, target, seed, key, **options.get(n, {})) for n in names
        }
        scores = cut_lineage(
            reduce(
                DataFrame.unionByName,
                [
                    models.score(m, data, [key, target, "split"]).select(
                        F.lit(n).alias("model"), "split", key,
                        label_column(data, target).alias("y"), "p",
                    )
                    for n, m in fitted.items()
                ],
            )
        )
    finally:
        data.unpersist()

    val = scores.filter(F.col("split") == "val")
    sweep = evaluate.threshold_sweep(val, keys=["model"])
    tuned = evaluate.optimal_threshold(sweep, "f1", ["model"])
    default = evaluate.binary_metrics(scores, 0.5, ["model", "split"])
    at_tuned = evaluate.binary_metrics(
        val.join(tuned.select("model", "threshold"), "model"), "threshold", ["model"]
    )
    facts = matrix.sparkSession.createDataFrame(
        [(n, models.algorithm(m), len(used)) for n, m in fitted.items()],
        "model string, algorithm string, n_features int",
    )
    on_val = default.filter(F.col("split") == "val")
    summary = (
        facts.join(cv.select("model", "cv_pr_auc_mean", "cv_pr_auc_std", "cv_roc_auc_mean"), "model")
        .join(
            default.filter(F.col("split") == "train").select(
                "model", F.col("pr_auc").alias("train_pr_auc")
            ),
            "model",
        )
        .join(
            on_val.select(
                "model",
                F.col("pr_auc").alias("val_pr_auc"),
                F.col("roc_auc").alias("val_roc_auc"),
                F.col("brier").alias("val_brier"),
                F.col("f1").alias("val_f1_default"),
                F.col("lift_at_10").alias("val_lift_at_10"),
            ),
            "model",
        )
        .join(
            at_tuned.select(
                "model",
                F.col("threshold").alias("val_threshold_tuned"),
                F.col("f1").alias("val_f1_tuned"),
                F.col("precision").alias("val_precision_tuned"),
                F.col("recall").alias("val_recall_tuned"),
            ),
            "model",
        )
        .orderBy(F.desc("val_pr_auc"), "model")
    )
    rows = summary.collect()  # one row per model
    spark = matrix.sparkSession
    summary = spark.createDataFrame(rows, summary.schema)
    best = rows[0]["model"]
    if registry_folder is not None:
        digests = {
            part: profile.table_digest(matrix.filter(F.col("split") == part).select(key, target, *[f"`{f}`" for f in used])).first().asDict()
            for part in ("train", "val")
        }
        _register(
            registry_folder, fitted, used, seed, cv, default, at_tuned, encoder,
            feature_subset is not None, folds, {"key": key, "target": target, "data": digests},
        )
    result = Comparison(summary, cv, sweep, scores, best, fitted)
    if report_folder is not None:
        tables.write_report(summary, f"{report_folder}/summary")
        tables.write_report(cv.orderBy(F.desc("cv_pr_auc_mean"), "model"), f"{report_folder}/cv")
        tables.write_report(
            sweep.filter(F.col("model") == best).drop("model").orderBy("threshold"),
            f"{report_folder}/threshold_sweep",
        )
        tables.write_points(evaluate.pr_points(val, ["model"]), f"{report_folder}/pr_points")
        tables.write_points(evaluate.roc_points(val, ["model"]), f"{report_folder}/roc_points")
    return result


def _register(folder, fitted, used, seed, cv, default, at_tuned, encoder, subset, folds, facts) -> None:
    def keyed(table: DataFrame, *by: str) -> dict:
        return {
            tuple(r[b] for b in by): {
                c: float(r[c]) for c in table.columns if c not in by and r[c] is not None
            }
            for r in table.collect()
        }

    cv_rows, metrics, tuned = keyed(cv, "model"), keyed(default, "model", "split"), keyed(
        at_tuned, "model"
    )
    for name, model in fitted.items():
        whole = (
            PipelineModel([encoder.stage([facts["key"]]), *model.stages]) if encoder else model
        )
        registry.save_model(
            whole,
            name,
            folder,
            {
                "algorithm": models.algorithm(model),
                "feature_set": used,
                "hyperparameters": models.hyperparameters(model),
                "metrics": {
                    "train": metrics.get((name, "train"), {}),
                    "val": metrics.get((name, "val"), {}),
                    "val_tuned": tuned.get((name,), {}),
                    "cv": {**cv_rows.get((name,), {}), "n_folds": float(folds)},
                },
                "random_state": seed,
                "feature_subset_applied": subset,
                "n_encoder_stages": 1 if encoder else 0,
                **facts,
            },
        )


def train_baselines(matrix: DataFrame, features: Sequence[str], **arguments) -> Comparison:
    """The four baselines only."""
    return train_models(matrix, features, names=models.BASELINES, **arguments)


def tuned_threshold(manifest: dict) -> float:
    value = ((manifest.get("metrics") or {}).get("val_tuned") or {}).get("threshold")
    return float(value) if value is not None else fixed.DEFAULT_THRESHOLD


def score_split(
    spark: SparkSession, name: str, registry_folder: str, matrix_path: str, split: str
) -> tuple[DataFrame, dict]:
    """(key, y, p) of a stored model on one stored split, and its manifest.

    The stored pipeline encodes raw rows; the matrix is encoded already, so only
    the stages after the encoder run. Key, target and the number of encoder stages are facts of the manifest.
    """
    model, manifest = registry.load_model(spark, name, registry_folder)
    key, target = manifest.get("key", fixed.KEY), manifest.get("target", fixed.TARGET)
    data = tables.read_split(spark, matrix_path, split, target)
    stages = model.stages[manifest.get("n_encoder_stages", 0):]
    scored = models.score(PipelineModel(stages), data, [key, target])
    return (
        scored.select(key, F.col(target).cast("int").alias("y"), "p"),
        manifest,
    )


def evaluate_model(
    spark: SparkSession,
    name: str,
    registry_folder: str,
    matrix_path: str,
    split: str = "val",
    threshold: float | None = None,
) -> DataFrame:
    """Metric bundle of one stored model on one split."""
    scores, manifest = score_split(spark, name, registry_folder, matrix_path, split)
    chosen = threshold if threshold is not None else tuned_threshold(manifest)
    return evaluate.binary_metrics(scores, chosen)


def evaluation_report(
    spark: SparkSession,
    name: str,
    registry_folder: str,
    matrix_path: str,
    folder: str | None = None,
    with_test: bool = False,
    top: int = 20,
) -> dict[str, DataFrame]:
    """Metrics at 0.5 and at the tuned threshold, sweep, chart data and importance."""
    splits = ["val", "test"] if with_test else ["val"]
    parts, manifest = [], {}
    for split in splits:
        scored, manifest = score_split(spark, name, registry_folder, matrix_path, split)
        parts.append(scored.withColumn("split", F.lit(split)))
    scores = cut_lineage(reduce(DataFrame.unionByName, parts))
    chosen = tuned_threshold(manifest)
    val = scores.filter(F.col("split") == "val")
    model, _ = registry.load_model(spark, name, registry_folder)
    report = {
        "metrics_default": evaluate.binary_metrics(scores, 0.5, ["split"]),
        "metrics_tuned": evaluate.binary_metrics(scores, chosen, ["split"]),
        "threshold_sweep": evaluate.threshold_sweep(val),
        "confusion": evaluate.confusion(val, chosen),
        "calibration": evaluate.calibration(val),
        "pr_points": evaluate.pr_points(val),
        "roc_points": evaluate.roc_points(val),
        "importance": evaluate.top_importance(
            models.importance(model, manifest["feature_set"]), top
        ),
    }
    if folder is not None:
        for label, table in report.items():
            if not label.startswith("metrics"):
                write = tables.write_points if label.endswith("_points") else tables.write_report
                write(table, f"{folder}/{label}")
        record = {
            label: [r.asDict() for r in report[label].collect()]
            for label in ("metrics_default", "metrics_tuned")
        }
        tables.write_json_record(spark, {"model": name, **record}, f"{folder}/metrics")
    return report


def fairness_audit(
    spark: SparkSession,
    accounts: DataFrame,
    name: str,
    registry_folder: str,
    matrix_path: str,
    split: str = "test",
    threshold: float | None = None,
    attributes: Sequence[str] = tuple(fixed.SENSITIVE),
    folder: str | None = None,
) -> tuple[DataFrame, DataFrame, bool]:
    """Group table, summary and the all-within flag of a stored model."""
    scores, manifest = score_split(spark, name, registry_folder, matrix_path, split)
    chosen = threshold if threshold is not None else tuned_threshold(manifest)
    label = label_column(accounts, fixed.TARGET)
    joined = fairness.attach_sensitive(
        cut_lineage(scores), accounts, fixed.KEY, attributes, label
    )
    groups = fairness.group_metrics(joined, attributes, chosen)
    summary = fairness.fairness_summary(groups)
    within = summary.filter(~F.col("within_thresholds")).isEmpty()
    if folder is not None:
        tables.write_audit(groups, summary, folder, name, chosen, split)
    return groups, summary, within
