"""Named queries over the order tables, one per operator.

Each takes (spark, folder) and returns a frame with rounded numbers, so that
results can be compared between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.functions import columns as C
from stayscope.functions import fixed
from stayscope.operators import (
    association,
    contract,
    encode,
    evaluate,
    fairness,
    models,
    prepare,
    profile,
    ranking,
    scoring,
    split,
)
from stayscope.plans import explore, training
from stayscope.plans.snapshot import customer_snapshot, read_table, subscriber_rows
from stayscope.session import cut_lineage, fresh_path
from stayscope.sources import checksums, registry, tables
from stayscope.streaming import scoring as streaming

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: A fixed linear score over encoded columns, so a whole scoring run is comparable.
LINEAR_SCORE = (
    "-0.5 - 0.9 * `tenure` + 0.4 * `MonthlyCharges` + 0.2 * `TotalCharges` - 0.7 * `Contract`"
    " + 0.3 * `has_internet` + 0.6 * `InternetService_Fiber optic`"
)
THRESHOLD = 0.3


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, integers widened; order of rows is not part of a result."""
    out = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("double", "float"):
            column = F.round(column.cast("double"), digits)
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("long")
        out.append(column.alias(name))
    return df.select(*out)


def typed_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.cast_accounts(subscriber_rows(spark, folder))


def snapshot_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Tied scores: a closed form of the order count, rounded to 4 digits."""
    p = F.round(1 / (1 + F.exp(-(1.0 - 0.25 * F.col("n_orders")))), 4)
    return customer_snapshot(spark, folder).select(
        "c_custkey", "region", "c_mktsegment", "has_urgent", F.col("churned").alias("y"), p.alias("p")
    )


def smooth_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Nearly continuous scores from spend and tenure, rounded to 6 digits."""
    x = 0.4 - F.col("total_spend") / 2000000.0 + F.col("tenure_days") / 4000.0
    return customer_snapshot(spark, folder).select(
        "c_custkey", "region", F.col("churned").alias("y"),
        F.round(1 / (1 + F.exp(-x)), 6).alias("p"),
    )


def broken_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Typed accounts, landed as a table, with faults planted by a hash of the key."""
    slot = F.expr("cast(conv(substring(md5(customerID), 1, 4), 16, 10) as int)")
    accounts = typed_accounts(spark, folder).withColumn("_s", slot)
    faulty = accounts.select(
        *[
            {
                "gender": F.when(F.col("_s") % 7 == 0, "Unknown").otherwise(F.col("gender")),
                "tenure": F.when(F.col("_s") % 11 == 0, F.lit(99)).otherwise(F.col("tenure")).cast(
                    "smallint"
                ),
                "MultipleLines": F.when(F.col("_s") % 5 == 0, "Yes").otherwise(
                    F.col("MultipleLines")
                ),
                "TechSupport": F.when(F.col("_s") % 6 == 0, "No internet service").otherwise(
                    F.col("TechSupport")
                ),
                "Partner": F.when(F.col("_s") % 13 == 0, F.lit(None)).otherwise(F.col("Partner")),
                "customerID": F.when(F.col("_s") % 17 == 0, "bad").otherwise(F.col("customerID")),
                "SeniorCitizen": F.when(F.col("_s") % 23 == 0, F.lit(2)).otherwise(F.col("SeniorCitizen")).cast(
                    "tinyint"
                ),
                "StreamingTV": F.when(F.col("_s") % 29 == 0, "Maybe").otherwise(F.col("StreamingTV")),
                "TotalCharges": F.when(F.col("_s") % 31 == 0, -F.col("TotalCharges") - 1)
                .otherwise(F.col("TotalCharges"))
                .cast("float"),
                "MonthlyCharges": F.when(F.col("_s") % 19 == 0, -F.col("MonthlyCharges") - 1)
                .otherwise(F.col("MonthlyCharges"))
                .cast("float"),
            }.get(c, F.col(c)).alias(c)
            for c in fixed.RAW_COLUMNS
        ]
    )
    return spark.read.parquet(tables.write_table(faulty, fresh_path(spark, "faulty")))


# --- sources and sinks ------------------------------------------------------
@register
def raw_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "raw")
    subscriber_rows(spark, folder).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return tables.read_raw_csv(spark, path)


@register
def interim_table(spark: SparkSession, folder: str) -> DataFrame:
    path = tables.write_table(typed_accounts(spark, folder), fresh_path(spark, "interim"))
    return tidy(spark.read.parquet(path))


@register
def stored_validation_split(spark: SparkSession, folder: str) -> DataFrame:
    prepared = training.encode_accounts(typed_accounts(spark, folder))
    path = tables.write_splits(prepared.matrix, fresh_path(spark, "matrix"))
    return tidy(tables.read_split(spark, path, "val"), 4)


@register
def content_checksums(spark: SparkSession, folder: str) -> DataFrame:
    return checksums.content_checksums(read_table(spark, folder, "documents"), "doc_id", "text")


@register
def checksum_verification(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    records = checksums.content_checksums(documents, "doc_id", "text")
    case = F.col("doc_id") % 3
    expected = documents.select(
        F.col("doc_id").alias("name"),
        F.when(case == 0, F.concat(F.lit(" "), F.upper(F.md5("text"))))
        .when(case == 1, F.lit(""))
        .otherwise(F.md5("source"))
        .alias("expected"),
    )
    return checksums.verify_checksums(records, expected)


@register
def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    return checksums.file_checksums(spark, folder, "*.parquet")


def score_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest lines of two scores, with metrics computed on the snapshot."""
    both = (
        snapshot_scores(spark, folder).select(F.lit("by_orders").alias("name"), "y", "p")
        .unionByName(
            smooth_scores(spark, folder).select(F.lit("by_spend").alias("name"), "y", "p")
        )
    )
    measured = tidy(evaluate.binary_metrics(both, THRESHOLD, ["name"]))
    metrics = F.create_map(
        *[x for m in ("pr_auc", "roc_auc", "brier") for x in (F.lit(m), F.col(m))]
    )
    lines = measured.select(
        F.to_json(
            F.struct(
                "name",
                F.lit("ClosedForm").alias("algorithm"),
                F.create_map(F.lit("val"), metrics).alias("metrics"),
            )
        ).alias("value")
    )
    return lines.unionByName(lines.select(F.lit("{broken").alias("value")))


@register
def model_listing(spark: SparkSession, folder: str) -> DataFrame:
    entries = registry.manifests(score_manifests(spark, folder))
    return entries.select(
        "name", "algorithm", F.col("metrics")["val"]["pr_auc"].alias("pr_auc")
    ).orderBy("name")


@register
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    entries = registry.manifests(score_manifests(spark, folder))
    return registry.best_model(entries, "pr_auc").select("name", "value")


# --- projections ------------------------------------------------------------
@register
def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(customer_snapshot(spark, folder))


@register
def cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(typed_accounts(spark, folder))


@register
def derived_features(spark: SparkSession, folder: str) -> DataFrame:
    derived = prepare.derive_features(typed_accounts(spark, folder))
    return tidy(
        derived.select(
            fixed.KEY, *fixed.DERIVED_ORDINAL, "services_count", *fixed.DERIVED_FLAGS,
            "avg_monthly_spend", "monthly_spend_gap",
        ),
        4,
    )


@register
def target_bits(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        typed_accounts(spark, folder).select(
            fixed.KEY, C.yes_no_to_bit(F.col(fixed.TARGET)).alias("churned")
        )
    )


@register
def scoring_input(spark: SparkSession, folder: str) -> DataFrame:
    """Rows without key and senior flag, as a scoring request may leave them out."""
    accounts = typed_accounts(spark, folder).drop(fixed.KEY, "SeniorCitizen", fixed.TARGET)
    return tidy(prepare.scoring_rows(accounts)).groupBy("SeniorCitizen", "Contract").agg(
        F.count("*").alias("n"), F.count("TotalCharges").alias("n_total"),
        F.count("customerID").alias("n_keys"),
    )


# --- validation -------------------------------------------------------------
@register
def contract_violations(spark: SparkSession, folder: str) -> DataFrame:
    return contract.violations(broken_accounts(spark, folder), contract.training_contract())


@register
def contract_holds(spark: SparkSession, folder: str) -> DataFrame:
    path = tables.write_table(typed_accounts(spark, folder), fresh_path(spark, "interim"))
    accounts = spark.read.parquet(path)
    return tidy(contract.assert_valid(accounts, contract.training_contract()).select(fixed.KEY))


@register
def scoring_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rows = prepare.scoring_rows(broken_accounts(spark, folder).drop(fixed.TARGET))
    _, bad = contract.separate(rows, contract.scoring_contract())
    return bad.select(F.explode("violations").alias("v"), "tenure").groupBy(
        F.col("v.rule").alias("rule"), F.col("v.column").alias("column")
    ).agg(F.count("*").alias("n"), F.sum("tenure").cast("long").alias("months"))


@register
def scoring_valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = prepare.scoring_rows(broken_accounts(spark, folder).drop(fixed.TARGET))
    good, _ = contract.separate(rows, contract.scoring_contract())
    return good.groupBy("gender", "Contract").agg(
        F.count("*").alias("n"), F.sum("tenure").cast("long").alias("months")
    )


@register
def repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return contract.key_violations(lines, ["l_orderkey", "l_linenumber"]).select(
        "rule", "column", "key", "n_rows"
    )


# --- profiling --------------------------------------------------------------
@register
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return profile.dataset_summary(typed_accounts(spark, folder)).drop("n_bytes", "digest")


@register
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.quality_report(typed_accounts(spark, folder)))


@register
def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_linenumber"
    )
    return tidy(profile.quality_report(lines, "l_returnflag", "R"))


@register
def column_quality(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_quality(typed_accounts(spark, folder))


@register
def missing_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_counts(typed_accounts(spark, folder))


@register
def numeric_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        profile.numeric_summary(
            customer_snapshot(spark, folder),
            ["tenure_days", "n_orders", "total_spend", "avg_spend", "c_acctbal"],
        ),
        4,
    )


@register
def numeric_summary_text(spark: SparkSession, folder: str) -> DataFrame:
    """Text columns with blanks: values that are no numbers count as missing."""
    return tidy(profile.numeric_summary(subscriber_rows(spark, folder), fixed.NUMERIC), 4)


@register
def numeric_summary_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        profile.numeric_summary(
            read_table(spark, folder, "lineitem"),
            ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ),
        4,
    )


@register
def categorical_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        profile.categorical_summary(
            customer_snapshot(spark, folder), ["c_mktsegment", "nation", "region", "has_urgent"]
        )
    )


@register
def categorical_summary_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        profile.categorical_summary(
            read_table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_suppkey"]
        )
    )


@register
def target_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.target_distribution(typed_accounts(spark, folder)))


@register
def rate_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        profile.rate_by_category(customer_snapshot(spark, folder), "nation", "churned", 50)
    )


@register
def rate_by_category_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Null groups are kept: source names below a size are blanked first."""
    labelled = read_table(spark, folder, "documents").join(
        read_table(spark, folder, "labels"), "doc_id"
    ).withColumn("place", F.when(F.col("n_chars") >= 500, F.col("source")))
    return tidy(profile.rate_by_category(labelled, "place", "quality"))


@register
def rate_chart(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.rate_chart(typed_accounts(spark, folder), "PaymentMethod"))


@register
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.histogram(customer_snapshot(spark, folder), "tenure_days", "churned"), 8)


@register
def box_plot(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.box_plot(customer_snapshot(spark, folder), "total_spend", "churned"), 4)


@register
def correlation_pearson(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        association.correlation(
            customer_snapshot(spark, folder),
            ["tenure_days", "n_orders", "total_spend", "c_acctbal"], "pearson",
        )
    )


@register
def correlation_spearman(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        association.correlation(
            customer_snapshot(spark, folder), ["tenure_days", "n_orders", "total_spend"], "spearman"
        )
    )


@register
def correlation_spearman_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Pairwise complete rows: totals are missing for customers without orders."""
    return tidy(association.correlation(typed_accounts(spark, folder), fixed.NUMERIC, "spearman"))


@register
def correlation_kendall(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        association.correlation(
            customer_snapshot(spark, folder), ["tenure_days", "n_orders", "churned"], "kendall"
        )
    )


@register
def correlation_heatmap(spark: SparkSession, folder: str) -> DataFrame:
    matrix = association.correlation(
        prepare.derive_features(typed_accounts(spark, folder)),
        [*fixed.NUMERIC, *fixed.DERIVED_NUMERIC], "pearson",
    )
    return tidy(association.lower_triangle(matrix))


@register
def target_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(explore.target_correlation(typed_accounts(spark, folder)))


@register
def contingency(spark: SparkSession, folder: str) -> DataFrame:
    return association.contingency(typed_accounts(spark, folder), ["Contract", "PaymentMethod"])


@register
def crosstab(spark: SparkSession, folder: str) -> DataFrame:
    return association.crosstab(typed_accounts(spark, folder), "Contract", "Churn", ["No", "Yes"])


@register
def chi_square(spark: SparkSession, folder: str) -> DataFrame:
    cells = association.contingency(
        customer_snapshot(spark, folder), ["c_mktsegment", "nation", "region"], "churned"
    )
    return tidy(association.chi_square(cells))


@register
def cramers_v(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        association.cramers_v(
            typed_accounts(spark, folder), [*fixed.BINARY, *fixed.ORDINAL, *fixed.NOMINAL]
        )
    )


@register
def exploration_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of the thirteen tables of the exploratory run."""
    accounts = prepare.derive_features(typed_accounts(spark, folder))
    parts = [
        table.agg(F.lit(name).alias("report"), F.count("*").alias("n_rows"))
        for name, table in explore.explore(accounts).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- split and encoding -----------------------------------------------------
@register
def split_assignment(spark: SparkSession, folder: str) -> DataFrame:
    accounts = typed_accounts(spark, folder)
    return split.stratified_split(accounts, fixed.KEY, fixed.TARGET).select(
        fixed.KEY, fixed.TARGET, "split"
    )


@register
def split_rates(spark: SparkSession, folder: str) -> DataFrame:
    accounts = typed_accounts(spark, folder)
    return tidy(
        profile.split_rates(
            split.stratified_split(accounts, fixed.KEY, fixed.TARGET), fixed.TARGET
        )
    )


@register
def fold_assignment(spark: SparkSession, folder: str) -> DataFrame:
    rows = customer_snapshot(spark, folder)
    cuts = split.fold_cuts(rows, "c_custkey", "churned", 5)
    return rows.select("c_custkey", "churned", cuts.part_of(rows).alias("fold")).select(
        "c_custkey", F.col("churned").cast("long").alias("churned"), "fold"
    )


@register
def encoder_parameters(spark: SparkSession, folder: str) -> DataFrame:
    encoder = training.encode_accounts(typed_accounts(spark, folder)).encoder
    return tidy(
        spark.createDataFrame(
            [
                (c, encoder.medians[c], encoder.means[c], encoder.deviations[c])
                for c in encoder.spec.numeric
            ],
            "variable string, median double, mean double, deviation double",
        ),
        4,
    )


@register
def encoded_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(training.encode_accounts(typed_accounts(spark, folder)).matrix, 4)


@register
def encoded_matrix_basic(spark: SparkSession, folder: str) -> DataFrame:
    """Without the derived columns: 28 features."""
    prepared = training.encode_accounts(typed_accounts(spark, folder), include_derived=False)
    sums = [F.sum(F.col(f"`{f}`").cast("double")).alias(f) for f in prepared.features]
    return tidy(prepared.matrix.groupBy("split").agg(*sums), 2)


# --- feature ranking --------------------------------------------------------
def snapshot_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """Small non-negative matrix of the snapshot for the ranking scores."""
    return customer_snapshot(spark, folder).select(
        "c_custkey",
        "churned",
        F.col("n_orders").cast("double").alias("n_orders"),
        F.col("total_spend"),
        F.col("tenure_days").cast("double").alias("tenure_days"),
        F.col("n_urgent").cast("double").alias("n_urgent"),
        F.col("has_urgent").cast("int").cast("double").alias("has_urgent"),
        (F.col("avg_spend") - 250000.0).alias("centred_spend"),
    )


SNAPSHOT_FEATURES = [
    "n_orders", "total_spend", "tenure_days", "n_urgent", "has_urgent", "centred_spend",
]


@register
def mutual_information(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        ranking.mutual_information(
            snapshot_matrix(spark, folder), SNAPSHOT_FEATURES, "churned", ["n_urgent", "has_urgent"]
        )
    )


@register
def chi2_scores(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        ranking.chi2_scores(snapshot_matrix(spark, folder), SNAPSHOT_FEATURES, "churned"), 4
    )


def _rank_scores(spark: SparkSession, folder: str) -> DataFrame:
    matrix = snapshot_matrix(spark, folder)
    return tidy(
        ranking.mutual_information(
            matrix, SNAPSHOT_FEATURES, "churned", ["n_urgent", "has_urgent"]
        ).unionByName(ranking.chi2_scores(matrix, SNAPSHOT_FEATURES, "churned")),
        4,
    )


@register
def score_ranks(spark: SparkSession, folder: str) -> DataFrame:
    ranked, _, _ = ranking.consensus(_rank_scores(spark, folder), 3, SNAPSHOT_FEATURES)
    return tidy(ranked.select("method", "feature", "rank", "vote", "norm_score"), 4)


@register
def consensus_features(spark: SparkSession, folder: str) -> DataFrame:
    _, _, top = ranking.consensus(_rank_scores(spark, folder), 3, SNAPSHOT_FEATURES)
    return tidy(top, 4)


@register
def l1_importance(spark: SparkSession, folder: str) -> DataFrame:
    prepared = training.encode_accounts(typed_accounts(spark, folder))
    train = prepared.matrix.filter(F.col("split") == "train")
    return tidy(ranking.l1_importance(train, prepared.features, fixed.TARGET), 4)


@register
def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        ranking.permutation_importance(
            snapshot_matrix(spark, folder), SNAPSHOT_FEATURES, "churned", "c_custkey",
            trees=10, repeats=2, max_depth=5,
        ),
        4,
    )


@register
def feature_selection(spark: SparkSession, folder: str) -> DataFrame:
    _, table, _ = ranking.select_features(
        snapshot_matrix(spark, folder), SNAPSHOT_FEATURES, "churned", "c_custkey", 3,
        ["n_urgent", "has_urgent"], trees=10, repeats=2, max_depth=5,
    )
    return tidy(table, 4)


# --- models -----------------------------------------------------------------
@register
def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(models.class_weights(customer_snapshot(spark, folder), "churned"))


@register
def constant_models(spark: SparkSession, folder: str) -> DataFrame:
    rows = customer_snapshot(spark, folder)
    parts = [
        models.constant_score(rows, name, "c_custkey", "churned").withColumn("model", F.lit(name))
        for name in models.CONSTANT_MODELS
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return tidy(out.select("model", "c_custkey", "y", "p"))


@register
def cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        models.cross_validate(
            customer_snapshot(spark, folder), [], "churned", "c_custkey",
            list(models.CONSTANT_MODELS), 5,
        )
    )


def _fitted_scores(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    matrix = cut_lineage(snapshot_matrix(spark, folder))
    spec = encode.EncoderSpec(tuple(SNAPSHOT_FEATURES))
    scaled = cut_lineage(encode.fit_encoder(matrix, spec).encode(matrix, ["c_custkey", "churned"]))
    model = models.fit(name, scaled, SNAPSHOT_FEATURES, "churned", key="c_custkey", **options)
    return tidy(models.score(model, scaled, ["c_custkey"]))


@register
def logistic_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted_scores(spark, folder, "logreg_balanced")


@register
def sparse_logistic_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted_scores(spark, folder, "logreg_l1")


@register
def forest_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted_scores(spark, folder, "random_forest", trees=20, max_depth=5)


@register
def boosting_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted_scores(spark, folder, "hist_gb", rounds=5, max_depth=3)


@register
def sampled_boosting_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _fitted_scores(spark, folder, "lightgbm", rounds=5, max_depth=3)


@register
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    prepared = training.encode_accounts(typed_accounts(spark, folder))
    result = training.train_models(
        prepared.matrix, prepared.features, names=["dummy_prior", "logreg_l1"], folds=3
    )
    return tidy(result.summary, 4)


# --- evaluation -------------------------------------------------------------
@register
def metric_bundle(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.binary_metrics(snapshot_scores(spark, folder), THRESHOLD))


@register
def metric_bundle_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.binary_metrics(smooth_scores(spark, folder), THRESHOLD, ["region"]))


@register
def metric_bundle_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Quality labels scored by document length."""
    p = F.least(F.col("n_chars") / 8192.0, F.lit(1.0))
    scores = read_table(spark, folder, "documents").join(
        read_table(spark, folder, "labels"), "doc_id"
    ).select("doc_id", "lang", F.col("quality").alias("y"), p.alias("p"))
    return tidy(evaluate.binary_metrics(scores, 0.5, ["lang"]))


def line_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line with a closed-form return score; the largest score frame."""
    x = F.col("l_discount") * 8 - F.col("l_quantity") / 40.0 - 0.5
    return read_table(spark, folder, "lineitem").select(
        "l_linestatus",
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.round(1 / (1 + F.exp(-x)), 6).alias("p"),
    )


@register
def metric_bundle_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.binary_metrics(line_scores(spark, folder), 0.35, ["l_linestatus"]))


@register
def group_metrics_lines(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(fairness.group_metrics(line_scores(spark, folder), ["l_linestatus"], 0.35))


@register
def threshold_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.threshold_sweep(snapshot_scores(spark, folder)))


@register
def threshold_sweep_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.threshold_sweep(smooth_scores(spark, folder), keys=["region"]))


@register
def best_threshold(spark: SparkSession, folder: str) -> DataFrame:
    sweep = evaluate.threshold_sweep(smooth_scores(spark, folder), keys=["region"])
    return tidy(evaluate.optimal_threshold(sweep, "f1", ["region"]))


@register
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.confusion(snapshot_scores(spark, folder), THRESHOLD))


@register
def calibration_curve(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.calibration(smooth_scores(spark, folder)))


@register
def pr_points(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.pr_points(snapshot_scores(spark, folder)))


@register
def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evaluate.roc_points(snapshot_scores(spark, folder), ["region"]))


@register
def top_importance(spark: SparkSession, folder: str) -> DataFrame:
    scores = ranking.chi2_scores(snapshot_matrix(spark, folder), SNAPSHOT_FEATURES, "churned")
    return tidy(
        evaluate.top_importance(
            scores.select("feature", F.col("score").alias("importance")), 3
        ),
        4,
    )


@register
def evaluation_report(spark: SparkSession, folder: str) -> DataFrame:
    """A stored model evaluated on stored splits, at its tuned threshold."""
    work = fresh_path(spark, "evaluation")
    prepared = training.preprocess(subscriber_rows(spark, folder), f"{work}/data")
    training.train_models(
        prepared.matrix, prepared.features, names=["dummy_prior"], folds=2,
        registry_folder=f"{work}/models", encoder=prepared.encoder,
    )
    report = training.evaluation_report(
        spark, "dummy_prior", f"{work}/models", f"{work}/data/matrix", with_test=True
    )
    return tidy(report["metrics_tuned"])


# --- fairness ---------------------------------------------------------------
@register
def calibration_error(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(fairness.calibration_error(snapshot_scores(spark, folder), ["region"]))


@register
def group_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(
        fairness.group_metrics(
            snapshot_scores(spark, folder), ["region", "c_mktsegment", "has_urgent"], THRESHOLD
        )
    )


@register
def fairness_summary(spark: SparkSession, folder: str) -> DataFrame:
    groups = fairness.group_metrics(
        snapshot_scores(spark, folder), ["region", "c_mktsegment", "has_urgent"], THRESHOLD
    )
    return tidy(fairness.fairness_summary(groups))


@register
def fairness_chart(spark: SparkSession, folder: str) -> DataFrame:
    groups = fairness.group_metrics(
        snapshot_scores(spark, folder), ["region", "c_mktsegment"], THRESHOLD
    )
    return tidy(fairness.group_chart(groups))


@register
def sensitive_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Scores joined by key to the sensitive columns of the accounts."""
    accounts = typed_accounts(spark, folder)
    scores = linear_scores(spark, folder).join(
        accounts.select(fixed.KEY, C.yes_no_to_bit(F.col(fixed.TARGET)).cast("int").alias("y")),
        fixed.KEY,
    )
    joined = fairness.attach_sensitive(
        scores, accounts, label=C.yes_no_to_bit(F.col(fixed.TARGET))
    )
    return tidy(joined.select(fixed.KEY, "y", F.round("p", 3).alias("p"), *fixed.SENSITIVE))


@register
def fairness_audit(spark: SparkSession, folder: str) -> DataFrame:
    work = fresh_path(spark, "audit")
    prepared = training.preprocess(subscriber_rows(spark, folder), f"{work}/data")
    training.train_models(
        prepared.matrix, prepared.features, names=["dummy_stratified"], folds=2,
        registry_folder=f"{work}/models", encoder=prepared.encoder,
    )
    groups, _, _ = training.fairness_audit(
        spark, typed_accounts(spark, folder), "dummy_stratified", f"{work}/models",
        f"{work}/data/matrix",
    )
    return tidy(groups)


# --- scoring ----------------------------------------------------------------
def linear_pipeline(spark: SparkSession, folder: str) -> PipelineModel:
    """Encoder fitted on the training split, then the fixed linear score."""
    encoder = training.encode_accounts(typed_accounts(spark, folder)).encoder
    formula = f"SELECT {fixed.KEY}, 1 / (1 + exp(-({LINEAR_SCORE}))) AS p FROM __THIS__"
    return PipelineModel([encoder.stage([fixed.KEY]), SQLTransformer(statement=formula)])


def linear_scores(spark: SparkSession, folder: str) -> DataFrame:
    accounts = typed_accounts(spark, folder)
    return scoring.score_accounts(accounts, linear_pipeline(spark, folder))


@register
def account_scores(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(linear_scores(spark, folder), 3)


@register
def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(scoring.predictions(snapshot_scores(spark, folder), THRESHOLD, "c_custkey"))


@register
def band_counts_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions on every order line, summed by band."""
    predicted = scoring.predictions(line_scores(spark, folder), 0.35, "line")
    return tidy(
        predicted.groupBy("risk_band", "label").agg(
            F.count("*").alias("n"), F.sum("probability").alias("probability")
        ),
        3,
    )


@register
def batch_summary(spark: SparkSession, folder: str) -> DataFrame:
    predicted = scoring.predictions(smooth_scores(spark, folder), THRESHOLD, "c_custkey")
    return tidy(scoring.batch_summary(predicted))


@register
def streamed_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts landed as files, scored by a stream with quarantine, read back."""
    return tidy(
        spark.read.parquet(f"{_stream(spark, folder)}/predictions").select(
            "customerID", F.round("probability", 3).alias("probability"), "prediction", "label", "risk_band"
        )
    )


@register
def streamed_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """What the same stream keeps out, by rule and column."""
    bad = spark.read.parquet(f"{_stream(spark, folder)}/quarantine")
    return bad.groupBy("rule", "column").agg(F.count("*").alias("n"))


def _stream(spark: SparkSession, folder: str) -> str:
    work = fresh_path(spark, "stream")
    landed = broken_accounts(spark, folder).drop(fixed.TARGET)
    landed.write.parquet(f"{work}/landed")
    arrivals = streaming.read_arrivals(spark, f"{work}/landed", landed.schema)
    query = streaming.run_scoring(
        arrivals, linear_pipeline(spark, folder), 0.4, f"{work}/out", f"{work}/progress"
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return f"{work}/out"


@register
def model_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions beside the facts of the model that made them."""
    best = registry.best_model(registry.manifests(score_manifests(spark, folder)), "pr_auc")
    scored = scoring.predictions(snapshot_scores(spark, folder), THRESHOLD, "c_custkey")
    facts = registry.facts(best, THRESHOLD)
    return tidy(scoring.with_facts(scored, facts).groupBy("model", "threshold", "risk_band").agg(
        F.count("*").alias("n")
    ))
