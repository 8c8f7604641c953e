"""Sources, sinks, registry, streaming and whole runs on small tables."""

import datetime as dt
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from stayscope.functions import fixed
from stayscope.operators import fairness, profile, scoring
from stayscope.operators.contract import ContractError
from stayscope.plans import training
from stayscope.plans.registered import typed_accounts
from stayscope.plans.snapshot import customer_snapshot, subscriber_rows
from stayscope.session import build_session, cut_lineage, shared_folder
from stayscope.sources import checksums, registry, tables
from stayscope.streaming import scoring as streaming
from tests.conftest import SF


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Preprocessed, trained and registered on the small tables."""
    folder = str(tmp_path_factory.mktemp("run"))
    prepared = training.preprocess(subscriber_rows(spark, SF), f"{folder}/data")
    comparison = training.train_models(
        prepared.matrix, prepared.features, names=["dummy_stratified", "logreg_l1"], folds=2,
        registry_folder=f"{folder}/models", encoder=prepared.encoder,
    )
    return folder, prepared, comparison


def test_raw_csv(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    raw.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    back = tables.read_raw_csv(spark, path)
    assert {t for _, t in back.dtypes} == {"string"} and len(back.columns) == 21
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.collect()))
    with pytest.raises(FileNotFoundError):
        tables.read_raw_csv(spark, str(tmp_path / "absent"))


def test_matrix_and_manifest(spark, run):
    folder, prepared, _ = run
    record = tables.read_json_record(spark, f"{folder}/data/manifest")
    assert record["n_features_out"] == 35 and record["random_seed"] == 42
    assert record["include_derived"] and record["input_columns"] == fixed.RAW_COLUMNS
    assert dt.datetime.fromisoformat(record["created_at"]).tzinfo is not None
    sizes = {k: v["n_rows"] for k, v in record["splits"].items()}
    assert sum(sizes.values()) == customer_count(spark)
    val = tables.read_split(spark, f"{folder}/data/matrix", "val")
    assert val.count() == sizes["val"]
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(KeyError):
        tables.read_matrix(spark, f"{folder}/data/matrix", "absent")
    with pytest.raises(ValueError):
        tables.read_split(spark, f"{folder}/data/matrix", "other")


def customer_count(spark):
    return spark.read.parquet(f"{SF}/customer.parquet").count()


def test_registry(spark, run, tmp_path):
    folder = f"{run[0]}/models"
    names = [r["name"] for r in registry.list_models(spark, folder).collect()]
    assert names == ["dummy_stratified", "logreg_l1"]
    model, manifest = registry.load_model(spark, "logreg_l1", folder)
    assert len(manifest["hash_model"]) == 64 and manifest["algorithm"] == "LogisticRegressionModel"
    assert 0.05 <= training.tuned_threshold(manifest) <= 0.95
    train = run[1].matrix.filter("split = 'train'").select(fixed.KEY, fixed.TARGET, *[f"`{f}`" for f in run[1].features])
    assert manifest["data"]["train"] == profile.table_digest(train.repartition(3)).first().asDict()
    assert (manifest["key"], manifest["target"], manifest["n_encoder_stages"]) == (fixed.KEY, fixed.TARGET, 1)
    with pytest.raises(FileNotFoundError):
        registry.load_model(spark, "absent", folder)
    for bad in ("", "a/b", ".hidden"):
        with pytest.raises(ValueError):
            registry.save_model(model, bad, folder)
    assert registry.list_models(spark, str(tmp_path / "none")).count() == 0


def test_best_model_and_broken_manifests(spark):
    lines = [
        '{"name":"%s","metrics":{"val":{"pr_auc":%s}}}' % (n, v)
        for n, v in (("a", 0.42), ("c", 0.10), ("b", 0.51), ("d", 0.51))
    ] + ["{broken", '{"name":"e"}']
    entries = registry.manifests(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert entries.count() == 5
    assert registry.best_model(entries, "pr_auc").first()["name"] == "b"
    assert registry.best_model(entries, "pr_auc", False).first()["name"] == "c"
    assert registry.best_model(entries, "roc_auc").count() == 0
    assert registry.best_model(entries, "pr_auc", split="train").count() == 0


def test_audit_record(spark, tmp_path):
    scores = spark.createDataFrame([("x", 0.9, 1), ("x", 0.2, 0), ("y", 0.7, 1)], "g string, p double, y int")
    groups = fairness.group_metrics(scores, ["g"])
    summary = fairness.fairness_summary(groups)
    assert (summary.first().n_smallest, summary.first().n_largest) == (1, 2)
    tables.write_audit(groups, summary, str(tmp_path), "m", 0.5, "val")
    record = tables.read_json_record(spark, f"{tmp_path}/summary")
    assert (record["split"], record["n_rows"], record["group_sizes"]) == ("val", 3, {"g": {"x": 2, "y": 1}})


def test_a_run_reads_the_orders_once_per_stored_table(spark):
    """The matrix is made from a stored table, not from the orders again."""
    matrix = training.encode_accounts(typed_accounts(spark, SF)).matrix
    assert "orders.parquet" not in "".join(matrix.inputFiles())


def test_checksums(spark, tmp_path):
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.txt").write_bytes(b"hello world")
    records = checksums.file_checksums(spark, str(tmp_path / "files"))
    row = records.first()
    assert row["md5"] == "5eb63bbbe01eeed093cb22bb8f5acdc3" and row["bytes"] == 11
    assert row["sha256"] == hashlib.sha256(b"hello world").hexdigest()
    stored = checksums.load_checksums(spark, checksums.save_checksums(records, str(tmp_path / "sums")))
    expected = spark.createDataFrame(
        [("a.txt", f" {row['md5'].upper()} "), ("b.txt", "00"), ("c.txt", "")],
        "name string, expected string",
    )
    ok = {r["name"]: r["ok"] for r in checksums.verify_checksums(stored, expected).collect()}
    assert ok == {"a.txt": True, "b.txt": False, "c.txt": True}


@pytest.fixture
def small_splits(spark, monkeypatch):
    """Files over 1,000 bytes cannot be one row and are cut into splits of 5,000."""
    monkeypatch.setattr(checksums, "WHOLE", 1000, raising=False)
    held = {
        "spark.sql.sources.binaryFile.maxLength": "1000",
        "spark.sql.files.maxPartitionBytes": "5000",
        "spark.sql.files.openCostInBytes": "100",
    }
    for name, value in held.items():
        spark.conf.set(name, value)
    yield
    for name in held:
        spark.conf.unset(name)


def _same_as_hashlib(records, contents):
    found = sorted(map(tuple, records.collect()))
    assert found == sorted(
        (name, hashlib.md5(data).hexdigest(), hashlib.sha256(data).hexdigest(), len(data))
        for name, data in contents.items()
    )


def test_checksums_of_files_longer_than_a_row_may_be(spark, tmp_path, small_splits):
    noise = random.Random(7).randbytes(60_000)
    contents = {
        "short": noise[:999],
        "noise.parquet": noise,
        "feed at the end": noise[:20_001] + b"\n",
        "feeds at both ends": b"\n\n" + noise[:20_000] + b"\r\n\n",
        "only feeds": b"\n" * 12_345,
        "no feed": noise.replace(b"\n", b"\r"),
        "feed where a split ends": b"x" * 4999 + b"\n" + b"y" * 5000 + b"\n" + b"z" * 4999,
        "a[1] {b,c}*?.bin": noise[30_000:],
    }
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    _same_as_hashlib(checksums.file_checksums(spark, str(tmp_path)), contents)


def test_no_task_reads_a_long_file_whole(spark, tmp_path, small_splits, monkeypatch):
    data = random.Random(8).randbytes(50_000)
    (tmp_path / "long").write_bytes(data)
    parts, run_job = [], type(spark.sparkContext).runJob
    monkeypatch.setattr(
        type(spark.sparkContext), "runJob",
        lambda *args: parts.append(got := run_job(*args)) or got,
    )
    _same_as_hashlib(checksums.file_checksums(spark, str(tmp_path)), {"long": data})
    fed = [0] + [part[0]["fed"] for part in parts]
    assert len(parts) == 10 and max(b - a for a, b in zip(fed, fed[1:], strict=False)) < 8000


def test_checksums_of_long_files_that_are_not_lines(spark, tmp_path, monkeypatch):
    """Names that the reader unpacks, byte order marks and very long lines: each such file is one row."""
    monkeypatch.setattr(checksums, "WHOLE", 1000)
    monkeypatch.setattr(checksums, "LONGEST_LINE", 4000)
    noise = random.Random(9).randbytes(30_000)
    contents = {"mark": b"\xef\xbb\xbf" + noise, "mark and feed": b"\xef\xbb\xbf" + noise + b"\n",
                "packed.gz": gzip.compress(noise), "named.gz": noise, "plain": noise,
                "long line": noise + b"x" * 5000 + noise, "only one": b"x" * 5000}
    for name, data in contents.items():
        (tmp_path / name).write_bytes(data)
    _same_as_hashlib(checksums.file_checksums(spark, str(tmp_path)), contents)


def test_stored_pipeline_scores_raw_rows_like_the_matrix(spark, run):
    folder, _, comparison = run
    from stayscope.operators.scoring import score_accounts

    model, _ = registry.load_model(spark, "logreg_l1", f"{folder}/models")
    raw_scored = score_accounts(typed_accounts(spark, SF), model)
    stored = comparison.scores.filter("model = 'logreg_l1'").select(
        fixed.KEY, F.col("p").alias("q")
    )
    gap = raw_scored.join(stored, fixed.KEY).agg(F.max(F.abs(F.col("p") - F.col("q"))), F.count("*")).first()
    assert gap[0] < 1e-6 and gap[1] == comparison.scores.filter("model = 'logreg_l1'").count()


def test_evaluation_report_and_audit(spark, run):
    folder, _, _ = run
    args = (spark, "logreg_l1", f"{folder}/models", f"{folder}/data/matrix")
    report = training.evaluation_report(*args, folder=f"{folder}/report", with_test=True)
    assert report["metrics_tuned"].count() == 2 and report["importance"].count() == 20
    assert training.evaluate_model(*args, split="test", threshold=0.5).first()["threshold"] == 0.5
    groups, summary, within = training.fairness_audit(
        spark, typed_accounts(spark, SF), *args[1:], folder=f"{folder}/audit"
    )
    assert {r["attribute"] for r in summary.collect()} == set(fixed.SENSITIVE)
    record = tables.read_json_record(spark, f"{folder}/audit/summary")
    assert record["all_within_thresholds"] is within and record["limits"]["ece_max"] == 0.05


def test_stream_equals_batch_and_quarantines(spark, run, tmp_path):
    folder, _, _ = run
    model, _ = registry.load_model(spark, "logreg_l1", f"{folder}/models")
    rows = typed_accounts(spark, SF).drop("Churn").withColumn(
        "tenure",
        F.when(F.col("customerID") == "0003-AAAAA", F.lit(99)).otherwise(F.col("tenure")).cast("smallint"),
    )
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second start finds nothing new
        arrivals = streaming.read_arrivals(spark, str(tmp_path / "in"), rows.schema, 1)
        query = streaming.run_scoring(arrivals, model, 0.5, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out/predictions"))
    batch = streaming.score_stream(spark.read.parquet(str(tmp_path / "in")), model, 0.5)
    assert sorted(map(tuple, got.drop("batch", "run").collect())) == sorted(map(tuple, batch.collect()))
    bad = spark.read.parquet(str(tmp_path / "out/quarantine")).collect()
    assert [(r["customerID"], r["rule"], r["value"]) for r in bad] == [("0003-AAAAA", "range", "99")]


def test_a_bad_value_is_quarantined_and_a_new_run_adds(spark, run, tmp_path):
    folder, _, _ = run
    model, _ = registry.load_model(spark, "logreg_l1", f"{folder}/models")
    rows = typed_accounts(spark, SF).drop("Churn").limit(20).withColumn(
        "tenure", F.when(F.col("customerID") == F.lit("none"), 1).otherwise(F.col("tenure")).cast("int")
    )
    first = rows.orderBy("customerID").first()["customerID"]
    rows = rows.withColumn("tenure", F.when(F.col("customerID") == first, 40_000).otherwise(F.col("tenure")))
    rows.write.parquet(str(tmp_path / "in"))
    for k in range(2):
        arrivals = streaming.read_arrivals(spark, str(tmp_path / "in"), rows.schema)
        streaming.run_scoring(
            arrivals, model, 0.5, str(tmp_path / "out"), str(tmp_path / f"cp{k}")
        ).awaitTermination(120)
    bad = spark.read.parquet(str(tmp_path / "out/quarantine"))
    assert {(r["customerID"], r["value"]) for r in bad.filter("rule = 'type'").collect()} == {(first, "40000")}
    assert spark.read.parquet(str(tmp_path / "out/predictions")).count() == 2 * 19
    scored, kept_out = scoring.score_batch(spark.read.parquet(str(tmp_path / "in")), model, 0.5)
    assert (scored.count(), kept_out.count()) == (19, 1)
    with pytest.raises(ContractError, match="empty"):
        scoring.score_batch(rows.limit(0), model, 0.5)
    with pytest.raises(ContractError, match="unexpected column age"):
        scoring.score_batch(rows.withColumn("age", F.lit(1)), model, 0.5)


def test_selection_tables(spark, tmp_path):
    from stayscope.operators import ranking

    scores = spark.createDataFrame(
        [("a", "f1", 2.0), ("a", "f2", 1.0)], "method string, feature string, score double"
    )
    ranked, table, top = ranking.consensus(scores, 1)
    paths = tables.write_selection(ranked, table, top, str(tmp_path), 1, {"seed": 42})
    record = tables.read_json_record(spark, paths["manifest"])
    assert record["top_k_features"] == ["f1"] and record["meta"] == {"seed": 42}
    back = spark.read.option("header", True).csv(paths["ranks"]).collect()
    assert {(r["feature"], r["rank"]) for r in back} == {("f1", "1"), ("f2", "2")}


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    stored = cut_lineage(spark.range(3).toDF("v"))
    assert stored.count() == 3


def test_entry_contract(spark):
    assert __spark_entry__.entry(spark).count() == 5
    queries, oracles = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracles) <= set(queries) and len(oracles) >= 80
    assert customer_snapshot(spark, SF).count() > 100
    assert build_session().version == spark.version
