import math

import pytest
from pyspark.sql import functions as F

from stayscope.operators import encode, split
from stayscope.operators.prepare import derive_features


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1001).select(
        F.col("id"), (F.col("id") % 4 == 0).cast("int").alias("y"), F.rand(5).alias("x")
    ).cache()


@pytest.mark.parametrize("prefix", [1, 4])
def test_exact_sizes_and_rates(rows, prefix):
    out = split.stratified_split(rows, "id", "y", prefix=prefix)
    counts = {r["split"]: r for r in out.groupBy("split").agg(F.count("*").alias("n"), F.avg("y").alias("rate")).collect()}
    test = math.ceil(1001 * 0.15)
    assert counts["test"]["n"] == test
    assert counts["val"]["n"] == math.ceil((1001 - test) * (0.15 / 0.85))
    assert sum(r["n"] for r in counts.values()) == 1001
    for r in counts.values():
        assert r["rate"] == pytest.approx(251 / 1001, abs=0.01)


def test_split_does_not_depend_on_partitions(rows):
    def parts(df, seed=42):
        out = split.stratified_split(df, "id", "y", seed=seed)
        return {r["id"]: r["split"] for r in out.select("id", "split").collect()}

    assert parts(rows) == parts(rows.repartition(7, "x"))
    assert parts(rows) != parts(rows, seed=1)


@pytest.mark.parametrize("sizes", [(0, 0.1), (0.1, 0), (0.6, 0.4), (1.2, 0.1)])
def test_bad_fractions(rows, sizes):
    with pytest.raises(ValueError):
        split.stratified_split(rows, "id", "y", *sizes)
    with pytest.raises(KeyError):
        split.stratified_split(rows, "id", "absent")


def test_published_sizes():
    """7,043 rows with 1,869 positives: 4,929 / 1,057 / 1,057."""
    counts = {0: 7043 - 1869, 1: 1869}
    kept = split.allocate(counts, 7043 - math.ceil(7043 * 0.15))
    assert sum(kept.values()) == 5986
    assert sum(split.allocate(kept, 5986 - math.ceil(5986 * (0.15 / 0.85))).values()) == 4929


def test_folds(rows):
    out = rows.withColumn("fold", split.fold_cuts(rows, "id", "y", 5).part_of(rows))
    for y in (0, 1):
        sizes = [r["count"] for r in out.filter(F.col("y") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_tiny_class(spark):
    df = spark.createDataFrame([(i, int(i == 3)) for i in range(10)], "id int, y int")
    assert split.stratified_split(df, "id", "y").filter("split IS NULL").count() == 0


def test_output_names_and_widths():
    assert len(encode.account_spec().outputs) == 35
    assert len(encode.account_spec(False).outputs) == 28
    names = encode.account_spec().outputs
    assert names[:7] == ["tenure", "MonthlyCharges", "TotalCharges", "services_count",
                         "avg_monthly_spend", "monthly_spend_gap", "Contract"]
    assert names[-1] == "PaymentMethod_Credit card (automatic)"


def test_encoding_of_levels(typed):
    derived = derive_features(typed)
    encoder = encode.fit_encoder(derived, encode.account_spec())
    rows = {r["customerID"]: r for r in encoder.encode(derived, ["customerID"]).collect()}
    first, last = rows["0001-AAAAA"], rows["0006-AAAAA"]
    assert first["Partner"] == 0.0 and first["Dependents"] == 1.0  # Yes before No
    assert rows["0005-AAAAA"]["gender"] == 1.0 and first["has_internet"] == 1.0
    assert rows["0004-AAAAA"]["Contract"] == 2.0 and rows["0004-AAAAA"]["InternetService_No"] == 1.0
    assert first["MultipleLines_No"] == 1.0 and first["MultipleLines_Yes"] == 0.0
    # The blank total takes the median of 41, 102.5, 246, 615, 922.5.
    assert encoder.medians["TotalCharges"] == 246.0
    assert last["TotalCharges"] == pytest.approx(rows["0005-AAAAA"]["TotalCharges"])
    assert all(v is not None for r in rows.values() for v in r)
    strange = derived.withColumn("Contract", F.lit("?")).withColumn("PaymentMethod", F.lit(None))
    row = encoder.encode(strange).first()
    assert row["Contract"] == -1.0 and row["PaymentMethod_Mailed check"] == 0.0


def test_scaling_is_population_and_constant_safe(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0), (6.0, 7.0)], "a double, k double")
    encoder = encode.fit_encoder(df, encode.EncoderSpec(("a", "k")))
    assert encoder.medians["a"] == 2.5 and encoder.deviations["a"] == pytest.approx(math.sqrt(3.5))
    assert {r["k"] for r in encoder.encode(df).collect()} == {0.0}
    with pytest.raises(ValueError):
        encode.fit_encoder(spark.createDataFrame([(None,)], "a double"), encode.EncoderSpec(("a",)))


def test_parameters_come_from_train_only(spark, rows):
    marked = split.stratified_split(rows, "id", "y")
    changed = marked.withColumn("x", F.when(F.col("split") == "train", F.col("x")).otherwise(F.lit(1e6)))
    spec = encode.EncoderSpec(("x",))
    train = F.col("split") == "train"
    assert encode.fit_encoder(marked.filter(train), spec) == encode.fit_encoder(
        changed.filter(train), spec
    )
