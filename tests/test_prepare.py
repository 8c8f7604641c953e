import pytest
from pyspark.sql import functions as F

from stayscope.functions import columns as C
from stayscope.functions import fixed
from stayscope.operators import prepare
from stayscope.operators.contract import ContractError, scoring_contract, separate


def test_types_and_blank_total(typed):
    types = dict(typed.dtypes)
    assert types["SeniorCitizen"] == "tinyint" and types["tenure"] == "smallint"
    assert types["MonthlyCharges"] == types["TotalCharges"] == "float"
    assert typed.filter(F.col("TotalCharges").isNull()).collect()[0]["tenure"] == 0


def test_garbage_number_raises(raw):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        prepare.cast_accounts(raw.withColumn("tenure", F.lit("many"))).collect()


def test_derived_columns(typed):
    months = {"0001-AAAAA": 24, "0002-AAAAA": 30, "0003-AAAAA": 49, "0004-AAAAA": 13, "0005-AAAAA": 12, "0006-AAAAA": 0}
    tenure = F.create_map(*[F.lit(v) for pair in months.items() for v in pair])[F.col("customerID")]
    placed = typed.withColumn("tenure", tenure.cast("smallint"))
    rows = {r["customerID"]: r for r in prepare.derive_features(placed).collect()}
    labels = {k: rows[k]["tenure_bucket"] for k in months}
    assert labels == {
        "0001-AAAAA": "13-24m", "0002-AAAAA": "25-48m", "0003-AAAAA": "49-72m",
        "0004-AAAAA": "13-24m", "0005-AAAAA": "0-12m", "0006-AAAAA": "0-12m",
    }
    second, fourth, last = rows["0002-AAAAA"], rows["0004-AAAAA"], rows["0006-AAAAA"]
    assert second["services_count"] == 3 and second["auto_payment"]
    assert not fourth["has_internet"] and fourth["has_phone"]
    assert second["avg_monthly_spend"] == pytest.approx(20.5)
    assert last["avg_monthly_spend"] == 0.0 and last["monthly_spend_gap"] == pytest.approx(20.5)


@pytest.mark.parametrize(
    ("months", "label"),
    [(-2, None), (-1, "0-12m"), (0, "0-12m"), (12, "0-12m"), (13, "13-24m"), (24, "13-24m"),
     (25, "25-48m"), (48, "25-48m"), (49, "49-72m"), (72, "49-72m"), (73, None)],
)
def test_bucket_edges(spark, months, label):
    row = spark.range(1).select(C.tenure_bucket(F.lit(months)).alias("b")).first()
    assert row["b"] == label


def test_missing_column_is_named(typed):
    with pytest.raises(KeyError, match="InternetService"):
        prepare.derive_features(typed.drop("InternetService"))


def test_target_bits(spark):
    df = spark.createDataFrame([("Yes",), ("No",)], "t string")
    assert [r[0] for r in df.select(C.yes_no_to_bit(F.col("t"))).collect()] == [1, 0]
    for wrong in ("maybe", None):
        bad = spark.createDataFrame([(wrong,)], "t string")
        with pytest.raises(Exception, match="target outside"):
            bad.select(C.yes_no_to_bit(F.col("t"))).collect()


def test_scoring_rows_fill_optional_columns(typed):
    out = prepare.scoring_rows(typed.drop("customerID", "SeniorCitizen", "Churn"))
    assert set(out.columns) == set(fixed.RAW_COLUMNS) - {"Churn"}
    assert out.filter(F.col("customerID").isNotNull() | (F.col("SeniorCitizen") != 0)).count() == 0
    with pytest.raises(KeyError):
        prepare.scoring_rows(typed.drop("Contract", "Churn"))


def test_feature_subset(typed):
    assert prepare.keep_features(typed, ["tenure"], ["customerID"]).columns == [
        "customerID", "tenure",
    ]
    with pytest.raises(KeyError, match="nope"):
        prepare.keep_features(typed, ["nope"], [])


@pytest.mark.parametrize("threshold", [0.4, 0.72])
def test_risk_bands_beside_their_edges(spark, threshold):
    """High from the threshold up, medium from half of it, low below."""
    near = 1e-9
    expected = {
        1.0: "high", threshold: "high", threshold - near: "medium",
        threshold / 2: "medium", threshold / 2 - near: "low", 0.0: "low",
    }
    df = spark.createDataFrame([(p,) for p in expected], "p double")
    got = {r["p"]: r["band"] for r in df.select("p", C.risk_band(F.col("p"), threshold).alias("band")).collect()}
    assert got == expected


def test_values_that_do_not_fit_are_listed(typed):
    rows = prepare.scoring_rows(
        typed.drop("Churn").withColumn("tenure", F.col("tenure").cast("int") * 20_000)
        .withColumn("TotalCharges", F.lit("much"))
    )
    got = {r["customerID"]: {f["column"] for f in r["type_faults"]} for r in rows.collect()}
    assert got["0005-AAAAA"] == {"tenure", "TotalCharges"} and got["0006-AAAAA"] == {"TotalCharges"}
    good, bad = separate(rows, scoring_contract())
    assert good.count() == 0 and "type_faults" not in bad.columns
    with pytest.raises(ContractError, match="unexpected column Churn"):
        prepare.scoring_rows(typed)
