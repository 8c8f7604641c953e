import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F

from stayscope.functions import fixed
from stayscope.operators.contract import raw_schema
from stayscope.operators.prepare import cast_accounts
from stayscope.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", 4,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def account(key, **changes):
    """One valid raw row, all text."""
    row = {
        "customerID": key, "gender": "Female", "SeniorCitizen": "0", "Partner": "Yes",
        "Dependents": "No", "tenure": "5", "PhoneService": "Yes", "MultipleLines": "No",
        "InternetService": "DSL", **{a: "No" for a in fixed.ADDONS}, "Contract": "Month-to-month",
        "PaperlessBilling": "Yes", "PaymentMethod": "Mailed check", "MonthlyCharges": "20.5",
        "TotalCharges": "102.5", "Churn": "No",
    }
    row.update(changes)
    return tuple(row[c] for c in fixed.RAW_COLUMNS)


@pytest.fixture(scope="session")
def raw(spark):
    """Six rows: no phone, no internet, and a new customer with a blank total."""
    off = {a: "No internet service" for a in fixed.ADDONS}
    rows = [
        account("0001-AAAAA"),
        account("0002-AAAAA", tenure="30", TotalCharges="615", OnlineSecurity="Yes",
                TechSupport="Yes", PaymentMethod="Credit card (automatic)", Contract="One year"),
        account("0003-AAAAA", tenure="2", PhoneService="No", MultipleLines="No phone service",
                Churn="Yes", TotalCharges="41"),
        account("0004-AAAAA", tenure="45", InternetService="No", Contract="Two year",
                TotalCharges="922.5", **off),
        account("0005-AAAAA", tenure="12", InternetService="Fiber optic", StreamingTV="Yes",
                Churn="Yes", TotalCharges="246", gender="Male"),
        account("0006-AAAAA", tenure="0", TotalCharges=" "),
    ]
    return spark.createDataFrame(rows, raw_schema())


@pytest.fixture(scope="session")
def typed(raw):
    return cast_accounts(raw)


@pytest.fixture(scope="session")
def scores(spark):
    """400 rows, 30 % positive, tied and skewed: a third share one score."""
    key = F.col("id")
    h = F.pmod(F.xxhash64(key), F.lit(1000)) / 1000.0
    p = F.when(key % 3 == 0, F.lit(0.4)).otherwise(F.round(h, 2))
    return spark.range(400).select(
        key, (F.pmod(F.xxhash64(key, F.lit(7)), F.lit(10)) < 3).cast("int").alias("y"),
        p.alias("p"), F.when(key % 2 == 0, "A").otherwise("B").alias("group"),
    ).cache()
