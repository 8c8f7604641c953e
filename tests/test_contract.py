import pytest
from pyspark.sql import functions as F

from stayscope.operators import contract as ct
from stayscope.operators.prepare import scoring_rows

RULES = ct.training_contract()


def test_good_rows_pass(typed):
    assert ct.violations(typed, RULES).count() == 0
    assert ct.assert_valid(typed, RULES) is typed


@pytest.mark.parametrize(
    ("column", "value", "rule"),
    [
        ("gender", "'Unknown'", "domain"),
        ("tenure", "CAST(99 AS SMALLINT)", "range"),
        ("MonthlyCharges", "CAST(-1 AS FLOAT)", "minimum"),
        ("customerID", "'x'", "pattern"),
        ("Partner", "CAST(NULL AS STRING)", "not_null"),
        ("SeniorCitizen", "CAST(2 AS TINYINT)", "domain"),
    ],
)
def test_each_fault_is_found(typed, column, value, rule):
    bad = typed.withColumn(
        column, F.when(F.col("customerID") == "0002-AAAAA", F.expr(value)).otherwise(F.col(column))
    )
    found = ct.row_violations(bad, RULES).collect()
    assert [(r["rule"], r["column"]) for r in found] == [(rule, column)]


def test_cross_column_rules(typed):
    bad = typed.withColumn("MultipleLines", F.lit("Yes")).withColumn("TechSupport", F.lit("Yes"))
    found = {r["rule"] for r in ct.row_violations(bad, RULES).collect()}
    assert found == {"phone_lines", "internet_addons"}


def test_null_total_is_allowed(typed):
    assert typed.filter(F.col("TotalCharges").isNull()).count() == 1


def test_repeated_key_is_one_violation(typed):
    doubled = typed.unionByName(typed.limit(1))
    found = ct.violations(doubled, RULES).collect()
    assert [(r["rule"], r["n_rows"]) for r in found] == [("unique", 2)]


def test_all_problems_are_gathered(typed):
    bad = typed.withColumn("gender", F.lit("x")).withColumn("Contract", F.lit("y"))
    with pytest.raises(ct.ContractError) as caught:
        ct.assert_valid(bad, RULES)
    assert len(caught.value.problems) == 2


def test_schema_problems(typed):
    assert ct.schema_problems(typed, RULES) == []
    odd = typed.drop("gender").withColumn("extra", F.lit(1)).withColumn(
        "tenure", F.col("tenure").cast("int")
    )
    assert sorted(ct.schema_problems(odd, RULES)) == [
        "column tenure is int, expected smallint", "missing column gender",
        "unexpected column extra",
    ]


def test_scoring_contract_checks_both_directions(typed):
    rows = scoring_rows(typed.drop("Churn"))
    bad = rows.withColumn(
        "MultipleLines",
        F.when(F.col("customerID") == "0001-AAAAA", "No phone service").otherwise(
            F.col("MultipleLines")
        ),
    )
    good, quarantined = ct.separate(bad, ct.scoring_contract())
    assert good.count() == 5
    row = quarantined.select("customerID", F.explode("violations.rule").alias("rule")).collect()
    assert [tuple(r) for r in row] == [("0001-AAAAA", "phone_lines_reverse")]
    # The training contract only looks one way.
    assert ct.row_violations(
        bad.withColumn("Churn", F.lit("No")), RULES
    ).count() == 0


def test_empty_batch_and_threshold(typed):
    with pytest.raises(ct.ContractError):
        ct.require_rows(typed.limit(0))
    for wrong in (0.0, 1.0, -1, 2):
        with pytest.raises(ValueError):
            ct.check_threshold(wrong)
