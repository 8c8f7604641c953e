"""Customer tables derived from order data.

``customer_snapshot`` is the retail view: one row per customer with orders
before the cut-off, labelled by whether any order followed.
``subscriber_rows`` maps the same customers to the 21-column subscriber
contract, as text rows the way they would land.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF = "2000-09-01"

#: Declared schemas save the job that would read Parquet footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _order_facts(spark: SparkSession, folder: str, cutoff: str) -> DataFrame:
    """Per customer: order counts and spend before the cut-off, in whole cents.

    The only shuffle of orders; sums combine before it, so a customer with a
    third of all orders is one row per task.
    """
    orders = read_table(spark, folder, "orders")
    end = F.lit(cutoff).cast("timestamp_ntz")
    before = F.col("o_orderdate") < end
    cents = F.round(F.col("o_totalprice") * 100).cast("long")

    def priority(value: str) -> F.Column:
        return F.count_if(before & (F.col("o_orderpriority") == value))

    return orders.groupBy("o_custkey").agg(
        F.count_if(before).alias("n_orders"),
        F.coalesce(F.sum(F.when(before, cents)), F.lit(0)).alias("cents"),
        F.min(F.when(before, F.col("o_orderdate"))).alias("first_order"),
        F.count_if(~before).alias("n_after"),
        priority("1-URGENT").alias("n_urgent"),
        priority("2-HIGH").alias("n_high"),
        priority("3-MEDIUM").alias("n_medium"),
        priority("4-NOT SPECIFIED").alias("n_unspecified"),
        priority("5-LOW").alias("n_low"),
        F.count_if(before & (F.col("o_orderstatus") == "O")).alias("n_open"),
    )


def customer_snapshot(spark: SparkSession, folder: str, cutoff: str = CUTOFF) -> DataFrame:
    """One typed row per customer with at least one order before the cut-off."""
    facts = _order_facts(spark, folder, cutoff).filter(F.col("n_orders") > 0)
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    days = F.datediff(F.to_date(F.lit(cutoff)), F.to_date("first_order"))
    return (
        customer.join(facts, F.col("c_custkey") == F.col("o_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "c_custkey",
            "c_mktsegment",
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
            "c_acctbal",
            days.alias("tenure_days"),
            "n_orders",
            (F.col("cents") / 100.0).alias("total_spend"),
            (F.expr("cents div n_orders") / 100.0).alias("avg_spend"),
            (F.col("n_urgent") > 0).alias("has_urgent"),
            "n_urgent",
            (F.col("n_after") == 0).cast("int").alias("churned"),
        )
    )


def subscriber_rows(spark: SparkSession, folder: str, cutoff: str = CUTOFF) -> DataFrame:
    """All customers as 21 text columns of the subscriber contract.

    Customers without an earlier order have tenure 0 and a blank total.
    """
    facts = _order_facts(spark, folder, cutoff)
    customer = read_table(spark, folder, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")

    def count(name: str) -> F.Column:
        return F.coalesce(F.col(name), F.lit(0))

    def yes_no(condition: F.Column) -> F.Column:
        return F.when(condition, "Yes").otherwise("No")

    letters = [
        F.char(F.lit(65) + (F.expr(f"c_custkey div {10_000 * 26 ** i}") % 26).cast("int"))
        for i in range(4, -1, -1)
    ]
    no_phone = key % 10 == 0
    no_internet = F.col("c_mktsegment") == "BUILDING"

    def addon(condition: F.Column) -> F.Column:
        return F.when(no_internet, "No internet service").otherwise(yes_no(condition))

    def money(amount: F.Column) -> F.Column:
        return (amount.cast("decimal(18,2)") / F.lit(100).cast("decimal(3,0)")).cast(
            "decimal(18,2)"
        ).cast("string")

    mapped = customer.join(facts, key == F.col("o_custkey"), "left").select(
        "*",
        # least() skips nulls, so the missing first order is settled inside.
        F.least(
            F.lit(72),
            F.coalesce(
                F.floor(F.datediff(F.to_date(F.lit(cutoff)), F.to_date("first_order")) / 30),
                F.lit(0),
            ),
        )
        .cast("int")
        .alias("months"),
        F.expr("coalesce(cents, 0) div 1000").alias("paid"),
    )
    months = F.col("months")
    monthly = F.expr("paid div greatest(months, 1)") + (key % 7) * 100
    return mapped.select(
        F.concat(F.lpad((key % 10_000).cast("string"), 4, "0"), F.lit("-"), *letters).alias(
            "customerID"
        ),
        F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
        F.when(key % 20 < 3, "1").otherwise("0").alias("SeniorCitizen"),
        yes_no(nation % 2 == 0).alias("Partner"),
        yes_no(nation % 3 == 0).alias("Dependents"),
        months.cast("string").alias("tenure"),
        yes_no(~no_phone).alias("PhoneService"),
        F.when(no_phone, "No phone service")
        .otherwise(yes_no(count("n_orders") >= 10))
        .alias("MultipleLines"),
        F.when(no_internet, "No")
        .when(F.col("c_mktsegment").isin("MACHINERY", "FURNITURE"), "DSL")
        .otherwise("Fiber optic")
        .alias("InternetService"),
        addon(count("n_urgent") >= 2).alias("OnlineSecurity"),
        addon(count("n_high") >= 2).alias("OnlineBackup"),
        addon(count("n_medium") >= 2).alias("DeviceProtection"),
        addon(count("n_low") >= 2).alias("TechSupport"),
        addon(count("n_unspecified") >= 2).alias("StreamingTV"),
        addon(count("n_open") >= 3).alias("StreamingMovies"),
        F.when(count("n_orders") <= 8, "Month-to-month")
        .when(count("n_orders") <= 11, "One year")
        .otherwise("Two year")
        .alias("Contract"),
        yes_no(F.col("c_acctbal") >= 4000).alias("PaperlessBilling"),
        F.when(nation % 4 == 0, "Electronic check")
        .when(nation % 4 == 1, "Mailed check")
        .when(nation % 4 == 2, "Bank transfer (automatic)")
        .otherwise("Credit card (automatic)")
        .alias("PaymentMethod"),
        money(monthly).alias("MonthlyCharges"),
        F.when(months == 0, " ").otherwise(money(F.col("paid"))).alias("TotalCharges"),
        yes_no(count("n_after") == 0).alias("Churn"),
    )
