"""Keys that own a third of the rows: the plans split them, the results stay whole."""

import pytest
from pyspark.sql import functions as F

from starmill.operators import quality as dq
from starmill.operators.numbering import range_buckets
from starmill.plans import star
from starmill.plans.reports import titleview

LINES = 200_000


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_limits(spark):
    """Thresholds small enough that the test data counts as big."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
    }
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name in limits:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    """A third of the lines is one order, another third one product."""
    root = tmp_path_factory.mktemp("skew")
    i = F.col("id")
    details = spark.range(0, LINES, 1, 8).select(
        F.when(i % 3 == 0, 500).otherwise(i % 1000).alias("order_id"),
        F.when(i % 3 == 1, 77).otherwise(i).alias("product_id"),
        i.alias("line"),
        (i % 7).cast("double").alias("unit_price"),
        F.lit(2).alias("quantity"),
        F.lit(0.1).alias("discount"),
    )
    orders = spark.range(1000).select(
        i.alias("order_id"),
        F.concat(F.lit("C"), i).alias("customer_id"),
        (i % 9).alias("employee_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (i % 300).cast("int")).alias("order_date"),
        F.lit("2020-06-01").cast("date").alias("required_date"),
        F.lit(None).cast("date").alias("shipped_date"),
    )
    products = spark.range(LINES).select(i.alias("product_id"), (i % 13).alias("supplier_id"))
    for name, df in (("order_details", details), ("orders", orders), ("products", products)):
        df.write.parquet(str(root / name))
    return {n: spark.read.parquet(str(root / n)) for n in ("order_details", "orders", "products")}


def test_fact_is_whole_and_its_product_join_splits_the_hot_product(spark, t, small_limits):
    fact = star.fact_table(
        t, as_of="2020-12-31", line_key=("order_id", "product_id", "line"), buckets=20
    )
    assert "SortMergeJoin(skew=true)" in final_plan(fact)
    row = fact.agg(
        F.count("*"), F.countDistinct("fact_id"), F.min("fact_id"), F.max("fact_id"),
        F.count("customer_id"), F.count("supplier_id"), F.count("order_date_id"),
        F.sum(F.when(F.col("customer_id") == "C500", 1)),
        F.count_if(F.col("supplier_id") != F.col("product_id") % 13),
    ).first()
    hot = t["order_details"].filter("order_id = 500").count()
    assert tuple(row) == (LINES, LINES, 1, LINES, LINES, LINES, LINES, hot, 0)


def test_a_hot_product_is_a_row_a_bucket(spark, t, small_limits):
    """By bucket, neither a third of the lines nor a product of theirs meets the products in one task."""
    keys = ("order_id", "product_id", "line")
    ranges = range_buckets(t["order_details"].select(*keys), keys, 20)
    met = star.suppliers_by_bucket(t["order_details"], t["products"], ranges)
    assert met.filter("product_id = 77").count() <= 20
    plan = final_plan(met)
    assert plan.index("Exchange hashpartitioning(product_id") < plan.index("HashAggregate(keys=[__bucket")
    fact = star.fact_table(t, as_of="2020-12-31", line_key=keys, buckets=20, by_bucket=True)
    row = fact.agg(
        F.count("*"), F.countDistinct("fact_id"), F.max("fact_id"), F.count_if(F.col("supplier_id") != F.col("product_id") % 13),
        F.count("supplier_id"),
    ).first()
    assert tuple(row) == (LINES, LINES, LINES, 0, LINES)


def test_titleview_splits_the_hot_author(spark, t, small_limits):
    shares = t["order_details"].select(
        F.col("order_id").alias("au_id"), F.col("product_id").alias("title_id"), F.lit(1).alias("au_ord")
    )
    authors = t["orders"].select(F.col("order_id").alias("au_id"), F.col("customer_id").alias("au_lname"))
    titles = t["products"].select(
        F.col("product_id").alias("title_id"), F.lit("x").alias("title"), F.lit(1).alias("price"),
        F.lit(1).alias("ytd_sales"), F.lit("p").alias("pub_id"),
    )
    view = titleview({"titleauthor": shares, "authors": authors, "titles": titles})
    assert "SortMergeJoin(skew=true)" in final_plan(view)
    assert view.count() == LINES


def test_hot_foreign_key_reaches_the_join_as_one_row(spark, t):
    lines = t["order_details"].withColumn(
        "product_id", F.when(F.col("product_id") == 77, -1).otherwise(F.col("product_id"))
    )
    got = dq.reference_violations(
        lines, "order_details", ["product_id"], t["products"], "products", ["product_id"]
    ).collect()
    hot = t["order_details"].filter("product_id = 77").count()
    assert [(r["key"], r["n_rows"]) for r in got] == [('{"product_id":-1}', hot)]
