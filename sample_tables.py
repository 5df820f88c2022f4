"""The test tables in the shape of the two source databases.

Each view is a projection of whole test tables, so the models and reports run unchanged on them.
Where the test data lacks a column, a near one stands in: a part's brand is its publisher, an
order line ties a part ("employee") to a supplier ("territory"), an order not open counts as
shipped a week after it was placed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.functions.dates import day_of
from starmill.functions.numbers import MONEY
from starmill.functions.text import like_class
from starmill.schemas.tables import Check, Table, by_name, number, small, text, tiny, to, whole

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

AS_OF = "2001-12-31"

# The test order lines have no short key; these columns order them totally.
LINE_KEY = (
    "order_id",
    "product_id",
    "supplier_id",
    "line_number",
    "quantity",
    "unit_price",
    "shipped",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rules for three test tables, some of which their rows break.
DECLARED = by_name(
    Table(
        "supplier",
        (
            small("s_suppkey", True),
            text("s_name", 18, True),
            small("s_nationkey", True),
            number("s_acctbal", True),
        ),
        key=("s_suppkey",),
        checks=(Check("in_credit", lambda: F.col("s_acctbal") >= 0),),
    ),
    Table(
        "part",
        (
            whole("p_partkey", True),
            text("p_name", 9, True),
            text("p_brand", 8),
            text("p_type", 8),
            tiny("p_size", True),
            number("p_retailprice", True),
        ),
        key=("p_brand", "p_size"),
        checks=(Check("brand_pattern", lambda: like_class(F.col("p_brand"), "Brand#[0-9]")),),
    ),
    Table(
        "lineitem",
        (whole("l_orderkey", True), whole("l_partkey", True), tiny("l_linenumber", True)),
        key=("l_orderkey", "l_linenumber"),
        references=(
            to("part", "l_partkey", "p_partkey"),
            to("supplier", "l_suppkey", "s_suppkey"),
        ),
        checks=(Check("some_tax", lambda: F.col("l_tax") > 0.07),),
    ),
)


class Views(dict):
    """Tables by name, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self.builders = builders

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.builders[name]()
        return self[name]


def order_entry(spark: SparkSession, sf_dir: str) -> Views:
    def table(name: str) -> DataFrame:
        return read(spark, sf_dir, name)

    def company(name: str, key: str, label: str, nation: str, alias: str) -> DataFrame:
        nations = table("nation").join(
            table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        return table(name).join(nations, F.col(nation) == F.col("n_nationkey"), "left").select(
            F.col(key).alias(alias),
            F.col(label).alias("company_name"),
            F.concat(F.lit("Contact of "), F.col(label)).alias("contact_name"),
            F.concat(F.lit("City "), F.col(nation).cast("string")).alias("city"),
            F.col("n_name").alias("country"),
            F.when(F.col("r_name") != "ASIA", F.col("r_name")).alias("region"),
        )

    def orders() -> DataFrame:
        df = table("orders")
        placed = day_of(df, "o_orderdate")
        return df.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("employee_id"),
            placed.alias("order_date"),
            F.date_add(placed, 28).alias("required_date"),
            F.when(F.col("o_orderstatus") != "O", F.date_add(placed, 7)).alias("shipped_date"),
        )

    return Views(
        {
            "customers": lambda: company(
                "customer", "c_custkey", "c_name", "c_nationkey", "customer_id"
            ),
            "suppliers": lambda: company(
                "supplier", "s_suppkey", "s_name", "s_nationkey", "supplier_id"
            ),
            "categories": lambda: table("nation").select(
                F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("category_name")
            ),
            "products": lambda: table("part").select(
                F.col("p_partkey").alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p_size").alias("supplier_id"),
                F.col("p_size").alias("category_id"),
                F.col("p_size").alias("units_in_stock"),
                (F.col("p_size") * 2).alias("reorder_level"),
                F.when(F.col("p_type") == "PROMO", 1).otherwise(0).alias("discontinued"),
            ),
            "orders": orders,
            "order_details": lambda: table("lineitem").select(
                F.col("l_orderkey").alias("order_id"),
                F.col("l_partkey").alias("product_id"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                F.col("l_quantity").alias("quantity"),
                F.col("l_discount").alias("discount"),
                F.col("l_suppkey").alias("supplier_id"),
                F.col("l_linenumber").alias("line_number"),
                F.col("l_shipdate").alias("shipped"),
            ),
            "employees": lambda: table("part").select(
                F.col("p_partkey").alias("employee_id"),
                F.col("p_brand").alias("first_name"),
                F.col("p_type").alias("last_name"),
                F.col("p_name").alias("title"),
                F.date_add(F.lit("1990-01-01").cast("date"), F.col("p_size")).alias("hire_date"),
            ),
            "employee_territories": lambda: table("lineitem").select(
                F.col("l_partkey").alias("employee_id"), F.col("l_suppkey").alias("territory_id")
            ),
            "territories": lambda: table("supplier").select(
                F.col("s_suppkey").alias("territory_id"), F.col("s_nationkey").alias("region_id")
            ),
            "region": lambda: table("nation").select(
                F.col("n_nationkey").alias("region_id"),
                F.col("n_name").alias("region_description"),
            ),
        }
    )


def publishing(spark: SparkSession, sf_dir: str) -> Views:
    def table(name: str) -> DataFrame:
        return read(spark, sf_dir, name)

    return Views(
        {
            "titles": lambda: table("part").select(
                F.col("p_partkey").alias("title_id"),
                F.col("p_name").alias("title"),
                F.col("p_type").alias("type"),
                F.col("p_brand").alias("pub_id"),
                F.col("p_retailprice").cast(MONEY).alias("price"),
                F.col("p_size").alias("ytd_sales"),
            ),
            "authors": lambda: table("orders").select(
                F.col("o_orderkey").alias("au_id"), F.col("o_orderpriority").alias("au_lname")
            ),
            "titleauthor": lambda: table("lineitem").select(
                F.col("l_orderkey").alias("au_id"),
                F.col("l_partkey").alias("title_id"),
                F.col("l_linenumber").alias("au_ord"),
                F.col("l_quantity").cast("int").alias("royaltyper"),
            ),
            # suppliers work in nations; a nation's level range depends on its key
            "employee": lambda: table("supplier").select(
                F.col("s_suppkey").alias("emp_id"),
                F.col("s_nationkey").alias("job_id"),
                F.floor(F.abs("s_acctbal") / 40).cast("int").alias("job_lvl"),
            ),
            "jobs": lambda: table("nation").select(
                F.col("n_nationkey").alias("job_id"),
                (F.lit(10) + F.col("n_nationkey") * 2).alias("min_lvl"),
                (F.lit(100) + F.col("n_nationkey") * 5).alias("max_lvl"),
            ),
        }
    )
