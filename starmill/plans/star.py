"""The star schema: five dimensions and one fact table.

Every builder takes ``t``, a mapping from source table name to DataFrame, and selects only the
columns it needs, so that scans stay narrow. Dates may be dates, timestamps or epoch
milliseconds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from starmill.functions.dates import day_of, millis
from starmill.operators.calendar import calendar, date_ids, with_role_dates
from starmill.operators.numbering import BUCKET, ROWS_PER_BUCKET, RangeBuckets, range_buckets

Tables = Mapping[str, DataFrame]

# The labels for an order line without and with a shipping date, in the sense
# the source model uses them.
STATUS_LABELS = ("fulfilled", "not fulfilled")
ROLES = {
    "order_date": "order_date_id",
    "required_date": "required_date_id",
    "shipped_date": "shipped_date_id",
}
# So many order lines are worth two narrow shuffles for their suppliers instead of one of whole fact rows.
MANY_LINES = 4 * ROWS_PER_BUCKET


def dim_suppliers(t: Tables) -> DataFrame:
    return t["suppliers"].select(
        "supplier_id", "company_name", "contact_name", "city", "country", "region"
    )


def dim_customers(t: Tables) -> DataFrame:
    return t["customers"].select(
        "customer_id", "company_name", "contact_name", "city", "country", "region"
    )


def dim_products(t: Tables) -> DataFrame:
    names = t["categories"].select("category_id", "category_name")
    return (
        t["products"]
        .join(names, "category_id", "left")
        .select(
            "product_id",
            "product_name",
            "category_name",
            "units_in_stock",
            "reorder_level",
            "discontinued",
        )
    )


def dim_employees(t: Tables, country: str = "USA", hire_date: str = "date") -> DataFrame:
    """One row per employee and region, with the number of territories there.

    The bridge is counted per employee and territory before it is joined, and per employee and region before it meets the
    employees: the counts combine ahead of each shuffle, so a busy employee or territory costs no more than any other. Territories and
    regions are joined one after the other, so that Spark knows how small each is and need not shuffle the
    bridge for them. Employee rows that agree in every shown
    column count as one employee with all their territories, as if grouped after the join.
    ``hire_date="millis"`` keeps the epoch milliseconds of a staged file.
    """
    regions = t["region"].select("region_id", "region_description")
    home = t["territories"].select("territory_id", "region_id")
    # Counted before the join too: a territory with very many rows in the bridge is few by then.
    bridge = (
        t["employee_territories"]
        .groupBy("employee_id", "territory_id")
        .agg(F.count("territory_id").alias("times"))
    )
    managed = (
        bridge.join(home, "territory_id", "left")
        .select("employee_id", "region_id", "times")
        # one shuffle for the sums and the join with the employees; an employee has a row for each territory at most
        .repartition("employee_id")
        .join(regions, "region_id", "left")
        .groupBy("employee_id", "region_description")
        .agg(F.sum("times").alias("n"))
    )
    employees = t["employees"]
    hired = day_of(employees, "hire_date")
    if hire_date == "millis":
        dtype = employees.schema["hire_date"].dataType
        is_millis = dtype.typeName() == "long"
        hired = F.col("hire_date") if is_millis else millis(F.col("hire_date"), dtype)
    person = ["employee_id", "employee_full_name", "title", "hire_date"]
    people = (
        employees.select(
            "employee_id",
            F.concat("first_name", F.lit(" "), "last_name").alias("employee_full_name"),
            "title",
            hired.alias("hire_date"),
        )
        .groupBy(*person)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return people.join(managed, "employee_id", "left").select(
        *person,
        "region_description",
        F.lit(country).alias("country"),
        (F.col("copies") * F.coalesce("n", F.lit(0))).alias("number_of_territories_managing"),
    )


def dim_date(t: Tables, as_of: dt.date | str | None = None) -> DataFrame:
    return calendar(t["orders"], "order_date", as_of)


def unique_rows(df: DataFrame, key: str, table: str) -> DataFrame:
    """``df``, whose job fails if a value of ``key`` is there twice; nulls may be."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & F.col(key).isNotNull())
    message = F.concat(F.lit(f"{table}.{key} is repeated: "), F.min(F.col(key).cast("string")))
    checked = repeated.agg(F.when(F.count(F.lit(1)) > 0, F.raise_error(message)).otherwise(F.lit(True)).alias("ok"))
    return df.filter(F.coalesce(checked.scalar().cast("boolean"), F.lit(True)))


def sent_around(df: DataFrame) -> bool:
    """Whether Spark's size check lets it send a table to every task of a join."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= limit


def suppliers_by_bucket(lines: DataFrame, products: DataFrame, ranges: RangeBuckets) -> DataFrame:
    """(bucket, product_id, supplier_id): the suppliers that the lines of each bucket ask for, in the partition of the bucket.

    Only buckets and product ids travel to the products and back, each pair once: a hot product has a row a bucket.
    """
    asked = ranges.assign(lines).select(BUCKET, "product_id").distinct()
    return ranges.place(asked.join(products, "product_id"))


def fact_table(
    t: Tables,
    as_of: dt.date | str | None = None,
    dates: DataFrame | None = None,
    labels: tuple[str, str] = STATUS_LABELS,
    line_key: Sequence[str] = ("order_id", "product_id"),
    buckets: int | None = None,
    by_bucket: bool | None = None,
) -> DataFrame:
    """One row per order line.

    Lines are range-partitioned once, by the sort order of ``line_key``, which must be a total
    order that starts with ``order_id``. That one shuffle serves the surrogate key and the join
    with the orders, which go to the same partitions. A large order spans several
    partitions, and its order row is copied to each of them. ``order_id`` must be unique in
    orders and ``product_id`` in products; a repeated one stops the build, since its lines would
    get one surrogate key several times.

    The products are joined with the whole rows, or with ``by_bucket`` each bucket gets the suppliers of its products, so
    that fact rows stay where they are, in order. By default that is so for many lines and a product table too large
    to be sent around.

    Date ids are computed on the orders, before the join. With ``dates``, a calendar table, they
    come from joins with that table instead of from its day arithmetic.
    """
    if line_key[0] != "order_id":
        raise ValueError("line_key must start with order_id")
    lines, products = t["order_details"], t["products"]
    orders = t["orders"].select("order_id", "customer_id", "employee_id", *ROLES)
    orders = unique_rows(orders, "order_id", "orders")
    products = unique_rows(products.select("product_id", "supplier_id"), "product_id", "products")
    if dates is None:
        orders = date_ids(orders, ROLES, "order_date", as_of)
    else:
        orders = with_role_dates(orders, dates, ROLES)
    orders = orders.select(
        "order_id",
        "customer_id",
        "employee_id",
        F.col("shipped_date").isNotNull().alias("__shipped"),
        *ROLES.values(),
    )
    measures = ["order_id", "product_id", "quantity", "unit_price", "discount"]
    lines = lines.select(*dict.fromkeys([*measures, *line_key]))

    # orders without lines count too, else many of them between two lines fill one partition
    spots = lines.select(*line_key).unionByName(
        t["orders"].select("order_id"), allowMissingColumns=True
    )
    ranges = range_buckets(spots, line_key, buckets)
    numbered = ranges.number(lines, "fact_id").select(BUCKET, "fact_id", *measures)
    copies = ranges.place(ranges.spread(orders, "order_id"))
    if by_bucket is None:
        by_bucket = not sent_around(products) and lines.count() > MANY_LINES
    if by_bucket:
        # a bucket's products are hashed, so its lines keep their order
        suppliers, met = suppliers_by_bucket(lines, products, ranges).hint("shuffle_hash"), ["product_id", BUCKET]
    else:
        suppliers, met = products, ["product_id"]

    extended = F.col("unit_price") * F.col("quantity")
    shipped = F.coalesce(F.col("__shipped"), F.lit(False))
    return (
        numbered.join(copies, ["order_id", BUCKET], "left")
        .join(suppliers, met, "left")
        .select(
            "fact_id",
            "order_id",
            "product_id",
            "quantity",
            "unit_price",
            extended.alias("extended_price"),
            "discount",
            (extended * (F.lit(1) - F.col("discount"))).alias("total_price"),
            F.when(shipped, F.lit(labels[1])).otherwise(F.lit(labels[0])).alias("order_status"),
            "customer_id",
            "supplier_id",
            "employee_id",
            *ROLES.values(),
        )
    )


MODELS = {
    "dim_suppliers": dim_suppliers,
    "dim_products": dim_products,
    "dim_customers": dim_customers,
    "dim_employees": dim_employees,
    "dim_date": dim_date,
    "fact_table": fact_table,
}
