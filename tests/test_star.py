import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from starmill.plans import star
from tests import order_fixture as fixture

AS_OF = dt.date(2021, 4, 15)


@pytest.fixture(scope="module")
def t(spark):
    return fixture.tables(spark)


def expected_fact():
    made = fixture.rows()
    orders = {o["order_id"]: o for o in made["orders"]}
    products = {p["product_id"]: p for p in made["products"]}
    first = min(o["order_date"] for o in made["orders"] if o["order_date"])

    def date_id(day):
        return (day - first).days + 1 if day and first <= day <= AS_OF else None

    out = []
    lines = sorted(made["order_details"], key=lambda d: (d["order_id"], d["product_id"]))
    for n, d in enumerate(lines, 1):
        o = orders.get(d["order_id"], {})
        extended = d["unit_price"] * d["quantity"]
        out.append(
            (
                n, d["order_id"], d["product_id"], d["quantity"], d["unit_price"], extended,
                d["discount"], extended * (1 - d["discount"]),
                "fulfilled" if o.get("shipped_date") is None else "not fulfilled",
                o.get("customer_id"), products[d["product_id"]]["supplier_id"], o.get("employee_id"),
                date_id(o.get("order_date")), date_id(o.get("required_date")),
                date_id(o.get("shipped_date")),
            )
        )
    return out


@pytest.mark.parametrize("buckets", [None, 1, 13])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_fact_table_equals_brute_force(spark, t, buckets, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = star.fact_table(t, as_of=AS_OF, buckets=buckets).orderBy("fact_id").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [tuple(r) for r in got] == expected_fact()


def test_fact_with_calendar_joins_is_the_same(t):
    dates = star.dim_date(t, as_of=AS_OF)
    got = star.fact_table(t, dates=dates, buckets=5).orderBy("fact_id").collect()
    assert [tuple(r) for r in got] == expected_fact()


def test_fact_from_epoch_millis_is_the_same(t):
    sent = t["orders"].withColumns(
        {c: F.unix_date(c).cast("long") * 86_400_000 for c in star.ROLES}
    )
    got = star.fact_table({**t, "orders": sent}, as_of=AS_OF, buckets=5).orderBy("fact_id").collect()
    assert [tuple(r) for r in got] == expected_fact()


def test_fact_labels_can_be_swapped(t):
    got = star.fact_table(t, as_of=AS_OF, labels=("open", "shipped"))
    assert {r[0] for r in got.select("order_status").distinct().collect()} == {"open", "shipped"}


def test_line_key_starts_with_the_order(t):
    with pytest.raises(ValueError):
        star.fact_table(t, line_key=("product_id", "order_id"))


def test_fact_moves_lines_once_and_orders_once(spark, t, tmp_path):
    """The numbering and the join with the orders share one partitioning."""
    for name in ("orders", "order_details", "products"):
        t[name].write.parquet(str(tmp_path / name))
    files = {n: spark.read.parquet(str(tmp_path / n)) for n in ("orders", "order_details", "products")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            star.fact_table(files, as_of=AS_OF, buckets=8).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the checks for repeated keys stand among the subqueries
    text = out.getvalue().split("===== Subqueries")[0]
    assert text.count("Arguments: shufflepartitionidpassthrough") == 2
    # the products, twice for their join, and the bucket sizes
    assert text.count("Arguments: hashpartitioning(product_id") == 2
    assert text.count("Arguments: hashpartitioning(__bucket") == 1
    assert "Arguments: hashpartitioning(order_id" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_needed_columns(spark, t, tmp_path):
    t["suppliers"].write.parquet(str(tmp_path / "s"))
    df = star.dim_suppliers({"suppliers": spark.read.parquet(str(tmp_path / "s"))})
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    schema = out.getvalue().split("ReadSchema:")[1]
    assert "company_name" in schema and "homepage" not in schema and "phone" not in schema


def test_dim_products(t):
    got = {r["product_id"]: r for r in star.dim_products(t).collect()}
    assert len(got) == 30
    assert got[1].asDict() == dict(
        product_id=1, product_name="prod 1", category_name="cat 2", units_in_stock=1,
        reorder_level=10, discontinued=1,
    )
    assert got[7]["category_name"] is None


def test_dim_customers_and_suppliers(t):
    columns = ["company_name", "contact_name", "city", "country", "region"]
    assert star.dim_customers(t).columns == ["customer_id", *columns]
    assert star.dim_suppliers(t).columns == ["supplier_id", *columns]
    assert star.dim_customers(t).count() == 20 and star.dim_suppliers(t).count() == 5


def test_dim_employees(t):
    got = star.dim_employees(t)
    assert got.columns == [
        "employee_id", "employee_full_name", "title", "hire_date", "region_description", "country",
        "number_of_territories_managing",
    ]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(
        [
            (1, "Ada Berg", "Boss", fixture.FIRST, "East", "USA", 1),
            (1, "Ada Berg", "Boss", fixture.FIRST, "West", "USA", 2),
            (2, "Bo Lund", None, None, "East", "USA", 2),
            (3, "Cy Vik", "Clerk", fixture.FIRST, None, "USA", 0),
        ],
        key=str,
    )
    assert {r["country"] for r in star.dim_employees(t, country="NO").collect()} == {"NO"}
    kept = star.dim_employees(t, hire_date="millis").filter("employee_id = 3").first()
    assert kept["hire_date"] == 1614556800000


def test_equal_employee_rows_are_one_row_with_all_territories(t):
    twice = t["employees"].unionByName(t["employees"].filter("employee_id = 1"))
    got = star.dim_employees({**t, "employees": twice}).filter("employee_id = 1").collect()
    assert {r["region_description"]: r["number_of_territories_managing"] for r in got} == {
        "East": 2,
        "West": 4,
    }
    renamed = twice.unionByName(
        t["employees"].filter("employee_id = 1").withColumn("title", F.lit("Other"))
    )
    assert star.dim_employees({**t, "employees": renamed}).filter("employee_id = 1").count() == 4


def test_a_missing_first_name_leaves_no_full_name(t):
    people = t["employees"].withColumn("first_name", F.when(F.col("employee_id") > 1, F.col("first_name")))
    got = star.dim_employees({**t, "employees": people}).filter("employee_id = 1").collect()
    assert {r["employee_full_name"] for r in got} == {None}


def test_dim_date(t):
    got = star.dim_date(t, as_of=AS_OF).orderBy("date_id").collect()
    assert [tuple(r) for r in got] == [
        (i + 1, fixture.FIRST + dt.timedelta(i)) for i in range((AS_OF - fixture.FIRST).days + 1)
    ]


@pytest.mark.parametrize("table", ["orders", "products"])
def test_a_repeated_key_stops_the_fact(spark, t, table):
    twice = {**t, table: t[table].unionByName(t[table].limit(1))}
    with pytest.raises(Exception, match="is repeated"):
        star.fact_table(twice, as_of=AS_OF).collect()


def test_the_bridge_is_shuffled_twice(spark, t, tmp_path):
    """Counted by employee and territory, then dealt by employee: the sums and the join with the employees need no more."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": str(10 << 20)}
    before = {name: spark.conf.get(name) for name in settings}
    files = {}
    for name in ("employees", "employee_territories", "territories", "region"):
        t[name].write.parquet(f"{tmp_path}/{name}")
        files[name] = spark.read.parquet(f"{tmp_path}/{name}")
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        plan = star.dim_employees(files)._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(employee_id" in x]
    assert len([x for x in dealt if "territory_id" in x]) == 1
    assert not [x for x in dealt if "region_description" in x]


def test_whole_fact_rows_do_not_travel_to_the_products(t, spark, tmp_path):
    """By bucket, only buckets and product ids go to the products, and the fact is the same and in order."""
    got = star.fact_table(t, as_of=AS_OF, buckets=5, by_bucket=True).orderBy("fact_id").collect()
    assert [tuple(r) for r in got] == expected_fact()

    files = {}
    for name in ("orders", "order_details", "products"):
        t[name].write.parquet(str(tmp_path / name))
        files[name] = spark.read.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            star.fact_table(files, as_of=AS_OF, buckets=8, by_bucket=True).explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = out.getvalue()
    # lines, orders and what the lines ask of the products; below an exchange by product stand few columns
    assert text.count("shufflepartitionidpassthrough") == 3
    lines = text.splitlines()
    below = [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning(product_id" in x]
    assert below and not any("unit_price" in x or "fact_id" in x for x in below)


def test_many_lines_meet_large_products_by_bucket(t, spark, tmp_path, monkeypatch):
    asked = []
    real = star.suppliers_by_bucket
    monkeypatch.setattr(star, "suppliers_by_bucket", lambda *x: asked.append(1) or real(*x))
    t["products"].write.parquet(str(tmp_path / "products"))
    files = {**t, "products": spark.read.parquet(str(tmp_path / "products"))}
    star.fact_table(files, as_of=AS_OF, buckets=3)
    monkeypatch.setattr(star, "MANY_LINES", 1)
    star.fact_table(files, as_of=AS_OF, buckets=3)
    assert not asked
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    try:
        got = star.fact_table(files, as_of=AS_OF, buckets=3).orderBy("fact_id").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert asked and [tuple(r) for r in got] == expected_fact()
