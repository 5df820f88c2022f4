import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from starmill.operators.calendar import calendar, date_ids, with_role_dates
from starmill.operators.rollup import average_money, average_whole, count_of, labelled_rollup

D = dt.date


def orders(spark):
    rows = [(1, D(2020, 2, 27), D(2020, 3, 1)), (2, D(2020, 2, 28), None), (3, None, D(2020, 2, 1))]
    return spark.createDataFrame(rows, "id int, placed date, sent date")


def test_calendar_has_every_day_once(spark):
    got = calendar(orders(spark), "placed", "2020-03-02").orderBy("date").collect()
    assert [tuple(r) for r in got] == [(i + 1, D(2020, 2, 27) + dt.timedelta(i)) for i in range(5)]


def test_calendar_defaults_to_today(spark):
    today = spark.sql("select current_date()").first()[0]
    assert calendar(orders(spark), "placed").agg(F.max("date")).first()[0] == today


def test_calendar_that_ends_before_it_starts_is_empty(spark):
    assert calendar(orders(spark), "placed", "2020-01-01").count() == 0
    assert calendar(orders(spark).filter("id = 3"), "placed", "2020-01-01").count() == 0


def test_ids_by_arithmetic_and_by_join_agree(spark):
    df = orders(spark)
    roles = {"placed": "placed_id", "sent": "sent_id"}
    for last in ("2020-02-28", "2020-03-05", "2019-01-01"):
        plain = date_ids(df, roles, "placed", last)
        joined = with_role_dates(df, calendar(df, "placed", last), roles)
        assert plain.columns == joined.columns == [*df.columns, "placed_id", "sent_id"]
        assert sorted(plain.collect(), key=str) == sorted(joined.collect(), key=str)
    assert [r["sent_id"] for r in date_ids(df, roles, "placed", "2020-03-05").orderBy("id").collect()] == [
        4,
        None,
        None,
    ]


def test_calendar_from_epoch_millis(spark):
    df = spark.createDataFrame([(86_400_000 * 3,), (86_400_000 * 5 + 1,)], "placed long")
    got = calendar(df, "placed", "1970-01-05").orderBy("date_id").collect()
    assert [tuple(r) for r in got] == [(1, D(1970, 1, 4)), (2, D(1970, 1, 5))]
    ids = date_ids(df, {"placed": "k"}, "placed", "1970-01-05").collect()
    assert sorted((r["k"] for r in ids), key=str) == [1, None]


SALES = [
    ("a", "x", "1.00", 5),
    ("a", "x", "2.0001", 6),
    ("a", None, "3.00", None),
    (None, "x", "4.00", 7),
    ("b", "y", None, None),
]


def sales(spark):
    rows = [(p, t, None if m is None else Decimal(m), n) for p, t, m, n in SALES]
    return spark.createDataFrame(rows, "pub string, type string, price decimal(19,4), sold int")


def test_rollup_by_two_keys_keeps_null_groups_apart_from_totals(spark):
    got = labelled_rollup(
        sales(spark), ["pub", "type"], [count_of("cnt", "price"), average_whole("avg", "sold")]
    ).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [
            ("a", "x", 2, 5),
            ("a", None, 1, None),
            ("a", "ALL", 3, 5),
            (None, "x", 1, 7),
            (None, "ALL", 1, 7),
            ("b", "y", 0, None),
            ("b", "ALL", 0, None),
            ("ALL", "ALL", 4, 6),
        ],
        key=str,
    )


def test_rollup_averages_are_of_rows_not_of_averages(spark):
    got = labelled_rollup(sales(spark), ["pub"], [average_money("avg", "price")]).collect()
    assert {r["pub"]: r["avg"] for r in got} == {
        "a": Decimal("2.0000"),
        None: Decimal("4.0000"),
        "b": None,
        "ALL": Decimal("2.5000"),
    }


def test_grand_total_is_the_sum_of_the_leaves(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).cast("string").alias("a"), (F.col("id") % 11).cast("string").alias("b"), "id"
    )
    got = labelled_rollup(df, ["a", "b"], [count_of("n", "id")])
    assert got.filter("a <> 'ALL' and b <> 'ALL'").agg(F.sum("n")).first()[0] == 5000
    assert got.filter("a = 'ALL'").first()["n"] == 5000
    assert got.count() == 77 + 7 + 1


def test_rollup_of_nothing_has_no_leaf(spark):
    got = labelled_rollup(sales(spark).limit(0), ["pub"], [count_of("n", "price")]).collect()
    assert [r for r in got if r["pub"] != "ALL"] == []
