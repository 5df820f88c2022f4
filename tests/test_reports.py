import contextlib
import io
from decimal import Decimal

import pytest

from starmill.plans import reports
from starmill.schemas.publishing import PUBLISHING

# Title, type, publisher, price and sales, from which the known report results follow.
TITLES = [
    ("PC8888", "popular_comp", "1389", "20.00", 4095),
    ("BU1032", "business", "1389", "19.99", 4095),
    ("PS7777", "psychology", "0736", "7.99", 3336),
    ("PS3333", "psychology", "0736", "19.99", 4072),
    ("BU1111", "business", "1389", "11.95", 3876),
    ("MC2222", "mod_cook", "0877", "19.99", 2032),
    ("TC7777", "trad_cook", "0877", "14.99", 4095),
    ("TC4203", "trad_cook", "0877", "11.95", 15096),
    ("PC1035", "popular_comp", "1389", "22.95", 8780),
    ("BU2075", "business", "0736", "2.99", 18722),
    ("PS2091", "psychology", "0736", "10.95", 2045),
    ("PS2106", "psychology", "0736", "7.00", 111),
    ("MC3021", "mod_cook", "0877", "2.99", 22246),
    ("TC3218", "trad_cook", "0877", "20.95", 375),
    ("BU7832", "business", "1389", "19.99", 4095),
    ("PS1372", "psychology", "0877", "21.59", 375),
]


@pytest.fixture(scope="module")
def t(spark):
    given = spark.createDataFrame(
        [(i, f"title {i}", k, p, Decimal(m), n) for i, k, p, m, n in TITLES],
        "title_id string, title string, type string, pub_id string, price decimal(19,4), ytd_sales int",
    )
    table = PUBLISHING["titles"]
    # two titles were inserted with a column list
    untyped = spark.createDataFrame([("MC3026", "m", "0877")], "title_id string, title string, pub_id string")
    typed = spark.createDataFrame(
        [("PC9999", "n", "popular_comp", "1389")],
        "title_id string, title string, type string, pub_id string",
    )
    titles = table.fill(given).unionByName(table.fill(untyped)).unionByName(table.fill(typed))
    authors = spark.createDataFrame(
        [("a1", "Ringer"), ("a2", "Green"), ("a3", "White")], "au_id string, au_lname string"
    )
    shares = spark.createDataFrame(
        [("a1", "PS2091", 1, 50), ("a2", "PS2091", 2, 50), ("a1", "PS2106", 1, 100),
         ("a1", "MC3021", 1, 100), ("a9", "PS2106", 1, 100), ("a2", "XX", 1, 100)],
        "au_id string, title_id string, au_ord short, royaltyper int",
    )
    return {"titles": titles, "authors": authors, "titleauthor": shares}


def test_reptq1(t):
    got = reports.reptq1(t).collect()
    # the average over all is 14.76625
    assert [(r["pub_id"], r["avg_price"]) for r in got] == [
        ("0736", Decimal("9.7840")),
        ("0877", Decimal("15.4100")),
        ("1389", Decimal("18.9760")),
        ("ALL", Decimal("14.7663")),
    ]


def test_reptq2(t):
    got = {(r["pub_id"], r["type"]): r["avg_ytd_sales"] for r in reports.reptq2(t).collect()}
    assert got == {
        ("0736", "business"): 18722,
        ("0736", "psychology"): 2391,
        ("0736", "ALL"): 5657,
        ("0877", "UNDECIDED"): None,
        ("0877", "mod_cook"): 12139,
        ("0877", "psychology"): 375,
        ("0877", "trad_cook"): 6522,
        ("0877", "ALL"): 7369,
        ("1389", "business"): 4022,
        ("1389", "popular_comp"): 6437,
        ("1389", "ALL"): 4988,
        ("ALL", "ALL"): 6090,
    }


@pytest.mark.parametrize("kind", ["business", "business    "])
def test_reptq3_keeps_every_cook_title_whatever_its_price(t, kind):
    got = {(r["pub_id"], r["type"]): r["cnt"] for r in reports.reptq3(t, 5, "20", kind).collect()}
    assert got == {
        ("0877", "mod_cook"): 2,
        ("0877", "trad_cook"): 3,
        ("0877", "ALL"): 5,
        ("1389", "business"): 3,
        ("1389", "ALL"): 3,
        ("ALL", "ALL"): 8,
    }


def test_reptq3_limits_are_excluded_and_case_can_be_ignored(t):
    def total(*args, **more):
        rows = reports.reptq3(t, *args, **more).filter("pub_id = 'ALL'").collect()
        return rows[0]["cnt"] if rows else 0

    assert total("11.95", "19.99", "business") == 5
    assert total("11.94", "20", "business") == 8
    assert total("11.94", "20", "BUSINESS") == 5
    assert total("11.94", "20", "BUSINESS", ignore_case=True) == 8


def test_titleview_is_inner_and_no_cross_join(t):
    got = reports.titleview(t)
    assert got.columns == ["title", "au_ord", "au_lname", "price", "ytd_sales", "pub_id"]
    assert sorted((r["title"], r["au_ord"], r["au_lname"]) for r in got.collect()) == [
        ("title MC3021", 1, "Ringer"),
        ("title PS2091", 1, "Ringer"),
        ("title PS2091", 2, "Green"),
        ("title PS2106", 1, "Ringer"),
    ]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain()
    assert "CartesianProduct" not in out.getvalue() and "NestedLoop" not in out.getvalue()


def test_byroyalty_keeps_duplicates(t):
    assert sorted(r[0] for r in reports.byroyalty(t, 100).collect()) == ["a1", "a1", "a2", "a9"]
    assert reports.byroyalty(t, 7).count() == 0


def test_default_fill(t):
    row = t["titles"].filter("title_id = 'MC3026'").first()
    assert row["type"] == "UNDECIDED" and row["price"] is None and row["pubdate"] is not None
    assert t["titles"].filter("title_id = 'PC9999'").first()["type"] == "popular_comp"
