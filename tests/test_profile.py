import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmill.operators import profile as profile_module
from starmill.operators.profile import column_profiles, normalise, profile


def forms(spark, **columns):
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{n} string" for n in names))
    return {p.column: (p.date_form, p.logical_type) for p in column_profiles(df)}


def test_date_like_texts(spark):
    assert forms(
        spark,
        day=["1996-07-04", None, "1998-05-06"],
        time=["1996-07-04 00:00:00", "1996-07-04T10:00", None],
        midnight=["1996-07-04 00:00:00", "1996-07-05 00:00:00.000", None],
        zoned=["1996-07-04T10:00:00Z", "1996-07-04 10:00:00+02:00", None],
        us=["6/12/94", "12/31/1999", None],
        slashed=["1996/7/4", "1996/12/31", None],
    ) == {
        "day": ("iso_day", "date"),
        "time": ("iso_time", "timestamp"),
        "midnight": ("iso_time", "date"),
        "zoned": ("iso_zone", "timestamp"),
        "us": ("month_first", "date"),
        "slashed": ("slashed", "date"),
    }


def test_texts_that_only_look_like_dates_stay_text(spark):
    found = forms(
        spark,
        zip=["12209", "05021", None],
        digits=["19960704", "19960705", "19960706"],
        no_such_day=["1996-02-30", "1996-02-01", None],
        mixed=["1996-07-04", "6/12/94", None],
        one_bad=["1996-07-04", "n/a", None],
        nothing=[None, None, None],
        empty=["", "", ""],
        too_old=["0001-01-01", "1996-07-04", None],
        long=["1996-07-04" + " " * 40, "1996-07-04", None],
    )
    assert set(found.values()) == {(None, None)}


def test_every_column_is_scanned_once(spark, tmp_path):
    spark.range(1000).select("id", F.col("id").cast("string").alias("t")).write.parquet(
        str(tmp_path / "t")
    )
    df = profile(spark.read.parquet(str(tmp_path / "t")))
    text = df._jdf.queryExecution().executedPlan().toString()
    schemas = [part.split()[0] for part in text.split("ReadSchema: ")[1:]]
    assert sorted(schemas) == ["struct<id:bigint>", "struct<t:string>"]
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "SortAggregate" not in text


def test_facts_and_types(spark):
    df = spark.createDataFrame(
        [
            (1, 0.5, 0.25, "x", True, dt.date(2020, 1, 1), dt.datetime(2020, 1, 1), b"", Decimal("1.5")),
            (None, float("nan"), None, None, False, None, dt.datetime(2020, 1, 2), None, None),
        ],
        "s short, f double, g float, t string, b boolean, d date, ts timestamp_ntz, bin binary, m decimal(9,2)",
    )
    got = {p.column: p for p in column_profiles(df)}
    assert [got[c].position for c in df.columns] == list(range(9))
    assert {c: p.staged_type for c, p in got.items()} == {
        "s": "bigint",
        "f": "double",
        "g": "double",
        "t": "string",
        "b": "boolean",
        "d": "date",
        "ts": "date",
        "bin": "binary",
        "m": "decimal(9,2)",
    }
    assert {c: p.nulls for c, p in got.items()} == {
        "s": 1, "f": 1, "g": 1, "t": 1, "b": 0, "d": 1, "ts": 0, "bin": 1, "m": 1
    }
    assert got["b"].nullable and not got["ts"].nullable
    assert {p.rows for p in got.values()} == {2}


def test_empty_table_has_a_profile(spark):
    df = spark.createDataFrame([], "a string, b timestamp_ntz, c int")
    got = column_profiles(df)
    assert [(p.column, p.rows, p.nullable, p.date_form) for p in got] == [
        ("a", 0, False, None),
        ("b", 0, False, None),
        ("c", 0, False, None),
    ]
    assert normalise(df, got).count() == 0


def test_normalise_dates_nulls_and_floats(spark):
    df = spark.createDataFrame(
        [("1996-07-04", "6/12/94", 0.15, float("nan"), None, 3), (None, "1/2/03", None, 2.0, "b", None)],
        "d string, us string, f float, g double, t string, n short",
    )
    found = column_profiles(df)
    kept = normalise(df, found)
    assert [tuple(r) for r in kept.collect()] == [
        (dt.date(1996, 7, 4), dt.date(1994, 6, 12), 0.15, None, None, 3),
        (None, dt.date(2003, 1, 2), None, 2.0, "b", None),
    ]
    assert [f.dataType.typeName() for f in kept.schema.fields] == [
        "date", "date", "double", "double", "string", "long"
    ]
    reference = normalise(df, found, null_text="None", dates="millis").collect()
    assert [tuple(r) for r in reference] == [
        (836438400000, 771379200000, 0.15, None, "None", 3),
        (None, 1041465600000, None, 2.0, "b", None),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_texts_with_a_zone_become_utc_times(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("1996-07-04T10:00:00+02:00",), ("1996-07-04 10:00Z",)], "t string")
        got = normalise(df, column_profiles(df)).select(F.col("t").cast("string")).collect()
        assert [r[0] for r in got] == ["1996-07-04 08:00:00", "1996-07-04 10:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_normalise_other_types(spark):
    df = spark.sql(
        "select interval '1 02:03:04' day to second as i, array(1, 2) as a, "
        "timestamp'2020-01-01 10:00:00' as ts, true as b"
    )
    row = normalise(df, column_profiles(df)).first()
    assert tuple(row) == ("P1DT2H3M4.000000S", "[1, 2]", dt.datetime(2020, 1, 1, 10), True)
    millis = normalise(df, column_profiles(df), dates="millis").first()
    assert millis["ts"] == 1577872800000


def test_month_names_blanks_and_years(spark):
    df = spark.createDataFrame(
        [("04-Jul-1996", "July 4, 1996", "1996-7-4", "9999-12-31"), ("5-AUG-1996", "aug 5, 1996", " ", "1996-01-01")],
        "a string, b string, c string, d string",
    )
    found = {p.column: p for p in profile_module.column_profiles(df)}
    assert [found[x].date_form for x in "abcd"] == ["day_month_name", "month_name_first", "iso_day", None]
    assert found["c"].nulls == 1 and found["c"].nullable
    rows = profile_module.normalise(df, list(found.values())).collect()
    assert [str(r.a) for r in rows] == ["1996-07-04", "1996-08-05"] == [str(r.b) for r in rows]
    assert rows[1].c is None
    late = profile_module.column_profiles(df, years=(1, 9999))
    assert late[3].date_form == "iso_day"


def test_no_session_zone_in_days(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.createDataFrame([("11/4/2018", "2018/11/4")], "a string, b string")
        assert {p.logical_type for p in profile_module.column_profiles(df)} == {"date"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
