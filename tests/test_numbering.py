import contextlib
import io
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window as W, functions as F

from starmill.operators import numbering
from starmill.operators.numbering import BUCKET, global_row_number, range_buckets


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def check(spark, rows, schema, keys, buckets):
    df = spark.createDataFrame(rows, schema).repartition(4)
    got = global_row_number(df, keys, "n", buckets).orderBy("n").collect()
    want = df.withColumn("n", F.row_number().over(W.orderBy(*keys))).orderBy("n").collect()
    assert got == want


@pytest.mark.parametrize("buckets", [1, 2, 7, 300, 700])
def test_equals_the_plain_window(spark, buckets):
    random.seed(buckets)
    rows = [(random.randrange(50), i, random.random()) for i in range(3000)]
    check(spark, rows, "a long, b long, x double", ["a", "b"], buckets)


def test_one_leading_key_with_a_third_of_the_rows_is_split(spark):
    rows = [(7 if i % 3 == 0 else i, i) for i in range(60_000)]
    df = spark.createDataFrame(rows, "a long, b long")
    ranges = range_buckets(df, ["a", "b"], 24)
    sizes = [r["count"] for r in ranges.assign(df).groupBy(BUCKET).count().collect()]
    assert sum(sizes) == 60_000
    assert max(sizes) < 3 * 60_000 / 24
    check(spark, rows[:6000], "a long, b long", ["a", "b"], 24)


def test_nulls_come_first_and_text_dates_and_floats_work(spark):
    rows = [
        (None if i % 5 == 0 else f"k'{i % 7}\"\n", None if i % 11 == 0 else i / 3, i)
        for i in range(500)
    ]
    check(spark, rows, "a string, b double, c int", ["a", "b", "c"], 9)
    df = spark.range(400).select(
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("d"),
        F.timestamp_millis(F.col("id") * 7919).cast("timestamp_ntz").alias("t"),
    )
    got = global_row_number(df, ["d", "t"], "n", 6).collect()
    want = df.withColumn("n", F.row_number().over(W.orderBy("d", "t"))).collect()
    assert sorted(got) == sorted(want)


def test_keys_that_json_rounds_still_order_the_cuts(spark):
    df = spark.range(4000).select(
        F.timestamp_micros(F.col("id") * 37 % 901).cast("timestamp_ntz").alias("t"),
        F.timestamp_micros(F.col("id") * 7 % 13).alias("u"),
        (F.col("id") * 31 % 4001).alias("k"),
        F.expr("cast(decode(unhex(lpad(hex(id % 256), 2, '0')), 'ISO-8859-1') as string)").alias("s"),
    )
    for keys in (["t", "u", "k"], ["u", "k"], ["s", "t", "k"]):
        got = global_row_number(df, keys, "n", 23).select("k", "n").collect()
        want = df.withColumn("n", F.row_number().over(W.orderBy(*keys))).select("k", "n").collect()
        assert sorted(got) == sorted(want)


def test_narrower_keys_than_the_cuts(spark):
    wide = spark.range(3000).select(F.col("id").alias("a"))
    ranges = range_buckets(wide, ["a"], 10)
    narrow = wide.select(F.col("a").cast("int").alias("a"))
    assert ranges.assign(narrow).select(BUCKET, "a").collect() == ranges.assign(wide).select(BUCKET, "a").collect()


def test_empty_and_single_row(spark):
    check(spark, [], "a long", ["a"], None)
    check(spark, [], "a long", ["a"], 5)
    check(spark, [(3,)], "a long", ["a"], 5)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.integers(-(2**60), 2**60)), unique=True),
    buckets=st.integers(1, 40),
)
def test_any_unique_keys(spark, keys, buckets):
    df = spark.createDataFrame(keys, "a long, b long")
    got = global_row_number(df, ["a", "b"], "n", buckets).orderBy("n").collect()
    ordered = sorted(keys, key=lambda k: (k[0] is not None, k[0] or 0, k[1]))
    assert [tuple(r) for r in got] == [(*k, i + 1) for i, k in enumerate(ordered)]


def test_buckets_do_not_depend_on_partitioning(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 1009).alias("a"), F.col("id").alias("b"))
    ranges = range_buckets(df, ["a", "b"], 16)
    one = ranges.assign(df.coalesce(1)).collect()
    many = ranges.assign(df.repartition(13)).collect()
    assert sorted(one) == sorted(many)


def test_spread_covers_every_bucket_of_a_leading_key(spark):
    lines = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("a"), F.col("id").alias("b")
    )
    ranges = range_buckets(lines, ["a", "b"], 30)
    heads = lines.select("a").distinct()
    copies = ranges.spread(heads, "a")
    used = ranges.assign(lines).select("a", BUCKET).distinct()
    assert used.join(copies, ["a", BUCKET], "left_anti").count() == 0
    assert copies.count() <= heads.count() + ranges.cuts


def test_rows_move_once_and_only_bucket_sizes_meet_in_one_task(spark, tmp_path):
    spark.range(100_000).select(F.col("id").alias("a")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(global_row_number(df, ["a"], "n", 8))
    assert text.count("shufflepartitionidpassthrough") == 1
    single = text[: text.index("SinglePartition")].rsplit("Input", 1)[1]
    assert "__bucket" in single and "n#" in single and "a#" not in single


def test_bucket_count_follows_the_rows(spark, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_BUCKET", 100)
    ranges = range_buckets(spark.range(5000).select(F.col("id").alias("a")), ["a"])
    assert ranges.count == 50


def test_small_tables_use_several_buckets_too(spark):
    assert range_buckets(spark.range(100).select(F.col("id").alias("a")), ["a"]).count > 1
    check(spark, [(1,), (2,), (3,)], "a int", ["a"], None)
    check(spark, [], "a int", ["a"], None)


def test_numbers_do_not_depend_on_what_follows(spark):
    """Sorts, filters and joins after the numbering must not reach below it."""
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("a"), (F.col("id") % 5).alias("b"))
    numbered = global_row_number(df, ["a", "b"], "n", 11)
    want = {
        r["a"]: r["n"]
        for r in df.withColumn("n", F.row_number().over(W.orderBy("a", "b"))).collect()
    }
    for after in (
        numbered.orderBy(F.desc("b"), "a"),
        numbered.filter("b = 3"),
        numbered.filter("n % 2 = 0").repartition(3),
        numbered.join(df.select("a").filter("a > 100"), "a"),
        numbered.groupBy("a").agg(F.max("n").alias("n")),
        numbered.sort("b").limit(50),
    ):
        rows = after.collect()
        assert rows and all(want[r["a"]] == r["n"] for r in rows)


def test_no_ceiling_on_buckets_and_no_cuts_in_the_plan(spark):
    df = spark.range(600_000).select((F.col("id") * 7919 % 600_011).alias("a"))
    ranges = range_buckets(df, ["a"], 40_000)
    assert 32_768 < ranges.count <= 40_000
    assert len(plan(ranges.assign(df))) < 20_000
    ranges = range_buckets(df, ["a"], 5_000)
    assert ranges.count == 5_000
    bucketed = ranges.assign(df)
    assert ranges.offsets(bucketed).agg(F.max("__before")).first()[0] < 600_000
    spans = bucketed.groupBy(BUCKET).agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.count("a").alias("n"))
    before = F.lag("hi").over(W.orderBy(BUCKET))
    row = spans.select("n", (F.col("lo") <= before).alias("overlap")).agg(
        F.sum("n"), F.max("n"), F.count_if("overlap")
    ).first()
    assert row[0] == 600_000 and row[1] < 1200 and row[2] == 0


def test_a_hundred_thousand_buckets_and_a_flat_driver(spark):
    """Cuts are rows of a table; what one task and the driver see is a key for each SEGMENT of them."""
    df = spark.range(1_600_000).select((F.col("id") * 7919 % 1_600_033).alias("a"), F.lit("x").alias("b"))
    ranges = range_buckets(df, ["a", "b"], 100_000)
    assert ranges.count == 100_000
    sizes = [r["n"] for r in ranges.segments.select(F.size("cuts").alias("n")).collect()]
    assert max(sizes) == numbering.SEGMENT and sum(sizes) == 99_999
    tops = ranges.tops.select(F.size("tops")).collect()
    assert [tuple(r) for r in tops] == [(99_999 // numbering.SEGMENT,)]
    assigned = ranges.assign(df)
    assert len(plan(assigned)) < 20_000
    spans = assigned.groupBy(BUCKET).agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.count("a").alias("n"))
    before = F.lag("hi").over(W.orderBy(BUCKET))
    row = spans.select(BUCKET, "n", (F.col("lo") <= before).alias("overlap")).agg(
        F.sum("n").alias("rows"), F.max("n").alias("most"), F.count_if("overlap").alias("overlaps"), F.max(BUCKET).alias("last")
    ).first()
    assert (row["rows"], row["overlaps"], row["last"]) == (1_600_000, 0, 99_999) and row["most"] <= 64


@pytest.mark.parametrize("buckets", [256, 257, 258, 513])
def test_cuts_at_the_ends_of_segments(spark, buckets):
    """As many cuts as fill their segments, one less and one more."""
    df = spark.range(2600).select((F.col("id") * 17 % 2609).alias("a"))
    ranges = range_buckets(df, ["a"], buckets)
    got = global_row_number(df, ["a"], "n", buckets).orderBy("a").collect()
    assert [r["n"] for r in got] == list(range(1, 2601)) and ranges.count == buckets
    heads = ranges.spread(df, "a")
    assert ranges.assign(df).join(heads, ["a", BUCKET], "left_anti").count() == 0
