import pytest
from pyspark.sql import functions as F

from starmill.operators import quality as dq
from starmill.operators.numbering import global_row_number
from starmill.schemas.order_entry import ORDER_ENTRY
from starmill.schemas.publishing import PUBLISHING
from starmill.schemas.tables import Reference, Table, text, whole
from tests import order_fixture


def found(df):
    assert tuple(df.columns) == dq.COLUMNS
    return sorted((r["rule"], r["key"], r["n_rows"]) for r in df.collect())


def test_primary_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None)], "x int, y string")
    assert found(dq.key_violations(df, "t", ["x", "y"])) == [
        ("primary_key", '{"x":1,"y":"a"}', 2),
        ("primary_key", '{"x":2,"y":null}', 2),
    ]
    assert found(dq.key_violations(df.filter("y = 'b'"), "t", ["x", "y"])) == []


def test_foreign_key(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id int, p int")
    parent = spark.createDataFrame([(1,), (2,)], "p int")
    assert found(dq.reference_violations(child, "c", ["p"], parent, "p", ["p"])) == [
        ("foreign_key:p", '{"p":9}', 2)
    ]


def test_composite_foreign_key_passes_when_a_part_is_null(spark):
    child = spark.createDataFrame([(1, "a"), (1, None), (1, "b")], "x int, y string")
    parent = spark.createDataFrame([(1, "a")], "u int, v string")
    assert found(dq.reference_violations(child, "c", ["x", "y"], parent, "p", ["u", "v"])) == [
        ("foreign_key:x,y", '{"x":1,"y":"b"}', 1)
    ]


def test_self_reference(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 7)], "id int, boss int")
    assert found(dq.reference_violations(df, "e", ["boss"], df, "e", ["id"])) == [
        ("foreign_key:boss", '{"boss":7}', 1)
    ]


def test_row_rules_share_one_scan_and_null_passes_checks(spark, tmp_path):
    rows = [(1, "abc", 5), (2, "abcdef  ", 300), (3, None, None), (4, "x1", -1)]
    spark.createDataFrame(rows, "id int, t string, n int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [
        dq.not_null("t"),
        dq.max_length("t", 5),
        dq.between("n", 0, 255),
        dq.check("letters", F.col("t").rlike("^[a-z ]+$")),
    ]
    got = dq.row_violations(df, "t", ["id"], rules)
    assert found(got) == [
        ("check:letters", '{"id":4}', 1),
        ("length:t", '{"id":2}', 1),
        ("not_null:t", '{"id":3}', 1),
        ("range:n", '{"id":2}', 1),
        ("range:n", '{"id":4}', 1),
    ]
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


JOBS = [(1, "new", 10, 10), (2, "chief", 200, 250)]


@pytest.mark.parametrize(
    "job, level, rule",
    [(1, 10, None), (1, 11, "first_job_level"), (2, 200, None), (2, 250, None),
     (2, 199, "job_level"), (2, 251, "job_level"), (2, None, None), (3, 5, None)],
)
def test_level_rule(spark, job, level, rule):
    jobs = PUBLISHING["jobs"].rows(spark, JOBS)
    staff = spark.createDataFrame([("PTC11962M", job, level)], "emp_id string, job_id short, job_lvl short")
    got = [r["rule"] for r in dq.level_violations(staff, jobs).collect()]
    assert got == ([rule] if rule else [])


def publishing(spark, dirty):
    jobs = PUBLISHING["jobs"].rows(spark, JOBS + ([(3, "x", 9, 251)] if dirty else []))
    publishers = PUBLISHING["publishers"].fill(
        spark.createDataFrame([("1389",), ("9952",)] + ([("9a52",)] if dirty else []), "pub_id string")
    )
    authors = [("409-56-7008", "B", "A", None), ("409-56-7009", "B", "A", "94705")]
    authors += [("409567008", "B", "A", "9470")] if dirty else []
    staff = [("PTC11962M", "P", "C", 2, 215), ("F-C16315M", "F", "C", 1, 10)]
    staff += [("PTC01962M", "P", "C", 2, 10)] if dirty else []
    return {
        "jobs": jobs,
        "publishers": publishers,
        "authors": PUBLISHING["authors"].fill(
            spark.createDataFrame(authors, "au_id string, au_lname string, au_fname string, zip string")
            .withColumn("contract", F.lit(True))
        ),
        "employee": PUBLISHING["employee"].fill(
            spark.createDataFrame(
                staff, "emp_id string, fname string, lname string, job_id int, job_lvl int"
            )
        ),
    }


def test_declared_rules_of_publishing(spark):
    assert found(dq.violations(publishing(spark, False), PUBLISHING)) == []
    got = dq.violations(publishing(spark, True), PUBLISHING)
    assert sorted(r for r, _, _ in found(got)) == [
        "check:au_id_pattern",
        "check:emp_id_pattern",
        "check:max_lvl_bound",
        "check:min_lvl_bound",
        "check:pub_id_known",
        "check:zip_pattern",
        "job_level",
    ]
    counts = {(r["table"], r["rule"]): r["violations"] for r in dq.rule_counts(got).collect()}
    assert counts[("jobs", "check:min_lvl_bound")] == 1


def test_defaults_of_an_employee(spark):
    got = PUBLISHING["employee"].fill(
        spark.createDataFrame([("PTC11962M", "P", "C", None)], "emp_id string, fname string, lname string, job_lvl int")
    ).first()
    assert (got["job_id"], got["job_lvl"], got["pub_id"]) == (1, None, "9952")
    assert got["hire_date"] is not None


def test_identity_columns_are_numbered_by_the_caller(spark):
    with pytest.raises(ValueError):
        PUBLISHING["jobs"].fill(spark.createDataFrame([("a", 10, 20)], "job_desc string, min_lvl int, max_lvl int"))


def test_identity_starts_at_one_in_the_stated_order(spark):
    given = spark.createDataFrame(
        [(20, "b", 10, 20), (10, "a", 10, 20), (30, "c", 10, 20)],
        "place int, job_desc string, min_lvl int, max_lvl int",
    )
    got = PUBLISHING["jobs"].fill(global_row_number(given, ["place"], "job_id")).orderBy("job_id")
    assert [(r["job_id"], r["job_desc"]) for r in got.collect()] == [(1, "a"), (2, "b"), (3, "c")]


def test_order_entry_rules_and_the_gate(spark):
    tables = order_fixture.tables(spark)
    got = dq.violations(tables, ORDER_ENTRY)
    assert found(got) == [("foreign_key:order_id", '{"order_id":999}', 1)]
    with pytest.raises(dq.BrokenRules, match="999"):
        dq.require_clean(got)
    clean = {**tables, "order_details": tables["order_details"].filter("order_id <> 999")}
    dq.require_clean(dq.violations(clean, ORDER_ENTRY))


def test_tables_without_rules_or_declaration_have_no_violations(spark):
    plain = {"plain": Table("plain", (text("a"),))}
    found = dq.violations({"plain": spark.createDataFrame([("x",)], "a string"), "other": spark.range(2)}, plain)
    assert found.count() == 0
    assert dq.violations({"other": spark.range(2)}, plain).columns == list(dq.COLUMNS)


def test_all_keys_of_a_table_come_from_one_scan(spark, tmp_path):
    declared = Table(
        "c",
        (whole("id"), whole("p"), whole("q")),
        key=("id",),
        references=(Reference(("p",), "parent", ("id",)), Reference(("q",), "parent", ("id",))),
    )
    rows = [(1, 1, 2), (1, 9, None), (2, 9, 8), (None, 1, 1)]
    spark.createDataFrame(rows, "id int, p int, q int").write.parquet(str(tmp_path / "c"))
    child, parent = spark.read.parquet(str(tmp_path / "c")), spark.createDataFrame([(1,), (2,)], "id int")
    parts = dq.table_violations(child, declared, {"c": child, "parent": parent})
    found = {(r.rule, r.key, r.n_rows) for part in parts[1:] for r in part.collect()}
    assert found == {
        ("primary_key", '{"id":1}', 2),
        ("primary_key", '{"id":null}', 1),
        ("foreign_key:p", '{"p":9}', 2),
        ("foreign_key:q", '{"q":8}', 1),
    }
