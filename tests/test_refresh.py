import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from starmill.operators.quality import BrokenRules
from starmill.plans import refresh, star
from starmill.schemas.order_entry import ORDER_ENTRY
from starmill.session import scratch_dir
from starmill.sinks import warehouse
from starmill.sinks.staging import stage
from starmill.sinks.warehouse import (
    create_database,
    create_tables,
    create_view,
    drop_tables,
    load_all,
    load_table,
    replace_table,
)
from starmill.sources.catalog import CatalogSource, describe_tables, list_tables
from starmill.sources.folders import (
    FolderSource,
    NothingStaged,
    list_staged,
    read_staged,
    table_name,
    table_name_column,
)
from starmill.sources.jdbc import JdbcSource, Split, base_tables_query
from starmill.storage import data_files_of, entries
from tests import order_fixture

AS_OF = dt.date(2021, 4, 15)


@pytest.fixture
def db(spark):
    root = scratch_dir(spark, "db")
    name = root.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, name, root)
    return name


def test_scratch_folder_follows_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_stage_then_load_keeps_rows_and_types(spark, db, tmp_path):
    df = order_fixture.tables(spark)["orders"]
    for _ in range(2):
        stage(df, str(tmp_path), "orders")
        load_table(spark, str(tmp_path), "orders", db)
    got = spark.table(f"{db}.orders")
    assert got.schema.simpleString() == df.schema.simpleString()
    assert sorted(got.collect(), key=str) == sorted(df.collect(), key=str)


def test_tables_without_rows_are_staged_and_loaded(spark, db, tmp_path):
    df = ORDER_ENTRY["customer_demographics"].empty(spark)
    stage(df, str(tmp_path), "customer_demographics")
    assert load_all(spark, str(tmp_path), db) == ["customer_demographics"]
    got = spark.table(f"{db}.customer_demographics")
    assert got.columns == df.columns and got.count() == 0


def test_only_datasets_of_the_format_are_listed(spark, tmp_path):
    with pytest.raises(NothingStaged):
        list_staged(spark, str(tmp_path / "none"))
    (tmp_path / "readme.txt").write_text("x")
    with pytest.raises(NothingStaged):
        list_staged(spark, str(tmp_path))
    stage(spark.range(3), str(tmp_path), "b")
    stage(spark.range(3), str(tmp_path), "a.b")
    stage(spark.range(3), str(tmp_path), "c", "orc")
    assert list_staged(spark, str(tmp_path)) == ["a.b", "b"]
    assert list_staged(spark, str(tmp_path), "orc") == ["c"]
    assert read_staged(spark, str(tmp_path), "c", "orc").count() == 3


def test_table_name_from_a_path(spark, tmp_path):
    assert table_name("bucket/folder/orders.avro", "avro") == "orders"
    assert table_name("orders.avro/", "avro") == "orders"
    stage(spark.range(3), str(tmp_path), "orders")
    df = FolderSource(spark, str(tmp_path)).read("orders")
    names = df.select(table_name_column(F.input_file_name(), "parquet")).distinct().collect()
    assert [r[0] for r in names] == ["orders"]


def test_replace_changes_rows_and_schema_even_when_reading_itself(spark, db):
    replace_table(spark.range(5), db, "t")
    replace_table(spark.table(f"{db}.t").select("id", (F.col("id") * 2).alias("twice")), db, "t")
    assert sorted(map(tuple, spark.table(f"{db}.t").collect())) == [(i, 2 * i) for i in range(5)]
    assert list_tables(spark, db) == ["t"]


def test_a_failed_replace_leaves_the_old_table(spark, db):
    replace_table(spark.range(5), db, "t")
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        replace_table(broken, db, "t")
    assert spark.table(f"{db}.t").count() == 5


def test_catalog_lists_tables_without_views(spark, db):
    create_tables(spark, db, ORDER_ENTRY)
    spark.sql(f"CREATE VIEW `{db}`.some_view AS SELECT 1 AS x")
    create_view(spark.range(1), "some_temporary_view")
    assert list_tables(spark, db) == sorted(ORDER_ENTRY)
    kinds = {
        (r["table_name"], r["table_type"])
        for r in describe_tables(spark).filter(F.col("table_schema") == db).collect()
    }
    assert ("some_view", "VIEW") in kinds and ("orders", "MANAGED") in kinds
    drop_tables(spark, db, ["orders", "never_there"])
    assert "orders" not in list_tables(spark, db)


def source_db(spark, db):
    for name, df in order_fixture.tables(spark).items():
        replace_table(df, db, name)
    return CatalogSource(spark, db)


@pytest.mark.parametrize("dates", ["date", "millis"])
def test_daily_run_twice(spark, db, tmp_path, dates):
    source = source_db(spark, db)
    raw, dw = f"{db}_raw", f"{db}_dw"
    for name in (raw, dw):
        create_database(spark, name, str(tmp_path / name))
    run = refresh.Run(str(tmp_path / "staging"), raw, dw, dates=dates, as_of=AS_OF, null_text="None")
    for _ in range(2):
        done = refresh.daily(spark, source, run)
    assert done["extracted"] == done["loaded"] == sorted(ORDER_ENTRY)
    assert list_tables(spark, dw) == sorted(star.MODELS)
    t = order_fixture.tables(spark)
    want = star.fact_table(t, as_of=AS_OF).orderBy("fact_id").collect()
    got = spark.table(f"{dw}.fact_table").orderBy("fact_id").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]
    assert spark.table(f"{dw}.dim_date").count() == (AS_OF - order_fixture.FIRST).days + 1
    assert spark.table(f"{dw}.dim_customers").filter("region = 'None'").count() == 20


def test_unstable_sources_are_read_once(spark, tmp_path):
    class Once:
        stable = False
        reads = 0

        def tables(self):
            return ["t"]

        def read(self, table):
            self.reads += 1
            return spark.sql("select rand() as x, '2020-01-01' as d")

    source = Once()
    refresh.extract(spark, source, refresh.Run(str(tmp_path / "s"), "raw", "dw"))
    assert source.reads == 1
    got = read_staged(spark, str(tmp_path / "s"), "t").first()
    assert got["d"] == dt.date(2020, 1, 1)


def test_landed_copies_are_removed(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    monkeypatch.setattr(refresh, "scratch_dir", lambda *_: str(landing))

    class Unstable:
        stable = False

        def tables(self):
            return ["t"]

        def read(self, table):
            return spark.range(3)

    refresh.extract(spark, Unstable(), refresh.Run(str(tmp_path / "s"), "raw", "dw"))
    assert not landing.exists()
    assert list_staged(spark, str(tmp_path / "s")) == ["t"]


def test_broken_rules_stop_the_run_before_the_models(spark, db, tmp_path):
    source = source_db(spark, db)
    raw, dw = f"{db}_raw", f"{db}_dw"
    for name in (raw, dw):
        create_database(spark, name, str(tmp_path / name))
    run = refresh.Run(str(tmp_path / "s"), raw, dw, as_of=AS_OF, rules=ORDER_ENTRY)
    with pytest.raises(BrokenRules, match="999"):
        refresh.daily(spark, source, run)
    assert list_tables(spark, dw) == []
    details = spark.table(f"{db}.order_details").filter("order_id <> 999")
    replace_table(details, db, "order_details")
    refresh.daily(spark, source, run)
    assert list_tables(spark, dw) == sorted(star.MODELS)


def test_a_failing_table_stops_the_run(spark, tmp_path):
    class Broken:
        stable = True

        def tables(self):
            return ["t"]

        def read(self, table):
            raise RuntimeError("gone")

    with pytest.raises(RuntimeError, match="gone"):
        refresh.extract(spark, Broken(), refresh.Run(str(tmp_path / "s"), "raw", "dw"))


def test_jdbc_statements_and_options(spark):
    """The statements only: these tests start no database."""
    assert base_tables_query("it's") == (
        "select table_name from information_schema.tables "
        "where table_schema = 'it''s' and table_type = 'BASE TABLE'"
    )
    source = JdbcSource(spark, {"url": "jdbc:x"}, splits={"orders": Split("order_id", 64)})
    assert source.range_options("orders", source.splits["orders"], 1, 900) == {
        "dbtable": '"public"."orders"',
        "partitionColumn": '"order_id"',
        "lowerBound": "1",
        "upperBound": "900",
        "numPartitions": "64",
    }
    assert not source.stable
    odd = JdbcSource(spark, {"url": "jdbc:x"}, "My", splits={'a"b': Split("Order")})
    assert odd.bounds_query('a"b', odd.split('a"b')) == 'select min("Order") as low, max("Order") as high from "My"."a""b"'
    with pytest.raises(ValueError, match="no split"):
        source.read("customers")


@pytest.mark.parametrize("step", ["_renamed", "_point"])
def test_a_plain_table_is_there_after_a_failed_step(spark, db, monkeypatch, step):
    """The first replacement of a plain table renames it away, and back if the rename or what follows fails."""
    spark.range(5).write.saveAsTable(f"{db}.t")
    plain, calls = getattr(warehouse, step), []

    def failing(*args):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("no step")
        plain(*args)

    monkeypatch.setattr(warehouse, step, failing)
    with pytest.raises(RuntimeError):
        replace_table(spark.range(9), db, "t")
    monkeypatch.undo()
    assert spark.table(f"{db}.t").count() == 5
    assert [t.name for t in spark.catalog.listTables(db) if not t.isTemporary] == ["t"]
    assert data_files_of(spark, warehouse.versions_folder(spark, db, "t")) == []
    replace_table(spark.range(9), db, "t")
    assert spark.table(f"{db}.t").count() == 9 and list_tables(spark, db) == ["t"]


def test_a_failed_change_of_the_catalog_leaves_the_version_before(spark, db, monkeypatch):
    replace_table(spark.range(5), db, "t")

    def failing(*_):
        raise RuntimeError("no change")

    monkeypatch.setattr(warehouse, "_point", failing)
    with pytest.raises(RuntimeError):
        replace_table(spark.range(9), db, "t")
    monkeypatch.undo()
    assert spark.table(f"{db}.t").count() == 5
    assert len(entries(spark, warehouse.versions_folder(spark, db, "t"))) == 1


def test_a_swap_that_a_lost_driver_left_is_undone(spark, db):
    spark.range(5).write.saveAsTable(f"{db}.t__old_1")
    spark.range(9).write.saveAsTable(f"{db}.t__new_1")
    assert list_tables(spark, db) == []
    warehouse.clear_leftovers(spark, db, "t")
    assert list_tables(spark, db) == ["t"] and spark.table(f"{db}.t").count() == 5


def test_a_failed_write_leaves_no_folder(spark, db):
    broken = spark.range(5).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception):
        replace_table(broken, db, "u")
    replace_table(spark.range(3), db, "u")
    assert list_tables(spark, db) == ["u"]


def test_a_dropped_database_is_gone(spark, db):
    replace_table(spark.range(5), db, "t")
    warehouse.drop_database(spark, db)
    assert not spark.catalog.databaseExists(db)


def test_queued_work_is_not_run_after_a_failure(spark):
    ran = []

    def work(name):
        ran.append(name)
        if name == "a":
            raise RuntimeError("no")
        time.sleep(0.3)

    with pytest.raises(RuntimeError):
        refresh._each(spark, work, "abcdefgh", 1)
    assert len(ran) < 8
