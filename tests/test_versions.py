"""Replaced tables, staged runs and declared tables: what readers see, and what failures leave."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F, types as T

from starmill.plans import refresh
from starmill.schemas.order_entry import ORDER_ENTRY
from starmill.schemas.publishing import PUBLISHING
from starmill.schemas.records import record_document, record_rows, schema_drift
from starmill.schemas.tables import NOW, Field, Table, code, text, whole
from starmill.session import scratch_dir
from starmill.sinks import warehouse
from starmill.sinks.staging import stage
from starmill.sinks.warehouse import (
    create_database,
    create_statement,
    create_stored_view,
    create_tables,
    drop_table,
    drop_tables,
    insert_rows,
    load_table,
    replace_table,
)
from starmill.sources.catalog import CatalogSource, describe_columns, list_tables, published_version, table_properties
from starmill.sources.folders import (
    AmbiguousDataset,
    NothingStaged,
    find_staged,
    inspect,
    list_staged,
    read_staged,
    staged,
)
from starmill.sources.manifest import FOLDER, IncompleteDataset, published
from starmill.storage import data_files_of, entries, exists, publish_text, read_text, remove_folder


@pytest.fixture
def db(spark):
    root = scratch_dir(spark, "versions")
    name = root.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, name, root)
    return name


def broken(spark, n=5):
    return spark.range(n).select(F.coalesce(F.raise_error(F.lit("no")).cast("long"), F.col("id")).alias("id"))


# -- replaced tables -----------------------------------------------------------------------


def test_numbers_in_order_take_few_bytes(spark, db):
    """Staged and replaced tables hold 200,000 consecutive numbers in far less than a byte each, and odd values come back."""
    odd = [(1, None, None), (-(2**63), "", 0.5), (2**63 - 1, "å" * 300, float("nan")), (None, "x", -0.0)]
    rows = spark.createDataFrame(odd, "id long, t string, x double")
    for n, df in {"many": spark.range(0, 200_000, 1, 1), "odd": rows.coalesce(1)}.items():
        replace_table(df, db, n)
        stage(df, f"{scratch_dir(spark, 'packed')}", n)
    folder = f"{warehouse.versions_folder(spark, db, 'many')}"
    sizes = [y.size for x in entries(spark, folder) for y in entries(spark, x.path) if not y.hidden]
    assert 0 < sum(sizes) < 50_000
    assert spark.table(f"{db}.many").distinct().count() == 200_000
    assert sorted(map(str, spark.table(f"{db}.odd").collect())) == sorted(map(str, rows.collect()))


def test_a_polling_reader_sees_whole_versions_only(spark, db):
    """Versions differ in rows and columns; at no time is the table missing or a mix of two."""
    versions = [spark.range(100 * (i + 1)).select("id", *[F.lit(i).alias(f"c{j}") for j in range(i)]) for i in range(4)]
    whole = {(i + 1, 100 * (i + 1)) for i in range(4)}
    replace_table(versions[0], db, "t")
    done, seen = threading.Event(), []

    def poll():
        while not done.is_set():
            try:
                shown = spark.table(f"{db}.t")
                seen.append((len(shown.columns), shown.count()))
            except Exception as e:
                seen.append(str(e))

    readers = [threading.Thread(target=poll) for _ in range(3)]
    for r in readers:
        r.start()
    for v in versions[1:]:
        replace_table(v, db, "t", keep=3)
    done.set()
    for r in readers:
        r.join()
    assert seen and set(seen) <= whole


def test_a_reader_of_the_version_before_goes_on(spark, db):
    replace_table(spark.range(5), db, "t")
    held = spark.table(f"{db}.t")
    replace_table(spark.range(7).withColumn("x", F.lit(1)), db, "t")
    assert held.count() == 5 and spark.table(f"{db}.t").count() == 7
    folder = warehouse.versions_folder(spark, db, "t")
    for i in range(3):
        replace_table(spark.range(i), db, "t")
        assert len(entries(spark, folder)) == 2
    replace_table(spark.range(1), db, "t", keep=0)
    assert [x.path for x in entries(spark, folder)] == [published_version(spark, db, "t")]


def test_what_a_lost_driver_wrote_goes_and_the_version_before_stays(spark, db):
    for n in (5, 6):
        replace_table(spark.range(n), db, "t")
    folder = warehouse.versions_folder(spark, db, "t")
    kept = published_version(spark, db, "t")
    spark.range(99).write.parquet(f"{folder}/99999999999999999999-lost")
    replace_table(spark.range(7), db, "t")
    assert {x.path for x in entries(spark, folder)} == {kept, published_version(spark, db, "t")}


def test_a_version_with_other_rows_than_announced_is_not_published(spark, db):
    replace_table(spark.range(5), db, "t", rows=5)
    with pytest.raises(IncompleteDataset, match="4 rows instead of 5"):
        replace_table(spark.range(4), db, "t", rows=5)
    assert spark.table(f"{db}.t").count() == 5


def test_filters_and_columns_reach_the_files_of_a_replaced_table(spark, db):
    replace_table(spark.range(50).withColumn("x", F.col("id") * 2), db, "t")
    plan = spark.table(f"{db}.t").filter("id > 40").select("x")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,40)]" in plan and "ReadSchema: struct<id:bigint,x:bigint>" in plan


def test_other_sessions_see_the_new_version(spark, db):
    replace_table(spark.range(5), db, "t")
    other = spark.newSession()
    assert other.table(f"{db}.t").count() == 5
    replace_table(spark.range(6).withColumn("x", F.lit(1)), db, "t")
    assert other.table(f"{db}.t").columns == ["id", "x"] and other.table(f"{db}.t").count() == 6


def test_odd_names_and_comments(spark, db):
    df = spark.range(3).select(F.col("id").alias("it's", metadata={"comment": "a 'quoted' \\ one"}))
    replace_table(df, db, "odd_name", doc="it's a \\ doc")
    row = describe_columns(spark, db).first()
    assert (row.column_name, row.column_comment, row.table_comment) == ("it's", "a 'quoted' \\ one", "it's a \\ doc")


def test_dropped_tables_leave_no_files(spark, db):
    replace_table(spark.range(5), db, "t")
    folder = warehouse.versions_folder(spark, db, "t")
    drop_table(spark, db, "t")
    assert not exists(spark, folder) and list_tables(spark, db) == []
    drop_tables(spark, db, ["t", "never_there"])


# -- staging -------------------------------------------------------------------------------


def test_a_failed_run_leaves_what_was_staged(spark, tmp_path):
    root = str(tmp_path)
    path = stage(spark.range(5), root, "t")
    with pytest.raises(Exception):
        stage(broken(spark), root, "t")
    assert read_staged(spark, root, "t").count() == 5 and list_staged(spark, root) == ["t"]
    assert len(entries(spark, path)) == 2
    with pytest.raises(Exception):
        stage(broken(spark), root, "first")
    assert list_staged(spark, root) == ["t"]
    assert [(x.table, x.state) for x in inspect(spark, root)] == [("first", "unfinished"), ("t", "complete")]


def test_a_run_that_a_lost_driver_left_is_not_read(spark, tmp_path):
    """Files without a manifest, a manifest that was cut off, and later a run that is complete again."""
    root = str(tmp_path)
    path = stage(spark.range(5), root, "t")
    spark.range(9).write.parquet(f"{path}/99999999999999999998-lost")
    publish_text(spark, f"{path}/{FOLDER}/99999999999999999999-cut.json", '{"run": "9999')
    assert read_staged(spark, root, "t").count() == 5
    stage(spark.range(6), root, "t", keep=0)
    assert read_staged(spark, root, "t").count() == 6 and len(published(spark, path)) == 1
    assert {x.name for x in entries(spark, path)} == {FOLDER, published(spark, path)[0].run}


def test_a_reader_of_the_run_before_goes_on(spark, tmp_path):
    root = str(tmp_path)
    stage(spark.range(5), root, "t")
    held = read_staged(spark, root, "t")
    stage(spark.range(6).withColumn("x", F.lit(1)), root, "t")
    assert held.count() == 5 and read_staged(spark, root, "t").columns == ["id", "x"]


@pytest.mark.parametrize("damage", ["less", "more", "other"])
def test_damaged_datasets_are_broken(spark, db, tmp_path, damage):
    root = str(tmp_path)
    path = stage(spark.range(50).repartition(3), root, "t")
    stage(spark.range(2), root, "fine")
    files = data_files_of(spark, path)
    if damage == "less":
        remove_folder(spark, files[0])
    elif damage == "more":
        publish_text(spark, f"{path}/{published(spark, path)[0].run}/part-9.parquet", "x")
    else:
        remove_folder(spark, files[0])
        publish_text(spark, files[0], "x")
    assert {x.table: x.state for x in inspect(spark, root)} == {"fine": "complete", "t": "broken"}
    assert list_staged(spark, root) == ["fine"]
    with pytest.raises(IncompleteDataset):
        read_staged(spark, root, "t")
    with pytest.raises(IncompleteDataset):
        load_table(spark, root, "t", db)
    assert list_tables(spark, db) == []


def test_rows_that_are_fewer_than_the_manifest_says_are_not_loaded(spark, db, tmp_path):
    path = stage(spark.range(5), str(tmp_path), "t")
    manifest = published(spark, path)[0]
    changed = manifest.text().replace('"rows": 5', '"rows": 6')
    remove_folder(spark, f"{path}/{FOLDER}/{manifest.run}.json")
    publish_text(spark, f"{path}/{FOLDER}/{manifest.run}.json", changed)
    with pytest.raises(IncompleteDataset, match="5 rows instead of 6"):
        load_table(spark, str(tmp_path), "t", db)
    assert list_tables(spark, db) == []


def test_datasets_at_any_depth(spark, tmp_path):
    root = str(tmp_path)
    stage(spark.range(1), f"{root}/2024/01", "deep")
    spark.range(2).write.parquet(f"{root}/plain.parquet")
    spark.range(2).write.orc(f"{root}/other.orc")
    (tmp_path / "_hidden").mkdir()
    spark.range(2).write.parquet(f"{root}/_hidden/x.parquet")
    assert sorted(staged(spark, root)) == ["deep", "plain"]
    assert read_staged(spark, root, "deep").count() == 1
    with pytest.raises(NothingStaged):
        read_staged(spark, root, "nowhere")
    stage(spark.range(1), f"{root}/2024/02", "deep")
    with pytest.raises(AmbiguousDataset):
        list_staged(spark, root)


def test_staging_over_files_of_others_replaces_them(spark, tmp_path):
    spark.range(9).write.parquet(str(tmp_path / "t.parquet"))
    path = stage(spark.range(5), str(tmp_path), "t")
    assert read_staged(spark, str(tmp_path), "t").count() == 5
    assert [x.name for x in entries(spark, path) if not x.is_folder] == []


def test_manifests_keep_the_schema(spark, tmp_path):
    """Comments and whether a column had missing values come back, rows and files are listed."""
    df = spark.range(4).select(
        F.col("id").alias("id", metadata={"comment": "the key"}),
        F.when(F.col("id") > 1, F.col("id")).alias("some"),
        F.lit("x").alias("unseen"),
    )
    path = stage(df, str(tmp_path), "t", observe=["id", "some"], namespace="n", doc="d")
    manifest = published(spark, path)[0]
    assert manifest.rows == 4 and sum(manifest.files.values()) > 0
    schema = read_staged(spark, str(tmp_path), "t").schema
    assert [f.metadata.get("nullable") for f in schema] == [False, True, None]
    assert schema["id"].metadata["comment"] == "the key"
    assert manifest.record["fields"][0] == {"name": "id", "type": "long", "doc": "the key"}
    assert (manifest.record["namespace"], manifest.record["doc"]) == ("n", "d")


def test_small_files_are_whole_or_absent(spark, tmp_path):
    publish_text(spark, str(tmp_path / "a" / "x"), "grün")
    assert read_text(spark, str(tmp_path / "a" / "x")) == "grün"
    assert entries(spark, str(tmp_path / "none")) == []


# -- one read of a table -------------------------------------------------------------------


class Counted:
    """A source whose rows count themselves when they are read."""

    stable = True

    def __init__(self, spark, df):
        self.rows = spark.sparkContext.accumulator(0)
        rows = self.rows

        @F.udf("long")
        def seen(x):
            rows.add(1)
            return x

        self.df = df.withColumn("id", seen.asNondeterministic()("id"))

    def tables(self):
        return ["t"]

    def read(self, table):
        return self.df


def test_a_table_without_texts_and_times_is_read_once(spark, tmp_path):
    df = spark.range(100).select(
        "id",
        F.when(F.col("id") > 9, F.col("id") / 2).otherwise(F.lit(float("nan"))).alias("ratio"),
        F.lit(dt.date(2020, 1, 1)).alias("day"),
        (F.col("id") > 5).alias("flag"),
    )
    source = Counted(spark, df)
    refresh.extract(spark, source, refresh.Run(str(tmp_path), "raw", "dw"))
    assert source.rows.value == 100
    schema = read_staged(spark, str(tmp_path), "t").schema
    assert {f.name: f.metadata["nullable"] for f in schema} == {"id": False, "ratio": True, "day": False, "flag": True}
    assert schema["day"].metadata["logical_type"] == "date"


def test_only_texts_and_times_are_profiled_ahead(spark, tmp_path, monkeypatch):
    profiled = []
    plain = refresh.column_profiles

    def profiles(df):
        profiled.append(df.columns)
        return plain(df)

    monkeypatch.setattr(refresh, "column_profiles", profiles)
    df = spark.range(9).select("id", F.lit("2020-01-01").alias("d"), F.current_timestamp().alias("ts"), F.lit(1.5).alias("x"))

    class Source:
        stable = True

        def tables(self):
            return ["t"]

        def read(self, table):
            return df

    refresh.extract(spark, Source(), refresh.Run(str(tmp_path), "raw", "dw"))
    assert profiled == [["d", "ts"]]
    schema = read_staged(spark, str(tmp_path), "t").schema
    assert schema.simpleString() == "struct<id:bigint,d:date,ts:timestamp_ntz,x:double>"


def test_tables_are_in_pools_of_their_own(spark):
    """Jobs side by side share the executors: a small table does not wait for all tasks of a large one."""
    assert spark.conf.get("spark.scheduler.mode") == "FAIR"
    pools, ended = {}, []

    def sleepy(name):
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        n = 64 if name == "large" else 1
        if name == "small":
            begun.wait()
        begun.set()

        @F.udf("long")
        def rest(x):
            import time

            time.sleep(0.15)
            return x

        spark.range(0, n, 1, n).select(rest("id")).collect()
        ended.append(name)

    begun = threading.Event()
    refresh._each(spark, sleepy, ["large", "small"], 2)
    assert pools == {"large": "large", "small": "small"} and ended == ["small", "large"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


# -- declared tables -----------------------------------------------------------------------


def test_statements_of_declared_tables():
    table = Table(
        "t",
        (
            whole("n", True, default=7),
            code("c", 2, default="it's"),
            text("v", 9, True),
            text("free"),
            Field("at", T.TimestampNTZType(), default=NOW),
        ),
        key=("n",),
    )
    assert create_statement("d", table) == (
        "CREATE TABLE `d`.`t` (`n` INT NOT NULL DEFAULT 7, `c` CHAR(2) DEFAULT 'it\\'s', `v` VARCHAR(9) NOT NULL, "
        "`free` STRING, `at` TIMESTAMP_NTZ DEFAULT current_timestamp()) USING parquet "
        "TBLPROPERTIES ('starmill.key' = 'n', 'starmill.required' = 'n,v')"
    )


def test_all_declared_tables_can_be_created(spark, db):
    create_tables(spark, db, PUBLISHING)
    create_tables(spark, db, ORDER_ENTRY)
    assert set(list_tables(spark, db)) == {*PUBLISHING, *ORDER_ENTRY}
    declared = {(r.table_name, r.column_name): r for r in describe_columns(spark, db).collect()}
    for table in [*PUBLISHING.values(), *ORDER_ENTRY.values()]:
        for f in table.fields:
            row = declared[table.name, f.name]
            assert row.data_type == warehouse.column_type(f).lower() and row.nullable == (not f.required)
            assert (row.column_default is not None) == f.has_default
    assert table_properties(spark, db, "sales")["starmill.key"] == "stor_id,ord_num,title_id"


def test_inserted_rows_take_defaults_and_keep_nulls(spark, db):
    jobs = PUBLISHING["jobs"]
    create_tables(spark, db, {"jobs": jobs})
    rows = spark.createDataFrame([(1, 10, 20), (2, 30, 40)], "job_id int, min_lvl int, max_lvl int")
    insert_rows(rows, db, jobs)
    insert_rows(rows.selectExpr("job_id + 2 as job_id", "'chief' as job_desc", "min_lvl", "max_lvl"), db, jobs)
    found = {r.job_id: r.job_desc for r in spark.table(f"{db}.jobs").collect()}
    assert found[1] == "New Position - title not formalized yet" and found[3] == "chief" and len(found) == 4


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("au_lname", F.when(F.col("au_id") < "4", F.col("au_lname"))),
        lambda df: df.withColumn("state", F.lit("CAL")),
        lambda df: df.withColumn("au_lname", F.lit("x" * 41)),
        lambda df: df.drop("au_fname"),
        lambda df: df.withColumn("more", F.lit(1)),
    ],
)
def test_refused_rows_change_nothing(spark, db, change):
    authors = PUBLISHING["authors"]
    create_tables(spark, db, {"authors": authors})
    rows = [(f"{i}09-56-7008", "Bennet", "Abraham", True) for i in range(1, 9)]
    good = spark.createDataFrame(rows, "au_id string, au_lname string, au_fname string, contract boolean")
    insert_rows(good, db, authors)
    with pytest.raises(Exception):
        insert_rows(change(good), db, authors)
    assert spark.table(f"{db}.authors").count() == 8


def test_blanks_of_fixed_length_do_not_count(spark, db):
    stores = PUBLISHING["stores"]
    create_tables(spark, db, {"stores": stores})
    insert_rows(spark.createDataFrame([("70", "Barnum's ")], "stor_id string, stor_name string"), db, stores)
    assert spark.table(f"{db}.stores").filter("stor_id = '70'").count() == 1
    row = CatalogSource(spark, db).read("stores").first()
    assert (row.stor_id, row.stor_name, row.zip) == ("70", "Barnum's ", None)


# -- views and records ---------------------------------------------------------------------


def test_a_stored_view_follows_its_tables(spark, db):
    replace_table(spark.range(5), db, "t")
    create_stored_view(spark, db, "v", f"SELECT id FROM {db}.t WHERE id > 1", "some")
    assert spark.newSession().table(f"{db}.v").count() == 3
    replace_table(spark.range(9).withColumn("x", F.lit("y")), db, "t")
    assert spark.newSession().table(f"{db}.v").count() == 7
    create_stored_view(spark, db, "v", f"SELECT id, x FROM {db}.t")
    assert spark.newSession().table(f"{db}.v").columns == ["id", "x"]
    with pytest.raises(Exception):
        create_stored_view(spark, db, "v", f"SELECT nothing FROM {db}.t")
    assert spark.table(f"{db}.v").count() == 9 and list_tables(spark, db) == ["t"]


def test_record_documents(spark):
    schema = T.StructType(
        [
            T.StructField("a", T.LongType(), metadata={"nullable": False}),
            T.StructField("b", T.LongType(), metadata={"nullable": True, "logical_type": "timestamp"}),
            T.StructField("c", T.DateType(), metadata={"comment": "a day"}),
            T.StructField("d", T.StringType(), metadata={"nullable": False, "logical_type": "duration"}),
            T.StructField("e", T.DecimalType(19, 4)),
            T.StructField("f", T.BooleanType()),
        ]
    )
    d = record_document(schema, "t", "n", "doc")
    assert {k: d[k] for k in ("type", "name", "namespace", "doc")} == {"type": "record", "name": "t", "namespace": "n", "doc": "doc"}
    assert d["fields"] == [
        {"name": "a", "type": "long"},
        {"name": "b", "type": ["null", {"type": "long", "logicalType": "timestamp-millis"}]},
        {"name": "c", "type": ["null", {"type": "int", "logicalType": "date"}], "doc": "a day"},
        {"name": "d", "type": {"type": "string", "logicalType": "duration"}},
        {"name": "e", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 19, "scale": 4}]},
        {"name": "f", "type": ["null", "boolean"]},
    ]
    rows = record_rows(spark, [d]).orderBy("position").collect()
    assert [(r.type, r.logical_type, r.nullable) for r in rows][4] == ("decimal(19,4)", "decimal", True)
    assert schema_drift(record_rows(spark, [d]), record_rows(spark, [d])).count() == 0
    other = record_document(T.StructType([T.StructField("a", T.LongType(), metadata={"nullable": True})]), "t")
    changes = {r.column: r.change for r in schema_drift(record_rows(spark, [other]), record_rows(spark, [d])).collect()}
    assert changes == {"a": "always there", **{x: "added" for x in "bcdef"}}
    assert record_rows(spark, []).count() == 0


def test_the_daily_run_names_its_records(spark, db, tmp_path):
    class Source:
        stable = True

        def tables(self):
            return ["t"]

        def read(self, table):
            return spark.range(3).withColumn("day", F.lit("2020-02-03"))

    run = refresh.Run(str(tmp_path), db, db, namespace="night", doc="orders of the day")
    refresh.extract(spark, Source(), run)
    refresh.load(spark, run)
    found = describe_columns(spark, db).collect()
    assert {r.table_comment for r in found} == {"night.t: orders of the day"}
    record = find_staged(spark, str(tmp_path), "t").manifest.record
    assert record["fields"][1] == {"name": "day", "type": {"type": "int", "logicalType": "date"}}
