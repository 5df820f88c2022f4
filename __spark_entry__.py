
from __future__ import annotations

import logging
import sys
import threading
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

import sample_tables as sample  # noqa: E402
from starmill.functions.dates import (  # noqa: E402
    day_from_millis,
    day_of,
    iso_duration,
    millis,
    month_first,
    time_text,
    timestamp_from_millis,
)
from starmill.functions.text import like_class  # noqa: E402
from starmill.operators import quality as dq  # noqa: E402
from starmill.operators.numbering import global_row_number  # noqa: E402
from starmill.operators.profile import column_profiles, normalise, profile, staged_schema  # noqa: E402
from starmill.plans import refresh, reports, star  # noqa: E402
from starmill.schemas.order_entry import ORDER_ENTRY  # noqa: E402
from starmill.schemas.publishing import PUBLISHING  # noqa: E402
from starmill.schemas.records import record_rows, schema_drift  # noqa: E402
from starmill.session import scratch_dir  # noqa: E402
from starmill.sinks.staging import stage  # noqa: E402
from starmill.sinks.warehouse import (  # noqa: E402
    create_database,
    create_stored_view,
    create_tables,
    drop_database,
    drop_tables,
    insert_rows,
    load_table,
    replace_table,
)
from starmill.sources.catalog import CatalogSource, describe_columns, list_tables  # noqa: E402
from starmill.sources.folders import (  # noqa: E402
    FolderSource,
    NothingStaged,
    dataset_path,
    find_staged,
    inspect,
    list_staged,
    table_name_column,
)
from starmill.sources.jdbc import equal_depth  # noqa: E402
from starmill.storage import data_files_of, remove_folder  # noqa: E402

log = logging.getLogger(__name__)

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return fact_table(spark, "/root/testdata/sf0.001")


# -- star schema ---------------------------------------------------------------------------


def dim_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_suppliers(sample.order_entry(spark, sf_dir))


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_products(sample.order_entry(spark, sf_dir))


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_customers(sample.order_entry(spark, sf_dir))


def dim_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_employees(sample.order_entry(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(sample.order_entry(spark, sf_dir), as_of=sample.AS_OF)


def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sample.order_entry(spark, sf_dir)
    return star.fact_table(tables, as_of=sample.AS_OF, line_key=sample.LINE_KEY)


def fact_table_role_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with its date ids joined from the calendar table, once per role."""
    tables = sample.order_entry(spark, sf_dir)
    dates = star.dim_date(tables, as_of=sample.AS_OF)
    return star.fact_table(tables, dates=dates, line_key=sample.LINE_KEY)


def order_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sample.order_entry(spark, sf_dir)["order_details"].select(*sample.LINE_KEY)
    return global_row_number(lines, sample.LINE_KEY, "fact_id").select(
        "fact_id", "order_id", "product_id", "supplier_id", "line_number"
    )


def identity_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An identity column over a stated order, here text first."""
    customers = sample.read(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey", "c_name")
    return global_row_number(customers, ["c_mktsegment", "c_custkey"], "customer_no")


# -- reports -------------------------------------------------------------------------------


def titleview(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = reports.titleview(sample.publishing(spark, sf_dir))
    return view.withColumn("price", F.col("price").cast("double"))


def byroyalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.byroyalty(sample.publishing(spark, sf_dir), 40)


def reptq1(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.reptq1(sample.publishing(spark, sf_dir))
    return report.withColumn("avg_price", F.col("avg_price").cast("double"))


def reptq2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.reptq2(sample.publishing(spark, sf_dir))


def reptq3(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sample.publishing(spark, sf_dir)
    return reports.reptq3(tables, "910", "950.5", "ECONOMY", always="%PROMO%")


def reptq1_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the first report with their places: it is sorted by its label."""
    report = reports.reptq1(sample.publishing(spark, sf_dir)).coalesce(1)
    return report.select("pub_id", (F.monotonically_increasing_id() + 1).alias("place"))


def calendar_to_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar without a last day ends today: its days less those that there should be."""
    tables = sample.order_entry(spark, sf_dir)
    first = tables["orders"].agg(F.min("order_date").alias("first"))
    found = star.dim_date(tables).agg(F.min("date").alias("low"), F.max("date").alias("high"), F.count("date").alias("n"))
    wanted = F.date_diff(F.current_date(), F.col("low")) + 1
    return found.select(
        "low",
        (F.col("low") == first.scalar()).alias("begins_with_orders"),
        F.date_diff(F.current_date(), F.col("high")).alias("days_short"),
        (F.col("n") - wanted).alias("days_too_many"),
    )


# -- profile and casts ---------------------------------------------------------------------


def _events_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a text export would hold them: times, days and month-first days as text."""
    ts = F.col("ts")
    return sample.read(spark, sf_dir, "events").select(
        "event_id",
        ts.cast("string").alias("ts"),
        F.date_format(ts, "yyyy-MM-dd").alias("iso_day"),
        F.date_format(ts, "M/d/yy").alias("us_day"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") > 5, F.col("value")).otherwise(F.lit(float("nan"))).alias("value"),
        F.col("user_id").cast("string").alias("user_text"),
    )


def profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(_events_as_text(spark, sf_dir))


def profile_written_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in further written forms, and with blanks among them."""
    ts = F.col("ts")
    forms = {"day_name": "d-MMM-yyyy", "month_name": "MMMM d, yyyy", "short_iso": "yyyy-M-d", "slashed": "yyyy/M/d"}
    written = [F.date_format(ts, form).alias(name) for name, form in forms.items()]
    blank = F.when(F.col("event_id") % 5 == 0, F.lit(" ")).otherwise(F.date_format(ts, "yyyy-MM-dd"))
    return profile(
        sample.read(spark, sf_dir, "events").select(*written, blank.alias("with_blanks"), F.lit("").alias("only_blanks"))
    )


def profile_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A boolean is nullable even where none is missing."""
    customers = sample.read(spark, sf_dir, "customer")
    return profile(customers.select((F.col("c_acctbal") > 0).alias("in_credit"), "c_custkey"))


def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of time, a day longer for each line of an order, as ISO text."""
    since = F.make_dt_interval(F.lit(1), F.lit(2), F.lit(3), F.lit(4.5)) + F.make_dt_interval(F.col("l_linenumber"))
    return sample.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", iso_duration(since).alias("lasted")
    )


def profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(sample.read(spark, sf_dir, "orders"))


def profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(sample.read(spark, sf_dir, "documents"))


def normalise_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text dates become dates and times, NaN becomes NULL, a missing text becomes a word."""
    events = _events_as_text(spark, sf_dir)
    dated = normalise(events, column_profiles(events), null_text="None")
    return dated.withColumn("ts", millis(F.col("ts"), dated.schema["ts"].dataType))


def staged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as they are staged: every date and time in epoch milliseconds."""
    events = _events_as_text(spark, sf_dir)
    return normalise(events, column_profiles(events), dates="millis")


def times_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.read(spark, sf_dir, "events").select(
        "event_id", time_text(F.col("ts")).alias("written"), F.floor("value").cast("int").alias("whole")
    )


def epoch_millis_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.order_entry(spark, sf_dir)["orders"]
    sent = orders.select(
        "order_id",
        millis(F.col("order_date"), orders.schema["order_date"].dataType).alias("order_millis"),
        millis(F.col("shipped_date"), orders.schema["shipped_date"].dataType).alias("ship_millis"),
    )
    return sent.select(
        "*",
        day_from_millis(F.col("order_millis")).alias("order_day"),
        F.unix_millis(timestamp_from_millis(F.col("order_millis"))).alias("millis_of_time"),
        day_from_millis(F.col("ship_millis")).alias("ship_day"),
    )


def month_first_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.read(spark, sf_dir, "orders")
    text = orders.select("o_orderkey", F.date_format("o_orderdate", "MM/dd/yy").alias("written"))
    return text.withColumn("parsed", F.to_date(month_first(F.col("written"))))


# -- sources and sinks ---------------------------------------------------------------------


def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per dataset of the source folder, named by the file each row comes from."""
    source = FolderSource(spark, sf_dir)
    paths = [source.read(n).select(F.col("_metadata.file_path")) for n in source.tables()]
    files = reduce(DataFrame.unionByName, paths).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    name = table_name_column(F.col("file_path"), source.fmt)
    return files.groupBy(name.alias("table_name")).agg(F.sum("n_rows").alias("n_rows"))


# The scratch database that each query made last. A result reads it until the query is asked for again.
_MADE: dict[str, str] = {}


def _database(spark: SparkSession, label: str) -> tuple[str, str]:
    if label in _MADE:
        drop_database(spark, _MADE[label])
    root = scratch_dir(spark, label)
    db = _MADE[label] = root.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, db, f"{root}/warehouse")
    return root, db


def load_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages the orders, loads them twice, and reads the table: the rows are there once."""
    root, db = _database(spark, "load_truncate")
    orders = sample.read(spark, sf_dir, "orders")
    staged = normalise(orders, column_profiles(orders), dates="millis")
    stage(staged, f"{root}/staging", "orders")
    for _ in range(2):
        load_table(spark, f"{root}/staging", "orders", db)
    return spark.table(f"{db}.orders")


def loaded_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the staged record schema said of each column, read back from the loaded table."""
    root, db = _database(spark, "loaded_schema")
    events = _events_as_text(spark, sf_dir)
    stage(normalise(events, column_profiles(events), dates="millis"), f"{root}/staging", "events")
    load_table(spark, f"{root}/staging", "events", db)
    rows = staged_schema(spark.table(f"{db}.events"), "events")
    return spark.createDataFrame(rows, "table string, column string, nullable boolean, logical_type string")


def replace_own_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Builds a dimension as a table, then replaces the table by a selection of itself."""
    _, db = _database(spark, "replace_own_table")
    replace_table(star.dim_customers(sample.order_entry(spark, sf_dir)), db, "dim_customers")
    old = spark.table(f"{db}.dim_customers")
    replace_table(old.filter(F.col("region").isNotNull()).drop("city"), db, "dim_customers")
    return spark.table(f"{db}.dim_customers")


def _daily(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, str]:
    """Two daily runs over a source database that also holds an empty table and a view."""
    root, source = _database(spark, f"{label}_source")
    tables = sample.order_entry(spark, sf_dir)
    for name in tables.builders:
        replace_table(tables[name], source, name)
    replace_table(ORDER_ENTRY["customer_demographics"].empty(spark), source, "customer_demographics")
    spark.sql(f"CREATE VIEW `{source}`.shipped_orders AS SELECT * FROM `{source}`.orders WHERE shipped_date IS NOT NULL")
    raw, star_db = _database(spark, f"{label}_raw")[1], _database(spark, f"{label}_star")[1]
    run = refresh.Run(f"{root}/staging", raw, star_db, as_of=sample.AS_OF, line_key=sample.LINE_KEY)
    for _ in range(2):
        refresh.daily(spark, CatalogSource(spark, source), run)
    return raw, star_db


def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact that the second of two daily runs leaves: extract, load, check, transform."""
    _, db = _daily(spark, sf_dir, "daily_fact")
    built, plain = spark.table(f"`{db}`.fact_table"), fact_table(spark, sf_dir)
    return built.select(*[F.col(f.name).cast(f.dataType) for f in plain.schema])


def daily_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every raw and star table after two daily runs: the view is not extracted, the empty table is."""
    found = dict(zip(("raw", "star"), _daily(spark, sf_dir, "daily_tables"), strict=True))
    counts = [
        spark.table(f"`{db}`.`{name}`").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n_rows"
        )
        for layer, db in found.items()
        for name in list_tables(spark, db)
    ]
    return reduce(DataFrame.unionByName, counts)


def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers inserted as authors with a column list: the rest takes defaults or NULL."""
    customers = sample.read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("au_id"),
        F.col("c_name").alias("au_lname"),
        F.col("c_mktsegment").alias("au_fname"),
        F.when(F.col("c_acctbal") > 0, F.lit("Berlin")).alias("city"),
        (F.col("c_nationkey") != 0).alias("contract"),
    )
    return PUBLISHING["authors"].fill(customers)


def _broken(df: DataFrame) -> DataFrame:
    """The same columns; reading a row fails."""
    failing = F.raise_error(F.lit("broken on purpose"))
    return df.select(*[F.coalesce(failing.cast(f.dataType), F.col(f.name)).alias(f.name) for f in df.schema])


def _refused(work: Callable[[], object]) -> bool:
    try:
        work()
    except Exception:  # whatever stops it: the callers count rows afterwards
        return True
    return False


def staged_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders staged once; the next run fails while it writes. What was staged first is read, and listed."""
    root, _ = _database(spark, "staged_after_failure")
    orders = sample.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    stage(orders, f"{root}/staging", "orders")
    failed = _refused(lambda: stage(_broken(orders), f"{root}/staging", "orders"))
    source = FolderSource(spark, f"{root}/staging")
    return source.read("orders").withColumns(
        {"second_run_failed": F.lit(failed), "tables": F.lit(",".join(source.tables()))}
    )


def staged_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staging folder of all sorts: a staged dataset, one of others, one further down, one that lost a file, one
    whose first write failed, one of another format. Each with its state and, if it can be read, its rows."""
    root, _ = _database(spark, "staged_inventory")
    staging = f"{root}/staging"
    table = {x: sample.read(spark, sf_dir, x) for x in ("orders", "nation", "region", "customer", "part", "supplier")}
    stage(table["orders"], staging, "orders")
    table["nation"].write.parquet(dataset_path(staging, "nation", "parquet"))
    stage(table["region"], f"{staging}/2024/01", "region")
    lossy = stage(table["customer"], staging, "customer")
    remove_folder(spark, data_files_of(spark, lossy)[0])
    first_failed = _refused(lambda: stage(_broken(table["part"]), staging, "part"))
    table["supplier"].write.json(dataset_path(staging, "supplier", "json"))
    found = [(x.table, x.state, x.readable) for x in inspect(spark, staging)]
    source = FolderSource(spark, staging)
    counts = [
        (source.read(name) if readable else spark.range(0)).agg(
            F.lit(name).alias("table_name"), F.lit(state).alias("state"), F.count(F.lit(1)).alias("n_rows")
        )
        for name, state, readable in found
    ]
    nothing = not first_failed
    try:
        list_staged(spark, f"{root}/nothing")
    except NothingStaged:
        nothing = True
    empty = spark.range(0).agg(
        F.lit("(empty folder)").alias("table_name"), F.lit("refused" if nothing else "listed").alias("state"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return reduce(DataFrame.unionByName, [*counts, empty])


def replaced_under_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice, each time with other columns, while a reader polls it all the time.

    What the table shows in the end, what a reader of the version before still counts, and how many polls saw
    neither version whole.
    """
    _, db = _database(spark, "replaced_under_readers")
    orders = sample.read(spark, sf_dir, "orders")
    versions = [
        orders.select("o_orderkey"),
        orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice"),
        orders.filter("o_orderstatus <> 'O'").select("o_totalprice", "o_custkey", "o_orderkey"),
    ]
    whole = {(len(v.columns), v.count()) for v in versions}
    replace_table(versions[0], db, "t")
    done, polls, odd = threading.Event(), [], []

    def poll() -> None:
        while not done.is_set() or not polls:
            try:
                shown = spark.table(f"{db}.t")
                polls.append((len(shown.columns), shown.count()))
            except Exception as e:  # a reader must never see the table missing
                odd.append(str(e))

    reader = threading.Thread(target=poll)
    reader.start()
    try:
        replace_table(versions[1], db, "t")
        held = spark.table(f"{db}.t")
        replace_table(versions[2], db, "t")
    finally:
        done.set()
        reader.join()
    odd += [x for x in polls if x not in whole]
    shown = spark.table(f"{db}.t").agg(F.lit("shown").alias("reading"), F.count("o_custkey").alias("n_rows"))
    before = held.agg(F.lit("version before").alias("reading"), F.count("o_totalprice").alias("n_rows"))
    missed = spark.range(len(odd)).agg(F.lit("odd polls").alias("reading"), F.count("id").alias("n_rows"))
    return shown.unionByName(before).unionByName(missed)


def _insertable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as rows of a declared table, with a column list."""
    return sample.read(spark, sf_dir, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("au_id"),
        F.col("c_name").alias("au_lname"),
        F.col("c_mktsegment").alias("au_fname"),
        F.substring("c_mktsegment", 1, 1).alias("state"),
        (F.col("c_acctbal") > 0).alias("contract"),
    )


def declared_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a declared table took: defaults where the column list leaves a column out, blanks of fixed length gone."""
    _, db = _database(spark, "declared_insert")
    create_tables(spark, db, {"authors": PUBLISHING["authors"]})
    insert_rows(_insertable(spark, sf_dir), db, PUBLISHING["authors"])
    return CatalogSource(spark, db).read("authors")


def declared_refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a declared table does not take, and its rows after each attempt."""
    _, db = _database(spark, "declared_refusals")
    declared = PUBLISHING["authors"]
    create_tables(spark, db, {"authors": declared})
    good = _insertable(spark, sf_dir)
    insert_rows(good, db, declared)
    missing = F.when(F.col("contract"), F.col("au_lname"))
    attempts = {
        "a missing required value": good.withColumn("au_lname", missing),
        "a text that is too long": good.withColumn("state", F.col("au_fname")),
        "a required column left out": good.drop("contract"),
        "an unknown column": good.withColumn("shoe_size", F.lit(40)),
        "the same rows again": good,
    }
    counts = []
    for name, rows in attempts.items():
        refused = _refused(lambda rows=rows: insert_rows(rows, db, declared))
        # counted now: the next attempt adds to the table
        n_rows = spark.table(f"{db}.authors").count()
        counts.append((name, refused, n_rows))
    return spark.createDataFrame(counts, "attempt string, refused boolean, n_rows long")


def now_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts inserted as titles without a day of publication: it is today's in every row."""
    _, db = _database(spark, "now_default")
    create_tables(spark, db, {"titles": PUBLISHING["titles"]})
    parts = sample.read(spark, sf_dir, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("title_id"), F.col("p_name").alias("title")
    )
    insert_rows(parts, db, PUBLISHING["titles"])
    days = F.date_diff(F.current_date(), F.to_date("pubdate"))
    return spark.table(f"{db}.titles").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("pubdate").alias("n_dated"),
        F.max(days).alias("most_days_ago"),
        F.count_distinct("pubdate").alias("n_moments"),
    )


def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup table written by hand beside a table: suppliers with the shipper that their nation's number gives."""
    shippers = ORDER_ENTRY["shippers"].rows(
        spark, [(0, "Speedy Express", None), (1, "United Package", "555"), (2, "Federal Shipping", None)]
    )
    suppliers = sample.read(spark, sf_dir, "supplier").select(
        "s_suppkey", (F.col("s_nationkey") % 4).cast("short").alias("shipper_id")
    )
    return suppliers.join(shippers, "shipper_id", "left").select("s_suppkey", "shipper_id", "company_name", "phone")


def dropped_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain, a replaced and a declared table stay; one of each kind is dropped, with one that never was."""
    root, db = _database(spark, "dropped_tables")
    nations, regions = sample.read(spark, sf_dir, "nation"), sample.read(spark, sf_dir, "region")
    for name in ("stays", "goes"):
        nations.write.saveAsTable(f"{db}.plain_{name}")
        replace_table(regions, db, f"replaced_{name}")
    create_tables(spark, db, {"jobs": PUBLISHING["jobs"], "stores": PUBLISHING["stores"]})
    drop_tables(spark, db, ["plain_goes", "replaced_goes", "jobs", "never_there"])
    counts = [
        spark.table(f"{db}.{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name in list_tables(spark, db)
    ]
    return reduce(DataFrame.unionByName, counts)


def titleview_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title view kept in a database, read by another session after its tables were loaded again."""
    _, db = _database(spark, "titleview_stored")
    tables = sample.publishing(spark, sf_dir)
    for name in ("titles", "authors", "titleauthor"):
        replace_table(tables[name].limit(0), db, name)
    create_stored_view(spark, db, "titleview", reports.titleview_query(db), "one row per author of a title")
    for name in ("titles", "authors", "titleauthor"):
        replace_table(tables[name], db, name)
    view = spark.newSession().table(f"{db}.titleview")
    return view.withColumn("price", F.col("price").cast("double"))


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and columns of a database as its metadata tells them: a replaced, a plain and a declared table, and a view."""
    _, db = _database(spark, "catalog_columns")
    replace_table(sample.read(spark, sf_dir, "customer"), db, "customer")
    sample.read(spark, sf_dir, "supplier").write.saveAsTable(f"{db}.supplier")
    create_tables(spark, db, {"publishers": PUBLISHING["publishers"]})
    create_stored_view(spark, db, "debtors", f"SELECT c_custkey, c_acctbal FROM {db}.customer WHERE c_acctbal < 0")
    columns = ["table_name", "table_type", "column_name", "position", "data_type", "nullable", "column_default"]
    return describe_columns(spark, db).select(*columns)


def record_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record schema of staged events, field by field: missing values are those of the rows."""
    root, _ = _database(spark, "record_schemas")
    events = _events_as_text(spark, sf_dir)
    staged = normalise(events, column_profiles(events), dates="millis")
    stage(staged, f"{root}/staging", "events", namespace="staging", doc="web events")
    return record_rows(spark, [find_staged(spark, f"{root}/staging", "events").manifest.record])


def record_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between the record schemas of two days: a column less, one more, one of another type, one that is now
    missing here and there, and a table that is new."""
    root, _ = _database(spark, "record_drift")
    customers, orders = sample.read(spark, sf_dir, "customer"), sample.read(spark, sf_dir, "orders")
    days = {
        "monday": {"customer": customers},
        "tuesday": {
            "customer": customers.drop("c_mktsegment").withColumns(
                {
                    "c_nationkey": F.col("c_nationkey").cast("string"),
                    "c_acctbal": F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")),
                    "in_credit": F.col("c_acctbal") > 0,
                }
            ),
            "orders": orders.select("o_orderkey"),
        },
    }
    for day, tables in days.items():
        for name, df in tables.items():
            stage(df, f"{root}/{day}", name, observe=df.columns)
    before, after = (
        record_rows(spark, [x.manifest.record for x in inspect(spark, f"{root}/{day}")]) for day in days
    )
    return schema_drift(before, after)


def equal_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates from a counted histogram of a clustered column: every row is in one part, and parts are even."""
    lines = sample.read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_partkey") * F.col("l_partkey")).alias("k")
    )
    parts = 8
    ranked = lines.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    # a histogram row for each value of the scaled key, as a database would return them for its buckets
    bucket = F.floor(F.sqrt(F.col("k")) / 10)
    counts = ranked.groupBy(bucket.alias("b")).agg(F.min("k").alias("k"), F.sum("n").alias("n")).orderBy("k")
    predicates = equal_depth("k", [(r["k"], r["n"]) for r in counts.collect()], parts)
    inside = [F.coalesce(F.expr(p.replace('"', "`")), F.lit(False)).cast("int") for p in predicates]
    total = F.count(F.lit(1))
    largest = F.greatest(*[F.sum(x) for x in inside[:-1]])
    return lines.agg(
        total.alias("n_rows"),
        F.count_if(reduce(lambda a, b: a + b, inside) == 1).alias("n_in_one_part"),
        F.sum(inside[-1]).alias("n_without_value"),
        (largest * parts <= 2 * F.count("k")).alias("parts_are_even"),
    )


# -- data quality --------------------------------------------------------------------------


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.order_entry(spark, sf_dir)["orders"]
    return dq.row_violations(orders, "orders", ["order_id"], [dq.not_null("shipped_date")])


def dq_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sample.read(spark, sf_dir, "lineitem")
    return dq.key_violations(lines, "lineitem", ["l_orderkey", "l_linenumber"])


def dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.reference_violations(
        sample.read(spark, sf_dir, "orders"),
        "orders",
        ["o_custkey"],
        sample.read(spark, sf_dir, "customer"),
        "customer",
        ["c_custkey"],
    )


def dq_fk_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose supplier is missing among the suppliers with money."""
    return dq.reference_violations(
        sample.read(spark, sf_dir, "lineitem"),
        "lineitem",
        ["l_suppkey"],
        sample.read(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 0),
        "supplier",
        ["s_suppkey"],
    )


def dq_self_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who report to the customer 100 places ahead; the last 100 have nobody."""
    customers = sample.read(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") + 100).alias("reports_to")
    )
    return dq.reference_violations(
        customers, "customer", ["reports_to"], customers, "customer", ["c_custkey"]
    )


def _part_violations(spark: SparkSession, sf_dir: str, *rules: dq.RowRule) -> DataFrame:
    return dq.row_violations(sample.read(spark, sf_dir, "part"), "part", ["p_partkey"], rules)


def _pattern() -> dq.RowRule:
    brand = F.col("p_brand")
    return dq.check("brand_pattern", like_class(brand, "Brand#[0-9]"), brand)


def _list_or_pattern() -> dq.RowRule:
    brand = F.col("p_brand")
    known = brand.isin("Brand#1", "Brand#3") | like_class(brand, "Brand#2[0-9]")
    return dq.check("brand_known", known, brand)


def dq_check_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_violations(spark, sf_dir, _pattern())


def dq_check_list_or_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_violations(spark, sf_dir, _list_or_pattern())


def dq_check_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    at_least = dq.check("size_low", size >= 10, size.cast("string"))
    at_most = dq.check("size_high", size <= 40, size.cast("string"))
    return _part_violations(spark, sf_dir, at_least, at_most)


def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _part_violations(spark, sf_dir, dq.max_length("p_name", 9))


def dq_int_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample.read(spark, sf_dir, "orders")
    return dq.row_violations(
        orders, "orders", ["o_orderkey"], [dq.between("o_custkey", 0, 255)]
    )


def dq_row_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = sample.publishing(spark, sf_dir)
    return dq.level_violations(tables["employee"], tables["jobs"])


def dq_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several row rules in one scan, with the key rule of another table, counted."""
    found = _part_violations(
        spark, sf_dir, _pattern(), _list_or_pattern(), dq.max_length("p_name", 9)
    ).unionByName(dq_pk(spark, sf_dir))
    return dq.rule_counts(found)


def dq_declared_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule that the declarations of three tables imply, counted."""
    tables = {name: sample.read(spark, sf_dir, name) for name in sample.DECLARED}
    return dq.rule_counts(dq.violations(tables, sample.DECLARED))


_QUERIES: tuple[Query, ...] = (
    dim_suppliers,
    dim_products,
    dim_customers,
    dim_employees,
    dim_date,
    fact_table,
    fact_table_role_dates,
    order_line_numbers,
    identity_numbers,
    titleview,
    byroyalty,
    reptq1,
    reptq2,
    reptq3,
    reptq1_places,
    calendar_to_today,
    profile_events,
    profile_written_dates,
    profile_flags,
    durations,
    profile_orders,
    profile_documents,
    normalise_events,
    staged_events,
    times_as_text,
    epoch_millis_roundtrip,
    month_first_dates,
    table_inventory,
    load_truncate,
    loaded_schema,
    replace_own_table,
    daily_fact,
    daily_tables,
    default_fill,
    staged_after_failure,
    staged_inventory,
    replaced_under_readers,
    declared_insert,
    declared_refusals,
    now_default,
    literal_rows,
    dropped_tables,
    titleview_stored,
    catalog_columns,
    record_schemas,
    record_drift,
    equal_splits,
    dq_not_null,
    dq_pk,
    dq_fk,
    dq_fk_broken,
    dq_self_fk,
    dq_check_pattern,
    dq_check_list_or_pattern,
    dq_check_bound,
    dq_length,
    dq_int_width,
    dq_row_rule,
    dq_rule_counts,
    dq_declared_rules,
)


def _text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the optional subpackage and its pipeline, as far as they can be imported."""
    try:
        from starmill.llm import queries as text

        import corpus_pipeline
    except ModuleNotFoundError as e:
        if e.name not in ("starmill.llm", "corpus_pipeline"):
            log.exception("the text queries are there, but something that they need is not")
            raise
        log.warning("no text queries: %s is not there", e.name)
        return {}, {}
    found, sql = text.queries(), dict(text.ORACLES)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES} | _text_queries()[0]


def oracle_sql() -> dict[str, str]:
    from sample_sql import ORACLES

    return dict(ORACLES) | _text_queries()[1]
