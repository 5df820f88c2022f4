"""The daily run: extract every table to staging, load it, build the star schema."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, types as T

from starmill.operators.profile import column_profiles, normalise, opened, typed_profile
from starmill.operators.quality import require_clean, violations
from starmill.plans import star
from starmill.schemas.records import NAMESPACE
from starmill.schemas.tables import Table
from starmill.session import scratch_dir
from starmill.sinks.staging import stage
from starmill.sinks.warehouse import load_dataset, replace_table
from starmill.sources.catalog import list_tables
from starmill.sources.folders import read_staged, staged
from starmill.storage import remove_folder

log = logging.getLogger(__name__)


class Source(Protocol):
    """``stable`` tells that a second read is cheap and gives the same rows."""

    stable: bool

    def tables(self) -> list[str]: ...

    def read(self, table: str) -> DataFrame: ...


@dataclass(frozen=True)
class Run:
    """Settings of one run. ``tables_at_once`` Spark jobs are submitted side by side.

    ``rules`` are the declared tables whose rules the raw tables must keep. ``line_key`` orders the
    order lines totally. ``namespace`` and ``doc`` go into the record schemas of the staged tables.
    """

    staging_root: str
    raw_db: str
    star_db: str
    fmt: str = "parquet"
    null_text: str | None = None
    dates: str = "date"
    as_of: dt.date | str | None = None
    tables_at_once: int = 4
    rules: Mapping[str, Table] | None = None
    line_key: tuple[str, ...] = ("order_id", "product_id")
    namespace: str = NAMESPACE
    doc: str = ""


def _each(spark: SparkSession, work: Callable[[str], None], names: Iterable[str], n: int) -> None:
    """Runs ``work`` for every name. The first failure is raised, and what had not begun is not run.

    Each name is a scheduler pool of its own. Under the fair scheduler (``spark.scheduler.mode``) pools share the executors, so that
    a large table does not hold up the small ones.
    """

    def pooled(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            work(name)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(n) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(pooled), name) for name in names]
        try:
            for done in as_completed(begun):
                done.result()
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def extract(spark: SparkSession, source: Source, run: Run) -> list[str]:
    """Profiles, casts and stages every base table of the source.

    Only texts and times are profiled ahead, since their values decide how they are staged. Missing values of the other columns
    are counted while the rows are written, so a table without texts and times is read once. A source
    that is not stable is read once in any case, into the scratch folder.
    """
    names = source.tables()
    log.info("tables to extract: %s", names)
    landing = None if source.stable else scratch_dir(spark, "landing")

    def one(name: str) -> None:
        df = source.read(name)
        if landing:
            stage(df, landing, name, "parquet")
            df = read_staged(spark, landing, name, "parquet")
        ahead = opened(df)
        profiles = column_profiles(df.select(*[f"`{x}`" for x in ahead])) if ahead else []
        typed = [(f, i) for i, f in enumerate(df.schema) if f.name not in ahead]
        profiles += [typed_profile(f, i) for f, i in typed]
        # a flag may always be missing
        counted = [f.name for f, _ in typed if not isinstance(f.dataType, T.BooleanType)]
        out = normalise(df, profiles, run.null_text, run.dates)
        path = stage(out, run.staging_root, name, run.fmt, counted, run.namespace, run.doc)
        log.info("staged %s", path)

    try:
        _each(spark, one, names, run.tables_at_once)
    finally:
        if landing:
            remove_folder(spark, landing)
    return names


def load(spark: SparkSession, run: Run) -> list[str]:
    """Loads every staged dataset as a raw table; raises when nothing is staged."""
    found = staged(spark, run.staging_root, run.fmt)

    def one(name: str) -> None:
        load_dataset(spark, found[name], run.raw_db, run.fmt)
        log.info("loaded %s.%s", run.raw_db, name)

    _each(spark, one, sorted(found), run.tables_at_once)
    return sorted(found)


class RawTables(dict):
    """Raw tables by name, looked up when a model asks for them."""

    def __init__(self, spark: SparkSession, db: str):
        super().__init__()
        self.spark, self.db = spark, db

    def __missing__(self, name: str) -> DataFrame:
        return self.spark.table(f"`{self.db}`.`{name}`")


def check(spark: SparkSession, run: Run) -> None:
    """Raises when a loaded table breaks a declared rule."""
    if run.rules:
        loaded = [n for n in list_tables(spark, run.raw_db) if n in run.rules]
        t = RawTables(spark, run.raw_db)
        require_clean(violations({n: t[n] for n in loaded}, run.rules))


def transform(spark: SparkSession, run: Run) -> list[str]:
    """Builds the models. One day is fixed up front for the calendar and the fact."""
    t = RawTables(spark, run.raw_db)
    as_of = run.as_of or spark.sql("select current_date() as d").first()["d"]

    def one(name: str) -> None:
        model = star.MODELS[name]
        settings = {"dim_date": {"as_of": as_of}, "fact_table": {"as_of": as_of, "line_key": run.line_key}}
        df = model(t, **settings.get(name, {}))
        replace_table(df, run.star_db, name)
        log.info("built %s.%s", run.star_db, name)

    _each(spark, one, star.MODELS, run.tables_at_once)
    return list(star.MODELS)


def daily(spark: SparkSession, source: Source, run: Run) -> dict[str, list[str]]:
    extracted = extract(spark, source, run)
    loaded = load(spark, run)
    check(spark, run)
    return {"extracted": extracted, "loaded": loaded, "built": transform(spark, run)}
