"""Consecutive row numbers over a whole table without sorting it in one task.

A plain ``row_number() over (order by ...)`` moves every row to a single task. Here the sort
order is split at cut points taken once from a small sample, and each row's bucket follows
from its keys alone. A lost executor therefore recomputes the same buckets. Buckets hold about
equally many rows even when one leading key value owns a large part of the table, because the
cuts compare all keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window as W, functions as F, types as T

from starmill.session import scratch_dir
from starmill.storage import remove_folder

ROWS_PER_BUCKET = 1_000_000
SAMPLE_PER_BUCKET = 16
SEGMENT = 256

BUCKET = "__bucket"
_KEY, _HIGH, _LOW, _NUMBER, _CUTS = "__key", "__high", "__low", "__segment", "__cuts"


def _key_struct(columns: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])


def _search(df: DataFrame, cuts: Column, size: int, out: str, strict: bool) -> DataFrame:
    """Adds how many of the sorted cuts lie below the row's key, one halving per projection.

    Reading past the end of the cuts gives NULL, which counts as "not below".
    """
    df = df.withColumn(out, F.lit(0))
    step = 1 << (size.bit_length() - 1) if size else 0
    while step:
        cut = F.get(cuts, F.col(out) + F.lit(step - 1))
        below = cut < F.col(_KEY) if strict else cut <= F.col(_KEY)
        df = df.withColumn(out, F.col(out) + F.when(below, F.lit(step)).otherwise(F.lit(0)))
        step >>= 1
    return df


@dataclass(frozen=True)
class RangeBuckets:
    """Fixed cut points through the sort order of ``keys``."""

    keys: tuple[str, ...]
    key_types: tuple[T.DataType, ...]
    # (segment, cuts): the sorted cuts, SEGMENT to a row.
    segments: DataFrame | None
    # One row: the last cut of each full segment. Plans hold a subquery on it, and join the segments by number.
    tops: DataFrame | None
    cuts: int

    @property
    def count(self) -> int:
        return self.cuts + 1

    def _locate(self, df: DataFrame, key: list[Column], out: str, strict: bool) -> DataFrame:
        """Adds the number of cuts below (or at) the key: first its segment, then its place there."""
        if not self.cuts:
            return df.withColumn(out, F.lit(0))
        n = len(key)

        def leading(cuts: Column) -> Column:
            if n == len(self.keys):
                return cuts
            return F.transform(cuts, lambda x: _key_struct([x[f"k{i}"] for i in range(n)]))

        typed = [c.cast(t) for c, t in zip(key, self.key_types)]
        df = df.withColumn(_KEY, _key_struct(typed))
        full = self.cuts // SEGMENT
        if not full:
            own = self.segments.select(leading(F.col("cuts"))).scalar()
            return _search(df, own, self.cuts, out, strict).drop(_KEY)
        df = _search(df, self.tops.select(leading(F.col("tops"))).scalar(), full, _HIGH, strict)
        segments = self.segments.select(F.col("segment").alias(_NUMBER), leading(F.col("cuts")).alias(_CUTS))
        # small tables of cuts are sent around, by Spark's own check of their size
        df = df.join(segments, F.col(_HIGH) == F.col(_NUMBER), "left")
        df = _search(df, F.col(_CUTS), SEGMENT, _LOW, strict)
        return df.withColumn(out, F.col(_HIGH) * F.lit(SEGMENT) + F.col(_LOW)).drop(_KEY, _HIGH, _LOW, _NUMBER, _CUTS)

    def assign(self, df: DataFrame, out: str = BUCKET) -> DataFrame:
        """Adds the bucket of every row."""
        return self._locate(df, [F.col(k) for k in self.keys], out, strict=False)

    def spread(self, df: DataFrame, lead: str, out: str = BUCKET) -> DataFrame:
        """Copies a row to each bucket in which its leading key can occur.

        Almost every leading key lies in one bucket; a hot one lies in several. There are at
        most as many extra copies as cuts when the leading key is unique.
        """
        lo, hi = "__lo", "__hi"
        df = self._locate(df, [F.col(lead)], lo, strict=True)
        df = self._locate(df, [F.col(lead)], hi, strict=False)
        return df.withColumn(out, F.explode(F.sequence(F.col(lo), F.col(hi)))).drop(lo, hi)

    def place(self, df: DataFrame) -> DataFrame:
        """One shuffle partition per bucket, in bucket order."""
        return df.repartitionById(self.count, F.col(BUCKET))

    def offsets(self, bucketed: DataFrame) -> DataFrame:
        """Rows before each bucket. Never more rows than there are buckets."""
        sizes = bucketed.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
        before = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
        return sizes.select(
            BUCKET, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")
        )

    def number(self, df: DataFrame, out: str) -> DataFrame:
        """Adds 1, 2, 3, ... in key order and keeps the bucket column and its partitioning.

        A partition holds one bucket, sorted by the keys, so a row's place in its partition is
        its rank in the bucket: the low bits of ``monotonically_increasing_id``. A window would
        sort by the bucket first, which compares every pair of rows twice; here the leading key
        comes first, and a join on the leading key and the bucket needs no further sort.
        """
        bucketed = self.assign(df)
        lead, *rest = self.keys
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        return (
            self.place(bucketed)
            .sortWithinPartitions(lead, BUCKET, *rest)
            .withColumn("__place", place)
            # a row of two numbers a bucket, that is for a million rows of the table
            .join(F.broadcast(self.offsets(bucketed)), BUCKET, "left")
            .withColumn(out, F.col("__before") + F.col("__place") + F.lit(1))
            .drop("__before", "__place")
        )


def range_buckets(df: DataFrame, keys: Sequence[str], buckets: int | None = None) -> RangeBuckets:
    """Takes cut points from a sample of bounded size; they only decide how even buckets are.

    Reads the keys twice: a row count, which the files' own counts can answer, then the sample.
    """
    keys = tuple(keys)
    types = tuple(df.schema[k].dataType for k in keys)
    keyed = df.select(*keys)
    rows = keyed.count()
    if buckets is None:
        cores = df.sparkSession.sparkContext.defaultParallelism
        buckets = max(math.ceil(rows / ROWS_PER_BUCKET), min(cores, rows))
    if buckets <= 1:
        return RangeBuckets(keys, types, None, None, 0)
    share = min(1.0, SAMPLE_PER_BUCKET * buckets / max(rows, 1))
    sample = keyed.sample(False, share, 42) if share < 1.0 else keyed
    sorted_sample = scratch_dir(df.sparkSession, "numbering")
    try:
        return RangeBuckets(keys, types, *_cuts(sample, keys, buckets, sorted_sample))
    finally:
        remove_folder(df.sparkSession, sorted_sample)


def _cuts(
    sample: DataFrame, keys: tuple[str, ...], buckets: int, folder: str
) -> tuple[DataFrame | None, DataFrame | None, int]:
    """Segments of the cuts, the tops of full ones, and how many cuts there are.

    The sample is sorted by many tasks, and so are the cuts numbered and gathered, SEGMENT to a row. Only the tops
    meet in one task: a key for each SEGMENT buckets.
    """
    spark = sample.sparkSession
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    key = _key_struct([F.col(k) for k in keys])
    sample.orderBy(*keys).select(key.alias("cut"), F.spark_partition_id().alias("part"), place.alias("place")).write.parquet(folder)
    placed = spark.read.parquet(folder)

    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # a row for each task of the sort
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(W.partitionBy()).alias("all"),
    )
    at = placed.join(F.broadcast(offsets), "part").withColumn("at", F.col("before") + F.col("place"))
    # as many buckets as there are sampled keys at most, so every bucket begins at one of them
    wanted = F.least(F.lit(buckets), F.col("all"))
    bucket = [F.floor((F.col("at") - back) * wanted / F.col("all")) for back in (0, 1)]
    number = bucket[0] - 1
    picked = at.filter((F.col("at") > 0) & (bucket[0] > bucket[1]))
    cuts = picked.select(number.alias("number"), "cut", F.floor(number / SEGMENT).cast("int").alias("segment"))
    in_order = F.sort_array(F.collect_list(F.struct("number", "cut")))
    gathered = cuts.groupBy("segment").agg(F.transform(in_order, lambda x: x["cut"]).alias("cuts"))
    seen = Observation()
    segments = _kept(gathered.observe(seen, F.coalesce(F.sum(F.size("cuts")), F.lit(0)).alias("n")), "cuts")
    n = seen.get["n"]
    if n < SEGMENT:
        return segments, None, n
    top = F.struct("segment", F.element_at("cuts", -1).alias("cut"))
    tops = segments.filter(F.size("cuts") == SEGMENT).agg(F.sort_array(F.collect_list(top)).alias("t"))
    return segments, _kept(tops.select(F.transform("t", lambda x: x["cut"]).alias("tops")), "tops"), n


def _kept(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table of the scratch folder: every later plan reads the same cuts."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def global_row_number(
    df: DataFrame, keys: Sequence[str], out: str, buckets: int | None = None
) -> DataFrame:
    """Adds ``row_number() over (order by keys)``; the keys must order the rows totally.

    ``df`` should be a table or a file scan: it is read once for the count, once for the
    sample (which is sorted in the scratch folder) and once for the bucket sizes, each time only the keys. By default a bucket holds a
    million rows; rows with long texts want more ``buckets``.
    """
    return range_buckets(df, keys, buckets).number(df, out).drop(BUCKET)
