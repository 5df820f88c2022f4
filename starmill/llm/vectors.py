"""Vectors in blocks: clean rows, numpy matrices, and a stated set of queries against every block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Of one block of vectors and what belongs to it, in double precision.
BLOCK_BYTES = 1 << 26


def finite(vector: str = "embedding") -> Column:
    """A vector that is there, without null, NaN or infinite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd, F.lit(False))


def one_per_id(rows: DataFrame) -> DataFrame:
    """One row of each vec_id, the least by its other columns in order; rows without an id are left out."""
    others = [x for x in rows.columns if x != "vec_id"]
    least = rows.filter("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct(*others)).alias("least"))
    return least.select("vec_id", *[F.col("least")[x].alias(x) for x in others])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles; a vector shorter than ``width`` goes on with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def block_count(n: int, bytes_a_row: int, tasks: int, least: int = 512) -> int:
    """Blocks of ``n`` rows: two for each task that can run at once, more where memory asks for it."""
    most = max(least, BLOCK_BYTES // max(1, bytes_a_row))
    return max(1, -(-n // most), min(2 * tasks, -(-n // least)))


def block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block")


def in_each_block(queries: DataFrame, blocks: int) -> DataFrame:
    """Every query once for each block."""
    return queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of the batches in which the keys stay the same, with those keys. Nothing is gathered."""
    for batch in batches:
        columns = [batch.column(x).to_numpy(zero_copy_only=False) for x in keys]
        turns = np.zeros(batch.num_rows, bool)
        for x in columns:
            turns[1:] |= x[1:] != x[:-1]
        cuts = [0, *np.flatnonzero(turns).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                yield tuple(x[a].item() for x in columns), batch.slice(a, b - a)


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n largest scores, largest first, ties by smaller id."""
    if len(scores) > n:
        least = np.partition(scores, len(scores) - n)[len(scores) - n]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:n]]
