"""Approximate nearest neighbours by largest inner product, over an index of pivot permutations.

Every vector is represented by its ``PREFIX`` nearest pivots in order. A row is posted in the inverted file of
each of them, with its place in the order. A query reads the inverted files of its own nearest pivots, which gives
the footrule distance of its order to that of every row posted there; rows not posted with any of them are farthest. The
share of rows with the least footrule distance is then reranked by the exact inner product.

How it runs: rows belong to blocks by a hash of their id, and each block has its own inverted files, so a pivot that a
third of all rows are nearest to is as many files as there are blocks. Queries go to every block, where a task
holds one block and lets queries pass in batches. Tasks return the best rows of a block; a window over those
gives the result.

What is fitted on bounded samples: ``PIVOTS`` pivots by farthest-first choice among ``PIVOT_SAMPLE`` rows, so that near
copies are not chosen twice; and the share to rerank, from the exact neighbours over all rows of ``SHARE_SAMPLE``
queries, such that ``recall`` of them are reranked. Both samples are the rows of smallest hash of the id. The index
itself has every row. The share is a part of the rows, not a number of them, and ties at its end are in.

Inner products of vectors of different norms: rows and pivots get one further component that makes all norms the
largest one, which makes the largest inner product the smallest distance.

Defined results: vectors that are null or zero, or hold null or non-finite components, take no part; a vector shorter
than the longest goes on with zeros; of rows with one vec_id the least vector takes part; rows without an id take
none; ties go to the smaller vec_id; a query without candidates has no rows; empty tables give empty results; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.llm.common import save
from starmill.llm.vectors import best, block_count, block_of, finite, in_each_block, matrix, one_per_id, runs

PIVOTS, PREFIX = 64, 32
PIVOT_SAMPLE, SHARE_SAMPLE = 4096, 256
RECALL = 0.95

MEMBER, POSTED, QUERY = 0, 1, 2
_ROWS = "vec_id long, vector array<double>, prefix array<smallint>"
_FILES = "block int, pivot smallint, rows array<int>, places array<smallint>"
_FOUND = "query_id long, vec_id long, score double, share double"


@dataclass(frozen=True)
class Geometry:
    """What turns vectors to orders of pivots; it travels with the tasks."""

    pivots: np.ndarray
    extra: np.ndarray
    norm: float
    width: int
    prefix: int

    def orders(self, vectors: np.ndarray, stored: bool) -> np.ndarray:
        """The nearest pivots of each vector, nearest first; ``stored`` vectors get the further component."""
        near = vectors @ self.pivots.T
        if stored:
            rest = self.norm**2 - np.einsum("ij,ij->i", vectors, vectors)
            near += np.sqrt(np.maximum(rest, 0))[:, None] * self.extra
        return np.argsort(-near, axis=1, kind="stable")[:, : self.prefix].astype(np.int16)


def spread_out(rows: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of up to n rows, all different."""
    if not len(rows):
        return rows
    chosen, far = [0], np.full(len(rows), np.inf)
    while len(chosen) < n:
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
        if far.max() <= 0:
            break
        chosen.append(int(far.argmax()))
    return rows[chosen]


def smallest_hashes(rows: DataFrame, n: int, most: int) -> DataFrame:
    """The ``most`` of ``n`` rows with the smallest hashes of their ids; tasks send about that many rows in all."""
    placed = rows.withColumn("place", F.xxhash64("vec_id"))
    if n > 4 * most:
        placed = placed.filter(F.col("place") < -(1 << 63) + (1 << 63) // n * 4 * most)
    return placed.orderBy("place", "vec_id").limit(most).drop("place")


class PermutationIndex:
    """``vectors`` is (vec_id, embedding) and further columns; the index is written to the shared folder."""

    def __init__(self, vectors: DataFrame, pivots: int = PIVOTS, prefix: int = PREFIX):
        self.spark = spark = vectors.sparkSession
        usable = vectors.filter(finite()).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
        usable = usable.filter(F.exists("vector", lambda x: x != 0))
        rows = save(one_per_id(usable), "permutation-rows")
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
        facts = rows.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.max(norm).alias("norm")
        ).first()
        self.n, self.width = facts["n"], facts["width"] or 1
        bytes_a_row = 8 * self.width + 6 * prefix
        self.blocks = block_count(self.n, bytes_a_row, spark.sparkContext.defaultParallelism)
        self.geometry = self._geometry(rows, facts["norm"] or 0.0, pivots, prefix)
        self.members = save(self._with_orders(rows, stored=True).select(block_of(self.blocks), "*"), "permutation-members")
        self.files = save(self._inverted_files(), "permutation-files")

    def _geometry(self, rows: DataFrame, norm: float, pivots: int, prefix: int) -> Geometry:
        sample = smallest_hashes(rows, self.n, PIVOT_SAMPLE).select("vector").toArrow()
        plain = np.zeros((0, self.width))
        if sample.num_rows:
            plain = matrix(sample.column("vector").combine_chunks(), self.width)
        rest = np.maximum(norm**2 - (plain**2).sum(axis=1), 0)
        chosen = spread_out(np.column_stack([plain, np.sqrt(rest)]), pivots)
        return Geometry(chosen[:, :-1], chosen[:, -1], norm, self.width, min(prefix, len(chosen)))

    def _with_orders(self, rows: DataFrame, stored: bool) -> DataFrame:
        geometry = self.geometry

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = geometry.orders(matrix(batch.column("vector"), geometry.width), stored)
                ends = np.arange(0, found.size + 1, max(1, found.shape[1]), dtype=np.int32)[: len(found) + 1]
                prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("vector"), prefix], ["vec_id", "vector", "prefix"]
                )

        return rows.select("vec_id", "vector").mapInArrow(run, _ROWS)

    def _inverted_files(self) -> DataFrame:
        """(block, pivot, rows, places): rows by place; a row's number is its rank by id in its block."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, orders in _gathered(batches):
                at = np.repeat(np.arange(len(orders), dtype=np.int32), orders.shape[1])
                place = np.tile(np.arange(orders.shape[1], dtype=np.int16), len(orders))
                pivot = orders.ravel()
                by_pivot = np.lexsort((at, place, pivot))
                names, begins = np.unique(pivot[by_pivot], return_index=True)
                ends = pa.array([*begins.tolist(), len(by_pivot)], pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(x[by_pivot])) for x in (at, place)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), block, np.int32)), pa.array(names), *lists],
                    ["block", "pivot", "rows", "places"],
                )

        dealt = self.members.select("block", "vec_id", "prefix").repartitionById(self.blocks, "block")
        return dealt.sortWithinPartitions("block", "vec_id").mapInArrow(run, _FILES)

    def _visit(self, queries: DataFrame, answer) -> DataFrame:
        """``answer(block, ids, vectors, orders)`` of each batch of queries at each block, as ``_FOUND`` rows."""
        width, prefix = self.width, self.geometry.prefix

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = None
            for (number, kind), part in runs(batches, ["block", "kind"]):
                if block is None or block.number != number:
                    block = Block(number, width, prefix)
                if kind == MEMBER:
                    block.add_rows(part)
                elif kind == POSTED:
                    block.add_files(part)
                elif block.ready():
                    ids, vectors, orders = _query_arrays(part, width)
                    found = list(answer(block, ids, vectors, orders))
                    asked = np.repeat(ids, [len(x[0]) for x in found])
                    columns = [asked, *(np.concatenate(x) for x in zip(*found, strict=True))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in columns], ["query_id", "vec_id", "score", "share"]
                    )

        def kind(df: DataFrame, number: int) -> DataFrame:
            wanted = {"vec_id": "long", "vector": "array<double>", "prefix": "array<smallint>", "pivot": "smallint",
                      "rows": "array<int>", "places": "array<smallint>"}
            have = [F.col(x) if x in df.columns else F.lit(None).cast(t).alias(x) for x, t in wanted.items()]
            return df.select("block", F.lit(number).alias("kind"), *have)

        everything = kind(self.members.drop("prefix"), MEMBER).unionByName(kind(self.files, POSTED))
        everything = everything.unionByName(kind(in_each_block(queries, self.blocks), QUERY))
        dealt = everything.repartitionById(self.blocks, "block")
        return dealt.sortWithinPartitions("block", "kind", "vec_id", "pivot").mapInArrow(run, _FOUND)

    def _queries(self, wanted: Column) -> DataFrame:
        """Rows of the index as queries: the order of a query has no further component."""
        return self._with_orders(self.members.filter(wanted), stored=False)

    def share_to_rerank(self, wanted: Column, k: int, recall: float = RECALL) -> float:
        """The least share that has ``recall`` of the true neighbours of a sample of queries."""
        n = self.members.filter(wanted).count()
        sample = self._with_orders(smallest_hashes(self.members.filter(wanted), n, SHARE_SAMPLE), stored=False)
        found = self._visit(save(sample, "permutation-sample"), lambda block, *q: block.true_neighbours(*q, k))
        top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        true = found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
        # at most k rows for each query of the sample
        shares = np.sort(true.select("share").toArrow().column("share").to_numpy())
        return float(shares[min(len(shares) - 1, int(np.ceil(recall * len(shares))))]) if len(shares) else 1.0

    def search(self, wanted: Column, k: int = 20, recall: float = RECALL, share: float | None = None) -> DataFrame:
        """(query_id, rank, vec_id, score) of the k nearest found of every indexed row that is ``wanted``.

        A row is no candidate of its own. ``share`` of each block is reranked, by default what ``recall`` asks for.
        """
        if not self.n:
            return self.spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        share = self.share_to_rerank(wanted, k, recall) if share is None else share
        found = self._visit(self._queries(wanted), lambda block, *q: block.nearest(*q, k, share))
        top = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
        return ranked.select("query_id", "rank", "vec_id", "score")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Orders of all rows of one block after the other."""
    held, number = [], None
    for (block,), part in runs(batches, ["block"]):
        if block != number and held:
            yield number, np.concatenate(held)
            held = []
        number = block
        column = part.column("prefix")
        held.append(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))
    if held:
        yield number, np.concatenate(held)


def _query_arrays(part: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    orders = part.column("prefix")
    flat = orders.flatten().to_numpy(zero_copy_only=False)
    return part.column("vec_id").to_numpy(), matrix(part.column("vector"), width), flat.reshape(len(orders), -1)


class Block:
    """Rows of one block with its inverted files."""

    def __init__(self, number: int, width: int, prefix: int):
        self.number, self.width, self.prefix = number, width, prefix
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        # what a row gains over having none of the query's pivots: nothing if it is not posted
        self.gains: dict[int, np.ndarray] = {}
        self.posted: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.ids = self.vectors = None

    def add_rows(self, part: pa.RecordBatch) -> None:
        self.parts.append((part.column("vec_id").to_numpy(), matrix(part.column("vector"), self.width)))

    def add_files(self, part: pa.RecordBatch) -> None:
        for i, pivot in enumerate(part.column("pivot").to_pylist()):
            rows, places = (part.column(x)[i].values.to_numpy(zero_copy_only=False) for x in ("rows", "places"))
            self.posted.append((pivot, rows, places))

    def ready(self) -> bool:
        if self.parts:
            self.ids, self.vectors = (np.concatenate(x) for x in zip(*self.parts, strict=True))
            for pivot, rows, places in self.posted:
                self.gains[pivot] = np.zeros(len(self.ids), np.uint8 if self.prefix < 256 else np.int16)
                self.gains[pivot][rows] = self.prefix - places
            self.parts, self.posted = [], []
        return self.ids is not None

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row's order to that of a query; a pivot beyond the prefix stands at its end."""
        near = np.zeros(len(self.ids), np.int32)
        for place, pivot in enumerate(order.tolist()):
            if pivot in self.gains:
                gains = self.gains[pivot]
                near += np.minimum(gains, gains.dtype.type(self.prefix - place))
        return self.prefix * (self.prefix + 1) - 2 * near

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products row by row: equal vectors have equal scores wherever they stand."""
        return (self.vectors[at] * query).sum(axis=1)

    def nearest(self, ids, vectors, orders, k: int, share: float) -> Iterator[tuple]:
        last = min(len(self.ids) - 1, int(share * len(self.ids)))
        for own, query, order in zip(ids, vectors, orders, strict=True):
            far = self.footrule(order)
            at = np.flatnonzero(far <= np.partition(far, last)[last])
            at = at[self.ids[at] != own]
            scores = self.scores(at, query)
            top = best(scores, self.ids[at], k)
            yield self.ids[at[top]], scores[top], np.full(len(top), np.nan)

    def true_neighbours(self, ids, vectors, orders, k: int) -> Iterator[tuple]:
        """By brute force, each with the share of the block's rows that are nearer by footrule."""
        for own, query, order in zip(ids, vectors, orders, strict=True):
            others = np.flatnonzero(self.ids != own)
            scores = self.scores(others, query)
            top = best(scores, self.ids[others], k)
            far = self.footrule(order)
            nearer = np.searchsorted(np.sort(far), far[others[top]], side="left")
            yield self.ids[others[top]], scores[top], nearer / len(self.ids)
