"""Hard-negative mining by a vertical scan of vector columns that shrinks its candidates as it goes.

Blocks of rows hold their vectors column by column, with the least and largest value of each column. For an anchor, a
block is read one run of ``RUN`` columns after the other, in descending magnitude of the anchor's own components.
After each run a candidate's score lies between what it has and the least and largest contributions of the columns that
are left; candidates that can no longer be in the result leave the bitmap, and the next run reads those that stay. Once all
columns are read the scores of what stays are exact. Nothing is approximate.

There are two scans. The first finds an anchor's best rows of its own label, its positives; only blocks of that label are
read. The second finds, for each positive, the best rows of other labels in a window of scores below it; all windows of
an anchor share the scan. A candidate leaves when it can lie in no window, or when enough others are sure to be better.

How it runs: the first scan's blocks are parts of a label, so a label that a third of the rows have is many
blocks; the second's are parts of all rows. A task holds one block and lets anchors pass in batches; only the best rows of each
block leave it, and a window over those gives the result.

Defined results: rows without id or label take no part, nor do vectors that are null or hold null or non-finite
components; a vector shorter than the longest goes on with zeros; of rows with one vec_id the least by label, then
vector, takes part; ties go to the smaller vec_id; anchors without positives, and positives without negatives, have no
rows; empty tables give empty results; other columns are ignored, whatever their names. ``quantised`` holds
components within +-2^25, so sums of up to 4,096 of them are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.llm.common import save
from starmill.llm.vectors import best, block_count, block_of, finite, in_each_block, matrix, one_per_id, runs

RUN = 8
MOST_COMPONENT = 1 << 25
EXACT = 1 << 53

ROW, ANCHOR = 0, 1
_FOUND = "anchor_id long, window long, vec_id long, score long"


def quantised(vector: str = "embedding", scale: int = 256) -> Column:
    """Components as floor(scale * x), x in double precision."""
    most = float(MOST_COMPONENT)
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-most)), F.lit(most))))


def participants(vectors: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, with whole-number components."""
    known = vectors.filter(finite()).select("vec_id", label.cast("long").alias("label"), quantised(scale=scale).alias("vector"))
    return one_per_id(known.filter("label is not null"))


class Block:
    """Rows column by column, with each column's least and largest value."""

    def __init__(self, width: int):
        self.width = width
        self.parts: list[tuple] = []
        self.ids = self.labels = self.columns = None

    def add(self, part: pa.RecordBatch) -> None:
        arrays = [part.column(x).to_numpy() for x in ("vec_id", "label")]
        self.parts.append((*arrays, matrix(part.column("vector"), self.width).T))

    def ready(self) -> bool:
        if self.parts:
            ids, labels, columns = zip(*self.parts, strict=True)
            self.ids, self.labels = np.concatenate(ids), np.concatenate(labels)
            self.columns = np.ascontiguousarray(np.concatenate(columns, axis=1))
            self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
            self.largest = np.abs(self.columns).max(initial=0)
            self.parts = []
        return self.ids is not None

    def runs_of(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float, float]]:
        """(columns, the anchor's components, least and largest that the columns after them can add)."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])[:, order]
        least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        for begin in range(0, self.width, RUN):
            end = min(begin + RUN, self.width)
            yield order[begin:end], anchor[order[begin:end]], least[end], most[end]

    def scan(self, anchor: np.ndarray, at: np.ndarray, stays) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) of what stays; ``stays(lower, upper)`` is the bitmap after each run."""
        columns = self.columns
        if self.largest * np.abs(anchor).max(initial=0) * self.width >= EXACT:
            anchor, columns = anchor.astype(np.int64), columns.astype(np.int64)
        score = np.zeros(len(at), anchor.dtype)
        for own, parts, least, most in self.runs_of(anchor):
            score += parts @ (columns[own] if len(at) == len(self.ids) else columns[own[:, None], at])
            bitmap = stays(score + least, score + most)
            if not bitmap.all():
                at, score = at[bitmap], score[bitmap]
        return at, score.astype(np.int64)

    def positives(self, own: int, anchor: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The n best rows but the anchor's own."""

        def stays(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            if len(lower) <= n:
                return np.ones(len(lower), bool)
            return upper >= np.partition(lower, len(lower) - n)[len(lower) - n]

        at, score = self.scan(anchor, np.flatnonzero(self.ids != own), stays)
        top = best(score, self.ids[at], n)
        return self.ids[at[top]], score[top]

    def negatives(self, label: int, anchor: np.ndarray, windows: np.ndarray, n: int) -> Iterator[tuple]:
        """For each (low, high) of ``windows`` the n best rows of other labels within it."""
        low, high = windows[:, :1], windows[:, 1:]

        def stays(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            bitmap = (upper >= low.min()) & (lower <= high.max())
            wanted = np.zeros(len(lower), bool)
            some = np.flatnonzero(bitmap)
            below, above = lower[some], upper[some]
            for bottom, top in windows:
                sure = below[(below >= bottom) & (above <= top)]
                bar = np.partition(sure, len(sure) - n)[len(sure) - n] if len(sure) > n else bottom
                wanted[some] |= (above >= max(bar, bottom)) & (below <= top)
            return wanted

        at, score = self.scan(anchor, np.flatnonzero(self.labels != label), stays)
        for bottom, top in windows:
            inside = np.flatnonzero((score >= bottom) & (score <= top))
            chosen = inside[best(score[inside], self.ids[at[inside]], n)]
            yield self.ids[at[chosen]], score[chosen]


def _visit(everything: DataFrame, keys: list[str], width: int, answer) -> DataFrame:
    """``answer(block, anchor rows)`` for each batch of anchors at each block, as ``_FOUND`` rows.

    ``everything`` is in order of its keys and kind: a block's rows, then the anchors that visit it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = None, Block(width)
        for (*own, kind), part in runs(batches, [*keys, "kind"]):
            if own != number:
                number, block = own, Block(width)
            if kind == ROW:
                block.add(part)
            elif block.ready():
                found = [(i, w, *x) for i, w, x in answer(block, part)]
                sizes = [len(x[2]) for x in found]
                ids = part.column("vec_id").to_numpy()
                columns = [
                    np.repeat(ids[[x[0] for x in found]] if found else ids[:0], sizes),
                    np.repeat(np.array([x[1] for x in found], np.int64), sizes),
                    np.concatenate([ids[:0], *(x[2] for x in found)]),
                    np.concatenate([ids[:0], *(x[3] for x in found)]),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns], ["anchor_id", "window", "vec_id", "score"]
                )

    return everything.sortWithinPartitions(*keys, "kind", "vec_id").mapInArrow(run, _FOUND)


def _top(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def positives(rows: DataFrame, anchors: Column, n: int, width: int, rows_a_block: int) -> DataFrame:
    """(anchor_id, vec_id, score, rank): the n best other rows of each anchor's label."""
    sizes = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / rows_a_block).cast("int").alias("parts"))
    sized = rows.join(sizes, "label")
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    stored = sized.select("label", part.alias("part"), F.lit(ROW).alias("kind"), "vec_id", "vector")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asking = sized.filter(anchors).select("label", every.alias("part"), F.lit(ANCHOR).alias("kind"), "vec_id", "vector")

    def answer(block: Block, part: pa.RecordBatch) -> Iterator[tuple]:
        ids = part.column("vec_id").to_numpy()
        for i, anchor in enumerate(matrix(part.column("vector"), width)):
            yield i, 0, block.positives(ids[i], anchor, n)

    dealt = stored.unionByName(asking).repartition("label", "part")
    return _top(_visit(dealt, ["label", "part"], width, answer), ["anchor_id"], n)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` is what ``participants`` gives, ``anchors`` a condition on it. A negative's score n has low[0] * p <=
    low[1] * n and high[1] * n <= high[0] * p for the positive's score p.
    """
    spark = rows.sparkSession
    rows = save(rows.select("vec_id", "label", "vector"), "bond-rows")
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    n, width = facts["n"], facts["width"] or 1
    tasks = spark.sparkContext.defaultParallelism
    blocks = block_count(n, 8 * width, tasks)
    near = save(positives(rows, anchors, n_positives, width, -(-n // blocks) or 1), "bond-positives")

    # as many scores for an anchor as it has positives
    scores = near.groupBy("anchor_id").agg(F.collect_set("score").alias("scores"))
    asking = rows.filter(anchors).join(scores.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    asking = in_each_block(asking.withColumn("kind", F.lit(ANCHOR)), blocks)
    stored = rows.withColumns({"block": block_of(blocks), "kind": F.lit(ROW), "scores": F.lit(None).cast("array<long>")})

    def answer(block: Block, part: pa.RecordBatch) -> Iterator[tuple]:
        labels = part.column("label").to_numpy()
        vectors, of = matrix(part.column("vector"), width), part.column("scores")
        for i, anchor in enumerate(vectors):
            p = of[i].values.to_numpy(zero_copy_only=False)
            windows = np.stack([-(-p * low[0] // low[1]), p * high[0] // high[1]], axis=1)
            open_ = windows[:, 0] <= windows[:, 1]
            if open_.any():
                found = block.negatives(labels[i], anchor, windows[open_], n_negatives)
                yield from ((i, score, x) for score, x in zip(p[open_], found, strict=True))

    dealt = stored.unionByName(asking).repartitionById(blocks, "block")
    far = _top(_visit(dealt, ["block"], width, answer), ["anchor_id", "window"], n_negatives)
    pairs = near.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    far = far.select("anchor_id", F.col("window").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"),
                     F.col("score").alias("negative_score"))
    return pairs.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
