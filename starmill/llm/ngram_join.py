"""N-gram Jaccard self-join by chosen paths.

Each text is the set of its hashed five-word shingles. A run splits the sets recursively: in a node, a set x
goes to the child of each of its tokens y whose hash under the node's path is below 1 / (t |x|), t being the
threshold, about 1 / t children. Two sets of similarity t or more share at least one child on average, so
they meet again with a known probability at every level. Buckets of up to ``small`` sets, which cost less to compare
than to split, are compared by brute force, large ones are split once more, up to ``levels`` times; what is still large
then is compared in blocks. A large bucket
whose sets are nearly all alike is a dense group: its children would hold almost all of it, again and again, so it is
not split but compared as it is. Runs repeat with other hashes until the chance of a pair to meet in none is below 1 - ``recall``:
fewer for sets that only ever met few others, more for those that were in a large bucket that had to be
split again. Nothing is capped: a bucket of any size is compared completely.

Beside its tokens a set has a sketch: its least token in each of 128 bins, a byte each. Splitting goes on the
tokens at the first level and on the sketch's further down. Brute force compares sketches first, with so
much slack that a pair at the threshold is missed once in 100,000 times; only sets with a plausible
partner have their whole token sets brought together, and those are compared exactly.

Equal sets are joined first, as one class. Buckets of one class, and buckets that repeat the members of
another, are dropped. The largest bucket of a set is its main one: sets with the same main bucket are compared there and
nowhere else, so the other buckets of a group compare only what its main bucket lacks, and those whose sets all have
another main bucket in common are dropped. Other pairs that meet in several buckets are counted in the least.

Defined results: null text is empty; a text without words has no links; a text of one to four words
is one shingle of all its words; equal sets link; rows with a null doc_id take part, and a class whose rows
all have null ids has a null class_id; repeated rows count as copies; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm.common import (
    WordHashes,
    components,
    keys_of,
    long_list,
    mixed,
    pieces,
    ranges,
    save,
    shingles,
    split_words,
    text_pieces,
)

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
LEVELS = 3
# To split a bucket leaves some 70 rows of each of its sets in further runs and levels, whatever its size; to compare it
# as it is takes half its sets' number of sketch comparisons a set, and a group's other buckets are not compared again.
SMALL = 8192
BLOCK, BLOCK_TOKENS = 2048, 8 << 20
BINS = 128
# A large bucket is dense if two of its sets share this much of PROBES bins, on average.
DENSE, PROBES = 0.7, 16
# Standard deviations of a sketch's similarity that a pair may fall short.
SLACK = 4.3
# What each member of a bucket carries of its set.
CARRIED = ["set_id", "n_tokens", "probe"]
MEMBER_SCHEMA = "set_id binary, n_tokens long, probe long, bucket long"


def runs_needed(recall: float, levels: int) -> int:
    """Runs until a pair at the threshold met with probability ``recall``.

    At the threshold a pair has one shared child on average, so it meets at a level with probability
    1 - exp(-p) if it meets with p one level further down.
    """
    meet = 1.0
    for _ in range(levels):
        meet = 1 - math.exp(-meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


def _chosen(tokens: np.ndarray, begins: np.ndarray, paths: np.ndarray, threshold: float):
    """Children of nodes (one path a set): their paths, and where each set's begin."""
    sizes = np.diff(begins)
    bound = np.minimum(2.0**64 / (threshold * np.maximum(sizes, 1)), 2.0**64 - 2048).astype(np.uint64)
    own = np.repeat(mixed(paths, 3), sizes)
    hashes = mixed(tokens ^ own, 5)
    taken = np.flatnonzero(hashes < np.repeat(bound, sizes))
    children = mixed(tokens[taken] + mixed(own[taken], 7), 11)
    return children, np.searchsorted(taken, begins)


def _token_sets(texts: list[bytes], hashes: WordHashes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, and where each text's begin."""
    words, starts = split_words(texts)
    grams, begins = shingles(hashes.of(words), starts, n)
    sets = [np.unique(grams[b:e]) for b, e in zip(begins[:-1], begins[1:], strict=True)]
    sizes = np.array([0, *map(len, sets)], np.int64)
    return (np.concatenate(sets) if sets else grams), np.cumsum(sizes)


def _digest(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def _roots(tokens: np.ndarray, begins: np.ndarray, threshold: float, runs: range) -> tuple[np.ndarray, np.ndarray]:
    """Paths of the first level in all ``runs``, and where each set's begin."""
    sets = len(begins) - 1
    rows, paths = [], []
    for r in runs:
        children, ends = _chosen(tokens, begins, np.full(sets, r + 1, np.uint64), threshold)
        rows.append(np.repeat(np.arange(sets), np.diff(ends)))
        paths.append(children)
    row = np.concatenate(rows)
    order = np.argsort(row, kind="stable")
    return np.concatenate(paths)[order], np.searchsorted(row[order], np.arange(sets + 1))


def _sketches(tokens: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A row of BINS bytes a set: of the least token in each bin, 0 if there is none."""
    sets = len(begins) - 1
    hashes = mixed(tokens, 21)
    place = np.repeat(np.arange(sets) * BINS, np.diff(begins)) + (hashes >> np.uint64(57)).astype(np.int64)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(sets * BINS, none)
    np.minimum.at(least, place, hashes << np.uint64(7))
    values = (mixed(least, 23) % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    values[least == none] = 0
    return values.reshape(sets, BINS)


def first_level(n: int, threshold: float, runs: range):
    """(doc_id, row_hash, set_id, n_tokens, sketch, paths) of each text: its buckets of the first level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for rows, texts in text_pieces(batch):
                tokens, begins = _token_sets(texts, hashes, n)
                digests = [_digest(tokens[b:e]) for b, e in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("row_hash"),
                        pa.array(digests, pa.binary()),
                        pa.array(np.diff(begins), pa.int64()),
                        pa.array([x.tobytes() for x in _sketches(tokens, begins)], pa.binary()),
                        long_list(*_roots(tokens, begins, threshold, runs)),
                    ],
                    ["doc_id", "row_hash", "set_id", "n_tokens", "sketch", "paths"],
                )

    return run


def keep_sets(n: int):
    """(set_id, tokens) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for _, texts in text_pieces(batch):
                tokens, begins = _token_sets(texts, hashes, n)
                own = [tokens[b:e] for b, e in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_digest(x) for x in own], pa.binary()),
                        pa.array([x.tobytes() for x in own], pa.binary()),
                    ],
                    ["set_id", "tokens"],
                )

    return run


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows with a sketch, the sketches' tokens (a bin with its byte is one), and where each row's begin."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sketches = _matrix(batch.column("sketch").cast(pa.binary()).to_pylist())
        rows, bins = np.nonzero(sketches)
        tokens = mixed((bins * 256 + sketches[rows, bins]).astype(np.uint64), 27)
        yield batch, tokens, np.searchsorted(rows, np.arange(len(sketches) + 1))


def _matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), BINS)


def _members(rows: pa.RecordBatch, paths: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """``MEMBER_SCHEMA`` for each path of each row."""
    place = pa.array(np.repeat(np.arange(rows.num_rows), np.diff(ends)))
    own = rows.select(CARRIED).take(place)
    return pa.RecordBatch.from_arrays([*own.columns, pa.array(paths.view(np.int64))], [*CARRIED, "bucket"])


def more_runs(threshold: float, runs: range):
    """``MEMBER_SCHEMA``: first-level buckets of sketches in further runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, tokens, begins in _sketched(batches):
            yield _members(rows, *_roots(tokens, begins, threshold, runs))

    return run


def next_level(threshold: float):
    """``MEMBER_SCHEMA``: the children of sets' buckets, a list in each row beside the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = ((x, pc.list_value_length(x.column("buckets")).to_pylist()) for x in batches)
        few = (x.slice(a, b - a) for x, sizes in lengths for a, b in pieces(sizes, 1 << 13))
        for rows, tokens, begins in _sketched(few):
            buckets = rows.column("buckets")
            paths = buckets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            # each set's tokens once for each of its buckets
            own = np.repeat(np.arange(rows.num_rows), pc.list_value_length(buckets).to_numpy(zero_copy_only=False))
            sizes = np.diff(begins)[own]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            children, cuts = _chosen(tokens[ranges(begins[:-1][own], sizes)], ends, paths, threshold)
            yield _members(rows.select(CARRIED).take(pa.array(own)), children, cuts)

    return run


def _close(
    sketches: np.ndarray, sizes: np.ndarray, mains: np.ndarray, bucket: int, threshold: float, rows: np.ndarray, others: np.ndarray
) -> np.ndarray:
    """Whether each set has a partner whose sketch and size allow for the threshold: pairs are of ``rows`` and ``others``.

    Sets with the same main bucket are partners in that one only.
    """
    found = np.zeros(len(sizes), bool)
    there = (sketches != 0).astype(np.float32)
    counts = there.sum(1)
    theirs, their_bins = sketches[others], there[others]
    step = max(1, (8 << 20) // (max(1, len(others)) * BINS))
    for a in range(0, len(rows), step):
        some = rows[a : a + step]
        # Equal bins are counted eight at a time, a byte each; bins without a token are equal in both and taken off.
        equal = (sketches[some][:, None, :] == theirs[None]).view(np.uint64).sum(2, dtype=np.uint64)
        equal = (equal * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.float32)
        both = there[some] @ their_bins.T
        either = counts[some][:, None] + counts[others][None] - both
        same = equal - (BINS - either)
        spread = np.sqrt(threshold * (1 - threshold) * np.maximum(either, 1))
        near = same >= threshold * either - SLACK * spread
        small, large = np.minimum(sizes[some][:, None], sizes[others][None]), np.maximum(sizes[some][:, None], sizes[others][None])
        near &= small >= threshold * large - 1e-6
        near &= (mains[some][:, None] != mains[others][None]) | (mains[some] == bucket)[:, None]
        near &= some[:, None] != others[None]
        found[some] |= near.any(1)
        found[others] |= near.any(0)
    return found


def _to_compare(key: tuple, mains: np.ndarray, blocks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and others whose pairs cover all that are to be compared under a key, each pair once or twice.

    The largest group that has its main bucket elsewhere is not compared with itself.
    """
    bucket, left, right = key
    apart = np.zeros(len(mains), bool)
    if (elsewhere := mains != bucket).any():
        values, counts = np.unique(mains[elsewhere], return_counts=True)
        apart = mains == values[counts.argmax()]
    if left == right:
        return [(np.flatnonzero(~apart), np.arange(len(mains)))]
    one, two = blocks == left, blocks == right
    return [(np.flatnonzero(a), np.flatnonzero(b)) for a, b in ((one & ~apart, two), (one & apart, two & ~apart))]


def plausible(threshold: float):
    """(bucket, left, right, block, set_id, main) of the sets that have a plausible partner in their block."""
    names = ["bucket", "left", "right", "block", "set_id", "main"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in keys_of(batches, ["bucket", "left", "right"]):
            mains, blocks, sizes = (rows.column(x).to_numpy() for x in ("main", "block", "n_tokens"))
            parts = [x for x in _to_compare(key, mains, blocks) if len(x[0]) and len(x[1])]
            if not parts:
                continue
            sketches = _matrix(rows.column("sketch").cast(pa.binary()).to_pylist())
            near = reduce(np.logical_or, [_close(sketches, sizes, mains, key[0], threshold, *x) for x in parts])
            if near.any():
                yield from rows.select(names).filter(pa.array(near)).combine_chunks().to_batches()

    return run


class _Block:
    """Sets that meet in one bucket, or in a pair of a large bucket's blocks."""

    def __init__(self, key: tuple, rows: pa.Table):
        self.key = key
        self.ids = rows.column("set_id").cast(pa.binary()).to_pylist()
        self.tokens = [np.frombuffer(x, np.uint64) for x in rows.column("tokens").cast(pa.binary()).to_pylist()]
        self.buckets = rows.column("buckets").to_pylist()
        self.copies = rows.column("copies").to_pylist()
        self.blocks = rows.column("block").to_numpy()
        self.mains = rows.column("main").to_numpy()

    def similar(self, threshold: float) -> np.ndarray:
        """Which sets are at least the threshold alike, compared exactly; only pairs that count in this bucket."""
        sizes = np.array([len(x) for x in self.tokens])
        _, place, counts = np.unique(np.concatenate(self.tokens), return_inverse=True, return_counts=True)
        common = _shared(place, counts, sizes)
        either = sizes[:, None] + sizes[None, :] - common
        # Equal to the threshold counts, so a hair of slack for the product.
        found = common >= threshold * either - 1e-6
        np.fill_diagonal(found, False)
        bucket, left, right = self.key
        if left != right:
            found &= self.blocks[:, None] != self.blocks[None, :]
        # A pair with one main bucket is counted there, another that also shares a lesser bucket in that one.
        alike = self.mains[:, None] == self.mains[None, :]
        found &= ~alike | (self.mains == bucket)[:, None]
        if (found & ~alike).any():
            lesser = [[x for x in own if x < bucket] for own in self.buckets]
            sizes = np.array([len(x) for x in lesser])
            if sizes.any():
                flat = np.fromiter((x for own in lesser for x in own), np.int64, int(sizes.sum()))
                _, place, counts = np.unique(flat, return_inverse=True, return_counts=True)
                found &= alike | (_shared(place, counts, sizes) == 0)
        return found

    def results(self, threshold: float, pairs: bool) -> Iterator[tuple]:
        """Links of each set that has some, and edges: all of them, or enough to hold groups together."""
        found = self.similar(threshold)
        texts = found.sum(axis=1)
        linked = np.flatnonzero(texts).tolist()
        rows = found @ np.array(self.copies, np.int64)
        if pairs:
            for a, b in np.argwhere(np.triu(found, 1)).tolist():
                yield self.ids[a], self.ids[b], 0, 0
        else:
            reached = np.zeros(len(texts), bool)
            for x in linked:
                new = [] if reached[x] else [x]
                reached[x] = True
                while len(new):
                    new = np.flatnonzero(found[new].any(axis=0) & ~reached)
                    reached[new] = True
                    for y in new.tolist():
                        yield self.ids[x], self.ids[y], 0, 0
        for x in linked:
            yield self.ids[x], None, int(texts[x]), int(rows[x])


def _shared(place: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many elements each two sets share: ``place`` numbers the elements of all sets in a row, ``counts`` is how
    many sets have each number."""
    shared = counts >= 2
    keep = shared[place]
    rows = np.repeat(np.arange(len(sizes)), sizes)[keep]
    columns = (np.cumsum(shared) - 1)[place[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    common = np.zeros((len(sizes), len(sizes)), np.float32)
    width = 2048
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(columns, [low, low + width])
        part = np.zeros((len(sizes), columns[b - 1] - low + 1), np.float32)
        part[rows[a:b], columns[a:b] - low] = 1
        common += part @ part.T
    return common


def compare(threshold: float, pairs: bool):
    """(set_id, other_id, texts, docs): exact comparison within each block of rows, in order of their blocks."""
    names = ["set_id", "other_id", "texts", "docs"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(x, kind) for x, kind in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for key, rows in keys_of(batches, ["bucket", "left", "right"]):
            for found in _Block(key, rows).results(threshold, pairs):
                held.append(found)
                if len(held) >= 20_000:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    return run


def _meeting(found: DataFrame) -> DataFrame:
    """Members of buckets that hold two sets or more, with sums that tell buckets of other members apart."""
    a, b = F.xxhash64("set_id"), F.xxhash64(F.lit(1), "set_id")
    sizes = found.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(a).alias("xor_a"), F.bit_xor(b).alias("xor_b")
    )
    return save(found.join(sizes.filter("members > 1"), "bucket"), "ngram-members")


def _probe(sketch: Column) -> Column:
    """PROBES bins of a sketch, two bits each: whether there is a token, and whether its byte is odd."""
    step = BINS // PROBES
    values = [F.conv(F.hex(F.substring(sketch, 1 + i * step, 1)), 16, 10).cast("int") for i in range(PROBES)]
    bits = [F.shiftleft((x > 0).cast("long") + x % 2 * 2, 2 * i) for i, x in enumerate(values)]
    return reduce(Column.__add__, bits)


def _dense(large: DataFrame, probe: Column | None = None) -> DataFrame:
    """Buckets whose sets are nearly all alike, by the probes (else the sketches) of their members.

    No two sets are brought together. Let a bin's odd bytes count 1 and its even ones -1: the square of their sum is, on
    average over the bins, the number of ordered pairs of sets with the same byte.
    """
    probe = _probe(F.col("sketch")) if probe is None else probe
    bits = [F.shiftright(probe, 2 * i).bitwiseAND(F.lit(3)) for i in range(PROBES)]
    there = [F.sum((x > 0).cast("int")).cast("double") for x in bits]
    signs = [F.sum(F.when(x == 3, 1).when(x == 1, -1).otherwise(0)).cast("double") for x in bits]
    sums = [c.alias(f"{name}{i}") for name, part in (("c", there), ("s", signs)) for i, c in enumerate(part)]
    found = large.groupBy("bucket").agg(F.count(F.lit(1)).cast("double").alias("n"), *sums)
    without = [F.col("n") - F.col(f"c{i}") for i in range(PROBES)]
    either = reduce(Column.__add__, [F.col("n") * F.col("n") - x * x for x in without])
    same = reduce(Column.__add__, [F.col(f"s{i}") * F.col(f"s{i}") for i in range(PROBES)])
    return found.filter(same >= DENSE * either).select("bucket")


def _settled(members: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """Members of buckets that are small or dense, and of those that are to be split."""
    large = members.filter(F.col("members") > small)
    dense = save(_dense(large, F.col("probe")), "ngram-dense")
    done = members.filter(F.col("members") <= small).unionByName(large.join(dense, "bucket", "left_semi"))
    return done, large.join(dense, "bucket", "left_anti")


def _compared(sets: DataFrame, first: DataFrame, threshold: float, runs: range, levels: int, small: int) -> DataFrame:
    """Members of all buckets that are to be compared. ``runs`` are for sets that were in a bucket that is split."""
    if levels == 1 or first.filter(F.col("members") > small).isEmpty():
        return first
    done, large = _settled(first, small)
    if large.isEmpty():
        return done
    again = sets.join(large.select("set_id").distinct(), "set_id", "left_semi")
    further = _meeting(save(again.mapInArrow(more_runs(threshold, runs), MEMBER_SCHEMA), "ngram-level"))
    more_done, more = _settled(further, small)
    done, large = done.unionByName(more_done), large.unionByName(more)
    for level in range(2, levels + 1):
        # A set meets its sketch once, whatever the number of its buckets.
        split = large.groupBy("set_id").agg(F.collect_list("bucket").alias("buckets"))
        children = split.join(sets, "set_id").mapInArrow(next_level(threshold), MEMBER_SCHEMA)
        members = _meeting(save(children, "ngram-level"))
        if level == levels:
            return done.unionByName(members)
        below, large = _settled(members, small)
        done = done.unionByName(below)
        if large.isEmpty():
            return done
    return done


def _with_main(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(set_id, n_tokens, sketch, main, buckets): a row for each set of the buckets to be compared, with its main bucket,
    the largest, and (members, bucket) of all of them. A set meets its sketch once, whatever the number of its buckets.

    Of buckets with the same members the least stays: each of their sets has all of them, so its own list tells which.
    """
    # both sums are made where the set's rows are
    distinct = members.repartition("set_id").groupBy("set_id", "members", "xor_a", "xor_b").agg(F.min("bucket").alias("bucket"))
    own = distinct.groupBy("set_id").agg(F.collect_list(F.struct("members", "bucket")).alias("buckets"))
    own = own.withColumn("main", F.array_max("buckets")["bucket"])
    return own.join(sets.select("set_id", "n_tokens", "sketch"), "set_id").select("set_id", "n_tokens", "sketch", "main", "buckets")


def _blocks(compared: DataFrame, block: int) -> DataFrame:
    """Members with the pairs of blocks they take part in; most buckets are one block.

    A block has about ``block`` sets, fewer if they are so long that BLOCK_TOKENS would be passed. A bucket whose sets
    have one main bucket, another one, has nothing left to compare.
    """
    members = compared.withColumn("own", F.explode("buckets")).drop("buckets").select("*", "own.*").drop("own")
    sums = members.groupBy("bucket").agg(
        F.sum("n_tokens").alias("all_tokens"), F.min("main").alias("least"), F.max("main").alias("most")
    )
    sums = sums.filter("least != most or least = bucket").select("bucket", "all_tokens")
    known = members.join(sums, "bucket")
    by_sets, by_tokens = F.col("members") / block, F.col("all_tokens") / BLOCK_TOKENS
    blocks = F.ceil(F.greatest(by_sets, by_tokens)).cast("int")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    split = known.withColumn("blocks", blocks).withColumn("block", own)
    # Most buckets are one block: only the others' rows are repeated.
    one = split.filter("blocks = 1").withColumns({"left": F.lit(0), "right": F.lit(0)})
    more = split.filter("blocks > 1").withColumn("against", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    more = more.withColumns({"left": F.least("block", "against"), "right": F.greatest("block", "against")})
    columns = ["bucket", "left", "right", "block", "set_id", "main", "n_tokens", "sketch"]
    return one.select(columns).unionByName(more.select(columns))


class NgramJoin:
    """The join of ``docs`` with itself. ``classes`` and ``pairs`` are its results."""

    def __init__(
        self,
        docs: DataFrame,
        n: int = WORDS,
        threshold: float = THRESHOLD,
        recall: float = RECALL,
        levels: int = LEVELS,
        small: int = SMALL,
        block: int = BLOCK,
        pairs: bool = False,
    ):
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {kind}, row_hash long, set_id binary, n_tokens long, sketch binary, paths array<long>"
        few, all_runs = runs_needed(recall, 1), runs_needed(recall, levels)
        paths = save(rows.mapInArrow(first_level(n, threshold, range(few)), schema), "ngram-paths")
        self.membership = paths.select("doc_id", "row_hash", "set_id", "n_tokens")
        # Rows of one set have the same tokens: one row speaks for all.
        one = F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row_hash")).alias("one")
        same_for_all = [F.any_value(x).alias(x) for x in ("n_tokens", "sketch", "paths")]
        classes = paths.filter("n_tokens > 0").groupBy("set_id")
        sets = classes.agg(F.count(F.lit(1)).alias("copies"), one, *same_for_all)
        sets = self.sets = save(sets.withColumn("probe", _probe(F.col("sketch"))), "ngram-sets")

        first = _meeting(sets.select(*CARRIED, F.explode(F.array_distinct("paths")).alias("bucket")))
        members = _compared(sets.select(*CARRIED, "sketch"), first, threshold, range(few, all_runs), levels, small)
        keys = ["bucket", "left", "right"]
        blocks = _blocks(save(_with_main(members, sets), "ngram-compared"), block)
        near = blocks.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
            plausible(threshold), "bucket long, left int, right int, block int, set_id binary, main long"
        )
        near = save(near, "ngram-plausible")

        takes_part = sets.join(near.select("set_id").distinct(), "set_id", "left_semi")
        wanted = takes_part.select(F.col("one.doc_id").alias("one_id"), F.col("one.row_hash").alias("one_hash"))
        same = F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("row_hash") == F.col("one_hash"))
        found = rows.join(wanted, same, "left_semi").mapInArrow(keep_sets(n), "set_id binary, tokens binary")
        # Only rows that repeat a doc_id with its text give a set twice.
        tokens = save(found.dropDuplicates(["set_id"]), "ngram-tokens")
        # A set meets its tokens once; they are repeated for its blocks on the way there.
        meets = near.groupBy("set_id").agg(
            F.collect_set("bucket").alias("buckets"), F.collect_list(F.struct(*keys, "block", "main")).alias("places")
        )
        own = tokens.join(meets, "set_id").join(sets.select("set_id", "copies"), "set_id")
        exact = own.withColumn("place", F.explode("places")).select("set_id", "place.*", "tokens", "buckets", "copies")
        exact = exact.repartition(*keys).sortWithinPartitions(*keys)
        out = "set_id binary, other_id binary, texts long, docs long"
        self.found = save(exact.mapInArrow(compare(threshold, pairs), out), "ngram-links")

    def pairs(self) -> DataFrame:
        """(set_id, other_id) of linked classes; all of them if the join was made with ``pairs=True``."""
        return self.found.filter("other_id is not null").select("set_id", "other_id")

    def classes(self) -> DataFrame:
        """A row for each row of ``docs``: doc_id, class_id, n_links, n_text_links.

        class_id is the smallest doc_id of the connected group; n_links counts the rows linked with the
        row, its copies included; n_text_links counts the other sets linked with its own.
        """
        return self._classes().drop("row_hash")

    def _classes(self) -> DataFrame:
        """The same with row_hash, which tells rows of one doc_id apart by their texts."""
        counts = self.found.filter("other_id is null").groupBy("set_id").agg(
            F.sum("texts").alias("texts"), F.sum("docs").alias("docs")
        )
        links = self.pairs().withColumnsRenamed({"set_id": "node", "other_id": "other"})
        roots = components(links, "ngram").withColumnRenamed("node", "set_id")
        sets = (
            self.sets.select("set_id", "copies", F.col("one.doc_id").alias("one_id"))
            .join(counts, "set_id", "left")
            .join(roots, "set_id", "left")
            .withColumn("root", F.coalesce("root", "set_id"))
        )
        least = sets.groupBy("root").agg(F.min("one_id").alias("class_id"))
        links = sets.join(least, "root").select(
            "set_id",
            "class_id",
            (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
            F.coalesce("texts", F.lit(0)).alias("n_text_links"),
        )
        linked = self.membership.join(links, "set_id", "left")
        alone = F.col("n_tokens") == 0
        return linked.select(
            "doc_id",
            "row_hash",
            F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"),
        )


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``NgramJoin(docs).classes()``."""
    return NgramJoin(docs, **options).classes()


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their class's smallest, with all their columns.

    Rows with a null doc_id stay. Rows are told apart by doc_id and text: of two texts with one doc_id, one may go as a
    near copy while the other stays.
    """
    gone = NgramJoin(docs, **options)._classes().filter("doc_id != class_id")
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("row_hash").alias("gone_hash")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("row_hash"))
    same = (F.col("doc_id") == F.col("gone_id")) & (F.col("row_hash") == F.col("gone_hash"))
    return rows.join(gone, same, "left_anti").select("row.*")
