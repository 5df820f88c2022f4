"""What several operators share: words, their hashes, ragged arrays, and tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.session import scratch_dir

# A word is a run of [^\x20\x09-\x0D], which is what bytes.split() splits by.
WHITESPACE = r"[\x20\x09-\x0D]+"

_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def save(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` below ``spark.checkpoint.dir`` and reads it back: lineage ends there."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): whole rows beside what is needed, so that no other column's name can clash."""
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_pieces(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows with their texts, about ``most`` bytes at a time: a batch of long texts is never unpacked whole."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    for begin, end in pieces(sizes, most):
        rows = batch.slice(begin, end - begin)
        yield rows, text_bytes(rows.column("text"))


def pieces(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum to ``most`` or little more, one row at least."""
    begin = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield begin, end
            begin, total = end, 0
    if begin < end:
        yield begin, end


class WordHashes(dict):
    """64-bit hash of a word, remembered for up to ``limit`` words of a Python worker."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words of all texts in a row, and where each text's words begin (one place more than texts)."""
    words: list[bytes] = []
    ends = [0]
    for text in texts:
        words += text.split()
        ends.append(len(words))
    return words, np.array(ends, np.int64)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads 64-bit values (splitmix64's finaliser), another way for each seed."""
    x = x + np.uint64((seed * _ODD[0] + _ODD[0]) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_ODD[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_ODD[2])
    return x ^ (x >> np.uint64(31))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on; the last n - 1 places have none."""
    size = max(0, len(words) - n + 1)
    out = words[:size].copy()
    for k in range(1, n):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(_ODD[k % 3]) + words[k : k + size]
    return mixed(out, n)


def shingles(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-word shingles of each text in order, and where each text's shingles begin.

    A text of fewer than n words, but at least one, has one shingle: all its words.
    """
    lengths = np.diff(starts)
    counts = np.where(lengths >= n, lengths - n + 1, lengths > 0)
    begins = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = np.empty(begins[-1], np.uint64)
    long = lengths >= n
    grams = ngram_hashes(words, n)
    place = ranges(starts[:-1][long], counts[long])
    out[ranges(begins[:-1][long], counts[long])] = grams[place]
    for i in np.flatnonzero((lengths > 0) & ~long):
        own = words[starts[i] : starts[i + 1]]
        out[begins[i]] = mixed(ngram_hashes(own, len(own)), len(own))[0]
    return out, begins


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] numbers, then the same for the next."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def long_list(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    """A list<int64> column from ragged values."""
    return pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(values.view(np.int64), pa.int64())
    )


class Vocabulary(dict):
    """Numbers distinct words of a Python worker in order of appearance; ``words`` has those of the numbers.

    An owner keeps what it knows of each word in tables by number. ``trim`` forgets all words once there are
    more than ``limit``, so memory is bounded; words that come again are worked out again.
    """

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit
        self.words: list = []

    def __missing__(self, word) -> int:
        self[word] = place = len(self.words)
        self.words.append(word)
        return place

    def numbers(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def trim(self) -> bool:
        if len(self) <= self.limit:
            return False
        self.clear()
        self.words = []
        return True


def keys_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of one key after the other, of batches in order of their keys."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        columns = [batch.column(x).to_numpy(zero_copy_only=False) for x in keys]
        turns = np.zeros(batch.num_rows, bool)
        for x in columns:
            turns[1:] |= x[1:] != x[:-1]
        cuts = [0, *np.flatnonzero(turns).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            own = tuple(x[a].item() for x in columns)
            if own != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = own
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def least_hashed(rows: DataFrame, hashed: str, most: int) -> DataFrame:
    """Distinct ``rows``, at most ``most``: those of the smallest 64-bit hash, a long column of theirs.

    Rows beyond a bound on the hash, which follows from how many hashes there are, are left out first: about twice as many
    as are asked for are sorted, whatever the table.
    """
    there = rows.agg(F.approx_count_distinct(hashed).alias("n")).first()["n"]
    share = 2.0 * (most + 50) / max(1, there)
    if share < 1:
        rows = rows.filter(F.col(hashed) < F.lit(int(share * 2**64) - 2**63))
    return rows.distinct().orderBy(hashed, *[x for x in rows.columns if x != hashed]).limit(most)


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root): the least node of each connected group of (node, other) links.

    Nodes take the least label of their neighbours, then that label's own, until nothing changes.
    """
    turned = links.select(F.col("other").alias("node"), F.col("node").alias("other"))
    both = save(links.unionByName(turned).distinct(), f"{label}-edges")
    labels = both.groupBy("node").agg(F.min("other").alias("least"))
    labels = save(labels.select("node", F.least("least", "node").alias("root")), f"{label}-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other")
        hooked = labels.join(near.groupBy("node").agg(F.min("root").alias("near")), "node")
        hooked = hooked.select("node", "root", F.least("root", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("root").alias("further"))
        changed = (F.col("further") != F.col("root")).alias("changed")
        moved = save(hooked.join(jump, "new").select("node", F.col("further").alias("root"), changed), f"{label}-labels")
        labels = moved.select("node", "root")
        if moved.filter("changed").isEmpty():
            return labels
