"""Quality rules: plain counts, and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are fitted: the raw corpus's on all documents, the trusted target's on all
that are labelled so. The raw counts need no labels, so no text moves for them. For the target's, a bitmap of fixed size
holds back documents that cannot be trusted, and the others meet the trusted ids in a shuffle, which decides. A document's
score is the mean of log p_target / p_raw over its n-grams, so length does not count. Documents below a fixed threshold
are rejected; nothing is drawn at random.

n-grams are single marks and pairs of neighbours, a mark being a word's letters or its adjoining signs:
``[^\\w]+`` runs at the end of a word count on their own, so that junk signs weigh even behind new words.

Defined results: null and empty texts have no words, score 0 and fail the base rules; rows with a null doc_id
are scored like others and never count as trusted; repeated rows count each time; labels may repeat or
contradict each other (a document is trusted if any of its labels says so and none says it is bad); with no
trusted document at all every score is 0; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from starmill.llm.common import Vocabulary, mixed, ngram_hashes, ranges, save, text_pieces

BITS = 18
LEAST_WORDS, MOST_REPEATED = 50, 50
THRESHOLD = -0.4
ADDED = 5.0
# Bits of the bitmap of trusted ids, as a power of two: 4 MB, whatever the ids.
MARK_BITS = 25

SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r "

COUNT_SCHEMA = "bucket int, n long"
BASE_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


class _Marks:
    """Hashes of a word's marks: its stem, and the signs behind it (0 if there are none)."""

    _SIGNS = re.compile(r"[^\w]+$")

    def __init__(self, limit: int = 300_000):
        self.known = Vocabulary(limit)
        self.stems = np.empty(0, np.uint64)
        self.signs = np.empty(0, np.uint64)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if self.known.trim():
            self.stems = self.signs = np.empty(0, np.uint64)
        numbers = self.known.numbers(words)
        fresh = self.known.words[len(self.stems) :]
        if fresh:
            stems, signs = [], []
            for word in fresh:
                text = word.decode("utf-8", "replace")
                tail = self._SIGNS.search(text)
                sign = tail.group() if tail else ""
                stem = text[: len(text) - len(sign)]
                stems.append(xxhash.xxh3_64_intdigest(stem) if stem else 0)
                signs.append(xxhash.xxh3_64_intdigest(sign, 1) if sign else 0)
            self.stems = np.concatenate([self.stems, np.array(stems, np.uint64)])
            self.signs = np.concatenate([self.signs, np.array(signs, np.uint64)])
        return self.stems[numbers], self.signs[numbers]


def _chunk(texts: list[bytes], marks: _Marks):
    """Word hashes of a chunk's texts in a row, where each text's begin, and n-gram buckets with theirs."""
    words: list[bytes] = []
    starts = [0]
    for text in texts:
        words += text.split()
        starts.append(len(words))
    starts = np.array(starts, np.int64)
    stems, signs = marks.of(words)
    both = np.empty(2 * len(words), np.uint64)
    both[0::2], both[1::2] = stems, signs
    there = both != 0
    row = both[there]
    begins = np.concatenate([[0], np.cumsum(there)])[2 * starts]
    lengths = np.diff(begins)
    pairs = ngram_hashes(row, 2)
    inner = pairs[ranges(begins[:-1], np.maximum(lengths - 1, 0))]
    shift = np.uint64(64 - BITS)
    single = (mixed(row, 1) >> shift).astype(np.int64)
    double = (mixed(inner, 2) >> shift).astype(np.int64)
    after = np.concatenate([[0], np.cumsum(np.maximum(lengths - 1, 0))])
    whole = (stems ^ (signs << np.uint64(1))) + np.uint64(1)
    return whole, starts, (single, begins), (double, after)


def count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, n) over all texts of a task."""
    marks, totals = _Marks(), np.zeros(1 << BITS, np.int64)
    for batch in batches:
        for _, texts in text_pieces(batch):
            _, _, *grams = _chunk(texts, marks)
            for values, _ in grams:
                totals += np.bincount(values, minlength=1 << BITS)
    there = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(totals[there])], ["bucket", "n"])


def _repeated(words: np.ndarray) -> int:
    """Words in three-word windows found twice or more."""
    if len(words) < 4:
        return 0
    windows = ngram_hashes(words, 3)
    in_order = np.sort(windows)
    again = in_order[1:][in_order[1:] == in_order[:-1]]
    if not len(again):
        return 0
    found = np.isin(windows, again)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(windows)] |= found
    return int(covered.sum())


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[begins[1:]] - sums[begins[:-1]]


class _Judge:
    """Counts, score and verdict of texts."""

    def __init__(self, ratios: np.ndarray, threshold: float):
        self.ratios, self.threshold, self.marks = ratios, threshold, _Marks()

    def columns(self, raw: list[bytes]) -> dict[str, pa.Array]:
        texts = [x.decode() for x in raw]
        words, starts, (single, ones), (double, twos) = _chunk(raw, self.marks)
        log = _sums(self.ratios[single], ones) + _sums(self.ratios[double], twos)
        scores = log / np.maximum(np.diff(ones) + np.diff(twos), 1)
        lines = [[x for x in text.split(b"\n") if x.strip()] for text in raw]
        n = np.diff(starts)
        again = np.array([_repeated(words[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)], np.int64)
        failed = (n < LEAST_WORDS) | (100 * again > MOST_REPEATED * n)
        return {
            "n_words": pa.array(n),
            "word_chars": pa.array([len(x) - sum(map(x.count, SPACES)) for x in texts], pa.int64()),
            "n_symbols": pa.array([sum(map(x.count, SYMBOLS)) for x in texts], pa.int64()),
            "n_dup_lines": pa.array([len(x) - len(set(x)) for x in lines], pa.int64()),
            "n_repeat_words": pa.array(again),
            "score": pa.array(scores),
            "base_failed": pa.array(failed),
            "kept": pa.array(~failed & (scores >= self.threshold)),
        }


def judge(ratios: np.ndarray, threshold: float, keep: bool):
    """doc_id with counts, score and verdict of each row; or, to ``keep``, the rows that are kept as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Judge(ratios, threshold)
        for batch in batches:
            for rows, texts in text_pieces(batch):
                columns = found.columns(texts)
                if keep:
                    yield rows.filter(columns["kept"])
                else:
                    own = [rows.column("doc_id"), *columns.values()]
                    yield pa.RecordBatch.from_arrays(own, ["doc_id", *columns])

    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents that are labelled good and clean, and never otherwise."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    votes = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
    return votes.filter("good").select("doc_id")


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id has its bit set by one of ``ids``: all that are among them, and a share of the others."""
    if docs.schema["doc_id"].dataType != ids.schema["trusted_id"].dataType:
        # hashes of two types differ
        return docs
    of_id, of_doc = (F.xxhash64(x).bitwiseAND(F.lit((1 << MARK_BITS) - 1)) for x in ("trusted_id", "doc_id"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(of_id)).alias("bits")
    bitmap = ids.groupBy(F.bitmap_bucket_number(of_id).alias("part")).agg(bits)
    place = F.bitmap_bit_position(of_doc)
    byte = F.substring("bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))
    bit = F.call_function("shiftleft", F.lit(1), place.bitwiseAND(F.lit(7)).cast("int"))
    is_set = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) != 0
    return docs.join(F.broadcast(bitmap), (F.bitmap_bucket_number(of_doc) == F.col("part")) & is_set, "left_semi")


def _totals(docs: DataFrame) -> np.ndarray:
    """n-grams of all texts by bucket. 2^BITS numbers reach the driver, whatever the texts."""
    found = docs.select("text").mapInArrow(count_ngrams, COUNT_SCHEMA).groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros(1 << BITS)
    totals[found["bucket"]] = found["n"]
    return totals


def log_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray:
    """log p_target / p_raw by bucket, smoothed."""
    ids = save(trusted.select(F.col("doc_id").alias("trusted_id")), "trusted")
    # Ids are never sent around, however few: what moves grows in proportion from the smallest table on.
    own = _marked(docs.select("doc_id", "text"), ids)
    own = own.join(ids.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left_semi")
    counts = np.stack([_totals(own), _totals(docs)])
    if not counts[0].sum():
        return np.zeros(1 << BITS)
    # Raw counts are brought to the target's total, and both get the same added counts: a bucket seen rarely
    # says little either way, so documents outside the target don't lose by their rare words.
    target_counts, raw_counts = counts
    expected = raw_counts * (target_counts.sum() / raw_counts.sum())
    return np.log((target_counts + ADDED) / (expected + ADDED))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the plain counts, score, base_failed and kept of every document."""
    ratios = log_ratios(docs, trusted_ids(labels))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {BASE_SCHEMA}, score double, base_failed boolean, kept boolean"
    return docs.select("doc_id", "text").mapInArrow(judge(ratios, threshold, False), schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    ratios = log_ratios(docs, trusted_ids(labels))
    return docs.mapInArrow(judge(ratios, threshold, True), docs.schema)
