"""Mixing to target weights with soft domain membership.

A classifier trained on the labelled table gives each document a posterior over domains. The unknowns are one
rate a document, at least 0: how often it is to be read. Projected-gradient least squares fits them, from
1 each, so that the expected tokens of each domain, summed over documents as rate x tokens x
posterior, match the targets. The squares are weighed by the inverse of sum(tokens x posterior x posterior'),
which makes the plain step right unless rates stop at 0. Rates have no upper bound unless ``most_rate`` sets one;
then the total is lowered as far as the targets' ratios need it. A step is one aggregation over the slim
table of posteriors; only sums by domain reach the driver, and the rates follow from the steps' few numbers.

Training takes at most ``MOST_LABELLED`` labelled documents, those of the smallest hash of their id; the fit and
everything else cover all documents. A document's tokens are its words with a letter or digit.

Defined results: null text is empty, with no tokens; labels with nulls, or several that disagree on a document,
are left out of the training; without labelled documents the posterior is empty and every rate is 1; with
one labelled domain every document belongs to it; a domain without mass cannot reach its target, the
others do; targets that no rates reach are met as nearly as the steps lead; a null doc_id is scored like others; repeated rows are mixed alike; empty
tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm.common import Vocabulary, packed, save, text_pieces

DOMAINS = ("good", "poor", "toxic")
WEIGHTS = {"good": 0.97, "poor": 0.02, "toxic": 0.01}
MOST_LABELLED = 20_000
FEATURES = 1 << 14
MOST_RATE = math.inf
MOST_STEPS, NEAR = 40, 1e-6
# For a bounded rate's total.
HALVINGS, BOUNDED_NEAR = 10, 1e-4
SMALLEST_PART, DIVERGED = 5, 10
# Of the L1 norm: few words tell domains apart.
PENALTY = 0.002

SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHAPES = 5


class _Describer:
    """Tokens, hashed words (each once) and shapes of texts."""

    _OTHER = re.compile(r"[\W_]+")

    def __init__(self) -> None:
        self.words = Vocabulary()
        self.buckets = np.empty(0, np.int64)

    def _bucket(self, word: bytes) -> int:
        plain = self._OTHER.sub("", word.decode("utf-8", "replace").lower())
        return xxhash.xxh3_64_intdigest(plain) % FEATURES if plain else -1

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of each text, pairs (text, bucket) in order, and shapes by text."""
        if self.words.trim():
            self.buckets = np.empty(0, np.int64)
        words = [x.split() for x in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        numbers = self.words.numbers([y for x in words for y in x])
        fresh = self.words.words[len(self.buckets) :]
        self.buckets = np.concatenate([self.buckets, np.fromiter(map(self._bucket, fresh), np.int64, len(fresh))])
        bucket, text = self.buckets[numbers], np.repeat(np.arange(len(texts)), counts)
        there = bucket >= 0
        tokens = np.bincount(text[there], minlength=len(texts))
        text, bucket = np.divmod(np.unique(text[there] * FEATURES + bucket[there]), FEATURES)
        sizes = np.array([max(len(x), 1) for x in texts])
        lines = [x.split(b"\n") for x in texts]
        shapes = [
            10 * np.array([len(x) - len(x.translate(None, SYMBOLS)) for x in texts]) / sizes,
            10 * np.array([len(x) - len(x.translate(None, CAPITALS)) for x in texts]) / sizes,
            10 * np.array([1 - len(set(x)) / len(x) for x in lines]),
            sizes / np.maximum(counts, 1) / 10,
            np.log1p(counts) / 10,
        ]
        return tokens, text, bucket, np.stack(shapes, 1).reshape(len(texts), SHAPES)


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(domain, buckets, shapes) of labelled texts."""
    known = _Describer()
    for batch in batches:
        for rows, texts in text_pieces(batch):
            _, text, bucket, shapes = known.of(texts)
            ends = np.searchsorted(text, np.arange(len(texts) + 1))
            buckets = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bucket, pa.int32()))
            columns = [rows.column("domain"), buckets, pa.array(shapes.tolist())]
            yield pa.RecordBatch.from_arrays(columns, ["domain", "buckets", "shapes"])


def posteriors(weights: np.ndarray, intercepts: np.ndarray):
    """(doc_id, row_hash, tokens, posterior) of each text; ``weights`` has a row a domain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words, rest = _Describer(), weights[:, :FEATURES].T.copy(), weights[:, FEATURES:].T
        for batch in batches:
            for rows, texts in text_pieces(batch):
                tokens, text, bucket, shapes = known.of(texts)
                sums = np.concatenate([np.zeros((1, len(intercepts))), np.cumsum(words[bucket], 0)])
                ends = np.searchsorted(text, np.arange(len(texts) + 1))
                margins = sums[ends[1:]] - sums[ends[:-1]] + shapes @ rest + intercepts
                odds = np.exp(margins - margins.max(1, keepdims=True))
                columns = [pa.array(tokens, pa.int64()), pa.array((odds / odds.sum(1, keepdims=True)).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("row_hash"), *columns],
                    ["doc_id", "row_hash", "tokens", "posterior"],
                )

    return run


def domain() -> Column:
    """The domain a row of the labels names; null if it names none."""
    good = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("toxic") == 0, good)


def labelled_sample(labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, domain) of at most ``most`` documents whose labels agree."""
    named = labels.select("doc_id", domain().alias("domain")).filter("doc_id is not null and domain is not null")
    votes = named.groupBy("doc_id").agg(F.min("domain").alias("domain"), F.max("domain").alias("other"))
    agreed = votes.filter("domain = other").select("doc_id", "domain")
    return agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


class DomainClassifier:
    """Multinomial logistic regression on hashed words and shapes."""

    def __init__(self, docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED):
        known = save(labelled_sample(labels, most), "mix-labels")
        # At most ``most`` ids, whatever the corpus, so this side may be broadcast.
        texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("domain", "text")
        described = texts.mapInArrow(describe, "domain string, buckets array<int>, shapes array<double>")
        sample = save(described, "mix-sample")
        found = {r[0] for r in sample.select("domain").distinct().collect()}
        self.domains = [x for x in DOMAINS if x in found]
        size = FEATURES + SHAPES
        self.weights, self.intercepts = np.zeros((len(self.domains), size)), np.zeros(len(self.domains))
        if len(self.domains) > 1:

            @F.udf(VectorUDT(), useArrow=False)
            def vector(buckets, shapes):
                places = [*buckets, *range(FEATURES, size)]
                return SparseVector(size, places, [1.0] * len(buckets) + list(shapes))

            place = F.array_position(F.array(*map(F.lit, self.domains)), F.col("domain")) - 1
            learner = LogisticRegression(family="multinomial", maxIter=60, regParam=PENALTY, elasticNetParam=1.0)
            model = learner.fit(sample.select(vector("buckets", "shapes").alias("features"), place.cast("double").alias("label")))
            self.weights, self.intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()

    def posteriors(self, docs: DataFrame) -> DataFrame:
        """(doc_id, row_hash, tokens, posterior): an array in the order of ``domains``, empty without domains."""
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        weights, intercepts = (self.weights, self.intercepts) if self.domains else (np.zeros((1, FEATURES + SHAPES)), np.zeros(1))
        scored = rows.mapInArrow(
            posteriors(weights, intercepts), f"doc_id {kind}, row_hash long, tokens long, posterior array<double>"
        )
        return scored if self.domains else scored.withColumn("posterior", F.array().cast("array<double>"))


@dataclass
class Fit:
    """The steps taken, and expected tokens by domain at their end."""

    domains: list[str]
    steps: list[list[float]]
    reached: list[float]
    targets: list[float]
    most_rate: float = MOST_RATE

    def rate(self, posterior: str = "posterior") -> Column:
        """A document's rate: each step lowers it by posterior x step, to 0 at least and ``most_rate`` at most."""
        rate = F.lit(1.0)
        for step in self.steps:
            lower = sum((F.col(posterior)[k] * x for k, x in enumerate(step)), F.lit(0.0))
            rate = F.least(F.lit(self.most_rate), F.greatest(F.lit(0.0), rate - lower))
        return rate


def fit_rates(
    slim: DataFrame,
    domains: list[str],
    weights: dict[str, float] | None = None,
    total: float | None = None,
    most_rate: float = MOST_RATE,
) -> Fit:
    """Rates for (tokens, posterior) rows; ``total`` tokens are to be expected, by default as many as there are.

    With ``most_rate``, the most of that total for which rates reach the targets' ratios, to one part in 2^HALVINGS.
    """
    weights = weights or WEIGHTS
    if not domains:
        return Fit(domains, [], [], [], most_rate)
    size = len(domains)
    p = [F.col("posterior")[k] for k in range(size)]
    there = np.array([x or 0.0 for x in slim.agg(*[F.sum(F.col("tokens") * x) for x in p]).first()])
    share = np.array([weights.get(x, 0.0) for x in domains])
    if not share.sum() or not there.sum():
        return Fit(domains, [], there.tolist(), there.tolist(), most_rate)
    targets = share / share.sum() * (there.sum() if total is None else total)
    fit = _fitted(slim, domains, targets, most_rate)
    if math.isinf(most_rate) or _is_near(fit, there):
        return fit
    low, high, reached = 0.0, 1.0, None
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        tried = _fitted(slim, domains, targets * middle, most_rate)
        if _is_near(tried, there):
            low, reached = middle, tried
        else:
            high = middle
    return reached or fit


def _is_near(fit: Fit, there: np.ndarray) -> bool:
    """Whether each domain that has any mass reaches its target."""
    off = np.abs(np.array(fit.reached) - fit.targets)[there > 0]
    return not len(off) or off.max() <= BOUNDED_NEAR * sum(fit.targets)


def rated_sums(size: int, steps: list[list[float]], most_rate: float):
    """A task's expected tokens by domain at the rates after ``steps``, and their cross sums where rates can move."""
    moves = [np.array(x) for x in steps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size + size * size)
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = batch.column("tokens").to_numpy(zero_copy_only=False).astype(float)
            p = batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            rate = np.ones(len(tokens))
            for step in moves:
                rate = np.minimum(most_rate, np.maximum(0.0, rate - p @ step))
            free = tokens * ((rate > 0) & (rate < most_rate))
            found += np.concatenate([(tokens * rate) @ p, ((p * free[:, None]).T @ p).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([found.tolist()])], ["sums"])

    return run


def _fitted(slim: DataFrame, domains: list[str], targets: np.ndarray, most_rate: float) -> Fit:
    """Rates whose totals are nearest to the targets."""
    fit, size = Fit(domains, [], [], targets.tolist(), most_rate), len(domains)

    def sums() -> tuple[np.ndarray, np.ndarray]:
        parts = slim.select("tokens", "posterior").mapInArrow(rated_sums(size, fit.steps, most_rate), "sums array<double>")
        values = np.array([x or 0.0 for x in parts.agg(*[F.sum(F.col("sums")[k]) for k in range(size + size * size)]).first()])
        return values[:size], values[size:].reshape(size, size)

    def off() -> float:
        return float(np.abs(there - targets)[mass].max())

    there, gram = sums()
    # A domain without mass stays at 0 whatever the rates.
    mass = there > 0
    nearest = (off(), 0, there, gram)
    while len(fit.steps) < MOST_STEPS and NEAR * targets.sum() < off() <= DIVERGED * nearest[0]:
        step = np.linalg.pinv(gram) @ (there - targets)
        if not step.any():
            break
        fit.steps.append(step.tolist())
        there, gram = sums()
        if off() < nearest[0]:
            nearest = (off(), len(fit.steps), there, gram)
    # Targets that no rates reach make plain steps grow: from the nearest point they go on by parts that lead nearer.
    _, kept, there, gram = nearest
    del fit.steps[kept:]
    while len(fit.steps) < MOST_STEPS and off() > NEAR * targets.sum():
        before, point, step = off(), (there, gram), np.linalg.pinv(gram) @ (there - targets)
        for part in range(SMALLEST_PART if step.any() else 0):
            fit.steps.append((step / 2**part).tolist())
            there, gram = sums()
            if off() < before * (1 - 1e-2):
                break
            fit.steps.pop()
            there, gram = point
        else:
            break
    fit.reached = there.tolist()
    return fit


def _uniform(*columns: str) -> Column:
    """In [0, 1), the same for the same values."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(17), *columns), 11) / F.lit(float(1 << 53))


def mixed_rates(
    docs: DataFrame,
    labels: DataFrame,
    weights: dict[str, float] | None = None,
    total: float | None = None,
    most_rate: float = MOST_RATE,
) -> tuple[DataFrame, Fit]:
    """(doc_id, row_hash, tokens, posterior, rate, copies) of every row, and the fit.

    ``copies`` is the rate, rounded up or down by a uniform number that follows from the row, so that it
    is the rate on average and the same whenever it is worked out.
    """
    classifier = DomainClassifier(docs, labels)
    slim = save(classifier.posteriors(docs), "mix-posteriors")
    fit = fit_rates(slim, classifier.domains, weights, total, most_rate)
    copies = F.floor(F.col("rate") + _uniform("doc_id", "row_hash")).cast("int")
    return slim.withColumn("rate", fit.rate()).withColumn("copies", copies), fit


def domain_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, tokens, domain, p_<domain>, rate and copies of every row."""
    rates, fit = mixed_rates(docs, labels)
    p = {x: F.col("posterior")[fit.domains.index(x)] if x in fit.domains else F.lit(0.0) for x in DOMAINS}
    most = F.greatest(*p.values())
    named = F.coalesce(*[F.when(column == most, F.lit(x)) for x, column in p.items()]) if fit.domains else F.lit(None).cast("string")
    return rates.select(
        "doc_id",
        "tokens",
        named.alias("domain"),
        *[column.alias(f"p_{x}") for x, column in p.items()],
        "rate",
        "copies",
    )


def mix(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say, with all their columns."""
    rates, _ = mixed_rates(docs, labels, **options)
    # The same id and text give the same copies: one row of each is enough to look them up.
    copies = rates.filter("copies > 0").groupBy("doc_id", "row_hash").agg(F.max("copies").alias("copies"))
    copies = copies.withColumnsRenamed({"doc_id": "of_id", "row_hash": "of_hash"})
    same = F.col("of_id").eqNullSafe(F.col("doc_id")) & (F.col("of_hash") == F.xxhash64("text"))
    found = packed(docs).join(copies, same)
    return found.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
