"""License scans by a trained paragraph classifier.

A paragraph is a line with a word, or several lines without an empty one between them, as notices wrapped over lines are.
Multinomial logistic regression on hashed word n-grams, of one and two words, tells licence families, other licence talk
(``unknown``) and plain text (``none``) apart. A line that it takes for a family by ``HINT`` or more proposes that family
for the lines around it: the fewest of them that hold one of the family's templates are a paragraph, which is
classified as a whole. Odds are calibrated with one temperature, fitted on held-out paragraphs; a family that is not
likely enough then is ``unknown``. Each prediction is confirmed by comparing the paragraph with the family's templates:
the share of a template's word pairs that the paragraph holds. What tells near families apart (version, Affero, Lesser,
ShareAlike and the like) must fit as well; a paragraph without a version has the first that the lines behind it name, up to an empty
one. A family that no template confirms is ``unknown`` too.

Training paragraphs are the templates with words dropped, changed and put around them, licence talk of no known
family, at most ``most_labelled`` paragraphs of a labelled table if there is one (``MOST_LABELLED``; those of the smallest hash;
families without templates are ``unknown``), and at most ``most`` paragraphs of the corpus (``MOST_PLAIN``; to ``LONGEST_PLAIN``
characters) that hold few of any template's words, those of the smallest hash. Every paragraph of every document is scored.

Defined results: null and empty texts have no paragraphs; a null doc_id stays null; repeated rows are found as
often as they are there; an empty corpus trains on templates alone and finds nothing; labelled paragraphs without a family or
text are left out; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.common import Vocabulary, least_hashed, mixed, ngram_hashes, ranges, text_pieces

# Short notices by licence family: fixed values.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Licensed under the BSD 3-Clause License.",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
}

# Licence talk that names no family above.
OTHERS = [
    "All rights reserved. No part of this work may be reproduced.",
    "Licensed under the terms of a proprietary license agreement.",
    "Released under the Zlib License.",
    "This software is licensed under the Artistic License.",
    "Licensed under the Eclipse Public License, version 1.0.",
    "Distributed under the Boost Software License.",
    "Released under the ISC License.",
    "Use is subject to license terms.",
]

UNKNOWN, NONE = "unknown", "none"
CLASSES = [*TEMPLATES, UNKNOWN, NONE]
BITS = 14
MOST_PLAIN, MOST_LABELLED, LONGEST_PLAIN, VARIANTS, SEED = 4_000, 20_000, 8_000, 30, 5
PENALTY = 0.0005
LIKELY, CONFIRMED = 0.5, 0.8
# Log-odds of a family against plain text from which on a line proposes it.
HINT = 1.0

FOUND = "paragraph int, begin int, end int, family string, probability double, similarity double, confirmed boolean"

_WORD = re.compile(r"\w+")


def plain_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class _Ngrams:
    """Hashed n-grams of paragraphs, each once a paragraph."""

    def __init__(self) -> None:
        self.known = Vocabulary()
        self.begins, self.hashes = np.zeros(1, np.int64), np.empty(0, np.uint64)

    def of(self, paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (paragraph, bucket) in order, and the number of a paragraph's words."""
        if self.known.trim():
            self.begins, self.hashes = np.zeros(1, np.int64), np.empty(0, np.uint64)
        raw = [x.split() for x in paragraphs]
        numbers = self.known.numbers([y for x in raw for y in x])
        fresh = [plain_words(x.decode("utf-8", "replace")) for x in self.known.words[len(self.begins) - 1 :]]
        if fresh:
            sizes = np.cumsum(np.fromiter(map(len, fresh), np.int64, len(fresh)))
            self.begins = np.concatenate([self.begins, self.begins[-1] + sizes])
            new = np.array([xxhash.xxh3_64_intdigest(y) for x in fresh for y in x], np.uint64)
            self.hashes = np.concatenate([self.hashes, new])
        first, count = self.begins[numbers], np.diff(self.begins)[numbers]
        words = self.hashes[ranges(first, count)]
        sizes = np.bincount(np.repeat(np.arange(len(raw)), [len(x) for x in raw]), count, len(raw)).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        pairs = np.maximum(sizes - 1, 0)
        shift = np.uint64(64 - BITS)
        one = (mixed(words, 1) >> shift).astype(np.int64)
        two = (mixed(ngram_hashes(words, 2)[ranges(starts, pairs)], 2) >> shift).astype(np.int64)
        row = np.concatenate([np.repeat(np.arange(len(raw)), sizes), np.repeat(np.arange(len(raw)), pairs)])
        both = np.unique((row << BITS) + np.concatenate([one, two]))
        return both >> BITS, both & ((1 << BITS) - 1), sizes


def paragraphs_of(text: bytes) -> list[tuple[int, int, bytes]]:
    """(number, where it begins in bytes, line) of each line with a word."""
    out, at = [], 0
    for number, line in enumerate(text.split(b"\n")):
        if line.strip():
            out.append((number, at, line))
        at += len(line) + 1
    return out


def _pairs(words: list[str]) -> set[tuple[str, ...]]:
    return {*zip(words, words[1:], strict=False)} or {tuple(words)}


_TEMPLATE_PAIRS = {family: [_pairs(plain_words(x)) for x in said] for family, said in TEMPLATES.items()}
# Words that a template has at most.
_LONGEST = {family: max(len(plain_words(x)) for x in said) for family, said in TEMPLATES.items()}


# Words that make a paragraph another family's, that a family must have, and the version it names.
_OTHER_FAMILY = {
    "gpl-3.0": re.compile(r"(affero|lesser|library)\s+general\s+public|\b[al]gpl"),
    "cc-by": re.compile(r"share\s*-?\s*alike|non\s*-?\s*commercial|no\s*-?\s*deriv|\bby[\s-]+(nc|sa|nd)\b"),
    "cc-by-nc": re.compile(r"share\s*-?\s*alike|no\s*-?\s*deriv|\bby[\s-]+nc[\s-]+(sa|nd)\b"),
}
_OWN_WORDS = {"cc-by-nc": re.compile(r"non\s*-?\s*commercial|\bby[\s-]+nc\b")}
VERSIONS = {"gpl-3.0": "3", "apache-2.0": "2", "mpl-2.0": "2"}
_VERSION = re.compile(r"(?:\bversion|\bv|\bgpl|\bgplv)[\s.-]*(\d+)")
# The same in UTF-8, where a letter outside ASCII is no end of a word.
_VERSION_BYTES = re.compile(rb"(?i)(?<![\w\x80-\xff])(?:version|v|gpl|gplv)[\s.-]*(\d+)")


def similarity(paragraph: str, family: str) -> float:
    """The largest share of a template's word pairs that the paragraph holds."""
    found = _pairs(plain_words(paragraph))
    return max((len(x & found) / len(x) for x in _TEMPLATE_PAIRS.get(family, [])), default=0.0)


def fits(paragraph: str, rest: str, family: str) -> bool:
    """Whether the words that tell near families apart are the family's; a version may stand in the ``rest`` behind."""
    text = paragraph.lower()
    if family in _OTHER_FAMILY and _OTHER_FAMILY[family].search(text):
        return False
    if family in _OWN_WORDS and not _OWN_WORDS[family].search(text):
        return False
    if family not in VERSIONS:
        return True
    said = _VERSION.findall(text) or _VERSION.findall(rest.lower())
    if said:
        return VERSIONS[family] in said
    # Without a version, only a template without one confirms.
    found = _pairs(plain_words(paragraph))
    near = [x for x in _TEMPLATE_PAIRS[family] if len(x & found) >= CONFIRMED * len(x)]
    return any(not any(VERSIONS[family] in pair for pair in x) for x in near)


class _Places:
    """Where things stand in one text: bytes in characters, and the versions that it names."""

    def __init__(self, text: bytes):
        self.text = text

    @cached_property
    def _characters(self) -> np.ndarray:
        starts = (np.frombuffer(self.text, np.uint8) & 0xC0) != 0x80
        return np.concatenate([np.zeros(1, np.int64), np.cumsum(starts)])

    @cached_property
    def _versions(self) -> tuple[list[int], list[str]]:
        found = [(x.start(), f"version {x[1].decode()}") for x in _VERSION_BYTES.finditer(self.text)]
        return [x for x, _ in found], [x for _, x in found]

    def character(self, at: int) -> int:
        return int(self._characters[at])

    def version(self, begin: int, end: int) -> str:
        """The first version named between two places; empty if none is."""
        starts, said = self._versions
        k = bisect_left(starts, begin)
        return said[k] if k < len(starts) and starts[k] < end else ""


def _block_ends(lines: list[tuple[int, int, bytes]]) -> list[int]:
    """For each line, where the lines end, in bytes, that follow it without an empty one between."""
    ends: list[int] = []
    for k in range(len(lines) - 1, -1, -1):
        number, at, line = lines[k]
        goes_on = k + 1 < len(lines) and lines[k + 1][0] == number + 1
        ends.append(ends[-1] if goes_on else at + len(line))
    return ends[::-1]


def _joined(lines: list[tuple[int, int, bytes]], hints: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last place of lines, two or more with none empty between them, that together hold a template of a family
    which the classifier proposes for one of them.

    ``hints`` has a row a line and a column a family; ``sizes`` are the lines' words.
    """
    numbers = np.array([x[0] for x in lines])
    block = np.concatenate([[0], np.cumsum(np.diff(numbers) != 1)])
    firsts, lasts = np.searchsorted(block, block), np.searchsorted(block, block, "right") - 1
    words = np.concatenate([[0], np.cumsum(sizes)])
    for f in np.flatnonzero(hints.any(0)).tolist():
        family = CLASSES[f]
        at = np.flatnonzero(hints[:, f])
        # As many words around a line as the longest template has, in its block.
        begin = np.searchsorted(words, words[at] - _LONGEST[family], "right") - 1
        end = np.searchsorted(words, words[at + 1] + _LONGEST[family], "left") - 1
        begin, end = np.maximum(begin, firsts[at]), np.minimum(end, lasts[at])
        opens = np.flatnonzero(np.append(True, begin[1:] > np.maximum.accumulate(end)[:-1]))
        for a, b in zip(begin[opens].tolist(), np.maximum.reduceat(end, opens).tolist(), strict=True):
            if a < b:
                yield from _joined_run(lines, a, b + 1, family)


def _joined_run(lines: list[tuple[int, int, bytes]], begin: int, end: int, family: str) -> Iterator[tuple[int, int]]:
    words = [plain_words(x[2].decode("utf-8", "replace")) for x in lines[begin:end]]
    all_pairs = _pairs([w for x in words for w in x])
    for pairs in _TEMPLATE_PAIRS[family]:
        if len(pairs & all_pairs) < CONFIRMED * len(pairs):
            continue
        for i in range(len(words)):
            so_far, held = list(words[i]), len(pairs & _pairs(words[i]))
            if not held or held >= CONFIRMED * len(pairs):
                continue
            for j in range(i + 1, len(words)):
                inner = len(so_far) - len(words[i])
                if inner > 2 * (len(pairs) + 1):
                    break
                so_far += words[j]
                if len(pairs & _pairs(so_far)) >= CONFIRMED * len(pairs):
                    # To the end of the template, if the next line has more of it.
                    whole = len(pairs & _pairs(so_far))
                    if j + 1 < len(words) and len(pairs & _pairs(so_far + words[j + 1])) > whole:
                        j += 1
                    if len(pairs & _pairs(words[j])) < CONFIRMED * len(pairs):
                        yield begin + i, begin + j
                    break


def training_paragraphs(plain: list[str], seed: int = SEED, without: set[str] = frozenset()) -> list[tuple[str, str]]:
    """(family, paragraph): templates and other licence talk in variants, and plain paragraphs as they are."""
    chance = random.Random(seed)
    filler = [w for x in plain for w in x.split()[:20]] or ["text"]

    def variant(said: str) -> str:
        words = [chance.choice(filler) if chance.random() < 0.03 else w for w in said.split() if chance.random() > 0.04]
        before = [chance.choice(filler) for _ in range(chance.choice((0, 0, 3, 12)))]
        after = [chance.choice(filler) for _ in range(chance.choice((0, 0, 3, 12)))]
        return " ".join([*before, *words, *after])

    known = [(family, said) for family, all_said in TEMPLATES.items() for said in all_said if said not in without]
    known += [(UNKNOWN, said) for said in OTHERS]
    varied = [(family, variant(said)) for family, said in known for _ in range(VARIANTS)]
    return [*known, *varied, *[(NONE, x) for x in plain]]


class LicenseClassifier:
    """Weights, calibrated, of the paragraph classifier."""

    def __init__(self, spark: SparkSession, plain: list[str], labelled: list[tuple[str, str]] = (), without: set[str] = frozenset()):
        """``labelled`` are more (family, paragraph) to train on; templates in ``without`` are left out."""
        rows = [*training_paragraphs(plain, without=without), *labelled]
        row, bucket, _ = _Ngrams().of([x.encode() for _, x in rows])
        ends = np.searchsorted(row, np.arange(len(rows) + 1))
        data = [
            (CLASSES.index(family), bucket[a:b].tolist(), int(xxhash.xxh3_64_intdigest(said) % 4))
            for (family, said), a, b in zip(rows, ends[:-1], ends[1:], strict=True)
        ]

        @F.udf(VectorUDT(), useArrow=False)
        def vector(buckets):
            return SparseVector(1 << BITS, buckets, [1.0] * len(buckets))

        sample = spark.createDataFrame(data, "label int, buckets array<int>, fold int")
        train = sample.filter("fold > 0").select(F.col("label").cast("double"), vector("buckets").alias("features"))
        learner = LogisticRegression(family="multinomial", maxIter=80, regParam=PENALTY, elasticNetParam=1.0)
        model = learner.fit(train)
        self.weights, self.intercepts = np.zeros((1 << BITS, len(CLASSES))), np.full(len(CLASSES), -30.0)
        size = model.numClasses
        self.weights[:, :size], self.intercepts[:size] = model.coefficientMatrix.toArray().T, model.interceptVector.toArray()
        held = [(label, buckets) for label, buckets, fold in data if fold == 0]
        margins = np.array([self.weights[b].sum(0) + self.intercepts for _, b in held])
        labels = np.array([x for x, _ in held])
        self.accuracy = float((margins.argmax(1) == labels).mean()) if len(held) else float("nan")
        self.temperature = self._calibrated(margins, labels) if len(held) else 1.0

    @staticmethod
    def _calibrated(margins: np.ndarray, labels: np.ndarray) -> float:
        """The temperature under which held-out labels are likeliest."""

        def loss(t: float) -> float:
            odds = margins / t
            odds = odds - odds.max(1, keepdims=True)
            return float((np.log(np.exp(odds).sum(1)) - odds[np.arange(len(labels)), labels]).mean())

        return min(np.geomspace(0.25, 8, 41).tolist(), key=loss)


def find(weights: np.ndarray, intercepts: np.ndarray, temperature: float):
    """Licence paragraphs of each text: where they are, their family, and how far template and odds agree."""
    none, unknown = CLASSES.index(NONE), CLASSES.index(UNKNOWN)
    names = ["doc_id", "paragraph", "begin", "end", "family", "probability", "similarity", "confirmed"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]

    def judged(line: str, behind: str, odds: np.ndarray) -> tuple[str, float, float, bool]:
        best = int(odds[:unknown].argmax())
        family = CLASSES[best] if odds[best] >= LIKELY else UNKNOWN
        alike = similarity(line, family)
        confirmed = alike >= CONFIRMED and fits(line, behind, family)
        return (family, float(odds[best]), alike, True) if confirmed else (UNKNOWN, float(1 - odds[none]), alike, False)

    def summed(paragraphs: list[bytes], ngrams: _Ngrams) -> tuple[np.ndarray, np.ndarray]:
        """Weights of each paragraph, summed by class, and its words."""
        row, bucket, sizes = ngrams.of(paragraphs)
        sums = np.concatenate([np.zeros((1, len(CLASSES))), np.cumsum(weights[bucket], 0)])
        ends = np.searchsorted(row, np.arange(len(paragraphs) + 1))
        return sums[ends[1:]] - sums[ends[:-1]], sizes

    def overlaps(taken: list[tuple[int, int]], begin: int, end: int) -> bool:
        """Whether a stretch meets one of those taken, which are in order and apart."""
        k = bisect_left(taken, (begin,))
        return (k > 0 and taken[k - 1][1] > begin) or (k < len(taken) and taken[k][0] < end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ngrams = _Ngrams()
        for batch in batches:
            for rows, texts in text_pieces(batch):
                all_own = [paragraphs_of(text) for text in texts]
                lines = [(i, *x, end) for i, own in enumerate(all_own) for x, end in zip(own, _block_ends(own), strict=True)]
                sums, sizes = summed([x[3] for x in lines], ngrams)
                hints = sums[:, :unknown] - sums[:, [none]] >= HINT
                first, joined = 0, []
                for i, own in enumerate(all_own):
                    mine = slice(first, first + len(own))
                    first += len(own)
                    if not hints[mine].any():
                        continue
                    for a, b in sorted(set(_joined(own, hints[mine], sizes[mine]))):
                        at = own[a][1]
                        joined.append((i, own[a][0], at, texts[i][at : own[b][1] + len(own[b][2])], lines[mine.start + b][4]))
                alone = len(lines)
                if joined:
                    more, more_sizes = summed([x[3] for x in joined], ngrams)
                    sums, sizes = np.concatenate([sums, more]), np.concatenate([sizes, more_sizes])
                    lines += joined
                margins = (sums + intercepts) / temperature
                odds = np.exp(margins - margins.max(1, keepdims=True)) if len(lines) else margins
                odds = odds / odds.sum(1, keepdims=True)
                where = [_Places(text) for text in texts]
                places, kept = {}, []
                # Joined lines first: lines within a notice that they confirm are part of it.
                likely = np.flatnonzero((odds[:, none] < 1 - LIKELY) & (sizes > 0))
                for k in [*likely[likely >= alone].tolist(), *likely[likely < alone].tolist()]:
                    owner, number, at, line, end = lines[k]
                    verdict = judged(line.decode(), where[owner].version(at + len(line), end), odds[k])
                    taken = places.setdefault(owner, [])
                    if k >= alone and not verdict[3]:
                        continue
                    if (k >= alone or not verdict[3]) and overlaps(taken, at, at + len(line)):
                        continue
                    if k >= alone:
                        taken.append((at, at + len(line)))
                    begin, end = where[owner].character(at), where[owner].character(at + len(line))
                    kept.append((owner, (number, begin, end, *verdict)))
                kept.sort(key=lambda x: x[:2])
                owners, found = [x[0] for x in kept], [x[1] for x in kept]
                if found:
                    columns = [pa.array(x, kind) for x, kind in zip(zip(*found, strict=True), kinds, strict=True)]
                    ids = rows.column("doc_id").take(pa.array(owners))
                    yield pa.RecordBatch.from_arrays([ids, *columns], names)

    return run


def plain_paragraphs(docs: DataFrame, most: int = MOST_PLAIN) -> list[str]:
    """At most ``most`` training paragraphs of the corpus that look like no template."""
    lines = docs.select(F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").rlike(r"\w"))
    # Equal lines count once; the bound is on what the driver gets.
    cut = lines.select(F.xxhash64("line").alias("hash"), F.substring("line", 1, LONGEST_PLAIN).alias("line"))
    chosen = least_hashed(cut, "hash", 2 * most).collect()
    plain = [x.line for x in sorted(chosen) if max(similarity(x.line, family) for family in TEMPLATES) < 0.3]
    return plain[:most]


def labelled_paragraphs(paragraphs: DataFrame, most: int = MOST_LABELLED) -> list[tuple[str, str]]:
    """At most ``most`` (family, paragraph) of a table with columns ``family`` and ``text``."""
    known = paragraphs.select("family", "text").filter("family is not null and text is not null")
    rows = least_hashed(known.withColumn("hash", F.xxhash64("text", "family")), "hash", most).collect()
    return [(x.family if x.family in CLASSES else UNKNOWN, x.text) for x in sorted(rows, key=lambda x: (x.hash, x.family, x.text))]


def accuracy_on_unseen(spark: SparkSession, plain: list[str]) -> tuple[float, float]:
    """Shares of templates taken for a licence, and for the right family, by classifiers that were trained without them.

    Of every family with two templates or more, one is left out of a training, each once.
    """
    licences, families, count = 0, 0, 0
    none = CLASSES.index(NONE)
    for k in range(max(map(len, TEMPLATES.values()))):
        held = {family: said[k] for family, said in TEMPLATES.items() if k < len(said) > 1}
        model = LicenseClassifier(spark, plain, without=set(held.values()))
        row, bucket, _ = _Ngrams().of([x.encode() for x in held.values()])
        margins = np.zeros((len(held), len(CLASSES))) + model.intercepts
        np.add.at(margins, row, model.weights[bucket])
        best = margins.argmax(1)
        licences += int((best != none).sum())
        families += sum(CLASSES[x] == family for x, family in zip(best.tolist(), held, strict=True))
        count += len(held)
    return licences / count, families / count


def scan(
    docs: DataFrame, paragraphs: DataFrame | None = None, most: int = MOST_PLAIN, most_labelled: int = MOST_LABELLED
) -> DataFrame:
    """A row for each licence paragraph: doc_id, its number and place in characters, family and confirmation.

    ``paragraphs`` is a labelled table (family, text) to train on, beside the templates.
    """
    labelled = [] if paragraphs is None else labelled_paragraphs(paragraphs, most_labelled)
    classifier = LicenseClassifier(docs.sparkSession, plain_paragraphs(docs, most), labelled)
    return scan_with(docs, classifier)


def scan_with(docs: DataFrame, classifier: LicenseClassifier) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    kernel = find(classifier.weights, classifier.intercepts, classifier.temperature)
    return docs.select("doc_id", "text").mapInArrow(kernel, f"doc_id {kind}, {FOUND}")
