"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols stand in a row; leaf i of the tree holds the rank of the pair that starts at symbol i, and
each node the least of its children, so the root is the leftmost pair of the lowest rank. A merge changes
three leaves at most, each in logarithmically many steps, until no pair can be merged. Trees of one size are
rows of an array: the new pieces of a batch are merged together, one merge of each of them a step. Texts are
split into words by white space, and what a word becomes is remembered, for a bounded number of words, by a Python
worker for all its tasks.

Vocabulary files are those of the tokenizers library: byte-level BPE with a suffix at word ends, NFC and lower
case before, no decoder. A file of another make is refused, not read in part.

Defined results: null is empty (no ids, empty decoded text); strings of added tokens inside a text become
their ids; ids that are not in the vocabulary are left out when decoding; a null doc_id stays null; repeated
rows come back as often as they are there; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from starmill.llm.common import Vocabulary, ranges, text_pieces

# Onigmo's \s; str.split() also splits by these four information separators.
SEPARATORS = regex.compile("[\x1c-\x1f]")
# Pieces of up to so many bytes are merged as rows of an array, so many symbols at once; longer ones one by one.
LONGEST_ROW, ROWS_AT_ONCE = 64, 1 << 17
SPACES = regex.compile("[\t-\r \x85\xa0  -     　]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest in order from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(others)) for b in range(0x100)]


class Tokenizer:
    """What a vocabulary file says."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as opened:
            said = json.load(opened)
        model = said["model"]
        steps = [x["type"] for x in said["normalizer"]["normalizers"]]
        split = next(x for x in said["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")
        known = (
            steps == ["NFC", "Replace", "Lowercase"]
            and split["behavior"] == "Removed"
            and split["invert"]
            and said["decoder"] is None
            and not any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in said["added_tokens"])
            and not any(model[x] for x in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        )
        if not known:
            raise ValueError(f"{file} is not a lower-case byte-level BPE with word ends")
        suffix = model["end_of_word_suffix"]
        vocabulary = model["vocab"]
        self.size = max(vocabulary.values()) + 1
        self.first = [vocabulary[x] for x in byte_letters()]
        self.last = [vocabulary[x + suffix] for x in byte_letters()]
        merges = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.ranks = {vocabulary[a] * self.size + vocabulary[b]: rank for rank, (a, b) in enumerate(merges)}
        self.merged = [vocabulary[a + b] for a, b in merges]
        self._arrays()
        self.added = {x["content"]: x["id"] for x in said["added_tokens"]}
        self.tokens = {i: token for token, i in [*vocabulary.items(), *self.added.items()]}
        self.piece = regex.compile(split["pattern"]["Regex"].replace(r"\s", SPACES.pattern[1:-2]))
        by_length = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids after all merges."""
        count = len(symbols)
        if count < 2:
            return symbols
        ranks, merged, width = self.ranks, self.merged, self.size
        size = 1 << (count - 1).bit_length()
        nothing = len(merged) * size
        tree = [nothing] * (2 * size)
        for i in range(count - 1):
            rank = ranks.get(symbols[i] * width + symbols[i + 1])
            if rank is not None:
                tree[size + i] = rank * size + i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        symbols = list(symbols)
        while tree[1] != nothing:
            rank, i = divmod(tree[1], size)
            gone = after[i]
            symbols[i] = new = merged[rank]
            symbols[gone] = -1
            after[i] = follows = after[gone]
            own = ahead = nothing
            if follows < count:
                before[follows] = i
                rank = ranks.get(new * width + symbols[follows])
                if rank is not None:
                    own = rank * size + i
            leads = before[i]
            if leads >= 0:
                rank = ranks.get(symbols[leads] * width + new)
                if rank is not None:
                    ahead = rank * size + leads
            for k, value in ((gone, nothing), (i, own), (leads, ahead)):
                if k < 0:
                    continue
                k += size
                if tree[k] == value:
                    continue
                tree[k] = value
                while k > 1:
                    other = tree[k ^ 1]
                    if other < value:
                        value = other
                    k >>= 1
                    if tree[k] == value:
                        break
                    tree[k] = value
        return [x for x in symbols if x >= 0]

    def _arrays(self) -> None:
        """The same facts as arrays; a pair of two byte symbols is looked up in a square table."""
        self.first_ids, self.last_ids = np.array(self.first), np.array(self.last)
        self.merged_ids = np.array(self.merged, np.int64)
        self.no_rank = len(self.merged)
        pairs = np.fromiter(self.ranks, np.int64, len(self.ranks))
        ranks = np.fromiter(self.ranks.values(), np.int64, len(self.ranks))
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], ranks[order]
        self.bytes = max(*self.first, *self.last) + 1
        a, b = np.divmod(self.pairs, self.size)
        low = (a < self.bytes) & (b < self.bytes)
        self.byte_ranks = np.full((self.bytes, self.bytes), self.no_rank, np.int32)
        self.byte_ranks[a[low], b[low]] = self.pair_ranks[low]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols."""
        pairs = a * self.size + b
        at = np.searchsorted(self.pairs, pairs)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == pairs, self.pair_ranks[at], self.no_rank)

    def merge_rows(self, symbols: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids after all merges of pieces of byte symbols, a row each, -1 for what is gone.

        ``symbols`` is as wide as a power of two; a row's first ``counts`` symbols are its own. All rows that still
        have a pair merge their leftmost of lowest rank in one step.
        """
        rows, size = symbols.shape
        nothing = self.no_rank * size
        places = np.arange(size)
        tree = np.full((rows, 2 * size), nothing, np.int64)
        ranks = self.byte_ranks[symbols[:, :-1], symbols[:, 1:]].astype(np.int64)
        ranks[places[1:] >= counts[:, None]] = self.no_rank
        tree[:, size : 2 * size - 1] = np.where(ranks < self.no_rank, ranks * size + places[:-1], nothing)
        level = size
        while level > 1:
            np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, level // 2 : level])
            level //= 2
        after = np.tile(places + 1, (rows, 1))
        after[places == counts[:, None] - 1] = size
        before = np.tile(places - 1, (rows, 1))
        out, own = np.where(places < counts[:, None], symbols, -1), np.arange(rows)
        while len(own):
            open_ = tree[own, 1] != nothing
            own = own[open_]
            if not len(own):
                break
            rank, i = np.divmod(tree[own, 1], size)
            new, gone = self.merged_ids[rank], after[own, i]
            out[own, i], out[own, gone] = new, -1
            follows, leads = after[own, gone], before[own, i]
            after[own, i] = follows
            right, left = follows < size, leads >= 0
            at_right, at_left = np.where(right, follows, 0), np.where(left, leads, 0)
            before[own[right], follows[right]] = i[right]
            ranks = self.rank(np.concatenate([new, out[own, at_left]]), np.concatenate([out[own, at_right], new]))
            ours, ahead = ranks[: len(own)], ranks[len(own) :]
            tree[own, size + gone] = nothing
            tree[own, size + i] = np.where(right & (ours < self.no_rank), ours * size + i, nothing)
            value = np.where(ahead < self.no_rank, ahead * size + leads, nothing)
            tree[own[left], size + leads[left]] = value[left]
            # the paths above the three leaves; without a symbol ahead, its own path is taken twice
            paths = np.stack([gone, i, np.where(left, leads, i)]) + size
            while paths[0, 0] > 1:
                paths >>= 1
                tree[own, paths] = np.minimum(tree[own, 2 * paths], tree[own, 2 * paths + 1])
        return out

    def pieces_ids(self, pieces: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each has. A number is the id of an added token."""
        texts = [x.encode() if isinstance(x, str) else b"" for x in pieces]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(sizes)
        symbols = self.first_ids[raw]
        there = sizes > 0
        symbols[ends[there] - 1] = self.last_ids[raw[ends[there] - 1]]
        found: list = [None] * len(pieces)
        counts = np.ones(len(pieces), np.int64)
        for at in np.flatnonzero(~there).tolist():
            found[at] = [pieces[at]]
        for at in np.flatnonzero(sizes > LONGEST_ROW).tolist():
            found[at] = self.merge(symbols[ends[at] - sizes[at] : ends[at]].tolist())
            counts[at] = len(found[at])
        width = 1
        while width <= LONGEST_ROW:
            low = width // 2 if width > 1 else 0
            group = np.flatnonzero((sizes > low) & (sizes <= width))
            for some in np.array_split(group, max(1, len(group) * width // ROWS_AT_ONCE)):
                if len(some):
                    place = (ends - sizes)[some, None] + np.minimum(np.arange(width), sizes[some, None] - 1)
                    out = symbols[place] if width == 1 else self.merge_rows(symbols[place], sizes[some])
                    kept = out >= 0
                    counts[some] = kept.sum(axis=1)
                    flat, cuts = out[kept], np.cumsum(counts[some])[:-1]
                    for at, ids in zip(some.tolist(), np.split(flat, cuts), strict=True):
                        found[at] = ids
            width *= 2
        ids = np.concatenate(found).astype(np.uint32) if found else np.empty(0, np.uint32)
        return ids, counts

    def split(self, text: str) -> list[str | int]:
        """Pieces of a text, and the ids of added tokens between them."""
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [y for x in parts for y in ([self.added[x]] if x in self.added else self.split(x))]
        if not text.isascii():
            # Lower case letter by letter: a sigma at the end of a word is no exception.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.piece.findall(text.lower())

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[x] for x in ids if x in self.tokens])


class WordIds:
    """Ids of words, remembered for ``limit`` words and as many pieces of words."""

    def __init__(self, tokenizer: Tokenizer, limit: int = 300_000):
        self.tokenizer = tokenizer
        self.token_bytes = [tokenizer.tokens.get(i, "").encode() for i in range(max(tokenizer.tokens) + 1)]
        # Without added tokens made of letters, a word of plain letters is one piece.
        self.plain = not any(x.isalpha() for x in tokenizer.added)
        self.words, self.pieces = Vocabulary(limit), Vocabulary(limit)
        self.ids, self.begins = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.piece_ids, self.piece_begins = self.ids, self.begins

    def numbers(self, words: list[str]) -> np.ndarray:
        """Places of words in ``begins``, which are places in ``ids``."""
        if self.words.trim():
            self.ids, self.begins = np.empty(0, np.uint32), np.zeros(1, np.int64)
        numbers = self.words.numbers(words)
        new = self.words.words[len(self.begins) - 1 :]
        if new:
            split = self.tokenizer.split
            plain = self.plain
            pieces = [[x.lower()] if plain and x.isascii() and x.isalpha() else split(x) for x in new]
            ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            ids, sizes = self._pieces([y for x in pieces for y in x])
            so_far = np.concatenate([[0], np.cumsum(sizes)])
            self.ids = np.concatenate([self.ids, ids])
            self.begins = np.concatenate([self.begins, self.begins[-1] + so_far[ends]])
        return numbers

    def _pieces(self, pieces: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces in a row, and how many each has."""
        if self.pieces.trim():
            self.piece_ids, self.piece_begins = np.empty(0, np.uint32), np.zeros(1, np.int64)
        numbers = self.pieces.numbers(pieces)
        new = self.pieces.words[len(self.piece_begins) - 1 :]
        if new:
            ids, sizes = self.tokenizer.pieces_ids(new)
            self.piece_ids = np.concatenate([self.piece_ids, ids])
            self.piece_begins = np.concatenate([self.piece_begins, self.piece_begins[-1] + np.cumsum(sizes)])
        first = self.piece_begins[numbers]
        sizes = self.piece_begins[numbers + 1] - first
        return self.piece_ids[ranges(first, sizes)], sizes

    def decoded(self, ids: list[int]) -> bytes:
        return b" ".join(map(self.token_bytes.__getitem__, ids))


def worker_words(file: str) -> WordIds:
    """The words that this Python worker knows: later tasks of the worker go on with them."""
    own = sys.modules.setdefault("starmill_worker_words", types.ModuleType("starmill_worker_words")).__dict__
    if file not in own:
        own[file] = WordIds(Tokenizer(file))
    return own[file]


def _words(text: str) -> list[str]:
    return [x for x in SPACES.split(text) if x] if SEPARATORS.search(text) else text.split()


def encode_texts(file: str, outputs: list[str]):
    """Adds ``outputs`` to doc_id: n_tokens, ids, decoded, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = worker_words(file)
        for batch in batches:
            for rows, texts in text_pieces(batch):
                words = [_words(x.decode()) for x in texts]
                starts = np.cumsum([0, *map(len, words)])
                numbers = known.numbers([y for x in words for y in x])
                first, sizes = known.begins[numbers], known.begins[numbers + 1] - known.begins[numbers]
                ids = known.ids[ranges(first, sizes)]
                ends = np.concatenate([[0], np.cumsum(sizes)])[starts]
                found: dict[str, pa.Array] = {"n_tokens": pa.array(np.diff(ends), pa.int64())}
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                if "ids" in outputs:
                    found["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))
                if "ids_sha256" in outputs:
                    little = ids.astype("<u4")
                    found["ids_sha256"] = pa.array([hashlib.sha256(little[a:b]).hexdigest() for a, b in spans])
                if "decoded" in outputs or "decoded_sha256" in outputs:
                    decoded = [known.decoded(ids[a:b].tolist()) for a, b in spans]
                    found["decoded"] = pa.array(decoded, pa.binary()).cast(pa.string()) if "decoded" in outputs else None
                    found["decoded_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in decoded])
                columns = [rows.column("doc_id"), *(found[x] for x in outputs)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *outputs])

    return run


TYPES = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode(docs: DataFrame, file: str, outputs: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """(doc_id, *outputs) of every document's text; ``TYPES`` lists what there is."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", *(f"{x} {TYPES[x]}" for x in outputs)])
    return docs.select("doc_id", "text").mapInArrow(encode_texts(file, list(outputs)), schema)


def decode(ids: Column, file: str) -> Column:
    """The text of an array of ids; null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = Tokenizer(file)
        for batch in batches:
            yield batch.map(lambda x: None if x is None else tokenizer.decode(x.tolist()))

    return run(ids)
