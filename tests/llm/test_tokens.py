"""Token counts and BPE against the libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from starmill.llm import bpe, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(WORDS)


def test_counts_are_the_librarys(spark, odd, odd_rows):
    cache = token_counts.TokenCountCache(spark)
    got = token_counts.token_counts(odd, PIECES, cache).collect()
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted((str(d), len((t or "").encode()), len(pieces.encode(t or ""))) for d, t in odd_rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)


def test_only_misses_are_encoded(spark, small, no_rows):
    cache = token_counts.TokenCountCache(spark)
    token_counts.token_counts(small.filter("doc_id < 100"), PIECES, cache).collect()
    first = spark.read.parquet(cache.path).count()
    digest = token_counts.tokenizer_digest(PIECES)
    # A count that no tokenizer gives shows that the stored one is used.
    one = small.filter("doc_id = 150").select(F.unhex(F.sha2("text", 256)).alias("content_digest"))
    cache.append(one.withColumn("n_tokens", F.lit(12345).cast("long")), digest)
    counted = {r.doc_id: r.n_tokens for r in token_counts.token_counts(small, PIECES, cache).collect()}
    assert counted[150] == 12345 and len(counted) == small.count()
    stored = spark.read.parquet(cache.path)
    assert first < stored.count() == small.select("text").distinct().count()
    assert cache.counts("another tokenizer").count() == 0
    assert token_counts.token_counts(no_rows, PIECES, cache).count() == 0


LETTERS = [*"abcXYZ'sStTdD  \n\t0129½²Ⅷ_-.,!é́̈ßİΣσςÄ中文한글ا🎉​ 　\x1c\x85﻿", "<|endoftext|>", "<|startoftext|>", "'re", "'LL", "the"]


def test_ids_and_decoding_are_the_librarys_on_random_texts(library):
    chance = random.Random(1)
    own = bpe.Tokenizer(WORDS)
    known = bpe.WordIds(own, limit=500)
    for _ in range(4000):
        text = "".join(chance.choice(LETTERS) for _ in range(chance.randint(0, 25)))
        numbers = known.numbers(bpe._words(text))
        ids = [int(x) for i in numbers for x in known.ids[known.begins[i] : known.begins[i + 1]]]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, repr(text)
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_merges_are_leftmost_and_lowest_ranked():
    own = bpe.Tokenizer(WORDS)

    def by_hand(symbols):
        while True:
            ranks = [own.ranks.get(a * own.size + b) for a, b in zip(symbols, symbols[1:], strict=False)]
            least = min((r for r in ranks if r is not None), default=None)
            if least is None:
                return symbols
            i = ranks.index(least)
            symbols = [*symbols[:i], own.merged[least], *symbols[i + 2 :]]

    chance = random.Random(8)
    for _ in range(300):
        symbols = [own.first[ord(chance.choice("abeinrst"))] for _ in range(chance.randint(1, 60))]
        assert own.merge(list(symbols)) == by_hand(symbols)


def test_pieces_merged_together_are_those_merged_alone():
    """Of all lengths, around powers of two and beyond the longest row, with added tokens among them."""
    own = bpe.Tokenizer(WORDS)
    chance = random.Random(9)
    sizes = [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 63, 64, 65, 200, *[chance.randint(1, 20) for _ in range(500)]]
    pieces = ["".join(chance.choice("abeinrstöß漢") for _ in range(n)) for n in sizes]
    pieces = [y for x in pieces for y in (x, 49406)][: len(pieces) + 20]
    ids, counts = own.pieces_ids(pieces)

    def alone(piece):
        raw = piece.encode()
        return own.merge([*[own.first[b] for b in raw[:-1]], own.last[raw[-1]]])

    want = [[x] if isinstance(x, int) else alone(x) for x in pieces]
    assert ids.tolist() == [y for x in want for y in x] and counts.tolist() == list(map(len, want))
    none, sizes = own.pieces_ids([])
    assert len(none) == len(sizes) == 0


def test_whole_table_is_the_librarys(spark, library):
    """Every text of sf0.01, by a worker that forgets words again and again."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in
           bpe.encode(docs, WORDS, ("n_tokens", "ids_sha256", "decoded_sha256")).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[doc_id] == (len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()), doc_id
    assert len(got) == docs.count()


def test_digests_of_rows(odd, odd_rows, no_rows, library):
    outputs = ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")
    got = bpe.encode(odd, WORDS, outputs).collect()
    want = []
    for doc_id, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        want.append((str(doc_id), len(ids), ids, decoded, *digests))
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(want)
    assert bpe.encode(no_rows, WORDS).count() == 0


def test_decode_column(spark, library):
    texts = ["Hello, World's end", "", "a  b"]
    ids = [library.encode(x, add_special_tokens=False).ids for x in texts]
    df = spark.createDataFrame([(x,) for x in [*ids, None]], "ids array<int>")
    got = [r[0] for r in df.select(bpe.decode(F.col("ids"), WORDS)).collect()]
    assert got == [*[library.decode(x, skip_special_tokens=False) for x in ids], None]


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
