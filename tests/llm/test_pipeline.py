"""The pipeline's stages and rows against a brute-force version, and the registered queries."""

import hashlib
import itertools
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from starmill.llm import quality_rules, queries, source_mixing
from starmill.llm.common import save
from tests.llm.conftest import SF
from tests.llm.test_dedup import normal, token_set
from tests.llm.test_models import counts_by_hand


def test_stages():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "ngram_jaccard_join", "mix_sources", "bpe"]


def test_all_are_registered():
    own = {q.__name__ for q in queries.QUERIES}
    assert {int(x[2:].split("_")[0]) for x in own} == set(range(1, 14))
    assert own | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= own


def test_pipeline_rows_by_hand(spark, small, labels):
    table = [(r.doc_id, r.text) for r in small.collect()]
    # 1: the score is the operator's, the base rules are counted by hand.
    scores = {r.doc_id: r.score for r in quality_rules.score(small, labels).collect()}
    rows = [(d, t) for d, t in table if not counts_by_hand(t)[-1] and scores[d] >= quality_rules.THRESHOLD]
    # 2
    first = {}
    for d, t in sorted(rows):
        first.setdefault(normal(t), (d, t))
    rows = sorted(first.values())
    # 3
    sets = {d: token_set(t) for d, t in rows}
    root = {d: d for d, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(root), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    rows = [(d, t) for d, t in rows if root[d] == d]
    # 4: posteriors are the classifier's; rates are stepped by hand.
    left = save(small.filter(F.col("doc_id").isin([d for d, _ in rows])), "by-hand")
    rates, fit = source_mixing.mixed_rates(left, labels)
    copies = {}
    for r in rates.collect():
        rate = 1.0
        for step in fit.steps:
            rate = min(max(0.0, rate - float(np.dot(r.posterior, step))), source_mixing.MOST_RATE)
        assert r.rate == pytest.approx(rate)
        copies[r.doc_id] = r.copies
    # 5
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids
        want[(d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())] += copies[d]
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want and len(got) > 50


def test_stages_on_odd_and_empty_rows(spark, odd, no_rows):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        out = stage(spark, no_rows, SF)
        assert out.columns == odd.columns and out.count() == 0


@pytest.mark.parametrize("name", [q.__name__ for q in queries.QUERIES if q.__name__ not in queries.ORACLES])
def test_queries_without_sql_run(spark, name):
    df = queries.queries()[name](spark, SF)
    assert df.count() >= 1
