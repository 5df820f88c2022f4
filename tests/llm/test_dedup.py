"""Exact dedup, the n-gram join and repeated passages against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starmill.llm import ngram_join, radix_dedup, substring_dedup
from tests.llm.conftest import words


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        keep = min((x for x in ids if x is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        kept_once = False
        for x in ids:
            kept = x == keep and not kept_once
            kept_once |= kept
            out[(x, keep, len(ids), kept, digest)] += 1
    return out


def found_exact(df):
    rows = radix_dedup.exact_dedup(df).collect()
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows)


def test_exact_dedup_of_odd_rows(odd, odd_rows):
    assert found_exact(odd) == exact_by_hand(odd_rows)


def test_exact_dedup_of_whole_table(small):
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert found_exact(small) == exact_by_hand(rows)


def test_exact_dedup_tells_texts_apart_at_every_round(spark):
    base = "x" * 6000
    texts = [base, base, base[:63], base[:64], base[:65], base[:576], base[:577], base[:4000] + "y" + base[4001:], "x"]
    rows = list(enumerate(texts))
    assert found_exact(spark.createDataFrame(rows, "doc_id long, text string")) == exact_by_hand(rows)


def test_exact_dedup_keeps_one_whole_row_a_group(odd, odd_rows):
    kept = radix_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    got = Counter((r.doc_id, normal(r.text)) for r in kept.collect())
    want = Counter((k[0], k[4]) for k, n in exact_by_hand(odd_rows).items() if k[3])
    assert sum(got.values()) == sum(want.values()) == len({normal(x) for _, x in odd_rows})
    assert set(got.values()) == {1}


def test_exact_dedup_of_nothing(no_rows):
    assert radix_dedup.exact_dedup(no_rows).count() == 0
    assert radix_dedup.keep_first(no_rows).count() == 0


def token_set(text, n=5):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset({tuple(w)} if w else ())


def near_by_hand(rows, threshold=0.8):
    """doc_id, class_id, links, links to other sets; every pair is compared."""
    sets = [token_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    links, others = Counter(), defaultdict(set)
    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and common >= threshold * len(sets[a] | sets[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[top(a)] = top(b)
            if sets[a] != sets[b]:
                others[a].add(sets[b])
                others[b].add(sets[a])
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        class_id = least.get(top(i)) if sets[i] else doc_id
        out[(doc_id, class_id, links[i], len(others[i]))] += 1
    return out


def found_near(df, **options):
    rows = ngram_join.near_duplicates(df, **options).collect()
    return Counter((r.doc_id, r.class_id, r.n_links, r.n_text_links) for r in rows)


def test_near_duplicates_of_odd_rows(odd, odd_rows):
    assert found_near(odd) == near_by_hand(odd_rows)


def changed(chance, text, share):
    return [w if chance.random() > share else f"c{chance.randrange(10**6)}" for w in text]


def test_near_duplicates_of_groups_and_a_common_line(spark):
    chance = random.Random(9)
    line = words(chance, 25)
    texts = [words(chance, chance.randrange(3, 200)) + line for _ in range(250)]
    bases = [words(chance, 150) for _ in range(6)]
    texts += [changed(chance, base, share) for base in bases for share in (0.0, 0.005, 0.01, 0.02, 0.03) for _ in range(12)]
    rows = [(i, " ".join(x)) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = near_by_hand(rows)
    assert found_near(df) == want
    # Small buckets and blocks: every path through levels and block pairs.
    assert found_near(df, small=8, block=16) == want


def test_pairs_of_the_join_are_all_links(spark):
    chance = random.Random(2)
    base = words(chance, 100)
    rows = [(i, " ".join(changed(chance, base, 0.01))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    join = ngram_join.NgramJoin(df, pairs=True)
    sets = {token_set(x) for _, x in rows}
    want = sum(len(a & b) >= 0.8 * len(a | b) for a, b in itertools.combinations(sets, 2))
    assert join.pairs().distinct().count() == want > 10


def test_one_of_each_near_group_stays(spark):
    chance = random.Random(5)
    base = words(chance, 200)
    copy = [*base]
    copy[100] = "other"
    rows = [(3, " ".join(base)), (1, " ".join(copy)), (2, " ".join(words(chance, 200))), (None, "a"), (4, None), (5, "")]
    kept = ngram_join.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 4, 5]


def test_another_text_with_the_id_of_a_near_copy_stays(spark):
    chance = random.Random(15)
    base, other = words(chance, 200), " ".join(words(chance, 90))
    copy = " ".join([*base[:100], "changed", *base[101:]])
    rows = [(1, " ".join(base)), (5, copy), (5, copy), (5, other), (7, None), (7, copy)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"gone_id": F.lit(1), "row_hash": F.lit(2)})
    kept = ngram_join.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted([(1, rows[0][1]), (5, other), (7, "")])


def test_a_dense_group_is_compared_as_it_is(spark):
    """Near copies of one text are not split: what is compared grows by a few rows for each of them, and no link is lost."""
    chance = random.Random(21)
    base = words(chance, 120)
    copies = [changed(chance, base, 0.01) for _ in range(300)]
    others = [words(chance, 60) for _ in range(60)]
    rows = [(i, " ".join(x)) for i, x in enumerate(copies + others)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = found_near(df, small=40)
    assert found == near_by_hand(rows)
    splits = []
    plain = ngram_join.next_level

    def counted(threshold):
        splits.append(threshold)
        return plain(threshold)

    ngram_join.next_level = counted
    try:
        ngram_join.NgramJoin(df, small=40)
    finally:
        ngram_join.next_level = plain
    assert splits == []


def test_a_loose_group_is_not_split(spark, monkeypatch):
    """Variants of one text that are no dense group, some hundreds: they are compared, no rows of children are made."""
    chance = random.Random(25)
    base = words(chance, 120)
    variants = [changed(chance, base, 0.06) for _ in range(500)]
    near = [changed(chance, variants[0], 0.005) for _ in range(8)]
    rows = [(i, " ".join(x)) for i, x in enumerate(variants + near)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    splits = []
    plain = ngram_join.next_level
    monkeypatch.setattr(ngram_join, "next_level", lambda threshold: splits.append(threshold) or plain(threshold))
    assert found_near(df) == near_by_hand(rows)
    assert splits == []
    # the same links if the group is split
    assert found_near(df, small=256) == near_by_hand(rows)
    assert splits


def test_pairs_to_compare_are_whole_and_not_repeated():
    """Every pair that is to be compared under a key is, by its blocks and main buckets; a group with another main bucket is not."""
    chance = np.random.default_rng(4)
    for trial in range(60):
        n = int(chance.integers(1, 40))
        blocks = chance.integers(0, 2, n) if trial % 2 else np.zeros(n, np.int64)
        key = (7, 0, 1) if trial % 2 else (7, 0, 0)
        mains = chance.choice([7, 8, 9] if trial % 3 else [8], n)
        want = set()
        for a, b in itertools.combinations(range(n), 2):
            if (mains[a] != mains[b] or mains[a] == 7) and (key[1] == key[2] or blocks[a] != blocks[b]):
                want.add((a, b))
        pairs = {(min(a, b), max(a, b)) for rows, others in ngram_join._to_compare(key, mains, blocks) for a in rows for b in others}
        assert want <= pairs
        if trial % 3 == 0:
            assert not pairs
        # Equal sketches: a set is found if it has any partner left.
        sketches, sizes = np.full((n, ngram_join.BINS), 3, np.uint8), np.full(n, 9)
        found = np.zeros(n, bool)
        for rows, others in ngram_join._to_compare(key, mains, blocks):
            found |= ngram_join._close(sketches, sizes, mains, 7, 0.8, rows, others)
        assert set(np.flatnonzero(found).tolist()) == {x for pair in want for x in pair}


def test_sketches_are_counted_as_bins():
    """The byte-wise count of equal bins against a plain one."""
    chance = np.random.default_rng(8)
    sketches = chance.integers(0, 4, (50, ngram_join.BINS)).astype(np.uint8)
    sketches[25:] = np.where(chance.random((25, ngram_join.BINS)) < 0.15, 0, sketches[:25])
    sizes, mains, every = np.full(50, 100), np.full(50, 1), np.arange(50)
    found = ngram_join._close(sketches, sizes, mains, 1, 0.8, every, every)
    want = np.zeros(50, bool)
    for a, b in itertools.combinations(range(50), 2):
        one, two = sketches[a], sketches[b]
        either = int(((one != 0) | (two != 0)).sum())
        same = int(((one == two) & (one != 0)).sum())
        if same >= 0.8 * either - ngram_join.SLACK * (0.16 * either) ** 0.5:
            want[[a, b]] = True
    assert found.tolist() == want.tolist() and want.any()


def test_a_common_line_is_no_dense_group(spark):
    """Texts that share a frequent passage meet in a large bucket, are split and not linked."""
    chance = random.Random(22)
    line = words(chance, 30)
    rows = [(i, " ".join(words(chance, 70) + line)) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    join = ngram_join.NgramJoin(df, small=20)
    assert join.pairs().isEmpty()
    sets = join.sets.select("set_id", "sketch")
    assert ngram_join._dense(sets.withColumn("bucket", F.lit(1).cast("long"))).isEmpty()


def test_dense_buckets_are_found_without_pairs_of_sets(spark):
    """A bucket's sets are summed up, not brought together, and members carry what a bucket is judged by."""
    chance = random.Random(23)
    base = words(chance, 200)
    near = [" ".join(changed(chance, base, 0.005)) for _ in range(60)]
    apart = [" ".join(words(chance, 80)) for _ in range(60)]
    halves = [" ".join(words(chance, 100) + base[:100]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(near + apart + halves)), "doc_id long, text string")
    join = ngram_join.NgramJoin(df, small=1000)
    rows = join.sets.select(F.floor(F.col("one.doc_id") / 60).alias("bucket"), *ngram_join.CARRIED, F.lit(60).alias("members"))
    dense = ngram_join._dense(rows, F.col("probe"))
    assert [r.bucket for r in dense.collect()] == [0]
    assert "Join" not in dense._jdf.queryExecution().toString()
    done, large = ngram_join._settled(rows, 40)
    assert {r.bucket for r in done.collect()} == {0} and {r.bucket for r in large.collect()} == {1, 2}


def test_children_of_a_set_are_those_of_its_buckets():
    """Buckets in one list have the same children as each alone, in batches of any size."""
    chance = np.random.default_rng(12)
    sketches = [chance.integers(0, 256, ngram_join.BINS, np.uint8).tobytes() for _ in range(40)]
    buckets = [chance.integers(-(2**62), 2**62, k).tolist() for k in chance.integers(1, 900, 40)]
    ids = [f"{i:016d}".encode() for i in range(40)]
    rows = pa.record_batch({"set_id": ids, "n_tokens": [9] * 40, "probe": list(range(40)), "sketch": sketches, "buckets": buckets})
    found = [x for b in ngram_join.next_level(0.8)(iter([rows.slice(0, 0), rows.slice(0, 7), rows.slice(7)])) for x in b.to_pylist()]
    want = Counter()
    for _, tokens, begins in ngram_join._sketched(iter([rows])):
        for i, own in enumerate(buckets):
            mine = tokens[begins[i] : begins[i + 1]]
            for x in own:
                path = np.array([x]).view(np.uint64)
                children, _ = ngram_join._chosen(mine, np.array([0, len(mine)]), path, 0.8)
                want.update((ids[i], 9, i, c) for c in children.view(np.int64).tolist())
    assert Counter((r["set_id"], r["n_tokens"], r["probe"], r["bucket"]) for r in found) == want and len(want) > 10_000


def test_sets_meet_their_sketches_once(spark, monkeypatch):
    """What is joined with the sketches has a row for each set, however many buckets a set is in."""
    chance = random.Random(24)
    base, line = words(chance, 120), words(chance, 30)
    rows = [(i, " ".join(changed(chance, base, 0.01))) for i in range(80)]
    rows += [(i, " ".join(words(chance, 70) + line)) for i in range(80, 160)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    plain, seen = ngram_join.save, {}

    def kept(rows, label):
        seen[label] = plain(rows, label)
        return seen[label]

    monkeypatch.setattr(ngram_join, "save", kept)
    assert found_near(df, small=20, block=16) == near_by_hand(rows)
    compared = seen["ngram-compared"]
    assert compared.count() == compared.select("set_id").distinct().count() > 80
    assert compared.select(F.max(F.size("buckets"))).first()[0] > 3


def test_buckets_that_repeat_the_members_of_another_are_left_out_by_each_set(spark):
    """Of buckets with the same members the least stays, told from a set's own list: memberships meet nothing for it."""
    same = [(x, 2, 5, 7, bucket) for x in "ab" for bucket in (12, 11, 13)]
    rows = same + [(x, 3, 8, 9, 20) for x in "abc"] + [(x, 2, 6, 7, 10) for x in "bc"]
    members = spark.createDataFrame([(x.encode(), *y) for x, *y in rows], "set_id binary, members long, xor_a long, xor_b long, bucket long")
    sets = spark.createDataFrame([(x.encode(), 9, b"s") for x in "abc"], "set_id binary, n_tokens long, sketch binary")
    found = ngram_join._with_main(members, sets)
    want = {b"a": [(2, 11), (3, 20)], b"b": [(2, 10), (2, 11), (3, 20)], b"c": [(2, 10), (3, 20)]}
    assert {bytes(r.set_id): sorted(map(tuple, r.buckets)) for r in found.collect()} == want
    assert {r.main for r in found.collect()} == {20}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_near_duplicates_of_nothing(no_rows):
    assert ngram_join.near_duplicates(no_rows).count() == 0
    assert ngram_join.keep_first(no_rows).count() == 0


def test_runs_follow_from_recall():
    assert ngram_join.runs_needed(0.9999, 1) == 10
    assert ngram_join.runs_needed(0.9999, 3) > ngram_join.runs_needed(0.99, 3) > ngram_join.runs_needed(0.99, 1)


def spans(df, **options):
    out = defaultdict(list)
    for r in substring_dedup.repeated_passages(df, **options).collect():
        out[r.doc_id].append((r.begin_word, r.end_word, r.class_id))
    return out


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    chance = random.Random(3)
    passage, long = words(chance, 60), words(chance, 200)
    near = [*passage]
    near[30] = "changed"
    drifted = [f"x{i}" if i in (10, 60, 110, 160) else w for i, w in enumerate(long)]
    short, line = words(chance, 30), words(chance, 12)
    texts = {
        1: words(chance, 100) + passage + words(chance, 40),
        2: words(chance, 10) + passage + words(chance, 300),
        3: words(chance, 200) + near + words(chance, 5),
        4: words(chance, 100) + short + words(chance, 100),
        5: short + words(chance, 70),
        6: words(chance, 300) + line + words(chance, 50),
        7: line + words(chance, 90),
        8: words(chance, 49),
        16: words(chance, 20) + long,
        17: drifted + words(chance, 9),
        20: passage[:30] * 5,
    }
    texts[9] = texts[8]
    copied = words(chance, 80)
    rows = [(k, " ".join(v)) for k, v in texts.items()] + [(18, " ".join(copied)), (19, " ".join(copied)), (21, None), (22, "")]
    found = spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert set(found) == {1, 2, 3, 16, 17, 18, 19}
    for doc_id, begin, end in ((1, 100, 160), (2, 10, 70), (16, 20, 220), (17, 0, 200), (18, 0, 80)):
        assert any(a <= begin and b >= end for a, b, _ in found[doc_id]), doc_id
    assert {c for x in (1, 2, 3) for _, _, c in found[x]} == {1}
    assert {c for x in (16, 17) for _, _, c in found[x]} == {16}


def planted(chance, n):
    """Rows of ``n`` passages of 50 words, each exact in two texts and with an edited word in the middle in a third."""
    rows = []
    for i in range(n):
        passage = words(chance, 50)
        edited = [*passage[:24], "changed", *passage[25:]]
        for k, w in enumerate((passage, passage, edited)):
            rows.append((10 * i + k, " ".join(words(chance, 30) + w + words(chance, 20))))
    return rows


def test_edited_copies_of_passages_with_exact_copies_are_met(spark):
    found = spans(spark.createDataFrame(planted(random.Random(8), 100), "doc_id long, text string"))
    classes = {x: {c for _, _, c in v} for x, v in found.items()}
    assert all(classes[10 * i + 1] == {10 * i} for i in range(100))
    assert sum(classes.get(10 * i + 2) == {10 * i} for i in range(100)) >= 95


def test_hashes_follow_from_recall():
    assert substring_dedup.hashes_needed(0.9999, 0.8) == 6
    assert substring_dedup.hashes_needed(0.99, 0.8) == 3
    assert substring_dedup.hashes_needed(0.9999, 0.5) > 6


def test_recall_of_near_copies_against_brute_force(spark):
    rows = planted(random.Random(12), 600)
    shingled = [{*zip(*[w[k:] for k in range(5)], strict=False)} for w in (t.split()[30:80] for _, t in rows)]
    near = [i for i in range(600) if 0.8 <= len(shingled[3 * i] & shingled[3 * i + 2]) / len(shingled[3 * i] | shingled[3 * i + 2]) < 0.81]
    assert len(near) == 600
    found = spans(spark.createDataFrame(rows, "doc_id long, text string"))
    met = sum(any(a <= 30 and b >= 80 and c == 10 * i for a, b, c in found.get(10 * i + 2, [])) for i in near)
    # 0.06 misses are to be expected.
    assert met >= 599


def test_every_exact_repeat_of_the_table_is_covered(small):
    rows = [(r.doc_id, (r.text or "").split()) for r in small.collect()]
    seen = defaultdict(set)
    for doc_id, w in rows:
        for a in range(len(w) - 49):
            seen[tuple(w[a : a + 50])].add(doc_id)
    found = spans(small, block=64)
    for doc_id, w in rows:
        for a in range(len(w) - 49):
            if len(seen[tuple(w[a : a + 50])]) > 1:
                assert any(x <= a and a + 50 <= y for x, y, _ in found[doc_id]), (doc_id, a)


def test_compact_windows_hold_every_passage_once():
    import numpy as np

    tokens = np.array([5, 3, 9, 3, 7, 1, 8, 8, 2, 6, 4], np.uint64)
    _, left, at, right = substring_dedup.compact_windows(tokens, np.array([0, 11]), 3, 1)
    for a in range(11):
        for b in range(a + 2, 11):
            inside = [i for i in range(len(at)) if left[i] <= a <= at[i] <= b <= right[i]]
            assert len(inside) == 1


def test_passages_of_odd_rows_and_of_nothing(odd, no_rows):
    found = spans(odd)
    assert set(found) == {1, 2, 3, None, 7, 8}
    assert found[7][0][:2] == (0, 30_000)
    assert substring_dedup.repeated_passages(no_rows).count() == 0


def spans_by_hand(rows, least=46, threshold=0.8):
    """Spans of passages that another text has nearly, and the least id of those they are linked with: all passages against all."""
    grams = {d: [tuple(w[i : i + 5]) for i in range(len(w) - 4)] for d, w in ((d, t.split()) for d, t in rows)}
    sets = {(d, a): frozenset(g[a : a + least]) for d, g in grams.items() for a in range(len(g) - least + 1)}
    at = defaultdict(set)
    for key, own in sets.items():
        for x in own:
            at[x].add(key)
    similar = defaultdict(set)
    for key, own in sets.items():
        counts = Counter(k for x in own for k in at[x] if k[0] != key[0])
        for other, n in counts.items():
            if n >= threshold * (len(own) + len(sets[other]) - n) - 1e-9:
                similar[key].add(other)
    spans, span_of = [], {}
    for d, a in sorted(similar):
        if not (spans and spans[-1][0] == d and spans[-1][2] >= a):
            spans.append([d, a, a + least + 4])
        spans[-1][2] = a + least + 4
        span_of[d, a] = len(spans) - 1
    root = list(range(len(spans)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for key, others in similar.items():
        for other in others:
            low, high = sorted((top(span_of[key]), top(span_of[other])))
            root[high] = low
    return [(d, a, b, spans[top(i)][0]) for i, (d, a, b) in enumerate(spans)]


def test_spans_and_classes_against_all_passages(spark):
    """Texts with exact and edited passages, passages that repeat themselves, chains of edits and a common line."""
    chance = random.Random(33)
    passages = [words(chance, chance.randrange(55, 120)) for _ in range(6)]
    loop = words(chance, 9) * 12
    line = words(chance, 14)
    rows = []
    for i in range(48):
        inner = passages[i % 6]
        if i % 4 == 1:
            inner = [w if k % 41 else f"edit{i}" for k, w in enumerate(inner)]
        if i % 8 == 3:
            inner = inner[:30] + loop + inner[30:]
        if i % 8 == 7:
            inner = loop[: 70 + i]
        rows.append((i, " ".join(words(chance, chance.randrange(0, 60)) + inner + line + words(chance, chance.randrange(0, 60)))))
    rows += [(100 + i, " ".join(words(chance, 80) + line)) for i in range(10)]
    want = spans_by_hand(rows)
    found = spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert set(found) == {d for d, *_ in want} and len(want) > 30
    for d, a, b, c in want:
        # the ends of passages that repeat themselves may lack words that change a set by less than a fifth
        slack = 5 if d % 4 == 3 else 0
        assert any(x <= a + slack and b <= y and k == c for x, y, k in found[d]), (d, a, b, c)
    # a stretch goes on while enough of a passage is in the other's surroundings: by less than a fifth of a passage
    for d, own in found.items():
        for x, y, k in own:
            assert any(d == e and a - 10 <= x and y <= b + 10 and k == c for e, a, b, c in want), (d, x, y, k)


def test_similar_passages_with_repeated_shingles():
    """As all pairs of passages say, also where the best window by counts is not similar as a set."""
    import numpy as np

    chance = random.Random(5)
    misses = kinds = 0
    for _ in range(400):
        n = chance.choice([4, 9, 20, 40])
        x = np.array([chance.randrange(n) for _ in range(chance.randrange(10, 40))], np.uint32)
        y = x.copy() if chance.random() < 0.3 else np.array([chance.randrange(n) for _ in range(chance.randrange(10, 40))], np.uint32)
        y[chance.randrange(len(y))] = 99
        own = [set(x[a : a + 10].tolist()) for a in range(len(x) - 9)]
        other = [set(y[a : a + 10].tolist()) for a in range(len(y) - 9)]
        want = any(len(p & q) >= 0.8 * len(p | q) for p in own for q in other)
        misses += (substring_dedup.similar_passages(x, y, 10, 0.8) is not None) != want
        kinds += want
    assert misses == 0 and 20 < kinds < 380


def test_places_of_a_signature_move_through_batches():
    """Signatures of one text are dropped, those of two are kept with each place once, wherever batches end."""
    import pyarrow as pa

    chance = random.Random(4)
    rows = [(s, t, f) for s in range(60) for t in range(chance.choice([1, 1, 2, 5])) for f in range(chance.choice([1, 2, 9]))]
    rows = sorted(rows + [r for r in rows if r[2] == 0])
    want = sorted({r for r in rows if len({t for s, t, _ in rows if s == r[0]}) > 1})
    for size in (1, 2, 3, 7, 50, 10_000):
        batches = []
        for i in range(0, len(rows), size):
            part = list(zip(*rows[i : i + size], strict=True))
            names = ["signature", "text_a", "first"]
            batches.append(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in part], names))
        got = [tuple(r.values()) for b in substring_dedup.shared_places(iter(batches)) for r in b.to_pylist()]
        assert got == want, size


def test_hashes_of_stretches():
    import numpy as np

    tokens = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    tokens[300:350] = tokens[100:150]
    of = substring_dedup._Contents(tokens).of
    one, two, three = (int(of(np.array([a]), np.array([b]))[0]) for a, b in ((100, 150), (300, 350), (300, 349)))
    assert one == two != three


def test_overlapping_places_of_a_home_move_each_shingle_once():
    """Places of one home that overlap are one stretch; those apart, of another home or of a large signature have their own."""
    chance = random.Random(31)
    texts = [words(chance, 300), words(chance, 200)]
    many = substring_dedup.FEW + 1
    # first, size, signature, content, members, shared, home
    places = [
        [(90, 80, 1, 11, 2, False, 5), (10, 90, 2, 12, 3, True, 5), (200, 60, 3, 13, 2, False, 5), (20, 90, 4, 14, 2, False, 6),
         (20, 90, 7, 15, many, False, 7), (30, 90, 7, 16, many, True, 7)],
        [(0, 92, 1, 17, 2, False, 5)],
    ]
    names = ["first", "size", "signature", "content", "members", "shared", "home"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64()]
    wanted = pa.array([[dict(zip(names, x)) for x in own] for own in places], pa.list_(pa.struct(list(zip(names, kinds)))))
    rows = pa.record_batch({"text": [" ".join(x) for x in texts], "text_a": [100, 200], "wanted": wanted})
    found = [x for b in substring_dedup.region_shingles(5)(iter([rows.slice(0, 0), rows])) for x in b.to_pylist()]
    sizes = sorted((x["text_a"], x["home"], len(x["tokens"]) // 4, len(x["parts"])) for x in found)
    assert sizes == [(100, 5, 60, 1), (100, 5, 160, 2), (100, 6, 90, 1), (100, 7, 90, 1), (100, 7, 90, 1), (200, 5, 92, 1)]
    assert sorted((x["members"], x["content"]) for x in found if x["home"] == 7) == [(many, 15), (many, 16)]
    assert {(x["members"], x["content"]) for x in found if x["home"] != 7} == {(1, 0)}
    got = {}
    for x in found:
        for p in x["parts"]:
            tokens = x["tokens"][4 * p["begin"] : 4 * (p["begin"] + p["size"])]
            got[x["text_a"], p["content"]] = (p["signature"], p["shared"], x["home"], tokens)
    whole = [np.concatenate([t for _, t, _ in substring_dedup._rows(iter([rows.slice(i, 1)]), 5)]) for i in range(2)]
    for i, own in enumerate(places):
        for first, size, signature, content, _, shared, home in own:
            tokens = (whole[i][first : first + size] >> np.uint64(32)).astype(np.uint32).tobytes()
            assert got[100 * (i + 1), content] == (signature, shared, home, tokens)


def test_contents_of_a_home_are_verified_as_each_alone():
    """Signatures of a home, their shingles numbered together, against a plain comparison of each two contents."""
    chance = np.random.default_rng(17)
    parts, rows, want = [], [], set()
    for signature in range(60):
        x = chance.integers(0, 2**32, 60, np.uint32) if signature % 3 else chance.integers(0, 25, 60).astype(np.uint32)
        y = x.copy()
        y[chance.random(60) < chance.choice([0.02, 0.3])] = 7
        for text, tokens in ((1, x), (2, y)):
            content = 2 * signature + text
            # some shingles before it, so that parts do not begin with their stretch
            before = chance.integers(0, 2**32, signature % 4, np.uint32)
            part = {"signature": signature, "content": content, "begin": len(before), "size": 60, "shared": False}
            rows.append((9, 0, 0, 0, text, np.concatenate([before, tokens]).tobytes(), [part]))
            parts.append(tokens)
        if substring_dedup.similar_passages(x, y, 46, 0.8) or substring_dedup.similar_passages(y, x, 46, 0.8):
            want.add(signature)
    names = ["home", "left", "right", "block", "text_a", "tokens", "parts"]
    kind = pa.struct([("signature", pa.int64()), ("content", pa.int64()), ("begin", pa.int32()), ("size", pa.int32()), ("shared", pa.bool_())])
    columns = [pa.array(x) for x in zip(*(x[:-1] for x in rows))] + [pa.array([x[-1] for x in rows], pa.list_(kind))]
    batch = pa.RecordBatch.from_arrays(columns, names)
    home = substring_dedup._Home((9, 0, 0), pa.Table.from_batches([batch]))
    assert home.distinct.tolist() == [len(set(x.tolist())) == len(x) for x in parts]
    found = [x for b in substring_dedup.verify(46, 0.8)(iter([batch.slice(0, 50), batch.slice(50)])) for x in b.to_pylist()]
    assert {x["signature"] for x in found} == want and 10 < len(want) < 55
    assert len(found) == len(want)


def test_pairs_compared_at_once_are_compared_as_each_alone():
    """Sizes differ, and pairs share much, little or moved parts; none repeats a shingle."""
    chance = np.random.default_rng(31)
    contents = []
    for _ in range(150):
        x = chance.permutation(400)[: chance.integers(46, 92)]
        y = x.copy()
        edited = chance.random(len(y)) < chance.choice([0.01, 0.1, 0.25])
        y[edited] = 400 + np.arange(edited.sum())
        y = np.roll(y, chance.integers(0, 30)) if chance.random() < 0.3 else y[: chance.integers(46, len(y) + 1)]
        contents += [x, y]
    place, sizes = np.concatenate(contents), np.array([len(x) for x in contents])
    starts = np.cumsum(sizes) - sizes
    xs, ys = np.arange(0, 300, 2), np.arange(1, 300, 2)
    for x, y in ((xs, ys), (ys, xs)):
        found, at = substring_dedup.similar_pairs(place, starts, sizes, x, y, 46, 0.8)
        want = [substring_dedup.similar_passages(contents[a], contents[b], 46, 0.8) for a, b in zip(x, y, strict=True)]
        assert found.tolist() == [w is not None for w in want] and 30 < found.sum() < 120
        assert [((a, b), (c, d)) for a, b, c, d in at[found].tolist()] == [w for w in want if w]


def test_contents_of_one_group_are_not_held_against_each_other(monkeypatch):
    """What is looked up follows the contents of a signature, not their square, once they are one group."""
    chance = np.random.default_rng(33)
    base = chance.integers(0, 2**32, 60, np.uint32)
    names = ["home", "left", "right", "block", "text_a", "tokens", "parts"]
    kind = pa.struct([("signature", pa.int64()), ("content", pa.int64()), ("begin", pa.int32()), ("size", pa.int32()), ("shared", pa.bool_())])
    plain, looked = substring_dedup._hits, []
    monkeypatch.setattr(substring_dedup, "_hits", lambda x, *rest: (looked.append(len(x)), plain(x, *rest))[1])
    for n in (100, 400):
        tokens = np.tile(base, (n, 1))
        tokens[np.arange(n), 50 + np.arange(n) % 10] = np.arange(n)
        parts = [[{"signature": 5, "content": i, "begin": 0, "size": 60, "shared": False}] for i in range(n)]
        columns = [pa.array([5] * n), *(pa.array([0] * n) for _ in range(3)), pa.array(range(n)), pa.array([x.tobytes() for x in tokens])]
        batch = pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.list_(kind))], names)
        looked.clear()
        found = [x for b in substring_dedup.verify(46, 0.8)(iter([batch])) for x in b.to_pylist()]
        assert {x["content"] for x in found} | {x["other"] for x in found} == set(range(n))
        assert sum(looked) < 60 * n * 10


def test_windows_of_texts_that_repeat_a_line_take_few_steps(monkeypatch):
    """A shingle that stands a thousand times in a text makes no step for each, and windows are those of the definition."""
    import numpy as np

    chance = random.Random(8)
    line = [chance.randrange(2**62) for _ in range(12)]
    rows = [line * 1000, [chance.randrange(2**62) for _ in range(700)], line[:5], [chance.randrange(9) for _ in range(300)]]
    tokens = np.array([x for row in rows for x in row], np.uint64)
    begins = np.cumsum([0, *map(len, rows)])
    steps = []
    monkeypatch.setattr(substring_dedup, "_reach", lambda *x, f=substring_dedup._reach: steps.append(1) or f(*x))
    found = sorted(zip(*(x.tolist() for x in substring_dedup.compact_windows(tokens, begins, 46, 3)), strict=True))
    assert len(steps) == 2
    values, want = substring_dedup.mixed(tokens, 3), []
    bits = np.uint64(len(tokens).bit_length())
    values = (values >> bits << bits | np.arange(len(tokens), dtype=np.uint64)).tolist()
    for row, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)):
        todo = [(a, b - 1)] if b - a >= 46 else []
        while todo:
            left, right = todo.pop()
            at = min(range(left, right + 1), key=values.__getitem__)
            want.append((row, left, at, right))
            todo += [x for x in ((left, at - 1), (at + 1, right)) if x[1] - x[0] >= 45]
    assert found == sorted(want)


def test_the_first_place_of_a_content_speaks_for_it():
    """Contents, their last texts and homes are the same wherever batches end; every place passes once."""
    import pyarrow as pa

    chance = random.Random(12)
    rows = sorted({(s, chance.randrange(-3, 9), chance.randrange(6)) for s in range(20) for _ in range(chance.choice([1, 3, 60]))})
    rows = [(*r, 50, chance.randrange(-2, chance.choice([1, 4, 30]))) for r in rows]
    names, kinds = ["signature", "text_a", "first", "size", "content"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    want = {}
    for s, t, f, _, c in rows:
        want.setdefault((s, c), (t, f, t))
        want[s, c] = (*want[s, c][:2], t)
    many = {s: sum(x == s for x, _ in want) for s, _ in want}
    homes = set()
    for size in (1, 3, 50, 10_000):
        parts = [list(zip(*rows[i : i + size], strict=True)) for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(p, kinds, strict=True)], names) for p in parts]
        got = [r for b in substring_dedup.met_contents(iter(batches)) for r in b.to_pylist()]
        assert sorted(tuple(r[x] for x in names) for r in got) == sorted(rows)
        first = [r for r in got if r["members"] is not None]
        assert {(r["signature"], r["content"]): (r["text_a"], r["first"], r["high"]) for r in first} == want
        assert all(r["members"] == many[r["signature"]] for r in first)
        homes.add(frozenset((r["signature"], r["home"]) for r in first))
    assert len(homes) == 1 and len(next(iter(homes))) == len(many)
    assert list(substring_dedup.met_contents(iter([]))) == []


def test_windows_of_many_contents_are_compared_as_rows_of_one_width():
    """Which contents have a stretch of 46 shingles with 41 of another's, for sizes from 46 to 91, against counting by hand."""
    import numpy as np

    chance = random.Random(21)
    pool = [chance.randrange(2**32) for _ in range(130)]
    rows, contents = [], []
    for i in range(60):
        size, first = chance.choice([46, 50, 77, 91]), chance.randrange(40)
        own = [x if chance.random() > 0.08 else chance.randrange(2**32) for x in pool[first : first + size]]
        contents.append(own)
        tokens = np.array(own, np.uint32).tobytes()
        rows.append(dict(home=7, left=0, right=0, block=0, text_a=i, tokens=tokens, parts=[(7, i, 0, size, False)]))
    names = ["signature", "content", "begin", "size", "shared"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
    parts = [[dict(zip(names, p, strict=True)) for p in x.pop("parts")] for x in rows]
    table = pa.Table.from_pylist(rows).append_column("parts", pa.array(parts, pa.list_(pa.struct(list(zip(names, kinds, strict=True))))))
    block = substring_dedup._Block(substring_dedup._Home((7, 0, 0), table), 0, len(rows))
    of, others = block._holds(46, 41), np.arange(len(rows))
    held = 0
    for x, own in enumerate(contents):
        want = [any(sum(t in own for t in y[a : a + 46]) >= 41 for a in range(len(y) - 45)) for y in contents]
        assert of(x, others).tolist() == want
        assert of(x, others[::3]).tolist() == want[::3]
        held += sum(want)
    assert 60 < held < 3000
    assert not substring_dedup._Block(substring_dedup._Home((7, 0, 0), table), 0, 2)._holds(46, 41)(0, others[:0]).size
