"""The conversation trie against one built node by node."""

import hashlib
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starmill.llm import prefix_trie

SF = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn int, role string, text string"


def rebuilt_by_hand(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            digest = hashlib.sha256(f"{len(said[0])}:{said[0]}{said[1]}".encode()).hexdigest()
            convs.setdefault(conv, []).append((-1 if turn is None else turn, digest, said))
    plain = {c: [x[2] for x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = plain.get(base, [])[:h] + own[h:]
    return out


def trie_by_hand(convs):
    starts = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            starts.setdefault(tuple(turns[:d]), []).append(c)
    nodes = {}
    for start in sorted(starts, key=len, reverse=True):
        members = sorted(starts[start])
        below = [x for s, x in nodes.items() if len(s) == len(start) + 1 and s[: len(start)] == start]
        cost = (len(members) - 1) * (len(start[-1][1]) if start else 0)
        ended = ",".join(str(c) for c in members if len(convs[c]) == len(start))
        nodes[start] = {
            "conv_id": members[0],
            "depth": len(start),
            "parent_conv_id": min(starts[start[:-1]]) if start else None,
            "n_convs": len(members),
            "n_children": len(below),
            "n_leaves": sum(x["n_leaves"] for x in below) or 1,
            "saved_tokens": cost + sum(x["saved_tokens"] for x in below),
            "ends_sha256": hashlib.sha256(ended.encode()).hexdigest(),
        }
    return nodes.values()


def nodes(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def wanted(rows):
    return sorted((tuple(sorted(x.items())) for x in trie_by_hand(rebuilt_by_hand(rows))), key=str)


def built(spark, rows, most_turns=prefix_trie.MOST_TURNS):
    df = spark.createDataFrame(rows, TURNS).withColumns({x: F.lit("x") for x in ("place", "depth", "node", "rep", "length")})
    turns = prefix_trie.ordered_turns(df)
    return prefix_trie.prefix_trie(*prefix_trie.shared_starts(turns), most_turns)


@pytest.fixture(scope="module")
def odd_turns():
    chance = random.Random(6)
    rows = []
    for c in [*range(60), *range(100, 130), *range(-130, -90), 255]:
        for t in range(chance.randrange(1, 9)):
            rows.append((c, t, chance.choice(["user", "assistant", None]), chance.choice(["a", "bb", "日本", "", None])))
    # repeated turns, ties, null turns, no conversation, a hot conversation, one long conversation
    rows += [(5, 0, "user", "a"), (5, 0, "user", "a"), (6, None, "user", "first"), (6, None, None, None), (None, 0, "user", "x")]
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(40) for t in range(3)]
    rows += [(2000, t, "user", f"{t % 7}") for t in range(300)]
    # a prefix of another one; conversations that end within what they take from others
    rows += [(3000, t, "user", "p") for t in range(4)] + [(3001, t, "user", "p") for t in range(2)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("most_turns", [4096, 60, 3])
def test_trie_of_odd_rows(spark, odd_turns, most_turns):
    """Containers that burst never, at the root, and down to the last shared turn give the same nodes."""
    assert nodes(built(spark, odd_turns, most_turns)) == wanted(odd_turns)


def test_one_conversation_and_equal_ones(spark):
    one = [(7, t, "user", "x" * t) for t in range(3)]
    assert nodes(built(spark, one)) == wanted(one)
    same = [(c, t, "user", "xyz") for c in (107, 113, 200, 9) for t in range(7)]
    assert nodes(built(spark, same)) == wanted(same)


def test_conversations_without_turns(spark):
    """A conversation shorter than what it takes from an absent one has no turns and ends at the root."""
    rows = [(c, 0, "user", "only") for c in range(201, 240)]
    found = built(spark, rows)
    assert nodes(found) == wanted(rows)
    assert [r.ends_sha256 == prefix_trie.NO_ENDS for r in found.collect() if r.depth == 0] == [False]


def test_no_conversations(spark, odd_turns):
    assert built(spark, odd_turns[:1]).limit(0).count() == 0
    assert built(spark, [(None, 1, "user", "x")]).count() == 0


def test_ids_of_equal_conversations_are_hashed_in_order(spark):
    """Over many range partitions and batches, with more ids than one batch holds."""
    members = spark.range(25_000).select(F.lit(3).cast("long").alias("rep"), F.col("id").alias("conv_id"))
    members = members.unionByName(spark.range(5).select(F.lit(9).cast("long").alias("rep"), (F.col("id") - 2).alias("conv_id")))
    got = {r.rep: r.ends for r in prefix_trie._ends(members.repartition(16)).collect()}
    text = ",".join(map(str, range(25_000)))
    assert got == {3: hashlib.sha256(text.encode()).hexdigest(), 9: hashlib.sha256(b"-2,-1,0,1,2").hexdigest()}


def test_sweep_of_one_container():
    """Two conversations part after two turns; a third ends where they part."""
    rows = [(1, 0, "r"), (1, 1, "a"), (1, 2, "b"), (2, 0, "r"), (2, 1, "a"), (2, 2, "c"), (3, 0, "r"), (3, 1, "a")]
    table = pa.table(
        {
            "rep": [r[0] for r in rows], "depth": [r[1] for r in rows], "turn": [r[2] for r in rows],
            "chars": [0 if r[1] == 0 else 5 for r in rows], "copies": [1, 1, 1, 2, 2, 2, 1, 1],
            "ends": [f"end {r[0]}" for r in rows], "parent": pa.array([None] * 8, pa.int64()),
        }
    )
    found = {(r["conv_id"], r["depth"]): r for r in prefix_trie.sweep(table, 0).to_pylist()}
    assert set(found) == {(1, 0), (1, 1), (1, 2), (2, 2)}
    assert found[1, 1]["n_convs"] == 4 and found[1, 1]["n_children"] == 2 and found[1, 1]["ends_sha256"] == "end 3"
    assert found[1, 0]["saved_tokens"] == 3 * 5 + 5 and found[2, 2]["saved_tokens"] == 5 and found[1, 0]["n_leaves"] == 2
    assert [r["top"] for r in found.values()].count(True) == 1


def test_a_whole_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    from starmill.llm.queries import op13_prefix_trie

    assert nodes(op13_prefix_trie(spark, SF)) == wanted(rows)
