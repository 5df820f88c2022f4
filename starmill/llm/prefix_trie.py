"""A trie of conversations' prefixes, built as a burst trie.

A node is a distinct sequence of first turns, the root the empty one; its members are the conversations that start
with it. A container hangs under a trie head and holds the suffixes, behind that head, of the conversations that go
through it. At first one container under the root holds everything. A container of more than ``most_turns`` turns
bursts: its members are dealt by their next turn to containers one turn deeper, and its head becomes a node of the upper
trie. All containers of one depth burst in the same round. When none is oversized, each container's suffixes are
sorted in one task and swept into nodes; a container of one member is a plain chain and is gathered nowhere. Sums over
subtrees then go up the bursted heads, depth by depth.

How it stays bounded: equal conversations are one member with a count, so a conversation that a third of all
rows repeat does not weigh on its containers; a frequent first turn bursts; counts have partial sums before rows move, and the
joins that hand members their container are ones whose hot partitions Spark splits. Turns of a table are put in order by
global numbering, so one conversation may hold any part of the rows. The ids of equal conversations, whose digest has to
be made in order, move as text, as many ids to a row as a batch holds, and pass through the digest one batch after
the other.

A turn is known by the SHA-256 of its role and text. Conversations count as equal by 128 bits of hashes of all their
turns with their places.

Defined results: null role or text is empty; turns are in order of turn, null first, ties by that SHA-256, so
repeated rows are repeated turns; rows without conv_id belong to no conversation; a conversation that is left without turns is a member of
the root; an empty table has no nodes, not even a root; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starmill.llm.common import keys_of, save
from starmill.llm.vectors import runs
from starmill.operators.numbering import global_row_number

MOST_TURNS = 4096
# SHA-256 of nothing: a node at which no conversation ends
NO_ENDS = hashlib.sha256().hexdigest()

_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, top boolean"
)


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn, chars): turns in order with places from 1 on, known by digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").alias("at"), digest.alias("turn"), F.length(text).cast("long").alias("chars")
    )
    rows = save(rows, "trie-turns")
    numbered = save(global_row_number(rows, ["conv_id", "at", "turn"], "number"), "trie-numbered")
    first = numbered.groupBy("conv_id").agg(F.min("number").alias("first"))
    placed = numbered.join(first, "conv_id")
    return placed.select("conv_id", (F.col("number") - F.col("first") + 1).alias("place"), "turn", "chars")


def shared_starts(turns: DataFrame, every: int = 100, kinds: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share their starts: turns (conv_id, depth, turn, chars) and lengths (conv_id, length).

    The first h turns come from conversation c - c % every, the others are c's own after its first h, with h the
    CRC-32 of the decimal id modulo ``kinds``. ``turns`` is what ``ordered_turns`` gives.
    """
    turns = save(turns, "trie-placed")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    taken = (F.crc32(F.col("conv_id").cast("string")) % kinds).alias("taken")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select("*", base, taken)
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    convs = convs.join(sizes, "base", "left").withColumn("shared", F.least("taken", F.coalesce("base_turns", F.lit(0))))
    own = F.greatest(F.col("own") - F.col("taken"), F.lit(0))
    convs = save(convs.select("conv_id", "base", "taken", "shared", (F.col("shared") + own).alias("length")), "trie-convs")
    starts = turns.filter((F.col("conv_id") % every == 0) & (F.col("place") < kinds))
    starts = starts.withColumnsRenamed({"conv_id": "base", "place": "depth"})
    before = convs.select("conv_id", "base", "shared").join(starts, "base").filter("depth <= shared")
    after = turns.join(convs.select("conv_id", "taken", "shared"), "conv_id").filter("place > taken")
    after = after.withColumn("depth", F.col("place") - F.col("taken") + F.col("shared"))
    columns = ["conv_id", "depth", "turn", "chars"]
    return before.select(columns).unionByName(after.select(columns)), convs.select("conv_id", "length")


def _ends(members: DataFrame) -> DataFrame:
    """(rep, ends): SHA-256 of the ascending ids of each group of ``members`` (rep, conv_id), joined by commas."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (rep,), part in runs(batches, ["rep"]):
            ids = part.column("conv_id").to_pylist()
            yield pa.RecordBatch.from_pylist([{"rep": rep, "first": ids[0], "ids": ",".join(map(str, ids))}])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep, state = None, None
        for (other,), part in runs(batches, ["rep"]):
            for ids in part.column("ids").to_pylist():
                if other != rep:
                    if state:
                        yield pa.RecordBatch.from_pylist([{"rep": rep, "ends": state.hexdigest()}])
                    rep, state = other, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if state:
            yield pa.RecordBatch.from_pylist([{"rep": rep, "ends": state.hexdigest()}])

    dealt = members.repartitionByRange("rep", "conv_id").sortWithinPartitions("rep", "conv_id")
    parts = dealt.mapInArrow(texts, "rep long, first long, ids string")
    return parts.repartition("rep").sortWithinPartitions("rep", "first").mapInArrow(digests, "rep long, ends string")


def distinct_conversations(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(rep, copies, length, ends): one row for equal conversations, named by the least id."""
    hashes = turns.groupBy("conv_id").agg(
        F.expr("bit_xor(xxhash64(depth, turn))").alias("x"), F.expr("bit_xor(xxhash64(turn, 'other', depth))").alias("y")
    )
    known = lengths.join(hashes, "conv_id", "left").na.fill(0, ["x", "y"])
    known = save(known, "trie-hashes")
    key = ["x", "y", "length"]
    groups = known.groupBy(*key).agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = save(groups, "trie-groups")
    several = groups.filter("copies > 1").select(*key, "rep")
    ends = _ends(known.join(several, key).select("rep", "conv_id"))
    alone = groups.filter("copies = 1").withColumn("ends", F.sha2(F.col("rep").cast("string"), 256))
    columns = ["rep", "copies", "length", "ends"]
    return alone.select(columns).unionByName(groups.filter("copies > 1").join(ends, "rep").select(columns))


def _swept(rows: DataFrame) -> DataFrame:
    """Nodes of containers: rows (node, depth0, parent, rep, copies, depth, turn, chars, ends) of their members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, depth), table in keys_of(batches, ["node", "depth0"]):
            yield from sweep(table.combine_chunks(), depth).to_batches()

    dealt = rows.repartition("node", "depth0").sortWithinPartitions("node", "depth0", "rep", "depth")
    return dealt.mapInArrow(run, _NODES)


def sweep(table: pa.Table, depth0: int) -> pa.Table:
    """Nodes of one container: suffixes are sorted, and ranges of equal first turns become nodes, top down."""
    reps = table.column("rep").to_numpy()
    starts = np.flatnonzero(np.append(True, reps[1:] != reps[:-1]))
    ends = np.append(starts[1:], len(reps))
    codes = table.column("turn").combine_chunks().dictionary_encode().indices.to_numpy().astype(">i4")
    order = sorted(range(len(starts)), key=lambda i: codes[starts[i] : ends[i]].tobytes())
    starts, ends = starts[order], ends[order]
    names, sizes = reps[starts], ends - starts
    copies = table.column("copies").to_numpy()[starts]
    chars = table.column("chars").to_numpy()
    digests = table.column("ends").to_pylist()
    above = table.column("parent")[0].as_py()
    # of nodes with several members, parents first: conv, depth, parent's place, members, own cost, digest
    conv, depth, up, members, digest = [], [], [], [], []
    children, leaves, saved = [], [], []
    chains: list[tuple] = []
    todo = [(0, len(starts), 0, -1)]
    while todo:
        low, high, k, parent = todo.pop()
        if parent >= 0:
            children[parent] += 1
        if high - low == 1:
            rest = chars[starts[low] + k : ends[low]]
            costs = (copies[low] - 1) * np.cumsum(rest[::-1])[::-1]
            chains.append((low, k, parent, costs))
            if parent >= 0:
                leaves[parent] += 1
                saved[parent] += int(costs[0])
            continue
        here = len(conv)
        conv.append(int(names[low:high].min()))
        depth.append(depth0 + k)
        up.append(parent)
        members.append(int(copies[low:high].sum()))
        saved.append((members[-1] - 1) * int(chars[starts[low] + k]))
        children.append(0)
        leaves.append(0)
        ended = int(sizes[low] == k + 1)
        digest.append(digests[ends[low] - 1] if ended else NO_ENDS)
        following = codes[starts[low + ended : high] + k + 1]
        cuts = [0, *(np.flatnonzero(following[1:] != following[:-1]) + 1).tolist(), len(following)]
        todo += [(low + ended + a, low + ended + b, k + 1, here) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]
    for i in range(len(conv) - 1, -1, -1):
        leaves[i] = leaves[i] or 1
        if up[i] >= 0:
            leaves[up[i]] += leaves[i]
            saved[up[i]] += saved[i]
    shared = pa.table(
        {
            "conv_id": pa.array(conv, pa.int64()),
            "depth": pa.array(depth, pa.int64()),
            "parent_conv_id": pa.array([above if x < 0 else conv[x] for x in up], pa.int64()),
            "n_convs": pa.array(members, pa.int64()),
            "n_children": pa.array(children, pa.int64()),
            "n_leaves": pa.array(leaves, pa.int64()),
            "saved_tokens": pa.array(saved, pa.int64()),
            "ends_sha256": pa.array(digest, pa.string()),
            "top": pa.array([x < 0 for x in up], pa.bool_()),
        }
    )
    parts = [shared]
    for low, k, parent, costs in chains:
        n = len(costs)
        name = int(names[low])
        parts.append(
            pa.table(
                {
                    "conv_id": pa.array(np.full(n, name)),
                    "depth": pa.array(depth0 + k + np.arange(n, dtype=np.int64)),
                    "parent_conv_id": pa.array([above if parent < 0 else conv[parent], *[name] * (n - 1)], pa.int64()),
                    "n_convs": pa.array(np.full(n, copies[low])),
                    "n_children": pa.array(np.append(np.ones(n - 1, np.int64), 0)),
                    "n_leaves": pa.array(np.ones(n, np.int64)),
                    "saved_tokens": pa.array(costs.astype(np.int64)),
                    "ends_sha256": pa.array([*[NO_ENDS] * (n - 1), digests[ends[low] - 1]], pa.string()),
                    "top": pa.array([parent < 0, *[False] * (n - 1)], pa.bool_()),
                }
            )
        )
    return pa.concat_tables(parts)


def _chains(rows: DataFrame) -> DataFrame:
    """Nodes of containers with one member, row by row; only repeated conversations need a sum along the chain."""
    down = Window.partitionBy("rep").orderBy(F.desc("depth"))
    once = rows.filter("copies = 1").withColumn("saved", F.lit(0).cast("long"))
    more = rows.filter("copies > 1").withColumn("saved", (F.col("copies") - 1) * F.sum("chars").over(down))
    top = F.col("depth") == F.col("depth0")
    return once.unionByName(more).select(
        F.col("rep").alias("conv_id"),
        "depth",
        F.when(top, F.col("parent")).otherwise(F.col("rep")).alias("parent_conv_id"),
        F.col("copies").alias("n_convs"),
        (F.col("depth") < F.col("length")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.when(F.col("depth") < F.col("length"), NO_ENDS).otherwise(F.col("ends")).alias("ends_sha256"),
        top.alias("top"),
    )


def prefix_trie(turns: DataFrame, lengths: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """The nodes of the trie: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``turns`` is (conv_id, depth, turn, chars) with depths from 1 on, ``lengths`` (conv_id, length) of every
    conversation, those without turns too. A node is named by its least member and its depth.
    """
    turns = save(turns, "trie-rebuilt")
    distinct = save(distinct_conversations(turns, lengths), "trie-distinct")
    start = {"depth": F.lit(0).cast("long"), "turn": F.lit("no turn"), "chars": F.lit(0).cast("long")}
    tops = distinct.select("rep").withColumns(start)
    rows = turns.withColumnRenamed("conv_id", "rep").join(distinct.select("rep"), "rep")
    rows = save(rows.select("rep", "depth", "turn", "chars").unionByName(tops), "trie-rows")

    # the one container under the root
    whole = distinct.agg(
        F.min("rep").alias("node"), F.count(F.lit(1)).alias("members"),
        F.coalesce(F.sum(F.col("length") + 1), F.lit(0)).alias("turns"), F.sum("copies").alias("n_convs"),
    ).first().asDict()
    whole |= {"parent": None, "chars": 0}
    held = distinct.withColumns({name: F.lit(value).cast("long") for name, value in whole.items()})
    settled, heads, depth = [], [], 0
    while True:
        held = held.withColumn("depth0", F.lit(depth).cast("long"))
        oversized = (F.col("members") > 1) & (F.col("turns") > most_turns)
        settled.append(held.filter(~oversized))
        bursting = held.filter(oversized)
        if bursting.isEmpty():
            break
        ended = F.max(F.when(F.col("length") == depth, F.col("ends")))
        heads.append(
            bursting.groupBy("node").agg(
                F.first("parent").alias("parent"), F.first("n_convs").alias("n_convs"), F.first("chars").alias("chars"),
                F.coalesce(ended, F.lit(NO_ENDS)).alias("ends"),
            )
        )
        going = bursting.select("rep", "copies", "length", "ends", F.col("node").alias("parent"))
        following = rows.filter(F.col("depth") == depth + 1).select("rep", "turn", "chars")
        going = save(going.join(following, "rep"), "trie-going")
        groups = going.groupBy("parent", "turn").agg(
            F.min("rep").alias("node"), F.count(F.lit(1)).alias("members"),
            F.sum(F.col("length") - depth).alias("turns"), F.sum("copies").alias("n_convs"),
        )
        held = save(going.join(groups, ["parent", "turn"]).drop("turn"), "trie-held")
        depth += 1

    columns = ["node", "depth0", "parent", "members", "rep", "copies", "length", "ends"]
    settled = reduce(DataFrame.unionByName, [x.select(columns) for x in settled])
    inside = settled.join(rows, "rep").filter("depth >= depth0")
    below = _chains(inside.filter("members = 1")).unionByName(_swept(inside.filter("members > 1")))
    done = [save(below, "trie-nodes")]
    for at in range(len(heads) - 1, -1, -1):
        above = reduce(DataFrame.unionByName, done[:1] + done[1:][-1:])
        children = above.filter((F.col("depth") == at + 1) & F.col("top"))
        sums = children.groupBy(F.col("parent_conv_id").alias("node")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below")
        )
        own = heads[at].join(sums, "node")
        done.append(
            save(
                own.select(
                    F.col("node").alias("conv_id"),
                    F.lit(at).cast("long").alias("depth"),
                    F.col("parent").alias("parent_conv_id"),
                    "n_convs",
                    "n_children",
                    "n_leaves",
                    (F.col("below") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
                    F.col("ends").alias("ends_sha256"),
                    F.lit(True).alias("top"),
                ),
                "trie-heads",
            )
        )
    return reduce(DataFrame.unionByName, done).drop("top")
