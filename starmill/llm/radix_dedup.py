"""Exact dedup by distributed MSD radix partitioning.

Texts are split by their successive bytes: first by the bytes at the start, then each group by the next
bytes, and so on. A group is done when it has one text, or when its texts have ended. Each round takes a
run of bytes as one radix digit, the runs growing eightfold, so a text of n bytes is done after about
log8(n / 64) rounds, and bytes behind a round's run move on only while their group is shared. Groups
are told apart by the bytes themselves; no digest decides. A round counts the groups with partial sums
before rows move, and the join that hands rows their group is one whose hot partitions Spark splits.

Defined results: null text counts as empty, and all empty texts are one group; the smallest doc_id of a
group stays, a null id only if the group has no other; where several rows of a group have that id, one of
them stays; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmill.llm.common import WHITESPACE, packed, save, text_or_empty

FIRST_RUN, GROWTH = 64, 8

_GROUP = ["in_id", "in_row", "digit", "ended"]
_DONE = ["doc_id", "row_id", "group_row", "keep_id", "group_size", "text_sha256"]


def normalised(name: str = "text") -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(text_or_empty(name), WHITESPACE, " ")


def row_hash() -> Column:
    """Tells rows of one doc_id apart by their texts, and is the same when a lost task runs again."""
    return F.xxhash64("doc_id", "text")


def _split(rows: DataFrame, width: int) -> DataFrame:
    """Splits each group by its next ``width`` bytes; a new group is named by its smallest ids."""
    cut = rows.withColumns(
        {
            "digit": F.expr(f"substring(rest, 1, {width})"),
            "ended": F.octet_length("rest") <= width,
            "rest": F.expr(f"substring(rest, {width + 1})"),
        }
    )
    groups = cut.groupBy(*_GROUP).agg(
        F.min("doc_id").alias("keep_id"),
        F.min("row_id").alias("group_row"),
        F.count(F.lit(1)).alias("group_size"),
    )
    groups = groups.withColumnsRenamed({name: f"of_{name}" for name in _GROUP})
    same = [F.col(name).eqNullSafe(F.col(f"of_{name}")) for name in _GROUP]
    shared = (F.col("group_size") > 1) & ~F.col("ended")
    return cut.join(groups, same).select(*_DONE, F.when(shared, F.col("rest")).alias("rest"))


def equal_texts(docs: DataFrame) -> DataFrame:
    """The group of every row: doc_id, row_id, group_row, keep_id, group_size, text_sha256.

    (keep_id, group_row) names the group; row_id is ``row_hash`` of the row.
    """
    text = normalised()
    rows = docs.select(
        "doc_id",
        row_hash().alias("row_id"),
        F.sha2(text, 256).alias("text_sha256"),
        text.cast("binary").alias("rest"),
        F.lit(None).cast(docs.schema["doc_id"].dataType).alias("in_id"),
        F.lit(0).cast("long").alias("in_row"),
    )
    done, width = None, FIRST_RUN
    while True:
        split = save(_split(rows, width), "radix")
        part = split.filter(F.col("rest").isNull()).select(*_DONE)
        done = part if done is None else done.unionByName(part)
        shared = split.filter(F.col("rest").isNotNull())
        if shared.isEmpty():
            return done
        rows = shared.select(
            "doc_id",
            "row_id",
            "text_sha256",
            "rest",
            F.col("keep_id").alias("in_id"),
            F.col("group_row").alias("in_row"),
        )
        width *= GROWTH


def _marked(docs: DataFrame) -> DataFrame:
    """The groups with ``kept``. Only rows that have the kept id are ranked: of a hot group they are few."""
    groups = equal_texts(docs).withColumn("has_id", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    first = Window.partitionBy("keep_id", "group_row").orderBy("row_id")
    ranked = groups.filter("has_id").withColumn("kept", F.row_number().over(first) == 1)
    return ranked.unionByName(groups.filter("not has_id").withColumn("kept", F.lit(False)))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row, dropped ones too."""
    return _marked(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stay = _marked(docs).filter("kept").select(F.col("doc_id").alias("stays"), "row_id")
    rows = packed(docs).withColumn("row_hash", row_hash())
    same = F.col("stays").eqNullSafe(F.col("doc_id")) & (F.col("row_id") == F.col("row_hash"))
    # Rows that also repeat the kept row's id and text differ in other columns at most: the first stays.
    others = [F.col("row")[name].cast("string") for name in docs.columns if name not in ("doc_id", "text")]
    one = Window.partitionBy("doc_id", "row_hash").orderBy(*others, "doc_id")
    kept = rows.join(stay, same, "left_semi").withColumn("place", F.row_number().over(one)).filter("place = 1")
    return kept.select("row.*")
