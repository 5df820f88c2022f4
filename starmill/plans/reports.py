"""The title view and the publisher reports."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from starmill.functions.numbers import MONEY
from starmill.functions.text import like_class, unpad
from starmill.operators.rollup import average_money, average_whole, count_of, labelled_rollup
from starmill.sources.catalog import quoted

Tables = Mapping[str, DataFrame]


def titleview(t: Tables) -> DataFrame:
    """One row per author of a title."""
    return (
        t["titleauthor"]
        .select("au_id", "title_id", "au_ord")
        .join(t["authors"].select("au_id", "au_lname"), "au_id")
        .join(t["titles"].select("title_id", "title", "price", "ytd_sales", "pub_id"), "title_id")
        .select("title", "au_ord", "au_lname", "price", "ytd_sales", "pub_id")
    )


def titleview_query(db: str) -> str:
    """The same view as SQL over the tables of a database, for a view that is stored."""
    return (
        f"SELECT t.title, ta.au_ord, a.au_lname, t.price, t.ytd_sales, t.pub_id FROM {quoted(db, 'titleauthor')} ta "
        f"JOIN {quoted(db, 'authors')} a ON a.au_id = ta.au_id JOIN {quoted(db, 'titles')} t ON t.title_id = ta.title_id"
    )


def byroyalty(t: Tables, percentage: int) -> DataFrame:
    """Authors with the given royalty share, once per title."""
    shares = t["titleauthor"]
    return shares.filter(F.col("royaltyper") == F.lit(percentage)).select("au_id")


def reptq1(t: Tables) -> DataFrame:
    """Average price per publisher and over all, sorted by the label."""
    priced = t["titles"].filter(F.col("price").isNotNull())
    return labelled_rollup(priced, ["pub_id"], [average_money("avg_price", "price")]).orderBy(
        "pub_id"
    )


def reptq2(t: Tables) -> DataFrame:
    """Integer average of sales per publisher and type, per publisher, and over all."""
    known = t["titles"].filter(F.col("pub_id").isNotNull())
    measures = [average_whole("avg_ytd_sales", "ytd_sales")]
    return labelled_rollup(known, ["pub_id", "type"], measures).select(
        "type", "pub_id", "avg_ytd_sales"
    )


def reptq3(
    t: Tables,
    lolimit: Decimal | float | str,
    hilimit: Decimal | float | str,
    type: str,
    always: str = "%cook%",
    ignore_case: bool = False,
) -> DataFrame:
    """Titles of a type priced between the limits, both excluded, and all titles whose type is
    like ``always`` whatever their price; counted per publisher and type with subtotals.
    """

    def fold(c):
        return F.lower(c) if ignore_case else c

    kind = fold(unpad(F.col("type")))
    low, high = (F.lit(str(v)).cast(MONEY) for v in (lolimit, hilimit))
    in_range = (F.col("price") > low) & (F.col("price") < high)
    wanted = (in_range & (kind == fold(F.lit(type.rstrip(" "))))) | like_class(
        kind, always.lower() if ignore_case else always
    )
    return labelled_rollup(
        t["titles"].filter(wanted), ["pub_id", "type"], [count_of("cnt", "title_id")]
    )
