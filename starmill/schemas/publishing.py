"""The publishing source: 11 tables behind the title reports.

Names, types, lengths, patterns, lists, bounds and defaults are fixed values.
"""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from starmill.functions.text import like_class
from starmill.schemas.tables import (
    NOW,
    Check,
    Field,
    Table,
    binary,
    by_name,
    code,
    flag,
    moment,
    money,
    small,
    text,
    tiny,
    to,
    whole,
)

AUTHOR_ID = "[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]"
ZIP_CODE = "[0-9][0-9][0-9][0-9][0-9]"
LISTED_PUBLISHERS = ("1389", "0736", "0877", "1622", "1756")
OTHER_PUBLISHER = "99[0-9][0-9]"
EMPLOYEE_ID = (
    "[A-Z][A-Z][A-Z][1-9][0-9][0-9][0-9][0-9][FM]",
    "[A-Z]-[A-Z][1-9][0-9][0-9][0-9][0-9][FM]",
)
LOWEST_LEVEL = 10
HIGHEST_LEVEL = 250


# The three named types of the source: their length, and that they are required.
def author_key(name: str) -> Field:
    return text(name, 11, required=True)


def title_key(name: str) -> Field:
    return text(name, 6, required=True)


def employee_key(name: str) -> Field:
    return code(name, 9, required=True)


def publisher_key(name: str, **more) -> Field:
    return code(name, 4, **more)


PUBLISHING = by_name(
    Table(
        "authors",
        (
            author_key("au_id"),
            text("au_lname", 40, True),
            text("au_fname", 20, True),
            code("phone", 12, True, default="UNKNOWN"),
            text("address", 40),
            text("city", 20),
            code("state", 2),
            code("zip", 5),
            flag("contract", True),
        ),
        key=("au_id",),
        checks=(
            Check("au_id_pattern", lambda: like_class(F.col("au_id"), AUTHOR_ID)),
            Check("zip_pattern", lambda: like_class(F.col("zip"), ZIP_CODE)),
        ),
    ),
    Table(
        "publishers",
        (
            publisher_key("pub_id", required=True),
            text("pub_name", 40),
            text("city", 20),
            code("state", 2),
            text("country", 30, default="USA"),
        ),
        key=("pub_id",),
        checks=(
            Check(
                "pub_id_known",
                lambda: F.col("pub_id").isin(*LISTED_PUBLISHERS)
                | like_class(F.col("pub_id"), OTHER_PUBLISHER),
            ),
        ),
    ),
    Table(
        "titles",
        (
            title_key("title_id"),
            text("title", 80, True),
            code("type", 12, True, default="UNDECIDED"),
            publisher_key("pub_id"),
            money("price"),
            money("advance"),
            whole("royalty"),
            whole("ytd_sales"),
            text("notes", 200),
            moment("pubdate", True, default=NOW),
        ),
        key=("title_id",),
        references=(to("publishers", "pub_id"),),
    ),
    Table(
        "titleauthor",
        (author_key("au_id"), title_key("title_id"), tiny("au_ord"), whole("royaltyper")),
        key=("au_id", "title_id"),
        references=(to("authors", "au_id"), to("titles", "title_id")),
    ),
    Table(
        "stores",
        (
            code("stor_id", 4, True),
            text("stor_name", 40),
            text("stor_address", 40),
            text("city", 20),
            code("state", 2),
            code("zip", 5),
        ),
        key=("stor_id",),
    ),
    Table(
        "sales",
        (
            code("stor_id", 4, True),
            text("ord_num", 20, True),
            moment("ord_date", True),
            small("qty", True),
            text("payterms", 12, True),
            title_key("title_id"),
        ),
        key=("stor_id", "ord_num", "title_id"),
        references=(to("stores", "stor_id"), to("titles", "title_id")),
    ),
    Table(
        "roysched",
        (title_key("title_id"), whole("lorange"), whole("hirange"), whole("royalty")),
        references=(to("titles", "title_id"),),
    ),
    Table(
        "discounts",
        (
            text("discounttype", 40, True),
            code("stor_id", 4),
            small("lowqty"),
            small("highqty"),
            Field("discount", T.DecimalType(4, 2), True),
        ),
        references=(to("stores", "stor_id"),),
    ),
    Table(
        "jobs",
        (
            small("job_id", True, identity=True),
            text("job_desc", 50, True, default="New Position - title not formalized yet"),
            tiny("min_lvl", True),
            tiny("max_lvl", True),
        ),
        key=("job_id",),
        checks=(
            Check("min_lvl_bound", lambda: F.col("min_lvl") >= LOWEST_LEVEL),
            Check("max_lvl_bound", lambda: F.col("max_lvl") <= HIGHEST_LEVEL),
        ),
    ),
    Table(
        "pub_info",
        (publisher_key("pub_id", required=True), binary("logo"), text("pr_info")),
        key=("pub_id",),
        references=(to("publishers", "pub_id"),),
    ),
    Table(
        "employee",
        (
            employee_key("emp_id"),
            text("fname", 20, True),
            code("minit", 1),
            text("lname", 30, True),
            small("job_id", True, default=1),
            tiny("job_lvl", default=LOWEST_LEVEL),
            publisher_key("pub_id", required=True, default="9952"),
            moment("hire_date", True, default=NOW),
        ),
        key=("emp_id",),
        references=(to("jobs", "job_id"), to("publishers", "pub_id")),
        checks=(
            Check(
                "emp_id_pattern",
                lambda: like_class(F.col("emp_id"), EMPLOYEE_ID[0])
                | like_class(F.col("emp_id"), EMPLOYEE_ID[1]),
            ),
        ),
    ),
)
