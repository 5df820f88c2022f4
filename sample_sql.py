"""SQL that gives the same rows as the registered queries, on the same tables."""

from __future__ import annotations

from sample_tables import AS_OF, LINE_KEY, NAMES


def _company(table: str, key: str, name: str, nation: str, alias: str) -> str:
    return f"""
        SELECT {key} AS {alias}, {name} AS company_name,
               'Contact of ' || {name} AS contact_name, 'City ' || {nation} AS city,
               n_name AS country,
               CASE WHEN r_name <> 'ASIA' THEN r_name END AS region
        FROM {table}
        LEFT JOIN nation ON {nation} = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey"""


_ORDERS = """
    orders_v AS (
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS employee_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_orderdate AS DATE) + 28 AS required_date,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 7 END AS shipped_date
        FROM orders)"""

_LINES = """
    lines_v AS (
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               l_extendedprice / l_quantity AS unit_price, l_quantity AS quantity,
               l_discount AS discount, l_suppkey AS supplier_id, l_linenumber AS line_number,
               l_shipdate AS shipped
        FROM lineitem)"""

_CALENDAR = f"""
    calendar AS (
        SELECT row_number() OVER (ORDER BY d) AS date_id, CAST(d AS DATE) AS date
        FROM (SELECT unnest(generate_series(
                  CAST((SELECT min(o_orderdate) FROM orders) AS TIMESTAMP),
                  TIMESTAMP '{AS_OF}', INTERVAL 1 DAY)) AS d))"""

_LINE_ORDER = ", ".join(f"od.{c}" for c in LINE_KEY)

_FACT = f"""
    WITH {_ORDERS}, {_LINES}, {_CALENDAR}
    SELECT row_number() OVER (ORDER BY {_LINE_ORDER}) AS fact_id,
           od.order_id, od.product_id, od.quantity, od.unit_price,
           od.unit_price * od.quantity AS extended_price, od.discount,
           (od.unit_price * od.quantity) * (1 - od.discount) AS total_price,
           CASE WHEN o.shipped_date IS NULL THEN 'fulfilled' ELSE 'not fulfilled' END
               AS order_status,
           o.customer_id, p.p_size AS supplier_id, o.employee_id,
           d1.date_id AS order_date_id, d2.date_id AS required_date_id,
           d3.date_id AS shipped_date_id
    FROM lines_v od
    LEFT JOIN orders_v o ON od.order_id = o.order_id
    LEFT JOIN part p ON od.product_id = p.p_partkey
    LEFT JOIN calendar d1 ON o.order_date = d1.date
    LEFT JOIN calendar d2 ON o.required_date = d2.date
    LEFT JOIN calendar d3 ON o.shipped_date = d3.date"""

_TITLES = """
    titles AS (
        SELECT p_partkey AS title_id, p_name AS title, p_type AS type, p_brand AS pub_id,
               CAST(p_retailprice AS DECIMAL(19,4)) AS price, p_size AS ytd_sales
        FROM part)"""

_EVENTS_TEXT = """
    events_text AS (
        SELECT event_id, ts AS ts_value, CAST(ts AS VARCHAR) AS ts,
               strftime(ts, '%Y-%m-%d') AS iso_day, strftime(ts, '%-m/%-d/%y') AS us_day,
               CASE WHEN event_type <> 'click' THEN event_type END AS event_type,
               CASE WHEN value > 5 THEN value END AS value,
               CAST(user_id AS VARCHAR) AS user_text
        FROM events)"""


def _profile(source: str, columns: list[tuple[str, ...]], prefix: str = "") -> str:
    """``columns``: name, source type, staged type, date form, logical type, as SQL values."""
    parts = []
    for i, (name, kind, staged, form, logical) in enumerate(columns):
        parts.append(
            f"""SELECT '{name}' AS "column", {i} AS position, '{kind}' AS source_type,
                       {staged} AS staged_type, count(*) AS "rows",
                       count(*) - count({name}) AS nulls, count({name}) < count(*) AS nullable,
                       CAST({form} AS VARCHAR) AS date_form,
                       CAST({logical} AS VARCHAR) AS logical_type
                FROM {source}"""
        )
    return prefix + " UNION ALL ".join(parts)


def _moment(name: str) -> tuple[str, ...]:
    midnight = f"bool_and({name} = date_trunc('day', {name}))"
    return (
        name,
        "timestamp_ntz",
        f"CASE WHEN {midnight} THEN 'date' ELSE 'timestamp_ntz' END",
        "NULL",
        f"CASE WHEN {midnight} THEN 'date' ELSE 'timestamp' END",
    )


def _text_date(name: str, pattern: str, form: str, date_format: str) -> tuple[str, ...]:
    fits = (
        f"count(*) FILTER (regexp_full_match({name}, '{pattern}') AND "
        f"try_strptime({name}, '{date_format}') IS NOT NULL) = count({name})"
    )
    return (
        name,
        "string",
        f"CASE WHEN {fits} THEN 'date' ELSE 'string' END",
        f"CASE WHEN {fits} THEN '{form}' END",
        f"CASE WHEN {fits} THEN 'date' END",
    )


def _plain(name: str, kind: str, staged: str) -> tuple[str, ...]:
    return (name, kind, f"'{staged}'", "NULL", "NULL")


_TIME_FITS = (
    r"count(*) FILTER (regexp_full_match(ts, "
    r"'\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?') "
    "AND try_cast(ts AS TIMESTAMP) IS NOT NULL) = count(ts)"
)


def _part_rows(rule: str, broken: str, detail: str) -> str:
    return f"""
        SELECT '{rule}' AS rule, 'part' AS "table", '{{"p_partkey":' || p_partkey || '}}' AS key,
               {detail} AS detail, CAST(1 AS BIGINT) AS n_rows
        FROM part WHERE {broken}"""


_PATTERN = _part_rows(
    "check:brand_pattern", "NOT regexp_full_match(p_brand, 'Brand#[0-9]')", "p_brand"
)
_KNOWN = _part_rows(
    "check:brand_known",
    "NOT (p_brand IN ('Brand#1', 'Brand#3') OR regexp_full_match(p_brand, 'Brand#2[0-9]'))",
    "p_brand",
)
_LENGTH = _part_rows(
    "length:p_name", "length(rtrim(p_name)) > 9", "length(rtrim(p_name)) || ' > 9'"
)
_PK = """
    SELECT 'primary_key' AS rule, 'lineitem' AS "table",
           '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}' AS key,
           'duplicate' AS detail, count(*) AS n_rows
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


def _missing(child: str, column: str, parent: str, key: str, known: str, parent_name: str) -> str:
    return f"""
        SELECT 'foreign_key:{column}' AS rule, '{child}' AS "table",
               '{{"{column}":' || {column} || '}}' AS key, 'not in {parent_name}' AS detail,
               count(*) AS n_rows
        FROM {parent} WHERE {column} NOT IN (SELECT {key} FROM {known}) GROUP BY {column}"""


ORACLES = {
    "dim_suppliers": _company("supplier", "s_suppkey", "s_name", "s_nationkey", "supplier_id"),
    "dim_customers": _company("customer", "c_custkey", "c_name", "c_nationkey", "customer_id"),
    "dim_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, n_name AS category_name,
               p_size AS units_in_stock, p_size * 2 AS reorder_level,
               CASE WHEN p_type = 'PROMO' THEN 1 ELSE 0 END AS discontinued
        FROM part LEFT JOIN nation ON p_size = n_nationkey""",
    "dim_employees": """
        SELECT e.p_partkey AS employee_id, e.p_brand || ' ' || e.p_type AS employee_full_name,
               e.p_name AS title, DATE '1990-01-01' + e.p_size AS hire_date,
               r.n_name AS region_description, 'USA' AS country,
               count(et.l_suppkey) AS number_of_territories_managing
        FROM part e
        LEFT JOIN lineitem et ON e.p_partkey = et.l_partkey
        LEFT JOIN supplier t ON et.l_suppkey = t.s_suppkey
        LEFT JOIN nation r ON t.s_nationkey = r.n_nationkey
        GROUP BY 1, 2, 3, 4, 5""",
    "dim_date": f"WITH {_CALENDAR} SELECT date_id, date FROM calendar",
    "fact_table": _FACT,
    "fact_table_role_dates": _FACT,
    "order_line_numbers": f"""
        WITH {_LINES}
        SELECT row_number() OVER (ORDER BY {_LINE_ORDER}) AS fact_id, order_id, product_id,
               supplier_id, line_number
        FROM lines_v od""",
    "identity_numbers": """
        SELECT c_mktsegment, c_custkey, c_name,
               row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS customer_no
        FROM customer""",
    "titleview": """
        SELECT p_name AS title, l_linenumber AS au_ord, o_orderpriority AS au_lname,
               CAST(CAST(p_retailprice AS DECIMAL(19,4)) AS DOUBLE) AS price,
               p_size AS ytd_sales, p_brand AS pub_id
        FROM orders, part, lineitem
        WHERE o_orderkey = l_orderkey AND p_partkey = l_partkey""",
    "byroyalty": "SELECT l_orderkey AS au_id FROM lineitem WHERE CAST(l_quantity AS INTEGER) = 40",
    # the price in ten-thousandths, so that the average rounds half up in whole numbers
    "reptq1": f"""
        WITH {_TITLES}
        SELECT CASE WHEN grouping(pub_id) = 1 THEN 'ALL' ELSE pub_id END AS pub_id,
               ((2 * sum(CAST(price * 10000 AS HUGEINT)) + count(price)) // (2 * count(price)))
                   / 10000.0 AS avg_price
        FROM titles WHERE price IS NOT NULL GROUP BY ROLLUP (pub_id)""",
    "reptq2": f"""
        WITH {_TITLES}
        SELECT CASE WHEN grouping(type) = 1 THEN 'ALL' ELSE type END AS type,
               CASE WHEN grouping(pub_id) = 1 THEN 'ALL' ELSE pub_id END AS pub_id,
               CAST(sum(ytd_sales) // count(ytd_sales) AS BIGINT) AS avg_ytd_sales
        FROM titles WHERE pub_id IS NOT NULL GROUP BY ROLLUP (pub_id, type)""",
    "reptq3": f"""
        WITH {_TITLES}
        SELECT CASE WHEN grouping(pub_id) = 1 THEN 'ALL' ELSE pub_id END AS pub_id,
               CASE WHEN grouping(type) = 1 THEN 'ALL' ELSE type END AS type,
               count(title_id) AS cnt
        FROM titles
        WHERE price > 910 AND price < 950.5 AND type = 'ECONOMY' OR type LIKE '%PROMO%'
        GROUP BY ROLLUP (pub_id, type)""",
    "profile_events": _profile(
        "events_text",
        [
            _plain("event_id", "bigint", "bigint"),
            (
                "ts",
                "string",
                f"CASE WHEN {_TIME_FITS} THEN 'timestamp_ntz' ELSE 'string' END",
                f"CASE WHEN {_TIME_FITS} THEN 'iso_time' END",
                f"CASE WHEN {_TIME_FITS} THEN 'timestamp' END",
            ),
            _text_date("iso_day", r"\d{4}-\d{2}-\d{2}", "iso_day", "%Y-%m-%d"),
            _text_date("us_day", r"\d{1,2}/\d{1,2}/\d{2}", "month_first", "%m/%d/%y"),
            _plain("event_type", "string", "string"),
            _plain("value", "double", "double"),
            _plain("user_text", "string", "string"),
        ],
        f"WITH {_EVENTS_TEXT} ",
    ),
    "profile_orders": _profile(
        "orders",
        [
            _plain("o_orderkey", "bigint", "bigint"),
            _plain("o_custkey", "bigint", "bigint"),
            _plain("o_orderstatus", "string", "string"),
            _plain("o_totalprice", "double", "double"),
            _moment("o_orderdate"),
            _plain("o_orderpriority", "string", "string"),
        ],
    ),
    "profile_documents": _profile(
        "documents",
        [
            _plain("doc_id", "bigint", "bigint"),
            _plain("text", "string", "string"),
            _plain("lang", "string", "string"),
            _plain("source", "string", "string"),
            _plain("n_chars", "bigint", "bigint"),
        ],
    ),
    # milliseconds are cut, not rounded
    "normalise_events": f"""
        WITH {_EVENTS_TEXT}
        SELECT event_id, epoch_us(ts_value) // 1000 AS ts, CAST(iso_day AS DATE) AS iso_day,
               CAST(strptime(us_day, '%m/%d/%y') AS DATE) AS us_day,
               coalesce(event_type, 'None') AS event_type, value, user_text
        FROM events_text""",
    "staged_events": f"""
        WITH {_EVENTS_TEXT}
        SELECT event_id, epoch_us(ts_value) // 1000 AS ts,
               epoch_us(CAST(CAST(iso_day AS DATE) AS TIMESTAMP)) // 1000 AS iso_day,
               epoch_us(strptime(us_day, '%m/%d/%y')) // 1000 AS us_day,
               event_type, value, user_text
        FROM events_text""",
    "times_as_text": """
        SELECT event_id, strftime(ts, '%d %b %Y %H:%M:%S:') ||
                   lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') AS written,
               CAST(floor(value) AS INTEGER) AS whole
        FROM events""",
    "epoch_millis_roundtrip": f"""
        WITH {_ORDERS}
        SELECT order_id, epoch_ms(CAST(order_date AS TIMESTAMP)) AS order_millis,
               epoch_ms(CAST(shipped_date AS TIMESTAMP)) AS ship_millis,
               order_date AS order_day,
               epoch_ms(CAST(order_date AS TIMESTAMP)) AS millis_of_time, shipped_date AS ship_day
        FROM orders_v""",
    "month_first_dates": """
        SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%y') AS written,
               CAST(strptime(strftime(o_orderdate, '%m/%d/%y'), '%m/%d/%y') AS DATE) AS parsed
        FROM orders""",
    "table_inventory": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in NAMES
    ),
    "load_truncate": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               epoch_ms(o_orderdate) AS o_orderdate, o_orderpriority
        FROM orders""",
    "replace_own_table": f"""
        SELECT customer_id, company_name, contact_name, country, region
        FROM ({_company("customer", "c_custkey", "c_name", "c_nationkey", "customer_id")})
        WHERE region IS NOT NULL""",
    "default_fill": """
        SELECT CAST(c_custkey AS VARCHAR) AS au_id, c_name AS au_lname, c_mktsegment AS au_fname,
               'UNKNOWN' AS phone, CAST(NULL AS VARCHAR) AS address,
               CASE WHEN c_acctbal > 0 THEN 'Berlin' END AS city,
               CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS zip,
               c_nationkey <> 0 AS contract
        FROM customer""",
    "dq_not_null": f"""
        WITH {_ORDERS}
        SELECT 'not_null:shipped_date' AS rule, 'orders' AS "table",
               '{{"order_id":' || order_id || '}}' AS key, 'NULL' AS detail,
               CAST(1 AS BIGINT) AS n_rows
        FROM orders_v WHERE shipped_date IS NULL""",
    "dq_pk": _PK,
    "dq_fk": _missing("orders", "o_custkey", "orders", "c_custkey", "customer", "customer"),
    "dq_fk_broken": _missing(
        "lineitem",
        "l_suppkey",
        "lineitem",
        "s_suppkey",
        "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
        "supplier",
    ),
    "dq_self_fk": _missing(
        "customer",
        "reports_to",
        "(SELECT c_custkey + 100 AS reports_to FROM customer)",
        "c_custkey",
        "customer",
        "customer",
    ),
    "dq_check_pattern": _PATTERN,
    "dq_check_list_or_pattern": _KNOWN,
    "dq_check_bound": _part_rows("check:size_low", "p_size < 10", "CAST(p_size AS VARCHAR)")
    + " UNION ALL "
    + _part_rows("check:size_high", "p_size > 40", "CAST(p_size AS VARCHAR)"),
    "dq_length": _LENGTH,
    "dq_int_width": """
        SELECT 'range:o_custkey' AS rule, 'orders' AS "table",
               '{"o_orderkey":' || o_orderkey || '}' AS key, CAST(o_custkey AS VARCHAR) AS detail,
               CAST(1 AS BIGINT) AS n_rows
        FROM orders WHERE o_custkey NOT BETWEEN 0 AND 255""",
    "dq_row_rule": """
        WITH staff AS (
            SELECT s_suppkey AS emp_id, s_nationkey AS job_id,
                   CAST(floor(abs(s_acctbal) / 40) AS INTEGER) AS job_lvl,
                   10 + n_nationkey * 2 AS min_lvl, 100 + n_nationkey * 5 AS max_lvl
            FROM supplier JOIN nation ON s_nationkey = n_nationkey)
        SELECT CASE WHEN job_id = 1 AND job_lvl <> 10 THEN 'first_job_level'
                    ELSE 'job_level' END AS rule,
               'employee' AS "table", '{"emp_id":' || emp_id || '}' AS key,
               CASE WHEN job_id = 1 AND job_lvl <> 10 THEN 'job 1 expects the level 10'
                    ELSE 'job ' || job_id || ' expects ' || min_lvl || ' to ' || max_lvl
               END AS detail,
               CAST(1 AS BIGINT) AS n_rows
        FROM staff
        WHERE (job_id = 1 AND job_lvl <> 10) OR job_lvl NOT BETWEEN min_lvl AND max_lvl""",
    "dq_declared_rules": """
        SELECT rule, "table", count(*) AS violations, CAST(sum(n_rows) AS BIGINT) AS n_rows
        FROM (
            SELECT 'check:in_credit' AS rule, 'supplier' AS "table", 1 AS n_rows
            FROM supplier WHERE s_acctbal < 0
            UNION ALL SELECT 'length:s_name', 'supplier', 1
            FROM supplier WHERE length(rtrim(s_name)) > 18
            UNION ALL SELECT 'length:p_name', 'part', 1 FROM part WHERE length(rtrim(p_name)) > 9
            UNION ALL SELECT 'length:p_brand', 'part', 1 FROM part WHERE length(rtrim(p_brand)) > 8
            UNION ALL SELECT 'length:p_type', 'part', 1 FROM part WHERE length(rtrim(p_type)) > 8
            UNION ALL SELECT 'check:brand_pattern', 'part', 1
            FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#[0-9]')
            UNION ALL SELECT 'primary_key', 'part', count(*)
            FROM part GROUP BY p_brand, p_size HAVING count(*) > 1
            UNION ALL SELECT 'check:some_tax', 'lineitem', 1 FROM lineitem WHERE NOT l_tax > 0.07
            UNION ALL SELECT 'primary_key', 'lineitem', count(*)
            FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
            UNION ALL SELECT 'foreign_key:l_partkey', 'lineitem', count(*)
            FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY l_partkey
            UNION ALL SELECT 'foreign_key:l_suppkey', 'lineitem', count(*)
            FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
            GROUP BY l_suppkey)
        GROUP BY rule, "table\"""",
    "dq_rule_counts": f"""
        SELECT rule, "table", count(*) AS violations, CAST(sum(n_rows) AS BIGINT) AS n_rows
        FROM ({_PATTERN} UNION ALL {_KNOWN} UNION ALL {_LENGTH} UNION ALL {_PK})
        GROUP BY rule, "table\"""",
}


def _counts(layer: str, table: str, rows: str) -> str:
    return f"SELECT '{layer}' AS layer, '{table}' AS table_name, count(*) AS n_rows FROM {rows}"


_RAW = {
    "categories": "nation",
    "customers": "customer",
    "employee_territories": "lineitem",
    "employees": "part",
    "order_details": "lineitem",
    "orders": "orders",
    "products": "part",
    "region": "nation",
    "suppliers": "supplier",
    "territories": "supplier",
    "customer_demographics": "(SELECT 1 WHERE false)",
}
_STAR = ("dim_customers", "dim_date", "dim_employees", "dim_products", "dim_suppliers", "fact_table")

ORACLES["daily_fact"] = ORACLES["fact_table"]
ORACLES["daily_tables"] = " UNION ALL ".join(
    [_counts("raw", name, rows) for name, rows in _RAW.items()]
    + [_counts("star", name, f"({ORACLES[name]})") for name in _STAR]
)


def _day(name: str, form: str) -> tuple[str, ...]:
    return (name, "string", "'date'", f"'{form}'", "'date'")


ORACLES["profile_written_dates"] = _profile(
    "written",
    [
        _day("day_name", "day_month_name"),
        _day("month_name", "month_name_first"),
        _day("short_iso", "iso_day"),
        _day("slashed", "slashed"),
        _day("with_blanks", "iso_day"),
        _plain("only_blanks", "string", "string"),
    ],
    """WITH written AS (
        SELECT strftime(ts, '%-d-%b-%Y') AS day_name, strftime(ts, '%B %-d, %Y') AS month_name,
               strftime(ts, '%Y-%-m-%-d') AS short_iso, strftime(ts, '%Y/%-m/%-d') AS slashed,
               CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS with_blanks, '' AS only_blanks
        FROM events) """,
)

ORACLES["reptq1_places"] = f"""
    SELECT pub_id, row_number() OVER (ORDER BY pub_id) AS place FROM ({ORACLES["reptq1"]})"""
ORACLES["calendar_to_today"] = """
    SELECT CAST(min(o_orderdate) AS DATE) AS low, true AS begins_with_orders, 0 AS days_short,
           CAST(0 AS BIGINT) AS days_too_many
    FROM orders"""
ORACLES["profile_flags"] = """
    SELECT 'in_credit' AS "column", 0 AS position, 'boolean' AS source_type, 'boolean' AS staged_type,
           count(*) AS "rows", count(*) - count(c_acctbal) AS nulls, true AS nullable,
           CAST(NULL AS VARCHAR) AS date_form, CAST(NULL AS VARCHAR) AS logical_type FROM customer
    UNION ALL
    SELECT 'c_custkey', 1, 'bigint', 'bigint', count(*), 0, false, NULL, NULL FROM customer"""
ORACLES["durations"] = """
    SELECT l_orderkey, l_linenumber, 'P' || (1 + l_linenumber) || 'DT2H3M4.500000S' AS lasted FROM lineitem"""

ORACLES["loaded_schema"] = f"""
    SELECT 'events' AS "table", "column", nullable, logical_type FROM ({ORACLES["profile_events"]})"""

ORACLES["staged_after_failure"] = """
    SELECT o_orderkey, o_custkey, o_totalprice, true AS second_run_failed, 'orders' AS tables FROM orders"""
ORACLES["staged_inventory"] = """
    SELECT 'orders' AS table_name, 'complete' AS state, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'nation', 'foreign', count(*) FROM nation
    UNION ALL SELECT 'region', 'complete', count(*) FROM region
    UNION ALL SELECT 'customer', 'broken', 0
    UNION ALL SELECT 'part', 'unfinished', 0
    UNION ALL SELECT '(empty folder)', 'refused', 0"""
ORACLES["replaced_under_readers"] = """
    SELECT 'shown' AS reading, count(*) AS n_rows FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT 'version before', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'odd polls', 0"""
ORACLES["declared_insert"] = """
    SELECT lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS au_id, c_name AS au_lname, c_mktsegment AS au_fname,
           'UNKNOWN' AS phone, CAST(NULL AS VARCHAR) AS address, CAST(NULL AS VARCHAR) AS city,
           c_mktsegment[1:1] AS state, CAST(NULL AS VARCHAR) AS zip, c_acctbal > 0 AS contract
    FROM customer"""
ORACLES["declared_refusals"] = """
    SELECT 'a missing required value' AS attempt, true AS refused, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'a text that is too long', true, count(*) FROM customer
    UNION ALL SELECT 'a required column left out', true, count(*) FROM customer
    UNION ALL SELECT 'an unknown column', true, count(*) FROM customer
    UNION ALL SELECT 'the same rows again', false, 2 * count(*) FROM customer"""
ORACLES["now_default"] = """
    SELECT count(*) AS n_rows, count(*) AS n_dated, 0 AS most_days_ago, CAST(1 AS BIGINT) AS n_moments FROM part"""
ORACLES["literal_rows"] = """
    SELECT s_suppkey, CAST(s_nationkey % 4 AS SMALLINT) AS shipper_id, company_name, phone
    FROM supplier LEFT JOIN (
        VALUES (0, 'Speedy Express', NULL), (1, 'United Package', '555'), (2, 'Federal Shipping', NULL)
    ) AS shippers (shipper_id, company_name, phone) ON shippers.shipper_id = s_nationkey % 4"""
ORACLES["dropped_tables"] = """
    SELECT 'plain_stays' AS table_name, count(*) AS n_rows FROM nation
    UNION ALL SELECT 'replaced_stays', count(*) FROM region
    UNION ALL SELECT 'stores', 0"""
ORACLES["titleview_stored"] = ORACLES["titleview"]

_SPARK_TYPE = """
    CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                   WHEN 'VARCHAR' THEN 'string' ELSE lower(data_type) END"""
ORACLES["catalog_columns"] = f"""
    SELECT table_name, CASE table_name WHEN 'customer' THEN 'REPLACED' ELSE 'MANAGED' END AS table_type, column_name,
           CAST(ordinal_position AS INTEGER) AS position, {_SPARK_TYPE} AS data_type, true AS nullable,
           CAST(NULL AS VARCHAR) AS column_default
    FROM information_schema.columns WHERE table_name IN ('customer', 'supplier')
    UNION ALL
    SELECT 'debtors', 'VIEW', column_name, CAST(row_number() OVER (ORDER BY ordinal_position) AS INTEGER), {_SPARK_TYPE},
           true, NULL
    FROM information_schema.columns WHERE table_name = 'customer' AND column_name IN ('c_custkey', 'c_acctbal')
    UNION ALL
    SELECT 'publishers', 'MANAGED', * FROM (VALUES
        ('pub_id', 1, 'char(4)', false, NULL),
        ('pub_name', 2, 'varchar(40)', true, NULL),
        ('city', 3, 'varchar(20)', true, NULL),
        ('state', 4, 'char(2)', true, NULL),
        ('country', 5, 'varchar(30)', true, '''USA'''))"""
ORACLES["record_schemas"] = f"""
    SELECT 'events' AS "table", 'staging' AS namespace, 'web events' AS doc, position, "column",
           CASE WHEN logical_type IS NOT NULL OR staged_type = 'bigint' THEN 'long' ELSE staged_type END AS type,
           CASE WHEN logical_type IS NOT NULL THEN 'timestamp-millis' END AS logical_type, nullable,
           CAST(NULL AS VARCHAR) AS column_doc
    FROM ({ORACLES["profile_events"]})"""
ORACLES["record_drift"] = """
    SELECT 'customer' AS "table", 'c_mktsegment' AS "column", 'dropped' AS change, 'string' AS before,
           CAST(NULL AS VARCHAR) AS after
    UNION ALL SELECT 'customer', 'c_nationkey', 'retyped',
                     CASE typeof(any_value(c_nationkey)) WHEN 'INTEGER' THEN 'int' ELSE 'long' END, 'string' FROM customer
    UNION ALL SELECT 'customer', 'in_credit', 'added', NULL, 'boolean'
    UNION ALL SELECT 'customer', 'c_acctbal', 'may be missing', 'double', 'double'
              FROM customer HAVING count(*) FILTER (c_acctbal <= 0) > 0
    UNION ALL SELECT 'orders', 'o_orderkey', 'added', NULL, 'long'"""
ORACLES["equal_splits"] = """
    SELECT count(*) AS n_rows, count(*) AS n_in_one_part, count(*) FILTER (l_linenumber = 7) AS n_without_value,
           true AS parts_are_even
    FROM lineitem"""
