"""The registered queries as SQL for an independent engine (DuckDB dialect).

Money is summed in whole cents and means are rounded in integer arithmetic, so
that both engines yield the same DOUBLE.
"""

from __future__ import annotations

from tidemark.functions.dates import WEEKDAY_NAMES
from tidemark.plans import cube_queries, nested_queries, order_queries, stream_queries, table_queries
from tidemark.plans.registry import (
    CHANNEL, MIN_CATEGORIES, OTHER_PRODUCT, PRODUCT, STATE, TEST_START, TYPED_TABLES,
)

# Columns of the test tables, in order.
COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "nation": "n_nationkey n_name n_regionkey",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "labels": "doc_id quality toxic",
    "pages": "page_id url html",
    "region": "r_regionkey r_name",
    "embeddings": "vec_id embedding label",
    "benchmark": "item_id text",
    "conversations": "conv_id turn role text",
}


def _rounded(cents: str, n: str) -> str:
    """Mean in money of a non-negative cent sum, halves up."""
    return f"CAST((2 * ({cents}) + ({n})) // (2 * ({n})) AS DOUBLE) / 100"


def _money(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


# Base tables ------------------------------------------------------------------

ORDERS = """o AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderdate AS created_at,
         CAST(o_orderdate AS DATE) AS day, o_orderpriority AS channel, o_orderstatus AS status,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders)"""
ITEMS = """i AS (
  SELECT l_orderkey AS order_id, p_partkey AS product_id, p_name AS name,
         CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS category_id, p_brand AS category,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""
ADDRESSES = """a AS (
  SELECT c_custkey AS customer_id, n_name AS state
  FROM customer JOIN nation ON n_nationkey = c_nationkey)"""
SUPPLIER_ADDRESSES = """sa AS (
  SELECT DISTINCT o_custkey AS customer_id, s_nationkey AS state
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey)"""
METRICS = f"""{ORDERS}, {ITEMS},
v AS (SELECT customer_id, sum(cents) AS cents, count(DISTINCT id) AS frequency FROM o GROUP BY 1),
d AS (SELECT customer_id, count(DISTINCT category_id) AS diversity
      FROM o JOIN i ON i.order_id = o.id GROUP BY 1),
m AS (SELECT v.customer_id, v.cents, frequency, diversity FROM v JOIN d USING (customer_id)),
elite AS (SELECT * FROM m WHERE diversity >= {MIN_CATEGORIES}
          ORDER BY CAST(cents AS DOUBLE) / frequency DESC, customer_id LIMIT 10)"""
INTER = f"""{ORDERS}, {ITEMS},
x AS (SELECT DISTINCT customer_id, product_id FROM i JOIN o ON o.id = i.order_id),
nb AS (SELECT product_id, count(*) AS n FROM x GROUP BY 1)"""
SIMILARITY = f"""{INTER},
s AS (SELECT p.product_a, p.product_b, co, co / (sqrt(na.n) * sqrt(nc.n)) AS similarity
      FROM (SELECT l.product_id AS product_a, r.product_id AS product_b, count(*) AS co
            FROM x l JOIN x r ON r.customer_id = l.customer_id AND l.product_id < r.product_id
            GROUP BY 1, 2) p
      JOIN nb na ON na.product_id = product_a JOIN nb nc ON nc.product_id = product_b)"""
SIMILAR_TO_ONE = f"""{INTER},
c AS (SELECT product_id, count(*) AS co FROM x
      WHERE customer_id IN (SELECT customer_id FROM x WHERE product_id = {PRODUCT}) GROUP BY 1),
t AS (SELECT nb.product_id, coalesce(co, 0) AS co, coalesce(co, 0) / (sqrt(nb.n) * sqrt(ref.n)) AS similarity
      FROM nb JOIN nb ref ON ref.product_id = {PRODUCT} LEFT JOIN c ON c.product_id = nb.product_id
      WHERE nb.product_id <> {PRODUCT} ORDER BY round(similarity, 12) DESC, nb.product_id LIMIT 5)"""
DEMAND = f"""{ORDERS}, {ITEMS},
dm AS (SELECT product_id, CAST(date_trunc('month', day) AS DATE) AS month,
              CAST(sum(quantity) AS BIGINT) AS units
       FROM i JOIN o ON o.id = i.order_id GROUP BY 1, 2)"""
FILLED = f"""{DEMAND},
sp AS (SELECT product_id, min(month) AS lo, max(month) AS hi FROM dm GROUP BY 1),
fm AS (SELECT g.product_id, g.month, coalesce(units, 0) AS units
       FROM (SELECT product_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
             FROM sp) g
       LEFT JOIN dm ON dm.product_id = g.product_id AND dm.month = g.month)"""
NAMES = "[" + ", ".join(f"'{n}'" for n in WEEKDAY_NAMES) + "]"
CALENDAR = f"""{ORDERS},
g AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM o), (SELECT max(day) FROM o),
                                         INTERVAL 1 DAY)) AS DATE) AS day),
cal AS (SELECT day, CAST(isodow(day) AS INTEGER) AS isodow, {NAMES}[isodow(day)] AS weekday FROM g),
dsl AS (SELECT day, sum(cents) AS cents FROM o WHERE channel = '{CHANNEL}' GROUP BY 1),
wm AS (SELECT isodow, weekday, count(*) AS n_days, count(dsl.cents) AS n_sale_days,
              coalesce(sum(dsl.cents), 0) AS cents
       FROM cal LEFT JOIN dsl USING (day) GROUP BY 1, 2),
wk AS (SELECT isodow, weekday, {_rounded('cents', 'n_days')} AS mean_sales,
              {_rounded('cents', 'n_sale_days')} AS naive_mean, n_days, n_sale_days FROM wm)"""


def _forecast(k: int, horizon: int) -> str:
    """Unrolled recursive mean over columns p1..pk (window) and q1..qh (actuals)."""
    start = f"DATE '{TEST_START}-01'"
    window = [f"max(CASE WHEN month = {start} - INTERVAL {k - j} MONTH THEN units END) AS p{j + 1}"
              for j in range(k)]
    actual = [f"max(CASE WHEN month = {start} + INTERVAL {j} MONTH THEN units END) AS q{j + 1}"
              for j in range(horizon)]
    base = f"""{FILLED},
w0 AS (SELECT product_id, {', '.join(window + actual)},
              sum(units) / count(*) AS mean_units,
              sum(CASE WHEN month < {start} THEN units END)
                / count(CASE WHEN month < {start} THEN 1 END) AS mean_before
       FROM fm GROUP BY 1
       HAVING min(month) <= {start} - INTERVAL {k} MONTH
          AND max(month) >= {start} + INTERVAL {horizon - 1} MONTH)"""
    values = [f"p{j + 1}" for j in range(k)]
    for j in range(horizon):
        mean = f"({' + '.join(values[-k:])}) / {k}.0"
        base += f",\nw{j + 1} AS (SELECT *, round_even({mean}, 0) AS f{j + 1} FROM w{j})"
        values.append(f"f{j + 1}")
    rows = " UNION ALL ".join(
        f"SELECT product_id, strftime({start} + INTERVAL {j} MONTH, '%Y-%m') AS month, "
        f"CAST(f{j + 1} AS BIGINT) AS predicted, q{j + 1} AS actual, mean_units, mean_before FROM w{horizon}"
        for j in range(horizon)
    )
    return f"{base},\nfc AS ({rows})"


# Type inference ----------------------------------------------------------------

D = r"[0-9]+(_[0-9]+)*"
INT = rf"^\s*[+-]?{D}\s*$"
NUM = rf"^\s*[+-]?(({D}\.?({D})?|\.{D})(e[+-]?{D})?|nan|inf|infinity)\s*$"
KIND = rf"""CASE
  WHEN regexp_matches(v, '^0[0-9]') OR (length(v) > 15 AND regexp_matches(v, '{INT}')) THEN 'code'
  WHEN upper(v) IN ('TRUE', 'FALSE') THEN 'boolean'
  WHEN regexp_matches(v, '{INT}') THEN 'integer'
  WHEN regexp_matches(v, '{NUM}', 'i') THEN 'number'
  WHEN try_strptime(v, ['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y %H:%M:%S', '%d/%m/%Y'])
       IS NOT NULL THEN 'date'
  ELSE 'text' END"""


def _cells(columns: list[tuple[str, int, str, str, str]]) -> str:
    """(table, pos, column, v) over the given (table, position, name, expression, source)."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", CAST({p} AS INTEGER) AS pos, '{c}' AS \"column\", "
        f"CAST({e} AS VARCHAR) AS v FROM {s}"
        for t, p, c, e, s in columns
    )


def _types(columns: list[tuple[str, int, str, str, str]]) -> str:
    return f"""cells AS ({_cells(columns)}),
kinds AS (SELECT *, CASE WHEN v IS NULL OR v = '' THEN 'empty' ELSE {KIND} END AS kind FROM cells),
sums AS (SELECT "table", pos, "column", count(*) FILTER (kind <> 'empty') AS n_filled,
           count(*) FILTER (kind = 'code') AS n_code,
           count(*) FILTER (kind = 'boolean') AS n_boolean,
           count(*) FILTER (kind = 'integer') AS n_integer,
           count(*) FILTER (kind = 'number') AS n_number,
           count(*) FILTER (kind = 'date') AS n_date,
           max(CASE WHEN kind = 'integer' THEN abs(TRY_CAST(replace(trim(v), '_', '') AS BIGINT)) END) AS max_int,
           min(CASE WHEN kind = 'code' THEN v END) AS sample_code
         FROM kinds GROUP BY 1, 2, 3),
types AS (SELECT *, CASE WHEN n_filled = 0 OR n_code > 0 THEN 'TEXT'
           WHEN n_boolean = n_filled THEN 'BOOLEAN'
           WHEN n_integer = n_filled THEN CASE WHEN max_int <= 2147483647 THEN 'INTEGER' ELSE 'BIGINT' END
           WHEN n_integer + n_number = n_filled THEN 'NUMERIC'
           WHEN n_date = n_filled THEN 'TIMESTAMP' ELSE 'TEXT' END AS type FROM sums)"""


def _table_columns(tables: list[str], key: bool = False) -> list[tuple[str, int, str, str, str]]:
    out = []
    for t in tables:
        for p, c in enumerate(COLUMNS[t].split()):
            name = "id" if key and p == 0 and t != "lineitem" else c
            out.append((t, p, name, c, t))
    return out


CODED = [
    ("orders", 0, "order_code", "lpad(CAST(o_orderkey AS VARCHAR), 12, '0')", "orders"),
    ("orders", 1, "day_first", "strftime(o_orderdate, '%d/%m/%Y')", "orders"),
    ("orders", 2, "iso_day", "strftime(o_orderdate, '%Y-%m-%d')", "orders"),
    ("orders", 3, "customer_id", "o_custkey", "orders"),
    ("orders", 4, "long_id", "o_custkey + 3000000000", "orders"),
]
EVENT_CELLS = [("e", p, c, c, "events") for p, c in enumerate(COLUMNS["events"].split())]


def _brl(cents: str) -> str:
    """Whole cents as 'R$ 1.234,56'."""
    return (
        f"'R$ ' || replace(format('{{:,}}', CAST(({cents}) // 100 AS BIGINT)), ',', '.') || ',' "
        f"|| lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0')"
    )


def _thousands(n: str) -> str:
    return f"replace(format('{{:,}}', CAST({n} AS BIGINT)), ',', '.')"


def _quantile(column: str, p: float) -> str:
    return f"quantile_cont({column}, {p})"


LABELLED = "SELECT doc_id, lang, source, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"
TOP_PRODUCTS = f"""{ITEMS},
tp AS (SELECT product_id, name, CAST(sum(quantity) AS BIGINT) AS units, {_money('sum(cents)')} AS revenue
       FROM i GROUP BY 1, 2)"""
STATE_PRODUCTS = f"""{ORDERS}, {TOP_PRODUCTS}, {ADDRESSES},
st AS (SELECT product_id, name, CAST(sum(quantity) AS BIGINT) AS units, {_money('sum(i.cents)')} AS revenue
       FROM i JOIN o ON o.id = i.order_id JOIN a USING (customer_id)
       WHERE state = '{STATE}' GROUP BY 1, 2)"""
CUSTOMER_STATE = f"""{ORDERS}, {ADDRESSES},
cs AS (SELECT state, customer_id, c_name AS legal_name, sum(cents) AS cents
       FROM o JOIN a USING (customer_id) JOIN customer ON c_custkey = customer_id GROUP BY 1, 2, 3)"""
MULTI_STATE = f"""{ORDERS}, {SUPPLIER_ADDRESSES},
ns AS (SELECT customer_id, count(DISTINCT state) AS n_states FROM sa GROUP BY 1 HAVING count(DISTINCT state) > 1),
sp AS (SELECT customer_id, sum(cents) AS cents FROM o GROUP BY 1),
ms AS (SELECT customer_id, c_name AS legal_name, n_states, cents
       FROM sp JOIN ns USING (customer_id) JOIN customer ON c_custkey = customer_id)"""

SQL: dict[str, str] = {
    "i1_read_raw_csv": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang, source,
  CAST(n_chars AS VARCHAR) AS n_chars FROM documents""",
    "i2_infer_types": f"""WITH {_types(_table_columns(TYPED_TABLES))}
SELECT "table", pos, "column", type, n_filled, n_code, max_int FROM types""",
    "i2a_code_columns": f"""WITH {_types(CODED)} SELECT "column", type, n_filled, n_code FROM types""",
    "i2b_value_classes": f"""WITH cells AS ({_cells(EVENT_CELLS)})
SELECT "column", {KIND} AS kind, count(*) AS n FROM cells GROUP BY 1, 2""",
    "i2c_code_examples": f"""WITH {_types(CODED)}
SELECT "table", "column", sample_code FROM types WHERE sample_code IS NOT NULL""",
    "i3_ddl": f"""WITH {_types(_table_columns(["orders", "lineitem", "customer"], key=True))}
SELECT "table", 'CREATE TABLE ' || "table" || ' (' || chr(10)
  || string_agg('    ' || "column" || ' ' || type || CASE WHEN "column" = 'id' THEN ' PRIMARY KEY' ELSE '' END,
                ',' || chr(10) ORDER BY pos)
  || chr(10) || ');' AS ddl, count(*) AS n_columns,
  CASE "table" WHEN 'orders' THEN (SELECT count(*) FROM orders) WHEN 'lineitem' THEN (SELECT count(*) FROM lineitem)
    ELSE (SELECT count(*) FROM customer) END AS n_rows
FROM types GROUP BY "table\"""",
    "i2_exact_numbers": """SELECT CAST(l_orderkey AS INTEGER) AS order_id,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS price,
  CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS cents FROM lineitem GROUP BY 1""",
    "i4_schema_misfit": """SELECT 'orders' AS "table", count(*) AS rows, 'loaded' AS status, count(*) AS n_rows FROM orders
UNION ALL SELECT 'orders', NULL, 'failed', count(*) FROM orders
UNION ALL SELECT 'nation', NULL, 'failed', NULL""",
    "i5_append_repeated_key": """SELECT 'orders' AS "table", count(*) FILTER (o_orderkey % 2 = 0) AS rows, 'loaded' AS status,
  count(*) AS n_rows FROM orders
UNION ALL SELECT 'orders', count(*) FILTER (o_orderkey % 2 = 1), 'loaded', count(*) FROM orders
UNION ALL SELECT 'orders', NULL, 'failed', count(*) FROM orders""",
    "i6_append_type_change": """SELECT 'lines' AS "table", count(*) AS rows, 'loaded' AS status, 2 * count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'lines', NULL, 'failed', 2 * count(*) FROM lineitem
UNION ALL SELECT 'lines', count(*), 'loaded', 2 * count(*) FROM lineitem""",
    "i4_full_refresh": """SELECT CAST(o_orderkey AS INTEGER) AS id, CAST(o_custkey AS INTEGER) AS o_custkey,
  o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "i5_key_violations": """SELECT 'orders' AS "table", count(*) AS n_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows
FROM (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1 OR o_orderkey IS NULL)
UNION ALL
SELECT 'lineitem', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1 OR l_orderkey IS NULL)""",
    "i6_append_reload": """SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, 2 * count(*) AS n_rows,
  2 * sum(l_quantity) AS quantity FROM lineitem GROUP BY 1""",
    "i7_load_audit": """SELECT 'orders' AS "table", count(*) AS rows, 'loaded' AS status FROM orders
UNION ALL SELECT 'customer', count(*), 'loaded' FROM customer
UNION ALL SELECT 'order_lines', count(*), 'loaded' FROM lineitem
UNION ALL SELECT 'broken', NULL, 'failed'""",
    "i7_load_summary": """SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer)
  + (SELECT count(*) FROM lineitem) AS total_rows, CAST(1 AS BIGINT) AS n_failed, 'broken' AS failed_tables""",
    "i8_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in TYPED_TABLES
    ),
    "i8_reconciliation": """SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders)
  + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events) AS total_rows""",
    "e1_order_summary": f"""WITH {ORDERS} SELECT count(*) AS n_rows, min(created_at) AS first_date,
  max(created_at) AS last_date, {_money('min(cents)')} AS min_amount, {_money('max(cents)')} AS max_amount,
  {_money('sum(cents)')} / count(*) AS mean_amount FROM o""",
    "e2_shape": f"""SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns,
  '{", ".join(COLUMNS["orders"].split())}' AS column_names FROM orders""",
    "e3_text_dates": """SELECT min(CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP)) AS first_date,
  max(CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP)) AS last_date FROM orders""",
    "e4_describe": f"""WITH {ORDERS}, u AS (SELECT cents, {_money('cents')} AS total FROM o)
SELECT count(*) AS n, {_money('sum(cents)')} / count(*) AS mean, round(stddev_samp(total), 6) AS std,
  min(total) AS min, round({_quantile('total', 0.25)}, 6) AS q25, round({_quantile('total', 0.5)}, 6) AS q50,
  round({_quantile('total', 0.75)}, 6) AS q75, max(total) AS max FROM u""",
    "e5_preview": f"""WITH {ORDERS} SELECT id, customer_id, {_money('cents')} AS total, created_at, channel, status
FROM o ORDER BY id LIMIT 5""",
    "e6_median": f"SELECT round({_quantile('o_totalprice', 0.5)}, 6) AS median FROM orders",
    "e7_iqr_outliers": f"""WITH q AS (SELECT {_quantile('value', 0.25)} AS q1, {_quantile('value', 0.75)} AS q3 FROM events),
f AS (SELECT q1 - (q3 - q1) * 1.5 AS lo, q3 + (q3 - q1) * 1.5 AS hi FROM q)
SELECT count(value) AS n, round(any_value(lo), 6) AS lower_fence, round(any_value(hi), 6) AS upper_fence,
  count(*) FILTER (value < lo) AS n_low, count(*) FILTER (value > hi) AS n_high,
  count(*) FILTER (value > hi) * 100.0 / count(value) AS pct_high,
  (count(*) FILTER (value < lo) + count(*) FILTER (value > hi)) * 100.0 / count(value) AS pct_outside
FROM events, f""",
    "e8_duplicate_keys": " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct,
  count(*) FILTER (n > 1) AS n_repeated, CAST(sum(n - 1) AS BIGINT) AS n_surplus
FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k})"""
        for t, k in [("orders", "o_orderkey"), ("lineitem", "l_orderkey, l_linenumber")]
    ),
    "e8_duplicate_rows": """SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct,
  count(*) FILTER (n > 1) AS n_repeated, CAST(sum(n - 1) AS BIGINT) AS n_surplus
FROM (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL)""",
    "e9_line_total_mismatches": f"""WITH {ORDERS},
l AS (SELECT l_orderkey AS id, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS line_cents FROM lineitem GROUP BY 1)
SELECT count(*) AS n_rows, count(*) FILTER (line_cents <> cents) AS n_different FROM o JOIN l USING (id)""",
    "e9_amount_mismatches": """WITH c AS (SELECT CAST(round(l_extendedprice * 100) AS BIGINT) AS sub,
  CAST(round(l_discount * 100) AS BIGINT) AS d FROM lineitem)
SELECT count(*) AS n_rows,
  count(*) FILTER (sub - (sub * d + 50) // 100 <> (sub * (100 - d) + 50) // 100) AS n_different FROM c""",
    "e9_text_length_mismatches": """SELECT count(*) AS n_rows,
  count(*) FILTER (length(text) <> n_chars) AS n_different FROM documents""",
    "e10_null_profile": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null,
  count(*) FILTER ({c} IS NULL) * 100.0 / count(*) AS pct_null FROM ({LABELLED})"""
        for c in ["doc_id", "lang", "source", "quality", "toxic"]
    ),
    "e11_null_by_group": f"""WITH g AS (SELECT source AS "group", count(*) AS n_rows,
  count(*) FILTER (quality IS NULL) AS n_null FROM ({LABELLED}) GROUP BY 1)
SELECT "group", n_rows, n_null, n_null * 100.0 / n_rows AS pct_null,
  n_null * 100.0 / CAST(sum(n_null) OVER () AS BIGINT) AS share_of_nulls FROM g""",
    "e12_repeated_names": """WITH r AS (SELECT p_name, count(DISTINCT p_partkey) AS n_ids FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1)
SELECT p_name AS name, p_partkey AS id, n_ids FROM part JOIN r USING (p_name)""",
    "e12_placeholder_records": """SELECT event_id, ' ' || upper(event_type) AS name FROM events
WHERE lower(trim(event_type)) IN ('error', 'asdf')""",
    "c1_customer_sales": f"""WITH {ORDERS} SELECT customer_id, {_money('sum(cents)')} AS revenue,
  count(DISTINCT id) AS frequency FROM o GROUP BY 1""",
    "c1_customer_sales_by_status": f"""WITH {ORDERS} SELECT customer_id, {_money('sum(cents)')} AS revenue,
  count(DISTINCT id) AS frequency FROM o WHERE status IN ('F', 'O') GROUP BY 1""",
    "c2_customer_diversity": f"WITH {METRICS} SELECT customer_id, diversity FROM d",
    "c3_customer_metrics": f"""WITH {METRICS} SELECT customer_id, {_money('cents')} AS revenue, frequency,
  {_rounded('cents', 'frequency')} AS ticket, diversity FROM m""",
    "c4_elite_customers": f"""WITH {METRICS} SELECT customer_id, {_money('cents')} AS revenue, frequency,
  {_rounded('cents', 'frequency')} AS ticket, diversity FROM elite""",
    "c5c_elite_category_ranking": f"""WITH {METRICS}
SELECT category_id, category, CAST(sum(quantity) AS BIGINT) AS units
FROM elite JOIN o USING (customer_id) JOIN i ON i.order_id = o.id GROUP BY 1, 2""",
    "c6_ticket_range": f"""WITH {METRICS} SELECT min({_rounded('cents', 'frequency')}) AS min_ticket,
  max({_rounded('cents', 'frequency')}) AS max_ticket FROM elite""",
    "k1_calendar": f"WITH {CALENDAR} SELECT day, isodow, weekday FROM cal",
    "k2_daily_sales": f"WITH {CALENDAR} SELECT day, {_money('cents')} AS sales FROM dsl",
    "k3_calendar_sales": f"""WITH {CALENDAR}
SELECT day, isodow, weekday, {_money('cents')} AS sales FROM cal LEFT JOIN dsl USING (day)""",
    "k3_weekday_mean": f"WITH {CALENDAR} SELECT isodow, weekday, mean_sales FROM wk",
    "k4_weekday_extremes": f"""WITH {CALENDAR}
SELECT (SELECT weekday FROM wk ORDER BY mean_sales, isodow LIMIT 1) AS worst_day,
  (SELECT min(mean_sales) FROM wk) AS worst_mean,
  (SELECT weekday FROM wk ORDER BY mean_sales DESC, isodow LIMIT 1) AS best_day,
  (SELECT max(mean_sales) FROM wk) AS best_mean""",
    "k5_naive_mean": f"WITH {CALENDAR} SELECT * FROM wk",
    "f1_product_lines": f"""WITH {ORDERS}, {ITEMS}
SELECT product_id, order_id, created_at, quantity FROM i JOIN o ON o.id = i.order_id WHERE product_id = {PRODUCT}""",
    "f2_monthly_demand": f"WITH {DEMAND} SELECT * FROM dm",
    "f2_product_monthly_demand": f"WITH {DEMAND} SELECT * FROM dm WHERE product_id = {PRODUCT}",
    "f3_filled_months": f"WITH {FILLED} SELECT * FROM fm",
    "f4_forecast": f"WITH {_forecast(3, 3)} SELECT product_id, month, predicted FROM fc",
    "f4_forecast_even_window": f"WITH {_forecast(2, 2)} SELECT product_id, month, predicted FROM fc",
    "f5_forecast_actual": f"WITH {_forecast(3, 3)} SELECT * FROM fc",
    "f6_forecast_error": f"""WITH {_forecast(3, 3)},
er AS (SELECT product_id, CAST(sum(predicted) AS BIGINT) AS sum_predicted, CAST(sum(actual) AS BIGINT) AS sum_actual,
              CAST(sum(abs(predicted - actual)) AS BIGINT) / count(*) AS mae,
              max(mean_units) AS mean_units, max(mean_before) AS mean_before FROM fc GROUP BY 1)
SELECT *, mae / mean_units * 100 AS mae_pct FROM er""",
    "f7_product_by_name": f"""WITH {ITEMS},
n AS (SELECT p_partkey AS product_id, p_name AS name, count(i.order_id) AS n
      FROM part LEFT JOIN i ON i.product_id = p_partkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY n DESC, product_id) AS place,
             count(*) OVER (PARTITION BY name) AS n_ids FROM n)
SELECT name, product_id, n AS n_records, n_ids FROM r WHERE place = 1""",
    "r1_interactions": f"WITH {INTER} SELECT customer_id, product_id FROM x",
    "r3_item_similarity": f"WITH {SIMILARITY} SELECT * FROM s",
    "r3_item_similarity_blocks": f"WITH {SIMILARITY} SELECT * FROM s",
    "r4_similar_products": f"WITH {SIMILAR_TO_ONE} SELECT product_id, co, similarity FROM t",
    "r4b_top_similar": f"""WITH {SIMILARITY},
dd AS (SELECT product_a AS product_id, product_b AS similar_id, similarity FROM s
       UNION ALL SELECT product_b, product_a, similarity FROM s),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY product_id
              ORDER BY round(similarity, 12) DESC, similar_id) AS INTEGER) AS position FROM dd)
SELECT product_id, position, similar_id, similarity FROM rk WHERE position <= 5""",
    "r5_named_similar": f"""WITH {SIMILAR_TO_ONE}
SELECT product_id, p_name AS name, CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS category_id,
  round(similarity, 4) AS similarity FROM t JOIN part ON p_partkey = product_id""",
    "r6_pair_overlap": f"""WITH {INTER},
pa AS (SELECT customer_id FROM x WHERE product_id = {PRODUCT}),
pb AS (SELECT customer_id FROM x WHERE product_id = {OTHER_PRODUCT}),
n AS (SELECT (SELECT count(*) FROM pa) AS buyers_a, (SELECT count(*) FROM pb) AS buyers_b,
             (SELECT count(*) FROM pa JOIN pb USING (customer_id)) AS "both")
SELECT *, CASE WHEN buyers_a > 0 AND buyers_b > 0 THEN "both" / (sqrt(buyers_a) * sqrt(buyers_b)) END AS similarity
FROM n""",
    "r7_matrix_density": f"""WITH {INTER},
n AS (SELECT count(DISTINCT customer_id) AS n_customers, count(DISTINCT product_id) AS n_products,
             count(*) AS n_interactions FROM x)
SELECT *, n_interactions * 100.0 / (n_customers * n_products) AS density_pct FROM n""",
    "b1_kpis": f"""WITH {ORDERS} SELECT count(*) AS n_orders, {_money('sum(cents)')} AS revenue,
  {_rounded('sum(cents)', 'count(*)')} AS mean_ticket, (SELECT count(*) FROM customer) AS n_customers FROM o""",
    "b2_revenue_by_state": f"""WITH {ORDERS}, {ADDRESSES}
SELECT state, {_money('sum(cents)')} AS revenue FROM o JOIN a USING (customer_id)
GROUP BY 1 ORDER BY sum(cents) DESC, state LIMIT 10""",
    "b2b_state_orders_customers": f"""WITH {ORDERS}, {ADDRESSES}
SELECT state, {_money('sum(cents)')} AS revenue, count(DISTINCT id) AS n_orders,
  count(DISTINCT customer_id) AS n_customers FROM o JOIN a USING (customer_id) GROUP BY 1""",
    "b2_several_addresses": f"""WITH {ORDERS}, {SUPPLIER_ADDRESSES}
SELECT state, {_money('sum(cents)')} AS revenue, count(DISTINCT id) AS n_orders,
  count(DISTINCT customer_id) AS n_customers FROM o JOIN sa USING (customer_id) GROUP BY 1""",
    "b2_primary_address_audit": f"""WITH {SUPPLIER_ADDRESSES},
n AS (SELECT c_custkey, count(state) AS n FROM customer
      LEFT JOIN (SELECT * FROM sa WHERE state < 2) p ON p.customer_id = c_custkey GROUP BY 1)
SELECT count(*) AS n_customers, count(*) FILTER (n = 0) AS without_primary,
  count(*) FILTER (n = 1) AS one_primary, count(*) FILTER (n > 1) AS several_primaries FROM n""",
    "b3_anchor_customers": f"""WITH {CUSTOMER_STATE},
r AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY cents DESC, customer_id) AS place FROM cs)
SELECT state, customer_id, legal_name, {_money('cents')} AS spent FROM r WHERE place = 1
ORDER BY cents DESC, state LIMIT 10""",
    "b3b_anchor_customers_ties": f"""WITH {CUSTOMER_STATE},
t AS (SELECT state, max(cents) AS cents FROM cs GROUP BY 1)
SELECT state, customer_id, legal_name, {_money('cs.cents')} AS spent FROM cs JOIN t USING (state)
WHERE cs.cents = t.cents""",
    "b3b_anchor_customers_ties_top": f"""WITH {CUSTOMER_STATE},
t AS (SELECT state, max(cents) AS cents FROM cs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
SELECT state, customer_id, legal_name, {_money('cs.cents')} AS spent FROM cs JOIN t USING (state)
WHERE cs.cents = t.cents""",
    "b4_top_products": f"""WITH {TOP_PRODUCTS}
SELECT product_id, name, units FROM tp ORDER BY units DESC, product_id LIMIT 10""",
    "b4b_top_products_revenue": f"""WITH {TOP_PRODUCTS}
SELECT product_id, name, units, revenue FROM tp ORDER BY units DESC, product_id LIMIT 10""",
    "b5_ranking_spread": f"""WITH {TOP_PRODUCTS},
t AS (SELECT units FROM tp ORDER BY units DESC, product_id LIMIT 10)
SELECT max(units) AS first, min(units) AS last, (max(units) - min(units)) * 100.0 / max(units) AS spread_pct FROM t""",
    "b6_multi_state_customers": f"""WITH {MULTI_STATE}
SELECT customer_id, legal_name, n_states, {_money('cents')} AS spent FROM ms ORDER BY cents DESC, customer_id LIMIT 5""",
    "b7_state_products": f"""WITH {STATE_PRODUCTS}
SELECT product_id, name, units, revenue FROM st ORDER BY units DESC, product_id LIMIT 5""",
    "b8_ticket_by_state": f"""WITH {ORDERS}, {ADDRESSES},
t AS (SELECT state, count(id) AS n_orders, {_rounded('sum(cents)', 'count(id)')} AS mean_ticket
      FROM o JOIN a USING (customer_id) GROUP BY 1)
SELECT * FROM t ORDER BY mean_ticket DESC, state LIMIT 10""",
    "b8_ticket_by_state_all": f"""WITH {ORDERS}, {ADDRESSES}
SELECT state, count(id) AS n_orders, {_rounded('sum(cents)', 'count(id)')} AS mean_ticket
FROM o JOIN a USING (customer_id) GROUP BY 1""",
    "b9_common_products_top": f"""WITH {STATE_PRODUCTS}
SELECT product_id FROM (SELECT product_id FROM tp ORDER BY units DESC, product_id LIMIT 10)
INTERSECT SELECT product_id FROM (SELECT product_id FROM st ORDER BY units DESC, product_id LIMIT 5)""",
    "b9_common_products": f"""WITH {STATE_PRODUCTS}
SELECT product_id FROM (SELECT product_id FROM tp ORDER BY units DESC, product_id LIMIT 200)
INTERSECT SELECT product_id FROM (SELECT product_id FROM st ORDER BY units DESC, product_id LIMIT 200)""",
    "b10_leads_overall": f"""WITH {MULTI_STATE},
t AS (SELECT (SELECT customer_id FROM ms ORDER BY cents DESC, customer_id LIMIT 1) AS multi_state_customer,
             (SELECT customer_id FROM sp ORDER BY cents DESC, customer_id LIMIT 1) AS top_customer)
SELECT *, multi_state_customer = top_customer AS same FROM t""",
    "b11_kpi_texts": f"""WITH {ORDERS},
t AS (SELECT count(*) AS n, sum(cents) AS cents, (2 * sum(cents) + count(*)) // (2 * count(*)) AS mean FROM o)
SELECT 'R$ ' || replace(replace(replace(format('{{:,.1f}}', cents / 100 / 1e6), ',', 'X'), '.', ','), 'X', '.')
    || ' mi' AS revenue_millions,
  {_brl('cents')} AS revenue, {_thousands('n')} AS orders, {_brl('mean')} AS mean_ticket,
  {_thousands('(SELECT count(*) FROM customer)')} AS customers FROM t""",
    "b11_month_labels": f"""WITH {ORDERS},
t AS (SELECT strftime(day, '%Y-%m') AS month, sum(cents) AS cents FROM o GROUP BY 1)
SELECT month, {_brl('cents')} AS revenue FROM t""",
}
SQL["c5_elite_top_category"] = (
    SQL["c5c_elite_category_ranking"] + " ORDER BY sum(quantity) DESC, category_id LIMIT 1"
)
SQL["r4b_top_similar_from_pairs"] = SQL["r4b_top_similar"]
SQL |= table_queries.SQL | stream_queries.SQL | order_queries.SQL | cube_queries.SQL | nested_queries.SQL
