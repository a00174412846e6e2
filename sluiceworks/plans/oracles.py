"""For each query the same result as ANSI SQL over the plain tables, written without the gate."""

from __future__ import annotations

_DIRTY = r"""
base AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS orderKey,
    CASE WHEN o_orderkey % 101 = 0 THEN '\N' WHEN o_orderkey % 103 = 0 THEN '999999999'
         ELSE CAST(o_custkey AS VARCHAR) END AS custKey,
    CASE WHEN o_orderkey % 107 = 0 THEN 'n/a' WHEN o_orderkey % 109 = 0 THEN '-1'
         ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS totalPrice,
    strftime(o_orderdate, '%Y-%m-%d') AS orderDate,
    CASE WHEN o_orderkey % 89 = 0 THEN '\N' ELSE o_orderpriority END AS orderPriority
  FROM orders),
dirty AS (
  SELECT * FROM base
  UNION ALL SELECT * FROM base WHERE CAST(orderKey AS BIGINT) % 113 = 0
  UNION ALL SELECT orderKey, custKey, totalPrice, orderDate, 'X-CONFLICT' FROM base
            WHERE CAST(orderKey AS BIGINT) % 127 = 0)"""

_STAGED = (
    _DIRTY
    + r""",
o_typed AS (
  SELECT nullif(orderKey, '\N') AS r_key, nullif(custKey, '\N') AS r_cust,
    nullif(totalPrice, '\N') AS r_total, nullif(orderDate, '\N') AS r_date,
    nullif(orderPriority, '\N') AS order_priority,
    try_cast(orderKey AS BIGINT) AS order_key, try_cast(custKey AS BIGINT) AS cust_key,
    try_cast(totalPrice AS BIGINT) AS total_price, try_cast(orderDate AS DATE) AS order_date
  FROM dirty),
o_ranked AS (
  SELECT *, count(*) OVER (PARTITION BY order_key) AS copies,
    row_number() OVER (PARTITION BY order_key ORDER BY order_priority) AS nth
  FROM o_typed),
o_variants AS (
  SELECT order_key, count(*) AS variants FROM (
    SELECT DISTINCT order_key, cust_key, total_price, order_date, order_priority FROM o_typed) AS d
  GROUP BY order_key),
o_staged AS (
  SELECT o_ranked.*, v.variants, concat_ws(',',
    CASE WHEN r_cust IS NOT NULL AND cust_key IS NULL THEN 'bad_cust_key' END,
    CASE WHEN r_cust IS NULL THEN 'missing_cust_key' END,
    CASE WHEN r_total IS NOT NULL AND total_price IS NULL THEN 'bad_total_price' END,
    CASE WHEN r_total IS NULL THEN 'missing_total_price' END,
    CASE WHEN NOT (total_price >= 0) THEN 'invalid_total_ge_0' END,
    CASE WHEN cust_key IS NOT NULL AND c_custkey IS NULL THEN 'orphan_cust_key' END,
    CASE WHEN copies > 1 AND variants = 1 AND nth > 1 THEN 'exact_duplicate' END,
    CASE WHEN copies > 1 AND variants > 1 THEN 'key_conflict' END) AS _reasons
  FROM o_ranked JOIN o_variants AS v ON v.order_key = o_ranked.order_key
  LEFT JOIN customer ON cust_key = c_custkey),
trusted_orders AS (
  SELECT order_key, cust_key, total_price, order_date, order_priority
  FROM o_staged WHERE _reasons = '')"""
)

_LINES = (
    _STAGED
    + """,
l_keys AS (
  SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS copies FROM lineitem GROUP BY 1, 2),
l_staged AS (
  SELECT lineitem.*, concat_ws(',',
    CASE WHEN t.order_key IS NULL THEN 'orphan_l_orderkey' END,
    CASE WHEN copies > 1 THEN 'key_conflict' END) AS _reasons,
    CASE WHEN copies > 1 THEN 'key_conflict' ELSE '' END AS own_reasons
  FROM lineitem JOIN l_keys ON l_orderkey = k AND l_linenumber = n
  LEFT JOIN trusted_orders AS t ON l_orderkey = t.order_key),
trusted_lines AS (SELECT * FROM l_staged WHERE _reasons = '')"""
)

_CUSTOMER_YEAR = (
    _STAGED
    + """,
customer_year AS (
  SELECT CAST(year(order_date) AS INTEGER) AS year, cust_key, c_name AS customer,
    c_mktsegment AS segment, count(*) AS orders,
    count(CASE WHEN order_priority = '1-URGENT' THEN 1 END) AS urgent,
    count(CASE WHEN order_priority <= '2-HIGH' THEN 1 END) AS urgent_or_high,
    CAST(sum(total_price) AS DOUBLE) AS spend,
    count(CASE WHEN order_priority IS NULL THEN 1 END) AS unprioritised,
    min(total_price) AS smallest
  FROM trusted_orders JOIN customer ON cust_key = c_custkey
  GROUP BY 1, 2, 3, 4)"""
)

_SEGMENT_YEAR = """,
segment_year AS (
  SELECT CAST(year(order_date) AS INTEGER) AS year, c_mktsegment AS segment, count(*) AS orders,
    count(CASE WHEN order_priority = '1-URGENT' THEN 1 END) AS urgent,
    CAST(sum(total_price) AS DOUBLE) AS spend, min(total_price) AS smallest
  FROM trusted_orders JOIN customer ON cust_key = c_custkey GROUP BY 1, 2)"""

_NATION_HISTORY = """,
nation_history AS (
  SELECT n_nationkey, n_name AS nation, count(*) AS orders,
    CAST(min(year(order_date)) AS INTEGER) AS first_year,
    CAST(max(year(order_date)) AS INTEGER) AS last_year,
    count(DISTINCT CASE WHEN order_priority = '1-URGENT' THEN cust_key END) AS urgent_customers
  FROM trusted_orders JOIN customer ON cust_key = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2)"""

_BRAND_YEAR = """,
brand_year AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, p_brand AS brand, count(*) AS lines,
    count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned,
    CAST(round(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 1) AS DOUBLE) AS revenue,
    CAST(min(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS least_quantity
  FROM trusted_lines JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""

# A double is rounded through its shortest decimal text, half away from zero.
_EVOLUTION = """
gaps AS (
  SELECT CAST(ts AS DATE) AS day, event_type,
    CASE WHEN event_id % 50 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS v FROM events),
event_evolution AS (
  SELECT day, event_type, count(*) AS events,
    CAST(round(CAST(CAST(CAST(sum(v) AS DOUBLE) / count(v) AS VARCHAR) AS DECIMAL(38,20)), 3) AS DOUBLE)
      AS avg_value,
    round(median(CAST(v AS DOUBLE)), 3) AS median_value,
    CAST(min(v) AS DOUBLE) AS least_value
  FROM gaps GROUP BY 1, 2)"""

_TABLES = (
    "region nation customer supplier part events documents labels conversations pages benchmark embeddings"
).split()

_LINE_TEXT = """CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey,
  CAST(l_quantity AS VARCHAR) AS l_quantity,
  CAST(l_extendedprice AS VARCHAR) AS l_extendedprice"""

# Table, columns in the contract, SQL for its trusted and its quarantined rows.
_GATED = [
    ("orders", 5, "FROM trusted_orders", "FROM o_staged WHERE _reasons <> ''"),
    ("lineitem", 11, "FROM trusted_lines", "FROM l_staged WHERE _reasons <> ''"),
    *(
        (t, n, f"FROM {t}", f"FROM {t} WHERE false")
        for t, n in zip(_TABLES, (2, 3, 5, 4, 6, 6, 5, 3, 4, 3, 2, 2), strict=True)
    ),
]
_MARTS = (
    ("customer_year_summary", 10, "customer_year"), ("segment_year_summary", 6, "segment_year"), ("brand_year_summary", 6, "brand_year"),
    ("nation_history", 6, "nation_history"), ("event_value_evolution", 6, "event_evolution"),
)
# Dirty orders and all marts, as one list of common table expressions.
_ALL = f"WITH {_LINES}{_CUSTOMER_YEAR[len(_STAGED):]}{_SEGMENT_YEAR}{_NATION_HISTORY}{_BRAND_YEAR},{_EVOLUTION} "


def _each_table(line):
    """``line(table, columns, rows)`` for every table of the graph: columns, and the FROM that counts its rows."""
    for t, n, trusted, rejected in _GATED:
        yield line(f"raw_{t}", n + 2, {"orders": "FROM dirty"}.get(t, f"FROM {t}"))
        yield line(t, n, trusted)
        yield line(f"quarantine_{t}", 4, rejected)
    for t, n, mart in _MARTS:
        yield line(t, n, f"FROM {mart}")


_ORDER_LINE = """concat_ws(',', o_orderkey, o_custkey, CAST(floor(o_totalprice) AS BIGINT),
  strftime(o_orderdate, '%Y-%m-%d'), o_orderpriority)"""

ORACLES: dict[str, str] = {
    "raw_provenance": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment,
  'customer.parquet' AS _source_file FROM customer""",
    "csv_scan": f"WITH {_DIRTY} SELECT * FROM dirty",
    "malformed_lines": f"""
SELECT CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE {_ORDER_LINE} || ',more' END AS line
FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 83 = 0""",
    "malformed_accounting": """
WITH n AS (SELECT count(*) AS n, count(CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 83 = 0 THEN 1 END) AS bad FROM orders)
SELECT 'orders' AS dataset, n AS bronze, n - bad AS silver, bad AS quarantine, true AS closes, bad AS malformed_lines FROM n""",
    "manifest_verdict": "WITH found AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, count(*) + {int(t == 'events')} AS n, {int(t == 'events')} AS leaks FROM {t}"
        for t in (*_TABLES, "orders", "lineitem")
    )
    + """)
SELECT dataset, n AS expected_rows, n AS actual_rows, CAST(leaks AS BIGINT) AS header_leaks, CAST(0 AS BIGINT) AS malformed_lines,
  true AS rows_ok, leaks = 0 AS header_ok, true AS lines_ok FROM found
UNION ALL SELECT 'deliveries', count(*), 0, 0, 0, count(*) = 0, true, true FROM orders""",
    "landing_presence": "".join(
        f"SELECT '{t}' AS dataset, 'present' AS status, count(*) AS rows FROM {t} UNION ALL "
        for t in "region nation customer supplier part orders lineitem events".split()
    )
    + "".join(
        f"SELECT '{t}', 'extra', count(*) FROM {t} UNION ALL "
        for t in "documents embeddings pages benchmark labels conversations".split()
    )
    + "SELECT 'deliveries', 'missing', 0",
    "snapshot_overwrite": """
SELECT 'customer' AS table_name, count(*) AS rows,
  CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance FROM customer""",
    "atomic_overwrite": """
WITH c AS (SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS s FROM customer),
p AS (SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS s FROM customer WHERE c_acctbal >= 0),
e AS (SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS s FROM customer WHERE c_custkey % 2 = 0)
SELECT '1 written' AS step, n AS rows, s AS keys, CAST(5 AS INTEGER) AS columns, CAST(1 AS BIGINT) AS versions FROM c
UNION ALL SELECT '2 died on a row', n, s, 5, 1 FROM c
UNION ALL SELECT '3 missed an expectation', n, s, 5, 1 FROM c
UNION ALL SELECT '4 replaced, another overtaken', n, s, 5, 1 FROM p
UNION ALL SELECT '5 died before the catalog', n, s, 1, 2 FROM c
UNION ALL SELECT '6 replaced by a part of itself', n, s, 1, 1 FROM e""",
    "dataset_graph": _ALL
    + " UNION ALL ".join(_each_table(lambda t, n, rows: f"SELECT '{t}' AS table_name, count(*) AS rows {rows}")),
    "expectation_rates": _ALL
    + " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, 'quality_gate' AS expectation, 'drop' AS action, (SELECT count(*) {trusted}) AS passed, "
        f"(SELECT count(*) {rejected}) AS failed"
        for t, _, trusted, rejected in _GATED
    )
    + "".join(
        f" UNION ALL SELECT '{t}', '{name}', '{action}', count(CASE WHEN {met} THEN 1 END), count(CASE WHEN NOT ({met}) THEN 1 END) FROM {mart}"
        for t, mart, name, met, action in (
            ("customer_year_summary", "customer_year", "has_orders", "orders > 0", "fail"),
            ("customer_year_summary", "customer_year", "spends", "spend > 0", "warn"),
            ("segment_year_summary", "segment_year", "has_orders", "orders > 0", "fail"),
            ("brand_year_summary", "brand_year", "has_brand", "brand IS NOT NULL", "drop"),
        )
    ),
    "incremental_gate": f"""WITH {_STAGED}
SELECT r_key AS "orderKey", r_cust AS "custKey", r_total AS "totalPrice", r_date AS "orderDate",
  order_priority AS "orderPriority", _reasons FROM o_staged""",
    "split_store": f"""WITH {_STAGED}
SELECT CASE WHEN _reasons = '' THEN 'trusted' ELSE 'quarantine' END AS verdict, count(*) AS rows,
  count(CASE WHEN _reasons = '' THEN order_key END) AS typed_keys,
  count(CASE WHEN _reasons <> '' THEN 1 END) AS originals
FROM o_staged GROUP BY 1""",
    "schema_profile": f"""WITH {_STAGED}
SELECT CAST(1 AS INTEGER) AS position, 'order_key' AS column_name, 'bigint' AS type, count(order_key) AS filled
  FROM trusted_orders
UNION ALL SELECT 2, 'cust_key', 'bigint', count(cust_key) FROM trusted_orders
UNION ALL SELECT 3, 'total_price', 'bigint', count(total_price) FROM trusted_orders
UNION ALL SELECT 4, 'order_date', 'date', count(order_date) FROM trusted_orders
UNION ALL SELECT 5, 'order_priority', 'string', count(order_priority) FROM trusted_orders""",
    "preview_orders": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 5""",
    "conform_names": """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, CAST(floor(o_totalprice) AS BIGINT) AS total_price,
  CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS order_priority FROM orders""",
    "gate_clean_orders": f"WITH {_STAGED} SELECT * FROM trusted_orders",
    "gate_rejected_orders": f"""WITH {_STAGED}
SELECT r_key AS "orderKey", r_cust AS "custKey", r_total AS "totalPrice", r_date AS "orderDate",
  order_priority AS "orderPriority", 'orders.parquet' AS _source_file, _reasons
FROM o_staged WHERE _reasons <> ''""",
    "gate_lineitem_conflicts": f"""WITH {_LINES}
SELECT {_LINE_TEXT}, own_reasons AS _reasons FROM l_staged WHERE own_reasons <> ''""",
    "duplicate_verdicts": f"""WITH {_STAGED}
SELECT order_key, count(*) AS copies, min(variants) = 1 AS alike FROM o_staged
WHERE copies > 1 GROUP BY order_key""",
    "gate_cascade_lineitem": f"""WITH {_LINES}
SELECT {_LINE_TEXT}, _reasons FROM l_staged WHERE _reasons LIKE '%orphan_l_orderkey%'""",
    "reason_breakdown": f"""WITH {_LINES}
SELECT 'orders' AS dataset, reason, count(*) AS rows
FROM (SELECT unnest(string_split(_reasons, ',')) AS reason FROM o_staged WHERE _reasons <> '') AS o
GROUP BY reason
UNION ALL
SELECT 'lineitem', reason, count(*)
FROM (SELECT unnest(string_split(_reasons, ',')) AS reason FROM l_staged WHERE _reasons <> '') AS l
GROUP BY reason""",
    "row_accounting": f"""WITH {_LINES}
SELECT 'orders' AS dataset, count(*) AS bronze, count(CASE WHEN _reasons = '' THEN 1 END) AS silver,
  count(CASE WHEN _reasons <> '' THEN 1 END) AS quarantine, true AS closes,
  count(CASE WHEN _reasons <> '' THEN 1 END) AS predicted, true AS as_predicted FROM o_staged
UNION ALL
SELECT 'lineitem', count(*), count(CASE WHEN _reasons = '' THEN 1 END),
  count(CASE WHEN _reasons <> '' THEN 1 END), true, count(CASE WHEN _reasons <> '' THEN 1 END), true
FROM l_staged"""
    + "".join(
        f"\nUNION ALL SELECT '{t}', count(*), count(*), 0, true, 0, true FROM {t}" for t in _TABLES
    ),
    "expectation_metrics": f"""WITH {_STAGED}
SELECT 'orders' AS dataset, 'quality_gate' AS expectation, count(CASE WHEN _reasons = '' THEN 1 END) AS passed,
  count(CASE WHEN _reasons <> '' THEN 1 END) AS failed FROM o_staged
UNION ALL SELECT 'orders', 'has_customer', count(cust_key), count(*) - count(cust_key) FROM o_staged
UNION ALL SELECT 'orders', 'has_priority', count(order_priority), count(*) - count(order_priority)
FROM o_staged""",
    "expectation_gate": f"WITH {_STAGED} SELECT *, '' AS _reasons FROM trusted_orders",
    "key_uniqueness": f"""WITH {_LINES}
SELECT 'raw orders' AS dataset, count(*) AS rows, count(DISTINCT order_key) AS distinct_keys,
  count(*) = count(DISTINCT order_key) AS is_unique FROM o_staged
UNION ALL SELECT 'trusted orders', count(*), count(DISTINCT order_key), true FROM trusted_orders
UNION ALL SELECT 'raw lineitem', CAST(sum(copies) AS BIGINT), count(*), sum(copies) = count(*) FROM l_keys
UNION ALL SELECT 'trusted lineitem', count(*), count(DISTINCT (l_orderkey, l_linenumber)), true
FROM trusted_lines""",
    "future_rows": f"""WITH {_STAGED}
SELECT order_key, order_date, total_price FROM trusted_orders WHERE order_date > DATE '2001-01-01'""",
    "scheduled_verdict": f"""WITH {_STAGED}
SELECT 'scheduled orders' AS check_name, CAST(count(*) AS DOUBLE) AS expected, CAST(0 AS DOUBLE) AS tolerance,
  CAST(count(*) AS DOUBLE) AS actual, true AS ok
FROM trusted_orders WHERE order_date > DATE '2001-01-01'""",
    "lossless_join_check": f"""WITH {_LINES}
SELECT 'orders-customer' AS join_name, count(*) AS fact_rows, count(*) AS joined_rows,
  CAST(0 AS BIGINT) AS lost_rows, CAST(0 AS BIGINT) AS added_rows, true AS lossless FROM trusted_orders
UNION ALL SELECT 'customer-nation', count(*), count(*), 0, 0, true FROM customer
UNION ALL SELECT 'lineitem-part', count(*), count(*), 0, 0, true FROM trusted_lines
UNION ALL SELECT 'raw lineitem-orders', count(*), count(t.order_key), count(*) - count(t.order_key), 0,
  count(*) = count(t.order_key)
FROM lineitem LEFT JOIN trusted_orders AS t ON l_orderkey = t.order_key""",
    "reproducible_build": _ALL
    + " UNION ALL ".join(
        f"SELECT '{layer} {t}' AS dataset, count(*) AS rows, count(*) AS rows_again, true AS identical, CAST(0 AS BIGINT) AS buckets_apart {rows}"
        for t, _, trusted, rejected in _GATED
        for layer, rows in (("trusted", trusted), ("quarantine", rejected))
    )
    + "".join(f" UNION ALL SELECT 'mart {mart}', count(*), count(*), true, 0 FROM {mart}" for _, _, mart in _MARTS),
    "located_change": f"""WITH {_LINES},
b AS (SELECT min(l_orderkey) AS a, max(l_orderkey) AS z FROM trusted_lines)
SELECT l_orderkey, l_linenumber, l_tax, CAST(1 AS BIGINT) AS copies, CAST(0 AS BIGINT) AS copies_again
FROM trusted_lines, b WHERE l_orderkey = a OR l_orderkey = z
UNION ALL SELECT l_orderkey, l_linenumber, l_tax + 1, 0, 1 FROM trusted_lines, b WHERE l_orderkey = z
UNION ALL SELECT l_orderkey, l_linenumber, l_tax, 1, 2 FROM trusted_lines, b WHERE l_orderkey = z - 1""",
    "running_totals": """
WITH l AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(28,10))) AS s FROM lineitem GROUP BY 1),
j AS (
  SELECT coalesce(o_orderkey, l_orderkey) AS order_key, o_custkey AS cust_key, o_orderdate,
    coalesce(CAST(o_totalprice AS DECIMAL(28,10)), 0) AS p, coalesce(s, 0) AS s
  FROM l FULL JOIN orders ON l_orderkey = o_orderkey),
r AS (
  SELECT order_key, cust_key, sum(p) OVER w AS p, sum(s) OVER w AS s FROM j
  WINDOW w AS (PARTITION BY cust_key ORDER BY o_orderdate, order_key ROWS UNBOUNDED PRECEDING))
SELECT order_key, cust_key, CAST(round(p, 2) AS DOUBLE) AS reported, CAST(round(s, 2) AS DOUBLE) AS summed,
  abs(p - s) < 0.005 AS agrees FROM r""",
    "event_extremes": """
WITH e AS (
  SELECT CAST(ts AS DATE) AS day, event_type,
    CASE WHEN event_id % 307 = 0 THEN 'nan'::DOUBLE WHEN event_id % 211 = 0 THEN 'inf'::DOUBLE
         WHEN event_id % 401 = 0 THEN '-inf'::DOUBLE WHEN event_id % 101 = 0 THEN 1e19 ELSE value END AS v FROM events),
g AS (
  SELECT day, event_type, count(*) AS events, count(v) AS n, count(CASE WHEN isnan(v) THEN 1 END) AS nans,
    count(CASE WHEN v = 'inf'::DOUBLE THEN 1 END) AS above, count(CASE WHEN v = '-inf'::DOUBLE THEN 1 END) AS below,
    coalesce(CAST(sum(CASE WHEN abs(v) < 1e15 THEN CAST(v AS DECIMAL(18,2)) END) AS DOUBLE), 0)
      + coalesce(sum(CASE WHEN abs(v) >= 1e15 AND isfinite(v) THEN v END), 0) AS s, median(v) AS m, min(v) AS least_value
  FROM e GROUP BY 1, 2)
SELECT day, event_type, events,
  CASE WHEN nans > 0 OR (above > 0 AND below > 0) THEN 'nan'::DOUBLE WHEN above > 0 THEN 'inf'::DOUBLE
       WHEN below > 0 THEN '-inf'::DOUBLE WHEN abs(s / n) > 1e12 THEN s / n
       ELSE CAST(round(CAST(CAST(s / n AS VARCHAR) AS DECIMAL(38,20)), 3) AS DOUBLE) END AS avg_value,
  round(m, 3) AS median_value, least_value FROM g""",
    "reported_vs_summed": """
SELECT coalesce(o_orderkey, l_orderkey) AS order_key, CAST(r AS DOUBLE) AS reported,
  CAST(s AS DOUBLE) AS summed, coalesce(r = s, false) AS agrees
FROM (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS s FROM lineitem GROUP BY 1) AS l
FULL JOIN (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS r FROM orders) AS o
  ON l_orderkey = o_orderkey""",
    "enriched_orders": f"""WITH {_STAGED}
SELECT order_key, CAST(year(order_date) AS INTEGER) AS year, order_date, cust_key, c_name AS customer,
  c_mktsegment AS segment, n_name AS nation, r_name AS region, total_price, order_priority
FROM trusted_orders JOIN customer ON cust_key = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "customer_year_summary": f"WITH {_CUSTOMER_YEAR} SELECT * FROM customer_year",
    "segment_year_summary": f"WITH {_STAGED}{_SEGMENT_YEAR} SELECT * FROM segment_year",
    "brand_year_summary": f"WITH {_LINES}{_BRAND_YEAR} SELECT * FROM brand_year",
    "event_value_evolution": f"WITH {_EVOLUTION} SELECT * FROM event_evolution",
    "nation_history": f"WITH {_STAGED}{_NATION_HISTORY} SELECT * FROM nation_history",
    "lines_by_order_year": f"""WITH {_LINES}, d AS (
  SELECT year(order_date) AS y, date_diff('day', order_date, CAST(l_shipdate AS DATE)) AS days
  FROM trusted_lines JOIN trusted_orders ON l_orderkey = order_key)
SELECT CAST(y AS INTEGER) AS year, count(*) AS lines, CAST(sum(days) AS BIGINT) AS days_to_ship, min(days) AS fewest_days,
  max(days) AS most_days FROM d GROUP BY 1""",
    "mart_reconciliation": f"""WITH {_LINES}, {_EVOLUTION},
t AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(total_price) AS DOUBLE) AS s,
    CAST(count(CASE WHEN order_priority = '1-URGENT' THEN 1 END) AS DOUBLE) AS u FROM trusted_orders),
i AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS DOUBLE) AS r,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(28,10))) AS DOUBLE) AS s FROM trusted_lines),
{_BRAND_YEAR.strip().lstrip(',')},
b AS (SELECT CAST(sum(CAST(revenue AS DECIMAL(28,1))) AS DOUBLE) AS s FROM brand_year),
e AS (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(min(v) AS DOUBLE) AS least FROM gaps)
SELECT 'orders by customer' AS check_name, n AS expected, CAST(0 AS DOUBLE) AS tolerance, n AS actual,
  true AS ok FROM t
UNION ALL SELECT 'orders by nation', n, 0, n, true FROM t
UNION ALL SELECT 'orders by segment', n, 0, n, true FROM t
UNION ALL SELECT 'urgent by customer', u, 0, u, true FROM t
UNION ALL SELECT 'urgent by segment', u, 0, u, true FROM t
UNION ALL SELECT 'spend by customer', s, 0.5, s, true FROM t
UNION ALL SELECT 'spend by segment', s, 0.5, s, true FROM t
UNION ALL SELECT 'lines by brand', n, 0, n, true FROM i
UNION ALL SELECT 'returned by brand', r, 0, r, true FROM i
UNION ALL SELECT 'revenue by brand', i.s, 20, b.s, abs(i.s - b.s) <= 20 FROM i, b
UNION ALL SELECT 'events by day', n, 0, n, true FROM e
UNION ALL SELECT 'least value by day', least, 0, least, true FROM e""",
    "triangle_check": f"""WITH {_STAGED},
t AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(total_price) AS DOUBLE) AS s,
    CAST(count(CASE WHEN order_priority = '1-URGENT' THEN 1 END) AS DOUBLE) AS u FROM trusted_orders)
SELECT 'orders' AS check_name, n AS expected, CAST(0 AS DOUBLE) AS tolerance, n AS actual, true AS ok FROM t
UNION ALL SELECT 'urgent', u, 0, u, true FROM t
UNION ALL SELECT 'spend', s, 0.5, s, true FROM t""",
    "mart_audit": f"WITH {_LINES}{_CUSTOMER_YEAR[len(_STAGED):]}{_SEGMENT_YEAR}{_NATION_HISTORY}{_BRAND_YEAR},{_EVOLUTION} "
    + " UNION ALL ".join(
        f"SELECT '{mart}' AS mart, count(*) AS rows, count(*) AS rows_expected, CAST(sum({column}) AS BIGINT) AS key_sum, "
        f"(SELECT count(*) FROM {facts}) AS key_sum_expected, sum({column}) = (SELECT count(*) FROM {facts}) AS ok FROM {mart}"
        for mart, column, facts in (
            ("customer_year", "orders", "trusted_orders"),
            ("segment_year", "orders", "trusted_orders"),
            ("nation_history", "orders", "trusted_orders"),
            ("brand_year", "lines", "trusted_lines"),
            ("event_evolution", "events", "events"),
        )
    ),
    "leaders_of_segments": f"""WITH {_CUSTOMER_YEAR},
ever AS (
  SELECT cust_key FROM customer_year GROUP BY cust_key ORDER BY sum(orders) DESC, cust_key LIMIT 3)
SELECT year, cust_key, orders FROM customer_year JOIN ever USING (cust_key)""",
    "urgent_chart": f"""WITH {_CUSTOMER_YEAR}
SELECT customer, CAST(sum(urgent) AS BIGINT) AS urgent FROM customer_year GROUP BY cust_key, customer
ORDER BY urgent DESC, cust_key LIMIT 10""",
    "named_series": f"""WITH {_STAGED}{_SEGMENT_YEAR}
SELECT year, segment, spend FROM segment_year WHERE segment IN ('BUILDING', 'MACHINERY', 'FURNITURE')""",
    "lowest_day": f"""WITH {_EVOLUTION}
SELECT day, median_value FROM event_evolution WHERE event_type = 'purchase'
ORDER BY median_value, day LIMIT 1""",
    "row_trace": f"""WITH {_CUSTOMER_YEAR},
one AS (SELECT * FROM trusted_orders WHERE order_key = 7)
SELECT '1 raw' AS layer, "custKey" AS customer, "totalPrice" AS amount, "orderDate" AS period
FROM dirty WHERE "orderKey" = '7'
UNION ALL SELECT '2 trusted', CAST(cust_key AS VARCHAR), CAST(total_price AS VARCHAR),
  CAST(order_date AS VARCHAR) FROM one
UNION ALL SELECT '3 mart', CAST(m.cust_key AS VARCHAR), CAST(CAST(spend AS BIGINT) AS VARCHAR),
  CAST(m.year AS VARCHAR)
FROM customer_year AS m JOIN one ON m.cust_key = one.cust_key AND m.year = year(one.order_date)""",
    "key_trace": f"""WITH {_CUSTOMER_YEAR},
hit AS (SELECT * FROM o_staged WHERE order_key % 113 = 0 OR order_key % 127 = 0)
SELECT CAST(orderKey AS BIGINT) AS order_key, '1 raw' AS layer, 'orders.parquet' AS place,
  concat_ws(',', orderKey, custKey, totalPrice, orderDate, orderPriority) AS detail
FROM dirty WHERE CAST(orderKey AS BIGINT) % 113 = 0 OR CAST(orderKey AS BIGINT) % 127 = 0
UNION ALL SELECT order_key, '2 trusted', '', concat_ws(',', order_key, cust_key, total_price, order_date, order_priority)
FROM hit WHERE _reasons = ''
UNION ALL SELECT order_key, '2 quarantine', _reasons, concat_ws(',', r_key, r_cust, r_total, r_date, order_priority)
FROM hit WHERE _reasons <> ''
UNION ALL SELECT order_key, '3 mart', 'customer_year', concat_ws(',', m.year, m.cust_key, m.orders, m.urgent)
FROM hit JOIN customer_year AS m ON m.cust_key = hit.cust_key AND m.year = year(hit.order_date) WHERE _reasons = ''""",
    "file_ledger_check": f"""WITH {_DIRTY},
k AS (SELECT *, CAST(orderKey AS BIGINT) AS k FROM dirty),
z AS (SELECT max(k) - (max(k) + 1) % 4 AS z FROM k)
SELECT 'orders' AS dataset, k % 4 AS remainder, count(*) AS rows, count(CASE WHEN k <> z THEN 1 END) AS rows_now,
  CAST(0 AS BIGINT) AS header_leaks, CAST(0 AS BIGINT) AS malformed_lines,
  CASE WHEN k % 4 IN (2, 3) THEN 'changed' ELSE 'unchanged' END AS state
FROM k, z GROUP BY k % 4""",
    "conflict_evidence": f"""WITH {_DIRTY}
SELECT * FROM dirty WHERE "orderKey" IN ('127', '254')""",
    "scalar_functions": """
SELECT event_id,
  concat_ws(' ', event_type, CASE WHEN user_id % 2 = 0 THEN 'even' END) AS label,
  round(CAST(event_id AS DOUBLE) / 1000, 3) AS thousandth,
  CASE WHEN value < 5 THEN 'low' WHEN value BETWEEN 5 AND 20 THEN 'mid' ELSE 'high' END AS band,
  CASE WHEN event_type = 'click' THEN 1 END AS only_click,
  event_type IN ('click', 'error') AS in_set,
  CAST(ts AS DATE) >= DATE '2024-01-15' AS second_half,
  try_cast(event_type AS INTEGER) IS NULL AS not_a_number,
  concat_ws(',', CASE WHEN value < 5 THEN 'low' END, CASE WHEN event_type = 'error' THEN 'error' END)
    AS reasons,
  CAST(CASE WHEN value < 5 THEN 1 ELSE 0 END + CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER)
    AS n_reasons
FROM events""",
    "range_filter": """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
WHERE l_returnflag = 'R' AND l_linenumber IN (1, 2) AND l_discount BETWEEN 0.02 AND 0.05
  AND (l_tax IS NULL OR l_tax >= 0.01) AND l_shipdate IS NOT NULL""",
    "distinct_customers": """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers, count(*) AS orders,
  max(o_orderkey) AS last_key FROM orders GROUP BY 1""",
    "spend_again": f"""WITH {_CUSTOMER_YEAR}
SELECT cust_key, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(CAST(spend AS DECIMAL(28,1))) AS DOUBLE) AS spend,
  CAST(sum(unprioritised) AS BIGINT) AS unprioritised
FROM customer_year GROUP BY 1 ORDER BY spend DESC, cust_key LIMIT 20""",
    "kpi_row": f"""WITH {_CUSTOMER_YEAR}{_NATION_HISTORY}, {_EVOLUTION}
SELECT (SELECT count(DISTINCT year) FROM customer_year) AS years_covered,
  (SELECT CAST(sum(orders) AS BIGINT) FROM nation_history) AS orders_placed,
  (SELECT count(DISTINCT cust_key) FROM customer_year) AS customers_ever,
  (SELECT CAST(sum(urgent) AS BIGINT) FROM customer_year) AS urgent_orders,
  (SELECT CAST(sum(events) AS BIGINT) FROM event_evolution) AS events_recorded""",
    "top_customers_by_year": f"""WITH {_CUSTOMER_YEAR},
ever AS (
  SELECT cust_key FROM customer_year GROUP BY cust_key
  ORDER BY sum(CAST(spend AS DECIMAL(28,1))) DESC, cust_key LIMIT 5)
SELECT year, cust_key, customer, spend, urgent FROM customer_year JOIN ever USING (cust_key)
ORDER BY year, customer, cust_key""",
    "top_brands_by_year": f"""WITH {_LINES}{_BRAND_YEAR},
ever AS (
  SELECT brand FROM brand_year GROUP BY brand
  ORDER BY sum(CAST(revenue AS DECIMAL(28,1))) DESC, brand LIMIT 5)
SELECT year, brand, revenue, lines FROM brand_year JOIN ever USING (brand) ORDER BY year, brand""",
    "evolution_series": f"WITH {_EVOLUTION} SELECT * FROM event_evolution ORDER BY day, event_type",
    "leaderboard": f"""WITH {_CUSTOMER_YEAR}
SELECT customer, CAST(sum(urgent) AS BIGINT) AS urgent, CAST(sum(urgent_or_high) AS BIGINT) AS urgent_or_high,
  CAST(round(sum(CAST(spend AS DECIMAL(28,1))), 1) AS DOUBLE) AS spend
FROM customer_year GROUP BY customer ORDER BY urgent DESC, customer LIMIT 10""",
    "busiest_nations": f"""WITH {_STAGED}{_NATION_HISTORY}
SELECT nation, orders, first_year, last_year, urgent_customers FROM nation_history
ORDER BY orders DESC, nation LIMIT 15""",
    "column_coverage": _ALL
    + " UNION ALL ".join(
        _each_table(
            lambda t, n, rows: f"SELECT '{t}' AS table_name, CAST({n} AS INTEGER) AS columns, CAST({n} AS INTEGER) AS documented, "
            f"CAST(0 AS INTEGER) AS undocumented, true AS has_comment, CAST(2 AS INTEGER) AS tags, count(*) AS rows {rows}"
        )
    ),
}
