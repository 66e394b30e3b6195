"""The registered queries as plain SQL, written independently of the operators."""

from __future__ import annotations

FIRST_LOAD = "TIMESTAMP '2001-01-01 00:00:00'"
RUN = "TIMESTAMP '2024-06-01 12:00:00'"

ORDER_COLS = ("customer_no, company_name, product_group_code, invoice_no, invoice_date, csp_yes_no, type, uom, "
              "quantity, kgs, insert_date, update_date")
FACT_TAIL = "invoice_no, invoice_date, csp_yes_no, type, uom, quantity, kgs, qty_in_nos, qty_in_mt"
FACT1_COLS = f"customerid, company_id, product_id, plant_id, date_id, {FACT_TAIL}"
FACT2_COLS = f"customer_id, company_id, product_id, plant_id, date_id, employee_id, {FACT_TAIL}"

ORDER_ROWS = """
order_rows AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_no, n_name AS company_name,
         CAST(l_partkey AS VARCHAR) AS product_group_code, CAST(l_orderkey AS VARCHAR) AS invoice_no,
         CAST(o_orderdate AS DATE) AS invoice_date, l_returnflag AS csp_yes_no, l_linestatus AS type,
         o_orderpriority AS uom, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_quantity * p_size AS BIGINT) AS kgs, o_orderdate AS insert_date, l_shipdate AS update_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

DIMS = """
dim_date AS (
  SELECT DISTINCT CAST(YEAR(o_orderdate) * 10000 + MONTH(o_orderdate) * 100 + DAY(o_orderdate) AS INTEGER) AS date_id,
         o_orderdate AS fulldate FROM orders),
sl_product AS (SELECT p_partkey AS product_id, CAST(p_partkey AS VARCHAR) AS product_group_code FROM part),
sl_customer AS (
  SELECT c_custkey AS customerid, CAST(c_custkey AS VARCHAR) AS customer_no, CAST(c_nationkey AS VARCHAR) AS kam_emp_no
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
sl_company AS (SELECT CAST(n_nationkey AS BIGINT) AS company_id, n_name AS company_name FROM nation),
sl_plant AS (
  SELECT CAST(n_regionkey * 100 + n_nationkey AS BIGINT) AS plant_id, n_name AS company_name FROM nation),
sl_plant_wide AS (
  SELECT CAST(nth * 1000 + n_regionkey * 100 + n_nationkey AS BIGINT) AS plant_id, n_name AS company_name
  FROM nation CROSS JOIN (VALUES (0), (1), (2)) AS v(nth)),
sl_employee AS (SELECT CAST(n_nationkey AS VARCHAR) AS emp_no FROM nation)"""

KEYED = f"""
keyed_orders AS (
  SELECT {ORDER_COLS} FROM (
    SELECT *, ROW_NUMBER() OVER (
      PARTITION BY invoice_no, product_group_code
      ORDER BY customer_no, company_name, invoice_date, csp_yes_no, type, uom, quantity, kgs,
               insert_date, update_date) AS rn
    FROM order_rows) WHERE rn = 1),
silver_before AS (SELECT * FROM keyed_orders WHERE uom <> '5-LOW'),
silver_after AS (
  SELECT CASE WHEN uom = '2-HIGH' THEN NULL
              WHEN uom = '4-NOT SPECIFIED' AND type = 'O' THEN customer_no || '-1' ELSE customer_no END AS customer_no,
         company_name, product_group_code, invoice_no, invoice_date, csp_yes_no, type, uom,
         CASE WHEN uom = '1-URGENT' THEN quantity + 1 ELSE quantity END AS quantity,
         CASE WHEN uom = '3-MEDIUM' THEN kgs + 1 ELSE kgs END AS kgs, insert_date, update_date
  FROM keyed_orders WHERE csp_yes_no <> 'A')"""


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts)


def fact1(orders: str, plant: str = "sl_plant") -> str:
    return f"""
  SELECT c.customerid, m.company_id, p.product_id, l.plant_id, d.date_id, o.invoice_no, o.invoice_date,
         o.csp_yes_no, o.type, o.uom, o.quantity, o.kgs,
         CAST(o.quantity AS DOUBLE) / 10000 AS qty_in_nos, CAST(o.kgs AS DOUBLE) / 1000 AS qty_in_mt
  FROM {orders} o
  JOIN sl_product p ON o.product_group_code = p.product_group_code
  JOIN dim_date d ON o.invoice_date = CAST(d.fulldate AS DATE)
  LEFT JOIN sl_customer c ON o.customer_no = c.customer_no
  LEFT JOIN sl_company m ON o.company_name = m.company_name
  LEFT JOIN {plant} l ON o.company_name = l.company_name"""


def fact2(orders: str) -> str:
    return f"""
  SELECT c.customerid AS customer_id, m.company_id, p.product_id, l.plant_id, d.date_id, e.emp_no AS employee_id,
         o.invoice_no, o.invoice_date, o.csp_yes_no, o.type, o.uom, o.quantity, o.kgs,
         CAST(o.quantity AS DOUBLE) / 10000 AS qty_in_nos, CAST(o.kgs AS DOUBLE) / 1000 AS qty_in_mt
  FROM {orders} o
  JOIN sl_product p ON o.product_group_code = p.product_group_code
  JOIN dim_date d ON o.invoice_date = CAST(d.fulldate AS DATE)
  JOIN sl_customer c ON o.customer_no = c.customer_no
  JOIN sl_company m ON o.company_name = m.company_name
  JOIN sl_plant l ON o.company_name = l.company_name
  JOIN sl_employee e ON c.kam_emp_no = e.emp_no"""


def dedupe(order: str) -> str:
    return f"""{with_(ORDER_ROWS)}, copies AS (
  SELECT * FROM order_rows UNION ALL
  SELECT customer_no, company_name, product_group_code, invoice_no, invoice_date, csp_yes_no,
         CASE WHEN quantity % 2 = 0 THEN NULL ELSE 'A' END, uom, quantity, kgs, insert_date, CAST(NULL AS TIMESTAMP)
  FROM order_rows WHERE quantity % 5 = 0)
SELECT {ORDER_COLS} FROM (
  SELECT *, ROW_NUMBER() OVER (
    PARTITION BY invoice_no, invoice_date, customer_no, company_name, product_group_code, csp_yes_no, uom,
                 quantity, kgs ORDER BY {order}) AS rn FROM copies) WHERE rn = 1"""


def scd1(target: str, source: str) -> str:
    cols = [c.strip() for c in FACT1_COLS.split(",")]
    picked = ", ".join(
        f"CASE WHEN s.hit THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    return f"""SELECT {picked}
FROM (SELECT *, TRUE AS hit FROM {target}) t
FULL JOIN (SELECT *, TRUE AS hit FROM {source}) s
  ON t.invoice_no IS NOT DISTINCT FROM s.invoice_no AND t.product_id IS NOT DISTINCT FROM s.product_id"""


FACT1_TABLES = f"""
fact_before AS ({fact1("silver_before")}),
fact_batch AS ({fact1("silver_after")})"""

FACT2_TABLES = f"""
fact_rows AS ({fact2("keyed_orders")}),
open_rows AS (
  SELECT *, {FIRST_LOAD} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, 'Y' AS active_flag
  FROM fact_rows WHERE uom <> '5-LOW'),
fact_before AS (
  SELECT * FROM open_rows WHERE NOT (uom = '4-NOT SPECIFIED' AND type = 'F' AND csp_yes_no = 'R')
  UNION ALL
  SELECT {FACT2_COLS}, start_date, TIMESTAMP '2002-01-01 00:00:00', 'N' FROM open_rows
  WHERE uom = '3-MEDIUM' OR (uom = '4-NOT SPECIFIED' AND type = 'F' AND csp_yes_no = 'R')),
fact_batch AS (
  SELECT CASE WHEN uom = '2-HIGH' THEN NULL WHEN uom = '4-NOT SPECIFIED' AND type = 'O' THEN customer_id + 1
              ELSE customer_id END AS customer_id,
         company_id, product_id, plant_id, date_id,
         CASE WHEN uom = '3-MEDIUM' THEN 'E' || employee_id ELSE employee_id END AS employee_id,
         invoice_no, invoice_date, csp_yes_no, type, uom,
         CASE WHEN uom = '1-URGENT' THEN quantity + 1 ELSE quantity END AS quantity, kgs,
         CASE WHEN uom = '1-URGENT' THEN CAST(quantity + 1 AS DOUBLE) / 10000 ELSE qty_in_nos END AS qty_in_nos,
         qty_in_mt
  FROM fact_rows WHERE csp_yes_no <> 'A')"""

FACT2_SINCE_2000 = FACT2_TABLES.replace("WHERE csp_yes_no <> 'A')", "WHERE csp_yes_no <> 'A' AND invoice_date >= DATE '2000-01-01')")

TRACKED = ["customer_id", "company_id", "plant_id", "date_id", "employee_id", "invoice_date", "csp_yes_no", "type",
           "uom", "quantity", "kgs", "qty_in_nos", "qty_in_mt"]


def scd2(target: str, closing: str, versioning: str) -> str:
    """The four parts of a versioned merge: closed and kept rows, new versions, first versions."""
    match = "t.invoice_no = s.invoice_no AND t.product_id = s.product_id"
    source_cols = ", ".join(f"s.{c.strip()}" for c in FACT2_COLS.split(","))
    target_cols = ", ".join(f"t.{c.strip()}" for c in FACT2_COLS.split(","))
    opened = f"{RUN} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, 'Y' AS active_flag"
    closes = f"t.end_date IS NULL AND EXISTS (SELECT 1 FROM fact_batch s WHERE {match} AND ({closing}))"
    return f"""SELECT {target_cols}, t.start_date, CASE WHEN {closes} THEN {RUN} ELSE t.end_date END AS end_date,
       CASE WHEN {closes} THEN 'N' ELSE t.active_flag END AS active_flag FROM {target} t
UNION ALL
SELECT {source_cols}, {opened} FROM fact_batch s JOIN {target} t ON {match}
WHERE t.end_date IS NULL AND ({versioning})
UNION ALL
SELECT {source_cols}, {opened} FROM fact_batch s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {match})"""


def differs(cols: list[str], op: str) -> str:
    return " OR ".join(f"t.{c} {op} s.{c}" for c in cols)


NULL_SAFE = differs(TRACKED, "IS DISTINCT FROM")
COMPAT_CLOSE = differs([c for c in TRACKED if c != "employee_id"], "<>")
COMPAT_VERSION = differs(["company_id", "plant_id", "date_id", "invoice_date", "csp_yes_no", "type", "uom",
                          "quantity", "kgs"], "<>")

SILVER_MATCH = "t.invoice_no IS NOT DISTINCT FROM s.invoice_no AND " \
               "t.product_group_code IS NOT DISTINCT FROM s.product_group_code"
SILVER_COMPARE = ["customer_no", "company_name", "invoice_date", "csp_yes_no", "type", "uom", "quantity", "kgs",
                  "insert_date", "update_date"]
SILVER_DIFFERS = differs(SILVER_COMPARE, "IS DISTINCT FROM")


def cols_of(alias: str) -> str:
    return ", ".join(f"{alias}.{c.strip()}" for c in ORDER_COLS.split(","))


DIFF = f"""
diff_rows AS (
  SELECT {cols_of("s")}, 'INSERT' AS _action, FALSE AS _is_update FROM silver_after s
  WHERE NOT EXISTS (SELECT 1 FROM silver_before t WHERE {SILVER_MATCH})
  UNION ALL
  SELECT {cols_of("t")}, 'DELETE', FALSE FROM silver_before t
  WHERE NOT EXISTS (SELECT 1 FROM silver_after s WHERE {SILVER_MATCH})
  UNION ALL
  SELECT {cols_of("t")}, 'DELETE', TRUE FROM silver_before t JOIN silver_after s ON {SILVER_MATCH}
  WHERE {SILVER_DIFFERS}
  UNION ALL
  SELECT {cols_of("s")}, 'INSERT', TRUE FROM silver_before t JOIN silver_after s ON {SILVER_MATCH}
  WHERE {SILVER_DIFFERS})"""


def cdc(feed: str, deletes: str, updates: str) -> str:
    """FULL JOIN of table and feed, one change per key, clause by clause."""
    names = [c.strip() for c in ORDER_COLS.split(",")]
    picked = ", ".join(
        f"CASE WHEN t.invoice_no IS NULL OR ({updates}) THEN s.{c} ELSE t.{c} END AS {c}" for c in names)
    return f"""SELECT {picked} FROM silver_before t FULL JOIN {feed} s ON {SILVER_MATCH}
WHERE CASE WHEN t.invoice_no IS NULL THEN s._action = 'INSERT' AND NOT s._is_update
           ELSE s._action IS NULL OR NOT ({deletes}) END"""


def replay(on_insert: str) -> str:
    """A feed with several changes a key, applied one by one by recursion; a state is a struct or NULL.

    ``on_insert`` is the state after an insert, from the state ``r.s`` and the values ``e.v``.
    """
    def step(which: str, number: int, action: str, is_update: str, replaced: str = "") -> str:
        rows = f"(SELECT * REPLACE ({replaced}) FROM diff_rows)" if replaced else "diff_rows"
        return f"SELECT {ORDER_COLS}, '{action}' AS _action, {is_update} AS _is_update, {number} AS change_no FROM {rows} " \
               f"WHERE _action = 'INSERT' AND {which}"
    steps = [
        f"SELECT {ORDER_COLS}, _action, _is_update, CASE WHEN _action = 'DELETE' THEN 100 ELSE 101 END AS change_no FROM diff_rows",
        step("uom = '1-URGENT'", 50, "INSERT", "TRUE", "quantity + 7 AS quantity, CAST(NULL AS BIGINT) AS kgs"),
        step("uom = '3-MEDIUM'", 200, "DELETE", "FALSE"),
        step("uom = '3-MEDIUM' AND csp_yes_no = 'R'", 300, "INSERT", "FALSE", "kgs + 5 AS kgs"),
        step("uom = '3-MEDIUM' AND csp_yes_no = 'R' AND type = 'O'", 400, "INSERT", "TRUE", "kgs + 6 AS kgs, CAST(NULL AS VARCHAR) AS company_name"),
        step("uom = '5-LOW'", 150, "INSERT", "TRUE", "quantity * 2 AS quantity"),
        step("uom = '5-LOW'", 160, "INSERT", "FALSE", "CAST(0 AS BIGINT) AS quantity"),
        step("uom = '5-LOW' AND type = 'F'", 500, "DELETE", "FALSE"),
    ]
    packed = "struct_pack(" + ", ".join(f"{c.strip()} := {c.strip()}" for c in ORDER_COLS.split(",")) + ")"
    return f"""WITH RECURSIVE {ORDER_ROWS}, {KEYED}, {DIFF},
feed AS ({" UNION ALL ".join(steps)}),
events AS (
  SELECT invoice_no AS k1, product_group_code AS k2, _action, _is_update, {packed} AS v,
         ROW_NUMBER() OVER (PARTITION BY invoice_no, product_group_code ORDER BY change_no) AS nth FROM feed),
states AS (SELECT invoice_no AS k1, product_group_code AS k2, {packed} AS v FROM silver_before),
run AS (
  SELECT coalesce(e.k1, b.k1) AS k1, coalesce(e.k2, b.k2) AS k2, 0 AS nth, b.v AS s
  FROM states b FULL JOIN (SELECT DISTINCT k1, k2 FROM events) e ON e.k1 = b.k1 AND e.k2 = b.k2
  UNION ALL
  SELECT r.k1, r.k2, CAST(e.nth AS INTEGER),
         CASE WHEN e._action = 'DELETE' AND NOT e._is_update THEN NULL
              WHEN e._action = 'DELETE' THEN r.s
              WHEN e._is_update THEN CASE WHEN r.s IS NULL THEN NULL ELSE e.v END
              ELSE {on_insert} END
  FROM run r JOIN events e ON e.k1 = r.k1 AND e.k2 = r.k2 AND e.nth = r.nth + 1)
SELECT UNNEST(s) FROM (SELECT arg_max(CASE WHEN s IS NULL THEN [] ELSE [s] END, nth) AS held FROM run GROUP BY k1, k2), UNNEST(held) AS u(s)"""


def other(every: int, usual: str, name: str) -> str:
    return f"CASE WHEN o_orderkey % {every} = 0 THEN '{usual}_b' ELSE '{usual}' END AS {name}"


IDENTITY = ("source_server_name, source_database_name, source_schema_name, source_table_name, "
            "target_database_name, target_schema_name, target_table_name")
LEDGER = f"""
ledger AS (
  SELECT o_orderkey AS run_id, o_orderdate - INTERVAL 1200 DAY AS run_start,
         {other(7, "oltp", "source_server_name")}, {other(11, "sales", "source_database_name")},
         {other(13, "dbo", "source_schema_name")}, {other(17, "lake", "target_database_name")},
         {other(19, "bronze", "target_schema_name")},
         'orders_' || CAST(o_custkey % 10 AS VARCHAR) AS source_table_name,
         CASE WHEN o_orderkey % 23 = 0 THEN 'bz_other' ELSE 'bz_orders_' || CAST(o_custkey % 10 AS VARCHAR) END AS target_table_name,
         CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 > 0 THEN o_orderdate - INTERVAL 1201 DAY END AS watermark FROM orders)"""
ORDERS_3 = """source_server_name = 'oltp' AND source_database_name = 'sales' AND source_schema_name = 'dbo'
  AND source_table_name = 'orders_3' AND target_database_name = 'lake' AND target_schema_name = 'bronze'
  AND target_table_name = 'bz_orders_3' AND status = 'SUCCESS'"""

MARK = f"(SELECT MAX(run_start) FROM ledger WHERE {ORDERS_3})"
SOURCE_MARK = f"(SELECT MAX(watermark) FROM ledger WHERE {ORDERS_3})"
ORDERS_KEPT = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
NEXT_ID = "(SELECT MAX(run_id) + 1 FROM ledger WHERE run_start = (SELECT MAX(run_start) FROM ledger))"

PRODUCT = """printf('%012d', p_partkey) AS product_no, p_type AS type, CAST(p_partkey AS VARCHAR) AS product_group_code,
         p_brand AS rm_type, p_name AS product_vertical, CAST(p_size AS VARCHAR) AS product_mvertical"""
WORDS = "SELECT UNNEST(string_split_regex(text, '\\s')) AS word FROM conversations"
PEOPLE = ("SELECT CAST(c_custkey AS INTEGER) AS userID, c_name AS name, CAST(c_nationkey * 3 AS INTEGER) AS age, "
          "CAST(FLOOR(c_acctbal) AS INTEGER) AS friends FROM customer")


def ledger_run(run_id: str, start: int, status: str, error: str, source_rows: str, target_rows: str,
               mark: str) -> str:
    def at(seconds: int) -> str:
        return f"{RUN} + INTERVAL {seconds} SECOND"
    return f"""SELECT CAST({run_id} AS BIGINT), {at(start)}, {at(start + 90)}, 90.0, 'oltp', 'sales', 'dbo', 'orders_3',
       'lake', 'bronze', 'bz_orders_3', FALSE, 'tests', '{status}', '{error}', {source_rows}, {target_rows},
       {at(start + 180)}, 'tests', {at(start + 180)}, 'tests', {mark}"""


LEDGER_APPEND = f"""{with_(LEDGER)}, fresh AS (SELECT * FROM orders WHERE o_orderdate > {SOURCE_MARK})
SELECT run_id, run_start, run_start AS run_end, CAST(0 AS DOUBLE) AS duration, {IDENTITY}, FALSE AS snowflake_flag,
       'tests' AS triggered_by, status, '' AS error,
       CAST(NULL AS BIGINT) AS source_nbr_of_records, CAST(NULL AS BIGINT) AS target_nbr_of_records,
       run_start AS created_date, CAST(NULL AS VARCHAR) AS created_by,
       run_start AS modified_date, CAST(NULL AS VARCHAR) AS modified_by, watermark FROM ledger
UNION ALL
{ledger_run(NEXT_ID, 0, "SUCCESS", "", "(SELECT COUNT(*) FROM fresh)", "(SELECT COUNT(*) FROM fresh)",
            "(SELECT MAX(o_orderdate) FROM fresh)")}
UNION ALL
{ledger_run(f"{NEXT_ID} + 1", 270, "FAILED", "source is down", "NULL", "NULL", "NULL")}"""

ORACLES: dict[str, str] = {
    "silver_orders": """
SELECT CAST(o_custkey AS VARCHAR) AS customer_no, n_name AS company_name,
       CAST(l_partkey AS VARCHAR) AS product_group_code, CAST(l_orderkey AS VARCHAR) AS invoice_no,
       CAST(o_orderdate AS DATE) AS invoice_date, l_returnflag AS csp_yes_no, l_linestatus AS type,
       o_orderpriority AS uom, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)), 0) AS BIGINT) AS kgs,
       o_orderdate AS insert_date, l_shipdate AS update_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey""",
    "silver_dedupe": dedupe("type ASC NULLS LAST, insert_date ASC NULLS LAST, update_date DESC NULLS FIRST"),
    "silver_dedupe_incremental": dedupe("type ASC NULLS LAST, insert_date ASC NULLS LAST, update_date DESC NULLS FIRST"),
    "silver_dedupe_latest": dedupe("update_date DESC NULLS LAST, insert_date DESC NULLS LAST, type ASC NULLS LAST"),
    "fact_full_load": f"{with_(ORDER_ROWS, DIMS)} {fact1('order_rows')}",
    "fact_full_load_fanout": f"{with_(ORDER_ROWS, DIMS)} {fact1('order_rows', 'sl_plant_wide')}",
    "fact_versioned_product": f"""{with_(ORDER_ROWS, DIMS.replace("sl_product AS", "sl_product_unversioned AS"))},
first AS (SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) AS product_id, * FROM part WHERE p_size <= 40),
changed AS (SELECT * FROM part WHERE p_size > 40 OR (p_size <= 10 AND p_brand <> 'Brand#99')),
versions AS (
  SELECT product_id, CAST(p_partkey AS VARCHAR) AS product_group_code, TIMESTAMP '1993-01-01' AS start_date,
         CASE WHEN p_size <= 10 AND p_brand <> 'Brand#99' THEN TIMESTAMP '1996-06-15' END AS end_date FROM first
  UNION ALL
  SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) + (SELECT COUNT(*) FROM first), CAST(p_partkey AS VARCHAR), TIMESTAMP '1996-06-15',
         CAST(NULL AS TIMESTAMP) FROM changed)
{fact1('order_rows').replace("JOIN sl_product p ON o.product_group_code = p.product_group_code",
    "JOIN versions p ON o.product_group_code = p.product_group_code AND o.invoice_date >= p.start_date "
    "AND (p.end_date IS NULL OR o.invoice_date < p.end_date)")}""",
    "fact_inner_employee": f"{with_(ORDER_ROWS, DIMS)} {fact2('order_rows')}",
    "fact_append": f"{with_(ORDER_ROWS, DIMS, KEYED)} {fact1('keyed_orders')} UNION ALL {fact1('keyed_orders')}",
    "scd1_merge": f"{with_(ORDER_ROWS, DIMS, KEYED, FACT1_TABLES)} {scd1('fact_before', 'fact_batch')}",
    "scd1_load": f"{with_(ORDER_ROWS, DIMS, KEYED, FACT1_TABLES)} {scd1('fact_before', 'fact_batch')}",
    "scd1_partitioned_load": f"""{with_(ORDER_ROWS, DIMS, KEYED, FACT1_TABLES)}
SELECT *, CAST(YEAR(invoice_date) AS INTEGER) AS invoice_year FROM ({scd1('fact_before', 'fact_batch')})""",
    "scd1_merge_latest": f"""{with_(ORDER_ROWS, DIMS, KEYED, FACT1_TABLES)}, largest AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (
    PARTITION BY invoice_no, product_id ORDER BY kgs DESC, quantity DESC, csp_yes_no DESC, type DESC, company_id DESC,
    customerid, plant_id, date_id, invoice_date, uom) AS rn FROM ({fact1('order_rows')})) WHERE rn = 1)
{scd1('fact_before', 'largest')}""",
    "scd2_merge": f"{with_(ORDER_ROWS, DIMS, KEYED, FACT2_TABLES)} {scd2('fact_before', NULL_SAFE, NULL_SAFE)}",
    "scd2_merge_compat":
        f"{with_(ORDER_ROWS, DIMS, KEYED, FACT2_TABLES)} {scd2('fact_before', COMPAT_CLOSE, COMPAT_VERSION)}",
    "scd2_partitioned_load": f"""{with_(ORDER_ROWS, DIMS, KEYED, FACT2_TABLES)}
SELECT *, CAST(CASE WHEN active_flag = 'N' THEN 1 ELSE 0 END AS BIGINT) AS closed_run
FROM ({scd2('open_rows', NULL_SAFE, NULL_SAFE)})""",
    "scd2_touched_load": f"""{with_(ORDER_ROWS, DIMS, KEYED, FACT2_SINCE_2000)}
SELECT *, CAST(CASE WHEN active_flag = 'N' THEN 1 ELSE 0 END AS BIGINT) AS closed_run
FROM ({scd2('open_rows', NULL_SAFE, NULL_SAFE)})""",
    "scd2_rerun_load": f"""{with_(ORDER_ROWS, DIMS, KEYED, FACT2_TABLES)}
SELECT *, CAST(CASE WHEN active_flag = 'Y' THEN 0 WHEN invoice_date < DATE '2000-01-01' THEN 1 ELSE 2 END AS BIGINT) AS closed_run
FROM ({scd2('open_rows', NULL_SAFE, NULL_SAFE)})""",
    "scd2_bloom_load": f"""{with_(ORDER_ROWS, DIMS, KEYED, FACT2_TABLES)}
SELECT *, CAST(CASE WHEN end_date = {RUN} THEN 1 ELSE 0 END AS BIGINT) AS closed_run
FROM ({scd2('fact_before', NULL_SAFE, NULL_SAFE)})""",
    "snapshot_diff": f"{with_(ORDER_ROWS, KEYED, DIFF)} SELECT * FROM diff_rows",
    "snapshot_diff_digest": f"{with_(ORDER_ROWS, KEYED, DIFF)} SELECT * FROM diff_rows WHERE year(invoice_date) = 1998",
    "cdc_apply": f"""{with_(ORDER_ROWS, KEYED, DIFF)},
feed AS (SELECT * FROM diff_rows WHERE NOT (_action = 'DELETE' AND _is_update))
{cdc('feed', "s._action = 'DELETE'", f"s._action = 'INSERT' AND s._is_update AND ({SILVER_DIFFERS})")}""",
    "cdc_apply_reinsert": f"""{with_(ORDER_ROWS, KEYED, DIFF)},
feed AS (SELECT * FROM diff_rows WHERE NOT (_action = 'DELETE' AND _is_update))
{cdc('feed', "s._action = 'DELETE'", f"s._action = 'INSERT' AND s._is_update AND ({SILVER_DIFFERS})")}""",
    "cdc_apply_compat": f"""{with_(ORDER_ROWS, KEYED, DIFF)},
feed AS (SELECT * FROM diff_rows WHERE NOT _is_update OR (_action = 'DELETE') = (csp_yes_no = 'R'))
{cdc('feed', "s._action = 'DELETE' AND s._is_update",
     f"s._action = 'INSERT' AND s._is_update AND ({SILVER_DIFFERS})")}""",
    "cdc_apply_upsert": f"""{with_(ORDER_ROWS, KEYED)},
feed AS (SELECT *, 'INSERT' AS _action, FALSE AS _is_update FROM silver_after)
{cdc('feed', "s._action = 'DELETE'", f"s._action = 'INSERT' AND ({SILVER_DIFFERS})")}""",
    "cdc_apply_sequenced": replay("coalesce(r.s, e.v)"),
    "cdc_apply_sequenced_upsert": replay("e.v"),
    "row_change_detect": f"""{with_(ORDER_ROWS, KEYED)}
SELECT s.* FROM silver_after s JOIN silver_before t ON {SILVER_MATCH} WHERE {SILVER_DIFFERS}""",
    "surrogate_keys": """
SELECT CAST(10 + ROW_NUMBER() OVER (ORDER BY p_brand, p_type, p_partkey) AS BIGINT) AS part_sk,
       p_brand, p_type, p_partkey, p_name FROM part""",
    "dim_product_load": f"""
SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) AS gl_product_id, printf('%012d', p_partkey) AS product_no,
       p_type AS type, CAST(p_partkey AS VARCHAR) AS product_group_code, p_brand AS rm_type,
       p_name AS product_vertical, CAST(p_size AS VARCHAR) AS product_mvertical,
       {RUN} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, 'Y' AS active_flag FROM part""",
    "dim_product_merge": f"""
WITH first AS (
  SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) AS gl_product_id, {PRODUCT} FROM part WHERE p_size <= 40),
fresh AS (
  SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) + (SELECT COUNT(*) FROM first) AS gl_product_id, {PRODUCT}
  FROM (SELECT * REPLACE (CASE WHEN p_size <= 10 THEN 'Brand#99' ELSE p_brand END AS p_brand) FROM part
        WHERE p_size > 40 OR (p_size <= 10 AND p_brand <> 'Brand#99')))
SELECT *, {FIRST_LOAD} AS start_date,
       CASE WHEN CAST(product_mvertical AS INTEGER) <= 10 AND rm_type <> 'Brand#99' THEN {RUN} END AS end_date,
       CASE WHEN CAST(product_mvertical AS INTEGER) <= 10 AND rm_type <> 'Brand#99' THEN 'N' ELSE 'Y' END AS active_flag FROM first
UNION ALL SELECT *, {RUN}, CAST(NULL AS TIMESTAMP), 'Y' FROM fresh""",
    "history_watermark": f"""{with_(LEDGER)}
SELECT COUNT(*) AS runs, MAX(watermark) AS watermark FROM ledger WHERE {ORDERS_3}""",
    "history_watermark_all": f"""{with_(LEDGER)}
SELECT {IDENTITY}, COUNT(*) AS runs, MAX(watermark) AS watermark FROM ledger WHERE status = 'SUCCESS' GROUP BY ALL""",
    "next_run_id": f"{with_(LEDGER)} SELECT {NEXT_ID} AS run_id",
    "bronze_full_load": f"SELECT {ORDERS_KEPT}, {RUN} AS insert_date, {RUN} AS update_date FROM orders",
    "bronze_incremental": f"""{with_(LEDGER)}
SELECT {ORDERS_KEPT}, {RUN} AS insert_date, {RUN} AS update_date FROM orders WHERE o_orderdate > {MARK}""",
    "reconcile_counts": """
WITH n AS (SELECT COUNT(*) AS everything, COUNT(*) FILTER (o_orderstatus <> 'P') AS kept FROM orders)
SELECT kept AS source_rows, kept AS target_rows, TRUE AS agree FROM n
UNION ALL SELECT everything, kept, everything = kept FROM n
UNION ALL SELECT everything, everything + kept, kept = 0 FROM n""",
    "ingest_after_empty_load": f"""
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS source_modified,
       {RUN} + INTERVAL 270 SECOND AS insert_date FROM orders""",
    "ingest_boundary_rows": f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate AS source_modified,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' OR (o_orderdate = TIMESTAMP '1998-01-01' AND o_orderstatus <> 'O') THEN {RUN}
            ELSE {RUN} + INTERVAL 270 SECOND END AS insert_date FROM orders""",
    "ingest_crash_between_write_and_ledger": f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate AS source_modified,
       CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' OR (o_orderdate = TIMESTAMP '1996-01-01' AND o_orderstatus <> 'O') THEN {RUN}
            ELSE {RUN} + INTERVAL 1080 SECOND END AS insert_date FROM orders""",
    "reconcile_digest": """
WITH wrong AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
         CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 100 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders),
swapped AS (
  SELECT CASE o_orderkey WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_totalprice
  FROM orders),
compared AS (
  SELECT 'same' AS against, c AS column_name, TRUE AS agree
  FROM (SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', '(rows)']) AS c)
  UNION ALL SELECT 'changed', unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_orderdate']), TRUE
  UNION ALL SELECT 'changed', unnest(['o_totalprice', '(rows)']),
    NOT EXISTS ((SELECT o_orderkey, o_totalprice FROM orders) EXCEPT (SELECT o_orderkey, o_totalprice FROM wrong))
  UNION ALL SELECT 'swapped', unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate']), TRUE
  UNION ALL SELECT 'swapped', '(rows)',
    NOT EXISTS ((SELECT o_orderkey, o_totalprice, o_custkey FROM orders) EXCEPT (SELECT o_orderkey, o_totalprice, o_custkey FROM swapped)))
SELECT column_name, (SELECT COUNT(*) FROM orders) AS source_rows, (SELECT COUNT(*) FROM orders) AS target_rows, agree, against FROM compared""",
    "ledger_append": LEDGER_APPEND,
    "line_token_count": """
SELECT array_to_string(string_split_regex(text, '\\s'), chr(1)) AS word, COUNT(*) AS n
FROM conversations GROUP BY string_split_regex(text, '\\s')""",
    "word_count": f"SELECT word, COUNT(*) AS n FROM ({WORDS}) GROUP BY word",
    "table_create_append": f"{with_(ORDER_ROWS)} SELECT * FROM order_rows",
    "stream_csv_to_csv": PEOPLE,
    "stream_two_checkpoints_append": PEOPLE,
    "stream_word_count_update": f"SELECT word, COUNT(*) AS n FROM ({WORDS}) GROUP BY word",
    "stream_quarantine": """
WITH people AS (
  SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 7 = 0 THEN 'thirty' ELSE CAST(c_nationkey * 3 AS VARCHAR) END AS age,
         CASE WHEN c_custkey % 5 = 0 THEN '3000000000' ELSE CAST(CAST(FLOOR(c_acctbal) AS BIGINT) AS VARCHAR) END AS friends FROM customer),
judged AS (
  SELECT *, CASE WHEN k % 11 = 0 OR k % 13 = 0 THEN 'malformed record'
                 WHEN k % 7 = 0 AND k % 5 = 0 THEN 'age is no int; friends is no int'
                 WHEN k % 7 = 0 THEN 'age is no int' WHEN k % 5 = 0 THEN 'friends is no int' END AS reason FROM people)
SELECT CASE WHEN reason IS NULL THEN CAST(k AS INTEGER) END AS userID, CASE WHEN reason IS NULL THEN name END AS name,
       TRY_CAST(CASE WHEN reason IS NULL THEN age END AS INTEGER) AS age, TRY_CAST(CASE WHEN reason IS NULL THEN friends END AS INTEGER) AS friends,
       reason, CASE WHEN k % 11 = 0 THEN k || ',' || name || ',' || age
                    WHEN k % 13 = 0 THEN k || ',' || name || ',' || age || ',' || friends || ',x'
                    WHEN reason IS NOT NULL THEN '{"userID":"' || k || '","name":"' || name || '","age":"' || age || '","friends":"' || friends || '"}'
               END AS record, reason IS NOT NULL AS quarantined FROM judged""",
    "stream_memory_counts": f"SELECT word, COUNT(*) AS n FROM ({WORDS}) GROUP BY word",
    "stream_filter_project": f"SELECT name, friends FROM ({PEOPLE}) WHERE age < 30",
    "stream_foreach_append": """
SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS url, source AS product_name, lang AS reviewer_name, '-' AS review_title,
       text AS review_text, CAST(n_chars AS VARCHAR) AS review_rating, '-' AS verified_purchase, '-' AS review_date,
       '-' AS helpful_count, CAST(doc_id AS VARCHAR) AS uniq_id FROM documents""",
    "stream_word_count": f"SELECT word, COUNT(*) AS n FROM ({WORDS}) GROUP BY word",
    "stream_line_token_count": """
SELECT array_to_string(string_split_regex(line, '\\s'), chr(1)) AS word, COUNT(*) AS n
FROM (SELECT UNNEST(string_split(text, chr(10))) AS line FROM conversations)
GROUP BY string_split_regex(line, '\\s')""",
    "stream_cdc_apply": f"{with_(ORDER_ROWS, KEYED)} SELECT * FROM silver_after",
}
