"""The logical tables of FIXTURES.md §2 as ANSI SQL over the driver's views.

Only the oracle (``__spark_entry__.oracle_sql``) uses this: DuckDB has the raw
tables (lineitem, orders, ...) registered, and each oracle query is prefixed
with the CTEs it references.  The expressions mirror
``tillpoint.sources.tables._RawFixture`` one for one.
"""

from __future__ import annotations

import re

from tillpoint.config import FIXTURE_APPLICATIONS, FIXTURE_EVENT_SHIFT_DAYS, FIXTURE_TASK_IDS

_TASK_ID = f"CASE WHEN l_linenumber <= 4 THEN 16 ELSE [{', '.join(map(str, FIXTURE_TASK_IDS))}][l_partkey % {len(FIXTURE_TASK_IDS)} + 1] END"


def _application_of(quantity: int, date_col: str | None, statuses: tuple[str, ...]) -> str:
    names = ", ".join(f"'{x}'" for x in statuses)
    date = f"CASE WHEN l_tax <= 0.06 THEN l_shipdate END AS {date_col}, " if date_col else ""
    return f"""
SELECT l_suppkey AS merchant_id, l_shipdate AS created_at, {date}[{names}][l_linenumber % {len(statuses)} + 1] AS status
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity BETWEEN {quantity} AND {quantity + 1}
  AND l_discount >= 0.07 AND l_suppkey % 3 <> 0"""


CTES: dict[str, str] = {
    "transactions": """
SELECT l.l_orderkey * 10 + l.l_linenumber AS id,
       l.l_suppkey AS merchant_id,
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
       l.l_shipdate AS payment_timestamp,
       CAST(o.o_custkey AS VARCHAR) AS payer_vpa_hash,
       CASE WHEN l.l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS status
FROM lineitem l LEFT JOIN (SELECT o_orderkey, MIN(o_custkey) AS o_custkey FROM orders GROUP BY o_orderkey) o
  ON l.l_orderkey = o.o_orderkey""",
    "application": """
SELECT l_suppkey AS merchant_id, l_shipdate AS created_at,
       CASE WHEN l_tax <= 0.06 THEN l_shipdate END AS order_date,
       CASE WHEN l_linestatus = 'F' THEN 'ORDERED' ELSE 'CANCELLED' END AS status
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity >= 45 AND l_discount >= 0.08""",
    "application_recent": """
SELECT l_suppkey AS merchant_id, l_shipdate AS created_at, l_shipdate AS order_date,
       CASE WHEN l_linestatus = 'F' THEN 'ORDERED' ELSE 'CANCELLED' END AS status
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2001-07-10' AND l_quantity >= 25""",
    "task_history_v1": f"""
SELECT l_suppkey AS merchant_id, l_shipdate AS created_at,
       CAST({_TASK_ID} AS BIGINT) AS task_id
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity BETWEEN 40 AND 43
  AND l_discount >= 0.07 AND l_suppkey % 3 <> 0""",
    "task_history_v2": f"""
SELECT l_suppkey AS merchant_id, l_shipdate AS created_at,
       CAST({_TASK_ID} AS BIGINT) AS task_id
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '2000-06-01' AND l_quantity BETWEEN 36 AND 39
  AND l_discount >= 0.07 AND l_suppkey % 4 <> 0""",
    "merchant_mart": """
SELECT s.s_suppkey AS merchant_id,
       CAST(s.s_suppkey AS VARCHAR) AS mid,
       CASE s.s_suppkey % 3 WHEN 0 THEN 'RETAIL' WHEN 1 THEN 'SERVICE' ELSE 'FOOD' END AS actual_merchant_type,
       'AREA_' || CAST(s.s_suppkey % 10 AS VARCHAR) AS area_name,
       r.r_name AS zone_name,
       n.n_name AS region_name,
       'TERR_' || CAST(s.s_suppkey % 6 AS VARCHAR) AS territory_name,
       CAST(DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) AS TIMESTAMP) AS merchant_created_at,
       'CAT_' || CAST(s.s_suppkey % 8 AS VARCHAR) AS std_category,
       CAST(s.s_suppkey % 25 * 7919 % 36000 AS DOUBLE) / 100.0 - 180.0 AS integ_longitude,
       CAST(s.s_suppkey % 25 * 104729 % 18000 AS DOUBLE) / 100.0 - 90.0 AS integ_latitude,
       CAST(s.s_suppkey % 2 = 0 AS INTEGER) AS swipe_flag,
       CAST(s.s_suppkey % 3 = 0 AS INTEGER) AS speaker_flag,
       CAST(s.s_suppkey % 5 = 0 AS INTEGER) AS loan_flag,
       CAST(s.s_suppkey % 7 = 0 AS INTEGER) AS fp_flag,
       CAST(s.s_suppkey % 11 = 0 AS INTEGER) AS club_flag,
       CAST(s.s_suppkey % 2 = 1 AS INTEGER) AS qr_flag,
       CAST(s.s_suppkey % 13 = 0 AS INTEGER) AS credit_flag,
       CAST(s.s_suppkey % 17 = 0 AS INTEGER) AS debit_flag,
       DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) + 3 AS onboarding_date,
       CAST(s.s_suppkey % 4 AS INTEGER) AS lending_eligibility,
       CASE WHEN s.s_suppkey % 4 = 0 THEN 'NONE' ELSE 'PRE_APPROVED' END AS lending_eligibility_type,
       CAST((s.s_suppkey + 1) % 4 AS INTEGER) AS swipe_eligibility,
       CAST((s.s_suppkey + 2) % 4 AS INTEGER) AS fp_eligibility,
       CAST((s.s_suppkey + 3) % 4 AS INTEGER) AS insurance_eligibility,
       CAST(s.s_suppkey % 2 AS INTEGER) AS club_eligibility,
       CAST((s.s_suppkey + 1) % 2 AS INTEGER) AS gl_eligibility,
       CAST((s.s_suppkey + 2) % 4 AS INTEGER) AS speaker_eligibility,
       s.s_acctbal AS merchant_score,
       CAST(s.s_suppkey * 31 % 100 AS DOUBLE) / 100.0 AS engagement_score,
       CASE WHEN s.s_suppkey % 5 = 0 THEN DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) + 200 END AS loan_disbursal_date,
       CASE WHEN s.s_suppkey % 10 = 0 THEN DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) + 380 END AS loan_closure_date,
       CASE WHEN s.s_suppkey % 2 = 0 THEN DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) + 120 END AS swipe_order_date,
       CASE WHEN s.s_suppkey % 3 = 0 THEN DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) + 150 END AS speaker_order_date,
       CASE WHEN s.s_suppkey % 11 = 0 THEN DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) + 90 END AS club_start_date,
       CASE WHEN s.s_suppkey % 22 = 0 THEN DATE '2000-01-01' + CAST(s.s_suppkey * 97 % 540 AS INTEGER) + 455 END AS club_end_date
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "app_event": f"""
SELECT CAST(user_id AS VARCHAR) AS mid,
       ts - INTERVAL {FIXTURE_EVENT_SHIFT_DAYS} DAY AS created_at,
       CASE WHEN event_id % 17 = 0 THEN NULL
            ELSE CAST(user_id AS VARCHAR) || '-' || CAST(event_id // 3 AS VARCHAR) END AS session_id,
       CASE WHEN event_id % 5 = 0 THEN 'Web' ELSE 'MerchantApp' END AS source,
       event_type AS event_name
FROM events""",
    "app_dump": f"""
SELECT merchant_id, date,
       CASE WHEN merchant_id % 13 = 0 THEN '"[' || items ELSE '"[' || items || ']"' END AS app_details
FROM (
  SELECT user_id AS merchant_id,
         CAST(ts - INTERVAL {FIXTURE_EVENT_SHIFT_DAYS} DAY AS DATE) AS date,
         string_agg('{{''appName'': ''' || app || ''', ''packageName'': ''com.' || lower(app) || '''}}', ', '
                    ORDER BY event_id) AS items
  FROM (
    SELECT event_id, user_id, ts,
           CASE event_type WHEN 'view' THEN 'Paytm' WHEN 'click' THEN 'PhonePe'
                WHEN 'purchase' THEN 'Khatabook' WHEN 'signup' THEN 'CRED'
                ELSE 'OtherApp' || CAST(event_id % 4 AS VARCHAR) END AS app
    FROM events) e
  GROUP BY 1, 2) g""",
    "device_info": """
SELECT s_suppkey AS merchant_id,
       CASE WHEN s_suppkey % 2 = 1 THEN 'Brand ' || CAST(s_suppkey % 31 AS VARCHAR) ELSE
         CASE s_suppkey % 7 WHEN 0 THEN 'Samsung' WHEN 1 THEN 'VIVO' WHEN 2 THEN 'TECNO MOBILE LIMITED'
            WHEN 3 THEN 'HMD Global' WHEN 4 THEN 'unknownbrand' WHEN 5 THEN 'xiaomi' END END AS manufacturer
FROM supplier WHERE s_suppkey % 11 <> 0""",
    "scored": """
SELECT c_custkey AS merchant_id,
       CAST(c_custkey % 3 = 0 AS INTEGER) AS target,
       CAST(c_custkey * 7919 % 1300 AS DOUBLE) / 1300.0 AS prob
FROM customer""",
    **{f"application_{name}": _application_of(*view) for name, view in FIXTURE_APPLICATIONS.items()},
}


def with_tables(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the logical-table CTEs it (transitively) uses.

    ``extra_ctes`` are (name, sql) pairs defined after the logical tables, in
    order, so later ones may reference earlier ones.
    """
    extra_ctes = extra_ctes or []
    text = body + " ".join(sql for _, sql in extra_ctes)
    used = [name for name in CTES if re.search(rf"\b{name}\b", text)]
    parts = [f"{name} AS ({CTES[name]}\n)" for name in used]
    parts += [f"{name} AS (\n{sql}\n)" for name, sql in extra_ctes]
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
