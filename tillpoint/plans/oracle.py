"""

These strings are an independent statement of each query (membership rows, anchors from
tagged bags, windows as a table joined to the facts in long form) against
which the Spark plans are checked.  They are test infrastructure, not part of the Spark execution path.
"""

from __future__ import annotations

import datetime as dt

from tillpoint.config import (
    MONTH_WINDOWS,
    PAYER_WINDOWS,
    TPV_WINDOWS,
    TXN_WINDOWS,
    WINDOWS,
    ProductSpec,
    feature_name,
)
from tillpoint.config import FIXTURE_DATE_FLOOR
from tillpoint.sources.fixture_sql import with_tables


def lit_date(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def lit_ts(d: dt.date) -> str:
    return f"TIMESTAMP '{d.isoformat()}'"


def in_list(values) -> str:
    out = []
    for v in values:
        out.append(str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'")
    return "(" + ", ".join(out) + ")"


def win(d: str, od: str, w: str) -> str:
    W = WINDOWS[w]
    upper = od if W.end == 0 else f"{od} - {W.end}"
    cond = f"{d} < {upper}"
    if W.start is not None:
        cond += f" AND {d} >= {od} - {W.start}"
    return cond


def FL(spec_or_date) -> str:
    d = getattr(spec_or_date, "date_floor", spec_or_date)
    return lit_ts(d)


def task_days(spec: ProductSpec) -> str:
    """Every task of the product with its day, tagged by the history it is stored in."""
    parts = [
        f"SELECT merchant_id, CAST(created_at AS DATE) AS day, created_at, {k} AS history FROM task_history_v{k} WHERE task_id IN {in_list(spec.task_ids)}"
        for k in (1, 2)
    ]
    return "\nUNION ALL\n".join(parts)


def first_tasks(spec: ProductSpec) -> str:
    """One row per merchant and distinct first day over the two histories."""
    return f"""
SELECT DISTINCT merchant_id, first_day FROM (
  SELECT merchant_id, day AS first_day,
         row_number() OVER (PARTITION BY merchant_id, history ORDER BY day NULLS LAST) AS k
  FROM ({task_days(spec)}) t WHERE created_at >= {FL(spec)}
) r WHERE k = 1"""


def applicants_sql(spec: ProductSpec) -> str:
    return f"""
SELECT merchant_id FROM {spec.application_table}
GROUP BY merchant_id HAVING bool_or(created_at >= {FL(spec)} AND status IN {in_list(spec.statuses)})"""


def cohort_ctes(spec: ProductSpec) -> list[tuple[str, str]]:
    """A merchant's membership in one row: was it pushed, did it apply."""
    return [
        ("first_task", first_tasks(spec)),
        (
            "member",
            f"""
SELECT merchant_id, max(pushed) AS pushed, max(applied) AS applied FROM (
  SELECT merchant_id, 1 AS pushed, 0 AS applied FROM first_task
  UNION ALL SELECT merchant_id, 0, 1 FROM ({applicants_sql(spec)}) a
) m GROUP BY merchant_id""",
        ),
    ]


def anchor_ctes(spec: ProductSpec, accepted_only: bool = False) -> list:
    """Anchor rows: one per first-task row, or one if there is none; an order day, if the merchant
    has one, takes the place of the task day.  ``accepted_only``: only accepted orders
    count, and whoever has a task or such an order is a member."""
    kept = f"WHERE status IN {in_list(spec.statuses)}" if accepted_only else ""
    orders = f"SELECT merchant_id, min(CAST({spec.order_date_col} AS DATE)) AS order_day FROM {spec.application_table} {kept} GROUP BY merchant_id"
    member = [("member", "SELECT merchant_id FROM first_task UNION SELECT merchant_id FROM order_days")] if accepted_only else []
    anchors = """
SELECT m.merchant_id, ifnull(o.order_day, f.first_day) AS order_date
FROM member m LEFT JOIN first_task f USING (merchant_id) LEFT JOIN order_days o USING (merchant_id)"""
    return [("order_days", orders), *member, ("anchor", anchors)]


def pushed_merchants(spec: ProductSpec) -> str:
    return with_tables("SELECT merchant_id FROM member WHERE pushed = 1", cohort_ctes(spec))


def applied_merchants(spec: ProductSpec) -> str:
    return with_tables(applicants_sql(spec))


def cohort_union(spec: ProductSpec) -> str:
    return with_tables("SELECT merchant_id FROM member", cohort_ctes(spec))


def applied_not_pushed(spec: ProductSpec) -> str:
    return with_tables("SELECT merchant_id FROM member WHERE pushed = 0", cohort_ctes(spec))


def target_label(spec: ProductSpec) -> str:
    return with_tables("SELECT merchant_id, applied AS target FROM member", cohort_ctes(spec))


def first_task_date(spec: ProductSpec) -> str:
    return with_tables("SELECT merchant_id, first_day AS order_date FROM first_task", cohort_ctes(spec)[:1])


def anchor_dates(spec: ProductSpec, mode: str = "reference") -> str:
    body = "SELECT merchant_id, order_date FROM anchor"
    if mode == "earliest":
        body = "SELECT merchant_id, MIN(order_date) AS order_date FROM anchor GROUP BY merchant_id"
    return with_tables(body, cohort_ctes(spec) + anchor_ctes(spec))


def push_converted(spec: ProductSpec, days: int) -> str:
    """Merchants whose first accepted order comes 0 to ``days`` - 1 days after some task."""
    first_order = f"""
SELECT merchant_id, CAST({spec.order_date_col} AS DATE) AS day FROM {spec.application_table}
WHERE created_at >= {FL(spec)} AND status IN {in_list(spec.statuses)}
QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY CAST({spec.order_date_col} AS DATE) NULLS LAST) = 1"""
    return with_tables(
        f"""
SELECT o.merchant_id FROM first_order o
WHERE EXISTS (SELECT 1 FROM task t WHERE t.merchant_id = o.merchant_id AND date_diff('day', t.day, o.day) BETWEEN 0 AND {days - 1})""",
        [("first_order", first_order), ("task", task_days(spec))],
    )


def active_list_sql(as_of: dt.date, min_txns: int, with_mart: bool, min_tpv: int = 150, days: int = 90, floor: dt.date = FIXTURE_DATE_FLOOR) -> str:
    """Merchants by their recent successes; with the mart, its new enough rows and their mid."""
    recent = f"""
SELECT merchant_id, len(list_distinct(list(id))) AS txns, sum(amount) AS tpv
FROM transactions WHERE status = 'SUCCESS' AND date_diff('day', CAST(payment_timestamp AS DATE), {lit_date(as_of)}) <= {days}
GROUP BY merchant_id"""
    enough = f"txns >= {min_txns} AND tpv >= {min_tpv}"
    if not with_mart:
        return f"SELECT merchant_id, txns, tpv FROM ({recent}) r WHERE {enough}"
    return f"""
SELECT m.merchant_id, m.mid, r.txns, r.tpv
FROM (SELECT DISTINCT merchant_id, mid FROM merchant_mart WHERE merchant_created_at >= {FL(floor)}) m
LEFT JOIN ({recent}) r ON r.merchant_id = m.merchant_id WHERE {enough}"""


def active_merchants(as_of: dt.date, min_txns: int, with_mart: bool = False) -> str:
    cols = "merchant_id, mid, txns, CAST(tpv AS DOUBLE) AS tpv" if with_mart else "merchant_id, txns, CAST(tpv AS DOUBLE) AS tpv"
    return with_tables(f"SELECT {cols} FROM merchant_list", [("merchant_list", active_list_sql(as_of, min_txns, with_mart))])


def chunk_union(as_of: dt.date, partitions: int = 10) -> str:
    chunks = [
        f"SELECT merchant_id, COUNT(*) AS n_txns FROM transactions WHERE status = 'SUCCESS' "
        f"AND MOD(merchant_id, {partitions}) = {i} GROUP BY 1"
        for i in range(partitions)
    ]
    return with_tables("\nUNION ALL\n".join(chunks))


def _windows(names) -> str:
    """(name, first, past): a window holds the days ``first`` back (NULL: all) to before ``past`` back."""
    rows = ", ".join(f"('{w}', {'NULL' if WINDOWS[w].start is None else WINDOWS[w].start}, {WINDOWS[w].end})" for w in dict.fromkeys(names))
    return f"SELECT * FROM (VALUES {rows}) v(name, first, past)"


_IN_WINDOW = "{d} < {od} - w.past AND (w.first IS NULL OR {d} >= {od} - w.first)"


def _pick(value: str, window: str, feature: str, as_type: str) -> str:
    """One window's value out of the long form; nothing in the window is 0."""
    return f"CAST(ifnull(max({value}) FILTER (WHERE name = '{window}'), 0) AS {as_type}) AS {feature_name(feature, window)}"


def _activity_ctes(as_of: dt.date, min_txns: int) -> list:
    """Successes of active merchants by day: single rows, and one row per merchant and day."""
    return [
        ("active", active_list_sql(as_of, min_txns, with_mart=True)),
        (
            "success",
            """
SELECT t.merchant_id, CAST(t.payment_timestamp AS DATE) AS day, t.id, t.payer_vpa_hash AS payer, t.amount
FROM transactions t SEMI JOIN active a ON a.merchant_id = t.merchant_id WHERE t.status = 'SUCCESS'""",
        ),
        (
            "per_day",
            """
SELECT merchant_id, day, sum(amount) AS value, count(DISTINCT payer) AS payers, count(DISTINCT id) AS txns
FROM success GROUP BY ALL""",
        ),
    ]


def _windowed_days(od: str, source: str, keys: str) -> str:
    """Long form over daily rows: per merchant and window, totals, days of the month and daily peaks."""
    return f"""
SELECT {keys}, w.name, sum(d.txns) AS txns, sum(d.value) AS value, count(DISTINCT day(d.day)) AS month_days,
       max(d.value) AS top_value, max(d.txns) AS top_txns, max(d.payers) AS top_payers
FROM {source} JOIN span w ON {_IN_WINDOW.format(d="d.day", od=od)} GROUP BY ALL"""


def _day_columns() -> list[str]:
    cols = [_pick("value", w, "tpv", "DOUBLE") for w in TPV_WINDOWS]
    cols += [_pick("month_days", w, "active_days", "BIGINT") for w in MONTH_WINDOWS]
    cols += [_pick("top_value", w, "max_daily_tpv", "DOUBLE") for w in MONTH_WINDOWS]
    return cols + [_pick("top_txns", w, "max_daily_txns", "BIGINT") for w in MONTH_WINDOWS]


def daily_rollup(as_of: dt.date, min_txns: int) -> str:
    return with_tables(
        "SELECT merchant_id, day AS payment_date, CAST(value AS DOUBLE) AS daily_tpv, payers AS daily_payees, txns AS daily_txns FROM per_day",
        _activity_ctes(as_of, min_txns),
    )


def txn_features_asof(as_of: dt.date, min_txns: int) -> str:
    today = lit_date(as_of)
    cols = [_pick("txns", w, "txn_count", "BIGINT") for w in TXN_WINDOWS] + _day_columns()
    ctes = _activity_ctes(as_of, min_txns) + [
        ("span", _windows(WINDOWS)),
        ("long", _windowed_days(today, "per_day d", "d.merchant_id")),
        ("life", f"SELECT merchant_id, count(*) FILTER (WHERE day < {today}) AS total_active_vintage FROM per_day GROUP BY merchant_id"),
    ]
    body = "SELECT merchant_id, any_value(total_active_vintage) AS total_active_vintage,\n  " + ",\n  ".join(cols)
    return with_tables(body + "\nFROM life LEFT JOIN long USING (merchant_id) GROUP BY merchant_id", ctes)


def payer_features_asof(as_of: dt.date, min_txns: int) -> str:
    cols = [_pick("payers", w, "unique_payers", "BIGINT") for w in PAYER_WINDOWS]
    ctes = _activity_ctes(as_of, min_txns)[:2] + [
        ("span", _windows(PAYER_WINDOWS)),
        ("met", "SELECT DISTINCT merchant_id, payer, day FROM success"),
        (
            "long",
            f"SELECT d.merchant_id, w.name, count(DISTINCT d.payer) AS payers FROM met d JOIN span w ON {_IN_WINDOW.format(d='d.day', od=lit_date(as_of))} GROUP BY ALL",
        ),
    ]
    body = "SELECT merchant_id,\n  " + ",\n  ".join(cols)
    return with_tables(body + "\nFROM (SELECT DISTINCT merchant_id FROM success) s LEFT JOIN long USING (merchant_id) GROUP BY merchant_id", ctes)


def max_daily_payers_asof(as_of: dt.date, min_txns: int) -> str:
    cols = [_pick("top_payers", w, "max_daily_payees", "BIGINT") for w in MONTH_WINDOWS]
    ctes = _activity_ctes(as_of, min_txns) + [("span", _windows(MONTH_WINDOWS)), ("long", _windowed_days(lit_date(as_of), "per_day d", "d.merchant_id"))]
    body = "SELECT merchant_id,\n  " + ",\n  ".join(cols)
    return with_tables(body + "\nFROM (SELECT DISTINCT merchant_id FROM per_day) s LEFT JOIN long USING (merchant_id) GROUP BY merchant_id", ctes)


def txn_features_train(spec: ProductSpec, mode: str = "reference") -> str:
    """Window by window in long form: distinct payers and transactions from the single rows, totals
    and peaks from the daily rows (a total counts once per anchor row, as bags do)."""
    anchors = "SELECT merchant_id, order_date FROM anchor"
    if mode == "earliest":
        anchors = "SELECT merchant_id, min(order_date) AS order_date FROM anchor GROUP BY merchant_id"
    ctes = cohort_ctes(spec) + anchor_ctes(spec) + [
        ("anchored", anchors),
        (
            "success",
            """
SELECT t.merchant_id, CAST(t.payment_timestamp AS DATE) AS day, t.id, t.payer_vpa_hash AS payer, t.amount
FROM transactions t SEMI JOIN member m ON m.merchant_id = t.merchant_id WHERE t.status = 'SUCCESS'""",
        ),
        (
            "per_day",
            """
SELECT merchant_id, day, sum(amount) AS value, count(DISTINCT payer) AS payers, count(DISTINCT id) AS txns
FROM success GROUP BY ALL""",
        ),
        ("span", _windows(WINDOWS)),
        (
            "single",
            f"""
SELECT d.merchant_id, w.name, count(DISTINCT d.payer) AS who, count(DISTINCT d.id) AS ids
FROM success d JOIN (SELECT DISTINCT * FROM anchored) a ON a.merchant_id = d.merchant_id
JOIN span w ON {_IN_WINDOW.format(d="d.day", od="a.order_date")} GROUP BY ALL""",
        ),
        ("daily", _windowed_days("a.order_date", "per_day d JOIN anchored a ON a.merchant_id = d.merchant_id", "d.merchant_id")),
        (
            "life",
            """
SELECT d.merchant_id, count(DISTINCT d.day) FILTER (WHERE d.day < a.order_date) AS total_active_vintage
FROM per_day d JOIN anchored a ON a.merchant_id = d.merchant_id GROUP BY d.merchant_id""",
        ),
        ("long", "SELECT * FROM daily FULL JOIN single USING (merchant_id, name)"),
    ]
    cols = [_pick("who", w, "unique_payers", "BIGINT") for w in PAYER_WINDOWS] + [_pick("ids", w, "txn_count", "BIGINT") for w in TXN_WINDOWS]
    cols += _day_columns() + [_pick("top_payers", w, "max_daily_payees", "BIGINT") for w in MONTH_WINDOWS]
    body = "SELECT merchant_id, any_value(total_active_vintage) AS total_active_vintage,\n  " + ",\n  ".join(cols)
    return with_tables(body + "\nFROM life LEFT JOIN long USING (merchant_id) GROUP BY merchant_id", ctes)


# --- sessions -----------------------------------------------------------------
def _session_ctes(spec: ProductSpec, start: dt.date, end: dt.date) -> list:
    """Anchors of cohort merchants whose mart row was made in [start, end), by mid."""
    return cohort_ctes(spec) + anchor_ctes(spec) + [
        (
            "visitor",
            f"""
SELECT a.merchant_id, d.mid, a.order_date FROM merchant_mart d JOIN anchor a ON a.merchant_id = d.merchant_id
WHERE CAST(d.merchant_created_at AS DATE) BETWEEN {lit_date(start)} AND {lit_date(end)} - 1""",
        )
    ]


def _session_select(spec: ProductSpec, start: dt.date, end: dt.date) -> str:
    """Distinct (merchant, window, session) triples, then counted."""
    if spec.event_pattern:
        found = f"SELECT trim(event_name) FROM app_event WHERE created_at >= {FL(spec)} AND contains(lower(event_name), '{spec.event_pattern.lower()}')"
        ev = f"event_name IN ({found})"
    else:
        ev = f"event_name IN {in_list(spec.events)}"
    return f"""
SELECT merchant_id, count(*) FILTER (WHERE name = 'w1') AS w1_sessions, count(*) FILTER (WHERE name = 'm1') AS m1_sessions
FROM (
  SELECT DISTINCT v.merchant_id, w.name, e.session_id
  FROM (SELECT mid, session_id, CAST(created_at AS DATE) AS day FROM app_event
        WHERE source = 'MerchantApp' AND session_id IS NOT NULL AND {ev}
          AND created_at >= {lit_ts(start)} AND created_at < {lit_ts(end)}) e
  JOIN visitor v ON v.mid = e.mid
  JOIN ({_windows(("w1", "m1"))}) w ON {_IN_WINDOW.format(d="e.day", od="v.order_date")}
) seen GROUP BY merchant_id HAVING bool_or(name = 'w1')"""


def session_features_train(spec: ProductSpec, start: dt.date, end: dt.date) -> str:
    return with_tables(_session_select(spec, start, end), _session_ctes(spec, start, end))


def session_features_years(spec: ProductSpec, years) -> str:
    parts = []
    for y in years:
        s, e = dt.date(y, 1, 1), dt.date(y + 1, 1, 1)
        inner = with_tables(_session_select(spec, s, e), _session_ctes(spec, s, e))
        parts.append(f"SELECT * FROM ({inner}) y{y}")
    union = "\nUNION ALL\n".join(parts)
    return (
        "SELECT merchant_id, CAST(SUM(w1_sessions) AS BIGINT) AS w1_sessions, "
        f"CAST(SUM(m1_sessions) AS BIGINT) AS m1_sessions FROM ({union}) u GROUP BY merchant_id"
    )


def event_name_discovery(pattern: str, floor: dt.date) -> str:
    return with_tables(
        f"SELECT DISTINCT trim(event_name) AS event_name FROM app_event "
        f"WHERE created_at >= {lit_ts(floor)} AND lower(event_name) LIKE '%{pattern.lower()}%'"
    )


def session_features_asof(as_of: dt.date, min_txns: int, products: dict, lookback: int = 31) -> str:
    """Long form: a session counts once per product and day it is seen on."""
    today = lit_date(as_of)
    kinds = "\nUNION ALL\n".join(f"SELECT '{p}' AS product, unnest({'[' + in_list(evs)[1:-1] + ']'}) AS event_name" for p, evs in products.items())
    cols = ", ".join(
        f"count(*) FILTER (WHERE product = '{p}' AND name = '{w}') AS {w}_{p}_sessions" for p in products for w in ("w1", "m1")
    )
    ctes = [
        ("active", active_list_sql(as_of, min_txns, with_mart=True)),
        ("recent", f"SELECT *, CAST(created_at AS DATE) AS day FROM app_event WHERE CAST(created_at AS DATE) >= {today} - {lookback}"),
        ("kind", f"SELECT DISTINCT * FROM ({kinds}) k"),
        ("span", _windows(("w1", "m1"))),
        (
            "seen",
            f"""
SELECT DISTINCT e.mid, k.product, w.name, e.day, e.session_id FROM recent e JOIN kind k USING (event_name)
JOIN span w ON {_IN_WINDOW.format(d="e.day", od=today)} WHERE e.session_id IS NOT NULL""",
        ),
    ]
    return with_tables(
        f"""
SELECT a.merchant_id, {cols} FROM active a JOIN (SELECT DISTINCT mid FROM recent) r USING (mid) LEFT JOIN seen USING (mid)
GROUP BY a.merchant_id, a.mid""",
        ctes,
    )


def _visits_ctes(as_of: dt.date, min_txns: int, lookback: int = 31) -> list:
    """Session rows (not distinct) of active merchants by window."""
    today = lit_date(as_of)
    in_w = lambda w: win("CAST(e.created_at AS DATE)", today, w)
    return [
        ("active", active_list_sql(as_of, min_txns, with_mart=True)),
        (
            "visits",
            f"""
SELECT a.merchant_id, count(e.session_id) FILTER (WHERE {in_w("w1")}) AS w1_sessions,
       count(e.session_id) FILTER (WHERE {in_w("m1")}) AS m1_sessions
FROM active a JOIN app_event e ON e.mid = a.mid AND CAST(e.created_at AS DATE) >= {today} - {lookback}
GROUP BY a.merchant_id, a.mid""",
        ),
    ]


def session_rollup_asof(as_of: dt.date, min_txns: int, lookback: int = 31) -> str:
    return with_tables("SELECT merchant_id, w1_sessions, m1_sessions FROM visits", _visits_ctes(as_of, min_txns, lookback))


# --- profile ------------------------------------------------------------------
def _profile_cols(precisions, vintage_as_of: dt.date | None) -> str:
    cols = ["merchant_id", "mid", "actual_merchant_type"]
    if vintage_as_of is not None:
        cols.append(f"date_diff('day', CAST(merchant_created_at AS DATE), {lit_date(vintage_as_of)}) AS vintage")
    cols += ["area_name", "zone_name", "region_name", "territory_name", "merchant_created_at", "std_category AS business_category"]
    cols += [f"{_geohash('integ_longitude', 'integ_latitude', p)} AS geohash{p}" for p in precisions]
    cols += ["swipe_flag", "speaker_flag", "loan_flag", "fp_flag", "club_flag", "qr_flag", "credit_flag", "debit_flag"]
    cols += ["actual_merchant_type AS merchant_acquisition_channel", "onboarding_date"]
    cols += [
        "lending_eligibility", "lending_eligibility_type", "swipe_eligibility", "fp_eligibility",
        "insurance_eligibility", "club_eligibility", "gl_eligibility", "speaker_eligibility",
    ]
    cols += ["merchant_score", "engagement_score"]
    cols += ["loan_disbursal_date", "loan_closure_date", "swipe_order_date", "speaker_order_date", "club_start_date", "club_end_date"]
    return ",\n  ".join(cols)


def merchant_profile(spec: ProductSpec) -> str:
    body = f"""
SELECT {_profile_cols((6, 3, 4), None)}
FROM merchant_mart
WHERE merchant_id IN (SELECT merchant_id FROM member) AND merchant_created_at >= {FL(spec)}
ORDER BY merchant_id"""
    return with_tables(body, cohort_ctes(spec))


def merchant_profile_asof(as_of: dt.date, min_txns: int) -> str:
    body = f"""
SELECT {_profile_cols((3, 4), as_of)}
FROM merchant_mart
WHERE merchant_created_at >= {FL(FIXTURE_DATE_FLOOR)}
  AND merchant_id IN (SELECT merchant_id FROM active_list)"""
    return with_tables(body, [("active_list", active_list_sql(as_of, min_txns, with_mart=False))])


def vintage(spec: ProductSpec) -> str:
    ctes = [("first_task", first_tasks(spec))] + anchor_ctes(spec, accepted_only=True)
    body = f"""
SELECT dm.merchant_id, date_diff('day', CAST(merchant_created_at AS DATE), so.order_date) AS vintage
FROM merchant_mart dm JOIN anchor so ON so.merchant_id = dm.merchant_id
WHERE merchant_created_at >= {FL(spec)}"""
    return with_tables(body, ctes)


def _norm_manufacturer(c: str) -> str:
    from tillpoint.config import MANUFACTURER_ALIASES

    whens = " ".join(f"WHEN lower({c}) = '{k}' THEN '{v}'" for k, v in MANUFACTURER_ALIASES.items())
    return f"CASE {whens} ELSE lower({c}) END"


def device_manufacturer(spec: ProductSpec) -> str:
    return with_tables(
        "SELECT merchant_id, manufacturer FROM device_info WHERE merchant_id IN (SELECT merchant_id FROM member)",
        cohort_ctes(spec),
    )


def manufacturer_fixed(as_of: dt.date, min_txns: int) -> str:
    from tillpoint.config import MAJOR_BRANDS

    n = _norm_manufacturer("d.manufacturer")
    body = f"""
SELECT a.merchant_id, CASE WHEN {n} IN {in_list(MAJOR_BRANDS)} THEN {n} ELSE 'other' END AS manufacturer
FROM active_list a LEFT JOIN device_info d ON a.merchant_id = d.merchant_id"""
    return with_tables(body, [("active_list", active_list_sql(as_of, min_txns, with_mart=True))])


def manufacturer_topk(spec: ProductSpec, k: int = 20) -> str:
    n = _norm_manufacturer("COALESCE(d.manufacturer, 'Other')")
    ctes = cohort_ctes(spec) + [
        ("dev", f"SELECT m.merchant_id, {n} AS manufacturer FROM member m LEFT JOIN device_info d ON m.merchant_id = d.merchant_id"),
        ("cnt", "SELECT manufacturer, COUNT(*) AS n FROM dev GROUP BY 1"),
        ("top", f"SELECT manufacturer FROM (SELECT manufacturer, ROW_NUMBER() OVER (ORDER BY n DESC, manufacturer ASC) AS r FROM cnt) WHERE r <= {k}"),
    ]
    body = "SELECT merchant_id, CASE WHEN manufacturer IN (SELECT manufacturer FROM top) THEN manufacturer ELSE 'other' END AS manufacturer FROM dev"
    return with_tables(body, ctes)


# --- installed apps -------------------------------------------------------------
def _apps_ctes(as_of: dt.date, min_txns: int, floor: dt.date = FIXTURE_DATE_FLOOR) -> list:
    from tillpoint.config import RELEVANT_APPS

    inner = "trim(substr(app_details, 2, length(app_details) - 2))"
    return [
        ("busy", active_list_sql(as_of, min_txns, with_mart=False)),
        (
            "snap",
            f"""
SELECT merchant_id, app_details FROM app_dump SEMI JOIN busy USING (merchant_id) WHERE date > {lit_date(floor)}
QUALIFY rank() OVER (PARTITION BY merchant_id ORDER BY date DESC) = 1""",
        ),
        (
            "snap_j",
            f"""
SELECT merchant_id, {inner} AS inner_text,
       replace(CASE WHEN {inner} LIKE '[%' THEN {inner} WHEN {inner} LIKE '{{%' THEN '[' || {inner} || ']' END, '''', '"') AS j
FROM snap""",
        ),
        (
            "parsed",
            """
SELECT merchant_id,
       CASE WHEN j IS NULL OR NOT json_valid(j) THEN []::VARCHAR[]
            WHEN inner_text LIKE '{%' AND json_array_length(j) < 2 THEN []::VARCHAR[]
            WHEN len(list_filter(json_extract_string(j, '$[*].appName'), lambda x: x IS NULL)) > 0 THEN []::VARCHAR[]
            ELSE json_extract_string(j, '$[*].appName') END AS app_names
FROM snap_j""",
        ),
        *_visits_ctes(as_of, min_txns),
        (
            "feats",
            f"""
SELECT p.merchant_id, p.app_names,
       CAST(len(list_intersect(p.app_names, {'[' + ', '.join("'" + a + "'" for a in RELEVANT_APPS) + ']'})) AS BIGINT) AS relevant_apps,
       CAST(len(p.app_names) AS BIGINT) AS total_apps, s.w1_sessions
FROM parsed p LEFT JOIN visits s ON p.merchant_id = s.merchant_id""",
        ),
    ]


def latest_app_snapshot(as_of: dt.date, min_txns: int) -> str:
    return with_tables("SELECT merchant_id, app_details FROM snap", _apps_ctes(as_of, min_txns)[:2])


def app_names(as_of: dt.date, min_txns: int) -> str:
    return with_tables(
        "SELECT merchant_id, array_to_string(app_names, '|') AS app_list, CAST(len(app_names) AS BIGINT) AS n_apps FROM parsed",
        _apps_ctes(as_of, min_txns)[:5],
    )


def package_names(as_of: dt.date, min_txns: int) -> str:
    """Same parse, packageName field."""
    ctes = _apps_ctes(as_of, min_txns)[:4] + [
        (
            "parsed_pkg",
            """
SELECT merchant_id,
       CASE WHEN j IS NULL OR NOT json_valid(j) THEN []::VARCHAR[]
            WHEN inner_text LIKE '{%' AND json_array_length(j) < 2 THEN []::VARCHAR[]
            WHEN len(list_filter(json_extract_string(j, '$[*].packageName'), lambda x: x IS NULL)) > 0 THEN []::VARCHAR[]
            ELSE json_extract_string(j, '$[*].packageName') END AS package_names
FROM snap_j""",
        )
    ]
    return with_tables(
        "SELECT merchant_id, array_to_string(package_names, '|') AS package_list, CAST(len(package_names) AS BIGINT) AS n_packages FROM parsed_pkg",
        ctes,
    )


def app_features(as_of: dt.date, min_txns: int) -> str:
    return with_tables(
        "SELECT merchant_id, relevant_apps, total_apps, w1_sessions FROM feats", _apps_ctes(as_of, min_txns)
    )


def app_frequency(as_of: dt.date, min_txns: int) -> str:
    return with_tables(
        "SELECT app, COUNT(*) AS n FROM (SELECT unnest(app_names) AS app FROM feats) GROUP BY app",
        _apps_ctes(as_of, min_txns),
    )


def app_frequency_top5(as_of: dt.date, min_txns: int) -> str:
    return with_tables(
        "SELECT app, COUNT(*) AS n FROM (SELECT unnest(app_names) AS app FROM feats) GROUP BY app ORDER BY n DESC, app ASC LIMIT 5",
        _apps_ctes(as_of, min_txns),
    )


def _bin_sql(col: str) -> str:
    e = f"list_sort(list_distinct((SELECT quantile_cont({col}, [0.0, 0.25, 0.5, 0.75, 1.0]) FROM feats)))"
    k = f"len(list_filter({e}, lambda x: x < CAST({col} AS DOUBLE)))"
    return f"CAST(CASE WHEN {col} IS NOT NULL AND {k} >= 1 AND CAST({col} AS DOUBLE) <= list_extract({e}, len({e})) THEN {k} END AS BIGINT) AS {col}_bin"


def _binned_ctes(as_of: dt.date, min_txns: int) -> list:
    cols = ", ".join(_bin_sql(c) for c in ("w1_sessions", "total_apps", "relevant_apps"))
    return _apps_ctes(as_of, min_txns) + [("binned", f"SELECT merchant_id, w1_sessions, total_apps, relevant_apps, {cols} FROM feats")]


def quartile_bins(as_of: dt.date, min_txns: int) -> str:
    return with_tables("SELECT * FROM binned", _binned_ctes(as_of, min_txns))


def app_session_pivot(as_of: dt.date, min_txns: int) -> str:
    cols = ", ".join(
        f"NULLIF(COUNT(DISTINCT CASE WHEN relevant_apps_bin = {i} THEN merchant_id END), 0) AS relevant_bin_{i}"
        for i in (1, 2, 3, 4)
    )
    return with_tables(
        f"SELECT w1_sessions_bin, {cols} FROM binned WHERE w1_sessions_bin IS NOT NULL AND relevant_apps_bin IS NOT NULL GROUP BY 1",
        _binned_ctes(as_of, min_txns),
    )


def digital_merchants(as_of: dt.date, min_txns: int, min_rel: int, min_w1: int) -> str:
    return with_tables(
        f"SELECT merchant_id FROM feats WHERE relevant_apps >= {min_rel} AND w1_sessions >= {min_w1}",
        _apps_ctes(as_of, min_txns),
    )


def channel_label(as_of: dt.date, min_txns: int, min_rel: int, min_w1: int) -> str:
    ctes = _apps_ctes(as_of, min_txns) + [
        ("digital", f"SELECT merchant_id FROM feats WHERE relevant_apps >= {min_rel} AND w1_sessions >= {min_w1}")
    ]
    return with_tables(
        "SELECT merchant_id, CASE WHEN merchant_id IN (SELECT merchant_id FROM digital) THEN 'Digital' ELSE 'Offline' END AS Channel FROM active",
        ctes,
    )


# --- feature matrices ------------------------------------------------------------
def _geohash(lng: str, lat: str, precision: int) -> str:
    """By text: both cells as binary digits, dealt in turn, and each five digits read as a number."""
    def digits(v: str, least: int, width: int, n: int) -> str:
        cell = f"greatest(0, least({2**n - 1}, CAST(floor(({v} + {-least}) * {float(2**n)} / {width}.0) AS BIGINT)))"
        return f"lpad(bin({cell}), {n}, '0')"

    n = 5 * precision
    east, north = digits(lng, -180, 360, n - n // 2), digits(lat, -90, 180, n // 2)
    dealt = f"array_to_string(list_transform(range({n}), lambda i: substr(CASE WHEN i % 2 = 0 THEN {east} ELSE {north} END, i // 2 + 1, 1)), '')"
    five = " + ".join(f"{2 ** (4 - b)} * CAST(substr({dealt}, 5 * c + {b + 1}, 1) AS INTEGER)" for b in range(5))
    letters = f"list_transform(range({precision}), lambda c: substr('0123456789bcdefghjkmnpqrstuvwxyz', {five} + 1, 1))"
    return f"CASE WHEN {lng} IS NOT NULL AND {lat} IS NOT NULL THEN array_to_string({letters}, '') END"


def compose(ctes: list[tuple[str, str]], body: str) -> str:
    """WITH over self-contained statements (each may carry its own WITH)."""
    return "WITH " + ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes) + "\n" + body


def _no_order(sql: str) -> str:
    i = sql.rfind("ORDER BY")
    return sql[:i] if i > 0 else sql


def _trend_sql() -> str:
    c1, c2 = "(w1_txn_count - w2_txn_count)", "(w2_txn_count - w3_txn_count)"
    return f"CASE WHEN {c1} > 0 AND {c2} > 0 THEN 'up' WHEN {c1} < 0 AND {c2} < 0 THEN 'down' ELSE 'flat' END"


def _ratios_sql() -> str:
    from tillpoint.config import RATIO_FEATURES

    return ",\n  ".join(f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0) AS {name}" for name, n, d in RATIO_FEATURES)


def _geo_cte(src: str) -> tuple[str, str]:
    return (
        "geo",
        f"""
SELECT geohash4, COUNT(DISTINCT merchant_id) AS loc_hash_density,
       COALESCE(SUM(total_tpv), 0.0) AS loc_tpv, COUNT(*) AS loc_rows
FROM {src} WHERE geohash4 IS NOT NULL GROUP BY 1""",
    )


ROLLING = None


def _rolling_cols() -> list[str]:
    from tillpoint.config import ROLLING_FEATURES

    return list(ROLLING_FEATURES)


def training_matrix(spec: ProductSpec, session_spec: ProductSpec, years, mode: str = "reference", drop_nulls: bool = True) -> str:
    from tillpoint.config import CATEGORICAL_FEATURES, RATIO_FEATURES

    order_col = [spec.profile_date_col] if spec.profile_date_col else []
    prof_cols = [
        "actual_merchant_type", "area_name", "zone_name", "region_name", "territory_name",
        "business_category", "merchant_acquisition_channel",
    ] + order_col + ["merchant_created_at", "geohash6", "geohash3", "geohash4"]
    roll = _rolling_cols()
    n = _norm_manufacturer("COALESCE(dev.manufacturer, 'Other')")
    ctes = [
        ("pf", target_label(spec)),
        ("dev", device_manufacturer(spec)),
        ("prof", _no_order(merchant_profile(spec))),
        ("trx", txn_features_train(spec, mode)),
        ("sess", session_features_years(session_spec, years)),
        ("vin", f"SELECT merchant_id, MIN(vintage) AS vintage FROM ({vintage(spec)}) v GROUP BY 1"),
        (
            "m0",
            f"""
SELECT pf.merchant_id, pf.target, {n} AS manufacturer_n,
  {', '.join('prof.' + c for c in prof_cols)},
  {', '.join('trx.' + c for c in roll)},
  sess.w1_sessions, sess.m1_sessions, vin.vintage AS vintage0
FROM pf LEFT JOIN dev ON pf.merchant_id = dev.merchant_id
LEFT JOIN prof ON pf.merchant_id = prof.merchant_id
LEFT JOIN trx ON pf.merchant_id = trx.merchant_id
LEFT JOIN sess ON pf.merchant_id = sess.merchant_id
LEFT JOIN vin ON pf.merchant_id = vin.merchant_id""",
        ),
        ("cnt", "SELECT manufacturer_n, COUNT(*) AS n FROM m0 GROUP BY 1"),
        (
            "top",
            "SELECT manufacturer_n FROM (SELECT manufacturer_n, ROW_NUMBER() OVER (ORDER BY n DESC, manufacturer_n ASC) AS r FROM cnt) t WHERE r <= 20",
        ),
        (
            "m1",
            f"""
SELECT m0.*, {_trend_sql()} AS trend,
  CASE WHEN manufacturer_n IN (SELECT manufacturer_n FROM top) THEN manufacturer_n ELSE 'other' END AS manufacturer
FROM m0""",
        ),
        _geo_cte("m1"),
    ]
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in CATEGORICAL_FEATURES)
    body = f"""
SELECT m1.merchant_id, target, manufacturer, {', '.join('m1.' + c for c in prof_cols)},
  {', '.join(roll)}, w1_sessions, m1_sessions, trend,
  CAST(CASE WHEN vintage0 < 0 THEN 0 ELSE vintage0 END AS BIGINT) AS vintage,
  loc_hash_density, loc_tpv / loc_rows AS loc_hash_atv, loc_tpv AS loc_hash_tpv,
  {_ratios_sql()}
FROM m1 LEFT JOIN geo ON m1.geohash4 = geo.geohash4
WHERE txn_count_90_days IS NOT NULL"""
    if drop_nulls:
        body += f" AND {not_null.replace('geohash4', 'm1.geohash4')}"
    return compose(ctes, body)


def scoring_matrix(as_of: dt.date, min_txns: int, products: dict) -> str:
    from tillpoint.config import MAJOR_BRANDS
    from tillpoint.sources.fixture_sql import CTES

    roll = _rolling_cols()
    payers = [feature_name("unique_payers", w) for w in PAYER_WINDOWS]
    maxpay = [feature_name("max_daily_payees", w) for w in MONTH_WINDOWS]
    trxc = [c for c in roll if c not in payers and c not in maxpay]
    sess = [f"{w}_{p}_sessions" for p in products for w in ("w1", "m1")]
    n = _norm_manufacturer("d.manufacturer")
    ctes = [
        ("device_info", CTES["device_info"]),
        (
            "base",
            "SELECT merchant_id, vintage, zone_name, business_category, geohash4, speaker_eligibility, swipe_eligibility, lending_eligibility "
            f"FROM ({merchant_profile_asof(as_of, min_txns)}) b",
        ),
        ("trx", txn_features_asof(as_of, min_txns)),
        ("pay", payer_features_asof(as_of, min_txns)),
        ("pay2", max_daily_payers_asof(as_of, min_txns)),
        ("app", session_features_asof(as_of, min_txns, products)),
        (
            "m0",
            f"""
SELECT base.*, {', '.join('trx.' + c for c in trxc)}, {', '.join('pay.' + c for c in payers)},
  {', '.join('pay2.' + c for c in maxpay)}, {', '.join('app.' + c for c in sess)}
FROM base LEFT JOIN trx ON base.merchant_id = trx.merchant_id
LEFT JOIN pay ON base.merchant_id = pay.merchant_id
LEFT JOIN pay2 ON base.merchant_id = pay2.merchant_id
LEFT JOIN app ON base.merchant_id = app.merchant_id
WHERE trx.txn_count_90_days IS NOT NULL""",
        ),
        (
            "m1",
            f"""
SELECT m0.*, {_trend_sql()} AS trend,
  CASE WHEN {n} IN {in_list(MAJOR_BRANDS)} THEN {n} ELSE 'other' END AS manufacturer
FROM m0 LEFT JOIN device_info d ON m0.merchant_id = d.merchant_id""",
        ),
        _geo_cte("m1"),
    ]
    body = f"""
SELECT m1.merchant_id, {', '.join(roll)},
  {_ratios_sql()},
  zone_name, business_category, trend, m1.geohash4, CAST(CASE WHEN vintage < 0 THEN 0 ELSE vintage END AS BIGINT) AS vintage, manufacturer,
  loc_hash_density, loc_tpv / loc_rows AS loc_hash_atv, loc_tpv AS loc_hash_tpv,
  {', '.join(sess)}, speaker_eligibility, swipe_eligibility, lending_eligibility
FROM m1 LEFT JOIN geo ON m1.geohash4 = geo.geohash4"""
    return compose(ctes, body)


def over(sql: str, select: str, alias: str = "sm") -> str:
    """SELECT ``select`` FROM (sql) — projections of a composed statement."""
    return f"SELECT {select} FROM (\n{sql}\n) {alias}"


# --- evaluation ------------------------------------------------------------------
def _dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)" if isinstance(x, float) else f"CAST({x} AS DOUBLE)"


def threshold_sweep(thresholds) -> str:
    vals = ", ".join(f"({_dbl(float(t))})" for t in thresholds)
    body = f"""
SELECT t AS threshold,
  CAST(SUM(CASE WHEN prob > t THEN 1 ELSE 0 END) AS BIGINT) AS predicted_positive,
  SUM(CASE WHEN prob > t AND target = 1 THEN 1 ELSE 0 END) / NULLIF(SUM(CASE WHEN prob > t THEN 1 ELSE 0 END), 0) AS precision,
  SUM(CASE WHEN prob > t AND target = 1 THEN 1 ELSE 0 END) / NULLIF(SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END), 0) AS recall
FROM scored, (VALUES {vals}) th(t) GROUP BY t"""
    return with_tables(body)


def confusion_matrix(thresholds) -> str:
    parts = []
    for t in thresholds:
        parts.append(f"""
SELECT {_dbl(float(t))} AS threshold, target, p.predicted,
  CAST(SUM(CASE WHEN CAST(prob > {_dbl(float(t))} AS INTEGER) = p.predicted THEN 1 ELSE 0 END) AS BIGINT) AS n,
  SUM(CASE WHEN CAST(prob > {_dbl(float(t))} AS INTEGER) = p.predicted THEN 1 ELSE 0 END) / COUNT(*) AS rate
FROM scored, (VALUES (0), (1)) p(predicted) GROUP BY target, p.predicted""")
    return with_tables("\nUNION ALL\n".join(parts))


def accuracy(threshold: float) -> str:
    return with_tables(
        f"SELECT {_dbl(threshold)} AS threshold, AVG(CASE WHEN CAST(prob > {_dbl(threshold)} AS INTEGER) = target THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy FROM scored"
    )


def _cum_ctes() -> list:
    return [
        ("per", "SELECT prob AS score, CAST(SUM(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos, CAST(SUM(CASE WHEN target = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg FROM scored GROUP BY prob"),
        ("cum", "SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS cum_pos, SUM(neg) OVER (ORDER BY score DESC) AS cum_neg FROM per"),
        ("tot", "SELECT SUM(pos) AS P, SUM(neg) AS N FROM per"),
    ]


def roc_curve() -> str:
    return with_tables("SELECT score AS threshold, cum_pos / P AS tpr, cum_neg / N AS fpr FROM cum, tot", _cum_ctes())


def roc_auc() -> str:
    return with_tables(
        "SELECT CAST(SUM(neg * (2 * cum_pos - pos)) AS BIGINT) / (2.0 * MAX(P) * MAX(N)) AS auc FROM cum, tot", _cum_ctes()
    )


def score_histogram(bins: int = 10) -> str:
    b = float(bins)
    body = f"""
s AS (SELECT MIN(prob) AS lo, MAX(prob) AS hi FROM scored),
b AS (SELECT LEAST(CAST(FLOOR((prob - lo) / (hi - lo) * {b}) AS INTEGER), {bins - 1}) + 1 AS bin FROM scored, s WHERE prob IS NOT NULL),
g AS (SELECT CAST(range AS INTEGER) + 1 AS bin FROM range({bins}))
SELECT g.bin, lo + (hi - lo) / {b} * CAST(g.bin - 1 AS DOUBLE) AS lo, lo + (hi - lo) / {b} * CAST(g.bin AS DOUBLE) AS hi,
  CAST(COUNT(b.bin) AS BIGINT) AS n
FROM g CROSS JOIN s LEFT JOIN b ON g.bin = b.bin GROUP BY g.bin, s.lo, s.hi"""
    from tillpoint.sources.fixture_sql import CTES

    return "WITH scored AS (" + CTES["scored"] + "\n),\n" + body


# --- scoring business layer -------------------------------------------------------
def _pseudo(sm_sql: str) -> str:
    return f"""
SELECT *, CAST(merchant_id * 7919 % 1000 AS DOUBLE) / 1000.0 AS prob_loan,
          CAST(merchant_id * 104729 % 1000 AS DOUBLE) / 1000.0 AS prob_swipe,
          CAST(merchant_id * 1299709 % 1000 AS DOUBLE) / 1000.0 AS prob_speaker
FROM ({sm_sql}) sm0"""


def _ltv_sql(sm_sql: str) -> str:
    avg = "((m1_tpv + m2_tpv) / CAST(2.0 AS DOUBLE))"
    d = lambda x: f"CAST({x} AS DOUBLE)"
    loan = f"{d(6.0)} * {d(0.12)} * ({d(0.5)} * {avg} * {d(2.0)}) * prob_loan * lending_eligibility"
    speaker = f"{d(12.0)} * {d(120.0)} * prob_speaker * speaker_eligibility"
    swipe = f"{avg} * {d(12.0)} * {d(0.02)} * prob_swipe * swipe_eligibility"
    inner = f"SELECT *, {loan} AS loan_ltv, {speaker} AS speaker_ltv, {swipe} AS swipe_ltv FROM ({_pseudo(sm_sql)}) p"
    return f"SELECT *, loan_ltv + speaker_ltv + swipe_ltv AS mltv FROM ({inner}) l"


def ltv(sm_sql: str) -> str:
    return f"SELECT merchant_id, loan_ltv, speaker_ltv, swipe_ltv, mltv FROM ({_ltv_sql(sm_sql)}) x"


def recommendation_order(sm_sql: str) -> str:
    from tillpoint.config import RANK_ORDER, THRESHOLDS

    m = {p: f"(prob_{p} - {_dbl(float(THRESHOLDS[p]))})" for p in RANK_ORDER}
    rank = {}
    for i, p in enumerate(RANK_ORDER):
        terms = []
        for j, o in enumerate(RANK_ORDER):
            if o == p:
                continue
            cond = f"{m[o]} > {m[p]}" + (f" OR {m[o]} = {m[p]}" if j < i else "")
            terms.append(f"CASE WHEN {cond} THEN 1 ELSE 0 END")
        rank[p] = "1 + " + " + ".join(terms)
    picks = []
    for r in range(1, len(RANK_ORDER) + 1):
        whens = " ".join(f"WHEN {rank[p]} = {r} THEN '{p}'" for p in RANK_ORDER)
        picks.append(f"CASE {whens} END AS p{r}_recommendation")
    return f"SELECT merchant_id, prob_loan, prob_swipe, prob_speaker, {', '.join(picks)} FROM ({_pseudo(sm_sql)}) p"


def iqr_trim(sm_sql: str) -> str:
    return f"""
WITH t AS (SELECT merchant_id, 0.5 * (m1_tpv + m2_tpv) AS m1_m2_avg_tpv FROM ({sm_sql}) sm0),
q AS (SELECT quantile_cont(m1_m2_avg_tpv, 0.25) AS q1, quantile_cont(m1_m2_avg_tpv, 0.75) AS q3 FROM t)
SELECT merchant_id, m1_m2_avg_tpv FROM t, q
WHERE m1_m2_avg_tpv >= q1 - 3.0 * (q3 - q1) AND m1_m2_avg_tpv <= q3 + 3.0 * (q3 - q1)"""


def max_ltv_rows(sm_sql: str) -> str:
    return f"""
WITH l AS ({_ltv_sql(sm_sql)})
SELECT merchant_id, loan_ltv FROM l WHERE loan_ltv = (SELECT MAX(loan_ltv) FROM l)"""


# --- EDA over the training matrix --------------------------------------------------
def rate_by_category(tm_sql: str, cols, label: str = "target") -> str:
    parts = [
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, 100.0 * AVG({label}) AS propensity, "
        f"COUNT(merchant_id) AS n_merchants FROM tm WHERE {c} IS NOT NULL GROUP BY 2"
        for c in cols
    ]
    return compose([("tm", tm_sql)], "\nUNION ALL\n".join(parts))


def column_quartiles(tm_sql: str, cols) -> str:
    qn = (("min", 0.0), ("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("max", 1.0))
    parts = [
        f"SELECT '{c}' AS feature, " + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {q}) AS {n}" for n, q in qn) + " FROM tm"
        for c in cols
    ]
    return compose([("tm", tm_sql)], "\nUNION ALL\n".join(parts))


def rate_by_quartile_bin(tm_sql: str, cols, label: str = "target") -> str:
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        qs = ", ".join(f"CAST(CAST(trunc(quantile_cont({v}, {q})) AS BIGINT) AS DOUBLE)" for q in (0.0, 0.25, 0.5, 0.75, 1.0))
        e = f"(SELECT list_sort(list_distinct([CAST(-0.01 AS DOUBLE), {qs}])) FROM tm)"
        k = f"len(list_filter({e}, lambda x: x < {v}))"
        idx = f"CASE WHEN {v} IS NOT NULL AND {k} >= 1 AND {v} <= list_extract({e}, len({e})) THEN {k} END"
        parts.append(
            f"""SELECT '{c}' AS feature, CAST(bin AS BIGINT) AS bin, list_extract(e, bin) AS lo, list_extract(e, bin + 1) AS hi,
  100.0 * AVG({label}) AS propensity, COUNT(merchant_id) AS n_merchants
FROM (SELECT merchant_id, {label}, {idx} AS bin, {e} AS e FROM tm) b WHERE bin IS NOT NULL GROUP BY bin, e"""
        )
    return compose([("tm", tm_sql)], "\nUNION ALL\n".join(parts))


def rate_by_top_category(tm_sql: str, col: str, k: int) -> str:
    return compose(
        [
            ("tm", tm_sql),
            ("d", f"SELECT merchant_id, target, COALESCE(CAST({col} AS VARCHAR), 'nan') AS category FROM tm"),
            ("top", f"SELECT category FROM (SELECT category, COUNT(*) AS c FROM d GROUP BY 1) t ORDER BY c DESC, category ASC LIMIT {k}"),
        ],
        "SELECT category, 100.0 * AVG(target) AS propensity, COUNT(merchant_id) AS n_merchants FROM d WHERE category IN (SELECT category FROM top) GROUP BY 1",
    )


def column_modes(sm_sql: str, cols) -> str:
    parts = [
        f"SELECT * FROM (SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS mode FROM sm WHERE {c} IS NOT NULL "
        f"GROUP BY {c} ORDER BY COUNT(*) DESC, {c} ASC LIMIT 1) m_{c}"
        for c in cols
    ]
    return compose([("sm", sm_sql)], "\nUNION ALL\n".join(parts))


def activity_features_asof(as_of: dt.date, min_txns: int) -> str:
    """The three as-of families joined per merchant."""
    payers = [feature_name("unique_payers", w) for w in PAYER_WINDOWS]
    maxpay = [feature_name("max_daily_payees", w) for w in MONTH_WINDOWS]
    return compose(
        [
            ("t", txn_features_asof(as_of, min_txns)),
            ("p", payer_features_asof(as_of, min_txns)),
            ("p2", max_daily_payers_asof(as_of, min_txns)),
        ],
        "SELECT t.*, " + ", ".join("p." + c for c in payers) + ", " + ", ".join("p2." + c for c in maxpay)
        + " FROM t JOIN p ON t.merchant_id = p.merchant_id JOIN p2 ON t.merchant_id = p2.merchant_id",
    )


# --- the scoring side by product -----------------------------------------------------
def with_flags(sm_sql: str) -> str:
    from tillpoint.sources.fixture_sql import CTES

    return compose(
        [("sm", sm_sql), ("mart", CTES["merchant_mart"])],
        "SELECT sm.*, swipe_flag, speaker_flag, loan_flag FROM sm LEFT JOIN mart ON mart.merchant_id = sm.merchant_id",
    )


def by_product(statement, products) -> str:
    """``statement(flag column)`` for every product, one below the other."""
    return "\nUNION ALL\n".join(f"SELECT '{p}' AS product, x.* FROM (\n{statement(f'{p}_flag')}\n) x" for p in products)


# --- all six products -----------------------------------------------------------------
def product_cohorts(catalogue: dict[str, ProductSpec], days: int) -> str:
    def count(sql: str) -> str:
        return f"(SELECT count(*) FROM ({sql}) q)"

    return "\nUNION ALL\n".join(
        f"SELECT '{p}' AS product, {count(applied_merchants(s))} AS applied, {count(pushed_merchants(s))} AS pushed, "
        f"{count(cohort_union(s))} AS cohort, {count(push_converted(s, days))} AS converted"
        for p, s in catalogue.items()
    )


def product_anchors(catalogue: dict[str, ProductSpec]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{p}' AS product, merchant_id, order_date FROM ({anchor_dates(s, 'reference')}) q" for p, s in catalogue.items()
    )


# --- rows that a CSV copy rejects -------------------------------------------------------
def csv_applications() -> str:
    stamp = "strftime(created_at, '%Y-%m-%dT%H:%M:%S')"
    return with_tables(f"""
SELECT 'row' AS kind, merchant_id, created_at, agreement_at, status, CAST(NULL AS VARCHAR) AS record FROM application_loan
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, NULL, CAST(merchant_id AS VARCHAR) || ',on ' || {stamp} || ',,' || status
FROM application_loan WHERE merchant_id % 5 = 0
UNION ALL
SELECT 'rejected', NULL, NULL, NULL, NULL, 'M' || CAST(merchant_id AS VARCHAR) || ',' || {stamp} || ',,' || status
FROM application_loan WHERE merchant_id % 7 = 0""")


# --- matrices with holes ------------------------------------------------------------------
def holed(sql: str) -> str:
    return f"""
SELECT * REPLACE (CASE WHEN merchant_id % 7 <> 0 THEN business_category END AS business_category,
  CASE WHEN merchant_id % 11 <> 0 THEN geohash4 END AS geohash4,
  CASE WHEN merchant_id % 4 <> 1 THEN manufacturer END AS manufacturer) FROM ({sql}) h"""


def imputed(sm_sql: str, cols) -> str:
    modes = {c: f"(SELECT {c} FROM sm WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in cols}
    return compose([("sm", sm_sql)], "SELECT merchant_id, " + ", ".join(f"coalesce({c}, {m}) AS {c}" for c, m in modes.items()) + " FROM sm")
