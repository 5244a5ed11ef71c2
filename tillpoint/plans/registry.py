"""Registry of named queries: Spark plan + (optional) DuckDB oracle SQL.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built on the
logical tables of the driver's parquet at ``sf_dir``.  Entries without an
oracle are checked by row count only (model training / scoring, sampling).
"""

from __future__ import annotations

from collections.abc import Callable
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.config import FIXTURE_ACTIVE_MIN_TXNS as MIN_TXNS
from tillpoint.config import FIXTURE_AS_OF as AS_OF
from tillpoint.config import FIXTURE_SPEC as SPEC
import dataclasses

from tillpoint.config import FIXTURE_CATALOGUE as CATALOGUE
from tillpoint.config import FIXTURE_DATE_FLOOR, FIXTURE_PRODUCTS, FIXTURE_SESSION_RANGE
from tillpoint.config import FIXTURE_CHANNEL_MIN_RELEVANT_APPS as MIN_REL
from tillpoint.config import FIXTURE_CHANNEL_MIN_W1_SESSIONS as MIN_W1
from tillpoint.config import CATEGORICAL_FEATURES, SWEEP_THRESHOLDS
from tillpoint.operators import apps, cohort, eda, evaluate, features, ml, profile, rolling, score, sessions
from tillpoint.session import checkpoint_dir
from tillpoint.sources.sinks import stage
from tillpoint.plans import oracle, scoring
from tillpoint.sources.tables import Tables


@dataclass
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: Callable[[], str] | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: Callable[[], str] | None):
    def deco(fn):
        REGISTRY[name] = Entry(fn, sql)
        return fn

    return deco


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables.from_fixture(spark, sf_dir)


# --- cohorts --------------------------------------------------------------
@register("pushed_merchants", lambda: oracle.pushed_merchants(SPEC))
def q_pushed(spark, sf):
    return cohort.pushed_merchants(_t(spark, sf), SPEC)


@register("applied_merchants", lambda: oracle.applied_merchants(SPEC))
def q_applied(spark, sf):
    return cohort.applied_merchants(_t(spark, sf), SPEC)


@register("cohort_union", lambda: oracle.cohort_union(SPEC))
def q_cohort_union(spark, sf):
    return cohort.cohort_union(_t(spark, sf), SPEC)


@register("applied_not_pushed", lambda: oracle.applied_not_pushed(SPEC))
def q_applied_not_pushed(spark, sf):
    return cohort.applied_not_pushed(_t(spark, sf), SPEC)


@register("target_label", lambda: oracle.target_label(SPEC))
def q_target_label(spark, sf):
    return cohort.target_label(_t(spark, sf), SPEC)


@register("first_task_date", lambda: oracle.first_task_date(SPEC))
def q_first_task_date(spark, sf):
    return cohort.first_task_date(_t(spark, sf), SPEC)


@register("anchor_dates", lambda: oracle.anchor_dates(SPEC, "reference"))
def q_anchor_dates(spark, sf):
    return cohort.anchor_dates(_t(spark, sf), SPEC, mode="reference")


@register("anchor_dates_earliest", lambda: oracle.anchor_dates(SPEC, "earliest"))
def q_anchor_dates_earliest(spark, sf):
    return cohort.anchor_dates(_t(spark, sf), SPEC, mode="earliest")


@register("push_converted_7d", lambda: oracle.push_converted(SPEC, 7))
def q_push_converted_7d(spark, sf):
    return cohort.push_converted(_t(spark, sf), SPEC, days=7)


@register("push_converted_60d", lambda: oracle.push_converted(SPEC, 60))
def q_push_converted_60d(spark, sf):
    return cohort.push_converted(_t(spark, sf), SPEC, days=60)


@register("active_merchants", lambda: oracle.active_merchants(AS_OF, MIN_TXNS))
def q_active(spark, sf):
    return cohort.active_merchants(_t(spark, sf), AS_OF, min_txns=MIN_TXNS)


@register("active_merchants_mart", lambda: oracle.active_merchants(AS_OF, MIN_TXNS, with_mart=True))
def q_active_mart(spark, sf):
    return cohort.active_merchants(_t(spark, sf), AS_OF, min_txns=MIN_TXNS, with_mart=True)


@register("chunk_union_equivalence", lambda: oracle.chunk_union(AS_OF, 10))
def q_chunk_union(spark, sf):
    tx = _t(spark, sf).transactions.filter(F.col("status") == "SUCCESS")
    return cohort.chunked_ids(tx, 10).groupBy("merchant_id").agg(F.count(F.lit(1)).alias("n_txns"))


# --- rolling features -------------------------------------------------------
@register("daily_rollup", lambda: oracle.daily_rollup(AS_OF, MIN_TXNS))
def q_daily_rollup(spark, sf):
    return rolling.daily_rollup_active(_t(spark, sf), AS_OF, MIN_TXNS)


@register("txn_features_asof", lambda: oracle.txn_features_asof(AS_OF, MIN_TXNS))
def q_txn_features_asof(spark, sf):
    return rolling.txn_features_asof(_t(spark, sf), AS_OF, MIN_TXNS)


@register("activity_features_asof", lambda: oracle.activity_features_asof(AS_OF, MIN_TXNS))
def q_activity_features_asof(spark, sf):
    return rolling.activity_features_asof(_t(spark, sf), AS_OF, MIN_TXNS)


@register("payer_features_asof", lambda: oracle.payer_features_asof(AS_OF, MIN_TXNS))
def q_payer_features_asof(spark, sf):
    return rolling.payer_features_asof(_t(spark, sf), AS_OF, MIN_TXNS)


@register("max_daily_payers_asof", lambda: oracle.max_daily_payers_asof(AS_OF, MIN_TXNS))
def q_max_daily_payers_asof(spark, sf):
    return rolling.max_daily_payers_asof(_t(spark, sf), AS_OF, MIN_TXNS)


@register("txn_features_train", lambda: oracle.txn_features_train(SPEC, "reference"))
def q_txn_features_train(spark, sf):
    return rolling.txn_features_train(_t(spark, sf), SPEC, anchor_mode="reference")


@register("txn_features_train_earliest", lambda: oracle.txn_features_train(SPEC, "earliest"))
def q_txn_features_train_earliest(spark, sf):
    return rolling.txn_features_train(_t(spark, sf), SPEC, anchor_mode="earliest")


# --- sessions -------------------------------------------------------------------
SESSION_SPEC = dataclasses.replace(SPEC, application_table="application_recent")
PATTERN_SPEC = dataclasses.replace(SESSION_SPEC, event_pattern="i")
PRODUCT_EVENTS = {name: spec.events for name, spec in FIXTURE_PRODUCTS.items()}
S0, S1 = FIXTURE_SESSION_RANGE


@register("session_features_train", lambda: oracle.session_features_train(SESSION_SPEC, S0, S1))
def q_session_features_train(spark, sf):
    return sessions.session_features_train(_t(spark, sf), SESSION_SPEC, S0, S1, anchor_mode="reference")


@register("session_features_pattern", lambda: oracle.session_features_train(PATTERN_SPEC, S0, S1))
def q_session_features_pattern(spark, sf):
    return sessions.session_features_train(_t(spark, sf), PATTERN_SPEC, S0, S1, anchor_mode="reference")


@register("session_features_years", lambda: oracle.session_features_years(SESSION_SPEC, (2000, 2001)))
def q_session_features_years(spark, sf):
    return sessions.session_features_years(_t(spark, sf), SESSION_SPEC, (2000, 2001), anchor_mode="reference")


@register("event_name_discovery", lambda: oracle.event_name_discovery("i", FIXTURE_DATE_FLOOR))
def q_event_name_discovery(spark, sf):
    return sessions.event_name_discovery(_t(spark, sf), "i", FIXTURE_DATE_FLOOR)


@register("session_features_asof", lambda: oracle.session_features_asof(AS_OF, MIN_TXNS, PRODUCT_EVENTS))
def q_session_features_asof(spark, sf):
    return sessions.session_features_asof(_t(spark, sf), AS_OF, PRODUCT_EVENTS, MIN_TXNS)


@register("session_rollup_asof", lambda: oracle.session_rollup_asof(AS_OF, MIN_TXNS))
def q_session_rollup_asof(spark, sf):
    return sessions.session_rollup_asof(_t(spark, sf), AS_OF, MIN_TXNS)


# --- profile ---------------------------------------------------------------------
@register("merchant_profile", lambda: oracle.merchant_profile(SPEC))
def q_merchant_profile(spark, sf):
    return profile.merchant_profile(_t(spark, sf), SPEC, ordered=True)


@register("merchant_profile_asof", lambda: oracle.merchant_profile_asof(AS_OF, MIN_TXNS))
def q_merchant_profile_asof(spark, sf):
    return profile.merchant_profile_asof(_t(spark, sf), AS_OF, MIN_TXNS)


@register("vintage", lambda: oracle.vintage(SPEC))
def q_vintage(spark, sf):
    return profile.vintage(_t(spark, sf), SPEC)


@register("device_manufacturer", lambda: oracle.device_manufacturer(SPEC))
def q_device_manufacturer(spark, sf):
    t = _t(spark, sf)
    return profile.device_manufacturer(t, cohort.cohort_union(t, SPEC))


@register("manufacturer_fixed", lambda: oracle.manufacturer_fixed(AS_OF, MIN_TXNS))
def q_manufacturer_fixed(spark, sf):
    t = _t(spark, sf)
    base = cohort.active_merchants(t, AS_OF, min_txns=MIN_TXNS, with_mart=True).select("merchant_id")
    return profile.manufacturer_fixed(base.join(t.device_info, "merchant_id", "left")).select("merchant_id", "manufacturer")


@register("manufacturer_topk", lambda: oracle.manufacturer_topk(SPEC))
def q_manufacturer_topk(spark, sf):
    t = _t(spark, sf)
    base = cohort.cohort_union(t, SPEC).join(t.device_info, "merchant_id", "left")
    return profile.manufacturer_topk(base).select("merchant_id", "manufacturer")


# --- installed apps -----------------------------------------------------------------
def _app_feats(spark, sf):
    return apps.app_features(_t(spark, sf), AS_OF, MIN_TXNS)


@register("latest_app_snapshot", lambda: oracle.latest_app_snapshot(AS_OF, MIN_TXNS))
def q_latest_app_snapshot(spark, sf):
    return apps.latest_app_snapshot(_t(spark, sf), AS_OF, MIN_TXNS)


@register("app_names", lambda: oracle.app_names(AS_OF, MIN_TXNS))
def q_app_names(spark, sf):
    snap = apps.app_names(apps.latest_app_snapshot(_t(spark, sf), AS_OF, MIN_TXNS))
    return snap.select(
        "merchant_id",
        F.array_join("app_names", "|").alias("app_list"),
        F.size("app_names").cast("bigint").alias("n_apps"),
    )


@register("package_names", lambda: oracle.package_names(AS_OF, MIN_TXNS))
def q_package_names(spark, sf):
    snap = apps.package_names(apps.latest_app_snapshot(_t(spark, sf), AS_OF, MIN_TXNS))
    return snap.select(
        "merchant_id",
        F.array_join("package_names", "|").alias("package_list"),
        F.size("package_names").cast("bigint").alias("n_packages"),
    )


@register("app_features", lambda: oracle.app_features(AS_OF, MIN_TXNS))
def q_app_features(spark, sf):
    return _app_feats(spark, sf).select("merchant_id", "relevant_apps", "total_apps", "w1_sessions")


@register("app_frequency", lambda: oracle.app_frequency(AS_OF, MIN_TXNS))
def q_app_frequency(spark, sf):
    return apps.app_frequency(_app_feats(spark, sf))


@register("app_frequency_top5", lambda: oracle.app_frequency_top5(AS_OF, MIN_TXNS))
def q_app_frequency_top5(spark, sf):
    return apps.top_apps(apps.app_frequency(_app_feats(spark, sf)), 5)


@register("quartile_bins", lambda: oracle.quartile_bins(AS_OF, MIN_TXNS))
def q_quartile_bins(spark, sf):
    b = apps.quartile_bins(_app_feats(spark, sf))
    return b.select("merchant_id", "w1_sessions", "total_apps", "relevant_apps", "w1_sessions_bin", "total_apps_bin", "relevant_apps_bin")


@register("app_session_pivot", lambda: oracle.app_session_pivot(AS_OF, MIN_TXNS))
def q_app_session_pivot(spark, sf):
    return apps.app_session_pivot(apps.quartile_bins(_app_feats(spark, sf)))


@register("digital_merchants", lambda: oracle.digital_merchants(AS_OF, MIN_TXNS, MIN_REL, MIN_W1))
def q_digital_merchants(spark, sf):
    return apps.digital_merchants(_app_feats(spark, sf), min_relevant=MIN_REL, min_w1=MIN_W1)


@register("channel_label", lambda: oracle.channel_label(AS_OF, MIN_TXNS, MIN_REL, MIN_W1))
def q_channel_label(spark, sf):
    t = _t(spark, sf)
    feats = apps.app_features(t, AS_OF, MIN_TXNS)
    base = cohort.active_merchants(t, AS_OF, min_txns=MIN_TXNS, with_mart=True).select("merchant_id")
    return apps.channel_label(base, apps.digital_merchants(feats, min_relevant=MIN_REL, min_w1=MIN_W1))


# --- feature matrices ---------------------------------------------------------------
TRAIN_YEARS = (2000, 2001)


def _train_matrix(spark, sf):
    return features.training_matrix(_t(spark, sf), SPEC, SESSION_SPEC, TRAIN_YEARS, anchor_mode="reference")


def _score_matrix(spark, sf):
    return features.scoring_matrix(_t(spark, sf), AS_OF, PRODUCT_EVENTS, MIN_TXNS)


def _train_sql():
    return oracle.training_matrix(SPEC, SESSION_SPEC, TRAIN_YEARS)


def _score_sql():
    return oracle.scoring_matrix(AS_OF, MIN_TXNS, PRODUCT_EVENTS)


@register("training_matrix", _train_sql)
def q_training_matrix(spark, sf):
    return _train_matrix(spark, sf)


@register("scoring_matrix", _score_sql)
def q_scoring_matrix(spark, sf):
    return _score_matrix(spark, sf)


@register("trend_label", lambda: oracle.over(_score_sql(), "merchant_id, w1_txn_count, w2_txn_count, w3_txn_count, trend"))
def q_trend_label(spark, sf):
    return _score_matrix(spark, sf).select("merchant_id", "w1_txn_count", "w2_txn_count", "w3_txn_count", "trend")


RATIO_COLS = ", ".join(r[0] for r in __import__("tillpoint.config", fromlist=["RATIO_FEATURES"]).RATIO_FEATURES)


@register("ratio_features", lambda: oracle.over(_score_sql(), "merchant_id, " + RATIO_COLS))
def q_ratio_features(spark, sf):
    return _score_matrix(spark, sf).select("merchant_id", *RATIO_COLS.split(", "))


@register("location_features", lambda: oracle.over(_score_sql(), "merchant_id, geohash4, loc_hash_density, loc_hash_atv, loc_hash_tpv"))
def q_location_features(spark, sf):
    return _score_matrix(spark, sf).select("merchant_id", "geohash4", "loc_hash_density", "loc_hash_atv", "loc_hash_tpv")


def _holed(df: DataFrame) -> DataFrame:
    """A view of a matrix that lacks some categoricals (the fixture's merchants all have theirs)."""
    k = F.col("merchant_id")
    return df.withColumns({
        "business_category": F.when(k % 7 != 0, F.col("business_category")),
        "geohash4": F.when(k % 11 != 0, F.col("geohash4")),
        "manufacturer": F.when(k % 4 != 1, F.col("manufacturer")),
    })


@register("drop_null_categoricals", lambda: oracle.over(
    oracle.holed(oracle.training_matrix(SPEC, SESSION_SPEC, TRAIN_YEARS, drop_nulls=False)), "merchant_id, target"
) + " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in CATEGORICAL_FEATURES))
def q_drop_null_categoricals(spark, sf):
    m = features.training_matrix(_t(spark, sf), SPEC, SESSION_SPEC, TRAIN_YEARS, anchor_mode="reference", drop_nulls=False)
    return features.drop_null_categoricals(_holed(m)).select("merchant_id", "target")


@register("mode_impute", lambda: oracle.imputed(oracle.holed(_score_sql()), CATEGORICAL_FEATURES))
def q_mode_impute(spark, sf):
    return features.mode_impute(stage(_holed(_score_matrix(spark, sf)))).select("merchant_id", *CATEGORICAL_FEATURES)


@register("column_modes", lambda: oracle.column_modes(oracle.holed(_score_sql()), CATEGORICAL_FEATURES))
def q_column_modes(spark, sf):
    return features.column_modes(_holed(_score_matrix(spark, sf)))


# --- evaluation (on the scored fixture: target + probability per merchant) ------
def _scored(spark, sf):
    return _t(spark, sf).scored


@register("threshold_sweep", lambda: oracle.threshold_sweep(SWEEP_THRESHOLDS))
def q_threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(_scored(spark, sf))


@register("confusion_matrix", lambda: oracle.confusion_matrix((0.75, 0.5)))
def q_confusion_matrix(spark, sf):
    s = _scored(spark, sf)
    return evaluate.confusion_matrix(s, 0.75).unionByName(evaluate.confusion_matrix(s, 0.5))


@register("accuracy", lambda: oracle.accuracy(0.85))
def q_accuracy(spark, sf):
    return evaluate.accuracy(_scored(spark, sf), 0.85)


@register("roc_curve", oracle.roc_curve)
def q_roc_curve(spark, sf):
    return evaluate.roc_curve(_scored(spark, sf))


@register("roc_auc", oracle.roc_auc)
def q_roc_auc(spark, sf):
    return evaluate.roc_auc(_scored(spark, sf))


@register("score_histogram", lambda: oracle.score_histogram(10))
def q_score_histogram(spark, sf):
    return score.histogram(_scored(spark, sf), "prob", 10)


# --- scoring business layer (model-free stand-in scores) -------------------------
def _scored_matrix(spark, sf):
    return features.with_pseudo_scores(stage(_score_matrix(spark, sf)))


@register("ltv", lambda: oracle.ltv(_score_sql()))
def q_ltv(spark, sf):
    return score.with_ltv(_scored_matrix(spark, sf)).select("merchant_id", "loan_ltv", "speaker_ltv", "swipe_ltv", "mltv")


@register("recommendation_order", lambda: oracle.recommendation_order(_score_sql()))
def q_recommendation_order(spark, sf):
    r = score.with_recommendation(_scored_matrix(spark, sf))
    return r.select("merchant_id", "prob_loan", "prob_swipe", "prob_speaker", "p1_recommendation", "p2_recommendation", "p3_recommendation")


@register("iqr_trim", lambda: oracle.iqr_trim(_score_sql()))
def q_iqr_trim(spark, sf):
    return score.iqr_trim(stage(_score_matrix(spark, sf))).select("merchant_id", "m1_m2_avg_tpv")


@register("max_ltv_rows", lambda: oracle.max_ltv_rows(_score_sql()))
def q_max_ltv_rows(spark, sf):
    return score.max_rows(score.with_ltv(_scored_matrix(spark, sf)), "loan_ltv").select("merchant_id", "loan_ltv")


# --- EDA over the (staged) training matrix -------------------------------------------
def _tm(spark, sf):
    return stage(_train_matrix(spark, sf))


@register("rate_by_category", lambda: oracle.rate_by_category(_train_sql(), eda.CATEGORY_EDA_COLS))
def q_rate_by_category(spark, sf):
    return eda.rate_by_category(_tm(spark, sf))


@register("column_quartiles", lambda: oracle.column_quartiles(_train_sql(), eda.NUMERIC_EDA_COLS))
def q_column_quartiles(spark, sf):
    return eda.column_quartiles(_tm(spark, sf))


@register("rate_by_quartile_bin", lambda: oracle.rate_by_quartile_bin(_train_sql(), eda.NUMERIC_EDA_COLS))
def q_rate_by_quartile_bin(spark, sf):
    return eda.rate_by_quartile_bin(_tm(spark, sf))


@register("rate_by_top_geohash", lambda: oracle.rate_by_top_category(_train_sql(), "geohash4", 50))
def q_rate_by_top_geohash(spark, sf):
    return eda.rate_by_top_category(_tm(spark, sf), "geohash4", 50)


@register("target_balance", lambda: oracle.over(oracle.target_label(SPEC), "target, COUNT(*) AS n") + " GROUP BY target")
def q_target_balance(spark, sf):
    return eda.value_counts(cohort.target_label(_t(spark, sf), SPEC), "target")


# --- the scoring side by product flag ---------------------------------------------------
FLAG_LABELS = {p: f"{p}_flag" for p in ("swipe", "speaker", "loan")}


def _flagged(spark, sf):
    return scoring.with_flags(_t(spark, sf), _score_matrix(spark, sf))


@register("scoring_rate_by_category", lambda: oracle.by_product(
    lambda flag: oracle.rate_by_category(oracle.with_flags(_score_sql()), eda.SCORING_CATEGORY_COLS, flag), FLAG_LABELS))
def q_scoring_rate_by_category(spark, sf):
    return eda.rate_by_category(_flagged(spark, sf), eda.SCORING_CATEGORY_COLS, labels=FLAG_LABELS)


@register("scoring_rate_by_quartile_bin", lambda: oracle.by_product(
    lambda flag: oracle.rate_by_quartile_bin(oracle.with_flags(_score_sql()), eda.SCORING_EDA_COLS, flag), FLAG_LABELS))
def q_scoring_rate_by_quartile_bin(spark, sf):
    return eda.rate_by_quartile_bin(_flagged(spark, sf), eda.SCORING_EDA_COLS, labels=FLAG_LABELS)


@register("product_flags", lambda: oracle.over(oracle.with_flags(_score_sql()), "merchant_id, swipe_flag, speaker_flag, loan_flag"))
def q_product_flags(spark, sf):
    return _flagged(spark, sf).select("merchant_id", *scoring.FLAG_COLS)


# --- all six products, each on its own application table -----------------------------------
@register("product_cohorts", lambda: oracle.product_cohorts(CATALOGUE, 60))
def q_product_cohorts(spark, sf):
    t = _t(spark, sf)
    rows = []
    for p, s in CATALOGUE.items():
        plans = {
            "applied": cohort.applied_merchants(t, s),
            "pushed": cohort.pushed_merchants(t, s),
            "cohort": cohort.cohort_union(t, s),
            "converted": cohort.push_converted(t, s, 60),
        }
        rows += [df.select(F.lit(p).alias("product"), F.lit(k).alias("k")) for k, df in plans.items()]
    counted = reduce(DataFrame.union, rows).groupBy("product").agg(
        *[F.count_if(F.col("k") == k).alias(k) for k in ("applied", "pushed", "cohort", "converted")]
    )
    return counted


@register("product_anchor_dates", lambda: oracle.product_anchors(CATALOGUE))
def q_product_anchor_dates(spark, sf):
    t = _t(spark, sf)
    parts = [cohort.anchor_dates(t, s, mode="reference").select(F.lit(p).alias("product"), "*") for p, s in CATALOGUE.items()]
    return reduce(DataFrame.unionByName, parts)


CLUB = dataclasses.replace(CATALOGUE["club"], events=SPEC.events)


@register("training_matrix_club", lambda: oracle.training_matrix(CLUB, CLUB, TRAIN_YEARS))
def q_training_matrix_club(spark, sf):
    """A product with a date column, a table and task ids of its own."""
    return features.training_matrix(_t(spark, sf), CLUB, CLUB, TRAIN_YEARS, anchor_mode="reference")


# --- typed CSV source -----------------------------------------------------------------------
@register("csv_applications", oracle.csv_applications)
def q_csv_applications(spark, sf):
    """The loan applications through a CSV copy that holds bad rows as well: the rows read back
    with the declared schema, and the text of the rejected ones."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    app = _t(spark, sf).application_loan
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    line = lambda *cells: F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("")) for c in cells]).alias("value")
    m, created, status, none = F.col("merchant_id"), stamp("created_at"), F.col("status"), F.lit("")
    good = app.select(line(m, created, stamp("agreement_at"), status))
    no_date = app.filter(m % 5 == 0).select(line(m, F.concat(F.lit("on "), created), none, status))
    no_number = app.filter(m % 7 == 0).select(line(F.concat(F.lit("M"), m.cast("string")), created, none, status))
    good.union(no_date).union(no_number).write.text(path)
    t = Tables.from_csv(spark, {"application_loan": path}, header=False)
    rows = t.application_loan.select(F.lit("row").alias("kind"), "*", F.lit(None).cast("string").alias("record"))
    fields = [f for f in t.application_loan.schema]
    bad = t.rejected("application_loan").select(
        F.lit("rejected").alias("kind"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], "record"
    )
    return rows.unionByName(bad)


def _audit_sql():
    parts = {
        "pushed": oracle.pushed_merchants(SPEC),
        "applied": oracle.applied_merchants(SPEC),
        "cohort": oracle.cohort_union(SPEC),
        "active": oracle.active_merchants(AS_OF, MIN_TXNS),
    }
    return "\nUNION ALL\n".join(f"SELECT '{k}' AS stage, COUNT(*) AS n_rows FROM ({v}) {k}" for k, v in parts.items())


@register("cohort_audit", _audit_sql)
def q_cohort_audit(spark, sf):
    t = _t(spark, sf)
    return eda.audit(
        {
            "pushed": cohort.pushed_merchants(t, SPEC),
            "applied": cohort.applied_merchants(t, SPEC),
            "cohort": cohort.cohort_union(t, SPEC),
            "active": cohort.active_merchants(t, AS_OF, min_txns=MIN_TXNS),
        }
    )


# --- Spark ML (row-count checks only: no SQL statement of a fitted model) -------
def _split(spark, sf):
    return ml.stratified_split(_tm(spark, sf), "target", 0.25, seed=0)


def _ranked_sql(rule: str, sql: str) -> str:
    """Rows whose seeded-hash rank in their class meets ``rule``."""
    return f"""
WITH tm AS (SELECT merchant_id, target FROM ({sql}) t0),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY CAST('0x' || substr(md5(CAST(merchant_id AS VARCHAR) || ':0'), 1, 15) AS BIGINT)) AS k,
      count(*) OVER (PARTITION BY target) AS n FROM tm),
s AS (SELECT *, min(n) OVER () AS least, max(target) OVER () <> min(target) OVER () AS two_classes FROM r)
SELECT merchant_id, target FROM s WHERE {rule}"""


@register("stratified_split", lambda: _ranked_sql("k <= CAST(floor(0.25 * n + 0.5) AS BIGINT)", _train_sql()))
def q_stratified_split(spark, sf):
    train, test = _split(spark, sf)
    return test.select("merchant_id", "target")


@register("downsample_negatives", lambda: _ranked_sql(
    "target <> 0 OR NOT two_classes OR k <= least", oracle.target_label(CATALOGUE["swipe"])))
def q_downsample_negatives(spark, sf):
    """On the labels of a product with fewer applicants than pushed merchants."""
    labels = stage(cohort.target_label(_t(spark, sf), CATALOGUE["swipe"]))
    return ml.downsample_negatives(labels, "target", seed=0).select("merchant_id", "target")


def _model(spark, sf):
    """Train from the tables, save, and load again: (model, hold-out rows)."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/models/{SPEC.name}-{uuid.uuid4().hex}"
    train, test = _split(spark, sf)
    ml.save(ml.train_gbt(train), path, SPEC.name)
    return ml.load(path, SPEC.name), test


@register("train_gbt", None)
def q_train_gbt(spark, sf):
    return ml.round_metrics(*_model(spark, sf))


@register("score_merchants", None)
def q_score_merchants(spark, sf):
    """Three products' models, each trained on its own labels and sessions, on the active base:
    probabilities, flags, LTV and the ranked recommendation."""
    t = _t(spark, sf)
    paths, rows = {}, {}
    for p, events in PRODUCT_EVENTS.items():
        spec = dataclasses.replace(CATALOGUE[p], events=events, event_pattern=None)
        session_spec = dataclasses.replace(spec, application_table="application_recent", order_date_col="order_date", statuses=SPEC.statuses)
        m = stage(features.training_matrix(t, spec, session_spec, TRAIN_YEARS, anchor_mode="reference"))
        rows[p] = ml.stratified_split(m, "target", 0.25, seed=0)[0]
    for p, model in ml.train_all(rows).items():
        paths[p] = f"{checkpoint_dir(spark).rstrip('/')}/models/{p}-{uuid.uuid4().hex}"
        ml.save(model, paths[p], p)
    scored = scoring.with_flags(t, scoring.score_products(stage(_score_matrix(spark, sf)), paths))
    final = score.with_recommendation(score.with_ltv(scored))
    cols = [f"prob_{p}" for p in PRODUCT_EVENTS] + list(scoring.FLAG_COLS) + ["loan_ltv", "speaker_ltv", "swipe_ltv", "mltv"]
    return final.select("merchant_id", *cols, "p1_recommendation", "p2_recommendation", "p3_recommendation")


@register("feature_importance", None)
def q_feature_importance(spark, sf):
    model, _ = _model(spark, sf)
    return ml.feature_importance(model, 20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql() for k, e in REGISTRY.items() if e.sql is not None}
