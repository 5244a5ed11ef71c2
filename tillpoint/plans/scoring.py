"""End-to-end scoring job ("as of" a date) for the active merchant base.

scoring matrix -> per-product probabilities from the saved models -> product
flags -> LTV -> ranked recommendations -> Digital / Offline channel -> table
(replace), CSV export and report tables.  Each product model is scored with its own session
columns renamed to the shared feature names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.config import CHANNEL_MIN_RELEVANT_APPS, CHANNEL_MIN_W1_SESSIONS, PRODUCTS
from tillpoint.operators import apps, eda, features, ml, score
from tillpoint.sources.sinks import export_csv, stage, write_table
from tillpoint.sources.tables import Tables

FLAG_COLS = ("swipe_flag", "speaker_flag", "loan_flag")


def score_products(matrix: DataFrame, model_paths: dict[str, str]) -> DataFrame:
    """``matrix`` with ``prob_<product>`` of every product's saved model; each model gets its own
    product's session columns under the shared names, and checks its contract."""
    out = matrix
    for product, path in model_paths.items():
        model = ml.load(path, product)
        # one frame, model after model: only the session columns change names
        x = out.withColumns({"w1_sessions": F.col(f"w1_{product}_sessions"), "m1_sessions": F.col(f"m1_{product}_sessions")})
        out = ml.score(model, ml.in_order(x, model.contract.features), f"prob_{product}").drop("w1_sessions", "m1_sessions")
    return ml.in_order(out, [*matrix.columns, *[f"prob_{p}" for p in model_paths]])


def with_flags(tables: Tables, df: DataFrame) -> DataFrame:
    """``df`` with the mart's product flags (NULL for a merchant the mart lacks)."""
    return df.join(tables.merchant_mart.select("merchant_id", *FLAG_COLS), "merchant_id", "left")


def run(
    tables: Tables,
    as_of: dt.date,
    model_paths: dict[str, str],
    out_table: str | None = None,
    csv_path: str | None = None,
    reports_dir: str | None = None,
    min_txns: int = 5,
    min_relevant_apps: int = CHANNEL_MIN_RELEVANT_APPS,
    min_w1_sessions: int = CHANNEL_MIN_W1_SESSIONS,
) -> DataFrame:
    products = {p: PRODUCTS[p].events for p in ("swipe", "loan", "speaker")}
    matrix = stage(features.scoring_matrix(tables, as_of, products, min_txns))
    scored = score_products(matrix, model_paths)
    scored = score.with_recommendation(score.with_ltv(with_flags(tables, scored)))
    digital = apps.digital_merchants(
        apps.app_features(tables, as_of, min_txns), min_relevant=min_relevant_apps, min_w1=min_w1_sessions
    )
    final = apps.channel_label(scored, digital)
    final = stage(final)
    if out_table:
        write_table(final, out_table)
    if csv_path:
        export_csv(final, csv_path)
    if reports_dir:
        for name, df in reports(final).items():
            df.write.mode("overwrite").parquet(f"{reports_dir}/{name}")
    return final


def reports(final: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the charts of a scoring run: flag rates by product, score and flag
    histograms, the rows kept by the 3 x IQR fence on the mean of the last two months' value, and the
    rows with the highest loan value."""
    labels = {c.removesuffix("_flag"): c for c in FLAG_COLS}
    shown = [c for c in final.columns if c.startswith("prob_") or c in FLAG_COLS]
    return {
        "rate_by_category": eda.rate_by_category(final, eda.SCORING_CATEGORY_COLS, labels=labels),
        "rate_by_quartile_bin": eda.rate_by_quartile_bin(final, eda.SCORING_EDA_COLS, labels=labels),
        "loan_outlier_trim": score.iqr_trim(final),
        "top_loan_ltv": score.max_rows(final, "loan_ltv"),
        **{f"histogram_{c}": score.histogram(final.filter(F.col(c).isNotNull()), c, 10) for c in shown},
    }
