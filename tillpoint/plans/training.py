"""End-to-end training job for one product.

extract (cohort, features, sessions, vintage) -> training matrix (staged) ->
split -> [down-sample] -> boosted trees -> saved PipelineModel + evaluation
and EDA tables written next to it.  Every step is a Spark job; only the fitted
model's metadata passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillpoint.config import ProductSpec
from tillpoint.operators import eda, evaluate, features, ml
from tillpoint.sources.sinks import stage
from tillpoint.sources.tables import Tables


def run(
    tables: Tables,
    spec: ProductSpec,
    out_dir: str,
    session_spec: ProductSpec | None = None,
    session_years: tuple[int, ...] | None = None,
    downsample: bool | None = None,
    anchor_mode: str = "earliest",
    seed: int = 0,
    gbt_kwargs: dict | None = None,
) -> dict[str, DataFrame]:
    years = session_years or spec.session_years
    matrix = stage(features.training_matrix(tables, spec, session_spec, years, anchor_mode))
    if downsample is None:
        downsample = spec.name == "fp"  # the source balances classes for this product only
    data = ml.downsample_negatives(matrix, "target", seed) if downsample else matrix
    train, test = ml.stratified_split(data, "target", 0.25, seed)
    model = ml.train_gbt(train, seed=seed, **(gbt_kwargs or {}))
    ml.save(model, f"{out_dir}/model", spec.name)
    scored = stage(ml.score(model, test.select("merchant_id", "target", *ml.MODEL_FEATURES), "prob"))
    outputs = {
        "training_matrix": matrix,
        "threshold_sweep": evaluate.threshold_sweep(scored),
        "confusion_matrix": evaluate.confusion_matrix(scored, 0.75).unionByName(evaluate.confusion_matrix(scored, 0.5)),
        "roc_curve": evaluate.roc_curve(scored),
        "roc_auc": evaluate.roc_auc(scored),
        "accuracy": evaluate.accuracy(scored, 0.85),
        "round_metrics": ml.round_metrics(model, test),
        "feature_importance": ml.feature_importance(model, 20),
        "rate_by_category": eda.rate_by_category(matrix),
        "rate_by_quartile_bin": eda.rate_by_quartile_bin(matrix),
        "rate_by_top_geohash": eda.rate_by_top_category(matrix, "geohash4", 50),
        "target_balance": eda.value_counts(matrix, "target"),
    }
    for name, df in outputs.items():
        if name != "training_matrix":
            df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return outputs
