"""Per-product extract: every training input written once, in restartable chunks.

The source re-runs each query per key chunk and skips files that exist; here each extract is
a few Spark jobs over key chunks with a manifest (``sources.extracts``): a re-run builds
only the chunks that are missing, and all of them if the inputs or parameters changed.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame

from tillpoint.config import ProductSpec
from tillpoint.operators import cohort, profile, rolling, sessions
from tillpoint.sources import extracts
from tillpoint.sources.tables import Tables

TASKS = ("task_history_v1", "task_history_v2")


def run(
    tables: Tables,
    spec: ProductSpec,
    out_dir: str,
    session_spec: ProductSpec | None = None,
    anchor_mode: str = "earliest",
    conversion_days: int = 7,
    chunks: int = 1,
) -> dict[str, DataFrame]:
    base = f"{out_dir.rstrip('/')}/{spec.name}"
    sspec = session_spec or spec
    cohort_inputs = (*TASKS, spec.application_table)
    # name -> (what it reads, how it is built from the tables or a chunk of them)
    plans = {
        "push_merchants_in_application": (cohort_inputs, lambda t: cohort.push_converted(t, spec, conversion_days)),
        "total_push_merchants": (TASKS, lambda t: cohort.pushed_merchants(t, spec)),
        "total_application_merchants": ((spec.application_table,), lambda t: cohort.applied_merchants(t, spec)),
        "merchant_data_mart": ((*cohort_inputs, "merchant_mart"), lambda t: profile.merchant_profile(t, spec)),
        "trxn": ((*cohort_inputs, "transactions"), lambda t: rolling.txn_features_train(t, spec, anchor_mode)),
        "app": (
            (*TASKS, sspec.application_table, "merchant_mart", "app_event"),
            lambda t: sessions.session_features_years(t, sspec, sspec.session_years, anchor_mode),
        ),
    }
    if spec.has_vintage:
        plans["vin"] = ((*cohort_inputs, "merchant_mart"), lambda t: profile.vintage(t, spec))
    parameters = [dataclasses.asdict(spec), dataclasses.asdict(sspec), anchor_mode, conversion_days, tables.date_floor]
    return {
        name: extracts.extract(tables, name, build, f"{base}/{name}", inputs, chunks, parameters)
        for name, (inputs, build) in plans.items()
    }
