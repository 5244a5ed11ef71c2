"""Hand-made logical tables for edge-case tests."""

import datetime as dt

from tillpoint.sources.tables import SCHEMAS, Tables

D = dt.date
T = dt.datetime


def ts(y, m, d):
    return T(y, m, d, 12, 0, 0)


def tables(spark, **frames):
    """frames: logical name -> list of tuples (declared schema order)."""
    loaders = {}
    for name, rows in frames.items():
        key = "task_history" if name.startswith("task_history") else name
        schema = SCHEMAS.get(key)
        df = spark.createDataFrame(rows, schema=schema) if isinstance(rows, list) else rows
        loaders[name] = (lambda d=df: d)
    for name in ("task_history_v1", "task_history_v2", "application"):
        if name not in loaders:
            key = "task_history" if name.startswith("task_history") else name
            empty = spark.createDataFrame([], schema=SCHEMAS[key])
            loaders[name] = (lambda d=empty: d)
    return Tables(spark, loaders, D(2000, 1, 1))
