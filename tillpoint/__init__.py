"""tillpoint: merchant propensity analytics expressed as Spark DataFrame plans.

Layers
------
sources    logical tables (transactions, applications, tasks, mart, app events,
           installed-app snapshots, devices) and sinks
functions  column-level helpers (window predicates, geohash, app-list parsing,
           binning, safe ratios)
operators  relational building blocks: cohorts and anchors, rolling-window
           features, sessions, profiles, app features, feature assembly,
           Spark ML training / scoring, evaluation tables, LTV and ranking, EDA
plans      end-to-end training / scoring plans and the query registry
"""

from tillpoint.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
