"""Cadence: regularity of recurring events, as Spark DataFrame code.

Sub-packages
------------
functions   Column builders (labels, null tests, texts); no plan of their own
operators   DataFrame in, DataFrame out: arrivals, headways, freshness, plan
            comparison, quality, alerts, watchdog, serving
sources     JSON, CSV and Parquet in and out; the versioned mart store
plans       write / audit / publish / validate, daily and date-bounded builds
streaming   Structured Streaming forms of ingest, windows and alerts
workload    the registered queries and their SQL oracles
"""

from cadence.params import AlertRules, Labels, LineRules, Params, WatchRules

__all__ = ["AlertRules", "Labels", "LineRules", "Params", "WatchRules"]
