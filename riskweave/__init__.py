"""riskweave: weekly, explainable account-risk scoring expressed as Spark DataFrame plans.

Layers:
  sources/    typed readers (CSV seeds, named tables), staging casts, test fixtures
  functions/  Column-level helpers (rounding, day/week arithmetic, score bands, text)
  operators/  DataFrame -> DataFrame steps (activity, signals, features, scoring,
              history, alerts, quality, compare, reports, ml)
  sinks/      table writes, keyed upsert, namespace routing, model persistence
  plans/      whole runs wired from the operators (weekly build, backfill, ML)
  streaming/  incremental weekly usage over an arriving events table
"""

from riskweave.config import Settings

__all__ = ["Settings"]
__version__ = "0.1.0"
