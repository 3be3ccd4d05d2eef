"""gamelake: player-telemetry analytics expressed as Spark DataFrame plans.

Layers:
  sources/    NDJSON scan and sink, bronze VARIANT frames, seed lookups, test adapters
  functions/  Column-level helpers (boundary datediff, safe ratio, segment rules, ...)
  operators/  reusable DataFrame operators (dedup, rolling distinct, retention, merge, SCD2, checks)
  plans/      the named models: staging, intermediate, marts, usage analytics, reports
  streaming/  Structured Streaming ingest, dedup and incremental activity
"""

__version__ = "0.1.0"
