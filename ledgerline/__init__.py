"""ledgerline: sales, production and finance analytics as Spark jobs.

Sub-packages:
  sources    - source registry, explicit schemas, stand-in views over the driver tables, sinks
  functions  - column expressions (liveness, unit picks, category groups, time windows)
  operators  - DataFrame operators with exact SQL semantics (joins, set ops, parameter lists,
               reconciliation, table-level analytics)
  plans      - jobs (kanban boards, daily load, enrichment, stale-link reset) and driver queries
  streaming  - incremental copy usable from a foreachBatch sink
"""

__version__ = "0.1.0"
