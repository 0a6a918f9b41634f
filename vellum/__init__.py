"""vellum — medallion data products as Spark DataFrame operators.

Layers: sources (typed intake, adapters, sinks) → operators (quality gate,
reconciliation, incremental loads, numbering, profiling) → plans (the marts
of each data product and their serving queries) → streaming (the keyed
incremental load driven by micro-batches).
"""

__all__ = ["session"]
