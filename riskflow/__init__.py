"""riskflow: wallet-risk analytics written as Spark DataFrame operators.

Layout:
  riskflow.session     session defaults and the shared scratch location
  riskflow.errors      typed errors raised by gates and loaders
  riskflow.functions   column-expression helpers (hash buckets, text formatting)
  riskflow.sources     readers: partitioned Parquet, CSV extracts, JSON events
  riskflow.sinks       writers: partition overwrite, versioned tables, upsert
  riskflow.operators   DataFrame -> DataFrame operators (contract, dedupe, SCD2, ...)
  riskflow.streaming   Structured Streaming velocity job
  riskflow.plans       composed jobs, driver-table mappings, registered queries
"""

__version__ = "0.1.0"
