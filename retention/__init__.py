"""retention: daily customer-churn analytics as Spark DataFrame jobs.

Layout:
  functions/  Column-level helpers (safe casts, white-space trim, guarded stats)
  sources/    readers/writers: CSV landing files, partitioned tables, test fixture
  operators/  DataFrame -> DataFrame steps: prepare, clean, quality, profile,
              features, segments, ordering (global prefix sums), quantiles, upsert, metrics
  plans/      multi-step jobs: daily pipeline, status log, model registry, training, scoring
  streaming/  incremental pickup of dropped CSV files (Structured Streaming)
"""

__all__ = ["session", "schemas"]
