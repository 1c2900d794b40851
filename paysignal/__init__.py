"""paysignal: payment-risk analytics as Spark DataFrame jobs.

Layers (all lazy DataFrame transforms unless a function says it writes):

* ``sources``   - raw readers, test-table adapters, versioned parquet storage
* ``functions`` - reusable Column expressions (money, ratios, hashes, levels, formats)
* ``operators`` - standardise, data quality, repeated keys, dedup, SCD2, fraud rules,
                  Gold, KPIs, alerts, synthetic data
* ``streaming`` - incremental Bronze ingestion with Structured Streaming
* ``plans``     - Silver split, dashboard bundle, incremental rescoring, end-to-end
                  jobs (``python -m paysignal.plans.jobs``), registered queries and
                  their DuckDB oracle SQL
"""

from paysignal.config import QualityProfile, RuleConfig

__all__ = ["RuleConfig", "QualityProfile"]
