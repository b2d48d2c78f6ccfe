"""claimlake — claims lakehouse analytics as plain PySpark DataFrame jobs.

Layers (all pure ``DataFrame -> DataFrame`` functions unless noted):

* ``sources``    — test-table fixture views, file/stream ingest, incremental loads
* ``operators``  — data quality, silver conformance, star schema, features,
                   summaries, fraud/billing/performance reports, model + monitor
* ``functions``  — reusable ``Column`` expressions (bands, costs, drift maths)
* ``plans``      — the end-to-end pipeline and the query registry
* ``streaming``  — Structured Streaming ingest of landed files
"""

__all__ = ["session"]
