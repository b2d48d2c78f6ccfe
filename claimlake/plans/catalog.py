"""The registered queries and their oracles.

Import order of the sections mirrors the build: silver and quality, gold,
fraud, billing/performance, incremental loads, model and monitoring.
"""

from __future__ import annotations

from . import catalog_gold  # noqa: F401  (defines gold CTEs used by later sections)
from . import catalog_billing, catalog_core, catalog_io, catalog_ml  # noqa: F401
