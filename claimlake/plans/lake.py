"""``Lake``: lazily built layers over one folder of given tables.

Each property is a lazy DataFrame; nothing runs until an action.  Registered
queries build a fresh ``Lake`` per call so they always read the whole tables
in ``sf_dir``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import billing, features, quality, silver, star, summary
from ..session import written
from ..sources import fixtures, incremental

AS_OF = date(2026, 2, 17)
RUN_TS = datetime(2026, 2, 17, 6, 0, 0)


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: date = AS_OF, run_ts: datetime = RUN_TS):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of
        self.run_ts = run_ts
        self._dq: dict[str, DataFrame] = {}
        self._written: dict[str, DataFrame] = {}
        self._kept: dict[str, DataFrame] = {}

    def written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """``build()``, written once; whatever this query derives from it reads the files."""
        if not self.has_written(name):
            self._written[name] = written(build(), name)
        return self._written[name]

    def has_written(self, name: str) -> bool:
        return name in self._written

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """``build()``, planned once a query; nothing is written for it."""
        if name not in self._kept:
            self._kept[name] = build()
        return self._kept[name]

    # given tables and derived fixture views
    def table(self, name: str) -> DataFrame:
        return fixtures.star_table(self.spark, self.sf_dir, name)

    def view(self, name: str) -> DataFrame:
        return fixtures.spark_view(self.spark, self.sf_dir, name)

    def bronze(self, entity: str) -> DataFrame:
        return fixtures.bronze(self.spark, self.sf_dir, entity)

    # silver
    def dq(self, entity: str) -> DataFrame:
        if entity not in self._dq:
            self._dq[entity] = silver.conform(entity, self.bronze(entity), self.as_of)
        return self._dq[entity]

    def silver(self, entity: str) -> DataFrame:
        return silver.clean(entity, self.bronze(entity), self.as_of)

    def failed(self, entity: str) -> DataFrame:
        return quality.to_quarantine(silver.failing(entity, self.bronze(entity), self.as_of), entity,
                                     silver.ID_COLUMNS[entity], self.run_ts)

    @cached_property
    def quarantine(self) -> DataFrame:
        out = None
        for entity in fixtures.BRONZE_ENTITIES:
            part = self.failed(entity)
            out = part if out is None else out.unionByName(part)
        return out

    # gold
    @cached_property
    def fact_claim(self) -> DataFrame:
        return star.fact_claim(self.silver("claims"), self.silver("policies"),
                               self.silver("policyholders"), self.silver("vehicles"))

    @cached_property
    def claim_features(self) -> DataFrame:
        return features.claim_features(
            self.silver("claims"), self.silver("policies"), self.silver("policyholders"),
            self.silver("vehicles"), self.silver("incidents"), self.silver("claim_assessments"))

    @cached_property
    def fraud_summary(self) -> DataFrame:
        return summary.summary_fraud_intelligence(self.silver("claims"))

    # billing / performance system tables (derived from the given events table)
    @cached_property
    def usage(self) -> DataFrame:
        v = self.view("usage")
        ids = ("job_name", "notebook_path", "dlt_pipeline_id")
        return v.select(*[c for c in v.columns if c not in ids], F.struct(*ids).alias("usage_metadata"))

    @cached_property
    def list_prices(self) -> DataFrame:
        v = self.view("list_prices")
        pricing = F.struct(F.struct(F.col("price_default").alias("default")).alias("effective_list"))
        return v.select("sku_name", "price_start_time", "price_end_time", pricing.alias("pricing"))

    @cached_property
    def fx(self) -> DataFrame:
        return self.view("fx_rates_usd_gbp")

    @cached_property
    def run_timeline(self) -> DataFrame:
        v = self.view("run_timeline")
        return v.withColumn("period_end_time", F.col("period_start_time") + F.make_dt_interval(
            secs=F.col("duration_s").cast("decimal(18,6)")))

    @cached_property
    def pipelines(self) -> DataFrame:
        return incremental.replace_dedup(self.run_timeline, ["pipeline_id"], "pipeline_name",
                                         "period_start_time", alias="name")

    @cached_property
    def query_history(self) -> DataFrame:
        v = self.view("query_history")
        return v.withColumn("end_time", F.col("start_time") + F.make_dt_interval(
            secs=F.col("duration_s").cast("decimal(18,6)")))

    def priced_usage(self, start=None, end=None) -> DataFrame:
        return billing.priced_usage(self.usage, self.list_prices, self.fx, start, end)
