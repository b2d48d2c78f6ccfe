"""File sources and sinks: landing CSV, bronze schemas, table write helpers.

Every sink writes to a path inside the shared checkpoint folder or a
configured table root — never a machine-local temp folder — and never
overwrites the path it is reading from (``stage_and_swap`` writes a new
version and returns its path).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fixtures import BRONZE_ENTITIES

AUDIT_INGESTED_AT = "_ingested_at"
AUDIT_SOURCE_FILE = "_source_file"
RESCUED = "_rescued_data"

# Landing columns per entity (all text at bronze; typed at silver).
BRONZE_COLUMNS: dict[str, tuple[str, ...]] = {
    "policyholders": ("policyholder_id", "first_name", "last_name", "date_of_birth", "gender", "email", "region",
                      "city", "postcode", "driving_points", "driving_years", "created_date"),
    "vehicles": ("vehicle_id", "policyholder_id", "make", "vehicle_type", "year", "colour", "estimated_value",
                 "mileage", "created_date"),
    "policies": ("policy_id", "policyholder_id", "vehicle_id", "policy_type", "coverage_type", "premium_monthly",
                 "excess", "coverage_limit", "start_date", "end_date", "status", "created_date"),
    "claims": ("claim_id", "policy_id", "policyholder_id", "vehicle_id", "claim_type", "claim_date",
               "incident_region", "incident_city", "severity_label", "fraud_risk_score", "claim_amount_gbp",
               "claim_status", "is_storm_related", "created_date"),
    "incidents": ("incident_id", "claim_id", "incident_type", "incident_date", "weather_condition", "road_condition",
                  "visibility", "police_report_filed", "num_vehicles_involved", "witness_count", "created_date"),
    "claim_assessments": ("assessment_id", "claim_id", "assessor_id", "assessor_tier", "assessment_date",
                          "damage_category", "estimated_repair_cost_gbp", "labour_hours", "parts_cost_gbp",
                          "recommended_action", "created_date"),
}

# Columns that landed files also bring and silver does not use; null where a file lacks them.
MORE_LANDING_COLUMNS: dict[str, tuple[str, ...]] = {
    "policyholders": ("phone", "street_address", "licence_number"),
    "vehicles": ("vin",),
    "claims": ("description",),
}


def landing_columns(entity: str) -> tuple[str, ...]:
    """All columns that a landed file of ``entity`` is known to bring."""
    return BRONZE_COLUMNS[entity] + MORE_LANDING_COLUMNS.get(entity, ())


def bronze_schema(entity: str, rescued: bool = False) -> T.StructType:
    """Fixed all-string landing schema (no inference); optional rescue column."""
    fields = [T.StructField(c, T.StringType(), True) for c in BRONZE_COLUMNS[entity]]
    if rescued:
        fields.append(T.StructField(RESCUED, T.StringType(), True))
    return T.StructType(fields)


def bronze_registry() -> dict[str, T.StructType]:
    """The six landing entities and their schemas, loaded the same way."""
    return {e: bronze_schema(e) for e in BRONZE_ENTITIES}


def ingest_audit_cols(df: DataFrame) -> DataFrame:
    """Ingest timestamp and source file path (``_metadata`` works for batch and stream)."""
    return df.withColumns({
        AUDIT_INGESTED_AT: F.current_timestamp(),
        AUDIT_SOURCE_FILE: F.col("_metadata.file_path"),
    })


def read_landing_csv(spark: SparkSession, path: str, entity: str, rescue: bool = True) -> DataFrame:
    """Batch read of a landing folder with the fixed schema; malformed lines are kept in ``_rescued_data``."""
    return (spark.read.schema(bronze_schema(entity, rescued=rescue)).option("header", True)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED).csv(path))


def land_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a landing folder with header CSV (clean ∪ bad rows already unioned)."""
    out = df.repartition(files) if files else df
    out.write.mode("overwrite").option("header", True).csv(path)


def stringify(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


@dataclass(frozen=True)
class TableConfig:
    """Where each layer's tables live (a path root per layer, or a catalog database)."""

    root: str
    use_catalog: bool = False
    layout: str = "{root}/{layer}/{name}"
    buckets: int = 0          # > 0 with a catalog: claim-keyed tables are bucketed for co-located joins

    def location(self, layer: str, name: str) -> str:
        if self.use_catalog:
            return f"{layer}.{name}"
        return self.layout.format(root=self.root.rstrip("/"), layer=layer, name=name)


def scan_table(spark: SparkSession, cfg: TableConfig, layer: str, name: str) -> DataFrame:
    loc = cfg.location(layer, name)
    return spark.table(loc) if cfg.use_catalog else spark.read.parquet(loc)


def materialize(df: DataFrame, cfg: TableConfig, layer: str, name: str, partition_by: Sequence[str] = (),
                bucket_by: str | None = None, then: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Full recompute and overwrite of one table; returns its location.

    ``then`` makes the table's rows of ``df`` after they were dealt out by ``partition_by``, so what it multiplies is not
    shuffled.

    With a catalog and ``cfg.buckets``, ``bucket_by`` writes the table bucketed
    and sorted on that key: two tables bucketed alike on the join key are joined
    by a sort-merge join with no exchange on either side.
    """
    loc = cfg.location(layer, name)
    if partition_by:      # few files a partition, however many tasks hold rows of it
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df = then(df) if then else df
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if cfg.use_catalog:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        if bucket_by and cfg.buckets:
            w = w.bucketBy(cfg.buckets, bucket_by).sortBy(bucket_by)
        w.saveAsTable(loc)
    else:
        w.parquet(loc)
    return loc


def overwrite_with_schema(df: DataFrame, path: str) -> None:
    """Replace a table including its schema (parquet overwrite replaces the files and footer schema)."""
    df.write.mode("overwrite").parquet(path)


def replace_full(source: DataFrame, path: str) -> None:
    """CREATE OR REPLACE … AS SELECT *."""
    source.write.mode("overwrite").parquet(path)


def stage_and_swap(df: DataFrame, base: str) -> str:
    """Write a new version under ``base`` and return its path; readers of the old
    version are never disturbed (the caller records the new path as current)."""
    path = f"{base.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, partition_col: str) -> None:
    """Dynamic partition overwrite: only the date partitions present in ``df`` are replaced.

    Rows are rebalanced by the partition column first, so a partition gets few files however many tasks hold rows of it,
    and a date with most of the rows is split over several tasks."""
    (df.hint("rebalance", F.col(partition_col)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))


def drop_partitions(spark: SparkSession, path: str, partition_col: str, values: Sequence) -> None:
    """Delete whole partitions of a table of files; those that do not exist are left out."""
    for v in values:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={v}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
