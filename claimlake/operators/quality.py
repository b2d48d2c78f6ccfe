"""Data-quality framework: rule flags, quarantine projection, policies, expectations.

A rule is a *failing* condition.  ``add_dq`` turns a list of rules into one
``_dq`` column — NULL when the row is clean, otherwise the names of the failed
rules in declaration order joined by ``|``.  It is a single projection, so it
stays inside whole-stage codegen and never shuffles.

Three-valued logic is kept on purpose: a rule whose condition is NULL (for
example ``NOT email LIKE '%@%'`` on a NULL email) does not fire.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RULE_SEPARATOR = "|"
DQ_COLUMN = "_dq"
QUARANTINE_COLUMNS = ("source_table", "record_id", "dq_rule_violated", "raw_record", "quarantined_at")


@dataclass(frozen=True)
class Rule:
    """A named failing condition over a typed (silver) frame."""

    name: str
    fails: Callable[[], Column]
    severity: str = "hard"  # "hard" drops the row, "soft" only warns (documented policy)

    def check(self) -> tuple[Column, str]:
        return self.fails(), self.name


def add_dq(df: DataFrame, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    """Append ``_dq``: NULL if every check passes, else ``rule|rule|...`` in order."""
    if not checks:
        return df.withColumn(DQ_COLUMN, F.lit(None).cast("string"))
    flags = F.concat_ws(RULE_SEPARATOR, *[F.when(cond, F.lit(name)) for cond, name in checks])
    return df.withColumn(DQ_COLUMN, F.when(flags == "", F.lit(None).cast("string")).otherwise(flags))


def add_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return add_dq(df, [r.check() for r in rules])


def _fires(rules: Sequence[Rule]) -> Column:
    """TRUE when at least one rule fires (a NULL condition does not fire)."""
    out = F.lit(False)
    for r in rules:
        out = out | F.coalesce(r.fails(), F.lit(False))
    return out


def passing_rows(typed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows where no rule fires — the same rows as ``_dq IS NULL`` but a plain boolean
    filter (no string is built), which Catalyst pushes into the scan stage."""
    return typed.filter(~_fires(rules))


def failing_rows(typed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows where some rule fires, with ``_dq`` computed only for them."""
    return add_rules(typed.filter(_fires(rules)), rules)


def _ts(run_ts: datetime | str | Column | None) -> Column:
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def to_quarantine(df: DataFrame, source_table: str, id_col: str,
                  run_ts: datetime | str | Column | None = None) -> DataFrame:
    """Failing rows in the shared quarantine shape; ``raw_record`` is JSON of the typed row."""
    data_cols = [c for c in df.columns if c != DQ_COLUMN]
    return (
        df.filter(F.col(DQ_COLUMN).isNotNull())
        .select(
            F.lit(source_table).alias("source_table"),
            F.col(id_col).cast("string").alias("record_id"),
            F.col(DQ_COLUMN).alias("dq_rule_violated"),
            F.to_json(F.struct(*[F.col(c) for c in data_cols])).alias("raw_record"),
            _ts(run_ts).alias("quarantined_at"),
        )
    )


def clean_rows(dq: DataFrame) -> DataFrame:
    """Strict policy (what the pipeline code does): every flagged row leaves the clean table."""
    return dq.filter(F.col(DQ_COLUMN).isNull()).drop(DQ_COLUMN)


def hard_pattern(rules: Sequence[Rule]) -> str:
    names = sorted({r.name for r in rules if r.severity == "hard"})
    return "|".join(names) if names else "(?!)"


def split_by_policy(dq: DataFrame, policy: str, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(clean, failed) under the chosen policy.

    ``strict``      — the code's behaviour: any flag removes the row from clean.
    ``documented``  — the documents' behaviour: rows with only soft warnings stay
                      in clean *and* appear among the failed rows.
    """
    failed = dq.filter(F.col(DQ_COLUMN).isNotNull())
    if policy == "strict":
        return clean_rows(dq), failed
    if policy != "documented":
        raise ValueError(f"unknown policy {policy!r}")
    hard = [r.name for r in rules if r.severity == "hard"]
    parts = F.split(F.coalesce(F.col(DQ_COLUMN), F.lit("")), r"\|")
    has_hard = F.arrays_overlap(parts, F.array(*[F.lit(n) for n in hard])) if hard else F.lit(False)
    return dq.filter(~has_hard).drop(DQ_COLUMN), failed


def expect_warn(df: DataFrame, name: str, passes: Column) -> tuple[DataFrame, Observation]:
    """Warn-only expectation: rows are kept; failures are counted as a side metric.

    ``Observation`` works for batch and streaming frames; the counts are
    available after the first action on the returned frame.
    """
    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.coalesce(passes, F.lit(False))).alias("failed"),
    )
    return observed, obs


def expectation_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per expectation: name, passed, failed — one aggregate pass over ``df``."""
    aggs = []
    for name, passes in rules.items():
        ok = F.coalesce(passes, F.lit(False))
        aggs += [F.count_if(ok).alias(f"{name}__p"), F.count_if(~ok).alias(f"{name}__f")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}__p`, `{n}__f`" for n in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) AS (expectation, passed, failed)")


def rule_report(typed: DataFrame, entity: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per catalogue rule of ``entity``: severity and how many rows it flags
    (one aggregate pass; rules that never fire show 0)."""
    counts = typed.agg(*[F.count_if(F.coalesce(r.fails(), F.lit(False))).alias(f"r{i}")
                         for i, r in enumerate(rules)])
    stack = ", ".join(f"'{r.name}', '{r.severity}', r{i}" for i, r in enumerate(rules))
    return counts.selectExpr(f"'{entity}' AS entity",
                             f"stack({len(rules)}, {stack}) AS (rule, severity, failed_records)")


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (a declared grain that does not hold)."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )
