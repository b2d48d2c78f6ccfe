"""Query registry: one entry per operator key, with its DuckDB oracle.

Every query reads the given tables in ``sf_dir`` (through the fixture views)
and runs over them whole.  Columns listed in ``rounded`` are sums/averages of
doubles whose last bits depend on summation order; both sides round them to
4 decimals so the value hash compares the number, not the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lake import Lake
from .oracle_sql import compose

ROUND_DIGITS = 4
# Rounding boundary shifted off the exact half: averages of decimal data often sit
# exactly on a tie, where Spark (BigDecimal HALF_UP) and DuckDB (scaled rint) round
# differently; with the same IEEE formula on both sides equal doubles give equal output.
_SCALE = 10 ** ROUND_DIGITS
_BOUNDARY = 0.4987654321


@dataclass
class Entry:
    key: str
    build: Callable[[Lake], DataFrame]
    sql: str | None
    rounded: tuple[str, ...] = field(default_factory=tuple)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Lake(spark, sf_dir))
        if self.rounded:
            df = df.withColumns({c: F.floor(F.col(c) * _SCALE + _BOUNDARY) / _SCALE for c in self.rounded})
        return df

    def oracle(self) -> str | None:
        if self.sql is None or not self.rounded:
            return self.sql
        repl = ", ".join(f"floor({c} * {_SCALE} + {_BOUNDARY}) / {_SCALE} AS {c}" for c in self.rounded)
        return f"SELECT * REPLACE ({repl}) FROM (\n{self.sql}\n) q"


ENTRIES: dict[str, Entry] = {}


def register(key: str, build: Callable[[Lake], DataFrame], sql: str | None,
             rounded: tuple[str, ...] | list[str] = ()) -> None:
    if key in ENTRIES:
        raise KeyError(f"duplicate key {key}")
    ENTRIES[key] = Entry(key, build, sql, tuple(rounded))


def q(final_sql: str, *deps: str) -> str:
    return compose(final_sql, *deps)


def _load() -> None:
    # Importing the catalogue modules fills ENTRIES.
    from . import catalog  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: e.spark for k, e in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: s for k, e in ENTRIES.items() if (s := e.oracle()) is not None}
