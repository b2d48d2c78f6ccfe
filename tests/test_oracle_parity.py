"""Every registered query against its DuckDB oracle on the smallest fixture (sf0.001).

Set CLAIMLAKE_SKIP_PARITY=1 to skip (it runs ~120 Spark queries).
"""

import math
import os

import pytest

from .conftest import SF_SMALL

pytestmark = pytest.mark.skipif(os.environ.get("CLAIMLAKE_SKIP_PARITY") == "1", reason="parity skipped")

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    import datetime

    import numpy as np
    import pandas as pd

    if isinstance(v, np.generic):
        v = v.item()
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (pd.Timestamp, np.datetime64, datetime.datetime)):
        return pd.Timestamp(v).tz_localize(None).isoformat()
    if isinstance(v, np.ndarray):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _canon(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)),
                  key=lambda t: tuple("" if x is None else str(x) for x in t))


def _kind(t):
    import pyarrow as pa

    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_decimal(t):
        return "decimal"
    if pa.types.is_list(t) or pa.types.is_large_list(t):
        return f"list<{_kind(t.value_type)}>"
    return str(t)


@pytest.mark.parametrize("key", sorted(SQL))
def test_parity(spark, duck, key):
    got_arrow = entry.queries()[key](spark, SF_SMALL).toArrow()
    want_arrow = duck.sql(SQL[key]).to_arrow_table()
    assert {f.name: _kind(f.type) for f in got_arrow.schema} == {f.name: _kind(f.type) for f in want_arrow.schema}
    got, want = got_arrow.to_pandas(), want_arrow.to_pandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _canon(got) == _canon(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["incident_region", "total_claims", "flagged_claims", "fraud_rate_pct", "fraud_amount_gbp"]


def test_every_key_has_a_query():
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 100
