"""Left joins with sides whose keys may repeat, with the rows multiplied last.

A chain of joins deals its rows out again for every key, so rows that one side multiplies are shuffled for all sides that
follow.  Here a side is gathered to one row per key first (an array of its rows), the joins carry the arrays, and
``spread`` multiplies the rows after the last join, where nothing is dealt out any more.  What is shuffled grows with the
rows and the sides, not with their product; the result is that of the left joins, row for row.

Rows of a side without a key match nothing.  A key with more than ``PACK`` rows gets several arrays, so no array is large
however often one key comes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PACK = 256


def packed(side: DataFrame, key: str, columns: Mapping[str, str | Column], pack: int = PACK) -> DataFrame:
    """(key, ``of_<key>``): the rows of every key of ``side`` as arrays of at most ``pack`` structs of ``columns``
    (name → name in ``side``, or what is made of its columns)."""
    made = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    known = side.filter(F.col(key).isNotNull()).select(key, F.struct(*made).alias("_row"))
    at = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return (known.withColumn("_part", F.floor((at - 1) / pack)).groupBy(key, "_part").agg(F.collect_list("_row").alias(f"of_{key}"))
            .drop("_part"))


def attach(rows: DataFrame, sides: Mapping[str, tuple[DataFrame, Mapping[str, str | Column]]]) -> DataFrame:
    """``rows`` left-joined with every side (key → (side, columns)), its matches still an array (null: none)."""
    for key, (side, columns) in sides.items():
        rows = rows.join(packed(side, key, columns), key, "left")
    return rows


def spread(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row per match of every key that :func:`attach` joined; one with nulls where there is none."""
    for key in keys:
        others = [c for c in rows.columns if c != f"of_{key}"]
        rows = rows.select(*others, F.explode_outer(f"of_{key}").alias("_row")).select(*others, "_row.*")
    return rows
