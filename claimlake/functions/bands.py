"""Reusable Column expressions: band ladders, encodings, money arithmetic.

CASE ladders send NULL to the last band (a NULL age lands in ``65+``), exactly
like the reference's ``when`` chains; tests pin this.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed band definitions of the reference: (exclusive upper bound, label), last label = otherwise.
AGE_BANDS = ((25, "17-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"), (None, "65+"))
VEHICLE_AGE_BANDS_INCL = ((3, "0-3 years"), (7, "4-7 years"), (12, "8-12 years"), (None, "13+ years"))
VALUE_BANDS_GBP = ((8000, "<£8K"), (20000, "£8K-£20K"), (40000, "£20K-£40K"), (None, "£40K+"))
PREMIUM_BANDS = ((60, "<£60/mo"), (100, "£60-£100/mo"), (200, "£100-£200/mo"), (None, "£200+/mo"))
RISK_SCORE_TIERS = ((0.2, "low"), (0.5, "medium"), (0.7, "high"), (None, "very_high"))
SEVERITY_CODES = {"minor": 0, "moderate": 1, "severe": 2, "total_loss": 3}
LABELS = ("minor", "moderate", "severe", "total_loss")


def ladder(col: Column, bands: Sequence[tuple[float | None, str]], inclusive: bool = False) -> Column:
    """``when(col < b1, l1).when(col < b2, l2)... .otherwise(last)`` (``<=`` if inclusive)."""
    out = None
    for bound, label in bands:
        if bound is None:
            return out.otherwise(F.lit(label)) if out is not None else F.lit(label)
        cond = col <= bound if inclusive else col < bound
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def one_hot(col: Column, *values: str) -> Column:
    """1 when ``col`` is one of ``values`` else 0 (NULL -> 0)."""
    cond = col == values[0] if len(values) == 1 else col.isin(*values)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def severity_code(col: Column) -> Column:
    out = None
    for label, code in SEVERITY_CODES.items():
        out = F.when(col == label, F.lit(code)) if out is None else out.when(col == label, F.lit(code))
    return out.otherwise(F.lit(None))


def severity_label(code: Column) -> Column:
    """Decode 0..3; anything else (incl. NULL) is ``total_loss`` like the scorer's ladder."""
    return (F.when(code == 0, "minor").when(code == 1, "moderate")
            .when(code == 2, "severe").otherwise("total_loss"))


def net_payout(amount: Column, excess: Column) -> Column:
    """``greatest(amount - excess, 0)``; ``greatest`` skips NULL, so no policy ⇒ 0.0."""
    return F.greatest(amount - excess, F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """``round(num / nullif(den, 0) * 100, digits)``."""
    return F.round(num / F.nullif(den, F.lit(0)) * 100, digits)


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd").cast("int")


# Money accumulation: each value is taken at 10 decimals and summed as DECIMAL,
# which is exact, so the total does not depend on partitioning or summation
# order (a double sum can differ in its last bit between runs and flip a
# subsequent ROUND on values such as 1172.27705).
MONEY_DECIMAL = "decimal(38,10)"


def money_sum(col: Column) -> Column:
    return F.sum(col.cast(MONEY_DECIMAL)).cast("double")


def money_avg(col: Column) -> Column:
    return money_sum(col) / F.count(col)
