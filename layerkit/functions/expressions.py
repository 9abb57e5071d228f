"""Column expressions shared by the layers. All built-in, JVM-side, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as exact decimals (2 fractional digits) so results do not depend on
# the order in which a distributed SUM adds doubles; outputs stay DOUBLE. 26 digits before the
# point, so that a sum (38 digits) has room for 10^10 of the largest amounts (larger ones: limbs.py).
MONEY = "decimal(28,2)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """``x IS NULL OR TRIM(x) = ''`` (TRIM strips spaces only)."""
    c = col_(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def round2(c: str | Column) -> Column:
    """``ROUND(x, 2)``, half-up on the decimal text of the double."""
    return F.round(col_(c), 2)


def exact_avg2(total: Column, count: Column) -> Column:
    """ROUND(total / count, 2) half-up, as DOUBLE, rounded once.

    ``total``: a sum with at most 2 fractional digits. In whole cents the result is
    floor((2 * |cents| + n) / (2 * n)); the remainder is taken off first, so the division is
    exact and no quotient is cut to a few digits before it is rounded.
    """
    cents = (F.abs(total) * F.lit(100)).cast("decimal(38,0)")
    n = count.cast("decimal(20,0)")
    top, bottom = (F.lit(2) * cents + n).cast("decimal(38,0)"), (F.lit(2) * n).cast("decimal(21,0)")
    whole = ((top - top % bottom) / bottom).cast("decimal(38,0)")
    return F.signum(total.cast("double")) * (whole.cast("double") / F.lit(100.0))


def month_start(c: str | Column) -> Column:
    """``DATE_TRUNC('MONTH', d)`` as a zone-free timestamp (midnight of the 1st)."""
    return F.trunc(col_(c), "month").cast("timestamp_ntz")
