"""Guarded ratios: a zero divisor gives 0 instead of an error or NULL.

Precision: Spark sizes a decimal quotient from its operands' precision and,
past 38 digits, cuts the scale down to 6.  On the wide sums of a roll-up
(decimal(28,3)) that makes ROUND(x / y * 100, 2) round twice (136.9749998
-> 136.975000 -> 136.98).  Operands are therefore cast to ``WORK`` first:
the quotient keeps 14 decimal places and rounding to 2 is exact for magnitudes up
to 10^18.  An operand that does not fit ``WORK`` unchanged fails the query.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORK = "decimal(24,6)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _work(x: Column) -> Column:
    """The operand as ``WORK``; fails where digits would be lost."""
    cut = x.try_cast(WORK)
    lost = x.isNotNull() & (cut.isNull() | (cut != x))
    bad = F.raise_error(F.concat(F.lit(f"ratio operand does not fit {WORK}: "), x.cast("string"))).cast(WORK)
    return F.when(lost, bad).otherwise(cut)


def guarded_ratio(num, den, scale: int = 2) -> Column:
    """ROUND(num / den, scale), 0 when den = 0 (half away from zero)."""
    n, d = _work(_c(num)), _work(_c(den))
    return F.when(d == 0, F.lit(0)).otherwise(F.round(n / d, scale))


def guarded_percent(num, den, scale: int = 2) -> Column:
    """ROUND(num / den * 100, scale), 0 when den = 0."""
    n, d = _work(_c(num) * 100), _work(_c(den))
    return F.when(d == 0, F.lit(0)).otherwise(F.round(n / d, scale))
