"""Aggregate expression builders shared by the reports.

Means are an exact sum (integer / decimal) divided once, so the result
does not depend on partition order.  Standard deviations follow the SQL
dialect of the reports: population, not sample.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mean(x) -> Column:
    """AVG(x) as double: exact sum / non-null count (NULL on no rows)."""
    x = _c(x)
    return F.try_divide(F.sum(x).cast("double"), F.count(x).cast("double"))


def std_pop(x, digits: int = 8) -> Column:
    """SQL STDDEV(x): population standard deviation, rounded."""
    return F.round(F.stddev_pop(_c(x).cast("double")), digits)


def std_samp(x, digits: int = 8) -> Column:
    return F.round(F.stddev_samp(_c(x).cast("double")), digits)


def null_count(x) -> Column:
    """SUM(CASE WHEN x IS NULL THEN 1 ELSE 0 END): NULL on empty input."""
    return F.sum(F.when(_c(x).isNull(), 1).otherwise(0)).cast("bigint")


def moments_corr(x, y, digits: int = 10) -> Column:
    """Pearson r from exact decimal moments, as the SQL report spells it:
    (nΣxy − ΣxΣy) / sqrt((nΣx² − (Σx)²)(nΣy² − (Σy)²)), n = COUNT(*)."""
    x, y = _c(x), _c(y)
    n = F.count(F.lit(1)).cast("decimal(20,0)")
    sxy, sx, sy = F.sum(x * y), F.sum(x), F.sum(y)
    sxx, syy = F.sum(x * x), F.sum(y * y)
    num = (n * sxy - sx * sy).cast("double")
    vx = (n * sxx - sx * sx).cast("double")
    vy = (n * syy - sy * sy).cast("double")
    den = F.sqrt(vx * vy)
    return F.round(F.try_divide(num, F.when(den != 0, den)), digits)
