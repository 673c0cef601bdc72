"""Budget-to-revenue ratio."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ratio given to films without positive revenue.
NO_REVENUE_RATIO = -999.999
# Unbounded NUMERIC read over JDBC arrives as DECIMAL(38,18); dividing two of
# them yields DECIMAL(38,6), so ratios equal to six places tie.
SOURCE_DECIMAL = "decimal(38,18)"


def guarded_ratio(num: Column, den: Column, mode: str = "double",
                  default: float = NO_REVENUE_RATIO) -> Column:
    """``num / den`` when ``den > 0`` else ``default`` (NULL ``den`` -> default).

    ``mode="decimal"`` reproduces the database path: both sides as
    DECIMAL(38,18), the quotient as DECIMAL(38,6) rounded half-up.  A value that
    does not fit gives NULL and never fails the job; cleaning rejects such
    values before (``validators.strict_float``).
    """
    if mode == "double":
        return F.when(den > 0, num.cast("double") / den.cast("double")) \
            .otherwise(F.lit(default).cast("double"))
    if mode == "decimal":
        q = F.try_divide(num.try_cast(SOURCE_DECIMAL), den.try_cast(SOURCE_DECIMAL))
        return F.when(den > 0, q).otherwise(F.lit(default).cast("decimal(38,6)"))
    raise ValueError(f"unknown ratio mode {mode!r}")
