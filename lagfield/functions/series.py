"""Window expressions over one series per key, ordered by month.

Every function takes the window specification, so all columns built from one
specification share a single exchange and sort.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from lagfield.functions.periods import as_col, month_index


def series(keys: Sequence[str], order: str = "periodo") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def lag(x: Column | str, n: int, w: WindowSpec) -> Column:
    """Value ``n`` rows back (``n`` < 0: ahead). On a gap-free series rows are months."""
    return F.lag(as_col(x), n).over(w)


def lag_months(x: Column | str, n: int, w: WindowSpec, period: str = "periodo") -> Column:
    """Value exactly ``n`` calendar months back on a series that may have gaps.

    ``w`` must be ordered by :func:`month_index` of the period.
    """
    frame = w.rangeBetween(-n, -n)
    return F.max(as_col(x)).over(frame)


def calendar_series(keys: Sequence[str], period: str = "periodo") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(month_index(period))


def trailing(w: WindowSpec, size: int) -> WindowSpec:
    return w.rowsBetween(-(size - 1), 0)


_ROLLING = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "max": F.max,
    "min": F.min,
    "sum": F.sum,
}


def rolling(x: Column | str, kind: str, size: int, w: WindowSpec, min_rows: int | None = None) -> Column:
    """Trailing statistic with the current row; null until ``min_rows`` values (default: full)."""
    need = size if min_rows is None else min_rows
    frame = trailing(w, size)
    value = as_col(x)
    if kind == "median":
        stat = F.percentile(value, F.lit(0.5)).over(frame)
    else:
        stat = _ROLLING[kind](value).over(frame)
    if need <= 1:
        return stat
    return F.when(F.count(value).over(frame) >= need, stat)


def ewm_mean(x: Column | str, span: int, index: str, w: WindowSpec) -> Column:
    """Bias-adjusted exponentially weighted mean, ``alpha = 2 / (span + 1)``.

    ``index`` names the row-index column of the series. Weights grow along the
    series and cancel in the ratio; at ``alpha`` 0.5 a double holds about 1,000
    rows, that is 83 years of months. A longer series raises.
    """
    keep = 1.0 - 2.0 / (span + 1.0)
    value = as_col(x)
    most = int(700 / -math.log(keep)) if keep > 0 else 0
    too_long = F.raise_error(F.lit(f"a series of over {most} rows")).cast("double")
    weight = F.when(F.col(index) > most, too_long).otherwise(F.pow(F.lit(keep), -F.col(index)))
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    seen = F.when(value.isNotNull(), weight)
    return F.try_divide(F.sum(value * weight).over(frame), F.sum(seen).over(frame))


def row_index(w: WindowSpec) -> Column:
    return F.row_number().over(w) - 1


def carried(x: Column | str, w: WindowSpec) -> Column:
    """Forward fill."""
    return F.last(as_col(x), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def running_sum(x: Column | str, w: WindowSpec) -> Column:
    return F.sum(as_col(x)).over(w.rowsBetween(Window.unboundedPreceding, 0))


def rows_since(event: Column, index: str, w: WindowSpec) -> Column:
    """Rows since ``event`` was last true; null before the first event."""
    return F.col(index) - carried(F.when(event, F.col(index)), w)
