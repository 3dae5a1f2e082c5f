"""Per-series seasonal forecasts as grouped regressions.

Each candidate is a one-regressor least-squares line over lags of the series, so
the whole family is fitted for all series by one window and one aggregate. The
candidate with the lowest corrected AIC, on the same rows, forecasts the series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.functions import series as S
from lagfield.operators import features as X
from lagfield.operators.naive import mean_12
from lagfield.operators.panel import densify
from lagfield.operators.relational import without_keys
from lagfield.session import stored

SEASON = 12
SSE_FLOOR = 1e-9


@dataclass(frozen=True)
class Candidate:
    """``response = c + slope * regressor`` in lags of y; no regressor means a constant."""

    name: str
    response: tuple[int, int | None]
    regressor: tuple[int, int | None] | None


# A pair (a, b) is y[t-a] - y[t-b]; (a, None) is y[t-a].
PLAIN = (
    Candidate("mean", (0, None), None),
    Candidate("drift", (0, 1), None),
    Candidate("ar", (0, None), (1, None)),
    Candidate("ar_diff", (0, 1), (1, 2)),
)
SEASONAL = (
    Candidate("season_drift", (0, SEASON), None),
    Candidate("season_ar", (0, None), (SEASON, None)),
    Candidate("season_diff_ar", (0, SEASON), (1, SEASON + 1)),
)


def _term(pair: tuple[int, int | None]) -> Column:
    first, second = pair
    base = F.col(f"_y{first}")
    return base if second is None else base - F.col(f"_y{second}")


def _fits(candidates: Sequence[Candidate]) -> list[Column]:
    """Slope, intercept and squared error of each candidate."""
    out = []
    for c in candidates:
        y = _term(c.response)
        if c.regressor is None:
            slope, inter = F.lit(0.0), F.avg(y)
            sse = F.var_pop(y) * F.count(y)
        else:
            x = _term(c.regressor)
            slope, inter = F.regr_slope(y, x), F.regr_intercept(y, x)
            sse = F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x)
        out += [slope.alias(f"{c.name}_b"), inter.alias(f"{c.name}_c"), sse.alias(f"{c.name}_sse")]
    return out


def _aicc(c: Candidate) -> Column:
    """Null when the fit failed or has too few rows."""
    k = 2 if c.regressor is None else 3
    n = F.col("n").cast("double")
    sse = F.greatest(F.col(f"{c.name}_sse"), F.lit(SSE_FLOOR))
    penalty = F.lit(2.0 * k) + F.lit(2.0 * k * (k + 1)) / (n - k - 1)
    usable = (n > k + 1) & F.col(f"{c.name}_c").isNotNull() & F.col(f"{c.name}_b").isNotNull()
    return F.when(usable, n * F.log(sse / n) + penalty)


def _forecast(c: Candidate, horizon: int) -> Column:
    """The value ``horizon`` months on, stepping the recursion from the last observed lags."""
    steps: dict[int, Column] = {}

    def y(step: int) -> Column:
        """y at T + step; observed values are ``_y<lag>`` of the last row."""
        return steps[step] if step > 0 else F.col(f"_y{-step}")

    for h in range(1, horizon + 1):
        value = F.col(f"{c.name}_c")
        if c.regressor is not None:
            a, b = c.regressor
            x = y(h - a) if b is None else y(h - a) - y(h - b)
            value = value + F.col(f"{c.name}_b") * x
        base = c.response[1]
        steps[h] = value if base is None else value + y(h - base)
    return steps[horizon]


def fit_family(
    history: DataFrame,
    candidates: Sequence[Candidate],
    keys: Sequence[str] = ("product_id",),
    horizon: int = 2,
    log: bool = True,
) -> DataFrame:
    """Best candidate per series and its forecast; series where none can be fitted are left out.

    ``history`` is gap-free and ends at the anchor for every series.
    """
    depth = max(
        lag for c in candidates for pair in (c.response, c.regressor or (0, None)) for lag in pair if lag is not None
    )
    w = S.series(keys)
    y = F.log1p(F.greatest("tn", F.lit(0.0))) if log else F.col("tn")
    lagged = X.with_columns(history.withColumn("_y0", y), {f"_y{n}": S.lag("_y0", n, w) for n in range(1, depth + 1)})
    full = F.col(f"_y{depth}").isNotNull()
    used = [c.alias(n) for n, c in {f"_y{n}": F.when(full, F.col(f"_y{n}")) for n in range(depth + 1)}.items()]
    rows = lagged.select(*keys, "periodo", *used)
    lags = [f"_y{n}" for n in range(depth + 1)]
    fitted = rows.groupBy(*keys).agg(
        F.count("_y0").alias("n"), F.max_by(F.struct(*lags), "periodo").alias("_last"), *_fits(candidates)
    )
    fitted = fitted.select("*", "_last.*")
    choices = F.array(
        *[
            F.struct(
                _aicc(c).alias("aicc"), F.lit(i).alias("rank"), F.lit(c.name).alias("model"),
                _forecast(c, horizon).alias("forecast"),
            )
            for i, c in enumerate(candidates)
        ]
    )
    best = F.array_min(F.filter(choices, lambda s: s["aicc"].isNotNull() & s["forecast"].isNotNull()))
    chosen = fitted.select(*keys, "n", best.alias("_best")).where(F.col("_best").isNotNull())
    value = F.expm1("_best.forecast") if log else F.col("_best.forecast")
    return chosen.select(
        *keys, F.greatest(value, F.lit(0.0)).alias("tn"), F.col("_best.model").alias("model"),
        F.col("_best.aicc").alias("aicc"), F.col("n").alias("rows_used"),
    )


def two_pass_forecast(
    history: DataFrame,
    anchor: int,
    keys: Sequence[str] = ("product_id",),
    horizon: int = 2,
    log: bool = True,
    done: DataFrame | None = None,
) -> DataFrame:
    """Seasonal family first, the plain one for series it cannot fit, then the 12-month mean.

    ``done`` holds results of an earlier run; those series are not fitted again.
    A ``status`` column says which step gave the value.
    """
    past = history.where(F.col("periodo") <= anchor)
    if done is not None:
        past = without_keys(past, done, keys)
    regular = stored(densify(past, keys, until=anchor), "regular")
    first = stored(fit_family(regular, (*SEASONAL, *PLAIN), keys, horizon, log), "seasonal")
    second = stored(fit_family(without_keys(regular, first, keys), PLAIN, keys, horizon, log), "plain")
    out = first.withColumn("status", F.lit("seasonal")).unionByName(second.withColumn("status", F.lit("plain")))
    left = without_keys(without_keys(mean_12(regular, anchor, keys), first, keys), second, keys)
    rest = left.select(
        *keys, "tn", F.lit("mean_12").alias("model"), F.lit(None).cast("double").alias("aicc"),
        F.lit(0).cast("bigint").alias("rows_used"), F.lit("fallback").alias("status"),
    )
    return out.unionByName(rest)
