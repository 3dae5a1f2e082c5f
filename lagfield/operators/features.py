"""Shared parts of the feature builders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from lagfield.functions import series as S
from lagfield.functions.scalars import STOCK_EPS, ratio
from lagfield.operators.relational import attach, category_codes, first_per_key, is_small
from lagfield.session import stored

# fixed values: lags of the stock columns
STOCK_LAGS = (1, 2, 3, 6, 12)


@dataclass(frozen=True)
class FeatureSet:
    """A feature table with the names a model should use."""

    table: DataFrame
    features: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)


def lag_columns(x: str, lags: Sequence[int], w: WindowSpec, prefix: str = "lag_") -> dict[str, Column]:
    return {f"{prefix}{n}": S.lag(x, n, w) for n in lags}


ROLLING_NAMES = {"mean": "rmean", "std": "rstd", "max": "rmax", "min": "rmin", "median": "rmed"}


def rolling_names(windows: Sequence[int], kinds: Sequence[str]) -> list[str]:
    return [f"{ROLLING_NAMES[k]}_{n}" for n in windows for k in kinds]


def rolling_frames(x: str, windows: Sequence[int], w: WindowSpec, kinds: Sequence[str]) -> dict[str, Column]:
    """Window columns :func:`finish_rolling` works from; put them in one select with other windows.

    Means and deviations are window aggregates. Order statistics of all sizes
    come from one array of the widest window, cut and sorted per size, which
    costs a fraction of a percentile or extreme per frame.
    """
    if not windows:
        return {}
    held = F.collect_list(F.coalesce(F.col(x).cast("double"), F.lit(float("nan"))))
    frames = {"_frame": held.over(S.trailing(w, max(windows)))}
    for n in windows:
        for kind in ("mean", "std"):
            if kind in kinds:
                frames[f"_{kind}_{n}"] = S.rolling(x, kind, n, w, min_rows=1)
    return frames


def with_rolling(df: DataFrame, x: str, windows: Sequence[int], w: WindowSpec, kinds: Sequence[str]) -> DataFrame:
    """Add full-window statistics named ``r<kind>_<size>``."""
    return finish_rolling(with_columns(df, rolling_frames(x, windows, w, kinds)), windows, kinds)


def finish_rolling(df: DataFrame, windows: Sequence[int], kinds: Sequence[str]) -> DataFrame:
    """Turn the frames into statistics; null until the window is full or if it holds a null."""
    if not windows:
        return df
    cut = {
        f"_sorted_{n}": F.when(F.size("_frame") >= n, F.sort_array(F.slice("_frame", F.lit(-n), F.lit(n))))
        for n in windows
    }
    df = with_columns(df, cut)
    out = {}
    for n in windows:
        values = F.col(f"_sorted_{n}")
        # NaN sorts last, so the last value tells whether the window has a null
        full = values.isNotNull() & ~F.isnan(F.get(values, F.lit(n - 1)))
        stats = {
            "mean": F.col(f"_mean_{n}") if "mean" in kinds else None,
            "std": F.col(f"_std_{n}") if "std" in kinds else None,
            "min": F.get(values, F.lit(0)),
            "max": F.get(values, F.lit(n - 1)),
            "median": (F.get(values, F.lit((n - 1) // 2)) + F.get(values, F.lit(n // 2))) / 2,
        }
        out |= {f"{ROLLING_NAMES[k]}_{n}": F.when(full, stats[k]) for k in kinds}
    spent = ["_frame", *cut, *[f"_{k}_{n}" for n in windows for k in ("mean", "std") if k in kinds]]
    return with_columns(df, out).drop(*spent)


def clean_attributes(attributes: DataFrame) -> DataFrame:
    """One attribute row per product."""
    cols = [c for c in ("cat1", "cat2", "cat3", "brand", "sku_size") if c in attributes.columns]
    return first_per_key(attributes.select("product_id", *cols), ["product_id"], cols)


def clean_stocks(stocks: DataFrame) -> DataFrame:
    """One stock row per product and month; the largest value wins among copies."""
    return stocks.groupBy("product_id", "periodo").agg(F.max("stock_final").alias("stock_final"))


def coded_attributes(attributes: DataFrame, names: dict[str, str]) -> DataFrame:
    """Replace category columns by integer codes in ascending order of the category text."""
    codes = stored(category_codes(attributes, list(names)), "codes")
    small = is_small(codes)
    out = attributes
    for source, target in names.items():
        side = codes.where(F.col("kind") == source).select(
            F.col("category").alias("_category"), F.col("code").alias(f"_code_{target}")
        )
        keyed = out.withColumn("_category", F.col(source).cast("string"))
        joined = keyed.join(F.broadcast(side), "_category", "left") if small else attach(keyed, side, ["_category"], ["product_id"])
        out = joined.drop("_category")
    keep = [c for c in attributes.columns if c not in names]
    return out.select(*keep, *[F.col(f"_code_{t}").alias(t) for t in names.values()])


def stock_state(stock: str, available: str, negative: str) -> dict[str, Column]:
    """Missing stock is flagged before it becomes 0, so it is not mistaken for zero stock."""
    x = F.col(stock)
    return {
        available: x.isNotNull().cast("int"),
        negative: F.coalesce(x < 0, F.lit(False)).cast("int"),
        "stock_0": F.coalesce(x, F.lit(0.0)),
    }


def coverage(stock: str, level: str) -> Column:
    return ratio(stock, F.abs(F.col(level)), STOCK_EPS)


def with_columns(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add all columns in one projection."""
    return df.select("*", *[c.alias(n) for n, c in cols.items()])
