"""Features of a gap-free monthly series, by product or any other key.

All features at month t use months up to t; the target is ``horizon`` rows ahead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.functions import series as S
from lagfield.functions.periods import month_of
from lagfield.functions.scalars import lenient_double, ratio
from lagfield.operators import features as X
from lagfield.operators.features import FeatureSet
from lagfield.operators.relational import attach
from lagfield.session import stored


@dataclass(frozen=True)
class ProductConfig:
    """Which feature groups to build."""

    keys: tuple[str, ...] = ("product_id",)
    horizon: int = 2
    lags: tuple[int, ...] = tuple(range(13))
    windows: tuple[int, ...] = ()
    deltas: bool = False
    intermittency: bool = False
    calendar: bool = False
    shares: bool = False
    attributes: bool = False
    stocks: bool = False


# fixed values: category columns and the names of their codes
CATEGORY_NAMES = {"cat1": "cat1", "cat2": "cat2", "cat3": "cat3_cat", "brand": "brand"}


def _joined(history: DataFrame, cfg: ProductConfig, attributes: DataFrame | None, stocks: DataFrame | None) -> DataFrame:
    spread = [*cfg.keys, "periodo"]
    df = history
    if cfg.shares or cfg.attributes:
        if attributes is None:
            raise ValueError("shares and attributes need the product table")
        traits = stored(X.clean_attributes(attributes), "attributes")
        if cfg.attributes:
            coded = X.coded_attributes(traits, CATEGORY_NAMES)
            coded = coded.withColumn("sku_size", lenient_double("sku_size"))
            traits = traits.select("product_id", F.col("cat3").alias("_cat3")).join(coded, "product_id")
        else:
            traits = traits.select("product_id", F.col("cat3").alias("_cat3"))
        df = attach(df, traits, ["product_id"], spread)
    if cfg.shares:
        universe = df.groupBy("periodo").agg(F.sum("tn").alias("_universe"))
        category = df.groupBy("_cat3", "periodo").agg(F.sum("tn").alias("_category"))
        # one row per month
        df = df.join(F.broadcast(universe), "periodo", "left")
        df = attach(df, stored(category, "category"), ["_cat3", "periodo"], spread)
    if cfg.stocks:
        if stocks is None:
            raise ValueError("stocks need the stock table")
        side = stored(X.clean_stocks(stocks), "stocks")
        df = attach(df, side, ["product_id", "periodo"], spread)
        df = X.with_columns(df, X.stock_state("stock_final", "stock_disponible", "stock_negativo"))
    return df


def build_features(
    history: DataFrame,
    cfg: ProductConfig,
    attributes: DataFrame | None = None,
    stocks: DataFrame | None = None,
) -> FeatureSet:
    """Feature table of ``history`` (keys, periodo, tn) for the groups switched on in ``cfg``."""
    w = S.series(cfg.keys)
    df = _joined(history, cfg, attributes, stocks)
    kinds = ("mean", "std", "max", "min")

    windowed = {f"lag_{n}": S.lag("tn", n, w) for n in cfg.lags}
    windowed["target"] = S.lag("tn", -cfg.horizon, w)
    if cfg.deltas:
        windowed |= {"_tn_1": S.lag("tn", 1, w), "_tn_12": S.lag("tn", 12, w)}
    if cfg.intermittency:
        windowed |= {"ceros_12": S.rolling((F.col("tn") == 0).cast("int"), "sum", 12, w), "_idx": S.row_index(w)}
    if cfg.shares:
        windowed |= {"_universe_12": S.lag("_universe", 12, w), "_category_12": S.lag("_category", 12, w)}
    if cfg.stocks:
        windowed |= X.lag_columns("stock_0", X.STOCK_LAGS, w, "stock_lag_")
    windowed |= X.rolling_frames("tn", cfg.windows, w, kinds)
    df = X.finish_rolling(X.with_columns(df, windowed), cfg.windows, kinds)

    feats = [f"lag_{n}" for n in cfg.lags] + X.rolling_names(cfg.windows, kinds)
    categorical: list[str] = []
    derived = {}
    if cfg.deltas:
        changes = {
            "delta_1": F.col("tn") - F.col("_tn_1"),
            "delta_12": F.col("tn") - F.col("_tn_12"),
            "ratio_1": ratio("tn", "_tn_1"),
            "ratio_12": ratio("tn", "_tn_12"),
        }
        if 12 in cfg.windows:
            changes["tn_vs_rmean12"] = ratio("tn", "rmean_12")
        if {3, 12} <= set(cfg.windows):
            changes["momentum_3_12"] = ratio("rmean_3", "rmean_12")
        derived |= changes
        feats += changes
    if cfg.intermittency:
        derived["meses_desde_venta"] = S.rows_since(F.col("tn") > 0, "_idx", w)
        feats += ["ceros_12", "meses_desde_venta"]
    if cfg.calendar:
        derived["mes"] = month_of("periodo")
        feats.append("mes")
        categorical.append("mes")
    if cfg.shares:
        parts = {
            "share_universo": ratio("tn", "_universe"),
            "share_cat3": ratio("tn", "_category"),
            "universo_yoy": ratio("_universe", "_universe_12"),
            "cat3_yoy": ratio("_category", "_category_12"),
        }
        derived |= parts
        feats += parts
    if cfg.attributes:
        codes = list(CATEGORY_NAMES.values())
        feats += [*codes, "sku_size"]
        categorical += codes
    if cfg.stocks:
        stock = {
            "stock_delta_1": F.col("stock_0") - F.col("stock_lag_1"),
            "stock_delta_12": F.col("stock_0") - F.col("stock_lag_12"),
            "stock_vs_tn": X.coverage("stock_0", "tn"),
        }
        for n in (3, 12):
            if n in cfg.windows:
                stock[f"stock_cobertura_{n}"] = X.coverage("stock_0", f"rmean_{n}")
        derived |= stock
        feats += ["stock_disponible", "stock_negativo", "stock_0"]
        feats += [f"stock_lag_{n}" for n in X.STOCK_LAGS] + list(stock)
    df = X.with_columns(df, derived)
    base = [*cfg.keys, "periodo", "tn"]
    return FeatureSet(df.select(*base, *feats, "target"), feats, categorical)


def regression_stock_table(history: DataFrame, stocks: DataFrame, lags: int = 12, horizon: int = 2) -> DataFrame:
    """Lags of sales with stock columns lagged inside the stock table, for the linear route."""
    w = S.series(["product_id"])
    names = [f"lag_{n}" for n in range(lags)]
    table = X.with_columns(
        history, {**X.lag_columns("tn", range(lags), w), "target": S.lag("tn", -horizon, w)}
    )
    present = [F.coalesce(F.col(n), F.lit(0.0)) for n in names]
    seen = sum((F.col(n).isNotNull().cast("int") for n in names), F.lit(0))
    table = table.withColumn("mean12", F.try_divide(sum(present, F.lit(0.0)), seen))
    side = X.with_columns(X.clean_stocks(stocks), X.lag_columns("stock_final", (1, 2), w, "stock_lag_"))
    joined = attach(table, stored(side, "stock-lags"), ["product_id", "periodo"], ["periodo", "product_id"])
    return X.with_columns(
        joined,
        {
            "stock_delta_1": F.col("stock_final") - F.col("stock_lag_1"),
            "stock_cobertura_12": X.coverage("stock_final", "mean12"),
            "stock_negativo": (F.col("stock_final") < 0).cast("int"),
        },
    )
