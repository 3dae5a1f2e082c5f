"""The registered queries: one entry per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagfield.functions import scalars as C
from lagfield.functions import series as S
from lagfield.functions.periods import (
    add_months, month_of, period_of, shift_period, to_month_start, to_month_timestamp, year_of,
)
from lagfield.operators import blend as B
from lagfield.operators import explore as E
from lagfield.operators import features as X
from lagfield.operators import leaderboard as L
from lagfield.operators import metrics as M
from lagfield.operators import naive as N
from lagfield.operators import panel as P
from lagfield.operators import relational as R
from lagfield.operators import relations as Y
from lagfield.operators import shape as D
from lagfield.operators import structure as G
from lagfield.operators import walk_forward as K
from lagfield.operators.learners import boosted_l1
from lagfield.operators.linear import forecast_on_lags, stock_group_search
from lagfield.operators.pair_features import PairConfig, attach_segments, scaled, to_products, unscaled
from lagfield.operators.pair_features import build_features as build_pair
from lagfield.operators.product_features import ProductConfig, regression_stock_table
from lagfield.operators.product_features import build_features as build_product
from lagfield.operators.seasonal import two_pass_forecast
from lagfield.plans.pair_hurdle import Validation, evaluate
from lagfield.session import shared_dir, stored, stored_by, tune
from lagfield.sources import io as IO
from lagfield.sources import testviews as V

# Anchors of the test data: one to score, two with a known target.
SCORE, SEASON, CONTROL = 200107, 200007, 200105
YEAR = 2000
# fixed value: months of the test data up to the last anchor
MONTHS = 79
PAIR = list(P.PAIR)
GRAIN = list(P.GRAIN)
Query = Callable[[SparkSession, str], DataFrame]

_KEPT: dict[tuple, DataFrame] = {}


def kept(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[..., DataFrame], pair_parts: Callable[[], int] | None = None,
    keys: Sequence[str] = P.PAIR,
) -> DataFrame:
    """A table many queries share, written once per session and data folder; by pair, or ``keys``, if the parts for it are given."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _KEPT:
        if pair_parts is None:
            _KEPT[key] = stored(build(), name)
        else:
            parts = pair_parts()
            _KEPT[key] = stored_by(build(parts), keys, parts, name)
    return _KEPT[key]


def sales(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d, "sales", lambda: V.sales(spark, d))


def sparse(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d, "sparse", lambda: V.sales_sparse(spark, d))


def panel(spark: SparkSession, d: str) -> DataFrame:
    return P.unpacked(kept(spark, d, "panel", lambda parts: P.packed_panel(sales(spark, d), parts=parts), lambda: P.pair_parts(sales(spark, d))))


def product_panel(spark: SparkSession, d: str) -> tuple[DataFrame, bool]:
    """The panel for features of pair and product month, and whether it lies by product, which spares it every shuffle."""
    facts = sales(spark, d)
    if not P.fits_by_product(facts):
        return panel(spark, d), False
    keys = ["product_id"]
    build = lambda parts: P.packed_panel(facts, parts=parts, keys=keys)
    return P.unpacked(kept(spark, d, "product-panel", build, lambda: P.pair_parts(facts, P.SORTED_PAIRS), keys)), True


def sparse_panel(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d, "sparse-panel", lambda: P.pair_panel(sparse(spark, d)))


def observed(spark: SparkSession, d: str) -> DataFrame:
    """Product months that have facts, for the requested products."""
    return R.keep_ids(P.monthly_total(sales(spark, d)), V.requested(spark, d), "product_id", ["periodo"])


def history(spark: SparkSession, d: str) -> DataFrame:
    return kept(spark, d, "history", lambda: P.densify(observed(spark, d), ["product_id"]))


def tidy(df: DataFrame, digits: int = 6, fine: Sequence[str] = ()) -> DataFrame:
    """Round doubles for comparison, ``fine`` ones to nine digits; adding 0.0 turns -0.0 into 0.0."""
    return df.select(
        *[
            (F.round(F.col(f.name), 9 if f.name in fine else digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else f.name
            for f in df.schema
        ]
    )


# --- sources, sinks, state -------------------------------------------------


def forecast_check(spark, d):
    """A forecast with unique ids passes; its row and id counts are returned."""
    ok = B.checked_forecast(N.complete(V.requested(spark, d), N.last_month(observed(spark, d), SCORE), N.mean_12(observed(spark, d), SCORE)))
    return ok.agg(F.count(F.lit(1)).alias("filas"), F.count_distinct("product_id").alias("ids"))


def run_log_union(spark, d):
    """Run rows whose columns and types differ, in one table."""
    obs = observed(spark, d)
    old = obs.groupBy("product_id").agg(F.count(F.lit(1)).cast("int").alias("meses"))
    new = obs.groupBy("product_id").agg(F.sum("tn").alias("meses"), F.max("periodo").alias("ultimo"))
    return R.union_relaxed(old, new)


def anti_resume(spark, d):
    """Series still to be done after part of them is finished."""
    done = N.last_month(observed(spark, d), SCORE)
    todo = V.requested(spark, d)
    return R.without_keys(todo, done, ["product_id"])


def one_row_per_month(spark, d):
    return tidy(P.one_row_per_month(V.sale_lines(spark, d)))


# --- panel -----------------------------------------------------------------


def densify_monthly(spark, d):
    return P.densify(observed(spark, d), ["product_id"])


def zero_fill_panel(spark, d):
    return P.zero_fill(sales(spark, d))


def zero_fill_lines(spark, d):
    """Zero fill that keeps repeated facts, counted per month."""
    lines = kept(spark, d, "lines", lambda: V.sale_lines(spark, d))
    filled = P.zero_fill(lines)
    return filled.groupBy("periodo", "product_id").agg(
        F.count(F.lit(1)).alias("filas"), F.sum("tn").alias("tn"), F.sum("plan_flag").cast("bigint").alias("en_plan")
    )


def pair_panel(spark, d):
    return P.pair_panel(sales(spark, d))


def plan_flag_range(spark, d):
    return P.zero_rows(sales(spark, d)).select(*GRAIN, "plan_flag")


def lives(spark, d):
    s = sales(spark, d)
    starts = P.customer_start(s).select(
        F.lit("cliente").alias("tipo"), F.col("customer_id").cast("bigint").alias("id"), F.col("started").alias("desde")
    )
    products = P.product_life(s).select(
        F.lit("producto").alias("tipo"), F.col("product_id").alias("id"), F.col("born").alias("desde"),
        F.col("died").alias("hasta"), "plan_from", "plan_to",
    )
    return products.unionByName(starts, allowMissingColumns=True)


def period_functions(spark, d):
    """Month arithmetic and dates for every product month."""
    obs = observed(spark, d)
    return obs.select(
        "product_id", "periodo", add_months("periodo", 2).alias("mas_2"), add_months("periodo", -13).alias("menos_13"),
        to_month_start("periodo").alias("ds"), to_month_timestamp("periodo").alias("marca"),
        period_of(to_month_start("periodo")).alias("vuelta"), month_of("periodo").alias("mes"),
        year_of("periodo").alias("anio"),
    )


def lag_table_positional(spark, d):
    return P.lag_table(sales(spark, d), PAIR)


def lag_table_calendar(spark, d):
    return P.calendar_lag_table(sales(spark, d), PAIR)


def last_observed(spark, d):
    return P.last_observed(P.monthly_total(sales(spark, d), PAIR), PAIR)


def anchor_split(spark, d):
    """Row counts of the training and validation parts of each anchor."""
    table = P.calendar_lag_table(observed(spark, d), target="target", prefix="lag_")
    return P.split_counts(table, (SEASON, CONTROL))


def complete_rows(spark, d):
    """Rows left after those with a null lag or target are dropped."""
    table = P.calendar_lag_table(observed(spark, d), target="target", prefix="lag_")
    return table.dropna(subset=[*C.starting_with(table, "lag_"), "target"]).select("product_id", "periodo", "target")


# --- window features -------------------------------------------------------


def rolling_full_window(spark, d):
    rows = panel(spark, d).select(*GRAIN, "tn")
    return tidy(X.with_rolling(rows, "tn", (3, 6, 9, 12), S.series(PAIR), ("mean", "std", "max", "min")).drop("tn"))


def rolling_median(spark, d):
    rows = panel(spark, d).select(*GRAIN, "tn")
    return tidy(X.with_rolling(rows, "tn", (3, 6, 9, 12, 24), S.series(PAIR), ("median",)).drop("tn"))


def rolling_min1(spark, d):
    w = S.series(PAIR)
    sums = [S.rolling("tn", "sum", n, w, min_rows=1).alias(f"suma_{n}") for n in (3, 6, 12)]
    return tidy(panel(spark, d).select(*GRAIN, S.rolling("tn", "mean", 12, w, min_rows=1).alias("media_12"), *sums))


def ewm(spark, d):
    w = S.series(PAIR)
    rows = panel(spark, d).select(*GRAIN, "tn", S.row_index(w).alias("idx"))
    return tidy(rows.select(*GRAIN, S.ewm_mean("tn", 3, "idx", w).alias("ewm_3"), S.ewm_mean("tn", 6, "idx", w).alias("ewm_6")), fine=("ewm_3", "ewm_6"))


def months_since_event(spark, d):
    w = S.series(PAIR)
    rows = panel(spark, d).select(*GRAIN, "tn", S.row_index(w).alias("idx"))
    return rows.select(
        *GRAIN, S.rows_since(F.col("tn") > 0, "idx", w).alias("meses"),
        S.carried(F.when(F.col("tn") > 0, F.col("tn")), w).alias("ultima"),
    )


def cumulative_buys(spark, d):
    w = S.series(PAIR)
    rows = panel(spark, d).withColumn("buy", (F.col("tn") > 0).cast("int"))
    total = S.running_sum("buy", w)
    return rows.select(*GRAIN, total.alias("compras")).withColumn("regimen", G.regime_of(F.col("compras")))


def _product(spark, d, **groups):
    need = {}
    if groups.get("shares") or groups.get("attributes"):
        need["attributes"] = V.products(spark, d)
    if groups.get("stocks"):
        need["stocks"] = V.stocks(spark, d)
    return build_product(history(spark, d), ProductConfig(**groups), **need)


def _product_columns(spark, d, cols: Sequence[str] | None = None, **groups):
    built = _product(spark, d, **groups)
    return tidy(built.table.select("product_id", "periodo", *(cols or built.features)))


def product_lags(spark, d):
    return tidy(_product(spark, d).table)


def deltas_ratios(spark, d):
    names = ["delta_1", "delta_12", "ratio_1", "ratio_12", "tn_vs_rmean12", "momentum_3_12"]
    return _product_columns(spark, d, names, windows=(3, 6, 12), deltas=True)


def intermittency(spark, d):
    return _product_columns(spark, d, ["ceros_12", "meses_desde_venta", "mes"], intermittency=True, calendar=True)


def category_share(spark, d):
    return _product_columns(spark, d, ["share_universo", "share_cat3", "universo_yoy", "cat3_yoy"], shares=True)


def product_attributes(spark, d):
    return _product_columns(spark, d, ["cat1", "cat2", "cat3_cat", "brand", "sku_size"], attributes=True)


def stock_features(spark, d):
    built = _product(spark, d, windows=(3, 12), stocks=True)
    return tidy(built.table.select("product_id", "periodo", *[f for f in built.features if f.startswith("stock")]))


def product_feature_table(spark, d):
    """All 60 product features."""
    return tidy(_full_product(spark, d).table)


def _full_product(spark, d):
    return _product(
        spark, d, windows=(3, 6, 9, 12), deltas=True, intermittency=True, calendar=True, shares=True,
        attributes=True, stocks=True,
    )


def stock_regression_table(spark, d):
    names = ["mean12", "stock_final", "stock_lag_1", "stock_lag_2", "stock_delta_1", "stock_cobertura_12", "stock_negativo"]
    table = regression_stock_table(observed(spark, d), V.stocks(spark, d))
    return tidy(table.select("product_id", "periodo", *names, "target"))


# --- pair features ---------------------------------------------------------

PAIR_OFF = dict(history=False, purchases=False, shares=False, price=False, stocks=False)


def _pair(spark, d, **groups):
    cfg = PairConfig(**{**PAIR_OFF, **groups})
    rows, by_product = product_panel(spark, d)
    return build_pair(rows, cfg, V.products(spark, d), V.stocks(spark, d), by_product)


def _pair_columns(spark, d, keep=None, **groups):
    built = _pair(spark, d, **groups)
    names = [f for f in built.features if f != "promedio_nivel" and (keep is None or keep(f))]
    return tidy(built.table.select(*GRAIN, *names), fine=("ewm_3", "ewm_6"))


def pair_scaling(spark, d):
    return tidy(scaled(panel(spark, d)).select(*GRAIN, "promedio_nivel", "tn_esc", "target_tn", "target", "target_buy"))


def pair_lags(spark, d):
    return _pair_columns(spark, d, lambda f: f.startswith("lag_"), history=True)


def pair_rolling(spark, d):
    return _pair_columns(spark, d, lambda f: f[:2] == "rm" or f.startswith("rstd"), history=True)


def pair_deltas(spark, d):
    return _pair_columns(
        spark, d, lambda f: f.startswith(("delta", "dlag", "slope", "ratio", "ewm")), history=True
    )


def pair_purchases(spark, d):
    return _pair_columns(spark, d, purchases=True)


def pair_shares(spark, d):
    return _pair_columns(spark, d, shares=True)


def fill_rate_lags(spark, d):
    return _pair_columns(spark, d, price=True)


def pair_stock(spark, d):
    return _pair_columns(spark, d, lambda f: f.startswith("stock"), shares=True, stocks=True)


def full_pair(spark, d):
    """All 82 pair features."""
    rows, by_product = product_panel(spark, d)
    return build_pair(rows, PairConfig(), V.products(spark, d), V.stocks(spark, d), by_product)


def pair_feature_table(spark, d):
    """All 82 pair features of every pair and month."""
    return tidy(full_pair(spark, d).table.select(*GRAIN, *full_pair_names()), fine=("ewm_3", "ewm_6"))


def leakage_check(spark, d):
    """Product features at an anchor, built with and without the months after it: rows that differ, per feature."""
    known = observed(spark, d)
    groups = {"windows": (3, 6, 12), "deltas": True, "shares": True}
    full = build_product(P.densify(known, ["product_id"]), ProductConfig(**groups), attributes=V.products(spark, d))
    past = known.where(F.col("periodo") <= CONTROL)
    cut = build_product(P.densify(past, ["product_id"]), ProductConfig(**groups), attributes=V.products(spark, d))
    at = F.col("periodo") == CONTROL
    return M.changed_features(full.table.where(at), cut.table.where(at), ["product_id"], full.features)


def _folder(spark: SparkSession, name: str) -> str:
    run = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/lagfield/{run}/{name}-{uuid.uuid4().hex}"


def sales_csv_file(spark, d):
    """The facts written as compressed text in order, and read again by name and type."""
    path = _folder(spark, "sales-csv")
    facts = sales(spark, d)
    IO.write_csv(facts, path, "gzip", GRAIN)
    return IO.read_delimited(spark, path, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in facts.schema))


def panel_month_file(spark, d):
    """The panel written by month; one month is read back."""
    path = _folder(spark, "panel-months")
    IO.write_panel(panel(spark, d), path, files=2)
    return spark.read.parquet(path).where(F.col("periodo") == CONTROL).select(*panel(spark, d).columns)


def run_log_file(spark, d):
    """Runs logged one by one, with columns and types that differ, and read as one table."""
    path = _folder(spark, "run-log")
    one = M.wape(_control(spark, d, "mean_12"), "tn_real", "tn").select(F.lit("mean_12").alias("run"), "wape")
    IO.append_log(one, path)
    counted = _control(spark, d, "last_month").agg(F.lit("last_month").alias("run"), F.count(F.lit(1)).cast("int").alias("n"))
    IO.append_log(counted, path)
    IO.append_log(counted.select(F.lit("again").alias("run"), F.col("n").cast("bigint")), path)
    return tidy(IO.read_log(spark, path).select("run", "wape", F.col("n").cast("bigint")))


def _control(spark, d, name):
    real = observed(spark, d).where(F.col("periodo") == shift_period(CONTROL, 2)).select("product_id", F.col("tn").alias("tn_real"))
    return real.join(N.BASELINES[name](observed(spark, d).where(F.col("periodo") <= CONTROL), CONTROL), "product_id")


def collapse_to_products(spark, d):
    """Un-scaled pair predictions summed to products, with the truth."""
    rows = scaled(panel(spark, d)).where(F.col("periodo") == CONTROL).withColumn("pred_scaled", F.col("tn_esc"))
    return tidy(to_products(unscaled(rows), "pred_tn"))


# --- structure -------------------------------------------------------------


def _requested_panel(spark, d):
    return R.keep_ids(panel(spark, d), V.requested(spark, d), "product_id", PAIR)


def lifecycle_flags(spark, d):
    return G.lifecycle(_requested_panel(spark, d)).select(*GRAIN, "buy", "prior_12", "is_new", "is_repeat", "is_churn", "regime")


def structure_agg(spark, d):
    return tidy(G.structure(_requested_panel(spark, d)))


def structure_lags(spark, d):
    return tidy(G.structure_lags(G.structure(_requested_panel(spark, d))).table)


# --- baselines, evaluation, blends ----------------------------------------


def naive_last(spark, d):
    return N.last_month(observed(spark, d), SCORE)


def naive_mean12(spark, d):
    return tidy(N.mean_12(observed(spark, d), SCORE))


def naive_same_month(spark, d):
    return tidy(N.same_month(observed(spark, d), SCORE))


def forecast_fallback(spark, d):
    """Requested products: same month last year, else the 12-month mean, else 0."""
    obs = observed(spark, d)
    return tidy(N.submission(V.requested(spark, d), N.same_month(obs, SCORE), obs, SCORE))


def _truth(spark, d, anchor):
    target = shift_period(anchor, 2)
    return observed(spark, d).where(F.col("periodo") == target).select("product_id", F.col("tn").alias("tn_real"))


def wape_total(spark, d):
    """Error of the flagship forecast at the control anchor."""
    obs = observed(spark, d)
    past = obs.where(F.col("periodo") <= CONTROL)
    pred = N.submission(V.requested(spark, d), N.same_month(past, CONTROL), past, CONTROL)
    return tidy(M.total_error_rate(pred, _truth(spark, d, CONTROL)))


def _pair_naive(spark, d):
    w = S.series(PAIR)
    return panel(spark, d).select(*GRAIN, F.col("tn").alias("pred_tn"), S.lag("tn", -2, w).alias("target_tn"))


def product_wape(spark, d):
    rows = _pair_naive(spark, d).where((F.col("periodo") == CONTROL) & F.col("target_tn").isNotNull())
    return tidy(M.product_wape(rows))


def pooled_wape(spark, d):
    anchors = [shift_period(CONTROL, -n) for n in (2, 1, 0)]
    rows = _pair_naive(spark, d).where(F.col("periodo").isin(anchors))
    return tidy(M.pooled_wape(rows, P.monthly_total(sales(spark, d))))


def _scored(spark, d, anchor):
    past = observed(spark, d).where(F.col("periodo") <= anchor)
    return _truth(spark, d, anchor).join(N.mean_12(past, anchor), "product_id", "left").withColumn(
        "tn", F.coalesce("tn", F.lit(0.0))
    )


def calibration_grid(spark, d):
    return tidy(M.scale_scores(_scored(spark, d, CONTROL)))


def calibration_best(spark, d):
    return tidy(M.best_scale(_scored(spark, d, CONTROL)))


def calibration_median(spark, d):
    """Median of the best scales of both anchors."""
    rows = [M.best_scale(_scored(spark, d, a)).select(F.lit("mean_12").alias("variant"), F.col("scale").alias("calibration")) for a in (SEASON, CONTROL)]
    return tidy(M.median_scale(rows[0].unionByName(rows[1])))


def baseline_runs(spark, d):
    obs = observed(spark, d)
    out = None
    for anchor in (SEASON, CONTROL):
        past = obs.where(F.col("periodo") <= anchor)
        for name, make in N.BASELINES.items():
            row = M.total_error_rate(make(past, anchor), _truth(spark, d, anchor)).select(
                F.lit(name).alias("candidate"), F.lit(anchor).alias("anchor"), "wape"
            )
            out = row if out is None else out.unionByName(row)
    return out


def pivot_scores(spark, d):
    wide = baseline_runs(spark, d).groupBy("candidate").pivot("anchor", [SEASON, CONTROL]).agg(F.first("wape"))
    return tidy(wide.select("candidate", F.col(str(SEASON)).alias("season"), F.col(str(CONTROL)).alias("control")))


def selection_score(spark, d):
    return tidy(M.selection_scores(baseline_runs(spark, d), SEASON, CONTROL))


def pivot_months(spark, d):
    """Product series side by side for all months."""
    months = [shift_period(SCORE, -n) for n in range(MONTHS - 1, -1, -1)]
    wide = observed(spark, d).groupBy("product_id").pivot("periodo", months).sum("tn")
    return wide.select("product_id", *[F.col(str(m)).alias(f"tn_{m}") for m in months])


def _two_forecasts(spark, d):
    obs = observed(spark, d)
    return N.mean_12(obs, SCORE), N.same_month(obs, SCORE)


def blend_weights(spark, d):
    a, b = _two_forecasts(spark, d)
    return tidy(B.blend(a, b, (0.1, 0.2, 0.3)).select("weight", "product_id", "tn"))


def blend_totals(spark, d):
    a, b = _two_forecasts(spark, d)
    return tidy(B.blend_totals(B.blend(a, b, (0.1, 0.2, 0.3))))


def blend_diagnostics(spark, d):
    return tidy(B.diagnostics(*_two_forecasts(spark, d)))


# --- relational odds and ends ---------------------------------------------


def dedup_latest(spark, d):
    """One stock row per product, the latest."""
    return R.last_per_key(V.stocks(spark, d), ["product_id"], "periodo")


def dedup_subset(spark, d):
    """One customer per nation, the richest; the smaller key wins a tie."""
    customer = V.table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return R.first_per_key(customer, ["c_nationkey"], [-F.col("c_acctbal"), F.col("c_custkey")])


def override_newer(spark, d):
    obs = observed(spark, d)
    return R.overridden(N.last_month(obs, SEASON), N.last_month(obs, SCORE), ["product_id"], "tn")


def row_functions(spark, d):
    """Row-wise mean, maximum, clip, bins and lenient numbers of the lags."""
    table = P.lag_table(observed(spark, d), lags=12, prefix="l")
    lags = [f"l{i}" for i in range(12)]
    return tidy(
        table.select(
            "product_id", "periodo", C.row_mean(lags).alias("media"), C.row_max(lags).alias("mayor"),
            C.clip("l0", 100, 500).alias("recorte"), C.digitize("l0", (100, 200, 400)).alias("bin"),
            C.positive_flag("clase").alias("compra"), C.lenient_double(F.concat(F.col("l0").cast("string"), F.lit("x"))).alias("malo"),
            C.lenient_double(F.col("product_id").cast("string")).alias("bueno"),
            F.log1p("l0").alias("log"), F.expm1(F.lit(0.001) * F.col("l0")).alias("ex"),
        )
    )


def category_codes(spark, d):
    return R.category_codes(V.products(spark, d), ["cat1", "cat3", "brand"])


def exact_cuts(spark, d):
    """Exact quartiles of the log volume of all pairs."""
    totals = panel(spark, d).groupBy(*PAIR).agg(F.log1p(F.sum("tn")).alias("v"))
    cuts = R.exact_quantiles(totals, "v", (0.25, 0.5, 0.75))
    rows = [(i, c) for i, c in enumerate(cuts)]
    return tidy(spark.createDataFrame(rows, "corte int, valor double"))


# --- exploration -----------------------------------------------------------


def monthly_total(spark, d):
    return E.monthly_sales(sales(spark, d))


def yearly_total(spark, d):
    return E.yearly_sales(sales(spark, d))


def trend_line(spark, d):
    return tidy(E.trend(sales(spark, d)))


def customer_share(spark, d):
    return tidy(E.share_of_total(E.in_year(sparse(spark, d), YEAR), "customer_id"))


def distinct_customers(spark, d):
    return E.distinct_count(E.in_year(sparse(spark, d), YEAR), "customer_id")


def customer_cum_share_top20(spark, d):
    return tidy(E.largest(E.share_of_total(E.in_year(sparse(spark, d), YEAR), "customer_id"), "customer_id", 20))


def customer_cum_share_bottom300(spark, d):
    return tidy(E.smallest(E.share_of_total(E.in_year(sparse(spark, d), YEAR), "customer_id"), "customer_id", 300))


def product_cum_share(spark, d):
    shares = stored(E.share_of_total(E.in_year(sales(spark, d), YEAR), "product_id"), "shares")
    return tidy(E.with_running_share(shares, "product_id"))


def history_completeness(spark, d):
    return E.history_completeness(sales(spark, d), V.requested(spark, d), YEAR)


def pareto(spark, d):
    return E.pareto(sales(spark, d), YEAR)


def skew_stats(spark, d):
    return E.skew(sales(spark, d))


def histogram(spark, d):
    return E.histogram(sales(spark, d))


def series_filter(spark, d):
    return E.series_of(sales(spark, d), "customer_id", (1, 2, 12))


def joint_series(spark, d):
    return E.joint_series(sales(spark, d), "product_id", (1, 2, 3))


def attribute_lookup(spark, d):
    by_category = E.attributes_where(V.products(spark, d), cat3="NATION_3")
    by_ids = E.attributes_where(V.products(spark, d), product_id=[1, 2, 3])
    return by_category.unionByName(by_ids)


def label_concat(spark, d):
    traits = V.products(spark, d).select("product_id", "cat1", "cat2", "cat3", "brand")
    return E.labelled_series(sales(spark, d), traits, 3)


# --- relations -------------------------------------------------------------


def target_encoding(spark, d):
    """Earlier targets of the row's customer and of its product, for every row of the panel."""
    names = ["te_customer_id", "te_product_id"]
    return tidy(Y.target_encoding(panel(spark, d)).select(*GRAIN, *names), fine=names)


def target_encoding_leak(spark, d):
    """Rows at the score anchor whose encoding changes if all later months are taken away: none."""
    names = ["te_customer_id", "te_product_id"]
    full = Y.target_encoding(panel(spark, d)).where(F.col("periodo") == SCORE)
    cut = Y.target_encoding(panel(spark, d).where(F.col("periodo") <= SCORE)).where(F.col("periodo") == SCORE)
    return M.changed_features(full, cut, GRAIN, names)


def product_breadth(spark, d):
    """Customers that bought a product in the last 3 and 12 months, and the change."""
    return Y.breadth(sales(spark, d), "product_id", "customer_id")


def customer_diversity(spark, d):
    """Product groups that a customer bought in the last 3 and 12 months, and the change."""
    return Y.breadth(sparse(spark, d), "customer_id", "product_id", prefix="diversity")


def _levels(spark, d):
    return kept(spark, d, "levels", lambda: Y.level_totals(sales(spark, d), V.products(spark, d)))


def level_totals(spark, d):
    """Monthly totals of the universe, each category, brand, product and customer, and the year before."""
    return tidy(_levels(spark, d))


def pair_level_shares(spark, d):
    """The share of each customer and product in the totals of every level, and how these move."""
    return tidy(Y.with_level_totals(sales(spark, d), _levels(spark, d), V.products(spark, d)), fine=[f"share_{c}" for c in (Y.UNIVERSE, *Y.LEVELS)])


def plan_months(spark, d):
    """Quarter, and months in the price plan so far, of every row of the panel."""
    return Y.plan_months(panel(spark, d)).select(*GRAIN, "trimestre", "meses_en_plan")


# --- walk-forward ----------------------------------------------------------

# Anchors of the pooled back-test; the target month of each is in the data.
FOLDS = (SEASON, 200012, CONTROL)


def walk_forward_naive(spark, d):
    """Errors of the naive forecasts, pooled over three anchors."""
    rows = K.naive_folds(observed(spark, d), FOLDS)
    return tidy(K.pooled_errors(rows, ("last", "mean_12", "same_month")))


def walk_forward_ols(spark, d):
    """Errors of the linear forecast and of the naive ones for the same products and anchors."""
    linear = K.linear_folds(history(spark, d), FOLDS)
    naive = K.naive_folds(history(spark, d), FOLDS).drop("actual")
    both = linear.join(naive, ["anchor", "product_id"])
    return tidy(K.pooled_errors(both, ("ols", "last", "mean_12", "same_month")))


# --- segments --------------------------------------------------------------


def regimes(spark, d):
    return D.purchase_stats_of_facts(sparse(spark, d), SCORE)


def segment_profile(spark, d):
    """Profile of the purchase regimes."""
    return tidy(D.segment_profile(D.purchase_stats_of_facts(sparse(spark, d), SCORE), ("regime", "regime_name")))


def shape_transform(spark, d):
    """Shape values of every series, one row per month of its life."""
    return tidy(D.shape_rows(D.shaped(D.series_stats(panel(spark, d)))))


def segments_one_hot(spark, d):
    """Segment columns and flags on the rows of the score anchor; pairs without a segment get 0."""
    seg = D.purchase_stats(panel(spark, d), SEASON).select(
        *PAIR, "regime", F.lit(0).alias("shape_cluster"), F.col("regime").alias("cluster_v2"), F.lit(SEASON).alias("cut")
    )
    rows = panel(spark, d).where(F.col("periodo") == SCORE).select(*GRAIN, "tn")
    return attach_segments(rows, seg, SCORE)


def stratified_sample(spark, d):
    stats = stored(D.purchase_stats_of_facts(sparse(spark, d), SCORE).where(F.col("regime") >= 1), "stats")
    return D.stratified_sample(stats).select(*PAIR, "positive_months", "total_tn", "stratum")


def _medoids(spark, d):
    return kept(spark, d, "medoids", lambda: D.fit_medoids(panel(spark, d), SEASON))


def shape_medoids(spark, d):
    return _medoids(spark, d).select("cut", "medoid_id", F.size("seq").alias("months"))


def shape_segments(spark, d):
    """Segments at a later cut with the medoids of the earlier one."""
    return D.segment_map(panel(spark, d), SCORE, _medoids(spark, d))


def shape_segment_profile(spark, d):
    return tidy(D.segment_profile(shape_segments(spark, d)))


def euclidean_segments(spark, d):
    return D.euclidean_segments(panel(spark, d))


def product_segments(spark, d):
    return D.product_segments(history(spark, d))


# --- models ----------------------------------------------------------------


def ols_lags(spark, d):
    return forecast_on_lags(observed(spark, d), SEASON, SCORE)


def ols_stock_search(spark, d):
    table = regression_stock_table(observed(spark, d), V.stocks(spark, d))
    return stock_group_search(table, shift_period(CONTROL, -4), CONTROL)


SEEDS = (1, 2)


def gbt_l1(spark, d):
    built = _product(spark, d, windows=(3, 6, 12), deltas=True, shares=True)
    table = stored(built.table, "gbt-table")
    fitted = boosted_l1(
        P.training_rows(table, CONTROL), P.anchor_rows(table, CONTROL), built.features, log_target=True,
        seeds=SEEDS,
    )
    return fitted.rows.select("product_id", "periodo", F.col("target").alias("tn_real"), "tn")


def gbt_importance(spark, d):
    built = _product(spark, d, calendar=True)
    table = stored(built.table, "gbt-table")
    fitted = boosted_l1(
        P.training_rows(table, SEASON), P.anchor_rows(table, SEASON), built.features, built.categorical,
        seeds=SEEDS,
    )
    return fitted.importance


def _pair_table(spark, d, anchors):
    """Pair features at the anchors, made from all months."""
    at = F.col("periodo").isin(*anchors)
    return kept(spark, d, f"pair-features-{'-'.join(map(str, anchors))}", lambda: full_pair(spark, d).table.where(at))


def _variant(spark, d, variant):
    spec = Validation("control", shift_period(CONTROL, -12), CONTROL)
    table, names = _pair_table(spark, d, (spec.train_anchor, spec.score_anchor)), full_pair_names()
    maps = None
    if variant in ("hurdle_cluster", "hurdle_per_cluster"):
        rows, _ = product_panel(spark, d)
        early = D.fit_medoids(rows, spec.train_anchor)
        early = stored(early, "medoids")
        maps = (
            stored(D.segment_map(rows, spec.train_anchor, early), "map"),
            stored(D.segment_map(rows, spec.score_anchor, early), "map"),
        )
    result = evaluate(table, names, variant, spec, maps, seeds=SEEDS)
    return result.products


def full_pair_names() -> list[str]:
    cfg = PairConfig()
    kinds = ("rmean", "rstd", "rmin", "rmax", "rmed")
    names = ["promedio_nivel", *[f"lag_{n}" for n in cfg.lags], *[f"{k}_{n}" for n in cfg.windows for k in kinds]]
    names += ["delta_1", "delta_12", "dlag_1_2", "dlag_1_3", "slope_5", "ratio_1", "ratio_12", "ewm_3", "ewm_6"]
    names += [*[f"buy_lag_{n}" for n in (0, 1, 2, 3, 6, 12)], "buys_3", "buys_6", "buys_12", "months_since_buy"]
    names += ["share_prod", "share_cli", "share_cat3", "yoy_prod", "yoy_cli", "yoy_uni"]
    names += ["ppc", "fill_rate", "fill_rate_lag1", "fill_rate_lag2", "fill_rate_lag3"]
    names += ["stock_available", "stock_0", "stock_negative", *[f"stock_lag_{n}" for n in X.STOCK_LAGS]]
    return [*names, "stock_delta_1", "stock_delta_12", "stock_vs_prod"]


def tweedie_one_stage(spark, d):
    return _variant(spark, d, "one_stage")


def hurdle_global(spark, d):
    return _variant(spark, d, "hurdle")


def hurdle_cluster(spark, d):
    return _variant(spark, d, "hurdle_cluster")


def hurdle_per_cluster(spark, d):
    return _variant(spark, d, "hurdle_per_cluster")


def seasonal_series(spark, d):
    return tidy(two_pass_forecast(observed(spark, d), SCORE).select("product_id", "tn", "model", "status"))


FORECASTERS = {
    **N.BASELINES,
    "seasonal": lambda past, anchor: two_pass_forecast(past, anchor).select("product_id", "tn"),
}
WINDOWS = (shift_period(CONTROL, -1), CONTROL)


def _backtest(spark, d, forecasters):
    return L.backtest(observed(spark, d), forecasters, WINDOWS)


def leaderboard(spark, d):
    """Baselines over two windows by WAPE."""
    return tidy(L.leaderboard(_backtest(spark, d, N.BASELINES), list(N.BASELINES)))


def leaderboard_rmse(spark, d):
    return tidy(L.leaderboard(_backtest(spark, d, N.BASELINES), list(N.BASELINES), "rmse"))


def ensemble(spark, d):
    """Greedy weighted mean of all forecasters at the score anchor."""
    results = _backtest(spark, d, FORECASTERS)
    weights = L.ensemble_weights(results, list(FORECASTERS))
    return L.ensemble_forecast(observed(spark, d), FORECASTERS, weights, SCORE)


# --- sampling and noise ----------------------------------------------------


def noise_lognormal(spark, d):
    return tidy(C.with_noise(observed(spark, d).select("product_id", "periodo", "tn"), "tn", ["product_id", "periodo"], 0.3, 102191))


def product_sample(spark, d):
    return P.sample_products(panel(spark, d), 20)


def _tuned(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(tune(spark), sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _tuned(f)
    for f in (
        forecast_check, run_log_union, anti_resume, one_row_per_month,
        densify_monthly, zero_fill_panel, zero_fill_lines, pair_panel, plan_flag_range, lives, period_functions,
        lag_table_positional, lag_table_calendar, last_observed, anchor_split, complete_rows,
        rolling_full_window, rolling_median, rolling_min1, ewm, months_since_event, cumulative_buys,
        product_lags, deltas_ratios, intermittency, category_share, product_attributes, stock_features,
        product_feature_table, stock_regression_table,
        pair_scaling, pair_lags, pair_rolling, pair_deltas, pair_purchases, pair_shares, fill_rate_lags, pair_stock,
        collapse_to_products, lifecycle_flags, structure_agg, structure_lags,
        naive_last, naive_mean12, naive_same_month, forecast_fallback, wape_total, product_wape, pooled_wape,
        calibration_grid, calibration_best, calibration_median, pivot_scores, selection_score, pivot_months,
        blend_weights, blend_totals, blend_diagnostics,
        dedup_latest, dedup_subset, override_newer, row_functions, category_codes, exact_cuts,
        monthly_total, yearly_total, trend_line, customer_share, distinct_customers, customer_cum_share_top20,
        customer_cum_share_bottom300, product_cum_share, history_completeness, pareto, skew_stats, histogram,
        series_filter, joint_series, attribute_lookup, label_concat,
        target_encoding, target_encoding_leak, product_breadth, customer_diversity, level_totals, pair_level_shares, plan_months,
        walk_forward_naive, walk_forward_ols,
        regimes, segment_profile, shape_transform, segments_one_hot, stratified_sample, shape_medoids, shape_segments,
        shape_segment_profile, euclidean_segments, product_segments,
        ols_lags, ols_stock_search, gbt_l1, gbt_importance, tweedie_one_stage, hurdle_global, hurdle_cluster,
        hurdle_per_cluster, seasonal_series, leaderboard, leaderboard_rmse, ensemble,
        noise_lognormal, product_sample,
        pair_feature_table, leakage_check, sales_csv_file, panel_month_file, run_log_file,
    )
}
