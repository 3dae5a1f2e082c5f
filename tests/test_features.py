import math

import pytest
from pyspark.sql import functions as F

from lagfield.operators import features as X
from lagfield.operators.metrics import changed_features
from lagfield.operators.pair_features import PairConfig, attach_segments, build_features, scaled
from lagfield.operators.product_features import ProductConfig
from lagfield.operators.product_features import build_features as build_product
from lagfield.operators.structure import lifecycle, structure, structure_lags
from lagfield.functions import series as S
from lagfield.plans import catalog as Q
from lagfield.plans.product_experiment import CANDIDATES
from lagfield.sources import testviews as V

PANEL = "customer_id bigint, product_id bigint, periodo int, plan_flag int, request_tn double, tn double"


@pytest.fixture(scope="module")
def six(spark):
    return spark.createDataFrame([(1, 1, 201701 + i, 0, 0.0, 10.0 * (i + 1)) for i in range(6)], PANEL)


def test_hand_made_series(six):
    rows = scaled(six).orderBy("periodo").collect()
    level = [10, 15, 20, 25, 30, 35]
    assert [r.promedio_nivel for r in rows] == level
    assert [r.tn_esc for r in rows] == [t / n for t, n in zip([10, 20, 30, 40, 50, 60], level)]
    assert [r.target for r in rows][:4] == pytest.approx([3.0, 40 / 15, 50 / 20, 60 / 25])
    assert [r.target for r in rows][4:] == [None, None]
    assert [r.target_buy for r in rows] == [1, 1, 1, 1, None, None]
    cfg = PairConfig(shares=False, stocks=False)
    lagged = build_features(six, cfg).table.orderBy("periodo").collect()
    assert lagged[0].lag_1 is None and lagged[1].lag_1 == rows[0].tn_esc


def test_feature_counts(spark, sf):
    counts = {"lags_raw": 13, "limpio_raw": 35, "limpio_log": 35, "limpio_stock_raw": 48}
    for c in CANDIDATES:
        if c.name in counts:
            built = build_product(Q.history(spark, sf), c.config, V.products(spark, sf), V.stocks(spark, sf))
            assert len(built.features) == counts[c.name], c.name
    extra = structure_lags(structure(Q.panel(spark, sf)))
    assert len(extra.features) == 46
    full = Q._full_product(spark, sf)
    assert len(full.features) == 60 and set(full.features) <= set(full.table.columns)
    pair = Q.full_pair(spark, sf)
    assert pair.features == Q.full_pair_names() and len(pair.features) == 82


def test_pair_features_do_not_see_the_future(spark, sf):
    panel, anchor = Q.panel(spark, sf), 200010

    def at(rows):
        built = build_features(rows, PairConfig(), V.products(spark, sf), V.stocks(spark, sf).where(F.col("periodo") <= anchor))
        return built.table.where(F.col("periodo") == anchor), built.features

    full, names = at(panel)
    cut, _ = at(panel.where(F.col("periodo") <= anchor))
    keys = ["customer_id", "product_id"]
    assert full.count() > 0
    bad = [r.feature for r in changed_features(full, cut, keys, names).collect() if r.changed]
    assert bad == []


def test_product_features_do_not_see_the_future(spark, sf):
    anchor = 200010
    cfg = ProductConfig(windows=(3, 6, 9, 12), deltas=True, intermittency=True, calendar=True, shares=True, attributes=True, stocks=True)

    def at(rows):
        built = build_product(rows, cfg, V.products(spark, sf), V.stocks(spark, sf))
        return built.table.where(F.col("periodo") == anchor), built.features

    full, names = at(Q.history(spark, sf))
    cut, _ = at(Q.history(spark, sf).where(F.col("periodo") <= anchor))
    assert [r.feature for r in changed_features(full, cut, ["product_id"], names).collect() if r.changed] == []


def test_leak_is_found(spark, sf):
    full = Q.history(spark, sf).where(F.col("periodo") == 200010)
    cut = full.withColumn("tn", F.col("tn") + F.when(F.col("product_id") == 1, 1.0).otherwise(0.0))
    assert changed_features(full, cut, ["product_id"], ["tn"]).first().changed == 1


def test_rolling_null_in_window_is_null(spark):
    df = spark.createDataFrame([(1, i, None if i == 3 else float(i)) for i in range(1, 8)], "k int, periodo int, x double")
    w = S.series(["k"])
    kinds = ("mean", "std", "min", "max", "median")
    got = {r.periodo: r for r in X.with_rolling(df, "x", (3,), w, kinds).collect()}
    assert [got[i].rmed_3 for i in range(1, 8)] == [None, None, None, None, None, 5.0, 6.0]
    assert [got[i].rmean_3 for i in (5, 6)] == [None, 5.0]
    assert (got[7].rmin_3, got[7].rmax_3, got[7].rstd_3) == (5.0, 7.0, 1.0)


def test_ewm_is_bias_adjusted(spark):
    xs = [3.0, 0.0, 4.0, 4.0, 1.0]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(xs)], "k int, periodo int, x double")
    w = S.series(["k"])
    got = [r.e for r in df.select("*", S.row_index(w).alias("i")).select("periodo", S.ewm_mean("x", 6, "i", w).alias("e")).orderBy("periodo").collect()]
    keep = 1 - 2 / 7
    for n in range(len(xs)):
        weights = [keep ** (n - i) for i in range(n + 1)]
        assert got[n] == pytest.approx(sum(a * b for a, b in zip(weights, xs)) / sum(weights))


def test_calendar_lag_on_gaps(spark):
    df = spark.createDataFrame([(1, 202001, 1.0), (1, 202003, 3.0), (1, 202004, 4.0)], "k int, periodo int, x double")
    w = S.calendar_series(["k"])
    got = {r.periodo: r.l for r in df.select("periodo", S.lag_months("x", 1, w).alias("l")).collect()}
    assert got == {202001: None, 202003: None, 202004: 3.0}


def test_lifecycle(spark):
    tn = [0, 1, 0, 1] + [0] * 12 + [1]
    months = [201901 + i if i < 12 else 202001 + i - 12 for i in range(len(tn))]
    df = spark.createDataFrame([(1, 1, m, 0, 0.0, float(t)) for m, t in zip(months, tn)], PANEL)
    rows = lifecycle(df).orderBy("periodo").collect()
    assert [i for i, r in enumerate(rows) if r.is_new] == [1, 16]
    assert [i for i, r in enumerate(rows) if r.is_repeat] == [3]
    assert [i for i, r in enumerate(rows) if r.is_churn] == [2, 4]
    assert [r.regime for r in rows][:5] == [0, 1, 1, 1, 1] and rows[-1].regime == 2


def test_missing_stock_is_not_zero_stock(spark):
    history = spark.createDataFrame([(1, 202001, 1.0), (1, 202002, 2.0), (1, 202003, 2.0)], "product_id bigint, periodo int, tn double")
    stocks = spark.createDataFrame([(1, 202002, 0.0), (1, 202003, -5.0)], "product_id bigint, periodo int, stock_final double")
    rows = build_product(history, ProductConfig(stocks=True), stocks=stocks).table.orderBy("periodo").collect()
    assert [(r.stock_disponible, r.stock_0, r.stock_negativo) for r in rows] == [(0, 0.0, 0), (1, 0.0, 0), (1, -5.0, 1)]
    assert rows[2].stock_vs_tn == pytest.approx(-5.0 / 2.001)


def test_segment_map_from_the_future_is_refused(spark, sf):
    rows = Q.panel(spark, sf).where(F.col("periodo") == 200007)
    seg = rows.select("customer_id", "product_id", *[F.lit(3).alias(c) for c in ("regime", "shape_cluster", "cluster_v2")])
    with pytest.raises(ValueError):
        attach_segments(rows, seg, 200007)
    with pytest.raises(ValueError):
        attach_segments(rows, seg.withColumn("cut", F.lit(200008)), 200007)
    ok = attach_segments(rows, seg.withColumn("cut", F.lit(200007)), 200007)
    assert ok.where("cluster_v2_is_3 = 1 and cluster_v2_is_2 = 0").count() == rows.count()


def test_shares_sum_to_one(spark, sf):
    built = Q._pair(spark, sf, shares=True).table
    sums = built.groupBy("product_id", "periodo").agg(F.sum("share_prod").alias("s"), F.sum("tn").alias("t")).where("t > 0")
    low, high = sums.agg(F.min("s"), F.max("s")).first()
    assert math.isclose(low, 1.0, abs_tol=1e-5) and math.isclose(high, 1.0, abs_tol=1e-5)


def test_large_side_path_gives_the_same_features(spark, sf, monkeypatch):
    from lagfield.operators import pair_features, relational

    keys = ["customer_id", "product_id", "periodo"]
    names = ["share_prod", "share_cli", "share_cat3", "yoy_prod", "yoy_cli", "yoy_uni", "stock_vs_prod"]
    small = Q.full_pair(spark, sf).table.select(*keys, *names)
    monkeypatch.setattr(pair_features, "attach", lambda big, side, on, spread: relational.attach(big, side, on, spread, limit=0))
    large = Q.full_pair(spark, sf).table.select(*keys, *names)
    assert [r.feature for r in changed_features(small, large, keys, names).collect() if r.changed] == []
