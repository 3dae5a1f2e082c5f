import math

import pytest
from pyspark.sql import functions as F

from lagfield.operators import blend as B
from lagfield.operators import metrics as M
from lagfield.operators import naive as N

# fixed values: published errors by candidate (season, control) and their weighted scores
PUBLISHED = {
    "lags_raw": (0.1913505759899934, 0.2557992373646819, 0.21068517440239992),
    "limpio_raw": (0.19524075232095453, 0.2858988733659532, 0.22243818863445414),
    "limpio_log": (0.19859500049274187, 0.28211075321970686, 0.22364972631083135),
    "limpio_stock_raw": (0.1969125808151871, 0.2898927850920206, 0.2248066420982371),
    "cp_agregada_raw": (0.2178354827386937, 0.38844443259495615, 0.2690181676955724),
    "cp_agregada_stock_raw": (0.2186355950125224, 0.39536354690055164, 0.27165398057893114),
}


def test_selection_matches_published_ranking(spark):
    rows = [(c, a, v) for c, (s, k, _) in PUBLISHED.items() for a, v in ((201812, s), (201910, k))]
    runs = spark.createDataFrame(rows, "candidate string, anchor int, wape double")
    got = M.selection_scores(runs, 201812, 201910).orderBy("score_seleccion").collect()
    assert [r.candidate for r in got] == list(PUBLISHED)
    for r in got:
        assert r.score_seleccion == pytest.approx(PUBLISHED[r.candidate][2], abs=1e-15)


def frame(spark, rows):
    return spark.createDataFrame(rows, "product_id bigint, tn_real double, tn double")


def test_wape_guards(spark):
    assert M.wape(frame(spark, [(1, 10.0, 8.0), (2, 10.0, 15.0)])).first().wape == 0.35
    assert math.isnan(M.wape(frame(spark, [(1, 0.0, 8.0)])).first().wape)


def test_missing_prediction_counts_as_zero(spark):
    real = spark.createDataFrame([(1, 10.0), (2, 30.0)], "product_id bigint, tn_real double")
    pred = spark.createDataFrame([(1, 10.0), (3, 99.0)], "product_id bigint, tn double")
    assert M.total_error_rate(pred, real).first().wape == 0.75


def test_product_wape_sums_customers_first(spark):
    df = spark.createDataFrame([(1, 5.0, 0.0), (1, 0.0, 5.0), (2, 4.0, 5.0)], "product_id bigint, pred_tn double, target_tn double")
    assert M.product_wape(df).first().wape == pytest.approx(0.1)


def test_calibration(spark):
    df = frame(spark, [(1, 8.0, 10.0), (2, 16.0, 20.0)])
    best = M.best_scale(df).first()
    assert best.scale == pytest.approx(0.8) and best.wape == pytest.approx(0.0, abs=1e-12)
    assert M.scale_scores(df).count() == 101
    flat = frame(spark, [(1, 8.0, 0.0)])
    assert M.best_scale(flat).first().scale == pytest.approx(0.30)


def test_calibration_never_hurts(spark):
    df = frame(spark, [(i, float(i % 7), float((i * 3) % 5)) for i in range(40)])
    assert M.best_scale(df).first().wape <= M.wape(df).first().wape


def test_pooled_wape_joins_the_target_month(spark):
    pred = spark.createDataFrame([(1, 201911, 2.0), (1, 201911, 3.0), (1, 201912, 9.0)], "product_id bigint, periodo int, pred_tn double")
    truth = spark.createDataFrame([(1, 202001, 10.0)], "product_id bigint, periodo int, tn double")
    assert M.pooled_wape(pred, truth).first().wape == 0.5


def test_complete_forecast(spark):
    requested = spark.createDataFrame([(1,), (2,), (3,), (4,)], "product_id bigint")
    pred = spark.createDataFrame([(1, 5.0), (4, -2.0)], "product_id bigint, tn double")
    history = spark.createDataFrame([(2, 201901, 4.0), (2, 201912, 6.0), (2, 201812, 99.0)], "product_id bigint, periodo int, tn double")
    got = {r.product_id: r.tn for r in N.submission(requested, pred, history, 201912).collect()}
    assert got == {1: 5.0, 2: 5.0, 3: 0.0, 4: 0.0}


def test_same_month_falls_back_to_the_mean(spark):
    history = spark.createDataFrame([(1, 201902, 7.0), (1, 201912, 1.0), (2, 201912, 3.0), (3, 201802, 8.0)], "product_id bigint, periodo int, tn double")
    got = {r.product_id: r.tn for r in N.same_month(history, 201912).collect()}
    assert got == {1: 7.0, 2: 3.0}


def test_blend(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "product_id bigint, tn double")
    b = spark.createDataFrame([(1, 20.0), (2, -200.0)], "product_id bigint, tn double")
    rows = {(round(r.weight, 1), r.product_id): r.tn for r in B.blend(a, b, (0.1, 0.3)).collect()}
    assert rows == {(0.1, 1): pytest.approx(11.0), (0.1, 2): 0.0, (0.3, 1): pytest.approx(13.0), (0.3, 2): 0.0}
    totals = {round(r.weight, 1): r.tn_total for r in B.blend_totals(B.blend(a, b, (0.1,))).collect()}
    assert totals[0.1] == pytest.approx(11.0 - 2.0)
    d = B.diagnostics(a, b).first()
    assert d.correlation == pytest.approx(-1.0) and d.disagreement == pytest.approx(230 / 30)


def test_checked_forecast(spark):
    good = spark.createDataFrame([(1, "1.5"), (2, "2")], "product_id bigint, tn string")
    assert B.checked_forecast(good, 2).agg(F.sum("tn")).first()[0] == 3.5
    with pytest.raises(ValueError):
        B.checked_forecast(good, 3)
    with pytest.raises(ValueError):
        B.checked_forecast(good.union(good))
