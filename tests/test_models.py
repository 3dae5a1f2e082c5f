import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagfield.operators import leaderboard as L
from lagfield.operators import naive as N
from lagfield.operators.hurdle import predict_variant, usable_features
from lagfield.operators.learners import (
    TreeParams, boosted_l1, design, least_squares, steady_parts, steady_rows, tweedie_trees,
)
from lagfield.operators.linear import forecast_on_lags, stock_forecast, stock_group_search
from lagfield.operators.metrics import wape
from lagfield.operators.product_features import regression_stock_table
from lagfield.operators.seasonal import PLAIN, fit_family, two_pass_forecast
from lagfield.plans import catalog as Q
from lagfield.sources import testviews as V

FEW = TreeParams(trees=3, depth=3, min_rows=1)
HISTORY = "product_id bigint, periodo int, tn double"


def month(i):
    return (2015 + i // 12) * 100 + i % 12 + 1


def test_least_squares_equals_normal_equations(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3))
    y = x @ [2.0, -1.0, 0.5] + 4 + rng.normal(size=60) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, y double")
    got = [r.p for r in least_squares(df, ["a", "b", "c"], "y")(df, "p").collect()]
    full = np.c_[np.ones(60), x]
    want = full @ np.linalg.lstsq(full, y, rcond=None)[0]
    assert np.allclose(got, want, atol=1e-8)


def test_forecast_on_lags_falls_back_to_the_mean(spark):
    rnd = random.Random(4)
    rows = [(p, month(i), 10.0 + p + rnd.random()) for p in range(1, 41) for i in range(40)]
    rows += [(99, month(i), 8.0) for i in range(36, 40)]
    df = spark.createDataFrame(rows, HISTORY)
    got = {r.product_id: r.tn for r in forecast_on_lags(df, month(30), month(39)).collect()}
    assert len(got) == 41 and got[99] == 8.0
    assert all(abs(got[p] - 10 - p) < 2.5 for p in range(1, 41))


def test_stock_search_skips_groups_without_rows(spark, sf):
    table = regression_stock_table(Q.observed(spark, sf), V.stocks(spark, sf))
    groups = {"base": [], "never": ["nothing"]}
    scores = stock_group_search(table.withColumn("nothing", F.lit(None).cast("double")), 200007, 200105, groups).collect()
    assert [r.stock_group for r in scores] == ["base"]


def test_stock_forecast_is_complete(spark, sf):
    obs = Q.observed(spark, sf)
    table = regression_stock_table(obs, V.stocks(spark, sf))
    name, out = stock_forecast(table, obs, V.requested(spark, sf), (200101, 200105), (200105, 200107), {"base": []})
    assert name == "base"
    assert out.count() == V.requested(spark, sf).count() and out.where("tn < 0 or tn is null").count() == 0


@pytest.fixture(scope="module")
def steps(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        a, b, kind = rnd.random(), (None if i % 9 == 0 else rnd.random()), i % 4
        rows.append((i, a, b, kind, 10.0 * (a > 0.5) + 5.0 * kind, int(a > 0.5), 2.0 + 3 * a, 1.0))
    return spark.createDataFrame(rows, "product_id bigint, a double, b double, kind int, y double, target_buy int, target double, promedio_nivel double")


def test_design_flags_nulls_and_sizes_categories(steps):
    plan = design(steps, steps, ["a", "b", "kind"], ["kind"])
    assert plan.flagged == ["b"] and plan.categorical == {"kind": 5} and plan.names == ["a", "b", "kind", "b_null"]
    attrs = plan.vectors(steps).schema["features"].metadata["ml_attr"]["attrs"]
    assert [x["idx"] for x in attrs["nominal"]] == [2]


def test_trees_are_repeatable_and_beat_a_constant(steps):
    runs = []
    for _ in range(2):
        fitted = boosted_l1(steps, steps, ["a", "b", "kind"], ["kind"], seeds=(1, 2), params=TreeParams(trees=8, depth=4), target="y")
        runs.append({r.product_id: r.tn for r in fitted.rows.select("product_id", "tn").collect()})
    assert runs[0] == runs[1]
    scored = fitted.rows
    middle = steps.agg(F.percentile("y", F.lit(0.5))).first()[0]
    constant = steps.withColumn("c", F.lit(middle))
    assert wape(scored, "y", "tn").first().wape < 0.6 * wape(constant, "y", "c").first().wape
    importance = {r.feature: r.importance for r in fitted.importance.collect()}
    assert set(importance) == {"a", "b", "kind"} and importance["a"] > importance["b"]
    logged = boosted_l1(steps, steps, ["a"], log_target=True, params=FEW, target="y")
    assert logged.rows.where("tn < 0 or tn is null").count() == 0


@pytest.mark.parametrize("variant", ["one_stage", "hurdle", "hurdle_cluster", "hurdle_per_cluster"])
def test_variants_score_every_row(steps, variant):
    table = steps.withColumn("cluster_v2", F.when(F.col("product_id") < 300, F.lit(3)).when(F.col("product_id") < 390, 1))
    fitted = predict_variant(table, table, ["a", "b", "cluster_v2"], variant, (1,), FEW, min_rows=200, min_positive=20)
    rows = fitted.rows.collect()
    assert len({r.product_id for r in rows}) == 400
    assert all(r.pred_scaled is not None and 0 <= r.pred_scaled <= 50 and 0 <= r.probability <= 1 for r in rows)


def test_tweedie_beats_a_constant_or_raises(spark, steps):
    plan = design(steps, steps, ["a", "b"])
    rows = steady_rows(plan.vectors(steps), ["features", F.col("target").alias("label")])
    fitted = tweedie_trees(rows, 1, TreeParams(trees=10, depth=3, min_rows=5))
    assert fitted.deviance < fitted.constant_deviance
    scored = fitted.predict(rows, "p")
    assert scored.agg(F.max(F.abs(F.col("p") - F.col("label")) / F.col("label"))).first()[0] < 0.5
    with pytest.raises(ValueError):
        tweedie_trees(rows.withColumn("label", F.lit(0.0)), 1, FEW)
    with pytest.raises(ArithmeticError):
        tweedie_trees(rows.withColumn("label", F.lit(2.0)), 1, FEW)


@pytest.mark.parametrize("variant", ["one_stage", "hurdle"])
def test_tweedie_variants_match_the_mean(spark, variant):
    """On the test data both routes are near the 12-month mean and below the last month."""
    sf = "/root/testdata/sf0.01"
    rows = Q.QUERIES["tweedie_one_stage" if variant == "one_stage" else "hurdle_global"](spark, sf)
    got = wape(rows, "tn_real", "tn").first().wape
    truth = rows.select("product_id", "tn_real")
    base = {}
    for name in ("mean_12", "last_month"):
        base[name] = wape(truth.join(N.BASELINES[name](Q.history(spark, sf), Q.CONTROL), "product_id"), "tn_real", "tn").first().wape
    assert got < 1.05 * base["mean_12"] and got < base["last_month"]


def test_many_categories_stay_categories(spark):
    df = spark.createDataFrame([(i, i % 300, float(i % 300 % 2), 1.0 * (i % 300 % 2)) for i in range(3000)] + [(3000, None, 1.0, 1.0)], "product_id long, kind int, y double, target double")
    plan = design(df, df, ["kind"], ["kind"])
    assert plan.categorical == {"kind": 301} and plan.bins == 301
    assert df.where("kind is null").transform(plan.vectors).first().features[0] == 300
    fitted = boosted_l1(df, df, ["kind"], ["kind"], params=TreeParams(trees=3, depth=2, min_rows=1, row_share=1.0, columns="all"), target="y")
    assert wape(fitted.rows, "y", "tn").first().wape < 0.2


def test_naive_keys(spark):
    rows = [(1, p, month(i), float(i + p)) for p in (1, 2) for i in range(24)]
    df = spark.createDataFrame(rows, "customer_id bigint, product_id bigint, periodo int, tn double")
    keys = ("customer_id", "product_id")
    assert {(r.customer_id, r.product_id, r.tn) for r in N.last_month(df, month(23), keys).collect()} == {(1, 1, 24.0), (1, 2, 25.0)}
    out = two_pass_forecast(df.where("product_id = 1 or periodo >= 201610"), month(23), keys)
    assert {(r.product_id) for r in out.collect()} == {1, 2}


def test_segment_columns_are_masked():
    cols = ["lag_0", "cluster_v2_is_3", "regime"]
    assert usable_features(cols, "hurdle") == ["lag_0"]
    assert usable_features(cols, "hurdle_cluster") == cols


def seasonal_rows(product, months, f):
    return [(product, month(i), f(i)) for i in range(months)]


def test_two_pass_statuses(spark):
    rows = seasonal_rows(1, 60, lambda i: 100 + 50 * math.sin(i * math.pi / 6))
    rows += [(2, month(i), 7.0 + i % 3) for i in range(50, 60)]
    rows += [(3, month(59), 4.0)]
    df = spark.createDataFrame(rows, HISTORY)
    got = {r.product_id: r for r in two_pass_forecast(df, month(59)).collect()}
    assert {p: r.status for p, r in got.items()} == {1: "seasonal", 2: "plain", 3: "fallback"}
    assert got[1].tn == pytest.approx(100 + 50 * math.sin(61 * math.pi / 6), rel=0.02)
    assert got[3].tn == 4.0
    done = df.where("product_id = 1").select("product_id").distinct()
    assert {r.product_id for r in two_pass_forecast(df, month(59), done=done).collect()} == {2, 3}


def test_series_that_ended_are_carried_to_the_anchor(spark):
    df = spark.createDataFrame(seasonal_rows(1, 30, lambda i: 9.0), HISTORY)
    got = two_pass_forecast(df, month(49)).first()
    assert got.tn < 3.0


def test_ar_forecast_equals_numpy(spark):
    rng = np.random.default_rng(3)
    y = [5.0]
    for _ in range(39):
        y.append(1.0 + 0.7 * y[-1] + rng.normal() * 0.3)
    df = spark.createDataFrame([(1, month(i), float(v)) for i, v in enumerate(y)], HISTORY)
    ar = next(c for c in PLAIN if c.name == "ar")
    got = fit_family(df, [ar], log=False).first().tn
    slope, inter = np.polyfit(y[:-1], y[1:], 1)
    assert got == pytest.approx(inter + slope * (inter + slope * y[-1]))


def test_constant_and_zero_series_do_not_fail(spark):
    df = spark.createDataFrame(seasonal_rows(1, 40, lambda i: 3.0) + seasonal_rows(2, 40, lambda i: 0.0), HISTORY)
    got = {r.product_id: r.tn for r in two_pass_forecast(df, month(39)).collect()}
    assert got == {1: pytest.approx(3.0), 2: pytest.approx(0.0, abs=1e-9)}


def test_leaderboard_and_ensemble(spark):
    rows = seasonal_rows(1, 48, lambda i: 10.0 + 5 * (i % 12)) + seasonal_rows(2, 48, lambda i: 3.0)
    df = spark.createDataFrame(rows, HISTORY)
    models = list(N.BASELINES)
    results = L.backtest(df, N.BASELINES, (month(40), month(41)))
    board = L.leaderboard(results, models).collect()
    assert board[0].model == "same_month" and board[0].score == 0.0
    assert L.leaderboard(results, models, "rmse").first().model == "same_month"
    assert L.ensemble_weights(results, models) == {"same_month": 1.0}
    mixed = {r.product_id: r.tn for r in L.ensemble_forecast(df, N.BASELINES, {"last_month": 0.5, "same_month": 0.5}, month(45)).collect()}
    assert mixed == {1: pytest.approx(0.5 * (10 + 5 * 9) + 0.5 * (10 + 5 * 11)), 2: 3.0}


def test_greedy_weights_mix_two_opposite_errors(spark):
    df = spark.createDataFrame([(10.0, 8.0, 12.0), (20.0, 18.0, 22.0)], "tn_real double, low double, high double")
    for metric in ("wape", "rmse"):
        assert L.ensemble_weights(df, ["low", "high"], metric) == {"low": 0.5, "high": 0.5}


def test_training_partitions_are_bounded_by_full_ones():
    """The old cut, one part per 5,000 rows, gave 5,001 parts for 25 million rows."""
    assert [steady_parts(n) for n in (0, 4_999, 7_000, 200_000)] == [1, 1, 2, 41]
    assert steady_parts(2_000_000) == 48
    assert steady_parts(25_000_000) == 101
