"""Skew-proof operators give the same result on their small and their large path."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagfield.functions import scalars as C
from lagfield.operators import explore as E
from lagfield.operators import relational as R

PATHS = [0, 1_000_000]


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds a third of the rows; values tie often."""
    rnd = random.Random(3)
    rows = [(i, 1 if rnd.random() < 0.34 else rnd.randint(2, 60), float(rnd.randint(0, 40))) for i in range(3000)]
    return spark.createDataFrame(rows, "id bigint, k bigint, v double")


@pytest.mark.parametrize("limit", PATHS)
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_attach(spark, hot, limit, how):
    side = spark.range(0, 30).select((F.col("id") * 2).alias("k"), (F.col("id") * 10).alias("w"))
    got = R.attach(hot, side, ["k"], ["id"], how, limit)
    want = hot.join(side, "k", how)
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(map(tuple, want.select(cols).collect()), key=str)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_attach_never_broadcasts_a_large_side(spark, hot, tmp_path, adaptive):
    """The files of the side are far below Spark's own bound, its rows are not small."""
    spark.range(0, 30).select((F.col("id") * 2).alias("k"), (F.col("id") * 10).alias("w")).write.parquet(str(tmp_path / "side"))
    side = spark.read.parquet(str(tmp_path / "side"))
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        got = R.attach(hot, side, ["k"], ["id"], limit=5)
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert ("Generate explode" in plan) == (adaptive == "false")
    assert sorted(map(str, rows)) == sorted(map(str, hot.join(side, "k", "left").select(got.columns).collect()))


@pytest.mark.parametrize("limit", PATHS)
@pytest.mark.parametrize("desc", [True, False])
def test_running_by_value(hot, limit, desc):
    got = R.running_by_value(hot, "v", {"n": F.count(F.lit(1)), "s": F.sum("v")}, desc, limit).collect()
    values = np.array([r.v for r in hot.collect()])
    assert len(got) == len(set(values))
    for r in got:
        kept = values[values >= r.v] if desc else values[values <= r.v]
        assert (r.run_n, r.run_s, r.n) == (len(kept), kept.sum(), (values == r.v).sum())


@pytest.mark.parametrize("limit", PATHS)
def test_exact_quantiles(hot, limit):
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    want = np.quantile([r.v for r in hot.collect()], probs)
    assert np.allclose(R.exact_quantiles(hot, "v", probs, limit), want)


def test_quantiles_of_nothing(hot):
    assert R.exact_quantiles(hot.where("false"), "v", [0.5]) == []


@pytest.mark.parametrize("limit", PATHS)
def test_category_codes(spark, limit):
    df = spark.createDataFrame([("b", "z"), ("a", "y"), (None, "y"), ("c", "x"), ("a", "z")], "p string, q string")
    got = {(r.kind, r.category): r.code for r in R.category_codes(df, ["p", "q"], limit).collect()}
    assert got == {("p", "a"): 0, ("p", "b"): 1, ("p", "c"): 2, ("q", "x"): 0, ("q", "y"): 1, ("q", "z"): 2}


@pytest.mark.parametrize("limit", PATHS)
def test_running_share_ties(spark, limit):
    df = spark.createDataFrame([(1, 40.0), (2, 30.0), (3, 15.0), (4, 15.0)], "product_id bigint, tn_pct double")
    got = {r.product_id: r.tn_pct_acumulado for r in E.with_running_share(df, "product_id", limit).collect()}
    assert got == {1: 40.0, 2: 70.0, 3: 100.0, 4: 100.0}


@pytest.mark.parametrize("k", [1, 3, 500])
def test_top_per_group(hot, k):
    got = sorted((r.k, r.v, r.id) for r in R.top_per_group(hot, ["k"], [F.col("v").desc(), F.col("id")], k).collect())
    groups = {}
    for r in hot.collect():
        groups.setdefault(r.k, []).append((-r.v, r.id))
    want = sorted((g, -v, i) for g, rows in groups.items() for v, i in sorted(rows)[:k])
    assert got == want


def test_top_per_group_limits_before_the_shuffle(hot):
    plan = R.top_per_group(hot, ["k"], [F.col("v")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_first_and_last_per_key(hot):
    first = {r.k: (r.v, r.id) for r in R.first_per_key(hot, ["k"], [F.col("v"), F.col("id")]).collect()}
    last = {r.k: r.id for r in R.last_per_key(hot, ["k"], "id").collect()}
    rows = hot.collect()
    for k in first:
        mine = [r for r in rows if r.k == k]
        assert first[k] == min((r.v, r.id) for r in mine)
        assert last[k] == max(r.id for r in mine)


def test_union_relaxed(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([(2.5, 7)], "n double, extra int")
    got = R.union_relaxed(a, b)
    assert dict(got.dtypes) == {"n": "double", "s": "string", "extra": "int"}
    assert sorted(map(tuple, got.collect())) == [(1.0, "x", None), (2.5, None, 7)]


def test_noise_does_not_depend_on_partitions(hot):
    one = {r.id: r.v for r in C.with_noise(hot, "v", ["id"], 0.3, 5).collect()}
    two = {r.id: r.v for r in C.with_noise(hot.repartition(13), "v", ["id"], 0.3, 5).collect()}
    assert one == two
    z = hot.select(F.log(C.lognormal_noise(["id"], 1.0, 5)).alias("z")).agg(F.avg("z"), F.stddev("z")).first()
    assert abs(z[0]) < 0.07 and abs(z[1] - 1) < 0.07


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(None, 2.0, 7.9), (4.0, None, 8.0), (None, None, 20.0)], "a double, b double, c double")
    got = df.select(
        C.row_mean(["a", "b"]), C.row_max(["a", "b"]), C.digitize("c", (8, 12, 18)), C.positive_flag("a"), C.clip("c", 7.95, 10),
        C.ratio("a", F.lit(-1e-6)), C.lenient_double(F.lit("x1")),
    ).collect()
    assert [tuple(r) for r in got] == [
        (2.0, 2.0, 0, None, 7.95, None, None), (4.0, 4.0, 1, 1, 8.0, None, None), (None, None, 3, None, 10.0, None, None),
    ]
