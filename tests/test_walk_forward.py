"""Pooled back-tests against fits and forecasts made one by one."""

import random

import numpy as np
import pytest

from lagfield.operators import panel as P
from lagfield.operators import walk_forward as K

ANCHORS = (201912, 202003, 202006)


def month(i):
    return 201801 + i // 12 * 100 + i % 12


def index(p):
    return p // 100 * 12 + p % 100 - 1 - 2018 * 12


@pytest.fixture(scope="module")
def series():
    rng = random.Random(9)
    out = {}
    for product in range(25):
        first = rng.choice([0, 0, 0, 4, 20])
        level = rng.randrange(5, 50)
        out[product] = {i: float(max(0.0, level + 5 * np.sin(i) + rng.gauss(0, 3))) for i in range(first, 34 if product % 6 else 26) if rng.random() < 0.9}
    return out


@pytest.fixture(scope="module")
def observed(spark, series):
    rows = [(p, month(i), v) for p, s in series.items() for i, v in s.items()]
    return spark.createDataFrame(rows, "product_id long, periodo int, tn double")


def test_naive_folds(observed, series):
    got = {(r.anchor, r.product_id): r for r in K.naive_folds(observed, ANCHORS).collect()}
    want = {}
    for anchor in ANCHORS:
        a = index(anchor)
        for p, s in series.items():
            if a + 2 in s:
                year = [s[i] for i in range(a - 11, a + 1) if i in s]
                mean = sum(year) / len(year) if year else 0.0
                want[anchor, p] = (s[a + 2], s.get(a, 0.0), mean, s.get(a - 10, mean))
    assert set(got) == set(want)
    for k, values in want.items():
        assert (got[k].actual, got[k]["last"], got[k].mean_12, got[k].same_month) == pytest.approx(values)


@pytest.mark.parametrize("lags", [3, 12])
def test_linear_folds(observed, lags):
    dense = P.densify(observed, ["product_id"])
    s = {}
    for r in dense.collect():
        s.setdefault(r.product_id, {})[index(r.periodo)] = r.tn
    got = {(r.anchor, r.product_id): r for r in K.linear_folds(dense, ANCHORS, lags=lags).collect()}
    want = {}
    for anchor in ANCHORS:
        a = index(anchor)
        rows = lambda when: [
            (p, i, [1.0, *[v[i - k] for k in range(lags)]], v[i + 2])
            for p, v in s.items() for i in v if when(i) and i - lags + 1 in v and i + 2 in v
        ]
        train = rows(lambda i: i <= a - 2)
        beta = np.linalg.lstsq(np.array([x for *_, x, _ in train]), np.array([y for *_, y in train]), rcond=None)[0]
        for p, _, x, y in rows(lambda i: i == a):
            want[anchor, p] = (y, max(0.0, float(np.dot(beta, x))))
    assert set(got) == set(want)
    for k, (y, f) in want.items():
        assert got[k].actual == pytest.approx(y) and got[k].ols == pytest.approx(f, rel=1e-6, abs=1e-6)


def test_pooled_errors(spark):
    rows = [(1, 10.0, 8.0, 10.0), (1, 0.0, 1.0, 0.0), (2, 10.0, 15.0, 0.0)]
    df = spark.createDataFrame(rows, "anchor int, actual double, a double, b double")
    got = {r.model: (r.folds, r.rows, r.wape) for r in K.pooled_errors(df, ("a", "b")).collect()}
    assert got == {"a": (2, 3, 0.4), "b": (2, 3, 0.5)}
    assert [r.wape for r in K.pooled_errors(df.where("actual = 0"), ("a",)).collect()] == [None]


def test_nothing_to_fit(observed):
    none = observed.where("false")
    assert K.naive_folds(none, ANCHORS).count() == 0
    assert K.linear_folds(none, ANCHORS, lags=3).count() == 0
    # an anchor before any training row has no model
    assert K.linear_folds(P.densify(observed, ["product_id"]), (201803,), lags=3).count() == 0
