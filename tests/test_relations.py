"""Encoded targets, breadth, totals of every level and counts without the grid, against plain versions."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lagfield.operators import metrics as M
from lagfield.operators import panel as P
from lagfield.operators import relations as Y
from lagfield.operators import shape as D

FACTS = "customer_id long, product_id long, periodo int, plan_flag int, request_tn double, tn double"


def month(i):
    return 201801 + i // 12 * 100 + i % 12


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(4)
    rows = set()
    for _ in range(260):
        rows.add((rng.randrange(5), rng.randrange(4), rng.choice([i for i in range(30) if i != 11])))
    # a product that ends early, a customer that comes late, a pair with one row
    rows = {r for r in rows if not (r[1] == 3 and r[2] > 8) and not (r[0] == 4 and r[2] < 20)} | {(4, 3, 5)}
    data = [(c, p, month(i), rng.randrange(2), 5.0, float(rng.choice([0, 0, 1, 2, 7]))) for c, p, i in sorted(rows)]
    return spark.createDataFrame(data, FACTS)


@pytest.fixture(scope="module")
def panel(facts):
    return P.pair_panel(facts)


def test_target_encoding(panel):
    rows = [(r.customer_id, r.product_id, r.periodo, r.tn) for r in panel.collect()]
    series = defaultdict(dict)
    for c, p, t, v in rows:
        series[c, p][t] = v
    # (customer, product, month in which the target is known, target): two rows later in the series
    targets = []
    for (c, p), s in series.items():
        months = sorted(s)
        targets += [(c, p, months[i + 2], s[months[i + 2]]) for i in range(len(months) - 2)]
    got = {(r.customer_id, r.product_id, r.periodo): r for r in Y.target_encoding(panel).collect()}
    assert len(got) == len(rows)
    for c, p, t, _ in rows:
        known = [x for x in targets if x[2] <= t]
        for name, own in (("te_customer_id", [x[3] for x in known if x[0] == c]), ("te_product_id", [x[3] for x in known if x[1] == p])):
            value = got[c, p, t][name]
            if not known:
                assert value is None
            else:
                mean = sum(x[3] for x in known) / len(known)
                assert value == pytest.approx((sum(own) + 20 * mean) / (len(own) + 20))


@pytest.mark.parametrize("anchor", [201806, 201907])
def test_target_encoding_does_not_see_the_future(panel, anchor):
    names = ["te_customer_id", "te_product_id"]
    full = Y.target_encoding(panel).where(F.col("periodo") == anchor)
    cut = Y.target_encoding(panel.where(F.col("periodo") <= anchor)).where(F.col("periodo") == anchor)
    assert full.count() > 0
    assert {r.feature: r.changed for r in M.changed_features(full, cut, P.GRAIN, names).collect()} == dict.fromkeys(names, 0)
    # the check itself sees a change of what is known
    other = panel.withColumn("tn", F.when(F.col("periodo") == anchor, F.col("tn") + 9).otherwise(F.col("tn")))
    moved = Y.target_encoding(other).where(F.col("periodo") == anchor)
    assert all(r.changed > 0 for r in M.changed_features(full, moved, P.GRAIN, names).collect())


@pytest.mark.parametrize(("key", "partner"), [("product_id", "customer_id"), ("customer_id", "product_id")])
def test_breadth(facts, key, partner):
    index = lambda p: p // 100 * 12 + p % 100 - 1
    rows = [(r[key], r[partner], index(r.periodo), r.tn) for r in facts.collect()]
    got = {(r[key], index(r.periodo)): r for r in Y.breadth(facts, key, partner, (1, 3, 12)).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        months = [i for x, _, i, _ in rows if x == k]
        for i in range(min(months), max(months) + 1):
            for w in (1, 3, 12):
                want[k, i, w] = len({y for x, y, j, v in rows if x == k and v > 0 and i - w < j <= i})
    assert {(k, i) for k, i, _ in want} == set(got)
    for (k, i, w), n in want.items():
        assert got[k, i][f"breadth_{w}"] == n
        before = want.get((k, i - w, w))
        assert got[k, i][f"breadth_{w}_trend"] == (None if before is None else n - before)


def test_level_totals(spark, facts):
    traits = [(0, "x", 1, "n", 5), (1, "x", 2, "m", 5), (2, None, 2, "m", 6)]  # product 3 has none
    products = spark.createDataFrame(traits, "product_id long, cat1 string, cat2 long, cat3 string, brand long")
    totals = Y.level_totals(facts, products)
    got = {(r.level, r.member, r.periodo): (r.tn, r.tn_12) for r in totals.collect()}
    of = {p: dict(zip(("cat1", "cat2", "cat3", "brand"), rest)) for p, *rest in traits}
    want = defaultdict(float)
    rows = facts.collect()
    for r in rows:
        names = {"universe": "universe", "product_id": r.product_id, "customer_id": r.customer_id}
        names |= of.get(r.product_id, dict.fromkeys(("cat1", "cat2", "cat3", "brand")))
        for level, member in names.items():
            want[level, None if member is None else str(member), r.periodo] += r.tn
    assert {k: v[0] for k, v in got.items()} == pytest.approx(dict(want))
    for (level, member, t), (_, before) in got.items():
        assert before == want.get((level, member, t - 100))
    shares = Y.with_level_totals(facts, totals, products).collect()
    assert len(shares) == len(rows)
    for r in shares:
        level = want["universe", "universe", r.periodo]
        assert r.share_universe == pytest.approx(r.tn / (level + 1e-6))
        cat = of.get(r.product_id, {}).get("cat1")
        assert r.share_cat1 == pytest.approx(r.tn / (want["cat1", cat, r.periodo] + 1e-6))
        assert r.share_customer_id == pytest.approx(r.tn / (want["customer_id", str(r.customer_id), r.periodo] + 1e-6))


@pytest.mark.parametrize("cut", [None, 201806, 201905, 201812, 201700])
def test_counts_without_the_grid(facts, panel, cut):
    key = lambda r: (r.customer_id, r.product_id)
    got = {key(r): r.asDict() for r in D.purchase_stats_of_facts(facts, cut).collect()}
    want = {key(r): r.asDict() for r in D.purchase_stats(panel, cut).collect()}
    assert got == want


def test_no_grid_in_the_plan(facts):
    plan = D.purchase_stats_of_facts(facts, 201905)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan.replace("sequence(0", "")


def test_plan_months(panel):
    rows = Y.plan_months(panel).orderBy("customer_id", "product_id", "periodo").collect()
    seen = defaultdict(int)
    for r in rows:
        seen[r.customer_id, r.product_id] += r.plan_flag
        assert (r.trimestre, r.meses_en_plan) == ((r.periodo % 100 + 2) // 3, seen[r.customer_id, r.product_id])


def test_empty(spark, facts, panel):
    products = spark.createDataFrame([], "product_id long, cat1 string, cat2 long, cat3 string, brand long")
    none = facts.where("false")
    assert Y.target_encoding(panel.where("false")).count() == 0
    assert Y.breadth(none, "product_id", "customer_id").count() == 0
    assert Y.level_totals(none, products).count() == 0
    assert D.purchase_stats_of_facts(none, 201905).count() == 0
