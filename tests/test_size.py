"""Plans that must not grow with the tables: no large side broadcast, nothing repeated or read twice, bounded tasks."""

import threading
from functools import partial

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from lagfield.operators import learners as L
from lagfield.operators import pair_features as A
from lagfield.operators import panel as P
from lagfield.operators import relational as R
from lagfield.operators import shape as D
from lagfield.operators.features import FeatureSet
from lagfield.plans import catalog as Q
from lagfield.session import SETTINGS, stored_by, tune
from lagfield.sources import testviews as V


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_orders_are_merged_with_their_lines(spark, sf):
    plan = _plan(V._lines(spark, sf))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_nation_is_that_of_the_customer(spark, sf):
    lines, orders, customer = (V.table(spark, sf, t) for t in ("lineitem", "orders", "customer"))
    want = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(customer, orders.o_custkey == customer.c_custkey)
    cols = ["l_orderkey", "l_linenumber", "c_nationkey"]
    got = V._nation_lines(spark, sf)
    assert got.select(*cols).exceptAll(want.select(*cols)).isEmpty() and want.select(*cols).exceptAll(got.select(*cols)).isEmpty()


def test_product_side_takes_stocks_by_a_counted_join(spark, monkeypatch):
    names = []
    monkeypatch.setattr(A, "attach", lambda df, side, on, *a, f=A.attach, **k: names.append(tuple(on)) or f(df, side, on, *a, **k))
    panel = spark.createDataFrame([(1, 7, 200001, 2.0)], "customer_id int, product_id long, periodo int, tn double")
    attributes = spark.createDataFrame([(7, "x", "y", "z", 1, 2.0)], "product_id long, cat1 string, cat2 string, cat3 string, brand int, sku_size double")
    stocks = spark.createDataFrame([(7, 200001, 5.0)], "product_id long, periodo int, stock_final double")
    row = A.product_month_side(panel, attributes, stocks, A.PairConfig()).first()
    assert (row.tot_prod, row.stock_final, row["_category"]) == (2.0, 5.0, 2.0)
    assert names.count(("product_id", "periodo")) == 1 and ("product_id",) in names


def test_segment_profile_reads_the_series_once(spark):
    df = spark.createDataFrame(
        [(0, "nunca", 1, 2.0), (0, "nunca", 3, 4.0), (3, "activa", 9, 6.0)],
        "cluster_v2 int, regime_name string, positive_months int, total_tn double",
    )
    profile = D.segment_profile(df.where(F.col("total_tn") > 0))
    assert "ubquery" not in _plan(profile)
    assert {r.cluster_v2: r.tn_share for r in profile.collect()} == pytest.approx({0: 0.5, 3: 0.5})


def test_tasks_take_a_bounded_part_of_a_shuffle(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert tune(spark).conf.get(name) == SETTINGS[name] == "16m"


def test_panel_by_product_is_not_moved(spark):
    """neither the product side nor the windows shuffle the rows of a panel that lies by product."""
    rows = [(c, p, m, 0, 1.0, float(c + p + m % 7)) for c in range(3) for p in (1, 2, 3, 4) for m in (200001, 200002, 200003)]
    facts = spark.createDataFrame(rows + [(1, None, 200001, 0, 1.0, 2.0)], "customer_id int, product_id long, periodo int, plan_flag int, request_tn double, tn double")
    packed = P.packed_panel(facts, parts=8, keys=["product_id"])
    panel = P.unpacked(stored_by(packed, ["product_id"], 8, "panel"))
    side = spark.createDataFrame([(1, 200001, 5.0), (1, 200003, None), (4, 200002, 7.0), (9, 200001, 1.0), (None, 200001, 3.0)], "product_id long, periodo int, stock double")
    joined = R.attach_in_place(panel, side, "product_id", "periodo", limit=0)
    out = joined.withColumn("before", F.lag("stock").over(Window.partitionBy(*P.PAIR).orderBy("periodo")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Broadcast" not in plan
    want = R.attach(panel, side, ["product_id", "periodo"], ["customer_id"], limit=0)
    assert sorted(map(str, joined.select(want.columns).collect())) == sorted(map(str, want.collect()))
    unpacked = P.unpacked(P.packed_panel(facts)).select(panel.columns)
    assert sorted(map(str, panel.collect())) == sorted(map(str, unpacked.collect()))


def test_product_layout_needs_few_customers(spark, monkeypatch):
    facts = spark.createDataFrame([(c, 1) for c in range(5)], "customer_id int, product_id long")
    assert P.fits_by_product(facts)
    monkeypatch.setattr(P, "PART_PAIRS", 4)
    assert not P.fits_by_product(facts)


def test_variants_store_the_rows_of_their_anchors(spark, monkeypatch):
    """the feature table of all months is never written."""
    table = spark.createDataFrame([(1, 200001), (1, 200002), (2, 200003)], "product_id long, periodo int")
    monkeypatch.setattr(Q, "full_pair", lambda *_: FeatureSet(table))
    got = Q._pair_table(spark, "made-here", (200001, 200003)).select("periodo").collect()
    assert sorted(r[0] for r in got) == [200001, 200003]


def test_training_rows_are_shuffled_once(spark):
    """each of the many passes of a fit reads the stored layout."""
    df = spark.createDataFrame([(c, p, 200001, float(c * p)) for c in range(90) for p in range(90)], "customer_id int, product_id long, periodo int, x double")
    rows = L.steady_rows(df, ["x"])
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    want = df.repartition(L.steady_parts(8100), *P.GRAIN).sortWithinPartitions(*P.GRAIN).select("x")
    parts = lambda d: [[r.x for r in part] for part in d.rdd.glom().collect()]
    assert L.steady_parts(8100) == 2 and parts(rows) == parts(want)


def test_tweedie_trees_write_no_copies(spark, monkeypatch):
    """scores of earlier trees are computed again, not written with the features every few trees."""
    def refused(*_):
        raise AssertionError("written again")

    df = spark.createDataFrame([(i, 1, 200001, [float(i % 5), float(i % 3)], float(i % 5) + 0.5) for i in range(60)], "customer_id int, product_id long, periodo int, x array<double>, label double")
    rows = L.steady_rows(df, [array_to_vector("x").alias("features"), "label"])
    monkeypatch.setattr(L, "stored", refused)
    fitted = L.tweedie_trees(rows, 1, L.TreeParams(trees=6, depth=2, min_rows=1))
    assert len(fitted.trees) == 6 and fitted.deviance < fitted.constant_deviance


def test_fits_of_small_tables_run_side_by_side():
    """a pass over a small table leaves the cluster idle."""
    both = threading.Barrier(2)

    def fit(n):
        both.wait(20)
        return n

    assert L.side_by_side(100, [partial(fit, 1), partial(fit, 2)]) == [1, 2]
    order = []
    assert L.side_by_side(L.FULL_PARTITION + 1, [partial(order.append, n) for n in range(3)]) == [None] * 3
    assert order == [0, 1, 2]
