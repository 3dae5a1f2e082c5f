import pytest
from pyspark.sql import functions as F

from lagfield.functions.periods import add_months, from_index, month_index, shift_period
from lagfield.operators import panel as P
from lagfield.plans import catalog as Q
from lagfield.sources import testviews as V

FACTS = "customer_id bigint, product_id bigint, periodo int, plan_flag int, request_tn double, tn double"


def facts(spark, rows):
    return spark.createDataFrame(rows, FACTS)


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_month_arithmetic(spark):
    df = spark.createDataFrame([(201911,), (201912,), (202001,), (200012,)], "p int")
    got = df.select("p", add_months("p", 2), add_months("p", -13), from_index(month_index("p"))).collect()
    assert [tuple(r) for r in got] == [
        (201911, 202001, 201810, 201911), (201912, 202002, 201811, 201912), (202001, 202003, 201812, 202001),
        (200012, 200102, 199911, 200012),
    ]
    assert [shift_period(201912, k) for k in (2, -10, -11, 0)] == [202002, 201902, 201901, 201912]


def test_densify_fills_own_life_only(spark):
    df = spark.createDataFrame([(1, 201911, 5.0), (1, 202002, 7.0), (2, 202001, 1.0)], "product_id bigint, periodo int, tn double")
    got = rows_of(P.densify(df, ["product_id"]), "product_id", "periodo")
    assert got == [(1, 201911, 5.0), (1, 201912, 0.0), (1, 202001, 0.0), (1, 202002, 7.0), (2, 202001, 1.0)]
    longer = rows_of(P.densify(df, ["product_id"], until=202003), "product_id", "periodo")
    assert [r[1] for r in longer if r[0] == 2] == [202001, 202002, 202003]
    assert [r[2] for r in longer if r[0] == 1] == [5.0, 0.0, 0.0, 7.0, 0.0]


def test_positional_and_calendar_lags_differ_on_a_gap(spark):
    df = spark.createDataFrame([(1, 202001, 1.0), (1, 202003, 3.0)], "product_id bigint, periodo int, tn double")
    rowwise = {r.periodo: r.tn_1 for r in P.lag_table(df, lags=2).collect()}
    monthly = {r.periodo: r.tn_1 for r in P.calendar_lag_table(df, lags=2).collect()}
    assert rowwise[202003] == 1.0
    assert monthly[202003] == 0.0 and monthly[202002] == 1.0


SMALL = [
    (1, 10, 202001, 0, 2.0, 2.0),
    (1, 10, 202001, 1, 1.0, 1.0),  # the same key twice
    (1, 10, 202003, 0, 4.0, 4.0),
    (2, 10, 202002, 1, 5.0, 5.0),
    (2, 20, 202002, 0, 3.0, 3.0),  # never bought by customer 1
]


def test_zero_fill_keeps_repeated_facts(spark):
    got = rows_of(P.zero_fill(facts(spark, SMALL)), *P.GRAIN, "tn")
    assert got == [
        (1, 10, 202001, 1, 1.0, 1.0), (1, 10, 202001, 0, 2.0, 2.0), (1, 10, 202002, 1, 0.0, 0.0), (1, 10, 202003, 0, 4.0, 4.0),
        (1, 20, 202002, 0, 0.0, 0.0), (2, 10, 202002, 1, 5.0, 5.0), (2, 10, 202003, 0, 0.0, 0.0), (2, 20, 202002, 0, 3.0, 3.0),
    ]


def test_pair_panel_equals_fill_then_collapse(spark):
    f = facts(spark, SMALL)
    assert rows_of(P.pair_panel(f), *P.GRAIN) == rows_of(P.one_row_per_month(P.zero_fill(f)), *P.GRAIN)


def test_zero_fill_skips_months_absent_from_all_facts(spark):
    f = facts(spark, [(1, 10, 202001, 0, 1.0, 1.0), (1, 10, 202004, 0, 1.0, 1.0)])
    assert sorted(r.periodo for r in P.zero_fill(f).collect()) == [202001, 202004]


def test_row_identity(spark, sf):
    s = Q.sales(spark, sf)
    assert P.zero_fill(s).count() == s.count() + P.life_grid(s).count() - s.select(*P.GRAIN).distinct().count()


def test_pair_panel_shuffles_the_pair_once(spark, sf):
    from lagfield.functions import series as S

    w = S.series(P.PAIR)
    built = P.pair_panel(V.sales(spark, sf)).select("*", S.lag("tn", 1, w), S.rolling("tn", "mean", 3, w))
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1
    head = plan.split("Union")[0]
    assert head.count("Exchange hashpartitioning") == 1


def test_training_rows_stop_before_the_anchor(spark):
    df = spark.createDataFrame([(1, p, 1.0) for p in (202001, 202002, 202003, 202004)], "product_id bigint, periodo int, target double")
    assert [r.periodo for r in P.training_rows(df, 202004).collect()] == [202001, 202002]
    got = P.split_counts(df, (202004,)).first()
    assert (got.train_rows, got.val_rows) == (2, 1)


@pytest.mark.parametrize("n", [1, 5])
def test_product_sample_is_repeatable(spark, sf, n):
    p = Q.panel(spark, sf)
    one = {r[0] for r in P.sample_products(p, n, 7).select("product_id").distinct().collect()}
    two = {r[0] for r in P.sample_products(p.repartition(3), n, 7).select("product_id").distinct().collect()}
    assert one == two and len(one) == n
    assert P.sample_products(p, n, 7).count() == p.where(F.col("product_id").isin(list(one))).count()


def test_packed_panel_is_the_panel(spark):
    """Nulls, gaps, repeated facts and facts without a flag: the same rows, whatever the parts."""
    rows = [*SMALL, (None, 10, 202001, 1, 2.0, 1.0), (1, None, 202002, 0, 2.0, 1.0), (1, 10, None, 0, 3.0, 1.0), (3, 11, 202003, None, 4.0, None), (4, 12, None, None, 4.0, 1.0)]
    f = facts(spark, rows)
    want = rows_of(P.pair_panel(f), *P.GRAIN)
    for parts in (None, 1, 3):
        got = P.unpacked(P.packed_panel(f, parts=parts))
        assert got.columns == P.pair_panel(f).columns
        assert rows_of(got, *P.GRAIN) == want


def test_windows_over_the_kept_panel_need_no_shuffle(spark, sf):
    from lagfield.functions import series as S

    lagged = Q.panel(spark, sf).select(*P.GRAIN, S.lag("tn", 1, S.series(P.PAIR)).alias("before"))
    plan = lagged._jdf.queryExecution().executedPlan().toString()
    assert "Window [" in plan and "Exchange" not in plan
