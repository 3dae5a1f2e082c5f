import pytest

from lagfield.operators.learners import TreeParams
from lagfield.operators.product_features import ProductConfig
from lagfield.plans import catalog as Q
from lagfield.plans import pair_hurdle as H
from lagfield.plans import product_experiment as E
from lagfield.sources import testviews as V

FEW = TreeParams(trees=2, depth=3)


def test_product_experiment_end_to_end(spark, sf):
    sources = E.Sources(Q.history(spark, sf), V.requested(spark, sf), V.products(spark, sf), V.stocks(spark, sf), Q.panel(spark, sf))
    candidates = [c for c in E.CANDIDATES if c.name in ("lags_raw", "limpio_log", "cp_agregada_raw")]
    out = E.run(sources, 200007, 200105, 200107, candidates, params=FEW)
    runs = {(r.candidate, r.anchor): r for r in out.runs.collect()}
    assert len(runs) == 6 and runs["cp_agregada_raw", 200007].n_features == 59
    assert runs["lags_raw", 200105].train_rows > runs["lags_raw", 200007].train_rows
    ranking = out.ranking.collect()
    assert [r.score_seleccion for r in ranking] == sorted(r.score_seleccion for r in ranking)
    assert out.winner.name == ranking[0].candidate == out.manifest["winner"]
    assert out.forecast.count() == V.requested(spark, sf).count()
    assert out.manifest["tn_total"] > 0


def test_walk_forward_keeps_training_targets_before_the_anchor(spark, sf):
    sources = E.Sources(Q.history(spark, sf), V.requested(spark, sf))
    built = E.prepare(sources, E.Candidate("lags_raw", ProductConfig()))
    out = E.walk_forward(built, 200104, (200103, 200104, 200105), params=FEW)
    assert out.row["train_until"] == 200101 and out.row["wape"] > 0


def test_pair_route_end_to_end(spark, sf):
    season = H.Validation("febrero", 199907, 200007)
    control = H.Validation("diciembre", 200005, 200105)
    final = H.Validation("final", 200007, 200107)
    out = H.run(
        Q.panel(spark, sf), V.products(spark, sf), V.stocks(spark, sf), V.requested(spark, sf), (season, control), final,
        variants=("one_stage", "hurdle_cluster"), params=FEW,
    )
    assert out.runs.count() == 4 and out.winner in ("one_stage", "hurdle_cluster")
    row = out.runs.where("variant = 'hurdle_cluster'").first()
    assert row.n_features == 89 and row.wape_calibrated <= row.wape
    assert out.forecast.count() == V.requested(spark, sf).count()
    assert out.forecast.where("tn < 0 or tn is null").count() == 0


def test_cluster_variant_without_maps_is_refused(spark, sf):
    table = Q.full_pair(spark, sf).table
    with pytest.raises(ValueError):
        H.evaluate(table, Q.full_pair_names(), "hurdle_cluster", H.Validation("x", 200007, 200107))
