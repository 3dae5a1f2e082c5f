"""Product-level experiment: back-test feature sets, rank them, forecast with the best."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.functions.periods import shift_period
from lagfield.operators.features import FeatureSet
from lagfield.operators.learners import Fitted, TreeParams, boosted_l1
from lagfield.operators.metrics import selection_scores, wape
from lagfield.operators.naive import submission
from lagfield.operators.panel import anchor_rows, training_rows
from lagfield.operators.product_features import ProductConfig, build_features
from lagfield.operators.structure import structure, structure_lags
from lagfield.session import stored


@dataclass(frozen=True)
class Candidate:
    """A feature set with its target scale; ``with_structure`` adds the commercial structure columns."""

    name: str
    config: ProductConfig = field(default_factory=ProductConfig)
    log_target: bool = False
    with_structure: bool = False

    @property
    def scale(self) -> str:
        return "log" if self.log_target else "raw"


_CLEAN = dict(windows=(3, 6, 12), deltas=True, shares=True)
# fixed values: the candidate feature sets that are compared
CANDIDATES = (
    Candidate("lags_raw"),
    Candidate("limpio_raw", ProductConfig(**_CLEAN)),
    Candidate("limpio_log", ProductConfig(**_CLEAN), log_target=True),
    Candidate("limpio_stock_raw", ProductConfig(**_CLEAN, stocks=True)),
    Candidate("cp_agregada_raw", with_structure=True),
    Candidate("cp_agregada_stock_raw", ProductConfig(stocks=True), with_structure=True),
)


@dataclass(frozen=True)
class Sources:
    """Tables an experiment reads; the panel is needed for structure columns only."""

    history: DataFrame
    requested: DataFrame
    attributes: DataFrame | None = None
    stocks: DataFrame | None = None
    panel: DataFrame | None = None


def prepare(sources: Sources, candidate: Candidate, extra: FeatureSet | None = None) -> FeatureSet:
    """The stored feature table of a candidate; anchors are filters on it."""
    built = build_features(sources.history, candidate.config, sources.attributes, sources.stocks)
    table, names = built.table, list(built.features)
    if candidate.with_structure:
        if extra is None:
            raise ValueError(f"{candidate.name} needs the structure features")
        table = table.join(extra.table, ["product_id", "periodo"], "left")
        names += extra.features
    return FeatureSet(stored(table, f"features-{candidate.name}"), names, built.categorical)


@dataclass(frozen=True)
class Validated:
    row: dict
    predictions: DataFrame
    importance: DataFrame


def _fit(train: DataFrame, score: DataFrame, built: FeatureSet, log: bool, seeds: Sequence[int], params: TreeParams) -> Fitted:
    return boosted_l1(train, score, built.features, built.categorical, log, seeds, params)


def validate(
    built: FeatureSet, candidate: Candidate, anchor: int, seeds: Sequence[int] = (1,), params: TreeParams = TreeParams(),
    horizon: int = 2,
) -> Validated:
    """Train on targets known at the anchor, score the anchor month."""
    train, val = training_rows(built.table, anchor, horizon), anchor_rows(built.table, anchor)
    fitted = _fit(train, val, built, candidate.log_target, seeds, params)
    predictions = stored(
        fitted.rows.select("product_id", "periodo", F.col("target").alias("tn_real"), "tn"), "validation"
    )
    row = {
        "candidate": candidate.name, "scale": candidate.scale, "anchor": anchor,
        "wape": wape(predictions).first()["wape"], "n_features": len(built.features),
        "train_rows": train.count(), "val_rows": predictions.count(),
    }
    return Validated(row, predictions, fitted.importance)


def walk_forward(
    built: FeatureSet, train_until: int, anchors: Sequence[int], log_target: bool = True,
    seeds: Sequence[int] = (1,), params: TreeParams = TreeParams(), horizon: int = 2,
) -> Validated:
    """One fit, several anchor months scored together, rows with a null feature left out.

    The last training month is moved back so that no training target lies after
    the first anchor.
    """
    last = min(train_until, shift_period(min(anchors), -horizon))
    full = built.table.dropna(subset=built.features)
    train = full.where((F.col("periodo") <= last) & F.col("target").isNotNull())
    val = full.where(F.col("periodo").isin(list(anchors)) & F.col("target").isNotNull())
    fitted = _fit(train, val, built, log_target, seeds, params)
    predictions = stored(
        fitted.rows.select("product_id", "periodo", F.col("target").alias("tn_real"), "tn"), "walk-forward"
    )
    row = {
        "train_until": last, "wape": wape(predictions).first()["wape"], "n_features": len(built.features),
        "train_rows": train.count(), "val_rows": predictions.count(),
    }
    return Validated(row, predictions, fitted.importance)


@dataclass(frozen=True)
class Experiment:
    runs: DataFrame
    ranking: DataFrame
    winner: Candidate
    importance: dict[str, DataFrame]
    forecast: DataFrame | None
    manifest: dict


def run(
    sources: Sources,
    season: int,
    control: int,
    final_anchor: int | None = None,
    candidates: Sequence[Candidate] = CANDIDATES,
    seeds: Sequence[int] = (1,),
    params: TreeParams = TreeParams(),
    horizon: int = 2,
) -> Experiment:
    """Back-test all candidates on both anchors, rank them, and forecast ``final_anchor`` with the winner."""
    spark = sources.history.sparkSession
    extra = None
    if any(c.with_structure for c in candidates):
        if sources.panel is None:
            raise ValueError("structure candidates need the customer x product panel")
        lagged = structure_lags(structure(sources.panel))
        extra = FeatureSet(stored(lagged.table, "structure"), lagged.features)
    prepared, rows, importance = {}, [], {}
    for candidate in candidates:
        built = prepared[candidate.name] = prepare(sources, candidate, extra)
        for anchor in (season, control):
            result = validate(built, candidate, anchor, seeds, params, horizon)
            rows.append(result.row)
            importance[candidate.name] = result.importance
    runs = spark.createDataFrame(rows)
    by = ["candidate", "scale", "n_features"]
    ranking = selection_scores(runs, season, control, by).orderBy("score_seleccion", "candidate")
    best = ranking.first()["candidate"]
    winner = next(c for c in candidates if c.name == best)
    manifest = {"winner": best, "target_scale": winner.scale, "features": prepared[best].features, "anchors": [season, control]}
    forecast = None
    if final_anchor is not None:
        built = prepared[best]
        fitted = _fit(
            training_rows(built.table, final_anchor, horizon), anchor_rows(built.table, final_anchor, target=None),
            built, winner.log_target, seeds, params,
        )
        forecast = stored(
            submission(sources.requested, fitted.rows.select("product_id", "tn"), sources.history, final_anchor), "forecast"
        )
        importance["final"] = fitted.importance
        manifest["tn_total"] = forecast.agg(F.sum("tn")).first()[0]
    return Experiment(runs, ranking, winner, importance, forecast, manifest)
