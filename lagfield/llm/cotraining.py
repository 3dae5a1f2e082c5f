"""Quality classifier by co-training of two views.

One classifier sees what a text says (hashed words and word shapes), the other what is known about it (source,
language, size, layout). Over some rounds each looks at all documents without a label and labels those that it is
sure of, for the other one to learn from. Both are then calibrated on labels kept aside, and their log-odds are added
up to score all documents.

The features of all documents are written once, as counts, and every round is a narrow pass over them: what a row is
passed on as follows from the models so far, so nothing is joined or sorted, and nothing but models is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.llm.common import clean_columns, let, words
from lagfield.session import stored


@dataclass(frozen=True)
class CoTrainingConfig:
    """``labelled`` bounds the rows with a true label that are used, taken by a hash of their ids; nothing else is bounded.

    A fifth of these is kept aside for calibration. In each of ``rounds`` rounds a view passes on every other row to
    which it gives a probability of ``sure`` or more for a class. Rows once passed on stay. The rows passed on for a class
    weigh together no more than the labelled ones of that class, so their number does not move the odds of the classes.
    """

    labelled: int = 8_000
    rounds: int = 3
    sure: float = 0.97
    word_bins: int = 1 << 13
    shape_bins: int = 1 << 8
    meta_bins: int = 1 << 8
    iterations: int = 25
    reg: float = 1e-4
    block_mb: float = 0.25
    min_score: float = 0.5


NUMBERS = ("log_chars", "log_lines", "line_words", "word_chars", "upper", "digit", "sign", "fresh_words", "fresh_lines")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def _layout(text: Column, shape: Column, n_chars: Column) -> list[Column]:
    """Counts about a text, all between about 0 and 1.

    ``shape`` is the text with one letter in place of each run of letters of a case. Digits and signs are the same in it,
    and it is a third as long to look through.
    """
    removed = lambda pattern, of: F.length(of) - F.length(F.regexp_replace(of, pattern, F.lit("")))
    w, lines = F.col("w"), F.split(text, "\n")
    n = F.size(w).cast("double")
    fresh = lambda x: _share(F.size(F.array_distinct(x)).cast("double"), F.size(x))
    size = F.length(text).cast("double")
    return [
        (F.log1p(n_chars.cast("double")) / 10).alias("log_chars"),
        (F.log1p(F.size(lines).cast("double")) / 5).alias("log_lines"),
        F.least(_share(n, F.size(lines)) / 100, F.lit(2.0)).alias("line_words"),
        F.least(_share(size, n) / 10, F.lit(3.0)).alias("word_chars"),
        _share(removed(r"\p{Lu}+", text), size).alias("upper"),
        _share(removed(r"\p{Nd}+", shape), size).alias("digit"),
        _share(removed(r"[^\p{L}\p{N}\s.,]+", shape), size).alias("sign"),
        fresh(w).alias("fresh_words"),
        let(lines, fresh).alias("fresh_lines"),
    ]


def view_counts(docs: DataFrame, config: CoTrainingConfig) -> DataFrame:
    """``docs(id, text, lang, source, n_chars, ...)`` as hashed counts of words and shapes and the meta vector.

    Other columns stay. Counts take a fraction of the room of normalised vectors, as they repeat.
    """
    text = F.col("text")
    others = [c for c in docs.columns if c not in ("id", "text", "lang", "source", "n_chars")]
    shape = F.regexp_replace(F.regexp_replace(text, r"\p{Lu}+", F.lit("A")), r"\p{Ll}+", F.lit("a"))
    rows = docs.select("*", words(F.lower(text)).alias("w"), shape.alias("shape"))
    rows = rows.select(
        "*", words(F.regexp_replace("shape", r"\p{Nd}+", F.lit("9"))).alias("shapes"),
        *_layout(text, F.col("shape"), F.coalesce(F.col("n_chars"), F.length(text))),
    ).drop("text", "shape", "n_chars")
    steps = [
        HashingTF(inputCol="w", outputCol="word_counts", numFeatures=config.word_bins),
        HashingTF(inputCol="shapes", outputCol="shape_counts", numFeatures=config.shape_bins),
        FeatureHasher(
            inputCols=["lang", "source", *NUMBERS], outputCol="meta", numFeatures=config.meta_bins,
            categoricalCols=["lang", "source"],
        ),
    ]
    for step in steps:
        rows = step.transform(rows)
    return rows.select("id", "word_counts", "shape_counts", "meta", *others)


def view_features(counts: DataFrame) -> DataFrame:
    """The counts as content and meta vectors; other columns stay."""
    steps = [
        Normalizer(inputCol="word_counts", outputCol="word_part"),
        Normalizer(inputCol="shape_counts", outputCol="shape_part"),
        VectorAssembler(inputCols=["word_part", "shape_part"], outputCol="content"),
    ]
    for step in steps:
        counts = step.transform(counts)
    return counts.drop("word_counts", "shape_counts", "word_part", "shape_part")


def _fit(rows: DataFrame, features: str, config: CoTrainingConfig) -> LogisticRegressionModel:
    # blocks of the default size are arrays of half a region of the heap and more, which the JVM can neither move nor pack
    return LogisticRegression(
        featuresCol=features, labelCol="label", weightCol="weight", maxIter=config.iterations, regParam=config.reg,
        standardization=False, maxBlockSizeInMB=config.block_mb,
    ).fit(rows)


def _margin(model: LogisticRegressionModel, rows: DataFrame, view: str) -> DataFrame:
    scored = model.setRawPredictionCol("_raw").setProbabilityCol("").setPredictionCol("").transform(rows)
    return scored.withColumn(f"m_{view}", vector_to_array("_raw")[1]).drop("_raw")


@dataclass(frozen=True)
class CoTrained:
    """Both models, their calibration (slope and offset of the margin) and the log-odds of the labels."""

    models: dict[str, LogisticRegressionModel]
    calibration: dict[str, tuple[float, float]]
    prior: float
    config: CoTrainingConfig

    def score(self, features: DataFrame) -> DataFrame:
        """``features`` with content_score, meta_score and score, the probability of good quality."""
        odds = {}
        for view, model in self.models.items():
            features = _margin(model, features, view)
            slope, offset = self.calibration[view]
            odds[view] = F.col(f"m_{view}") * slope + offset
        chance = lambda x: 1 / (1 + F.exp(-x))
        # independent views: their log-odds add up, the prior counts once
        both = odds["content"] + odds["meta"] - self.prior
        return features.select(
            "*", chance(odds["content"]).alias("content_score"), chance(odds["meta"]).alias("meta_score"),
            chance(both).alias("score"),
        )


def first_ids(ids: DataFrame, count: int) -> DataFrame:
    """At most ``count`` rows, by a hash of the id."""
    return ids.orderBy(F.xxhash64("id"), "id").limit(count)


OTHER = {"content": "meta", "meta": "content"}


def _pass_on(rows: DataFrame, models: dict[str, LogisticRegressionModel], sure: float) -> DataFrame:
    """``rows`` with for_content and for_meta, the labels given by the other view, if it is sure of one.

    A label given in an earlier round stays.
    """
    edge = log(sure / (1 - sure))
    for view, model in models.items():
        margin, target = F.col(f"m_{view}"), f"for_{OTHER[view]}"
        given = F.when(margin >= edge, 1.0).when(margin <= -edge, 0.0)
        rows = _margin(model, rows, view).withColumn(target, F.coalesce(target, given)).drop(f"m_{view}")
    return rows


def _training(base: DataFrame, rows: DataFrame, known: dict[float, int]) -> dict[str, DataFrame]:
    """Labelled rows and all rows passed on, by view; ``known`` counts the labelled ones of each class."""
    sums = [F.count_if(F.col(f"for_{view}") == c).alias(f"{view}_{c:.0f}") for view in OTHER for c in known]
    passed = rows.agg(*sums).first()
    training = {}
    for view in OTHER:
        label, weight = F.col(f"for_{view}"), F.lit(0.0)
        for c, n in known.items():
            weight = F.when(label == c, min(1.0, n / max(passed[f"{view}_{c:.0f}"], 1))).otherwise(weight)
        more = rows.where(label.isNotNull()).select(view, label.alias("label"), weight.alias("weight"))
        training[view] = base.select(view, "label", F.lit(1.0).alias("weight")).unionByName(more)
    return training


def mark_labelled(rows: DataFrame, labels: DataFrame, config: CoTrainingConfig) -> DataFrame:
    """``rows`` with label and aside, whether it is kept for calibration; both null without a label that is used."""
    known = labels.where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    present = rows.where("id is not null").select("id").distinct()
    aside = F.pmod(F.xxhash64("id", F.lit("aside")), F.lit(5)) == 0
    # bounded by the configuration
    taken = first_ids(known.join(present, "id"), config.labelled).select("id", F.col("label").cast("double"), aside.alias("aside"))
    return rows.join(F.broadcast(stored(taken, "co-taken")), "id", "left")


def co_train(
    counts: DataFrame, labels: DataFrame, config: CoTrainingConfig = CoTrainingConfig()
) -> CoTrained | None:
    """Fit both views on the output of ``view_counts`` and ``labels(id, label)``; None without both classes.

    Rows with a null id, and labelled rows beyond the bound, take part as rows without a label.
    """
    return co_train_marked(stored(mark_labelled(counts, labels, config), "co-marked"), config)


def co_train_marked(marked: DataFrame, config: CoTrainingConfig = CoTrainingConfig()) -> CoTrained | None:
    """``co_train`` on counts that ``mark_labelled`` marked and that are stored, as they are gone through many times."""
    marked = marked.select("id", "word_counts", "shape_counts", "meta", "label", "aside")
    labelled = stored(view_features(marked.where("label is not null").dropDuplicates(["id"])), "co-labelled")
    sizes = {(r.aside, r.label): r.n for r in labelled.groupBy("aside", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any((a, c) not in sizes for a in (True, False) for c in (0.0, 1.0)):
        return None
    held, base = labelled.where("aside"), labelled.where("not aside")
    null = F.lit(None).cast("double")
    rows = view_features(marked.where("label is null").drop("id", "label", "aside"))
    rows = rows.withColumns({f"for_{view}": null for view in OTHER})
    training = {view: base.select(view, "label", F.lit(1.0).alias("weight")) for view in OTHER}
    for _ in range(config.rounds):
        models = {view: _fit(training[view], view, config) for view in OTHER}
        rows = _pass_on(rows, models, config.sure)
        training = _training(base, rows, {c: sizes[False, c] for c in (0.0, 1.0)})
    models = {view: _fit(training[view], view, config) for view in OTHER}
    calibration = {}
    for view, model in models.items():
        points = _margin(model, held, view).select("label", array_to_vector(F.array(f"m_{view}")).alias("x"))
        line = LogisticRegression(featuresCol="x", labelCol="label", maxIter=50, regParam=1e-3).fit(points)
        calibration[view] = (float(line.coefficients[0]), float(line.intercept))
    good, bad = (sum(sizes[a, c] for a in (True, False)) for c in (1.0, 0.0))
    return CoTrained(models, calibration, log(good / bad), config)


def _row_key(*columns: Column) -> list[Column]:
    """Two hashes of a whole row, never null; rows that differ in one of the columns differ in them."""
    flags = [F.isnull(c) for c in columns]
    return [F.xxhash64(F.lit(seed), *flags, *columns) for seed in ("first", "second")]


def _verdicts(
    docs: DataFrame, labels: DataFrame, names: dict[str, str], label_id: str, label_col: str, config: CoTrainingConfig
) -> DataFrame:
    """id, key_a and key_b (of the whole row), the three scores and kept, one row per input row."""
    rows = clean_columns(docs, **names)
    key_a, key_b = _row_key(*[F.col(c) for c in names])
    rows = rows.select("*", key_a.alias("key_a"), key_b.alias("key_b"))
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("text", "lang", "source")})
    # labels are joined once, before the counts are stored, and not in every pass over these
    marked = mark_labelled(rows, clean_columns(labels, id=label_id, label=label_col), config)
    counts = stored(view_counts(marked, config), "co-counts")
    trained = co_train_marked(counts, config)
    scores = ["content_score", "meta_score", "score"]
    if trained is None:
        scored = counts.withColumns({c: F.lit(None).cast("double") for c in scores})
    else:
        scored = trained.score(view_features(counts.drop("label", "aside")))
    kept = F.coalesce(F.col("score") >= config.min_score, F.lit(True))
    return scored.select("id", "key_a", "key_b", *scores, kept.alias("kept"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    source_col: str = "source", size_col: str = "n_chars", label_id: str = "doc_id", label_col: str = "quality",
    config: CoTrainingConfig = CoTrainingConfig(),
) -> DataFrame:
    """One row per input row: id, content_score, meta_score, score, kept (score of at least ``min_score``).

    Null and empty texts are scored as texts without words, null metadata as a value of its own; repeated rows get
    equal scores, and so do rows with a null id, which no label reaches. Of several labels of an id the largest counts.
    Texts count whole, however long. Without labels of both classes scores are null and all rows are kept; an empty
    table gives an empty one.
    """
    names = {"id": id_col, "text": text_col, "lang": lang_col, "source": source_col, "n_chars": size_col}
    scored = _verdicts(docs, labels, names, label_id, label_col, config)
    return scored.select(F.col("id").alias(id_col), "content_score", "meta_score", "score", "kept")


def good_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    source_col: str = "source", size_col: str = "n_chars", label_id: str = "doc_id", label_col: str = "quality",
    config: CoTrainingConfig = CoTrainingConfig(),
) -> DataFrame:
    """The rows that ``quality_scores`` keeps, with all their columns.

    Rows are told apart by all that the classifier sees of them, not by the id: a bad row with a null id goes, and a
    good one that shares its id with a bad one stays.
    """
    names = {"id": id_col, "text": text_col, "lang": lang_col, "source": source_col, "n_chars": size_col}
    bad = _verdicts(docs, labels, names, label_id, label_col, config).where(~F.col("kept"))
    bad = bad.select(F.col("key_a").alias("_bad_a"), F.col("key_b").alias("_bad_b")).distinct()
    key_a, key_b = _row_key(*[docs[c] for c in names.values()])
    return docs.join(bad, (key_a == bad["_bad_a"]) & (key_b == bad["_bad_b"]), "left_anti")
