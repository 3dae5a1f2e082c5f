"""Quality rules by distribution divergence, with DataFrame functions only.

A document is compared with its language: the shares of six character classes and the shares of the language's
common words, each by Jensen-Shannon distance (base 2, 0 to 1). The references are means over the documents of the
language, so a very long document weighs no more than a short one; class shares are averaged twice, the second time
over the documents no farther than the average one. Guards: a histogram is judged only if the
document has enough words and the language enough documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagfield.llm.common import WORDY, clean_columns, let, words
from lagfield.operators.relational import attach
from lagfield.session import stored

# fixed values: rules of the base verdict
SYMBOLS = r"[#*$%&|<>]+"
WINDOW, MIN_WORDS, MAX_REPEAT = 8, 20, 30
CLASSES = ("space", "upper", "digit", "punct", "symbol", "letter")


@dataclass(frozen=True)
class DivergenceConfig:
    """``guard_words`` words are needed to judge a histogram, ``guard_docs`` documents to make a reference.

    A common word occurs in at least ``common_share`` of the language's documents; the ``common_words`` most
    frequent of them form the histogram, all other words one more bin. Shares of a short text scatter, so the
    largest distance allowed is ``limit * (1 + slack_words / words)``.
    """

    guard_words: int = 40
    guard_docs: int = 20
    common_words: int = 40
    common_share: float = 0.1
    max_class: float = 0.165
    max_words: float = 0.45
    slack_words: int = 20


def js_term(p: Column, q: Column) -> Column:
    """One bin's part of the Jensen-Shannon divergence."""
    both = p + q
    part = lambda x: F.when(x > 0, x * F.log2(2 * x / both)).otherwise(0.0)
    return (part(p) + part(q)) / 2


def _removed(text: Column, pattern: str) -> Column:
    """Characters that match."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, F.lit("")))).cast("long")


def _repeated_words(w: Column) -> Column:
    """Words inside windows of eight that occur twice or more in the same text."""

    def covered(starts: Column) -> Column:
        # sorted starts: each covers up to the next one, at most a whole window
        steps = F.zip_with(
            F.slice(starts, 2, F.size(starts)), F.slice(starts, 1, F.size(starts) - 1),
            lambda after, at: F.least(after - at, F.lit(WINDOW)),
        )
        return F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step).cast("long")

    def twins(ranked: Column) -> Column:
        # ranked: (hash, start), sorted; a window with a twin has it as a neighbour
        hash_at = lambda i: F.get(ranked, i)["h"]
        same = lambda i: (hash_at(i) == hash_at(i - 1)) | (hash_at(i) == hash_at(i + 1))
        kept = F.filter(
            F.transform(ranked, lambda x, i: F.when(F.coalesce(same(i), F.lit(False)), x["at"])),
            lambda at: at.isNotNull(),
        )
        return let(F.array_sort(kept), covered)

    def repeats(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(unique, F.lit(0).cast("long")).otherwise(let(ranked, twins))

    starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    hashes = F.transform(starts, lambda at: F.xxhash64(F.slice(w, at, WINDOW)))
    return F.when(F.size(w) < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(hashes, repeats))


def text_counts(text: Column) -> Column:
    """The base counts and character classes of one text as a struct; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def lines(parts: Column) -> Column:
        return (F.size(parts) - F.size(F.array_distinct(parts))).cast("long")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated_words(w).alias("n_repeat_words"),
        )

    return F.struct(
        let(words(text), of_words).alias("w"),
        let(F.filter(F.split(text, "\n"), lambda x: x.rlike(WORDY)), lines).alias("n_dup_lines"),
        _removed(text, SYMBOLS).alias("symbol"),
        _removed(text, r"\p{Lu}+").alias("upper"),
        _removed(text, r"\p{Nd}+").alias("digit"),
        _removed(text, r"[\p{P}&&[^#*%&]]+").alias("punct"),
        F.length(text).cast("long").alias("n_chars"),
    )


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    config: DivergenceConfig = DivergenceConfig(),
) -> DataFrame:
    """One row per input row: the base counts, both distances and the verdict.

    Columns: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, class_distance,
    words_distance, kept. A distance is null where a guard holds it back, and null distances pass. Null and empty
    texts have no words and fail the base rules. A null language is a language of its own. Repeated rows give
    repeated results; an empty table gives an empty one.
    """
    docs = clean_columns(docs, id=id_col, text=text_col, lang=lang_col)
    docs = docs.withColumn("lang", F.coalesce("lang", F.lit("")))
    # null ids do not meet in a join: they take a value of their own, and the hash says that it is none
    unset = F.lit("0").try_cast(docs.schema["id"].dataType)
    docs = docs.withColumn("unset", F.col("id").isNull()).withColumn("h", F.xxhash64("text", "unset"))
    docs = docs.withColumn("id", F.coalesce("id", unset))
    key = ["lang", "id", "h"]

    counted = docs.select(*key, "unset", text_counts(F.col("text")).alias("c"))
    counts = stored(
        counted.select(
            *key, "unset", "c.w.*", "c.n_dup_lines", "c.n_chars", "c.symbol", "c.upper", "c.digit", "c.punct",
            (F.col("c.n_chars") - F.col("c.w.word_chars")).alias("space"),
        ).withColumn("letter", F.col("word_chars") - F.col("symbol") - F.col("upper") - F.col("digit") - F.col("punct")),
        "rule-counts",
    )
    long_enough = F.col("n_words") >= config.guard_words
    shares = {c: F.when(long_enough, F.col(c) / F.col("n_chars")) for c in CLASSES}
    divergence = F.greatest(F.lit(0.0), sum((js_term(shares[c], F.col(f"q_{c}")) for c in CLASSES), F.lit(0.0)))

    def means(rows: DataFrame) -> DataFrame:
        return rows.where(long_enough).groupBy("lang").agg(*[F.avg(shares[c]).alias(f"q_{c}") for c in CLASSES])

    # Junk pulls at a mean; the second one is taken over the nearer documents only.
    sizes = counts.groupBy("lang").agg(F.count(F.when(long_enough, 1)).alias("n_docs"), F.count(F.lit(1)).alias("n_rows"))
    first_pass = stored(means(counts), "rule-means")
    measured = attach(counts, first_pass, ["lang"], ["id", "h"], "inner").withColumn("d", divergence)
    usual_d = stored(measured.where(long_enough).groupBy("lang").agg(F.avg("d").alias("usual_d")), "rule-usual-d")
    near = attach(measured, usual_d, ["lang"], ["id", "h"], "inner").where(F.col("d") <= F.col("usual_d"))
    judged = stored(
        means(near).join(sizes.where(F.col("n_docs") >= config.guard_docs), "lang"), "rule-classes"
    )

    # The number of common words is bounded: a document adds to few, and each needs a share of all documents.
    held = docs.select("lang", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
    frequent = attach(held.groupBy("lang", "word").count(), judged.select("lang", "n_rows"), ["lang"], ["word"], "inner")
    frequent = frequent.where(F.col("count") >= F.greatest(F.lit(2.0), config.common_share * F.col("n_rows")))
    first = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    common = stored(
        frequent.withColumn("bin", F.row_number().over(first)).where(F.col("bin") <= config.common_words)
        .select("lang", "word", "bin"),
        "rule-words",
    )

    spelled = docs.select(*key, F.explode(words(F.col("text"))).alias("word"))
    binned = attach(spelled, common, ["lang", "word"], ["id", "h"])
    bins = stored(
        binned.groupBy(*key, F.coalesce("bin", F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("n")), "rule-bins"
    )
    totals = bins.groupBy(*key).agg(F.sum("n").alias("total"))
    bins = bins.join(totals, key).where(F.col("total") >= config.guard_words)
    bins = bins.select(*key, "bin", (F.col("n") / F.col("total")).alias("p"))
    usual = bins.groupBy("lang", "bin").agg(F.sum("p").alias("sum_p"))
    usual = stored(
        usual.join(bins.select(*key).distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "lang")
        .select("lang", "bin", (F.col("sum_p") / F.col("n")).alias("q")),
        "rule-usual",
    )
    met = attach(bins, usual, ["lang", "bin"], ["id", "h"], "inner")
    # Bins a document lacks add half their reference share each.
    apart = met.groupBy(*key).agg((F.sum(js_term(F.col("p"), F.col("q"))) + (1 - F.sum("q")) / 2).alias("d"))

    rows = attach(counts, judged.select("lang", *[f"q_{c}" for c in CLASSES]), ["lang"], ["id", "h"])
    rows = rows.join(apart, key, "left")
    judged_row = long_enough & F.col("q_space").isNotNull()
    distance = lambda d: F.when(judged_row, F.sqrt(F.greatest(d, F.lit(0.0))))
    rows = rows.withColumns({"class_distance": distance(divergence), "words_distance": distance(F.col("d"))})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    slack = 1 + config.slack_words / F.greatest(F.col("n_words"), F.lit(1))
    passes = (F.coalesce("class_distance", F.lit(0.0)) <= config.max_class * slack) & (
        F.coalesce("words_distance", F.lit(0.0)) <= config.max_words * slack
    )
    return rows.select(
        F.when(~F.col("unset"), F.col("id")).alias(id_col), "n_words", "word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"), "class_distance", "words_distance",
        (~failed & passes).alias("kept"),
    )
