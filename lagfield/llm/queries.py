"""The registered queries of the training-data operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lagfield.llm.cotraining import quality_scores
from lagfield.llm.decontaminate import leak_report
from lagfield.llm.html_text import extract_text
from lagfield.llm.line_dedup import line_report
from lagfield.llm.minhash import near_duplicates
from lagfield.llm.mixing import graded, measured, mix
from lagfield.llm.periodic import periodic_runs, with_tail_repeats
from lagfield.llm.pieces import encode, read_model
from lagfield.llm.quality_rules import quality_rules
from lagfield.llm.repair import damaged, repair_report
from lagfield.llm.secrets import secret_report
from lagfield.llm.sharding import place
from lagfield.llm.url_lists import judge_captures, url_keys
from lagfield.session import tune


# fixed values: the public tokenizer file, a parameter of the operator
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules(table(spark, d, "documents"))


def op2_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every different line with its class and the number of lines in that."""
    report = line_report(table(spark, d, "documents"))
    return report.withColumn("line", F.sha2("line", 256)).withColumnRenamed("line", "line_sha256")


def op3_cotraining(spark: SparkSession, d: str) -> DataFrame:
    return quality_scores(table(spark, d, "documents"), table(spark, d, "labels"))


def _hash(column: str, use: str) -> Column:
    """A number below 2^32 that SQL engines agree on."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(use), F.col(column).cast("string"))), 1, 8), 16, 10).cast("long")


def captures(pages: DataFrame) -> DataFrame:
    """The pages as captures of one year, each on a day that its id and url give."""
    day = _hash("url", "day") + F.coalesce("page_id", F.lit(0))
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01"), F.pmod(day, F.lit(366)).cast("int")).alias("fetched_on"))


def list_log(pages: DataFrame) -> DataFrame:
    """A dated list of the pages' own hosts, domains and path prefixes: a sixth of them, added, taken off and some
    added again on days that their hashes give."""
    entries = pages.select(F.explode(url_keys(F.col("url"))).alias("entry")).distinct()
    entries = entries.where(_hash("entry", "list") % 6 == 0)
    first = (_hash("entry", "from") % 366).cast("int")
    days = [(first, True), (first + (20 + _hash("entry", "stay") % 120).cast("int"), False)]
    days.append((first + F.when(_hash("entry", "again") % 3 == 0, 200).cast("int"), True))
    changes = F.array(*[F.struct(day.alias("day"), F.lit(added).alias("added")) for day, added in days])
    log = entries.select("entry", F.explode(changes).alias("c")).where("c.day is not null")
    return log.select("entry", F.date_add(F.lit("2024-01-01"), F.col("c.day")).alias("listed_on"), "c.added")


def op4_url_lists(spark: SparkSession, d: str) -> DataFrame:
    """Every page judged by the list entries that were valid on the day of its capture."""
    pages = table(spark, d, "pages").select("page_id", "url")
    return judge_captures(captures(pages), list_log(pages))


def op5_minhash(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates(table(spark, d, "documents"))


def op6_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secret_report(table(spark, d, "documents"))


def op7_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Token counts and hashes of every document, with both checks."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return encode(docs, read_model(PIECES), digest=True).drop("text")


# fixed values: names of the shards
SHARDS = [f"shard-{i:03d}" for i in range(96)]


def op8_sharding(spark: SparkSession, d: str) -> DataFrame:
    """The shard of every document, and where it would be if the last shard were gone."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    placed = place(docs, ["source", "doc_id"], SHARDS)
    without = place(placed, ["source", "doc_id"], SHARDS[:-1], column="shard_without")
    return without.withColumn("moved", F.col("shard") != F.col("shard_without"))


def op9_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return leak_report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op10_html_text(spark: SparkSession, d: str) -> DataFrame:
    return extract_text(table(spark, d, "pages"))


def op11_repair(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation's faults after damage, and its cheapest repair."""
    talks = table(spark, d, "conversations")
    return repair_report(damaged(talks), ids=talks)


def op12_mix(spark: SparkSession, d: str) -> DataFrame:
    """How many words of every document a mix of the sources takes; labels of quality weigh the sampling."""
    rows = graded(measured(table(spark, d, "documents")), table(spark, d, "labels"))
    return mix(rows).drop("weight")


def op13_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    """Every document's runs of repeated words: their number, the one repeated most, and hashes of all."""
    runs = periodic_runs(with_tail_repeats(table(spark, d, "documents")))
    # lengths over periods are compared as products; runs come by start, then period, so the first of equals stays
    most = F.expr(
        "reduce(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (best, r) -> "
        "if(best is null or r.length * best.period > best.length * r.period, r, best))"
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return runs.withColumn("most", most).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "most.start",
        "most.length",
        "most.period",
        F.expr("most.length * 1000 div most.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_line_dedup, op3_cotraining, op4_url_lists, op5_minhash, op6_secrets, op7_pieces,
        op8_sharding, op9_decontamination, op10_html_text, op11_repair, op12_mix, op13_periodic_runs,
    )
}

# Entries that cover a url, the capture's day and the list's log, as in ``url_keys``, ``captures`` and ``list_log``.
_URL_LISTS = r"""
WITH cut AS (
  SELECT page_id, url,
    regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1) AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS steps,
    DATE '2024-01-01' + CAST((CAST('0x' || substr(md5('day' || url), 1, 8) AS BIGINT) + page_id) % 366 AS INTEGER) AS fetched_on
  FROM pages
), labelled AS (
  SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels FROM cut
), keyed AS (
  SELECT page_id, url, fetched_on, list_distinct(list_concat(
    list_transform(range(1, greatest(len(labels), 1)), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[1:i], '/')))) AS keys
  FROM labelled
), covered AS (
  SELECT page_id, url, fetched_on, unnest(keys) AS entry FROM keyed
), entries AS (
  SELECT DISTINCT entry FROM covered WHERE CAST('0x' || substr(md5('list' || entry), 1, 8) AS BIGINT) % 6 = 0
), days AS (
  SELECT entry, CAST('0x' || substr(md5('from' || entry), 1, 8) AS BIGINT) % 366 AS first,
    20 + CAST('0x' || substr(md5('stay' || entry), 1, 8) AS BIGINT) % 120 AS stay,
    CAST('0x' || substr(md5('again' || entry), 1, 8) AS BIGINT) % 3 = 0 AS again
  FROM entries
), spans AS (
  SELECT entry, first AS a, first + stay AS b FROM days
  UNION ALL SELECT entry, first + 200, NULL FROM days WHERE again
), met AS (
  SELECT page_id, count(*) AS n_entries, arg_max(c.entry, {'n': length(c.entry), 'e': c.entry}) AS entry
  FROM covered c JOIN spans s ON c.entry = s.entry AND c.fetched_on - DATE '2024-01-01' >= s.a
    AND (s.b IS NULL OR c.fetched_on - DATE '2024-01-01' < s.b)
  GROUP BY page_id
)
SELECT k.page_id, k.url, k.fetched_on, coalesce(m.n_entries, 0) AS n_entries, m.entry, m.n_entries IS NOT NULL AS blocked
FROM keyed k LEFT JOIN met m USING (page_id)
"""

# Words, keys and weights as in ``measured``, ``graded`` and ``mix``; the full sources are the first of those in the
# order of ceiling over weight, up to where the share of the others is within the next one's ceiling.
_MIX = r"""
WITH marks AS (
  SELECT doc_id, avg(quality) AS mark FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), drawn AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS size,
    coalesce(1 + 3 * m.mark, 2.0) AS quality,
    (CAST('0x' || substr(md5('0|' || coalesce(CAST(d.doc_id AS VARCHAR), '') || '|' || coalesce(d.source, '') || '|'
      || md5(coalesce(d.text, ''))), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents d LEFT JOIN marks m USING (doc_id)
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS weight
  FROM drawn GROUP BY source
), ranked AS (
  SELECT *, 3.0 * source_size AS ceiling, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k FROM sources
), steps AS (
  SELECT a.k, a.ceiling / a.weight AS bound,
    ((SELECT sum(source_size) FROM ranked) - coalesce((SELECT sum(ceiling) FROM ranked b WHERE b.k < a.k), 0.0))
      / (SELECT sum(weight) FROM ranked b WHERE b.k >= a.k) AS share
  FROM ranked a
), found AS (
  SELECT min(k) AS k, arg_min(share, k) AS share FROM steps WHERE share <= bound
), targets AS (
  SELECT r.source, source_size, CASE WHEN f.k IS NULL OR r.k < f.k THEN ceiling ELSE weight * f.share END AS target
  FROM ranked r, found f
), placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(u) / quality, u
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size / 2 AS middle
  FROM drawn d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), judged AS (
  SELECT *, size > 0 AND middle <= target - epochs * source_size AND epochs < 3 AS picked FROM placed
)
SELECT doc_id, source, size, source_size, target, epochs, picked, size * (epochs + CAST(picked AS BIGINT)) AS taken FROM judged
"""

SQL: dict[str, str] = {"op4_url_lists": _URL_LISTS, "op12_mix": _MIX}
