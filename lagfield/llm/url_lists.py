"""URL filters by a temporal list join.

A list is a log of dated changes: an entry is added or taken off. The changes become validity intervals, and every
capture is judged by the entries that were valid when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagfield.llm.common import clean_columns, let
from lagfield.operators.relational import attach
from lagfield.session import stored


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without user, port and last dot; empty if there is none."""
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*?)\.?(?::\d*)?(?:[/?#]|$)", 1)


def path_of(url: Column) -> Column:
    """Path of a URL, without query and fragment."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_keys(url: Column) -> Column:
    """Entries that cover a URL: its host and the domains above it of two labels or more, and its path prefixes."""

    def domains(labels: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(labels) - 1)
        return F.when(F.size(labels) < 2, F.array().cast("array<string>")).otherwise(
            F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        )

    def prefixes(steps: Column) -> Column:
        ends = F.sequence(F.lit(1), F.size(steps))
        return F.when(F.size(steps) < 1, F.array().cast("array<string>")).otherwise(
            F.transform(ends, lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(steps, 1, i), "/")))
        )

    labels = F.filter(F.split(host_of(url), r"\."), lambda x: x != "")
    steps = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    return F.when(host_of(url) == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(let(labels, domains), let(steps, prefixes)))
    )


def list_intervals(log: DataFrame) -> DataFrame:
    """Validity intervals ``(entry, valid_from, valid_to)`` of a log ``(entry, listed_on, added)``.

    An entry is valid from the day it is added, to the day before it is taken off; an open end is null. Of several
    changes on a day an addition counts. Rows with a null are ignored. Changes are first reduced to one a day, so an
    entry's history is no longer than the calendar.
    """
    daily = log.where("entry is not null and listed_on is not null and added is not null")
    daily = daily.groupBy("entry", "listed_on").agg(F.max("added").alias("added"))
    history = Window.partitionBy("entry").orderBy("listed_on")
    turns = daily.withColumn("before", F.lag("added").over(history))
    turns = turns.where(F.col("before").isNull() & F.col("added") | (F.col("before") != F.col("added")))
    ends = turns.withColumn("valid_to", F.lead("listed_on").over(history))
    return ends.where("added").select("entry", F.col("listed_on").alias("valid_from"), "valid_to")


def judge_captures(
    captures: DataFrame, log: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_on"
) -> DataFrame:
    """One row per capture: id, url, date, n_entries (valid entries that cover it), entry (the longest), blocked.

    A null or odd URL and a null date meet no entry. Repeated rows give repeated results; an empty list blocks
    nothing. An entry's intervals are kept as one array, so the captures of a hot host are joined to one row, which
    is broadcast if small and else copied to salted keys.
    """
    rows = clean_columns(captures, id=id_col, url=url_col, at=time_col)
    rows = rows.withColumn("key", F.xxhash64("id", "url", "at"))
    spans = list_intervals(log).groupBy("entry").agg(
        F.array_sort(F.collect_list(F.struct("valid_from", "valid_to"))).alias("spans")
    )
    covered = rows.select("key", "at", F.explode(url_keys(F.col("url"))).alias("entry")).distinct()
    met = attach(covered, stored(spans, "list-spans"), ["entry"], ["key"], "inner")
    at = F.col("at")
    valid = F.exists("spans", lambda s: (s["valid_from"] <= at) & (s["valid_to"].isNull() | (at < s["valid_to"])))
    met = met.where(valid)
    verdict = met.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_entries"), F.max_by("entry", F.struct(F.length("entry"), "entry")).alias("entry")
    )
    return rows.join(verdict, "key", "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(time_col),
        F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), "entry",
        F.col("n_entries").isNotNull().alias("blocked"),
    )
