"""Secret scans over a trigram index, with DataFrame functions only.

Each rule is a regular expression. From it a Boolean query over trigrams is derived: any match must hold all trigrams
of at least one of its alternatives. The index holds, for each trigram of any query, the texts that have it; the
postings of an alternative are intersected, and only texts that are left are scanned by the rule. A rule without a
mandatory trigram scans all texts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from re import _constants as sre
from re import _parser as sre_parse

from lagfield.llm.common import clean_columns, let
from lagfield.session import stored

# Alternatives followed in a rule; beyond this a part of it counts as unknown, which only widens the query.
ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the base rules, then public formats of common tokens
BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)
RULES = (
    *BASE,
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("login", r"[a-z]{2,12}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@"),
)

# A run of known characters, or None for unknown ones between runs.
Parts = tuple[str | None, ...]


def _joined(left: Parts, right: Parts) -> Parts:
    if left and right and left[-1] is not None and right[0] is not None:
        return (*left[:-1], left[-1] + right[0], *right[1:])
    return (*left, *right)


def _alternatives(tree) -> list[Parts]:
    """What a parsed expression can look like, as runs of known characters with gaps."""
    found: list[Parts] = [()]
    for op, arg in tree:
        options: list[Parts] = [(None,)]
        if op is sre.LITERAL:
            options = [(chr(arg).lower(),)]
        elif op is sre.IN and len(arg) <= 6 and all(o is sre.LITERAL for o, _ in arg):
            options = [(chr(a).lower(),) for _, a in arg]
        elif op is sre.SUBPATTERN:
            options = _alternatives(arg[-1])
        elif op is sre.BRANCH:
            options = [a for branch in arg[1] for a in _alternatives(branch)]
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            inner = _alternatives(body)
            known = all(None not in a for a in inner)
            if known and high == 1:
                options = [(), *inner]
            elif known and len(inner) ** min(low, 8) <= ALTERNATIVES:
                options = [()]
                for _ in range(min(low, 8)):
                    options = [_joined(a, b) for a, b in product(options, inner)]
                if high > min(low, 8):
                    options = [_joined(a, (None,)) for a in options]
        elif op is sre.AT:
            options = [()]
        if len(found) * len(options) > ALTERNATIVES:
            options = [(None,)]
        found = [_joined(a, b) for a, b in product(found, options)]
    return list(dict.fromkeys(found))


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of a rule, each a set of mandatory trigrams in lower case; none if the rule has to scan fully."""
    sets = []
    for parts in _alternatives(sre_parse.parse(pattern)):
        runs = [p for p in parts if p is not None]
        sets.append(frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2)))
    if not all(sets):
        return []
    # an alternative that asks for more than another adds nothing
    return [s for s in dict.fromkeys(sets) if not any(o < s for o in sets)]


def trigram_index(texts: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Postings ``(trigram, key)`` of ``texts(key, text)`` for the given trigrams."""
    low = F.lower("text")
    held = let(low, lambda t: F.array(*[F.when(F.contains(t, F.lit(g)), F.lit(g)) for g in trigrams]))
    postings = texts.select("key", F.explode(held).alias("trigram"))
    return postings.where(F.col("trigram").isNotNull()).select("trigram", "key").distinct()


def candidates(texts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(key, kinds)``: the rules that a text may match, from the intersected postings."""
    spark = texts.sparkSession
    asked = [
        (rule.kind, i, gram, len(grams))
        for rule in rules for i, grams in enumerate(trigram_query(rule.pattern)) for gram in sorted(grams)
    ]
    schema = "kind string, alternative int, trigram string, needed int"
    # as many rows as the rules have trigrams
    queries = F.broadcast(spark.createDataFrame(asked, schema))
    index = stored(trigram_index(texts, sorted({a[2] for a in asked})), "trigrams")
    met = index.join(queries, "trigram").groupBy("key", "kind", "alternative", "needed").agg(F.count(F.lit(1)).alias("n"))
    return met.where(F.col("n") == F.col("needed")).groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of a rule in a text as (start, order, end), in code points.

    Matches and the pieces between them alternate, so their lengths add up to the places.
    """
    found = F.struct(
        F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p)).alias("between"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda m: F.length(m)).alias("size"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda m: F.length(m)).alias("own"),
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def placed(x: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.get(x["between"], i)
            end = start + F.get(x["size"], i)
            span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
            spans = F.when(
                F.get(x["own"], i) >= rule.least, F.concat(state["spans"], F.array(span))
            ).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        places = F.sequence(F.lit(0), F.size(x["size"]) - 1)
        return F.when(F.size(x["size"]) == 0, none).otherwise(F.aggregate(places, begin, step, lambda s: s["spans"]))

    return let(found, placed)


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per input row: the id and ``spans``, an array of (start, kind, end) by start, then order of the rules.

    ``kind`` is the rule's number. Null and empty texts have no spans; repeated rows and null ids give a row each.
    """
    docs = clean_columns(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("key", F.xxhash64("id", "text"))
    indexed = [r for r in rules if trigram_query(r.pattern)]
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if indexed:
        chosen = candidates(docs.select("key", "text"), indexed)
        # The few candidates are the hashed side; the texts are not sorted.
        docs = docs.join(chosen.hint("shuffle_hash"), "key", "left")
    else:
        docs = docs.withColumn("kinds", F.lit(None).cast("array<string>"))
    text = F.col("text")
    found = []
    for i, rule in enumerate(rules):
        asked = F.array_contains("kinds", rule.kind) if rule in indexed else text.rlike(rule.pattern)
        found.append(F.when(asked, rule_spans(text, rule, i)).otherwise(none))
    return docs.select(F.col("id").alias(id_col), F.array_sort(F.concat(*found)).alias("spans"))


def secret_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as text ``kind:start:end``."""
    names = F.array(*[F.lit(r.kind) for r in rules])
    base = {r.kind: i for i, r in enumerate(rules) if r in BASE}

    def written(spans: Column) -> Column:
        part = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, part), ",")

    spans = secret_spans(docs, id_col, text_col, rules)
    of_base = F.filter("spans", lambda s: s["kind"].isin(*base.values()))

    def count(i: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == i)).cast("long")

    return spans.select(
        id_col,
        *[count(i).alias(f"n_{kind}") for kind, i in base.items()],
        F.sha2(written(of_base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
