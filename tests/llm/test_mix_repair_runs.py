"""Repair of conversations, mixing of sources and periodic runs, each against a plain version."""

import hashlib
import random
import re
import zlib
from fractions import Fraction
from functools import lru_cache

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagfield.llm import mixing, periodic, repair
from lagfield.llm.queries import QUERIES, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- repair of conversations -------------------------------------------------

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
LEGAL = {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}


def cheapest(rows):
    """Cost and letters of the cheapest edits of (initial, fault), by trying all."""

    @lru_cache(None)
    def best(i, state, put):
        ways = [(0, "")] if i == len(rows) and state in ("", "a") else []

        def then(cost, letter, rest):
            ways.append((cost + rest[0], letter + rest[1]))

        if put < 3:
            then(5, "I", best(i, NEXT[state], put + 1))
        if i < len(rows):
            initial, fault = rows[i]
            stay = 5 if fault == 3 else 0
            then(2, "D", best(i + 1, state, 0))
            if fault not in (1, 2):
                then(1 + stay, "R", best(i + 1, NEXT[state], 0))
                if (state, initial) in LEGAL:
                    then(stay, "K", best(i + 1, initial, 0))
        return min(ways) if ways else (10**9, "")

    return best(0, "", 0)


def kinds_of(rows):
    return [8 if f in (1, 2) else 2 * "suax".index(r) + (f == 3) for r, f in rows]


def test_cheapest_edits():
    rng = random.Random(11)
    for _ in range(3000):
        rows = tuple((rng.choice("suuaax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(0, 12)))
        assert "".join(repair.row_edits(kinds_of(rows))[0]) == cheapest(rows)[1]


def test_blocks_give_the_same_edits():
    rng = random.Random(12)
    for _ in range(1500):
        rows = [(rng.choice("suuaax"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randrange(2, 40))]
        kinds = kinds_of(rows)
        edges = [0, *sorted(rng.sample(range(1, len(rows)), rng.randrange(0, min(len(rows), 5)))), len(rows)]
        parts = [kinds[a:b] for a, b in zip(edges, edges[1:])]
        states = repair._states([repair._block_step(p) for p in parts], repair._START, repair._END)
        ends = zip(parts, [repair._START, *states[:-1]], [*states[:-1], -1])
        assert "".join("".join(repair.row_edits(*e)[0]) for e in ends) == "".join(repair.row_edits(kinds)[0])


def plain_repair(rows):
    talks = {}
    for conv, turn, role, text in rows:
        found = talks.setdefault(conv, [])
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            found += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    out = {}
    for conv, found in talks.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in found:
            full = "".join(WORD.findall(text))
            faults.append(1 if not full else 2 if (role, text) in seen else 3 if full[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = [t for t, _, _ in found if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(tuple((i if i in ("s", "u", "a") else "x", f) for i, f in zip(initials, faults)))
        state, lines, left = "", [], iter(found)
        for letter in audit:
            _, role, text = ("", "", "") if letter == "I" else next(left)
            if letter == "D":
                continue
            if letter == "K":
                state = role[:1]
            else:
                state = NEXT[state]
                role = {"u": "user", "a": "assistant"}[state]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, digest)
    return out


REPAIR = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TALK = "conv_id long, turn long, role string, text string, key string, pos int, block string"


def reported(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r[c] for c in REPAIR) for r in rows}
    assert len(found) == len(rows)
    return found


def test_op11_against_plain(spark, sf):
    talks = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    assert reported(QUERIES["op11_repair"](spark, sf)) == plain_repair([tuple(r) for r in talks.collect()])


@pytest.mark.parametrize("bits", [repair.BLOCK_BITS, 3])
def test_repair_of_odd_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "BLOCK_BITS", bits)
    rng = random.Random(5)
    texts = ["Hi there.", "No", "", "  \n", None, "ok?", "été 😀.", "long text here. " * 5000]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool"]
    rows = [
        (conv, rng.choice([t, t, t, t // 2, None]), rng.choice(roles), rng.choice([*texts, f"text {t}", f"turn {t}!"]))
        for conv in (1, 2, None, *range(10, 40))
        for t in range(rng.choice([1, 3, 50]))
    ]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TALK).repartition(5)
    want = plain_repair(rows)
    assert reported(repair.repair_report(repair.damaged(df), ids=df)) == want
    lines = {}
    for r in repair.repaired(repair.damaged(df)).orderBy("pos", "step").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], TALK)
    assert repair.repair_report(repair.damaged(none), ids=none).count() == 0
    assert repair.repaired(none).count() == 0
    # a conversation without rows after damage
    ids = spark.createDataFrame([(7,), (None,)], "conv_id long")
    empty = hashlib.sha256(b"").hexdigest()
    assert reported(repair.repair_report(none, ids=ids)) == {i: (0,) * 6 + ("", empty) for i in (7, None)}


# --- mixing of sources --------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing again and again, in fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(names)}
    full = set()
    while True:
        rest = [s for s in names if s not in full]
        left = Fraction(sum(sizes.values())) - sum(most * sizes[s] for s in full)
        target = {s: Fraction(most * sizes[s]) for s in full}
        target |= {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def mixed(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "doc_id long, source string, text string, size long, part string, u double")
    labels = spark.createDataFrame([(1, 1, 3), (2, 0, 3), (2, 1, 3), (3, None, 3), (None, 1, 3)], "doc_id long, quality int, source int")
    return mixing.mix(mixing.graded(mixing.measured(docs), labels)).toPandas()


def test_mix_meets_targets(spark):
    rng = random.Random(8)
    rows = []
    for source, count in (("a", 900), ("b", 30), ("", 4), (None, 60), ("é", 200), ("z", 1)):
        for i in range(count):
            rows.append((len(rows), source, " ".join("w" for _ in range(rng.randrange(0, 30)))))
    rows += [(5, "a", rows[5][2])] * 40 + [(None, "b", None), (None, "b", ""), (None, "b", " \x0b\t")]
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    target = plain_targets(sizes)
    got["source"] = [None if pd.isna(s) else s for s in got["source"]]
    for source, group in got.groupby(got["source"].map(lambda s: ("n",) if s is None else ("v", s))):
        name = source[1] if len(source) > 1 else None
        assert set(group["source_size"]) == {sizes[name]}
        assert set(group["target"].round(6)) == {round(float(target[name]), 6)}
        assert abs(group["taken"].sum() - float(target[name])) <= group["size"].max() / 2 + 1e-6
        assert (group["taken"] <= 3 * group["size"]).all()
        # whole epochs come first: every document gets them, and at most one pass more
        epochs = int(target[name] // sizes[name]) if sizes[name] else 0
        assert set(group["epochs"]) == {epochs}
        assert (group["taken"] == group["size"] * (epochs + group["picked"])).all()


def test_mix_agrees_with_itself(spark):
    rows = [(i, f"s{i % 3}", "a b c " * (i % 7)) for i in range(300)]
    cols = ["doc_id", "taken"]
    first = mixed(spark, rows)[cols].sort_values(cols).reset_index(drop=True)
    again = mixed(spark, rows[::-1])[cols].sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(first, again)


def test_better_documents_come_more_often(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("string").alias("source"), F.lit(1).alias("size"),
        F.when(F.col("id") % 4 < 2, 4.0).otherwise(1.0).alias("quality"), F.lit("").alias("digest"),
    )
    got = mixing.mix(rows, weights=(1, 1.5)).where("source = '0'").join(rows.select("doc_id", "quality"), "doc_id")
    picked = {r.quality: r.n for r in got.where("picked").groupBy("quality").agg(F.count("*").alias("n")).collect()}
    # 2,400 of 3,000 are taken; with weights 4 and 1 nearly all of the better ones
    assert sum(picked.values()) == 2400 and picked[4.0] > 1.35 * picked[1.0]


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert mixing.mix(mixing.graded(mixing.measured(docs), labels)).count() == 0
    blank = mixed(spark, [(1, "a", None), (2, None, "")])
    assert set(blank["target"]) == {0.0} and set(blank["taken"]) == {0}


# --- periodic runs ------------------------------------------------------------


def plain_runs(w, min_length=6, times=4):
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            part = w[i : j + q]
            primitive = all(any(a != b for a, b in zip(part, part[d:])) for d in range(1, q))
            if len(part) >= max(min_length, times * q) and primitive:
                out.append((i, len(part), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def tail_repeated(doc_id, text):
    w = WORD.findall(text or "")
    h, n = 0 if doc_id is None else zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_of_words():
    rng = random.Random(2)
    for _ in range(2500):
        n, letters = rng.randrange(0, 60), rng.choice([1, 2, 2, 3, 5])
        w = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // (3 + rng.randrange(8))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        for least, times in ((6, 4), (2, 2), (3, 3)):
            assert periodic.word_runs(w, least, times) == plain_runs(w, least, times)


def test_runs_of_a_long_text():
    block = [f"w{i}" for i in range(500)]
    words = ["a"] * 3000 + block * 20 + ["b", "c"] * 2000
    want = [(0, 3000, 1), (3000, 10_000, 500), (13_000, 4000, 2)]
    assert periodic.word_runs(words) == want


def test_op13_against_plain(spark, sf):
    rows = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    texts = table(spark, sf, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        w = tail_repeated(doc_id, text)
        runs, r = plain_runs(w), rows[doc_id]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        most = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == most
        assert r.exponent_milli == (1000 * most[1] // most[2] if runs else None)


def test_runs_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\x0b"), (4, "a a a a a a b"), (4, "a a a a a a b"), (None, "x y " * 8), (5, "é 😀\t" * 2000)]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, words string, runs int")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs).collect()), key=str)
    assert sorted((i, len(WORD.findall(t or ""))) for i, t in rows if i) == sorted(g[:2] for g in got if g[0])
    assert [g[2] for g in got if g[0] == 4] == [[(0, 6, 1)]] * 2 and {g[3] for g in got if g[0] == 4} == {"a b"}
    assert [g[2:] for g in got if g[0] is None] == [([(0, 8, 1)], "x y")]
    assert [g[2:] for g in got if g[0] == 5] == [([(0, 4000, 2)], "é 😀")]
    assert all(g[2:] == ([], "") for g in got if g[0] in (1, 2, 3))
    tails = {r.doc_id: r.text for r in periodic.with_tail_repeats(docs).collect() if r.doc_id != 4}
    assert tails[None] == rows[5][1] and tails[1] is None and WORD.findall(tails[5]) == tail_repeated(5, rows[6][1])
    assert periodic.periodic_runs(docs.where("false")).count() == 0
