"""Repair of damaged conversations by the cheapest edits, found by divide and conquer (Hirschberg).

The roles of a sound conversation read ``(s?(ua)+)?`` by their initials, so four states follow it: nothing yet, after
system, after user, after assistant. Each row is kept (0), given the next role (1) or deleted (2, which blank and
repeated rows must be); a missing row may be put in anywhere (5); a truncated row that stays adds 5. Of the cheapest
edits the one whose letters sort first counts: D(elete), I(nsert), K(eep), R(erole).

A vector holds the cost of each state. Forward from the start and backward from the end, two vectors meet in the
middle; the state where their sum is least is where the best edits cross, and both halves are solved in the same way.
Nothing but two vectors is held for a level, so space is linear. Ties: beside the costs the forward vector ranks the
states by the least letters that reach them. Letters that end with a row's own edit, for the same rows, are never the
beginning of each other, so their ranks decide between whole edits too.

Rows are dealt to tasks in blocks of bounded size, in the order of conversations. A conversation inside a block is
solved there. One that crosses a block's edge gives one 4 x 4 matrix per block, its costs and ranks from each state to
each; the same meeting of vectors over these matrices fixes the states at the edges, and then its blocks are solved
apart. So a conversation that holds a third of all rows is shared by many tasks. Only its letters and the hash of its
repaired text, which are values of one result row, are put together in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.llm.common import clean_columns
from lagfield.session import stored

# fixed values: costs of the edits, the roles put in, white space at the end of a text
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
BLANKS = " \t\n\x0b\x0c\r"
# rows of a block, as a power of two
BLOCK_BITS = 12

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
# rows that fit as they are: state before and initial (s, u, a) -> state behind
_FITS = {(_START, 0): _SYSTEM, (_START, 1): _USER, (_SYSTEM, 1): _USER, (_ASSISTANT, 1): _USER, (_USER, 2): _ASSISTANT}
_FAR = 1 << 60
# kinds of rows: initial (s, u, a, other) and truncated or not; the last one must go
_MUST_GO = 8
_FINE, _BLANK, _REPEATED, _CUT = range(4)

Step = tuple  # costs and ranks, each from each state to each
Vector = tuple  # costs and ranks of the states


def _row_steps() -> tuple[list[Step], list[list[list[str]]]]:
    """For each kind of row the step over it and the letters from each state to each."""
    steps, letters = [], []
    for kind in range(_MUST_GO + 1):
        initial, cut = divmod(kind, 2)
        best: list[list[tuple[int, str]]] = [[(_FAR, "")] * 4 for _ in range(4)]
        for p in range(4):
            state, spent, put = p, 0, ""
            for _ in range(3):  # two rows put in lead back to the same state, so more are never needed
                ways = [(state, DELETE, "D")]
                if kind != _MUST_GO:
                    stay = TRUNCATED if cut else 0
                    ways.append((_NEXT[state], RETYPE + stay, "R"))
                    if (state, initial) in _FITS:
                        ways.append((_FITS[state, initial], stay, "K"))
                for q, cost, letter in ways:
                    best[p][q] = min(best[p][q], (spent + cost, put + letter))
                state, spent, put = _NEXT[state], spent + INSERT, put + "I"
        costs = tuple(tuple(c for c, _ in row) for row in best)
        ranks = tuple(tuple(sorted(row, key=lambda x: x[1]).index(x) for x in row) for row in best)
        steps.append((costs, ranks))
        letters.append([[text for _, text in row] for row in best])
    return steps, letters


_STEPS, _LETTERS = _row_steps()
# what the end asks of each state: the cost and the letters of the rows still to be put in
_END, _END_LETTERS = (0, 2 * INSERT, INSERT, 0), ("", "II", "I", "")


def _at(state: int) -> Vector:
    return tuple(0 if q == state else _FAR for q in range(4)), (0, 0, 0, 0)


@lru_cache(maxsize=65_536)
def _forward(vector: Vector, step: int | Step) -> tuple[Vector, int]:
    """The vector after a row (by its kind) or a block (by its step), less its smallest cost, and that cost."""
    costs, ranks = vector
    step_costs, step_ranks = _STEPS[step] if isinstance(step, int) else step
    best = [
        min(
            (costs[p] + step_costs[p][q], ranks[p], step_ranks[p][q]) if costs[p] + step_costs[p][q] < _FAR else (_FAR, 0, 0)
            for p in range(4)
        )
        for q in range(4)
    ]
    least = min(best)[0]
    order = sorted({b[1:] for b in best if b[0] < _FAR})
    after = tuple(b[0] - least if b[0] < _FAR else _FAR for b in best)
    return (after, tuple(order.index(b[1:]) if b[0] < _FAR else 0 for b in best)), least


@lru_cache(maxsize=65_536)
def _backward(costs: tuple, step: int | Step) -> tuple:
    """Costs from each state over the step to the end, less the smallest."""
    step_costs = (_STEPS[step] if isinstance(step, int) else step)[0]
    best = [min(step_costs[p][q] + costs[q] for q in range(4)) for p in range(4)]
    least = min(best)
    return tuple(b - least if b < _FAR else _FAR for b in best)


def _states(steps, start: int, end: tuple) -> list[int]:
    """The state behind each step on the best way from ``start`` to an end with these costs."""
    found = [0] * len(steps)
    # open parts: first and last step, the state before, the costs of the states behind
    parts = [(0, len(steps), start, end)] if len(steps) else []
    while parts:
        low, high, before, behind = parts.pop()
        middle = (low + high + 1) // 2
        vector = _at(before)
        for i in range(low, middle):
            vector = _forward(vector, steps[i])[0]
        back = behind
        for i in range(high - 1, middle - 1, -1):
            back = _backward(back, steps[i])
        crossing = min(range(4), key=lambda q: (vector[0][q] + back[q], vector[1][q]))
        found[middle - 1] = crossing
        if middle - low > 1:
            parts.append((low, middle, before, _at(crossing)[0]))
        if high > middle:
            parts.append((middle, high, crossing, behind))
    return found


def row_edits(kinds: list[int], start: int = _START, end: int = -1) -> tuple[list[str], list[str]]:
    """The letters of each row, and what they make: k its own role, U or A its text in that role, u or a a row put in.

    Rows put in stand before the next row's letters, at the end behind the last one's. ``start`` and ``end`` are the
    states before and behind; -1 is the end of the conversation.
    """
    states = _states(kinds, start, _END if end < 0 else _at(end)[0])
    letters = [_LETTERS[k][p][q] for k, p, q in zip(kinds, [start, *states], states)]
    if end < 0 and letters:
        letters[-1] += _END_LETTERS[states[-1]]
    made = []
    for text, state, behind in zip(letters, [start, *states], states):
        roles = ""
        for letter in text:
            if letter == "K":
                state = behind
                roles += "k"
            elif letter != "D":
                state = _NEXT[state]
                role = "u" if state == _USER else "a"
                roles += role if letter == "I" else role.upper()
        made.append(roles)
    return letters, made


def _block_step(kinds: list[int]) -> Step:
    """Costs and ranks of a whole block, from each state to each."""
    costs, ranks = [], []
    for p in range(4):
        vector, total = _at(p), 0
        for k in kinds:
            vector, added = _forward(vector, k)
            total += added
        costs.append(tuple(c + total if c < _FAR else _FAR for c in vector[0]))
        ranks.append(vector[1])
    return tuple(costs), tuple(ranks)


def _parts(frame: pd.DataFrame) -> Iterator[tuple[str, int, int]]:
    """Key, first and last row of each conversation of a sorted block."""
    keys = frame["key"].tolist()
    first = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[first]:
            yield keys[first], first, i
            first = i


def _edge_steps(frame: pd.DataFrame) -> pd.DataFrame:
    """The steps of a block's first and last conversation, which may go on in other blocks."""
    frame = frame.sort_values("pos")
    kinds, block, parts = frame["kind"].tolist(), int(frame["block"].iloc[0]), list(_parts(frame))
    rows = []
    for key, a, b in parts[:1] + parts[1:][-1:]:
        costs, ranks = _block_step(kinds[a:b])
        rows.append((key, block, [c for row in costs for c in row], [r for row in ranks for r in row]))
    return pd.DataFrame(rows, columns=["key", "block", "costs", "ranks"])


def _edge_states(frame: pd.DataFrame) -> pd.DataFrame:
    """The states before and behind each block of a conversation."""
    frame = frame.sort_values("block")
    square = lambda flat: tuple(tuple(int(x) for x in flat[i : i + 4]) for i in range(0, 16, 4))
    steps = [(square(c), square(r)) for c, r in zip(frame["costs"], frame["ranks"])]
    states = _states(steps, _START, _END)
    ends = [*states[:-1], -1]
    return pd.DataFrame({"key": frame["key"], "block": frame["block"], "start": [_START, *states[:-1]], "end": ends})


def _block_edits(frame: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("pos")
    kinds, letters, made = frame["kind"].tolist(), [], []
    known = {k: (s, e) for k, s, e in zip(edges["key"], edges["start"], edges["end"])}
    for key, a, b in _parts(frame):
        for own, all_rows in zip(row_edits(kinds[a:b], *known.get(key, (_START, -1))), (letters, made)):
            all_rows += own
    return pd.DataFrame({"key": frame["key"], "pos": frame["pos"], "fault": frame["fault"], "edit": letters, "made": made})


def _key(column: Column) -> Column:
    """A text for each id, a null one included."""
    return F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))


def damaged(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rows of conversations (conv_id, turn, role, text) with faults that the checksum of ``conv_id:turn`` gives.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its
    role user. A null stands as one space, in the checksum, the role and the text.
    """
    space = F.lit(" ")
    rows = clean_columns(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("draw", F.crc32(name.cast("binary")) % 20).where("draw <> 0")
    role, text = F.coalesce(F.col("role").cast("string"), space), F.coalesce(F.col("text").cast("string"), space)
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = rows.select("conv_id", "turn", F.when(F.col("draw") == 4, USER).otherwise(role).alias("role"), text.alias("text"), "draw")
    times = F.when(F.col("draw") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), times)).alias("copy")).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """Stored rows of conversations with ``pos``, their place among all rows: by conversation, then by turn.

    Nulls come first; rows of one turn follow their role, then the digest of their text. Rows that tie are equal in
    all of these. A range shuffle on these short keys deals the rows out, whatever conversation they belong to.
    """
    order = ["key", "turn", "role", "digest", "row"]
    rows = rows.select(
        _key(F.col("conv_id")).alias("key"), F.col("turn").cast("long").alias("turn"), "role", "text",
        F.sha2("text", 256).alias("digest"), F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(rows.drop("row").withColumn("pos", F.monotonically_increasing_id()), "turns")


def edits(turns: DataFrame) -> DataFrame:
    """``key, pos, fault, edit, made`` for rows ``in_order``: the fault counted first, and ``row_edits``.

    fault: 0 none, 1 blank, 2 role and text seen earlier in the conversation, 3 truncated (ends without ``.!?``).
    """
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    cut = ~F.right(end, F.lit(1)).isin(".", "!", "?")
    rows = turns.select("key", "pos", code.alias("code"), (end == "").alias("blank"), cut.alias("cut"))
    first = turns.groupBy("key", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    rows = rows.join(first, "pos", "left")
    fault = F.when(F.col("blank"), _BLANK).when(F.col("first").isNull(), _REPEATED).when(F.col("cut"), _CUT).otherwise(_FINE)
    rows = rows.select("key", "pos", "code", fault.alias("fault"))
    kind = F.when(F.col("fault").isin(_BLANK, _REPEATED), _MUST_GO).otherwise(2 * F.col("code") + (F.col("fault") == _CUT).cast("int"))
    block = F.shiftright(F.col("pos"), BLOCK_BITS)
    rows = stored(rows.select("key", "pos", "fault", kind.alias("kind"), block.alias("block")), "turn-kinds")
    steps = rows.groupBy("block").applyInPandas(_edge_steps, "key string, block long, costs array<long>, ranks array<int>")
    # a conversation has one step per block; its letters, a value of one result row, bound how many there can be
    states = steps.groupBy("key").applyInPandas(_edge_states, "key string, block long, start int, end int")
    both = rows.groupBy("block").cogroup(states.groupBy("block"))
    return both.applyInPandas(_block_edits, "key string, pos long, fault int, edit string, made string")


# letters of ``made``: role (None for the row's own) and whether the row's text stays
_MADE = {"k": (None, True), "U": (USER, True), "A": (ASSISTANT, True), "u": (USER, False), "a": (ASSISTANT, False)}


class _Report:
    """What one conversation adds up to, row by row."""

    def __init__(self, key: str) -> None:
        self.key, self.last, self.letters = key, None, []
        self.faults, self.illegal, self.cost = [0] * 4, 0, 0
        self.low = self.high = None
        self.turns = 0
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, turn: int | None, role: str, text: str, fault: int, edit: str, made: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        self.faults[fault] += 1
        if self.last is not None:
            self.illegal += self.last + role[:1] not in ("su", "ua", "au")
        self.last = role[:1]
        self.letters.append(edit)
        stays = "D" not in edit
        self.cost += INSERT * edit.count("I") + RETYPE * edit.count("R") + (TRUNCATED * (fault == _CUT) if stays else DELETE)
        for letter in made:
            other, whole = _MADE[letter]
            line = f"{role if other is None else other}:{text if whole else ''}"
            self.hash.update((("\n" if self.begun else "") + line).encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        _, blank, repeated, cut = self.faults
        return self.key, gaps, blank, repeated, cut, self.illegal, self.cost, "".join(self.letters), self.hash.hexdigest()


_REPORT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _REPORT.split(", ")]
    kinds = [pa.string() if f.endswith("string") else pa.int64() for f in _REPORT.split(", ")]
    done: list[tuple] = []
    open_one: _Report | None = None
    plan = (0, "", "")

    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        for key, turn, role, text, fault, edit, made in zip(*[batch.column(i) for i in range(7)]):
            if edit.is_valid:  # the edit of a row comes right before the row
                plan = fault.as_py(), edit.as_py(), made.as_py()
                continue
            name = key.as_py()
            if open_one is None or open_one.key != name:
                if open_one:
                    done.append(open_one.row())
                open_one = _Report(name)
            open_one.add(turn.as_py(), role.as_py(), text.as_py(), *plan)
        if done:
            yield flush()
    if open_one:
        done.append(open_one.row())
        yield flush()


def _texts(rows: DataFrame) -> DataFrame:
    rows = clean_columns(rows, conv_id="conv_id", turn="turn", role="role", text="text")
    return rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")})


def repair_report(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text), and for those of ``ids`` that have no rows.

    gaps (turns missing between the first and the last; null turns do not count), blank, duplicate and truncated (rows
    by their first fault), illegal (neighbours whose role initials are not su, ua or au), cost and audit (letters of
    the cheapest edits) and repaired_sha256 (hash of the repaired ``role:text``, joined by newlines).

    A null conv_id is a conversation of its own. Null turns come first, null roles and texts count as empty; a role
    that does not begin with s, u or a cannot be kept. Rows of one turn follow role and text digest, and repeated rows
    count as often as they stand. No rows: zeros, an empty audit and the hash of an empty text. Long texts are hashed
    as they stream by. An empty table gives none. Other columns are ignored.
    """
    rows = _texts(rows)
    ids = rows if ids is None else ids
    names = ids.select(F.col("conv_id")).distinct().select("conv_id", _key(F.col("conv_id")).alias("key"))
    turns = in_order(rows)
    none = lambda kind: F.lit(None).cast(kind)
    planned = edits(turns).select(
        "key", "pos", F.lit(0).alias("second"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), "fault", "edit", "made"
    )
    own = turns.select("key", "pos", F.lit(1).alias("second"), "turn", "role", "text", none("int").alias("fault"), none("string").alias("edit"), none("string").alias("made"))
    # an edit meets its row by lying next to it, so the texts are shuffled once
    lined = planned.unionByName(own).repartition("key").sortWithinPartitions("key", "pos", "second")
    reports = lined.select("key", "turn", "role", "text", "fault", "edit", "made").mapInArrow(_reports, _REPORT)
    joined = names.join(reports, "key", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, pos, step, role, text, where pos and then step give the order.

    ``step`` numbers the rows that come from one place: rows put in, the row itself, rows put in at the end. Nulls,
    ties, repeats and empty tables are as in ``repair_report``; a conversation whose rows all go has none.
    """
    rows = _texts(rows)
    names = rows.select("conv_id").distinct().select("conv_id", _key(F.col("conv_id")).alias("key"))
    turns = in_order(rows)
    made = edits(turns).where("made <> ''").select("pos", F.posexplode(F.split("made", "")).alias("step", "made"))
    placed = made.join(turns.select("key", "pos", "role", "text"), "pos")
    role = F.when(F.lower("made") == "u", USER).when(F.lower("made") == "a", ASSISTANT).otherwise(F.col("role"))
    text = F.when(F.col("made").isin("u", "a"), "").otherwise(F.col("text"))
    placed = placed.select("key", "pos", "step", role.alias("role"), text.alias("text"))
    # ids are one row each; a hot one is split by the skew handling of the join
    return placed.join(names, "key").select("conv_id", "pos", "step", "role", "text")
