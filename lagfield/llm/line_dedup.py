"""Near-duplicate lines by a segment-partition edit join, with DataFrame functions only.

Two lines are linked if at most ``threshold`` edits turn one into the other. A line is cut into threshold + 1 even
segments; by the pigeonhole principle one of them is left whole by the edits, so it occurs in the other line, at a
place and for a line length that the edits allow. Segments are the index, the allowed substrings the probes, and a
banded bit-parallel edit distance confirms each meeting.

Lines that meet in a hot segment (a common opening, say) are cut finer: of ``FINE`` segments the edits spoil at most
``threshold``, so close lines agree in all the others, and what two lines must share to meet is most of their text.
Where many meet even so, they are copies of one another: each is compared with one representative of the meeting, and
then only lines of different classes are. So a group of near copies costs its size, not the square of it, and no two
lines that are close end up in different classes.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.llm.common import clean_columns, components, let, stored_by
from lagfield.session import stored


@dataclass(frozen=True)
class LineConfig:
    """``threshold`` edits link two lines of ``min_chars`` characters or more; shorter ones only match exactly.

    A segment with over ``hot`` index lines is hot.
    """

    threshold: int = 2
    min_chars: int = 9
    hot: int = 16


# Segments of lines that meet in a hot one; segments and piece size of the cheap conditions before the edit distance.
FINE, PARTS, PIECE = 5, 9, 6


def _segment(length: Column, parts: int, i: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of a line; later segments take the odd characters."""
    base, odd = F.floor(length / parts).cast("int"), length % parts
    longer = F.greatest(odd - (parts - i), F.lit(0))
    size = base + F.when(odd > parts - 1 - i, 1).otherwise(0)
    return (base * i + longer).cast("int"), size.cast("int")


def _key(length: Column, i: int, line: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substring(line, start + 1, size))


def _index(line: Column, length: Column, parts: int) -> list[Column]:
    return [_key(length, i, line, *_segment(length, parts, i)) for i in range(parts)]


def _probes(line: Column, length: Column, threshold: int, gap: int) -> list[Column]:
    """Keys of the substrings that may be a whole segment of a line ``gap`` characters shorter.

    The shifts are those that bounded edits before the segment and behind it allow. A line's own segments are left out:
    the lines that these meet are the ones that hold the same key.
    """
    found, parts, shorter = [], threshold + 1, length - gap
    for i in range(parts):
        start, size = _segment(shorter, parts, i)
        for shift in range(max(-i, gap - (threshold - i)), min(i, gap + (threshold - i)) + 1):
            if gap == shift == 0:
                continue
            fits = (start + shift >= 0) & (start + shift + size <= length) & (shorter >= parts)
            found.append(F.when(fits, _key(shorter, i, line, start + shift, size)))
    return found


def edit_distance_within(a: Column, b: Column, threshold: int) -> Column:
    """Edits between ``a`` and ``b``, if at most ``threshold``; a larger number otherwise.

    One column of the matrix is a band of 2 * threshold + 1 rows along the diagonal, kept as the bits of two
    numbers: rows where the value rises by one and rows where it falls. ``a`` is the shorter one.
    """
    width = 2 * threshold + 1
    mask = F.lit((1 << width) - 1).cast("long")
    one = F.lit(1).cast("long")
    flip = lambda x: x.bitwiseXOR(mask)

    def distance(pair: Column) -> Column:
        pattern, text = pair["a"], pair["b"]
        gap = F.size(text) - F.size(pattern)
        # the bit of the row that ends at the pattern's last character
        diagonal = F.get(F.array(*[F.lit(1 << d).cast("long") for d in range(width)]), threshold - gap)

        def step(state: Column, j: Column) -> Column:
            here = F.get(text, j - 1)
            match = F.lit(0).cast("long")
            for d in range(width):
                row = j - threshold + d
                hit = (row >= 1) & (row <= F.size(pattern)) & (F.get(pattern, row - 1) == here)
                match = match + F.when(hit, F.lit(1 << d).cast("long")).otherwise(F.lit(0).cast("long"))

            def moved(x: Column) -> Column:
                rise, fall, m = x["rise"], x["fall"], x["m"]
                carried = ((m.bitwiseAND(rise) + rise).bitwiseXOR(rise)).bitwiseOR(m).bitwiseOR(fall).bitwiseAND(mask)

                def turned(same: Column) -> Column:
                    up = fall.bitwiseOR(flip(same.bitwiseOR(rise).bitwiseAND(mask)))
                    down = same.bitwiseAND(rise)
                    after = F.shiftright(same, 1)
                    return F.struct(
                        down.bitwiseOR(flip(after.bitwiseOR(up).bitwiseAND(mask))).bitwiseAND(mask).alias("rise"),
                        up.bitwiseAND(after).bitwiseAND(mask).alias("fall"),
                        (x["n"] + F.when(same.bitwiseAND(diagonal) == 0, 1).otherwise(0)).alias("n"),
                    )

                return let(carried, turned)

            return let(F.struct(state["rise"].alias("rise"), state["fall"].alias("fall"), state["n"].alias("n"), match.alias("m")), moved)

        rising = F.lit(((1 << width) - 1) & ~((1 << threshold) - 1)).cast("long")
        start = F.struct(rising.alias("rise"), F.lit(0).cast("long").alias("fall"), F.lit(0).alias("n"))
        walked = F.aggregate(F.sequence(F.lit(1), F.size(text)), start, step, lambda s: s["n"])
        return F.when(F.size(text) == 0, F.lit(0)).when(gap > threshold, F.lit(threshold + 1)).otherwise(walked)

    return let(F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b")), distance)


def _mostly_whole(a: Column, length: Column, b: Column, parts: int, threshold: int) -> Column:
    """A cheap condition that close lines meet: all but ``threshold`` of ``parts`` segments of ``a`` occur in ``b``,
    at most ``threshold`` characters off their place."""
    whole = F.lit(0)
    for i in range(parts):
        start, size = _segment(length, parts, i)
        first = F.greatest(start - threshold, F.lit(0))
        room = F.substring(b, first + 1, start + size + threshold - first)
        whole = whole + F.when(F.contains(room, F.substring(a, start + 1, size)), 1).otherwise(0)
    return whole >= parts - threshold


def _pieces_whole(a: Column, length: Column, b: Column, threshold: int) -> Column:
    """The same for pieces of a few characters, of which each edit spoils one at most."""
    size = PIECE
    starts = F.sequence(F.lit(1), F.greatest(length - size + 1, F.lit(1)), F.lit(size))

    def spoiled(at: Column) -> Column:
        first = F.greatest(at - threshold, F.lit(1))
        return ~F.contains(F.substring(b, first, at + size + threshold - first), F.substring(a, at, size))

    return F.size(F.filter(starts, spoiled)) <= threshold


def _trimmed(pair: Column) -> Column:
    """Struct ``x, y`` of two lines without what they begin and end with in common, in steps of a part of the first.

    That leaves their distance as it is, and the distance costs time for each character.
    """
    parts = 2 * FINE

    def common(p: Column, left: bool) -> Column:
        n, found = F.length(p["x"]), F.lit(0)
        side = (lambda t, k: F.substring(t, F.lit(1), k)) if left else (lambda t, k: F.right(t, k))
        for i in range(1, parts + 1):
            size = F.floor(n * i / parts).cast("int")
            found = F.when(side(p["x"], size) == side(p["y"], size), size).otherwise(found)
        return found

    def cut(p: Column, left: bool) -> Column:
        rest = lambda t, k: F.substring(t, k + 1, F.length(t)) if left else F.substring(t, F.lit(1), F.length(t) - k)
        return let(F.struct(p["x"].alias("x"), p["y"].alias("y"), common(p, left).alias("k")), lambda q: F.struct(
            rest(q["x"], q["k"]).alias("x"), rest(q["y"], q["k"]).alias("y")
        ))

    return let(cut(pair, True), lambda p: cut(p, False))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """Each different line once: its number, text, copies and first place (document, line).

    The table is bucketed by the number, so that later joins leave the texts where they are.
    """
    lines = docs.select("id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.where(F.col("line") != "")
    one = lines.groupBy("line").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "line_no")).alias("first"))
    return stored_by(one.withColumn("line_id", F.monotonically_increasing_id()), "line_id", "lines")


def _fine_start(length: Column, i: Column) -> Column:
    """Start (from 0) of segment ``i`` of ``FINE``, as in ``_segment``."""
    return (F.floor(length / FINE) * i + F.greatest(length % FINE - (FINE - i), F.lit(0))).cast("int")


def _fine_keys(lines: DataFrame, threshold: int, probing: bool) -> DataFrame:
    """``k, line_id, rest``: keys of all but ``threshold`` fine segments of a line, or, if ``probing``, of those of a line
    that many edits may turn into it, which is as long or shorter.

    A way to spoil segments i < j < ... with bounded edits fixes by how many characters each stretch between them is
    moved: none before the first, the whole gap behind the last, and one more edit for each character in between.
    ``rest`` is what lies in the spoiled segments.
    """
    ways = []
    for spoiled in combinations(range(FINE), threshold):
        for gap in range(threshold + 1 if probing else 1):
            for moves in product(range(-threshold, threshold + 1), repeat=threshold - 1) if probing else [(0,) * (threshold - 1)]:
                shifts = (0, *moves, gap)
                if sum(abs(b - a) for a, b in zip(shifts, shifts[1:])) <= threshold:
                    ways.append(F.struct(F.lit(gap).alias("gap"), F.array(*map(F.lit, spoiled)).alias("at"), F.array(*map(F.lit, shifts)).alias("by")))
    rows = lines.select("line_id", "line", "n", F.explode(F.array(*ways)).alias("way"))
    short, line = F.col("n") - F.col("way.gap"), F.col("line")
    stretches, spoiled_text, fits = [], [], F.lit(True)
    before = F.lit(0)
    for x in range(threshold + 1):
        by = F.get("way.by", x)
        begin = before + by
        end = (_fine_start(short, F.get("way.at", x)) if x < threshold else short) + by
        # the stretch before must have ended, or two stretches would claim the same characters
        fits = fits & (end >= begin) & (end <= F.col("n")) & (begin >= (done if x else F.lit(0)))
        stretches.append(F.substring(line, begin + 1, end - begin))
        if x:
            spoiled_text.append(F.substring(line, done + 1, begin - done))
        done = end
        before = _fine_start(short, F.get("way.at", x) + 1) if x < threshold else before
    key = F.xxhash64(short, "way.at", *stretches)
    return rows.where(fits).select(key.alias("k"), "line_id", F.concat_ws("\n", *spoiled_text).alias("rest"))


def _close(pairs: DataFrame, lines: DataFrame, threshold: int) -> DataFrame:
    """The pairs ``(a, b)`` of line numbers, each once, that are within the threshold."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    text = F.struct("n", "line")
    # only the texts of paired lines are moved; a line of many pairs may be a skewed key in the joins behind
    pairs = stored(pairs, "line-pairs")
    paired = pairs.select(F.explode(F.array("a", "b")).alias("line_id")).distinct()
    lines = stored(lines.join(paired.hint("shuffle_hash"), "line_id"), "line-paired")
    left = pairs.join(lines.select(F.col("line_id").alias("a"), text.alias("x")).hint("merge"), "a")
    both = left.join(lines.select(F.col("line_id").alias("b"), text.alias("y")).hint("merge"), "b")
    both = both.select("a", "b", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    both = both.select("a", "b", F.col("x.n").alias("n"), F.col("x.line").alias("x"), F.col("y.line").alias("y"))
    rough = _mostly_whole(F.col("x"), F.col("n"), F.col("y"), PARTS, threshold)
    exact = F.when(rough, _pieces_whole(F.col("x"), F.col("n"), F.col("y"), threshold))
    near = stored(both.where(exact), "line-near")
    cut = near.select("a", "b", _trimmed(F.struct("x", "y")).alias("cut")).select("a", "b", "cut.x", "cut.y")
    edits = edit_distance_within(F.col("x"), F.col("y"), threshold)
    return stored(cut.where(edits <= threshold).select("a", "b"), "line-links")


def line_groups(lines: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """``(id, component)`` for the lines that have another one within the threshold: the connected groups of these.

    No side of a join is broadcast by the size of its files, which says little: line numbers that follow one another
    take a hundredth of their room there. A side with a row per key is hashed part by part, others are merged.
    """
    t = config.threshold
    # the length of a line is counted once, not for each of its segments
    joined = lines.where(F.length("line") >= max(config.min_chars, t + 1))
    joined = joined.select("line_id", "line", F.length("line").alias("n"))
    line, length = F.col("line"), F.col("n")
    entries = joined.select(F.explode(F.array(*_index(line, length, t + 1))).alias("k"), F.col("line_id").alias("a"))
    # one projection for each gap, small enough to be compiled
    probes = None
    for gap in range(t + 1):
        some = joined.select(F.explode(F.array(*_probes(line, length, t, gap))).alias("k"), F.col("line_id").alias("b"))
        probes = some if probes is None else probes.unionByName(some)
    probes = probes.where(F.col("k").isNotNull())
    # Most segments have one index line and meet no probe; what is left is small. A segment of several lines stays without
    # a probe, its ``b`` is null then.
    counted = entries.groupBy("k").agg(F.count(F.lit(1)).alias("held"), F.min("a").alias("a"))
    hits = stored(
        counted.hint("shuffle_hash").join(probes, "k", "left").where((F.col("held") > 1) | (F.col("a") != F.col("b"))), "line-hits"
    )
    alone = hits.where("held = 1").select("a", "b")
    several = hits.where("held > 1").select("k", "held").distinct()
    members = stored(entries.join(several.hint("shuffle_hash"), "k"), "line-members")
    # every line that holds a segment of several asks for it too
    asking = hits.where("held > 1 and b is not null").select("k", "held", "b").unionByName(
        members.select("k", "held", F.col("a").alias("b"))
    )
    warm, hot = F.col("held") <= config.hot, F.col("held") > config.hot
    met = members.where(warm).select("k", "a").join(asking.where(warm).select("k", "b").hint("merge"), "k")
    met = met.where(F.col("a") != F.col("b")).select("a", "b")

    in_hot = asking.where(hot).select(F.col("b").alias("line_id")).distinct()
    fine = stored(joined.join(in_hot.hint("shuffle_hash"), "line_id"), "line-fine")
    held = _fine_keys(fine, t, probing=False).groupBy("k").agg(F.min("line_id").alias("first"), F.count(F.lit(1)).alias("held"))
    # a line that alone holds a key and probes it meets nobody
    asks = _fine_keys(fine, t, probing=True).join(held.hint("shuffle_hash"), "k").where("held > 1 or first <> line_id")
    asks = stored(asks.select("k", F.col("line_id").alias("b"), "rest", "first", "held"), "line-asks")
    # each line that asks meets one line of the key; every line that holds the key asks for it too
    star = asks.where(F.col("first") != F.col("b")).select(F.col("first").alias("a"), "b")
    links = _close(alone.unionByName(met).unionByName(star), joined, t)
    groups = components(links, "line-groups")

    # what meets in a key held by several lines and is not of one group yet
    group = groups.withColumnRenamed("component", "group")
    open_keys = asks.where("held > 1").join(group.withColumnRenamed("id", "b").hint("shuffle_hash"), "b", "left").select(
        "k", "b", "rest", F.coalesce("group", "b").alias("group")
    )
    mixed = open_keys.groupBy("k").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high")
    open_keys = stored(open_keys.join(mixed.select("k").hint("shuffle_hash"), "k"), "line-open")
    holders = _fine_keys(fine, t, probing=False).join(mixed.select("k").hint("shuffle_hash"), "k")
    holders = holders.join(group.withColumnRenamed("id", "line_id").hint("shuffle_hash"), "line_id", "left").select(
        F.col("k").alias("held_k"), F.col("line_id").alias("a"), F.col("rest").alias("own"), F.coalesce("group", "line_id").alias("of")
    )
    # lines of one key differ in ``rest`` only, a few characters, so most pairs are settled by these
    like = F.levenshtein("own", "rest", t) >= 0
    rest = holders.join(open_keys.hint("merge"), (F.col("held_k") == F.col("k")) & (F.col("of") != F.col("group")) & like).select("a", "b")
    more = _close(rest, joined, t)
    if more.isEmpty():
        return groups
    return components(links.unionByName(more), "line-groups")


def line_classes(docs: DataFrame, config: LineConfig = LineConfig()) -> DataFrame:
    """Every different line with its class: ``line, copies, first, class_first, class_lines``.

    A class is a connected set of lines within the threshold; it is named by its first place, the smallest
    (document, line), and ``class_lines`` counts its different lines.
    """
    lines = distinct_lines(docs)
    groups = line_groups(lines, config)
    grouped = groups.withColumnRenamed("id", "line_id")
    member = lines.select("line_id", "first").join(grouped.hint("shuffle_hash"), "line_id")
    place = member.groupBy("component").agg(F.min("first").alias("class_first"), F.count(F.lit(1)).alias("class_lines"))
    named = grouped.join(place.hint("shuffle_hash"), "component").drop("component")
    return lines.join(named.hint("shuffle_hash"), "line_id", "left").select(
        "line", "copies", "first", F.coalesce("class_first", "first").alias("class_first"),
        F.coalesce("class_lines", F.lit(1).cast("long")).alias("class_lines"),
    )


def line_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: LineConfig = LineConfig()
) -> DataFrame:
    """One row per different line with its class; lines of different classes are never within the threshold.

    Columns: doc_id and line_no (first place), line, copies, class_doc, class_line (first place of its class),
    class_lines (different lines of its class). Empty lines, null and empty texts give no row, nor does an empty
    table; a null id sorts first; repeated rows count as copies. Of equal lines, and of the lines of a class, the
    smallest (document, line) is the first place, so ties do not depend on the order of the rows. Long lines are
    compared whole.
    """
    docs = clean_columns(docs, id=id_col, text=text_col)
    named = line_classes(docs, config)
    return named.select(
        F.col("first.id").alias(id_col), F.col("first.line_no").alias("line_no"), "line", "copies",
        F.col("class_first.id").alias("class_doc"), F.col("class_first.line_no").alias("class_line"), "class_lines",
    )


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None, min_words: int = 5,
    config: LineConfig = LineConfig(min_chars=30), min_size: int = 30,
) -> DataFrame:
    """The documents without lines that an earlier place of the table has, up to the threshold.

    Lines of under ``min_words`` words and ``min_size`` characters stay, as they carry no passage; short lines that
    are not equal, but near another, stay as well (``config``). The first place is the smallest (id, line).
    Other columns are unchanged, but that ``size_col``, if given, follows a text that changes. A document left without a word, though it had some, goes; null, empty and blank
    texts stay as they are. Rows that repeat an id share places; each loses what an earlier place has.
    """
    given = docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select("_row")
    given = given.select("_row", F.col("_row")[id_col].alias("id"), F.col("_row")[text_col].alias("text"))
    named = line_classes(given.select("id", "text"), config)
    # Only lines seen twice, or near another, can go.
    doubtful = named.where((F.col("copies") > 1) | (F.col("class_lines") > 1))
    n_words = F.size(F.filter(F.split("line", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    doubtful = doubtful.where((n_words >= min_words) | (F.length("line") >= min_size))
    # two 64-bit hashes stand for the text of a line in this join
    name = lambda: [F.xxhash64("line").alias("h"), F.xxhash64(F.lit("line"), "line").alias("h2")]
    doubtful = doubtful.select(*name(), "class_first")
    places = given.select("id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    again = places.select("id", "line_no", *name()).join(doubtful, ["h", "h2"]).where(
        ~F.struct("id", "line_no").eqNullSafe(F.struct(F.col("class_first.id").alias("id"), F.col("class_first.line_no").alias("line_no")))
    )
    gone = again.groupBy("id").agg(F.collect_set("line_no").alias("gone"))
    marked = given.join(gone.withColumnRenamed("id", "gone_id"), given["id"].eqNullSafe(F.col("gone_id")), "left")

    def rest(parts: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
        return F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")

    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), rest))
    cut = marked.withColumn("new", text).where(F.col("gone").isNull() | F.col("new").rlike(r"[^\x20\x09-\x0D]"))
    values = {c: F.col("_row").getField(c) for c in docs.columns}
    values[text_col] = F.col("new")
    if size_col:
        size = F.when(F.col("gone").isNull(), values[size_col]).otherwise(F.length("new").cast("long"))
        values[size_col] = size.cast(docs.schema[size_col].dataType)
    return cut.select(*[value.alias(c) for c, value in values.items()])
