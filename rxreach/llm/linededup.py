"""Line deduplication: segment-partition edit join [native].

A line goes when an earlier line of the corpus (by doc_id, then row hash, then
line number) is equal to it or near it.  How many edits (code points) are near
grows with the length of the shorter line: ``edits_from`` lists the lengths
from which one, two, three ... are allowed.  Equal lines collapse first: a
class is known by a 128-bit hash and its first occurrence, and every later
occurrence goes.

Near lines are found by threshold-plus-one segments: of two near lines at least
one segment of the shorter stands unedited in the other, with exactly as many
edits to its left as segments.  With t > 1 edits allowed the segments are as
long for all lines of a span of lengths (``_least``), the first ones stand at
fixed places from the start and the last ones from the end, so one set of
probes, shifted by the edits on the nearer side, serves every length: 5 rows a
line for two edits, 8 for three (``_windows``).  Rows hold hashes alone; the
texts are fetched for the classes that meet.  With one edit allowed a line
files two segments under (length, segment number, hash) and probes for its own
length and the one below.  Classes that meet, whose counts of ``LETTERS`` are
near and that agree in enough of ``t + EXTRA`` small pieces are verified on
their whole texts by a banded bit-parallel automaton over 2t + 1 diagonals.

Comparing all classes that share a segment would make their square of pairs.
With one edit allowed they are taken on by groupings of what the rest of the
line is without one code point (``_meetings``): each class is paired with the
earliest class of each of its groups alone.  With more edits every class first
meets the earliest class filed under its segment; those not decided by that are
compared within groups of up to ``GROUP``, and the members of larger groups
file and probe again by two segments of t + 2, of which two near lines share at
least two, where the same two steps follow, the second in groups of any size.

Cases: null text has no lines and stays null; empty text is one blank line;
blank lines (white space only) always stay; lines shorter than the first of
``edits_from`` match by equality alone; rows equal in doc_id and text count as
one document and each gets its result; null doc_id orders first; no rows give
no rows; extra columns pass through ``dedup_lines`` untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: An edit is allowed from 16 code points on, two from 64, three from 256.
EDITS_FROM = (16, 64, 256)
PIECE = 16
GROUP = 32
EXTRA = 13
LETTERS = "etaoinshrdlucmfwypvbg .,"      # their counts are compared, eight to a long
KEY = ["_id", "_th"]


def within(a: Column, b: Column, threshold: int) -> Column:
    """True where the edit distance of strings a and b is at most threshold (up to 4).

    Bit d of the word for e errors says that the prefix of a read so far and
    the prefix of b that ends ``d - threshold`` code points further are within
    e edits: 2 * threshold + 1 diagonals of the table, advanced together for
    each code point of a.  The words of all e stand side by side in one long."""
    if not 0 <= threshold <= 4:
        raise ValueError("the words of more than 4 edits do not fit a long")
    read, other = [F.regexp_extract_all(x, F.lit("(?s)."), F.lit(0)).alias(c) for x, c in ((a, "a"), (b, "b"))]
    band = 2 * threshold + 1
    mask = F.lit((1 << band) - 1).cast("long")

    def equal(other: Column, x: Column, i: Column) -> Column:
        return reduce(lambda m, d: m.bitwiseOR(F.when(F.get(other, i + (d - threshold)) == x, F.lit(1 << d)).otherwise(0)),
                      range(band), F.lit(0)).cast("long")

    def step(words: Column, match: Column) -> Column:
        word = lambda e: F.shiftright(words, e * band).bitwiseAND(mask)
        now = [word(0).bitwiseAND(match)]
        for e in range(1, threshold + 1):
            old = word(e - 1)
            now.append(word(e).bitwiseAND(match).bitwiseOR(old).bitwiseOR(F.shiftright(old, 1))
                       .bitwiseOR(F.shiftleft(now[e - 1], 1)).bitwiseAND(mask))
        return reduce(lambda x, e: x.bitwiseOR(F.shiftleft(now[e], e * band)), range(1, threshold + 1), now[0])

    # before any code point of a: k code points of b cost k edits
    start = sum(sum(1 << (threshold + k) for k in range(e + 1)) << (e * band) for e in range(threshold + 1))
    # one element, so that both texts are cut once and not for each code point
    ends = F.transform(F.array(F.struct(read, other)), lambda p: F.aggregate(
        F.transform(p["a"], lambda x, i: equal(p["b"], x, i)), F.lit(start).cast("long"), step))
    end = F.get(ends, F.lit(0))
    at = F.length(b) - F.length(a) + threshold
    return F.when((at < 0) | (at >= band), F.lit(False)).otherwise(
        F.shiftright(end, threshold * band).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), at)) != 0)


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("_id"), F.hash("text").alias("_th"),
                       F.split("text", "\n", -1).alias("lines"))


def _classes(docs: DataFrame, least: int) -> DataFrame:
    """One row per distinct line that is not blank: first occurrence, a number
    (63 bits of the line's hash) and, from ``least`` code points on, the line."""
    rows = _lines(docs).select(*KEY, F.posexplode("lines").alias("pos", "line")).where(
        F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return (rows.select(*KEY, "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
                        F.when(F.length("line") >= least, F.col("line")).alias("line"))
                .groupBy("h1", "h2").agg(F.min(F.struct(*KEY, "pos")).alias("at"), F.first("line").alias("line"))
                .select("at", F.shiftrightunsigned("h1", 1).alias("id"), "line"))


def _allowed(n: Column, edits_from: Sequence[int]) -> Column:
    return reduce(lambda k, least: k + (n >= least).cast("int"), edits_from, F.lit(0))


def _piece(line: Column, m: Column, parts: Column | int, i: Column | int, shift: Column | int) -> Column:
    """Where the i-th of ``parts`` even pieces of a line of m code points would
    stand in ``line`` if it were shifted (the last pieces hold one more)."""
    parts, i = [F.lit(x) if isinstance(x, int) else x for x in (parts, i)]
    size, short = F.floor(m / parts).cast("int"), parts - m % parts
    start = i * size + F.greatest(F.lit(0), i - short)
    return F.substring(line, start + shift + 1, size + (i >= short).cast("int"))


def _places(t: int, d: int, segments: int) -> list[tuple[int, int, int, int]]:
    """(i, s, j, u): the i-th segment of a line with t edits allowed may stand
    shifted by s in one d code points longer; of two segments also the j-th by u."""
    if segments == 1:
        return [(i, s, 0, 0) for i in range(t + 1)
                for s in range(max(-i, d - t + i), min(i, d + t - i) + 1)]
    # an insertion counts to the segment it stands before, or to the last
    shifts, last = range(-t, t + 1), t + 1
    return [(i, s, j, u) for j in range(t + 2) for i in range(j) for s in shifts for u in shifts
            if abs(s) + abs(u - s) + abs(d - u) <= t
            and (i or not s) and (j < last or u == d) and (j > i + 1 or u == s)]


def _least(n: Column, edits_from: Sequence[int]) -> Column:
    """The least length of the span that a line of n code points is in: spans
    begin at 2, 3, 4, 6, 8, 12 ... and where another edit is allowed."""
    power = F.call_function("shiftleft", F.lit(1), F.length(F.bin(n)) - 1)
    half = power + F.shiftright(power, 1)
    return F.greatest(power, F.when(n >= half, half), *[F.when(n >= least, F.lit(least)) for least in edits_from])


def _windows(classes: DataFrame, edits_from: Sequence[int]) -> DataFrame:
    """(key, v): the segments of each class with more than one edit allowed and
    the windows it probes with.  v is the class's number, or -1 less it where
    the row only probes.

    Of two near lines there is an i such that the i-th segment of the shorter
    stands in the other with i edits before it and at most t - i after it: its
    place from the start is off by i at most, that from the end by t - i."""
    most, none = len(edits_from), F.expr("cast(array() as array<int>)")
    lines = classes.where(F.length("line") >= edits_from[1]).select("id", "line", F.length("line").alias("n"))
    # the span of each length that a near line no longer than itself may have
    lines = lines.select("*", *[_least(F.col("n") - d, edits_from).alias(f"l{d}") for d in range(most + 1)])
    codes = []
    for d in range(most + 1):
        t, found = _allowed(F.col("n") - d, edits_from), none
        for k in range(max(2, d), most + 1):
            packed = [((k * 16 + d) * 16 + i) * 16 + s + 8 for i, s, _, _ in _places(k, 0, 1)]
            found = F.when(t == k, F.expr(f"array({', '.join(map(str, packed))})")).otherwise(found)
        # once for a span, though several lengths are in it
        codes.append(found if not d else F.when(F.col(f"l{d}") < F.col(f"l{d - 1}"), found).otherwise(none))
    rows = lines.select("*", F.explode(F.concat(*codes)).alias("e"))
    t, d, i, s = [F.shiftright("e", 4 * b).bitwiseAND(F.lit(15)) for b in (3, 2, 1, 0)]
    least = reduce(lambda x, k: F.when(d == k, F.col(f"l{k}")).otherwise(x), range(1, most + 1), F.col("l0"))
    rows = rows.select("id", "line", "n", t.alias("t"), i.alias("i"), (s - 8).alias("s"), least.alias("least"),
                       ((d == 0) & (s == 8)).alias("base"))
    size = F.floor(F.col("least") / (F.col("t") + 1)).cast("int")
    start = F.when(2 * F.col("i") <= F.col("t"), F.col("i") * size).otherwise(F.col("n") - (F.col("t") + 1 - F.col("i")) * size) + F.col("s")
    return rows.where((start >= 0) & (start + size <= F.col("n"))).select(
        F.xxhash64("least", "i", F.substring("line", start + 1, size)).alias("key"),
        F.when(F.col("base"), F.col("id")).otherwise(-1 - F.col("id")).alias("v"))


def _met_by_windows(classes: DataFrame, edits_from: Sequence[int]) -> tuple[DataFrame, DataFrame]:
    """The rows of ``_windows`` whose key several classes have, a base among
    them: (key, base, n: rows of that key, at, size, bag); and their texts."""
    w, number = Window.partitionBy("key"), F.greatest("v", -1 - F.col("v"))
    rows = _windows(classes, edits_from).select(
        "key", "v", F.min(number).over(w).alias("low"), F.max(number).over(w).alias("high"),
        F.max("v").over(w).alias("top"), F.count(F.lit(1)).over(w).alias("n"))
    rows = saved(rows.where("low < high and top >= 0").select("key", number.alias("id"), (F.col("v") >= 0).alias("base"), "n"))
    texts = saved(_counted(classes.join(rows.select("id").distinct(), "id")))
    return saved(rows.join(texts.drop("line"), "id").drop("id")), texts.drop("id")


def _counted(classes: DataFrame) -> DataFrame:
    """``classes`` with the length of the line and the counts of ``LETTERS`` in
    its halves, modulo 256."""
    n = F.length("line")
    half = F.floor(n / 2).cast("int")

    def eight(part: Column, letters: str) -> Column:
        count = lambda c: F.octet_length(part) - F.octet_length(F.replace(part, F.lit(c), F.lit("")))
        return reduce(F.Column.bitwiseOR, [F.shiftleft(count(c).bitwiseAND(F.lit(255)).cast("long"), 8 * k)
                                           for k, c in enumerate(letters)])
    halves = classes.select("*", n.alias("size"), F.left("line", half).alias("_0"), F.right("line", n - half).alias("_1"))
    return halves.select("*", F.struct(*[eight(F.col(f"_{h}"), LETTERS[k:k + 8]).alias(f"c{h}_{k}") for h in (0, 1)
                                         for k in range(0, len(LETTERS), 8)]).alias("bag")).drop("_0", "_1")


def _apart(a: Column, b: Column) -> Column:
    """How far the counts of two lines lie apart, as far as they are known.  An
    edit adds two at most: one or two letters of its half change, and with one
    the end of the half moves by a letter.  So does one of the halves' ends for
    each code point that one line is longer than the other."""
    ways = [F.shiftrightunsigned(a[f"c{h}_{k}"], 8 * j).bitwiseAND(F.lit(255))
            - F.shiftrightunsigned(b[f"c{h}_{k}"], 8 * j).bitwiseAND(F.lit(255))
            for h in (0, 1) for k in range(0, len(LETTERS), 8) for j in range(8)]
    return reduce(F.Column.__add__, [F.least(F.abs(w), 256 - F.abs(w)) for w in ways])


def _filed(classes: DataFrame, edits_from: Sequence[int], segments: int) -> DataFrame:
    """(key, at, seg, longer, base): the segments of each class (``base``) and
    the substrings it probes with, by their hash; one segment where one edit is
    allowed, or two of t + 2 where more are."""
    n = F.length("line")

    def codes(d: int) -> Column:
        t, found = _allowed(n - d, edits_from), F.expr("cast(array() as array<int>)")
        for k in range(max(segments, d), 2 if segments == 1 else len(edits_from) + 1):
            packed = [((((k * 16 + d) * 16 + i) * 16 + s + 8) * 16 + j) * 16 + u + 8 for i, s, j, u in _places(k, d, segments)]
            found = F.when(t == k, F.expr(f"array({', '.join(map(str, packed))})")).otherwise(found)
        return found

    rows = classes.where("line is not null").select(
        "at", "line", n.alias("n"), F.explode(F.concat(*[codes(d) for d in range(len(edits_from) + 1)])).alias("e"))
    t, d, i, s, j, u = [F.shiftright("e", 4 * b).bitwiseAND(F.lit(15)) for b in (5, 4, 3, 2, 1, 0)]
    s, u, m = s - 8, u - 8, F.col("n") - d
    found = [_piece(F.col("line"), m, t + segments, i, s)]
    if segments == 2:
        found.append(_piece(F.col("line"), m, t + segments, j, u))
    return rows.select(F.xxhash64(m, i, j, *found).alias("key"), "at", i.alias("seg"),
                       (d > 0).alias("longer"), ((d == 0) & (s == 0) & (u == 0)).alias("base"))


def _met(classes: DataFrame, edits_from: Sequence[int], segments: int) -> DataFrame:
    """The rows of ``_filed`` whose key several rows have, a base among them,
    with the size of that group and what else ``classes`` holds."""
    rows = _filed(classes, edits_from, segments)
    keys = saved(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("base"), 1)).alias("bases"))
                     .where("n > 1 and bases > 0").select("key", "n"))
    return saved(saved(rows.join(keys, "key")).join(classes if segments == 1 else classes.drop("line"), "at"))


def _alike(short: Column, long: Column, t: Column) -> Column:
    """False only if more than t edits lie between: t edits leave all but t of
    any pieces of ``short`` standing in ``long``, shifted by t at most."""
    n, parts = F.length(short), t + EXTRA
    size, longer = F.floor(n / parts).cast("int"), parts - n % parts

    def stands(i: Column) -> Column:
        start = i * size + F.greatest(F.lit(0), i - longer) - t
        around = F.substring(long, F.greatest(start, F.lit(0)) + 1, size + 1 + 2 * t + F.least(start, F.lit(0)))
        return F.contains(around, _piece(short, n, parts, i, 0))

    return F.size(F.filter(F.sequence(F.lit(0), parts - 1), stands)) >= parts - t


def _trimmed(pairs: DataFrame) -> DataFrame:
    """``pairs`` whose texts ``short`` and ``long`` are without what they begin
    and end with alike (but for the last few code points of it): edits between
    them are the same, and the automaton reads less."""
    steps = F.array(*[F.lit(k) for k in (1024, 512, 256, 128, 64, 32, 16, 8, 4)])
    for end in (False, True):
        n, m = F.length("short"), F.length("long")

        def further(p: Column, k: Column) -> Column:
            x, y = (n - p - k, m - p - k) if end else (p, p)
            same = (p + k <= n) & (F.substring("short", x + 1, k) == F.substring("long", y + 1, k))
            return F.when(same, p + k).otherwise(p)
        pairs = pairs.withColumn("_p", F.aggregate(steps, F.lit(0), further))
        cut = F.left if end else F.right
        pairs = pairs.withColumns({c: cut(F.col(c), F.length(c) - F.col("_p")) for c in ("short", "long")})
    return pairs.drop("_p")


def _verified(pairs: DataFrame, texts: DataFrame, edits_from: Sequence[int]) -> DataFrame:
    """(at): the later class of each pair (a, b) that is near."""
    line = lambda c: texts.select(F.col("at").alias(c), F.col("line").alias(f"l_{c}"))
    both = pairs.distinct().join(line("a"), "a").join(line("b"), "b")
    turned = F.length("l_a") > F.length("l_b")
    both = both.select(F.greatest("a", "b").alias("at"), F.when(turned, F.col("l_b")).otherwise(F.col("l_a")).alias("short"),
                       F.when(turned, F.col("l_a")).otherwise(F.col("l_b")).alias("long"))
    t, both = F.col("t"), saved(_trimmed(both.withColumn("t", _allowed(F.length("short"), edits_from))))
    # dealt anew: what takes long is the automaton, and pairs lie as their classes did
    once = both.where(_alike(F.col("short"), F.col("long"), t)).repartition(
        int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "at", "short", "long")
    near = once.where(reduce(lambda found, k: F.when(t == k, within(F.col("short"), F.col("long"), k)).otherwise(found),
                             range(1, len(edits_from) + 1), F.lit(False)))
    return saved(near.select("at").distinct())


def _gone(met: DataFrame, texts: DataFrame, edits_from: Sequence[int], known: DataFrame | None = None) -> DataFrame:
    """(at): classes near an earlier one that shares a key.  Without ``known``,
    the classes that an earlier step found gone, groups over ``GROUP`` rows give
    only what their first base decides; else all are compared."""
    row = F.struct("at", "size", "bag")
    more, t = F.col("b.size") - F.col("a.size"), _allowed(F.col("a.size"), edits_from)
    # a is filed, so no longer than b
    may = (F.col("a.at") != F.col("b.at")) & (more >= 0) & (more <= t) & (_apart(F.col("a.bag"), F.col("b.bag")) <= 2 * t + more)
    ends = [F.col("a.at").alias("a"), F.col("b.at").alias("b")]
    first = met.where("base").groupBy("key").agg(F.min(row).alias("a"))
    gone = _verified(met.select("key", row.alias("b")).join(first, "key").where(may).select(*ends), texts, edits_from)
    if known is None:
        left = met.where(F.col("n") <= GROUP)
    else:
        left, gone = met, saved(gone.union(known).distinct())
    left = left.join(gone.withColumn("gone", F.lit(True)), "at", "left")
    side = lambda c: [row.alias(c), F.col("gone").isNull().alias(f"{c}_open")]
    pairs = left.where("base").select("key", *side("a")).join(left.select("key", "base", *side("b")), "key")
    later = F.col("b.at") > F.col("a.at")
    pairs = pairs.where(F.when(later, F.col("b_open")).otherwise(F.col("a_open")) & (later | ~F.col("base") | (more > 0)) & may)
    return gone.union(_verified(pairs.select(*ends), texts, edits_from))


def _meetings(met: DataFrame) -> DataFrame:
    """(at, partner): class positions and an earlier class that may be near,
    among rows that share a segment.  met: key, at, longer (one code point
    longer than the filed length), rest (the line without the shared segment).

    A rest is cut into pieces of ``PIECE`` code points (a longer one's own piece
    holds one more).  Of two rests within one edit all but one piece agree, and
    in that piece the longer without one code point is the other, or both
    without their q-th are equal.  Those are groupings, whose minimum is
    combined map-side: no pairs are made but with the group's earliest line."""
    size = F.length("rest") - F.col("longer").cast("int")
    pieces = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(size / PIECE).cast("int") - 1, F.lit(0)))).alias("k")
    cut = met.select("key", "at", "longer", "rest", pieces)
    start, width = F.col("k") * PIECE, PIECE + F.col("longer").cast("int")
    cut = cut.select(
        "at", "longer", F.substring("rest", start + 1, width).alias("mid"),
        *[F.xxhash64(F.lit(s), "key", "k", F.left("rest", start), F.substring("rest", start + width + 1, F.length("rest"))).alias(f"o{s}")
          for s in (1, 2)])
    def row(kind: str, place, left) -> DataFrame:
        return F.struct(F.lit(kind).alias("kind"), place.alias("q"), left.alias("v"))
    without = lambda q: F.concat(F.left("mid", q - 1), F.substring("mid", q + 1, F.length("mid")))
    every = F.when(F.col("mid") != "", F.sequence(F.lit(1), F.length("mid"))).otherwise(F.array().cast("array<int>"))
    same = F.transform(every, lambda q: row("same", q, without(q)))
    longer = F.transform(every, lambda q: row("longer", F.lit(0), without(q)))
    base = F.array(row("base", F.lit(0), F.col("mid")))
    rows = cut.select("at", "o1", "o2", F.explode(F.when(F.col("longer"), longer).otherwise(F.concat(same, base))).alias("e"))
    rows = rows.select("at", "e.kind", *[F.xxhash64(f"o{s}", "e.q", "e.v").alias(f"v{s}") for s in (1, 2)])
    is_longer = F.col("kind") == "longer"
    low = rows.groupBy("v1", "v2").agg(
        F.min(F.when(~is_longer, F.col("at"))).alias("low"), F.min(F.when(is_longer, F.col("at"))).alias("low_longer"),
        F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    partner = F.when(F.col("kind") == "base", F.col("low_longer")).otherwise(F.col("low"))
    return (rows.join(low, ["v1", "v2"]).select("at", partner.alias("partner"))
                .where("partner < at").distinct())


def _gone_by_one(met: DataFrame, edits_from: Sequence[int]) -> DataFrame:
    """(at): classes within one edit of an earlier one that shares a segment."""
    n = F.length("line")
    base = F.when(F.col("longer"), n - 1).otherwise(n)
    half = F.floor(base / 2).cast("int")
    meetings = saved(_meetings(met.select(
        "key", "at", "longer", F.when(F.col("seg") == 0, F.right("line", n - half))
                                .otherwise(F.left("line", n - (base - half))).alias("rest"))))
    return _verified(meetings.select(F.col("partner").alias("a"), F.col("at").alias("b")),
                     met.select("at", "line").distinct(), edits_from)


def kept_lines(docs: DataFrame, edits_from: Sequence[int] = EDITS_FROM) -> DataFrame:
    """(_id, _th, kept): ascending numbers of the lines that stay because they
    are the first of their class and near no earlier class.  Documents without
    such a line are absent; blank lines are not listed."""
    classes, most = saved(_classes(docs, edits_from[0])), len(edits_from)
    # one edit: lines whose equal or one shorter length allows one
    one = classes if most == 1 else classes.where(F.length("line") <= edits_from[1])
    gone = _gone_by_one(_met(one.drop("id"), edits_from, 1), edits_from)
    if most > 1:
        met, texts = _met_by_windows(classes, edits_from)
        found = _gone(met, texts, edits_from)
        hot = saved(texts.join(met.where(F.col("n") > GROUP).select("at").distinct(), "at"))
        gone = gone.union(_gone(_met(hot, edits_from, 2), hot, edits_from, known=found))
    stay = classes.select("at").join(gone, "at", "left_anti")
    return stay.select("at.*").groupBy(*KEY).agg(F.sort_array(F.collect_list("pos")).alias("kept"))


def _null_safe(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    r = right.withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    return left.join(r, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")),
                     how).drop("_rid", "_rth")


def _whole(docs: DataFrame) -> DataFrame:
    """The side of a join that carries texts: sorted merge at every size, so a
    job on little data has the plan of one on much."""
    return docs.hint("merge")


def dedup_lines(docs: DataFrame, edits_from: Sequence[int] = EDITS_FROM, counts: bool = True) -> DataFrame:
    """``docs`` with the lines that stay as ``text``, plus n_lines, n_removed
    (in place of columns so named; without ``counts`` neither)."""
    kept = saved(kept_lines(docs, edits_from))
    # the other columns travel in one struct, so their names clash with nothing
    d = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"), F.col("doc_id").alias("_id"),
                    F.hash("text").alias("_th"), F.split("text", "\n", -1).alias("_lines"))
    out = _null_safe(_whole(d), kept, "left")
    out = out.withColumn("_kept", F.coalesce("kept", F.expr("array()").cast("array<int>")))
    blanks = F.filter("_lines", lambda x: ~x.rlike(r"[^\x20\x09-\x0D]"))
    # merge the listed lines with the blank ones in order; without blank lines
    # (almost always) the listed ones are picked by number
    numbered = F.transform("_lines", lambda x, i: F.when(~x.rlike(r"[^\x20\x09-\x0D]"), i))
    order = F.when(F.size(blanks) == 0, F.col("_kept")).otherwise(
        F.sort_array(F.concat("_kept", F.array_compact(numbered))))
    out = out.withColumn("_order", order)
    null = F.col("_lines").isNull()
    text = F.when(~null, F.array_join(F.transform("_order", lambda i: F.get("_lines", i)), "\n"))
    n, left = [F.when(null, 0).otherwise(F.size(c)) for c in ("_lines", "_order")]
    extra = {"n_lines": n.cast("long"), "n_removed": (n - left).cast("long")} if counts else {}
    return out.select(*[text.alias("text") if c == "text" else F.col("_row")[c].alias(c)
                        for c in docs.columns if c not in extra], *[v.alias(k) for k, v in extra.items()])
