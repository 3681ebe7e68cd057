"""Conversation structure repair: scalar big-integer weights over a DAG.

Rows of a conversation, in order of turn, are edited until their role initials
read ``(s?(ua)+)?``.  Edits and costs: Keep 0, Rerole to user or assistant 1,
Delete 2 (the only edit of a blank or duplicate row), Insert an empty user or
assistant turn anywhere 5; a truncated row that is not deleted costs 5 more.
Of the cheapest repairs the one whose edit initials, read as text, are least
in ASCII is taken.

One integer is both: an edge (an edit) weighs ``cost * 8**width`` plus its
letter's digit (D 1, I 2, K 3, R 4) at the place of that edit in the audit, the
first edit at the highest of ``width`` octal places; places after the last edit
hold zero, so a shorter audit is less than one that goes on.  A node is (rows
read, last kind written); the smallest sum of weights that reaches it is kept.
Two audits of equal cost at one node differ at some place that both hold: one
that only went on would hold more inserts, which cost.  So the smallest integer
of an accepting node is the repair, and its digits are the audit.

A conversation's rows are known by one letter each (role initial and fault),
and only letters reach Python.  Its letters are read in stretches of ``PART``:
within one, weights have the stretch's width; between stretches, the best
weight from each kind to each kind is an edge of the same sort.  So integers
stay short on long conversations.

Spark side: one narrow pass finds duplicates (by a 128-bit hash of role and
text) and the letters; texts are shuffled once, by (conversation, section of
1,024 turn numbers), where the edits are applied.  The audit is one letter a
row, so a conversation's letters are bounded by its own result.

Cases: a null role or text is one space; a null conv_id is one conversation; a
null turn comes first; rows equal in turn are ordered by a hash of role and
text, equal rows stand together; a role is known by its first character; rows
of no conversation give no rows; only conv_id, turn, role and text are read, so
other columns clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SECTION = 1024
PART = 128
BLANKS = " \t\n\x0b\x0c\r"
KEY = ["_key", "_section"]

KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
START, SYSTEM, USER, ASSISTANT = range(4)
KINDS = range(4)
#: row letters: s u a x by role initial; capitals are truncated rows, digits rows to delete
LETTERS = "suax"


def _edges(code: str) -> list[tuple[int, int, int, str]]:
    """Edits of a row: (kind before, kind after, cost, letter)."""
    edges = [(q, q, DELETE, "D") for q in KINDS]
    if code.isdigit():
        return edges
    more = CUT if code.isupper() else 0
    to = {"s": SYSTEM, "u": USER, "a": ASSISTANT, "x": None}[code.lower()]
    for q in KINDS:
        nxt = ASSISTANT if q == USER else USER
        if to == nxt or (to == SYSTEM and q == START):
            edges.append((q, to, KEEP + more, "K"))
        edges.append((q, nxt, REROLE + more, "R"))
    return edges


EDGES = {c: _edges(c) for c in LETTERS + LETTERS.upper() + "0123"}
#: an insert before a row, or two; then no more can help
INSERTS = [(q, ASSISTANT if q == USER else USER, INSERT, "I") for q in KINDS]


def _least(nodes: dict, kind: int, found: tuple[int, int]) -> None:
    if kind not in nodes or found < nodes[kind]:
        nodes[kind] = found


def _inserted(nodes: dict, width: int) -> dict:
    """Nodes after up to two inserts."""
    out = dict(nodes)
    layer = nodes
    for _ in range(2):
        after: dict = {}
        for q, to, cost, letter in INSERTS:
            if q in layer:
                weight, n = layer[q]
                _least(after, to, (weight + (cost << 3 * width) + (DIGIT[letter] << 3 * (width - 1 - n)), n + 1))
        for kind, found in after.items():
            _least(out, kind, found)
        layer = after
    return out


def _through(codes: str, kind: int) -> tuple[int, dict]:
    """(width, best (weight, letters) per kind after ``codes``) from ``kind``."""
    width = 3 * len(codes) + 2
    nodes = {kind: (0, 0)}
    for c in codes:
        before = _inserted(nodes, width)
        nodes = {}
        for q, to, cost, letter in EDGES[c]:
            if q in before:
                weight, n = before[q]
                _least(nodes, to, (weight + (cost << 3 * width) + (DIGIT[letter] << 3 * (width - 1 - n)), n + 1))
    return width, nodes


def solve(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of rows ``codes``."""
    width = 3 * len(codes) + 2
    nodes, seen = {START: (0, 0)}, {}
    for at in range(0, len(codes), PART):
        part = codes[at:at + PART]
        if part not in seen:
            seen[part] = [_through(part, q) for q in KINDS]
        after: dict = {}
        for q, (weight, n) in nodes.items():
            w, ends = seen[part][q]
            for to, (more, m) in ends.items():
                cost, letters = more >> 3 * w, more & ((1 << 3 * w) - 1)
                edge = (cost << 3 * width) + (letters >> 3 * (w - m) << 3 * (width - n - m))
                _least(after, to, (weight + edge, n + m))
        nodes = after
    ends = _inserted(nodes, width)
    weight, n = min(ends[q] for q in (START, ASSISTANT) if q in ends)
    digits = format(weight & ((1 << 3 * width) - 1), "o").zfill(width)[:n]
    return weight >> 3 * width, digits.translate(str.maketrans("1234", "DIKR"))


def plan(codes: str, audit: str) -> list[str]:
    """What happens at each row, and at the end: initials of the turns inserted
    before it, then K, D, or U or A for a new role."""
    out, now, kind, at = [], "", START, 0
    for letter in audit:
        nxt = ASSISTANT if kind == USER else USER
        if letter == "I":
            now, kind = now + " sua"[nxt], nxt
            continue
        if letter == "D":
            now += "D"
        elif letter == "K":
            now, kind = now + "K", {"s": SYSTEM, "u": USER, "a": ASSISTANT}[codes[at].lower()]
        else:
            now, kind = now + ("A" if nxt == ASSISTANT else "U"), nxt
        out.append(now)
        now, at = "", at + 1
    return [*out, now]


def illegal(initials: str) -> int:
    """Neighbouring role initials other than su, ua and au."""
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


def _decide(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, tuple] = {}
    for rows in parts:
        out = []
        for key, sections, codes in zip(rows["_key"], rows["sections"], rows["codes"]):
            whole = "".join(codes)
            if whole not in known:
                if len(known) > 20_000:
                    known.clear()
                cost, audit = solve(whole)
                known[whole] = (cost, audit, plan(whole, audit), illegal(whole.lower().translate(str.maketrans("0123", LETTERS))))
            cost, audit, edits, wrong = known[whole]
            at = 0
            for k, (section, own) in enumerate(zip(sections, codes)):
                last = k == len(codes) - 1
                mine = edits[at:at + len(own) + last]
                at += len(own)
                out.append((key, section, ",".join(mine), wrong if k == 0 else 0, cost if k == 0 else 0,
                            audit if k == 0 else None))
            if len(out) >= 5_000:
                yield pd.DataFrame(out, columns=PLAN_COLUMNS)
                out = []
        yield pd.DataFrame(out, columns=PLAN_COLUMNS)


PLAN_COLUMNS = ["_key", "_section", "plan", "illegal", "cost", "audit"]


def _rows(conversations: DataFrame) -> DataFrame:
    """The four columns read, with a key that is never null."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    turn = F.col("turn").cast("long")
    rows = conversations.select(F.col("conv_id").alias("_conv"), turn.alias("_turn"), role.alias("_role"), text.alias("_text"))
    return rows.select(
        "*", F.coalesce(F.concat(F.lit("="), F.col("_conv").cast("string")), F.lit("")).alias("_key"),
        F.coalesce(F.floor(F.col("_turn") / SECTION), F.lit(-(1 << 62))).cast("long").alias("_section"),
        F.xxhash64("_role", "_text").alias("_h1"), F.xxhash64(F.lit(1), "_role", "_text").alias("_h2"))


def _letter() -> Column:
    """A row's letter, from its role and text (whether it repeats comes later)."""
    initial = F.left("_role", F.lit(1))
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    end = F.right(F.rtrim("_text", F.lit(BLANKS)), F.lit(1))
    return (F.when(end == "", F.translate(kind, LETTERS, "0123"))
             .when(~end.isin(".", "!", "?"), F.upper(kind)).otherwise(kind))


def decisions(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per conversation: faults and gaps; per section: plan, and at the first
    section of a conversation the illegal pairs, the cost and the audit)."""
    rows = _rows(conversations)
    same = Window.partitionBy("_key", "_h1", "_h2").orderBy(F.col("_turn").asc_nulls_first())
    # texts stay behind: a row goes on as its hash and its letter
    narrow = rows.select("_key", "_conv", "_section", "_turn", "_h1", "_h2", _letter().alias("_code"))
    narrow = narrow.withColumn("_again", F.row_number().over(same) > 1)
    code, to_delete = F.col("_code"), F.translate(F.lower("_code"), LETTERS, "0123")
    fault = F.when(code.rlike("[0-9]"), 0).when(F.col("_again"), 1).when(code.rlike("[A-Z]"), 2)
    narrow = narrow.withColumns({"_fault": fault, "_code": F.when(F.col("_again"), to_delete).otherwise(code)})
    def of(k: int) -> Column:
        return F.count(F.when(F.col("_fault") == k, 1))
    per = narrow.groupBy(*KEY).agg(
        F.first("_conv").alias("_conv"), of(0).alias("blank"), of(1).alias("duplicate"), of(2).alias("truncated"),
        F.min("_turn").alias("_low"), F.max("_turn").alias("_high"), F.size(F.collect_set("_turn")).alias("_turns"),
        F.sort_array(F.collect_list(F.struct("_turn", "_h1", "_h2", "_again", "_code"))).alias("_in"))
    per = per.withColumn("_codes", F.array_join("_in._code", "")).drop("_in")
    whole = per.groupBy("_key").agg(
        F.first("_conv").alias("conv_id"),
        F.coalesce(F.max("_high") - F.min("_low") + 1 - F.sum("_turns"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        F.sort_array(F.collect_list(F.struct("_section", "_codes"))).alias("_in"))
    whole = saved(whole)                      # letters only: what follows reads no text again
    told = whole.select("_key", F.col("_in._section").alias("sections"), F.col("_in._codes").alias("codes"))
    plans = saved(told.mapInPandas(
        _decide, "_key string, _section long, plan string, illegal long, cost long, audit string"))
    return whole.drop("_in"), plans


def repaired(conversations: DataFrame, plans: DataFrame) -> DataFrame:
    """Repaired turns: (_key, _section, turns), turns an array of (role, text,
    edit) in order, edit the initial of what was done.  Deleted rows are absent."""
    rows = _rows(conversations)
    own = rows.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct("_turn", "_h1", "_h2", "_role", "_text"))).alias("_in"))
    def turn(role, text, edit: str) -> Column:
        return F.struct(role.alias("role"), text.alias("text"), F.lit(edit).alias("edit"))
    def at(p: Column, i: Column) -> Column:
        row, last = F.get("_in", i), F.right(p, F.lit(1))
        new = F.transform(F.regexp_extract_all(p, F.lit("[ua]"), F.lit(0)),
                          lambda r: turn(F.when(r == "u", "user").otherwise("assistant"), F.lit(""), "I"))
        done = (F.when(last == "K", F.array(turn(row["_role"], row["_text"], "K")))
                 .when(last == "U", F.array(turn(F.lit("user"), row["_text"], "R")))
                 .when(last == "A", F.array(turn(F.lit("assistant"), row["_text"], "R")))
                 .otherwise(F.slice(F.array(turn(F.lit(""), F.lit(""), "D")), 1, 0)))
        return F.concat(new, done)
    return (own.join(plans.select(*KEY, "plan"), KEY)
               .select(*KEY, F.flatten(F.transform(F.split("plan", ","), at)).alias("turns")))


def report(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit and repaired (its turns as ``role:text``, one a line)."""
    whole, plans = decisions(conversations)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    pieces = repaired(conversations, plans).where(F.size("turns") > 0).select(*KEY, lines.alias("_piece"))
    texts = pieces.groupBy("_key").agg(F.array_join(
        F.sort_array(F.collect_list(F.struct("_section", "_piece")))["_piece"], "\n").alias("repaired"))
    sums = plans.groupBy("_key").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.max("audit").alias("audit"))
    return (whole.join(sums, "_key").join(texts, "_key", "left")
                 .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                         F.coalesce("repaired", F.lit("")).alias("repaired")))
