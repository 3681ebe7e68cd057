"""Chat formatting into budgeted windows [native].

Turns of a conversation are written as ``[ROLE]role[/ROLE]text</s>`` after a
``<s>``, in windows of at most ``budget`` tokens.  Prefix sums of turn tokens
choose which turns are new in a window: with ``room`` tokens a window (what
the budget leaves beside the system turn and the history), turns that end in
the same multiple of ``room`` belong together; where that would exceed the
room, the one turn that reaches over from the multiple before stands alone.
Each later window first repeats the conversation's first system turn, then up
to ``history_turns`` turns that precede its new ones, while they hold no more
than ``history`` tokens.  The loss mask covers the texts of new assistant
turns; repeated ones are masked out, so each target is learnt once.

Control strings inside texts and roles get a backslash after their first
character (``<\\/s>``); where backslashes stand there already they get one more,
so ``unescaped`` restores every text.

No conversation has to fit one task: turns are dealt by (conversation, section
of 1,024 turn numbers), and windows end where a section ends.  The last turns
of a section, and the system turn, are handed to the next one for its history.
Texts are shuffled once.

Cases: a null text or role is empty; a null conv_id is one conversation; a null
turn comes first; rows equal in turn are ordered by role and text; a turn over
the budget is a window of its own, whole (``n_tokens`` then exceeds the budget);
a system turn that leaves less than a quarter of the budget leaves a quarter;
system turns are never repeated as history; no rows give no rows; only conv_id,
turn, role and text are read, so other columns clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

SECTION = 1024
BEGIN, ROLE, BODY, END = "<s>", "[ROLE]", "[/ROLE]", "</s>"
OVERHEAD = 4                 # tokens of a turn's marks
#: control strings: those above, and the instruction and system marks of chat templates
_AFTER = (r"(?<=<){0}(?=\\*/?s>)", r"(?<=\[){0}(?=\\*/?(?:ROLE|INST|SYS)\])")
KEY = ["_key", "_section"]


def escaped(c: Column) -> Column:
    return F.regexp_replace(c, "|".join(x.format("") for x in _AFTER), r"\\")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, "|".join(x.format(r"\\") for x in _AFTER), "")


def words(text: Column) -> Column:
    """Tokens of a text, unless the caller counts them otherwise."""
    return F.regexp_count(text, F.lit(WORD))


def _rows(conversations: DataFrame, tokens) -> DataFrame:
    turn = F.col("turn").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").alias("_conv"), turn.alias("_turn"), role.alias("_role"), text.alias("_text"))
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("_conv").cast("string")), F.lit("")).alias("_key"),
        F.coalesce(F.floor(F.col("_turn") / SECTION), F.lit(-(1 << 62))).cast("long").alias("_section"),
        "*", (tokens(F.col("_text")) + OVERHEAD).cast("long").alias("_tokens"), F.lit("new").alias("_as"))


def _handed_on(rows: DataFrame, history_turns: int) -> DataFrame:
    """Rows of one section that another one of the conversation needs too."""
    ends = rows.where((F.pmod("_turn", F.lit(SECTION)) >= SECTION - history_turns) & (F.col("_role") != "system"))
    ends = ends.withColumns({"_section": F.col("_section") + 1, "_as": F.lit("history")})
    sections = rows.groupBy(*KEY).agg(F.lit(1).alias("_one")).drop("_one")
    long = sections.groupBy("_key").agg(F.min("_section").alias("_low"), F.max("_section").alias("_high")).where("_low < _high")
    # conversations of one section (nearly all) end here
    later = sections.join(long.select("_key"), "_key").withColumnRenamed("_section", "_to")
    heads = rows.where(F.col("_role") == "system").join(long.select("_key"), "_key", "left_semi")
    first = heads.groupBy("_key").agg(F.min(F.struct("_section", "_turn", "_text")).alias("_at"),
                                      F.first("_conv").alias("_conv"), F.min_by("_tokens", F.struct("_section", "_turn", "_text")).alias("_tokens"))
    heads = first.join(later, "_key").where("_to > _at._section").select(
        "_key", F.col("_to").alias("_section"), "_conv", "_at._turn", F.lit("system").alias("_role"),
        "_at._text", "_tokens", F.lit("head").alias("_as"))
    return ends.unionByName(heads)


def windows(conversations: DataFrame, budget: int = 512, history: int = 128, history_turns: int = 2,
            tokens=words) -> DataFrame:
    """One row per window: conv_id, section, span (windows of a conversation in
    order), formatted, n_tokens, n_repeated (leading turns that are repeated)
    and loss (array of (start, end), code points of ``formatted``)."""
    rows = _rows(conversations, tokens)
    rows = rows.unionByName(_handed_on(rows, history_turns))
    own = Window.partitionBy(*KEY)
    order = own.orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text", "_as")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new, system = F.col("_as") == "new", F.col("_role") == "system"
    rows = rows.select(
        "*", F.row_number().over(order).alias("_pos"),
        F.sum(F.when(new, F.col("_tokens")).otherwise(0)).over(upto).alias("_end"),
        F.sum("_tokens").over(upto).alias("_all"),
        (system & (F.sum(system.cast("int")).over(upto) == 1)).alias("_head"))
    left = budget - history - F.coalesce(F.max(F.when(F.col("_head"), F.col("_tokens"))).over(own), F.lit(0))
    rows = rows.withColumn("_room", F.greatest(left, F.lit(budget // 4)))
    into = F.when(new, F.expr("(_end - 1) div _room"))
    rows = rows.withColumn("_into", into).withColumn(
        "_sum", F.sum("_tokens").over(Window.partitionBy(*KEY, "_into")))
    alone = (F.col("_sum") > F.col("_room")) & (F.expr("(_end - _tokens) div _room") < F.col("_into"))
    rows = rows.withColumn("_span", 2 * F.col("_into") + F.when(alone, 0).otherwise(1))
    # history rows stand before new ones, so a span's first row is the first with its number
    start = F.col("_span").isNotNull() & ~F.coalesce(F.lag("_span").over(order) == F.col("_span"), F.lit(False))
    rows = rows.withColumn("_start", F.when(start, F.struct("_span", (F.col("_all") - F.col("_tokens")).alias("before"))))
    def place(span: Column, again: bool) -> Column:
        return F.struct(span.alias("span"), F.lit(again).alias("again"))
    def repeats(k: int) -> Column:
        at = F.lead("_start", k).over(order)
        fits = at["before"] - (F.col("_all") - F.col("_tokens")) <= history
        return F.when(~system & at.isNotNull() & fits, place(at["_span"], True))
    # a head that was handed on waits in a span before all others
    mine = F.when(F.col("_as") == "head", place(F.lit(-1).cast("long"), True)).when(new, place(F.col("_span"), False))
    rows = rows.withColumn("_places", F.array(mine, *[repeats(k) for k in range(1, history_turns + 1)]))
    rows = rows.select(*KEY, "_conv", "_pos", "_role", "_text", "_tokens", "_head",
                       F.explode(F.array_compact("_places")).alias("_place"))
    head = F.concat(F.lit(ROLE), escaped(F.col("_role")), F.lit(BODY))
    body = escaped(F.col("_text"))
    turn = F.struct("_pos", F.concat(head, body, F.lit(END)).alias("written"), F.length(head).alias("from"),
                    (F.length(head) + F.length(body)).alias("to"), "_tokens", F.col("_place.again").alias("again"),
                    (~F.col("_place.again") & (F.col("_role") == "assistant")).alias("learn"))
    spans = rows.groupBy(*KEY, F.col("_place.span").alias("_span")).agg(
        F.first("_conv").alias("conv_id"), F.sort_array(F.collect_list(turn)).alias("_turns"),
        F.max(F.when(F.col("_head"), F.struct("_pos", turn.alias("turn"))))["turn"].alias("_system"))
    before = own.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_system", F.first("_system", ignorenulls=True).over(before)).where("_span >= 0")
    kept = F.when(F.col("_system").isNull(), F.col("_turns")).otherwise(
        F.concat(F.array(F.col("_system").withField("again", F.lit(True)).withField("learn", F.lit(False))), "_turns"))
    spans = spans.withColumn("_turns", kept)
    def add(acc: Column, t: Column) -> Column:
        masked = F.array(F.struct((acc["at"] + t["from"]).alias("start"), (acc["at"] + t["to"]).alias("end")))
        return F.struct((acc["at"] + F.length(t["written"])).alias("at"),
                        F.when(t["learn"], F.concat(acc["loss"], masked)).otherwise(acc["loss"]).alias("loss"))
    zero = F.struct(F.lit(len(BEGIN)).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("loss"))
    return spans.select(
        "conv_id", F.col("_section").alias("section"), F.col("_span").alias("span"),
        F.concat(F.lit(BEGIN), F.array_join("_turns.written", "")).alias("formatted"),
        F.aggregate("_turns._tokens", F.lit(0).cast("long"), lambda a, t: a + t).alias("n_tokens"),
        F.size(F.filter("_turns.again", lambda t: t)).alias("n_repeated"),
        F.aggregate("_turns", zero, add)["loss"].alias("loss"))


def read_back(formatted: Column, n_repeated: Column) -> Column:
    """New turns of a window, from its text alone: array of (role, text)."""
    pieces = F.split(F.substring(formatted, F.lit(len(BEGIN) + 1), F.length(formatted)), END, -1)
    new = F.slice(pieces, n_repeated + 1, F.size(pieces) - 1 - n_repeated)
    def turn(x: Column) -> Column:
        at = F.instr(x, BODY)
        return F.struct(unescaped(F.substring(x, F.lit(len(ROLE) + 1), at - len(ROLE) - 1)).alias("role"),
                        unescaped(F.substring(x, at + len(BODY), F.length(x))).alias("text"))
    return F.transform(new, turn)


def targets(formatted: Column, loss: Column) -> Column:
    """Texts under the loss mask of a window."""
    return F.transform(loss, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
