"""Personal data: patterns, and information-theoretic sanitisation [native].

Base spans are the matches of four kinds (email, ip, card, phone), leftmost and
not overlapping per kind, those that fail their check dropped.  Spans are
places in code points, from 0, end exclusive: the text around the matches
(``split``) gives their places.

The protected entities are the values found.  The corpus estimates how strongly
a term (a word of any length; in scripts without spaces each two neighbouring
characters) reveals an entity in whose document it stands, at any distance.
With N, n(e), n(t) and n(e, t) distinct texts, all four counted over whole texts,
P(e) = n(e) / N and q a cautious estimate of P(e|t), the disclosure is the share
of the entity's information that the term gives away,

    disclosure = KL(q || P(e)) / ln(1 / P(e)), 0 where q <= P(e).

It is near q for a rare entity, whatever N is.  q is the higher of two bounds:

* the lower end of Wilson's interval of n(e, t) among n(t) (``Z`` deviations):
  one text tells little, as each rare word of a text stands in no other; three
  texts that share a value and a word tell more than the threshold;
* (n(b, t) + P(e)) / (n(t) + 1), where n(b, t) counts texts in which t stands
  beside the value (its start within ``REACH`` code points of it) and one more
  text, in which e is as likely as anywhere, stands for what the corpus has not
  shown: that a rare word stands just there by chance is unlikely, so one text does.

At ``threshold`` or more the term is a span in the texts that hold that entity,
outside base spans: of kind ``general`` (it is replaced by its class), or of kind
``remove`` at ``certain`` or more.  Documents without an entity get none.  An
entity that every text holds carries no information and reveals nothing.  The
kind of a value is not protected: its class is published.

Disclosure is never above q, so terms that could not reach the threshold if
the most frequent entity stood wherever they do go before anything is paired,
and pairs that could not before they are counted; that loses none.  Entities of the same texts are one class: a list of addresses
is paired with a text's terms once.  Terms beside values are met by cells of
``REACH`` code points.  Counts are combined map-side; of texts without an entity
only the words are shuffled.

Cases: null and empty texts have no spans; rows equal in text count as one
document and each gets its result; null doc_id is an id like another;
overlapping spans are all reported, and in ``sanitise`` the one that starts
first (then listed first) is replaced and the rest of the others goes; no rows give no rows;
extra columns pass through ``sanitise``.

The patterns are those of the contract with possessive quantifiers and a guard
on where a match may start (where the text before could not have been part of
it); they find the same matches, without backtracking on long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CLUE = {"email": "@", "phone": "+", "ip": ".", "card": ""}       # without it there is no match
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
LETTER = r"[[\p{L}\p{M}]&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]]"
WORD = rf"(?<![\p{{N}}]|{LETTER}){LETTER}++(?!\p{{N}})"
# neighbouring characters from the first on, and from the second on
PAIRS = (rf"{UNSPACED}{{2}}|(?<!{UNSPACED}){UNSPACED}(?!{UNSPACED})", rf"(?<={UNSPACED}){UNSPACED}{{2}}")
TEXT = ["_t", "_th"]
SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"
REACH = 40          # code points
Z = 1.64            # deviations of the lower bound: one-sided 95 %
SALT = 8            # a term's occurrences meet its counts in so many parts


def places(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of all matches in a text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + F.length(x["value"])).alias("at"),
        F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + x["gap"]).alias("start"),
            (acc["at"] + x["gap"] + F.length(x["value"])).alias("end"), x["value"].alias("value")))).alias("out"))
    pairs = F.transform(found, lambda v, i: F.struct(F.get(gaps, i).alias("gap"), v.alias("value")))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\.", -1), lambda p: (
            F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.right(F.concat(F.lit("0"), p), F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """All base spans of a text, by kind as listed, then start."""
    none = F.expr(f"cast(array() as {SPAN})")

    def of(k: int, kind: str) -> Column:
        found = F.filter(places(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
        found = F.transform(found, lambda s: F.struct(
            F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        clue = F.contains(text, F.lit(CLUE[kind])) if CLUE[kind] else text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")
        return F.when(clue, found).otherwise(none)

    return F.when(text.isNull(), none).otherwise(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)]))


def written(spans: Column, names: tuple[str, ...]) -> Column:
    """kind:start:end, joined by commas."""
    names_ = F.array(*map(F.lit, names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names_, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


ALL = KINDS + ("general", "remove")


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("_t"), F.hash(text).alias("_th")]


def _words(text: Column) -> Column:
    """The distinct terms of a text."""
    of = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.array_distinct(F.transform(
        F.when(text.rlike(UNSPACED), F.concat(of(WORD), *map(of, PAIRS))).otherwise(of(WORD)), F.lower))


def _places(texts: DataFrame) -> DataFrame:
    """One row per place of a term.  A running sum gives the places: a text may
    have as many terms as it likes."""
    text = F.col("text")
    run = lambda k, p: F.struct(
        F.lit(k).alias("k"), F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("value"),
        F.transform(F.split(text, p, -1), F.length).alias("gap"))
    runs = [run(k, p) for k, p in enumerate((WORD, *PAIRS))]
    t = texts.select(*TEXT, F.explode(F.when(text.rlike(UNSPACED), F.array(*runs)).otherwise(F.array(runs[0]))).alias("r"))
    t = t.select(*TEXT, "r.k", F.posexplode(F.arrays_zip("r.value", "r.gap")).alias("i", "x"))
    n = F.length("x.value")
    end = F.sum(F.col("x.gap") + n).over(Window.partitionBy(*TEXT, "k").orderBy("i"))
    return (t.where("x.value is not null").withColumn("end", end.cast("int"))
             .select(*TEXT, F.lower("x.value").alias("term"), (F.col("end") - n).alias("start"), "end"))


def wilson(k: Column, n: Column) -> Column:
    """Lower end of Wilson's interval of a share k / n."""
    share, z2 = k / n, Z * Z
    spread = Z * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))
    return (share + z2 / (2 * n) - spread) / (1 + z2 / n)


def disclosure(q: Column, p: Column) -> Column:
    """Share of the information ln(1 / p) that raising p to q gives away."""
    told = q * F.log(q / p) + (1 - q) * F.log((1 - q) / F.nullif(1 - p, F.lit(0.0)))
    return F.when((q > p) & (p < 1), told / F.nullif(-F.log(p), F.lit(0.0))).otherwise(F.lit(0.0))


def _beside(places: DataFrame, spans: DataFrame) -> DataFrame:
    """(text, class, term) where the term starts within ``REACH`` code points of
    a value of the class.  A value is filed in the cells it reaches, so a text
    of many values and words pairs neighbours alone."""
    cell = lambda at: F.floor(at / REACH).cast("int")
    reach = spans.select(*TEXT, "class", "start", "end", F.explode(F.sequence(
        cell(F.col("start") - REACH), cell(F.col("end") + REACH))).alias("cell"))
    at = places.select(*TEXT, "term", F.col("start").alias("at"), cell(F.col("start")).alias("cell"))
    return (at.join(reach, [*TEXT, "cell"]).where("at between start - {0} and end + {0}".format(REACH))
              .select(*TEXT, "class", "term").distinct())


def find(docs: DataFrame, threshold: float = 1 / 3, certain: float = 0.8) -> DataFrame:
    """doc_id, _th (hash of the text), base and spans for every row of ``docs``."""
    d = docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    d = d.select("_id", *_keys(F.col("text")), "text", base_spans(F.col("text")).alias("base"))
    base = saved(d.withColumn("text", F.when(F.size("base") > 0, F.col("text"))))
    held = base.where(F.size("base") > 0)
    once = saved(held.dropDuplicates(TEXT).drop("_id"))
    total = F.lit(float(base.select(*TEXT).distinct().count()))
    values = once.select(*TEXT, F.explode("base").alias("s")).select(
        *TEXT, F.xxhash64("s.kind", "s.value").alias("entity"), "s.start", "s.end")
    # entities that stand in the same texts are one class
    own = values.select(*TEXT, "entity").distinct().groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_e"), *[F.sum(F.xxhash64(F.lit(k), *TEXT).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)])
    own = own.select("entity", "n_e", F.xxhash64("n_e", "s1", "s2").alias("class"))
    spans = saved(values.join(own, "entity").select(*TEXT, "class", "n_e", "start", "end"))
    classes = spans.select(*TEXT, "class", "n_e").distinct()
    most = spans.agg(F.max("n_e")).scalar()
    # equal texts are one; their words, not the texts, are shuffled
    words = docs.select(F.col("text").cast("string").alias("text"))
    words = words.select(*_keys(F.col("text")), _words(F.col("text")).alias("words")).dropDuplicates(TEXT)
    terms = once.select(*TEXT, F.explode(_words(F.col("text"))).alias("term"))
    words = (words.select(F.explode("words").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
                  .join(terms.select("term").distinct(), "term").where((F.col("n_t") + 1) * threshold <= most + 1))
    # written before it is repeated: the shuffles of all words end here
    words = saved(words).withColumn("salt", F.explode(F.array(*map(F.lit, range(SALT)))))
    terms = terms.withColumn("salt", F.pmod(F.col("_th"), F.lit(SALT)).cast("int"))
    seen = saved(terms.join(words, ["term", "salt"]).drop("salt"))
    places = saved(_places(once).join(seen, [*TEXT, "term"]))
    # a term beside a value in one text may stand far from it in another
    of = classes.drop("n_e")
    beside = (_beside(places, spans).join(seen, [*TEXT, "term"]).join(classes, [*TEXT, "class"])
              .where((F.col("n_t") + 1) * threshold <= F.col("n_e") + 1).select(*TEXT, "class", "term"))
    beside = saved(beside)
    both = beside.select("class", "term").distinct().join(seen.drop("n_t"), "term").join(of, [*TEXT, "class"])
    flag = lambda pairs, b: pairs.select(*TEXT, "class", "term", F.lit(b).alias("b"))
    # far from a value: only terms and classes that can reach the threshold are paired
    can = lambda n_e: wilson(F.least("n_t", n_e), F.col("n_t")) >= threshold
    top = classes.groupBy(*TEXT).agg(F.max("n_e").alias("top"))
    far = seen.join(top, TEXT).where(can("top")).drop("top").join(classes, TEXT).where(can("n_e"))
    met = saved(flag(beside, 1).union(flag(both, 0)).union(flag(far, 0))
                .groupBy(*TEXT, "class", "term").agg(F.max("b").alias("b")))
    counts = met.groupBy("class", "term").agg(F.count(F.lit(1)).alias("n_et"), F.sum("b").alias("n_bt"))
    counts = (counts.join(classes.select("class", "n_e").distinct(), "class")
                    .join(seen.select("term", "n_t").distinct(), "term"))
    p = F.col("n_e") / total
    q = F.greatest(wilson(F.col("n_et"), F.col("n_t")), (F.col("n_bt") + p) / (F.col("n_t") + 1))
    telling = (counts.withColumn("disclosure", disclosure(q, p)).where(F.col("disclosure") >= threshold)
                     .select("class", "term", (F.lit(len(KINDS)) + (F.col("disclosure") >= certain).cast("int")).alias("kind")))
    # a word that reveals two entities is one span: its stronger kind
    told = met.join(telling, ["class", "term"]).groupBy(*TEXT, "term").agg(F.max("kind").alias("kind"))
    found = (places.join(told, [*TEXT, "term"])
                          .groupBy(*TEXT).agg(F.sort_array(F.collect_list(F.struct(
                              "kind", "start", "end", F.col("term").alias("value")))).alias("terms")))
    none = F.expr(f"cast(array() as {SPAN})")
    outside = F.filter("terms", lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    out = held.join(found, TEXT, "left").select("_id", "_th", "base", F.coalesce(outside, none).alias("terms"))
    out = out.union(base.where(F.size("base") <= 0).select("_id", "_th", "base", none))
    return out.select(F.col("_id").alias("doc_id"), "_th", "base", F.concat("base", "terms").alias("spans"))


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with base values and revealing terms replaced by their class
    (terms of kind ``remove`` by nothing)."""
    found = saved(find(docs, **options).dropDuplicates(["doc_id", "_th"]))
    r = found.select(F.col("doc_id").alias("_rid"), F.col("_th").alias("_rth"),
                     F.sort_array(F.transform("spans", lambda s: F.struct(
                         s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))).alias("_spans"))
    marks = F.array(*[F.lit("" if n == "remove" else f"[{n.upper()}]") for n in ALL])
    # the row travels in one struct, so its columns' names clash with nothing
    d = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.hash("text").alias("_h"))
    d = d.join(r, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_h") == F.col("_rth")), "left")
    text = F.col("_row")["text"].cast("string")
    done = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                     F.get(marks, s["kind"])).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = F.when(text.isNull() | (F.size("_spans") <= 0), F.col("_row")["text"]).otherwise(done)
    return d.select(*[new.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])
