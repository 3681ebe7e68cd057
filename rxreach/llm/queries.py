"""Registered queries of the ten operators, and their SQL where SQL can say it.

Each query applies its operator to its whole table and derives the digest
columns of its contract from what the operator returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, embeddings, html, linededup, mixing, pii, repair, search, simhash, substrings, tokens, toxicity
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the benchmark items found in it, and the smallest distance."""
    found = decontam.with_items(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.transform("items", lambda x: x["item_id"]).alias("item_ids"),
                        F.array_min(F.transform("items", lambda x: x["distance"])).alias("min_distance"),
                        (F.size("items") > 0).alias("contaminated"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "rejected")


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.main_text(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.removed_words(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.with_tokens(docs, tokens.load()).select("doc_id", "n_tokens")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    def of(k: int):
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
                        F.sha2(pii.written(F.col("base"), pii.ALL).cast("binary"), 256).alias("base_sha256"),
                        pii.written(F.col("spans"), pii.ALL).alias("spans"))


def op10_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those removed, and a hash of the text that stays (null: null)."""
    found = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed",
                        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that quotes control strings, read back from the formatted windows."""
    quoting = spark.sql("""SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'),
                           (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)""")
    rows = table(spark, sf_dir, "conversations").select(*quoting.columns).union(quoting)
    found = chat.windows(rows, budget=512, history=128, history_turns=2)
    whole = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("section", "span", "formatted", "n_repeated", "loss"))).alias("w"))
    turns = F.flatten(F.transform("w", lambda w: chat.read_back(w["formatted"], w["n_repeated"])))
    loss = F.array_join(F.flatten(F.transform("w", lambda w: chat.targets(w["formatted"], w["loss"]))), "")
    whole = whole.select("conv_id", turns.alias("turns"), loss.alias("learnt"), F.aggregate(
        F.transform("w.formatted", F.length), F.lit(0).cast("long"), lambda a, n: a + n).alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the damage of op13's contract (nulls: one space)."""
    said = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    hit = F.crc32(F.concat(said["conv_id"], F.lit(":"), said["turn"])) % 20
    text = F.when(hit == 1, "").when(hit == 2, F.translate(said["text"], ".!?", "")).otherwise(said["text"])
    times = F.when(hit == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return conversations.where(hit != 0).select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(said["role"]).alias("role"),
        text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = repair.report(damaged(rows)).withColumnRenamed("conv_id", "_id")
    ids = rows.select("conv_id").distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return ids.join(found, ids["conv_id"].eqNullSafe(found["_id"]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("repaired", F.lit("")).cast("binary"), 256).alias("repaired_sha256"))


def queries() -> dict:
    return {f.__name__: f for f in (
        op1_mixing, op2_simhash, op3_embedding, op4_decontamination, op5_toxicity,
        op6_html, op7_substring, op8_tokens, op9_pii, op10_linededup, op11_search, op12_chat, op13_repair)}


OP1 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 3))::INTEGER AS bucket
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight,
             3 * source_size AS cap FROM s),
-- the water level is the largest at which no more than the total is held
levels AS (SELECT a.cap / a.weight AS ratio FROM w a),
held AS (SELECT ratio, (SELECT sum(source_size) FROM w) AS total,
                (SELECT coalesce(sum(cap), 0) FROM w WHERE cap / weight <= ratio)::BIGINT AS full_,
                (SELECT coalesce(sum(weight), 0) FROM w WHERE cap / weight > ratio)::BIGINT AS left_
         FROM (SELECT -1.0::DOUBLE AS ratio UNION SELECT ratio FROM levels)),
-- the last ratio below the level: all sources up to it are full
water AS (SELECT (total - full_)::DOUBLE / left_ AS level, ratio FROM held
          WHERE left_ > 0 AND (total - full_)::DOUBLE / left_ >= ratio ORDER BY ratio DESC LIMIT 1),
goal AS (SELECT source, source_size, CASE WHEN (SELECT count(*) FROM water) = 0 THEN cap::DOUBLE
                ELSE least(cap::DOUBLE, (SELECT level FROM water) * weight) END AS target FROM w),
plan AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goal),
b AS (SELECT source, bucket, sum(size)::BIGINT AS words,
             sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket)::BIGINT AS upto FROM d GROUP BY source, bucket),
cut AS (SELECT p.source, b.bucket, b.words, b.upto, p.target - p.whole * p.source_size AS more
        FROM plan p JOIN b ON p.source IS NOT DISTINCT FROM b.source
        WHERE b.upto > p.target - p.whole * p.source_size
        QUALIFY row_number() OVER (PARTITION BY p.source ORDER BY b.bucket) = 1)
SELECT d.doc_id, d.size, p.source_size, p.target,
       p.whole * d.size + CASE WHEN d.bucket < coalesce(c.bucket, 4096) THEN d.size
         WHEN d.bucket = c.bucket THEN floor((c.more - c.upto + c.words) / c.words * d.size + 0.5)::BIGINT
         ELSE 0 END AS taken
FROM d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN cut c ON d.source IS NOT DISTINCT FROM c.source
"""

OP3 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0
         AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links,
       (SELECT min(b) FROM reach r WHERE r.a = v.vec_id) AS component_id,
       v.vec_id = (SELECT min(b) FROM reach r WHERE r.a = v.vec_id) AS kept
FROM v
"""

OP7 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
gone AS (SELECT doc_id, s FROM (
           SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS k FROM win) WHERE k > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
covered AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + 20)) AS p FROM gone)),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS t, count(*) AS n
         FROM words x ANTI JOIN covered c ON x.doc_id = c.doc_id AND x.p = c.p GROUP BY x.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP10 = r"""
WITH RECURSIVE l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(0, len(string_split(text, chr(10))))) AS p FROM documents WHERE text IS NOT NULL),
f AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS full_ FROM l),
c AS (SELECT line, length(line) AS n, min({'d': doc_id, 'p': p}) AS at, regexp_extract_all(line, '(?s).') AS x,
             row_number() OVER (ORDER BY line) AS id FROM f WHERE full_ GROUP BY line),
-- segment i of a line of m code points, t edits allowed, looked for up to t places off in lines up to t longer
g AS (SELECT c.*, m, t, i, s, i * (m // (t + 1)) + greatest(0, i - (t + 1 - m % (t + 1))) + s AS p0,
             m // (t + 1) + CASE WHEN i >= t + 1 - m % (t + 1) THEN 1 ELSE 0 END AS w
      FROM (SELECT c.*, n - d AS m, (n - d >= 16)::INT + (n - d >= 64)::INT + (n - d >= 256)::INT AS t, d
            FROM c, range(0, 4) AS r(d)) AS c, range(0, 4) AS ri(i), range(-3, 4) AS rs(s)
      WHERE t > 0 AND d <= t AND i <= t AND abs(s) <= t),
k AS (SELECT id, n, m, t, i, s, substr(line, p0 + 1, w) AS seg FROM g WHERE p0 >= 0 AND p0 + w <= n),
met AS (SELECT DISTINCT a.id AS a, b.id AS b, a.t FROM k a JOIN k b USING (m, i, seg)
        WHERE a.n = m AND a.s = 0 AND a.id <> b.id AND (b.n > a.n OR b.id > a.id)),
-- code points read of both lines after e edits, with all that is equal from there on
walk(a, b, t, e, i, j) AS (
  SELECT a, b, t, 0, q, q FROM (SELECT met.*, coalesce(nullif(list_position(
      list_transform(range(1, least(ca.n, cb.n) + 1), lambda z: ca.x[z] = cb.x[z]), false), 0) - 1, least(ca.n, cb.n)) AS q
    FROM met JOIN c ca ON ca.id = met.a JOIN c cb ON cb.id = met.b) AS met
  UNION
  SELECT a, b, t, e + 1, i + q, j + q FROM (
    SELECT w.a, w.b, w.t, w.e, w.i + o.di AS i, w.j + o.dj AS j, coalesce(nullif(list_position(
      list_transform(range(1, least(ca.n - w.i - o.di, cb.n - w.j - o.dj) + 1),
                     lambda z: ca.x[w.i + o.di + z] = cb.x[w.j + o.dj + z]), false), 0) - 1,
      least(ca.n - w.i - o.di, cb.n - w.j - o.dj)) AS q
    FROM walk w JOIN c ca ON ca.id = w.a JOIN c cb ON cb.id = w.b, (VALUES (1, 1), (1, 0), (0, 1)) AS o(di, dj)
    WHERE w.e < w.t AND w.i + o.di <= ca.n AND w.j + o.dj <= cb.n)),
near AS (SELECT CASE WHEN ca.at > cb.at THEN ca.line ELSE cb.line END AS line
         FROM walk JOIN c ca ON ca.id = a JOIN c cb ON cb.id = b WHERE i = ca.n AND j = cb.n),
stay AS (SELECT c.at.d AS doc_id, c.at.p AS p FROM c ANTI JOIN near ON c.line = near.line),
kept AS (SELECT f.doc_id, count(*) AS n, string_agg(f.line, chr(10) ORDER BY f.p) AS t
         FROM f LEFT JOIN stay ON f.doc_id = stay.doc_id AND f.p = stay.p
         WHERE NOT full_ OR stay.p IS NOT NULL GROUP BY f.doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
       (coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(kept.t, '')) END AS kept_sha256
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


OP11 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
q AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)),
qt AS (SELECT i, item_id, t, count(*) AS times FROM q GROUP BY i, item_id, t),
n AS (SELECT count(*) FILTER (len(w) > 0)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
tf AS (SELECT r, doc_id, t, n, count(*) AS tf FROM (SELECT r, doc_id, unnest(w) AS t, len(w) AS n FROM d)
       WHERE t IN (SELECT t FROM qt) GROUP BY r, doc_id, t, n),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
wt AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, n),
g AS (SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)) AS part FROM tf, n),
s AS (SELECT i, item_id, r, doc_id, sum(times * w * part)::BIGINT AS score
      FROM g JOIN qt USING (t) JOIN wt USING (t) GROUP BY i, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 20
"""

# windows as chat.windows draws them, for turns numbered under 1,024
OP12 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS k,
             length('[ROLE]' || role || '[/ROLE]' || text || '</s>')
               + len(regexp_extract_all(role || chr(10) || text, '<\\*/?s>|\[\\*/?(?:ROLE|INST|SYS)\]')) AS chars FROM t),
h AS (SELECT conv_id, arg_min(p, p) AS p, arg_min(k, p) AS k, arg_min(chars, p) AS chars FROM o WHERE role = 'system' GROUP BY conv_id),
e AS (SELECT o.*, sum(o.k) OVER (PARTITION BY o.conv_id ORDER BY o.p) AS upto,
             greatest(512 - 128 - coalesce(h.k, 0), 128) AS room, h.p AS hp, h.chars AS hchars
      FROM o LEFT JOIN h ON o.conv_id IS NOT DISTINCT FROM h.conv_id),
i AS (SELECT *, (upto - 1) // room AS into_, (upto - k) // room AS from_ FROM e),
j AS (SELECT *, 2 * into_ + CASE WHEN sum(k) OVER (PARTITION BY conv_id, into_) > room AND from_ < into_ THEN 0 ELSE 1 END AS span FROM i),
s AS (SELECT conv_id, span, min(p) AS first_, min(upto - k) AS before_, 3 + sum(chars) AS chars, any_value(hp) AS hp, any_value(hchars) AS hchars
      FROM j GROUP BY conv_id, span),
f AS (SELECT s.conv_id, s.span, any_value(s.chars) + coalesce(sum(j.chars), 0) + CASE WHEN any_value(s.hp) < any_value(s.first_) THEN any_value(s.hchars) ELSE 0 END AS chars
      FROM s LEFT JOIN j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.p IN (s.first_ - 1, s.first_ - 2)
        AND j.role <> 'system' AND s.before_ - (j.upto - j.k) <= 128 GROUP BY s.conv_id, s.span),
g AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM f GROUP BY conv_id)
SELECT o.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
       any_value(g.formatted_chars) AS formatted_chars
FROM o JOIN g ON o.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY o.conv_id
"""


def _paid(v: str, cost: str, letter: str) -> str:
    """A path's text (cost in nine digits, then its audit) after one more edit."""
    return f"lpad((left({v}, 9)::BIGINT + {cost})::VARCHAR, 9, '0') || substr({v}, 10) || '{letter}'"


def _any(letter: str, cost: str, *kinds: int) -> str:
    return "least(" + ", ".join(_paid(f"a.s{q}", cost, letter) for q in kinds) + ", NULL)"


# the least text per last kind written (s0 none, s1 system, s2 user, s3 assistant), edit after edit;
# 'i' stands for a place where a turn may be inserted
OP13 = rf"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hit AS (SELECT *, xor(4294967295, list_reduce(list_transform(string_split(k, ''), lambda c: ord(c)::BIGINT),
          lambda crc, b: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(crc, b)),
          4294967295::BIGINT)) % 20 AS h FROM src),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit WHERE h <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS p FROM d),
f AS (SELECT *, left(role, 1) AS ini, left(lag(role) OVER (PARTITION BY conv_id ORDER BY p), 1) || left(role, 1) AS pair,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (p > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
             list(CASE WHEN fault IN ('blank', 'duplicate') THEN '0' WHEN ini NOT IN ('s', 'u', 'a') THEN CASE fault WHEN '' THEN 'x' ELSE 'X' END
                  WHEN fault = '' THEN ini ELSE upper(ini) END ORDER BY p) AS codes,
             list(role ORDER BY p) AS roles, list(text ORDER BY p) AS texts FROM f GROUP BY conv_id),
best AS (SELECT *, list_reduce(list_concat(flatten(list_transform(codes, lambda x: ['i', 'i', x])), ['i', 'i']), lambda a, x:
    CASE WHEN x = 'i' THEN {{'s0': a.s0, 's1': a.s1, 's2': least(a.s2, {_any('I', '5', 0, 1, 3)}), 's3': least(a.s3, {_any('I', '5', 2)})}}
    ELSE {{'s0': {_paid('a.s0', '2', 'D')},
      's1': least({_paid('a.s1', '2', 'D')}, CASE WHEN lower(x) = 's' THEN {_any('K', "(x = 'S')::INT * 5", 0)} END),
      's2': least({_paid('a.s2', '2', 'D')}, CASE WHEN x <> '0' THEN {_any('R', "(x <> lower(x))::INT * 5 + 1", 0, 1, 3)} END,
                  CASE WHEN lower(x) = 'u' THEN {_any('K', "(x = 'U')::INT * 5", 0, 1, 3)} END),
      's3': least({_paid('a.s3', '2', 'D')}, CASE WHEN x <> '0' THEN {_any('R', "(x <> lower(x))::INT * 5 + 1", 2)} END,
                  CASE WHEN lower(x) = 'a' THEN {_any('K', "(x = 'A')::INT * 5", 2)} END)}} END,
    {{'s0': '000000000', 's1': NULL::VARCHAR, 's2': NULL::VARCHAR, 's3': NULL::VARCHAR}}) AS b FROM c),
told AS (SELECT *, left(least(b.s0, b.s3), 9)::BIGINT AS cost, substr(least(b.s0, b.s3), 10) AS audit FROM best),
done AS (SELECT *, list_reduce(string_split(audit, ''), lambda a, e:
    CASE e WHEN 'D' THEN {{'i': a.i + 1, 'q': a.q, 't': a.t}}
      WHEN 'K' THEN {{'i': a.i + 1, 'q': left(roles[a.i], 1), 't': list_append(a.t, roles[a.i] || ':' || texts[a.i])}}
      WHEN 'R' THEN {{'i': a.i + 1, 'q': CASE a.q WHEN 'u' THEN 'a' ELSE 'u' END,
                     't': list_append(a.t, CASE a.q WHEN 'u' THEN 'assistant:' ELSE 'user:' END || texts[a.i])}}
      WHEN 'I' THEN {{'i': a.i, 'q': CASE a.q WHEN 'u' THEN 'a' ELSE 'u' END,
                     't': list_append(a.t, CASE a.q WHEN 'u' THEN 'assistant:' ELSE 'user:' END)}}
      ELSE a END, {{'i': 1, 'q': '', 't': []::VARCHAR[]}}).t AS lines FROM told)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN done ON i.conv_id IS NOT DISTINCT FROM done.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": OP1, "op3_embedding": OP3, "op7_substring": OP7, "op10_linededup": OP10, "op11_search": OP11, "op12_chat": OP12,
            "op13_repair": OP13}
