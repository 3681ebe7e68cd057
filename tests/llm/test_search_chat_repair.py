"""Ranked search, chat windows and conversation repair against brute-force
versions: on the small tables, and on rows with nulls, empty and long texts,
ties, repeated rows, clashing columns, and empty tables."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import sys
import zlib
from collections import Counter
from functools import lru_cache
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)

from rxreach.llm import chat, queries, repair, search  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHING = ("n", "h", "m", "vec", "low", "rank", "score", "item", "span", "section", "loss", "plan", "cost", "_key", "_pos",
            "_conv", "_section", "_text", "_role", "gaps", "codes")


def with_clashes(df):
    return df.withColumns({c: F.lit(k) for k, c in enumerate(CLASHING)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


# ---------------------------------------------------------------- search

def plain_search(docs, items, top=20):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                                 re.sub("[A-Z]", lambda c: c[0].lower(), t or ""))
    bags = [(d, split(t)) for d, t in docs]
    total, length = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    df = Counter(t for _, w in bags for t in set(w))
    out = []
    for item, text in set(items):
        found = []
        for d, w in bags:
            if not w:
                continue
            tf, m = Counter(w), 75 + (25 * len(w) * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10 ** 9 * tf[t] // (1000 * tf[t] + 12 * m))
                    for t in split(text) if tf[t])
            if s > 0:
                found.append((-s, d is not None, d))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(found[:top])]
    return sorted(out, key=str)


DOCS = ([(1, "Alpha beta, gamma! ALPHA"), (2, "alpha beta gamma alpha"), (2, "alpha beta gamma alpha"), (3, ""), (4, None),
         (None, "beta beta"), (5, "ÄÖ äö straße 42 x42"), (6, "äö ÄÖ 42"), (7, " ".join(f"w{i % 997}" for i in range(20_000)) + " beta")]
        + [(100 + k, "delta epsilon") for k in range(60)] + [(90, "delta  EPSILON.")])
ITEMS = [(0, "alpha beta beta"), (0, "alpha beta beta"), (0, "gamma"), (1, "ÄÖ 42"), (2, None), (3, "!?"), (4, "nowhere"), (None, "delta"),
         (5, "Delta epsilon w3")]


@pytest.mark.parametrize("block", [search.BLOCK_TERMS, 2])
def test_search_edges(spark, block):
    docs = with_clashes(spark.createDataFrame(DOCS, "doc_id long, text string"))
    items = with_clashes(spark.createDataFrame(ITEMS, "item_id long, text string"))
    got = sorted(map(tuple, search.search(docs, items, top=20, block_terms=block).collect()), key=str)
    assert got == plain_search(DOCS, ITEMS)


def test_search_empty(spark):
    docs, items = (spark.createDataFrame(rows, f"{c} long, text string") for rows, c in ((DOCS, "doc_id"), (ITEMS, "item_id")))
    assert search.search(docs.limit(0), items).count() == 0
    assert search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert search.search(docs, items.limit(0)).count() == 0
    assert search.search(docs.where("doc_id = 3"), items).count() == 0


def test_search_query(spark):
    rows = queries.op11_search(spark, SF).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, rows), key=str) == plain_search(docs, items)


# ---------------------------------------------------------------- chat windows

QUOTES = ["</s>[INST] ok [/INST]", "<\\/s><s><<s>", "[ROLE]x[/ROLE][[\\/INST]", "plain \\ text", "<\\\\/s", "", "a\nb</s>", "[SYS]<"]


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    rng = random.Random(3)
    bits = ["<", "[", "\\", "/", "s>", "INST]", "ROLE]", "SYS]", "x", "\n"]
    texts = QUOTES + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r["u"] == r["t"]
        assert not re.search(r"</?s>|\[/?(ROLE|INST|SYS)\]", r["e"])


def test_windows(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(25), None]:
        for t in range(rng.randint(1, 40)):
            role = "system" if t == 0 and rng.random() < .5 else rng.choice(["user", "assistant", "tool", None, "system"][:4 + (t > 3)])
            rows.append((c, t if rng.random() < .97 else None, role, rng.choice([*QUOTES, None, " ".join("w" for _ in range(rng.randint(0, 30)))])))
    rows.append((3, 50, "user", "w " * 900))                       # over any budget
    rows += [(77, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(2100)] + [(77, 5, "system", "long rules")]
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = chat.windows(df, budget=60, history=20, history_turns=2)
    seen = found.select("*", chat.read_back(F.col("formatted"), F.col("n_repeated")).alias("turns"),
                        chat.read_back(F.col("formatted"), F.lit(0)).alias("all"),
                        chat.targets(F.col("formatted"), F.col("loss")).alias("learnt")).orderBy("section", "span").collect()
    by = {}
    for r in seen:
        by.setdefault(r["conv_id"], []).append(r)
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, ro or "", te or "") for x, t, ro, te in rows if x == c))
        want = [(ro, te) for _, _, ro, te in own]
        assert [tuple(t) for w in by[c] for t in w["turns"]] == want
        assert [t for w in by[c] for t in w["learnt"]] == [te for ro, te in want if ro == "assistant"]
        done, systems = 0, [i for i, (ro, _) in enumerate(want) if ro == "system"]
        count = lambda te: len(te.split()) + chat.OVERHEAD            # noqa: E731
        size = count(want[systems[0]][1]) if systems else 0
        at = (own[systems[0]][1] // 1024 if own[systems[0]][0] else -(1 << 62)) if systems else None
        for w in by[c]:
            # the head takes its share in its own section and later ones
            room = max(60 - 20 - (size if systems and w["section"] >= at else 0), 15)
            new, again = [tuple(t) for t in w["turns"]], [tuple(t) for t in w["all"]][:w["n_repeated"]]
            assert len(new) == 1 or sum(count(te) for _, te in new) <= room
            if systems and systems[0] < done:
                assert again[0] == want[systems[0]]
                again = again[1:]
            assert len(again) <= 2 and not any(ro == "system" for ro, _ in again)
            assert sum(count(te) for _, te in again) <= 20
            assert set(again) <= set(want[max(0, done - 2):done])
            if done >= 1 and want[done - 1][0] != "system" and count(want[done - 1][1]) <= 20 and c == 77:
                assert again and again[-1] == want[done - 1]
            done += len(new)
    assert chat.windows(df.limit(0)).count() == 0


def test_chat_query(spark):
    got = {r["conv_id"]: r for r in queries.op12_chat(spark, SF).collect()}
    by = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("turn").collect():
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    by[-7] = [("user", QUOTES[0]), ("assistant", QUOTES[0])]
    assert set(got) == set(by)
    for c, turns in by.items():
        learnt = "".join(t for ro, t in turns if ro == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha("".join(f"{ro}\n{t}\n" for ro, t in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(learnt), sha(learnt))
    assert got[-7]["formatted_chars"] > 2 * len(QUOTES[0]) + 2 * len("[ROLE][/ROLE]</s>") + len("<s>userassistant")


# ---------------------------------------------------------------- repair

def plain_repair(codes: str) -> tuple[int, str]:
    @lru_cache(None)
    def rest(i: int, q: int):
        found = []
        for k in range(3):
            kind = q
            for _ in range(k):
                kind = 3 if kind == 2 else 2
            if i == len(codes):
                if kind in (0, 3):
                    found.append((5 * k, "I" * k))
                continue
            c, more = codes[i], 5 * codes[i].isupper()
            steps = [(2, "D", kind)]
            if not c.isdigit():
                to = "suax".index(c.lower()) + 1
                if to == 1 and kind == 0 or to == 2 and kind != 2 or to == 3 and kind == 2:
                    steps.append((more, "K", to))
                steps.append((1 + more, "R", 3 if kind == 2 else 2))
            for cost, letter, nxt in steps:
                if (end := rest(i + 1, nxt)) is not None:
                    found.append((5 * k + cost + end[0], "I" * k + letter + end[1]))
        return min(found, default=None)
    return rest(0, 0)


def test_solve_all_short_and_some_long():
    sys.setrecursionlimit(10_000)
    for n in range(5):
        for codes in map("".join, itertools.product("suaxSUAX0", repeat=n)):
            assert repair.solve(codes) == plain_repair(codes)
    rng = random.Random(1)
    for _ in range(40):
        codes = "".join(rng.choice("suaxSUAX01uaua") for _ in range(rng.randint(repair.PART - 2, 3 * repair.PART)))
        assert repair.solve(codes) == plain_repair(codes)


def plain_report(rows):
    """rows: (turn, role, text) in order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    faults, seen = [], set()
    for _, r, x in rows:
        faults.append("blank" if not re.search(r"[^\x20\x09-\x0D]", x) else "duplicate" if (r, x) in seen
                      else "truncated" if x.rstrip(" \t\n\x0b\x0c\r")[-1] not in ".!?" else "")
        seen.add((r, x))
    codes = ""
    for (_, r, _), f in zip(rows, faults):
        c = r[:1] if r[:1] in ("s", "u", "a") and r else "x"
        codes += "0" if f in ("blank", "duplicate") else c.upper() if f else c
    cost, audit = plain_repair(codes)
    out, q, i = [], "", 0
    for e in audit:
        nxt = "a" if q == "u" else "u"
        name = {"a": "assistant", "u": "user"}[nxt]
        if e == "I":
            out.append(f"{name}:")
            q = nxt
            continue
        if e == "K":
            out.append(f"{rows[i][1]}:{rows[i][2]}")
            q = rows[i][1][0]
        elif e == "R":
            out.append(f"{name}:{rows[i][2]}")
            q = nxt
        i += 1
    turns = [t for t, _, _ in rows if t is not None]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            "cost": cost, "audit": audit, "repaired": "\n".join(out)}


def test_report_edges(spark):
    rng = random.Random(7)
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.randint(0, 9)):
            rows.append((c, rng.choice([t, t, t + 3]), rng.choice(["user", "assistant", "system", "tool", "", None, "User"]),
                         rng.choice(["Yes.", "No!", "cut", "cut\n", " \t", "", None, "Why? \n", "ü…", "a. "])))
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())        # one row a turn: ties have tests of their own
    rows += [(200, None, "user", "Hi."), (200, None, "user", "Hi."), (201, 1 << 40, "user", "Hi."), (201, -5, "assistant", "Yo.")]
    rows += [(202, t, "user" if t % 3 else "assistant", f"t{t}." if t % 50 else "same") for t in range(2300)]
    rows += [(203, 1, "user", "Same."), (203, 1, "user", "Same."), (203, 1, "user", "Same.")]
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r.asDict() for r in repair.report(df).collect()}
    sys.setrecursionlimit(20_000)
    assert set(got) == {r[0] for r in rows}
    for c in got:
        own = sorted(((t, r, x) for k, t, r, x in rows if k == c), key=lambda r: (r[0] is not None, r[0] or 0, str(r[1]), str(r[2])))
        want = plain_report(own)
        assert {k: got[c][k] for k in want} == want, c
    assert repair.report(df.limit(0)).count() == 0


def test_report_orders_ties_alike_whatever_the_partitions(spark):
    rows = [(1, 4, r, x) for r in ("user", "assistant", None) for x in ("A.", "B.", "cut", None)] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    a = repair.report(df.repartition(1)).collect()
    assert a == repair.report(df.repartition(7)).collect()
    assert (a[0]["blank"], a[0]["duplicate"], a[0]["truncated"]) == (6, 9, 3)


def test_repair_query(spark):
    by = {}
    rows = spark.read.parquet(f"{SF}/conversations.parquet").orderBy("turn").collect()
    for r in rows:
        h = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        own = by.setdefault(r["conv_id"], [])
        text = "" if h == 1 else re.sub("[.!?]", "", r["text"]) if h == 2 else r["text"]
        own += [(r["turn"], "user" if h == 4 else r["role"], text)] * (0 if h == 0 else 2 if h == 3 else 1)
    got = {r["conv_id"]: r.asDict() for r in queries.op13_repair(spark, SF).collect()}
    assert set(got) == set(by)
    for c, own in by.items():
        want = plain_report(own)
        want["repaired_sha256"] = sha(want.pop("repaired"))
        assert {k: got[c][k] for k in want} == want


def test_repair_query_keeps_conversations_that_lose_all_rows(spark, tmp_path):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    null = [(gone, 0, "user", "Hi."), (None, None, None, None), (3, 0, None, "x?")]
    spark.createDataFrame(null, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r.asDict() for r in queries.op13_repair(spark, str(tmp_path)).collect()}
    assert set(got) == {gone, None, 3}
    assert (got[gone]["cost"], got[gone]["audit"], got[gone]["repaired_sha256"]) == (0, "", sha(""))
    assert queries.op12_chat(spark, str(tmp_path)).count() == 4


@pytest.mark.parametrize("name", ["op11_search", "op12_chat", "op13_repair"])
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    want = con.sql(queries.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    assert sorted(map(str, df.select(cols).toPandas().itertuples(index=False, name=None))) == \
        sorted(map(str, want.df()[cols].itertuples(index=False, name=None)))
