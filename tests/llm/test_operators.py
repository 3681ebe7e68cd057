"""Each operator against a brute-force version, on the small tables and on rows
with nulls, empty and long texts, ties, repeated rows, clashing columns, and
empty tables."""

from __future__ import annotations

import math
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)

from rxreach.llm import (decontam, embeddings, html, linededup, mixing, pii, queries, simhash,  # noqa: E402
                         substrings, tokens, toxicity)

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE = [
    (1, "alpha beta gamma delta epsilon zeta eta theta\nsecond line of some length here", "en", "a", 10),
    (2, "alpha beta gamma delta epsilon zeta eta theta\nsecond line of some length hero", "en", "a", 10),
    (2, "alpha beta gamma delta epsilon zeta eta theta\nsecond line of some length hero", "en", "a", 10),
    (3, "", "en", "b", 0), (4, None, None, None, None), (None, "text without an id of its own", "de", "", 5),
    (5, LONG, "fr", "b", len(LONG)), (6, " \t\n ", "es", None, 4),
    (7, "mail a.b@c.example.org or 10.0.0.256 and 10.0.0.25, +49 (89) 1234-567, 4111 1111 1111 1111", "en", "c", 9),
]
CLASHING = ("n", "h", "score", "rejected", "size", "kept", "n_lines", "class", "line", "_id", "_th", "_n", "_row", "_spans")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, COLUMNS).withColumns(
        {c: F.lit(k) for k, c in enumerate(CLASHING)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_mixing(docs, edge, empty):
    rows = mixing.mix(docs).collect()
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
        assert r["taken"] <= 3 * r["size"]
    for own in by.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= len(own)
        assert own[0]["target"] <= 3 * own[0]["source_size"] + 1e-6
    # water-filling by repeated clamping
    names = sorted(by)
    size = {s: by[s][0]["source_size"] for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, full = float(sum(size.values())), set()
    while True:
        left = total - sum(3 * size[s] for s in full)
        goal = {s: 3 * size[s] if s in full else left * weight[s] / sum(weight[x] for x in names if x not in full)
                for s in names}
        over = {s for s in names if s not in full and goal[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    assert all(abs(goal[s] - by[s][0]["target"]) < 1e-6 * total for s in names)
    assert {r["doc_id"]: r["size"] for r in mixing.mix(edge).collect()}[4] == 0
    assert mixing.mix(edge).count() == len(EDGE) and mixing.mix(empty).count() == 0


def plain_components(items, near):
    parent = list(range(len(items)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(items)):
        for j in near(i):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(items))]


def test_simhash(docs, edge, empty):
    got = simhash.near_duplicates(docs).toPandas().sort_values("doc_id", ignore_index=True)
    fp = got["fp"].to_numpy().view(np.uint64)
    root = plain_components(fp, lambda i: np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 2))
    ids = got["doc_id"].tolist()
    low = {r: min(i for i, x in zip(ids, root) if x == r) for r in set(root)}
    assert [low[r] for r in root] == got["component_id"].tolist()
    rows = {(r["doc_id"], r["_th"]): r for r in simhash.near_duplicates(edge).collect()}
    assert {r["component_id"] for r in rows.values() if r["doc_id"] in (3, 4, 6)} == {3}   # no words: zero
    assert simhash.near_duplicates(edge).count() == len(EDGE)
    assert simhash.one_of_each(edge).where("doc_id = 2").count() <= 1
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_simhash_cells():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(1), base ^ np.uint64(0b101), base ^ np.uint64(7 << 40)]))
    root = plain_components(fps, lambda i: np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2))
    stars = dict((m, r) for r, m in simhash._cell_stars(fps, 2))
    assert [stars.get(i, i) for i in range(len(fps))] == root
    group = np.zeros(12, int)
    links = {(int(a), int(b)) for x, y in simhash._shifted(fps[:12], group, 2) for a, b in zip(x, y)}
    assert links == {(i, j) for i in range(12) for j in range(i + 1, 12) if int(fps[i] ^ fps[j]).bit_count() <= 2}


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((60, 32))
    x = np.concatenate([x, x[:30] + 0.02 * rng.standard_normal((30, 32)), x[:5], 3 * x[:3]])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] + [1.0] * 31), (903, [None] + [1.0] * 31),
           (904, [float("inf")] + [1.0] * 31), (905, []), (906, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("k", F.lit(1))
    got = {r["vec_id"]: r for r in embeddings.near_vectors(df).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    root = plain_components(x, lambda i: np.flatnonzero(near[i]))
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (near[i].sum(), root[i])
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i, _ in odd)
    assert embeddings.near_vectors(df.limit(0)).count() == 0
    tile = rng.standard_normal((40, 32))
    tile /= np.linalg.norm(tile, axis=1, keepdims=True)
    assert (embeddings.linked(tile, tile, 0.3) == (np.einsum("ik,jk->ij", tile, tile) >= 0.3)).all()


def edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min(row)


def test_decontamination(spark, edge, empty):
    rng = np.random.default_rng(2)
    for _ in range(60):
        p = "".join(rng.choice(list("abc"), 30))
        t = "".join(rng.choice(list("abc"), 50))
        d = edits(p, t)
        assert decontam.myers(p, t, 40) == d and (decontam.myers(p, t, d - 1) is None)
    item = "The quick brown fox jumps over the lazy dog near the quiet river bank at noon today"
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short"), (5, item)], "item_id long, text string")
    texts = [f"xx {item} yy", f"a {item.replace('quick', 'quack').replace(' lazy', '  LAZY')} b",
             "a " + item[:20] + "zzzzzzzzzz" + item[40:], "nothing here", None, "", LONG + " " + item]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("item_id", F.lit(9))
    got = {r["doc_id"]: [tuple(x) for x in r["items"]] for r in decontam.with_items(df, bench).collect()}
    assert got == {0: [(1, 0), (5, 0)], 1: [(1, 1), (5, 1)], 2: [], 3: [], 4: [], 5: [], 6: [(1, 0), (5, 0)]}
    assert sorted(r["doc_id"] for r in decontam.decontaminate(df, bench).collect()) == [2, 3, 4, 5]
    assert decontam.decontaminate(edge, bench.limit(0)).count() == len(EDGE)
    assert decontam.decontaminate(empty, bench).count() == 0


def test_decontamination_of_short_and_unnamed_items(spark, monkeypatch):
    long = "The quick brown fox jumps over the lazy dog near the quiet river bank at noon today"
    items = [(1, "Pi is 3.14"), (None, "a null id of an item that is long enough"), (None, None), (3, " \t"), (4, "数学の問題"),
             (5, long), (6, "pi is 3.14"), (None, "pi is")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["xx PI  is\n3.14.", "pi is 3.141", "epi is 3.14", "here a null id of an item that is long enough!",
             "これは数学の問題です", f"a {long.replace('quick', 'quack')} b", "pi was 3.14", "", None, "pi is"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("_ITEMS", F.lit("mine"))

    def brute(text, item):
        t, p = decontam.normal(text), decontam.normal(item)
        if not p:
            return None
        if len(p) >= 25:
            return decontam.myers(p, t, int(0.06 * len(p)))
        at = [i for i in range(len(t) - len(p) + 1) if t.startswith(p, i)]
        edge = lambda a, b: bool(a and b and (a + b).isalnum() and a + b < "\u0e00")
        return 0 if any(not edge(t[i - 1:i], p[0]) and not edge(p[-1], t[i + len(p):i + len(p) + 1]) for i in at) else None

    want = {k: sorted(((i, d) for i, p in items if (d := brute(t, p)) is not None), key=str) for k, t in enumerate(texts)}
    assert want[0] and want[3] and want[4] and want[5] and want[1] == [(None, 0)] and not want[2] and not want[6]
    for size in (decontam.BLOCK_CHARS, 30):                    # all items in one block; nearly one block each
        monkeypatch.setattr(decontam, "BLOCK_CHARS", size)
        got = {r["doc_id"]: sorted((tuple(x) for x in r["items"]), key=str) for r in decontam.with_items(df, bench).collect()}
        assert got == want
    clean = decontam.decontaminate(df, bench)
    assert clean.columns == df.columns and {(r["doc_id"], r["_ITEMS"]) for r in clean.collect()} == {(k, "mine") for k, w in want.items() if not w}


def test_toxicity(spark, edge, empty):
    rng = np.random.default_rng(4)
    words = [f"{a}{b}n" for a in "bcdfgl" for b in "aeiou"]
    rows = [(i, " ".join(rng.choice(words, 60)) + (" vilify scumbag" if i % 4 == 0 else ""), "en", int(i % 4 == 0))
            for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    labels = df.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (99999, 0), (3, None)], "a long, b int"))
    model = toxicity.fit(df.drop("toxic"), labels.where(~toxicity.held_out()), epochs=3)
    out = toxicity.score(df, model).where(toxicity.held_out()).collect()
    assert sum(r["predicted"] == r["toxic"] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(edge, model).collect())
    assert toxicity.score(edge, model).count() == len(EDGE) and toxicity.score(empty, model).count() == 0
    assert toxicity.fit(empty, labels.limit(0)) is None
    # rows that repeat an id reach the driver once
    once, thrice = [toxicity.fit(d, labels, epochs=1) for d in (df.drop("toxic"), df.union(df).union(df).drop("toxic"))]
    assert np.array_equal(once.emb, thrice.emb)
    assert not toxicity.score(edge, None).where("rejected").count()


def test_html(spark):
    page = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=x>Home</a></nav>"
            "<div class='ad'>Buy the best of the things</div><article><h1>A &amp; B&nbsp;c</h1><p>One <b>two<br>three</p>"
            "<div class='comments'><p>First!</p></div><p>Four\n five</article><footer>&copy; x</footer>")
    plain = ("<div><a href=a>menu</a> <a href=b>more</a></div><p>" + "This is the story of a man and his dog in the town. " * 4
             + "</p><p>Short one.</p><p>" + "It was on the way to the house that they met with him again. " * 3
             + "</p><div><a href=z>next page of links</a></div>")
    assert html.extract(page) == "A & B c\n\nOne two three\n\nFour five"
    assert "\n\nShort one.\n\nIt was" in html.extract(plain) and "menu" not in html.extract(plain)
    for odd in (None, "", "<", "<!-- never closed <p>x", "<script>x", "<p", "a < b", "<p>" * 5000):
        assert isinstance(html.extract(odd), str)
    df = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string").withColumn("n_chars", F.lit(0))
    assert [r["text"] for r in html.main_text(df).orderBy("page_id").collect()] == [html.extract(page), ""]


def test_html_keeps_articles_in_odd_containers():
    prose = "This is the story of a man and his dog in the town that they came to on the way. " * 4
    body = f"<p>{prose}</p><p>{prose}</p>"
    for page in (f"<html><head><title>t</title><body>{body}", f"<html><head><title>t</title>{body}",
                 f"<body><nav><a href=x>Home</a><div>{body}</div>",
                 f"<body><nav><a href=x>Home</a><div>{body}</div><NAV><a href=y>More</a></NAV>",
                 *(f"<body><div class='{c}'>{body}</div>" for c in ("content no-sidebar", "has-comments", "with-social", "social"))):
        assert html.extract(page).count("story") == 8, page[:60]
    assert "Buy" not in html.extract(f"<body><div class='no-sidebar ad'>Buy it now</div>{body}")


def test_html_drops_no_article_text():
    prose = "This is the story of a man and his dog in the town that they came to on the way. " * 4
    body = f"<p>{prose}</p>"
    japanese = "これは長い文章です。犬と猫が川のそばを歩いていました。とても静かな夜でした。" * 4
    portuguese = "Ontem à noite vimos um cão muito grande perto daquela ponte velha onde moramos felizes juntos. " * 3
    links = "<p>See <a>the report of the group on the matter</a> and <a>the other one that was on it</a> for more.</p>"
    for page, words in (
            (f"<article><h2><a href=x>Big title here</a></h2>{body}</article>", "Big title here"),
            (f"<body><h1><a href=x>Big title here</a></h1>{body}", "Big title here"),
            (f"<article>{body}{links}{body}</article>", "See the report of the group on the matter and the other"),
            (f"<body>{body}<p>The end came.</p><footer>Imprint</footer>", "The end came."),
            (f"<body><div>{body}<p>The end came.</p></div><div class=footer>Imprint</div>", "The end came."),
            (f"<body><p>{japanese}</p><p>{japanese}</p><footer>Imprint</footer>", japanese),
            (f"<body><nav><a>x</a></nav><p>{portuguese}</p>", portuguese.strip()),
            (f"<body><article><a href=x>Read more of this</a></article><div>{body}{body}</div>", prose.strip()),
            (f"<body><article><h3>Other</h3><p>{prose[:100]}</p></article><div>{body}{body}</div>", prose.strip()),
            (f"<body><div class='story-tags-body'><p>{prose[:160]}</p></div>{body}", prose[:160].strip())):
        assert words in html.extract(page), page[:80]
        assert "Imprint" not in html.extract(page)
    for name in ("article-tags", "post-share", "related-posts", "comment-body", "sidebar2", "tags"):
        assert "Dogs" not in html.extract(f"<body><div class={name}><p>Dogs of the town</p></div>{body}"), name
    assert "Dogs" not in html.extract(f"<body><article><p>Short.</p><p>Shorter.</p></article><div>Dogs of the town</div>")
    whole = "".join(f"<p>{prose} number {i}</p>" for i in range(3000))           # a long page keeps all of its blocks
    assert html.extract(f"<body><article>{whole}</article>").count("\n\n") == 2999


def test_html_second_pass_against_brute_force():
    rng = np.random.default_rng(11)
    for _ in range(400):
        marked = bool(rng.integers(2))
        page = []
        for _ in range(rng.integers(1, 12)):
            b = html.Block("x" * int(rng.choice([10, 100])), 0, bool(rng.integers(2)), int(rng.choice([0, 0, 0, 2])), False)
            b.label = False if b.out else [None, True, False][rng.integers(3)]
            page.append(b)
        want = []
        for i, b in enumerate(page):
            near = [[c.label for c in side if c.label is not None and not c.out][:1] for side in (page[i::-1], page[i:])]
            if b.label is not None:
                want.append(b.label)
            elif near[0] and near[1] and near[0] != near[1]:
                want.append(near[1][0] if b.heading else len(b.text) >= html.SHORT or marked)
            else:
                want.append((near[0] + near[1] + [marked])[0])
        html._second_pass(page, marked)
        assert [b.label for b in page] == want


def test_substrings(docs, edge, empty, spark):
    def brute(rows):
        seen, out = set(), {}
        for i, t in sorted(rows):
            w = (t or "").encode().split()
            cover = [False] * len(w)
            for s in range(len(w) - 19):
                k = tuple(w[s:s + 20])
                if k in seen:
                    cover[s:s + 20] = [True] * 20
                seen.add(k)
            out[i] = (len(w), sum(cover), b" ".join(x for x, c in zip(w, cover) if not c))
        return out
    passage = " ".join(f"p{i}" for i in range(60))
    more = [(10_000 + i, f"head{i} " + " ".join(passage.split()[i:i + 30]) + f" tail{i} " + "A " * 50) for i in range(20)]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "a long, b string"))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], bytes(r["kept"])) for r in substrings.removed_words(df).collect()}
    assert got == brute(rows)
    found = substrings.removed_words(edge).collect()
    assert len(found) == len(EDGE) and substrings.removed_words(empty).count() == 0
    assert {r["n_removed"] for r in found if r["doc_id"] != 5} == {0}


def test_tokens(spark, docs, edge, empty):
    lib = pytest.importorskip("tokenizers")
    import sentencepiece
    v = tokens.load()
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.VOCABULARY)
    t = lib.Tokenizer(lib.models.Unigram([(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())],
                                         sp.unk_id(), byte_fallback=True))
    t.normalizer = lib.normalizers.Sequence([lib.normalizers.Prepend("▁"), lib.normalizers.Replace(" ", "▁")])
    for df in (docs, edge):
        for r in tokens.with_tokens(df, v).select("text", "n_tokens").collect():
            assert r["n_tokens"] == (len(t.encode(r["text"], add_special_tokens=False).ids) if r["text"] else 0)
    c = tokens.Counter(v)
    for text in ("日本語 😀\n\nx", "  a   b ", "Straße éé"):
        assert c.count(text) == len(t.encode(text, add_special_tokens=False).ids)
        assert c.viterbi("▁" + text.replace(" ", "▁")) == c.count(text)
    assert tokens.with_tokens(empty, v).count() == 0


def luhn(digits):
    return not sum(int(c) if k % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for k, c in enumerate(reversed(digits))) % 10


def base_spans(text):
    digits = lambda v: re.sub("[^0-9]", "", v)
    kinds = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15))
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, text or "") if ok(m.group()))


def test_pii(spark, docs, edge, empty):
    odd = ["a@b.c_d@e.f @x.y a@b", "1.2.3.4.5.6.7.8 0001.2.3.4 1.2.3.999 256.1.1.1", "5" * 3000, "é😀 +1 (2) 345-67890 x",
           "4111-1111-1111-1111 4111 1111 1111 1112", "x" * 50_000 + "@", "+1--2", "a+b@c-d.e-f.g++12345678901"]
    df = docs.select("doc_id", "text").union(edge.select("doc_id", "text")).union(
        spark.createDataFrame([(5000 + i, t) for i, t in enumerate(odd)], "a long, b string"))
    got = pii.find(df).select("doc_id", "_th", pii.written(F.col("base"), pii.ALL).alias("b")).collect()
    want = [(r["doc_id"], r["h"], base_spans(r["text"])) for r in df.select("*", F.hash("text").alias("h")).collect()]
    order = lambda rows: sorted(map(str, map(tuple, rows)))
    assert order(got) == order(want)
    # a word that stands by one address only reveals it; ordinary words don't
    rows = [(i, f"ordinary words around bluebird {'ordinary' if i % 2 else 'words'} me@site.org says hello number{i}")
            for i in range(6)] + [(100 + i, "ordinary words around here says hello again") for i in range(200)]
    out = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)
    assert {text[i][s["start"]:s["end"]] for i in out for s in out[i] if s["kind"] >= 4} == {"bluebird"}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "bluebird" not in clean[1] and "[EMAIL]" in clean[1] and clean[100] == text[100]
    assert pii.find(empty).count() == 0 and pii.sanitise(edge).count() == len(EDGE)


def told(spark, rows, **options):
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    text = dict(rows)
    return {r["doc_id"]: {text[r["doc_id"]][s["start"]:s["end"]] for s in r["spans"] if s["kind"] >= 4} for r in found}


PLAIN = [(1000 + i, f"some ordinary words about the weather of day w{i} and so on") for i in range(300)]


def test_pii_terms_of_any_length_at_any_place(spark):
    far = "ordinary words about the weather " * 20
    rows = [(i, f"Lee {far} write to me@site.org {far} so on {'and ' * i} 王小明") for i in range(1, 7)] + PLAIN
    got = told(spark, rows)
    assert all({"Lee", "王小", "小明"} <= got[i] for i in range(1, 7)), got[1]
    assert all(got[i].isdisjoint({"ordinary", "words", "about", "weather", "so", "and"}) for i in range(1, 7))
    assert not any(got[i] for i, _ in PLAIN)
    out = pii.sanitise(spark.createDataFrame(rows[:6] + PLAIN, "doc_id long, text string")).where("doc_id = 1").first()
    assert not set("王小明") & set(out["text"]) and "Lee" not in out["text"]


def test_pii_needs_no_number_of_documents(spark):
    one = [(1, "some ordinary words by Kowalski of the weather, kim@one.org and so on")]
    want = told(spark, one + PLAIN)[1]
    assert "Kowalski" in want and "ordinary" not in want
    # copies are one document: fifty of them tell no more than one
    copies = [(i, one[0][1]) for i in range(1, 51)]
    got = told(spark, copies + PLAIN)
    assert all(got[i] == want for i in range(1, 51))


def test_pii_counts_rows_once_and_a_value_everywhere_tells_nothing(spark):
    rows = [(i, f"bluebird sings at me@site.org of number n{i}") for i in range(5)]
    got = told(spark, rows + [(2000, "bluebird of day")] * 50 + PLAIN)
    assert "bluebird" in got[0]
    assert told(spark, rows) == {i: set() for i in range(5)}


def brute_terms(rows, threshold=1 / 3, certain=0.8):
    """{doc_id: {term: kind}} by the docstring, all pairs of all texts."""
    held = {i: [(m.group(), m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", t)]
            for i, t in rows}
    terms = {i: [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"(?<!\w)[a-z]+(?!\w)", t, re.I)] for i, t in rows}
    n, out = len(rows), {i: {} for i, _ in rows}
    for e in {v for h in held.values() for v, _, _ in h}:
        of_e = {i for i in held if any(v == e for v, _, _ in held[i])}
        p = len(of_e) / n
        for t in {x for i in of_e for x, _, _ in terms[i]}:
            of_t = {i for i in terms if any(x == t for x, _, _ in terms[i])}
            nt, net = len(of_t), len(of_t & of_e)
            nbt = sum(any(x == t and v == e and b - pii.REACH <= a <= c + pii.REACH for x, a, _ in terms[i] for v, b, c in held[i])
                      for i in of_t)
            z, share = pii.Z, net / nt
            low = (share + z * z / (2 * nt) - z * math.sqrt(share * (1 - share) / nt + z * z / (4 * nt * nt))) / (1 + z * z / nt)
            q = max(low, (nbt + p) / (nt + 1))
            told = 0 if q <= p or p == 1 else (q * math.log(q / p) + (1 - q) * math.log((1 - q) / (1 - p))) / -math.log(p)
            if told >= threshold:
                for i in of_t & of_e:
                    places = [(a, b) for x, a, b in terms[i] if x == t]
                    if any(all(b <= c or d <= a for _, c, d in held[i]) for a, b in places):
                        out[i][t] = max(out[i].get(t, 0), 4 + (told >= certain))
    return out


def test_pii_disclosure_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    share = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(240):
        t = list(rng.choice(words, int(rng.integers(3, 60)), p=share / share.sum()))
        for _ in range(int(rng.integers(0, 3)) if i % 3 == 0 else 0):
            at = int(rng.integers(len(t) + 1))
            t[at:at] = ["z" + "".join(chr(97 + int(d)) for d in str(i)), f"u{int(rng.integers(25))}@site.org"]
        if i % 20 == 0:                 # a name far from a value that recurs
            t = ["Kowalski"] + ["ban"] * 30 + t + ["hot@site.org"]
        rows.append((i, " ".join(map(str, t)) + f" {i}"))
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), certain=0.55).collect()
    got = {r["doc_id"]: {s["value"]: s["kind"] for s in r["spans"] if s["kind"] >= 4} for r in found}
    want = brute_terms(rows, certain=0.55)
    assert got == want and all("kowalski" in want[i] for i in range(0, 240, 20))
    assert {k for w in want.values() for k in w.values()} == {4, 5}


@pytest.mark.parametrize("size", [400, 3200])
def test_pii_finds_planted_names_and_leaves_rare_words(spark, size):
    """Names planted beside one-text values, and names far from values that
    recur; every text has words of its own."""
    rng = np.random.default_rng(size)
    name = lambda i: "Zo" + "".join(chr(97 + int(d)) for d in f"{i:05d}")
    own = lambda i, k: "q" + "".join(chr(97 + int(d)) for d in f"{i:05d}{k:02d}")
    rows, planted = [], {}
    for i in range(size):
        t = [own(i, k) if rng.random() < 0.1 else f"{'abcdefgh'[int(rng.integers(8))]}word" for k in range(100)]
        if i % 20 == 0:
            t[50:50] = ["by", name(i), f"m{i}@one.org"]
            planted[i] = name(i)
        elif i % 20 == 1:
            t = [name(90_000 + i // 100)] + t + [f"g{i // 100}@one.org"]
            planted[i] = name(90_000 + i // 100)
        rows.append((i, " ".join(t)))
    got = told(spark, rows)
    beside = [i for i in planted if i % 20 == 0]
    assert sum(planted[i] in got[i] for i in beside) == len(beside)
    far = [i for i in planted if i % 20 == 1]
    assert sum(planted[i] in got[i] for i in far) >= 0.9 * len(far)
    flagged = sum(len(got[i] - {planted[i]}) for i in planted)
    assert flagged < 0.02 * sum(len(t.split()) for i, t in rows if i in planted), flagged


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def line_dedup_by_hand(rows, edits_from):
    first = {}
    for i, t in rows:
        for j, line in enumerate(t.split("\n") if t else []):
            if line.strip(" \t\n\r\x0b\x0c"):
                first.setdefault(line, (i, j))
    allowed = lambda x, y: sum(min(len(x), len(y)) >= n for n in edits_from)
    gone = {x for x in first for y in first if first[y] < first[x] and abs(len(x) - len(y)) <= allowed(x, y)
            and 0 < allowed(x, y) >= edits(x, y)}
    return gone, {i: None if t is None else "\n".join(
        x for j, x in enumerate(t.split("\n")) if not x.strip() or first[x] == (i, j) and x not in gone) for i, t in rows}


def edited(rng, line, times):
    for _ in range(times):
        k, c = int(rng.integers(0, len(line))), str(rng.choice(list("xyzé\U0001F600")))
        line = str(rng.choice([line[:k] + c + line[k + 1:], line[:k] + line[k + 1:], line[:k] + c + line[k:]]))
    return line


# groups of every size by the first step alone, by pairs, and by two segments
@pytest.mark.parametrize("edits_from, piece, group", [((16,), 3, 32), ((16, 24, 36), 16, 32), ((16, 24, 36), 3, 2),
                                                      ((20, 30), 16, 0)])
def test_line_dedup(spark, edge, empty, edits_from, piece, group, monkeypatch):
    monkeypatch.setattr(linededup, "PIECE", piece)
    monkeypatch.setattr(linededup, "GROUP", group)
    rng = np.random.default_rng(6)
    lines = []
    for n in (15, 18, 22, 25, 29, 34, 38, 44, 60):
        base = "".join(rng.choice(list("abcdé "), n))
        lines += [edited(rng, base, int(rng.integers(0, 5))) for _ in range(14)]
        # a start that many different lines share
        lines += [edited(rng, "a common start, " * 2 + "".join(rng.choice(list("ab"), max(n - 32, 3))), int(rng.integers(0, 3))) for _ in range(8)]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[4 * i:4 * i + 4]) + ("\n\n" if i % 3 else "")) for i in range(len(lines) // 4 + 1)]
    rows += [(500, None), (501, ""), (502, " \n\t")]
    gone, want = line_dedup_by_hand(rows, edits_from)
    assert len(gone) > 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(df, edits_from).collect()}
    assert got == want
    if group == 32:
        assert linededup.dedup_lines(edge).count() == len(EDGE) and linededup.dedup_lines(empty).count() == 0


def test_pieces_that_lines_share(spark):
    """Lines within t edits are always alike; of two segments, some place holds both."""
    rng = np.random.default_rng(9)
    rows = []
    for t in (1, 2, 3):
        for _ in range(120):
            a = "".join(rng.choice(list("abc"), rng.integers(16, 40)))
            b = edited(rng, a, t)
            rows.append((t, *sorted((a, b), key=len)))
    df = spark.createDataFrame(rows, "t int, a string, b string")
    for t in (1, 2, 3):
        assert not df.where(F.col("t") == t).where(~linededup._alike(F.col("a"), F.col("b"), F.lit(t))).count()

    def cut(m, parts, i):
        size, short = m // parts, parts - m % parts
        start = i * size + max(0, i - short)
        return start, start + size + (i >= short)
    for t, a, b in rows:
        for segments in (1, 2):
            if t < segments or len(b) - len(a) > t:
                continue
            def stands(i, s):
                x, y = cut(len(a), t + segments, i)
                return x + s >= 0 and b[x + s:y + s] == a[x:y]
            assert any(stands(i, s) and (segments == 1 or stands(j, u))
                       for i, s, j, u in linededup._places(t, len(b) - len(a), segments)), (t, a, b)


def test_edit_automaton(spark):
    rng = np.random.default_rng(8)
    pairs = [("".join(rng.choice(list("ab"), rng.integers(0, 7))), "".join(rng.choice(list("ab"), rng.integers(0, 7))))
             for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string")
    for k in (1, 2, 3):
        bad = df.where(linededup.within(F.col("a"), F.col("b"), k) != (F.levenshtein("a", "b") <= k)).count()
        assert not bad


def test_queries_equal_their_sql(spark):
    from compare import compare, duck
    con = duck(SF)
    for name, sql in queries.oracle_sql().items():
        ok, message = compare(queries.queries()[name](spark, SF), con, sql)
        assert ok, (name, message)


def test_stages_return_the_columns_they_get(spark, edge):
    import corpus_pipeline as p
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, edge, SF)
        assert out.columns == edge.columns, name
        assert all(r[c] == k for r in out.collect() for k, c in enumerate(CLASHING)), name


def test_pipeline(spark):
    import corpus_pipeline as p
    out = p.run(spark, SF)
    assert 0 < out.count() <= 200
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in p.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).columns == docs.columns
    leaks = [r["doc_id"] for r in queries.op4_decontamination(spark, SF).where("contaminated").collect()]
    assert not {r["doc_id"] for r in out.collect()} & set(leaks)


def test_lines_of_a_group_meet_few_times(spark):
    """Many lines with one beginning, none near another: none is verified."""
    rng = np.random.default_rng(11)
    same = "a long beginning that all of these lines have in common, word by word " * 4
    rows = [(i, same + "".join(rng.choice(list("abcdefghij klmnop"), 90))) for i in range(200)]
    classes = linededup._classes(spark.createDataFrame(rows, "doc_id long, text string"), 16)
    met, _ = linededup._met_by_windows(classes, linededup.EDITS_FROM)
    assert met.where(F.col("n") > linededup.GROUP).count() > 200
    a, b = [met.select("key", F.struct("at", "size", "bag").alias(c)) for c in "ab"]
    pairs = a.join(b, "key").where("a.at < b.at")
    assert pairs.count() > 19000 and not pairs.where(linededup._apart(F.col("a.bag"), F.col("b.bag")) <= 6 + 3).count()


def test_few_rows_a_line(spark):
    """A line files and probes 2, 5 or 8 windows, however many lengths are near."""
    rows = [(i, "".join(np.random.default_rng(i).choice(list("abcdef"), n))) for i, n in enumerate((70, 100, 240, 300, 700))]
    classes = linededup._classes(spark.createDataFrame(rows, "doc_id long, text string"), 16)
    assert linededup._windows(classes, linededup.EDITS_FROM).count() == 3 * 5 + 2 * 8


def test_counts_and_trimming_lose_no_near_line(spark):
    rng = np.random.default_rng(12)
    rows = []
    for t in (1, 2, 3):
        for _ in range(80):
            a = "".join(rng.choice(list("eta in,x"), rng.integers(16, 90)))
            rows.append((t, *sorted((a, edited(rng, a, t)), key=len)))
    df = spark.createDataFrame(rows, "t int, short string, long string")
    a, b = [linededup._counted(df.select("t", F.monotonically_increasing_id().alias("k"), F.col(c).alias("line"))) for c in ("short", "long")]
    both = a.alias("a").join(b.alias("b"), F.col("a.k") == F.col("b.k"))
    far = linededup._apart(F.col("a.bag"), F.col("b.bag")) > 2 * F.col("a.t") + F.col("b.size") - F.col("a.size")
    assert not both.where(far).count()
    cut = linededup._trimmed(df.withColumns({"x": F.col("short"), "y": F.col("long")}))
    assert not cut.where(F.levenshtein("short", "long") != F.levenshtein("x", "y")).count()
    assert cut.where(F.length("short") < F.length("x")).count() > 200


def test_one_of_each_joins_alike_at_every_size(spark, edge):
    plan = simhash.one_of_each(edge)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
