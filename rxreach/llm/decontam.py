"""Benchmark decontamination: pigeonhole edit matching.

An item is found in a document when some stretch of the document is within
``floor(rate * item length)`` edits of it, both lower-cased with each run of
white space as one space.  The item is cut into one piece more than that
budget; a stretch within the budget holds one piece whole, in its place give
or take the budget.  An Aho-Corasick automaton finds all exact pieces in the
whole text; around each hit the stretch is verified with Myers' bit-parallel
distance.  A short item (fewer than ``min_chars`` characters once normalised)
has no budget and is found between word bounds only; in scripts without spaces
any place is a bound.  Documents are never shuffled.

The items are a stated query set: they are matched in blocks of at most
``BLOCK_CHARS`` characters, each in one pass over the documents whose result is
written before the next block is fetched, so neither the driver nor a task
holds a larger automaton.

Cases: null and empty texts hold nothing; null items and items of white space
are in no text; items without an id are reported under a null id; items with
equal text or equal id are each reported; equal rows and null doc_ids are
separate rows; no rows give no rows; extra columns are left as they are, but
``with_items`` puts its result in place of a column named ``out``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

BLOCK_CHARS = 4_000_000
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, budget: int) -> int | None:
    """Smallest edit distance of the pattern to a substring of text, or None
    if above the budget."""
    m, top = len(pattern), 1 << (len(pattern) - 1)
    full, eq = (1 << m) - 1, {}
    for i, c in enumerate(pattern):
        eq[c] = eq.get(c, 0) | 1 << i
    pv, mv, score, best = full, 0, m, m
    for c in text:
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score < best:
            best = score
            if not best:
                break
    return best if best <= budget else None


def bound(text: str, at: int) -> bool:
    """Whether a word may begin or end at this place."""
    pair = text[at - 1:at + 1] if 0 < at < len(text) else ""
    return not (len(pair) == 2 and pair.isalnum()) or bool(UNSPACED.search(pair))


class Matcher:
    """Pieces of one block of items in an automaton."""

    def __init__(self, items: list[tuple[int | None, str]], rate: float, min_chars: int):
        self.ids = [i for i, _ in items]
        self.short = [len(text) < min_chars for _, text in items]
        self.items = [(text, 0 if short else int(rate * len(text))) for (_, text), short in zip(items, self.short)]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (text, budget) in enumerate(self.items):
            for off, piece in pieces(text, budget):
                found.setdefault(piece, []).append((k, off))
        self.auto = ahocorasick.Automaton()
        for piece, where in found.items():
            self.auto.add_word(piece, (len(piece), where))
        self.auto.make_automaton()

    def search(self, text: str) -> list[tuple[int | None, int]]:
        """(item id, smallest distance) of each item within its budget."""
        spans: dict[int, list[list[int]]] = {}
        whole: set[int] = set()                 # short items
        for end, (size, where) in self.auto.iter(text):
            for k, off in where:
                if self.short[k]:
                    if bound(text, end + 1 - size) and bound(text, end + 1):
                        whole.add(k)
                    continue
                item, budget = self.items[k]
                a = end + 1 - size - off - budget
                b = a + len(item) + 2 * budget
                own = spans.setdefault(k, [])
                if own and a <= own[-1][1] and b >= own[-1][0]:
                    own[-1][0], own[-1][1] = min(a, own[-1][0]), max(b, own[-1][1])
                else:
                    own.append([a, b])
        out = [(self.ids[k], 0) for k in whole]
        for k, own in spans.items():
            found = [d for a, b in own if (d := myers(self.items[k][0], text[max(0, a):b], self.items[k][1])) is not None]
            if found:
                out.append((self.ids[k], min(found)))
        return sorted(out, key=lambda hit: (hit[0] is None, hit[0] or 0, hit[1]))


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """Normalised items, streamed from Spark in blocks of bounded size."""
    block, size = [], 0
    for item_id, text in benchmark.where("text is not null").select("item_id", "text").toLocalIterator():
        text = normal(text)
        if not text:
            continue
        if size + len(text) > BLOCK_CHARS and block:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text)
    if block:
        yield block


def with_items(docs: DataFrame, benchmark: DataFrame, rate: float = 0.06,
               min_chars: int = 25, out: str = "items") -> DataFrame:
    """``docs`` with a column of the items found in each row's text:
    array of (item_id, distance), by item_id (null last) within a block."""
    kind = "array<struct<item_id:long,distance:int>>"

    def of(block: list[tuple[int | None, str]]):
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            m = Matcher(block, rate, min_chars)
            for texts in parts:
                yield pd.Series([[{"item_id": i, "distance": d} for i, d in m.search(normal(t))] for t in texts],
                                dtype=object)
        return F.pandas_udf(run, kind, F.PandasUDFType.SCALAR_ITER)(F.col("text").cast("string"))

    found = None
    for block in item_blocks(benchmark):
        if found is None:
            found = docs.withColumn(out, of(block))
        else:
            found = saved(found)
            found = found.withColumn(out, F.concat(found[out], of(block)))
    return docs.withColumn(out, F.expr("array()").cast(kind)) if found is None else found


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no item; their columns as they are."""
    out = "_items"
    while out in map(str.lower, docs.columns):
        out += "_"
    found = with_items(docs, benchmark, out=out, **options)
    return found.where(F.size(out) == 0).drop(out)
