"""Ranked lexical search by bag deduplication.

Documents matter to a set of items only through the terms the items hold.  So
each text becomes the vector of its counts of those terms plus ``m``, its
length measure; documents that agree in both are one class.  A class is known
by a hash and verified on the vector itself (it is part of the grouping key),
scored once against every item, and its members come back in the end, smallest
doc_id first.

One pass over the texts counts terms (bytes, split at what is no term).  Each
task scores its classes through the items' postings and hands on, per item,
the best ``top`` classes by score and smallest doc_id: a class that ``top``
others outrank so has no document among the best ``top``.  Of the classes that
remain, only their smallest ``top`` doc_ids are looked at; the limit is applied
before rows are shuffled, so a class with a third of all documents is no load.

Items are searched in blocks of at most ``BLOCK_TERMS`` terms, each against all
documents: what a task holds of the items (vocabulary, postings, best classes)
is bounded by the block.  An item with more distinct terms is a block alone.

Cases: a null or empty text has no terms: such a document counts for nothing
and such an item finds nothing; rows equal in all are documents of their own;
rows of items equal in item_id and text are one, rows that share only item_id
are searched each; a null doc_id comes first among equal scores; no rows give
no rows; only the columns named are read, so others clash with nothing.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

BLOCK_TERMS = 200_000
K = 1_000_000_000
#: digits, letters (A-Z lower-cased) and all bytes of other characters make terms; all else parts them
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
LEAST_ID = -(1 << 63)


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(TERM_BYTES).split() if text else []


@dataclass
class Block:
    """Items (by position), their terms' numbers, and postings by term."""
    items: list                          # their item_id
    vocabulary: dict[bytes, int]
    starts: np.ndarray                   # postings of term t: starts[t]:starts[t + 1]
    item: np.ndarray
    times: np.ndarray


def _block(items: list[tuple[object, Counter]]) -> Block:
    vocabulary: dict[bytes, int] = {}
    rows = [(vocabulary.setdefault(t, len(vocabulary)), i, n) for i, (_, bag) in enumerate(items) for t, n in bag.items()]
    rows.sort()
    at = np.array(rows, dtype=np.int64).reshape(-1, 3)
    return Block([i for i, _ in items], vocabulary, np.searchsorted(at[:, 0], np.arange(len(vocabulary) + 1)), at[:, 1], at[:, 2])


def blocks(items: DataFrame, size: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items, streamed to the driver and cut into blocks of bounded size
    (terms, and five times as many postings)."""
    held: list[tuple[object, Counter]] = []
    seen: set[bytes] = set()
    postings = 0
    for row in items.select("item_id", F.col("text").cast("binary").alias("text")).distinct().toLocalIterator():
        bag = Counter(terms(None if row["text"] is None else bytes(row["text"])))
        if not bag:
            continue
        if held and (len(seen | bag.keys()) > size or postings > 5 * size):
            yield _block(held)
            held, seen, postings = [], set(), 0
        held.append((row["item_id"], bag))
        seen |= bag.keys()
        postings += len(bag)
    if held:
        yield _block(held)


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, vec): terms with repeats, and the counts of the vocabulary's
    terms (term number and count, four bytes each, by number; none: null)."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for rows in parts:
            ns, vecs = [], []
            for text in rows.column("text"):
                words = terms(text.as_py())
                bag = Counter(map(number, words))
                bag.pop(None, None)
                ns.append(len(words))
                vecs.append(np.array(sorted(bag.items()), dtype="<i4").tobytes() if bag else None)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ns, pa.int64()), pa.array(vecs, pa.binary())],
                                             names=["doc_id", "n", "vec"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, vec binary")


def document_counts(classes: DataFrame, size: int) -> DataFrame:
    """(t, df): documents that hold each term, summed per task and then over all."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(size, dtype=np.int64)
        for rows in parts:
            for vec, n in zip(rows["vec"], rows["size"]):
                df[np.frombuffer(vec, dtype="<i4")[::2]] += n
        t = np.flatnonzero(df)
        yield pd.DataFrame({"t": t, "df": df[t]})

    return classes.select("vec", "size").mapInPandas(run, "t int, df long").groupBy("t").agg(F.sum("df").alias("df"))


def _weights(total: int, df: dict[int, int], size: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df.get(t, 0) + 1))) for t in range(size)], dtype=np.int64)


def _best_classes(classes: DataFrame, block: Block, weight: np.ndarray, top: int) -> DataFrame:
    """Per task and item, the ``top`` best classes with a score above 0."""
    n = len(block.items)
    starts, item, times = block.starts, block.item, block.times

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # per item: a heap of (score, -smallest doc_id, class), the worst first
        best: list[list] = [[] for _ in range(n)]
        floor = np.zeros(n, dtype=np.int64)
        for rows in parts:
            for h, m, low, vec in zip(rows["h"], rows["m"], rows["low"], rows["vec"]):
                tf = np.frombuffer(vec, dtype="<i4").astype(np.int64).reshape(-1, 2)
                gain = weight[tf[:, 0]] * (K * tf[:, 1] // (1000 * tf[:, 1] + 12 * m))
                lengths = starts[tf[:, 0] + 1] - starts[tf[:, 0]]
                upto = np.cumsum(lengths)
                at = np.arange(upto[-1]) + np.repeat(starts[tf[:, 0]] - upto + lengths, lengths)
                score = np.zeros(n, dtype=np.int64)
                np.add.at(score, item[at], times[at] * np.repeat(gain, lengths))
                for i in np.flatnonzero((score >= floor) & (score > 0)).tolist():
                    found = (int(score[i]), -int(low), int(h), int(m), vec)
                    if len(best[i]) < top:
                        heapq.heappush(best[i], found)
                    else:
                        heapq.heappushpop(best[i], found)
                    if len(best[i]) == top:
                        floor[i] = best[i][0][0]
        out = [(i, score, -low, h, m, vec) for i, own in enumerate(best) for score, low, h, m, vec in own]
        for at in range(0, len(out), 10_000):
            yield pd.DataFrame(out[at:at + 10_000], columns=["item", "score", "low", "h", "m", "vec"])

    return classes.select("h", "m", "low", "vec").mapInPandas(
        run, "item int, score long, low long, h long, m long, vec binary")


def _search(docs: DataFrame, block: Block, item_ids: DataFrame, top: int) -> DataFrame:
    found = saved(vectors(docs, block.vocabulary))
    sizes = found.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.sum("n").alias("L")).first()
    total, length = sizes["N"] or 0, sizes["L"] or 0
    m = F.expr(f"75 + (25 * n * {total}L) div {max(length, 1)}L").cast("long")
    low = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))
    members = found.where("vec is not null").select("doc_id", low.alias("low"), m.alias("m"), "vec", F.xxhash64("vec", m).alias("h"))
    # the hash decides where a class is gathered, the vector itself what is in it
    classes = saved(members.groupBy("h", "m", "vec").agg(F.count(F.lit(1)).alias("size"), F.min("low").alias("low")))
    size = len(block.vocabulary)
    df = {r["t"]: r["df"] for r in document_counts(classes, size).toLocalIterator()}      # at most one row a term of the block
    best = _best_classes(classes, block, _weights(total, df, size), top)
    rank = Window.partitionBy("item").orderBy(F.col("score").desc(), "low")
    best = saved(best.withColumn("_k", F.row_number().over(rank)).where(F.col("_k") <= top).drop("_k"))
    wanted = best.select("h", "m", "vec").distinct()
    own = Window.partitionBy("h", "m", "vec").orderBy("low")
    # cut to the smallest ids in each map task, so a hot class is few rows when it is shuffled
    small = (members.withColumn("_k", F.row_number().over(own)).where(F.col("_k") <= top).drop("_k", "low")
                    .join(wanted, ["h", "m", "vec"], "left_semi"))
    hits = best.drop("low").join(small, ["h", "m", "vec"])
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    hits = hits.select("item", "doc_id", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame([(i, x) for i, x in enumerate(block.items)],
                                              f"item int, item_id {item_ids.schema['item_id'].dataType.simpleString()}")
    return hits.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = 20, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Each item's ``top`` best documents: item_id, rank, doc_id, score."""
    out = None
    for block in blocks(items, block_terms):
        found = saved(_search(docs, block, items, top))
        out = found if out is None else out.union(found)
    if out is None:
        kind = {c: d.schema[c].dataType.simpleString() for d, c in ((items, "item_id"), (docs, "doc_id"))}
        return docs.sparkSession.createDataFrame(
            [], f"item_id {kind['item_id']}, rank int, doc_id {kind['doc_id']}, score long")
    return out
