"""Substring deduplication: level-wise doubling.

A word goes when some window of ``window`` consecutive words of its document
covers it and the same words start earlier in the corpus (by doc_id, then row
hash, then position).  Windows grow by doubling: only those whose first half
size is repeated somewhere are extended.

Level 1 (half the window): of the half-windows inside each window the one with
the smallest hash is its anchor.  Equal windows have equal anchors at equal
offsets, so anchors alone need be counted (about one position in six); an
anchor that occurs once ends the windows it stands for.
Level 2 (the window): windows whose anchor is repeated are hashed to 128 bits,
composed from the half-window hashes, and their first start is found.  For a
window length that is not the last, its repeats would be the next level's
candidates in the same way; ``window`` words is the last level needed here, as
what is removed is the union of the windows.

Counts and minima are combined map-side, so a passage in every document costs
a row per task; joins back are split by adaptive execution.

Cases: null text has no words; texts under ``window`` words keep all; rows
equal in doc_id and text count as one document and each gets its result (the
copies are not repeats of each other); null doc_id orders first; no rows give
no rows; extra columns are left as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

CACHE = 400_000
B1, B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
KEY = ["_id", "_th"]


class WordHash(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __init__(self, seed: int):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text) -> list[bytes]:
    return bytes(text).split() if text is not None else []


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def rolled(words: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of ``size`` words, by doubling shorter runs."""
    h, n, out, have = words, 1, None, 0
    while size:
        if size & 1:
            m = len(words) - have - n + 1
            if m <= 0:
                return np.zeros(0, np.uint64)
            out = h[:m] if out is None else out[:m] * _power(base, n) + h[have:have + m]
            have += n
        size >>= 1
        if size:
            if len(h) <= n:
                return np.zeros(0, np.uint64)
            h = h[:-n] * _power(base, n) + h[n:]
            n *= 2
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def anchored(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the half-windows, and for each window the position of its
    anchor: the first of the smallest half-windows inside it."""
    half = window // 2
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = mixed(rolled(words, half, B1))
    span = window - half + 1
    # hash above, position below: of equal hashes the first is the smallest
    low = (np.uint64(1) << np.uint64(max(24, len(h).bit_length()))) - np.uint64(1)
    least, n = h & ~low | np.arange(len(h), dtype=np.uint64), 1
    while 2 * n <= span:
        least, n = np.minimum(least[:-n], least[n:]), 2 * n
    more = span - n
    least = np.minimum(least[:len(least) - more], least[more:])
    return h, (least & low).astype(np.int64)


def classes_of(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor: its position, its hash, and a hash of all words of the
    windows it stands for (a run of starts, as the first smallest is taken)."""
    h, at = anchored(words, window)
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    lo = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    hi = np.append(lo[1:], len(at)) - 1
    p, w = at[lo], rolled(words, window, B2)
    around = mixed(mixed(w[lo]) * B1 + mixed(w[hi]) + (p - lo).astype(np.uint64) * B2
                   + (hi - lo).astype(np.uint64))
    return p, h[p], around


def _ids(b: pd.DataFrame, counts: list[int]) -> dict:
    at = np.repeat(np.arange(len(b)), counts)
    return {c: b[c].astype("Int64").array.take(at) for c in KEY}


def _anchor_rows(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHash(1)
        for b in batches:
            got = [classes_of(hashes.of(words_of(t)), window) for t in b["text"]]
            if got:
                at, h, c = map(np.concatenate, zip(*got))
                yield pd.DataFrame(_ids(b, [len(g[0]) for g in got]) | {
                    "at": at.astype(np.int32), "h": h.view(np.int64), "c": c.view(np.int64)})

    return docs.mapInPandas(run, "_id long, _th int, at int, h long, c long")


def _window_rows(docs: DataFrame, window: int) -> DataFrame:
    """128-bit hashes of all windows of the anchors listed in ``edges``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHash(1)
        for b in batches:
            got = []
            for t, edges in zip(b["text"], b["edges"]):
                words = hashes.of(words_of(t))
                s = np.flatnonzero(np.isin(anchored(words, window)[1], edges))
                got.append((s, mixed(rolled(words, window, B1)[s]), mixed(rolled(words, window, B2)[s])))
            if got:
                s, w1, w2 = map(np.concatenate, zip(*got))
                yield pd.DataFrame(_ids(b, [len(g[0]) for g in got]) | {
                    "s": s.astype(np.int32), "w1": w1.view(np.int64), "w2": w2.view(np.int64)})

    return docs.mapInPandas(run, "_id long, _th int, s int, w1 long, w2 long")


def _join(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    r = lists.withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    return docs.join(r, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")),
                     how).drop("_rid", "_rth")


def removed_words(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one
    space, UTF-8) for every row of ``docs`` (doc_id, text)."""
    d = docs.select(F.col("doc_id").cast("long").alias("_id"), F.hash("text").alias("_th"),
                    F.col("text").cast("string").cast("binary").alias("text"))
    # anchors that stand for the same words: the first one's windows are judged below,
    # all windows of the later ones start earlier elsewhere
    firsts = saved(_anchor_rows(d, window).groupBy("h", "c")
                   .agg(F.min(F.struct(*KEY, "at")).alias("f")).select("h", "f.*"))
    several = firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    # anchors repeated amid different words: their windows are compared one by one
    edges = saved(firsts.join(several, "h").select(*KEY, "at").distinct())
    per_doc = edges.groupBy(*KEY).agg(F.collect_list("at").alias("edges"))
    first_windows = saved(_window_rows(_join(d, per_doc, "inner"), window).groupBy("w1", "w2")
                          .agg(F.min(F.struct(*KEY, "s")).alias("f")).select("f.*"))
    alone = firsts.join(several, "h", "left_anti").select(*KEY, "at")
    stay = (alone.select(*KEY, F.col("at").alias("e"))
                 .union(first_windows.select(*KEY, (-1 - F.col("s")).alias("e")))
                 .groupBy(*KEY).agg(F.collect_list("e").alias("stay")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHash(1)
        for b in batches:
            out = []
            for t, stay in zip(b["text"], b["stay"]):
                words = words_of(t)
                at = anchored(hashes.of(words), window)[1]
                keep = np.asarray(stay if stay is not None else [], np.int64)
                gone = np.flatnonzero(~(np.isin(at, keep[keep >= 0])
                                        | np.isin(np.arange(len(at)), -1 - keep[keep < 0])))
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, gone, 1)
                np.add.at(cover, gone + window, -1)
                under = np.cumsum(cover[:-1]) > 0
                left = [w for w, u in zip(words, under.tolist()) if not u] if len(gone) else words
                out.append((len(words), len(words) - len(left), b" ".join(left)))
            n, r, kept = zip(*out) if out else ((), (), ())
            yield pd.DataFrame({"doc_id": b["_id"].astype("Int64"), "n_words": np.array(n, np.int64),
                                "n_removed": np.array(r, np.int64), "kept": list(kept)})

    return _join(d, stay, "left").select("_id", "text", "stay").mapInPandas(
        run, "doc_id long, n_words long, n_removed long, kept binary")
