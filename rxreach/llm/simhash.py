"""SimHash near-duplicates: majority fingerprints, bit-sliced comparison.

A text's fingerprint has bit b set when more than half the XXH64 hashes (seed
42) of its word shingles have it.  Equal fingerprints collapse first (a group
of copies is one row from then on).  Two fingerprints within ``radius`` bits
agree in all but ``radius`` of ``2 * radius`` blocks or more, so they share the
value of at least half of four blocks (radius 2): each fingerprint is filed
under every choice of the agreeing blocks, and only rows of one file are
compared.  A file of more than ``CELL`` rows is dealt as pairs of chunks, so no
task holds more than two chunks.

Within a cell the fingerprints stand as 64 vertical bit planes; for a tile of
queries the planes that differ are added to many distances at once by a
carry-save pair of bitwise counters, and a block is abandoned once every lane
has exceeded the radius.  A cell returns one star per linked group of its rows,
never all pairs; the components follow from the stars.

Cases: null or word-less text has fingerprint zero, linked like any other; a
text of fewer words than a shingle is one shingle; equal rows are separate rows
of one component; a null doc_id gets the component of its fingerprint, whose
id is the smallest doc_id that is not null (null if there is none); no rows
give no rows; extra columns are ignored.  ASCII A-Z are lower-cased, nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LINK, components, saved

CELL = 1024          # rows of a chunk; a cell holds two at most
TILE = 256           # queries compared at once
SMALL = 16           # cells up to this size are compared many at a time


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    counts, step = np.zeros(64, np.int64), 1 << 16      # bounded memory for long texts
    for at in range(0, n, step):
        part = words[at:at + min(step, n - at) + shingle - 1]
        h = np.fromiter((digest(b" ".join(part[i:i + shingle]), 42) for i in range(max(1, len(part) - shingle + 1))),
                        np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, _th, fp): fp is the fingerprint as a signed long, _th a hash
    that tells rows of one doc_id apart."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "_th": b["_th"], "fp": fp})

    return (docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("_th"), F.col("text").cast("string"))
                .mapInPandas(run, "doc_id long, _th int, fp long"))


def _planes(fps: np.ndarray) -> np.ndarray:
    """64 bit planes over len(fps) lanes, as uint64 words."""
    lanes = -len(fps) % 64
    bits = np.unpackbits(np.concatenate([fps, np.zeros(lanes, np.uint64)]).view(np.uint8).reshape(-1, 8),
                         axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _within(diffs: Iterator[np.ndarray], radius: int, like: np.ndarray) -> np.ndarray:
    """Lanes whose count of set bits over all planes is at most ``radius``:
    a carry-save counter of bit-wide registers, with a sticky overflow."""
    width = radius.bit_length()
    regs, over = [np.zeros_like(like) for _ in range(width)], np.zeros_like(like)
    for k, carry in enumerate(diffs):
        for j in range(width):
            regs[j], carry = regs[j] ^ carry, regs[j] & carry
        over |= carry
        if k % 8 == 7 and not (~(over | _above(regs, radius))).any():
            return np.zeros_like(like)                      # every lane is out: abandon
    return ~(over | _above(regs, radius))


def _above(regs: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds ``radius`` (compared from the top bit)."""
    gt, eq = np.zeros_like(regs[0]), ~np.zeros_like(regs[0])
    for j in reversed(range(len(regs))):
        if radius >> j & 1:
            eq &= regs[j]
        else:
            gt |= eq & regs[j]
            eq &= ~regs[j]
    return gt


def _cell_stars(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """(root, member) row numbers of each linked group of one cell."""
    n, planes = len(fps), _planes(fps)
    ones = ~np.uint64(0)
    near = np.empty((n, planes.shape[1]), np.uint64)
    for at in range(0, n, TILE):
        q = fps[at:at + TILE]
        like = np.empty((len(q), planes.shape[1]), np.uint64)
        near[at:at + TILE] = _within(
            (planes[b][None, :] ^ np.where((q >> np.uint64(b)) & np.uint64(1), ones, np.uint64(0))[:, None]
             for b in range(64)), radius, like)
    left = np.packbits(np.arange(planes.shape[1] * 64) < n, bitorder="little").view(np.uint64)
    while left.any():
        root = int(np.flatnonzero(np.unpackbits(left.view(np.uint8), bitorder="little"))[0])
        front = np.array([root])
        left[root >> 6] &= ~(np.uint64(1) << np.uint64(root & 63))
        while len(front):
            hit = np.bitwise_or.reduce(near[front], axis=0) & left
            left &= ~hit
            front = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little"))
            for i in front:
                yield root, int(i)


def _shifted(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links inside many small groups at once: lane i against lane i + s."""
    pos = np.arange(len(fps))
    for s in range(1, SMALL):
        ok = pos[:-s][group[:-s] == group[s:]] if s < len(fps) else pos[:0]
        if not len(ok):
            return
        a, b = _planes(fps[ok]), _planes(fps[ok + s])
        hit = _within((x ^ y for x, y in zip(a, b)), radius, a[0])
        hit = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little")[:len(ok)])
        yield ok[hit], ok[hit] + s


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Star links (src, dst) between distinct fingerprints ``fp`` (column) that
    are within ``radius`` bits, directly or through rows of the same cell."""
    blocks = 2 * max(1, radius)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in keep)
             for keep in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    filed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"))
        for i, m in enumerate(signed)])).alias("f")).select("fp", "f.t", "f.k")
    sizes = filed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CELL).cast("int")
    dealt = (filed.join(sizes, ["t", "k"])
                  .withColumn("c", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
                  .withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
                  .select("t", "k", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "fp"))
    cell = ["t", "k", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            new = (b[cell] != b[cell].shift()).any(axis=1).to_numpy()
            last = np.flatnonzero(new)[-1] if len(b) else 0
            rest = b.iloc[last:]
            yield from compare(b.iloc[:last], new[:last])
        if rest is not None and len(rest):
            yield from compare(rest, np.arange(len(rest)) == 0)

    def compare(b: pd.DataFrame, new: np.ndarray) -> Iterator[pd.DataFrame]:
        if len(b) < 2:
            return
        fp, group = b["fp"].to_numpy().view(np.uint64), np.cumsum(new)
        starts = np.append(np.flatnonzero(new), len(b))
        size = np.diff(starts)
        src, dst = [], []
        for g in np.flatnonzero(size > SMALL):
            at = starts[g]
            for r, i in _cell_stars(fp[at:starts[g + 1]], radius):
                src.append(np.array([at + i])), dst.append(np.array([at + r]))
        few = np.flatnonzero(np.repeat(size <= SMALL, size))
        for x, y in _shifted(fp[few], group[few], radius):
            src.append(few[x]), dst.append(few[y])
        if src:
            f = fp.view(np.int64)
            yield pd.DataFrame({"src": f[np.concatenate(src)], "dst": f[np.concatenate(dst)]})

    return dealt.repartition(*cell).sortWithinPartitions(*cell).mapInPandas(run, LINK)


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, _th, fp, class, component_id) for every row of ``docs``; class
    names the component by one of its fingerprints."""
    rows = saved(fingerprints(docs, shingle))
    reps = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    comp = components(links(reps, radius))
    ids = (reps.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
               .select("fp", "rep", F.coalesce("component", "fp").alias("class")))
    low = ids.groupBy("class").agg(F.min("rep").alias("component_id"))
    ids = ids.join(low, "class").select("fp", "class", "component_id")
    return rows.join(ids, "fp").select("doc_id", "_th", "fp", "class", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    smallest (doc_id, text hash), once if that row is repeated."""
    found = near_duplicates(docs, shingle, radius).groupBy("class", "doc_id", "_th").agg(F.count(F.lit(1)).alias("n"))
    stay = saved(found.groupBy("class").agg(F.min(F.struct("doc_id", "_th", "n")).alias("s")).select(
        F.col("s.doc_id").alias("_rid"), F.col("s._th").alias("_rth"), F.col("s.n").alias("_n")))
    # the row travels in one struct, so its columns' names clash with nothing
    out = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                      F.hash("text").alias("_th"))
    # sorted merge at every size, so a job on little data has the plan of one on much
    out = out.hint("merge").join(stay, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")))
    again = out.where("_n > 1").dropDuplicates(["_id", "_th"])
    return out.where("_n = 1").unionByName(again).select("_row.*")
