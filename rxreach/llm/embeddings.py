"""Embedding near-duplicates: int8 tile products with rigorous error bounds.

Candidates come from random hyperplanes: a vector is filed in ``tables`` files
under the signs of ``bits`` planes each.  The number of bits follows the
logarithm of the row count, so files stay of a size at any scale; the number
of tables follows from the chance that two vectors exactly at the threshold
share a file, so that at least ``recall`` of such pairs meet (closer pairs meet
more surely).  Equal vectors collapse first, and a file of more than ``CELL``
vectors is dealt as pairs of chunks.

In a cell vectors are unit vectors x = s q + r with q int8; the tile product
q.q' (exact in float32: below 2^24) gives the cosine up to
|r'| + |r| (1 + |r'|), with |r| measured per vector.  Only pairs whose upper
bound reaches the threshold are computed in double precision.  A pair counts in
the first table in which its files agree, so links are counted once, and a
cell returns counts and stars, never its pairs.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; vectors of different lengths never link; equal vectors are
linked with each other; rows with equal ids are rows of their own (a group's
id is the smallest that is not null); no rows give no rows; extra columns are
ignored.  Labels are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, saved

CELL = 256           # vectors of a chunk; a cell holds two at most
ONE = 1e-9           # slack for rounding in double precision


def plan(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits, tables) for so many vectors."""
    bits = max(8, math.ceil(math.log2(max(2, rows))) - 2)
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - meet)))


def file_keys(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """(rows, tables) signs of the planes, packed into a long each."""
    rng = np.random.default_rng([seed, x.shape[1]])
    out = np.empty((len(x), tables), np.int64)
    for t in range(tables):
        out[:, t] = (x @ rng.standard_normal((x.shape[1], bits)) > 0) @ (1 << np.arange(bits, dtype=np.int64))
    return out


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales and the lengths of what they leave out."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((x - q * scale[:, None]) ** 2).sum(axis=1)) + ONE


def linked(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean tile: cosine of rows of x and y (unit vectors) >= threshold."""
    (qx, sx, rx), (qy, sy, ry) = quantised(x), quantised(y)
    kind = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (qx.astype(kind) @ qy.T.astype(kind)) * (sx[:, None] * sy[None, :])
    maybe = product + ry[None, :] + rx[:, None] * (1 + ry[None, :]) + ONE >= threshold
    i, j = np.nonzero(maybe)
    step = max(1, (1 << 22) // x.shape[1])
    for at in range(0, len(i), step):
        a, b = i[at:at + step], j[at:at + step]
        maybe[a, b] = np.einsum("ij,ij->i", x[a], y[b]) >= threshold
    return maybe



def near_vectors(rows: DataFrame, threshold: float = 0.95, recall: float = 0.995, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row (vec_id, embedding)."""
    v = F.col("embedding").cast("array<double>")
    good = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) \
        & F.exists(v, lambda c: c != 0)
    base = rows.select(F.col("vec_id").cast("long"), F.when(F.coalesce(good, F.lit(False)), v).alias("v"))
    base = base.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(1), "v")})
    found = base.where("v is not null")
    groups = saved(found.groupBy("k1", "k2").agg(
        F.first("v").alias("v"), F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"))
        .withColumn("node", F.xxhash64("k1", "k2")))
    bits, tables = plan(groups.count(), threshold, recall)

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, part in b.groupby(b["v"].map(len)):
                x = np.array(part["v"].tolist(), np.float64)
                x = x / np.abs(x).max(axis=1, keepdims=True)      # no overflow in the lengths
                keys = file_keys(x, bits, tables, seed)
                yield pd.DataFrame({"node": part["node"].to_numpy().repeat(tables),
                                    "t": np.tile(np.arange(tables, dtype=np.int32), len(part)),
                                    "d": np.int32(x.shape[1]), "k": keys.ravel()})

    filed = groups.select("node", "v").mapInPandas(file, "node long, t int, d int, k long")
    sizes = (filed.groupBy("t", "d", "k").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    chunks = F.ceil(F.col("m") / CELL).cast("int")
    dealt = (filed.join(sizes, ["t", "d", "k"])
                  .withColumn("c", F.pmod(F.xxhash64("node"), chunks).cast("int"))
                  .withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
                  .select("node", "t", "d", "k", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "c"))
    cell = ["t", "d", "k", "i", "j"]
    vectors = groups.select("node", F.col("n"), "v")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for b in batches:
            b = b if rest is None else pd.concat([rest, b], ignore_index=True)
            new = np.append(np.flatnonzero((b[cell] != b[cell].shift()).any(axis=1)), len(b))
            for at, end in zip(new[:-2], new[1:-1]):
                yield from one(b.iloc[at:end])
            rest = b.iloc[new[-2]:] if len(b) else None
        if rest is not None:
            yield from one(rest)

    def one(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(b) < 2:
            return
        x = np.array(b["v"].tolist(), np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        t, i, j = int(b["t"].iloc[0]), int(b["i"].iloc[0]), int(b["j"].iloc[0])
        keys = file_keys(x, bits, t, seed)                   # of the tables before this one
        u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        near = linked(u, u, threshold)
        np.fill_diagonal(near, False)
        if i != j:
            c = b["c"].to_numpy()
            near &= c[:, None] != c[None, :]                 # the rest is met in cells of one chunk
        a, z = np.nonzero(near)
        fresh = ~(keys[a] == keys[z]).any(axis=1)
        links = np.bincount(a[fresh], weights=b["n"].to_numpy(np.float64)[z[fresh]], minlength=len(b)).astype(np.int64)
        node, root, left = b["node"].to_numpy(), np.arange(len(b)), np.ones(len(b), bool)
        for r in range(len(b)):
            front = np.array([r]) if left[r] else np.zeros(0, int)
            left[r] = False
            while len(front):
                front = np.flatnonzero(near[front].any(axis=0) & left)
                left[front], root[front] = False, r
        some = near.any(axis=1)
        if some.any():
            yield pd.DataFrame({"src": node[some], "dst": node[root[some]], "links": links[some]})

    stars = saved(dealt.join(vectors, "node").repartition(*cell).sortWithinPartitions(*cell)
                  .mapInPandas(compare, "src long, dst long, links long"))
    comp = components(stars.select("src", "dst"))
    counts = stars.groupBy("src").agg(F.sum("links").alias("links"))
    own = (groups.join(comp, "node", "left").join(counts, groups["node"] == counts["src"], "left")
                 .select("k1", "k2", "rep", "n", F.coalesce("component", groups["node"]).alias("class"),
                         F.coalesce("links", F.lit(0)).alias("links")))
    low = own.groupBy("class").agg(F.min("rep").alias("low"))
    own = own.join(low, "class").select(
        F.col("k1").alias("g1"), F.col("k2").alias("g2"), "low", (F.col("links") + F.col("n") - 1).alias("n_links"))
    out = base.join(own, base["v"].isNotNull() & (base["k1"] == own["g1"]) & (base["k2"] == own["g2"]), "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("low"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
