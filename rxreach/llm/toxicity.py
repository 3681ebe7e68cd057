"""Toxicity: a convolutional text classifier trained in numpy.

Words (runs of letters, lower-cased) have an embedding that is the sum of two
hashed rows, of the word and of its first letters.  Filters of several widths
slide over the words of a whole text, each filter's largest answer is kept, and
a logistic layer on those gives the score.  It is trained by Adam on at most
``sample`` labelled rows (a documented bound; rows are chosen by hash); a fifth
of them is kept aside to calibrate: one scale and shift so that 0.5 divides
the labels best over all languages, and one threshold per language.

Labels, language, source and id never enter a score; the language only selects
the threshold of ``rejected``.

Cases: null and empty texts score what the logistic layer gives to no answer;
labels that are null, repeated rows of a label and labels without a document
are handled (the larger label of an id counts); without labelled rows of both
classes every score is 0 and nothing is rejected; unknown or null languages
use the threshold of all languages; equal rows score alike; no rows give no
rows; extra columns pass through.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
WORD_ROWS, STEM_ROWS, STEM = 1 << 16, 1 << 14, 5
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
CHUNK = 1 << 16          # words convolved at once
CACHE = 400_000          # words a task remembers


def word_rows(word: str) -> tuple[int, int]:
    b = word.encode("utf-8", "surrogatepass")
    stem = word[:STEM].encode("utf-8", "surrogatepass")
    return zlib.crc32(b) % WORD_ROWS, WORD_ROWS + zlib.crc32(stem, 7) % STEM_ROWS


class Rows(dict):
    """word -> packed pair of embedding rows, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        a, b = word_rows(word)
        self[word] = out = a << 32 | b
        return out

    def of(self, text: str | None) -> np.ndarray:
        words = LETTERS.findall((text or "").lower())
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Model:
    emb: np.ndarray
    conv: list[np.ndarray]                 # per width: (width * DIM, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    shift: np.ndarray                      # (1,): bias of the logistic layer
    scale: float = 1.0
    move: float = 0.0
    limits: dict = field(default_factory=dict)   # language -> threshold; None: all

    def vectors(self, packed: np.ndarray) -> np.ndarray:
        return self.emb[packed >> 32] + self.emb[packed & 0xFFFFFFFF]

    def pooled(self, packed: np.ndarray) -> np.ndarray:
        """Largest answer of each filter over a whole text, at least 0."""
        best = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        for at in range(0, len(packed), CHUNK):
            x = self.vectors(packed[at:at + CHUNK + WIDTHS[-1] - 1])
            for k, w in enumerate(WIDTHS):
                n = len(x) - w + 1
                if n > 0:
                    z = sum(x[i:i + n] @ self.conv[k][i * DIM:(i + 1) * DIM] for i in range(w))
                    part = slice(k * FILTERS, (k + 1) * FILTERS)
                    best[part] = np.maximum(best[part], z.max(axis=0) + self.bias[k])
        return best

    def logit(self, packed: np.ndarray) -> float:
        return float(self.pooled(packed) @ self.out + self.shift[0])

    def score(self, packed: np.ndarray) -> float:
        z = self.scale * (self.logit(packed) - self.move)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: list[np.ndarray], labels: np.ndarray, langs: list, epochs: int = 6,
          batch: int = 32, rate: float = 0.01, seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    m = Model(rng.normal(0, 0.05, (WORD_ROWS + STEM_ROWS, DIM)).astype(np.float32),
              [rng.normal(0, 0.3, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS],
              [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
              rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32), np.zeros(1, np.float32))
    order = rng.permutation(len(rows))
    aside, fit = order[:len(rows) // 5], order[len(rows) // 5:]
    _warm(m, [rows[i] for i in fit], labels[fit])
    params = [m.emb, *m.conv, *m.bias, m.out, m.shift]
    mean, var = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    steps = np.zeros(len(m.emb), np.int64)
    weight = np.where(labels == 1, max(1.0, (labels == 0).sum() / max(1, (labels == 1).sum())) ** 0.5, 1.0)
    t = 0
    for _ in range(epochs):
        fit = rng.permutation(fit)
        for at in range(0, len(fit), batch):
            own = fit[at:at + batch]
            t += 1
            ids, grads = _gradients(m, [rows[i] for i in own], labels[own], weight[own])
            for k, (p, g) in enumerate(zip(params, grads)):
                if k == 0:                               # rows of the embedding that answered
                    steps[ids] += 1
                    n = steps[ids][:, None]
                    mean[0][ids] = 0.9 * mean[0][ids] + 0.1 * g
                    var[0][ids] = 0.999 * var[0][ids] + 0.001 * g * g
                    p[ids] -= rate * (mean[0][ids] / (1 - 0.9 ** n)) / (np.sqrt(var[0][ids] / (1 - 0.999 ** n)) + 1e-6)
                else:
                    mean[k] = 0.9 * mean[k] + 0.1 * g
                    var[k] = 0.999 * var[k] + 0.001 * g * g
                    p -= rate * (mean[k] / (1 - 0.9 ** t)) / (np.sqrt(var[k] / (1 - 0.999 ** t)) + 1e-6)
    _calibrate(m, [rows[i] for i in aside], labels[aside], [langs[i] for i in aside])
    return m


def _warm(m: Model, rows: list[np.ndarray], labels: np.ndarray) -> None:
    """First coordinate of each embedding row: damped log odds of texts with it."""
    counts = np.zeros((2, len(m.emb)), np.float32)
    for r, y in zip(rows, labels):
        u = np.unique(r)
        np.add.at(counts[int(y)], np.unique(np.concatenate([u >> 32, u & 0xFFFFFFFF])), 1)
    n0, n1 = max(1, (labels == 0).sum()), max(1, (labels == 1).sum())
    odds = np.log((counts[1] / n1 + 2 / n1) / (counts[0] / n0 + 2 / n1))
    m.emb[:, 0] = np.where(counts.sum(0) > 0, odds, 0) / 2


def _gradients(m: Model, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray):
    """Gradients of the weighted log loss; only the words that a filter's
    largest answer covers take part."""
    conv, bias = [np.zeros_like(c) for c in m.conv], [np.zeros_like(b) for b in m.bias]
    out, shift = np.zeros_like(m.out), np.zeros_like(m.shift)
    ids, rowg = [], []
    for r, label, w8 in zip(rows, y, weight):
        x, pooled, where = m.vectors(r), np.zeros(len(m.out), np.float32), []
        for k, w in enumerate(WIDTHS):
            n = len(x) - w + 1
            if n <= 0:
                where.append(None)
                continue
            z = sum(x[i:i + n] @ m.conv[k][i * DIM:(i + 1) * DIM] for i in range(w)) + m.bias[k]
            at = z.argmax(axis=0)
            where.append(at)
            pooled[k * FILTERS:(k + 1) * FILTERS] = np.maximum(0, z[at, np.arange(FILTERS)])
        g = w8 * (1 / (1 + np.exp(-np.clip(pooled @ m.out + m.shift[0], -30, 30))) - label) / len(rows)
        out += g * pooled
        shift += g
        down = g * m.out * (pooled > 0)
        for k, w in enumerate(WIDTHS):
            if where[k] is None:
                continue
            d = down[k * FILTERS:(k + 1) * FILTERS]
            bias[k] += d
            for i in range(w):
                part = slice(i * DIM, (i + 1) * DIM)
                conv[k][part] += (x[where[k] + i] * d[:, None]).T
                hit = d != 0
                if hit.any():
                    packed = r[where[k][hit] + i]
                    gv = (m.conv[k][part][:, hit] * d[hit]).T
                    ids += [packed >> 32, packed & 0xFFFFFFFF]
                    rowg += [gv, gv]
    if not ids:
        return np.zeros(0, np.int64), [np.zeros((0, DIM), np.float32), *conv, *bias, out, shift]
    own, inv = np.unique(np.concatenate(ids), return_inverse=True)
    emb = np.zeros((len(own), DIM), np.float32)
    np.add.at(emb, inv, np.concatenate(rowg))
    return own, [emb, *conv, *bias, out, shift]


def _best_limit(z: np.ndarray, y: np.ndarray) -> float:
    """The cut between two scores with the fewest errors; the middle of the widest such gap."""
    order = np.argsort(z)
    z, y = z[order], y[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    low, high = np.concatenate([[z[0] - 1], z]), np.concatenate([z, [z[-1] + 1]])
    best = np.flatnonzero((errors == errors.min()) & (high > low))
    k = best[np.argmax((high - low)[best])]
    return float((low[k] + high[k]) / 2)


def _calibrate(m: Model, rows: list[np.ndarray], y: np.ndarray, langs: list) -> None:
    if not len(rows) or y.min() == y.max():
        m.limits[None] = 0.5
        return
    z = np.array([m.logit(r) for r in rows])
    m.move = _best_limit(z, y)
    m.scale = 1.0
    p = lambda x: 1 / (1 + np.exp(-np.clip(m.scale * (x - m.move), -30, 30)))
    m.limits[None] = 0.5
    for lang in set(langs):
        own = np.array([x == lang for x in langs])
        if lang is not None and (y[own] == 1).sum() >= 10 and (y[own] == 0).sum() >= 10:
            m.limits[lang] = float(p(_best_limit(z[own], y[own])))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 12_000, seed: int = 5, **options) -> Model | None:
    """A model from at most ``sample`` rows of ``labels`` (doc_id, toxic) and
    their texts in ``docs``.  Texts become embedding rows on the executors; one
    task trains on them, and the driver receives the model."""
    chosen = (labels.where("doc_id is not null and toxic is not null")
                    .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
                    .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample))
    texts = docs.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = Rows()
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang": b["lang"], "toxic": b["toxic"],
                                "rows": [rows.of(t).astype("<i8").tobytes() for t in b["text"]]})

    got = (texts.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("toxic").cast("int"),
                        F.col("text").cast("string"))
                .mapInPandas(run, "doc_id long, lang string, toxic int, rows binary")
                # one text per labelled id, however many rows repeat it: the bound holds on the driver
                .groupBy("doc_id").agg(F.min(F.struct("rows", "lang", "toxic")).alias("r"))
                .select("doc_id", "r.*"))

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame(columns=["doc_id", "rows", "lang", "toxic"]), *batches])
        if len(got) and got["toxic"].min() != got["toxic"].max():
            got["rows"] = [bytes(r) for r in got["rows"]]
            got = got.sort_values(["doc_id", "rows"], kind="stable")
            y = (got["toxic"].to_numpy(dtype=float) > 0).astype(np.float32)
            langs = [x if isinstance(x, str) else None for x in got["lang"]]
            m = train([np.frombuffer(r, "<i8") for r in got["rows"]], y, langs, **options)
            # arrays and numbers only: no class of this package has to be known where they are read
            yield pd.DataFrame({"model": [pickle.dumps([getattr(m, f.name) for f in fields(Model)])]})

    # one task holds the sample (at most ``sample`` rows); the driver gets the 2.6 MB of the model
    made = got.coalesce(1).mapInPandas(learn, "model binary").first()
    return None if made is None else Model(*pickle.loads(bytes(made["model"])))


def score(docs: DataFrame, model: Model | None, prefix: str = "") -> DataFrame:
    """``docs`` with columns score, predicted (score >= 0.5) and rejected
    (score at or over the threshold of the row's language), their names after
    ``prefix``; columns so named are replaced."""
    named = [prefix + c for c in ("score", "predicted", "rejected")]
    if model is None:
        return docs.withColumns(dict(zip(named, (F.lit(0.0), F.lit(0), F.lit(False)))))

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rows = Rows()                        # the model is 2.6 MB, whatever the input
        for texts in parts:
            yield pd.Series([model.score(rows.of(t)) for t in texts], dtype=float)

    scored = docs.withColumn(named[0], F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)(
        F.col("text").cast("string")))
    limit: Column = F.lit(model.limits[None])
    for lang, at in sorted((k, v) for k, v in model.limits.items() if k is not None):
        limit = F.when(F.col("lang") == lang, F.lit(at)).otherwise(limit)
    return scored.withColumns({named[1]: (F.col(named[0]) >= 0.5).cast("int"),
                               named[2]: F.col(named[0]) >= limit})


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that never trains: crc32(doc_id as text) mod 5 is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
