"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins; the model is a lookup table per feature and, for the few pairs
that explain most of what is left, a table per pair. The tables are learned by cyclic boosting: in turn, every
feature gets a shallow tree (three leaves) on the gradients of the logistic loss, added with a small step. A
score is the sum of table entries, looked up for whole batches at once. Features are counts of the text alone:
shares of kinds of bytes, word lengths, repeated words, lines and word sequences.

The labelled rows to learn from are at most ``most`` (those with the smallest hash of the id); labels of
equal ids are averaged. Defined cases: null labels and ids are not learned from; null and empty texts have all
features 0 and get a score like any other; without labels of both classes every score is the share of class 1, or
0.5 without any; rows with equal ids are scored each on its own; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scan import NOT_SPACE, Words, ngrams, raw, slices, words
from .shared import bounded_batches, column, table, tidy

MOST_LABELS = 50_000
THRESHOLD = 0.3
FEATURES = ("bytes", "words", "word_length", "upper", "digits", "bars", "exclaim", "marks", "stops", "commas", "wide", "short_words", "long_words", "same_as_last", "distinct_words", "repeated_runs", "lines", "repeated_lines")


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars.encode())] = 1
    return out


KINDS = (_bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes("0123456789"), _bytes("|<>{}[]=_\\~^"), _bytes("!?"), _bytes("#$%&*@+"), _bytes("."), _bytes(",;:"), (np.arange(256) >= 0x80).astype(np.int64))
NOT_NEWLINE = np.ones(256, bool)
NOT_NEWLINE[[0x0A, 0x0D]] = False


def _sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values)))[ptr]).astype(np.float64)


def _repeated(h: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """By text, how many entries equal an earlier one."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    again = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) + 1
    return np.bincount(doc[again], minlength=n).astype(np.float64)


def features(texts: pa.Array) -> np.ndarray:
    """A row of FEATURES for every text."""
    data, offsets = raw(texts)
    n = len(texts)
    w: Words = words(texts, NOT_SPACE)
    lines: Words = words(texts, NOT_NEWLINE)
    size, count = np.diff(offsets).astype(np.float64), np.diff(w.ptr).astype(np.float64)
    per_byte, per_word = np.maximum(size, 1), np.maximum(count, 1)
    n_lines = np.diff(lines.ptr).astype(np.float64)
    kinds = [_sums(k[data], offsets) / per_byte for k in KINDS]
    length, doc = w.end - w.start, w.doc
    same = np.zeros(len(doc), np.int64)
    same[1:] = (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1])
    runs = ngrams(w.hash, 3)
    inside = np.flatnonzero(doc[: len(runs)] == doc[2:]) if len(runs) else np.empty(0, np.int64)
    columns = [
        np.log1p(size), np.log1p(count), _sums(length, w.ptr) / per_word, *kinds,
        _sums(length <= 3, w.ptr) / per_word, _sums(length >= 16, w.ptr) / per_word, _sums(same, w.ptr) / per_word,
        1 - _repeated(w.hash, doc, n) / per_word, _repeated(runs[inside], doc[inside], n) / per_word,
        n_lines / per_word, _repeated(lines.hash, lines.doc, n) / np.maximum(n_lines, 1),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Gam:
    """Bin edges, tables by feature, and tables by pair over coarser bins."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            total += t[np.searchsorted(self.edges[j], x[:, j], "right")]
        for a, b, t in self.pairs:
            total += t[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between distinct quantiles."""
    q = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)))
    return (q[1:] + q[:-1]) / 2 if len(q) > 1 else np.empty(0)


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _shallow(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int, ridge: float, leaves: int = 3) -> np.ndarray:
    """Leaf values by bin of a tree on one feature's ordered bins, grown best split first."""
    spans = [(0, len(g))]

    def best(span: tuple[int, int]) -> tuple[float, int]:
        a, b = span
        cg, ch, cn = np.cumsum(g[a:b]), np.cumsum(h[a:b]), np.cumsum(n[a:b])
        if b - a < 2:
            return 0.0, a
        won = _gain(cg[:-1], ch[:-1], ridge) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1], ridge) - _gain(cg[-1], ch[-1], ridge)
        won[(cn[:-1] < least) | (cn[-1] - cn[:-1] < least)] = 0
        k = int(won.argmax())
        return float(won[k]), a + k + 1

    while len(spans) < leaves:
        won, at, k = max((*best(s), k) for k, s in enumerate(spans))
        if won <= 1e-9:
            break
        a, b = spans[k]
        spans[k : k + 1] = [(a, at), (at, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray, least: int, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of both features of a pair into four leaves, and its gain."""
    cg, ch, cn = (np.pad(t, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for t in (g, h, n))

    def four(c: np.ndarray) -> list[np.ndarray]:
        a, right, low, whole = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1], c[-1, -1]
        return [a, right - a, low - a, whole - right - low + a]

    won = sum(_gain(x, y, ridge) for x, y in zip(four(cg), four(ch)))
    if not won.size:
        return 0.0, np.zeros_like(g, float)
    won = np.where(np.min(four(cn), axis=0) < least, 0, won)
    i, j = np.unravel_index(int(won.argmax()), won.shape)
    out = np.zeros(g.shape)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for columns in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, columns] = -g[rows, columns].sum() / (h[rows, columns].sum() + ridge)
    return float(won[i, j]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, step: float = 0.15, bins: int = 64, coarse: int = 12, pairs: int = 4, pair_rounds: int = 40, ridge: float = 1.0) -> Gam:
    """Cyclic boosting: all features in turn, ``rounds`` times, then the chosen pairs."""
    share = float(y.mean()) if len(y) else 0.5
    share_safe = min(max(share, 1e-3), 1 - 1e-3)
    model = Gam(float(np.log(share_safe / (1 - share_safe))))
    if share in (0.0, 1.0) or not len(y):
        return model
    least = max(3, len(y) // 1000)
    model.edges = [_edges(x[:, j], bins) for j in range(x.shape[1])]
    model.coarse = [_edges(x[:, j], coarse) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    sizes = [np.bincount(a, minlength=len(t)) for a, t in zip(at, model.tables)]
    total = np.full(len(y), model.base)
    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            p = 1 / (1 + np.exp(-total))
            add = step * _shallow(np.bincount(at[j], p - y, len(t)), np.bincount(at[j], p * (1 - p), len(t)), sizes[j], least, ridge)
            t += add
            total += add[at[j]]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]

    def grids(a: int, b: int) -> list[np.ndarray]:
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        cell, p = rough[a] * shape[1] + rough[b], 1 / (1 + np.exp(-total))
        return [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (p - y, p * (1 - p), np.ones(len(y)))]

    ranked = sorted(((-_quadrants(*grids(a, b), least, ridge)[0], a, b) for a, b in combinations(range(x.shape[1]), 2)))[:pairs]
    chosen = [(a, b, np.zeros((len(model.coarse[a]) + 1, len(model.coarse[b]) + 1))) for won, a, b in ranked if won < 0]
    for _ in range(pair_rounds):
        for a, b, t in chosen:
            add = step * _quadrants(*grids(a, b), least, ridge)[1]
            t += add
            total += add[rough[a], rough[b]]
    model.pairs = chosen
    return model


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; null ids belong to it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> Gam:
    """Learn from the labelled ``docs`` that aren't held out; the broadcast sample has at most ``most`` rows."""
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("double").alias("y"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("text")):
                x = np.ascontiguousarray(features(texts))
                own = [batch.column(c).slice(first, len(texts)) for c in ("doc_id", "y", "tell")]
                yield pa.RecordBatch.from_arrays([*own, pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "y", "tell", "x"])

    # One text of each labelled id, so that repeated ids can't add up to more rows than ``most``. Only features are shuffled, never texts.
    rows = docs.select("doc_id", F.xxhash64("text").alias("tell"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y", "tell", "text")
    kinds = T.StructType([rows.schema["doc_id"], rows.schema["y"], rows.schema["tell"], T.StructField("x", T.BinaryType())])
    least = rows.mapInArrow(tidy(run), kinds).groupBy("doc_id").agg(F.min(F.struct("tell", "x", "y")).alias("least")).select("least.*")
    got = least.select("y", "x").toArrow()
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float64).reshape(-1, len(FEATURES))
    y = got["y"].to_numpy()
    order = np.lexsort((y, *x.T))  # the same model whatever the order of rows
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Gam, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """carried (a struct of the columns ``carry``) and the score of every text."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.struct(*(column(c) for c in carry)).alias("carried"), F.col("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column("_text")):
                s = shared.value.score(features(texts))
                yield pa.RecordBatch.from_arrays([batch.column("carried").slice(first, len(texts)), pa.array(s)], ["carried", "score"])

    return own.mapInArrow(tidy(run), T.StructType([own.schema["carried"], T.StructField("score", T.DoubleType())]))


def accepted(column: str = "score", threshold: float = THRESHOLD) -> Column:
    return F.col(column) >= threshold


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every text of ``documents`` for quality: see the module."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("carried.doc_id", held_out(F.col("carried.doc_id")).alias("held_out"), "score", accepted().cast("int").alias("predicted"))
