"""Toxicity scores: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text becomes the set of its hashed n-grams.  Feature f of a text that has it is the log of the
ratio of its smoothed shares among toxic and other training texts; a logistic regression is
fitted on those scaled features and calibrates the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantsilo.llm.common import map_rows, mix, plain_text, reliable, small_batches, text_buffer

#: Lengths of the character n-grams, in bytes of the lower-cased UTF-8.
NGRAMS = (4, 5, 6)
BUCKETS = 1 << 20
#: Bound of the labelled sample that the classifier is fitted on: rows in the order of a hash of the id.
TRAIN_ROWS = 20_000
#: Features that the linear model weighs: those whose log-count ratio is best supported.
FEATURES = 4096
SMOOTH = 0.5
#: Partitions of the sample, and slices of the buckets whose counts are added apart.
SAMPLE_PARTS = 16
SLICES = 16
L2 = 1.0
#: Bytes hashed at once, and features of training rows that the fit widens at once.
BLOCK, FIT_BLOCK = 1 << 16, 1 << 20

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_FOLD = mix(_FOLD * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))


def _hashes(data: np.ndarray, ngrams: tuple[int, ...], buckets: int):
    """Buckets of all n-grams of one text's bytes, block by block (blocks overlap by an n-gram)."""
    top = max(ngrams)
    for a in range(0, len(data), BLOCK):
        v = _FOLD[data[a:a + BLOCK + top - 1]]
        h = v.copy()
        for n in range(2, top + 1):
            if len(v) < n:
                break
            h = h[:len(v) - n + 1] * np.uint64(0x100000001B3) + v[n - 1:]
            if n in ngrams:
                yield ((mix(h[:BLOCK]) >> np.uint64(7)) % np.uint64(buckets)).astype(np.int32)


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int32)


def features(data: np.ndarray, ngrams: tuple[int, ...] = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """The set of n-gram buckets of a text, sorted; never more than one block of repeats in memory."""
    return _distinct([np.unique(h) for h in _hashes(data, ngrams, buckets)])


@dataclass
class Model:
    """Weights by bucket (log-count ratio times coefficient), 0 where the model has no feature."""

    weights: np.ndarray
    bias: float
    ngrams: tuple[int, ...] = NGRAMS
    known: bool = True

    def score(self, data: np.ndarray) -> float:
        """Probability of a text's bytes being toxic."""
        if not self.known:
            return 0.0
        hits = _distinct([h[self.weights[h] != 0] for h in _hashes(data, self.ngrams, len(self.weights))])
        z = self.bias + float(self.weights[hits].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def choose(p: np.ndarray, q: np.ndarray, n: int, m: int, n_features: int = FEATURES,
           smooth: float = SMOOTH) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that the linear model weighs, and their ratios log((p/|p|) / (q/|q|)).

    p, q: in how many of the n toxic and the m other rows each bucket stands.  A bucket's support
    is its ratio times the rows of the class that it speaks for (toxic ones scaled to the others).
    """
    r = np.log((p + smooth) / (n + 2 * smooth)) - np.log((q + smooth) / (m + 2 * smooth))
    gain = np.where(r > 0, p * r, -q * r * (n / max(m, 1)))
    gain[(p + q) < 2] = 0
    chosen = np.sort(np.argsort(-gain, kind="stable")[:n_features])
    chosen = chosen[gain[chosen] > 0]
    return chosen, r[chosen]


def fit(sets: list[np.ndarray], y: np.ndarray, chosen: np.ndarray, ratios: np.ndarray,
        buckets: int = BUCKETS, ngrams: tuple[int, ...] = NGRAMS, l2: float = L2, steps: int = 300) -> Model:
    """Logistic regression on scaled features; ``sets`` hold places in ``chosen``, y is 0/1 by row.

    Without rows of both labels the model knows nothing (score 0).
    """
    y = np.asarray(y, bool)
    if not len(y) or y.all() or not y.any():
        return Model(np.zeros(buckets, np.float32), 0.0, ngrams, known=False)
    k = len(chosen)
    sizes = np.array([len(c) for c in sets], np.int64)
    # places in ``chosen`` stay as narrow as they come; rows are widened in groups of about FIT_BLOCK places
    ends = np.cumsum(sizes)
    first = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]) + 1, FIT_BLOCK), "right")).tolist()
    groups = [(a, z, np.concatenate(sets[a:z])) for a, z in zip(first, [*first[1:], len(y)]) if a < z and sizes[a:z].any()]

    def each():
        for a, z, places in groups:
            col = places.astype(np.int64)
            yield a, z, np.repeat(np.arange(z - a), sizes[a:z]), col, ratios[col]

    w, b, t = np.zeros(k), float(np.log(y.sum() / (~y).sum())), y.astype(float)
    # a bound of the logistic loss's curvature gives each coordinate its step; Nesterov momentum
    wide, curve = np.zeros(len(y)), np.zeros(k)
    for a, z, row, col, x in each():
        wide[a:z] = np.bincount(row, np.abs(x), z - a)
        curve += np.bincount(col, np.abs(x) * (wide[a:z][row] + 1), k)
    step = 1 / (0.25 * curve + l2)
    step_b = 1 / (0.25 * (wide + 1).sum())
    v, vb = w, b
    for i in range(steps):
        slope, total = l2 * v, 0.0
        seen = np.zeros(len(y), bool)
        for a, z, row, col, x in each():
            e = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * v[col], z - a) + vb, -30, 30))) - t[a:z]
            slope += np.bincount(col, x * e[row], k)
            total += e.sum()
            seen[a:z] = True
        total += (1 / (1 + np.exp(-vb)) - t[~seen]).sum()       # rows without any chosen feature
        w2 = v - step * slope
        b2 = vb - step_b * total
        f = i / (i + 3)
        v, vb, w, b = w2 + f * (w2 - w), b2 + f * (b2 - b), w2, b2
    weights = np.zeros(buckets, np.float32)
    weights[chosen] = w * ratios
    return Model(weights, float(b), ngrams)


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", train_rows: int = TRAIN_ROWS, ngrams: tuple[int, ...] = NGRAMS,
          buckets: int = BUCKETS, n_features: int = FEATURES) -> Model:
    """Fit on at most ``train_rows`` labelled rows where ``learn`` (on the id) holds.

    The ids of the sample, the smallest by hash, are broadcast (bounded by ``train_rows``); its texts
    go to a checkpoint of SAMPLE_PARTS partitions.  Counts are added by slices of the buckets; the
    driver gets those sums and, for each sampled row, the chosen features it has.  Rows without a
    label or an id are left out; a label above 0 is toxic, and an id with several labels is if one says
    so.  An id that repeats counts once, null texts as empty; with no labelled rows, or of one kind
    only, the model knows nothing and scores 0.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = (labels.where(learn & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col).cast("double") > 0).cast("int")).alias("y"))
              .orderBy(F.xxhash64("id"), "id").limit(train_rows))
    # an id that repeats brings one of its texts, the first in the order of a digest
    texts = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("t")).join(F.broadcast(sample), "id")
    rows = reliable(texts.groupBy("id").agg(F.min_by(F.struct("t", "y"), F.xxhash64("t")).alias("x")).select("x.t", "x.y")
                    .repartition(SAMPLE_PARTS))
    width = -(-buckets // SLICES)

    def count(batches):
        seen = np.zeros((2, width * SLICES), np.int32)
        total = np.zeros(2, np.int64)
        for b in batches:
            data, off = text_buffer(b.column(0))
            for i, y in enumerate(b.column(1).to_pylist()):
                seen[y, features(data[off[i]:off[i + 1]], ngrams, buckets)] += 1
                total[y] += 1
        part = seen.reshape(2, SLICES, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([part[1, s].tobytes() for s in range(SLICES)], pa.binary()),
             pa.array([part[0, s].tobytes() for s in range(SLICES)], pa.binary()),
             pa.array([total[1]] * SLICES, pa.int64()), pa.array([total[0]] * SLICES, pa.int64())],
            ["slice", "p", "q", "n", "m"])

    def add(t: pa.Table) -> pa.Table:
        sums = [sum(np.frombuffer(x, np.int32).astype(np.int64) for x in t[c].to_pylist()).tobytes() for c in "pq"]
        return pa.table({"slice": t["slice"][:1], "p": pa.array([sums[0]], pa.binary()),
                         "q": pa.array([sums[1]], pa.binary()), "n": pa.array([sum(t["n"].to_pylist())], pa.int64()),
                         "m": pa.array([sum(t["m"].to_pylist())], pa.int64())})

    kind = "slice int, p binary, q binary, n long, m long"
    got = sorted(rows.mapInArrow(count, kind).groupBy("slice").applyInArrow(add, kind).collect())
    if not got or not got[0]["n"] or not got[0]["m"]:
        return fit([], np.zeros(0), np.zeros(0, int), np.zeros(0), buckets, ngrams)
    p, q = (np.concatenate([np.frombuffer(r[c], np.int64) for r in got])[:buckets] for c in "pq")
    chosen, ratios = choose(p, q, got[0]["n"], got[0]["m"], n_features)

    def pick(batches):
        for b in batches:
            data, off = text_buffer(b.column(0))
            sets = []
            for i in range(b.num_rows):
                f = features(data[off[i]:off[i + 1]], ngrams, buckets)
                sets.append(np.flatnonzero(np.isin(chosen, f, assume_unique=True)).astype(np.int16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), b.column(1)], ["f", "y"])

    found = sorted((r["f"], r["y"]) for r in rows.mapInArrow(pick, "f binary, y int").collect())
    return fit([np.frombuffer(f, np.int16) for f, _ in found], np.array([y for _, y in found], bool),
               chosen, ratios, buckets, ngrams)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
          prefix: str = "") -> DataFrame:
    """Columns ``keep`` of every row with score (0 to 1) and predicted (1 from 0.5) of its whole text.

    Null counts as empty, whose score is the bias alone.  Only the text is an input; repeated rows
    get the same score.  One narrow pass, no shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)   # of a fixed size: BUCKETS weights

    def decide(texts):
        data, off = text_buffer(texts)
        p = np.array([shared.value.score(data[off[i]:off[i + 1]]) for i in range(len(texts))], float)
        return pa.array(p), pa.array((p >= 0.5).astype(np.int32))

    return map_rows(docs, keep, plain_text(text_col), decide, [(f"{prefix}score", "double"), (f"{prefix}predicted", "int")])
