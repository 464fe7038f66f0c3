"""Hard negatives: anchor-candidate tiles of integer inner products by Strassen's multiplication.

Anchors go in blocks of bounded size, one broadcast each; every task multiplies its candidates with the
block tile by tile and keeps, for each anchor, a heap of the first positives.  Heaps of all tasks merge
to the block's positives; these give windows of scores, and a second pass over the same tiles keeps a
heap of the first negatives for each window, merged the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantsilo.llm.common import reliable, small_batches

POSITIVES, NEGATIVES = 5, 10
#: A window holds scores from LOW to HIGH hundredths of the positive's score.
LOW, HIGH = 30, 90
SCALE = 256
#: Products of blocks with a side of at most this are made directly.
CUTOFF = 16
#: Bytes of an anchor block (broadcast), and rows of a tile on either side.
BLOCK_BYTES, TILE_ANCHORS, TILE_ROWS = 8 << 20, 512, 2048
_MAX = np.iinfo(np.int64).max


def strassen(a: np.ndarray, b: np.ndarray, cutoff: int = CUTOFF) -> np.ndarray:
    """a @ b.T for int64 matrices by Strassen's recursion, sides padded to even with zeros.

    Sums are exact modulo 2**64, so the product is exact whenever its entries fit 64 bits.
    """
    (p, n), q = a.shape, len(b)
    if min(p, n, q) <= cutoff:
        return a @ b.T
    a = np.pad(a, ((0, p % 2), (0, n % 2)))
    b = np.pad(b, ((0, q % 2), (0, n % 2)))
    i, j, k = len(a) // 2, len(b) // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    # quarters of b's transpose, kept as rows of b
    b11, b21, b12, b22 = b[:j, :k], b[:j, k:], b[j:, :k], b[j:, k:]
    m1 = strassen(a11 + a22, b11 + b22, cutoff)
    m2 = strassen(a21 + a22, b11, cutoff)
    m3 = strassen(a11, b12 - b22, cutoff)
    m4 = strassen(a22, b21 - b11, cutoff)
    m5 = strassen(a11 + a12, b22, cutoff)
    m6 = strassen(a21 - a11, b11 + b12, cutoff)
    m7 = strassen(a12 - a22, b21 + b22, cutoff)
    out = np.empty((2 * i, 2 * j), np.int64)
    out[:i, :j] = m1 + m4 - m5 + m7
    out[:i, j:] = m3 + m5
    out[i:, :j] = m2 + m4
    out[i:, j:] = m1 - m2 + m3 + m6
    return out[:p, :q]


class Heaps:
    """For each slot the first ``k`` (score, id) seen, highest score first, equal ones by smaller id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), -_MAX - 1)
        self.id = np.full((slots, k), _MAX)
        self.used = np.zeros((slots, k), bool)

    def beaten(self, slots, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Where a (slot, candidate) entry of the score matrix comes before the slot's last."""
        last, full = self.score[slots, -1][:, None], self.used[slots, -1][:, None]
        return ~full | (scores > last) | ((scores == last) & (ids[None, :] < self.id[slots, -1][:, None]))

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        own = np.unique(slot)
        held = self.used[own]
        slot = np.concatenate([slot, np.repeat(own, held.sum(1))])
        score = np.concatenate([score, self.score[own][held]])
        ids = np.concatenate([ids, self.id[own][held]])
        by = np.lexsort((ids, -1 - score, slot))       # -1 - x turns the order of all 64-bit integers round
        slot, score, ids = slot[by], score[by], ids[by]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        top = place < self.k
        slot, place = slot[top], place[top]
        self.score[slot, place], self.id[slot, place], self.used[slot, place] = score[top], ids[top], True

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, _ = np.nonzero(self.used)
        return slot, self.score[self.used], self.id[self.used]


def usable(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v) of the rows that take part, components as floor(256 * x).

    Every seventh id has its label moved on by one, modulo 10.  Components beyond 64 bits are held at
    the largest and smallest 64-bit integer.
    """
    i, v, label = F.col(f"`{id_col}`").cast("long"), F.col(f"`{vector_col}`").cast("array<double>"), F.col(f"`{label_col}`").cast("long")
    return (df.where(i.isNotNull() & v.isNotNull() & label.isNotNull()).select(
                i.alias("id"), F.when(i % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), v.alias("x"))
            .where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
            .select("id", "label", F.transform("x", lambda c: F.floor(c * SCALE).cast("long")).alias("v")))


def _tiles(batch: pa.RecordBatch, dims):
    """(dim, ids, labels, int64 matrix) of the batch's rows, by vector length and in tiles."""
    ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    v = batch.column(2)
    flat, off = v.values.to_numpy(zero_copy_only=False), np.asarray(v.offsets)
    size = np.diff(off)
    for dim in np.intersect1d(size, dims).tolist():
        at = np.flatnonzero(size == dim)
        for i in range(0, len(at), TILE_ROWS):
            rows = at[i:i + TILE_ROWS]
            yield dim, ids[rows], labels[rows], flat[off[rows][:, None] + np.arange(dim)].astype(np.int64)


def _products(block: dict, batches):
    """Over all tiles: the anchors' positions in the block, candidates' ids and labels, and the scores."""
    dims = np.array(sorted(block["of"]))
    for b in batches:
        for dim, ids, labels, m in _tiles(b, dims):
            slots, anchors = block["of"][dim]
            for i in range(0, len(slots), TILE_ANCHORS):
                yield slots[i:i + TILE_ANCHORS], ids, labels, strassen(anchors[i:i + TILE_ANCHORS], m)


def mine(vectors: DataFrame, anchors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Hard negatives of every row of ``anchors`` (same columns) among the rows of ``vectors``.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  Scores are inner
    products of the components as floor(256 * x), 64-bit.  An anchor's positives are the first
    ``positives`` rows with its label and another id; for each the first ``negatives`` rows with another
    label whose score lies in the window of ``low`` to ``high`` hundredths of the positive's.  Higher
    scores come first, ties by the smaller id.  Rows whose id, label or vector is null or holds a null or
    non-finite component take no part; vectors meet those of their own length; empty vectors have the
    score 0 with each other.  Of anchors that repeat an id the smallest (label, vector) counts;
    repeated candidates count each.  Other columns are ignored; empty tables give no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    base = reliable(usable(vectors, id_col, vector_col, label_col))
    asked = reliable(usable(anchors, id_col, vector_col, label_col)
                     .groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v"))
    size = asked.agg(F.sum(F.size("v") * 8 + 64 + 48 * positives)).first()[0] or 0
    blocks = max(1, -(-2 * size // block_bytes))
    out = None
    for k in range(blocks):        # the stated queries against all rows, in blocks of a bounded size
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).orderBy("id").toArrow()
        found = _block(spark, base, part, positives, negatives, low, high)
        out = found if out is None else out.unionByName(found)
    return out


def _block(spark, base: DataFrame, part: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    ids, labels = part["id"].to_numpy(), part["label"].to_numpy()
    lists = part["v"].to_pylist()
    sizes = np.array([len(v) for v in lists], np.int64)
    of = {int(d): (at := np.flatnonzero(sizes == d), np.array([lists[i] for i in at], np.int64).reshape(len(at), int(d)))
          for d in np.unique(sizes)}
    block = spark.sparkContext.broadcast({"ids": ids, "labels": labels, "of": of})

    def first_positives(batches):
        a = block.value
        heaps = Heaps(len(a["ids"]), positives)
        for slots, cid, clabel, s in _products(a, batches):
            fits = heaps.beaten(slots, s, cid)
            fits &= (clabel[None, :] == a["labels"][slots][:, None]) & (cid[None, :] != a["ids"][slots][:, None])
            r, c = np.nonzero(fits)
            heaps.offer(slots[r], s[r, c], cid[c])
        slot, score, cid = heaps.rows()
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(score), pa.array(cid)],
                                         ["slot", "score", "id"])

    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id")
    top = (base.mapInArrow(first_positives, "slot long, score long, id long")
           .withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives))
    got = top.orderBy("slot", "place").toArrow()        # at most ``positives`` rows for each anchor of the block
    slot, score, pid = (got[c].to_numpy() for c in ("slot", "score", "id"))
    windows = spark.sparkContext.broadcast({
        "first": np.searchsorted(slot, np.arange(len(ids) + 1)), "slot": slot, "score": score, "id": pid,
        "least": np.array([-(-low * int(s) // 100) for s in score], np.int64),
        "most": np.array([high * int(s) // 100 for s in score], np.int64)})

    def first_negatives(batches):
        a, w = block.value, windows.value
        heaps = Heaps(len(w["slot"]), negatives)
        for slots, cid, clabel, s in _products(a, batches):
            other = clabel[None, :] != a["labels"][slots][:, None]
            for j in range(positives):
                at = w["first"][slots] + j
                has = at < w["first"][slots + 1]
                at, mine_s, mine_o = at[has], s[has], other[has]
                fits = mine_o & (mine_s >= w["least"][at][:, None]) & (mine_s <= w["most"][at][:, None])
                fits &= heaps.beaten(at, mine_s, cid)
                r, c = np.nonzero(fits)
                heaps.offer(at[r], mine_s[r, c], cid[c])
        at, score, cid = heaps.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(a["ids"][w["slot"][at]], pa.int64()), pa.array(w["id"][at], pa.int64()),
             pa.array(w["score"][at], pa.int64()), pa.array(cid), pa.array(score)],
            ["window", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    order = Window.partitionBy("window").orderBy(F.desc("negative_score"), "negative_id")
    return (base.mapInArrow(first_negatives, "window long, anchor_id long, positive_id long, positive_score long, "
                                             "negative_id long, negative_score long")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
