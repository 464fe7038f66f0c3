"""Nearest neighbours by vantage-point trees, one for each shard of the vectors.

A node holds a vantage point and the median distance of its other points; the triangle inequality
tells which side cannot hold anything nearer than what has been found.  ``relax`` multiplies that
bound: 1 prunes only what cannot matter (exact search), more prunes earlier and may miss some.

What the bounds leave of a leaf is met by matrix products in single precision, whose error is bounded;
only what may be among the nearest by them gets its distance, in double precision.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantsilo.llm.common import reliable, small_batches

#: Rows and bytes of a shard (one tree, one row of the index), rows of a leaf.
SHARD_ROWS, SHARD_BYTES, LEAF = 4096, 2 << 20, 512
#: Queries of a pass over the index, and bytes of their vectors (one broadcast).
QUERY_ROWS, QUERY_BYTES = 65536, 32 << 20
#: Parts of the index for each core: a pass returns ``k`` rows for a query and part.
PARTS_PER_CORE = 2
#: Queries that go down a tree together, and those of one matrix product.
CHUNK, TILE = 4096, 512
#: Bytes of vectors that wait for the rest of their shard, and of the differences that are squared at once.
HELD_BYTES, PAIR_BYTES = 64 << 20, 8 << 20
#: Candidates that wait at most, and rows of a batch of answers.
WAITING, ANSWERS = 1 << 18, 1 << 17
#: Factor on the pruning bound in the registered query: exact.
RELAX = 1.0
_NONE = np.iinfo(np.int64).max
#: Rounding of single precision; room for what underflows there; room for rounding of distances in double precision.
_UNIT, _TINY, _ROUND = 2.0 ** -24, 2.0 ** -120, 1e-9
#: Squares of longer distances may overflow; those of shorter ones than this (and the root of the length) vanish.
_HUGE, _VANISH = 1e153, 2.0 ** -536


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows, squares added in the order of the components."""
    total = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        diff = a[:, k, None] - b[None, :, k]
        total += diff * diff
    return np.sqrt(total)


def paired(a: np.ndarray, r: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """``distances`` of the pairs (a[r], b[c]) alone, the same to the last bit."""
    out = np.empty(len(r))
    step = max(1, PAIR_BYTES // (8 * max(1, a.shape[1])))
    for i in range(0, len(r), step):
        diff = a[r[i:i + step]] - b[c[i:i + step]]
        diff *= diff
        total = np.zeros(len(diff))
        for k in range(a.shape[1]):
            total += diff[:, k]
        out[i:i + step] = np.sqrt(total)
    return out


class Nearest:
    """The ``k`` nearest seen so far for each query: nearest first, equal ones by id; inf where there are fewer.

    What is offered waits until ``settle``; till then ``d`` may be too large, which only lets more through.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.d = np.full((queries, k), np.inf)
        self.i = np.full((queries, k), _NONE)
        self._wait: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._waiting = 0

    def offer(self, who: np.ndarray, d: np.ndarray, ids: np.ndarray) -> None:
        """Candidates ``ids`` at distances ``d`` of queries ``who``."""
        last = self.d[who, -1]
        nearer = (d < last) | ((d == last) & (ids < self.i[who, -1]))
        if nearer.any():
            self._wait.append((who[nearer], d[nearer], ids[nearer]))
            self._waiting += len(self._wait[-1][0])

    def settle(self, most: int = 0) -> None:
        """Count what waits, if it is more than ``most``."""
        if self._waiting <= most:
            return
        who, d, ids = (np.concatenate(x) for x in zip(*self._wait))
        self._wait, self._waiting = [], 0
        own = np.unique(who)
        who = np.concatenate([np.repeat(own, self.k), who])
        d = np.concatenate([self.d[own].ravel(), d])
        ids = np.concatenate([self.i[own].ravel(), ids])
        by = np.lexsort((ids, d, who))
        who, d, ids = who[by], d[by], ids[by]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        top = place < self.k                        # every query of ``own`` has k entries at least
        self.d[own], self.i[own] = d[top].reshape(-1, self.k), ids[top].reshape(-1, self.k)


class VPTree:
    """Nodes are (vantage row, radius, inside, outside), or (-1, 0, first row, last row) of a leaf.

    Vantage points are the first rows, in the order of their nodes.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order: list[np.ndarray] = []
        points: list[int] = []
        self.nodes: list[tuple[int, float, int, int]] = []
        placed = 0
        todo = [(np.arange(len(ids)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            me = len(self.nodes)
            if parent >= 0:
                node = list(self.nodes[parent])
                node[2 + side] = me
                self.nodes[parent] = tuple(node)
            inside = outside = None
            if len(rows) > leaf:
                # a point at the rim splits better than one in the middle
                vp = rows[np.argmax(distances(vectors[rows[:1]], vectors[rows])[0])]
                rest = rows[rows != vp]
                d = distances(vectors[vp:vp + 1], vectors[rest])[0]
                radius = float(np.median(d))
                inside, outside = rest[d <= radius], rest[d > radius]
            if inside is None or not len(outside):      # few points, or more than half at one distance
                self.nodes.append((-1, 0.0, placed, placed + len(rows)))
                order.append(rows)
                placed += len(rows)
                continue
            self.nodes.append((len(points), radius, -1, -1))
            points.append(int(vp))
            todo += [(outside, me, 1), (inside, me, 0)]
        self.points = len(points)
        self.nodes = [n if n[0] >= 0 else (-1, 0.0, n[2] + len(points), n[3] + len(points)) for n in self.nodes]
        at = np.concatenate([np.array(points, int), *order])
        self.ids, self.vectors = ids[at], vectors[at]
        with np.errstate(over="ignore", under="ignore"):
            single = self.vectors.astype(np.float32)
        if np.array_equal(single, self.vectors):
            self.vectors = single                       # the same numbers in half the room

    def leaves(self) -> list[tuple[int, int, list[tuple[int, int]]]]:
        """(first row, last row, way) of each leaf; way: vantage row and side (1: outside) of the nodes above."""
        out, todo = [], [(0, [])]
        while todo:
            node, way = todo.pop()
            row, _, a, b = self.nodes[node]
            if row < 0:
                out.append((a, b, way))
            else:
                todo += [(b, [*way, (row, 1)]), (a, [*way, (row, 0)])]
        return out

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float = 1.0,
               found: Nearest | None = None):
        """(distances, ids) of shape (queries, k), nearest first, equal ones by id; inf where there are fewer.

        ``found``, if given, holds what other trees gave and takes what this one has; its owner settles
        it.  Queries go to the leaf of their own side first, then to those that the bounds of their way
        leave.
        """
        near = Nearest(len(queries), k) if found is None else found
        if len(self.ids) and len(queries):
            with np.errstate(over="ignore", invalid="ignore", under="ignore"):
                self._search(query_ids, queries, relax, near)
        if found is None:
            near.settle()
        return near.d, near.i

    def _search(self, query_ids: np.ndarray, queries: np.ndarray, relax: float, found: Nearest) -> None:
        dim = queries.shape[1]
        # a power of two brings all components below 1; the shard's middle goes to the origin
        largest = max(np.abs(queries).max(initial=0), float(np.abs(self.vectors).max(initial=0)))
        scale = 2.0 ** -min(1020, max(-1000, int(np.frexp(largest)[1]) + 1))
        vectors = self.vectors.astype(np.float64)
        middle = (vectors * scale).mean(axis=0)
        moved = vectors * scale - middle
        squares = (moved * moved).sum(axis=1)
        reach = np.sqrt(squares.max())
        rows = np.empty((len(moved), dim + 1), np.float32)
        rows[:, :-1], rows[:, -1] = -2 * moved, squares
        leaves = self.leaves()
        for i in range(0, len(queries), CHUNK):
            part = slice(i, i + CHUNK)
            pairs = _Chunk(found, i, query_ids[part], queries[part], scale, middle, reach, self.ids, vectors, rows)
            home, bound = self._bounds(leaves, pairs)
            for j, (a, b, _) in enumerate(leaves):
                pairs.meet(np.flatnonzero(home == j), a, b)
            pairs.offer()
            last = pairs.last
            for j, (a, b, _) in enumerate(leaves):
                # points at least ``bound`` away may still concern these; ties and rounding count as such
                pairs.meet(np.flatnonzero((home != j) & ~(bound[j] * relax > last)), a, b)
            pairs.offer()

    def _bounds(self, leaves, pairs: _Chunk) -> tuple[np.ndarray, np.ndarray]:
        """For each query the leaf on its own side of all nodes; for each leaf and query the least distance of the leaf's points, scaled."""
        least, most = pairs.vantage(self.points)
        room = pairs.room
        gaps = {(v, side): r * (1 - _ROUND) - room - most[v] if side else least[v] - r * (1 + _ROUND) - room
                for v, r in ((n[0], n[1] * pairs.scale) for n in self.nodes if n[0] >= 0) for side in (0, 1)}
        bound = np.zeros((len(leaves), len(pairs.ids)))
        for j, (_, _, way) in enumerate(leaves):
            for v, side in way:
                np.fmax(bound[j], gaps[v, side], out=bound[j])
        return bound.argmin(axis=0), bound


class _Chunk:
    """Some queries of a search, moved as the tree's vectors are; ``first`` is the place of the first of them."""

    def __init__(self, found: Nearest, first: int, ids, queries, scale, middle, reach, row_ids, vectors, rows):
        self.found, self.first, self.ids, self.queries, self.scale = found, first, ids, queries, scale
        self.row_ids, self.vectors, self.rows = row_ids, vectors, rows
        self._met: list[tuple[np.ndarray, np.ndarray]] = []
        self._many = 0
        dim = queries.shape[1]
        moved = queries * scale - middle
        self.squares = (moved * moved).sum(axis=1)
        self.moved = np.ones((len(moved), dim + 1), np.float32)
        self.moved[:, :-1] = moved
        far = np.sqrt(self.squares) + reach
        #: bounds the error of a squared distance as single precision has it
        self.slack = (dim + 16) * _UNIT * far * far + _TINY
        #: what a distance may have lost by squares that vanish
        self.room = np.sqrt(dim + 1.0) * _VANISH * scale

        self._limit()

    def _limit(self) -> None:
        """Scaled distances that no candidate may exceed, and what the matrix products may not; ``open``: some have none."""
        d = self.found.d[self.first:self.first + len(self.ids), -1]
        self.last = np.where(d > _HUGE, np.inf, d * self.scale * (1 + _ROUND) + self.room)
        self.most = self._single(self.last, slice(None))
        self.open = bool(np.isinf(self.most).any())

    def _single(self, d: np.ndarray, q) -> np.ndarray:
        return np.nextafter((d * d - self.squares[q] + self.slack[q]).astype(np.float32), np.float32(np.inf))

    def vantage(self, points: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest scaled distances of the vantage points, which are met on the way."""
        if points:
            self.meet(np.arange(len(self.ids)), 0, points)
        s = self.rows[:points] @ self.moved.T + self.squares
        return np.sqrt(np.maximum(s - self.slack, 0)), np.sqrt(np.maximum(s + self.slack, 0))

    def meet(self, who: np.ndarray, a: int, b: int) -> None:
        """Take what may be among the nearest of queries ``who`` from the tree's rows ``a`` to ``b``."""
        ids, rows = self.row_ids[a:b], self.rows[a:b].T
        room = np.empty(min(len(who), TILE) * len(ids), np.float32)
        for i in range(0, len(who), TILE):
            q = who[i:i + TILE]
            s = np.matmul(self.moved[q], rows, out=room[:len(q) * len(ids)].reshape(len(q), len(ids)))
            most = self.most[q]
            if self.open and len(ids) > self.found.k:
                fresh = np.flatnonzero(np.isinf(most))
                most[fresh] = self._kth(s[fresh], q[fresh], ids)
            some = np.flatnonzero(~(s.min(axis=1) > most))
            if not len(some):
                continue
            r, c = np.divmod(np.flatnonzero(~(s[some] > most[some, None])), len(ids))
            self._met.append((q[some[r]], a + c))
            self._many += len(r)
            if self._many > WAITING:
                self.offer()

    def offer(self) -> None:
        """Offer what was met by its distance; settle where it may bring the limits down."""
        if self._met:
            r, c = (np.concatenate(x) for x in zip(*self._met))
            self._met, self._many = [], 0
            ids = self.row_ids[c]
            other = ids != self.ids[r]
            r, c, ids = r[other], c[other], ids[other]
            self.found.offer(self.first + r, paired(self.queries, r, self.vectors, c), ids)
        self.found.settle(0 if self.open else min(WAITING, 2 * len(self.found.d)))
        self._limit()

    def _kth(self, s: np.ndarray, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """A first limit: the k-th of these rows is within it."""
        k = self.found.k
        s = np.where(ids[None, :] == self.ids[q][:, None], np.float32(np.inf), s)
        kth = np.partition(s, k - 1, axis=1)[:, k - 1].astype(np.float64)
        d = np.sqrt(np.maximum(kth + self.squares[q] + self.slack[q], 0))
        return self._single(np.where(d > _HUGE * self.scale, np.inf, d * (1 + _ROUND) + self.room), q)


def _matrix(col, dim: int) -> np.ndarray:
    """float64 matrix of an Arrow list column whose rows all have ``dim`` components."""
    flat = (col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _by_length(ids, vectors):
    """(dim, ids, matrix) of the rows of an Arrow id and list column, for each length of the vectors."""
    size = np.diff(np.asarray(vectors.offsets))
    for dim in np.unique(size).tolist():
        at = pa.array(np.flatnonzero(size == dim))
        yield dim, ids.take(at).to_numpy(), _matrix(vectors.take(at), dim)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim) of the rows that take part: vectors with components, all finite, not all zero."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .where(finite & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, relax: float = RELAX, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest rows of ``vectors`` for every row of ``queries`` (same columns).

    Returns query_id, rank (from 1), vec_id, score (Euclidean distance in double precision on the
    original vectors), ties to the smaller id.  A row is no candidate for the query of its id.
    Rows whose id or vector is null, and vectors that are empty, zero or hold null or non-finite
    components, take no part; vectors of other lengths than the query's are no candidates.  Of
    queries that repeat an id the smallest vector counts; repeated candidates count each.

    Rows are dealt evenly to a few parts a core, each a sequence of shards of at most ``shard_rows``; a
    shard's tree is one row of the index.  Blocks of about ``query_rows`` queries, one broadcast each,
    pass over the index one after the other; a task carries what it has found from tree to tree, and
    its answer is ``k`` rows for a query, merged by query.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    asked = reliable(usable(queries, id_col, vector_col).groupBy("id", "dim").agg(F.min("v").alias("v")))
    m, size = asked.agg(F.count("*"), F.coalesce(F.sum(8 * F.col("dim").cast("long")), F.lit(0))).first()
    blocks = max(1, -(-m // query_rows), -(-size // QUERY_BYTES))

    def build(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def trees(dim: int, rest: bool):
            ids, v = held.pop(dim)
            rows = max(1, min(shard_rows, SHARD_BYTES // (8 * dim)))
            whole = len(ids) if rest else len(ids) // rows * rows
            for i in range(0, whole, rows):
                tree = pickle.dumps(VPTree(ids[i:i + rows], v[i:i + rows]))
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([tree], pa.binary())], ["dim", "tree"])
            if whole < len(ids):
                held[dim] = ids[whole:].copy(), v[whole:].copy()

        for b in batches:
            for dim, ids, v in _by_length(b.column(0), b.column(1)):
                if dim in held:
                    ids, v = np.concatenate([held[dim][0], ids]), np.concatenate([held[dim][1], v])
                held[dim] = ids, v
                yield from trees(dim, False)
            if sum(v.nbytes for _, v in held.values()) > HELD_BYTES:       # many lengths, each with few rows
                for dim in sorted(held):
                    yield from trees(dim, True)
        for dim in sorted(held):
            yield from trees(dim, True)

    parts = PARTS_PER_CORE * max(1, spark.sparkContext.defaultParallelism)
    dealt = usable(vectors, id_col, vector_col).withColumn("no", F.monotonically_increasing_id()).repartition(parts, "no")
    index = reliable(dealt.select("id", "v").mapInArrow(build, "dim int, tree binary"))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    out = None
    for b in range(blocks):
        found = _pass(index, asked.where(block == b).select("id", "v"), k, relax)
        out = found if out is None else out.unionByName(found)
    return out


def _pass(index: DataFrame, block: DataFrame, k: int, relax: float) -> DataFrame:
    """``nearest`` for the queries of ``block``, which the driver hands to all tasks."""
    t = block.toArrow()
    of = {d: (i, q) for d, i, q in _by_length(t["id"].combine_chunks(), t["v"].combine_chunks())} if len(t) else {}
    queries = index.sparkSession.sparkContext.broadcast(of)
    rows = max(1, ANSWERS // k)

    def search(batches):
        asked = queries.value
        found = {dim: Nearest(len(ids), k) for dim, (ids, _) in asked.items()}
        for b in batches:
            for dim, tree in zip(b.column(0).to_pylist(), b.column(1)):
                if dim in asked:
                    pickle.loads(tree.as_py()).search(*asked[dim], k, relax, found[dim])
        for dim, near in found.items():
            near.settle()
            for i in range(0, len(near.d), rows):
                d, ids = near.d[i:i + rows], near.i[i:i + rows]
                hit = ids != _NONE
                qid = np.repeat(asked[dim][0][i:i + rows], hit.sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(qid), pa.array(ids[hit]), pa.array(d[hit])],
                                                 ["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    out = reliable(index.mapInArrow(search, "query_id long, vec_id long, score double")
                   .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                   .select("query_id", "rank", "vec_id", "score"))
    queries.destroy()
    return out
