"""Ranked lexical search: exact inner products of sparse term vectors by ball trees.

Queries go in blocks of bounded size.  One pass over all documents counts the terms of the block's
queries in each (other terms cannot add to an inner product), which also gives the corpus statistics.
Every task then builds ball trees over the document vectors it holds.  A ball has a centroid c and a
radius r, so no vector in it has a product with q above <q, c> + |q| r; it also knows the radius along
each single term, whose sum over the query's terms is the smaller one for sparse text.  Bounds are
rounded up.  A query opens balls best-first and stops at the first bound below its current last score; leaves are
scored in 64-bit integers.  Both sides are scaled by the root of the term weights, which leaves
products as they are and keeps frequent terms from widening the balls.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantsilo.llm.common import plain_text, reliable, small_batches
from quantsilo.plans.topk import top_k_per_key

#: Terms are runs of digits, ASCII letters and characters beyond ASCII; bytes of UTF-8 tell them apart as well.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
OTHER = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Bytes of text whose terms are held at once.
SEGMENT = 1 << 20
#: Bytes of the terms of a block of queries (broadcast); one query is never divided.
BLOCK_BYTES = 4 << 20
#: Documents and stored terms of a tree, documents of a leaf.
TREE_ROWS, TREE_TERMS, LEAF = 8192, 1 << 22, 4


def terms(text: bytes):
    """Lists of the terms of a text, A-Z lower-cased, piece by piece."""
    text = text.lower()
    at = 0
    while at < len(text):
        end = at + SEGMENT
        if end < len(text):
            stop = OTHER.search(text, end)
            end = stop.start() if stop else len(text)
        yield TERM.findall(text, at, end)
        at = end


def _bytes(x) -> bytes:
    return x.as_buffer().to_pybytes() if x.is_valid else b""


class Weights:
    """Integer weights of the terms of a block, from the corpus statistics."""

    def __init__(self, n_docs: int, n_terms: int, df: np.ndarray):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)

    def values(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """(10**9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L, for a term found ``tf`` times among ``n``."""
        m = 10 + (90 * n * self.n_docs) // self.n_terms
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class BallTree:
    """Balls over sparse rows; a node is (first row, last row, left child or -1)."""

    def __init__(self, at: np.ndarray, term: np.ndarray, value: np.ndarray, scale: np.ndarray, leaf: int = LEAF):
        """Rows are term[at[i]:at[i+1]] with integer values; ``scale`` is the root of each term's weight."""
        self._scale = scale
        real = value * scale[term]
        square = _sums(real * real, at)
        rows = np.arange(len(at) - 1)
        todo, self.nodes, balls, radius = [(0, len(rows), rows)], [], [], []
        order = np.empty(len(rows), np.int64)
        made, k = 1, 0
        while k < len(todo):                        # level by level, so that two children stand side by side
            lo, hi, own = todo[k]
            t, v, a = _take(at, term, real, own)
            ct, back = np.unique(t, return_inverse=True)
            c = np.bincount(back, v, len(ct)) / max(1, len(own))
            most = np.zeros(len(ct))
            np.maximum.at(most, back, v)
            cc = float(c @ c)
            r2 = square[own] - 2 * _sums(v * c[back], a) + cc + 1e-11 * (square[own] + cc)
            radius.append(math.sqrt(max(0.0, float(r2.max(initial=0.0)))) * (1 + 1e-11))
            balls.append((np.full(len(ct), k), ct, c, most - c))
            k += 1
            if len(own) <= leaf:
                order[lo:hi] = own
                self.nodes.append((lo, hi, -1))
                continue
            # two rows far apart; the others go by which of them is nearer, half to each side
            one = _distances(a, back, v, len(ct), square[own], int(np.argmax(r2)))
            two = _distances(a, back, v, len(ct), square[own], int(np.argmax(one)))
            by = np.argsort(one - two, kind="stable")
            half = len(own) // 2
            todo += [(lo, lo + half, own[by[:half]]), (lo + half, hi, own[by[half:]])]
            self.nodes.append((lo, hi, made))
            made += 2
        self.rows = order
        self.term, self.value, self.at = _take(at, term, value, order)
        # the balls by term: the nodes that have it, the centroid there, and how far the farthest row is above it
        node, ct, c, above = (np.concatenate(x) for x in zip(*balls))
        by = np.argsort(ct, kind="stable")
        self._node, self._c, self._above = node[by], c[by], above[by]
        self._first = np.searchsorted(ct[by], np.arange(len(scale) + 1))
        self._radius = np.array(radius)

    def bounds(self, own: np.ndarray, norm: float) -> np.ndarray:
        """For every node an integer that no row in it can exceed, for a query of the terms ``own``.

        <q, c> plus what a row can lie above c in the direction of q: |q| times the radius, or, where
        that is less, the radii along the query's terms.
        """
        first, n = self._first[own], self._first[own + 1] - self._first[own]
        pick = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        q, node = np.repeat(self._scale[own], n), self._node[pick]
        near = np.bincount(node, q * self._c[pick], len(self.nodes))
        along = np.bincount(node, q * self._above[pick], len(self.nodes))
        return np.floor((near + np.minimum(norm * self._radius, along)) * (1 + 1e-9)).astype(np.int64) + 1

    def search(self, own: np.ndarray, weight: np.ndarray, norm: float, first: "First", ids) -> int:
        """Offers the rows that may be among the first; returns how many were scored.

        ``own`` are the query's terms, ``weight`` their integer weights by term, ``ids`` the rows' ids.
        """
        scored, bound = 0, self.bounds(own, norm).tolist()
        heap = [(-bound[0], 0)]
        while heap:
            up, node = heapq.heappop(heap)
            if -up < first.least():
                break
            lo, hi, left = self.nodes[node]
            if left >= 0:
                for child in (left, left + 1):
                    if bound[child] >= first.least():
                        heapq.heappush(heap, (-bound[child], child))
                continue
            a = self.at[lo:hi + 1]
            s = _sums(self.value[a[0]:a[-1]] * weight[self.term[a[0]:a[-1]]], a - a[0])
            scored += hi - lo
            for i in np.flatnonzero(s >= max(1, first.least())).tolist():
                first.offer(int(s[i]), ids[self.rows[lo + i]])
        return scored


def _sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of x[at[i]:at[i+1]]; exact for integers."""
    if x.dtype == np.int64:
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(x)])
        return total[at[1:]] - total[at[:-1]]
    return np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at)), x, len(at) - 1)


def _take(at, term, value, rows):
    n = at[rows + 1] - at[rows]
    to = np.concatenate([[0], np.cumsum(n)])
    pick = np.arange(to[-1]) + np.repeat(at[rows] - to[:-1], n)
    return term[pick], value[pick], to


def _distances(a, back, v, size, square, row):
    dense = np.zeros(size)
    dense[back[a[row]:a[row + 1]]] = v[a[row]:a[row + 1]]
    return square + square[row] - 2 * _sums(v * dense[back], a)


class First:
    """The first ``k`` (score, id) of a query: highest score, then smallest id, null ids last."""

    def __init__(self, k: int):
        self.k, self.held = k, []

    def least(self) -> int:
        return -self.held[-1][0] if len(self.held) == self.k else 1

    def offer(self, score: int, key) -> None:
        self.held.append((-score, key is None, 0 if key is None else key))
        self.held.sort()
        del self.held[self.k:]


def _query_blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """Arrow tables (item, terms) of the queries that have terms, in blocks of bounded size."""
    kind = items.schema[item_col].dataType.simpleString()

    def split(batches):
        for b in batches:
            found = [sorted(set().union(*terms(_bytes(x)))) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.binary()))], ["item", "found"])

    listed = reliable(items.select(F.col(f"`{item_col}`").alias("item"), plain_text(f"`{text_col}`").alias("t"))
                      .mapInArrow(split, f"item {kind}, found array<binary>")
                      .select("item", F.explode("found").alias("term")).distinct()
                      .groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))
                      .withColumn("bytes", F.aggregate("terms", F.lit(0).cast("long"), lambda s, t: s + F.length(t) + 32)))
    size = listed.agg(F.sum("bytes")).first()[0] or 0
    blocks = -(-2 * size // block_bytes)
    for k in range(blocks):
        part = listed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).select("item", "terms").toArrow()
        if part.num_rows:
            yield part


def count_terms(docs: DataFrame, kind: str, vocabulary) -> DataFrame:
    """(id, n, term, tf) of rows (id, t) that have terms: all terms counted, and those of the vocabulary."""
    def run(batches):
        index = vocabulary.value
        for b in batches:
            n, ids, tfs, keep = [], [], [], []
            for i, x in enumerate(b.column(1)):
                count: Counter = Counter()
                total = 0
                for found in terms(_bytes(x)):
                    total += len(found)
                    count.update(filter(index.__contains__, found))
                if total:
                    keep.append(i)
                    n.append(total)
                    ids.append([index[t] for t in count])
                    tfs.append(list(count.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                 pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], ["id", "n", "term", "tf"])

    return docs.mapInArrow(run, f"id {kind}, n long, term array<int>, tf array<long>")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents for every item: ``item_col``, rank (from 1), ``id_col``, score above 0.

    Highest score first, ties by the smaller id, null ids last.  Documents that are null or have no term
    count nowhere and are never found; items that have none find nothing.  Rows that repeat an item id
    are one item with the terms of all; repeated documents count, and are found, each.  Other columns
    are ignored; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), plain_text(f"`{text_col}`").alias("t"))
    parts = []
    for part in _query_blocks(items, item_col, item_text_col, block_bytes):
        asked = part["terms"].to_pylist()
        index = {t: i for i, t in enumerate(sorted(set().union(*asked)))}
        vectors = reliable(count_terms(texts, id_kind, spark.sparkContext.broadcast(index)))
        n_docs, n_terms = vectors.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        df = np.zeros(len(index), np.int64)          # one number a term of the block
        for r in vectors.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect():
            df[r["term"]] = r["n"]
        block = spark.sparkContext.broadcast((
            Weights(n_docs, n_terms, df), part["item"].to_pylist(),
            [np.array([index[t] for t in found], np.int64) for found in asked]))
        parts.append(vectors.where(F.size("term") > 0).mapInArrow(
            _searcher(block, k, part.schema.field("item").type), f"item {item_kind}, id {id_kind}, score long"))
    if not parts:
        return spark.createDataFrame([], f"`{item_col}` {item_kind}, rank int, `{id_col}` {id_kind}, score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    few = top_k_per_key(found, ["item"], order, k)
    return (few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
            .select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"))


def _searcher(block, k, item_type):
    def run(batches):
        weights, items, asked = block.value
        scale = np.sqrt(weights.w.astype(float))
        best = [First(k) for _ in items]
        weight = np.zeros(len(scale), np.int64)
        held, rows, size, id_type = [], 0, 0, None

        def search_held():
            ids, at, term, value = [], [np.zeros(1, np.int64)], [], []
            for i, n, t, tf in held:
                ids += i
                lengths = np.diff(t.offsets.to_numpy())
                value.append(weights.values(np.repeat(n, lengths), tf.flatten().to_numpy()))
                term.append(t.flatten().to_numpy().astype(np.int64))
                at.append(at[-1][-1] + np.cumsum(lengths))
            tree = BallTree(np.concatenate(at), np.concatenate(term), np.concatenate(value), scale)
            for mine, own in zip(best, asked):
                weight[own] = weights.w[own]
                tree.search(own, weight, math.sqrt(float(weights.w[own].sum())), mine, ids)
                weight[own] = 0

        for b in batches:
            id_type = b.schema.field(0).type
            for i in range(0, b.num_rows, 512):
                s = b.slice(i, 512)
                held.append((s.column(0).to_pylist(), s.column(1).to_numpy(), s.column(2), s.column(3)))
                rows += s.num_rows
                size += len(s.column(2).flatten())
                if rows >= TREE_ROWS or size >= TREE_TERMS:
                    search_held()
                    held, rows, size = [], 0, 0
        if held:
            search_held()
        out = [(items[j], None if none else key, -s) for j, first in enumerate(best) for s, none, key in first.held]
        if out:
            a, b, c = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(a, item_type), pa.array(b, id_type), pa.array(c, pa.int64())],
                                             ["item", "id", "score"])

    return run
