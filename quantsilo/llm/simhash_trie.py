"""SimHash near-duplicates: a self-join of the binary trie over the distinct fingerprints.

Two trie nodes are traversed together.  The bits that both prefixes fix are compared, and a pair of
subtrees is dropped as soon as these differ in more than the error budget; what remains is split at
the node that fixes fewer bits, down to small leaves whose fingerprints are compared in full.

The trie is cut into shards, its highest nodes with a bounded number of fingerprints.  The trie above
the shards is joined with itself on the driver (counts by prefix only), which gives the pairs of
shards that can hold links.  A shard is first joined with itself, then with its partners; subtrees
that are connected already are skipped, so a dense ball of near copies does not cost all its pairs,
and every task returns a spanning forest, at most one edge for each fingerprint.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo.llm.common import plain_text, reliable, small_batches
from quantsilo.llm.ngram_join import components

WORDS, BUDGET, SEED = 3, 3, 42
#: The trie is cut into about so many shards, of at least and at most so many fingerprints (8 bytes each).
SHARDS, SHARD_LEAST, SHARD_MOST = 64, 512, 1 << 20
#: Bits that one round of counting adds to a prefix.
STEP_BITS = 8
#: Fingerprints of a leaf, node pairs held at once, edges kept until they are merged.
LEAF, FRONTIER, EDGES = 4, 1 << 15, 1 << 18
#: Shingles hashed at once; bounds the memory of a very long text.
SEGMENT = 1 << 15
_U1 = np.uint64(1)


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """64 bits: each is 1 if it is set in over half the XXH64 of the text's word ``words``-grams.

    Words are runs outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased, joined by one space; repeats count.
    Fewer words make one shingle of all, none give 0.
    """
    found = text.lower().split()            # of bytes: ASCII letters and exactly these separators
    if not found:
        return 0
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    line, ends = b" ".join(found), ends.tolist()
    n = max(1, len(found) - words + 1)
    last = min(words, len(found)) - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for i in range(0, n, SEGMENT):
        j = min(n, i + SEGMENT)
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[i:j], ends[i + last:j + last])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(texts: DataFrame, id_type: str) -> DataFrame:
    """(id, fp) of rows (id, t); fp is the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in b.column(1)),
                             np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    return texts.mapInArrow(run, f"id {id_type}, fp long")


class Trie:
    """Path-compressed binary trie over sorted distinct fingerprints, in arrays.

    Node k holds values[lo:hi]; these share their ``depth`` highest bits (64 for a single one), which are
    those of ``prefix``.  ``left`` is -1 for a leaf.
    """

    def __init__(self, values: np.ndarray, leaf: int = LEAF):
        self.values = values
        lo, hi, left = [np.zeros(1, np.int64)], [np.full(1, len(values))], []
        made, level = 1, (lo[0], hi[0])
        while len(level[0]):
            a, b = level
            split = b - a > leaf
            x = values[a] ^ values[b - 1]
            top = np.zeros(len(a), np.uint64)                   # the highest bit in which the node's values differ
            for s in (32, 16, 8, 4, 2, 1):
                up = (x >> np.uint64(s)) > 0
                top[up] += np.uint64(s)
                x = np.where(up, x >> np.uint64(s), x)
            at = np.searchsorted(values, (values[b - 1] >> top) << top)
            kids = np.full(len(a), -1)
            kids[split] = made + 2 * np.arange(split.sum())
            left.append(kids)
            level = (np.stack([a[split], at[split]], 1).ravel(), np.stack([at[split], b[split]], 1).ravel())
            made += len(level[0])
            lo.append(level[0])
            hi.append(level[1])
        self.lo, self.hi, self.left = np.concatenate(lo), np.concatenate(hi), np.concatenate(left)
        self.prefix = values[self.lo]
        self.depth = 64 - _bit_length(self.prefix ^ values[self.hi - 1])

    def uniform(self, label: np.ndarray) -> np.ndarray:
        """The label of a node all of whose fingerprints have it, else -1."""
        change = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        return np.where(change[self.lo] == change[self.hi - 1], label[self.lo], -1)


def _bit_length(x: np.ndarray) -> np.ndarray:
    n = np.zeros(len(x), np.int64)
    for s in (32, 16, 8, 4, 2, 1):
        up = (x >> np.uint64(s)) > 0
        n[up] += s
        x = np.where(up, x >> np.uint64(s), x)
    return n + (x > 0)


def _fixed(x: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The highest ``bits`` (0 to 64) bits of x; a shift by 64 is undefined, so it goes in two steps."""
    return np.where(bits == 64, x, (x >> _U1) >> np.maximum(63 - bits, 0).astype(np.uint64))


def _merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (each the smallest index of its component) after joining those of u and v."""
    while True:
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            return label
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def join(one: Trie, two: Trie | None, label: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """Labels after all links within ``budget`` of trie ``one`` with itself, or with trie ``two``.

    ``label`` are those known before, over the values of ``one`` and then of ``two``.  Budgets go up from
    one bit, so that most of a dense ball is connected, and then skipped, before wide budgets meet it.
    """
    self_join, shift = two is None, 0 if two is None else len(one.values)
    other = one if self_join else two
    if not len(one.values) or not len(other.values):
        return label
    for within in range(1, budget + 1):
        label = _pass(one, other, self_join, shift, label, within)
    return label


def _pass(one, two, self_join, shift, label, budget):
    def uniforms():
        return (one.uniform(label[:len(one.values)]), two.uniform(label[shift:shift + len(two.values)]))

    u1, u2 = uniforms()
    todo, held, waiting = [(np.zeros(1, np.int64), np.zeros(1, np.int64))], [], 0
    while todo:
        a, b = todo.pop()
        if len(a) > FRONTIER:
            todo.append((a[FRONTIER:], b[FRONTIER:]))
            a, b = a[:FRONTIER], b[:FRONTIER]
        da, db = one.depth[a], two.depth[b]
        differ = _fixed(one.prefix[a] ^ two.prefix[b], np.minimum(da, db))
        keep = (np.bitwise_count(differ) <= budget) & ((u1[a] < 0) | (u1[a] != u2[b]))
        a, b, da, db = a[keep], b[keep], da[keep], db[keep]
        la, lb = one.left[a], two.left[b]
        same = (a == b) if self_join else np.zeros(len(a), bool)
        ends = (la < 0) & (lb < 0)
        if ends.any():
            u, v = _leaves(one, two, a[ends], b[ends], budget)
            v = v + shift
            apart = label[u] != label[v]
            held.append((u[apart], v[apart]))
            waiting += int(apart.sum())
            if waiting >= EDGES or (waiting and not todo):
                label = _merge(label, *(np.concatenate(x) for x in zip(*held)))
                held, waiting = [], 0
                u1, u2 = uniforms()
        both = same & ~ends
        first = ~both & ~ends & (la >= 0) & ((da <= db) | (lb < 0))
        second = ~both & ~ends & ~first
        kid = la[both]
        next_a = np.concatenate([kid, kid, kid + 1, la[first], la[first] + 1, a[second], a[second]])
        next_b = np.concatenate([kid, kid + 1, kid + 1, b[first], b[first], lb[second], lb[second] + 1])
        if len(next_a):
            todo.append((next_a, next_b))
    if held:
        label = _merge(label, *(np.concatenate(x) for x in zip(*held)))
    return label


def _leaves(one, two, a, b, budget):
    """Index pairs of the values of leaf pairs that differ in at most ``budget`` bits."""
    na, nb = one.hi[a] - one.lo[a], two.hi[b] - two.lo[b]
    n = na * nb
    pair = np.repeat(np.arange(len(a)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    u, v = one.lo[a][pair] + k // nb[pair], two.lo[b][pair] + k % nb[pair]
    near = np.bitwise_count(one.values[u] ^ two.values[v]) <= budget
    return u[near], v[near]


def cut(count_by_prefix, total: int, most: int) -> list[tuple[int, int]]:
    """Shards (prefix, bits): the highest trie nodes with at most ``most`` fingerprints, in order.

    ``count_by_prefix(bits, heavy)`` gives {prefix: fingerprints} for prefixes of that many bits below the
    given heavy ones.  Only counts come here, and only below nodes that are too large: at most
    2 ** STEP_BITS for each ``most`` fingerprints a round.
    """
    shards, heavy, bits = [], [0], 0
    if total <= most:
        return [(0, 0)] if total else []
    while heavy and bits < 64:
        step = bits + STEP_BITS
        counts = count_by_prefix(step, heavy)
        tree: dict[tuple[int, int], int] = {}
        for p, n in counts.items():
            for up in range(STEP_BITS + 1):
                key = (p >> up, step - up)
                tree[key] = tree.get(key, 0) + n
        above, heavy = heavy, []
        todo = [(p, bits) for p in above]
        while todo:
            p, b = todo.pop()
            n = tree.get((p, b), 0)
            if not n:
                continue
            if n <= most:
                shards.append((p, b))
            elif b == step:
                heavy.append(p)
            else:
                todo += [(2 * p, b + 1), (2 * p + 1, b + 1)]
        bits = step
    return sorted(shards, key=lambda s: (s[0] << (64 - s[1]), s[1]))


def partners(shards: list[tuple[int, int]], budget: int = BUDGET) -> list[tuple[int, int]]:
    """Pairs (i, j), i < j, of shards whose prefixes differ in at most ``budget`` of the bits that both fix."""
    if len(shards) < 2:
        return []
    low = np.array([p << (64 - b) for p, b in shards], np.uint64)
    bits = np.array([b for _, b in shards], np.int64)
    out = []
    for i in range(len(shards) - 1):
        x = _fixed(low[i] ^ low[i + 1:], np.minimum(bits[i], bits[i + 1:]))
        out += [(i, i + 1 + int(j)) for j in np.flatnonzero(np.bitwise_count(x) <= budget)]
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, budget: int = BUDGET, id_col: str = "doc_id",
                    text_col: str = "text", shards: int = SHARDS, least: int = SHARD_LEAST) -> DataFrame:
    """One row per input row: ``id_col``, fingerprint (16 hex digits) and component_id, the smallest id reachable.

    Texts link when their fingerprints differ in at most ``budget`` bits.  Null, empty and blank texts have
    the fingerprint zero and link like any other.  Rows are told apart by fingerprints, so repeated rows
    and ids are all kept; a null id is never the smallest unless a component has no other.  Other columns
    are ignored, whatever their names; an empty table gives no rows.  No link between components is lost;
    links inside one are not listed.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = reliable(fingerprints(docs.select(F.col(f"`{id_col}`").alias("id"), plain_text(f"`{text_col}`").alias("t")),
                                 id_type))
    classes = reliable(rows.groupBy("fp").agg(F.min("id").alias("min_id")))
    total = classes.count()

    def prefix(bits):
        return F.shiftrightunsigned("fp", 64 - bits)

    def count_by_prefix(bits, heavy):
        p = classes.select(prefix(bits).alias("p"), F.lit(1).alias("one"))
        if bits > STEP_BITS:
            few = spark.createDataFrame([(_signed(h),) for h in heavy], "h long")
            p = p.join(F.broadcast(few), F.shiftrightunsigned("p", STEP_BITS) == F.col("h"), "left_semi")
        return {r["p"] % (1 << 64): r["n"] for r in p.groupBy("p").agg(F.count("*").alias("n")).collect()}

    cuts = cut(count_by_prefix, total, min(SHARD_MOST, max(least, -(-total // shards))))
    starts = np.array([p << (64 - b) if b else 0 for p, b in cuts], np.uint64)

    def place(batches):
        for b in batches:
            fp = b.column(0).to_numpy()
            at = np.searchsorted(starts, fp.view(np.uint64), "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), b.column(0)], ["shard", "fp"])

    def within(t: pa.Table) -> pa.Table:
        v = np.sort(t["fp"].to_numpy().view(np.uint64))
        label = join(Trie(v), None, np.arange(len(v)), budget)
        return pa.table({"shard": t["shard"][:1], "fps": pa.array([v.tobytes()], pa.binary()),
                         "roots": pa.array([label.astype(np.int32).tobytes()], pa.binary())})

    index = reliable(classes.select("fp").mapInArrow(place, "shard int, fp long")
                     .groupBy("shard").applyInArrow(within, "shard int, fps binary, roots binary"))
    pairs = spark.createDataFrame(partners(cuts, budget), "i int, j int")
    meets = (pairs.join(index.selectExpr("shard AS i", "fps AS fi", "roots AS ri"), "i")
             .join(index.selectExpr("shard AS j", "fps AS fj", "roots AS rj"), "j").select("fi", "ri", "fj", "rj"))

    def across(batches):
        for b in batches:
            for fi, ri, fj, rj in zip(*(c.to_pylist() for c in b.columns)):
                x, y = np.frombuffer(fi, np.uint64), np.frombuffer(fj, np.uint64)
                before = np.concatenate([np.frombuffer(ri, np.int32), np.frombuffer(rj, np.int32) + len(x)]).astype(np.int64)
                after = join(Trie(x), Trie(y), before.copy(), budget)
                roots = np.unique(before)
                moved = roots[after[roots] != roots]
                both = np.concatenate([x, y]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[moved]), pa.array(both[after[moved]])], ["a", "b"])

    def inside(batches):
        for b in batches:
            for fi, ri in zip(*(c.to_pylist() for c in b.columns)):
                x, r = np.frombuffer(fi, np.int64), np.frombuffer(ri, np.int32)
                at = np.flatnonzero(r != np.arange(len(r)))
                yield pa.RecordBatch.from_arrays([pa.array(x[at]), pa.array(x[r[at]])], ["a", "b"])

    edges = (meets.mapInArrow(across, "a long, b long")
             .unionByName(index.select("fps", "roots").mapInArrow(inside, "a long, b long")))
    labels = components(edges)
    named = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "min_id", F.coalesce("comp", "fp").alias("comp"))
    lowest = named.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    placed = reliable(named.join(lowest, "comp").select("fp", "component_id"))
    # a fingerprint may be that of a large part of all rows: two plain sides, which adaptive execution can split
    return rows.join(placed, "fp").select(F.col("id").alias(id_col),
                                          F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x
