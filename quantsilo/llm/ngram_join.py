"""Jaccard join on word n-grams with a vertically partitioned global order, and its components.

Global order: shingles go by how often their sketch counter was hit (in powers of two), then by
hash; rare ones first.  Any total order gives the same result, the frequencies only keep
candidates few.  The order is cut into fragments of equal mass.

1. Equal sets become one class (a node).  Two sets of n and m shingles that reach the threshold share
   at least ``need(n, m)`` of them, so they share one among the first ``n - need + 1`` of either.
   Only those prefixes, which lie in the fragments of rare shingles, are shuffled.
2. Prefix rows are range-partitioned by (shingle, position), so that a shingle of any frequency is
   split.  The first row of a run has the fewest private shingles; every node is paired with the
   one that it meets most often, so a group of near copies has as many candidates as members.
3. Candidates are checked exactly: overlaps are counted in each fragment apart and summed by pair.
4. What shares a prefix shingle and is not connected yet is checked as well, so no link between
   different components is lost; a pair comes up where it first meets, and again only when the last
   ``BEFORE`` shingles of both that could bring links hold none in common.  Components follow by
   alternating large-star and small-star steps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantsilo.llm.common import (SPACES, byte_set, mix, plain_text, shuffle_partitions, small_batches, stored,
                                  text_buffer, word_hashes, word_spans)

#: Counters of the frequency sketch, 2 ** SKETCH_BITS.
SKETCH_BITS = 20
FRAGMENTS = 4
#: Ids of up to so many bytes are broadcast to fetch their texts; more are joined by a shuffle.
BROADCAST_BYTES = 8 << 20
#: Shingles before its own by which a row knows that a pair has met already.
BEFORE = 8
_SLICES = 16
_IS_WORD = ~byte_set(SPACES)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, off: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word ``words``-grams of all texts, repeats included, and the n+1 offsets.

    A text with fewer words has its whole sequence as one; without words it has none.
    """
    starts, ends, at = word_spans(data, off, _IS_WORD)
    h = word_hashes(data, starts, ends)
    chain = h
    for j in range(1, words):
        chain = mix(chain[:len(h) - j] * _STEP + h[j:]) if len(h) > j else chain[:0]
    count = np.diff(at)
    n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    to = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(to[-1], np.uint64)
    for i in np.flatnonzero(n).tolist():
        a = at[i]
        if count[i] >= words:
            out[to[i]:to[i + 1]] = chain[a:a + n[i]]
        else:
            x = h[a:a + 1]
            for j in range(1, count[i]):
                x = mix(x * _STEP + h[a + j:a + j + 1])
            out[to[i]] = x[0]
    return out, to


def need(n, m, num: int, den: int):
    """The least overlap of sets of n and m elements with Jaccard similarity num/den or more."""
    return -(-(num * (n + m)) // (den + num))


class Order:
    """The global order: sketch classes, and the fragments' first tokens."""

    def __init__(self, counts: np.ndarray, fragments: int = FRAGMENTS):
        self.bits = int(len(counts)).bit_length() - 1
        self.classes = np.minimum(np.log2(np.maximum(counts, 1)).astype(np.uint8), 31)
        by = np.lexsort((np.arange(len(counts)), self.classes))
        mass = np.cumsum(counts[by].astype(float))
        at = np.searchsorted(mass, mass[-1] * np.arange(1, fragments) / fragments)
        first = by[np.minimum(at, len(by) - 1)]
        self.cuts = ((self.classes[first].astype(np.uint64) << np.uint64(58))
                     | (first.astype(np.uint64) << np.uint64(58 - self.bits)))

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        """A set's elements as ordered tokens (63 bits), sorted, without repeats."""
        c = self.classes[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)].astype(np.uint64)
        t = np.sort((c << np.uint64(58)) | (hashes >> np.uint64(6)))
        return t[np.concatenate([[True], t[1:] != t[:-1]])] if len(t) else t


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set, which do not depend on the global order."""
    h = tokens & np.uint64((1 << 58) - 1)
    m = mix(h + np.uint64(1))
    return (int(mix(np.array([m.sum() + np.uint64(len(h))], np.uint64)).view(np.int64)[0]),
            int(np.bitwise_xor.reduce(mix(m ^ _STEP)).view(np.int64)) if len(h) else 0)


def frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all texts fall on each sketch counter, summed by slices of the sketch."""
    size = 1 << SKETCH_BITS

    def count(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            h, _ = shingles(*text_buffer(b.column(b.num_columns - 1)), words)
            total += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
        part = total.reshape(_SLICES, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()),
                                          pa.array([p.tobytes() for p in part], pa.binary())], ["slice", "n"])

    def add(t: pa.Table) -> pa.Table:
        s = sum(np.frombuffer(x.as_py(), np.int64) for x in t["n"])
        return pa.table({"slice": t["slice"][:1], "n": pa.array([s.tobytes()], pa.binary())})

    got = (texts.mapInArrow(count, "slice int, n binary").groupBy("slice")
           .applyInArrow(add, "slice int, n binary").collect())
    return (np.concatenate([np.frombuffer(r["n"], np.int64) for r in sorted(got)]) if got
            else np.zeros(size, np.int64))


def _star(schema: pa.Schema):
    """Rows sorted by (token, position): those of runs of two or more, each with the run's first row.

    A run may go on in the next partition, so the first and the last run of a partition always stay.
    """
    cols = ("token", "node", "n", "p")

    def run(batches):
        held, head, first_run = None, None, True     # held: last row, while its run has only this one

        for b in batches:
            if not b.num_rows:
                continue
            t, node, n, p = (b.column(c).to_numpy() for c in cols)
            new = np.ones(len(t), bool)
            new[1:] = t[1:] != t[:-1]
            new[0] = head is None or t[0] != head[0]
            at = np.maximum.accumulate(np.where(new, np.arange(len(t)), -1))
            lead = {c: np.where(at >= 0, x[np.maximum(at, 0)], 0) for c, x in zip(cols, (t, node, n, p))}
            if not new[0]:
                for i, c in enumerate(cols):
                    lead[c][at < 0] = head[i]
            last_of_run = np.ones(len(t), bool)
            last_of_run[:-1] = new[1:]
            keep = ~(new & last_of_run)               # not a run of one, as far as this batch shows
            if first_run:
                stop = np.flatnonzero(new)[1:2]       # the partition's first run stays
                keep[:stop[0] if len(stop) else len(t)] = True
                first_run = not len(stop)
            keep[-1] = False                          # decided with the next batch
            if held is not None and not new[0]:
                yield held
            held = None
            rows = np.flatnonzero(keep)
            if len(rows):
                yield _rows(schema, t, node, n, p, lead, rows)
            last = len(t) - 1
            alone = bool(new[last])
            tail = _rows(schema, t, node, n, p, lead, np.array([last]))
            head = tuple(x[at[last]] for x in (t, node, n, p)) if at[last] >= 0 else head
            if alone and not first_run:
                held = tail
            else:
                yield tail
        if held is not None:
            yield held

    return run


def _rows(schema, t, node, n, p, lead, rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(x[rows]) for x in (t, node, n, p, lead["node"], lead["n"], lead["p"])], schema=schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): every node of ``edges`` (a, b) with the smallest node that it is connected with.

    Large-star and small-star steps in turn until nothing changes; every step is a grouped minimum
    and a join, its result is checkpointed.
    """
    def low(e):
        return e.where("u <> v").distinct()

    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    e = stored(low(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    seen = state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = low(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = stored(low(small))
        now = state(e)
        if now == seen:
            break
        seen = now
    ends = e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("comp"))
    return stored(ends.unionByName(roots).distinct())


def jaccard_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text", fragments: int = FRAGMENTS) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles and component_id, the smallest id reachable by links.

    Two texts link when Jaccard(distinct ``words``-word shingles) >= num/den; words are runs outside
    ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased.  A text with fewer words has its whole sequence as one
    shingle; null, empty and blank texts have none, link with nothing and are their own component.
    Rows are told apart by their sets, so repeated rows and ids are all kept; a null id is never the
    smallest unless a component has no other.  Other columns are ignored; an empty table gives no rows.
    Shingles are compared by 58 bits of a hash, classes of equal sets by 128.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("t"))
    order = spark.sparkContext.broadcast(Order(frequencies(texts.select("t"), words), fragments))

    def sets(batches):
        o = order.value
        for b in batches:
            h, at = shingles(*text_buffer(b.column(1)), words)
            n, k1, k2, prefix = [], [], [], []
            for i in range(b.num_rows):
                t = o.tokens(h[at[i]:at[i + 1]])
                a, c = set_key(t)
                n.append(len(t))
                k1.append(a)
                k2.append(c)
                prefix.append(t[:len(t) - (-(-num * len(t) // den)) + 1].view(np.int64) if len(t) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(prefix, pa.list_(pa.int64()))], ["id", "n", "node", "node2", "prefix"])

    rows = stored(texts.mapInArrow(sets, f"id {id_type}, n long, node long, node2 long, prefix array<long>"))
    classes = stored(rows.where("n > 0").groupBy("node", "node2", "n")
                     .agg(F.min("id").alias("min_id"), F.first("prefix").alias("prefix")))

    schema = pa.schema([(c, pa.int64()) for c in ("token", "node", "n", "p", "c_node", "c_n", "c_p")])
    prefix_rows = classes.select("node", "n", F.posexplode("prefix").alias("p", "token")).select(
        "token", "node", "n", F.col("p").cast("long").alias("p"))
    runs = stored(prefix_rows.repartitionByRange(shuffle_partitions(spark), "token", "p", "node")
                    .sortWithinPartitions("token", "p", "node")
                    .mapInArrow(_star(schema), ", ".join(f"{f.name} long" for f in schema)))

    # a run that partitions cut has a first row in each; all its rows take that of the whole run
    cut = (runs.where("node = c_node").groupBy("token")
           .agg(F.min(F.struct("c_p", "c_node", "c_n")).alias("lead"), F.count("*").alias("parts")).where("parts > 1"))
    runs = (runs.join(F.broadcast(cut.select("token", "lead")), "token", "left")      # at most one for each partition
            .withColumns({k: F.coalesce(F.col(f"lead.{k}"), F.col(k)) for k in ("c_p", "c_node", "c_n")}).drop("lead"))

    def least_overlap(n, m):
        return F.ceil(num * (n + m) / F.lit(float(den + num)) - 1e-9)

    def may_link(n, p, m, q):
        """Lengths fit, and the shared shingle stands in the prefixes that this pair needs."""
        least = least_overlap(n, m)
        return (num * F.greatest(n, m) <= den * F.least(n, m)) & (p <= n - least) & (q <= m - least)

    def as_pairs(df, a, n, b, m):
        return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
                         F.when(a < b, n).otherwise(m).alias("na"),
                         F.when(a < b, m).otherwise(n).alias("nb")).distinct()

    c = F.col
    # each node tries the one first row that it meets in most runs: as many candidates as nodes
    stars = (runs.where((c("node") != c("c_node")) & may_link(c("n"), c("p"), c("c_n"), c("c_p")))
             .groupBy("node", "n", "c_node", "c_n").agg(F.count("*").alias("k"))
             .groupBy("node", "n").agg(F.max(F.struct("k", "c_node", "c_n")).alias("x"))
             .select("node", "n", "x.c_node", "x.c_n"))
    found = _verified(texts, classes, as_pairs(stars, c("node"), c("n"), c("c_node"), c("c_n")), order, words, num, den,
                      fragments)
    labels = components(found)

    # runs that still hold several components: all but the most frequent one meet everything in the run
    known = (runs.select("token", "node", "n", "p").join(labels, "node", "left")
             .withColumn("comp", F.coalesce("comp", "node")))
    mixed = (known.groupBy("token", "comp").agg(F.count("*").alias("k"), F.min("n").alias("n"))
             .groupBy("token").agg(F.max(F.struct("k", "comp"))["comp"].alias("main"), F.count("*").alias("comps"),
                                   F.min("n").alias("least_n")).where("comps > 1"))
    # a row whose shingle stands too far back for any partner of the run cannot link through it
    smallest = F.greatest(c("least_n"), F.ceil(num * c("n") / F.lit(float(den)) - 1e-9))
    rest = stored(_with_before(known.join(mixed, "token").where(c("p") <= c("n") - least_overlap(c("n"), smallest))))
    cross = _meetings(rest, may_link)
    more = _verified(texts, classes, as_pairs(cross, c("x.node"), c("x.n"), c("y.node"), c("y.n")), order, words, num,
                     den, fragments)
    labels = components(more.unionByName(labels.select(c("node").alias("a"), c("comp").alias("b"))))

    named = classes.select("node", "node2", "min_id").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = named.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    placed = stored(named.join(lowest, "comp").select("node", "node2", "component_id"))
    # a class may hold a large part of all rows: two plain sides, which adaptive execution can split
    full = rows.where("n > 0").select("id", "n", "node", "node2").join(placed, ["node", "node2"])
    empty = rows.where("n = 0").select("id", "n", c("id").alias("component_id"))
    return full.select("id", "n", "component_id").unionByName(empty).select(
        c("id").alias(id_col), c("n").alias("n_shingles"), "component_id")


def _with_before(rest: DataFrame) -> DataFrame:
    """Rows of mixed runs with the last ``BEFORE`` shingles of the same node that stand in such runs."""
    last = Window.partitionBy("node").orderBy("p").rowsBetween(-BEFORE, -1)
    return rest.select("token", "node", "n", "p", "comp", "main", F.collect_list("token").over(last).alias("before"))


def _meetings(rest: DataFrame, may_link) -> DataFrame:
    """Pairs of rows x, y of different components in one run, without those that also meet shortly before."""
    c = F.col
    x, y = rest.where("comp <> main").alias("x"), rest.alias("y")
    return x.join(y, c("x.token") == c("y.token")).where(
        (c("x.comp") != c("y.comp")) & ((c("y.comp") == c("y.main")) | (c("x.node") < c("y.node")))
        # two sets that also share an earlier shingle meet there, where they stand further ahead
        & ~F.arrays_overlap("x.before", "y.before")
        & may_link(c("x.n"), c("x.p"), c("y.n"), c("y.p")))


def _verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame, order, words: int, num: int, den: int,
              fragments: int) -> DataFrame:
    """The pairs (a, b) that link, by partial overlaps of fragments summed for each pair.

    Prefixes come first: elements of the prefix that ends earlier which the other prefix lacks are not
    in the other set at all, so a pair that lacks too many of them cannot link.  Whole sets are read
    again from the texts, only for pairs that pass.
    """
    heads = classes.select("node", "prefix")
    c = F.size(F.array_intersect("pa", "pb"))
    a_ends_first = F.element_at("pa", -1) <= F.element_at("pb", -1)
    most = F.when(a_ends_first, F.col("na") - F.size("pa") + c).otherwise(F.col("nb") - F.size("pb") + c)
    pairs = stored(
        pairs.join(heads.select(F.col("node").alias("a"), F.col("prefix").alias("pa")), "a")
        .join(heads.select(F.col("node").alias("b"), F.col("prefix").alias("pb")), "b")
        .where(most * (den + num) >= num * (F.col("na") + F.col("nb"))).select("a", "b", "na", "nb"))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ids = stored(classes.join(wanted, "node", "left_semi").select(F.col("min_id").alias("id")).distinct())
    size = ids.agg(F.sum(F.octet_length(F.col("id").cast("string")) + 16)).first()[0] or 0
    chosen = F.broadcast(ids) if size <= BROADCAST_BYTES else ids
    fetched = texts.join(chosen, "id", "left_semi").unionByName(texts.where("id IS NULL"))

    def cut(batches):
        o = order.value
        for b in batches:
            h, at = shingles(*text_buffer(b.column(1)), words)
            node, part, tokens = [], [], []
            for i in range(b.num_rows):
                t = o.tokens(h[at[i]:at[i + 1]])
                ends = [0, *np.searchsorted(t, o.cuts).tolist(), len(t)]
                key = set_key(t)[0]
                for f in range(len(ends) - 1):
                    if ends[f + 1] > ends[f]:
                        node.append(key)
                        part.append(f)
                        tokens.append(t[ends[f]:ends[f + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(part, pa.int32()),
                                              pa.array(tokens, pa.list_(pa.int64()))], ["node", "part", "tokens"])

    segments = (fetched.select("id", "t").mapInArrow(cut, "node long, part int, tokens array<long>")
                .join(wanted, "node", "left_semi"))
    segments = stored(segments)
    one = segments.select(F.col("node").alias("a"), "part", F.col("tokens").alias("ta"))
    two = segments.select(F.col("node").alias("b"), "part", F.col("tokens").alias("tb"))
    overlap = (pairs.withColumn("part", F.explode(F.array(*map(F.lit, range(fragments)))))
               .join(one, ["a", "part"]).join(two, ["b", "part"])
               .select("a", "b", "na", "nb", "part", F.size(F.array_intersect("ta", "tb")).cast("long").alias("k")))
    # rows that repeat an id give their set more than once, and the same overlaps
    overlap = overlap.groupBy("a", "b", "na", "nb", "part").agg(F.max("k").alias("k"))
    return stored(overlap.groupBy("a", "b", "na", "nb").agg(F.sum("k").alias("k"))
                    .where(den * F.col("k") >= num * (F.col("na") + F.col("nb") - F.col("k"))).select("a", "b"))
