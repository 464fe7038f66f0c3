"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

The model predicts one of the most frequent words, the end of a text, or a group of all other
words that share the hash of their last two bytes; inside a group, words follow their add-one
unigram share.  So probabilities add up to one over the V known words and one unknown word for
each group.  The vector predicted from the two words before is  r = R[w1] C1 + R[w2] C2,  a word's
score r.Q[w] + b[w].  Training never normalises (noise-contrastive estimation, numpy, averaged over
partitions); scoring does, by matrix products over all pairs of contexts.

Exact counts of every training word cover the whole corpus: blocks of documents send their distinct
words, packed by shard, shards add them up and send each block the totals of its own words.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantsilo.llm.common import (LOWER, SPACES, byte_set, mix, plain_text, reliable, shuffle_partitions, small_batches,
                                  text_buffer, word_hashes, word_spans)

#: Words with a vector of their own, groups of the others, components.
TOP_WORDS = 768
GROUPS = 64
DIM = 24
#: Noise words for each batch of targets, learning rate (Adagrad), targets in a batch.
NOISE = 24
RATE = 0.1
BATCH = 512
#: Rounds of training over every target (each averages all partitions).
ROUNDS = 2
#: Text bytes of a block, about.
BLOCK_BYTES = 16 << 20
_AVERAGES = 16
_IS_WORD = ~byte_set(SPACES)
_LOW = np.uint64(GROUPS - 1)
#: Stands for the end of a text among the word hashes (group 0).
END = np.uint64(0xE4D0_0000_0000_0000)


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text closed by END, and the n+1 token offsets.

    The low bits of a hash are the word's group.
    """
    starts, ends, at = word_spans(data, off, _IS_WORD)
    h = word_hashes(data, starts, ends)
    z = LOWER[data[ends - 1]].astype(np.uint64)
    y = np.where(ends - starts > 1, LOWER[data[np.maximum(ends, 2) - 2]], 0).astype(np.uint64)
    group = mix((z << np.uint64(8)) + y + np.uint64(1)) & _LOW
    n = len(at) - 1
    to = at + np.arange(n + 1)
    out = np.empty(to[-1] if n else 0, np.uint64)
    last = np.zeros(len(out), bool)
    last[to[1:] - 1] = True
    out[last] = END
    out[~last] = (h & ~_LOW) | group
    return out, to


@dataclass
class Vocabulary:
    """Counts of the whole training corpus that every task needs; of a fixed size."""

    top: np.ndarray            # hashes of the words with vectors and of END, sorted
    top_counts: np.ndarray
    n_tokens: int              # training tokens, with ends
    n_distinct: int
    group_tokens: np.ndarray   # of the words without a vector
    group_distinct: np.ndarray

    @property
    def size(self) -> int:
        return len(self.top) + GROUPS

    def classes(self, h: np.ndarray) -> np.ndarray:
        """What the model predicts for a token: its place in ``top``, or its group behind those."""
        i = np.minimum(np.searchsorted(self.top, h), len(self.top) - 1)
        return np.where(self.top[i] == h, i, len(self.top) + (h & _LOW).astype(np.int64))

    def unigram(self) -> np.ndarray:
        p = np.concatenate([self.top_counts, self.group_tokens]) + 1.0
        return p / p.sum()


def contexts(classes: np.ndarray, to: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the two tokens before each token; ``start`` before a text's first."""
    one, two = np.full(len(classes), start), np.full(len(classes), start)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    first = to[:-1]
    one[first] = two[first] = start
    second = first + 1
    second = second[second < to[1:]]
    two[second] = start
    return one, two


def _row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and the sums of the values that belong to each."""
    narrow = rows.astype(np.min_scalar_type(int(rows.max())))      # 16 bits and less are sorted by radix
    order = np.argsort(narrow, kind="stable")
    s = rows[order]
    first = np.append(0, np.flatnonzero(s[1:] != s[:-1]) + 1)
    return s[first], np.add.reduceat(values.take(order, 0), first, axis=0)


class LogBilinear:
    def __init__(self, vocabulary: Vocabulary, dim: int = DIM, seed: int = 1):
        v, rng = vocabulary.size, np.random.default_rng(seed)
        self.v = v
        self.noise = vocabulary.unigram()
        p = {"R": rng.normal(0, 0.1, (v + 1, dim)), "Q": rng.normal(0, 0.1, (v, dim)),
             "C1": np.eye(dim), "C2": np.eye(dim) * 0.5, "b": np.log(self.noise)}
        self.p = {n: x.astype(np.float32) for n, x in p.items()}        # trained in single precision, scored in double

    def train(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, rng: np.random.Generator,
              squares: dict[str, np.ndarray]) -> None:
        """One pass of noise-contrastive estimation with Adagrad; the noise words of a batch are shared.

        Only rows with a gradient are touched: Adagrad leaves the others as they are.
        """
        p, k = self.p, NOISE
        log_kp = np.log(k * self.noise).astype(np.float32)
        cdf = np.cumsum(self.noise)
        for a in range(0, len(word), BATCH):
            c1, c2, w = one[a:a + BATCH], two[a:a + BATCH], word[a:a + BATCH]
            ns = np.minimum(np.searchsorted(cdf, rng.random(k)), self.v - 1)
            r1, r2 = p["R"][c1], p["R"][c2]
            h = r1 @ p["C1"] + r2 @ p["C2"]
            qw, qn = p["Q"][w], p["Q"][ns]
            gt = 1 / (1 + np.exp(-np.clip((h * qw).sum(1) + p["b"][w] - log_kp[w], -30, 30))) - 1
            gn = 1 / (1 + np.exp(-np.clip(h @ qn.T + (p["b"] - log_kp)[ns], -30, 30)))
            dh = gt[:, None] * qw + gn @ qn
            wide = np.empty((len(w) + k, h.shape[1] + 1), np.float32)     # gradients of Q and, last, of b
            np.multiply(h, gt[:, None], out=wide[:len(w), :-1])
            wide[:len(w), -1], wide[len(w):, -1] = gt, gn.sum(0)
            np.matmul(gn.T, h, out=wide[len(w):, :-1])
            rows, by_row = _row_sums(np.concatenate([w, ns]), wide)
            context, by_context = _row_sums(np.concatenate([c1, c2]), np.concatenate([dh @ p["C1"].T, dh @ p["C2"].T]))
            for n, at, g in (("Q", rows, by_row[:, :-1]), ("b", rows, by_row[:, -1]), ("R", context, by_context),
                             ("C1", slice(None), r1.T @ dh), ("C2", slice(None), r2.T @ dh)):
                g = g / np.float32(len(w))
                sq = squares[n][at] + g * g
                squares[n][at] = sq
                p[n][at] -= np.float32(RATE) * g / np.sqrt(sq + np.float32(1e-8))

    def normalisers(self) -> np.ndarray:
        """log sum exp of all words' scores for every pair of contexts, by batched matrix products."""
        p, v = self.p, self.v
        first, second = (p["R"] @ p["C1"]).astype(np.float32), (p["R"] @ p["C2"]).astype(np.float32)
        q, b = p["Q"].T.astype(np.float32), p["b"].astype(np.float32)
        out = np.empty((v + 1, v + 1))
        for c1 in range(v + 1):
            s = (first[c1] + second) @ q + b
            top = s.max(1)
            out[c1] = top + np.log(np.exp(s - top[:, None]).sum(1, dtype=np.float64))
        return out

    def log_probabilities(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, z: np.ndarray) -> np.ndarray:
        p = {n: x.astype(float) for n, x in self.p.items()}
        first, second = p["R"] @ p["C1"], p["R"] @ p["C2"]
        out = np.empty(len(word))
        for a in range(0, len(word), 1 << 17):
            c1, c2, w = one[a:a + (1 << 17)], two[a:a + (1 << 17)], word[a:a + (1 << 17)]
            out[a:a + (1 << 17)] = np.einsum("ij,ij->i", first[c1] + second[c2], p["Q"][w]) + p["b"][w] - z[c1, c2]
        return out


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sort(h)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
    return s[first], np.diff(np.append(first, len(s)))


def _block_counts(shards: int):
    def run(t: pa.Table) -> pa.Table:
        h, to = tokens(*text_buffer(t["t"]))
        learn = np.repeat(t["learn"].to_numpy(), np.diff(to))
        words, _ = _distinct(h)
        known, times = _distinct(h[learn])
        count = np.zeros(len(words), np.int64)
        count[np.searchsorted(words, known)] = times
        shard = ((words >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        ends = np.searchsorted(shard[order], np.arange(shards + 1))
        parts = [order[a:b] for a, b in zip(ends, ends[1:])]
        full = [s for s, x in enumerate(parts) if len(x)]
        return pa.table({"shard": pa.array(full, pa.int32()), "block": pa.array([t["block"][0].as_py()] * len(full), pa.int32()),
                         "words": pa.array([words[parts[s]].tobytes() for s in full], pa.binary()),
                         "counts": pa.array([count[parts[s]].astype(np.uint32).tobytes() for s in full], pa.binary())})

    return run


def _shard_totals(top_words: int):
    def run(t: pa.Table) -> pa.Table:
        words = [np.frombuffer(x.as_py(), np.uint64) for x in t["words"]]
        h = np.concatenate(words)
        c = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in t["counts"]]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        s = h[order]
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        total, known = np.add.reduceat(c[order], first), s[first]
        seen = total > 0
        group = (known & _LOW).astype(np.int64)
        best = np.lexsort((known, -total))[:top_words + 1]
        best = best[total[best] > 0]
        facts = pickle.dumps((int(total.sum()), int(seen.sum()), np.bincount(group, total, GROUPS),
                              np.bincount(group[seen], minlength=GROUPS), known[best], total[best]))
        n = len(words)
        return pa.table({"block": pa.concat_arrays([t["block"].combine_chunks().cast(pa.int32()), pa.nulls(1, pa.int32())]),
                         "words": pa.array([x.tobytes() for x in words] + [None], pa.binary()),
                         "counts": pa.array([total[np.searchsorted(known, x)].tobytes() for x in words] + [None], pa.binary()),
                         "facts": pa.array([None] * n + [facts], pa.binary())})

    return run


def _vocabulary(facts: list, top_words: int) -> Vocabulary:
    n = sum(f[0] for f in facts)
    v = sum(f[1] for f in facts)
    tokens_of, distinct_of = (np.sum([f[i] for f in facts], axis=0) if facts else np.zeros(GROUPS) for i in (2, 3))
    words = np.concatenate([f[4] for f in facts] or [np.zeros(0, np.uint64)])
    counts = np.concatenate([f[5] for f in facts] or [np.zeros(0, np.int64)])
    others = words != END
    end = int(counts[~others].sum())
    words, counts = words[others], counts[others]
    best = np.lexsort((words, -counts))[:top_words]
    top, times = np.append(words[best], END), np.append(counts[best], end)
    order = np.argsort(top)
    top, times = top[order], times[order]
    group = (top & _LOW).astype(np.int64)
    return Vocabulary(top, times, n, v, tokens_of - np.bincount(group, times, GROUPS),
                      distinct_of - np.bincount(group[times > 0], minlength=GROUPS))


def _trained(texts: DataFrame, vocabulary: Vocabulary, rounds: int) -> LogBilinear:
    """Rounds of training on every target of the learning texts, averaged over partitions by the targets seen."""
    spark = texts.sparkSession
    model = LogBilinear(vocabulary)
    names, shapes = list(model.p), {n: x.shape for n, x in model.p.items()}

    def flat(p):
        return np.concatenate([p[n].ravel() for n in names])

    for step in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, model))

        def learn(batches, step=step, shared=shared):
            voc, m = shared.value
            m = pickle.loads(pickle.dumps(m))
            squares = {n: np.full_like(x, 1e-3) for n, x in m.p.items()}
            used, key = 0, 0
            for b in batches:
                h, to = tokens(*text_buffer(b.column(0)))
                if not len(h):
                    continue
                key = int(np.bitwise_xor.reduce(mix(h)))       # order and noise depend on the texts alone
                rng = np.random.default_rng([step, key & 0x7FFFFFFF, len(h)])
                w = voc.classes(h)
                one, two = contexts(w, to, voc.size)
                order = rng.permutation(len(w))
                m.train(one[order], two[order], w[order], rng, squares)
                used += len(w)
            if used:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key % _AVERAGES], pa.int32()), pa.array([(flat(m.p).astype(float) * used).tobytes()], pa.binary()),
                     pa.array([used], pa.int64())], ["part", "p", "n"])

        def add(t: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x.as_py()) for x in t["p"])
            return pa.table({"part": t["part"][:1], "p": pa.array([total.tobytes()], pa.binary()),
                             "n": pa.array([sum(t["n"].to_pylist())], pa.int64())})

        kind = "part int, p binary, n long"
        got = texts.where("learn").select("t").mapInArrow(learn, kind).groupBy("part").applyInArrow(add, kind).collect()
        if not got:
            return model
        mean = sum(np.frombuffer(r["p"]) for r in got) / sum(r["n"] for r in got)
        at = 0
        for n in names:
            size = int(np.prod(shapes[n]))
            model.p[n] = mean[at:at + size].reshape(shapes[n]).astype(np.float32)
            at += size
    return model


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", top_words: int = TOP_WORDS,
          rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Base and model log10 probabilities of every whole text, one row for each input row.

    ``learn`` marks the rows to learn from.  Returns ``id_col``, learned, n_tokens (words and one
    end), n_known (tokens of the training corpus), train_tokens, base_score, score.  A null, empty or
    blank text is its end alone.  Repeated rows count, and are scored, each; with nothing to learn
    from every token is unknown and the model is uniform but for its random start.  Other columns
    are ignored; an empty table gives no rows.

    Documents are dealt to blocks of about ``block_bytes`` by a hash of id and length; a block and the
    counts of its distinct words are all that a task holds.
    """
    spark = docs.sparkSession
    small_batches(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("t"),
                        F.coalesce(learn, F.lit(False)).alias("learn"))
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    shards = max(1, min(blocks, shuffle_partitions(spark)))
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("id", F.length("t")), F.lit(blocks)).cast("int"))
    totals = reliable(
        dealt.groupBy("block").applyInArrow(_block_counts(shards), "shard int, block int, words binary, counts binary")
        .groupBy("shard").applyInArrow(_shard_totals(top_words), "block int, words binary, counts binary, facts binary"))
    facts = [pickle.loads(r["facts"]) for r in totals.where("facts IS NOT NULL").select("facts").toLocalIterator()]
    vocabulary = _vocabulary(facts, top_words)
    model = _trained(texts, vocabulary, rounds)
    shared = spark.sparkContext.broadcast((vocabulary, model, model.normalisers()))

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        voc, m, z = shared.value
        h, to = tokens(*text_buffer(left["t"]))
        words = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in right["words"]] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in right["counts"]] or [np.zeros(0, np.int64)])
        order = np.argsort(words)
        c = counts[order][np.searchsorted(words[order], h)] if len(h) else counts[:0]
        base = np.log10((c + 1) / (voc.n_tokens + voc.n_distinct + 1))
        w = voc.classes(h)
        one, two = contexts(w, to, voc.size)
        logp = m.log_probabilities(one, two, w, z)
        rest = w >= len(voc.top)
        g = w[rest] - len(voc.top)
        logp[rest] += np.log((c[rest] + 1) / (voc.group_tokens[g] + voc.group_distinct[g] + 1))
        first = to[:-1]
        n = len(first)
        return pa.table({"id": left["id"], "learned": left["learn"], "n_tokens": pa.array(np.diff(to).astype(np.int64)),
                         "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
                         "train_tokens": pa.array(np.full(n, voc.n_tokens, np.int64)),
                         "base_score": pa.array(np.add.reduceat(base, first)),
                         "score": pa.array(np.add.reduceat(logp, first) / np.log(10))})

    return (dealt.groupBy("block").cogroup(totals.where("facts IS NULL").groupBy("block"))
            .applyInArrow(apply, f"id {id_type}, learned boolean, n_tokens long, n_known long, train_tokens long, "
                                 "base_score double, score double").withColumnRenamed("id", id_col))
