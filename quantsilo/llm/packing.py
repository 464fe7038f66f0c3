"""Sequence packing as a cutting-stock problem, solved by column generation.

Documents are tokenised and cut into pieces of at most ``SIZE`` ids; a histogram of piece lengths,
at most ``SIZE`` numbers, is all that the driver sees.  A linear program over patterns (multisets of
lengths that fit a sequence) covers it at least cost; a knapsack dynamic program prices new
patterns with the program's dual values.  The solution is rounded down, what remains is filled
sequence by sequence, and patterns are dealt to the documents by their rank among those of their
length, so that every task places its pieces by itself.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quantsilo.llm.common import plain_text, reliable, small_batches

SIZE = 1024
END_ID = 0
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Column generation ends when the program's cost is this close to its bound, relatively, or within
#: one sequence of it, or after so many columns.
GAP = 5e-4
MAX_COLUMNS = 2000
#: It also ends when so many columns have not lowered the cost by GAP, relatively.
STALL = 100
#: Rows of one length that one task ranks, about.
RANK_ROWS = 50_000
#: Words whose ids a worker remembers, in each of two generations.
MEMORY = 100_000


# ---- tokens ------------------------------------------------------------------------------------

#: White space that a space follows: there a text may not be cut before the space.
_UNSAFE = re.compile(r"[\s\x85] ")
#: Words encoded in one call.
_TOGETHER = 512


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, word by word with a memory.

    The pre-tokenizer's pattern never joins a character that is no white space with white space
    after it, so a text falls apart before every space that follows such a character, and each
    part has the same ids alone.  Other texts are encoded whole.

    The memory's keys are words without their space; a text's first part, which has none, is kept
    under a space and itself.  New words are encoded many at a time, as one text that falls apart
    at the same places; the tokens' byte lengths tell which ids are whose.
    """

    def __init__(self, path: str = TOKENIZER, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads hold memory of their own
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # their strings in a text are ordinary text
        self.limit, self.known, self.older = memory, {}, {}
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)   # a character stands for a byte
        self.width[list(vocabulary.values())] = [len(t) for t in vocabulary]

    def _ids(self, texts: list[str]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of memory keys."""
        together = [w for w in words if w and w[0] != " " and not w[-1].isspace()]   # a space may follow these
        alone = set(words).difference(together)
        out = {}
        for a in range(0, len(together), _TOGETHER):
            some = together[a:a + _TOGETHER]
            raw = self._ids([" " + " ".join(some)])[0]
            ends = np.cumsum([len(w.encode()) + 1 for w in some])
            reached = np.cumsum(self.width[np.frombuffer(raw, "<u4")])
            last = np.searchsorted(reached, ends)
            if last[-1] >= len(reached) or (reached[last] != ends).any():   # a tokenizer that joins words
                alone.update(some)
                continue
            at = [0, *(4 * last + 4).tolist()]
            out.update(zip(some, map(raw.__getitem__, map(slice, at, at[1:]))))
        rest = list(alone)
        out.update(zip(rest, self._ids([w[1:] if w[:1] == " " else " " + w for w in rest])))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        parts, whole = [], {}
        for k, t in enumerate(texts):
            words = []
            if _UNSAFE.search(t):
                whole[k] = t
            elif t:
                words = t.split(" ")
                words[0] = " " + words[0]
            parts.append(words)
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known     # frequent words come back, the others go
        known, older = self.known, self.older
        missing = set().union(*parts).difference(known)
        known.update({w: older[w] for w in missing if w in older})
        known.update(self._words([w for w in missing if w not in older]))
        out = [b"".join(map(known.__getitem__, p)) for p in parts]
        if whole:
            for k, ids in zip(whole, self._ids(list(whole.values()))):
                out[k] = ids
        return out


#: Longest run of white space that ``RankEncoder`` takes.
_RUN = 1 << 16
_LONG_SPACE = re.compile(r"\s{64,}")


def merge_ranks(path: str = TOKENIZER) -> dict[bytes, int] | None:
    """Bytes of each token to its id, when ids alone say what the file's tokenizer does; else None.

    That holds for byte-level BPE on plain text if every merge makes a token of its own and merges come
    in the order of ids: then the pair to merge next is the one whose token has the least id.  A pair
    that gives a token's bytes without being its merge never meets: inside a token's bytes no merge
    crosses their ends, so they go the way of the token alone, by its own merge.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback",
           "ignore_merges")
    if (model.get("type") != "BPE" or any(map(model.get, odd)) or spec.get("normalizer") or spec.get("truncation")
            or spec.get("padding") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space", True)
            or not cut.get("use_regex", True)):
        return None
    vocabulary = model["vocab"]
    merged = [vocabulary.get("".join(m.split(" ", 1) if isinstance(m, str) else m), -1) for m in model["merges"]]
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in kept]
    byte_of = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(other)}
    special = {t["content"] for t in spec.get("added_tokens") or ()}
    if any(not t.get("special") for t in spec.get("added_tokens") or ()):
        return None
    plain = {t: i for t, i in vocabulary.items() if t not in special}
    single = {t for t in plain if len(t) == 1}
    if (any(a >= b for a, b in zip(merged, merged[1:])) or min(merged, default=0) < 0 or single != set(byte_of)
            or {*merged, *map(plain.get, single)} != set(plain.values()) or max(map(plain.get, single)) > min(merged)):
        return None
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in plain.items()}


class RankEncoder:
    """Ids of whole texts as ``WordEncoder`` gives them, by the ranks of the same file in one compiled pass.

    Texts with an endless run of white space, too much for its pattern, go to the ``tokenizers`` library.
    """

    def __init__(self, ranks: dict[bytes, int], path: str = TOKENIZER):
        self.path, self.words = path, None
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _endless(self, text: str) -> bool:
        return len(text) > _RUN and any(m.end() - m.start() > _RUN for m in _LONG_SPACE.finditer(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for t in texts:
            if self._endless(t):
                self.words = self.words or WordEncoder(self.path)
                out += self.words.encode([t])
            else:
                out.append(np.asarray(self.fast.encode_ordinary(t), "<u4").tobytes())
        return out


_ENCODERS: dict[str, RankEncoder | WordEncoder] = {}


def encoder(path: str = TOKENIZER) -> RankEncoder | WordEncoder:
    """The encoder of a file, made once in a process.

    A task's function must reach it by calling this: Spark sends such a function with copies of the module's
    variables that it names itself, so a memory among them would begin empty in every task.
    """
    if path not in _ENCODERS:
        ranks = merge_ranks(path)
        _ENCODERS[path] = WordEncoder(path) if ranks is None else RankEncoder(ranks, path)
    return _ENCODERS[path]


#: Characters of text handed to the encoder at once.
_CHUNK = 1 << 18


def tokenise(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
             path: str = TOKENIZER) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens) of every text's ids with END_ID behind them."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([END_ID], "<u4").tobytes()

    def pieces(ids: pa.Array, texts: list[str], enc: RankEncoder | WordEncoder) -> pa.RecordBatch:
        row, start, length, crc, total = [], [], [], [], []
        for k, raw in enumerate(enc.encode(texts)):
            raw += end
            n = len(raw) // 4
            for a in range(0, n, size):
                z = min(n, a + size)
                row.append(k)
                start.append(a)
                length.append(z - a)
                crc.append(zlib.crc32(raw[4 * a:4 * z]))
                total.append(n)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row, pa.int64())), *(pa.array(v, pa.int64()) for v in (start, length, crc, total))],
            ["id", "start", "length", "ids_crc32", "doc_tokens"])

    def run(batches):
        enc = encoder(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            a = 0
            while a < len(texts):
                z, chars = a, 0
                while z < len(texts) and (z == a or chars + len(texts[z]) <= _CHUNK):
                    chars += len(texts[z])
                    z += 1
                yield pieces(b.column(0).slice(a, z - a), texts[a:z], enc)
                a = z

    return (docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"))


# ---- the linear program ------------------------------------------------------------------------

def padded(total: int, size: int = SIZE) -> int:
    """What a sequence of ``total`` ids costs: itself at a power of two, else ``size``."""
    return total if total & (total - 1) == 0 else size


@dataclass
class Pattern:
    """``copies`` sequences that each hold ``items``: length -> how many, laid out in that order."""

    items: dict[int, int]
    copies: int
    total: int = field(init=False)

    def __post_init__(self):
        self.total = sum(n * k for n, k in self.items.items())


def knapsack(lengths: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the most value of lengths that add up to exactly c (any number of each); last[c]: one of them."""
    best = np.full(size + 1, -np.inf)
    last = np.full(size + 1, -1)
    best[0] = 0
    ends = np.searchsorted(lengths, np.arange(size + 1), "right")
    for c in range(1, size + 1):
        e = ends[c]
        if e:
            v = values[:e] + best[c - lengths[:e]]
            j = int(v.argmax())
            if v[j] > -np.inf:
                best[c], last[c] = v[j], j
    return best, last


def greedy_basis(lengths: np.ndarray, counts: np.ndarray, size: int) -> tuple[list[dict[int, int]], np.ndarray]:
    """A first basis: one pattern for each length, and how often each is used (fractional).

    Each step takes the longest length left with the fullest set of others behind it, as often as
    some length lasts; that length is what the pattern stands for.  Later patterns do not have it,
    so the basis is triangular.  A length that runs out together with another stands alone, unused.
    """
    left = counts.astype(float)
    basis: list[dict[int, int]] = [{int(n): int(size // n)} for n in lengths]
    used = np.zeros(len(lengths))
    alive = np.flatnonzero(left > 0)
    while len(alive):
        longest = alive[-1]
        items = {int(longest): 1}
        room = int(size - lengths[longest])
        few = alive[lengths[alive] <= room]
        best, last = knapsack(lengths[few], lengths[few].astype(float) ** 2, room)
        total = np.flatnonzero(np.isfinite(best))
        waste = [1 - (t + lengths[longest]) / padded(int(t + lengths[longest]), size) for t in total]
        at = int(total[np.lexsort((-total, waste))[0]])
        while at:
            j = int(few[last[at]])
            items[j] = items.get(j, 0) + 1
            at -= int(lengths[j])
        own = min(items, key=lambda j: left[j] / items[j])
        times = left[own] / items[own]
        for j, k in items.items():
            left[j] -= k * times
        left[own] = 0
        left[left < 1e-9] = 0
        basis[own], used[own] = {int(lengths[j]): k for j, k in items.items()}, times
        alive = alive[left[alive] > 0]
    return basis, used


def column_generation(lengths: np.ndarray, counts: np.ndarray, size: int = SIZE, gap: float = GAP,
                      max_columns: int = MAX_COLUMNS) -> tuple[list[dict[int, int]], np.ndarray, float]:
    """Patterns of an optimal basis, how often each is used (fractional), and a lower bound of the cost.

    min sum cost(p) x_p  subject to  sum a_p x_p = counts, x >= 0, by the revised simplex method with
    an explicit inverse from ``greedy_basis`` on.  The dual values price the knapsack over lengths; the pattern of least
    reduced cost enters.  Farley's bound, and the ids themselves, bound the cost from below.
    """
    lengths, b = np.asarray(lengths, np.int64), np.asarray(counts, float)
    m = len(lengths)
    place = {int(n): k for k, n in enumerate(lengths)}
    basis, x = greedy_basis(lengths, b, size)
    matrix = np.zeros((m, m))
    for k, items in enumerate(basis):
        for n, c in items.items():
            matrix[place[n], k] = c
    cost = np.array([padded(sum(n * c for n, c in items.items()), size) for items in basis], float)
    inverse = np.linalg.inv(matrix)
    totals = np.arange(1, size + 1)
    price = np.where(totals & (totals - 1) == 0, totals, size).astype(float)
    bound = float(lengths @ b)      # a sequence costs at least its ids
    before = np.inf
    for step in range(max_columns):
        z = float(cost @ x)
        if z - bound <= max(gap * bound, size):
            break
        if step % STALL == 0:
            if before - z < gap * z:
                break
            before = z
        y = cost @ inverse
        best, last = knapsack(lengths, y, size)
        reach = np.isfinite(best[1:])
        ratio = np.where(reach, best[1:] / price, -np.inf)
        worst = float(ratio.max())
        bound = max(bound, z / max(worst, 1.0))
        c = int(np.where(reach, price - best[1:], np.inf).argmin()) + 1
        if price[c - 1] - best[c] > -1e-7 * size:
            break
        items: dict[int, int] = {}
        at = c
        while at:
            n = int(lengths[last[at]])
            items[n] = items.get(n, 0) + 1
            at -= n
        column = np.zeros(m)
        for n, k in items.items():
            column[place[n]] = k
        d = inverse @ column
        ok = d > 1e-7
        if not ok.any():
            break
        rate = np.full(m, np.inf)
        rate[ok] = np.maximum(x[ok], 0) / d[ok]
        theta = rate.min()
        out = int(np.where(rate <= theta + 1e-12, d, -np.inf).argmax())     # of ties the steadiest pivot
        x -= theta * d
        x[out] = theta
        matrix[:, out], cost[out], basis[out] = column, price[c - 1], items
        if step % 200 == 199:
            inverse = np.linalg.inv(matrix)
            x = inverse @ b
        else:
            row = inverse[out] / d[out]
            inverse -= np.outer(d, row)
            inverse[out] = row
    return basis, np.maximum(x, 0), bound


def fill(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Sequences for the few lengths that rounding leaves: the longest, and the fullest set that fits with it.

    Subset sums over the remaining lengths are bits of one integer; walking them back gives the set.
    """
    left = {n: k for n, k in counts.items() if k}
    out = []
    while left:
        first = max(left)
        left[first] -= 1
        room = size - first
        chosen = {first: 1}
        stages, sums, mask = [], 1, (1 << (room + 1)) - 1
        for n in sorted((n for n, k in left.items() if k and n <= room), reverse=True):
            k, part = min(left[n], room // n), 1
            while k > 0 and not sums >> room & 1:       # 1, 2, 4, ... copies give every number up to k
                part = min(part, k)
                stages.append((n, part, sums))
                sums |= (sums << (n * part)) & mask
                k -= part
                part *= 2
        at = sums.bit_length() - 1
        for n, part, before in reversed(stages):
            if not before >> at & 1:
                at -= n * part
                chosen[n] = chosen.get(n, 0) + part
        for n, k in chosen.items():
            if n != first:
                left[n] -= k
            elif k > 1:
                left[n] -= k - 1
        # as many copies as the remaining counts allow
        more = min((left[n] // k for n, k in chosen.items()), default=0)
        for n, k in chosen.items():
            left[n] -= more * k
        left = {n: k for n, k in left.items() if k}
        out.append(Pattern(chosen, 1 + more))
    return out


def patterns(counts: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Patterns with whole copies that together hold every length exactly ``counts`` times."""
    left = {int(n): int(k) for n, k in counts.items() if k and n != size}
    out = [Pattern({size: 1}, int(counts[size]))] if counts.get(size) else []
    if left:
        lengths = np.array(sorted(left))
        basis, x, _ = column_generation(lengths, np.array([left[n] for n in lengths.tolist()]), size)
        for items, copies in sorted(zip(basis, x), key=lambda p: -p[1]):
            copies = min([int(copies + 1e-9), *(left[n] // k for n, k in items.items())])
            if copies > 0:
                out.append(Pattern(dict(sorted(items.items(), reverse=True)), copies))
                for n, k in items.items():
                    left[n] -= k * copies
        out += fill(left, size)
    return out


def places(found: list[Pattern]) -> dict[str, np.ndarray]:
    """For each (pattern, length): which ranks of that length it takes, and where they go; by length and rank."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for p in found:
        at = 0
        for n, k in p.items.items():
            lo = taken.get(n, 0)
            taken[n] = lo + k * p.copies
            rows.append((n, lo, k, sequence, at))
            at += n * k
        sequence += p.copies
    t = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return {"length": t[:, 0], "lo": t[:, 1], "each": t[:, 2], "sequence": t[:, 3], "offset": t[:, 4]}


def pack(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text",
         path: str = TOKENIZER, rank_rows: int = RANK_ROWS) -> DataFrame:
    """All documents in sequences of at most ``size`` ids; one row for each piece of a document.

    Returns ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset.  A null or empty
    text is one id (END_ID).  Documents are cut every ``size`` ids from their start, so only their
    ends need packing.  Repeated rows are documents of their own; ranks among equal lengths go by a
    hash of the piece, then id and start.  Other columns are ignored; an empty table gives no rows.
    """
    pieces = reliable(tokenise(docs, size, id_col, text_col, path))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = max(1, -(-max(counts.values(), default=0) // rank_rows))
    t = places(patterns(counts, size))
    span = max(counts.values(), default=0) + 1
    keys = t["length"] * span + t["lo"]

    # ranks: a length of any number of pieces is ranked in ``buckets`` parts
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "start"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
               .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    within = Window.partitionBy("length", "bucket").orderBy("id", "start", "ids_crc32", "doc_tokens")
    ranked = (dealt.withColumn("k", F.row_number().over(within) - 1).join(offsets, ["length", "bucket"])
              .withColumn("rank", F.col("k") + F.col("ahead")))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    id_type = docs.schema[id_col].dataType.simpleString()

    def assign(batches):
        for b in batches:
            n, r = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(keys, n * span + r, "right") - 1
            q = r - t["lo"][i]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(t["sequence"][i] + q // t["each"][i]),
                 pa.array(t["offset"][i] + q % t["each"][i] * n)], [*names, "sequence_id", "offset"])

    return (ranked.select(*names, "rank")
            .mapInArrow(assign, f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
                                "sequence_id long, offset long").withColumnRenamed("id", id_col))
