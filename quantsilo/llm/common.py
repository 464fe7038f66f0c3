"""Helpers shared by the training-data operators: reliable checkpoints, fold hashes, text buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantsilo.session import ensure_checkpoint_dir, scratch_path

#: Words are runs of characters outside these (space, \t, \n, \v, \f, \r).
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

#: Spark's own bound of an Arrow batch, too much for several copies of a batch in a Python worker.
DEFAULT_BATCH = "67108864b"
#: Text bytes hashed at once: bounds the scratch arrays of ``word_hashes``.
SEGMENT = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quoted(name: str) -> str:
    """A column name as Spark's parsers take it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def free(name: str, taken) -> str:
    """``name``, with underscores after it until no name of ``taken`` begins with it."""
    low = [t.lower() for t in taken]
    while any(t.startswith(name.lower()) for t in low):
        name += "_"
    return name


def map_rows(df: DataFrame, keep, value: Column, fn, added: list[tuple[str, str]]) -> DataFrame:
    """Columns ``keep`` of ``df``, whatever their names, and those that ``fn`` makes of ``value``.

    ``fn`` takes an Arrow array and returns one for each of ``added`` (name, type).  One narrow pass.
    """
    kinds = [df.schema[c].dataType.simpleString() for c in keep]
    names = [f"c{i}" for i in range(len(keep) + len(added))]
    ddl = ", ".join(f"{n} {k}" for n, k in zip(names, [*kinds, *(k for _, k in added)]))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *fn(b.columns[-1])], names)

    rows = df.select(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, names)], value.alias("value"))
    return rows.mapInArrow(run, ddl).toDF(*keep, *(n for n, _ in added))


def reliable(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared folder of ``spark.checkpoint.dir``; lineage is cut.

    A lost executor cannot take these rows away, and later passes do not repeat the work.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once into a compressed table in that folder: for rows that are many or read by columns."""
    path = scratch_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches handed to Python by bytes, unless the session sets its own bound."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == DEFAULT_BATCH:
        spark.conf.set(key, str(8 << 20))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def plain_text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


# ---- byte level helpers used inside Arrow tasks ------------------------------------------------

def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of an Arrow column and the n+1 offsets (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    size = 8 if wide else 4
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32, n + 1,
                        col.offset * size).astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def byte_set(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, off: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and ends of the words of all texts, and the n+1 word offsets of the texts."""
    w = is_word[data]
    first, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    first[off[:-1]] = True          # a text's first byte begins a word whatever stands before it
    last[off[1:]] = True
    before = np.empty_like(w)
    after = np.empty_like(w)
    if len(w):
        before[0], before[1:] = False, w[:-1]
        after[-1], after[:-1] = False, w[1:]
    starts = np.flatnonzero(w & (~before | first[:-1]))
    ends = np.flatnonzero(w & (~after | last[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (invertible), on unsigned arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        n = max(n, SEGMENT + 4096)
        p = np.full(n, _ODD, np.uint64)
        q = np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
        p[0] = q[0] = 1
        _POWERS["p"], _POWERS["q"] = np.cumprod(p), np.cumprod(q)
    return _POWERS["p"], _POWERS["q"]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, A-Z lower-cased: a polynomial over random byte values, mixed.

    Differences of running sums give all words of a segment at once; ``_ODD`` has an inverse
    modulo 2**64, which moves a word's sum to position 0.
    """
    table = _BYTE[LOWER]
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, a + SEGMENT, "right")))
        b = int(ends[j - 1])
        p, q = _powers(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * p[:b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * q[s] + (e - s).astype(np.uint64))
        i = j
    return out
