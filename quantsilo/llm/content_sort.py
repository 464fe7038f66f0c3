"""Exact duplicates by a content sort.

Sampled splitters range-partition the normalised texts, each partition is sorted externally so
that equal texts stand next to each other, and neighbours are compared in full.

* The sort key is (first ``SPLIT_BYTES`` characters, SHA-256, whole text, length descending, id):
  splitters hold only the first two and the last two parts, so a sample never carries whole texts
  to the driver; a group of any size is spread over as many partitions as its rows need.
* A partition writes thin rows (id, digest, run); only its first and last run can go on in a
  neighbouring partition.  Those runs, at most two for each partition, are summed by digest and
  broadcast; no row is shuffled a second time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo.llm.common import plain_text, reliable, shuffle_partitions, small_batches

#: What normalisation deletes.
SPACES = r"[ \t\n\x0B\f\r]+"
#: Characters of the normalised text that splitters may hold.
SPLIT_BYTES = 32

_THIN = ("id {t}, text_sha256 string, n_chars int, part int, run long, keep_id {t}, run_rows long, "
         "first boolean, edge boolean")


def _close(rows: list[pa.RecordBatch], part: int, run: int, edge: bool, schema: pa.Schema) -> pa.RecordBatch:
    """The rows of one finished run; the first in sort order is the one to keep."""
    t = pa.Table.from_batches(rows).combine_chunks().to_batches()[0] if len(rows) > 1 else rows[0]
    n = t.num_rows
    first = np.zeros(n, bool)
    first[0] = True
    keep = pa.repeat(t.column("id")[0], n)
    return pa.RecordBatch.from_arrays(
        [t.column("id"), t.column("sha"), t.column("n_chars"), pa.array(np.full(n, part, np.int32)),
         pa.array(np.full(n, run, np.int64)), keep, pa.array(np.full(n, n, np.int64)), pa.array(first),
         pa.array(first & edge)], schema=schema)


def _scanner(schema: pa.Schema):
    def scan(batches):
        part = TaskContext.get().partitionId()
        last, open_rows, run = None, [], 0
        for b in batches:
            if b.num_rows == 0:
                continue
            text = b.column("norm")
            new = np.ones(b.num_rows, bool)
            new[1:] = pc.not_equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
            new[0] = last is None or text[0].as_py() != last
            last = text[-1].as_py()
            thin = pa.RecordBatch.from_arrays([b.column("id"), b.column("sha"), b.column("n_chars")],
                                              names=["id", "sha", "n_chars"])
            cuts = [*np.flatnonzero(new).tolist(), b.num_rows]
            if cuts[0]:
                open_rows.append(thin.slice(0, cuts[0]))
            for i, j in zip(cuts, cuts[1:]):
                if open_rows:
                    yield _close(open_rows, part, run, run == 0, schema)
                    run += 1
                open_rows = [thin.slice(i, j - i)]
        if open_rows:
            yield _close(open_rows, part, run, True, schema)

    return scan


def _merged(batches_of, schema):
    """Runs are often single rows: hand them on in larger batches."""
    def go(batches):
        held, n = [], 0
        for b in batches_of(batches):
            held.append(b)
            n += b.num_rows
            if n >= 4096:
                yield pa.Table.from_batches(held, schema).combine_chunks().to_batches()[0]
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held, schema).combine_chunks().to_batches()[0]

    return go


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 spaces: str = SPACES) -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Texts are equal when identical after deleting ``spaces``; null counts as empty.  The row with
    the most code points stays, then the smallest id; a null id comes after all others, and of
    rows that are the same in id and text exactly one has ``kept``.  Other columns are ignored,
    whatever their names.  An empty table gives no rows.

    Returns ``id_col``, keep_id, group_size, kept, text_sha256 (of the normalised UTF-8), n_chars.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = plain_text(text_col)
    norm = F.regexp_replace(text, spaces, "")
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("id"), norm.alias("norm"), F.length(text).alias("n_chars"))
    keyed = keyed.select("id", "norm", "n_chars", F.sha2(F.col("norm"), 256).alias("sha"))
    head = F.substring("norm", 1, SPLIT_BYTES)
    rest = [F.col("n_chars").desc(), F.col("id").asc_nulls_last()]
    ordered = (keyed.repartitionByRange(shuffle_partitions(spark), head, F.col("sha"), *rest)
               .sortWithinPartitions(head, F.col("sha"), F.col("norm"), *rest)
               .select("id", "norm", "sha", "n_chars"))
    ddl = _THIN.format(t=id_type)
    schema = pa.schema([("id", _arrow(docs, id_col)), ("text_sha256", pa.string()), ("n_chars", pa.int32()),
                        ("part", pa.int32()), ("run", pa.int64()), ("keep_id", _arrow(docs, id_col)),
                        ("run_rows", pa.int64()), ("first", pa.bool_()), ("edge", pa.bool_())])
    thin = reliable(ordered.mapInArrow(_merged(_scanner(schema), schema), ddl))
    # at most two rows for each partition
    edges = (thin.where("edge").groupBy("text_sha256")
             .agg(F.sum("run_rows").alias("all_rows"),
                  F.min(F.struct("part", "keep_id")).alias("lead")))
    lead = F.coalesce(F.col("lead.part"), F.col("part"))
    return (thin.join(F.broadcast(edges), "text_sha256", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("lead").isNull(), F.col("keep_id")).otherwise(F.col("lead.keep_id")).alias("keep_id"),
                    F.coalesce("all_rows", "run_rows").alias("group_size"),
                    (F.col("first") & (F.col("part") == lead)).alias("kept"), "text_sha256", "n_chars"))


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)
