"""Skew-safe top-k per key.

``row_number`` over ``partitionBy(key)`` puts a whole key in one task.  Here
each key is first split into ``salts`` sub-groups by a hash of the row; each
sub-group keeps its own top k (a bounded result), and only those
``salts * k`` survivors per key meet in the final ranking.  The result is
exact: every global top-k row is in the top k of its sub-group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SALTS = 32


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, k: int,
                  salts: int = DEFAULT_SALTS, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``k`` rows of every key in ``order`` (ties broken by the full row hash)."""
    keys = list(keys)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(tie, F.lit(salts))).withColumn("_tie", tie)
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*cols, "_tie")
    pre = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*cols, "_tie")
    out = pre.withColumn("_r", F.row_number().over(w2)).filter(F.col("_r") <= k)
    if rank_col:
        out = out.withColumnRenamed("_r", rank_col)
    else:
        out = out.drop("_r")
    return out.drop("_salt", "_tie")
