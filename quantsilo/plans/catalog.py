"""Registry of named queries: a Spark builder and (when SQL can say it) a DuckDB twin.

Every builder takes ``(spark, sf_dir)`` and reads the driver tables through
``quantsilo.sources``; its work grows with those tables.  Double columns are
rounded (``ROUND_DIGITS``) on both sides because floating sums depend on
summation order, which differs between engines and between runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

ROUND_DIGITS = 6
PRE_DIGITS = 9


@dataclass
class Query:
    name: str
    ids: tuple[str, ...]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: tuple[str, ...] = ()
    digits: int = ROUND_DIGITS
    note: str = ""
    tags: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Query] = {}


def register(name: str, ids: str, sql: str | None = None, doubles: str = "",
             digits: int = ROUND_DIGITS, note: str = ""):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``ids`` are SURVEY section-2 identifiers (space separated); ``doubles``
    names the double columns the SQL twin must round (space separated).
    """
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, tuple(ids.split()), fn, sql, tuple(doubles.split()), digits, note)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            # pre-rounding at 9 digits snaps summation-order noise to the exact
            # decimal, so the final rounding agrees at half-way values
            cols.append(F.round(F.round(F.col(f.name), PRE_DIGITS), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def spark_round_sql(expr: str, digits: int) -> str:
    """SQL for Spark's ``round(double, d)``: HALF_UP on the shortest decimal form of the double."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def rounded_sql(q: Query) -> str:
    if not q.doubles:
        return q.sql
    # DECIMAL rounding is exact half-up, like Spark's round on doubles
    rep = ", ".join(f'CAST(round(CAST("{c}" AS DECIMAL(38, {PRE_DIGITS})), {q.digits}) AS DOUBLE) AS "{c}"'
                    for c in q.doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{q.sql}\n) AS _q"


def _load_all() -> None:
    # importing the modules registers their queries
    from quantsilo.plans import (queries_market, queries_indicators, queries_joins,  # noqa: F401
                                 queries_ops)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def runner(q: Query):
        return lambda spark, sf_dir: round_doubles(q.build(spark, sf_dir), q.digits)

    return {name: runner(q) for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {name: rounded_sql(q) for name, q in REGISTRY.items() if q.sql}


def coverage() -> dict[str, list[str]]:
    """Survey id -> registered query names."""
    _load_all()
    out: dict[str, list[str]] = {}
    for q in REGISTRY.values():
        for i in q.ids:
            out.setdefault(i, []).append(q.name)
    return out
