"""Exponential moving averages as a scan of a linear recurrence, in built-in functions only.

One row takes the state (fast, slow, signal) to

    fast' = u fast + (1-u) x,  slow' = v slow + (1-v) x,  signal' = w signal + (1-w) (fast' - slow')

which is an affine map.  Rows go in pieces of at most ``PIECE`` rows inside a block.  From a zero state a
piece is two running sums: with k the row's place, fast is u^k times the sum of (1-u) x u^-k, and the
signal likewise over fast - slow.  A piece as a whole is a map of (k, fast, slow, signal); the maps of a
block are composed in order, those of a key's blocks by ``ordered.scan``, and the state that enters a
piece adds u^k fast, v^k slow and a closed form for the signal.  Every row before counts, without a
constant of how far to look back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quantsilo.plans import ordered

#: Rows of a piece: u^-k must stay a double (0.8 ** -2048 is 1e198 for the shortest span in use, 9).
PIECE = 2048

_STATE = ["_n", "_fast", "_slow", "_sig"]
_ZERO = {"_n": "0L", "_fast": "0D", "_slow": "0D", "_sig": "0D"}


class _Spans:
    """The recurrence of three spans, as SQL expressions."""

    def __init__(self, fast: int, slow: int, signal: int):
        self.u, self.v, self.w = (1 - 2.0 / (s + 1) for s in (fast, slow, signal))

    def towards_signal(self, decay: float, k: str) -> str:
        """What a unit of an average before k rows has added to the signal after them."""
        return f"{(1 - self.w) * decay / (decay - self.w)!r}D * (pow({decay!r}D, {k}) - pow({self.w!r}D, {k}))"

    def after(self, k: str, fast: str, slow: str, signal: str) -> tuple[str, str, str]:
        """The state (fast, slow, signal) after k rows of zeros."""
        return (f"pow({self.u!r}D, {k}) * ({fast})", f"pow({self.v!r}D, {k}) * ({slow})",
                f"pow({self.w!r}D, {k}) * ({signal}) + {self.towards_signal(self.u, k)} * ({fast}) "
                f"- {self.towards_signal(self.v, k)} * ({slow})")

    def compose(self, one: dict, two: dict) -> dict:
        state = self.after(two["_n"], *(one[c] for c in _STATE[1:]))
        return {"_n": f"{one['_n']} + {two['_n']}", **{c: f"{x} + {two[c]}" for c, x in zip(_STATE[1:], state)}}

    def fold(self, maps: str, start: dict) -> str:
        """The state after the maps of an array, in order."""
        step = self.compose({c: f"acc.{c}" for c in _STATE}, {c: f"m.{c}" for c in _STATE})
        return f"aggregate({maps}, {_record(start)}, (acc, m) -> {_record(step)})"


def _record(x: dict) -> str:
    return "named_struct(" + ", ".join(f"'{c}', {x[c]}" for c in _STATE) + ")"


def _pieces(df: DataFrame, price: str, s: _Spans) -> DataFrame:
    """Rows with their place ``_n`` in the piece ``_piece`` and the state from zero."""
    upto = "OVER (PARTITION BY _key, _blk, _piece ORDER BY _g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def average(decay: float, x: str) -> str:
        return f"sum({1 - decay!r}D * {x} * pow({decay!r}D, -_n)) {upto} * pow({decay!r}D, _n)"

    return (df.selectExpr("*", f"floor(_g / {PIECE}) AS _piece").selectExpr("*", f"count({price}) {upto} AS _n")
            .selectExpr("*", f"{average(s.u, price)} AS _fast", f"{average(s.v, price)} AS _slow")
            .selectExpr("*", f"{average(s.w, f'CASE WHEN {price} IS NOT NULL THEN _fast - _slow END')} AS _sig"))


def ema_columns(df: DataFrame, price: str, spans: tuple[int, int, int],
                names=("EMA12", "EMA26", "MACD", "Signal"), source: DataFrame | None = None) -> DataFrame:
    """pandas ``ewm(span, adjust=False).mean()`` of ``price`` per key: fast, slow, their difference, its signal.

    ``df`` holds rows of ``ordered.arrange``.  The first price of a key starts both averages and the signal
    starts at 0.  Rows without a price repeat the averages of the row before (null before the first).
    ``source`` may hold the same rows before other columns were added: maps of pieces are then made from it.
    """
    size, total = ordered.plan_of(df)
    s = _Spans(*spans)
    x = f"CAST(`{price}` AS DOUBLE)"
    rows = _pieces(df, x, s)
    slim = _pieces((df if source is None else source).select("_key", "_blk", "_g", price), x, s)
    priced = f"CASE WHEN {x} IS NOT NULL THEN _g END"
    ends = ", ".join(f"coalesce(max_by({c}, {priced}), 0D) AS {c}" for c in _STATE[1:])
    one = slim.sparkSession.sql(
        f"SELECT _key, _blk, _piece, max(_n) AS _n, {ends}, min_by({x}, {priced}) AS _first, min({priced}) AS _first_g "
        "FROM {slim} GROUP BY _key, _blk, _piece", slim=slim)
    record = _record({c: c for c in _STATE})[:-1] + ", '_piece', _piece)"
    maps = one.sparkSession.sql(       # at most block / PIECE + 1 pieces in an array
        f"SELECT _key, _blk, _maps, _first, _first_g, _all.* FROM (SELECT *, {s.fold('_maps', _ZERO)} AS _all FROM ("
        f"SELECT _key, _blk, array_sort(collect_list({record}), (a, b) -> CAST(a._piece - b._piece AS INT)) AS _maps, "
        "min_by(_first, _first_g) AS _first, min(_first_g) AS _first_g FROM {one} GROUP BY _key, _blk))", one=one)
    maps = ordered.scan(maps, _STATE, s.compose, -(-total // size))
    # the state that enters a block: from zero up to the block before, on top of the key's first price
    w = "OVER (PARTITION BY _key ORDER BY _blk)"
    whole = "OVER (PARTITION BY _key ORDER BY _blk ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    maps = maps.selectExpr("_key", "_blk", "_maps", f"first(_first, true) {whole} AS _start", f"min(_first_g) {whole} AS _start_g",
                           *[f"coalesce(lag({c}) {w}, {_ZERO[c]}) AS {c}" for c in _STATE])
    began = s.after("_n", "_start", "_start", "0D")
    entering = {"_n": "0L", **{c: f"{b} + {c}" for c, b in zip(_STATE[1:], began)}}
    maps = maps.selectExpr("_key", "_blk", "_start_g", "_maps[0]._piece AS _piece0", "_maps", f"{_record(entering)} AS _enter")
    maps = maps.selectExpr("_key", "_blk", "_start_g", "_piece0", "transform(_maps, (x, i) -> " + s.fold(
        "slice(_maps, 1, i)", {c: f"_enter.{c}" for c in _STATE}) + ") AS _states")
    keep = [f"`{c}`" for c in df.columns]
    rows = ordered.carry(rows, maps).selectExpr(*keep, *_STATE, "_start_g", "get(_states, CAST(_piece - _piece0 AS INT)) AS _e")
    add = s.after("_n", "_e._fast", "_e._slow", "_e._sig")
    rows = rows.selectExpr(*keep, *[f"CASE WHEN _g >= _start_g THEN coalesce({c}, 0D) + {y} END AS _o{c}"
                                    for c, y in zip(_STATE[1:], add)])
    return rows.selectExpr(*keep, f"_o_fast AS `{names[0]}`", f"_o_slow AS `{names[1]}`", f"_o_fast - _o_slow AS `{names[2]}`",
                           f"_o_sig AS `{names[3]}`")
