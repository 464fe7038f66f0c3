"""Keyed stream state with timers (R5, R6) and sinks that commit by batch id.

* ``enrich_stream`` (R6): a symbol's messages wait in list state until the watermark has passed them and
  are then applied in the order (time, kind, id), so neither their order inside a micro-batch nor the
  micro-batch they come in matters.  A timer at the earliest waiting message brings the symbol back
  when nothing else does; another one forgets a symbol that has been silent for ``ttl``.
* ``flag_stream`` (R5): finished windows (append mode) meet their symbol's last 29 in list state and
  leave with their anomaly flags.  State is the only history: no table is read back.
* ``CommittedSink`` (S10, S18): every micro-batch goes to a folder of its own in each table; a folder
  with its success marker is never written again, one without is written anew.  A batch that dies
  between sinks and is replayed therefore ends like one that ran once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from quantsilo import config as C
from quantsilo.operators import silver
from quantsilo.sources import io
from quantsilo.streaming import pipeline

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEPTH, MARK, LIQUIDATION, TRADE = range(4)
#: A waiting message: what any kind needs, nulls as 0.
_MESSAGE = "kind int, rank int, us long, event_id long, p double, q double, maker boolean, ms long, bid double, ask double, rate double, sell boolean"
_FIELDS = [f.split()[0] for f in _MESSAGE.split(", ")]
_BOOK = "bid double, ask double, mark double, rate double, liq_buy double, liq_sell double, last_us long"


def use_state_store(spark: SparkSession) -> None:
    """Named state variables and timers need the RocksDB provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _last(values: np.ndarray, has: np.ndarray, before: float) -> np.ndarray:
    """The last value at or before each row among those with ``has``; ``before`` where there is none."""
    at = np.maximum.accumulate(np.where(has, np.arange(len(has)), -1))
    return np.where(at >= 0, values[np.maximum(at, 0)], before)


def settle(symbol: str, rows: pd.DataFrame, book: tuple) -> tuple[pd.DataFrame, tuple]:
    """Apply messages in order to a symbol's book; the enriched trades and the book after them."""
    rows = rows.sort_values(["us", "rank", "event_id"], kind="stable")
    kind = rows["kind"].to_numpy()
    v = {c: rows[c].to_numpy(float) for c in ("p", "q", "bid", "ask", "rate")}
    bid, ask = (_last(v[c], kind == DEPTH, book[i]) for i, c in ((0, "bid"), (1, "ask")))
    mark, rate = (_last(v[c], kind == MARK, book[i]) for i, c in ((2, "p"), (3, "rate")))
    # liquidations belong to the next trade: they are added up by the number of trades before them
    trade = kind == TRADE
    after = np.cumsum(trade) - trade
    usd = np.where(kind == LIQUIDATION, v["p"] * v["q"], 0.0)
    sell = rows["sell"].to_numpy(bool)
    sums = [np.bincount(after, usd * side, int(trade.sum()) + 1) for side in (sell, ~sell)]
    for s, open_sum in zip(sums, book[4:6]):
        s[0] += open_sum
    t = rows[trade]
    p, q, maker = t["p"].to_numpy(float), t["q"].to_numpy(float), t["maker"].to_numpy(bool)
    b, a = bid[trade], ask[trade]
    total = b + a
    out = pd.DataFrame({
        "symbol": symbol, "price": p, "quantity": q, "volume_usd": p * q, "is_buyer_maker": maker,
        "trade_side": np.where(maker, "SELL", "BUY"), "buy_wall_usd": b, "sell_wall_usd": a,
        "imbalance_ratio": np.divide(b - a, total, out=np.zeros(len(p)), where=total > 0),
        "mark_price": mark[trade], "funding_rate": rate[trade], "liq_buy_usd": sums[0][:-1], "liq_sell_usd": sums[1][:-1],
        "timestamp": pd.to_datetime(t["ms"].to_numpy(), unit="ms"), "ts": pd.to_datetime(t["us"].to_numpy(), unit="us"),
        "event_id": t["event_id"].to_numpy()})
    last = max(int(rows["us"].max()), book[6]) if len(rows) else book[6]
    ends = [float(x[-1]) if len(x) else book[i] for i, x in enumerate((bid, ask, mark, rate))]
    return out, (*ends, float(sums[0][-1]), float(sums[1][-1]), last)


class ExchangeState(StatefulProcessor):
    """Last book, mark price and liquidations since the previous trade, in event-time order."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _MESSAGE)
        self.book = handle.getValueState("book", _BOOK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            self.waiting.appendList(list(part[_FIELDS].itertuples(index=False, name=None)))
        yield self._advance(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._advance(key, timerValues)

    def _advance(self, key, timers) -> pd.DataFrame:
        now = timers.getCurrentWatermarkInMs()
        rows = pd.DataFrame(list(self.waiting.get()), columns=_FIELDS) if self.waiting.exists() else pd.DataFrame(columns=_FIELDS)
        book = self.book.get() if self.book.exists() else (0.0,) * 6 + (0,)
        ready = rows["us"].astype("int64") <= now * 1000
        out, book = settle(key[0], rows[ready], tuple(book))
        later = rows[~ready]
        if len(later):
            self.waiting.put(list(later.itertuples(index=False, name=None)))
            # timers lie ahead of the watermark
            self.handle.registerTimer(max(now + 1, -(-int(later["us"].min()) // 1000)))
        else:
            self.waiting.clear()
        silent = book[6] // 1000 + self.ttl_ms
        if book[6] and (len(later) or silent > now):
            self.book.update(book)
            self.handle.registerTimer(max(now + 1, silent))
        else:
            self.book.clear()
        return out

    def close(self) -> None:
        pass


def enrich_stream(messages: DataFrame, delay: str = C.SILVER_WATERMARK, ttl_ms: int = 86_400_000) -> DataFrame:
    """One enriched tick for every trade, once the watermark (``delay`` behind the newest message) has passed it.

    A message behind the watermark is dropped.  A symbol without messages for ``ttl_ms`` starts again from zero.
    """
    use_state_store(messages.sparkSession)
    code = F.when(F.col("kind") == "depth", DEPTH).when(F.col("kind") == "mark", MARK).when(
        F.col("kind") == "liquidation", LIQUIDATION).otherwise(TRADE)

    def number(c):
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    m = (messages.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
         .select(F.upper("raw_symbol").alias("symbol"), "ts", code.cast("int").alias("kind"), F.col("kind_rank").cast("int").alias("rank"),
                 F.unix_micros("ts").alias("us"), F.col("event_id").cast("long").alias("event_id"), number("p").alias("p"),
                 number("q").alias("q"), F.coalesce("m", F.lit(False)).alias("maker"),
                 F.coalesce(F.col("T").cast("long"), F.lit(0)).alias("ms"), number("bid_wall").alias("bid"),
                 number("ask_wall").alias("ask"), number("r").alias("rate"),
                 F.coalesce(F.col("liq_side") == "SELL", F.lit(False)).alias("sell")))
    return m.groupBy("symbol").transformWithStateInPandas(
        ExchangeState(ttl_ms), pipeline.ENRICHED_SCHEMA, "append", "EventTime")


# ------------------------------------------------------- anomaly history ----
class WindowHistory(StatefulProcessor):
    """R5 + W12 + W13: a symbol's last windows in list state; each finished window leaves flagged."""

    def __init__(self, history: int = C.ANOMALY_HISTORY):
        self.history = history

    def init(self, handle) -> None:
        self.last = handle.getListState("last", "volume double, imbalance double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # windows leave the aggregate when the watermark passes their end, so no batch holds one from before
        new = pd.concat(list(rows), ignore_index=True).sort_values("window_start", kind="stable")
        old = pd.DataFrame(list(self.last.get()) if self.last.exists() else [], columns=["volume", "imbalance"], dtype=float)
        v = pd.concat([old["volume"], new["volume_usd"].astype(float)], ignore_index=True)
        i = pd.concat([old["imbalance"], new["wall_imbalance"].astype(float)], ignore_index=True)
        mean, n = {}, v.rolling(self.history, min_periods=1).count()
        z = {}
        for name, x in (("v", v), ("i", i)):
            r = x.rolling(self.history, min_periods=1)
            mean[name] = r.mean()
            z[name] = (x - mean[name]) / (r.std(ddof=0) + C.ANOMALY_EPS)
        enough = n >= C.ANOMALY_MIN_ROWS
        wash = enough & (z["v"] > C.ANOMALY_Z)
        spoof = enough & (z["i"].abs() > C.ANOMALY_Z) & (v < mean["v"] * C.SPOOF_VOLUME_FRACTION)
        score = np.where(enough, np.maximum(z["v"].abs(), z["i"].abs()), 0.0)
        k = len(old)
        self.last.put([(float(a), float(b)) for a, b in zip(v[-(self.history - 1):], i[-(self.history - 1):])])
        yield new.assign(symbol=key[0], anomaly_wash_trading=wash[k:].to_numpy(), anomaly_spoofing=spoof[k:].to_numpy(),
                         anomaly_score=score[k:])[_flag_columns()]

    def close(self) -> None:
        pass


def _flag_columns() -> list[str]:
    return ["window_start", "window_end", *silver.SILVER_COLUMNS]


def flag_stream(ticks: DataFrame, watermark: str = C.SILVER_WATERMARK) -> DataFrame:
    """Silver rows of finished windows: aggregate, bands and anomaly flags in one stream (append mode)."""
    use_state_store(ticks.sparkSession)
    w = pipeline.silver_windows_stream(ticks, watermark)
    w = silver.liquidation_bands(w.withColumn("predicted_price", F.col("average_price")))
    kinds = {f.name: f.dataType.simpleString() for f in w.schema.fields}
    kinds |= {"anomaly_wash_trading": "boolean", "anomaly_spoofing": "boolean", "anomaly_score": "double"}
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in _flag_columns())
    return w.groupBy("symbol").transformWithStateInPandas(WindowHistory(), ddl, "append", "None")


# ------------------------------------------------------------ committed sinks ----
class CommittedSink:
    """Writes each micro-batch once to silver, serving and latest state, whatever is retried.

    A table is the union of its batch folders that carry a success marker.  The state table's newest
    such folder holds the newest window of every symbol: the batch's merged with the folder before.
    """

    TABLES = ("silver", "serving", "latest_state")

    def __init__(self, base_path: str, max_pain: DataFrame | None = None):
        self.base_path, self.max_pain = base_path.rstrip("/"), max_pain

    def _folder(self, table: str, batch_id: int) -> str:
        return f"{self.base_path}/{table}/batch={batch_id}"

    def committed(self, spark: SparkSession, table: str) -> list[int]:
        """Ids of the batches that the table holds in full."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.base_path}/{table}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch=")]
        return sorted(int(p.getName()[6:]) for p in names if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        """The committed rows of a table (of the state: of its newest batch)."""
        ids = self.committed(spark, table)
        if table == "latest_state":
            ids = ids[-1:]
        return spark.read.parquet(*[self._folder(table, i) for i in ids]) if ids else None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = {t: self.committed(spark, t) for t in self.TABLES}
        if all(batch_id in ids for ids in done.values()):
            return
        batch = batch.persist()
        try:
            if batch_id not in done["silver"]:
                self._write(batch, "silver", batch_id)
            if batch_id not in done["serving"]:
                self._write(silver.serving_projection(batch), "serving", batch_id)
            if batch_id not in done["latest_state"]:
                self._write(self._state(spark, batch, [i for i in done["latest_state"] if i < batch_id]), "latest_state", batch_id)
        finally:
            batch.unpersist()

    def _state(self, spark: SparkSession, batch: DataFrame, before: list[int]) -> DataFrame:
        new = pipeline.latest_state(batch, self.max_pain)
        if not before:
            return new
        old = spark.read.parquet(self._folder("latest_state", before[-1])).select(*new.columns)
        # two windows may end with one tick: the later window comes with the later batch
        both = old.withColumn("_later", F.lit(0)).unionByName(new.withColumn("_later", F.lit(1)))
        return io.latest_per_key(both, ["symbol"], ["processed_time", "_later"]).drop("_later")

    def _write(self, df: DataFrame, table: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(table, batch_id))


def start_silver_once(ticks: DataFrame, base_path: str, checkpoint: str, trigger: str = C.SILVER_TRIGGER,
                      available_now: bool = False, max_pain: DataFrame | None = None):
    """Finished, flagged windows to committed tables; append mode, checkpointed."""
    w = (flag_stream(ticks).writeStream.outputMode("append").foreachBatch(CommittedSink(base_path, max_pain))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
