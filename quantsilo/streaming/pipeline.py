"""Structured Streaming: bronze, silver and stateful enrichment.

* Sources: Kafka (``subscribe``, starting offsets, ``maxOffsetsPerTrigger``,
  ``failOnDataLoss``) when its connector is on the classpath, or a file
  stream with ``maxFilesPerTrigger`` (tests, replays).
* Bronze: append-only raw records with a checkpoint and a 5 s trigger.
* Silver: event-time watermark (1 minute) + 10 s / 5 s sliding windows in
  update mode; every micro-batch goes through ``SilverSink`` (foreachBatch):
  the batch is persisted once, anomaly history (last 30 windows per symbol)
  is read back from the stored silver table - so a restart replays
  identically - and three sinks are written: silver (upsert), serving table
  (upsert of 18 columns) and the latest state per symbol as JSON.
* Exchange state (R6), history in state (R5) and sinks that commit by batch id: ``streaming.stateful``.
* Alarms (R7): each micro-batch's latest prices check the live alarms; fired
  alarms are appended to a table and excluded from later batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantsilo import config as C
from quantsilo.operators import alerts, silver
from quantsilo.plans import ordered, topk
from quantsilo.plans.joins import broadcast_if_small
from quantsilo.session import ensure_checkpoint_dir
from quantsilo.sources import io


# ------------------------------------------------------------- sources ----
def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets: int | None = None, fail_on_data_loss: bool = False) -> DataFrame:
    """Kafka scan (needs the spark-sql-kafka connector)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    return r.load()


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """File-stream replacement for the Kafka source (rate-capped with ``maxFilesPerTrigger``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


# -------------------------------------------------------------- bronze ----
def start_bronze(records: DataFrame, path: str, checkpoint: str, trigger: str = C.SILVER_TRIGGER,
                 available_now: bool = False):
    """Raw records appended to the bronze table (P2 projection), checkpointed."""
    from quantsilo.operators.ops import bronze
    w = (bronze(records).writeStream.outputMode("append").format("parquet")
         .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


# -------------------------------------------------------------- silver ----
def silver_windows_stream(ticks: DataFrame, watermark: str = C.SILVER_WATERMARK) -> DataFrame:
    """R1 + R2 + A1-A5: watermarked sliding-window aggregate (streaming)."""
    t = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    w = silver.window_metrics(t)
    return (w.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
            .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
            .withColumn("processed_time", F.col("processed_time").cast("timestamp_ntz")))


class SilverSink:
    """S10 multi-sink for each micro-batch of silver windows (R5 history, S11-S13, S18, J9)."""

    KEYS = ["symbol", "window_start"]

    def __init__(self, base_path: str, max_pain: DataFrame | None = None,
                 history: int = C.ANOMALY_HISTORY):
        self.silver_path = f"{base_path}/silver"
        self.serving_path = f"{base_path}/serving"
        self.state_path = f"{base_path}/latest_state"
        self.max_pain = max_pain
        self.history = history

    def _history(self, spark: SparkSession, batch: DataFrame) -> DataFrame | None:
        """Stored windows each batch symbol needs: its last ``history - 1`` before the batch, and later ones.

        Only partitions from the day before the batch's first window are read;
        symbols that find fewer earlier windows there (a quiet symbol) are
        read again over all days - restricted to those symbols - so the
        result stays exact without scanning the whole table every trigger.
        """
        table = io.read_if_there(spark, self.silver_path)
        if table is None:
            return None
        cols = batch.columns
        first = batch.groupBy("symbol").agg(F.min("window_start").alias("_first"))
        since = batch.agg(F.date_sub(F.to_date(F.min("window_start")), 1).alias("d")).first().d

        def pick(stored):
            stored = stored.select(*cols).join(batch.select(*self.KEYS), self.KEYS, "left_anti")
            s = stored.join(broadcast_if_small(first), "symbol")
            before = s.filter(F.col("window_start") < F.col("_first")).drop("_first")
            after = s.filter(F.col("window_start") >= F.col("_first")).drop("_first")
            back = topk.top_k_per_key(before, ["symbol"], [F.col("window_start").desc()], self.history - 1)
            return back, after

        back, after = pick(table.filter(F.col("day") >= F.lit(since)))
        short = (first.join(back.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n")), "symbol", "left")
                 .filter(F.coalesce(F.col("_n"), F.lit(0)) < self.history - 1).select("symbol"))
        if not short.isEmpty():
            old = table.filter(F.col("day") < F.lit(since)).join(broadcast_if_small(short), "symbol", "left_semi")
            late = table.filter(F.col("day") >= F.lit(since)).join(broadcast_if_small(short), "symbol", "left_semi")
            back2, _ = pick(old.unionByName(late))
            back = back.join(broadcast_if_small(short), "symbol", "left_anti").unionByName(back2)
        return back.unionByName(after)

    def _touched(self, batch: DataFrame, hist: DataFrame | None) -> DataFrame:
        """Keys of the batch's windows and of the stored ones whose history holds one of them."""
        if hist is None:
            return batch.select(*self.KEYS)
        keys = batch.select(*self.KEYS, F.lit(1).alias("_new")).unionByName(
            hist.select(*self.KEYS, F.lit(0).alias("_new")))
        reach = self.history - 1
        keys = ordered.rolling(ordered.arrange(keys, ["symbol"], ["window_start"]), lambda w: [
            F.max("_new").over(w.rowsBetween(-reach, 0)).alias("_hit")], lookback=reach)
        return keys.filter("_hit = 1").select(*self.KEYS)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        ensure_checkpoint_dir(spark)
        batch = batch_df.persist()
        try:
            if batch.isEmpty():
                return
            hist = self._history(spark, batch)
            rows = batch if hist is None else batch.unionByName(hist)
            rows = silver.liquidation_bands(rows.withColumn("predicted_price", F.col("average_price")))
            # written out before the tables that it is read from are replaced
            flagged = (silver.anomaly_flags(rows).select("window_start", "window_end", *silver.SILVER_COLUMNS)  # R5
                       .withColumn("day", F.to_date("window_start")).checkpoint())
            # a late window changes the history of those that follow it: they are flagged anew as well
            out = flagged.join(self._touched(batch, hist), self.KEYS, "left_semi").checkpoint()
            io.upsert(spark, out, self.silver_path, self.KEYS, ["symbol", "day"])         # S11 S12
            io.upsert(spark, silver.serving_projection(out), self.serving_path,           # S13
                      self.KEYS, ["day"])
            # every stored window from the batch's first on is in ``flagged``, so its newest is the newest of all
            io.upsert(spark, latest_state(flagged, self.max_pain), self.state_path, ["symbol"])  # S18
        finally:
            batch.unpersist()


def latest_state(silver_rows: DataFrame, max_pain: DataFrame | None = None) -> DataFrame:
    """S18 + J9: newest window per symbol as a JSON document; max pain joined when known."""
    last = io.latest_per_key(silver_rows, ["symbol"], ["processed_time", "window_start"])
    if max_pain is not None:
        last = last.join(broadcast_if_small(max_pain.select("symbol", "max_pain")), "symbol", "left")
    else:
        last = last.withColumn("max_pain", F.lit(None).cast("double"))
    doc = F.to_json(F.struct(
        F.col("average_price").alias("p"), "predicted_price", "trade_side", "cvd", "volatility",
        F.col("vpin_score").alias("vpin"), F.col("imbalance_ratio").alias("imb"), "wall_imbalance",
        "buy_wall_usd", "sell_wall_usd", F.col("liq_buy_usd").alias("liq_buy"),
        F.col("liq_sell_usd").alias("liq_sell"), F.col("funding_rate").alias("fr"),
        "liq_up_25x", "liq_dn_25x", "liq_up_50x", "liq_dn_50x", "max_pain",
        F.col("anomaly_wash_trading").alias("anomaly_wash"), F.col("anomaly_spoofing").alias("anomaly_spoof"),
        F.col("anomaly_score").alias("anomaly_zscore")), {"ignoreNullFields": "false"})
    return last.select("symbol", "processed_time", doc.alias("state_json"))


def start_silver(ticks: DataFrame, base_path: str, checkpoint: str, trigger: str = C.SILVER_TRIGGER,
                 available_now: bool = False, max_pain: DataFrame | None = None):
    """Update output mode, checkpointed, 5 s trigger (or availableNow for replays)."""
    w = (silver_windows_stream(ticks).writeStream.outputMode("update")
         .foreachBatch(SilverSink(base_path, max_pain)).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


# ------------------------------------------------- exchange state (R6) ----
ENRICHED_SCHEMA = ("symbol string, price double, quantity double, volume_usd double, is_buyer_maker boolean, "
                   "trade_side string, buy_wall_usd double, sell_wall_usd double, imbalance_ratio double, "
                   "mark_price double, funding_rate double, liq_buy_usd double, liq_sell_usd double, "
                   "timestamp timestamp_ntz, ts timestamp_ntz, event_id long")


# -------------------------------------------------------------- alarms ----
class AlarmSink:
    """Fire each alarm once - on the first micro-batch whose latest price crosses it - while alive."""

    def __init__(self, alarms: DataFrame, fired_path: str):
        self.alarms = alerts.cap_per_user(alarms)
        self.fired_path = fired_path

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch = batch_df.persist()
        try:
            if batch.isEmpty():
                return
            as_of = batch.agg(F.max("ts").alias("as_of"))
            live = alerts.live_alarms(self.alarms, as_of)
            done = io.read_if_there(spark, self.fired_path)
            if done is not None:
                live = live.join(done.select("alarm_id"), "alarm_id", "left_anti")
            fired = alerts.triggered(live, alerts.current_prices(batch)).withColumn("batch_id", F.lit(batch_id))
            fired.write.mode("append").parquet(self.fired_path)
        finally:
            batch.unpersist()


def start_alarms(ticks: DataFrame, alarms: DataFrame, fired_path: str, checkpoint: str,
                 available_now: bool = False, trigger: str = C.SILVER_TRIGGER):
    w = ticks.writeStream.foreachBatch(AlarmSink(alarms, fired_path)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()
