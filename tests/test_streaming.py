"""Streaming pipelines replayed from time-ordered files must equal the batch operators."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from paths import SF_SMALL
from quantsilo.operators import ops, silver
from quantsilo.sources import fixtures as fx
from quantsilo.streaming import pipeline as P

N_FILES = 4


def _write_ordered(df, path, order_col):
    """Write ``df`` as N_FILES files in time order (sequential jobs -> increasing file times)."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) / N_FILES
    for i in range(N_FILES):
        a, b = lo + step * i, (lo + step * (i + 1) if i < N_FILES - 1 else hi + dt.timedelta(seconds=1))
        df.filter((F.col(order_col) >= a) & (F.col(order_col) < b)).coalesce(1) \
          .write.mode("append").parquet(path)


def _cmp(a, b, keys):
    cols = sorted(set(a.columns) & set(b.columns))
    def norm(df):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())
    return norm(a) == norm(b)


def test_silver_stream_equals_batch_then_late_row_and_restart(spark):
    base = tempfile.mkdtemp(prefix="qs-stream-")
    src, out, ckpt = f"{base}/ticks", f"{base}/tables", f"{base}/ckpt"
    ticks = fx.ticks(spark, SF_SMALL)
    _write_ordered(ticks, src, "ts")
    stream = P.file_stream(spark, src, ticks.schema, max_files=1)
    q = P.start_silver(stream, out, ckpt, available_now=True)
    q.awaitTermination(600)
    got = spark.read.parquet(f"{out}/silver").drop("day")
    want = silver.silver(ticks)
    assert got.count() == want.count()
    assert _cmp(got, want, P.SilverSink.KEYS)

    serving = spark.read.parquet(f"{out}/serving")
    assert serving.count() == want.count() and "anomaly_score" not in serving.columns
    state = spark.read.parquet(f"{out}/latest_state").collect()
    assert len(state) == ticks.select("symbol").distinct().count()
    assert all('"max_pain":null' in r.state_json for r in state)

    # A row far behind the watermark is dropped; R3: restart from the checkpoint adds nothing else
    old = ticks.orderBy("ts").limit(1).withColumn("price", F.lit(99999.0)).withColumn("event_id", F.lit(10**9))
    old.write.mode("append").parquet(src)
    q2 = P.start_silver(P.file_stream(spark, src, ticks.schema, max_files=1), out, ckpt, available_now=True)
    q2.awaitTermination(600)
    again = spark.read.parquet(f"{out}/silver").drop("day")
    assert again.count() == want.count()
    assert again.filter(F.col("average_price") > 90000).count() == 0


def test_raw_records_stream_to_windows(spark, tmp_path):
    ticks = fx.ticks(spark, SF_SMALL).limit(200).checkpoint()
    records = ops.to_kafka_records(ticks)
    records.coalesce(1).write.parquet(f"{tmp_path}/records")
    stream = P.file_stream(spark, f"{tmp_path}/records", records.schema)
    q = (P.silver_windows_stream(silver.parse_ticks(stream)).writeStream.format("memory").queryName("raw_windows")
         .option("checkpointLocation", f"{tmp_path}/ckpt").outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination(120)
    got, want = spark.table("raw_windows"), silver.window_metrics(ticks)
    assert got.count() == want.count() > 0 and _cmp(got, want, [])


def test_ticks_of_one_instant_go_by_offset_or_payload(spark):
    row = '{"symbol":"X","price":%d.0,"volume_usd":1.0,"trade_side":"BUY","buy_wall_usd":%d.0,"timestamp":"2024-01-01T00:00:01"}'
    raw = spark.createDataFrame([(row % (1, 9), 0, 5), (row % (2, 3), 0, 6)], "value string, partition int, offset long")
    for records, wall in ((raw, 3.0), (raw.select("value"), 3.0)):
        found = silver.window_metrics(silver.parse_ticks(records)).collect()
        assert {r.buy_wall_usd for r in found} == {wall} and {r.average_price for r in found} == {1.5}


def test_alarm_stream_fires_once(spark):
    base = tempfile.mkdtemp(prefix="qs-r7-")
    ticks = fx.ticks(spark, SF_SMALL)
    _write_ordered(ticks, f"{base}/ticks", "ts")
    stream = P.file_stream(spark, f"{base}/ticks", ticks.schema, max_files=1)
    q = P.start_alarms(stream, fx.alarms(spark, SF_SMALL), f"{base}/fired", f"{base}/ckpt", available_now=True)
    q.awaitTermination(600)
    fired = spark.read.parquet(f"{base}/fired")
    n = fired.count()
    assert n > 0 and fired.select("alarm_id").distinct().count() == n
    bad = fired.filter(((F.col("direction") == "up") & (F.col("current_price") < F.col("target")))
                       | ((F.col("direction") == "down") & (F.col("current_price") > F.col("target"))))
    assert bad.count() == 0


def test_late_window_flags_its_followers_anew_and_keeps_the_newest_state(spark, tmp_path):
    windows = silver.window_metrics(fx.ticks(spark, SF_SMALL))
    symbol = windows.groupBy("symbol").count().orderBy(F.desc("count"), "symbol").first().symbol
    rows = windows.where(F.col("symbol") == symbol).orderBy("window_start").limit(60).checkpoint()
    starts = [r.window_start for r in rows.select("window_start").orderBy("window_start").collect()]
    late = F.col("window_start") == F.lit(starts[35])
    in_order, out_of_order = P.SilverSink(str(tmp_path / "a")), P.SilverSink(str(tmp_path / "b"))
    in_order(rows, 0)
    out_of_order(rows.where(~late), 0)
    out_of_order(rows.where(late), 1)
    for name in ("silver", "latest_state"):
        a, b = (spark.read.parquet(f"{tmp_path}/{k}/{name}") for k in "ab")
        assert a.count() == b.count() and _cmp(a, b, [])
