"""Stream state with timers and committed sinks: disorder, restarts and crashes end like the batch operators."""

import datetime as dt
import json

import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F

from quantsilo.operators import exchange, silver
from quantsilo.sources import fixtures as fx
from quantsilo.streaming import pipeline as P
from quantsilo.streaming import stateful as S


def same(a, b):
    cols = sorted(b.columns)

    def norm(df):
        return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=repr)

    return norm(a) == norm(b)


def run(query):
    query.awaitTermination(600)
    assert query.exception() is None


def test_shuffled_messages_in_ten_batches_equal_the_batch_enrichment(spark, tmp_path):
    msgs = fx.exchange_messages(spark, SF_SMALL).checkpoint()
    src = f"{tmp_path}/msgs"
    tenth = F.pmod(F.xxhash64("event_id"), F.lit(10))
    for i in range(10):                                    # every batch holds messages of the whole month
        msgs.filter(tenth == i).coalesce(1).write.mode("append").parquet(src)
    end = msgs.agg(F.max("ts")).first()[0] + dt.timedelta(days=100)
    stream = lambda: S.enrich_stream(P.file_stream(spark, src, msgs.schema, max_files=1), delay="60 days")     # noqa: E731
    start = lambda: (stream().writeStream.format("parquet").option("path", f"{tmp_path}/out")                 # noqa: E731
                     .option("checkpointLocation", f"{tmp_path}/ckpt").outputMode("append").trigger(availableNow=True).start())
    run(start())
    assert spark.read.schema(P.ENRICHED_SCHEMA).parquet(f"{tmp_path}/out").count() == 0      # all still wait
    later = msgs.limit(1).withColumn("ts", F.lit(end)).withColumn("raw_symbol", F.lit("clock")).withColumn("kind", F.lit("depth"))
    later.select(*[F.col(c).cast(msgs.schema[c].dataType) for c in msgs.columns]).coalesce(1).write.mode("append").parquet(src)
    run(start())                                           # a restart, and the watermark passes everything
    got, want = spark.read.parquet(f"{tmp_path}/out"), exchange.enrich_trades(msgs)
    assert got.count() == want.count() > 0 and same(got, want)


def test_book_is_forgotten_after_silence():
    import pandas as pd
    rows = pd.DataFrame([(S.DEPTH, 0, 1_000, 1, 0, 0, False, 0, 5.0, 3.0, 0, False), (S.LIQUIDATION, 0, 2_000, 2, 2.0, 4.0, False, 0, 0, 0, 0, True)],
                        columns=S._FIELDS)
    out, book = S.settle("X", rows, (0.0,) * 6 + (0,))
    assert len(out) == 0 and book == (5.0, 3.0, 0.0, 0.0, 8.0, 0.0, 2_000)
    trade = pd.DataFrame([(S.TRADE, 1, 3_000, 3, 10.0, 1.0, True, 7, 0, 0, 0, False)], columns=S._FIELDS)
    out, book = S.settle("X", trade, book)
    assert out[["buy_wall_usd", "liq_buy_usd", "trade_side"]].values.tolist() == [[5.0, 8.0, "SELL"]]
    assert book == (5.0, 3.0, 0.0, 0.0, 0.0, 0.0, 3_000)


@pytest.fixture(scope="module")
def ticks(spark):
    return fx.ticks(spark, SF_SMALL).checkpoint()


def in_four(ticks, path):
    lo, hi = ticks.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / 4
    for i in range(4):
        a, b = lo + step * i, lo + step * (i + 1) if i < 3 else hi + dt.timedelta(seconds=1)
        ticks.filter((F.col("ts") >= a) & (F.col("ts") < b)).coalesce(1).write.mode("append").parquet(path)


def finished(ticks):
    """Silver rows of windows that the watermark has passed by the end of the replay."""
    last = ticks.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=1)
    return silver.silver(ticks).filter(F.col("window_end") <= F.lit(last))


def test_flags_from_state_equal_the_batch_flags_after_a_crash_between_sinks(spark, ticks, tmp_path, monkeypatch):
    src, base, ckpt = f"{tmp_path}/ticks", f"{tmp_path}/tables", f"{tmp_path}/ckpt"
    in_four(ticks, src)
    start = lambda: S.start_silver_once(P.file_stream(spark, src, ticks.schema, max_files=1), base, ckpt, available_now=True)
    real, failed = S.CommittedSink._write, []

    def fails_once(self, df, table, batch_id):
        if table == "serving" and batch_id >= 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("the batch dies between two sinks")
        real(self, df, table, batch_id)

    monkeypatch.setattr(S.CommittedSink, "_write", fails_once)
    with pytest.raises(Exception, match="dies between"):
        start().awaitTermination(600)
    sink = S.CommittedSink(base)
    assert failed and failed[0] in sink.committed(spark, "silver") and failed[0] not in sink.committed(spark, "serving")
    run(start())                                           # replays that batch, and goes on
    got, want = sink.read(spark, "silver"), finished(ticks)
    assert got.count() == want.count() > 0 and same(got, want)
    assert sink.read(spark, "serving").count() == want.count()
    state, newest = ({r.symbol: {k: round(v, 6) if isinstance(v, float) else v for k, v in json.loads(r.state_json).items()}
                      for r in df.collect()} for df in (sink.read(spark, "latest_state"), P.latest_state(want)))
    assert state == newest and len(state) == want.select("symbol").distinct().count()
    sink(got.limit(3), failed[0])                          # a replay of what is there changes nothing
    assert sink.read(spark, "silver").count() == want.count()
