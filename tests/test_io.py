"""Sources and sinks: CSV, lake tables, upsert, truncate, compaction, RSS, catalog, bronze stream."""

import datetime as dt
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from paths import SF_SMALL
from quantsilo.operators import gold, ops
from quantsilo.sources import fixtures as fx
from quantsilo.sources import io, versions
from quantsilo.streaming import pipeline as P


def test_csv_roundtrip_with_header_cleanup(spark):
    base = tempfile.mkdtemp(prefix="qs-csv-")
    df = spark.createDataFrame([(1, "BTC", 10.5), (2, "ETH", 3.25)], "`Müşteri No` int, `Sembol Adı` string, `Fiyat (₺)` double")
    io.write_csv(df, f"{base}/a")                                     # S19 / S20
    io.write_csv(df, f"{base}/b")
    one = io.read_csv(spark, f"{base}/a")                              # S3
    assert one.columns == ["musteri_no", "sembol_adi", "fiyat____"]
    assert one.schema["fiyat____"].dataType.simpleString() == "double"
    many = io.read_csv(spark, f"{base}/*/*.csv")                       # S4 glob
    assert many.count() == 4 and many.dropna().distinct().count() == 2     # P6 + A16
    assert io.table_name_from_file("/x/Günlük Veri.csv") == "gunluk_veri"   # S14


def test_partitioned_lake_write_prunes_and_upserts(spark):
    base = tempfile.mkdtemp(prefix="qs-lake-")
    bars = fx.daily_bars(spark, SF_SMALL).withColumn("year", F.year("timestamp"))
    io.write_lake(bars, f"{base}/bars", ["symbol", "year"], fmt="parquet")          # S15 / S17
    assert {p.split("=")[1] for p in os.listdir(f"{base}/bars") if "=" in p} == \
        {r.symbol for r in bars.select("symbol").distinct().collect()}
    scan = io.read_lake(spark, f"{base}/bars", "parquet").filter("symbol = '1-URGENT' AND year = 1996")  # S5
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "1-URGENT" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert scan.count() == bars.filter("symbol = '1-URGENT' AND year = 1996").count()

    # Update-all + insert-all on (symbol, timestamp), only touched partitions rewritten
    path = f"{base}/merge"
    io.upsert(spark, bars, path, ["symbol", "timestamp"], ["symbol"])
    first = bars.filter("symbol = '2-HIGH'").orderBy("timestamp").limit(3)
    changed = first.withColumn("close", F.lit(-1.0))
    new = changed.limit(1).withColumn("timestamp", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"))
    io.upsert(spark, changed.unionByName(new), path, ["symbol", "timestamp"], ["symbol"])
    after = spark.read.parquet(path)
    assert after.count() == bars.count() + 1
    assert after.filter("close = -1.0").count() == 4
    assert after.filter("symbol = '1-URGENT'").count() == bars.filter("symbol = '1-URGENT'").count()

    after.write.parquet(f"{base}/compacted")
    assert spark.read.parquet(f"{base}/compacted").count() == after.count()
    io.truncate(spark, f"{base}/compacted")                                          # S25
    assert spark.read.parquet(f"{base}/compacted").count() == 0
    assert gold.read_or_none(spark, f"{base}/compacted") is None                     # S6: empty -> clean exit


def test_catalog_listing_and_counts(spark):
    io.materialize(fx.ticks(spark, SF_SMALL), "qs_test_ticks")                       # S21
    assert "qs_test_ticks" in io.list_tables(spark)                                   # S23
    assert io.row_count(spark, "qs_test_ticks") == fx.ticks(spark, SF_SMALL).count()  # S24
    assert io.run_sql(spark, "SELECT count(DISTINCT symbol) AS n FROM qs_test_ticks").first().n == 5  # S22


def test_rss_items_first_five(spark):
    items = "".join(f"<item><title>t{i}</title><link>http://x/{i}</link><pubDate>d{i}</pubDate></item>"
                    for i in range(8))
    rdf = ('<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/">'
           '<channel rdf:about="c"><title>feed</title></channel><item rdf:about="u"><title>one</title><link>l1</link></item>'
           '<item rdf:about="v"><title><![CDATA[a < b & c]]></title></item></rdf:RDF>')
    named = ('<rss version="2.0"><channel><title>all</title><item id="7"><title lang="en">odd &amp; even</title><link>l</link>'
             '<pubDate>today</pubDate></item></channel></rss>')
    feed = spark.createDataFrame([("f1", f"<rss><channel>{items}</channel></rss>"), ("f2", rdf), ("f3", named), ("f4", "no xml"),
                                  ("f5", None), ("f6", "<rss><channel><title>empty</title></channel></rss>")], "feed string, xml string")
    got = io.rss_items(feed).orderBy("feed", "pos").collect()                         # S8
    assert [r.title for r in got if r.feed == "f1"] == ["t0", "t1", "t2", "t3", "t4"] and got[0].link == "http://x/0"
    assert [tuple(r)[2:] for r in got if r.feed == "f2"] == [("one", "l1", None), ("a < b & c", None, None)]
    assert [tuple(r)[2:] for r in got if r.feed == "f3"] == [("odd & even", "l", "today")]
    assert {r.feed for r in got} == {"f1", "f2", "f3"}


def test_compaction_leaves_no_gap_and_vacuum_waits(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    bars = fx.daily_bars(spark, SF_SMALL).withColumn("year", F.year("timestamp"))
    want = sorted(map(tuple, bars.select(sorted(bars.columns)).collect()))
    first = versions.write(bars.repartition(40), base, ("symbol",))                   # 200 small files
    before = versions.files(spark, first)
    n, size = before.count(), before.agg(F.sum("bytes")).first()[0]
    assert n > 150

    def rows(df):
        return sorted(map(tuple, df.select(sorted(bars.columns)).collect()))

    with monkeypatch.context() as m:                                                   # S26: dies before the swap
        m.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            versions.compact(spark, base, ("symbol",), size // 10)
    assert versions.current(spark, base) == first and rows(versions.read(spark, base)) == want
    reader = versions.read(spark, base)                                                # begun before the swap
    second = versions.compact(spark, base, ("symbol",), size // 10, ("timestamp",))
    assert versions.current(spark, base) == second != first
    assert rows(versions.read(spark, base)) == want == rows(reader)
    sizes = [r.bytes for r in versions.files(spark, second).collect()]
    assert 5 <= len(sizes) <= 20 and max(sizes) < 2 * size // 10
    assert versions.vacuum(spark, base) == [] and rows(reader) == want
    assert len(versions.vacuum(spark, base, older_than_seconds=-5)) == 2 and rows(versions.read(spark, base)) == want


def test_bronze_stream_appends(spark):
    base = tempfile.mkdtemp(prefix="qs-bronze-")
    recs = ops.to_kafka_records(fx.ticks(spark, SF_SMALL))
    recs.write.parquet(f"{base}/in")
    src = P.file_stream(spark, f"{base}/in", recs.schema, max_files=1)                # S2 (rate cap)
    q = P.start_bronze(src, f"{base}/bronze", f"{base}/ckpt", available_now=True)     # S9
    q.awaitTermination(300)
    b = spark.read.parquet(f"{base}/bronze")
    assert b.columns == ["kafka_key", "raw_payload", "ingest_time"] and b.count() == recs.count()
