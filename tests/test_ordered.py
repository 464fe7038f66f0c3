"""The skew-safe helpers must equal plain per-key windows, also with tiny chunks and blocks."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from quantsilo.plans import ordered, topk


def _data(spark, n=400, keys=3, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if rnd.random() < 0.3 else round(rnd.uniform(1, 100), 2)
        rows.append((f"k{rnd.randrange(keys)}" if rnd.random() < 0.95 else None, rnd.randrange(0, 50), i, v))
    # t has many ties; (t, i) is a total order
    return spark.createDataFrame(rows, "k string, t int, i int, v double")


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


BLOCKS = [3, 9, 50, 1000]


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_arranged_rows_have_global_and_own_ordinals(spark, block_rows):
    df = _data(spark)
    got = ordered.arrange(df, ["k"], ["t", "i"], block_rows)
    g = F.row_number().over(Window.orderBy("k", "t", "i")) - 1
    want = df.withColumn("_g", g).withColumn("_blk", F.floor(F.col("_g") / block_rows))
    assert _rows(got, ["k", "i", "_g", "_blk"]) == _rows(want, ["k", "i", "_g", "_blk"])
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy("t", "i")) - 1)
    assert _rows(ordered.sequence(got), ["k", "i", "seq"]) == _rows(want, ["k", "i", "seq"])


@pytest.mark.parametrize("block_rows", [2, 5, 9, 40, 1000])
def test_rolling_equals_plain_window(spark, block_rows):
    df = ordered.arrange(_data(spark), ["k"], ["t", "i"], block_rows)

    def build(w):
        return [F.avg("v").over(w.rowsBetween(-4, 0)).alias("ma"), F.lag("v", 2).over(w).alias("lag2"),
                F.lead("v", 3).over(w).alias("lead3"), F.count("v").over(w.rowsBetween(-4, 0)).alias("n")]

    got = ordered.rolling(df, build, lookback=4, lookahead=3)          # frames that reach over blocks as well
    want = df.select("*", *build(Window.partitionBy("k").orderBy("_g")))
    cols = ["k", "i", "ma", "lag2", "lead3", "n"]
    assert _rows(got, cols) == _rows(want, cols)
    assert ordered.plan_of(got) == (block_rows, 400)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_fill_forward_and_backward(spark, block_rows):
    df = ordered.arrange(_data(spark), ["k"], ["t", "i"], block_rows)
    w = Window.partitionBy("k").orderBy("t", "i")
    want = df.select("k", "i",
                     F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v_f"),
                     F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("v_b"))
    got = ordered.fill_backward(ordered.fill_forward(df, ["v"], suffix="_f"), ["v"], suffix="_b")
    assert _rows(got, ["k", "i", "v_f", "v_b"]) == _rows(want, ["k", "i", "v_f", "v_b"])


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_running_max_and_sum(spark, block_rows):
    df = ordered.arrange(_data(spark), ["k"], ["t", "i"], block_rows)
    w = Window.partitionBy("k").orderBy("t", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "i", F.max("v").over(w).alias("m"), F.round(F.sum("v").over(w), 6).alias("s"))
    got = ordered.running(df, "v", "max", "m")
    got = ordered.running(got, "v", "sum", "s").withColumn("s", F.round("s", 6))
    assert _rows(got, ["k", "i", "m", "s"]) == _rows(want, ["k", "i", "m", "s"])


def test_scan_composes_in_order(spark):
    rows = [("a", b, 1.0 + b / 10, b * 1.0) for b in range(13)] + [("b", b, 2.0, 1.0) for b in range(3)]
    maps = spark.createDataFrame(rows, "_key string, _blk long, a double, b double")
    got = ordered.scan(maps, ["a", "b"], lambda p, q: {"a": f"{p['a']} * {q['a']}", "b": f"{q['a']} * {p['b']} + {q['b']}"}, 13)
    for key in "ab":
        x, y, want = 1.0, 0.0, []
        for k, _, a, b in rows:
            if k == key:
                x, y = x * a, a * y + b
                want.append((pytest.approx(x), pytest.approx(y)))
        assert [(r.a, r.b) for r in got.filter(F.col("_key") == key).orderBy("_blk").collect()] == want


def test_empty_input(spark):
    df = ordered.arrange(_data(spark).limit(0), ["k"], ["t", "i"])
    got = ordered.rolling(ordered.fill_forward(ordered.sequence(df), ["v"]),
                          lambda w: [F.lag("v", 1).over(w).alias("p")], lookback=1)
    assert got.count() == 0 and set(got.columns) == {"k", "t", "i", "v", "seq", "p", *ordered.HELPERS}


def test_half_of_all_rows_in_one_instant_of_one_key_is_split(spark):
    hot = spark.range(60000).select(F.lit("hot").alias("k"), F.lit(7).alias("t"), F.col("id").alias("i"), F.rand(1).alias("v"))
    rest = spark.range(60000).select(F.concat(F.lit("k"), F.col("id") % 40).alias("k"), (F.col("id") % 997).cast("int").alias("t"),
                                     (F.col("id") + 60000).alias("i"), F.rand(2).alias("v"))
    df = ordered.arrange(hot.unionByName(rest), ["k"], ["t", "i"], block_rows=250)
    got = ordered.rolling(df, lambda w: [F.avg("v").over(w.rowsBetween(-9, 0)).alias("m")], lookback=9)
    parts = got.groupBy(F.pmod(F.hash("_key", "_blk"), F.lit(53)).alias("task")).count()       # as the shuffle deals them
    sizes = sorted(r["count"] for r in parts.collect())
    assert len(sizes) == 53 and sizes[-1] <= 2.5 * sizes[26]
    per_block = [r["count"] for r in got.groupBy("_blk").count().collect()]
    assert max(per_block) == 250 and len(per_block) == 480


def test_top_k_per_key_is_exact(spark):
    df = _data(spark, n=600, keys=2)
    got = topk.top_k_per_key(df, ["k"], ["t", "i"], 10, salts=8)
    w = Window.partitionBy("k").orderBy("t", "i")
    want = df.withColumn("r", F.row_number().over(w)).filter("r <= 10")
    assert _rows(got, ["k", "i"]) == _rows(want, ["k", "i"])
