"""Ordered plans in many tiny blocks must equal those in blocks of the default size.

usage: python scripts/check_block_path.py   (reads /root/testdata/sf0.1)
"""
import sys
sys.path.insert(0, "/root/repo")
from quantsilo.session import get_spark
from quantsilo.sources import fixtures as fx
from quantsilo.operators import silver, indicators
from quantsilo.plans.queries_indicators import _live_rows
from quantsilo.plans.catalog import round_doubles
spark = get_spark("local[8]", 8, extra={"spark.driver.memory": "8g"})
sf = "/root/testdata/sf0.1"
def rows(df):
    return sorted(tuple(r) for r in round_doubles(df, 6).collect())
w = silver.window_metrics(fx.ticks(spark, sf))
base = {"anomaly": rows(silver.anomaly_flags(w)),
        "live": rows(indicators.live_indicators(_live_rows(spark, sf))),
        "history": rows(indicators.history_indicators(fx.daily_bars(spark, sf)))}
multi = {"anomaly": rows(silver.anomaly_flags(w, block_rows=500)),
         "live": rows(indicators.live_indicators(_live_rows(spark, sf), block_rows=1000)),
         "history": rows(indicators.history_indicators(fx.daily_bars(spark, sf), block_rows=800))}
for k in base:
    print(k, len(base[k]), "equal" if base[k] == multi[k] else "DIFFER")
