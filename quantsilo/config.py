"""Thresholds and constants.

Fixed values that must equal the reference's for equal results are listed
together here, in natural order, as plain text.  The reference disagrees with
itself on several thresholds; each such value is a parameter with the default
the survey picked, and the operators take an override argument.
"""

# --- fixed values (reference semantics) -----------------------------------
# silver sliding window: 10 s long, 5 s slide, 1 minute watermark
SILVER_WINDOW = "10 seconds"
SILVER_SLIDE = "5 seconds"
SILVER_WATERMARK = "1 minute"
SILVER_TRIGGER = "5 seconds"

# liquidation bands: leverage -> fraction of price
LIQ_BANDS = ((10, 0.10), (25, 0.04), (50, 0.02), (100, 0.01))

# anomaly detector: history of 30 windows, at least 6 needed, z > 3
ANOMALY_HISTORY = 30
ANOMALY_MIN_ROWS = 6
ANOMALY_Z = 3.0
ANOMALY_EPS = 1e-5
SPOOF_VOLUME_FRACTION = 0.5

# backtests: 5 minute buckets, 6 buckets ahead
BACKTEST_BUCKET = "5 minutes"
BACKTEST_LEAD = 6
BACKTEST_DAYS = 7
CVD_BULLISH_MIN = 100000.0
VPIN_TOXIC_MIN = 0.80

# arbitrage signal (percent), bot tier (percent)
ARBITRAGE_SIGNAL_PCT = 0.05
ARBITRAGE_HIGH_TIER_PCT = 0.5

# whale wall ratio, funding classes, flow tags
WHALE_WALL_RATIO = 2.5
FUNDING_HIGH = 0.001
FUNDING_LOW = -0.0005
FLOW_WHALE_CVD = 1_000_000.0
FLOW_RETAIL_CVD = 100_000.0
FLOW_BULL_IMB = 0.6
FLOW_BEAR_IMB = 0.4

# dashboard signals
RSI_OVERBOUGHT = 70.0
RSI_OVERSOLD = 30.0
VPIN_FLOW_RISK = 0.75
LARGE_TRADE_USD = 5000.0

# indicator spans
RSI_PERIOD = 14
BOLLINGER_PERIOD = 20
BOLLINGER_K = 2.0
EMA_FAST = 12
EMA_SLOW = 26
EMA_SIGNAL = 9
MA_PERIODS = (7, 25, 99)
FEATURE_MA_PERIODS = (5, 10)

# quotas: requests per second by tier, free daily cap, login and registration guards
QUOTA_PER_SECOND = (("VIP", 50), ("PREMIUM", 10))
FREE_DAILY_CAP = 1000
EXPORT_HOURS = (("PREMIUM", 12), ("VIP", 24))
LOGIN_MAX_FAILURES = 5
LOGIN_LOCK_SECONDS = 900
REGISTRATION_MAX_PER_IP = 3
REGISTRATION_WINDOW_SECONDS = 3600

# alarms: per-user cap, time to live
MAX_ALARMS_PER_USER = 10
ALARM_TTL_DAYS = 30
ALARM_UP_WORDS = ("üst", "ust", "üstü", "up", "yukari", "yukarı")
ALARM_DOWN_WORDS = ("alt", "down", "aşağı", "asagi")

# model training
MIN_ROWS_PER_SYMBOL = 20
TRAIN_FRACTION = 0.8
RMSE_MISSING = 9999.0
R2_BADGE = 0.95

# sentiment clamp
SENTIMENT_MIN = 5.0
SENTIMENT_MAX = 95.0

# header cleanup transliteration (Turkish letters -> ASCII), as pairs
TRANSLIT_PAIRS = (("ı", "i"), ("ğ", "g"), ("ü", "u"), ("ş", "s"), ("ö", "o"), ("ç", "c"),
                  ("İ", "I"), ("Ğ", "G"), ("Ü", "U"), ("Ş", "S"), ("Ö", "O"), ("Ç", "C"))
TRANSLIT_FROM = "".join(a for a, _ in TRANSLIT_PAIRS)
TRANSLIT_TO = "".join(b for _, b in TRANSLIT_PAIRS)

# 24 h change rating (percent): > 3 strong buy, > 0 buy, < -3 strong sell, < 0 sell, else neutral
CHANGE_STRONG = 3.0
