"""Feature operators: hand-computed rows, invariants, chunked == plain."""

import math

import pytest
from pyspark.sql import functions as F

from barsmith.operators import features as feat
from barsmith.plans import job
from barsmith.plans.series import Series
from conftest import make_bars, random_walk


def _rows(df, *cols):
    return [tuple(r) for r in df.orderBy("ticker", "date").select(*cols).collect()]


def test_sma_partial_frames_never_null(spark):
    bars = make_bars(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    out = feat.add_moving_averages(bars)
    got = _rows(out, "sma_5", "sma_200")
    assert got[0] == (1.0, 1.0)                  # one-row frame
    assert got[4][0] == pytest.approx(3.0)       # mean of 1..5
    assert got[5][0] == pytest.approx(4.0)       # mean of 2..6 (5-row frame slides)
    assert got[5][1] == pytest.approx(3.5)       # partial 200-row frame
    assert all(r[1] is not None for r in got)


def test_ema_is_simple_mean(spark):
    bars = make_bars(spark, [float(i) for i in range(1, 31)])
    out = _rows(feat.add_ema(bars), "ema_12", "ema_26")
    assert out[-1][0] == pytest.approx(sum(range(19, 31)) / 12)
    assert out[-1][1] == pytest.approx(sum(range(5, 31)) / 26)


def test_bollinger_first_row_null_std(spark):
    bars = make_bars(spark, [10.0, 12.0, 14.0])
    out = _rows(feat.add_bollinger_bands(bars), "bb_std", "bb_upper", "bb_pct_b", "bb_mid")
    assert out[0][0] is None and out[0][1] is None and out[0][2] is None
    std = math.sqrt(((10 - 11) ** 2 + (12 - 11) ** 2) / 1)
    assert out[1][0] == pytest.approx(std)
    assert out[1][1] == pytest.approx(11 + 2 * std)
    assert out[2][3] == pytest.approx(12.0)


def test_rsi_first_row_and_rising_are_100(spark):
    bars = make_bars(spark, [float(x) for x in range(100, 150)])
    out = _rows(feat.add_rsi(bars), "rsi")
    assert out[0][0] == 100.0                    # lag null -> gain = loss = 0 -> 100
    assert all(r[0] == 100.0 for r in out)       # never a loss


def test_rsi_hand_value_and_bounds(spark):
    closes = [10.0, 11.0, 10.5, 11.5]
    out = _rows(feat.add_rsi(make_bars(spark, closes)), "rsi")
    gains, losses = [0.0, 1.0, 0.0, 1.0], [0.0, 0.0, 0.5, 0.0]
    ag, al = sum(gains) / 4, sum(losses) / 4
    assert out[3][0] == pytest.approx(100 - 100 / (1 + ag / (al + 1e-10)))
    walk = feat.add_rsi(make_bars(spark, random_walk(300)))
    lo, hi = walk.agg(F.min("rsi"), F.max("rsi")).first()
    assert 0 <= lo and hi <= 100


def test_macd(spark):
    bars = make_bars(spark, [float(i) for i in range(1, 41)])
    out = feat.add_macd(bars)
    r = out.orderBy(F.col("date").desc()).first()
    assert r["macd_line"] == pytest.approx(r["ema_12"] - r["ema_26"])
    assert r["macd_hist"] == pytest.approx(r["macd_line"] - r["macd_signal"])


def test_log_return_and_volatility(spark):
    closes = [100.0, 110.0, 99.0, 99.0]
    out = _rows(feat.add_volatility(make_bars(spark, closes)), "log_return", "vol_5d",
                "annualized_vol_5d")
    assert out[0][0] is None                     # no previous close
    assert out[1][0] == pytest.approx(math.log(110 / (100 + 1e-10)))
    assert out[0][1] is None and out[1][1] is None  # vol null on rows 1-2
    assert out[2][1] is not None
    assert out[3][2] == pytest.approx(out[3][1] * math.sqrt(252))
    walk = feat.add_volatility(make_bars(spark, random_walk(200)))
    assert walk.agg(F.max(F.abs("log_return"))).first()[0] < 0.5
    vol = walk.agg(F.stddev_samp("log_return")).first()[0] * math.sqrt(252)
    assert 0 < vol < 5.0


def test_atr_first_row_is_high_minus_low_and_mixes_raw_and_adjusted(spark):
    bars = make_bars(spark, [10.0, 20.0], highs=[12.0, 21.0], lows=[9.0, 19.0])
    out = _rows(feat.add_atr(bars), "atr_14")
    assert out[0][0] == pytest.approx(3.0)       # greatest() skips the null terms
    tr2 = max(21 - 19, abs(21 - 10), abs(19 - 10))
    assert out[1][0] == pytest.approx((3.0 + tr2) / 2)
    adj = make_bars(spark, [10.0, 20.0], highs=[12.0, 21.0], lows=[9.0, 19.0]) \
        .withColumn("high", F.col("high") * 2)
    raw = _rows(feat.add_atr(adj), "atr_14")[0][0]
    adjusted = _rows(feat.add_atr(adj, adjusted=True), "atr_14")[0][0]
    assert raw == pytest.approx(15.0) and adjusted == pytest.approx(3.0)


def test_obv_running_sum(spark):
    bars = make_bars(spark, [10.0, 11.0, 10.0, 10.0, 12.0], volumes=[5, 7, 3, 4, 6])
    assert [r[0] for r in _rows(feat.add_obv(bars), "obv")] == [0, 7, 4, 4, 10]


def test_volume_zscore(spark):
    bars = make_bars(spark, [1.0, 1.0, 1.0], volumes=[10, 20, 30])
    out = _rows(feat.add_volume_zscore(bars), "vol_sma_20", "vol_std_20", "vol_zscore")
    assert out[0][1] is None and out[0][2] is None
    assert out[2][0] == pytest.approx(20.0)
    assert out[2][2] == pytest.approx((30 - 20) / (10 + 1e-10))


def test_range_golden_cross_momentum(spark):
    rising = [float(x) for x in range(1, 251)]
    out = feat.add_momentum(feat.add_golden_cross(feat.add_range_52w(make_bars(spark, rising))))
    last = out.orderBy(F.col("date").desc()).first()
    assert last["golden_cross"] == 1             # rising: sma_50 above sma_200
    assert last["sma_50"] > last["sma_200"]
    assert last["pct_from_52w_high"] == pytest.approx(0.0)
    assert last["pct_from_52w_low"] == pytest.approx((250 - 1) / (1 + 1e-10))
    assert last["momentum_20d"] == pytest.approx((250 - 230) / (230 + 1e-10))
    first = _rows(out, "momentum_20d", "golden_cross")[0]
    assert first == (None, 0)                    # null lag; equal SMAs -> 0


def test_build_features_equals_composed_operators(spark):
    bars = make_bars(spark, random_walk(320, seed=7)).unionByName(
        make_bars(spark, random_walk(280, seed=8), ticker="OTHER"))
    s = Series.plain()
    composed = bars
    for fn in (feat.add_moving_averages, feat.add_ema, feat.add_bollinger_bands, feat.add_rsi,
               feat.add_macd, feat.add_volatility, feat.add_atr, feat.add_obv,
               feat.add_volume_zscore, feat.add_range_52w, feat.add_golden_cross,
               feat.add_momentum):
        composed = fn(composed, s)
    built = feat.build_features(bars, s)
    cols = sorted(set(built.columns) - {"date", "ticker", "ingested_at"})
    a = {(r["ticker"], r["date"]): r for r in composed.collect()}
    for r in built.collect():
        o = a[(r["ticker"], r["date"])]
        for c in cols:
            assert (r[c] is None and o[c] is None) or r[c] == pytest.approx(o[c], rel=1e-12), c


@pytest.mark.parametrize("chunk_rows", [260, 400])
def test_chunked_plan_equals_plain_window(spark, chunk_rows):
    """Series cut into chunks (with halo copies) give the per-ticker window's values,
    including the running OBV across chunk borders."""
    bars = make_bars(spark, random_walk(900, seed=3)).unionByName(
        make_bars(spark, random_walk(50, seed=4), ticker="SHORT"))
    chunked = job.features(bars, run_date="r", processed_at="p", chunk_rows=chunk_rows)
    plain = job.features_plain(bars, run_date="r", processed_at="p")
    assert chunked.count() == plain.count() == 950
    assert chunked.exceptAll(plain).count() == 0
    assert plain.exceptAll(chunked).count() == 0


def test_duplicates_keep_latest_ingest(spark):
    a = make_bars(spark, [1.0, 2.0, 3.0], ingested_at="2024-01-01T00:00:00")
    b = make_bars(spark, [1.0, 5.0, 3.0], ingested_at="2024-01-02T00:00:00").filter(
        F.col("adj_close") == 5.0)
    out = job.features(a.unionByName(b), run_date="r", processed_at="p")
    assert out.count() == 3
    assert [r[0] for r in _rows(out, "adj_close")] == [1.0, 5.0, 3.0]


def test_null_dates_dropped_and_bad_divisions_are_null(spark):
    bars = make_bars(spark, [0.0, -1.0, 2.0])
    out = _rows(job.features(bars, run_date="r", processed_at="p"), "log_return", "rsi")
    assert out[1][0] is None                     # log of a negative ratio
    assert all(r[1] is not None for r in out)


def test_metadata(spark):
    bars = make_bars(spark, [1.0])
    r = feat.add_metadata(bars, "20240101", "2024-01-02T00:00:00").first()
    assert (r["pipeline_run"], r["processed_at"], r["year"], r["month"]) == \
        ("20240101", "2024-01-02T00:00:00", 2023, 1)
    assert r["date_ts"] == r["date"]


def test_min_periods_nulls_until_frame_is_full(spark):
    bars = make_bars(spark, [float(i) for i in range(1, 31)])
    s = Series.plain(min_periods=True)
    out = _rows(feat.add_moving_averages(bars, s), "sma_5", "sma_20", "sma_200")
    assert out[3][0] is None and out[4][0] == pytest.approx(3.0)
    assert out[18][1] is None and out[19][1] == pytest.approx(10.5)
    assert all(r[2] is None for r in out)
    default = _rows(feat.add_moving_averages(bars), "sma_5")
    assert default[0][0] == 1.0                   # default unchanged: partial frames


def test_min_periods_count_values_as_pandas_does(spark):
    import pandas as pd

    walk = random_walk(60, seed=4)
    got = job.features(make_bars(spark, walk), run_date="r", processed_at="p", min_periods=True).orderBy("date").toPandas()
    close = pd.Series(walk)
    line = close.rolling(12).mean() - close.rolling(26).mean()
    want = {"macd_signal": line.rolling(9).mean(), "vol_5d": got["log_return"].astype(float).rolling(5).std()}
    for c, w in want.items():
        assert got[c].isna().tolist() == w.isna().tolist(), c
        assert got[c].dropna().tolist() == pytest.approx(w.dropna().tolist()), c


def test_min_periods_chunked_equals_plain(spark):
    bars = make_bars(spark, random_walk(700, seed=11))
    a = job.features(bars, run_date="r", processed_at="p", chunk_rows=300, min_periods=True)
    b = job.features_plain(bars, run_date="r", processed_at="p", min_periods=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.filter(F.col("sma_200").isNull()).count() == 199


def test_intraday_timestamp_series_chunked_equals_plain(spark):
    """Minute bars over several days: the order column is a timestamp, buckets are
    days, and chunks cut through days; results equal the plain window."""
    import datetime as dt

    closes = random_walk(1500, seed=21)
    t0 = dt.datetime(2024, 3, 1, 9, 30)
    rows = [(t0 + dt.timedelta(minutes=i), "X", c, c * 1.001, c * 0.999, c, 100 + i,
             c, c * 1.001, c * 0.999, c, 100 + i, "2024-03-10T00:00:00")
            for i, c in enumerate(closes)]
    bars = spark.createDataFrame(rows, (
        "ts timestamp, ticker string, open double, high double, low double, close double, "
        "volume long, adj_open double, adj_high double, adj_low double, adj_close double, "
        "adj_volume long, ingested_at string"))
    chunked = job.features(bars, run_date="r", processed_at="p", order="ts", chunk_rows=400)
    plain = feat.add_metadata(feat.build_features(bars, Series.plain("ticker", "ts")),
                              "r", "p", order="ts")
    cols = [c for c in chunked.columns if c != "date"]
    assert chunked.count() == 1500
    a = chunked.select(*cols)
    b = plain.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert {r[0] for r in chunked.select("date_ts").distinct().collect()} == \
        {dt.date(2024, 3, 1), dt.date(2024, 3, 2)}


def test_single_bar_and_empty_input(spark):
    one = job.features(make_bars(spark, [5.0]), run_date="r", processed_at="p").collect()
    assert len(one) == 1
    r = one[0]
    assert (r["sma_200"], r["rsi"], r["obv"], r["golden_cross"]) == (5.0, 100.0, 0, 0)
    assert r["bb_std"] is None and r["log_return"] is None and r["momentum_20d"] is None
    assert r["atr_14"] == pytest.approx(5.0 * 1.01 - 5.0 * 0.99)
    empty = make_bars(spark, [1.0]).limit(0)
    assert job.features(empty, run_date="r", processed_at="p").count() == 0
