"""Hand-made series for edge rules, parameter strings, catalogue and storage."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.windows import ffd_weights
from tidemark.operators import align, events, features, registry, targets
from tidemark.sources import bars as B
from tidemark.sources import sinks

T0 = datetime(2024, 1, 2)


def series(spark, closes, opens=None, volume=None):
    rows = [("A", T0 + timedelta(minutes=i), (opens or closes)[i], c, c, c, (volume or [1.0] * len(closes))[i]) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double")


def column(df, name):
    return [r[name] for r in df.orderBy("timestamp").select(name).collect()]


def test_constant_price(spark):
    last = features.indicators(series(spark, [5.0] * 25)).orderBy(F.desc("timestamp")).first()
    assert last.rsi == 100 and last.close_zscore == 0 and last.close_minmax is None and last.autocorr_lag1 is None


def test_short_series_is_null(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0, 5.0])
    assert column(features.volatility(df, (5,)), "volatility_5") == [None] * 5
    assert column(features.market_regime(df, (8,)), "volatility_regime_8") == [0.0] * 5


def test_missing_prices_carry(spark):
    closes = [None, 2.0, 3.0, None, 3.0, 1.0]
    assert column(features.on_balance_volume(series(spark, closes)), "obv") == [1.0, 1.0, 2.0, 2.0, 2.0, 1.0]
    e = column(features.ema(series(spark, closes), (3,)), "ema_3")
    assert e[3] == e[2] == 2.5


def test_targets_touch_and_tail(spark):
    df = series(spark, [100.0, 120.0, 90.0, 100.0, 100.0, 100.0], opens=[100.0, 100.0, 118.0, 100.0, 100.0, 100.0])
    out = targets.targets(df, [(3, 0.2, 0.1)], "double").orderBy("timestamp").collect()
    name, ret, score = targets.target_names("long", 0.2, 0.1, 3)
    assert out[0][name] == 1 and out[0][ret] == pytest.approx(0.18) and out[0][score] == pytest.approx(0.9)
    assert out[1][name] == -1
    assert out[-1][name] == 0 and out[-1][ret] is None


def test_event_filters(spark):
    df = series(spark, [100.0, 103.0, 106.0, 100.0, 100.0])
    assert [r.breakout_side for r in events.cumsum_events(df, 0.05).orderBy("timestamp").collect()] == [1, -1]
    got = events.reversal_events(df, 0.02, 0.01).collect()
    assert len(got) == 1 and got[0].breakout_side == 1 and got[0].s_extreme > got[0].s_final


def test_dollar_bars_reset(spark):
    rows = [("A", T0, T0 + timedelta(seconds=s), 100.0, v) for s, v in ((1, 60.0), (2, 150.0), (3, 210.0), (4, 420.0))]
    got = events.dollar_bars(spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, close double, volume double")).collect()
    assert [r.dollar_volume for r in got] == [21000.0, 21000.0]


def test_sequences_by_rows_and_by_time(spark):
    df = series(spark, [1.0, 2.0, 3.0, 4.0]).where("close <> 2")
    f = df.select("timestamp", "symbol", "close")
    assert column(align.sequence_rows(f, 3), "close") == [[1.0, 3.0, 4.0]]
    assert align.sequence_at_events(f, f, 3).count() == 0
    assert column(align.sequence_at_events(f, f, 2), "close") == [[3.0, 4.0]]


def test_latest_update_and_grid(spark):
    rows = [("A", T0, None, 1.0, 1), ("A", T0, T0, 2.0, 1), ("A", T0, T0, 3.0, 2)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, close double, timestamp_seconds long")
    assert [r.close for r in B.raw_to_bars(df).collect()] == [3.0]
    up = B.upsample(series(spark, [1.0, None, 3.0]), "30 seconds", ["close"])
    assert column(up, "close") == [1.0, 1.0, 1.0, 1.0, 3.0]


def test_weights_and_parameters():
    assert len(ffd_weights()) == 55
    params = {"periods": [5, 15], "price": "close", "d": 0.4, "log": True}
    assert registry.from_text(registry.to_text(params)) == params
    with pytest.raises(ValueError):
        registry.from_text("close,0.07")
    assert registry.features_of(["return_5", "ema_rel_15", "return_1"]) == {"returns": {"periods": (1, 5)}, "ema": {"periods": (15,)}}
    assert "btc_features" not in registry.list_features("stock")
    sets = {"b": {"features": ["x", "y"], "k": 1}, "a": {"features": ["x", "y", "z"], "k": 1}, "c": {"features": ["x"], "k": 2}}
    assert registry.smallest_superset(sets, ["x"], k=1) == "b"
    assert len(registry.dataset_id({"a": 1})) == 12


def test_day_tables(spark, tmp_path):
    at = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(datetime(2024, 3, 10, h) + timedelta(days=d), float(d)) for d in range(3) for h in (3, 12)], "timestamp timestamp_ntz, v double")
    sinks.write_days(df, at)
    sinks.write_days(df.where("v = 1").withColumn("v", F.lit(9.0)), at, overwrite=False)
    assert spark.read.parquet(at).count() == 6
    assert sinks.read_days(spark, at, "2024-03-10", "2024-03-12", ["v", "nothing"]).columns == ["v"]
    have = spark.read.parquet(at).select("date")
    assert [str(r.date) for r in sinks.missing_days(have, "2024-03-08", "2024-03-12").orderBy("date").collect()] == ["2024-03-08"]
