"""Raw layer, feature labels, defaults and layers at events; day limits of event filters."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.functions.windows import ffd_weights
from tidemark.operators import align, events, features, labels, registry, targets
from tidemark.plans import layers
from tidemark.sources import raw, sinks

BARS = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume double"


def series(spark, start, closes, step=timedelta(hours=1)):
    return spark.createDataFrame([("A", start + i * step, c, c, c, c, 1.0) for i, c in enumerate(closes)], BARS)


def updates(spark, hours=72):
    rows = [("A", datetime(2024, 3, 9) + timedelta(hours=h), 100.0 + h + k, datetime(2024, 3, 9) + timedelta(hours=h, seconds=k) if k else None, k) for h in range(hours) for k in (0, 1)]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double, ingestion_timestamp timestamp_ntz, timestamp_seconds long")


@pytest.mark.parametrize(("start", "midnight"), [(datetime(2024, 3, 9), 5), (datetime(2024, 3, 11), 4)], ids=["winter", "summer"])
def test_event_days_begin_at_midnight_in_new_york(spark, start, midnight):
    """A rise of 3 % an hour from 22 to 8 UTC: the sum of a 10 % threshold starts again at New York's midnight, whose first bar has no change."""
    first = start + timedelta(hours=22)
    closes = [100 * 1.03**i for i in range(11)]
    got = [r.timestamp for r in events.cumsum_events(series(spark, first, closes), 0.1).orderBy("timestamp").collect()]
    want, total = [], 0.0
    for i in range(1, 11):
        at = first + timedelta(hours=i)
        if at.hour == midnight:
            total = 0.0
            continue
        total += 0.03
        if total > 0.1:
            want.append(at)
            total = 0.0
    assert got == want and want


def test_missing_prices_are_no_change(spark):
    df = series(spark, datetime(2024, 1, 2, 12), [100.0, 104.0, None, 108.16, 108.16])
    assert [r.timestamp.hour for r in events.cumsum_events(df, 0.07).collect()] == [15]
    got = targets.targets(df, [(1, 0.5, 0.5)], "double").orderBy("timestamp").collect()
    assert [r.label_forward_return_1m for r in got] == pytest.approx([0.04, 0.0, 0.04, 0.0, None])


def test_array_differencing_equals_the_weighted_sum(spark):
    x = np.random.default_rng(1).normal(100, 1, 90)
    x[60] = np.nan
    df = series(spark, datetime(2024, 1, 2), [None if np.isnan(v) else float(v) for v in x])
    got = [r[0] for r in df.select(features.ffd(F.col("close")).alias("f"), "timestamp").orderBy("timestamp").collect()]
    w = np.array(ffd_weights())[::-1]
    for i, v in enumerate(got):
        frame = x[max(0, i - len(w)) : i]
        assert v is None if len(frame) < len(w) or np.isnan(frame).any() else v == pytest.approx(frame @ w)


def test_bar_ends_equal_one_by_one():
    values = np.random.default_rng(2).exponential(10, 5000)
    at, sums, total = events.bar_ends(values[:1700], 700.0)
    more, rest, total = events.bar_ends(values[1700:], 700.0, total)
    want, now = [], 0.0
    for i, v in enumerate(values):
        now += v
        if now >= 700.0:
            want.append((i, now))
            now = 0.0
    assert list(zip(at + [1700 + i for i in more], sums + rest, strict=True)) == want and total == now


def test_wide_equals_joins(spark):
    df = series(spark, datetime(2024, 1, 2), [100.0 + (i * 7) % 11 for i in range(60)])
    got = align.wide(df, {"returns": {"periods": (1,)}, "ema": {"periods": (5,)}, "volatility": {"windows": (5,)}}, [(3, 0.02, 0.02)])
    want = align.full_join([features.returns(df, (1,)), features.volatility(df, (5,)), targets.targets(df, [(3, 0.02, 0.02)]), features.ema(df, (5,))])
    key = sorted(want.columns)
    assert sorted(got.columns) == key and got.select(key).orderBy("timestamp").collect() == want.select(key).orderBy("timestamp").collect()
    plan = align.wide(df, {"returns": {"periods": (1,)}, "volatility": {"windows": (5,)}}, [(3, 0.02, 0.02)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_time_ranges():
    assert raw.time_range("2024-01-02", "2024-01-03T05:00:00+01:00") == (datetime(2024, 1, 2), datetime(2024, 1, 3, 4))
    assert raw.time_range(0, 86400) == (datetime(1970, 1, 1), datetime(1970, 1, 2))
    assert raw.iso_text(datetime(2024, 1, 2, 3)) == "2024-01-02T03:00:00+0000"
    for bad in ((0, "2024-01-01"), ("2024-01-02", "2024-01-02"), (None, "2024-01-02")):
        with pytest.raises(ValueError):
            raw.time_range(*bad)
    days = raw.split_days(date(2024, 1, 1), date(2024, 1, 6), 2, 1)
    assert days == [(date(2023, 12, 31), date(2024, 1, 3)), (date(2024, 1, 2), date(2024, 1, 5)), (date(2024, 1, 4), date(2024, 1, 6))]


def test_read_through_asks_for_missing_days_only(spark, tmp_path):
    path, asked = f"file://{tmp_path}/bars", []

    def source(a, b):
        asked.append((a, b))
        return raw.fetch(updates(spark), "candle", "take_latest", "2024-03-09", "2024-03-12")

    got = raw.read_through(spark, source, path, "2024-03-10", "2024-03-11", ["timestamp", "symbol", "close", "nothing"])
    assert asked == [("2024-03-10", "2024-03-11")] and got.columns == ["timestamp", "symbol", "close"]
    assert got.count() == 23  # the day the clocks go forward
    raw.read_through(spark, source, path, "2024-03-09", "2024-03-12")
    assert asked[1:] == [("2024-03-09", "2024-03-10"), ("2024-03-11", "2024-03-12")]
    grid = raw.read_through(spark, source, path, "2024-03-10", "2024-03-11", ["timestamp", "symbol", "close"], "30 minutes")
    assert len(asked) == 3 and grid.count() == 45
    one = raw.summary(got).first()
    assert (one.n_rows, one.n_columns, one.n_symbols, one.first_time) == (23, 3, 1, datetime(2024, 3, 10, 5))


def test_fetch_modes(spark):
    rows = updates(spark, 2)
    price = lambda mode: [r.close for r in raw.fetch(rows, "candle", mode, "2024-03-09", "2024-03-10").orderBy("timestamp").collect()]
    assert price("take_latest") == [101.0, 102.0] and price("collect_all_updates") == [100.0, 101.0]
    with pytest.raises(ValueError):
        raw.fetch(rows, "candle", "by_update", "2024-03-09", "2024-03-10")
    rows.createOrReplaceTempView("raw_updates")
    got = raw.query(spark, "select timestamp as t, symbol, close from raw_updates", "t")
    assert got.count() == 2 and got.first().date == date(2024, 3, 8)


def test_labels_and_store(spark, tmp_path):
    made = labels.Collection.from_str("returns@periods:[1,5],log:True ema@ volatility@windows:[5]")
    assert str(labels.Collection.from_str(str(made))) == str(made)
    assert labels.Collection.from_dict(made.to_dict()).features() == made.features() == {"returns": {"periods": (1, 5), "log": True}, "ema": {}, "volatility": {"windows": (5,)}}
    assert made.labels[0].params["price"] == "close" and len(made.subsets()) == 7 and made.tag() == "returns__ema__volatility"
    for bad in ("nothing@", "returns@period:5"):
        with pytest.raises(ValueError):
            labels.FeatureLabel.from_str(bad)
    store = labels.CollectionStore(spark, f"file://{tmp_path}")
    assert store.tags() == []
    store.save(made, "mine")
    assert store.tags() == ["mine"] and str(store.load("mine")) == str(made)
    store.delete("mine")
    assert not store.exists("mine")
    with pytest.raises(FileNotFoundError):
        store.load("mine")


def test_defaults_and_grammar(spark):
    assert len(registry.event_defaults("cumsum", "stock")) == 5 and registry.event_defaults("reversal", "forex") == [{"threshold": 0.0025, "reversal": 0.005}]
    assert registry.event_params("reversal", "threshold:0.1,reversal:0.02") == {"threshold": 0.1, "reversal": 0.02}
    for bad in ("threshold:0.1", "threshold:-1,reversal:0.1", "threshold:0.1,reversal:0.1,x:1"):
        with pytest.raises(ValueError):
            registry.event_params("reversal", bad)
    assert len(registry.target_specs()) == 9 and len(registry.target_specs("fp:5,10|tp:0.1")) == 6
    specs = registry.target_specs("fp:5,10|tp:0.1|sl:0.2,0.3")
    assert registry.target_specs(registry.specs_to_text(specs)) == specs
    with pytest.raises(ValueError):
        registry.specs_to_text(registry.target_specs())
    assert registry.columns_of("returns", {"periods": (2,)}, series(spark, datetime(2024, 1, 2), [1.0])) == ["return_2"]


def test_layers_at_events_and_command_line(spark, tmp_path):
    bars, root = f"file://{tmp_path}/bars", f"file://{tmp_path}/store"
    df = series(spark, datetime(2024, 1, 2, 5), [100.0 * (1.04 if i % 5 == 4 else 0.999) ** (i % 7) for i in range(96)])
    sinks.write_days(df, bars)
    at = ("cumsum", {"threshold": 0.05})
    path = layers.cache_feature_at_events(spark, bars, root, at, "returns", {"periods": (1,)}, "2024-01-02", "2024-01-05")
    got = sorted(map(tuple, spark.read.parquet(path).select("timestamp", "symbol", "return_1").collect()))
    inside = df.where("timestamp < '2024-01-05 05:00:00'")
    want = align.at_events(events.cumsum_events(inside, 0.05), features.returns(df, (1,)))
    assert got == sorted(map(tuple, want.select("timestamp", "symbol", "return_1").collect())) and got
    assert layers.missing(spark, bars, path, "2024-01-02", "2024-01-06") == [date(2024, 1, 5)]
    path = layers.cache_targets_at_events(spark, bars, root, at, [(2, 0.1, 0.1)], "2024-01-02", "2024-01-05")
    assert spark.read.parquet(path).count() == len(got)
    src, out = f"file://{tmp_path}/updates", f"file://{tmp_path}/raw"
    updates(spark).write.parquet(src)
    args = ["--source", src, "--raw", out, "--since", "2024-03-10", "--until", "2024-03-12"]
    assert main(["raw", "check", *args], spark) == ["raw 2024-03-10", "raw 2024-03-11"]
    main(["raw", "cache", *args], spark)
    assert main(["raw", "list", *args], spark) == ["2024-03-10", "2024-03-11"] and main(["raw", "check", *args], spark) == []
    said = main(["resampled", "cache", "--raw", bars, "--root", root, "--since", "2024-01-02", "--until", "2024-01-04", "--label", "returns", "--params", "periods:[1]", "--events", "cumsum@threshold:0.05", "--targets", "fp:2|tp:0.1|sl:0.1"], spark)
    assert len(said) == 2
