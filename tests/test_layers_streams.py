"""Layers by day, manifests, the command line, the REST source, and streams held against their batch forms."""

import json
import threading
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.operators import events, registry
from tidemark.plans import layers
from tidemark.sources import bars as B
from tidemark.sources import rest, sinks
from tidemark.streaming.bars import stream_bars, stream_latest
from tidemark.streaming.events import stream_cumsum_events, stream_reversal_events

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bars(spark):
    return B.event_bars(spark.read.parquet(f"{SF}/events.parquet"))


@pytest.fixture(scope="module")
def raw(spark, bars, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('raw')}/bars"
    sinks.write_days(bars, at)
    return at


SPEC = {"events": ("cumsum", {"threshold": 0.5}), "targets": [(3, 0.9, 0.9)], "sequence": 0, "columns": ["close"], "features": {"returns": {"periods": (1, 5)}, "volatility": {"windows": (5,)}}}


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_feature_days_equal_the_whole_series(spark, bars, raw, tmp_path):
    root = f"file://{tmp_path}"
    for label, params in (("returns", {"periods": (1, 5)}), ("volatility", {"windows": (5,)}), ("ema", {"periods": (5,)})):
        layers.cache_feature(spark, raw, root, label, params, "2024-01-10", "2024-01-12", bars_per_day=1)
        path = layers.cache_feature(spark, raw, root, label, params, "2024-01-08", "2024-01-14", bars_per_day=1)
        whole = sinks.with_day(registry.FEATURES[label](bars, **params)).where("date >= '2024-01-08' and date < '2024-01-14'")
        assert rows(spark.read.parquet(path)) == rows(whole)
        assert layers.missing(spark, raw, path, "2024-01-08", "2024-01-14") == []


def test_default_reach_counts_bars(spark, bars, raw, tmp_path):
    """Hourly bars, far fewer than 390 a day: warm-up and look-ahead by default equal the whole series."""
    root, since, until = f"file://{tmp_path}", "2024-01-12", "2024-01-13"
    inside = f"date >= '{since}' and date < '{until}'"
    path = layers.cache_feature(spark, raw, root, "volatility", {"windows": (60,)}, since, until)
    assert rows(spark.read.parquet(path)) == rows(sinks.with_day(registry.FEATURES["volatility"](bars, windows=(60,))).where(inside))
    path = layers.cache_targets(spark, raw, root, [(100, 0.9, 0.9)], since, until)
    assert rows(spark.read.parquet(path)) == rows(sinks.with_day(layers.targets(bars, [(100, 0.9, 0.9)])).where(inside))


def test_warmup_covers_defaults():
    assert layers.warmup_bars("ffd_volatility_zscore", {"vol_window": 10}) >= 100 + 10 + 55
    assert layers.warmup_bars("returns", {"periods": (1, 5)}) == 6 and layers.warmup_bars("time_of_day", {}) == 0


def test_dataset_and_superset_lookup(spark, raw, tmp_path):
    root = f"file://{tmp_path}"
    layers.cache_dataset(spark, raw, root, SPEC, "2024-01-05", "2024-01-12", bars_per_day=1)
    asked = SPEC | {"features": {"returns": {"periods": (1, 5)}}}
    got = layers.load_dataset(spark, root, asked, "2024-01-05", "2024-01-12", ["return_5"])
    assert got.columns[:3] == ["timestamp", "symbol", "return_5"] and "close" in got.columns and got.count() > 0
    with pytest.raises(LookupError):
        layers.load_dataset(spark, root, asked | {"targets": [(4, 0.9, 0.9)]}, "2024-01-05", "2024-01-12")


def test_manifest_round_trip():
    for spec in (SPEC, SPEC | {"sequence": 60, "columns": [], "features": {}}):
        assert layers.parse_manifest(layers.manifest_text(spec)) == spec
    with pytest.raises(ValueError):
        layers.parse_manifest("Dataset\n=======\n\nx: y")


def test_command_line(spark, raw, tmp_path):
    root = f"file://{tmp_path}"
    assert "returns" in main(["feature", "list", "--security", "stock"])
    args = ["--raw", raw, "--root", root, "--since", "2024-01-05", "--until", "2024-01-07", "--label", "returns", "--params", "periods:[1,5]"]
    assert len(main(["feature", "check", *args], spark)) == 2
    main(["feature", "cache", *args], spark)
    assert main(["feature", "check", *args], spark) == []


def test_rest_source(spark):
    asked = []

    class Answer(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            if len(asked) == 1:
                self.send_error(503)
                return
            body = json.dumps({"results": [{"t": 1704205800000, "c": 2, "x": {"y": "z"}}]} if "range" in self.path else {"status": "none"}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}/v2"
    spark.dataSource.register(rest.RestSource)
    urls = [rest.minute_url(base, "A", "2024-01-02"), rest.contracts_url(base, "A", "call", "2024-01-02")]
    df = spark.read.format("rest_results").schema("t long, c double, `x.y` string, no string").option("urls", json.dumps(urls)).option("pause", "0.01").load()
    got = rest.with_market_time(df).collect()
    server.shutdown()
    assert [tuple(r) for r in got] == [(1704205800000, 2.0, "z", None, datetime(2024, 1, 2, 9, 30))]
    assert len(asked) >= 3


def streamed(spark, tmp_path, batches, schema, plan):
    """Rows a streaming plan sends for input files read one by one."""
    folder = tmp_path / "in"
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"file://{folder}/b{i:03}")
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"file://{folder}")
    out, marks = f"file://{tmp_path}/out", f"file://{tmp_path}/marks"
    plan(source).writeStream.format("parquet").option("checkpointLocation", marks).outputMode("append").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


SERIES = [100.0, 103.0, 106.0, None, 100.0, 90.0, 95.0, 99.0, 80.0, 101.0]
END = datetime(2024, 1, 9)


def price_batches():
    made = [("A", datetime(2024, 1, 2 + i // 5, 10, i), c) for i, c in enumerate(SERIES)]
    made[1], made[2] = made[2], made[1]  # out of order, and in two files
    return [made[:2], made[2:5], made[5:], [("Z", END, 1.0)]]


def test_stream_filters_equal_batch(spark, tmp_path):
    schema = "symbol string, timestamp timestamp_ntz, close double"
    whole = spark.createDataFrame([r for b in price_batches() for r in b], schema)
    got = streamed(spark, tmp_path / "a", price_batches(), schema, lambda s: stream_cumsum_events(s, 0.05, "3 days"))
    assert rows(got) == rows(events.cumsum_events(whole, 0.05)) and got.count() > 1
    got = streamed(spark, tmp_path / "b", price_batches(), schema, lambda s: stream_reversal_events(s, 0.02, 0.01, "3 days"))
    assert rows(got) == rows(events.reversal_events(whole, 0.02, 0.01)) and got.count() > 0


def test_stream_state_carries_over_batches(spark, tmp_path):
    schema = "symbol string, timestamp timestamp_ntz, close double"
    one_by_one = [[("A", datetime(2024, 1, 2, 10, i), c)] for i, c in enumerate([100.0, 103.0, None, 103.0, 107.0, 104.0])] + [[("Z", END, 1.0)]]
    whole = spark.createDataFrame([r for b in one_by_one for r in b], schema)
    got = streamed(spark, tmp_path, one_by_one, schema, lambda s: stream_reversal_events(s, 0.02, 0.01, "0 seconds"))
    assert rows(got) == rows(events.reversal_events(whole, 0.02, 0.01)) and got.count() == 1  # a missing price is no change


def test_stream_bars_and_latest_equal_batch(spark, tmp_path):
    schema = "symbol string, ts timestamp_ntz, price double, size long, id long"
    ticks = [("A", datetime(2024, 1, 2, 10) + timedelta(minutes=17 * i), float(i % 7), i, i) for i in range(12)]
    batches = [ticks[1::2], ticks[::2], [("Z", END, 1.0, 1, 99)], [("Z", END, 1.0, 1, 100)]]
    cols = (F.col("symbol"), F.col("ts"), F.col("price"), F.col("size"), F.col("id"))
    got = streamed(spark, tmp_path / "a", batches, schema, lambda s: stream_bars(s, *cols, late="1 day"))
    assert rows(got) == rows(B.bars_from_ticks(spark.createDataFrame(ticks, schema), *cols))
    schema = "symbol string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, close double"
    t = datetime(2024, 1, 2, 10)
    ups = [("A", t, None, 1.0), ("A", t, t, 2.0), ("A", t, t + timedelta(seconds=1), 3.0), ("B", t, None, 4.0)]
    got = streamed(spark, tmp_path / "b", [[ups[2]], ups[:2], ups[3:], [("Z", END, None, 0.0)], [("Z", END, None, 0.0)]], schema, lambda s: stream_latest(s, "1 day"))
    assert rows(got) == rows(B.take_latest(spark.createDataFrame(ups, schema), ["timestamp", "symbol"], "ingestion_timestamp"))
