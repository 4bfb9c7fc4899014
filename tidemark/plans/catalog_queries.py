"""Registered queries over the driver's tables, with hourly bars of `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import align, events, features, targets
from tidemark.functions.windows import ffd, normalised_ffd
from tidemark.plans.oracles import ORACLES
from tidemark.sources import bars as B
from tidemark.sources import raw, sinks

__all__ = ["ORACLES", "QUERIES"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the oracle's are: the engines add in different orders."""
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


def _events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def _bars(spark: SparkSession, d: str) -> DataFrame:
    return B.event_bars(_events(spark, d))


def _updates(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"), F.col("event_type").alias("symbol"), "value", F.col("ts").alias("ingestion_timestamp"), "event_id")


def _traded(spark: SparkSession, d: str) -> DataFrame:
    """Updates with the volume so far within their hour."""
    hour = Window.partitionBy("event_type", F.date_trunc("hour", "ts")).orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = _events(spark, d).withColumn("volume", F.sum(F.get_json_object("props", "$.k").cast("double")).over(hour))
    return rows.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("timestamp"), F.col("event_type").alias("symbol"), F.col("value").alias("close"), "volume", F.col("ts").alias("ingestion_timestamp"))


def _feature(fn, digits: int = 6, **params):
    return lambda spark, d: rounded(fn(_bars(spark, d), **params), digits)


def _cumsum(spark: SparkSession, d: str) -> DataFrame:
    return events.cumsum_events(_bars(spark, d), 0.5)


def _forward(bars: DataFrame) -> DataFrame:
    return targets.with_filled(bars).select("timestamp", "symbol", F.round(targets.forward_return(3), 6).alias("label_forward_return_3m"))


def _side(side: str):
    names = targets.target_names(side, 0.9, 0.9, 3)
    return lambda spark, d: rounded(targets.targets(_bars(spark, d), [(3, 0.9, 0.9)], "double").select("timestamp", "symbol", *names))


def _spread(df: DataFrame) -> DataFrame:
    """A four-row sequence column as four columns, oldest first."""
    return df.select("timestamp", "symbol", *[F.round(F.get("close", k), 6).alias(f"close_{3 - k}") for k in range(4)])


def _quotes(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).select(F.col("ts").alias("timestamp"), F.col("event_type").alias("symbol"), F.col("value").alias("price_ask"), (F.col("value") * 0.99).alias("price_bid"), F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("ingestion_timestamp"), F.col("event_id").alias("quote_id"))


def _orderbook(spark: SparkSession, d: str) -> DataFrame:
    return rounded(B.orderbook_latest(_quotes(spark, d)).select("timestamp", "symbol", "price_ask", "price_bid", "quote_id"))


def _ml_data(spark: SparkSession, d: str) -> DataFrame:
    """All features and targets over one exchange, then one join with the events."""
    bars = _bars(spark, d)
    side = align.wide(bars, {"returns": {"periods": (1, 5)}, "volatility": {"windows": (5,)}}, [(3, 0.9, 0.9)], "double")
    out = events.cumsum_events(bars, 0.5).select(*align.KEY, "breakout_side").join(side, align.KEY, "left")
    return out.select(*align.KEY, "breakout_side", *[F.round(c, 4 if c == "volatility_5" else 6).alias(c) for c in ("return_1", "return_5", "volatility_5", "label_forward_return_3m")])


def _outer(spark: SparkSession, d: str) -> DataFrame:
    bars = _bars(spark, d)
    ranges = bars.where(F.hour("timestamp") < 20).select("timestamp", "symbol", F.when(F.col("close") > 0, (F.col("high") - F.col("low")) / F.col("close")).alias("hl_range_pct"))
    return rounded(align.full_join([features.returns(bars.where("symbol <> 'click'"), (1, 5)), ranges]))


def _days(spark: SparkSession, d: str) -> DataFrame:
    return sinks.with_day(_events(spark, d).where("event_type = 'purchase' and day(ts) % 5 < 3"), "ts").select("date")


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return B.raw_to_bars(_updates(spark, d).withColumnRenamed("event_id", "timestamp_seconds")).select("timestamp", "symbol", "value")


QUERIES = {
    "bars_hourly": lambda s, d: rounded(_bars(s, d)),
    "take_latest": lambda s, d: B.take_latest(_updates(s, d), ["timestamp", "symbol"], "ingestion_timestamp", "event_id").select("timestamp", "symbol", "value", "event_id"),
    "collect_all_updates": lambda s, d: B.collect_all_updates(_updates(s, d), ["timestamp", "symbol"], "2024-01-05", "2024-01-15", "ingestion_timestamp", "event_id").select("timestamp", "symbol", "value", "event_id"),
    "raw_to_bars": _raw,
    "orderbook_latest": _orderbook,
    "orderbook_updates": lambda s, d: rounded(B.orderbook_updates(_quotes(s, d), "2024-01-05", "2024-01-15").select("timestamp", "symbol", "price_ask", "price_bid", "quote_id")),
    "normalised_ffd": lambda s, d: rounded(_bars(s, d).select("timestamp", "symbol", normalised_ffd(F.col("close")).alias("normalised_ffd_close"))),
    "dataset_summary": lambda s, d: raw.summary(_ml_data(s, d)),
    "upsample_ffill": lambda s, d: rounded(B.upsample(_bars(s, d), "30 minutes", ["close"])),
    "returns_simple": _feature(features.returns, 8),
    "returns_log": _feature(features.returns, log=True),
    "ema": _feature(features.ema, periods=(5, 15)),
    "bollinger": _feature(features.bollinger),
    "volatility": _feature(features.volatility, 4),
    "indicators": _feature(features.indicators),
    "volume": _feature(features.volume),
    "garch": _feature(features.garch, 4),
    "time_of_day": _feature(features.time_of_day),
    "reference_returns": _feature(features.reference_returns, periods=(1, 5, 15), patterns=("purchase",), prefix="ref_return"),
    "ffd": lambda s, d: rounded(_bars(s, d).select("timestamp", "symbol", ffd(F.col("close")).alias("ffd_close"))),
    "ffd_zscore": _feature(features.ffd_zscore),
    "ffd_volatility_zscore": _feature(features.ffd_volatility_zscore),
    "market_regime": _feature(features.market_regime, 4, windows=(24, 72)),
    "forward_return": lambda s, d: _forward(_bars(s, d)),
    "tp_sl_long": _side("long"),
    "tp_sl_short": _side("short"),
    "cumsum_events": _cumsum,
    "reversal_events": lambda s, d: rounded(events.reversal_events(_bars(s, d), 0.5, 0.3)),
    "adaptive_events": lambda s, d: events.adaptive_events(_bars(s, d), 0.01),
    "dollar_bars": lambda s, d: rounded(events.dollar_bars(_traded(s, d), 5e4), 4),
    "feature_resample": lambda s, d: align.at_events(_cumsum(s, d), rounded(features.returns(_bars(s, d), (1, 5)))),
    "target_resample": lambda s, d: align.at_events(_cumsum(s, d), _forward(_bars(s, d))),
    "sequence_rows": lambda s, d: _spread(align.sequence_rows(_bars(s, d).select("timestamp", "symbol", "close"), 4)),
    "sequence_resample": lambda s, d: _spread(align.sequence_at_events(_cumsum(s, d), _bars(s, d).select("timestamp", "symbol", "close"), 4, 3600)),
    "multi_feature_outer": _outer,
    "ml_data": _ml_data,
    "ml_select_columns": lambda s, d: align.select_columns(_ml_data(s, d), ["return_5"], ["breakout_side"]),
    "missing_days": lambda s, d: sinks.missing_days(_days(s, d), "2024-01-01", "2024-01-31"),
    "consecutive_days": lambda s, d: sinks.consecutive_days(_days(s, d)),
    "warmup_trim": lambda s, d: rounded(sinks.trim_warmup(sinks.with_day(_bars(s, d).select("timestamp", "symbol", "close")), 3)),
}
