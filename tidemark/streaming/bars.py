"""Bars and latest updates of unbounded inputs, as watermarked aggregates; each result is sent once, when its time is past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stream_bars(ticks: DataFrame, symbol: Column, ts: Column, price: Column, size: Column, order: Column, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """OHLCV bars of a stream: equal to bars_from_ticks over the same ticks if none comes later than `late`."""
    price = F.when(F.isnan(price), None).otherwise(price)
    rows = ticks.select(symbol.alias("symbol"), ts.cast("timestamp").alias("__ts"), price.alias("p"), size.alias("v"), order.alias("o")).withWatermark("__ts", late)
    k = F.struct("__ts", "o")
    made = rows.groupBy("symbol", F.window("__ts", width).alias("w")).agg(F.min_by("p", k).alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", k).alias("close"), F.sum("v").cast("double").alias("volume"))
    return made.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("timestamp"), "open", "high", "low", "close", "volume")


def stream_latest(updates: DataFrame, late: str, ingested: str = "ingestion_timestamp", *ties: str) -> DataFrame:
    """The update of each (timestamp, symbol) ingested last, null being first of all, as take_latest has it."""
    rest = [c for c in updates.columns if c not in ("timestamp", "symbol")]
    known = F.col(ingested).isNotNull()
    rows = updates.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", late)
    best = rows.groupBy("timestamp", "symbol").agg(F.max_by(F.struct(*rest), F.struct(known, F.coalesce(ingested, F.lit(0).cast("timestamp").cast(dict(updates.dtypes)[ingested])), *ties)).alias("__u"))
    return best.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "symbol", *[F.col(f"__u.{c}").alias(c) for c in rest])
