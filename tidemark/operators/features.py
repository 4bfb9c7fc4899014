"""Feature operators: bars in, (timestamp, symbol) and feature columns out. Windows of one symbol share one shuffle and sort.

Those with `keep` can give more of the bars' columns, so that features and targets are chained over one exchange (align.wide).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.windows import by_symbol, ffd, full, lag, signed_log, simple_return, trailing, upto, zscore_upto
from tidemark.operators.registry import feature

KEY = ["timestamp", "symbol"]
MINUTES_PER_YEAR = 252 * 24 * 60


@feature("returns")
def returns(bars: DataFrame, periods=(1, 5, 15, 30, 60, 120), price: str = "close", log: bool = False, keep=KEY) -> DataFrame:
    c = F.col(price)
    one = (lambda p: F.when(lag(c, p) > 0, F.log(c / lag(c, p)))) if log else (lambda p: simple_return(c, p))
    return bars.select(*keep, *[one(p).alias(f"return_{p}") for p in periods])


def _recursive(bars: DataFrame, columns: list[str], kernel) -> DataFrame:
    """One pass over each symbol's series in time order by a pandas kernel; for recursions no bounded frame expresses."""
    schema = "timestamp timestamp_ntz, symbol string, " + ", ".join(f"{c} double" for c in columns)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("timestamp", kind="stable")
        return kernel(pdf)[["timestamp", "symbol", *columns]]

    return bars.groupBy("symbol").applyInPandas(run, schema)


@feature("ema")
def ema(bars: DataFrame, periods=(5, 15, 30, 60, 120), price: str = "close", relative: bool = True) -> DataFrame:
    columns = [f"ema_{p}" for p in periods] + [f"ema_rel_{p}" for p in periods if relative]

    def kernel(pdf):
        for p in periods:
            e = pdf[price].ewm(span=p, adjust=False, ignore_na=True).mean().ffill()
            pdf[f"ema_{p}"] = e
            if relative:
                pdf[f"ema_rel_{p}"] = (pdf[price] / e).where(e > 0)
        return pdf

    return _recursive(bars.select(*KEY, price), columns, kernel)


@feature("bollinger")
def bollinger(bars: DataFrame, period: int = 20, deviations: float = 2.0, price: str = "close", keep=KEY) -> DataFrame:
    """Bands around the running sum of one-bar changes."""
    padded = bars.withColumn("__c", F.last(price, ignorenulls=True).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0)))
    summed = padded.withColumn("__r", F.coalesce(F.when(lag("__c", 1) != 0, F.col("__c") / lag("__c", 1) - 1), F.lit(0.0))).withColumn("__s", F.sum("__r").over(by_symbol().rowsBetween(Window.unboundedPreceding, 0)))
    s = F.col("__s")
    out = summed.withColumn("bb_middle", trailing(F.avg, s, period)).withColumn("__sd", trailing(F.stddev_pop, s, period))
    mid, half = F.col("bb_middle"), deviations * F.col("__sd")
    place = (s - (mid - half)) / (2 * half)
    return out.select(*keep, "bb_middle", (mid + half).alias("bb_upper"), (mid - half).alias("bb_lower"), F.when(half > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), place))).alias("bb_position"), F.when(mid > 0, 2 * half / mid).alias("bb_width"))


@feature("volatility")
def volatility(bars: DataFrame, windows=(5, 10, 20, 30, 60), price: str = "close", keep=KEY) -> DataFrame:
    out = bars.withColumn("__r", simple_return(F.col(price), 1))
    return out.select(*keep, *[(trailing(F.stddev_pop, F.col("__r"), w) * (MINUTES_PER_YEAR / w) ** 0.5).alias(f"volatility_{w}") for w in windows])


@feature("indicators")
def indicators(bars: DataFrame, rsi_period: int = 14, autocorr_lag: int = 1, autocorr_window: int = 14, zscore_window: int = 20, minmax_window: int = 20, keep=KEY) -> DataFrame:
    c = F.col("close")
    out = bars.withColumn("__d", F.coalesce(c - lag(c, 1), F.lit(0.0))).withColumn("__l", lag(c, autocorr_lag)).withColumn("__i", F.row_number().over(by_symbol()) - 1)
    gain, loss = F.avg(F.greatest(F.col("__d"), F.lit(0.0))).over(upto(rsi_period)), F.avg(F.greatest(-F.col("__d"), F.lit(0.0))).over(upto(rsi_period))
    rsi = F.when(F.col("__i") >= rsi_period, F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + gain / loss)))
    frame = by_symbol().rowsBetween(-autocorr_window, -1)
    x, y = F.when(F.col("__l").isNotNull(), c), F.when(c.isNotNull(), F.col("__l"))
    corr = F.when(full(autocorr_window) & (F.count(x).over(frame) >= 5) & (F.var_pop(x).over(frame) > 0) & (F.var_pop(y).over(frame) > 0), F.covar_pop(x, y).over(frame) / (F.stddev_pop(x).over(frame) * F.stddev_pop(y).over(frame)))  # corr() itself fails on a constant frame
    z = (c - trailing(F.avg, c, zscore_window)) / F.greatest(trailing(F.stddev_pop, c, zscore_window), F.lit(1e-8))
    low, high = trailing(F.min, c, minmax_window), trailing(F.max, c, minmax_window)
    return out.select(
        *keep, rsi.alias("rsi"), F.when(c > 0, F.col("open") / c).alias("open_close_ratio"), corr.alias("autocorr_lag1"), F.when(c > 0, (F.col("high") - F.col("low")) / c).alias("hl_range_pct"),
        F.when(z.isNotNull(), F.greatest(F.lit(-10.0), F.least(F.lit(10.0), z))).alias("close_zscore"), F.when(high > low, (c - low) / (high - low)).alias("close_minmax"),
    )


def on_balance_volume(bars: DataFrame, price: str = "close") -> DataFrame:
    """bars with obv: the first valid volume, then plus or minus each volume by the price's direction; missing values carry."""
    c, v = F.col(price), F.col("volume")
    ahead = by_symbol().rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.count(v).over(ahead), F.lit(0)) == 0
    move = F.when(v.isNull() | c.isNull() | lag(c, 1).isNull(), 0.0).when(c > lag(c, 1), v).when(c < lag(c, 1), -v).otherwise(0.0)
    return bars.withColumn("__m", F.when(v.isNotNull() & first, v).when(first, None).otherwise(move)).withColumn("obv", F.sum("__m").over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))).drop("__m")


@feature("volume")
def volume(bars: DataFrame, ratio_period: int = 100, price: str = "close", zscore_window: int = 100, keep=KEY) -> DataFrame:
    out = on_balance_volume(bars, price).withColumn("__f", ffd(F.col("obv")))
    change = F.when(lag("obv", 1) != 0, (F.col("obv") - lag("obv", 1)) / F.abs(lag("obv", 1)))
    mean = trailing(F.avg, F.col("volume"), ratio_period)
    return out.select(*keep, zscore_upto(F.col("__f"), zscore_window).alias("obv_ffd_zscore"), signed_log(change).alias("obv_pct_change_log"), signed_log(F.when(mean > 0, F.col("volume") / mean)).alias("volume_ratio_log"))


@feature("garch")
def garch(bars: DataFrame, omega: float = 0.1, alpha: float = 0.1, beta: float = 0.8, price: str = "close") -> DataFrame:
    """Conditional volatility; its seed is the variance of all returns of the symbol, so early rows know the whole series. beta is under 1."""
    if not 0 <= beta < 1:
        raise ValueError(f"beta is from 0 to under 1, not {beta}")
    rows = bars.withColumn("r", F.coalesce(simple_return(F.col(price), 1), F.when(F.row_number().over(by_symbol()) == 1, F.lit(0.0))))

    def kernel(pdf):
        r = pdf["r"]
        y = (omega + alpha * r.shift(1) ** 2) / (1 - beta)
        y.iloc[0] = r.var(ddof=0)
        pdf["garch_volatility"] = (y.ewm(alpha=1 - beta, adjust=False, ignore_na=True).mean().ffill() * MINUTES_PER_YEAR) ** 0.5
        return pdf

    return _recursive(rows.select(*KEY, "r"), ["garch_volatility"], kernel)


@feature("time_of_day")
def time_of_day(bars: DataFrame, zone: str = "US/Eastern", keep=KEY) -> DataFrame:
    t = F.from_utc_timestamp(F.col("timestamp").cast("timestamp"), zone)
    m = F.hour(t) * 60 + F.minute(t)
    # Bins end at 9:30, 10:30, 12:00, 14:00, 15:30 and with 16:00
    bins = F.when(m < 570, 0).when(m < 630, 1).when(m < 720, 2).when(m < 840, 3).when(m < 930, 4).when(m <= 960, 5).otherwise(6)
    return bars.select(*keep, F.hour(t).cast("double").alias("hour_of_day"), bins.cast("double").alias("time_of_day_bin"))


@feature("btc_features")
def reference_returns(bars: DataFrame, periods=(1, 5, 15, 30, 60, 120), patterns=("BTC", "BTCUSDT", "BTC-USDT"), prefix: str = "btc_return", price: str = "close") -> DataFrame:
    """Returns of the first symbol that holds a pattern, for every symbol by time; no such symbol gives nulls."""
    is_one = F.lit(False)
    for p in patterns:
        is_one = is_one | F.upper("symbol").contains(p.upper())
    own = bars.where(is_one)
    own = own.join(own.agg(F.min("symbol").alias("symbol")), "symbol", "left_semi")
    c = F.last(price, ignorenulls=True).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))
    rates = own.withColumn("__c", c).select("timestamp", *[F.when(lag("__c", p) != 0, F.col("__c") / lag("__c", p) - 1).alias(f"{prefix}_{p}") for p in periods])
    rates = rates.groupBy("timestamp").agg(*[F.avg(f"{prefix}_{p}").alias(f"{prefix}_{p}") for p in periods])
    return bars.select(*KEY).join(rates, "timestamp", "left").select(*KEY, *[f"{prefix}_{p}" for p in periods])


@feature("ffd_zscore")
def ffd_zscore(bars: DataFrame, columns=("close", "volume"), window: int = 100, d: float = 0.4, threshold: float = 1e-3, keep=KEY) -> DataFrame:
    out = bars.withColumns({f"__{c}": ffd(F.col(c), d, threshold) for c in columns})
    return out.select(*keep, *[zscore_upto(F.col(f"__{c}"), window).alias(f"ffd_zscore_{c}") for c in columns])


@feature("ffd_volatility_zscore")
def ffd_volatility_zscore(bars: DataFrame, price: str = "close", vol_window: int = 20, window: int = 100, log: bool = True, keep=KEY) -> DataFrame:
    c = F.col(price)
    r = F.when((lag(c, 1) > 0) & (c > 0), F.log(c / lag(c, 1))) if log else F.when(lag(c, 1) != 0, c / lag(c, 1) - 1)
    out = bars.withColumn("__r", r).withColumn("__v", F.stddev_samp("__r").over(upto(vol_window))).withColumn("__f", ffd(F.col("__v")))
    return out.select(*keep, zscore_upto(F.col("__f"), window).alias(f"ffd_volatility_zscore_{price}"))


@feature("market_regime", listed=False)
def market_regime(bars: DataFrame, windows=(240, 1440, 4320), price: str = "close", keep=KEY) -> DataFrame:
    """Moments of one-bar returns over the shortest window; class and z-score of volatility for each."""
    short = min(windows)
    quarter = lambda fn, c, w: trailing(fn, c, w, w // 4)
    r = F.col("__r")
    out = bars.withColumn("__r", simple_return(F.col(price), 1))
    mean, some = trailing(F.avg, r, short), F.count(r).over(by_symbol().rowsBetween(-short, -1)) >= short // 2
    variance = F.when(some, quarter(F.var_pop, r, short))
    out = out.withColumns({"return_mean": mean, "return_variance": variance} | {f"__v{w}": quarter(F.stddev_pop, r, w) for w in windows})
    moment = lambda fn: F.when(F.col("return_variance") > 0, quarter(fn, r, short))
    columns = [F.col("return_mean"), F.col("return_variance"), F.sqrt("return_variance").alias("return_volatility"), moment(F.skewness).alias("return_skewness"), moment(F.kurtosis).alias("return_excess_kurtosis")]
    for w in windows:
        v = F.col(f"__v{w}")
        low, high = F.col(f"__low{w}"), F.col(f"__high{w}")
        mean, sd = trailing(F.avg, v, w), trailing(F.stddev_pop, v, w)
        z = (v - mean) / F.greatest(sd, F.lit(1e-8))
        columns += [F.when(v > high, 1.0).when(v < low, -1.0).otherwise(0.0).alias(f"volatility_regime_{w}"), F.when(z.isNotNull(), F.greatest(F.lit(-10.0), F.least(F.lit(10.0), z))).alias(f"volatility_zscore_{w}")]
    return _trailing_quantiles(out, windows).select(*keep, *columns)


def _trailing_quantiles(rows: DataFrame, windows) -> DataFrame:
    """rows with __low and __high of each window: the 33 % and 66 % points of __v over the rows before, by a sorted window that moves along."""
    schema = T.StructType([*rows.schema.fields, *[T.StructField(f"__{x}{w}", T.DoubleType()) for w in windows for x in ("low", "high")]])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("timestamp", kind="stable").reset_index(drop=True)
        for w in windows:
            frame = pdf[f"__v{w}"].astype(float).shift(1).rolling(w, min_periods=max(1, w // 4))
            for x, q in (("low", 0.33), ("high", 0.66)):
                pdf[f"__{x}{w}"] = frame.quantile(q).where(pdf.index >= w)
        return pdf

    return rows.groupBy("symbol").applyInPandas(run, schema)
