"""Forward-looking targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.windows import by_symbol, filled

KEY = ["timestamp", "symbol"]


def forward_return(period: int, price: str = "__fill") -> Column:
    """The change to `period` bars later of a price filled forward (with_filled gives `__fill`); null where either is missing or the first is 0."""
    return F.when(F.col(price) != 0, F.lead(price, period).over(by_symbol()) / F.col(price) - 1)


def with_filled(bars: DataFrame, price: str = "close") -> DataFrame:
    return bars.withColumn("__fill", filled(price))


def target_names(side: str, tp: float, sl: float, period: int) -> tuple[str, str, str]:
    base = f"label_{side}_tp{int(tp * 1000)}_sl{int(sl * 1000)}_{period}m"
    return base, f"{base}_return", f"{base}_score"


def targets(bars: DataFrame, specs: list[tuple[int, float, float]], kind: str = "float", keep=KEY) -> DataFrame:
    """For each (period, take profit, stop loss): forward return, and label, return and score, long and short.

    The first close within the next period - 1 bars that crosses a level decides, take profit first; it fills at the
    next bar's open. Else the return over the period counts. The last `period` rows have label 0 and nulls. One
    forward frame for each period serves all its levels. bars need timestamp, symbol, open and close.
    """
    if lacking := {"timestamp", "symbol", "open", "close"} - set(bars.columns):
        raise ValueError(f"bars lack {sorted(lacking)}")
    periods = sorted({p for p, _, _ in specs})
    out = with_filled(bars).withColumn("__next", F.lead("open").over(by_symbol()))
    for p in periods:
        out = out.withColumn(f"__f{p}", F.collect_list(F.struct(F.col("close").alias("c"), F.col("__next").alias("o"))).over(by_symbol().rowsBetween(1, p - 1)) if p > 1 else F.array().cast("array<struct<c:double,o:double>>"))
        out = out.withColumn(f"__e{p}", F.lead("close", p).over(by_symbol())).withColumn(f"__k{p}", F.lead(F.lit(1), p).over(by_symbol()).isNotNull())
    c = F.col("close")

    def first_hit(p, tp, sl, sign):
        def crosses(x):
            return ((x["c"] >= c * (1 + tp)) | (x["c"] <= c * (1 - sl))) if sign > 0 else ((x["c"] <= c * (1 - tp)) | (x["c"] >= c * (1 + sl)))

        return F.get(F.filter(f"__f{p}", crosses), 0)

    columns = [forward_return(p).cast(kind).alias(f"label_forward_return_{p}m") for p in periods]
    hits = {}
    for p, tp, sl in specs:
        for side, sign in (("long", 1), ("short", -1)):
            hits[p, tp, sl, side] = first_hit(p, tp, sl, sign)
    names = {k: f"__h{i}" for i, k in enumerate(hits)}
    out = out.withColumns({names[k]: v for k, v in hits.items()})
    for (p, tp, sl, side), name in names.items():
        sign = 1 if side == "long" else -1
        x = F.col(name)
        won = (x["c"] >= c * (1 + tp)) if sign > 0 else (x["c"] <= c * (1 - tp))
        ret = sign * (F.coalesce(F.when(x.isNotNull(), x["o"]), F.col(f"__e{p}")) - c) / c
        label = F.when(x.isNull(), 0).when(won, 1).otherwise(-1)
        score = ret / F.when(F.when(x.isNotNull(), won).otherwise(ret >= 0), F.lit(tp)).otherwise(F.lit(sl))
        base, as_return, as_score = target_names(side, tp, sl, p)
        whole = F.col(f"__k{p}")
        columns += [F.when(whole, label).otherwise(0).cast(kind).alias(base), F.when(whole, ret).cast(kind).alias(as_return), F.when(whole, score).cast(kind).alias(as_score)]
    return out.select(*keep, *columns)
