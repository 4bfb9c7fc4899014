"""DuckDB SQL with the rows of the registered queries, written apart from the operators."""

from __future__ import annotations

from tidemark.functions.windows import ffd_weights

BARS = """t as (select event_type as symbol, date_trunc('hour', ts) as timestamp, value as p, ts, event_id, (props->>'$.k')::double as k from events),
b as (select symbol, timestamp, arg_min(p, (ts, event_id)) as open, max(p) as high, min(p) as low, arg_max(p, (ts, event_id)) as close, sum(k)::double as volume from t group by symbol, timestamp)"""
W = "partition by symbol order by timestamp"
NY = "timezone('America/New_York', timezone('UTC', timestamp))::date"
DAY = f"partition by symbol, {NY} order by timestamp"


def p(n):
    return f"over ({W} rows between {n} preceding and 1 preceding)"


def u(n):
    return f"over ({W} rows between {n - 1} preceding and current row)"


def lag(c, n):
    return f"lag({c}, {n}) over ({W})"


def ret(c, n):
    return f"case when {lag(c, n)} > 0 then {c} / {lag(c, n)} - 1 end"


def trail(fn, c, n, least=None):
    return f"case when count(*) {p(n)} = {n} and count({c}) {p(n)} >= {n // 2 if least is None else least} then {fn}({c}) {p(n)} end"


def ffd(c):
    return " + ".join(f"({w!r}) * {lag(c, k)}" for k, w in enumerate(ffd_weights(), 1))


def zscore(c, n):
    return f"case when count(*) {u(n)} = {n} and stddev_samp({c}) {u(n)} > 0 then ({c} - avg({c}) {u(n)}) / stddev_samp({c}) {u(n)} end"


def final(columns: dict[str, str], source: str = "b", digits: int = 6, ctes: str = "", key: str = "timestamp, symbol") -> str:
    return f"with recursive {BARS}{ctes} select {key}, " + ", ".join(f"round({e}, {digits}) as {n}" for n, e in columns.items()) + f" from {source}"


slog = lambda x: f"sign({x}) * ln(1 + abs({x}))"
clip = lambda x, a, b: f"case when {x} is not null then greatest({a}, least({b}, {x})) end"
R = f", r as (select *, {ret('close', 1)} as r from b)"
N = f", n as (select *, row_number() over ({W}) as i, count(*) over (partition by symbol) as all_ from b)"
D = f""", d as (select symbol, timestamp, {NY} as day, close / lag(close) over ({DAY}) - 1 as r, row_number() over ({DAY}) - 1 as i from b)"""

ORACLES: dict[str, str] = {
    "bars_hourly": final({c: c for c in ("open", "high", "low", "close", "volume")}),
    "take_latest": f"with {BARS}, l as (select *, row_number() over (partition by symbol, timestamp order by ts desc, event_id desc) as r from t) select timestamp, symbol, p as value, event_id from l where r = 1",
    "collect_all_updates": f"with {BARS}, l as (select *, row_number() over (partition by symbol, timestamp order by ts, event_id) as r from t where timestamp >= timestamp '2024-01-05' and timestamp < timestamp '2024-01-15') select timestamp, symbol, p as value, event_id from l where r = 1",
    "raw_to_bars": f"with {BARS}, l as (select *, row_number() over (partition by symbol, timestamp order by ts desc nulls last, event_id desc) as r from t) select timestamp, symbol, p as value from l where r = 1",
    "orderbook_latest": "with l as (select date_trunc('minute', ts) as timestamp, event_type as symbol, value as price_ask, value * 0.99 as price_bid, event_id as quote_id, row_number() over (partition by event_type, date_trunc('minute', ts) order by ts desc, event_id desc) as r from events where event_id % 7 <> 0) select timestamp, symbol, price_ask, round(price_bid, 6) as price_bid, quote_id from l where r = 1",
    "upsample_ffill": final({"close": f"last_value(close ignore nulls) over ({W})"}, "g", ctes=", e as (select symbol, min(timestamp) as a, max(timestamp) as z from b group by symbol), g0 as (select symbol, unnest(generate_series(a, z, interval 30 minute)) as timestamp from e), g as (select g0.symbol, g0.timestamp, b.close from g0 left join b on g0.symbol = b.symbol and g0.timestamp = b.timestamp)"),
    "returns_simple": final({f"return_{k}": ret("close", k) for k in (1, 5, 15, 30, 60, 120)}, digits=8),
    "returns_log": final({f"return_{k}": f"case when {lag('close', k)} > 0 then ln(close / {lag('close', k)}) end" for k in (1, 5, 15, 30, 60, 120)}),
    "volatility": final({f"volatility_{w}": f"{trail('stddev_pop', 'r', w)} * sqrt(362880.0 / {w})".replace("end *", "end *") for w in (5, 10, 20, 30, 60)}, "r", 4, R),
    "bollinger": final({"bb_middle": "m", "bb_upper": "m + 2 * s", "bb_lower": "m - 2 * s", "bb_position": "case when s > 0 then greatest(0.0, least(1.0, (c - (m - 2 * s)) / (4 * s))) end", "bb_width": "case when m > 0 then 4 * s / m end"}, "y",
        ctes=f", x0 as (select *, coalesce(close / {lag('close', 1)} - 1, 0) as r from b), x as (select *, sum(r) over ({W} rows unbounded preceding) as c from x0), y as (select *, {trail('avg', 'c', 20)} as m, {trail('stddev_pop', 'c', 20)} as s from x)"),
    "indicators": final({
        "rsi": f"case when i >= 14 then case when avg(l) {u(14)} = 0 then 100 else 100 - 100 / (1 + avg(g) {u(14)} / avg(l) {u(14)}) end end", "open_close_ratio": "case when close > 0 then open / close end",
        "autocorr_lag1": f"case when count(*) {p(14)} = 14 and count(case when prev is not null then close end) {p(14)} >= 5 and var_pop(case when prev is not null then close end) {p(14)} > 0 and var_pop(prev) {p(14)} > 0 then corr(close, prev) {p(14)} end", "hl_range_pct": "case when close > 0 then (high - low) / close end",
        "close_zscore": clip(f"(close - ({trail('avg', 'close', 20)})) / greatest({trail('stddev_pop', 'close', 20)}, case when {trail('stddev_pop', 'close', 20)} is not null then 1e-8 end)", -10, 10), "close_minmax": f"case when ({trail('max', 'close', 20)}) > ({trail('min', 'close', 20)}) then (close - ({trail('min', 'close', 20)})) / (({trail('max', 'close', 20)}) - ({trail('min', 'close', 20)})) end"},
        "x", ctes=f", x as (select *, row_number() over ({W}) - 1 as i, {lag('close', 1)} as prev, greatest(coalesce(close - {lag('close', 1)}, 0), 0) as g, greatest(coalesce({lag('close', 1)} - close, 0), 0) as l from b)"),
    "volume": final({"obv_ffd_zscore": zscore("f", 100), "obv_pct_change_log": slog("q"), "volume_ratio_log": slog(f"(case when ({trail('avg', 'volume', 100)}) > 0 then volume / ({trail('avg', 'volume', 100)}) end)")}, "z",
        ctes=f", x as (select *, sum(case when {lag('close', 1)} is null then volume when close > {lag('close', 1)} then volume when close < {lag('close', 1)} then -volume else 0 end) over ({W} rows unbounded preceding) as o from (select *, {lag('close', 1)} as pc from b) q0), z as (select *, {ffd('o')} as f, case when {lag('o', 1)} <> 0 then (o - {lag('o', 1)}) / abs({lag('o', 1)}) end as q from x)".replace(f"case when {lag('close', 1)} is null then volume when close > {lag('close', 1)} then volume when close < {lag('close', 1)} then -volume else 0 end", "case when pc is null then volume when close > pc then volume when close < pc then -volume else 0 end")),
    "time_of_day": final({"hour_of_day": "hour(l)::double", "time_of_day_bin": "(case when m < 570 then 0 when m < 630 then 1 when m < 720 then 2 when m < 840 then 3 when m < 930 then 4 when m <= 960 then 5 else 6 end)::double"}, "x", ctes=", x as (select *, hour(l) * 60 + minute(l) as m from (select *, timezone('US/Eastern', timezone('UTC', timestamp)) as l from b) q)"),
    "reference_returns": final({f"ref_return_{k}": f"x.r{k}" for k in (1, 5, 15)}, "b left join x using (timestamp)", ctes=f", x as (select timestamp, {', '.join(f'close / {lag(chr(99) + chr(108) + chr(111) + chr(115) + chr(101), k)} - 1 as r{k}' for k in (1, 5, 15))} from b where symbol = (select min(symbol) from b where upper(symbol) like '%PURCHASE%'))", key="timestamp, b.symbol"),
    "ffd": final({"ffd_close": ffd("close")}),
    "ffd_zscore": final({f"ffd_zscore_{c}": zscore(f"f_{c}", 100) for c in ("close", "volume")}, "x", ctes=f", x as (select *, {ffd('close')} as f_close, {ffd('volume')} as f_volume from b)"),
    "ffd_volatility_zscore": final({"ffd_volatility_zscore_close": zscore("f", 100)}, "z", ctes=f", x as (select *, ln(close / {lag('close', 1)}) as r from b), y as (select *, stddev_samp(r) {u(20)} as v from x), z as (select *, {ffd('v')} as f from y)"),
    "market_regime": final({
        "return_mean": trail("avg", "r", 24), "return_variance": "v24 * v24", "return_volatility": "v24",
        "return_skewness": "case when v24 > 0 then (e3 - 3 * e1 * e2 + 2 * e1 * e1 * e1) / (v24 * v24 * v24) end", "return_excess_kurtosis": "case when v24 > 0 then (e4 - 4 * e1 * e3 + 6 * e1 * e1 * e2 - 3 * e1 * e1 * e1 * e1) / (v24 * v24 * v24 * v24) - 3 end"}
        | {f"volatility_regime_{w}": f"case when v{w} > ({trail('quantile_q66', f'v{w}', w, w // 4)}) then 1.0::double when v{w} < ({trail('quantile_q33', f'v{w}', w, w // 4)}) then -1.0::double else 0.0::double end" for w in (24, 72)}
        | {f"volatility_zscore_{w}": clip(f"((v{w} - ({trail('avg', f'v{w}', w)})) / greatest({trail('stddev_pop', f'v{w}', w)}, case when {trail('stddev_pop', f'v{w}', w)} is not null then 1e-8 end))", -10, 10) for w in (24, 72)},
        "x", 4, R + f", x as (select *, {trail('stddev_pop', 'r', 24, 6)} as v24, {trail('stddev_pop', 'r', 72, 18)} as v72, avg(r) {p(24)} as e1, avg(r * r) {p(24)} as e2, avg(r * r * r) {p(24)} as e3, avg(r * r * r * r) {p(24)} as e4 from r)"),
    "ema": final({f"ema_{k}": f"e{k}" for k in (5, 15)} | {f"ema_rel_{k}": f"case when e{k} > 0 then close / e{k} end" for k in (5, 15)}, "e", ctes=N + ", e as (select symbol, timestamp, i, close, close as e5, close as e15 from n where i = 1 union all select n.symbol, n.timestamp, n.i, n.close, n.close * (2.0/6) + e.e5 * (4.0/6), n.close * (2.0/16) + e.e15 * (14.0/16) from e join n on n.symbol = e.symbol and n.i = e.i + 1)"),
    "garch": final({"garch_volatility": "sqrt(s * 362880)"}, "e", 4, N + f", q as (select n.*, coalesce({ret('close', 1)}, 0) as r from n), m as (select symbol, var_pop(r) as s0 from q group by symbol), e as (select symbol, timestamp, i, r, s0 as s from q join m using (symbol) where i = 1 union all select q.symbol, q.timestamp, q.i, q.r, 0.1 + 0.1 * e.r * e.r + 0.8 * e.s from e join q on q.symbol = e.symbol and q.i = e.i + 1)"),
}
for _w in (24, 72):
    for _q in ("33", "66"):
        _c = f"quantile_q{_q}(v{_w})"
        ORACLES["market_regime"] = ORACLES["market_regime"].replace(_c, f"quantile_cont(v{_w}, 0.{_q})")


def _targets(side: str) -> str:
    sign = 1 if side == "long" else -1
    win, lose = ("c.close >= n.close * 1.9", "c.close <= n.close * (1 - 0.9)") if sign > 0 else ("c.close <= n.close * (1 - 0.9)", "c.close >= n.close * 1.9")
    base = f"label_{side}_tp900_sl900_3m"
    return f"""with {BARS}{N}, h as (select n.symbol, n.i, c.i as j, {win} as won, row_number() over (partition by n.symbol, n.i order by c.i) as k from n join n c on c.symbol = n.symbol and c.i between n.i + 1 and n.i + 2 where {win} or {lose}),
    x as (select n.timestamp, n.symbol, n.i + 3 <= n.all_ as whole, h.won, {sign} * (case when h.j is null then e.close else o.open end - n.close) / n.close as r, h.j from n left join h on h.symbol = n.symbol and h.i = n.i and h.k = 1 left join n o on o.symbol = n.symbol and o.i = h.j + 1 left join n e on e.symbol = n.symbol and e.i = n.i + 3)
    select timestamp, symbol, (case when not whole or j is null then 0 when won then 1 else -1 end)::double as {base}, case when whole then round(r, 6) end as {base}_return, case when whole then round(r / 0.9, 6) end as {base}_score from x"""


ORACLES["forward_return"] = final({"label_forward_return_3m": f"lead(close, 3) over ({W}) / close - 1"})
ORACLES["tp_sl_long"], ORACLES["tp_sl_short"] = _targets("long"), _targets("short")
CUSUM = f"""{BARS}{D}, s as (select symbol, day, timestamp, i, 0.0::double as p, 0.0::double as q, 0 as side from d where i = 0
    union all select d.symbol, d.day, d.timestamp, d.i, case when greatest(0, s.p + d.r) > 0.5 then 0 else greatest(0, s.p + d.r) end,
      case when greatest(0, s.p + d.r) <= 0.5 and least(0, s.q + d.r) < -0.5 then 0 else least(0, s.q + d.r) end,
      case when greatest(0, s.p + d.r) > 0.5 then 1 when least(0, s.q + d.r) < -0.5 then -1 else 0 end from s join d on d.symbol = s.symbol and d.day = s.day and d.i = s.i + 1)"""
ORACLES["cumsum_events"] = f"with recursive {CUSUM} select timestamp, symbol, side::int as breakout_side from s where side <> 0"
ORACLES["reversal_events"] = f"""with recursive {BARS}{D}, s as (select symbol, day, timestamp, i, 0.0::double as p, 0.0::double as q, 0 as state, 0.0::double as ext, 0 as side, 0.0::double as fin, 0.0::double as fext from d where i = 0
    union all select symbol, day, timestamp, i, case when e <> 0 then 0 else p end, case when e <> 0 then 0 else q end,
      case when e <> 0 then 0 when state <> 0 then state when p > 0.5 then 1 when q < -0.5 then -1 else 0 end,
      case when e <> 0 then 0 when state = 1 then greatest(ext, p) when state = -1 then least(ext, q) when p > 0.5 then p when q < -0.5 then q else 0 end, e, case when e = 1 then p else q end, ext
    from (select *, case when state = 1 and p <= ext and ext - p > 0.3 then 1 when state = -1 and q >= ext and q - ext > 0.3 then -1 else 0 end as e
      from (select d.symbol, d.day, d.timestamp, d.i, greatest(0, s.p + d.r) as p, least(0, s.q + d.r) as q, s.state, s.ext from s join d on d.symbol = s.symbol and d.day = s.day and d.i = s.i + 1) a) c)
    select timestamp, symbol, side::int as breakout_side, round(fin, 6) as s_final, round(fext, 6) as s_extreme from s where side <> 0"""
ORACLES["adaptive_events"] = f"""with recursive {BARS}{N}, r0 as (select *, {NY} as day, coalesce(close / {lag('close', 1)} - 1, 0) as r from n), r1 as (select *, case when count(*) {u(60)} = 60 then 0.01 * 100 * stddev_samp(r) {u(60)} end as t from r0),
    d as (select *, row_number() over ({DAY}) as k from r1 where i > 1), s as (select symbol, day, null::timestamp as timestamp, 0::bigint as k, 0.0::double as p, 0.0::double as q, 0 as side from (select distinct symbol, day from d) z
    union all select symbol, day, timestamp, k, case when up then 0 else p end, case when down then 0 else q end, case when up or down then 1 else 0 end from (select *, coalesce(p > t, false) as up, not coalesce(p > t, false) and coalesce(q < -t, false) as down
      from (select d.symbol, d.day, d.timestamp, d.k, d.t, greatest(0, s.p + d.r) as p, least(0, s.q + d.r) as q from s join d on d.symbol = s.symbol and d.day = s.day and d.k = s.k + 1) a) c)
    select timestamp, symbol from s where side <> 0"""
SEQ = ", ".join(f"round({lag('close', k)}, 6) as close_{k}" if k else "round(close, 6) as close_0" for k in range(4))
ORACLES["sequence_rows"] = f"with {BARS}, x as (select timestamp, symbol, {SEQ}, row_number() over ({W}) as i from b) select timestamp, symbol, close_3, close_2, close_1, close_0 from x where i >= 4"
ORACLES["sequence_resample"] = f"with recursive {CUSUM}, x as (select timestamp, symbol, {SEQ}, {lag('timestamp', 3)} as first from b) select x.timestamp, x.symbol, close_3, close_2, close_1, close_0 from x join s on s.timestamp = x.timestamp and s.symbol = x.symbol and s.side <> 0 where first > x.timestamp - interval 4 hour"
RET = ", ".join(f"round({ret('close', k)}, 6) as return_{k}" for k in (1, 5))
ORACLES["feature_resample"] = f"with recursive {CUSUM}, f as (select timestamp, symbol, {RET} from b) select s.timestamp, s.symbol, return_1, return_5 from s left join f using (timestamp, symbol) where side <> 0"
ORACLES["target_resample"] = f"with recursive {CUSUM}, f as (select timestamp, symbol, round(lead(close, 3) over ({W}) / close - 1, 6) as label_forward_return_3m from b) select s.timestamp, s.symbol, label_forward_return_3m from s left join f using (timestamp, symbol) where side <> 0"
ORACLES["multi_feature_outer"] = f"with {BARS}, f as (select timestamp, symbol, {RET} from b where symbol <> 'click'), g as (select timestamp, symbol, round(case when close > 0 then (high - low) / close end, 6) as hl_range_pct from b where hour(timestamp) < 20) select timestamp, symbol, return_1, return_5, hl_range_pct from (select timestamp, symbol, round({ret('close', 1)}, 6) as return_1, round({ret('close', 5)}, 6) as return_5 from b where symbol <> 'click') f full join g using (timestamp, symbol)"
ORACLES["ml_data"] = f"with recursive {CUSUM}, f as (select timestamp, symbol, {RET}, round({trail('stddev_pop', 'r', 5)} * sqrt(362880.0 / 5), 4) as volatility_5, round(lead(close, 3) over ({W}) / close - 1, 6) as label_forward_return_3m from (select *, {ret('close', 1)} as r from b) z) select s.timestamp, s.symbol, side::int as breakout_side, return_1, return_5, volatility_5, label_forward_return_3m from s left join f using (timestamp, symbol) where side <> 0"
ORACLES["ml_select_columns"] = f"select timestamp, symbol, return_5, label_forward_return_3m, breakout_side from ({ORACLES['ml_data']}) q"
DAYS = "d as (select distinct timezone('America/New_York', timezone('UTC', ts))::date as date from events where event_type = 'purchase' and day(ts) % 5 < 3)"
ORACLES["missing_days"] = f"with {DAYS} select c.date from (select unnest(generate_series(date '2024-01-01', date '2024-01-30', interval 1 day))::date as date) c anti join d on c.date = d.date"
ORACLES["consecutive_days"] = f"with {DAYS}, g as (select date, date - row_number() over (order by date)::int as g from d) select min(date) as first_day, max(date) as last_day, count(*) as n_days from g group by g"
ORACLES["warmup_trim"] = f"with {BARS}, x as (select timestamp, symbol, close, timezone('America/New_York', timezone('UTC', timestamp))::date as date from b), k as (select *, dense_rank() over (order by date) as k from x) select date, timestamp, symbol, round(close, 6) as close from k where k > 3"
ORACLES["dollar_bars"] = """with recursive u as (select event_type as symbol, date_trunc('hour', ts) as hour, value as close, ts, sum((props->>'$.k')::double) over (partition by event_type, date_trunc('hour', ts) order by ts, event_id rows unbounded preceding) as volume from events),
    v as (select *, coalesce(volume * close - coalesce(lag(volume * close) over (partition by symbol, hour order by ts), 0), 0) as d from u), n as (select symbol, ts, close, d, row_number() over (partition by symbol order by hour, ts, close, d) as i from v),
    s as (select symbol, 0::bigint as i, null::timestamp as ts, 0.0::double as close, 0.0::double as sum_, false as full_ from (select distinct symbol from n) q
    union all select n.symbol, n.i, n.ts, n.close, case when s.full_ then 0 else s.sum_ end + n.d, case when s.full_ then 0 else s.sum_ end + n.d >= 5e4 from s join n on n.symbol = s.symbol and n.i = s.i + 1)
    select ts as timestamp, symbol, round(close, 4) as close, round(sum_, 4) as dollar_volume from s where full_"""

ORACLES["normalised_ffd"] = final({"normalised_ffd_close": f"case when close <> 0 then ({ffd('close')}) / close end"})
ORACLES["orderbook_updates"] = "with l as (select date_trunc('minute', ts) as timestamp, event_type as symbol, value as price_ask, value * 0.99 as price_bid, event_id as quote_id, row_number() over (partition by event_type, date_trunc('minute', ts) order by case when event_id % 7 <> 0 then ts end nulls first, event_id) as r from events where date_trunc('minute', ts) >= timestamp '2024-01-05' and date_trunc('minute', ts) < timestamp '2024-01-15') select timestamp, symbol, price_ask, round(price_bid, 6) as price_bid, quote_id from l where r = 1"
ORACLES["dataset_summary"] = f"select count(*) as n_rows, 7::bigint as n_columns, count(distinct symbol) as n_symbols, min(timestamp) as first_time, max(timestamp) as last_time from ({ORACLES['ml_data']}) q"
