"""Trailing row frames over one symbol's series, with their eligibility rules, and fractional differencing."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

def by_symbol():
    return Window.partitionBy("symbol").orderBy("timestamp")


def lag(c: Column | str, n: int) -> Column:
    return F.lag(c, n).over(by_symbol())


def before(n: int):
    """The n rows before the current one."""
    return by_symbol().rowsBetween(-n, -1)


def upto(n: int):
    """The current row and the n - 1 before it."""
    return by_symbol().rowsBetween(-(n - 1), 0)


def full(n: int) -> Column:
    return F.count(F.lit(1)).over(before(n)) == n


def trailing(fn, c: Column, n: int, least: int | None = None) -> Column:
    """fn over the n rows before; null unless all are there and `least` (half of them) are valid."""
    least = n // 2 if least is None else least
    return F.when(full(n) & (F.count(c).over(before(n)) >= least), fn(c).over(before(n)))


def filled(c: Column | str) -> Column:
    """The last valid value up to the current row."""
    return F.last(c, ignorenulls=True).over(by_symbol().rowsBetween(Window.unboundedPreceding, 0))


def simple_return(c: Column, n: int) -> Column:
    return F.when(lag(c, n) > 0, c / lag(c, n) - 1)


def ffd_weights(d: float = 0.4, threshold: float = 1e-3) -> list[float]:
    """Weights of the fractional difference of order d, newest first, down to the threshold."""
    out, k = [1.0], 1
    while abs(w := -out[-1] * (d - k + 1) / k) >= threshold:
        out.append(w)
        k += 1
    return out


def ffd(c: Column, d: float = 0.4, threshold: float = 1e-3) -> Column:
    """Fixed-width fractional difference of the rows before the current one; null if any is missing."""
    weights = ffd_weights(d, threshold)[::-1]
    rows = F.collect_list(c).over(before(len(weights)))  # the valid ones, oldest first
    products = F.zip_with(rows, F.lit(weights), lambda x, w: x * w)
    return F.when(F.size(rows) == len(weights), F.aggregate(products, F.lit(0.0), lambda a, x: a + x))


def normalised_ffd(c: Column, d: float = 0.4, threshold: float = 1e-3) -> Column:
    """The fractional difference relative to the row's own value; null where that is 0."""
    return F.when(c != 0, ffd(c, d, threshold) / c)


def zscore_upto(c: Column, n: int = 100) -> Column:
    """(c - mean) / sample deviation over n rows that end here; null if rows are missing or the deviation isn't positive."""
    mean, sd = F.avg(c).over(upto(n)), F.stddev_samp(c).over(upto(n))
    return F.when((F.count(F.lit(1)).over(upto(n)) == n) & (sd > 0), (c - mean) / sd)


def signed_log(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))
