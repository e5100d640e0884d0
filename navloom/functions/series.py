"""Window expressions over one entity's dated series.

A series holds at most one row per calendar day and entity (the unique key of every dated table), so one window partition is
bounded by the length of the calendar however many entities there are.  Event-level tables are first reduced to that grain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from navloom.functions.exprs import log_return, safe_div, simple_return


def by(keys: Sequence[str], order: str | Sequence[str]) -> WindowSpec:
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*keys).orderBy(*order)


def upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def daily_return(x: Column, w: WindowSpec) -> Column:
    return simple_return(x, F.lag(x).over(w))


def daily_log_return(x: Column, w: WindowSpec) -> Column:
    return log_return(x, F.lag(x).over(w))


def drawdown(x: Column, w: WindowSpec) -> Column:
    return 1 - safe_div(x, F.max(x).over(upto(w)))


def running_sum(x: Column, w: WindowSpec) -> Column:
    return F.sum(x).over(upto(w))


def running_product(x: Column, w: WindowSpec) -> Column:
    return F.product(x).over(upto(w))


def moving_mean(x: Column, w: WindowSpec, rows: int, min_rows: int = 1) -> Column:
    frame = w.rowsBetween(-(rows - 1), 0)
    mean = F.avg(x).over(frame)
    return mean if min_rows <= 1 else F.when(F.count(x).over(frame) >= min_rows, mean)


def forward_fill(x: Column, w: WindowSpec) -> Column:
    return F.last(x, ignorenulls=True).over(upto(w))


def lag_return(x: Column, w: WindowSpec, n: int) -> Column:
    return simple_return(x, F.lag(x, n).over(w))


def lagged_weight_return(weight: Column, ret: Column, w: WindowSpec) -> Column:
    return F.coalesce(F.lag(weight).over(w), F.lit(0.0)) * ret


def difference(x: Column, w: WindowSpec) -> Column:
    return x - F.lag(x).over(w)


def rebase(x: Column, w: WindowSpec) -> Column:
    return safe_div(x, F.first(x).over(upto(w)))
