"""Average-cost positions from a ledger of trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.functions.exprs import safe_div
from navloom.functions.series import by, forward_fill, running_sum
from navloom.operators.scans import BLOCK, linear_recurrence, numbered, running_total


def positions(ledger: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per trade: cash flow, units and cost before and after, cost of what is sold, realised gain and yield.

    ``ledger``: ``seq, date, type, ticker, quantity, price``.  A sale reduces the cost pro rata to the units; a sale before any
    purchase moves nothing and has no cost.  The running state is kept unrounded and each output is rounded, so that blocks
    of one ticker can be worked on in parallel.
    """
    rows = numbered(ledger, ["ticker"], [F.col("date"), F.col("seq")], block)
    buy = F.col("type") == "Buy"
    value = F.round(F.col("quantity") * F.col("price"), 2)
    rows = rows.withColumns({"transact_val": value, "_move": F.when(buy, F.col("quantity")).when(F.col("RN") == 1, 0.0).otherwise(-F.col("quantity"))})
    rows = running_total(rows, ["ticker"], "_move", "_units").withColumn("_before", F.round(F.col("_units") - F.col("_move"), 4))
    keep = 1 - F.coalesce(safe_div(F.col("quantity"), F.col("_before")), F.lit(0.0))
    first_sale = ~buy & (F.col("RN") == 1)
    rows = linear_recurrence(rows, ["ticker"], F.when(buy | first_sale, 1.0).otherwise(keep), F.when(buy, F.col("transact_val")).otherwise(0.0), "_cost", block)
    sold = F.when(~buy & ~first_sale, F.coalesce(safe_div(F.col("quantity"), F.col("_before")), F.lit(0.0)) * F.col("_cost_before"))
    rows = rows.withColumn("_sold", F.coalesce(F.round(sold, 4), F.lit(0.0)))
    gain = F.when(~buy, F.round(F.col("transact_val") - F.col("_sold"), 4)).otherwise(0.0)
    return rows.select(
        "seq",
        "date",
        "type",
        "ticker",
        "quantity",
        "price",
        F.round(F.when(buy, -F.col("quantity") * F.col("price")).otherwise(F.col("quantity") * F.col("price")), 2).alias("cashflow"),
        F.col("_before").alias("prev_units"),
        F.round("_units", 4).alias("cml_units"),
        F.round("_cost_before", 4).alias("prev_cost"),
        F.round("_cost", 4).alias("cml_cost"),
        F.col("_sold").alias("cost_transact"),
        F.when(~buy, F.round(F.coalesce(safe_div(F.col("_cost_before"), F.col("_before")), F.lit(0.0)), 4)).otherwise(0.0).alias("cost_unit"),
        gain.alias("gain_loss"),
        F.coalesce(F.round(safe_div(gain, F.col("_sold")), 4), F.lit(0.0)).alias("yield"),
    )


def daily_valuation(trades: DataFrame, prices: DataFrame) -> DataFrame:
    """Ticker by day: position carried forward over the price history, market value, running cash flow.

    ``trades`` comes from ``positions``; ``prices``: ``ticker, date, adj_close``.
    """
    at = F.struct("date", "seq")
    day = trades.groupBy("ticker", "date").agg(
        F.sum("cashflow").alias("cashflow"), F.max_by("cml_units", at).alias("cml_units"), F.max_by("cml_cost", at).alias("cml_cost"), F.sum("gain_loss").alias("gain_loss")
    )
    traded = day.select("ticker").distinct()
    joined = prices.join(traded, "ticker", "left_semi").join(day, ["ticker", "date"], "full_outer")
    w = by(["ticker"], "date")
    filled = joined.withColumns({c: F.coalesce(forward_fill(F.col(c), w), F.lit(0.0)) for c in ("cml_units", "cml_cost", "gain_loss")})
    filled = filled.withColumn("cashflow", running_sum(F.coalesce(F.col("cashflow"), F.lit(0.0)), w))
    return filled.withColumns({"avg_price": F.round(safe_div(F.col("cml_cost"), F.col("cml_units")), 3), "mktvalue": F.round(F.col("cml_units") * F.col("adj_close"), 3)})


def portfolio_value(valuation: DataFrame, index: DataFrame) -> DataFrame:
    """Total market value per day next to an index, both with their daily change in percent."""
    total = valuation.groupBy("date").agg(F.sum(F.coalesce(F.col("mktvalue"), F.lit(0.0))).alias("portf_value"))
    joined = total.join(index.select("date", F.col("adj_close").alias("index_value")), "date")
    w = by([F.lit(0)], "date")  # one row per day

    def change(c: str):
        return F.round((safe_div(F.col(c), F.lag(c).over(w)) - 1) * 100, 2)

    return joined.withColumns({"portf_value_pctch": change("portf_value"), "index_value_pctch": change("index_value")})


def current_positions(trades: DataFrame, last_prices: DataFrame, sectors: DataFrame) -> DataFrame:
    """Open positions with unrealised value and percent, weight in the book."""
    at = F.struct("date", "seq")
    last = trades.groupBy("ticker").agg(F.max_by("cml_units", at).alias("units"), F.max_by("cml_cost", at).alias("cost"), F.sum("gain_loss").alias("realised"))
    held = last.where(F.col("units") > 0).join(last_prices, "ticker").join(sectors, "ticker", "left")
    valued = held.withColumn("mktvalue", F.round(F.col("units") * F.col("adj_close"), 2))
    valued = valued.withColumns({"unrealised": F.round(F.col("mktvalue") - F.col("cost"), 2), "unrealised_pct": F.round(safe_div(F.col("mktvalue") - F.col("cost"), F.col("cost")) * 100, 2)})
    total = F.broadcast(valued.agg(F.sum("mktvalue").alias("_TOTAL")))  # one row
    return valued.join(total).withColumn("weight", F.round(safe_div(F.col("mktvalue"), F.col("_TOTAL")) * 100, 4)).drop("_TOTAL")


def sector_rollup(positions_now: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Market value, cost and weight by sector levels with subtotals (null level = subtotal)."""
    return positions_now.rollup(*levels).agg(F.round(F.sum("mktvalue"), 2).alias("mktvalue"), F.round(F.sum("cost"), 2).alias("cost"), F.round(F.sum("weight"), 3).alias("weight"), F.count(F.lit(1)).alias("n"))
