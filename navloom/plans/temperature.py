"""Valuation temperature of stock indices and bond curves."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.functions.exprs import safe_div
from navloom.operators import ranks


def valuation_spreads(valuation: DataFrame, curve: DataFrame) -> DataFrame:
    """Equity risk premium and dividend spread against the government yield (percent), as difference and as quotient."""
    joined = valuation.join(curve.select("TRADE_DT", (F.col("YIELD") / 100).alias("_Y")), "TRADE_DT")
    inverse = safe_div(F.lit(1.0), F.col("PE_TTM"))
    return joined.withColumns(
        {
            "ERP_MINUS": (inverse - F.col("_Y")) * 100,
            "ERP_DIV": safe_div(inverse, F.col("_Y")),
            "DIVIDEND_SPREAD_MINUS": F.col("DIVIDEND_YIELD") - F.col("_Y") * 100,
            "DIVIDEND_SPREAD_DIV": safe_div(F.col("DIVIDEND_YIELD"), F.col("_Y")) / 100,
        }
    ).drop("_Y")


RANKED = {"PE_TTM": "PE_PCT_RANK", "ERP_MINUS": "ERP_PCT_RANK", "DIVIDEND_YIELD": "DIVIDEND_YIELD_RANK", "PB_LF": "PB_RANK", "DIVIDEND_SPREAD_MINUS": "DIVIDEND_SPREAD_RANK"}


def stock_temperature(spreads: DataFrame, start: str, end: str) -> DataFrame:
    """Percent rank of each measure in the index's own history since ``start``; temperature = (PE rank + 100 - premium rank) / 2.

    The history of one index is one row per day, a bounded group.
    """
    rows = spreads.where(F.col("TRADE_DT").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    for column, out in RANKED.items():
        rows = ranks.percent_rank(rows, column, ["TICKER_SYMBOL"], out, bounded=True)
    rows = rows.withColumns({out: F.round(F.col(out) * 100, 6) if out == "PE_PCT_RANK" else F.round(F.col(out), 6) * 100 for out in RANKED.values()})
    first = spreads.where(F.col("TRADE_DT") >= F.to_date(F.lit(start))).groupBy("TICKER_SYMBOL").agg(F.min("TRADE_DT").alias("START_DATE"))
    heat = F.round((F.col("PE_PCT_RANK") + 100 - F.col("ERP_PCT_RANK")) / 2, 6)
    return rows.join(first, "TICKER_SYMBOL").select(F.col("TRADE_DT").alias("END_DATE"), "START_DATE", "TICKER_SYMBOL", *RANKED.values(), heat.alias("TEMPERATURE"))


def bond_temperature(yields: DataFrame, government: str, rows: int = 850) -> DataFrame:
    """Credit spread over the government curve and the mean of two rolling ranks, per curve (and term)."""
    base = yields.where(F.col("CURVE") == government).select("END_DATE", "TERM", F.col("YIELD").alias("GOVERNMENT_BOND_YIELD"))
    joined = yields.join(base, ["END_DATE", "TERM"]).withColumn("CREDIT_SPREAD", F.round(F.col("YIELD") - F.col("GOVERNMENT_BOND_YIELD"), 6))
    names = {"YIELD": "YIELD_RANK_PCT", "CREDIT_SPREAD": "CREDIT_SPREAD_RANK_PCT"}
    ranked = ranks.rolling_ranks(joined, names, ["CURVE", "TERM"], "END_DATE", rows)
    ranked = ranked.withColumns({c: F.col(c) * 100 for c in names.values()})
    return ranked.withColumn("TEMPERATURE", (F.col("YIELD_RANK_PCT") + F.col("CREDIT_SPREAD_RANK_PCT")) / 2)


# fixed values: holding periods in days, and the unit codes of a fee rule (1 year, 2 month, 3 day)
HOLDING_DAYS = [1, 7, 30, 60, 90, 180, 270, 365, 730, 1095, 1460]
YEAR, MONTH, DAY = 1, 2, 3


def redemption_fee_ladder(fees: DataFrame) -> DataFrame:
    """Highest redemption fee per fund and holding period, one column per period.

    ``fees``: ``TICKER_SYMBOL, UNIT, START, END, RATE``; an open bound or unit is null.  Each rule is tested against every
    holding period in the rule's own unit.
    """
    probes = [(d, unit, float(v)) for d in HOLDING_DAYS for unit, v in ((YEAR, d / 365), (MONTH, (d + 1) // 30), (DAY, d + 2))]
    tests = F.array(*[F.struct(F.lit(d).alias("DAYS"), F.lit(u).alias("_UNIT"), F.lit(v).alias("_AT")) for d, u, v in probes])
    long = fees.select("TICKER_SYMBOL", "UNIT", "START", "END", "RATE", F.inline(tests))
    conditions = [F.col("UNIT").isNull() | (F.col("UNIT") == F.col("_UNIT")), F.col("START").isNull() | (F.col("START") <= F.col("_AT")), F.col("END").isNull() | (F.col("END") > F.col("_AT"))]
    hit = long.where(reduce(lambda a, b: a & b, conditions))
    return hit.groupBy("TICKER_SYMBOL").agg(*[F.max(F.when(F.col("DAYS") == d, F.col("RATE"))).alias(f"{d}d") for d in HOLDING_DAYS])
