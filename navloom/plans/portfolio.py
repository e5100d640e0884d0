"""Portfolio roll-forward, contribution, turnover, limits and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from navloom.functions.exprs import map_values, safe_div
from navloom.functions.series import by, moving_mean, upto
from navloom.operators import ranks
from navloom.operators.aggregates import conditional_sums, listed, union_all
from navloom.operators.joins import full_outer_fill, spread
from navloom.session import broadcast_checked

P, T, DAY = "PORTFOLIO_NAME", "TICKER_SYMBOL", "TRADE_DT"


def delayed_valuation(nav: DataFrame, funds: DataFrame, days: DataFrame) -> DataFrame:
    """NAV used on each trading day: funds flagged ``DELAYED`` are valued with the previous trading day.

    One equi-join on the NAV date: every calendar day offers its own date to prompt funds and the previous one to delayed funds.
    """
    offers = days.select("TRADE_DT", F.inline(F.array(F.struct(F.lit(False).alias("DELAYED"), F.col("TRADE_DT").alias("END_DATE")), F.struct(F.lit(True).alias("DELAYED"), F.col("PREV_TRADE_DATE").alias("END_DATE")))))
    return nav.join(funds, "TICKER_SYMBOL").join(offers, ["DELAYED", "END_DATE"])


# --- roll forward ---


def rebalance_periods(targets: DataFrame, keys: Sequence[str] = (P,)) -> DataFrame:
    """``keys, PERIOD_START, NEXT_START``: a rebalance of a portfolio replaces all of its holdings."""
    starts = targets.select(*keys, F.col(DAY).alias("PERIOD_START")).distinct()
    return starts.withColumn("NEXT_START", F.lead("PERIOD_START").over(by(keys, "PERIOD_START")))


def drifted_weights(targets: DataFrame, returns: DataFrame, trading_days: DataFrame, keys: Sequence[str] = (P,)) -> DataFrame:
    """Start and end weight of every holding on every trading day.

    Between two rebalances the weight before the day is ``w0 * product(1 + r) / sum`` over the days so far, so no day-by-day loop
    is needed.  A missing return counts as 0.  ``targets``: ``keys, TRADE_DT, TICKER_SYMBOL, WEIGHT`` (sums to 100);
    ``returns``: ``TICKER_SYMBOL, TRADE_DT, RETURN_RATE`` in percent; rebalance dates are trading days.
    """
    keys = list(keys)
    days = trading_days.select(DAY)
    last = F.broadcast(days.agg(F.max(DAY).alias("_LAST")))  # one row
    held = targets.withColumnRenamed(DAY, "PERIOD_START").join(rebalance_periods(targets, keys), [*keys, "PERIOD_START"]).join(last)
    until = F.coalesce(F.date_sub("NEXT_START", 1), F.col("_LAST"))
    daily = spread(held.where(F.col("PERIOD_START") <= F.col("_LAST")), *keys, T).select(
        *keys, T, "PERIOD_START", "WEIGHT", F.explode(F.sequence("PERIOD_START", until, F.expr("INTERVAL 1 DAY"))).alias(DAY)
    )
    daily = daily.join(days, DAY, "left_semi").join(returns.select(T, DAY, "RETURN_RATE"), [T, DAY], "left").fillna({"RETURN_RATE": 0.0})
    w = by([*keys, "PERIOD_START", T], DAY)
    grown = F.col("WEIGHT") * F.product(1 + F.col("RETURN_RATE") / 100).over(upto(w))
    daily = daily.withColumn("_G1", grown)
    daily = daily.withColumn("_G0", F.coalesce(F.lag("_G1").over(w), F.col("WEIGHT")))
    book = Window.partitionBy(*keys, DAY)  # the holdings of one portfolio on one day
    out = daily.withColumns({"_S0": F.sum("_G0").over(book), "_S1": F.sum("_G1").over(book)})
    first = F.col(DAY) == F.col("PERIOD_START")
    start = F.when(first, F.col("WEIGHT")).otherwise(F.col("_G0") / F.col("_S0") * 100)
    return out.select(
        *keys,
        DAY,
        T,
        "PERIOD_START",
        start.alias("START_WEIGHT"),
        "RETURN_RATE",
        (F.log1p(F.col("RETURN_RATE") / 100) * 100).alias("LOG_RETURN"),
        (start * F.col("RETURN_RATE") / 100).alias("WEIGHT_RETURN"),
        (F.col("_G1") / F.col("_S1") * 100).alias("END_WEIGHT"),
    )


def daily_returns(weights: DataFrame, keys: Sequence[str] = (P,)) -> DataFrame:
    """Portfolio return and log return per day, in percent."""
    total = weights.groupBy(*keys, DAY).agg(F.sum("WEIGHT_RETURN").alias("RETURN_RATE"))
    return total.withColumn("LOG_RETURN_RATE", F.log1p(F.col("RETURN_RATE") / 100) * 100)


def blended_benchmark(mix: DataFrame, index_ret: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Weighted index return per portfolio, day and benchmark type, types as columns (missing = 0).

    ``mix``: ``PORTFOLIO_NAME, BENCHMARK_CODE, BENCHMARK_TYPE, WEIGHT``; ``kinds`` maps a type to its column.
    """
    joined = mix.join(index_ret.select(F.col(T).alias("BENCHMARK_CODE"), DAY, "RETURN_RATE"), "BENCHMARK_CODE")
    out = conditional_sums(joined.withColumn("_R", F.col("WEIGHT") * F.col("RETURN_RATE") / 100), [DAY, P], "BENCHMARK_TYPE", "_R", list(kinds))
    return out.withColumnsRenamed(dict(kinds))


def accumulated(returns: DataFrame, columns: Mapping[str, str], listed: DataFrame, keys: Sequence[str] = (P,)) -> DataFrame:
    """Compounded return since listing; the listing day itself is a row of zeros.

    ``listed``: ``keys, LISTED_DATE``; ``columns`` maps a return column to its accumulated column, all in percent.
    """
    after = returns.join(listed, list(keys)).where(F.col(DAY) > F.col("LISTED_DATE")).select(*keys, DAY, *columns)
    zero = listed.select(*keys, F.col("LISTED_DATE").alias(DAY), *[F.lit(0.0).alias(c) for c in columns])
    rows = after.unionByName(zero)
    w = upto(by(list(keys), DAY))
    return rows.withColumns({out: (F.product(1 + F.coalesce(F.col(c), F.lit(0.0)) / 100).over(w) - 1) * 100 for c, out in columns.items()})


def backtest(targets: DataFrame, returns: DataFrame, trading_days: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Many test codes at once: daily return, accumulated NAV of portfolio and benchmark, excess."""
    keys = ["TEST_CODE", P]
    ret = daily_returns(drifted_weights(targets, returns, trading_days, keys), keys)
    joined = ret.join(benchmark.select(DAY, F.col("RETURN_RATE").alias("BENCH_RET")), DAY, "left").fillna({"BENCH_RET": 0.0})
    w = upto(by(keys, DAY))
    nav = joined.withColumns({"NAV": F.product(1 + F.col("RETURN_RATE") / 100).over(w), "BENCH_NAV": F.product(1 + F.col("BENCH_RET") / 100).over(w)})
    return nav.withColumn("ALPHA", (F.col("NAV") - F.col("BENCH_NAV")) * 100)


# --- contribution ---


def period_contribution(weights: DataFrame, alpha: DataFrame | None = None) -> DataFrame:
    """Per portfolio, rebalance period and holding: start and end weight, linked return, contribution (percent).

    ``alpha``: ``TICKER_SYMBOL, TRADE_DT, LOG_ALPHA`` adds the same for the excess return.
    """
    rows = weights if alpha is None else weights.join(alpha.select(T, DAY, "LOG_ALPHA"), [T, DAY], "left")
    group = [P, T, "PERIOD_START"]
    aggs = [
        F.min(DAY).alias("START_TRADE_DT"),
        F.max(DAY).alias("END_TRADE_DT"),
        F.min_by("START_WEIGHT", DAY).alias("START_WEIGHT"),
        F.max_by("END_WEIGHT", DAY).alias("END_WEIGHT"),
        ((F.exp(F.sum("LOG_RETURN") / 100) - 1) * 100).alias("SUM_PERIOD_RETURN"),
    ]
    if alpha is not None:
        aggs.append(((F.exp(F.sum(F.coalesce("LOG_ALPHA", F.lit(0.0))) / 100) - 1) * 100).alias("SUM_PERIOD_ALPHA"))
    out = rows.groupBy(*group).agg(*aggs)
    parts = {"PERIOD_RETURN_CONTRIBUTION": "SUM_PERIOD_RETURN"} | ({} if alpha is None else {"PERIOD_ALPHA_CONTRIBUTION": "SUM_PERIOD_ALPHA"})
    return out.withColumns({c: F.col("START_WEIGHT") * F.col(r) / 100 for c, r in parts.items()})


def linked_contribution(periods: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Link the periods of each holding by product, add the share of the portfolio total."""
    linked = periods.groupBy(P, T).agg(*[((F.product(1 + F.col(c) / 100) - 1) * 100).alias(c) for c in columns])
    shares = [c for c in columns if c.endswith("CONTRIBUTION")]
    totals = linked.groupBy(P).agg(*[F.sum(c).alias(f"_{c}") for c in shares])
    return linked.join(totals, P).withColumns({f"{c}_PCT": safe_div(F.col(c), F.col(f"_{c}")) * 100 for c in shares}).drop(*[f"_{c}" for c in shares])


def contribution_rollup(linked: DataFrame, classes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums by portfolio, class and fund, with subtotals (``ALL``)."""
    joined = linked.join(classes.select(T, "CLASS"), T, "left").fillna("-", ["CLASS"])
    sums = joined.rollup(P, "CLASS", T).agg(*[F.sum(c).alias(c) for c in columns])
    return sums.fillna("ALL", ["CLASS", T]).where(F.col(P).isNotNull())


# --- turnover ---


def turnover(weights: DataFrame, cal: DataFrame) -> DataFrame:
    """Half the absolute change between the drifted weights of the day before and the new ones, on each rebalance date."""
    first = weights.where(F.col(DAY) == F.col("PERIOD_START")).select(P, T, DAY, F.col("START_WEIGHT").alias("NEW_WEIGHT"))
    starts = first.select(P, DAY).distinct().join(cal.select(DAY, "PREV_TRADE_DATE"), DAY)
    before = weights.select(P, T, F.col(DAY).alias("PREV_TRADE_DATE"), F.col("END_WEIGHT").alias("OLD_WEIGHT"))
    old = starts.join(before, [P, "PREV_TRADE_DATE"]).select(P, T, DAY, "OLD_WEIGHT")
    known = old.select(P, DAY).distinct()  # the first target of a portfolio has nothing to compare with
    joined = full_outer_fill(first.join(known, [P, DAY], "left_semi"), old, [P, T, DAY], {"NEW_WEIGHT": 0.0, "OLD_WEIGHT": 0.0})
    return joined.groupBy(P, DAY).agg((F.sum(F.abs(F.col("NEW_WEIGHT") - F.col("OLD_WEIGHT"))) / 2).alias("TURNOVER"))


def turnover_between(turnovers: DataFrame, start: Column, end: Column) -> DataFrame:
    return turnovers.where((F.col(DAY) > start) & (F.col(DAY) <= end)).groupBy(P).agg(F.sum("TURNOVER").alias("TURNOVER"))


def proposed_turnover(proposed: DataFrame, current: DataFrame) -> DataFrame:
    """Turnover of a proposal against the current holdings, for the portfolios that have a proposal."""
    keys = [P, T]
    now = current.join(proposed.select(P).distinct(), P, "left_semi").select(*keys, F.col("WEIGHT").alias("OLD_WEIGHT"))
    joined = full_outer_fill(proposed.select(*keys, F.col("WEIGHT").alias("NEW_WEIGHT")), now, keys, {"NEW_WEIGHT": 0.0, "OLD_WEIGHT": 0.0})
    return joined.groupBy(P).agg((F.sum(F.abs(F.col("NEW_WEIGHT") - F.col("OLD_WEIGHT"))) / 2).alias("TURNOVER"))


# --- peers and reports ---

# fixed values: measures of the peer table, those where a small value is good, and their report names
PEER_MEASURES = ["CUM_RETURN", "ANNUAL_RETURN", "ANNUAL_VOLATILITY", "SHARP_RATIO_ANNUAL", "CALMAR_RATIO_ANNUAL", "MAXDD"]
PEER_LOW = ["MAXDD", "ANNUAL_VOLATILITY"]
MEASURE_NAMES = {
    "CUM_RETURN": "累计收益率", "ANNUAL_RETURN": "年化收益率", "ANNUAL_VOLATILITY": "年化波动率",
    "SHARP_RATIO_ANNUAL": "收益波动比", "CALMAR_RATIO_ANNUAL": "年化收益回撤比", "MAXDD": "最大回撤",
}


def measure_rows(stats: DataFrame, name: str = "PORTFOLIO_VALUE") -> DataFrame:
    return stats.unpivot([T, "START_DATE", "END_DATE"], PEER_MEASURES, "INDICATOR", name)


def peer_table(own: DataFrame, peers: DataFrame, windows: DataFrame, benchmarks: Mapping[str, DataFrame]) -> DataFrame:
    """Every portfolio among its peers, with peer median, benchmark values and the window labels.

    ``own``: statistics of the portfolios (``TICKER_SYMBOL`` is the portfolio); ``peers``: statistics of funds tagged with the
    portfolio they are compared to; ``benchmarks`` maps a value column to statistics keyed by portfolio name.
    """
    key = [P, "START_DATE", "END_DATE", "INDICATOR"]
    mine = measure_rows(own).withColumn(P, F.col(T))
    others = peers.unpivot([T, P, "START_DATE", "END_DATE"], PEER_MEASURES, "INDICATOR", "PORTFOLIO_VALUE")
    median = ranks.quantiles(others, key, "PORTFOLIO_VALUE", {"PEER_MEDIAN": 0.5})
    rows = mine.unionByName(others)
    signed = rows.withColumn("_V", F.when(F.col("INDICATOR").isin(PEER_LOW), -F.col("PORTFOLIO_VALUE")).otherwise(F.col("PORTFOLIO_VALUE")))
    ranked = ranks.peer_rank(signed, "_V", key, pct="PEER_RANK_PCT", text="PEER_RANK").drop("_V").where(F.col(T) == F.col(P))
    out = ranked.join(median, key, "left")
    for column, stats in benchmarks.items():
        out = out.join(measure_rows(stats, column), [T, "START_DATE", "END_DATE", "INDICATOR"], "left")
    labels = windows.select(F.col("PORTFOLIO_NAME").alias("_FLAG"), F.col("DATE_NAME").alias("CYCLE"), "START_DATE", "END_DATE")
    named = out.join(labels, ["START_DATE", "END_DATE"]).where((F.col("_FLAG") == "ALL") | (F.col("_FLAG") == F.col(P)))
    named = named.withColumn("INDICATOR", map_values(F.col("INDICATOR"), MEASURE_NAMES))
    return named.where(F.col("PORTFOLIO_VALUE").isNotNull()).drop("_FLAG", P)


def daily_sheet(acc: DataFrame, named: DataFrame, info: DataFrame, cycles: Sequence[str], day: Column, prev_day: Column) -> DataFrame:
    """One line per portfolio alive on the day: return per cycle, drawdown since listing, new-high flag.

    Portfolios with overseas funds are shown as of the previous trading day.  ``named``: ``PORTFOLIO_NAME, END_DATE, CYCLE,
    CUM_RETURN, MAXDD``; ``acc``: accumulated returns; ``info``: ``PORTFOLIO_NAME, LISTED_DATE, DELISTED_DATE, INCLUDE_QDII, ORDER_ID``.
    """
    shown = info.withColumn("END_DATE", F.when(F.col("INCLUDE_QDII") == 1, prev_day).otherwise(day))
    alive = shown.where((F.col("LISTED_DATE") <= F.col("END_DATE")) & (F.coalesce("DELISTED_DATE", F.to_date(F.lit("2099-12-31"))) >= F.col("END_DATE")))
    cells = named.join(alive.select(P, "END_DATE"), [P, "END_DATE"])
    wide = cells.groupBy(P, "END_DATE").agg(*[F.max(F.when(F.col("CYCLE") == c, F.col("CUM_RETURN"))).alias(c) for c in cycles], F.max(F.when(F.col("CYCLE") == "成立日", F.col("MAXDD"))).alias("最大回撤"))
    past = acc.join(alive.select(P, "END_DATE", "LISTED_DATE"), P).where((F.col(DAY) >= F.col("LISTED_DATE")) & (F.col(DAY) <= F.col("END_DATE")))
    high = past.groupBy(P).agg(F.max("ACCUMULATED").alias("_HIGH"), F.max_by("ACCUMULATED", DAY).alias("_NOW"))
    flag = F.when(F.col("_NOW") >= F.col("_HIGH"), "是").otherwise("否")
    return wide.join(high, P).join(alive.select(P, "LISTED_DATE", "ORDER_ID"), P).select(P, "END_DATE", "LISTED_DATE", *cycles, "最大回撤", flag.alias("是否新高"))


def holding_returns(holdings: DataFrame, returns: DataFrame) -> DataFrame:
    """Return of each held fund with the list of the portfolios that hold it."""
    held = holdings.select(T, P).distinct().groupBy(T).agg(listed(P).alias("PORTFOLIOS"))
    return returns.join(held, T)


def purchase_limits(holdings: DataFrame, products: DataFrame) -> DataFrame:
    """Largest daily purchase and smallest first purchase the holdings allow, and the weighted redemption fee.

    With an alternative fund the limit of the main fund is enough when it is the larger one, else both add up; individuals and
    institutions each use their own columns.  ``products``: ``TICKER_SYMBOL, MAX_IND, MAX_INST, FIRST_BUY, DELAY_DATE, FEE_7D``.
    """
    alt = products.select(F.col(T).alias("ALTERNATIVE"), F.col("MAX_IND").alias("_ALT_IND"), F.col("MAX_INST").alias("_ALT_INST"))
    rows = holdings.join(products, T).join(alt, "ALTERNATIVE", "left")

    def with_alternative(main: str, other: str) -> Column:
        return F.when(F.col(main) >= F.coalesce(F.col(other), F.lit(0.0)), F.col(main)).otherwise(F.col(main) + F.col(other))

    def limit(x: Column) -> Column:
        return F.round(F.min(safe_div(x, F.col("WEIGHT")) * 100) / 10000, 2)

    return rows.groupBy(P).agg(
        limit(F.col("MAX_IND")).alias("DAILY_INDIVIDUAL"),
        limit(F.col("MAX_INST")).alias("DAILY_INSTITUTION"),
        limit(with_alternative("MAX_IND", "_ALT_IND")).alias("DAILY_INDIVIDUAL_ALT"),
        limit(with_alternative("MAX_INST", "_ALT_INST")).alias("DAILY_INSTITUTION_ALT"),
        F.round(F.max(safe_div(F.col("FIRST_BUY"), F.col("WEIGHT")) * 100), 2).alias("FIRST_BUY"),
        F.max("DELAY_DATE").alias("DELAY_DATE"),
        F.round(F.sum(F.col("WEIGHT") * F.col("FEE_7D")) / 100, 2).alias("FEE_7D"),
    )


def fee_income(holdings: DataFrame, products: DataFrame, info: DataFrame) -> DataFrame:
    """Income and cost of each portfolio from fee shares above the smallest share of all pooled products.

    ``products``: ``TICKER_SYMBOL, SHARE_IND, SHARE_INST, MANAGEMENT_FEE, SALE_FEE, IF_IN_TRANCHE``; ``info``:
    ``PORTFOLIO_NAME, PORTFOLIO_MANAGEMENT_FEE``.
    """
    floor = F.broadcast(products.where("IF_IN_TRANCHE = 1").agg(F.min("SHARE_IND").alias("MIN_IND"), F.min("SHARE_INST").alias("MIN_INST")))  # one row
    rows = holdings.join(products, T).join(floor)
    w, fee = F.col("WEIGHT"), F.col("MANAGEMENT_FEE")
    sums = rows.groupBy(P, "MIN_IND", "MIN_INST").agg(
        F.round(F.sum(w * (F.col("SHARE_IND") - F.col("MIN_IND")) * fee / 10000), 4).alias("OFFSET_IND"),
        F.round(F.sum(w * (F.col("SHARE_INST") - F.col("MIN_INST")) * fee / 10000), 4).alias("OFFSET_INST"),
        F.round(F.sum(w * F.col("MIN_IND") * fee / 10000), 4).alias("INCOME_IND"),
        F.round(F.sum(w * F.col("MIN_INST") * fee / 10000), 4).alias("INCOME_INST"),
        F.round(F.sum(w * F.col("SALE_FEE") / 100), 4).alias("SALE_INCOME"),
    )
    base = F.col("PORTFOLIO_MANAGEMENT_FEE")
    return sums.join(info, P).withColumns(
        {
            "TOTAL_IND": base + F.col("INCOME_IND") + F.col("SALE_INCOME"),
            "TOTAL_INST": base + F.col("INCOME_INST") + F.col("SALE_INCOME"),
            "COST_IND": base - F.col("OFFSET_IND"),
            "COST_INST": base - F.col("OFFSET_INST"),
        }
    )


def stock_share(temperature: Column) -> Column:
    """Half in stocks between 30 and 70 degrees; 5 points more (less) for each 5 degrees begun below (above)."""
    low, high = F.ceil((30 - temperature) / 5) * 0.05, F.ceil((temperature - 70) / 5) * 0.05
    return F.when((temperature > 30) & (temperature < 70), 0.5).when(temperature < 30, 0.5 + low).otherwise(0.5 - high)


def temperature_allocation(signals: DataFrame, returns: DataFrame) -> DataFrame:
    """Rule-based mix of stocks, cash and bond-plus, held from the next date on.

    ``signals``: ``TRADE_DT, STOCK_TEMPERATURE, BOND_TEMPERATURE``; ``returns``: ``TRADE_DT, STOCK, CASH, BOND_PLUS`` (fractions).
    """
    stock = F.col("STOCK_SHARE")
    hot_bonds = F.col("BOND_TEMPERATURE") > 90
    rows = signals.withColumn("STOCK_SHARE", stock_share(F.col("STOCK_TEMPERATURE")))
    cash = F.when((F.col("STOCK_TEMPERATURE") > 70) & hot_bonds, 1 - stock).when(hot_bonds, (1 - stock) * 0.5).otherwise(0.0)
    rows = rows.withColumn("CASH_SHARE", cash).withColumn("BOND_PLUS_SHARE", 1 - F.col("CASH_SHARE") - stock).join(returns, DAY)
    w = by([F.lit(0)], DAY)  # one row per period end
    earned = sum((F.coalesce(F.lag(f"{a}_SHARE").over(w), F.lit(0.0)) * F.col(a) for a in ("CASH", "STOCK", "BOND_PLUS")), F.lit(0.0))
    rows = rows.withColumn("PORTFOLIO", earned)
    return rows.withColumns({"NAV": F.product(1 + F.col("PORTFOLIO")).over(upto(w)), "STOCK_NAV": F.product(1 + F.col("STOCK")).over(upto(w))})


# fixed values: trade types of the order-flow summary
BUY_TYPES = ["首次签约", "追加投资", "定投", "预约购买", "份额追加投资"]
REDEEM_TYPES = ["减少投资", "解约"]


def order_flow(orders: DataFrame, keys: Sequence[str], blocked: Sequence[str] = (), minimum: float = 0.0) -> DataFrame:
    """Purchases per group in units of 10,000, without blocked portfolios, from ``minimum`` up."""
    kept = orders.where(F.col("TRADE_TYPE").isin(BUY_TYPES))
    kept = kept.where(~F.col(P).isin(list(blocked))) if blocked else kept
    return kept.groupBy(*keys).agg((F.sum("AMOUNT") / 10000).alias("AMOUNT")).where(F.col("AMOUNT") >= minimum)


def redemptions(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("TRADE_TYPE").isin(REDEEM_TYPES)).groupBy(P).agg((F.sum("AMOUNT") / 10000).alias("AMOUNT"))


def product_sheet(nav: DataFrame, assets: DataFrame, stats: DataFrame, level_ranks: DataFrame, level_of: DataFrame, cycles: Sequence[str]) -> DataFrame:
    """Latest NAV and assets of each product, return per cycle and its rank at the level chosen for its class.

    ``stats``: ``TICKER_SYMBOL, DATE_NAME, CUM_RETURN`` on the sheet's date; ``level_ranks``: ``TICKER_SYMBOL, LEVEL, DATE_NAME, RANK``;
    ``level_of``: ``TICKER_SYMBOL, LEVEL``.
    """
    last = nav.groupBy(T).agg(F.max("END_DATE").alias("END_DATE"), F.max_by("NAV", "END_DATE").alias("NAV"))
    asset = assets.groupBy(T).agg(F.max_by("NET_ASSET", "REPORT_DATE").alias("NET_ASSET"))
    wide = stats.groupBy(T).agg(*[F.max(F.when(F.col("DATE_NAME") == c, F.col("CUM_RETURN"))).alias(c) for c in cycles])
    chosen = level_ranks.join(level_of, [T, "LEVEL"], "left_semi")
    ranked = chosen.groupBy(T).agg(*[F.max(F.when(F.col("DATE_NAME") == c, F.col("RANK"))).alias(f"{c}_排名") for c in cycles])
    return last.join(asset, T, "left").join(wide, T, "left").join(ranked, T, "left")


def event_monitor(events: DataFrame, holdings: DataFrame, since: Column) -> DataFrame:
    """Events since a day on funds that are held, with the portfolios that hold them."""
    held = holdings.select(T, P).distinct().groupBy(T).agg(listed(P).alias("PORTFOLIOS"))
    return events.where(F.col("EVENT_DATE") >= since).join(held, T)


def money_flow(markets: Sequence[DataFrame], latest: int = 5) -> DataFrame:
    """Net inflow per day over all markets with its 5, 20 and 60-row means; the latest days only."""
    day = union_all(markets).groupBy("END_DATE").agg(F.sum("NET").alias("NET"))
    w = by([F.lit(0)], "END_DATE")  # one row per day
    means = day.withColumns({f"MA{n}": moving_mean(F.col("NET"), w, n) for n in (5, 20, 60)})
    return means.orderBy(F.desc("END_DATE")).limit(latest)


def valid_windows(windows: DataFrame, info: DataFrame) -> DataFrame:
    """Window names each portfolio can show: its own or general ones that start on or after its listing; not the one-day window."""
    own = windows.where("DATE_NAME <> '近1日'").withColumnRenamed(P, "_OWNER")
    shared = own.where("_OWNER = 'ALL'").drop("_OWNER")
    small = broadcast_checked(shared)  # horizons x end dates
    general = info.select(P, "LISTED_DATE").join(shared if small is None else small, F.col("START_DATE") >= F.col("LISTED_DATE"))
    special = own.where("_OWNER <> 'ALL'").join(info.select(F.col(P).alias("_OWNER"), "LISTED_DATE"), "_OWNER").where("START_DATE >= LISTED_DATE")
    cols = [P, "DATE_NAME", "START_DATE", "END_DATE"]
    return general.select(*cols).unionByName(special.withColumnRenamed("_OWNER", P).select(*cols))


def report_with_older_rank(report: DataFrame, older: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report of the day with the rank that was known two trading days before."""
    return report.join(older.select(*keys, F.col("RANK").alias("OLDER_RANK"), F.col("END_DATE").alias("RANK_DATE")), list(keys), "left")


def rebalance_dates(targets: DataFrame, start: Column, end: Column) -> DataFrame:
    return targets.where((F.col(DAY) > start) & (F.col(DAY) <= end)).select(P, DAY).distinct()

