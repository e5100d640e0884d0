"""Holdings: industry and sector exposure, popularity, crowding, concentration, style."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from navloom.functions.exprs import safe_div
from navloom.functions.series import by, moving_mean
from navloom.operators import ranks
from navloom.operators.aggregates import ALL, grouping_sets, level_grouping_sets, share_of, union_all
from navloom.operators.joins import align_to_trading_day, interval_join, spread
from navloom.operators.packs import coded, half_up, mean_rank_fraction, numbered, pack, unpacked
from navloom.session import cut_lineage

REPORT, FUND, HELD, MV = "REPORT_DATE", "FUND_ID", "HOLDING_TICKER_SYMBOL", "MARKET_VALUE"


def industry_exposure(holdings: DataFrame, membership: DataFrame, equity: DataFrame) -> DataFrame:
    """Market value per fund, report, industry level and industry, its share of equity and of the held total.

    ``membership``: ``TICKER_SYMBOL, LEVEL_NUM, INDUSTRY_NAME, ENTRY_DT, REMOVE_DT``; ``equity``: ``REPORT_DATE, FUND_ID,
    EQUITY_MARKET_VALUE``.
    """
    held = holdings.select(REPORT, FUND, F.col(HELD).alias("TICKER_SYMBOL"), MV)
    members = membership.select("TICKER_SYMBOL", "LEVEL_NUM", "INDUSTRY_NAME", "ENTRY_DT", "REMOVE_DT")
    joined = interval_join(held, members, "TICKER_SYMBOL", REPORT, "ENTRY_DT", "REMOVE_DT")
    sums = joined.groupBy(REPORT, FUND, "LEVEL_NUM", "INDUSTRY_NAME").agg(F.sum(MV).alias(MV))
    out = sums.join(equity, [REPORT, FUND]).withColumn("INDUSTRY_RATIO_IN_EQUITY", safe_div(F.col(MV), F.col("EQUITY_MARKET_VALUE")) * 100)
    out = share_of(out, [REPORT, FUND, "LEVEL_NUM"], MV, "_SHARE").withColumn("INDUSTRY_RATIO_IN_TOP10", F.col("_SHARE") * 100)
    return out.drop("_SHARE", "EQUITY_MARKET_VALUE")


def top_holdings(holdings: DataFrame, k: int = 10) -> DataFrame:
    """The k largest holdings of each report with their serial number."""
    return ranks.row_numbers(holdings, [REPORT, FUND], [-F.col(MV), F.col(HELD)], "HOLDING_NUM").where(F.col("HOLDING_NUM") <= k)


def sector_exposure(industries: DataFrame, sectors: DataFrame, values: Sequence[str]) -> DataFrame:
    """Industry rows mapped to sectors and summed."""
    return industries.join(sectors, "INDUSTRY_NAME").groupBy(REPORT, FUND, "SECTOR").agg(*[F.sum(v).alias(v) for v in values])


COLUMNS = ["LEVEL_1", "LEVEL_2", "LEVEL_3", "COMPANY", "INDUSTRY_NAME"]
POPULARITY_SETS = level_grouping_sets(COLUMNS[:3], COLUMNS[3:])
TASK_ROWS = 1_000_000  # rows of all groupings that one task adds up or ranks
GROUP_ROWS = 4_000_000  # holdings that one task has as plain arrays; larger groups are ranked in blocks
CLASS_ROWS = 500_000  # funds with their classes that travel to the holdings


def popularity(holdings: DataFrame, classes: DataFrame, sets: Sequence[Sequence[str]] = POPULARITY_SETS, block_rows: int = GROUP_ROWS) -> DataFrame:
    """How many funds hold a stock and for how much, over class, company and industry groupings, with percentile scores.

    ``classes``: ``FUND_ID, LEVEL_1, LEVEL_2, LEVEL_3, COMPANY``; holdings carry ``INDUSTRY_NAME`` and ``MARKET_VALUE`` (double); ``sets``: the
    groupings asked for, by default all sixteen.  The holdings are packed once by report and first level and stored so, in a few bytes each.
    The packs of a report and first level meet for the groupings with that level, those of a report for the others, so a holding travels
    twice, not once for each grouping, and the rows of the result do not travel at all.  Groupings whose packs would hold more than ``block_rows``
    holdings at once are ranked natively, in blocks if need be.
    """
    known = classes.limit(CLASS_ROWS + 1).count()
    joined = holdings.join(F.broadcast(classes) if known <= CLASS_ROWS else classes, FUND).select(REPORT, HELD, *COLUMNS, F.col(MV).cast("double").alias(MV))
    packs = pack(joined, [REPORT, COLUMNS[0]], HELD, MV)
    sizes = packs.groupBy(REPORT, COLUMNS[0]).agg(F.sum("_ROWS").alias("N")).withColumn("_ALL", F.sum("N").over(Window.partitionBy(REPORT)))
    most = sizes.agg(F.max("N").alias("LEVEL"), F.max("_ALL").alias("REPORT"), F.sum("N").alias("ROWS"), F.count(F.lit(1)).alias("GROUPS")).first()
    fits = {True: (most["LEVEL"] or 0) <= block_rows, False: (most["REPORT"] or 0) <= block_rows}
    here = [s for s in sets if fits[COLUMNS[0] in s]]
    parts = []
    if here:
        tasks = max(2 * int(holdings.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-(most["ROWS"] or 0) * len(here) // TASK_ROWS), 2 * most["GROUPS"]))
        parts.append(_packed_scores(packs, here, tasks))
    if len(here) < len(sets):
        parts.append(_native_scores(joined, [s for s in sets if s not in here], block_rows))
    return union_all(parts)


def _packed_scores(packs: DataFrame, sets: Sequence[Sequence[str]], tasks: int) -> DataFrame:
    """The groupings with the first level out of the packs of a report and that level, the others out of the packs of a report."""
    level = COLUMNS[0]
    routes = [own for own in (True, False) if any((level in s) == own for s in sets)]
    routed = packs.select(F.explode(F.array(*[F.lit(own) for own in routes])).alias("_OWN"), "*").withColumn("_AT", F.when(F.col("_OWN"), F.col(level)))
    routed = routed.repartition(tasks, "_OWN", REPORT, "_AT").select("_OWN", "_AT", REPORT, level, "_PACK")
    when, texts = packs.schema[REPORT], [T.StructField(c, T.StringType()) for c in (HELD, *COLUMNS, "GROUP_SET")]
    schema = T.StructType([when, *texts, T.StructField("NUMBER", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in (MV, "NUMBER_SCORE", "MARKET_VALUE_SCORE")]])
    asked = {own: [(list(s), _set_name(s)) for s in sets if (level in s) == own] for own in routes}
    columns, out_rows = list(COLUMNS), 50_000

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, list] = {}
        for batch in batches:
            kind, date = batch.schema.field(2).type, batch.column(2)
            for own, at, report, first, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), date, batch.column(3).to_pylist(), batch.column(4)):
                groups.setdefault((own, at, report.as_py()), []).append((first, blob))
        while groups:
            (own, _, report), blobs = groups.popitem()
            tables = []
            for first in {f for f, _ in blobs}:
                t = unpacked([b.as_py() for f, b in blobs if f == first], MV)
                tables.append(t.append_column(columns[0], pa.repeat(pa.scalar(first, pa.string()), t.num_rows)))
            t = pa.concat_tables(tables)
            stock, stocks = coded(t[HELD])
            holders = (~t[HELD].is_null().to_numpy()).astype(np.int64)
            codes = {c: coded(t[c]) for c in columns}
            known = (~t[MV].is_null().to_numpy()).astype(np.int64)
            value = t[MV].fill_null(0.0).to_numpy()
            rows = t.num_rows
            del t, tables, blobs
            for names, title in asked[own]:
                group = numbered([codes[c][0] for c in names], rows)
                key = group * len(stocks) + stock
                order = np.argsort(key, kind="stable")
                key = key[order]
                start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                group, held = key[start] // len(stocks), key[start] % len(stocks)
                one = order[start]  # a holding of each row
                number = np.add.reduceat(holders[order], start)
                has = np.add.reduceat(known[order], start) > 0
                amount = half_up(np.add.reduceat(value[order], start), 2)
                scores = [half_up(mean_rank_fraction(number, group, np.ones(len(start), dtype=bool)) * 100, 4), half_up(mean_rank_fraction(amount, group, has) * 100, 4)]
                for a in range(0, len(start), out_rows):
                    part = slice(a, a + out_rows)
                    n, lacks = len(start[part]), ~has[part]
                    texts = [codes[c][1].take(pa.array(codes[c][0][one[part]])) if c in names else pa.repeat(pa.scalar(ALL), n) for c in columns]
                    arrays = [pa.repeat(pa.scalar(report, kind), n), stocks.take(pa.array(held[part])), *texts, pa.repeat(pa.scalar(title), n), pa.array(number[part])]
                    arrays += [pa.array(amount[part], mask=lacks), pa.array(scores[0][part]), pa.array(scores[1][part], mask=lacks)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return routed.mapInArrow(score, schema)


def _native_scores(joined: DataFrame, sets: Sequence[Sequence[str]], block_rows: int) -> DataFrame:
    """The same for groups of any size: the holdings of a stock are brought together once and multiplied by the groupings there."""
    held = joined.groupBy(REPORT, *COLUMNS).agg(F.count(F.lit(1)).alias("_N"))
    bounds = [F.max(F.when(F.col("GROUP_SET") == _set_name(s), F.col("_N"))).alias(str(k)) for k, s in enumerate(sets)]
    most = grouping_sets(held, sets, COLUMNS, [F.sum("_N").alias("_N")], keys=[REPORT]).agg(*bounds, F.sum("_N").alias("ALL")).first()
    tasks = max(2 * int(joined.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(most["ALL"] or 0) // TASK_ROWS))
    kept = joined.repartition(tasks, REPORT, HELD)
    block_rows = min(block_rows, ranks.BLOCK_ROWS)
    small = [s for k, s in enumerate(sets) if (most[str(k)] or 0) <= block_rows]
    large = [s for s in sets if s not in small]
    parts = []
    if small:
        parts.append(_scores(_grouped(kept, small).repartition(tasks, *_GROUP), block_rows, True))
    if large:
        grouped = cut_lineage(_grouped(kept, large))
        parts.append(_scores(grouped, block_rows, ranks.fits(grouped, _GROUP, block_rows)))
    return union_all(parts)


_GROUP = [REPORT, *COLUMNS, "GROUP_SET"]


def _set_name(columns: Sequence[str]) -> str:
    return "+".join(c for c in COLUMNS if c in columns)


def _grouped(kept: DataFrame, sets: Sequence[Sequence[str]]) -> DataFrame:
    """Holders and value of every stock in every grouping; ``kept`` lies by report and stock, and no row leaves its task."""
    each = [F.struct(*[(F.col(c) if c in s else F.lit(ALL)).alias(c) for c in COLUMNS], F.lit(_set_name(s)).alias("GROUP_SET")) for s in sets]
    fine = kept.groupBy(REPORT, HELD, *COLUMNS).agg(F.count(HELD).alias("_N"), F.sum(MV).alias("_MV"))
    long = fine.select(REPORT, HELD, "_N", "_MV", F.explode(F.array(*each)).alias("_SET")).select(REPORT, HELD, "_SET.*", "_N", "_MV")
    return long.groupBy(REPORT, HELD, *COLUMNS, "GROUP_SET").agg(F.sum("_N").alias("NUMBER"), F.round(F.sum("_MV"), 2).alias(MV))


def _scores(grouped: DataFrame, block_rows: int, bounded: bool) -> DataFrame:
    scored = ranks.rank_fraction(grouped, "NUMBER", _GROUP, "_N", block_rows=block_rows, bounded=bounded)
    scored = ranks.rank_fraction(scored, MV, _GROUP, "_V", block_rows=block_rows, bounded=bounded)
    return scored.withColumns({"NUMBER_SCORE": F.round(F.col("_N") * 100, 4), "MARKET_VALUE_SCORE": F.round(F.col("_V") * 100, 4)}).drop("_N", "_V")


def crowding(holdings: DataFrame, scores: DataFrame, weigh: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Holding-weighted mean of the popularity scores per fund and report.

    ``scores``: one row for each report and stock; ``weigh`` adds ``RATIO_IN_NA`` to holdings and leaves their other columns.  The scores come to the
    holdings where these lie by stock (a stock's scores are one row, bounded by the reports, so that the stock alone places them), and a holding
    travels once, with its score, to its fund.
    """
    score = F.struct("NUMBER_SCORE", "MARKET_VALUE_SCORE")
    of_stock = spread(scores.where(F.col(REPORT).isNotNull()), HELD).groupBy(HELD).agg(F.map_from_entries(F.collect_list(F.struct(REPORT, score))).alias("_SCORES"))
    held = holdings.select(REPORT, FUND, HELD, MV).join(of_stock, HELD, "left").withColumn("_SCORE", F.try_element_at("_SCORES", F.col(REPORT))).drop("_SCORES")
    joined = weigh(held).where(F.col("_SCORE").isNotNull()).select("*", "_SCORE.*")
    ratio = F.sum("RATIO_IN_NA")
    return joined.groupBy(REPORT, FUND).agg(
        safe_div(F.sum(F.col("MARKET_VALUE_SCORE") * F.col("RATIO_IN_NA")), ratio).alias("TOTAL_VALUE_SCORE"),
        safe_div(F.sum(F.col("NUMBER_SCORE") * F.col("RATIO_IN_NA")), ratio).alias("NUMBER_SCORE"),
    )


def top_industry_concentration(industries: DataFrame, k: int = 3, value: str = "INDUSTRY_RATIO_IN_EQUITY") -> DataFrame:
    """Sum of the industries ranked up to k (ties share a rank)."""
    ranked = ranks.sql_rank(industries, [REPORT, FUND], [-F.col(value)], "RANK_NO")
    return ranked.where(F.col("RANK_NO") <= k).groupBy(REPORT, FUND).agg(F.sum(value).alias("INDUSTRY_CONCENTRATION"))


def sector_rotation(sectors: DataFrame) -> DataFrame:
    """Label from the weighted mean change of the sector shares over three reports.

    ``sectors``: ``REPORT_DATE, FUND_ID, SECTOR, RATIO`` in percent of equity.
    """
    w = by([FUND, "SECTOR"], REPORT)
    moved = sectors.withColumn("_CHANGE", F.abs(F.col("RATIO") - F.lag("RATIO").over(w)))
    smooth = moved.withColumns({"_AVG": moving_mean(F.col("RATIO"), w, 3), "_CHANGE_AVG": F.round(moving_mean(F.col("_CHANGE"), w, 3), 6)})
    scored = smooth.groupBy(FUND, REPORT).agg(F.round(safe_div(F.sum(F.col("_AVG") * F.col("_CHANGE_AVG")), F.sum("_AVG")), 4).alias("CHANGE_SCORE"), F.max("_AVG").alias("_TOP"))
    scored = scored.where(F.col("CHANGE_SCORE").isNotNull()).withColumn("MAX_SECTOR_CHANGE", F.round(F.col("_TOP") * (100 - F.col("CHANGE_SCORE")) / 100, 4))
    label = F.when(F.col("MAX_SECTOR_CHANGE") > 50, "赛道").when(F.col("CHANGE_SCORE") >= 20, "板块轮动").otherwise("不轮动")
    return scored.select(REPORT, FUND, "CHANGE_SCORE", "MAX_SECTOR_CHANGE", label.alias("SECTOR_ROTATION"))


def quality_score(stocks: DataFrame, weights: DataFrame, measures: Sequence[str] = ("ROE_TTM", "ROA_TTM")) -> DataFrame:
    """Percentile of each stock's measures per report, averaged, then weighted by the holding ratio.

    The mean takes the trailing measures only, not the estimate; pass others in ``measures`` to change that.
    """
    stocks, small = ranks.sized(stocks, [REPORT])
    scored = stocks
    for m in measures:
        scored = ranks.rank_fraction(scored, m, [REPORT], f"_{m}", bounded=small)
    mean = sum((F.col(f"_{m}") for m in measures), F.lit(0.0)) * 100 / len(measures)
    scored = scored.select(REPORT, HELD, mean.alias("TOTAL_SCORE"))
    joined = weights.join(scored, [REPORT, HELD], "left")
    return joined.groupBy(REPORT, FUND).agg((F.coalesce(F.sum(F.col("RATIO_IN_NA") * F.col("TOTAL_SCORE")), F.lit(0.0)) / 100).alias("QUALITY"))


def holding_factors(weights: DataFrame, exposures: DataFrame, cal: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Weight times exposure summed per fund for every factor; the exposure is that of the report's trading day.

    ``exposures``: ``TRADE_DT, HOLDING_TICKER_SYMBOL`` and the factors.  The weighted numbers are summed, for style (size and
    growth) as for the wide factor list.
    """
    aligned = align_to_trading_day(weights, cal, REPORT)
    joined = aligned.join(exposures, ["TRADE_DT", HELD])
    return joined.groupBy(REPORT, FUND).agg(*[F.sum(F.col("RATIO") * F.col(f)).alias(f) for f in factors])


def fund_turnover(trades: DataFrame, expense: DataFrame, fees: DataFrame) -> DataFrame:
    """(buy + sell) over the net assets that the trustee expense and fee rate imply, in percent."""
    base = expense.join(fees, FUND).select(REPORT, FUND, F.round(safe_div(F.col("TRUSTEE_EXPENSE"), F.col("FEE_RATE")) * 100, 4).alias("NET_ASSET_ESTIMATED"))
    rate = F.round(safe_div(F.col("BUY_COST") + F.col("SELL_INCOME"), F.col("NET_ASSET_ESTIMATED")) * 100, 4)
    return base.join(trades, [REPORT, FUND]).select(REPORT, FUND, "NET_ASSET_ESTIMATED", rate.alias("TURNOVER_RATE"))


def duration_leverage(risk: DataFrame, assets: DataFrame) -> DataFrame:
    """Mean rate sensitivity over net value, and mean total over net assets."""
    joined = risk.join(assets, [REPORT, FUND])
    duration = F.abs(safe_div(safe_div(F.col("NET_VALUE_END"), F.col("CHANGE_RANGE")) * 100, F.col("NV")))
    return joined.groupBy(REPORT, FUND).agg(F.avg(duration).alias("DURATION"), F.avg(safe_div(F.col("TOTAL_ASSET"), F.col("NV"))).alias("LEVERAGE"))
