"""Risk decomposition and the compliance checks of a portfolio."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions.exprs import safe_div
from navloom.operators.aggregates import union_all
from navloom.operators.joins import band_join

P, T = "PORTFOLIO_NAME", "TICKER_SYMBOL"

# fixed values: names of the checks, caps per pool (percent), related companies' limit, yearly turnover limit
WEIGHT_SUM, POOL, RELATED, RISK, ASSET, TURNOVER, FIRST_BUY = (
    "校验组合权重之和", "校验基金是否在池及比例", "校验关联基金权重", "校验风险等级是否一致",
    "校验资产配置是否符合说明书要求", "检验过去1年换手率", "校验起投金额",
)
POOL_CAPS = {"优选池": 10.0, "核心池": 20.0}
COMPANY_WARNING, RELATED_LIMIT, TURNOVER_LIMIT, ASSET_SLACK = 20.0, 40.0, 200.0, 0.01


def decomposition(weights: DataFrame, returns: DataFrame, date: str, value: str, scale: int = 252) -> DataFrame:
    """Portfolio deviation, marginal and absolute contribution of every holding, yearly, over the dates on which every entity has a return.

    ``weights``: ``PORTFOLIO_NAME, TICKER_SYMBOL, WEIGHT`` (fractions); ``returns``: ``TICKER_SYMBOL``, the date and the return.  What a holding's
    row of the covariance matrix gives with the weights is its covariance with the portfolio's own return, so there is no matrix: the
    rows are the returns of the holdings, and two sums by date and by holding.
    """
    known = returns.where(F.col(value).isNotNull() & F.col(T).isNotNull()).select(T, F.col(date).alias("_D"), F.col(value).cast("double").alias("_R"))
    entities = known.agg(F.count_distinct(T)).first()[0]
    complete = known.groupBy("_D").agg(F.count(F.lit(1)).alias("N")).where(F.col("N") == entities).select("_D")
    held = known.join(complete, "_D", "left_semi").join(weights.select(P, T, "WEIGHT"), T)
    own = held.groupBy(P, "_D").agg(F.sum(F.col("WEIGHT") * F.col("_R")).alias("_PR"))
    marginal = held.join(own, [P, "_D"]).groupBy(P, T).agg((F.covar_samp("_R", "_PR") * scale).alias("_CW"))
    rows = weights.join(marginal, [P, T])
    std = rows.groupBy(P).agg(F.sqrt(F.sum(F.col("WEIGHT") * F.col("_CW"))).alias("PORTFOLIO_STD"))
    out = rows.join(std, P).withColumn("MARGINAL", safe_div(F.col("_CW"), F.col("PORTFOLIO_STD")))
    return out.withColumn("CONTRIBUTION", F.col("WEIGHT") * F.col("MARGINAL")).drop("_CW")


def _result(df: DataFrame, check: str, ok: Column, note: Column) -> DataFrame:
    passed = F.coalesce(ok, F.lit(False))
    return df.select(P, F.lit(check).alias("CHECK"), F.when(passed, "通过").otherwise("失败").alias("RESULT"), F.when(~passed, note).alias("NOTE"))


def check_weight_sum(holdings: DataFrame) -> DataFrame:
    total = holdings.groupBy(P).agg(F.sum("WEIGHT").alias("W"))
    return _result(total, WEIGHT_SUM, F.round(F.col("W") - 100, 4) == 0, F.lit("权重之和不为100"))


def check_pool(holdings: DataFrame, pool: DataFrame) -> DataFrame:
    """Every fund, and its alternative when given, is in the pool and within the cap of its pool."""
    caps = F.create_map(*[F.lit(x) for kv in POOL_CAPS.items() for x in kv])
    both = holdings.select(P, "WEIGHT", F.explode(F.array(F.col(T), F.col("ALTERNATIVE"))).alias(T)).where(F.col(T).isNotNull())
    rows = both.join(pool.select(T, "TRANCHE"), T, "left").withColumn("_CAP", F.element_at(caps, F.col("TRANCHE")))
    bad = F.col("_CAP").isNull() | (F.col("WEIGHT") > F.col("_CAP"))
    per = rows.groupBy(P).agg(F.max(F.when(bad, 1).otherwise(0)).alias("_BAD"), F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col(T)))), ",").alias("_WHO"))
    return _result(per, POOL, F.col("_BAD") == 0, F.concat(F.lit("不在池内或超过上限: "), F.col("_WHO")))


def check_related(holdings: DataFrame, companies: DataFrame, related: Sequence[str]) -> DataFrame:
    """The related companies together stay within the limit."""
    per = holdings.join(companies, T, "left").groupBy(P).agg(F.sum(F.when(F.col("MANAGEMENT_COMPANY_NAME").isin(list(related)), F.col("WEIGHT")).otherwise(0.0)).alias("W"))
    return _result(per, RELATED, F.round("W", 6) <= RELATED_LIMIT, F.lit("关联方基金超过40%"))


def company_warnings(holdings: DataFrame, companies: DataFrame) -> DataFrame:
    per = holdings.join(companies, T).groupBy(P, "MANAGEMENT_COMPANY_NAME").agg(F.sum("WEIGHT").alias("WEIGHT"))
    return per.where(F.round("WEIGHT", 6) > COMPANY_WARNING)


def check_risk(holdings: DataFrame, pool: DataFrame, bands: DataFrame, info: DataFrame) -> DataFrame:
    """The band of the weighted risk score equals the declared level.  ``bands``: ``MIN, MAX, LEVEL``."""
    score = holdings.join(pool.select(T, "MEDIAN"), T, "left").groupBy(P).agg((F.sum(F.col("WEIGHT") * F.col("MEDIAN")) / 100).alias("SCORE"))
    rows = band_join(score, bands, "SCORE").join(info.select(P, "RISK_LEVEL"), P)
    return _result(rows, RISK, F.col("LEVEL") == F.col("RISK_LEVEL"), F.concat(F.lit("预期"), F.col("RISK_LEVEL"), F.lit(",实际"), F.coalesce("LEVEL", F.lit("无"))))


def check_assets(holdings: DataFrame, asset_types: DataFrame, limits: DataFrame) -> DataFrame:
    """Each asset class lies inside its band.  ``limits``: ``PORTFOLIO_NAME, ASSET_TYPE, MIN, MAX``."""
    per = holdings.join(asset_types, T, "left").groupBy(P, "ASSET_TYPE").agg(F.sum("WEIGHT").alias("W"))
    inside = (F.col("W") <= F.col("MAX") + ASSET_SLACK) & (F.col("W") >= F.col("MIN") - ASSET_SLACK)
    rows = per.join(limits, [P, "ASSET_TYPE"], "left").withColumn("_BAD", F.when(F.coalesce(inside, F.lit(False)), 0).otherwise(1))
    failing = F.array_join(F.array_sort(F.collect_list(F.when(F.col("_BAD") == 1, F.col("ASSET_TYPE")))), ",")
    out = rows.groupBy(P).agg(F.max("_BAD").alias("_ANY"), failing.alias("_WHO"))
    return _result(out, ASSET, F.col("_ANY") == 0, F.concat(F.col("_WHO"), F.lit("不符合要求")))


def check_turnover(holdings: DataFrame, yearly: DataFrame) -> DataFrame:
    rows = holdings.select(P).distinct().join(yearly.select(P, "TURNOVER"), P, "left").fillna({"TURNOVER": 0.0})
    return _result(rows, TURNOVER, F.col("TURNOVER") <= TURNOVER_LIMIT, F.concat(F.lit("过去1年换手率"), F.format_string("%.2f", "TURNOVER"), F.lit("%")))


def check_first_buy(holdings: DataFrame, pool: DataFrame, info: DataFrame) -> DataFrame:
    need = holdings.join(pool.select(T, F.col("FIRST_BUY").alias("_FB")), T).groupBy(P).agg(F.max(safe_div(F.col("_FB"), F.col("WEIGHT")) * 100).alias("NEED"))
    rows = need.join(info.select(P, "FIRST_BUY"), P)
    return _result(rows, FIRST_BUY, F.col("NEED") <= F.col("FIRST_BUY"), F.concat(F.lit("首次买入金额"), F.format_string("%.2f", "NEED"), F.lit("大于"), F.format_string("%.2f", "FIRST_BUY")))


def compliance(
    holdings: DataFrame, pool: DataFrame, companies: DataFrame, related: Sequence[str], bands: DataFrame, info: DataFrame, asset_types: DataFrame, limits: DataFrame, yearly: DataFrame
) -> DataFrame:
    """The seven checks of every portfolio: ``PORTFOLIO_NAME, CHECK, RESULT, NOTE``."""
    return union_all(
        [
            check_weight_sum(holdings),
            check_pool(holdings, pool),
            check_related(holdings, companies, related),
            check_risk(holdings, pool, bands, info),
            check_assets(holdings, asset_types, limits),
            check_turnover(holdings, yearly),
            check_first_buy(holdings, pool, info),
        ]
    )
