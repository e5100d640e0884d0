"""Due-diligence scores of all funds at once: piecewise scores as columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.functions.exprs import safe_div
from navloom.operators import ranks
from navloom.operators.aggregates import listed
from navloom.operators.joins import related_classes

T, COMPANY = "TICKER_SYMBOL", "MANAGEMENT_COMPANY_NAME"

# fixed values: score steps (upper bound inclusive, score), else score
COMPANY_RANK = {"active": ([(10, 10), (20, 8), (50, 5)], 0), "other": ([(20, 20), (30, 15), (40, 10), (50, 5)], 0), "cash": ([(20, 5), (50, 3)], 0)}
STAFF_LOSS = ([(0.1, 5), (0.2, 4), (0.3, 3), (0.4, 2), (0.5, 1)], 0)
RETURN_RANK = ([(20, 15), (50, 10), (70, 5)], 0)
RISK_RANK = ([(20, 10), (50, 8), (70, 5)], 0)
TWO_YEAR_RANK = ([(30, 10), (50, 5)], 0)
TOTAL_FEE = ([(0.4, 50), (0.5, 30), (0.6, 20)], 0)
QUALITATIVE = {"active": 35, "other": 30, "cash": 20}  # team 5, incentives 5, compliance 10, style 15; compliance only
DEFAULT_NOTE = "公司近三年合规表现良好，具备较为完善的内控机制"
EQUITY, BOND, INDEX, CASH = "主动权益", "主动债券", "指数和商品", "货币"


def stepped(x: Column, table: tuple[Sequence[tuple[float, float]], float]) -> Column:
    steps, rest = table
    return reduce(lambda chain, s: chain.when(x <= s[0], float(s[1])), steps, F.when(x.isNull(), F.lit(None).cast("double"))).otherwise(float(rest))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x))


def template(df: DataFrame) -> DataFrame:
    """Template from the summary class; enhanced index funds are scored as index funds."""
    kind = F.when(F.col("LEVEL_SUM").isin("指数", "商品"), INDEX).when(F.col("LEVEL_2") == "指数增强", INDEX).otherwise(F.col("LEVEL_SUM"))
    return df.withColumn("TEMPLATE", kind)


def company_asset_rank(assets: DataFrame) -> DataFrame:
    """Assets per strategy and company with the company's place; enhanced index funds count as a strategy of their own too.

    ``assets``: ``TICKER_SYMBOL, LEVEL_SUM, LEVEL_2, MANAGEMENT_COMPANY_NAME, NET_ASSET, IS_MAIN``.
    """
    main = assets.where("IS_MAIN = 1")
    strategies = F.array_compact(F.array(F.col("LEVEL_SUM"), F.when(F.col("LEVEL_2") == "指数增强", F.col("LEVEL_2"))))
    sums = main.select(F.explode(strategies).alias("STRATEGY"), COMPANY, "NET_ASSET").groupBy("STRATEGY", COMPANY).agg(F.round(F.sum("NET_ASSET"), 4).alias("NET_ASSET"))
    return ranks.row_numbers(sums, ["STRATEGY"], [-F.col("NET_ASSET"), F.col(COMPANY)], "PLACE")


def manager_tenure(spells: DataFrame, today: Column) -> DataFrame:
    """Years between a person's first start and last end over all funds, and the list of managers of each fund.

    ``spells``: ``PERSON, TICKER_SYMBOL, START_DATE, END_DATE`` (null end = still there).
    """
    person = spells.groupBy("PERSON").agg(F.min("START_DATE").alias("_S"), F.max(F.coalesce("END_DATE", today)).alias("_E"))
    years = person.select("PERSON", F.round(F.datediff("_E", "_S") / 365, 4).alias("YEARS"))
    now = spells.where(F.col("END_DATE").isNull()).select(T, "PERSON").distinct().join(years, "PERSON")
    return now.groupBy(T).agg(listed("PERSON").alias("MANAGERS"), F.max("YEARS").alias("MANAGER_YEARS"))


def manager_changed(spells: DataFrame, since: Column, until: Column) -> DataFrame:
    """1 when a manager left within the period."""
    return spells.groupBy(T).agg(F.max(F.when(F.col("END_DATE").between(since, until), 1).otherwise(0)).alias("CHANGED"))


def staff_loss_score(companies: DataFrame) -> DataFrame:
    rate = safe_div(F.col("LEAVERS"), F.col("MANAGERS"))
    return companies.withColumn("LOSS_RATE", F.round(rate, 6)).withColumn("LOSS_SCORE", stepped(rate, STAFF_LOSS))


def evaluation_window(funds: DataFrame, today: Column) -> DataFrame:
    """Start: the later of the manager's start (else establishment) and three years ago."""
    begin = F.coalesce("MANAGER_START", "ESTABLISH_DATE")
    return funds.withColumns({"EVAL_START": F.greatest(begin, F.add_months(today, -36)), "EVAL_END": today})


def best_rank(df: DataFrame, name: str, out: str) -> DataFrame:
    """Three-year rank, else two-year, else one-year."""
    return df.withColumn(out, F.coalesce(f"{name}_3Y", f"{name}_2Y", f"{name}_1Y"))


def manager_assets(holdings: DataFrame) -> DataFrame:
    """Largest same-strategy assets among the managers of a fund.

    ``holdings``: ``PERSON, TICKER_SYMBOL, STRATEGY, NET_ASSET``.
    """
    book = holdings.groupBy("PERSON", "STRATEGY").agg(F.sum("NET_ASSET").alias("_BOOK"))
    return holdings.join(book, ["PERSON", "STRATEGY"]).groupBy(T).agg(F.round(F.max("_BOOK"), 4).alias("MANAGER_ASSET"))


def tenure_score(years: Column) -> Column:
    return F.when(years <= 1, 0.0).when(years > 5, 5.0).otherwise(years)


def pool_age_bonus(years: Column) -> Column:
    return F.when(years < 1, 0.0).when(years > 2, 10.0).otherwise(5.0)


def equity_score(df: DataFrame) -> dict[str, Column]:
    asset = F.col("FUND_ASSET")
    return {
        "SIZE_SCORE": F.when(asset <= 20, 10.0).when(asset > 120, 0.0).otherwise(12 - 0.1 * asset),
        "RETURN_SCORE": clamp(7 + F.col("EXCESS") / 0.02, 0, 15),
        "DRAWDOWN_SCORE": clamp(10 + (0.9 - F.col("DRAWDOWN_RATIO")) / 0.05, 0, 15),
        "RATIO_SCORE": clamp((F.col("IR") - 1) / 0.5, 0, 5),
    }


def bond_score(df: DataFrame) -> dict[str, Column]:
    asset = F.col("FUND_ASSET")
    short = F.when(asset <= 5, 0.0).otherwise((asset - 5) / 5)
    rest = F.when(asset <= 10, 10.0).otherwise((asset - 10) / 10)
    return {
        "SIZE_SCORE": F.least(F.when(F.col("LEVEL_2") == "短债", short).otherwise(rest), F.lit(10.0)),
        "RETURN_SCORE": stepped(F.col("RETURN_RANK"), RETURN_RANK),
        "DRAWDOWN_SCORE": stepped(F.col("DRAWDOWN_RANK"), RISK_RANK),
        "RATIO_SCORE": stepped(F.col("SHARPE_RANK"), RISK_RANK),
    }


def index_score(df: DataFrame) -> dict[str, Column]:
    """Enhanced index funds by size and excess, all others by size and tracking error (percent)."""
    asset, error = F.col("FUND_ASSET"), F.col("TRACKING_ERROR")
    enhanced = F.col("LEVEL_2") == "指数增强"
    overseas = F.col("LEVEL_1") == "QDII"
    plain_size = F.when(overseas, F.when(asset > 5, 30.0).when(asset > 2, 15.0).otherwise(0.0)).otherwise(F.when(asset > 40, 30.0).when(asset > 15, 15.0).otherwise(0.0))
    limit = F.when(overseas, 6.0).otherwise(3.0)
    return {
        "SIZE_SCORE": F.when(enhanced, F.when(asset <= 10, 20.0).otherwise(F.greatest(20 - (asset - 10) / 10, F.lit(0.0)))).otherwise(plain_size),
        "RETURN_SCORE": F.when(enhanced, F.least(F.when(F.col("EXCESS") <= 0, 0.0).otherwise(F.col("EXCESS") * 100 / 0.5 * 2), F.lit(30.0))).otherwise(
            F.least(F.when(error > limit, 0.0).otherwise((limit - error) / 0.1), F.lit(20.0))
        ),
        "DRAWDOWN_SCORE": F.lit(0.0),
        "RATIO_SCORE": F.lit(0.0),
    }


def cash_score(df: DataFrame) -> dict[str, Column]:
    asset = F.col("FUND_ASSET")
    return {
        "SIZE_SCORE": F.when(asset >= 200, 15.0).when(asset >= 100, 10.0).when(asset >= 50, 5.0).otherwise(0.0),
        "RETURN_SCORE": stepped(F.col("RETURN_RANK"), TWO_YEAR_RANK),
        "DRAWDOWN_SCORE": F.lit(0.0),
        "RATIO_SCORE": stepped(F.col("TOTAL_FEE"), TOTAL_FEE),
    }


PARTS = ["COMPANY_SCORE", "MANAGER_SCORE", "SIZE_SCORE", "RETURN_SCORE", "DRAWDOWN_SCORE", "RATIO_SCORE", "QUALITATIVE_SCORE", "BONUS_SCORE"]


def scored(df: DataFrame) -> DataFrame:
    """All part scores and the total of every fund by its template.

    Input: ``TEMPLATE, LEVEL_1, LEVEL_2, COMPANY_PLACE, MANAGER_YEARS, LOSS_SCORE, POOL_YEARS, FUND_ASSET, EXCESS, DRAWDOWN_RATIO, IR,
    RETURN_RANK, DRAWDOWN_RANK, SHARPE_RANK, TRACKING_ERROR, TOTAL_FEE``.
    """
    which = F.col("TEMPLATE")
    active = which.isin(EQUITY, BOND)
    tables = {EQUITY: equity_score(df), BOND: bond_score(df), INDEX: index_score(df), CASH: cash_score(df)}

    def pick(part: str) -> Column:
        return reduce(lambda chain, kv: chain.when(which == kv[0], kv[1][part]), tables.items(), F.when(F.lit(False), F.lit(None).cast("double")))

    place = F.col("COMPANY_PLACE")
    out = df.withColumns(
        {
            "COMPANY_SCORE": F.when(active, stepped(place, COMPANY_RANK["active"])).when(which == INDEX, stepped(place, COMPANY_RANK["other"])).otherwise(stepped(place, COMPANY_RANK["cash"])),
            "MANAGER_SCORE": F.when(active, tenure_score(F.col("MANAGER_YEARS"))).otherwise(0.0),
            **{p: pick(p) for p in ("SIZE_SCORE", "RETURN_SCORE", "DRAWDOWN_SCORE", "RATIO_SCORE")},
            "QUALITATIVE_SCORE": F.when(active, QUALITATIVE["active"] + F.col("LOSS_SCORE")).when(which == INDEX, float(QUALITATIVE["other"])).otherwise(float(QUALITATIVE["cash"])),
            "BONUS_SCORE": F.when(active, pool_age_bonus(F.col("POOL_YEARS"))).otherwise(0.0),
        }
    )
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(p), F.lit(0.0)) for p in PARTS])
    return out.withColumn("TOTAL_SCORE", F.round(total, 4))


def gated(df: DataFrame) -> DataFrame:
    """Pass or fail with remarks: age, size, manager's same-strategy assets and score threshold by pool."""
    which, preferred = F.col("TEMPLATE"), F.col("TRANCHE") == "优选池"
    need = F.when(which == EQUITY, F.when(preferred, 5.0).otherwise(20.0)).when(which == BOND, F.when(preferred, 20.0).otherwise(50.0))
    threshold = F.when(which == INDEX, 60.0).when(preferred, 65.0).otherwise(75.0)
    remarks = F.concat_ws(
        ";",
        F.when((F.col("FUND_YEARS") < 1) & (F.col("LEVEL_SUM") != "指数"), "非指数产品不满足成立1年"),
        F.when(F.col("FUND_ASSET") < 2, "基金资产不满2亿"),
        F.when(F.col("MANAGER_ASSET") < need, F.concat(F.col("TRANCHE"), F.lit("同策略产品管理规模不足"), need.cast("int").cast("string"), F.lit("亿"))),
        F.when(F.col("TOTAL_SCORE") < threshold, "评分不满"),
    )
    return df.withColumn("REMARKS", remarks).withColumn("RESULT", F.when(F.col("REMARKS") == "", "满足").otherwise("不满足"))


def company_notes(funds: DataFrame, notes: DataFrame) -> DataFrame:
    """Written assessment: the company's own note when there is one, else the standard text."""
    return funds.join(notes, COMPANY, "left").withColumn("COMPLIANCE", F.coalesce("COMPLIANCE", F.lit(DEFAULT_NOTE)))


def related_text(relations: Sequence[DataFrame], funds: DataFrame, pool: DataFrame) -> DataFrame:
    """``name:code(+pool)`` of all share classes of a fund, sorted and joined."""
    pairs = related_classes(relations, funds)
    names = funds.select(F.col(T).alias("RELATED"), "SEC_SHORT_NAME").join(pool.select(F.col(T).alias("RELATED"), "TRANCHE"), "RELATED", "left")
    label = F.concat(F.col("SEC_SHORT_NAME"), F.lit(":"), F.col("RELATED"), F.coalesce(F.concat(F.lit("("), F.col("TRANCHE"), F.lit(")")), F.lit("")))
    return pairs.join(names, "RELATED").select(T, label.alias("LABEL")).groupBy(T).agg(listed("LABEL", ";").alias("RELATED_FUNDS"))
