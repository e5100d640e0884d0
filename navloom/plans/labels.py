"""Fund labels and classification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPSILON = 0.0001  # fixed value: keeps a ratio finite when its base is zero


def bond_split(df: DataFrame, interest_parts: Sequence[str], bond: str, convertible: str) -> DataFrame:
    """Interest-rate bonds are the sum of their parts; what is neither that nor convertible is credit."""
    interest = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in interest_parts])
    out = df.withColumn("INTEREST_BOND", interest)
    out = out.withColumn("CREDIT_BOND", F.col(bond) - F.col(convertible) - F.col("INTEREST_BOND"))
    return out.withColumn("INTEREST_RATIO", F.col("INTEREST_BOND") / (F.col("INTEREST_BOND") + F.col("CREDIT_BOND") + EPSILON))


def classify(funds: DataFrame) -> DataFrame:
    """Three-level class of every fund from its asset ratios, name and tracked index.

    Input columns: ``TYPE_1, TYPE_2, TYPE_3`` (vendor classes), ``SEC_SHORT_NAME``, four-period means of the ratios
    ``EQUITY_RATIO_IN_NA, BOND_RATIO_IN_NA, COVERTBOND_RATIO_IN_NA, RISK_EXPOSURE, EQUITY_TO_COVERTBOND, CREDIT_TO_INTEREST,
    F_PRT_HKSTOCKVALUETONAV``, ``SECTOR`` and ``TRACKING_INDEX``.  Level 2 and 3 look at the levels already decided.
    """
    name, equity, risk = F.col("SEC_SHORT_NAME"), F.col("EQUITY_RATIO_IN_NA"), F.col("RISK_EXPOSURE")
    # fixed values: class names and thresholds (percent)
    mixed = ["细分", "固收+", "固收"]
    passive = ["权益指数", "债券指数", "商品", "货币", "QDII"]
    tracked = ["ETF联接", "ETF", "存单基金", "商品基金", "国际(QDII)增强指数型股票基金", "国际(QDII)被动指数型股票基金", "权益指数基金"]
    risk_bands = [(35, "(35+)"), (25, "(25-35)"), (15, "(15-25)"), (5, "(05-15)")]
    out = funds.withColumn(
        "LEVEL_1",
        F.when(~F.col("TYPE_1").isin(mixed), F.col("TYPE_1"))
        .when(equity > 60, "主动权益")
        .when(equity > 40, "平衡型")
        .when(risk > 0.5, "固收+")
        .when(F.col("BOND_RATIO_IN_NA") > 50, "固收")
        .otherwise(F.col("TYPE_1")),
    )
    first = F.col("LEVEL_1")
    band = reduce(lambda chain, b: chain.when(risk > b[0], b[1]), risk_bands, F.when(F.col("COVERTBOND_RATIO_IN_NA") > 50, "可转债")).otherwise("(00-05)")
    index_kind = (
        F.when(name.contains("ETF") & name.contains("联接"), "ETF联接")
        .when(name.contains("ETF"), "ETF")
        .when(name.contains("存单"), "存单基金")
        .when(name.contains("QDII"), F.col("TYPE_2"))
        .otherwise(F.concat(first, F.lit("基金")))
    )
    active = F.when(F.col("TYPE_2") == "指数增强", "指数增强").when(F.col("F_PRT_HKSTOCKVALUETONAV") > 50, "港股主题").otherwise("A股主题")
    out = out.withColumn(
        "LEVEL_2",
        F.when(first == "固收", F.when((F.col("TYPE_2") == "短债") | name.contains("短"), "短债").otherwise("中长债"))
        .when(first == "平衡型", "平衡型")
        .when(first == "固收+", band)
        .when(first == "主动权益", active)
        .when(first.isin(passive), index_kind)
        .otherwise(F.col("TYPE_2")),
    )
    second, credit, to_cb = F.col("LEVEL_2"), F.col("CREDIT_TO_INTEREST"), F.col("EQUITY_TO_COVERTBOND")
    short = F.when(name.contains("中短") | (F.col("TYPE_3") == "中短期纯债型"), "中短债").when(name.contains("超短"), "超短债").otherwise("短债")
    long_bond = F.when(credit > 2, "信用债").when(credit < 0.5, "利率债").otherwise("券种均衡")
    third = (
        F.when((first == "固收") & (second == "短债"), short)
        .when((first == "固收") & (second == "中长债"), long_bond)
        .when((first == "主动权益") & second.isin("A股主题", "港股主题"), F.coalesce(F.col("SECTOR"), F.lit("无主题")))
        .when((first == "主动权益") & (second == "指数增强"), F.col("TRACKING_INDEX"))
        .when(first == "固收+", F.when(to_cb > 2, "权益增强").when(to_cb < 0.5, "转债增强").otherwise("均衡增强"))
        .when(second.isin(tracked), F.col("TRACKING_INDEX"))
    )
    return out.withColumn("LEVEL_3", third)


def class_paths(classes: DataFrame) -> DataFrame:
    """Level columns as full paths; a fund without a third level keeps the second path."""
    return classes.withColumns(
        {"PATH_2": F.concat_ws("-", "LEVEL_1", "LEVEL_2"), "PATH_3": F.concat_ws("-", "LEVEL_1", "LEVEL_2", "LEVEL_3")}
    )


def style_position(style: DataFrame, cal: DataFrame) -> DataFrame:
    """Growth-value and size position of a trading day, moved to the report date it belongs to (quarter end)."""
    return style.withColumn("REPORT_DATE", F.last_day(F.add_months(F.trunc("TRADE_DT", "quarter"), 2)))
