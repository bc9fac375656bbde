"""Trades joined to outcomes, as positions of takers and makers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import semantics as S


def resolved_trades(trades: DataFrame, markets: DataFrame, strict: bool = True, market_columns: tuple[str, ...] = ()) -> DataFrame:
    """Trades of markets with an outcome. Spark picks the join; trades keep duplicates of a market's ticker."""
    outcomes = markets.filter(S.resolved(strict)).select("ticker", "result", *market_columns)
    return trades.join(outcomes, "ticker")


def positions(joined: DataFrame, *keep: Column | str) -> DataFrame:
    """Two rows for each trade, from one scan and one join: role, price, won, contracts and ``keep``."""
    sides = F.array(
        F.struct(F.lit("taker").alias("role"), S.taker_price().alias("price"), S.taker_won().alias("won")),
        F.struct(F.lit("maker").alias("role"), S.maker_price().alias("price"), S.maker_won().alias("won")),
    )
    return joined.select(F.inline(sides), F.col("count").alias("contracts"), *keep)


def maker_legs(joined: DataFrame) -> DataFrame:
    """What makers bought: side, price, won, contracts."""
    bought_yes = F.col("taker_side") == "no"
    side = F.when(bought_yes, "YES").when(F.col("taker_side") == "yes", "NO")
    return joined.select(
        side.alias("side"),
        F.when(bought_yes, F.col("yes_price")).otherwise(F.col("no_price")).alias("price"),
        F.when(F.col("result") == F.lower(side), 1).otherwise(0).alias("won"),
        F.col("count").alias("contracts"),
    ).filter("side is not null")
