"""Keep-latest deduplication, anti joins and ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import semantics as S


def keep_first(rows: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """One row for each key, first in order. The rank is limited before the shuffle, so hot keys stay small."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_trades(trades: DataFrame, *ties: Column | str) -> DataFrame:
    """The latest row of each trade_id; unparseable times come last, and ``ties`` (such as the file) decide among equals: names highest first, columns as they say."""
    return keep_first(trades, ["trade_id"], [F.col("created_time").try_cast("timestamp").desc_nulls_last(), *[F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in ties]])


def canonical_markets(markets: DataFrame, *ties: str) -> DataFrame:
    """The latest row of each market, by ticker and close (or creation) time."""
    keyed = markets.withColumn("_key", S.market_key())
    order = [F.col("updated_time").try_cast("timestamp").desc_nulls_last(), F.col("created_time").try_cast("timestamp").desc_nulls_last()]
    return keep_first(keyed, ["ticker", "_key"], [*order, *[F.col(c).desc_nulls_last() for c in ties]]).drop("_key")


def without_known(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in ``known``; null keys match null keys."""
    mine, theirs = rows.alias("r"), known.select(*keys).distinct().alias("k")
    same = None
    for key in keys:
        own = F.col(f"r.{key}").eqNullSafe(F.col(f"k.{key}"))
        same = own if same is None else same & own
    return mine.join(theirs, same, "left_anti")


def orphans(trades: DataFrame, markets: DataFrame, done: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Traded tickers without a market, less those already seen to; ``most`` caps a repair run, as its operator asks."""
    out = trades.filter(F.trim("ticker") != "").select("ticker").distinct().join(markets.select("ticker"), "ticker", "left_anti")
    out = out if done is None else out.join(done.select("ticker"), "ticker", "left_anti")
    return out if most is None else out.orderBy("ticker").limit(most)


def average_ranks(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """(by, value, n, rank): average ranks of values, from counts of distinct values, so no row is sorted twice."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("n"))
    before = Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("rank", F.coalesce(F.sum("n").over(before), F.lit(0)) + (F.col("n") + 1) / 2.0)
