"""Ingestion and repair over the derived views, as queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.operators import keys as K
from tidemark.operators import repair as R
from tidemark.registry import query
from tidemark.sources.derived import oracle_with, view
from tidemark.streaming import ingest as I

WITH = oracle_with("markets", "trades")
#: Rows that came twice, the second time a day later, and the part of the markets that the past has.
_TWICE = WITH + """, tt AS (SELECT trade_id, ticker, count, created_time FROM trades UNION ALL SELECT trade_id, ticker, count + 1, created_time + INTERVAL 1 DAY FROM trades WHERE count % 7 = 0),
mm AS (SELECT ticker, volume, CAST(created_time AS VARCHAR)[:10] AS close_time, created_time FROM markets),
m2 AS (SELECT * FROM mm UNION ALL SELECT ticker, volume + 1, close_time, created_time + INTERVAL 1 DAY FROM mm WHERE volume % 5 = 0), past AS (SELECT * FROM mm WHERE volume % 3 = 0)"""


def _trades_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = view(spark, sf_dir, "trades").select("trade_id", "ticker", "count", "created_time")
    later = trades.filter("count % 7 = 0").withColumns({"count": F.col("count") + 1, "created_time": F.col("created_time") + F.expr("INTERVAL 1 DAY")})
    return trades.unionByName(later)


def _markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "markets").select("ticker", "volume", F.date_format("created_time", "yyyy-MM-dd").alias("close_time"), F.col("created_time").cast("timestamp_ntz").alias("created_time"))
    return rows.withColumn("updated_time", F.col("created_time").cast("string"))


def _markets_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _markets(spark, sf_dir)
    later = rows.filter("volume % 5 = 0").withColumns({"volume": F.col("volume") + 1, "created_time": F.col("created_time") + F.expr("INTERVAL 1 DAY")})
    return rows.unionByName(later.withColumn("updated_time", F.col("created_time").cast("string")))


@query("rp1_repaired_trades", _TWICE + " SELECT ticker, count(*) AS n, CAST(sum(count) AS BIGINT) AS contracts FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY created_time DESC) AS r FROM tt) WHERE r = 1 GROUP BY 1")
def rp1_repaired_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest of every trade, by market; of rows with the same time, which the SQL leaves open, the one with the least count."""
    return K.latest_trades(_trades_twice(spark, sf_dir), F.col("count").asc()).groupBy("ticker").agg(F.count("*").alias("n"), F.sum("count").alias("contracts"))


@query("rp2_repaired_markets", _TWICE + " SELECT ticker, CAST(volume AS BIGINT) AS volume FROM (SELECT *, row_number() OVER (PARTITION BY ticker, close_time ORDER BY created_time DESC) AS r FROM m2) WHERE r = 1 AND (ticker, close_time) NOT IN (SELECT ticker, close_time FROM past)")
def rp2_repaired_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest of every market that the past does not have."""
    past = _markets(spark, sf_dir).filter("volume % 3 = 0")
    return R.repair_markets(_markets_twice(spark, sf_dir).withColumn("created_time", F.col("created_time").cast("string")), past.withColumn("created_time", F.col("created_time").cast("string"))).select("ticker", "volume")


@query("rp4_orphans", WITH + " SELECT DISTINCT ticker FROM trades WHERE ticker NOT IN (SELECT ticker FROM markets)")
def rp4_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traded tickers without a market."""
    return K.orphans(view(spark, sf_dir, "trades"), view(spark, sf_dir, "markets"))


@query("rp5_table_stats", _TWICE + " SELECT 'trades' AS kind, count(*) AS rows, count(DISTINCT trade_id) AS keys, 0 AS overlap FROM tt UNION ALL SELECT 'markets', count(*), count(DISTINCT (ticker, close_time)), (SELECT count(DISTINCT (ticker, close_time)) FROM past) FROM m2")
def rp5_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a repair looks at before and after: rows, keys and keys that the past has."""
    text = lambda rows: rows.withColumn("created_time", F.col("created_time").cast("string"))
    past = text(_markets(spark, sf_dir).filter("volume % 3 = 0"))
    parts = [("trades", R.stats_row(_trades_twice(spark, sf_dir), "trades")), ("markets", R.stats_row(text(_markets_twice(spark, sf_dir)), "markets", past))]
    rows = [part.select(F.lit(kind).alias("kind"), "rows", "keys", F.col("overlap").cast("long").alias("overlap")) for kind, part in parts]
    return rows[0].unionByName(rows[1])


@query("dq15_markets_audit", _TWICE + " SELECT * FROM (SELECT 'duplicates' AS failure, count(*) - count(DISTINCT (ticker, close_time)) AS n FROM m2 UNION ALL SELECT 'overlap', count(DISTINCT (ticker, close_time)) FROM past) WHERE n > 0")
def dq15_markets_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of forward markets: duplicates and overlap with the past."""
    text = lambda rows: rows.withColumn("created_time", F.col("created_time").cast("string"))
    return R.audit_markets(text(_markets_twice(spark, sf_dir)), text(_markets(spark, sf_dir).filter("volume % 3 = 0")))


_FROM, _TO = datetime(1996, 1, 1), datetime(1998, 1, 1)


@query("stm6_sorted_batch", WITH + """, b AS (SELECT trade_id, created_time FROM trades UNION ALL SELECT trade_id, created_time FROM trades WHERE count % 7 = 0), k AS (SELECT trade_id FROM trades WHERE count % 3 = 0),
r AS (SELECT created_time <= TIMESTAMP '1996-01-01' AS low, created_time > TIMESTAMP '1998-01-01' AS high, trade_id IN (SELECT trade_id FROM k) AS known, row_number() OVER (PARTITION BY trade_id, created_time > TIMESTAMP '1996-01-01' AND created_time <= TIMESTAMP '1998-01-01') AS i FROM b)
SELECT CASE WHEN low THEN 'low' WHEN high THEN 'high' WHEN known THEN 'existing' WHEN i > 1 THEN 'duplicate' ELSE 'new' END AS reason, count(*) AS n FROM r GROUP BY 1""")
def stm6_sorted_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of a batch's rows, given what the sink holds."""
    trades = view(spark, sf_dir, "trades").select("trade_id", "count", F.col("created_time").cast("string").alias("created_time"))
    batch = trades.unionByName(trades.filter("count % 7 = 0")).drop("count")
    seconds = lambda t: int((t - datetime(1970, 1, 1)).total_seconds())
    done = I.sort_batch(batch, trades.filter("count % 3 = 0").select("trade_id"), ["trade_id"], I.Bounds(seconds(_FROM), seconds(_TO)), S.epoch(F.col("created_time")))
    return done.groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("n"))
