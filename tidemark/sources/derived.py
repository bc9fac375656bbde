"""Market and trade views over the star-schema tables, in Spark and as SQL for the oracle.

Both sides compute the same rows: orders act as markets, lineitems as trades, parts as markets of a
second platform and events as its blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PRICE = "(l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 101"
_PM_PRICE = "(1 + (l_partkey * 7 + l_suppkey * 13 + l_linenumber) % 99)"

_MARKETS = """
SELECT 'MKT-' || CAST(o_orderkey AS {S}) AS ticker,
  CASE o_orderkey % 8 WHEN 0 THEN 'NFLGAME-25' WHEN 1 THEN 'BTCD-25' WHEN 2 THEN 'FEDDECISION-25' WHEN 3 THEN CAST(NULL AS {S})
       WHEN 4 THEN '' WHEN 5 THEN 'lower-25' WHEN 6 THEN 'CPI-25' ELSE 'HIGHNY-25' END AS event_ticker,
  CASE o_orderstatus WHEN 'F' THEN 'finalized' WHEN 'O' THEN 'active' ELSE 'closed' END AS status,
  CASE WHEN o_orderkey % 10 < 4 THEN 'yes' WHEN o_orderkey % 10 < 9 THEN 'no' ELSE '' END AS result,
  CAST(FLOOR(o_totalprice) AS BIGINT) AS volume, o_orderdate AS created_time
FROM {orders} WHERE o_orderkey % 97 <> 0
"""

_TRADES = """
SELECT CAST(l_orderkey AS {S}) || '-' || CAST(l_linenumber AS {S}) AS trade_id,
  'MKT-' || CAST(l_orderkey AS {S}) AS ticker,
  CASE WHEN l_linestatus = 'O' THEN 'yes' ELSE 'no' END AS taker_side,
  CASE WHEN l_linenumber = 5 THEN CAST(0 AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END AS count,
  CAST(l_quantity AS {S}) AS count_fp,
  CAST({price} AS INT) AS yes_price, CAST(100 - {price} AS INT) AS no_price,
  {ts} AS created_time, l_partkey, l_suppkey
FROM {lineitem}
"""

_PM_MARKETS = """
SELECT CAST(p_partkey AS {S}) AS id,
  '["T' || CAST(p_partkey * 2 AS {S}) || '","T' || CAST(p_partkey * 2 + 1 AS {S}) || '"]' AS clob_token_ids,
  CASE p_partkey % 4 WHEN 0 THEN '["0.999","0.001"]' WHEN 1 THEN '["0.001","0.999"]' WHEN 2 THEN '["0.6","0.4"]' ELSE '[]' END AS outcome_prices,
  p_partkey % 5 <> 0 AS closed, '0xF' || CAST(p_partkey AS {S}) AS market_maker_address
FROM {part}
"""

_PM_TRADES = """
SELECT l_orderkey * 3 + l_linenumber AS block_number,
  CASE WHEN l_linestatus = 'O' THEN '0' ELSE 'T' || CAST(l_partkey * 2 + l_suppkey % 2 AS {S}) END AS maker_asset_id,
  CASE WHEN l_linestatus = 'O' THEN 'T' || CAST(l_partkey * 2 + l_suppkey % 2 AS {S}) ELSE '0' END AS taker_asset_id,
  CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) * 10000 * {p} ELSE CAST(l_quantity AS BIGINT) * 1000000 END AS maker_amount,
  CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) * 1000000 ELSE CAST(l_quantity AS BIGINT) * 10000 * {p} END AS taker_amount
FROM {lineitem}
"""

_PM_BLOCKS = "SELECT event_id * 5 AS block_number, ts AS timestamp FROM {events}"

#: Automated-market-maker trades: amounts are strings of micro-units; every third pool is not collateralised in USDC.
_PM_LEGACY = """
SELECT o_orderkey * 2 AS block_number, '0xf' || CAST(1 + o_custkey % 200 AS {S}) AS fpmm_address,
  CAST(CAST(FLOOR(o_totalprice) AS BIGINT) * 10000 * (1 + o_orderkey % 99) AS {S}) AS amount,
  CAST(CAST(FLOOR(o_totalprice) AS BIGINT) * 1000000 AS {S}) AS outcome_tokens,
  CAST(o_orderkey % 2 AS INT) AS outcome_index
FROM {orders}
"""

_PM_COLLATERAL = """
SELECT '0xF' || CAST(p_partkey AS {S}) AS fpmm_address, CASE WHEN p_partkey % 3 = 0 THEN 'DAI' ELSE 'USDC' END AS collateral_symbol FROM {part}
"""

_VIEWS = {
    "markets": _MARKETS, "trades": _TRADES, "pm_markets": _PM_MARKETS, "pm_trades": _PM_TRADES,
    "pm_blocks": _PM_BLOCKS, "pm_legacy": _PM_LEGACY, "pm_collateral": _PM_COLLATERAL,
}
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def oracle_view(name: str) -> str:
    """The view's SQL for the oracle."""
    return _VIEWS[name].format(S="VARCHAR", price=_PRICE, p=_PM_PRICE, ts="l_shipdate + to_hours(CAST(l_partkey % 24 AS INT))", **{t: t for t in _TABLES})


def oracle_with(*names: str) -> str:
    """A WITH clause of views for the oracle, open for more."""
    return "WITH " + ", ".join(f"{n} AS ({oracle_view(n)})" for n in names)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view over the Parquet tables in a folder."""
    text = _VIEWS[name].format(S="STRING", price=_PRICE, p=_PM_PRICE, ts="timestampadd(HOUR, CAST(l_partkey % 24 AS INT), l_shipdate)", **{t: "{" + t + "}" for t in _TABLES})
    used = [t for t in _TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def collateral_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collateral lookup as it arrives: one JSON object for each address."""
    rows = view(spark, sf_dir, "pm_collateral")
    return rows.select(F.to_json(F.create_map("fpmm_address", F.struct(F.col("collateral_symbol")))).alias("text"))
