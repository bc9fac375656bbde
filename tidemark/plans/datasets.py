"""Forecast scores, data set statistics, inspection and comparison with an outside baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.registry import query
from tidemark.sources.derived import oracle_with, view

WITH = oracle_with("markets", "trades")
BINS = 10


def last_prices(trades: DataFrame) -> DataFrame:
    """(ticker, yp): the yes price of each ticker's last trade; later ids decide among equal times."""
    known = trades.filter("yes_price is not null and created_time is not null")
    return known.groupBy("ticker").agg(F.max_by("yes_price", F.struct("created_time", "trade_id", "l_partkey", "l_suppkey")).alias("yp"))


def forecasts(trades: DataFrame, markets: DataFrame, clip: bool = True) -> DataFrame:
    """(ticker, p, y): last price as probability, outcome as 0 or 1. Extremes are clipped, or prices outside 1 to 99 left out."""
    outcome = markets.filter(F.lower("result").isin("yes", "no")).groupBy("ticker").agg(F.max_by(F.lower("result"), "created_time").alias("outcome"))
    rows = last_prices(trades).join(outcome, "ticker")
    price = F.col("yp") / 100.0
    if clip:
        price = F.when(F.col("yp") < 1, 0.005).when(F.col("yp") > 99, 0.995).otherwise(price)
    else:
        rows = rows.filter(F.col("yp").between(1, 99))
    return rows.select("ticker", price.alias("p"), F.when(F.col("outcome") == "yes", 1.0).otherwise(0.0).alias("y"))


def probability_bins(rows: DataFrame, bins: int = BINS) -> DataFrame:
    """(bin_id, n_k, p_bar_k, o_bar_k) of equal-width bins."""
    if bins < 3:
        raise ValueError("at least three bins")
    bin_id = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(F.col("p") * bins).cast("int")))
    return rows.groupBy(bin_id.alias("bin_id")).agg(F.count("*").alias("n_k"), F.avg("p").alias("p_bar_k"), F.avg("y").alias("o_bar_k"))


def murphy(binned: DataFrame) -> DataFrame:
    """One row: o_bar, reliability, resolution, uncertainty, brier_binned."""
    n, p, o = F.col("n_k"), F.col("p_bar_k"), F.col("o_bar_k")
    # The sum of n (o - ō)² is that of n o² less N ō², so one pass is enough.
    sums = binned.agg(F.sum(n).alias("N"), F.sum(n * o).alias("so"), F.sum(n * (p - o) * (p - o)).alias("rel"), F.sum(n * o * o).alias("soo"))
    mean = F.col("so") / F.col("N")
    rel, res, unc = F.col("rel") / F.col("N"), F.col("soo") / F.col("N") - mean * mean, mean * (1 - mean)
    r = lambda c, name: F.round(c, 9).alias(name)
    return sums.select(r(mean, "o_bar"), r(rel, "reliability"), r(res, "resolution"), r(unc, "uncertainty"), r(rel - res + unc, "brier_binned"))


_FORECASTS = (
    WITH
    + """, l AS (SELECT ticker, arg_max(yes_price, (created_time, trade_id, l_partkey, l_suppkey)) AS yp FROM trades GROUP BY ticker),
o AS (SELECT ticker, lower(result) AS outcome FROM markets WHERE lower(result) IN ('yes', 'no')),
f AS (SELECT l.ticker, CASE WHEN yp < 1 THEN 0.005::DOUBLE WHEN yp > 99 THEN 0.995::DOUBLE ELSE yp / 100.0::DOUBLE END AS p, CASE WHEN outcome = 'yes' THEN 1.0::DOUBLE ELSE 0.0 END AS y FROM l JOIN o ON l.ticker = o.ticker),
b AS (SELECT least(9, greatest(0, CAST(floor(p * 10) AS INT))) AS bin_id, count(*) AS n_k, avg(p) AS p_bar_k, avg(y) AS o_bar_k FROM f GROUP BY 1)"""
)


@query("a24_last_trade_brier", _FORECASTS + " SELECT round(avg((p - y) * (p - y)), 9) AS brier_exact, round(avg(y), 9) AS o_bar, count(*) AS n FROM f")
def a24_last_trade_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brier score of last prices over all resolved markets."""
    rows = forecasts(view(spark, sf_dir, "trades"), view(spark, sf_dir, "markets"))
    error = F.col("p") - F.col("y")
    return rows.agg(F.round(F.avg(error * error), 9).alias("brier_exact"), F.round(F.avg("y"), 9).alias("o_bar"), F.count("*").alias("n"))


@query("st16_probability_bins", _FORECASTS + " SELECT bin_id, n_k, round(p_bar_k, 9) AS p_bar_k, round(o_bar_k, 9) AS o_bar_k FROM b")
def st16_probability_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, mean forecasts and observed shares of ten bins."""
    rows = probability_bins(forecasts(view(spark, sf_dir, "trades"), view(spark, sf_dir, "markets")))
    return rows.select("bin_id", "n_k", F.round("p_bar_k", 9).alias("p_bar_k"), F.round("o_bar_k", 9).alias("o_bar_k"))


@query(
    "st15_murphy",
    _FORECASTS
    + """, s AS (SELECT sum(n_k * o_bar_k) / sum(n_k) AS m FROM b)
SELECT round(m, 9) AS o_bar, round(rel, 9) AS reliability, round(res, 9) AS resolution, round(m * (1 - m), 9) AS uncertainty, round(rel - res + m * (1 - m), 9) AS brier_binned
FROM (SELECT any_value(m) AS m, sum(n_k * (p_bar_k - o_bar_k) ** 2) / sum(n_k) AS rel, sum(n_k * (o_bar_k - m) ** 2) / sum(n_k) AS res FROM b, s)""",
)
def st15_murphy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Murphy's decomposition of the binned Brier score."""
    return murphy(probability_bins(forecasts(view(spark, sf_dir, "trades"), view(spark, sf_dir, "markets"))))


@query(
    "a25_dataset_stats",
    WITH
    + """ SELECT count(*) AS trades, count(DISTINCT ticker) AS tickers, min(created_time) AS first_trade, max(created_time) AS last_trade,
 sum(coalesce(CAST(nullif(count, 0) AS DOUBLE), TRY_CAST(count_fp AS DOUBLE))) AS contracts, round(sum(coalesce(CAST(nullif(count, 0) AS DOUBLE), TRY_CAST(count_fp AS DOUBLE)) * yes_price / 100.0), 2) AS notional_usd FROM trades""",
)
def a25_dataset_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over all trades, with counts given as text where the count is 0."""
    count = S.effective_count()
    return view(spark, sf_dir, "trades").agg(
        F.count("*").alias("trades"), F.count_distinct("ticker").alias("tickers"), F.min("created_time").alias("first_trade"), F.max("created_time").alias("last_trade"),
        F.sum(count).alias("contracts"), F.round(F.sum(count * F.col("yes_price") / 100.0), 2).alias("notional_usd"),
    )


@query("srt4_top_tickers", WITH + " SELECT ticker, count(*) AS n FROM trades GROUP BY ticker ORDER BY n DESC, ticker LIMIT 5")
def srt4_top_tickers(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """The five most traded tickers; names decide among equals."""
    return view(spark, sf_dir, "trades").groupBy("ticker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ticker").limit(k)


@query(
    "a26_inspection",
    WITH
    + """ SELECT 'trades' AS source, count(*) AS n_rows, count(DISTINCT ticker) AS tickers, min(created_time) AS first_time, max(created_time) AS last_time FROM trades
UNION ALL SELECT 'markets', count(*), count(DISTINCT ticker), min(created_time), max(created_time) FROM markets""",
)
def a26_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, tickers and time range of each source."""
    parts = [view(spark, sf_dir, name).agg(F.lit(name).alias("source"), F.count("*").alias("n_rows"), F.count_distinct("ticker").alias("tickers"), F.min("created_time").alias("first_time"), F.max("created_time").alias("last_time")) for name in ("trades", "markets")]
    return parts[0].unionByName(parts[1])


@query("srt8_sample_rows", WITH + " SELECT trade_id, ticker, created_time FROM trades ORDER BY created_time, trade_id, l_partkey, l_suppkey LIMIT 3")
def srt8_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three earliest trades."""
    return view(spark, sf_dir, "trades").orderBy("created_time", "trade_id", "l_partkey", "l_suppkey").limit(3).select("trade_id", "ticker", "created_time")


BASELINE = {"total_contracts": 1_700_000.0, "total_volume_usd": 900_000.0, "total_trades": 60_000.0}


@query(
    "a27_baseline_comparison",
    WITH
    + """, o AS (SELECT CAST(count(*) AS DOUBLE) AS t, sum(coalesce(CAST(nullif(count, 0) AS DOUBLE), TRY_CAST(count_fp AS DOUBLE))) AS c, sum(coalesce(CAST(nullif(count, 0) AS DOUBLE), TRY_CAST(count_fp AS DOUBLE)) * yes_price / 100.0) AS v FROM trades),
r AS (SELECT 'total_contracts' AS metric, c AS ours, 1700000.0::DOUBLE AS baseline FROM o UNION ALL SELECT 'total_volume_usd', v, 900000.0 FROM o UNION ALL SELECT 'total_trades', t, 60000.0 FROM o)
SELECT metric, round(ours, 2) AS ours, baseline, round(100 * ours / baseline, 6) AS pct, CASE WHEN ours / baseline >= 0.85 THEN 'close' WHEN ours / baseline >= 0.40 THEN 'partial' ELSE 'far' END AS band FROM r""",
)
def a27_baseline_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Our totals against a published baseline, with bands at 85 and 40 per cent."""
    return compare_to_baseline(view(spark, sf_dir, "trades"), BASELINE)


def compare_to_baseline(trades: DataFrame, baseline: dict[str, float]) -> DataFrame:
    """(metric, ours, baseline, pct, band)."""
    count = S.effective_count()
    totals = trades.agg(F.count("*").cast("double").alias("total_trades"), F.sum(count).alias("total_contracts"), F.sum(count * F.col("yes_price") / 100.0).alias("total_volume_usd"))
    rows = totals.select(F.inline(F.array(*[F.struct(F.lit(k).alias("metric"), F.coalesce(k, F.lit(0.0)).alias("ours"), F.lit(v).alias("baseline")) for k, v in baseline.items()])))
    share = F.col("ours") / F.nullif(F.col("baseline"), F.lit(0.0))
    band = F.when(share >= 0.85, "close").when(share >= 0.40, "partial").otherwise("far")
    return rows.select("metric", F.round("ours", 2).alias("ours"), "baseline", F.round(100 * share, 6).alias("pct"), band.alias("band"))
