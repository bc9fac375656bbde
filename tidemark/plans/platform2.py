"""Analyses of the second platform: trades keyed by block, outcomes in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import moments as M
from tidemark.operators.positions import positions, resolved_trades
from tidemark.registry import query
from tidemark.sources.derived import collateral_json, oracle_with, view
from tidemark.sources.tables import usdc_addresses

WITH = oracle_with("pm_markets", "pm_trades", "pm_blocks", "pm_legacy", "pm_collateral")
#: Blocks that share a time.
BLOCK_BUCKET = 1000


def outcomes(markets: DataFrame) -> DataFrame:
    """(clob_token_ids, market_maker_address, winner) of closed markets with one price over 0.99 and the other under 0.01.

    Prices that are no JSON array of two numbers leave the market out.
    """
    strict = {"allowSingleQuotes": "false"}
    prices = F.from_json("outcome_prices", "array<string>", strict)
    parsed = markets.filter("closed").select("clob_token_ids", "market_maker_address", prices.alias("p")).filter(F.size("p") == 2)
    first, second = F.get("p", F.lit(0)).try_cast("double"), F.get("p", F.lit(1)).try_cast("double")
    winner = F.when((first > 0.99) & (second < 0.01), 0).when((first < 0.01) & (second > 0.99), 1)
    return parsed.select(F.from_json("clob_token_ids", "array<string>", strict).alias("tokens"), "market_maker_address", winner.alias("winner")).filter("winner is not null")


def token_outcomes(markets: DataFrame) -> DataFrame:
    """(token_id, won)."""
    rows = outcomes(markets).filter(F.size("tokens") == 2)
    return rows.select(F.posexplode("tokens").alias("place", "token_id"), "winner").select("token_id", (F.col("place") == F.col("winner")).alias("won")).dropDuplicates(["token_id"])


def pool_outcomes(markets: DataFrame, usdc: DataFrame) -> DataFrame:
    """(fpmm_address, winner) of USDC pools."""
    rows = outcomes(markets).filter("market_maker_address <> ''").select(F.lower("market_maker_address").alias("fpmm_address"), "winner")
    return rows.dropDuplicates(["fpmm_address"]).join(usdc, "fpmm_address", "left_semi")


def token_positions(trades: DataFrame, tokens: DataFrame, *keep: str) -> DataFrame:
    """(price, won, ...) of buyers and sellers of outcome tokens; the price is rounded to whole cents."""
    paid = F.col("maker_asset_id") == "0"
    token = F.when(paid, F.col("taker_asset_id")).otherwise(F.col("maker_asset_id"))
    ratio = F.when(paid, F.lit(100.0) * F.col("maker_amount") / F.col("taker_amount").cast("double")).otherwise(F.lit(100.0) * F.col("taker_amount") / F.col("maker_amount").cast("double"))
    valid = trades.filter("taker_amount > 0 and maker_amount > 0")
    priced = valid.select(token.alias("token_id"), ratio.alias("cents"), *keep).join(tokens, "token_id")
    return _both_sides(priced, F.col("won"), keep)


def pool_positions(trades: DataFrame, pools: DataFrame, *keep: str) -> DataFrame:
    """(price, won, ...) of buyers and sellers in pools."""
    tokens = F.col("outcome_tokens").try_cast("double")
    rows = trades.filter(tokens > 0).select(F.lower("fpmm_address").alias("fpmm_address"), (F.lit(100.0) * F.col("amount").try_cast("double") / tokens).alias("cents"), "outcome_index", *keep)
    return _both_sides(rows.join(pools, "fpmm_address"), F.col("outcome_index") == F.col("winner"), keep)


def _both_sides(rows: DataFrame, won: Column, keep: tuple[str, ...]) -> DataFrame:
    sides = F.array(F.struct(F.round("cents").alias("price"), won.alias("won")), F.struct(F.round(F.lit(100.0) - F.col("cents")).alias("price"), (~won).alias("won")))
    return rows.select(F.inline(sides), *keep)


def block_times(blocks: DataFrame, size: int = BLOCK_BUCKET) -> DataFrame:
    """(bucket, timestamp): the time of each bucket's first block."""
    return blocks.groupBy(F.expr(f"block_number div {size}").alias("bucket")).agg(F.min_by("timestamp", "block_number").alias("timestamp"))


_TOKENS = """, o AS (SELECT clob_token_ids, market_maker_address, CAST(outcome_prices->>0 AS DOUBLE) AS p0, CAST(outcome_prices->>1 AS DOUBLE) AS p1 FROM pm_markets WHERE closed AND json_array_length(outcome_prices) = 2),
w AS (SELECT *, CASE WHEN p0 > 0.99 AND p1 < 0.01 THEN 0 WHEN p0 < 0.01 AND p1 > 0.99 THEN 1 END AS winner FROM o),
tok AS (SELECT clob_token_ids->>0 AS token_id, winner = 0 AS won FROM w WHERE winner IS NOT NULL UNION ALL SELECT clob_token_ids->>1, winner = 1 FROM w WHERE winner IS NOT NULL),
pool AS (SELECT lower(market_maker_address) AS fpmm_address, winner FROM w WHERE winner IS NOT NULL AND lower(market_maker_address) IN (SELECT lower(fpmm_address) FROM pm_collateral WHERE collateral_symbol = 'USDC')),
pt AS (SELECT block_number, 100.0::DOUBLE * CASE WHEN maker_asset_id = '0' THEN maker_amount ELSE taker_amount END / CASE WHEN maker_asset_id = '0' THEN taker_amount ELSE maker_amount END AS c, won
 FROM pm_trades JOIN tok ON CASE WHEN maker_asset_id = '0' THEN taker_asset_id ELSE maker_asset_id END = token_id WHERE maker_amount > 0 AND taker_amount > 0),
pl AS (SELECT block_number, 100.0::DOUBLE * CAST(amount AS DOUBLE) / CAST(outcome_tokens AS DOUBLE) AS c, outcome_index = winner AS won FROM pm_legacy t JOIN pool ON lower(t.fpmm_address) = pool.fpmm_address WHERE CAST(outcome_tokens AS DOUBLE) > 0),
pp AS (SELECT round(c) AS price, won, block_number FROM pt UNION ALL SELECT round(100.0 - c), NOT won, block_number FROM pt UNION ALL SELECT round(c), won, block_number FROM pl UNION ALL SELECT round(100.0 - c), NOT won, block_number FROM pl)"""


@query(
    "a20_trades_over_time",
    WITH
    + """, c AS (SELECT block_number, count(*) AS n FROM (SELECT block_number FROM pm_trades UNION ALL SELECT block_number FROM pm_legacy) GROUP BY 1)
SELECT c.block_number, b.timestamp, c.n AS trade_count FROM c JOIN pm_blocks b ON c.block_number = b.block_number""",
)
def a20_trades_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of both kinds by block, for blocks whose time is known."""
    both = view(spark, sf_dir, "pm_trades").select("block_number").unionAll(view(spark, sf_dir, "pm_legacy").select("block_number"))
    counts = both.groupBy("block_number").agg(F.count("*").alias("trade_count"))
    return counts.join(view(spark, sf_dir, "pm_blocks"), "block_number").select("block_number", "timestamp", "trade_count")


@query(
    "a21_volume_over_time",
    WITH
    + f""", b AS (SELECT block_number // {BLOCK_BUCKET} AS bucket, arg_min(timestamp, block_number) AS ts FROM pm_blocks GROUP BY 1),
v AS (SELECT block_number, CASE WHEN maker_asset_id = '0' THEN taker_amount ELSE maker_amount END AS a FROM pm_trades WHERE maker_asset_id = '0' OR taker_asset_id = '0'
 UNION ALL SELECT block_number, CAST(amount AS BIGINT) FROM pm_legacy WHERE lower(fpmm_address) IN (SELECT lower(fpmm_address) FROM pm_collateral WHERE collateral_symbol = 'USDC'))
SELECT date_trunc('quarter', b.ts)::TIMESTAMP AS quarter, round(CAST(sum(a) AS DOUBLE) / 1e6, 2) AS volume_usd FROM v JOIN b ON v.block_number // {BLOCK_BUCKET} = b.bucket GROUP BY 1""",
)
def a21_volume_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume by quarter: tokens against USDC, and pools collateralised in USDC. Blocks meet times by bucket."""
    tokens = view(spark, sf_dir, "pm_trades").filter("maker_asset_id = '0' or taker_asset_id = '0'")
    tokens = tokens.select("block_number", F.when(F.col("maker_asset_id") == "0", F.col("taker_amount")).otherwise(F.col("maker_amount")).alias("amount"))
    pools = view(spark, sf_dir, "pm_legacy").withColumn("fpmm_address", F.lower("fpmm_address")).join(usdc_addresses(collateral_json(spark, sf_dir)), "fpmm_address", "left_semi")
    both = tokens.unionAll(pools.select("block_number", F.col("amount").try_cast("long")))
    per_bucket = both.groupBy(F.expr(f"block_number div {BLOCK_BUCKET}").alias("bucket")).agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount"))
    dated = per_bucket.join(block_times(view(spark, sf_dir, "pm_blocks")), "bucket")
    return dated.groupBy(F.date_trunc("quarter", "timestamp").cast("timestamp_ntz").alias("quarter")).agg(F.round(F.sum("amount").cast("double") / 1e6, 2).alias("volume_usd"))


def _all_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    markets = view(spark, sf_dir, "pm_markets")
    tokens = token_positions(view(spark, sf_dir, "pm_trades"), token_outcomes(markets), "block_number")
    pools = pool_positions(view(spark, sf_dir, "pm_legacy"), pool_outcomes(markets, usdc_addresses(collateral_json(spark, sf_dir))), "block_number")
    return tokens.unionByName(pools).filter(F.col("price").between(1, 99))


def calibration(positions: DataFrame, price: str = "price") -> DataFrame:
    """(price, total_trades, wins) by price."""
    return positions.groupBy(F.col(price).cast("int").alias("price")).agg(F.count("*").alias("total_trades"), F.sum(F.col("won").cast("int")).alias("wins"))


@query("a22_win_rate_by_price", WITH + _TOKENS + " SELECT CAST(price AS INT) AS price, count(*) AS total_trades, CAST(sum(won::INT) AS BIGINT) AS wins, round(100.0 * sum(won::INT) / CAST(count(*) AS DOUBLE), 6) AS win_rate FROM pp WHERE price BETWEEN 1 AND 99 GROUP BY 1")
def a22_win_rate_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rate by whole cent over tokens and pools."""
    return calibration(_all_positions(spark, sf_dir)).select("*", F.round(F.lit(100.0) * F.col("wins") / F.col("total_trades").cast("double"), 6).alias("win_rate"))


def scores(by_price: DataFrame) -> DataFrame:
    """One row of Brier score, log loss, expected calibration error and number of positions, from (price, total_trades, wins)."""
    p, n, w = F.col("price") / 100.0, F.col("total_trades").cast("double"), F.col("wins").cast("double")
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    total = F.sum("total_trades").cast("double")
    return by_price.agg(
        F.round(F.sum(w * (p - 1) * (p - 1) + (n - w) * p * p) / total, 9).alias("brier"),
        F.round(-F.sum(w * F.ln(safe) + (n - w) * F.ln(1 - safe)) / total, 9).alias("log_loss"),
        F.round(F.sum(n * F.abs(w / n - p)) / total, 9).alias("ece"),
        F.sum("total_trades").alias("total"),
    )


_SCORES = """ SELECT round(sum(w * (p - 1) * (p - 1) + (n - w) * p * p) / sum(n), 9) AS brier, round(-sum(w * ln(p) + (n - w) * ln(1 - p)) / sum(n), 9) AS log_loss,
 round(sum(n * abs(w / n - p)) / sum(n), 9) AS ece, CAST(sum(n) AS BIGINT) AS total FROM (SELECT price / 100.0::DOUBLE AS p, CAST(count(*) AS DOUBLE) AS n, CAST(sum(won::INT) AS DOUBLE) AS w FROM pp WHERE price BETWEEN 1 AND 99 GROUP BY 1)"""


@query("st12_proper_scores", WITH + _TOKENS + _SCORES)
def st12_proper_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brier score, log loss and calibration error of prices as forecasts."""
    return scores(calibration(_all_positions(spark, sf_dir)))


def cumulative(by_day: DataFrame) -> DataFrame:
    """(platform, day, price, total, wins), each the sum up to that day, for every day a platform traded and every price it had."""
    days = by_day.select("platform", "day").distinct()
    prices = by_day.groupBy("platform", "price").agg(F.min("day").alias("since"))
    grid = days.join(prices, "platform").filter(F.col("day") >= F.col("since")).select("platform", "day", "price")
    running = Window.partitionBy("platform", "price").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    dense = grid.join(by_day, ["platform", "day", "price"], "left")
    return dense.select("platform", "day", "price", F.sum("total").over(running).alias("total"), F.sum("wins").over(running).alias("wins"))


def _by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = positions(resolved_trades(view(spark, sf_dir, "trades"), view(spark, sf_dir, "markets")), F.date_trunc("day", "created_time").cast("timestamp_ntz").alias("day"))
    first = first.filter(F.col("price").between(1, 99)).groupBy("day", "price").agg(F.count("*").alias("total"), F.sum("won").alias("wins"))
    second = _all_positions(spark, sf_dir).withColumn("bucket", F.expr(f"block_number div {BLOCK_BUCKET}"))
    second = second.groupBy("bucket", F.col("price").cast("int").alias("price")).agg(F.count("*").alias("total"), F.sum(F.col("won").cast("int")).alias("wins"))
    second = second.join(block_times(view(spark, sf_dir, "pm_blocks")), "bucket").groupBy(F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("day"), "price")
    second = second.agg(F.sum("total").alias("total"), F.sum("wins").alias("wins"))
    return first.withColumn("platform", F.lit("exchange")).unionByName(second.withColumn("platform", F.lit("chain")))


_MARKETS = oracle_with("markets", "trades").removeprefix("WITH ")
_BY_DAY = (
    WITH + ", " + _MARKETS + _TOKENS
    + f""", bk AS (SELECT block_number // {BLOCK_BUCKET} AS bucket, arg_min(timestamp, block_number) AS ts FROM pm_blocks GROUP BY 1),
kj AS (SELECT t.*, m.result FROM trades t JOIN markets m ON t.ticker = m.ticker WHERE m.status = 'finalized' AND m.result IN ('yes', 'no')),
kp AS (SELECT date_trunc('day', created_time)::TIMESTAMP AS day, CASE WHEN taker_side = 'yes' THEN yes_price ELSE no_price END AS price, (taker_side = result)::INT AS won FROM kj
 UNION ALL SELECT date_trunc('day', created_time)::TIMESTAMP, CASE WHEN taker_side = 'yes' THEN no_price ELSE yes_price END, (taker_side <> result)::INT FROM kj),
d AS (SELECT 'exchange' AS platform, day, price, count(*) AS total, sum(won) AS wins FROM kp WHERE price BETWEEN 1 AND 99 GROUP BY ALL
 UNION ALL SELECT 'chain', date_trunc('day', bk.ts)::TIMESTAMP, CAST(price AS INT), count(*), sum(won::INT) FROM pp JOIN bk ON pp.block_number // {BLOCK_BUCKET} = bk.bucket WHERE price BETWEEN 1 AND 99 GROUP BY ALL)"""
)


@query(
    "a23_cumulative_win_rate",
    _BY_DAY + """, last AS (SELECT max(day) AS day FROM d), s AS (SELECT platform, price, sum(total) AS total, sum(wins) AS wins FROM d WHERE platform IN (SELECT platform FROM d, last WHERE d.day = last.day) GROUP BY 1, 2)
SELECT platform, CAST(price AS INT) AS price, CAST(total AS BIGINT) AS total, CAST(wins AS BIGINT) AS wins, round(100.0 * wins / CAST(total AS DOUBLE), 6) AS win_rate FROM s""",
)
def a23_cumulative_win_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rate by platform and price up to the last day; a platform without trades on that day gives nothing."""
    sums = _by_day(spark, sf_dir).groupBy("platform", "price").agg(F.sum("total").alias("total"), F.sum("wins").alias("wins"), F.max("day").alias("day"))
    own, last = F.max("day").over(Window.partitionBy("platform")), F.max("day").over(Window.partitionBy())  # over at most 99 rows a platform
    final = sums.select("platform", "price", "total", "wins", (own == last).alias("up_to_date")).filter("up_to_date").drop("up_to_date")
    return final.select("*", F.round(F.lit(100.0) * F.col("wins") / F.col("total").cast("double"), 6).alias("win_rate"))


MIN_DAY_TOTAL = 1000


@query(
    "join18_as_of_frames",
    _BY_DAY + f""", t AS (SELECT platform, day, sum(total) AS n FROM d GROUP BY 1, 2), c AS (SELECT platform, day, sum(n) OVER (PARTITION BY platform ORDER BY day) AS n FROM t),
v AS (SELECT DISTINCT day FROM c WHERE n >= {MIN_DAY_TOTAL}), f AS (SELECT day FROM (SELECT day, row_number() OVER (ORDER BY day) AS r FROM v) WHERE r % 2 = 1)
SELECT f.day, CAST((SELECT arg_max(n, c.day) FROM c WHERE c.platform = 'exchange' AND c.day <= f.day) AS BIGINT) AS exchange_total, CAST((SELECT arg_max(n, c.day) FROM c WHERE c.platform = 'chain' AND c.day <= f.day) AS BIGINT) AS chain_total FROM f""",
)
def join18_as_of_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second day with enough trades, with each platform's latest total as of that day (one row a day)."""
    per_day = _by_day(spark, sf_dir).groupBy("platform", "day").agg(F.sum("total").alias("n"))
    running = Window.partitionBy("platform").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    totals = per_day.withColumn("n", F.sum("n").over(running))
    wide = totals.groupBy("day").pivot("platform", ["exchange", "chain"]).agg(F.max("n"))
    by_time = Window.orderBy("day")
    latest = [F.last(p, ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias(f"{p}_total") for p in ("exchange", "chain")]
    valid = (F.col("exchange") >= MIN_DAY_TOTAL) | (F.col("chain") >= MIN_DAY_TOTAL)
    frames = wide.select("day", *latest, F.coalesce(valid, F.lit(False)).alias("valid")).filter("valid")
    return frames.withColumn("_r", F.row_number().over(by_time)).filter("_r % 2 = 1").select("day", "exchange_total", "chain_total")


@query(
    "win11_interpolated_block_times",
    WITH + """, s AS (SELECT block_number AS b, CAST(epoch_us(timestamp) // 1000000 AS BIGINT) AS t, lead(block_number) OVER (ORDER BY block_number) AS b2, lead(CAST(epoch_us(timestamp) // 1000000 AS BIGINT)) OVER (ORDER BY block_number) AS t2 FROM pm_blocks)
SELECT x AS block_number, CASE WHEN b2 IS NULL THEN t ELSE t + CAST(trunc(CAST((t2 - t) * (x - b) AS DOUBLE) / (b2 - b)) AS BIGINT) END AS ts FROM (SELECT *, unnest(CASE WHEN b2 IS NULL THEN [b] ELSE generate_series(b, b2 - 1) END) AS x FROM s)""",
)
def win11_interpolated_block_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A time for every block between sampled ones, by linear interpolation in whole seconds."""
    sampled = view(spark, sf_dir, "pm_blocks").select("block_number", F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("t"))
    return interpolate_blocks(sampled)


def interpolate_blocks(sampled: DataFrame, stretch: int = 1_000_000) -> DataFrame:
    """(block_number, ts) for every block; neighbours are found within stretches of blocks, each of which also sees the next one's first."""
    keyed = sampled.withColumn("s", F.expr(f"block_number div {stretch}"))
    firsts = keyed.groupBy("s").agg(F.min(F.struct("block_number", "t")).alias("f"))
    following = Window.orderBy("s")  # one row for each stretch
    after = firsts.select("s", F.lead("f").over(following).alias("g"))
    order = Window.partitionBy("s").orderBy("block_number")
    rows = keyed.join(after, "s").select("block_number", "t", F.coalesce(F.lead(F.struct("block_number", "t")).over(order), F.col("g")).alias("n"))
    end = F.coalesce(F.col("n.block_number") - 1, F.col("block_number"))
    spread = rows.select("block_number", "t", "n", F.explode(F.sequence("block_number", end)).alias("x"))
    step = F.expr("(n.t - t) * (x - block_number) div (n.block_number - block_number)")
    return spread.select(F.col("x").alias("block_number"), F.coalesce(F.col("t") + step, F.col("t")).alias("ts"))


def decode_words(data: Column) -> Column:
    """The 32-byte big-endian words of a hexadecimal string as decimals; words beyond 38 digits are null."""
    plain = F.regexp_replace(data, "^0x", "")
    n = F.floor(F.length(plain) / 64).cast("int")

    def word(i: Column) -> Column:
        hexes = F.substring(plain, i * 64 + 1, F.lit(64))
        high = [F.conv(F.substring(hexes, F.lit(at), F.lit(12)), 16, 10).cast("decimal(38,0)") for at in (41, 53)]
        mid = F.conv(F.substring(hexes, F.lit(33), F.lit(8)), 16, 10).cast("decimal(38,0)")
        small = F.substring(hexes, F.lit(1), F.lit(32)) == "0" * 32
        value = F.try_add(F.try_multiply(mid, F.lit(str(2**96)).cast("decimal(38,0)")).cast("decimal(38,0)"), (high[0] * F.lit(str(2**48)).cast("decimal(38,0)")).cast("decimal(38,0)") + high[1])
        return F.when(small, value.cast("decimal(38,0)"))

    return F.transform(F.sequence(F.lit(0), n - 1), word)


def trade_price_size(maker_asset: Column, maker_amount: Column, taker_amount: Column) -> tuple[Column, Column, Column]:
    """(price, size, side) of a token trade; without a divisor the price is 0."""
    buy = maker_asset == "0"
    paid, got = F.when(buy, maker_amount).otherwise(taker_amount), F.when(buy, taker_amount).otherwise(maker_amount)
    return F.when(got > 0, paid / got.cast("double")).otherwise(0.0), got / 1e6, F.when(buy, "BUY").otherwise("SELL")


@query(
    "mth7_trade_price_size",
    WITH + """ SELECT side, count(*) AS n, round(sum(price), 4) AS prices, round(sum(size), 4) AS sizes FROM (SELECT CASE WHEN maker_asset_id = '0' THEN 'BUY' ELSE 'SELL' END AS side,
 CASE WHEN maker_asset_id = '0' THEN CASE WHEN taker_amount > 0 THEN CAST(maker_amount AS DOUBLE) / taker_amount ELSE 0.0 END ELSE CASE WHEN maker_amount > 0 THEN CAST(taker_amount AS DOUBLE) / maker_amount ELSE 0.0 END END AS price,
 CASE WHEN maker_asset_id = '0' THEN taker_amount ELSE maker_amount END / 1e6 AS size FROM pm_trades) GROUP BY side""",
)
def mth7_trade_price_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of derived prices and sizes by side."""
    price, size, side = trade_price_size(F.col("maker_asset_id"), F.col("maker_amount"), F.col("taker_amount"))
    rows = view(spark, sf_dir, "pm_trades").select(side.alias("side"), price.alias("price"), size.alias("size"))
    return rows.groupBy("side").agg(F.count("*").alias("n"), F.round(F.sum("price"), 4).alias("prices"), F.round(F.sum("size"), 4).alias("sizes"))
