"""Analyses of trades against outcomes on the first platform."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.functions.stats import normal_two_sided
from tidemark.functions.taxonomy import group_sql, hierarchy
from tidemark.operators import moments as M
from tidemark.operators.positions import maker_legs, positions, resolved_trades
from tidemark.registry import query
from tidemark.sources.derived import oracle_with, view

WITH = oracle_with("markets", "trades")
_CATEGORY = "CASE WHEN event_ticker IS NULL OR regexp_extract(event_ticker, '^([A-Z0-9]+)', 1) = '' THEN 'independent' ELSE regexp_extract(event_ticker, '^([A-Z0-9]+)', 1) END"
#: Both sides of every resolved trade, for the oracle.
POSITIONS = (
    WITH
    + f""", resolved AS (SELECT ticker, result, {_CATEGORY} AS category FROM markets WHERE status = 'finalized' AND result IN ('yes', 'no')),
joined AS (SELECT t.*, m.result, m.category FROM trades t JOIN resolved m ON t.ticker = m.ticker),
pos AS (
  SELECT 'taker' AS role, CASE WHEN taker_side = 'yes' THEN yes_price ELSE no_price END AS price, CASE WHEN taker_side = result THEN 1 ELSE 0 END AS won,
         count AS contracts, created_time, category FROM joined
  UNION ALL
  SELECT 'maker', CASE WHEN taker_side = 'yes' THEN no_price ELSE yes_price END, CASE WHEN taker_side <> result THEN 1 ELSE 0 END, count, created_time, category FROM joined
)"""
)


def _joined(spark: SparkSession, sf_dir: str, strict: bool = True, *columns: str) -> DataFrame:
    return resolved_trades(view(spark, sf_dir, "trades"), view(spark, sf_dir, "markets"), strict, columns)


def _r(c: Column, places: int = 6) -> Column:
    return F.round(c, places)


@query(
    "a01_meta_stats",
    WITH
    + """, t AS (SELECT count(*) AS n, sum(CAST(count AS BIGINT)) AS c, sum(yes_price * count) AS v, count(DISTINCT ticker) AS k FROM trades),
m AS (SELECT count(*) AS n, count(DISTINCT event_ticker) AS e FROM markets)
SELECT 'num_trades' AS metric, CAST(n AS DOUBLE) AS value FROM t UNION ALL SELECT 'total_contracts', CAST(c AS DOUBLE) FROM t
UNION ALL SELECT 'total_volume_usd', CAST(v AS DOUBLE) / 100.0 FROM t UNION ALL SELECT 'avg_position_size', round(CAST(c AS DOUBLE) / n, 6) FROM t
UNION ALL SELECT 'num_markets', CAST(n AS DOUBLE) FROM m UNION ALL SELECT 'num_events', CAST(e AS DOUBLE) FROM m
UNION ALL SELECT 'num_tickers_with_trades', CAST(k AS DOUBLE) FROM t
UNION ALL SELECT 'markets_with_trades_pct', round(100.0 * t.k / CAST(m.n AS DOUBLE), 6) FROM t, m""",
)
def a01_meta_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of trades and markets, one row for each metric."""
    return meta_stats(spark, sf_dir).select("metric", "value")


def meta_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(metric, value, formatted)."""
    t = view(spark, sf_dir, "trades").agg(
        F.count("*").alias("n"), F.sum("count").alias("c"), F.sum(F.col("yes_price") * F.col("count")).alias("v"), F.count_distinct("ticker").alias("k")
    )
    m = view(spark, sf_dir, "markets").agg(F.count("*").alias("m"), F.count_distinct("event_ticker").alias("e"))
    both = t.withColumn("one", F.lit(1)).join(m.withColumn("one", F.lit(1)), "one")
    number = lambda c: F.format_number(F.col(c), 0)
    pct = 100.0 * M.ratio("k", "m")
    rows = [
        ("num_trades", F.col("n"), number("n")),
        ("total_contracts", F.col("c"), number("c")),
        ("total_volume_usd", M.usd("v"), F.concat(F.lit("$"), F.format_number(M.usd("v"), 2))),
        ("avg_position_size", _r(M.ratio("c", "n")), F.format_string("%.1f", M.ratio("c", "n"))),
        ("num_markets", F.col("m"), number("m")),
        ("num_events", F.col("e"), number("e")),
        ("num_tickers_with_trades", F.col("k"), number("k")),
        ("markets_with_trades_pct", _r(pct), F.format_string("%.1f%%", pct)),
    ]
    return both.select(F.inline(F.array(*[F.struct(F.lit(a).alias("metric"), b.cast("double").alias("value"), c.alias("formatted")) for a, b, c in rows])))


def market_tree(markets: DataFrame) -> DataFrame:
    """Volume and number of markets by group, category and subcategory; the taxonomy is applied to categories, not to rows."""
    by_category = markets.select(S.category().alias("name"), F.coalesce("volume", F.lit(0)).alias("volume")).groupBy("name").agg(F.sum("volume").alias("v"), F.count("*").alias("n"))
    placed = by_category.select(hierarchy(F.col("name")).alias("h"), "v", "n")
    return placed.groupBy("h.group", "h.category", "h.subcategory").agg(F.sum("v").alias("total_contracts"), F.sum("n").alias("market_count"))


def visible_tree(tree: DataFrame, least: float = 0.01) -> DataFrame:
    """The tree without branches under one hundredth of their parent."""
    group, category = Window.partitionBy("group"), Window.partitionBy("group", "category")
    sized = tree.withColumn("_g", F.sum("total_contracts").over(group)).withColumn("_c", F.sum("total_contracts").over(category))
    return sized.filter((M.ratio("_c", "_g") >= least) & (M.ratio("total_contracts", "_c") >= least)).drop("_g", "_c")


@query(
    "a02_market_types",
    WITH + f", c AS (SELECT {_CATEGORY} AS category, coalesce(volume, 0) AS volume FROM markets)"
    f' SELECT {group_sql("category")} AS "group", CAST(sum(volume) AS BIGINT) AS total_contracts, count(*) AS market_count FROM c GROUP BY 1',
)
def a02_market_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume and markets by group."""
    tree = market_tree(view(spark, sf_dir, "markets"))
    return tree.groupBy("group").agg(F.sum("total_contracts").alias("total_contracts"), F.sum("market_count").alias("market_count"))


@query(
    "a03_trade_size_by_role",
    POSITIONS
    + """ SELECT role, round(avg(x), 6) AS mean_trade_size, round(median(x), 6) AS median_trade_size, round(stddev_pop(x), 6) AS std_trade_size,
 round(quantile_cont(x, 0.25), 6) AS p25_trade_size, round(quantile_cont(x, 0.75), 6) AS p75_trade_size, round(quantile_cont(x, 0.90), 6) AS p90_trade_size,
 round(quantile_cont(x, 0.95), 6) AS p95_trade_size, round(avg(contracts), 6) AS mean_contracts, round(CAST(median(contracts) AS DOUBLE), 6) AS median_contracts,
 count(*) AS n_trades, round(sum(x), 2) AS total_volume
FROM (SELECT role, contracts, CAST(contracts * price AS DOUBLE) / 100.0 AS x FROM pos) GROUP BY role""",
)
def a03_trade_size_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes in dollars by role. Exact percentiles over (cents, frequency), so state grows with distinct sizes only."""
    sized = positions(_joined(spark, sf_dir)).select("role", (F.col("contracts") * F.col("price")).alias("cents"), "contracts")
    counted = sized.groupBy("role", "cents", "contracts").agg(F.count("*").alias("k"))
    at = lambda p: _r(F.percentile("cents", F.lit(p), F.col("k")) / 100.0)
    n = F.sum("k")
    mean = F.sum(F.col("cents") * F.col("k")) / n / 100.0
    squares = F.sum((F.col("cents").cast("decimal(20,0)") * F.col("cents") * F.col("k")).cast("decimal(38,0)")).cast("double")
    return counted.groupBy("role").agg(
        _r(mean).alias("mean_trade_size"), at(0.5).alias("median_trade_size"),
        _r(F.sqrt(F.greatest(squares / n / 1e4 - mean * mean, F.lit(0.0)))).alias("std_trade_size"),
        at(0.25).alias("p25_trade_size"), at(0.75).alias("p75_trade_size"), at(0.9).alias("p90_trade_size"), at(0.95).alias("p95_trade_size"),
        _r(F.sum(F.col("contracts") * F.col("k")) / n).alias("mean_contracts"), _r(F.percentile("contracts", F.lit(0.5), F.col("k"))).alias("median_contracts"),
        n.alias("n_trades"), F.round(F.sum(F.col("cents") * F.col("k")) / 100.0, 2).alias("total_volume"),
    )


def by_role(rows: DataFrame, *keys: str) -> DataFrame:
    """Excess sums of takers (t_) and makers (m_) side by side: one aggregation instead of a join of two."""
    sums = [c for role, prefix in (("taker", "t_"), ("maker", "m_")) for c in M.excess_sums(when=F.col("role") == role, prefix=prefix)]
    return rows.groupBy(*keys).agg(*sums)


_A04_SIDE = """CAST(sum(contracts * price) FILTER (WHERE role = '{r}') AS DOUBLE) / 100.0 AS {r}_volume,
 round(avg(CAST(won AS DOUBLE)) FILTER (WHERE role = '{r}'), 6) AS {r}_win_rate, price / 100.0 AS {r}_expected,
 round((CAST(sum(won * 100 - price) FILTER (WHERE role = '{r}') AS DOUBLE) / count(*) FILTER (WHERE role = '{r}') / 100.0), 6) AS {r}_excess, round(var_pop(won - price / 100.0) FILTER (WHERE role = '{r}'), 6) AS {r}_var,
 count(*) FILTER (WHERE role = '{r}') AS {r}_n, round(sum(contracts * (won - price / 100.0)) FILTER (WHERE role = '{r}'), 2) AS {r}_pnl"""


@query(
    "a04_maker_vs_taker_returns",
    POSITIONS + f" SELECT price, {_A04_SIDE.format(r='taker')}, {_A04_SIDE.format(r='maker')} FROM pos WHERE price BETWEEN 1 AND 99 GROUP BY price"
    " HAVING count(*) FILTER (WHERE role = 'taker') > 0 AND count(*) FILTER (WHERE role = 'maker') > 0",
)
def a04_maker_vs_taker_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rates, excess returns, volume and profit of both roles by price."""
    return _returns_by_price(spark, sf_dir).drop("taker_z", "maker_z")


def _returns_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = by_role(positions(_joined(spark, sf_dir)).filter(F.col("price").between(1, 99)), "price").filter("t_n > 0 and m_n > 0")
    out: list[Column] = [F.col("price")]
    for role, p in (("taker", "t_"), ("maker", "m_")):
        z = M.mean_excess(p) / F.nullif(M.standard_error(M.var_pop(p), p + "n"), F.lit(0.0))
        out += [
            M.usd(p + "scp").alias(f"{role}_volume"), _r(M.win_rate(p)).alias(f"{role}_win_rate"), (F.col("price") / 100.0).alias(f"{role}_expected"),
            _r(M.mean_excess(p)).alias(f"{role}_excess"), _r(M.var_pop(p)).alias(f"{role}_var"), F.col(p + "n").alias(f"{role}_n"),
            F.round(M.usd(p + "scx"), 2).alias(f"{role}_pnl"), z.alias(f"{role}_z"),
        ]
    return both.select(*out)


@query("a04_pvalues")
def a04_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z statistics and two-sided p by price; at most 99 rows reach the Arrow function."""
    @F.pandas_udf("double")
    def p_value(z: pd.Series) -> pd.Series:
        return z.map(lambda v: None if pd.isna(v) else normal_two_sided(v))

    rows = _returns_by_price(spark, sf_dir).select("price", "taker_z", "maker_z")
    return rows.select("price", "taker_z", p_value("taker_z").alias("taker_p"), "maker_z", p_value("maker_z").alias("maker_p"))


_LEGS = (
    POSITIONS
    + """, legs AS (SELECT 'YES' AS side, yes_price AS price, CASE WHEN result = 'yes' THEN 1 ELSE 0 END AS won, count AS contracts FROM joined WHERE taker_side = 'no'
 UNION ALL SELECT 'NO', no_price, CASE WHEN result = 'no' THEN 1 ELSE 0 END, count FROM joined WHERE taker_side = 'yes')"""
)


def _sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    legs = maker_legs(_joined(spark, sf_dir)).filter(F.col("price").between(1, 99))
    won = F.col("contracts") * F.col("won")
    sums = [c for side, p in (("YES", "y_"), ("NO", "n_")) for c in (*M.excess_sums(when=F.col("side") == side, prefix=p), F.sum(F.when(F.col("side") == side, won)).alias(p + "scw"))]
    return legs.groupBy("price").agg(*sums)


@query(
    "a05_maker_win_rate_by_direction",
    _LEGS + " SELECT price, price / 100.0 AS implied_prob, " + ", ".join(
        f"round(CAST(sum(won * contracts) FILTER (WHERE side = '{s}') AS DOUBLE) / nullif(sum(contracts) FILTER (WHERE side = '{s}'), 0), 6) AS {p}_win_rate,"
        f" round(CAST(sum(won * contracts) FILTER (WHERE side = '{s}') AS DOUBLE) / nullif(sum(contracts) FILTER (WHERE side = '{s}'), 0) - price / 100.0, 6) AS {p}_mispricing,"
        f" nullif(count(*) FILTER (WHERE side = '{s}'), 0) AS {p}_n, CAST(sum(contracts) FILTER (WHERE side = '{s}') AS BIGINT) AS {p}_contracts"
        for s, p in (("YES", "yes"), ("NO", "no"))
    ) + " FROM legs WHERE price BETWEEN 1 AND 99 GROUP BY price",
)
def a05_maker_win_rate_by_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract-weighted win rates of what makers bought, by price; a side without trades is null, as in an outer join."""
    out: list[Column] = [F.col("price"), (F.col("price") / 100.0).alias("implied_prob")]
    for name, p in (("yes", "y_"), ("no", "n_")):
        rate = M.ratio(p + "scw", p + "sc")
        out += [_r(rate).alias(f"{name}_win_rate"), _r(rate - F.col("price") / 100.0).alias(f"{name}_mispricing"), F.col(p + "n").alias(f"{name}_n"), F.col(p + "sc").alias(f"{name}_contracts")]
    return _sides(spark, sf_dir).select(*out)


@query(
    "a06_maker_returns_by_direction",
    _LEGS + " SELECT * EXCLUDE (yes_x, no_x), round(no_x - yes_x, 6) AS diff FROM (SELECT price, " + ", ".join(
        f"round(avg(CAST(won AS DOUBLE)) FILTER (WHERE side = '{s}'), 6) AS {p}_win_rate, (CAST(sum(won * 100 - price) FILTER (WHERE side = '{s}') AS DOUBLE) / count(*) FILTER (WHERE side = '{s}') / 100.0) AS {p}_x,"
        f" round((CAST(sum(won * 100 - price) FILTER (WHERE side = '{s}') AS DOUBLE) / count(*) FILTER (WHERE side = '{s}') / 100.0), 6) AS {p}_excess, nullif(count(*) FILTER (WHERE side = '{s}'), 0) AS {p}_n,"
        f" CAST(sum(contracts) FILTER (WHERE side = '{s}') AS BIGINT) AS {p}_contracts, CAST(sum(contracts * price) FILTER (WHERE side = '{s}') AS DOUBLE) / 100.0 AS {p}_volume"
        for s, p in (("YES", "yes"), ("NO", "no"))
    ) + " FROM legs WHERE price BETWEEN 1 AND 99 GROUP BY price)",
)
def a06_maker_returns_by_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade-weighted excess of what makers bought, by price, with the difference of both sides."""
    out: list[Column] = [F.col("price")]
    for name, p in (("yes", "y_"), ("no", "n_")):
        out += [
            _r(M.win_rate(p)).alias(f"{name}_win_rate"), F.round(M.mean_excess(p), 12).alias(f"{name}_x"), _r(M.mean_excess(p)).alias(f"{name}_excess"),
            F.col(p + "n").alias(f"{name}_n"), F.col(p + "sc").alias(f"{name}_contracts"), M.usd(p + "scp").alias(f"{name}_volume"),
        ]
    return _sides(spark, sf_dir).select(*out, _r(M.mean_excess("n_") - M.mean_excess("y_")).alias("diff")).drop("yes_x", "no_x")


_A07 = ", ".join(
    f"count(*){f} AS {r}_trades, CAST(sum(won){f} AS BIGINT) AS {r}_wins, round(100.0 * sum(won){f} / CAST(count(*){f} AS DOUBLE), 6) AS {r}_win_rate,"
    f" round((100.0 * sum(won){f} / CAST(count(*){f} AS DOUBLE) - price) / price * 100, 6) AS {r}_mispricing_pct,"
    f" round(100.0 * sum(won){f} / CAST(count(*){f} AS DOUBLE) - price, 6) AS {r}_mispricing_pp"
    for r, f in (("taker", " FILTER (WHERE role = 'taker')"), ("maker", " FILTER (WHERE role = 'maker')"), ("combined", ""))
)


@query(
    "a07_mispricing_by_price",
    POSITIONS + f" SELECT price, CAST(price AS DOUBLE) AS implied_probability, {_A07} FROM pos WHERE price BETWEEN 1 AND 99 GROUP BY price"
    " HAVING count(*) FILTER (WHERE role = 'taker') > 0 AND count(*) FILTER (WHERE role = 'maker') > 0",
)
def a07_mispricing_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rates against price for takers, makers and both."""
    both = by_role(positions(_joined(spark, sf_dir)).filter(F.col("price").between(1, 99)), "price").filter("t_n > 0 and m_n > 0")
    both = both.withColumn("c_n", F.col("t_n") + F.col("m_n")).withColumn("c_sw", F.col("t_sw") + F.col("m_sw"))
    price = F.col("price").cast("double")
    out: list[Column] = [F.col("price"), price.alias("implied_probability")]
    for role, p in (("taker", "t_"), ("maker", "m_"), ("combined", "c_")):
        rate = F.lit(100.0) * F.col(p + "sw") / F.col(p + "n").cast("double")
        out += [
            F.col(p + "n").alias(f"{role}_trades"), F.col(p + "sw").alias(f"{role}_wins"), _r(rate).alias(f"{role}_win_rate"),
            _r((rate - price) / price * 100).alias(f"{role}_mispricing_pct"), _r(rate - price).alias(f"{role}_mispricing_pp"),
        ]
    return both.select(*out)


@query("a08_win_rate_by_price", POSITIONS + " SELECT price, count(*) AS total_trades, CAST(sum(won) AS BIGINT) AS wins, round(100.0 * sum(won) / CAST(count(*) AS DOUBLE), 6) AS win_rate FROM pos GROUP BY price")
def a08_win_rate_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rate of both sides at every price, 0 and 100 included."""
    rows = positions(_joined(spark, sf_dir)).groupBy("price").agg(F.count("*").alias("total_trades"), F.sum("won").alias("wins"))
    return rows.select("price", "total_trades", "wins", _r(F.lit(100.0) * F.col("wins") / F.col("total_trades").cast("double")).alias("win_rate"))


@query(
    "a09_yes_vs_no_by_price",
    WITH
    + """, legs AS (SELECT 'taker_yes' AS leg, yes_price AS price, count FROM trades WHERE taker_side = 'yes' UNION ALL SELECT 'taker_no', no_price, count FROM trades WHERE taker_side = 'no'
 UNION ALL SELECT 'maker_yes', yes_price, count FROM trades WHERE taker_side = 'no' UNION ALL SELECT 'maker_no', no_price, count FROM trades WHERE taker_side = 'yes'),
w AS (SELECT price, """
    + ", ".join(f"CAST(coalesce(sum(count) FILTER (WHERE leg = '{x}'), 0) AS BIGINT) AS {x}" for x in ("taker_yes", "taker_no", "maker_yes", "maker_no"))
    + """ FROM legs WHERE price BETWEEN 1 AND 99 GROUP BY price), s AS (SELECT *, taker_yes + taker_no + maker_yes + maker_no AS total FROM w)
SELECT *, """
    + ", ".join(f"round(100.0 * {x} / CAST(nullif(total, 0) AS DOUBLE), 6) AS {x}_pct" for x in ("taker_yes", "taker_no", "maker_yes", "maker_no"))
    + " FROM s",
)
def a09_yes_vs_no_by_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts by price on each side of each role, from one scan and one aggregation."""
    yes = F.col("taker_side") == "yes"
    legs = F.when(yes | (F.col("taker_side") == "no"), F.array(
        F.struct(F.when(yes, "taker_yes").otherwise("taker_no").alias("leg"), S.taker_price().alias("price")),
        F.struct(F.when(yes, "maker_no").otherwise("maker_yes").alias("leg"), S.maker_price().alias("price")),
    ))
    rows = view(spark, sf_dir, "trades").select(F.inline(legs), "count").filter(F.col("price").between(1, 99))
    names = ("taker_yes", "taker_no", "maker_yes", "maker_no")
    wide = rows.groupBy("price").agg(*[F.coalesce(F.sum(F.when(F.col("leg") == x, F.col("count"))), F.lit(0)).alias(x) for x in names])
    wide = wide.withColumn("total", sum((F.col(x) for x in names[1:]), F.col(names[0])))
    return wide.select("*", *[_r(F.lit(100.0) * M.ratio(x, "total")).alias(f"{x}_pct") for x in names])


@query("a10_volume_over_time", WITH + " SELECT date_trunc('quarter', created_time)::TIMESTAMP AS quarter, CAST(sum(count * yes_price) AS DOUBLE) / 100.0 AS volume_usd FROM trades GROUP BY 1")
def a10_volume_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume at the yes price by quarter."""
    rows = view(spark, sf_dir, "trades").groupBy(F.date_trunc("quarter", "created_time").cast("timestamp_ntz").alias("quarter"))
    return rows.agg(M.usd(F.sum(F.col("count") * F.col("yes_price"))).alias("volume_usd"))


def _takers(joined: DataFrame, *keep: Column | str) -> DataFrame:
    return joined.select(S.taker_price().alias("price"), S.taker_won().alias("won"), F.col("count").alias("contracts"), *keep)


@query(
    "a11_returns_by_hour",
    POSITIONS
    + """ SELECT *, round(x - 1.96 * s, 6) AS ci_lower, round(x + 1.96 * s, 6) AS ci_upper FROM (
SELECT CAST(extract(hour FROM created_time) AS BIGINT) AS hour_et, round(avg(CAST(won AS DOUBLE)), 6) AS win_rate, round((CAST(sum(price) AS DOUBLE) / count(*) / 100.0), 6) AS avg_implied_prob,
 (CAST(sum(won * 100 - price) AS DOUBLE) / count(*) / 100.0) AS x, sqrt(var_samp(won - price / 100.0) / count(*)) AS s, round((CAST(sum(won * 100 - price) AS DOUBLE) / count(*) / 100.0), 6) AS excess_return,
 round(var_samp(won - price / 100.0), 6) AS var_excess, CAST(sum(contracts) AS BIGINT) AS total_contracts, CAST(sum(contracts * price) AS DOUBLE) / 100.0 AS total_volume_usd,
 count(*) AS n_trades, round(sqrt(var_samp(won - price / 100.0) / count(*)), 6) AS se FROM pos WHERE role = 'taker' GROUP BY 1)""".replace("SELECT *,", "SELECT * EXCLUDE (x, s),"),
)
def a11_returns_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Takers' excess by hour of day, as times are stored."""
    rows = _takers(_joined(spark, sf_dir), S.local_hour(F.col("created_time")).alias("hour_et")).groupBy("hour_et").agg(*M.excess_sums())
    mean, se = M.mean_excess(), M.standard_error(M.var_samp(), "n")
    lower, upper = M.interval(mean, se)
    return rows.select(
        "hour_et", _r(M.win_rate()).alias("win_rate"), _r(M.ratio("sp", "n") / 100.0).alias("avg_implied_prob"), _r(mean).alias("excess_return"),
        _r(M.var_samp()).alias("var_excess"), F.col("sc").alias("total_contracts"), M.usd("scp").alias("total_volume_usd"), F.col("n").alias("n_trades"),
        _r(se).alias("se"), _r(lower).alias("ci_lower"), _r(upper).alias("ci_upper"),
    )


@query(
    "a12_vwap_by_hour",
    POSITIONS
    + """ SELECT hour_et, round(v, 6) AS vwap, total_contracts, total_volume_usd, n_trades, avg_price, std_price, round(s, 6) AS se, round(v - 1.96 * s, 6) AS ci_lower, round(v + 1.96 * s, 6) AS ci_upper FROM (
SELECT CAST(extract(hour FROM created_time) AS BIGINT) AS hour_et, CAST(sum(price * contracts) AS DOUBLE) / nullif(sum(contracts), 0) AS v, CAST(sum(contracts) AS BIGINT) AS total_contracts,
 CAST(sum(contracts * price) AS DOUBLE) / 100.0 AS total_volume_usd, count(*) AS n_trades, round(avg(price), 6) AS avg_price, round(stddev_samp(price), 6) AS std_price,
 stddev_samp(price) / sqrt(count(*)) AS s FROM pos WHERE role = 'taker' GROUP BY 1)""",
)
def a12_vwap_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Takers' volume-weighted price by hour of day."""
    rows = _takers(_joined(spark, sf_dir), S.local_hour(F.col("created_time")).alias("hour_et"))
    sums = rows.groupBy("hour_et").agg(*M.excess_sums(), F.sum(F.col("price").cast("long") * F.col("price")).alias("spp"))
    n = F.col("n").cast("double")
    std = F.sqrt((F.col("n") * F.col("spp").cast("decimal(38,0)") - F.col("sp").cast("decimal(19,0)") * F.col("sp")).cast("double") / F.nullif(n * (n - 1.0), F.lit(0.0)))
    vwap, se = M.ratio("scp", "sc"), std / F.sqrt(n)
    lower, upper = M.interval(vwap, se)
    return sums.select(
        "hour_et", _r(vwap).alias("vwap"), F.col("sc").alias("total_contracts"), M.usd("scp").alias("total_volume_usd"), F.col("n").alias("n_trades"),
        _r(M.ratio("sp", "n")).alias("avg_price"), _r(std).alias("std_price"), _r(se).alias("se"), _r(lower).alias("ci_lower"), _r(upper).alias("ci_upper"),
    )


MIN_QUARTER_TRADES = 300


@query(
    "a13_maker_taker_gap_over_time",
    POSITIONS
    + f""", q AS (SELECT role, date_trunc('quarter', created_time)::TIMESTAMP AS quarter, (CAST(sum(won * 100 - price) AS DOUBLE) / count(*) / 100.0) AS x, count(*) AS n, CAST(sum(contracts * price) AS DOUBLE) / 100.0 AS v
 FROM pos GROUP BY 1, 2 HAVING count(*) >= {MIN_QUARTER_TRADES})
SELECT t.quarter, round(t.x * 100, 6) AS taker_return, round(m.x * 100, 6) AS maker_return, round((m.x - t.x) * 100, 6) AS gap_pp, t.n AS n_trades, t.v AS volume_usd
FROM q t JOIN q m ON t.quarter = m.quarter WHERE t.role = 'taker' AND m.role = 'maker'""",
)
def a13_maker_taker_gap_over_time(spark: SparkSession, sf_dir: str, min_trades: int = MIN_QUARTER_TRADES) -> DataFrame:
    """Gap of returns by quarter, where both roles have enough trades."""
    rows = positions(_joined(spark, sf_dir), F.date_trunc("quarter", "created_time").cast("timestamp_ntz").alias("quarter"))
    both = by_role(rows, "quarter").filter((F.col("t_n") >= min_trades) & (F.col("m_n") >= min_trades))
    t, m = M.mean_excess("t_"), M.mean_excess("m_")
    return both.select("quarter", _r(t * 100).alias("taker_return"), _r(m * 100).alias("maker_return"), _r((m - t) * 100).alias("gap_pp"), F.col("t_n").alias("n_trades"), M.usd("t_scp").alias("volume_usd"))


@query(
    "a14_returns_by_category",
    POSITIONS
    + f""", c AS (SELECT category, role, (CAST(sum(won * 100 - price) AS DOUBLE) / count(*) / 100.0) AS x, count(*) AS n, sum(contracts) AS k, sum(contracts * price) / 100.0 AS v, sum(contracts * (won - price / 100.0)) AS p FROM pos GROUP BY 1, 2),
b AS (SELECT {group_sql("t.category")} AS g, t.x AS tx, m.x AS mx, t.n AS tn, m.n AS mn, t.k AS tk, m.k AS mk, t.v AS tv, m.v AS mv, t.p AS tp, m.p AS mp FROM c t JOIN c m ON t.category = m.category AND t.role = 'taker' AND m.role = 'maker')
SELECT g AS "group", round(sum(tx * tk) / nullif(sum(tk), 0) * 100, 6) AS taker_excess, round(sum(mx * mk) / nullif(sum(mk), 0) * 100, 6) AS maker_excess,
 round((sum(mx * mk) / nullif(sum(mk), 0) - sum(tx * tk) / nullif(sum(tk), 0)) * 100, 6) AS gap, CAST(sum(tn) AS BIGINT) AS taker_n, CAST(sum(mn) AS BIGINT) AS maker_n,
 round(CAST(sum(tv) AS DOUBLE), 2) AS taker_volume, round(CAST(sum(mv) AS DOUBLE), 2) AS maker_volume, round(CAST(sum(tp) AS DOUBLE), 2) AS taker_pnl, round(CAST(sum(mp) AS DOUBLE), 2) AS maker_pnl
FROM b GROUP BY g""",
)
def a14_returns_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns by group: contract-weighted means of the categories' trade means."""
    rows = positions(_joined(spark, sf_dir, True, "event_ticker"), S.category().alias("category"))
    both = by_role(rows, "category").filter("t_n > 0 and m_n > 0").withColumn("group", hierarchy(F.col("category"))["group"])
    sums = both.groupBy("group").agg(
        *[F.sum(M.mean_excess(p) * F.col(p + "sc")).alias(p + "w") for p in ("t_", "m_")],
        *[F.sum(p + c).alias(p + c) for p in ("t_", "m_") for c in ("n", "sc", "scp", "scx")],
    )
    t, m = M.ratio("t_w", "t_sc"), M.ratio("m_w", "m_sc")
    return sums.select(
        "group", _r(t * 100).alias("taker_excess"), _r(m * 100).alias("maker_excess"), _r((m - t) * 100).alias("gap"), F.col("t_n").alias("taker_n"), F.col("m_n").alias("maker_n"),
        F.round(M.usd("t_scp"), 2).alias("taker_volume"), F.round(M.usd("m_scp"), 2).alias("maker_volume"), F.round(M.usd("t_scx"), 2).alias("taker_pnl"), F.round(M.usd("m_scx"), 2).alias("maker_pnl"),
    )


def price_bucket(price: Column) -> Column:
    """Ten-cent buckets from 1 to 99; null outside."""
    out = None
    for low in range(1, 100, 10):
        high = min(low + 9, 99)
        inside, label = price.between(low, high), F.lit(f"{low}-{high}c")
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


_BUCKET = "CASE " + " ".join(f"WHEN price BETWEEN {a} AND {min(a + 9, 99)} THEN '{a}-{min(a + 9, 99)}c'" for a in range(1, 100, 10)) + " END"


@query(
    "a15_longshot_volume_share",
    POSITIONS
    + """, q AS (SELECT date_trunc('quarter', created_time)::TIMESTAMP AS quarter, price, contracts FROM pos WHERE role = 'taker')
SELECT quarter, CAST(sum(contracts * price) FILTER (WHERE price BETWEEN 1 AND 20) AS DOUBLE) / 100.0 AS volume_usd, CAST(sum(contracts) FILTER (WHERE price BETWEEN 1 AND 20) AS BIGINT) AS contracts,
 count(*) FILTER (WHERE price BETWEEN 1 AND 20) AS n_trades, CAST(sum(contracts * price) AS DOUBLE) / 100.0 AS total_volume,
 round(100.0 * sum(contracts * price) FILTER (WHERE price BETWEEN 1 AND 20) / CAST(nullif(sum(contracts * price), 0) AS DOUBLE), 6) AS longshot_share
FROM q GROUP BY quarter HAVING count(*) FILTER (WHERE price BETWEEN 1 AND 20) > 0""",
)
def a15_longshot_volume_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of volume at 1 to 20 cents by quarter; prices outside 1 to 99 count in the total."""
    rows = _takers(_joined(spark, sf_dir), F.date_trunc("quarter", "created_time").cast("timestamp_ntz").alias("quarter"))
    low, cents = F.col("price").between(1, 20), F.col("contracts") * F.col("price")
    sums = rows.groupBy("quarter").agg(F.sum(F.when(low, cents)).alias("v"), F.sum(F.when(low, F.col("contracts"))).alias("contracts"), F.count_if(low).alias("n_trades"), F.sum(cents).alias("t"))
    return sums.filter("n_trades > 0").select("quarter", M.usd("v").alias("volume_usd"), "contracts", "n_trades", M.usd("t").alias("total_volume"), _r(F.lit(100.0) * M.ratio("v", "t")).alias("longshot_share"))


@query(
    "agg24_bucket_pivot",
    POSITIONS + ", q AS (SELECT date_trunc('quarter', created_time)::TIMESTAMP AS quarter, " + _BUCKET + " AS b, contracts * price AS c FROM pos WHERE role = 'taker') SELECT quarter, "
    + ", ".join(f"CAST(coalesce(sum(c) FILTER (WHERE b = '{a}-{min(a + 9, 99)}c'), 0) AS DOUBLE) / 100.0 AS \"{a}-{min(a + 9, 99)}c\"" for a in range(1, 100, 10)) + " FROM q GROUP BY quarter",
)
def agg24_bucket_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume by quarter and price bucket, one column for each bucket."""
    rows = _takers(_joined(spark, sf_dir), F.date_trunc("quarter", "created_time").cast("timestamp_ntz").alias("quarter")).withColumn("bucket", price_bucket(F.col("price")))
    names = [f"{a}-{min(a + 9, 99)}c" for a in range(1, 100, 10)]
    return rows.groupBy("quarter").pivot("bucket", names).agg(M.usd(F.sum(F.col("contracts") * F.col("price")))).fillna(0.0)


MIN_POSITIONS_DAILY, MIN_POSITIONS_WEEKLY = 500, 1000

_A16 = WITH + f""", j AS (SELECT t.*, m.result FROM trades t JOIN markets m ON t.ticker = m.ticker WHERE m.result IN ('yes', 'no') AND t.yes_price > 0 AND t.no_price > 0),
p AS (SELECT created_time, CASE WHEN taker_side = 'yes' THEN yes_price ELSE no_price END AS price, CASE WHEN taker_side = result THEN 1 ELSE 0 END AS won FROM j
 UNION ALL SELECT created_time, CASE WHEN taker_side = 'yes' THEN no_price ELSE yes_price END, CASE WHEN taker_side <> result THEN 1 ELSE 0 END FROM j),
f AS (SELECT * FROM p WHERE price BETWEEN 1 AND 99), b AS (SELECT min(created_time) AS lo, max(created_time) AS hi FROM f),
s AS (SELECT lo, hi, CASE WHEN hi - lo < INTERVAL 7 DAY THEN lo ELSE lo + to_days(CAST((7 - dayofweek(lo)) % 7 AS INT)) END AS first_end, CASE WHEN hi - lo < INTERVAL 7 DAY THEN 1 ELSE 7 END AS step,
 CASE WHEN hi - lo < INTERVAL 7 DAY THEN {MIN_POSITIONS_DAILY} ELSE {MIN_POSITIONS_WEEKLY} END AS least FROM b),
e AS (SELECT unnest(CASE WHEN first_end > hi THEN [hi] ELSE generate_series(first_end, hi, to_days(step)) END) AS d, least FROM s),
g AS (SELECT e.d, e.least, f.price, count(*) AS n, sum(won) AS w FROM e JOIN f ON f.created_time <= e.d GROUP BY 1, 2, 3)
SELECT CAST(d AS TIMESTAMP) AS date, round(avg(abs(100.0 * w / n - price)), 6) AS mean_absolute_deviation FROM g GROUP BY d, least HAVING sum(n) >= least"""


@query("a16_calibration_deviation_over_time", _A16)
def a16_calibration_deviation_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean absolute deviation of win rates from prices, over all trades up to each period's end.

    Trades are summed by (period, price) once; running sums over at most periods x 99 rows do the rest.
    """
    trades = view(spark, sf_dir, "trades").filter((F.col("yes_price") > 0) & (F.col("no_price") > 0))
    rows = positions(resolved_trades(trades, view(spark, sf_dir, "markets"), False), F.col("created_time").alias("ts")).filter(F.col("price").between(1, 99))
    lo, hi = rows.agg(F.min("ts"), F.max("ts")).first()
    if lo is None:
        return spark.createDataFrame([], "date timestamp_ntz, mean_absolute_deviation double")
    daily = (hi - lo).days < 7
    import datetime

    first = lo if daily else lo + datetime.timedelta(days=(6 - lo.weekday()) % 7)
    step = datetime.timedelta(days=1 if daily else 7)
    ends = [first + i * step for i in range(int((hi - first) / step) + 1)] if first <= hi else [hi]
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    span = int(step.total_seconds() * 1_000_000)
    period = F.greatest(F.ceil((micros(F.col("ts")) - micros(F.lit(ends[0]))) / span), F.lit(0)).cast("int")
    sums = rows.groupBy(period.alias("period"), "price").agg(F.count("*").alias("n"), F.sum("won").alias("w")).filter(F.col("period") < len(ends))
    spine = spark.range(len(ends)).select(F.col("id").cast("int").alias("period"), F.explode(F.sequence(F.lit(1), F.lit(99))).alias("price"))
    running = Window.partitionBy("price").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    dense = spine.join(sums, ["period", "price"], "left")
    total = dense.select("period", "price", F.sum("n").over(running).alias("n"), F.sum("w").over(running).alias("w")).filter("n > 0")
    rate = F.abs(F.lit(100.0) * F.col("w") / F.col("n").cast("double") - F.col("price"))
    least = MIN_POSITIONS_DAILY if daily else MIN_POSITIONS_WEEKLY
    out = total.groupBy("period").agg(F.avg(rate).alias("d"), F.sum("n").alias("n")).filter(F.col("n") >= least)
    date = F.timestamp_micros(micros(F.lit(ends[0])) + F.col("period").cast("long") * span).cast("timestamp_ntz")
    return out.select(date.alias("date"), _r(F.col("d")).alias("mean_absolute_deviation"))


@query(
    "a18_ev_yes_vs_no",
    WITH
    + """, j AS (SELECT t.*, m.result FROM trades t JOIN markets m ON t.ticker = m.ticker WHERE m.result IN ('yes', 'no')),
y AS (SELECT yes_price AS price, CAST(sum(CASE WHEN result = 'yes' THEN count ELSE 0 END) AS DOUBLE) / nullif(sum(count), 0) AS r, CAST(sum(count) AS BIGINT) AS c FROM j GROUP BY 1),
n AS (SELECT no_price AS price, CAST(sum(CASE WHEN result = 'no' THEN count ELSE 0 END) AS DOUBLE) / nullif(sum(count), 0) AS r, CAST(sum(count) AS BIGINT) AS c FROM j GROUP BY 1)
SELECT p.price, round(100 * y.r - p.price, 6) AS yes_ev, round(y.r, 6) AS yes_win_rate, y.c AS yes_contracts, round(100 * n.r - p.price, 6) AS no_ev, round(n.r, 6) AS no_win_rate, n.c AS no_contracts,
 p.price / 100.0 AS implied_prob, round(greatest(coalesce(100 * y.r - p.price, -100), coalesce(100 * n.r - p.price, -100)), 6) AS best_ev,
 CASE WHEN coalesce(100 * y.r - p.price, -100) > coalesce(100 * n.r - p.price, -100) THEN 'YES' ELSE 'NO' END AS best_bet
FROM (SELECT range AS price FROM range(1, 100)) p LEFT JOIN y ON p.price = y.price LEFT JOIN n ON p.price = n.price""",
)
def a18_ev_yes_vs_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected value of buying yes or no at each price from 1 to 99."""
    joined = _joined(spark, sf_dir, False)
    legs = F.array(
        F.struct(F.lit("y").alias("leg"), F.col("yes_price").alias("price"), F.when(F.col("result") == "yes", F.col("count")).otherwise(0).alias("w")),
        F.struct(F.lit("n").alias("leg"), F.col("no_price").alias("price"), F.when(F.col("result") == "no", F.col("count")).otherwise(0).alias("w")),
    )
    rows = joined.select(F.inline(legs), F.col("count").alias("c")).filter(F.col("price").between(1, 99))
    sums = rows.groupBy("price").agg(*[F.sum(F.when(F.col("leg") == leg, F.col(x))).alias(leg + x) for leg in "yn" for x in "wc"])
    wide = spark.range(1, 100).select(F.col("id").alias("price")).join(sums, "price", "left")
    y, n = M.ratio("yw", "yc"), M.ratio("nw", "nc")
    ev_y, ev_n = 100 * y - F.col("price"), 100 * n - F.col("price")
    best_y, best_n = F.coalesce(ev_y, F.lit(-100.0)), F.coalesce(ev_n, F.lit(-100.0))
    return wide.select(
        "price", _r(ev_y).alias("yes_ev"), _r(y).alias("yes_win_rate"), F.col("yc").alias("yes_contracts"), _r(ev_n).alias("no_ev"), _r(n).alias("no_win_rate"), F.col("nc").alias("no_contracts"),
        (F.col("price") / 100.0).alias("implied_prob"), _r(F.greatest(best_y, best_n)).alias("best_ev"), F.when(best_y > best_n, "YES").otherwise("NO").alias("best_bet"),
    )


MIN_BIN_TRADES = 10


@query(
    "a19_win_rate_by_trade_size",
    POSITIONS
    + f""" SELECT round(power(10, CAST(b AS DOUBLE) / 4.0), 6) AS trade_size_bin, round(avg(CAST(won AS DOUBLE)), 6) AS win_rate, round((CAST(sum(price) AS DOUBLE) / count(*) / 100.0), 6) AS expected_win_rate, round((CAST(sum(won * 100 - price) AS DOUBLE) / count(*) / 100.0), 6) AS excess_win_rate,
 round(var_samp(won - price / 100.0), 6) AS var_excess, count(*) AS n_trades, CAST(sum(contracts * price) AS DOUBLE) / 100.0 AS total_volume, round(sqrt(var_samp(won - price / 100.0) / count(*)), 6) AS se,
 round((CAST(sum(won * 100 - price) AS DOUBLE) / count(*) / 100.0) - 1.96 * sqrt(var_samp(won - price / 100.0) / count(*)), 6) AS ci_lower, round((CAST(sum(won * 100 - price) AS DOUBLE) / count(*) / 100.0) + 1.96 * sqrt(var_samp(won - price / 100.0) / count(*)), 6) AS ci_upper
FROM (SELECT *, CAST(floor(log10(greatest(CAST(contracts * price AS DOUBLE) / 100.0, 0.01)) * 4) AS BIGINT) AS b FROM pos WHERE role = 'taker') GROUP BY b HAVING count(*) >= {MIN_BIN_TRADES}""",
)
def a19_win_rate_by_trade_size(spark: SparkSession, sf_dir: str, min_trades: int = MIN_BIN_TRADES) -> DataFrame:
    """Takers' excess by trade size, in quarters of a decade; rows are grouped by the bin's whole number."""
    rows = _takers(_joined(spark, sf_dir))
    bin_no = F.floor(F.log10(F.greatest(M.usd(F.col("contracts") * F.col("price")), F.lit(0.01))) * 4)
    sums = rows.groupBy(bin_no.alias("b")).agg(*M.excess_sums()).filter(F.col("n") >= min_trades)
    mean, se = M.mean_excess(), M.standard_error(M.var_samp(), "n")
    lower, upper = M.interval(mean, se)
    return sums.select(
        _r(F.pow(F.lit(10.0), F.col("b").cast("double") / 4.0)).alias("trade_size_bin"), _r(M.win_rate()).alias("win_rate"), _r(M.ratio("sp", "n") / 100.0).alias("expected_win_rate"),
        _r(mean).alias("excess_win_rate"), _r(M.var_samp()).alias("var_excess"), F.col("n").alias("n_trades"), M.usd("scp").alias("total_volume"),
        _r(se).alias("se"), _r(lower).alias("ci_lower"), _r(upper).alias("ci_upper"),
    )
