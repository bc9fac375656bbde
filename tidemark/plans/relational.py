"""The relational operators one by one, over the derived views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.functions.taxonomy import group_sql, hierarchy
from tidemark.operators import keys as K
from tidemark.operators import quality as Q
from tidemark.plans.analyses import _CATEGORY, POSITIONS, _joined
from tidemark.operators.positions import positions
from tidemark.registry import query
from tidemark.sources.derived import oracle_with, view

WITH = oracle_with("markets", "trades")
TIES = ("l_partkey", "l_suppkey")
AS_OF = datetime(2024, 1, 1)


def _t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "trades")


def _m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "markets")


_LATEST = """ SELECT trade_id, created_time, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY created_time DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS r FROM trades) WHERE r = 1"""


@query("win1_dedupe_latest_trades", WITH + _LATEST)
def win1_dedupe_latest_trades(spark, sf_dir):
    """The latest row of each trade id."""
    return K.latest_trades(_t(spark, sf_dir), *TIES).select("trade_id", "created_time", *TIES)


@query(
    "win2_dedupe_latest_markets",
    """SELECT ticker, o_orderkey AS row_id FROM (SELECT *, row_number() OVER (PARTITION BY ticker, d ORDER BY o_totalprice DESC, o_orderkey DESC) AS r FROM (SELECT 'M-' || CAST(o_custkey % 50 AS VARCHAR) AS ticker, date_trunc('year', o_orderdate) AS d, o_totalprice, o_orderkey FROM orders)) WHERE r = 1""",
)
def win2_dedupe_latest_markets(spark, sf_dir):
    """The latest row of each composite key."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.concat(F.lit("M-"), F.col("o_custkey") % 50).alias("ticker"), F.date_trunc("year", "o_orderdate").alias("d"), "o_totalprice", F.col("o_orderkey").alias("row_id")
    )
    return K.keep_first(rows, ["ticker", "d"], [F.col("o_totalprice").desc_nulls_last(), F.col("row_id").desc()]).select("ticker", "row_id")


@query("win5_export_row_ids", WITH + " SELECT trade_id, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY length(trim(trade_id)), trim(trade_id), l_partkey) AS row_id FROM trades")
def win5_export_row_ids(spark, sf_dir):
    """Row numbers within a part of the data, by length and text of the id."""
    order = Window.partitionBy("l_suppkey").orderBy(F.length(F.trim("trade_id")), F.trim("trade_id"), "l_partkey")
    return _t(spark, sf_dir).select("trade_id", *TIES, F.row_number().over(order).cast("long").alias("row_id"))


@query("win6_day_gaps", WITH + ", d AS (SELECT CAST(created_time AS DATE) AS d, min(created_time) AS a, max(created_time) AS b FROM trades GROUP BY 1) SELECT d, round(epoch_us(lead(a) OVER (ORDER BY d) - b) / 3.6e9, 6) AS gap_hours FROM d")
def win6_day_gaps(spark, sf_dir):
    """Hours from each day's last trade to the next day's first; the window is over one row a day."""
    ts = F.col("created_time").cast("timestamp")
    days = _t(spark, sf_dir).groupBy(F.to_date("created_time").alias("d")).agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    gap = F.unix_micros(F.lead("a").over(Window.orderBy(F.col("d").asc_nulls_last()))) - F.unix_micros("b")
    return days.select("d", F.round(gap / 3.6e9, 6).alias("gap_hours"))


@query("win7_group_share", WITH + f", c AS (SELECT {_CATEGORY} AS category, sum(volume) AS v FROM markets GROUP BY 1) SELECT category, CAST(v AS BIGINT) AS volume, round(100.0 * v / CAST(sum(v) OVER () AS DOUBLE), 6) AS share FROM c")
def win7_group_share(spark, sf_dir):
    """Each category's share of all volume; the window is over one row a category."""
    rows = _m(spark, sf_dir).groupBy(S.category().alias("category")).agg(F.sum("volume").alias("volume"))
    return rows.select("category", "volume", F.round(F.lit(100.0) * F.col("volume") / F.sum("volume").over(Window.partitionBy()).cast("double"), 6).alias("share"))


@query("win8_shade_index", WITH + f", c AS (SELECT {group_sql('category')} AS g, category, v FROM (SELECT {_CATEGORY} AS category, sum(volume) AS v FROM markets GROUP BY 1)) SELECT g AS \"group\", category, row_number() OVER (PARTITION BY g ORDER BY v DESC, category) - 1 AS shade, count(*) OVER (PARTITION BY g) AS shades FROM c")
def win8_shade_index(spark, sf_dir):
    """A category's place within its group and the group's size."""
    rows = _m(spark, sf_dir).groupBy(S.category().alias("category")).agg(F.sum("volume").alias("v")).withColumn("group", hierarchy(F.col("category"))["group"])
    return rows.select("group", "category", (F.row_number().over(Window.partitionBy("group").orderBy(F.desc("v"), "category")) - 1).cast("long").alias("shade"), F.count("*").over(Window.partitionBy("group")).alias("shades"))


@query("win9_running_total", WITH + ", d AS (SELECT yes_price, CAST(created_time AS DATE) AS d, count(*) AS n FROM trades GROUP BY 1, 2) SELECT yes_price, d, CAST(sum(n) OVER (PARTITION BY yes_price ORDER BY d) AS BIGINT) AS running FROM d")
def win9_running_total(spark, sf_dir):
    """Trades so far by price and day."""
    rows = _t(spark, sf_dir).groupBy("yes_price", F.to_date("created_time").alias("d")).agg(F.count("*").alias("n"))
    frame = Window.partitionBy("yes_price").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("yes_price", "d", F.sum("n").over(frame).alias("running"))


@query("win10_average_ranks", WITH + ", r AS (SELECT taker_side, count, rank() OVER (PARTITION BY taker_side ORDER BY count) + (count(*) OVER (PARTITION BY taker_side, count) - 1) / 2.0 AS rank FROM trades) SELECT taker_side, count AS value, count(*) AS n, CAST(any_value(rank) AS DOUBLE) AS rank FROM r GROUP BY ALL")
def win10_average_ranks(spark, sf_dir):
    """Average ranks of sizes within a side."""
    return K.average_ranks(_t(spark, sf_dir).withColumnRenamed("count", "value"), "value", "taker_side").select("taker_side", "value", "n", F.col("rank").cast("double").alias("rank"))


@query("srt6_top_groups_and_rest", WITH + f", c AS (SELECT {_CATEGORY} AS category, sum(volume) AS v FROM markets GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY v DESC, category) AS k FROM c) SELECT CASE WHEN k <= 3 THEN category ELSE 'Rest' END AS name, CAST(sum(v) AS BIGINT) AS volume, count(*) AS n FROM r GROUP BY 1")
def srt6_top_groups_and_rest(spark, sf_dir, k: int = 3):
    """The three largest categories and the sum of the others (one row a category is ranked)."""
    rows = _m(spark, sf_dir).groupBy(S.category().alias("category")).agg(F.sum("volume").alias("v"))
    ranked = rows.withColumn("k", F.row_number().over(Window.orderBy(F.desc("v"), "category")))
    return ranked.groupBy(F.when(F.col("k") <= k, F.col("category")).otherwise("Rest").alias("name")).agg(F.sum("v").alias("volume"), F.count("*").alias("n"))


@query("srt7_limit_offset", WITH + " SELECT ticker, volume FROM markets ORDER BY volume DESC, ticker LIMIT 20 OFFSET 10")
def srt7_limit_offset(spark, sf_dir):
    """Rows 11 to 30 by volume."""
    return _m(spark, sf_dir).orderBy(F.desc("volume"), "ticker").offset(10).limit(20).select("ticker", "volume")


@query("srt9_extreme_rows", POSITIONS + ", s AS (SELECT price, round(100.0 * sum(won) / count(*) - price, 9) AS ev FROM pos WHERE role = 'taker' AND price BETWEEN 1 AND 99 GROUP BY price) SELECT (SELECT price FROM s ORDER BY ev, price LIMIT 1) AS worst_price, (SELECT price FROM s ORDER BY ev DESC, price LIMIT 1) AS best_price")
def srt9_extreme_rows(spark, sf_dir):
    """Prices of least and greatest expected value; the lower price decides among equals."""
    rows = positions(_joined(spark, sf_dir)).filter("role = 'taker' and price between 1 and 99").groupBy("price")
    ev = rows.agg(F.round(F.lit(100.0) * F.sum("won") / F.count("*").cast("double") - F.col("price"), 9).alias("ev"))
    return ev.agg(F.min_by("price", F.struct("ev", "price")).alias("worst_price"), F.min_by("price", F.struct(-F.col("ev"), "price")).alias("best_price"))


@query("set3_price_spine", WITH + " SELECT DISTINCT price FROM (SELECT yes_price AS price FROM trades UNION SELECT no_price FROM trades) WHERE price BETWEEN 1 AND 99")
def set3_price_spine(spark, sf_dir):
    """Distinct prices of both sides."""
    return _t(spark, sf_dir).select(F.explode(F.array("yes_price", "no_price")).alias("price")).filter(F.col("price").between(1, 99)).distinct()


@query("set4_except_orphans", WITH + " SELECT ticker FROM trades EXCEPT SELECT ticker FROM markets")
def set4_except_orphans(spark, sf_dir):
    """Traded tickers without a market, as a set difference."""
    return _t(spark, sf_dir).select("ticker").subtract(_m(spark, sf_dir).select("ticker"))


@query("join14_anti_composite", WITH + " SELECT t.trade_id, t.ticker FROM trades t LEFT JOIN (SELECT DISTINCT ticker, CASE WHEN result = 'yes' THEN 'yes' ELSE 'no' END AS side FROM markets) m ON t.ticker = m.ticker AND t.taker_side = m.side WHERE m.ticker IS NULL")
def join14_anti_composite(spark, sf_dir):
    """Trades whose ticker and side have no market with that outcome."""
    known = _m(spark, sf_dir).select("ticker", F.when(F.col("result") == "yes", "yes").otherwise("no").alias("taker_side"))
    return K.without_known(_t(spark, sf_dir), known, ["ticker", "taker_side"]).select("trade_id", "ticker")


@query("join15_orphans", WITH + " SELECT DISTINCT ticker FROM trades WHERE trim(ticker) <> '' AND ticker NOT IN (SELECT ticker FROM markets)")
def join15_orphans(spark, sf_dir):
    """Traded tickers without a market, as an anti join."""
    return K.orphans(_t(spark, sf_dir), _m(spark, sf_dir))


@query("join16_key_overlap", WITH + " SELECT count(*) AS n FROM (SELECT DISTINCT trade_id FROM trades WHERE l_suppkey % 2 = 0) a JOIN (SELECT DISTINCT trade_id FROM trades WHERE l_suppkey % 2 = 1) b USING (trade_id)")
def join16_key_overlap(spark, sf_dir):
    """Ids that both halves of the trades hold."""
    even = F.col("l_suppkey") % 2 == 0
    sides = _t(spark, sf_dir).groupBy("trade_id").agg(F.bool_or(even).alias("a"), F.bool_or(~even).alias("b"))
    return sides.filter("a and b").agg(F.count("*").alias("n"))


@query("join17_ingest_reasons", WITH + """, o AS (SELECT DISTINCT trade_id FROM trades WHERE created_time < TIMESTAMP '1995-01-01'), n AS (SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY created_time, l_partkey, l_suppkey) AS r FROM trades WHERE created_time >= TIMESTAMP '1995-01-01')
SELECT CASE WHEN o.trade_id IS NOT NULL THEN 'existing' WHEN r > 1 THEN 'duplicate' ELSE 'new' END AS reason, count(*) AS n FROM n LEFT JOIN o ON n.trade_id = o.trade_id GROUP BY 1""")
def join17_ingest_reasons(spark, sf_dir):
    """What becomes of a batch: rows known before, repeated within it, or new."""
    trades = _t(spark, sf_dir)
    start = F.lit("1995-01-01").cast("timestamp_ntz")
    known = trades.filter(F.col("created_time") < start).select("trade_id").distinct().withColumn("known", F.lit(True))
    rank = F.row_number().over(Window.partitionBy("trade_id").orderBy("created_time", *TIES))
    batch = trades.filter(F.col("created_time") >= start).withColumn("r", rank).join(known, "trade_id", "left")
    return batch.groupBy(F.when(F.col("known"), "existing").when(F.col("r") > 1, "duplicate").otherwise("new").alias("reason")).agg(F.count("*").alias("n"))


@query("join19_complement", POSITIONS + ", s AS (SELECT price, role, round(100.0 * sum(won) / CAST(count(*) AS DOUBLE), 6) AS w FROM pos WHERE price BETWEEN 1 AND 99 GROUP BY ALL) SELECT t.price, t.w AS taker_win_rate, coalesce(m.w, 0) AS complement_win_rate FROM s t LEFT JOIN s m ON m.role = 'maker' AND m.price = 100 - t.price WHERE t.role = 'taker'")
def join19_complement(spark, sf_dir):
    """Takers' win rate beside that of makers at the complementary price."""
    rate = F.round(F.lit(100.0) * F.sum("won") / F.count("*").cast("double"), 6)
    rates = positions(_joined(spark, sf_dir)).filter("price between 1 and 99").groupBy("price", "role").agg(rate.alias("w"))
    makers = rates.filter("role = 'maker'").select((F.lit(100) - F.col("price")).alias("price"), F.col("w").alias("m"))
    return rates.filter("role = 'taker'").join(makers, "price", "left").select("price", F.col("w").alias("taker_win_rate"), F.coalesce("m", F.lit(0.0)).alias("complement_win_rate"))


@query("agg8_composite_distinct", WITH + " SELECT count(*) AS n, count(DISTINCT ticker || '|' || coalesce(event_ticker, result, '')) AS keys FROM markets")
def agg8_composite_distinct(spark, sf_dir):
    """Distinct composite keys."""
    return _m(spark, sf_dir).agg(F.count("*").alias("n"), F.count_distinct(F.concat("ticker", F.lit("|"), F.coalesce("event_ticker", "result", F.lit("")))).alias("keys"))


@query("agg13_percentiles", WITH + " SELECT taker_side, " + ", ".join(f"quantile_cont(CAST(count AS DOUBLE), {p}) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) + " FROM trades GROUP BY 1")
def agg13_percentiles(spark, sf_dir):
    """Exact percentiles of sizes, over distinct sizes and how often they occur."""
    counted = _t(spark, sf_dir).groupBy("taker_side", "count").agg(F.count("*").alias("k"))
    return counted.groupBy("taker_side").agg(*[F.percentile("count", F.lit(p), F.col("k")).alias(f"p{int(p * 100)}") for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)])


@query("agg16_last_value", WITH + " SELECT ticker, arg_max(yes_price, (created_time, trade_id, l_partkey, l_suppkey)) AS last_price, min(created_time) AS first_time FROM trades GROUP BY ticker")
def agg16_last_value(spark, sf_dir):
    """Each ticker's last price and first time."""
    return _t(spark, sf_dir).groupBy("ticker").agg(F.max_by("yes_price", F.struct("created_time", "trade_id", *TIES)).alias("last_price"), F.min("created_time").alias("first_time"))


@query("agg18_having", WITH + " SELECT ticker, count(*) AS n FROM trades GROUP BY ticker HAVING count(*) >= 6")
def agg18_having(spark, sf_dir):
    """Tickers with at least six trades."""
    return _t(spark, sf_dir).groupBy("ticker").agg(F.count("*").alias("n")).filter("n >= 6")


@query("flt_predicates", WITH + " SELECT count(*) FILTER (WHERE status IN ('finalized', 'closed')) AS in_list, count(*) FILTER (WHERE volume BETWEEN 1000 AND 100000) AS in_range, count(*) FILTER (WHERE event_ticker IS NULL OR trim(event_ticker) = '') AS missing, count(*) FILTER (WHERE volume >= 100) AS liquid, (SELECT count(*) > 0 FROM trades WHERE yes_price = 0) AS has_zero FROM markets")
def flt_predicates(spark, sf_dir):
    """Lists, ranges, missing texts, thresholds and an existence probe."""
    probe = _t(spark, sf_dir).filter("yes_price = 0").limit(1).agg((F.count("*") > 0).alias("has_zero"), F.lit(1).alias("one"))
    rows = _m(spark, sf_dir).agg(
        F.count_if(F.col("status").isin("finalized", "closed")).alias("in_list"), F.count_if(F.col("volume").between(1000, 100000)).alias("in_range"),
        F.count_if(F.col("event_ticker").isNull() | (F.trim("event_ticker") == "")).alias("missing"), F.count_if(F.col("volume") >= 100).alias("liquid"), F.lit(1).alias("one"),
    )
    return rows.join(probe, "one").drop("one")


@query("str1_category", WITH + f" SELECT {_CATEGORY} AS category, {group_sql(_CATEGORY)} AS \"group\", count(*) AS n FROM markets GROUP BY ALL")
def str1_category(spark, sf_dir):
    """Categories and groups."""
    rows = _m(spark, sf_dir).groupBy(S.category().alias("category")).agg(F.count("*").alias("n"))
    return rows.select("category", hierarchy(F.col("category"))["group"].alias("group"), "n")


@query("dt_functions", WITH + " SELECT trade_id, l_partkey, l_suppkey, year(created_time) || ' Q' || quarter(created_time) AS quarter_label, 'Q' || quarter(created_time) || ' ''' || strftime(created_time, '%y') AS quarter_short, CAST(extract(hour FROM created_time) AS BIGINT) AS hour, CAST(epoch_us(created_time) // 1000000 AS BIGINT) AS seconds, strftime(created_time, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM trades")
def dt_functions(spark, sf_dir):
    """Labels, hours and epoch seconds of times."""
    ts = F.col("created_time")
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return _t(spark, sf_dir).select("trade_id", *TIES, S.quarter_label(ts).alias("quarter_label"), S.quarter_short(ts).alias("quarter_short"), S.local_hour(ts).alias("hour"), seconds.alias("seconds"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))


@query("dt5_iso_round_trip", WITH + " SELECT count(*) AS n, CAST(sum(CASE WHEN yes_price = 0 THEN 0 ELSE epoch_us(created_time) // 1000000 END) AS BIGINT) AS total FROM trades")
def dt5_iso_round_trip(spark, sf_dir):
    """ISO texts to seconds; what is no time (here: at price 0) counts as 0."""
    text = F.when(F.col("yes_price") == 0, "not a time").otherwise(F.date_format("created_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return _t(spark, sf_dir).select(S.epoch(text).alias("s")).agg(F.count("*").alias("n"), F.sum("s").alias("total"))


@query("mth2_log_bins", WITH + " SELECT CAST(floor(log10(greatest(CAST(count * yes_price AS DOUBLE) / 100.0, 0.01)) * 4) AS BIGINT) AS b, count(*) AS n FROM trades GROUP BY 1")
def mth2_log_bins(spark, sf_dir):
    """Trades by quarter decade of dollars."""
    usd = (F.col("count") * F.col("yes_price")).cast("double") / 100.0
    return _t(spark, sf_dir).groupBy(F.floor(F.log10(F.greatest(usd, F.lit(0.01))) * 4).alias("b")).agg(F.count("*").alias("n"))


@query("jsn_event_props", "SELECT event_type, CAST(sum(CAST(props->>'k' AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY 1")
def jsn_event_props(spark, sf_dir):
    """A field of JSON texts, summed."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", F.from_json("props", "k bigint").k.alias("k"))
    return rows.groupBy("event_type").agg(F.sum("k").alias("total"), F.count("*").alias("n"))


@query("src2_provenance_counts", "SELECT 'orders.parquet' AS file, count(*) AS n FROM orders")
def src2_provenance_counts(spark, sf_dir):
    """Rows by file name, with a merged schema."""
    from tidemark.sources.tables import scan

    rows = scan(spark, f"{sf_dir}/orders.parquet", provenance=True)
    return rows.groupBy(F.regexp_extract("filename", "([^/]+)$", 1).alias("file")).agg(F.count("*").alias("n"))


_DQ = WITH + f""", f AS (SELECT count(*) AS n, count(DISTINCT trade_id) AS ids, count(*) FILTER (WHERE created_time > TIMESTAMP '{AS_OF}') AS future, count(*) FILTER (WHERE coalesce(count, 0) = 0) AS zero FROM trades),
m AS (SELECT count(*) AS n, count(DISTINCT ticker || '|' || CAST(created_time AS VARCHAR)) AS k, max(volume) AS top, quantile_cont(volume, 0.99) AS p99 FROM markets),
d AS (SELECT CAST(created_time AS DATE) AS d, min(created_time) AS a, max(created_time) AS b FROM trades GROUP BY 1), g AS (SELECT max(h) AS h FROM (SELECT epoch_us(lead(a) OVER (ORDER BY d) - b) / 3.6e9 AS h FROM d)),
o AS (SELECT count(DISTINCT ticker) AS n FROM trades WHERE ticker NOT IN (SELECT ticker FROM markets))
SELECT 'DATA_PRESENCE' AS name, CASE WHEN f.n = 0 OR m.n = 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(f.n AS DOUBLE) AS value FROM f, m
UNION ALL SELECT 'UNIQUENESS_TRADES', CASE WHEN n > ids THEN 'FAIL' ELSE 'PASS' END, n - ids FROM f UNION ALL SELECT 'UNIQUENESS_MARKETS', CASE WHEN n > k THEN 'WARN' ELSE 'PASS' END, n - k FROM m
UNION ALL SELECT 'REFERENTIAL_INTEGRITY', CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END, n FROM o UNION ALL SELECT 'TEMPORAL_TRADES', CASE WHEN future > 0 THEN 'WARN' ELSE 'PASS' END, future FROM f
UNION ALL SELECT 'VALUE_CONSTRAINTS_TRADES', 'PASS', 0 UNION ALL SELECT 'TRADE_TIMELINE_DENSITY', CASE WHEN h > 48 THEN 'WARN' ELSE 'PASS' END, round(h, 6) FROM g
UNION ALL SELECT 'COMPLETENESS', CASE WHEN zero > 0.5 * n THEN 'WARN' ELSE 'PASS' END, zero FROM f UNION ALL SELECT 'STATISTICAL_SANITY', CASE WHEN top > 15000 * p99 THEN 'WARN' ELSE 'PASS' END, top FROM m
UNION ALL SELECT 'SCHEMA_TRADES', 'PASS', 0 UNION ALL SELECT 'SCHEMA_MARKETS', 'PASS', 0"""


@query("dq_health_checks", _DQ)
def dq_health_checks(spark, sf_dir):
    """Every check of trades and markets, from single passes."""
    checks = Q.run_checks(_t(spark, sf_dir), _m(spark, sf_dir), AS_OF)
    return checks.select("name", "status", F.round("value", 6).alias("value"))


@query("dq14_summary", "SELECT count(*) FILTER (WHERE status = 'PASS') AS pass, count(*) FILTER (WHERE status = 'WARN') AS warn, count(*) FILTER (WHERE status = 'FAIL') AS fail, count(*) FILTER (WHERE status = 'FAIL') > 0 AS strict_failure FROM (" + _DQ + ")")
def dq14_summary(spark, sf_dir):
    """How many checks passed, warned and failed."""
    return Q.summary(Q.run_checks(_t(spark, sf_dir), _m(spark, sf_dir), AS_OF))


_SPLIT = WITH + ", h AS (SELECT * FROM trades WHERE created_time < TIMESTAMP '1995-06-01'), w AS (SELECT * FROM trades WHERE created_time >= TIMESTAMP '1995-06-01')"


@query("dq8_boundary", _SPLIT + """ SELECT 'BOUNDARY_OVERLAP' AS name, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(count(*) AS DOUBLE) AS value FROM (SELECT DISTINCT trade_id FROM h WHERE trade_id IN (SELECT trade_id FROM w))
UNION ALL SELECT 'BOUNDARY_GAP', CASE WHEN x > 24 THEN 'WARN' ELSE 'PASS' END, round(x, 6) FROM (SELECT epoch_us((SELECT min(created_time) FROM w) - (SELECT max(created_time) FROM h)) / 3.6e9 AS x)
UNION ALL SELECT 'BOUNDARY_ALIGNMENT', 'PASS', 0 UNION ALL SELECT 'FORWARD_COUNT_COMPLETENESS', CASE WHEN z > 0.95 * n THEN 'WARN' ELSE 'PASS' END, z FROM (SELECT count(*) AS n, count(*) FILTER (WHERE count = 0) AS z FROM w)""")
def dq8_boundary(spark, sf_dir):
    """Checks at the boundary of past and forward trades."""
    cut = datetime(1995, 6, 1)
    trades = _t(spark, sf_dir)
    past = F.col("created_time") < F.lit(cut).cast("timestamp_ntz")
    checks = Q.run_checks(trades, _m(spark, sf_dir), AS_OF, trades.filter(past), trades.filter(~past), cut)
    names = ("BOUNDARY_OVERLAP", "BOUNDARY_GAP", "BOUNDARY_ALIGNMENT", "FORWARD_COUNT_COMPLETENESS")
    return checks.filter(F.col("name").isin(*names)).select("name", "status", F.round("value", 6).alias("value"))


@query("dq16_gauges", "SELECT 'check_' || lower(name) AS metric, CASE status WHEN 'PASS' THEN 1.0::DOUBLE WHEN 'WARN' THEN 0.5 ELSE 0.0 END AS value FROM (" + _DQ + ") UNION ALL SELECT 'check_boundary_gap', -1.0 UNION ALL SELECT 'report_age_hours', 1.5")
def dq16_gauges(spark, sf_dir):
    """Numbers for monitoring; a check that did not run gives -1."""
    checks = Q.run_checks(_t(spark, sf_dir), _m(spark, sf_dir), AS_OF)
    names = "DATA_PRESENCE UNIQUENESS_TRADES UNIQUENESS_MARKETS REFERENTIAL_INTEGRITY TEMPORAL_TRADES VALUE_CONSTRAINTS_TRADES TRADE_TIMELINE_DENSITY COMPLETENESS STATISTICAL_SANITY SCHEMA_TRADES SCHEMA_MARKETS BOUNDARY_GAP"
    return Q.gauges(checks, names.split(), 1.5)


@query("dq15_forward_audit", _SPLIT + " SELECT * FROM (SELECT 'duplicates' AS failure, count(*) - count(DISTINCT trade_id) AS n FROM w UNION ALL SELECT 'overlap', count(DISTINCT trade_id) FROM w WHERE trade_id IN (SELECT trade_id FROM h)) WHERE n > 0")
def dq15_forward_audit(spark, sf_dir):
    """Failures of forward trades: duplicates and overlap with the past."""
    trades = _t(spark, sf_dir)
    past = F.col("created_time") < F.lit(datetime(1995, 6, 1)).cast("timestamp_ntz")
    return Q.audit_forward(trades.filter(~past), trades.filter(past))


@query("src9_json_lookup", oracle_with("pm_collateral") + " SELECT lower(fpmm_address) AS fpmm_address FROM pm_collateral WHERE collateral_symbol = 'USDC'")
def src9_json_lookup(spark, sf_dir):
    """Addresses of USDC pools, from JSON."""
    from tidemark.sources.derived import collateral_json
    from tidemark.sources.tables import usdc_addresses

    return usdc_addresses(collateral_json(spark, sf_dir))


@query("src10_row_counts", "SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def src10_row_counts(spark, sf_dir):
    """Rows of tables; no column is read."""
    parts = [spark.read.parquet(f"{sf_dir}/{t}.parquet").agg(F.lit(t).alias("source"), F.count("*").alias("n")) for t in ("orders", "lineitem", "events")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src14_price_spine", "SELECT range AS price FROM range(1, 100)")
def src14_price_spine(spark, sf_dir):
    """Prices from 1 to 99."""
    return spark.range(1, 100).select(F.col("id").alias("price"))


@query("src5_union_of_sources", WITH + " SELECT trade_id, ticker, count, CASE WHEN l_suppkey % 2 = 0 THEN 'historical' ELSE 'forward' END AS layer FROM trades")
def src5_union_of_sources(spark, sf_dir):
    """Two layers with different columns as one table."""
    trades = _t(spark, sf_dir)
    past = trades.filter("l_suppkey % 2 = 0").select("trade_id", "ticker", "count")
    new = trades.filter("l_suppkey % 2 = 1").select("ticker", "trade_id", "count", F.lit("forward").alias("layer"))
    return past.unionByName(new, allowMissingColumns=True).select("trade_id", "ticker", "count", F.coalesce("layer", F.lit("historical")).alias("layer"))


@query("agg21_two_level", WITH + " SELECT ticker, CAST(sum(n) AS BIGINT) AS n FROM (SELECT ticker, count(*) AS n FROM trades WHERE taker_side = 'yes' GROUP BY 1 UNION ALL SELECT ticker, count(*) FROM trades WHERE taker_side = 'no' GROUP BY 1) GROUP BY 1")
def agg21_two_level(spark, sf_dir):
    """Counts by source, then summed: one aggregation over the union."""
    trades = _t(spark, sf_dir)
    return trades.filter("taker_side = 'yes'").select("ticker").unionAll(trades.filter("taker_side = 'no'").select("ticker")).groupBy("ticker").agg(F.count("*").alias("n"))


@query("agg27_effective_volume", WITH + " SELECT coalesce(sum(coalesce(CAST(nullif(count, 0) AS DOUBLE), TRY_CAST(count_fp AS DOUBLE))), 0) AS contracts FROM trades")
def agg27_effective_volume(spark, sf_dir):
    """Contracts over all sources, with counts given as text."""
    return _t(spark, sf_dir).agg(F.coalesce(F.sum(S.effective_count()), F.lit(0.0)).alias("contracts"))


@query("prj2_star_except", WITH + " SELECT * EXCLUDE (l_partkey, l_suppkey, created_time) FROM trades")
def prj2_star_except(spark, sf_dir):
    """All columns but some."""
    return _t(spark, sf_dir).drop("l_partkey", "l_suppkey", "created_time")


@query("set6_day_union", WITH + " SELECT DISTINCT d FROM (SELECT CAST(created_time AS DATE) AS d FROM trades UNION SELECT CAST(ts AS DATE) FROM events)")
def set6_day_union(spark, sf_dir):
    """Days on which either platform was active."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.to_date("ts").alias("d"))
    return _t(spark, sf_dir).select(F.to_date("created_time").alias("d")).union(events).distinct()


@query("flt6_semi_join", WITH + " SELECT trade_id, ticker FROM trades WHERE ticker IN (SELECT ticker FROM markets WHERE volume >= 200000)")
def flt6_semi_join(spark, sf_dir):
    """Trades of large markets."""
    large = _m(spark, sf_dir).filter("volume >= 200000").select("ticker")
    return _t(spark, sf_dir).join(large, "ticker", "left_semi").select("trade_id", "ticker")


@query("stm_event_windows", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY ALL")
def stm_event_windows(spark, sf_dir):
    """Hourly tumbling windows (an extension beside ingestion); the same expression runs on a stream."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = events.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return rows.select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")
