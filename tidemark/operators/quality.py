"""Data quality: checks from one pass over each table, gauges and repairs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.operators import keys as K
from tidemark.sources.tables import FORWARD_MARKETS, FORWARD_TRADES

SCHEMA = "name string, status string, value double"
MAX_VOLUME_TO_P99, ZERO_SHARE_WARN, FORWARD_ZERO_SHARE_WARN = 15_000, 0.5, 0.95
GAP_WARN_H, DENSITY_WARN_H, DENSITY_SEVERE_H = 24.0, 48.0, 168.0
#: Columns without which nothing can be checked.
TRADE_ESSENTIALS = ("trade_id", "ticker", "taker_side", "count", "yes_price", "no_price", "created_time")
MARKET_ESSENTIALS = ("ticker", "event_ticker", "status", "result", "volume", "created_time")


def _ts(c: str) -> Column:
    return F.col(c).try_cast("timestamp")


def _status(bad: Column, otherwise: str, fine: str = "PASS") -> Column:
    return F.when(bad, otherwise).otherwise(fine)


def trade_facts(trades: DataFrame, as_of: datetime) -> DataFrame:
    """All counts that checks of trades need, in one row from one scan."""
    ok_price = F.col("yes_price").between(0, 100) & F.col("no_price").between(0, 100)
    off_sum = (F.col("yes_price") + F.col("no_price") != 100) & ~((F.col("yes_price") == 0) & (F.col("no_price") == 0))
    ts = _ts("created_time")
    return trades.agg(
        F.count("*").alias("n"),
        F.count_distinct(F.when(F.trim("trade_id") != "", F.col("trade_id"))).alias("ids"),
        F.count_if(ts.isNull()).alias("no_time"),
        F.count_if(ts > F.lit(as_of)).alias("future"),
        F.count_if(~F.coalesce(ok_price, F.lit(False))).alias("bad_price"),
        F.count_if(off_sum).alias("bad_sum"),
        F.count_if(F.coalesce("count", F.lit(0)) == 0).alias("zero"),
        F.min(ts).alias("first"),
        F.max(ts).alias("last"),
    )


def market_facts(markets: DataFrame, close: str = "close_time") -> DataFrame:
    key = F.concat("ticker", F.lit("|"), F.coalesce(close, F.col("created_time").cast("string"), F.lit(""))) if close in markets.columns else F.concat("ticker", F.lit("|"), F.col("created_time").cast("string"))
    # By key and by volume first: the percentile then runs over distinct volumes with their counts.
    counts = markets.groupBy(key.alias("key")).agg(F.count("*").alias("n")).agg(F.sum("n").alias("markets"), F.count("key").alias("keys"))
    volumes = markets.groupBy("volume").agg(F.count("*").alias("n")).agg(F.max("volume").alias("top"), F.percentile("volume", F.lit(0.99), F.col("n")).alias("p99"))
    return counts.select(F.coalesce("markets", F.lit(0)).alias("markets"), "keys").join(F.broadcast(volumes))  # one row each


def longest_gap_h(trades: DataFrame) -> DataFrame:
    """(hours): the longest time between a day's last trade and the next day's first. The window is over one row a day."""
    days = trades.select(_ts("created_time").alias("ts")).filter("ts is not null").groupBy(F.to_date("ts").alias("d")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    following = F.lead("first").over(Window.orderBy("d"))
    return days.select(((F.unix_micros(following) - F.unix_micros("last")) / 3.6e9).alias("hours")).agg(F.max("hours").alias("hours"))


def run_checks(trades: DataFrame, markets: DataFrame, as_of: datetime, historical: DataFrame | None = None, forward: DataFrame | None = None, cutoff: datetime | None = None) -> DataFrame:
    """(name, status, value) of every check; PASS, WARN or FAIL.

    Checks that need the two parts of a corpus run where they are given; without a cutoff its check warns.
    """
    spark = trades.sparkSession
    missing_t, missing_m = [sorted(set(want) - set(t.columns)) for want, t in ((TRADE_ESSENTIALS, trades), (MARKET_ESSENTIALS, markets))]
    fixed = [("SCHEMA_TRADES", "FAIL" if missing_t else "PASS", float(len(missing_t))), ("SCHEMA_MARKETS", "FAIL" if missing_m else "PASS", float(len(missing_m)))]
    if missing_t or missing_m:
        return spark.createDataFrame(fixed, SCHEMA)
    one = F.lit(1).alias("one")
    facts = trade_facts(trades, as_of).select("*", one).join(market_facts(markets).select("*", one), "one").join(longest_gap_h(trades).select("*", one), "one")
    facts = facts.join(K.orphans(trades, markets).agg(F.count("*").alias("orphans")).select("*", one), "one")
    n = F.col("n").cast("double")
    empty = (F.col("n") == 0) | (F.col("markets") == 0)
    rows: list[tuple[str, Column, Column]] = [
        ("DATA_PRESENCE", _status(empty, "FAIL"), n),
        ("UNIQUENESS_TRADES", _status(F.col("n") > F.col("ids"), "FAIL"), F.col("n") - F.col("ids")),
        ("UNIQUENESS_MARKETS", _status(F.col("markets") > F.col("keys"), "WARN"), F.col("markets") - F.col("keys")),
        ("REFERENTIAL_INTEGRITY", _status(F.col("orphans") > 0, "WARN"), F.col("orphans")),
        ("TEMPORAL_TRADES", F.when(F.col("no_time") > 0, "FAIL").when(F.col("future") > 0, "WARN").otherwise("PASS"), F.when(F.col("no_time") > 0, F.col("no_time")).otherwise(F.col("future"))),
        ("VALUE_CONSTRAINTS_TRADES", F.when(F.col("bad_price") > 0, "FAIL").when(F.col("bad_sum") > 0, "WARN").otherwise("PASS"), F.when(F.col("bad_price") > 0, F.col("bad_price")).otherwise(F.col("bad_sum"))),
        ("TRADE_TIMELINE_DENSITY", _status(F.col("hours") > DENSITY_WARN_H, "WARN"), F.coalesce("hours", F.lit(0.0))),
        ("COMPLETENESS", _status(F.col("zero") > ZERO_SHARE_WARN * n, "WARN"), F.col("zero")),
        ("STATISTICAL_SANITY", _status(F.coalesce(F.col("top") > MAX_VOLUME_TO_P99 * F.col("p99"), F.lit(False)), "WARN"), F.coalesce("top", F.lit(0))),
    ]
    if forward is not None:
        facts = facts.join(forward.agg(F.count("*").alias("fn"), F.count_if(F.coalesce("count", F.lit(0)) == 0).alias("fz"), F.min(_ts("created_time")).alias("f_first")).select("*", one), "one")
        rows.append(("FORWARD_COUNT_COMPLETENESS", _status(F.col("fz") > FORWARD_ZERO_SHARE_WARN * F.col("fn"), "WARN"), F.col("fz")))
    if historical is not None:
        facts = facts.join(historical.agg(F.max(_ts("created_time")).alias("h_last")).select("*", one), "one")
        past = F.lit(None).cast("boolean") if cutoff is None else F.col("h_last") > F.lit(cutoff)
        rows.append(("BOUNDARY_ALIGNMENT", F.when(past.isNull(), "WARN").when(past, "FAIL").otherwise("PASS"), F.coalesce(past.cast("int"), F.lit(0))))
    if historical is not None and forward is not None:
        shared = historical.select("trade_id").distinct().join(forward.select("trade_id"), "trade_id", "left_semi")
        facts = facts.join(shared.agg(F.count("*").alias("shared")).select("*", one), "one")
        gap = (F.unix_micros("f_first") - F.unix_micros("h_last")) / 3.6e9
        rows += [("BOUNDARY_OVERLAP", _status(F.col("shared") > 0, "FAIL"), F.col("shared")), ("BOUNDARY_GAP", _status(F.coalesce(gap > GAP_WARN_H, F.lit(False)), "WARN"), F.coalesce(gap, F.lit(0.0)))]
    entries = F.array(*[F.struct(F.lit(a).alias("name"), b.alias("status"), c.cast("double").alias("value")) for a, b, c in rows])
    return facts.select(F.inline(entries)).unionByName(spark.createDataFrame(fixed, SCHEMA))


def summary(checks: DataFrame) -> DataFrame:
    """(pass, warn, fail) and whether a strict run fails."""
    count = lambda s: F.count_if(F.col("status") == s)
    return checks.agg(count("PASS").alias("pass"), count("WARN").alias("warn"), count("FAIL").alias("fail"), (count("FAIL") > 0).alias("strict_failure"))


def gauges(checks: DataFrame, expected: list[str], age_hours: float) -> DataFrame:
    """(metric, value): PASS 1, WARN 0.5, FAIL 0, missing -1, and the report's age in hours."""
    names = checks.sparkSession.createDataFrame([(n,) for n in expected], "name string")
    score = F.when(F.col("status") == "PASS", 1.0).when(F.col("status") == "WARN", 0.5).when(F.col("status") == "FAIL", 0.0).otherwise(-1.0)
    rows = names.join(checks, "name", "left").select(F.concat(F.lit("check_"), F.lower("name")).alias("metric"), score.alias("value"))
    return rows.unionByName(checks.sparkSession.createDataFrame([("report_age_hours", age_hours)], "metric string, value double"))


def assert_valid(rows: DataFrame, kind: str) -> DataFrame:
    """Rows to be written; a row without id or ticker, or a market without an effective time, stops the job."""
    required = ["trade_id", "ticker"] if kind == "trades" else ["ticker"]
    bad = F.lit(False)
    for c in required:
        bad = bad | F.coalesce(F.trim(c) == "", F.lit(True))
    if kind == "markets":
        bad = bad | F.coalesce(F.col("_effective_ts") <= 0, F.lit(True))
    return rows.filter(F.when(bad, F.raise_error(F.lit(f"invalid row among {kind}")).cast("boolean")).otherwise(True))


def audit_forward(trades: DataFrame, historical: DataFrame) -> DataFrame:
    """(failure, n) of duplicates within forward trades and overlap with the past."""
    duplicates = trades.agg((F.count("*") - F.count_distinct("trade_id")).alias("n")).select(F.lit("duplicates").alias("failure"), "n")
    overlap = trades.select("trade_id").distinct().join(historical.select("trade_id"), "trade_id", "left_semi").agg(F.count("*").alias("n"))
    return duplicates.unionByName(overlap.select(F.lit("overlap").alias("failure"), "n")).filter("n > 0")


def repair_trades(trades: DataFrame, target: str | None = None, *ties: str) -> dict[str, int]:
    """Keep the latest of each trade and write it to ``target`` (none: only count). The source is never overwritten while read."""
    kept = K.latest_trades(trades, *ties)
    before = trades.count()
    if target is None:
        return {"before": before, "after": kept.count()}
    kept.write.mode("overwrite").option("compression", "zstd").parquet(target)
    return {"before": before, "after": trades.sparkSession.read.parquet(target).count()}


def repair_markets(markets: DataFrame, historical: DataFrame | None = None, *ties: str) -> DataFrame:
    """The latest of each market, without those that the past already has."""
    kept = K.canonical_markets(markets, *ties)
    if historical is None:
        return kept
    keyed = kept.withColumn("_key", S.market_key())
    return K.without_known(keyed, historical.withColumn("_key", S.market_key()), ["ticker", "_key"]).drop("_key")


def required_columns(kind: str) -> list[str]:
    return (FORWARD_TRADES if kind == "trades" else FORWARD_MARKETS).names
