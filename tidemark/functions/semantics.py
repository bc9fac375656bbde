"""What prices, sides and keys mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolved(strict: bool = True) -> Column:
    """A market with an outcome; strictly, one that is also final."""
    outcome = F.col("result").isin("yes", "no")
    return outcome & (F.col("status") == "finalized") if strict else outcome


def taker_price() -> Column:
    return F.when(F.col("taker_side") == "yes", F.col("yes_price")).otherwise(F.col("no_price"))


def maker_price() -> Column:
    return F.when(F.col("taker_side") == "yes", F.col("no_price")).otherwise(F.col("yes_price"))


def taker_won() -> Column:
    return F.when(F.col("taker_side") == F.col("result"), 1).otherwise(0)


def maker_won() -> Column:
    return F.when(F.col("taker_side") != F.col("result"), 1).otherwise(0)


def effective_count() -> Column:
    """The count, or where that is 0 or missing the count given as text."""
    return F.coalesce(F.nullif(F.col("count"), F.lit(0)).cast("double"), F.col("count_fp").try_cast("double"))


def category() -> Column:
    """The leading capitals and digits of an event's ticker, or 'independent'."""
    prefix = F.regexp_extract(F.coalesce(F.col("event_ticker"), F.lit("")), "^([A-Z0-9]+)", 1)
    return F.when(prefix == "", "independent").otherwise(prefix)


def market_key() -> Column:
    """Close time, or where that is missing or empty the creation time."""
    return F.coalesce(F.nullif(F.col("close_time"), F.lit("")), F.nullif(F.col("created_time"), F.lit("")), F.lit(""))


def epoch(text: Column) -> Column:
    """Seconds of an ISO time; what is no time counts as 0."""
    return F.coalesce(F.unix_seconds(text.try_cast("timestamp")), F.lit(0).cast("long"))


def quarter_label(ts: Column) -> Column:
    return F.concat(F.year(ts), F.lit(" Q"), F.quarter(ts))


def quarter_short(ts: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(ts), F.lit(" '"), F.date_format(ts, "yy"))


def local_hour(ts: Column, tz: str | None = None) -> Column:
    """Hour of day as stored, or in a time zone on demand."""
    return F.hour(F.from_utc_timestamp(ts, tz) if tz else ts).cast("long")


def title(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))
