"""Categories to groups: the first pattern, in order, that a category contains.

The table is a parameter: rows of (position, pattern, group, category, subcategory), as a DataFrame or a JSON file that Spark can
read, named by the setting TAXONOMY for all queries. The default is a short table of general terms.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAXONOMY = "spark.tidemark.taxonomy"

DEFAULT = """
NFL, Sports, Football, Professional
NBA, Sports, Basketball, Professional
MLB, Sports, Baseball, Professional
NHL, Sports, Hockey, Professional
NCAA, Sports, College, All
PGA, Sports, Golf, Tour
UFC, Sports, Fighting, All
SENATE, Politics, Congress, Senate
HOUSE, Politics, Congress, House
PRES, Politics, Executive, President
GOV, Politics, States, Governors
BTC, Crypto, Coins, Bitcoin
ETH, Crypto, Coins, Ether
FED, Finance, Rates, Central bank
CPI, Finance, Indicators, Prices
GDP, Finance, Indicators, Output
INX, Finance, Indices, Large companies
NASDAQ, Finance, Indices, Technology
RAIN, Weather, Precipitation, Rain
SNOW, Weather, Precipitation, Snow
HIGH, Weather, Temperature, Daily high
OSCAR, Entertainment, Awards, Film
GRAMMY, Entertainment, Awards, Music
"""


class Pattern(NamedTuple):
    text: str
    group: str
    category: str
    subcategory: str


def default_patterns() -> list[Pattern]:
    """The table that the session names, else the short one."""
    spark = SparkSession.getActiveSession()
    path = spark.conf.get(TAXONOMY, None) if spark else None
    if path:
        return load_patterns(spark.read.json(path))
    return [Pattern(*line.split(", ")) for line in DEFAULT.strip().splitlines()]


def load_patterns(table: DataFrame) -> list[Pattern]:
    """A taxonomy from rows (position, pattern, group, category, subcategory)."""
    return [Pattern(r["pattern"], r["group"], r["category"], r["subcategory"]) for r in table.orderBy("position").toLocalIterator()]


def hierarchy(category: Column, patterns: list[Pattern] | None = None) -> Column:
    """struct(group, category, subcategory) of the first pattern that the upper-cased category contains."""
    upper = F.upper(category)
    rows = json.dumps([dict(zip(Pattern._fields, p)) for p in patterns or default_patterns()])
    entries = F.from_json(F.lit(rows), "array<struct<text: string, `group`: string, category: string, subcategory: string>>")  # one constant
    first = F.get(F.filter(entries, lambda p: F.contains(upper, p["text"])), F.lit(0))
    other = F.struct(F.lit("Other").alias("group"), F.lit("Other").alias("category"), category.alias("subcategory"))
    found = F.struct(first["group"].alias("group"), first["category"].alias("category"), first["subcategory"].alias("subcategory"))
    return F.when(first.isNull(), other).otherwise(found)


def group_sql(column: str, patterns: list[Pattern] | None = None) -> str:
    """The group as a CASE expression."""
    whens = reduce(lambda s, p: s + f" WHEN contains(upper({column}), '{p.text}') THEN '{p.group}'", patterns or default_patterns(), "CASE")
    return whens + " ELSE 'Other' END"
