"""Physical tables: source sets, tolerant scans, provenance, readability, JSON lookups, CSV bootstrap and sinks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(text: str) -> T.StructType:
    kinds = {"s": _S, "l": _L, "i": _I, "d": _D, "b": _B}
    return T.StructType([T.StructField(n, kinds[k]) for k, names in (p.split(":") for p in text.split(";")) for n in names.split()])


#: Columns of stored trades and markets; forward tables add how and when a row was taken in.
TRADE_COLUMNS = "s:trade_id ticker taker_side;l:count;i:yes_price no_price;d:price;s:created_time count_fp yes_price_dollars no_price_dollars"
MARKET_COLUMNS = (
    "s:ticker event_ticker market_type title subtitle yes_sub_title no_sub_title status result;"
    "i:yes_bid yes_ask no_bid no_ask last_price previous_price previous_yes_bid previous_yes_ask;"
    "l:volume volume_24h open_interest liquidity;i:tick_size;s:strike_type;d:floor_strike cap_strike;b:can_close_early;"
    "s:rules_primary rules_secondary expiration_value settlement_value open_time close_time created_time updated_time "
    "expected_expiration_time expiration_time latest_expiration_time settlement_ts;i:notional_value;d:dollar_volume dollar_open_interest"
)
PROVENANCE = "s:_run_id _ingested_at _source"
HISTORICAL_TRADES, FORWARD_TRADES = _struct(TRADE_COLUMNS), _struct(f"{TRADE_COLUMNS};{PROVENANCE}")
HISTORICAL_MARKETS, FORWARD_MARKETS = _struct(MARKET_COLUMNS), _struct(f"{MARKET_COLUMNS};l:_effective_ts;{PROVENANCE}")


@dataclass(frozen=True)
class Catalogue:
    """Where the tables of a corpus lie."""

    root: str
    trades: tuple[str, ...] = ("historical/trades", "forward/trades")
    markets: tuple[str, ...] = ("historical/markets", "forward/markets")
    legacy: tuple[str, ...] = field(default=("legacy/trades",))

    def trade_paths(self, include_legacy: bool = False) -> list[str]:
        return [f"{self.root}/{p}" for p in self.trades + (self.legacy if include_legacy else ())]

    def market_paths(self) -> list[str]:
        return [f"{self.root}/{p}" for p in self.markets]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds anything, on whatever file system it names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def union_of(spark: SparkSession, paths: list[str], columns: list[str]) -> DataFrame:
    """The named columns of all sources that exist; missing columns are null."""
    found = [p for p in paths if exists(spark, p)]
    if not found:
        raise FileNotFoundError(f"none of these sources exists: {', '.join(paths)}")
    out = None
    for path in found:
        own = scan(spark, path)
        own = own.select(*[c for c in columns if c in own.columns])
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out.select(*[c for c in columns if c in out.columns])


def scan(spark: SparkSession, *paths: str, provenance: bool = False, skip_unreadable: bool = False) -> DataFrame:
    """Parquet files with a merged schema; optionally each row's file, optionally passing over broken files."""
    reader = spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", skip_unreadable)
    rows = reader.parquet(*paths)
    return rows.select("*", F.col("_metadata.file_path").alias("filename")) if provenance else rows


def missing_columns(table: DataFrame, required: T.StructType) -> list[str]:
    return sorted(set(required.names) - set(table.columns))


def unreadable_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, reason) of files that are no Parquet: pointer stubs, empty files and others."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    magic = F.lit(b"PAR1")
    head, tail = F.substring("content", 1, 4), F.substring(F.col("content"), F.length("content") - 3, F.lit(4))
    pointer = F.decode(F.substring("content", 1, 34), "utf-8").startswith("version https://git-lfs")
    reason = F.when(F.col("length") == 0, "empty").when(pointer, "pointer").when((head != magic) | (tail != magic), "not parquet")
    return files.select("path", "length", reason.alias("reason")).filter("reason is not null")


def usdc_addresses(lookup: DataFrame) -> DataFrame:
    """Lower-cased addresses of pools collateralised in USDC, from JSON objects address -> {collateral_symbol}."""
    parsed = lookup.select(F.explode(F.from_json("text", "map<string, struct<collateral_symbol: string>>")).alias("fpmm_address", "info"))
    return parsed.filter(F.col("info.collateral_symbol") == "USDC").select(F.lower("fpmm_address").alias("fpmm_address")).distinct()


def bootstrap_csv(spark: SparkSession, source: str, target: str, schema: T.StructType) -> None:
    """CSV with a header to compressed Parquet."""
    spark.read.csv(source, header=True, schema=schema).write.mode("overwrite").option("compression", "zstd").parquet(target)


def append_partition(rows: DataFrame, target: str, date: str, max_records: int = 5_000_000) -> None:
    """Append rows under dt=<date>; the commit protocol makes it all or nothing."""
    out = rows.withColumn("dt", F.lit(date))
    out.write.mode("append").partitionBy("dt").option("compression", "zstd").option("maxRecordsPerFile", max_records).parquet(target)


def top_up(rows: DataFrame, existing: DataFrame | None, target: str, key: str = "ticker", chunk: int = 10_000) -> None:
    """Append rows whose key is new, in files of at most ``chunk`` rows."""
    new = rows.dropDuplicates([key]) if existing is None else rows.join(existing.select(key), key, "left_anti").dropDuplicates([key])
    new.write.mode("append").option("maxRecordsPerFile", chunk).parquet(target)


def from_api(rows: DataFrame, schema: T.StructType, text: str = "json") -> DataFrame:
    """API objects as JSON text to typed rows: missing numbers 0, missing strings empty."""
    parsed = rows.select(F.from_json(F.col(text), schema).alias("r")).select("r.*")
    zero = {"string": F.lit(""), "bigint": F.lit(0).cast("long"), "int": F.lit(0), "double": F.lit(0.0), "boolean": F.lit(False)}
    return parsed.select(*[F.coalesce(F.col(n), zero[kind]).alias(n) for n, kind in parsed.dtypes])
