"""Repairs of whole tables: duplicates and rows that the past already has go, behind a lock, with a backup, and only if the result checks out."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.operators import keys as K
from tidemark.operators.quality import repair_markets
from tidemark.sources.files import Lock, remove, replace_directory
from tidemark.sources.tables import scan


@dataclass(frozen=True)
class Stats:
    """Rows of a table, their distinct keys, and keys that the past has too."""

    rows: int
    keys: int
    overlap: int = 0

    @property
    def clean(self) -> bool:
        return self.rows == self.keys and self.overlap == 0


def _keyed(rows: DataFrame, kind: str) -> DataFrame:
    key = F.col("trade_id") if kind == "trades" else F.concat_ws("|", "ticker", S.market_key())
    return rows.select(key.alias("key"))


def stats_row(rows: DataFrame, kind: str, historical: DataFrame | None = None) -> DataFrame:
    """(rows, keys, overlap). Keys are counted first, so that the distinct count is a count of groups."""
    counted = _keyed(rows, kind).groupBy("key").agg(F.count("*").alias("n"))
    if historical is None:
        counted = counted.withColumn("past", F.lit(0))
    else:
        counted = counted.join(_keyed(historical, kind).distinct().withColumn("past", F.lit(1)), "key", "left")
    return counted.agg(*[F.coalesce(c, F.lit(0)).alias(name) for name, c in (("rows", F.sum("n")), ("keys", F.count("*")), ("overlap", F.sum("past")))])


def table_stats(rows: DataFrame, kind: str, historical: DataFrame | None = None) -> Stats:
    return Stats(**stats_row(rows, kind, historical).first().asDict())


def audit_markets(markets: DataFrame, historical: DataFrame) -> DataFrame:
    """(failure, n) of duplicates within forward markets and overlap with the past."""
    keys = _keyed(markets, "markets").groupBy("key").agg(F.count("*").alias("n"))
    duplicates = keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")).select(F.lit("duplicates").alias("failure"), "n")
    overlap = keys.join(_keyed(historical, "markets"), "key", "left_semi").agg(F.count("*").alias("n"))
    return duplicates.unionByName(overlap.select(F.lit("overlap").alias("failure"), "n")).filter("n > 0")


def repair_table(spark: SparkSession, target: str, kind: str, owner: str, historical: DataFrame | None = None, apply: bool = True) -> dict:
    """Statistics, repair, validation, swap. Without ``apply``, or for a clean table, nothing is written.

    The repaired rows are written beside the table and counted there; only if they are clean and no key got lost do they take its
    place. The table as it was stays as a backup.
    """
    with Lock(spark, f"{target}.lock", owner):
        before = table_stats(scan(spark, target), kind, historical)
        report: dict = {"kind": kind, "before": asdict(before), "applied": False, "backup": None}
        if before.clean or not apply:
            return report
        rows = scan(spark, target)
        ties = [c for c in ("_ingested_at", "_run_id") if c in rows.columns]
        kept = K.latest_trades(rows, *ties) if kind == "trades" else repair_markets(rows, historical, *ties)
        if kind == "trades" and historical is not None:
            kept = K.without_known(kept, historical, ["trade_id"])
        staged = f"{target}.staged"
        kept.write.mode("overwrite").option("compression", "zstd").parquet(staged)
        after = table_stats(spark.read.parquet(staged), kind, historical)
        report["after"] = asdict(after)
        if not after.clean or after.rows != before.keys - before.overlap:
            remove(spark, staged)
            raise ValueError(f"repair of {target} is not clean: {report}")
        report["backup"] = replace_directory(spark, staged, target)
        report["applied"] = True
        return report


def may_heal(status: str, rows: int, cap: int) -> bool:
    """Whether an automatic repair may run: only after a warning, and only if a cap is set and holds."""
    return status == "WARN" and 0 < rows <= cap


def ops_snapshot(checks: DataFrame, manifest: dict | None, now: int) -> dict:
    """What an operator looks at first: counts of check results, what is not fine, how far and how long ago ingestion came."""
    rows = checks.select("name", "status").collect()  # one row for each check
    counts = {s: sum(r["status"] == s for r in rows) for s in ("PASS", "WARN", "FAIL")}
    mark = (manifest or {}).get("checkpoint", {}).get("watermark_trade_ts")
    return {
        "checks": counts,
        "attention": sorted(r["name"] for r in rows if r["status"] != "PASS"),
        "last_run": (manifest or {}).get("run_id"),
        "watermark_trade_ts": mark,
        "lag_hours": None if not mark else round((now - mark) / 3600, 2),
    }
