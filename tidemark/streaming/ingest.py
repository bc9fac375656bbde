"""Incremental ingestion: windows, slices, idempotent batches with watermarks, and the same as a stream.

A batch takes rows in a half-open window (watermark - lookback, upper bound], drops what the sink already holds and
what the batch repeats, writes one partition, and then moves the watermarks forward. A crash in between is
repaired by the next run, which reads the same window again and finds its rows in the sink.
"""

from __future__ import annotations

import json
import os
import socket
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import semantics as S
from tidemark.operators.quality import assert_valid
from tidemark.sources.files import Lock, move, read_text, remove, write_text
from tidemark.sources.tables import append_partition, exists, scan

LOOKBACK_S = 24 * 3600
MARKET_EXTRA_S = 7 * 24 * 3600


@dataclass(frozen=True)
class Checkpoint:
    """How far ingestion has come, in epoch seconds."""

    watermark_trade_ts: int = 0
    watermark_market_ts: int = 0
    total_trade_rows_written: int = 0
    total_market_rows_written: int = 0
    last_successful_run_id: str = ""
    checkpoint_version: int = 1

    @staticmethod
    def load(path: str, start: int = 0) -> Checkpoint:
        """The stored checkpoint; a missing one starts at ``start``, a broken one is set aside first."""
        spark = SparkSession.builder.getOrCreate()
        text = read_text(spark, path)
        if text is None:
            return Checkpoint(start, start)
        try:
            return Checkpoint(**{k: v for k, v in json.loads(text).items() if k in Checkpoint.__dataclass_fields__})
        except (ValueError, TypeError, AttributeError):
            remove(spark, f"{path}.broken")
            move(spark, path, f"{path}.broken")
            return Checkpoint(start, start)

    def save(self, path: str) -> None:
        write_text(SparkSession.builder.getOrCreate(), path, json.dumps(asdict(self)))

    def advanced(self, trade_ts: int | None, market_ts: int | None, trades: int, markets: int, run_id: str) -> Checkpoint:
        """Watermarks only ever grow."""
        return replace(
            self,
            watermark_trade_ts=max(self.watermark_trade_ts, trade_ts or 0),
            watermark_market_ts=max(self.watermark_market_ts, market_ts or 0),
            total_trade_rows_written=self.total_trade_rows_written + trades,
            total_market_rows_written=self.total_market_rows_written + markets,
            last_successful_run_id=run_id,
        )


@dataclass(frozen=True)
class Bounds:
    """(min_exclusive, max_inclusive] in epoch seconds."""

    min_exclusive: int
    max_inclusive: int

    @property
    def empty(self) -> bool:
        return self.max_inclusive <= self.min_exclusive


def plan(checkpoint: Checkpoint, upper: int, lookback: int = LOOKBACK_S, market_extra: int = MARKET_EXTRA_S) -> dict[str, Bounds]:
    """The windows of a run; nothing where the bound is not beyond the watermark."""

    def window(mark: int, back: int) -> Bounds:
        return Bounds(upper, upper) if upper <= mark else Bounds(max(0, mark - back), upper)

    return {"trades": window(checkpoint.watermark_trade_ts, lookback), "markets": window(checkpoint.watermark_market_ts, lookback + market_extra)}


def chunks(bounds: Bounds, days: int) -> list[Bounds]:
    """Consecutive windows of at most so many days; 0 days is one window."""
    if bounds.empty:
        return []
    if days <= 0:
        return [bounds]
    step = days * 86400
    starts = range(bounds.min_exclusive, bounds.max_inclusive, step)
    return [Bounds(s, min(s + step, bounds.max_inclusive)) for s in starts]


def slices(min_exclusive: int, max_inclusive: int, hours: int, extra: int = MARKET_EXTRA_S) -> list[tuple[int, int]]:
    """Contiguous inclusive slices that cover the window and a stretch before it; 0 hours is one slice."""
    first = max(min_exclusive + 1 - extra, 0)
    if hours <= 0:
        return [(first, max_inclusive)]
    step = hours * 3600
    return [(s, min(s + step - 1, max_inclusive)) for s in range(first, max_inclusive + 1, step)]


def effective_ts() -> object:
    """Epoch seconds of the later of close and creation."""
    return F.greatest(S.epoch(F.col("close_time")), S.epoch(F.col("created_time")))


@dataclass
class Run:
    """What a run did."""

    run_id: str
    windows: dict[str, Bounds]
    counts: dict[str, dict[str, int]] = field(default_factory=dict)
    checkpoint: Checkpoint = field(default_factory=Checkpoint)
    dry_run: bool = False

    def manifest(self) -> dict:
        return {"run_id": self.run_id, "dry_run": self.dry_run, "windows": {k: asdict(v) for k, v in self.windows.items()}, "counts": self.counts, "checkpoint": asdict(self.checkpoint)}


def sort_batch(rows: DataFrame, known: DataFrame | None, keys: list[str], bounds: Bounds, ts: object) -> DataFrame:
    """``rows`` with _ts and _reason: low, high, existing, duplicate or new. Of repeated keys the first by time is new."""
    timed = rows.withColumn("_ts", ts)
    if known is None:
        timed = timed.withColumn("_known", F.lit(False))
    else:
        stored = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct().withColumn("_known", F.lit(True))
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
        timed = timed.join(stored, same, "left").drop(*[f"_known_{k}" for k in keys]).withColumn("_known", F.coalesce("_known", F.lit(False)))
    inside = F.col("_ts").between(bounds.min_exclusive + 1, bounds.max_inclusive)
    rank = F.row_number().over(Window.partitionBy(*keys, inside & ~F.col("_known")).orderBy("_ts", *[c for c in rows.columns if c not in keys]))
    reason = F.when(F.col("_ts") <= bounds.min_exclusive, "low").when(F.col("_ts") > bounds.max_inclusive, "high").when(F.col("_known"), "existing").when(rank > 1, "duplicate").otherwise("new")
    return timed.withColumn("_reason", reason).drop("_known")


def known_keys(spark: SparkSession, target: str, kind: str, bounds: Bounds) -> DataFrame:
    """The sink's keys of rows in the window. Trades are written on the day they happen or later, so older partitions are not read."""
    rows = scan(spark, target)
    if kind == "trades":
        day = datetime.fromtimestamp(bounds.min_exclusive, timezone.utc).strftime("%Y-%m-%d")
        rows = rows.filter(F.col("dt").cast("date") >= F.lit(day).cast("date"))
        return rows.filter(S.epoch(F.col("created_time")).between(bounds.min_exclusive + 1, bounds.max_inclusive)).select("trade_id")
    return rows.filter(effective_ts().between(bounds.min_exclusive + 1, bounds.max_inclusive)).select("ticker", S.market_key().alias("_key"))


def run_once(
    spark: SparkSession,
    root: str,
    fetch: Callable[[str, Bounds], DataFrame],
    upper: int,
    start: int = 0,
    dry_run: bool = False,
    lookback: int = LOOKBACK_S,
    run_id: str | None = None,
    lock_s: float = 6 * 3600,
) -> Run:
    """One run: plan, fetch, sort out, validate, write, then move the watermarks.

    ``fetch(kind, bounds)`` gives rows of trades or markets. It is not called for an empty window. Two runs may not share a root
    at a time: the lock file is created exclusively, and one that a crash has left is taken over after ``lock_s`` seconds.
    """
    path = f"{root}/checkpoint.json"
    with Lock(spark, f"{root}/run.lock", f"{socket.gethostname()}:{os.getpid()}", lock_s):
        before = Checkpoint.load(path, start)
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        run = Run(run_id or uuid.uuid4().hex[:12], plan(before, upper, lookback), checkpoint=before, dry_run=dry_run)
        newest: dict[str, int | None] = {"trades": None, "markets": None}
        for kind, keys in (("trades", ["trade_id"]), ("markets", ["ticker", "_key"])):
            bounds = run.windows[kind]
            run.counts[kind] = {"written": 0}
            if bounds.empty:
                continue
            rows = fetch(kind, bounds)
            target = f"{root}/{kind}"
            if kind == "markets":
                rows = rows.withColumn("_key", S.market_key())
            ts = effective_ts() if kind == "markets" else S.epoch(F.col("created_time"))
            known = known_keys(spark, target, kind, bounds) if exists(spark, target) else None
            sorted_out = sort_batch(rows, known, keys, bounds, ts).persist()
            try:
                for r in sorted_out.groupBy("_reason").agg(F.count("*").alias("n")).collect():
                    run.counts[kind][r["_reason"]] = r["n"]
                new = sorted_out.filter("_reason = 'new'")
                newest[kind] = new.agg(F.max("_ts")).first()[0]
                if not dry_run and run.counts[kind].get("new"):
                    extra = {"_run_id": F.lit(run.run_id), "_ingested_at": F.lit(now), "_source": F.lit(f"forward_{kind}")}
                    if kind == "markets":
                        extra["_effective_ts"] = F.col("_ts")
                    valid = assert_valid(new.withColumns(extra).drop("_reason", "_ts", "_key"), kind)
                    append_partition(valid, target, now[:10])
                    run.counts[kind]["written"] = run.counts[kind]["new"]
            finally:
                sorted_out.unpersist()
        if not dry_run:
            run.checkpoint = before.advanced(newest["trades"], newest["markets"], run.counts["trades"]["written"], run.counts["markets"]["written"], run.run_id)
            run.checkpoint.save(path)
            write_text(spark, f"{root}/manifest-{run.run_id}.json", json.dumps(run.manifest()))
        return run


def catch_up(spark: SparkSession, root: str, fetch: Callable[[str, Bounds], DataFrame], upper: int, days: int, start: int = 0, **options: object) -> list[Run]:
    """A long stretch in runs of at most so many days, each of which writes its rows and moves the watermarks before the next."""
    stored = Checkpoint.load(f"{root}/checkpoint.json", start)
    whole = plan(stored, upper)["trades"]
    return [run_once(spark, root, fetch, part.max_inclusive, start, **options) for part in chunks(whole, days) if part.max_inclusive > stored.watermark_trade_ts]


def first_watermark(historical: DataFrame | None, explicit: int | None = None) -> int:
    """Where a new root starts: the explicit time, else the newest trade of the past, else 0."""
    if explicit is not None:
        return explicit
    newest = None if historical is None else historical.agg(F.max(S.epoch(F.col("created_time")))).first()[0]
    return int(newest or 0)


def upper_bound(now: int, cutoff: int | None = None, cap_s: int | None = None, watermark: int = 0) -> int:
    """Now or the cutoff, whichever comes first, and at most ``cap_s`` seconds past the watermark."""
    bound = now if cutoff is None else min(now, cutoff)
    return bound if cap_s is None else min(bound, watermark + cap_s)


def dedupe_stream(rows: DataFrame, key: str = "trade_id", time: str = "created_time", delay: str = "24 hours") -> DataFrame:
    """Each key once within the watermark; state is bounded by the delay."""
    timed = rows.withColumn("_event_time", F.col(time).try_cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key])


def start_stream(rows: DataFrame, target: str, checkpoint: str, key: str = "trade_id", delay: str = "24 hours", **trigger: object) -> StreamingQuery:
    """Deduplicated rows appended to ``target``: within the watermark by state, beyond it against the sink.

    A batch that is replayed finds its own rows in the sink and adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = batch.drop("_event_time").dropDuplicates([key])
        if exists(spark, target):
            new = new.join(spark.read.parquet(target).select(key), key, "left_anti")
        new.write.mode("append").parquet(target)

    stream = dedupe_stream(rows, key, delay=delay)
    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
