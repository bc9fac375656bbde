import json
import os
import time

import pytest

from tidemark.streaming import ingest as I

TRADE = "trade_id string, ticker string, created_time string"
MARKET = "ticker string, close_time string, created_time string"


def _fetch(spark, trades, markets, calls=None):
    def fetch(kind, bounds):
        if calls is not None:
            calls.append(kind)
        return spark.createDataFrame(trades, TRADE) if kind == "trades" else spark.createDataFrame(markets, MARKET)

    return fetch


def test_slices_are_contiguous_and_cover():
    got = I.slices(1000, 1000 + 3 * 86400, 24)
    assert got[0][0] == max(1001 - I.MARKET_EXTRA_S, 0) and got[-1][1] == 1000 + 3 * 86400
    assert all(b[0] == a[1] + 1 for a, b in zip(got, got[1:]))
    assert len(I.slices(1000, 5000, 0)) == 1


def test_chunks_and_plan():
    assert [b.max_inclusive for b in I.chunks(I.Bounds(0, 200_000), 1)] == [86400, 172800, 200_000]
    assert I.plan(I.Checkpoint(2000, 2000), 1000)["trades"].empty
    assert I.plan(I.Checkpoint(100_000, 0), 200_000)["trades"] == I.Bounds(100_000 - 86400, 200_000)


def test_dedupe_and_watermarks(spark, tmp_path):
    root = str(tmp_path / "c")
    first = I.run_once(spark, root, _fetch(spark, [("already", "T", "2025-03-13T22:00:00Z")], [("TICK-1", "", "2025-03-13T22:00:00Z")]), 1741910000)
    assert first.counts["trades"]["written"] == 1
    batch = [(i, "T", "2025-03-14T00:00:00Z") for i in ("already", "dup-in-run", "dup-in-run", "new")]
    markets = [("TICK-1", "", "2025-03-13T22:00:00Z"), ("TICK-1", "", "2025-03-13T23:00:00Z"), ("TICK-1", "", "2025-03-13T23:00:00Z")]
    run = I.run_once(spark, root, _fetch(spark, batch, markets), 1741910400)
    assert run.counts["trades"] == {"written": 2, "existing": 1, "duplicate": 1, "new": 2}
    assert run.counts["markets"]["written"] == 1
    assert run.checkpoint.watermark_trade_ts == 1741910400
    again = I.run_once(spark, root, _fetch(spark, batch, markets), 1741910401)
    assert again.counts["trades"]["written"] == 0
    assert spark.read.parquet(f"{root}/trades").count() == 3
    assert json.load(open(f"{root}/manifest-{run.run_id}.json"))["counts"]["trades"]["new"] == 2


def test_no_call_for_an_empty_window(spark, tmp_path):
    calls = []
    I.Checkpoint(2000, 2000).save(str(tmp_path / "checkpoint.json"))
    I.run_once(spark, str(tmp_path), _fetch(spark, [], [], calls), 1000)
    assert calls == []


def test_dry_run_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "d")
    run = I.run_once(spark, root, _fetch(spark, [("a", "T", "2025-03-13T22:00:00Z")], [("M", "", "2025-03-13T22:00:00Z")]), 1741910400, dry_run=True)
    assert run.counts["trades"]["new"] == 1 and os.listdir(root) == []


def test_broken_checkpoint_is_set_aside(tmp_path):
    path = str(tmp_path / "checkpoint.json")
    open(path, "w").write("{")
    assert I.Checkpoint.load(path, 7) == I.Checkpoint(7, 7)
    assert os.path.exists(path + ".broken")


def test_one_writer_at_a_time(spark, tmp_path):
    (tmp_path / "run.lock").write_text("")
    with pytest.raises(FileExistsError):
        I.run_once(spark, str(tmp_path), _fetch(spark, [], []), 10)


def test_stream_drops_repeats_and_replays(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.createDataFrame([("a", "2025-01-01T00:00:00Z"), ("a", "2025-01-01T00:00:01Z"), ("b", "2025-01-01T00:00:02Z")], "trade_id string, created_time string")
    rows.write.parquet(source)
    stream = lambda: spark.readStream.schema(rows.schema).parquet(source)
    I.start_stream(stream(), target, str(tmp_path / "c1")).awaitTermination()
    rows.write.mode("append").parquet(source)
    I.start_stream(stream(), target, str(tmp_path / "c1")).awaitTermination()
    I.start_stream(stream(), target, str(tmp_path / "c2")).awaitTermination()  # everything again
    assert sorted(r.trade_id for r in spark.read.parquet(target).collect()) == ["a", "b"]


def test_a_lock_left_by_a_crash_is_taken_over(spark, tmp_path):
    (tmp_path / "run.lock").write_text(json.dumps({"owner": "gone:1", "since": 0}))
    run = I.run_once(spark, str(tmp_path), _fetch(spark, [("a", "T", "1970-01-01T00:00:05Z")], []), 10)
    assert run.counts["trades"]["written"] == 1 and not (tmp_path / "run.lock").exists()
    (tmp_path / "run.lock").write_text(json.dumps({"owner": "busy:1", "since": time.time()}))
    with pytest.raises(FileExistsError, match="busy:1"):
        I.run_once(spark, str(tmp_path), _fetch(spark, [], []), 20)


def test_state_in_another_file_system(spark, tmp_path):
    """The root is reached through a Hadoop URI that only Spark's file systems resolve."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.state.link./root", tmp_path.as_uri())
    root = "viewfs://state/root/r"
    batch = [("a", "T", "2025-03-13T22:00:00Z")]
    assert I.run_once(spark, root, _fetch(spark, batch, []), 1741910400).counts["trades"]["written"] == 1
    again = I.run_once(spark, root, _fetch(spark, batch, []), 1741910500)
    assert again.counts["trades"] == {"written": 0, "existing": 1} and again.checkpoint.total_trade_rows_written == 1


def test_only_partitions_of_the_window_are_read(spark, tmp_path):
    rows = spark.createDataFrame([("old", "T", "2025-01-01T00:00:00Z", "2025-01-01"), ("new", "T", "2025-03-14T00:00:00Z", "2025-03-14")], TRADE + ", dt string")
    rows.write.partitionBy("dt").parquet(str(tmp_path / "trades"))
    known = I.known_keys(spark, str(tmp_path / "trades"), "trades", I.Bounds(1741824000, 1741996800))
    assert [r.trade_id for r in known.collect()] == ["new"]
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dt#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(known.inputFiles()) <= 2


def test_null_keys_in_the_sink_are_existing(spark):
    rows = spark.createDataFrame([(None, "T", "1970-01-01T00:00:05Z"), ("b", "T", "1970-01-01T00:00:06Z")], TRADE)
    known = spark.createDataFrame([(None,)], "trade_id string")
    got = I.sort_batch(rows, known, ["trade_id"], I.Bounds(0, 100), I.S.epoch(I.F.col("created_time"))).collect()
    assert {r.trade_id: r._reason for r in got} == {None: "existing", "b": "new"}


def test_catching_up_commits_every_chunk(spark, tmp_path):
    day = 86400
    everything = [(f"t{d}", "T", f"1970-01-{d:02d}T12:00:00Z") for d in range(2, 6)]
    seen = []

    def fetch(kind, bounds):
        seen.append((kind, bounds.max_inclusive))
        if kind == "trades" and bounds.max_inclusive > 4 * day:
            raise OSError("the source went away")
        return spark.createDataFrame(everything if kind == "trades" else [], TRADE if kind == "trades" else MARKET)

    with pytest.raises(OSError):
        I.catch_up(spark, str(tmp_path), fetch, 6 * day, 2)
    done = I.Checkpoint.load(f"{tmp_path}/checkpoint.json")
    assert done.watermark_trade_ts == 3 * day - day // 2 + day and done.total_trade_rows_written == 3
    runs = I.catch_up(spark, str(tmp_path), _fetch(spark, everything, []), 6 * day, 2)
    assert sum(r.counts["trades"]["written"] for r in runs) == 1 and spark.read.parquet(f"{tmp_path}/trades").count() == 4


def test_bounds_of_a_run(spark):
    past = spark.createDataFrame([("a", "T", "1970-01-01T00:00:05Z"), ("b", "T", None)], TRADE)
    assert I.first_watermark(past) == 5 and I.first_watermark(past, 3) == 3 and I.first_watermark(None) == 0
    assert I.upper_bound(100) == 100 and I.upper_bound(100, 50) == 50 and I.upper_bound(100, 50, 10, 20) == 30
