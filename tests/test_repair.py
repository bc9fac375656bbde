from datetime import datetime

import pytest

from tidemark.operators import quality as Q
from tidemark.operators import repair as R
from tidemark.plans import upkeep
from tidemark.sources import files as FS

TRADE = "trade_id string, ticker string, created_time string, _run_id string, _ingested_at string"
MARKET = "ticker string, close_time string, created_time string, updated_time string, _ingested_at string"


def _trades(spark, *rows):
    return spark.createDataFrame([(i, "T", "2025-01-01T00:00:00Z", run, at) for i, run, at in rows], TRADE)


def test_repair_swaps_and_keeps_a_backup(spark, tmp_path):
    target = str(tmp_path / "trades")
    _trades(spark, ("a", "1", "2025-01-01"), ("a", "2", "2025-01-02"), ("b", "1", "2025-01-01"), ("past", "1", "2025-01-01")).write.parquet(target)
    past = _trades(spark, ("past", "0", "2024-01-01"))
    dry = R.repair_table(spark, target, "trades", "me", past, apply=False)
    assert dry["before"] == {"rows": 4, "keys": 3, "overlap": 1} and not dry["applied"] and spark.read.parquet(target).count() == 4
    report = R.repair_table(spark, target, "trades", "me", past)
    assert report["after"] == {"rows": 2, "keys": 2, "overlap": 0} and report["applied"]
    assert sorted((r.trade_id, r._run_id) for r in spark.read.parquet(target).collect()) == [("a", "2"), ("b", "1")]
    assert spark.read.parquet(report["backup"]).count() == 4
    again = R.repair_table(spark, target, "trades", "me", past)
    assert not again["applied"] and again["backup"] is None and not FS.exists(spark, f"{target}.lock")


def test_a_repair_waits_for_no_other(spark, tmp_path):
    target = str(tmp_path / "trades")
    _trades(spark, ("a", "1", "x")).write.parquet(target)
    with FS.Lock(spark, f"{target}.lock", "other"), pytest.raises(FileExistsError, match="other"):
        R.repair_table(spark, target, "trades", "me")


def test_markets_are_audited_and_repaired(spark, tmp_path):
    rows = [("M", "2025-01-01", "x", None, "1"), ("M", "2025-01-01", "x", None, "2"), ("M", "2025-02-01", "x", None, "1"), ("N", None, "2025-01-05", None, "1")]
    markets = spark.createDataFrame(rows, MARKET)
    past = spark.createDataFrame([("N", "", "2025-01-05", None, "0")], MARKET)
    assert {r.failure: r.n for r in R.audit_markets(markets, past).collect()} == {"duplicates": 1, "overlap": 1}
    target = str(tmp_path / "markets")
    markets.write.parquet(target)
    report = R.repair_table(spark, target, "markets", "me", past)
    assert report["after"] == {"rows": 2, "keys": 2, "overlap": 0}
    assert R.audit_markets(spark.read.parquet(target), past).count() == 0


def test_a_failed_move_puts_the_table_back(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(3).write.parquet(target)
    with pytest.raises(OSError):
        FS.replace_directory(spark, str(tmp_path / "nothing"), target)
    assert spark.read.parquet(target).count() == 3


def test_decisions_and_snapshot(spark):
    assert R.may_heal("WARN", 5, 10) and not R.may_heal("WARN", 11, 10) and not R.may_heal("FAIL", 1, 10) and not R.may_heal("WARN", 0, 10)
    checks = spark.createDataFrame([("A", "PASS"), ("B", "WARN"), ("C", "FAIL")], "name string, status string")
    got = R.ops_snapshot(checks, {"run_id": "r1", "checkpoint": {"watermark_trade_ts": 3600}}, 3 * 3600)
    assert got == {"checks": {"PASS": 1, "WARN": 1, "FAIL": 1}, "attention": ["B", "C"], "last_run": "r1", "watermark_trade_ts": 3600, "lag_hours": 2.0}
    assert R.ops_snapshot(checks, None, 10)["lag_hours"] is None


def test_percentile_over_counts(spark):
    markets = spark.createDataFrame([(str(i), None, "c", i % 50) for i in range(200)] + [("0", None, "c", None)], "ticker string, close_time string, created_time string, volume long")
    got = Q.market_facts(markets).first()
    assert (got["markets"], got["keys"], got["top"]) == (201, 200, 49) and got["p99"] == pytest.approx(49.0)


LINEITEM = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_linestatus string, l_shipdate timestamp"


@pytest.mark.parametrize("reverse", [False, True])
def test_repaired_trades_with_equal_times_do_not_depend_on_order(spark, tmp_path, reverse):
    day, next_day = datetime(2000, 1, 2), datetime(2000, 1, 3)
    rows = [(1, 24, 1, 3, 12.0, "F", day), (1, 48, 1, 3, 45.0, "F", day), (2, 24, 1, 1, 7.0, "O", day), (2, 24, 1, 1, 5.0, "O", next_day), (2, 24, 1, 2, 3.0, "O", day)]
    spark.createDataFrame(rows[::-1] if reverse else rows, LINEITEM).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert sorted(map(tuple, upkeep.rp1_repaired_trades(spark, str(tmp_path)).collect())) == [("MKT-1", 1, 12), ("MKT-2", 2, 8)]
