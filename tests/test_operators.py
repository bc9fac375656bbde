import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import semantics as S
from tidemark.functions import stats
from tidemark.functions.taxonomy import default_patterns, hierarchy
from tidemark.operators import keys as K
from tidemark.operators import quality as Q
from tidemark.plans.charts import Chart, chart_of
from tidemark.plans.datasets import murphy, probability_bins
from tidemark.plans.platform2 import decode_words, outcomes
from tidemark.sources import tables as T


def test_latest_trade_wins(spark):
    rows = spark.createDataFrame([("x", "2025-01-01T00:00:00Z", 1), ("x", "2025-06-01T00:00:00Z", 2), ("x", "bad", 3), ("y", "", 4)], "trade_id string, created_time string, v int")
    assert {(r.trade_id, r.v) for r in K.latest_trades(rows).collect()} == {("x", 2), ("y", 4)}


def test_canonical_market_keeps_the_last_update(spark):
    rows = spark.createDataFrame([("t", "c", "a", "2025-01-02", "t1"), ("t", "c", "a", "2025-01-03", "t2"), ("t", "", "b", "2025-01-01", "t3")], "ticker string, close_time string, created_time string, updated_time string, title string")
    assert sorted(r.title for r in K.canonical_markets(rows).collect()) == ["t2", "t3"]


def test_null_keys_match_in_anti_join(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    known = spark.createDataFrame([(None,), ("b",)], "k string")
    assert [r.k for r in K.without_known(rows, known, ["k"]).collect()] == ["a"]


def test_average_ranks(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (5,)], "value int")
    assert {r.value: r["rank"] for r in K.average_ranks(rows, "value").collect()} == {1: 1.0, 2: 2.5, 5: 4.0}


def test_orphans_with_resume_and_cap(spark):
    trades = spark.createDataFrame([("a",), ("b",), ("c",), (" ",)], "ticker string")
    markets = spark.createDataFrame([("a",)], "ticker string")
    assert sorted(r.ticker for r in K.orphans(trades, markets).collect()) == ["b", "c"]
    done = spark.createDataFrame([("b",)], "ticker string")
    assert [r.ticker for r in K.orphans(trades, markets, done, 1).collect()] == ["c"]


ORDERED = [("EC", "Politics", "College", "All"), ("FED", "Finance", "Rates", "All"), ("DOGE", "Crypto", "Coins", "All"), ("CUOMO", "Politics", "Mayor", "Cuomo")]


@pytest.mark.parametrize(("name", "group"), [("FEDDECISION", "Politics"), ("FEDCHAIRNOM", "Finance"), ("MUSKDOGE", "Crypto"), ("zzz", "Other"), ("fed", "Finance"), ("CUOM", "Other"), ("CUOMOX", "Politics")])
def test_first_pattern_decides(spark, name, group):
    from tidemark.functions.taxonomy import Pattern

    assert spark.range(1).select(hierarchy(F.lit(name), [Pattern(*p) for p in ORDERED]).alias("h")).first().h["group"] == group


def test_taxonomy_file_of_the_session(spark, tmp_path):
    from tidemark.functions.taxonomy import TAXONOMY, group_sql

    (tmp_path / "table.json").write_text("".join(json.dumps(dict(zip(("position", "pattern", "group", "category", "subcategory"), (i, *p)))) + "\n" for i, p in enumerate(ORDERED)))
    spark.conf.set(TAXONOMY, str(tmp_path / "table.json"))
    try:
        h = spark.range(1).select(hierarchy(F.lit("FEDDECISION")).alias("h")).first().h
        assert (h["group"], h["category"], h["subcategory"]) == ORDERED[0][1:] and "CUOMO" in group_sql("c")
    finally:
        spark.conf.unset(TAXONOMY)


def test_taxonomy_is_a_parameter(spark):
    table = spark.createDataFrame([(1, "AB", "G", "C", "S"), (0, "A", "G2", "C2", "S2")], "position int, pattern string, `group` string, category string, subcategory string")
    from tidemark.functions.taxonomy import load_patterns

    assert load_patterns(table)[0].group == "G2"
    assert len(default_patterns()) < 250


def test_category_of_event_tickers(spark):
    rows = spark.createDataFrame([(None,), ("",), ("lower-25",), ("NFL-1",)], "event_ticker string")
    assert [r.c for r in rows.select(S.category().alias("c")).collect()] == ["independent"] * 3 + ["NFL"]


def test_effective_count(spark):
    rows = spark.createDataFrame([(0, "46.00"), (3, "5"), (None, "x")], "count long, count_fp string")
    assert [r.c for r in rows.select(S.effective_count().alias("c")).collect()] == [46.0, 3.0, None]


def test_murphy_of_calibrated_and_single_bins(spark):
    m = stats.murphy([50, 50], [0.25, 0.75], [0.25, 0.75])
    assert (m["o_bar"], m["reliability"], m["resolution"], m["uncertainty"]) == (0.5, 0.0, 0.0625, 0.25)
    one = stats.murphy([100], [0.5], [0.6])
    assert [round(one[k], 9) for k in ("reliability", "resolution", "uncertainty", "brier")] == [0.01, 0.0, 0.24, 0.25]
    with pytest.raises(ValueError):
        stats.murphy([], [], [])
    bins = spark.createDataFrame([(50, 0.25, 0.25), (50, 0.75, 0.75)], "n_k long, p_bar_k double, o_bar_k double")
    row = murphy(bins).first()
    assert (row.reliability, row.resolution, row.uncertainty) == (0.0, 0.0625, 0.25)
    with pytest.raises(ValueError):
        probability_bins(bins, 2)


def test_distribution_functions():
    assert abs(stats.normal_two_sided(1.959963985) - 0.05) < 1e-9
    assert abs(stats.student_two_sided(2.228138852, 10) - 0.05) < 1e-8
    assert abs(stats.student_two_sided(1.0, 1) - 0.5) < 1e-9
    assert stats.student_two_sided(None, 3) is None


def test_checks_on_bad_rows(spark):
    trades = spark.createDataFrame(
        [("a", "t", "yes", 1, 50, 50, "2025-01-01T00:00:00.5Z"), ("a", "t", None, 0, 101, 0, "nonsense"), ("", "u", "no", 0, 60, 50, "2030-01-01T00:00:00Z")],
        "trade_id string, ticker string, taker_side string, count long, yes_price int, no_price int, created_time string",
    )
    markets = spark.createDataFrame([("t", "e", "finalized", "yes", 10, "2025-01-01")], "ticker string, event_ticker string, status string, result string, volume long, created_time string")
    found = {r.name: (r.status, r.value) for r in Q.run_checks(trades, markets, datetime(2026, 1, 1)).collect()}
    assert found["UNIQUENESS_TRADES"] == ("FAIL", 2.0)
    assert found["TEMPORAL_TRADES"] == ("FAIL", 1.0)
    assert found["VALUE_CONSTRAINTS_TRADES"] == ("FAIL", 1.0)
    assert found["REFERENTIAL_INTEGRITY"] == ("WARN", 1.0)
    assert found["COMPLETENESS"][0] == "WARN"
    lacking = Q.run_checks(trades.drop("ticker"), markets, datetime(2026, 1, 1))
    assert {r.name: r.status for r in lacking.collect()} == {"SCHEMA_TRADES": "FAIL", "SCHEMA_MARKETS": "PASS"}
    assert Q.summary(lacking).first().strict_failure


def test_invalid_rows_stop_a_write(spark):
    rows = spark.createDataFrame([("a", ""), ("b", "t")], "trade_id string, ticker string")
    with pytest.raises(Exception, match="invalid row"):
        Q.assert_valid(rows, "trades").collect()


def test_repair_writes_elsewhere(spark, tmp_path):
    rows = spark.createDataFrame([("x", "2025-01-01"), ("x", "2025-01-02")], "trade_id string, created_time string")
    assert Q.repair_trades(rows) == {"before": 2, "after": 1}
    assert Q.repair_trades(rows, str(tmp_path / "out")) == {"before": 2, "after": 1}


def test_outcomes_skip_what_is_no_resolution(spark):
    rows = spark.createDataFrame([('["0.999","0.001"]', True), ("['0.999','0.001']", True), ("[]", True), ("bad", True), ('["0.6","0.4"]', True), ('["0.001","0.999"]', False), ('["x","0.001"]', True)], "outcome_prices string, closed boolean")
    rows = rows.withColumn("clob_token_ids", F.lit('["A","B"]')).withColumn("market_maker_address", F.lit(""))
    assert [r.winner for r in outcomes(rows).collect()] == [0]


def test_words_of_logs(spark):
    data = "0x" + f"{5:064x}" + f"{2**64 + 7:064x}" + "f" * 64
    got = spark.range(1).select(decode_words(F.lit(data)).alias("w")).first().w
    assert [None if x is None else int(x) for x in got] == [5, 2**64 + 7, None]


def test_sources(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("a", 1)], "trade_id string, count long").write.parquet(f"{root}/historical/trades")
    spark.createDataFrame([("b", "r")], "trade_id string, _run_id string").write.parquet(f"{root}/forward/trades")
    union = T.union_of(spark, T.Catalogue(root).trade_paths(), ["trade_id", "count"])
    assert {(r.trade_id, r["count"]) for r in union.collect()} == {("a", 1), ("b", None)}
    with pytest.raises(FileNotFoundError):
        T.union_of(spark, T.Catalogue(root).market_paths(), ["ticker"])
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "stub.parquet").write_text("version https://git-lfs.github.com/spec/v1\n")
    assert [r.reason for r in T.unreadable_files(spark, f"{root}/bad").collect()] == ["pointer"]
    (tmp_path / "rows.csv").write_text("ticker,volume\nx,3\n")
    T.bootstrap_csv(spark, f"{root}/rows.csv", f"{root}/csv", T._struct("s:ticker;l:volume"))
    rows = spark.read.parquet(f"{root}/csv")
    T.top_up(rows, None, f"{root}/store")
    T.top_up(rows, spark.read.parquet(f"{root}/store"), f"{root}/store")
    assert spark.read.parquet(f"{root}/store").count() == 1
    lookup = spark.createDataFrame([('{"0xAB": {"collateral_symbol": "USDC"}, "0xCD": {"collateral_symbol": "DAI"}}',)], "text string")
    assert [r.fpmm_address for r in T.usdc_addresses(lookup).collect()] == ["0xab"]
    api = spark.createDataFrame([('{"trade_id": "q", "yes_price": 5}',)], "json string")
    row = T.from_api(api, T.HISTORICAL_TRADES).first()
    assert (row.trade_id, row.yes_price, row.no_price, row.ticker) == ("q", 5, 0, "")


def test_chart(spark):
    rows = spark.createDataFrame([(2, None), (1, 1.234)], "x int, y double")
    assert chart_of(rows, "line", "x", ["y"]).to_dict() == {"type": "line", "data": [{"x": 1, "y": 1.23}, {"x": 2, "y": 0}], "x": "x", "y": ["y"]}
    with pytest.raises(ValueError):
        Chart("donut", [])


def test_one_scan_of_each_table(spark):
    from tidemark.plans.analyses import a08_win_rate_by_price

    plan = a08_win_rate_by_price(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
