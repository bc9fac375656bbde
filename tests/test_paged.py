import pytest

from tidemark.sources import paged
from tidemark.sources.tables import HISTORICAL_TRADES, from_api


def fake_get(endpoint, parameters):
    """Trades at every hundredth second, two a page."""
    first = int(parameters.get("cursor") or -(-parameters["min_ts"] // 100) * 100)
    times = [t for t in (first, first + 100) if t <= parameters["max_ts"]]
    more = first + 200
    return {"trades": [{"trade_id": str(t), "yes_price": 5} for t in times], "cursor": str(more) if more <= parameters["max_ts"] else ""}


def test_slices_are_read_by_pages(spark):
    spark.dataSource.register(paged.PagedSource)
    options = {"getter": "tests.test_paged:fake_get", "endpoint": "/trades", "items": "trades", "min_exclusive": "0", "max_inclusive": "20000", "slice_hours": "1"}
    rows = from_api(spark.read.format("paged").options(**options).load(), HISTORICAL_TRADES)
    assert sorted(int(r.trade_id) for r in rows.collect()) == list(range(100, 20001, 100))


def test_page_limit_and_retries():
    assert len(list(paged.pages(fake_get, "", {"min_ts": 0, "max_ts": 10_000}, "trades", 2))) == 4
    calls = []

    def flaky(endpoint, parameters):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return {}

    assert paged.with_retries(flaky, wait=0)("", {}) == {} and len(calls) == 3
    with pytest.raises(OSError):
        paged.with_retries(lambda e, p: (_ for _ in ()).throw(OSError()), 2, 0)("", {})


def test_ranges_are_halved_when_refused():
    def get(endpoint, parameters):
        if parameters["to"] - parameters["from"] > 2:
            raise OverflowError
        return {"logs": [{"b": b} for b in range(parameters["from"], parameters["to"] + 1)]}

    assert [x["b"] for x in paged.ranges_of(get, "", 5, 25, "logs", 10)] == list(range(5, 26))
