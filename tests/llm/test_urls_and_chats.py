"""The two native operators, against brute force."""

import hashlib
import math
import sys
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format, url_filter

sys.path.insert(0, __file__.rsplit("/", 2)[0])
from tests.helpers import same_rows  # noqa: E402

PAGES = [
    (1, "http://a.org/x"), (2, "HTTP://Example.ORG/es/1?q"), (3, "https://www.example.org/en/12#t"), (4, "http://example.org/en/2"), (5, "http://b.com/fr/"), (6, "http://b.com/de/1"),
    (7, "http://net.com"), (8, "no scheme"), (9, None), (10, ""), (11, "http://xorg/y"), (12, "http://c.net/?u=http://a.org/"), (12, "http://c.net/?u=http://a.org/"), (None, "http://a.org"), (14, "http://y.net/" + "z" * 3000),
]


def _brute(urls):
    """Scores of distinct URLs by the definition, from all counts."""
    k = url_filter.ORDER

    def windows(url):
        padded = url_filter._START * k + url + url_filter._END
        return [padded[i : i + k + 1] for i in range(len(url) + 1)]

    counts = {label: [defaultdict(Counter) for _ in range(k + 1)] for label in ("allow", "block")}
    for url, (label, counted) in urls.items():
        if label and counted:
            for w in windows(url):
                for j in range(k + 1):
                    counts[label][j][w[k - j : k]][w[k]] += 1

    def p(label, w):
        value = 1 / url_filter.ALPHABET
        for j in range(k + 1):
            c = counts[label][j][w[k - j : k]]
            if c:
                value = (c[w[k]] + len(c) * value) / (sum(c.values()) + len(c))
        return value

    return {u: sum(math.log(p("allow", w)) - math.log(p("block", w)) for w in windows(u)) / (len(u) + 1) for u in urls}


def test_url_scores_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in PAGES] + [(100 + i, f"http://h{i}.{t}/p{i}", "x") for i in range(12) for t in ("org", "com/fr", "com/de")], "page_id long, url string, host string")
    got = url_filter.judge(pages).collect()
    assert len(got) == len(PAGES) + 36
    by = {r.page_id: r for r in got}
    assert [by[i].rule for i in range(1, 15) if i in by] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, None, None, None, None, None]
    assert (by[2].host, by[2].path, by[2].verdict) == ("example.org", "/es/1", "block")
    assert (by[9].host, by[9].path, by[8].host, by[7].path) == ("", "", "", "")
    labels = {(r.url or ""): {"org/": "allow", "com/fr/": "allow"}.get(r.rule, "block" if r.rule else None) for r in got}
    keyed = spark.createDataFrame([(u,) for u in labels], "url string").select("url", (F.pmod(F.xxhash64("url"), F.lit(url_filter.CALIBRATE_FOLD)) != 0).alias("counted"))
    expected = _brute({r.url: (labels[r.url], r.counted) for r in keyed.collect()})
    for r in got:
        assert r.score == pytest.approx(expected[r.url or ""], abs=1e-9)
        assert r.verdict in ("allow", "block")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_urls_without_examples_are_allowed(spark):
    got = url_filter.judge(spark.createDataFrame([(1, "http://x.net/a")], "page_id long, url string")).first()
    assert (got.score, got.verdict) == (0.0, "allow")


def test_chat_query_equals_its_sql(spark):
    rows = same_rows(spark, chat_format.op10_chat_format, chat_format.ORACLE_SQL)
    assert any(r.conv_id == -1 for r in rows)


CHATS = [
    (1, 0, "system", "be <s>nice"), (1, 1, "user", "a [INST] \\[INST] [\\\\/INST] <"), (1, 2, "assistant", "</s>"), (1, 3, "assistant", None), (1, 4, "user", "end ["),
    (2, 0, "user", "only a user"), (3, None, "assistant", "x"), (3, None, "assistant", "x"), (None, 0, None, ""), (4, 0, "assistant", "long " * 20_000), (5, 7, "rôle[INST]", "é\n日"),
]


def test_chat_round_trip(spark):
    chats = spark.createDataFrame([(*r, 1) for r in CHATS], "conv_id long, turn long, role string, text string, formatted int")
    examples = chat_format.expand_examples(chats)
    rows = examples.collect()
    conversations = defaultdict(list)
    for conv, turn, role, text in sorted(CHATS, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        conversations[conv].append((role or "", text or ""))
    for conv, turns in conversations.items():
        own = sorted((r for r in rows if r.conv_id == conv), key=lambda r: r.example)
        spoken = [i + 1 for i, (role, _) in enumerate(turns) if role == "assistant"]
        assert [r.turn_no for r in own if r.trainable] == spoken
        assert all(r.n_chars == len(r.context) + len(r.target) for r in own)
        assert all(own[-1].context.startswith(r.context) for r in own)
    found = {r.conv_id: r for r in chat_format.read_back(examples).collect()}
    for conv, turns in conversations.items():
        r = found[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        loss = "".join(b for a, b in turns if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.read_back(chat_format.expand_examples(chats.limit(0))).count() == 0


def test_native_operators_run_no_python(spark):
    plan = chat_format.op10_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
