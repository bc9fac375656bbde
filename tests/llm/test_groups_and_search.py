"""Dedup, joins, decontamination, search and the pipeline, against brute force."""

import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import ann_search, clusters, decontaminate, line_dedup, ngram_join
from tidemark.session import Scratch

sys.path.insert(0, __file__.rsplit("/", 2)[0])

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def words(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n)]


def roots(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in clusters.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    whole = [p for p in pairs if None not in p and p[0] != p[1]]
    assert got == roots(whole, {n for p in whole for n in p})
    assert clusters.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def near_copies(rng, n):
    """Documents of which many are copies, edited copies, and odd ones."""
    base = [words(rng, 60) for _ in range(6)]
    rows = []
    for i in range(n):
        text = list(base[rng.randrange(6)])
        for _ in range(rng.choice([0, 0, 1, 2, 3, 12])):
            text[rng.randrange(60)] = rng.choice(["changed", "words", "here"])
        rows.append((i, " ".join(text)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "!! ??"), (n + 3, "two words"), (n + 4, "Two, words"), (n + 4, "Two, words"), (None, "two words"), (n + 6, "solo " + " ".join(words(rng, 4000)))]


@pytest.mark.parametrize("block", [256, 8])
def test_ngram_join_equals_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(clusters, "BLOCK", block)
    rows = near_copies(random.Random(5), 120)
    got = ngram_join.join_documents(docs_of(spark, rows).withColumn("node", F.lit(1)).withColumn("cluster", F.lit(2))).collect()
    vocabulary = ngram_join._Words()
    sets = {}
    for i, text in rows:
        grams = frozenset(ngram_join.shingles(text, vocabulary).tolist())
        if grams:
            sets.setdefault(grams, []).append(i)
    keys = list(sets)
    links = [(a, b) for a in range(len(keys)) for b in range(a) if len(keys[a] & keys[b]) >= 0.8 * len(keys[a] | keys[b])]
    root = roots(links, range(len(keys)))
    least = {r: min(i for k in range(len(keys)) if root[k] == r for i in sets[keys[k]] if i is not None) for r in root.values()}
    expected = {}
    for k, grams in enumerate(keys):
        for i in sets[grams]:
            expected[i] = (least[root[k]], min(x for x in sets[grams] if x is not None), len(sets[grams]), sum(k in p for p in links))
    assert len(got) == len(rows) and len(links) > 20
    for r in got:
        assert (r.class_id, r.copy_id, r.n_copies, r.n_links) == expected.get(r.doc_id, (r.doc_id, r.doc_id, 1, 0))


def test_bands_reach_the_target_recall():
    bands, rows = ngram_join.choose_bands()
    assert bands * rows <= ngram_join.HASHES and 1 - (1 - 0.8**rows) ** bands >= ngram_join.TARGET_RECALL
    assert ngram_join.choose_bands(0.5, 0.9, 100)[1] == 3


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words that stand all alone"), (9, None), (9, ""), (7, "x y z"), (7, "x y z")]
    kept = ngram_join.stage_ngram_join(spark, docs_of(spark, rows), SF).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, "a b c d e f g"), (2, "other words that stand all alone"), (7, "x y z"), (9, ""), (9, "")]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        assert line_dedup.edit_distance(a, b) == row[-1]
    for _ in range(300):
        a = "".join(rng.choices("abcd", k=rng.randint(40, 150)))
        b = "".join(c if rng.random() < 0.8 else rng.choice(["", "x", "ab"]) for c in a)
        d, limit = line_dedup.edit_distance(a, b), rng.randint(0, 60)
        assert (line_dedup.edit_distance(a, b, limit) <= limit) == (d <= limit)
        a, b = a.replace("d", " "), b.replace("d", " ")
        assert line_dedup.easy_edits(a.split(" "), b.split(" "), 1000) >= line_dedup.edit_distance(a, b)


def test_a_block_is_the_simhash_of_its_sample():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 1 << 63, (4, 3, 5), dtype=np.uint64)
    got = line_dedup.simhash_blocks(rows)
    for b in range(4):
        for n in range(5):
            own = [int(x) for x in line_dedup._mix(rows[b, :, n].copy(), line_dedup._SEEDS[1])]
            bits = sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in own) > 3)
            mixed = line_dedup._mix(np.array([bits], np.uint64) + np.uint64(b + 1) * np.uint64(line_dedup._BASE), line_dedup._SEEDS[2])
            assert mixed[0] == got[b, n]


def test_a_short_line_meets_every_line_without_one_of_its_words():
    hasher = line_dedup.LineHasher()
    own = words(random.Random(4), 7)
    _, _, _, _, n, blocks = hasher.lines([" ".join(own)])
    assert n.tolist() == [line_dedup.BLOCKS + 7 + 6]
    for i in range(7):
        for other in (own[:i] + ["zz"] + own[i + 1 :], own[:i] + own[i + 1 :] + ["zz"]):
            found = hasher.lines(["a b", "Some other line of five words here\n" + " ".join(other)])[5]
            assert blocks[line_dedup.BLOCKS + i] in found


@pytest.mark.parametrize("n", [7, 9, 12])
def test_two_replaced_words_of_a_short_line_spare_a_choice_of_parts(n):
    hasher, rng = line_dedup.LineHasher(), random.Random(n)
    own = words(rng, n)
    blocks = set(hasher.lines([" ".join(own)])[5].tolist())
    for i in range(n):
        for j in range(i):
            other = [w if k not in (i, j) else "zz" for k, w in enumerate(own)]
            found = hasher.lines(["x y z u v w\n" + " ".join(other)])
            assert found[4][1] == line_dedup.BLOCKS + 6 + (n if n <= 10 else 0) and blocks & set(found[5][found[4][0] :].tolist())


def brute_lines(rows):
    """All pairs of different lines by edit similarity alone."""
    places = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [line_dedup.normalise(line) for line in (text or "").split("\n")]
        if max(map(len, lines)) >= line_dedup.FULL_WORDS:
            for n, own in enumerate(lines):
                if own:
                    places.setdefault(" ".join(own), []).append((i, n))
    keys = list(places)
    links = [(a, b) for a in range(len(keys)) for b in range(a) if line_dedup.similar(keys[a], keys[b])]
    root = roots(links, range(len(keys)))
    groups = {}
    for k, key in enumerate(keys):
        groups.setdefault(root[k], []).extend(places[key])
    gone = {p for g in groups.values() for p in sorted(g, key=lambda p: (p[0] is not None, p[0] or 0, p[1]))[1:]}
    return {i: None if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows}, len(links)


@pytest.mark.parametrize("block", [256, 3])
def test_line_dedup_equals_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(clusters, "BLOCK", block)
    rng = random.Random(8)
    pool = [" ".join(words(rng, rng.randint(5, 30))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(pool)
            if rng.random() < 0.5:
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice("xyz") + line[at + 1 :]
            lines.append(rng.choice([line, line.upper(), "short one", "", "--", "fresh " + " ".join(words(rng, 8))]))
        rows.append((i, "\n".join(lines)))
    rows += [(99, "\n".join(pool)), (100, None), (101, ""), (102, "\n\n"), (None, pool[0] + "\nkept words in a line here"), (103, "word " * 3000), (104, "short one"), (105, "short one"), (106, "short one\n" + pool[3])]
    expected, links = brute_lines(rows)
    docs = docs_of(spark, rows)
    for name in ("key", "line", "removed", "_id", "_th", "_own", "node", "cluster", "text2"):
        docs = docs.withColumn(name, F.lit(name))
    got = line_dedup.dedup_lines(docs.withColumn("n_lines", F.lit("x"))).collect()
    assert links > 20 and len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id]
        assert r.text == expected[r.doc_id] and r.removed == "removed" and r._th == "_th"
        assert r.n_lines == (text.count("\n") + 1 if text else 0)
    stage = line_dedup.stage_line_dedup(spark, docs, SF)
    assert stage.columns == docs.columns
    assert {r.doc_id for r in stage.collect()} == {i for i, t in rows if t is None or not t.strip() or expected[i].strip()}
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_rows_outside_the_largest_group_of_a_cluster_are_compared(spark, monkeypatch):
    """One large group of copies, and in the same cluster two lines that are similar to each other only, and one to a single member."""
    monkeypatch.setattr(clusters, "BLOCK", 4)
    rng = random.Random(2)
    base = words(rng, 20)
    texts = [" ".join(base[:i] + ["changed"] + base[i + 1 :]) for i in range(20) for _ in range(2)]
    alone = " ".join(words(rng, 20))
    texts += [alone, alone + " x", " ".join(words(rng, 20)), " ".join(["changed", *base[1:15], *words(rng, 4)])]
    members = spark.createDataFrame([(7, bytes([i]), len(t), t, 0, 65535) for i, t in enumerate(dict.fromkeys(texts))], "cluster long, node binary, size int, text string, bits long, place int")
    with Scratch(spark) as scratch:
        edges = clusters.connect_members(scratch, clusters.with_blocks(members), line_dedup.compare_lines, ["text", "bits", "place"])
        got = {r.node: r.root for r in clusters.connected_components(edges).collect()}
    plain = list(dict.fromkeys(texts))
    links = [(a, b) for a in range(len(plain)) for b in range(a) if line_dedup.similar(plain[a], plain[b])]
    expected = roots(links, range(len(plain)))
    assert {bytes(k): bytes(v) for k, v in got.items()} == {bytes([k]): bytes([v]) for k, v in expected.items() if list(expected.values()).count(v) > 1}


@pytest.mark.parametrize("n", [5, 6, 8, 10, 20, 50])
def test_one_changed_word_is_found(spark, n):
    """Of 40 lines each with a copy of one word replaced, all of edit similarity 0.8 or more."""
    rng = random.Random(n)
    rows, pairs = [], 0
    while pairs < 40:
        line = words(rng, n)
        copy = list(line)
        copy[rng.randrange(n)] = words(rng, 1)[0]
        if copy != line and line_dedup.similar(" ".join(line), " ".join(copy)):
            rows += [(2 * pairs, " ".join(line)), (2 * pairs + 1, " ".join(copy))]
            pairs += 1
    got = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    found = sum(r.n_removed for r in got if r.doc_id % 2)
    assert found >= 0.9 * pairs and not any(r.n_removed for r in got if r.doc_id % 2 == 0)


def test_similar_lines_pass_the_filter_of_tiles():
    rng = random.Random(9)
    lines = [" ".join(words(rng, 9)) for _ in range(3)]
    for _ in range(60):
        line = list(rng.choice(lines))
        for _ in range(rng.randint(1, 16)):
            at = rng.randrange(len(line))
            line[at : at + rng.randint(0, 1)] = rng.choice(["x", "", "é"])
        lines.append("".join(line))
    near = line_dedup.perhaps_similar(lines)
    true = [(i, j) for j in range(len(lines)) for i in range(j) if line_dedup.similar(lines[i], lines[j])]
    assert len(true) > 20 and all(near[p] for p in true)


def test_line_dedup_treats_repeated_rows_alike(spark):
    text = "one line with many words\nquite different things stand here\none line with many words"
    got = line_dedup.dedup_lines(docs_of(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, text[: text.rindex("\n")])] * 2 + [(2, "")]


def test_alignment():
    item = np.arange(10)
    assert decontaminate.align(item, np.array([-1, *range(10), -1])) == (1.0, 1, 10)
    edited = [0, 1, 2, 99, 4, 5, 6, 98, 97, 8, 9]
    score, first, last = decontaminate.align(item, np.array([-1, -1, *edited]))
    assert (first, last) == (2, 12) and 0.5 < score < 1
    plain = np.zeros((11, 12), int)
    for i in range(1, 11):
        for j in range(1, 12):
            plain[i, j] = max(0, plain[i - 1, j - 1] + (2 if item[i - 1] == edited[j - 1] else -1), plain[i - 1, j] - 1, plain[i, j - 1] - 1)
    assert score == plain.max() / 20


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randint(8, 40)))) for i in range(12)] + [(50, "too short"), (51, None)]
    rows, planted = [], set()
    for i in range(80):
        text = words(rng, 150)
        if i % 4 == 0:
            item = items[i % 12]
            copy = item[1].split()
            if i % 8 == 0:
                for at in range(3, len(copy), 9):
                    copy[at] = "edited"
            text[40:40] = copy
            planted.add((i, item[0]))
        rows.append((i, " ".join(text).upper() if i % 3 else " ".join(text)))
    rows += [(200, None), (201, ""), (None, items[0][1]), (202, items[1][1] + " x " * 30_000)]
    planted |= {(None, 0), (202, 1)}
    docs, bench = docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == planted
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("half, score", [(False, 0.7), (True, 0.5)])
def test_passages_without_most_of_the_n_grams_are_found(spark, half, score):
    """Copies edited every fifth word, and verbatim first halves; no exact copy elsewhere."""
    rng = random.Random(6)
    items = [words(rng, 20) for _ in range(3)]
    rows = []
    for i, item in enumerate(items):
        copy = item[:10] if half else ["edited" if at % 5 == 2 else w for at, w in enumerate(item)]
        rows.append((i, " ".join(words(rng, 50) + copy + words(rng, 50))))
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(items)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs_of(spark, rows), bench).collect()}
    assert found == {(i, i): score for i in range(3)}


def test_clean_documents_with_the_id_of_a_leaking_one_stay(spark):
    rng = random.Random(7)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 60").orderBy("item_id").first().text
    clean = [" ".join(words(rng, 40)) for _ in range(3)]
    rows = [(None, item), (None, clean[0]), (None, None), (1, item), (1, clean[1]), (2, clean[2])]
    kept = decontaminate.stage_decontaminate(spark, docs_of(spark, rows), SF).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(0, clean[0]), (0, ""), (1, clean[1]), (2, clean[2])])


def test_leaks_against_alignments_of_all_pairs(spark):
    """Every item aligned with every document, without seeds; edits from one word in twelve to one in four."""
    rng = random.Random(21)
    items = [(i, " ".join(words(rng, rng.randint(8, 40)))) for i in range(25)] + [(25, "one two three"), (26, "alpha beta gamma delta"), (27, "solo"), (28, "two words"), (None, "Null id stands here for once")]
    rows = []
    for d in range(150):
        text = words(rng, rng.randint(0, 80))
        if d % 2:
            copy = rng.choice(items[:25])[1].split()
            for at in range(len(copy)):
                if rng.random() < rng.choice([1 / 12, 1 / 6, 1 / 4]):
                    copy[at : at + 1] = rng.choice([[], ["changed"], ["two", "more"]])
            at = rng.randint(0, len(text))
            text[at:at] = copy
        rows.append((d, " ".join(text)))
    rows += [(200, "here are one two three"), (201, "one two, Three!"), (202, "alpha beta then gamma delta"), (203, "Solo."), (204, "solo act"), (205, "two words"), (206, None), (207, ""), (208, "null id stands here for once"), (209, items[0][1] + " x" * 30_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("node", F.lit(1))
    docs = docs_of(spark, rows)
    for name in ("_id", "_th", "th", "item_id", "score"):
        docs = docs.withColumn(name, F.lit("x"))
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.find_leaks(docs, benchmark).collect()}
    numbers: dict[str, int] = {}
    ids = {k: np.array([numbers.setdefault(w, len(numbers)) for w in decontaminate.words_of(t)], np.int64) for k, t in [*(("i", x) for x in items), *(("d", x) for x in rows)] for k, t in [((k, t[0]), t[1])]}
    expected = {}
    for i, _ in items:
        for d, _ in rows:
            item, doc = ids["i", i], ids["d", d]
            if len(item) < 3:
                score = float(item.tolist() == doc.tolist())
            else:
                score = decontaminate.align(item, doc)[0] if len(doc) else 0.0
            if score >= (0.5 if len(item) >= 5 else 1.0):
                expected[d, i] = score
    assert set(got) <= set(expected) and len(expected) > 50
    assert len(got) >= 0.95 * len(expected) and all(abs(got[k] - expected[k]) < 0.1 for k in got)
    assert {(200, 25), (201, 25), (203, 27), (205, 28), (208, None)} <= set(got) and not {(202, 26), (204, 27)} & set(got)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = {tuple(r) for r in decontaminate.find_leaks(docs, bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 300)
    assert {tuple(r) for r in decontaminate.find_leaks(docs, bench).collect()} == whole and whole


def brute_nearest(rows, k=5):
    usable = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v) and i is not None:
            usable.setdefault(i, np.array(v, np.float64))
    out = {}
    for i, v in usable.items():
        if i % 50 == 0:
            near = [(-float(v @ w) / float(np.linalg.norm(v) * np.linalg.norm(w)), j) for j, w in usable.items() if j != i and len(w) == len(v)]
            for rank, (score, j) in enumerate(sorted(near)[:k], 1):
                out[i, rank] = (j, -score)
    return out


def test_search_is_exact_on_small_tables_with_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.standard_normal(6)]) for i in range(1, 8)] + [(50, rows_vector(rng)), (100, rows_vector(rng))]
    same = rows_vector(rng)
    rows += [(200 + i, list(same)) for i in range(9)] + [(300, list(same)), (8, None), (9, [0.0] * 6), (10, [float("nan")] * 6), (11, [None] * 6), (12, []), (150, [1.0, 2.0]), (13, [2.0, 1.0]), (13, [2.0, 1.0]), (None, list(same))]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann_search.nearest(table, F.col("vec_id") % 50 == 0).collect()}
    expected = brute_nearest(rows)
    assert got.keys() == expected.keys()
    for key, (vec_id, score) in expected.items():
        assert got[key][0] == vec_id and got[key][1] == pytest.approx(score, abs=1e-12)
    assert ann_search.nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def rows_vector(rng):
    return [float(x) for x in rng.standard_normal(6)]


def test_recall_of_the_search(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    expected = brute_nearest([(r.vec_id, r.embedding) for r in rows])
    got = {(r.query_id, r.vec_id): r.score for r in ann_search.op8_ann_search(spark, folder).collect()}
    hits = [got.get((q, v)) for (q, _), (v, _) in expected.items()]
    assert len(got) == len(expected) and sum(h is not None for h in hits) / len(hits) >= 0.9


@pytest.mark.parametrize("length", [768, 1536])
def test_recall_at_usual_lengths(spark, length):
    """Vectors around centres, as embeddings of copies are; the driver's part must stay small."""
    import tracemalloc

    rng = np.random.default_rng(length)
    centres = rng.standard_normal((60, length))
    vectors = (centres[rng.integers(0, 60, 900)] + 0.7 * rng.standard_normal((900, length))).astype(np.float32)
    tracemalloc.start()
    ann_search.fit_plan(vectors.astype(np.float64))
    assert tracemalloc.get_traced_memory()[1] < 600 << 20
    tracemalloc.stop()
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = ann_search.nearest(table, F.col("vec_id") % 50 == 0).collect()
    units = ann_search.units_of(vectors.astype(np.float64))
    hits = 0
    for q in range(0, 900, 50):
        cosines = units @ units[q]
        cosines[q] = -2
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(-cosines)[:5].tolist()))
    assert hits >= 0.9 * 5 * 18


def test_probes_are_the_best_sums():
    rng = np.random.default_rng(3)
    units = ann_search.units_of(rng.standard_normal((6, 16)))
    plan = ann_search.Plan(16, 2, 1)
    first, second = plan.nearness(units, 0)
    whole = (first[:, :, None] + second[:, None, :]).reshape(6, -1)
    for n in (1, 7, 100, 1024):
        got = plan.probed(units, 0, n)
        assert np.allclose(np.take_along_axis(whole, got, 1), -np.sort(-whole, axis=1)[:, :n]) and all(len(set(r)) == n for r in got.tolist())


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(2).standard_normal((4, 16))
    assert np.allclose(np.linalg.norm(ann_search.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(ann_search.hadamard(ann_search.hadamard(x)), x)


def test_pipeline_runs_and_keeps_clean_documents(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_join", "decontamination", "bpe"]
    out = corpus_pipeline.run(spark, SF)
    given = spark.read.parquet(f"{SF}/documents.parquet")
    assert out.columns[:2] == ["doc_id", "n_tokens"] and 0.6 * given.count() < out.count() <= given.count()
    assert out.join(given, "doc_id", "left_anti").count() == 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, given.limit(0), SF)
        assert empty.columns == given.columns and empty.count() == 0


def test_one_line_against_many_is_as_one_by_one():
    rng = random.Random(3)
    letters = "abcdeé 𝒳"
    for size in (0, 1, 7, 8, 63, 64, 65, 200, 300):
        base = "".join(rng.choice(letters) for _ in range(size))
        others = ["", base, base[::-1], base + "x" * (size // 4), base[size // 5 :], "y" * (size // 6) + base[: size - size // 6]]
        for _ in range(20):
            line = list(base)
            for at in rng.sample(range(size), int(size * rng.random() * 0.3)):
                line[at] = rng.choice(["", "z", line[at] + "z"])
            others.append("".join(line))
        assert line_dedup.similar_among(base, others).tolist() == [line_dedup.similar(base, x) for x in others]


def test_many_lines_with_one_passage_are_grouped_as_one_by_one(monkeypatch):
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 8))) for _ in range(n))
    passage = words(25)
    texts = [f"{words(5)} {passage} {words(5)}" for _ in range(40)]
    texts += [t.replace("ae", "xy").replace("rst", "q") for t in texts[:20]]
    rows = [{"text": t, "bits": 1, "place": 65535} for t in texts]
    links, first = line_dedup.compare_lines(rows, [0] * len(rows), True)
    expected = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if line_dedup.similar(texts[i], texts[j]):
                a, b = expected[i], expected[j]
                expected = [min(a, b) if x in (a, b) else x for x in expected]
    assert first.tolist() == expected and len(set(expected)) < len(texts)
    calls = []
    monkeypatch.setattr(line_dedup, "similar", lambda a, b: calls.append(a))
    line_dedup.compare_lines(rows[:40], [0] * 40, True)
    assert len(calls) <= 80  # of 780 pairs


def test_tiles_are_not_joined_by_their_bytes(spark):
    rows = [(i, f"{i}-{j}".encode(), 1, 0, "t") for i in range(64) for j in range(2)]
    members = spark.createDataFrame(rows, "cluster long, node binary, blocks int, block int, text string")
    both = lambda rows, blocks, same: (np.ones(len(rows), np.int64), np.zeros(len(rows), np.int64))
    parts = clusters.compare_tiles(members, both, ["text"]).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_texts_that_no_cluster_needs_stay_out_of_the_shuffle(spark):
    rows = spark.range(20_000).selectExpr("if(id = 7, null, id) AS doc_id", "id * 3 AS th", "'t' AS text")
    members = spark.range(0, 20_000, 7).selectExpr("named_struct('doc_id', if(id = 7, null, id), 'th', id * 3) AS one")
    kept = ngram_join.perhaps_wanted(rows, ["doc_id", "th"], members, ["one.doc_id", "one.th"])
    assert kept.columns == rows.columns
    found = {tuple(r) for r in kept.select("doc_id", "th").collect()}
    assert {(r.one.doc_id, r.one.th) for r in members.collect()} <= found and len(found) < 20_000 / 7 * 1.7
    assert ngram_join.perhaps_wanted(rows, ["doc_id", "th"], members.filter("one.th < 0"), ["one.doc_id", "one.th"]).count() == 0


def test_lines_that_meet_are_found_without_a_row_for_a_block(spark, monkeypatch):
    rng = random.Random(6)
    pool = [words(rng, rng.randint(5, 20)) for _ in range(60)]
    lines = [" ".join(w if rng.random() < 0.95 else "changed" for w in rng.choice(pool)) for _ in range(400)]
    docs = docs_of(spark, [(i, "\n".join(lines[i : i + 4])) for i in range(0, 400, 4)]).select("doc_id", "text", F.lit(1).cast("long").alias("th"))
    hashed = line_dedup.map_batches(docs.repartition(3), line_dedup._lines, line_dedup.LINE_SCHEMA)
    rows = hashed.select(F.xxhash64("key").alias("id"), "blocks").collect()
    owners = {}
    for r in rows:
        for block in np.frombuffer(bytes(r.blocks), np.int64).tolist():
            owners.setdefault(block >> 16, {})[r.id] = block & 0xFFFF
    expected = {}
    for bits, own in owners.items():
        if len(own) > 1:
            for i, place in own.items():
                key = (min(own), max(own), i)
                expected[key] = min(expected.get(key, (1 << 63, 0)), (bits, place))
    found = line_dedup.meetings(hashed)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(line_dedup, "_DEALT_AT_ONCE", 500)
    for got in (found, line_dedup.meetings(hashed)):
        got = {(r.cluster, r.id): (r.bits, r.place) for r in got.collect()}
        ends = spark.createDataFrame([(*k, *v) for k, v in expected.items()], "least long, greatest long, id long, bits long, place int")
        assert len(expected) > 100 and got == {(r.cluster, r.id): (r.bits, r.place) for r in ends.select(F.xxhash64("least", "greatest").alias("cluster"), "id", "bits", "place").collect()}
    assert line_dedup.meetings(hashed.limit(0)).count() == 0


def test_two_lines_of_a_tile_are_compared_as_among_many():
    rng = random.Random(12)
    apart = {"text": "zz", "bits": 9, "place": 65535}
    found = []
    for _ in range(200):
        base = words(rng, rng.randint(4, 30))
        copy = [w if rng.random() < 0.85 else words(rng, 1)[0] for w in base][rng.randint(0, 1) :]
        bits, places = rng.randint(1, 2), [rng.choice([0, 3, 40, 65535]) for _ in range(2)]
        rows = [{"text": " ".join(x), "bits": b, "place": p} for x, b, p in zip((base, copy), (1, bits), places)]
        same, blocks = rng.random() < 0.5, [0, rng.randint(0, 1)]
        links, first = line_dedup.compare_lines(rows, blocks, same)
        of_three = line_dedup.compare_lines([*rows, apart], [*blocks, 0], same)
        assert links.tolist() == of_three[0].tolist()[:2] and first.tolist() == of_three[1].tolist()[:2]
        found.append(bool(links[0]))
    assert 20 < sum(found) < 180
