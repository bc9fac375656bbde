"""Operators that map over texts, against brute force."""

import random
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import bpe_codec, language_id, license_scan, pii
from tidemark.llm import pii_tagger as tagger_module

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, extra int"
ODD = [(1, None, None, 0), (2, "", "en", 0), (2, "", "en", 0), (None, "some words", None, 0), (4, "x" * 50_000, "en", 0), (5, "é\n\n " * 2000, "fr", 0)]


@pytest.fixture(scope="module")
def texts():
    return pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()


def test_tokens_are_those_of_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe_codec.vocabulary_path())
    more = ["<|endoftext|>Hello<|startoftext|> World's", "ΣΑΣ İstanbul \x1c\x85 ﬁ", "aaaaaaaaaa" * 40, "日本語 ½ ² 😀", None, ""]
    rows = [(i, t) for i, t in enumerate(texts + more)]
    found = bpe_codec.encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), with_ids=True).collect()
    codec = bpe_codec.Codec(bpe_codec.vocabulary_path())
    for r in found:
        ids = library.encode(rows[r.doc_id][1] or "", add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
    words = codec.words(texts[0])
    codec.learn(set(words))
    assert codec.decode(words) == library.decode(library.encode(texts[0], add_special_tokens=False).ids, skip_special_tokens=False)


def test_words_that_share_prefixes():
    trie = bpe_codec.TrieEncoder(bpe_codec.vocabulary_path())
    words = ["the", "then", "there", "thereupon", "t", "th", "zzzzq"]
    for word, tokens in trie.encode_words(words).items():
        assert tokens == trie.merge([*word[:-1], word[-1] + bpe_codec.END])


@pytest.mark.parametrize("run", [bpe_codec.encode_documents, license_scan.scan_documents, pii.find_personal_data])
def test_odd_rows_each_give_a_row(spark, run):
    found = run(spark.createDataFrame(ODD, DOCS)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ODD)
    assert run(spark.createDataFrame([], DOCS)).count() == 0


def _base_labels(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [(m[0], m.start()) for m in re.finditer(license_scan.WORD + "+", lowered)]
    only = [w for w, _ in words]
    places = sorted((i, label) for phrase, label in license_scan.BASE for i in range(len(only)) if only[i : i + len(phrase.split())] == phrase.split())
    return len(only), [p for p, _ in places], ",".join(sorted({label for _, label in places}))


def test_base_license_phrases(texts):
    scanner = license_scan.Scanner()
    more = ["MIT  License\nmit,license mit_license amit license éMIT license", "GNU GENERAL public\tlicense general public", None, "apache license" * 3]
    for text in texts + more:
        got = scanner.scan(text)
        n, places, labels = _base_labels(text)
        assert (got["n_words"], got["n_base"], got["base_labels"]) == (n, len(places), labels)
        assert (got["first_word"], got["last_word"]) == ((places[0], places[-1]) if places else (None, None))
        assert set(filter(None, labels.split(","))) <= set(got["labels"].split(","))


def test_license_rules_and_suppression():
    assert len(license_scan.rules()) > 300
    scan = license_scan.Scanner().scan
    assert scan("SPDX-License-Identifier: BSD-3-Clause")["labels"] == "bsd-3-clause"
    assert scan("under the GNU General Public License, version 3")["labels"] == "gpl,gpl-3.0"
    inner, outer = license_scan.Detection(5, 9, "a", 1, 1.0, False), license_scan.Detection(0, 20, "b", 2, 1.0, False)
    overlap = license_scan.Detection(15, 30, "c", 1, 1.0, False)
    assert license_scan.suppress([inner, outer, overlap]) == [outer, overlap]
    assert license_scan.suppress([]) == []
    rng = np.random.default_rng(6)
    for _ in range(60):
        found = [license_scan.Detection(int(s), int(s + n), str(k), int(p), 1.0, False) for k, (s, n, p) in enumerate(zip(rng.integers(0, 30, 40), rng.integers(1, 12, 40), rng.integers(0, 4, 40)))]
        kept = [d for d in found if not any(o.start <= d.start and d.end <= o.end and (o.priority, o.end - o.start) > (d.priority, d.end - d.start) for o in found)]
        assert sorted(license_scan.suppress(found), key=str) == sorted(kept, key=str)
    many = [license_scan.Detection(i, i + 5 + i % 7, "a", i % 5, 1.0, False) for i in range(100_000)]
    began = time.time()
    license_scan.suppress(many)
    assert time.time() - began < 3


def test_every_rule_needs_its_keyword(texts):
    """All rules without the keyword gate find what they find with it, on texts that hold every kind of notice."""
    scanner = license_scan.Scanner()
    made = ["GNU General Public License v2 or any later version", "gpl-3.0 or later", "LGPL 2.1 only", "Licensed under either of the MIT license or Apache License, Version 2.0", "Apache License 2.0 with LLVM exceptions", "BSD 3-clause license, BSD-2", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "placed in the public domain", "same terms as Perl itself", "for research or non-commercial use only", "with the GNU classpath linking exception", "see LICENSE.txt for details", "MIT-style licence"]
    made += [line.split(": ", 1)[1].replace("#", "version") for line in license_scan.NOTICES.strip().splitlines()]
    hit = set()
    for text in made + [t for t in texts if t][:150]:
        lowered = text.lower()
        free = []
        for rule in license_scan.rules():
            for m in re.finditer(rule.pattern, lowered):
                assert rule.keyword in m[0]
                hit.add(rule.pattern)
                free.append(license_scan.Detection(m.start(), m.end(), rule.label, rule.priority, rule.confidence, rule.base))
        other = [d for d in free if not d.base]
        kept = [d for d in other if not any(o.start <= d.start and d.end <= o.end and (o.priority, o.end - o.start) > (d.priority, d.end - d.start) for o in other)]
        assert sorted(scanner.detections(lowered), key=str) == sorted([d for d in free if d.base] + kept, key=str)
    assert len(hit) > 40
    scan = scanner.scan
    assert scan(made[0])["labels"] == "gpl,gpl-2.0-or-later" and scan(made[2])["labels"] == "lgpl-2.1-only"
    assert "mit-or-apache-2.0" in scan(made[3])["labels"] and scan(made[6])["labels"] == "cc-by-nc-sa"
    assert "classpath-exception" in scan(made[10])["labels"]


def _brute_spans(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (kind == "phone" and 9 <= len(digits) <= 15)
            if ok or (kind == "card" and 13 <= len(digits) <= 19 and tagger_module.luhn(digits)):
                out.append((m.start(), m.end(), kind))
    return out


def test_base_patterns(texts):
    rng = np.random.default_rng(3)
    pieces = ["1", "25", ".", "..", "@", "-", " ", "+", "a", "b.", "(", ")", "4111111111111111", "192.168.", "é", "_", "%", "0001."]
    made = ["".join(rng.choice(pieces, rng.integers(0, 25))) for _ in range(3000)]
    for text in texts + made:
        assert pii.base_spans(text or "") == _brute_spans(text or "")
    assert len(pii.base_spans("9" * 100_000 + "a" * 100_000 + "@" * 1000)) == 0  # linear


def test_tagger_finds_held_out_spans():
    """Recall and precision on labelled texts that were not trained on, by the spans that come out."""
    tagger, right, found, real = tagger_module.default_tagger(), 0, 0, 0
    examples = tagger_module.labelled_examples(99, 400)
    for (_, spans), got in zip(examples, pii.tag_texts(tagger, [text for text, _ in examples])):
        own = set(pii.reconcile(got, []))
        right, found, real = right + len(own & set(spans)), found + len(own), real + len(spans)
    assert right / found > 0.95 and right / real > 0.85


@pytest.mark.parametrize("value", ["(415) 555-2671", "212-555-0188", "jane at example dot com", "jane.doe [at] mail [dot] example [dot] org", "4111.1111.1111.1111"])
def test_tagger_adds_what_the_base_patterns_miss(spark, value):
    text = "é" * 300 + " some words and then " + value + " was what it said " + "x y " * 100
    docs = spark.createDataFrame([(1, text), (2, "Nothing of the kind is written here. " * 50), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_personal_data(docs).collect()}
    spans = [s.split(":") for s in rows[1].spans.split(",")]
    assert [text[int(s) : int(e)] for _, s, e in spans] == [value] and rows[1].n_method == 1 and rows[1].n_email + rows[1].n_phone + rows[1].n_card == 0
    assert rows[2].spans == "" and rows[3].spans == ""


def test_columns_left_out_of_decoding_hold_no_spans():
    tagger = tagger_module.default_tagger()
    examples = [t for t, _ in tagger_module.labelled_examples(5, 60)] + ["only words are here and no numbers at all " * 2] * 20
    x = np.zeros((72, len(examples)), np.int64)
    for column, text in enumerate(examples):
        x[: len(text[:72]), column] = tagger_module.encode(text[:72])
    scores = tagger.scores(x)
    assert np.allclose(scores, tagger.emissions(x)[0].transpose(0, 2, 1), atol=1e-3)
    paths, _ = tagger.best_paths(np.ascontiguousarray(scores.transpose(0, 2, 1)))
    assert set(np.flatnonzero(paths.any(axis=0)).tolist()) == set(tagger.may_leave(scores).tolist())


@pytest.mark.parametrize("address", ["firstname.lastname (at) mail.department.university (dot) edu", "firstname.lastname.secondname (at) mail.department.faculty.university (dot) edu", "first.last (at) department.org"])
def test_spans_do_not_depend_on_where_windows_are_cut(address):
    tagger = tagger_module.default_tagger()
    before, after = "please write to ", " for more about it and then wait " * 4
    texts = [" " * at + "some words stand here " * 8 + before + address + after for at in range(0, 48, 3)]
    for text, spans in zip(texts, pii.tag_texts(tagger, texts)):
        assert address in [text[s:e] for s, e, _ in pii.reconcile(spans, [])]


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    scores, moves, tags = rng.standard_normal((6, 2, 4)), rng.standard_normal((4, 4)), rng.integers(0, 4, (6, 2))
    _, d_scores, d_moves = tagger_module.crf_loss(scores, moves, tags)
    for array, gradient, at in ((scores, d_scores, (3, 1, 2)), (moves, d_moves, (1, 2))):
        array[at] += 1e-5
        up = tagger_module.crf_loss(scores, moves, tags)[0]
        array[at] -= 2e-5
        down = tagger_module.crf_loss(scores, moves, tags)[0]
        array[at] += 1e-5
        assert abs((up - down) / 2e-5 - gradient[at]) < 1e-6


def test_spans_are_reconciled_globally():
    found = {(0, 10, "phone"): 5.0, (0, 4, "ip"): 3.0, (5, 10, "ip"): 3.0, (12, 14, "ip"): 1.0}
    assert sorted(pii.reconcile(found, [(13, 20, "card")])) == [(0, 4, "ip"), (5, 10, "ip")]
    rng = np.random.default_rng(4)
    many = {(s, s + int(n), "phone"): 4.0 for s, n in zip(rng.integers(0, 500, 80).tolist(), rng.integers(1, 30, 80))}
    base = [(s, s + int(n), "card") for s, n in zip(rng.integers(0, 500, 12).tolist(), rng.integers(1, 30, 12))]
    free = {f for f in many if all(f[1] <= s or e <= f[0] for s, e, _ in base)}
    kept = pii.reconcile(many, base)
    assert set(kept) <= free and all(a[1] <= b[0] for a, b in zip(sorted(kept), sorted(kept)[1:]))
    assert all(any(f[0] < k[1] and k[0] < f[1] for k in kept) for f in free)


def test_languages_of_held_out_documents(spark):
    rows = language_id.op7_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and 100 < len(held) < 300
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_rows(spark):
    rows = [(i, f"the quick {w} of the", "en", 0) for i, w in enumerate(["fox", "dog", "cat", "hen", "cow", "pig"] * 4)]
    rows += [(100 + i, f"der schnelle {w} und die", "de", 0) for i, w in enumerate(["hund", "wolf", "hahn", "kuh", "bär", "fuchs"] * 4)]
    odd = [(900, None, "en", 0), (901, "123 !!", "en", 0), (902, "", None, 0), (903, "der und die", None, 0), (903, "der und die", None, 0)]
    docs = spark.createDataFrame(rows + odd, DOCS)
    model = language_id.train(docs)
    assert model.languages == ["de", "en"] and model.temperature > 0
    assert [model.predict(r[1])[0] for r in odd] == ["und", "und", "und", "de", "de"]
    empty = language_id.train(docs.limit(0))
    assert empty.predict("words") == ("und", 0.0)


def test_temperature_prefers_the_likelier():
    logits = np.array([[4.0, 0.0]] * 10)
    assert language_id.fit_temperature(logits, np.array([0] * 6 + [1] * 4)) > 2


def test_the_pattern_of_the_first_characters_gives_the_same_words(monkeypatch):
    codec = bpe_codec.Codec(bpe_codec.vocabulary_path())
    rng = random.Random(11)
    texts = ["", "".join(map(chr, range(256))), "It's we'll ''s 'x don't I'M '", "½ ²³ 12 a1é2 ÀÉ\xa0ß\x85µ\x1cª", "O'Ve 'RE'd\n\t'"]
    texts += ["".join(chr(rng.randrange(256)) if rng.random() < 0.3 else rng.choice("aeéstvdlm' 1'.\n") for _ in range(60)) for _ in range(500)]
    general = [codec.pattern.findall(t.lower()) for t in texts]
    assert [codec.narrow.findall(t.lower()) for t in texts] == general
    monkeypatch.setattr(codec, "pattern", None)
    assert [codec.plain_words(t) for t in texts] == general
