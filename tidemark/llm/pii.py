"""Personal data: base patterns, and a character tagger for what is written otherwise.

Base spans follow fixed patterns per kind, leftmost and non-overlapping; matches that fail their check are dropped.
The patterns are run in time linear in the text. The tagger (pii_tagger) reads every text whole, in windows of WINDOW characters,
STRIDE apart. Where a window's edge cuts a span that no other window shows whole, a window of twice the length is laid around
it, and so on until it is whole. The spans of all windows are reconciled over the whole text: those with a lead below MIN_LEAD, that fail
their kind's check on digits or marks, or that touch a base span go, and of those that overlap the set with the greatest total score
stays. Base spans always stay.

``spans`` and ``base_sha256`` list kind:start:end, by kind as listed, then start, in code points, end exclusive.
Counts are those of base spans; ``n_method`` counts the tagger's.

Defined results: a null or empty text has no spans; a text may have any length, as windows are tagged TOGETHER at a time and
spans are reconciled in time proportional to their number, but for sorting; repeated rows each give a row; other columns are
ignored; an empty table gives no rows. One pass over the texts, no shuffle; the model is of fixed size and is trained by the driver.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.pii_tagger import KINDS, STRIDE, TOGETHER, WINDOW, Tagger, default_tagger, encode, luhn, spans_of
from tidemark.llm.texts import map_batches, to_batch

Span = tuple[int, int, str]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: The least log odds against "none" that the tagger must give a span.
MIN_LEAD = 3.0
_AT, _DOT = re.compile(r"@|\bat\b", re.IGNORECASE), re.compile(r"\.|\bdot\b", re.IGNORECASE)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    begin, at = 0, text.find("@")
    while at >= 0:
        start = begin + len(text[begin:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            begin = domain.end()
            at = text.find("@", begin)
        else:
            begin, at = at + 1, text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans, by kind and start."""
    out: list[Span] = [(s, e, "email") for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(digits := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m[0])) <= 15]
    return out


def valid(kind: str, value: str) -> bool:
    """What holds for the base patterns' values too, however they are written: numbers of digits, their sums and ranges, an address's two marks."""
    groups = re.findall("[0-9]+", value)
    digits = "".join(groups)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "ip":
        return len(groups) == 4 and all(len(x) <= 3 and int(x) <= 255 for x in groups)
    return bool(_AT.search(value)) and bool(_DOT.search(value))


def reconcile(found: dict[Span, float], base: list[Span]) -> list[Span]:
    """Of spans that touch no base span, the non-overlapping set of greatest total score."""
    taken = sorted((s, e) for s, e, _ in base)
    reach = list(accumulate((e for _, e in taken), max))  # the furthest end of all base spans up to here

    def touched(start: int, end: int) -> bool:
        before = bisect_left(taken, (end,))
        return before > 0 and reach[before - 1] > start

    free = sorted((s for s in found if not touched(s[0], s[1])), key=lambda s: (s[1], s[0]))
    ends = [s[1] for s in free]
    best, take = [0.0], []
    for i, span in enumerate(free):
        before = bisect_right(ends, span[0], hi=i)
        value = found[span] + best[before]
        take.append((value > best[i], before))
        best.append(max(value, best[i]))
    out, i = [], len(free)
    while i:
        taken, before = take[i - 1]
        if taken:
            out.append(free[i - 1])
        i = before if taken else i - 1
    return out


def tag_texts(tagger: Tagger, texts: list[str]) -> list[dict[Span, float]]:
    """For each text, the valid spans that its windows show whole, with their scores."""
    classes = [encode(text) for text in texts]
    places = [(i, start) for i, text in enumerate(texts) for start in range(0, max(1, len(text) - (WINDOW - STRIDE)), STRIDE) if text]
    places.sort(key=lambda p: min(WINDOW, len(texts[p[0]]) - p[1]))  # windows of about one length are tagged together
    out: list[dict[Span, float]] = [{} for _ in texts]
    size = WINDOW
    while places:
        cut = _tag_windows(tagger, texts, classes, places, size, out)
        size *= 2
        step = size // 4
        places = sorted({(i, max(0, (start + end) // 2 - size // 2) // step * step) for i, start, end in cut if not any(s <= start and end <= e for s, e, _ in out[i])})
    return out


def _tag_windows(tagger: Tagger, texts: list[str], classes: list[np.ndarray], places: list[tuple[int, int]], size: int, out: list[dict[Span, float]]) -> list[tuple[int, int, int]]:
    """Adds what the windows of this size show whole, and returns (text, start, end) of what their edges cut."""
    cuts = []
    at_once = max(1, TOGETHER * WINDOW // size)
    for at in range(0, len(places), at_once):
        some = places[at : at + at_once]
        x = np.zeros((max(min(size, len(texts[i]) - start) for i, start in some), len(some)), np.int64)
        for column, (i, start) in enumerate(some):
            own = classes[i][start : start + size]
            x[: len(own), column] = own
        columns, paths, leads = tagger.decode(x)
        for place in np.flatnonzero(paths.any(axis=0)).tolist():
            i, offset = some[columns[place]]
            text = texts[i]
            for start, end, kind in spans_of(paths[:, place].tolist()):
                end = min(end, len(text) - offset)
                if end <= start:
                    continue
                if (start == 0 and offset > 0) or (end == size and offset + size < len(text)):
                    cuts.append((i, offset + start, offset + end))
                    continue
                lead = float(leads[start : end + 1, place].sum())
                if lead >= MIN_LEAD and valid(kind, text[offset + start : offset + end]):
                    span = (offset + start, offset + end, kind)
                    out[i][span] = max(lead, out[i].get(span, 0.0))
    return cuts


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (KINDS.index(x[2]), x[0])))


TYPES = {"doc_id": pa.int64(), **{f"n_{k}": pa.int64() for k in KINDS}, "base_sha256": pa.string(), "spans": pa.string(), "n_method": pa.int64()}
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_method long"


def find_personal_data(documents: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """A row for each document with its spans."""
    shared = documents.sparkSession.sparkContext.broadcast(tagger or default_tagger())  # of fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out: dict[str, list] = {name: [] for name in TYPES}
            for text, found in zip(texts, tag_texts(own, texts)):
                base = base_spans(text)
                added = reconcile(found, base) if found else []
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[2] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(listed(base).encode()).hexdigest())
                out["spans"].append(listed(base + added))
                out["n_method"].append(len(added))
            out["doc_id"] = batch.column("doc_id")
            yield to_batch(out, TYPES)

    return map_batches(documents.select("doc_id", "text"), work, SCHEMA)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data."""
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
