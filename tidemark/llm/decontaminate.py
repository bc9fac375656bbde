"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

Words are lower-cased runs of word characters. Test items are taken in blocks of
BLOCK_WORDS words, each block's vocabulary and n-grams being dealt to all tasks, and each block meets all
documents; so the benchmark may have any size and nothing of unproven size is broadcast. One pass over the
texts cuts out, for every document, the passages where an item has enough n-grams of SEED_WORDS words close together.
How many documents hold an n-gram doesn't matter: an edited copy may hold only the frequent ones of its item, so every
passage with enough seeds counts. It is aligned, unless so few of the item's words are in it that no alignment reaches MIN_SCORE:
match +2, mismatch and gap -1; the score is the best local alignment over that of the item with itself.

Result: (doc_id, item_id, score, first_word, last_word) for every document and item with a score of MIN_SCORE or
more; a document's best passage counts. Items of fewer than MIN_WORDS words must stand word for word, and those of fewer than
SEED_WORDS words, which are no passage, must be all that a document says. Defined results: null texts and items, and those without words, match
nothing; repeated rows each give theirs; items with equal texts each match; a null item_id is kept as null; other columns are
ignored, whatever their names; a text may have any length; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.texts import map_batches, to_batch
from tidemark.session import durable

SEED_WORDS = 3
MIN_WORDS = 5
MIN_SEEDS = 2
MIN_SCORE = 0.5
BLOCK_WORDS = 200_000
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Block:
    """Some test items with the numbers of their words and n-grams."""

    def __init__(self, items: list[tuple[int | None, list[str]]]):
        self.ids = [item_id for item_id, _ in items]
        vocabulary: dict[str, int] = {}
        self.words = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int64) for _, words in items]
        self.vocabulary = vocabulary
        keys = [self.keys(words) for words in self.words]
        self.grams = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        #: For each item, its n-grams; for each n-gram, the items that have it.
        self.of_item = [np.unique(np.searchsorted(self.grams, k)) for k in keys]
        pairs = sorted((g, i) for i, grams in enumerate(self.of_item) for g in grams.tolist())
        self.items = np.array([i for _, i in pairs], np.int64)
        self.starts = np.searchsorted(np.array([g for g, _ in pairs], np.int64), np.arange(len(self.grams) + 1))
        self.exact = [len(words) < MIN_WORDS for words in self.words]
        #: Items that are too short for an n-gram, by their words.
        self.whole: dict[tuple[int, ...], list[int]] = {}
        for i, words in enumerate(self.words):
            if len(words) < SEED_WORDS:
                self.whole.setdefault(tuple(words.tolist()), []).append(i)
        self.needed = np.array([min(MIN_SEEDS, max(1, len(g) // 4)) for g in self.of_item], np.int64)

    def keys(self, ids: np.ndarray) -> np.ndarray:
        """A number for each n-gram; negative where a word is not in the vocabulary."""
        n = len(self.vocabulary)
        key = ids[: max(0, len(ids) - SEED_WORDS + 1)].copy()
        bad = key < 0
        for i in range(1, SEED_WORDS):
            part = ids[i : i + len(key)]
            bad |= part < 0
            key = key * n + part
        key[bad] = -1
        return key

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of the block's n-grams in a text."""
        if len(ids) < SEED_WORDS or not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys = self.keys(ids)
        at = np.flatnonzero(keys >= 0)
        found = np.searchsorted(self.grams, keys[at])
        found[found == len(self.grams)] = 0
        same = self.grams[found] == keys[at]
        return at[same], found[same]

    def passages(self, ids: np.ndarray, at: np.ndarray, grams: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
        """(item, start, word numbers) where an item has enough different n-grams close together."""
        counts = self.starts[grams + 1] - self.starts[grams]
        places, which = np.repeat(at, counts), np.repeat(grams, counts)
        offsets = np.arange(len(places)) - np.repeat(np.cumsum(counts) - counts, counts)
        items = self.items[self.starts[which] + offsets]
        out = []
        often = np.flatnonzero(np.bincount(items, minlength=len(self.ids)) >= self.needed)
        for item in often.tolist():
            own = items == item
            where, what, reach = places[own], which[own], 2 * len(self.words[item])
            for part in np.split(np.arange(len(where)), np.flatnonzero(np.diff(where) > reach) + 1):
                seeds = np.unique(what[part])
                if len(seeds) >= self.needed[item]:
                    start = max(0, int(where[part[0]]) - reach)
                    end = int(where[part[-1]]) + reach
                    out.append((item, start, ids[start:end]))
        return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """(score from 0 to 1, first and last word of the passage's aligned part), by Smith-Waterman.

    Row by row; gaps along a row are a running maximum.
    """
    n = len(passage)
    slope = np.arange(n + 1)
    above, origin_above = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best, ends = 0, (0, 0)
    for word in item.tolist():
        diagonal = np.concatenate(([0], above[:-1] + np.where(passage == word, 2, -1)))
        here = np.maximum(np.maximum(diagonal, above - 1), 0)
        origin = np.where(here == 0, slope, np.where(here == diagonal, np.concatenate(([0], origin_above[:-1])), origin_above))
        lifted = here + slope
        reached = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == reached, slope, 0))
        above, origin_above = reached - slope, origin[source]
        top = int(above.argmax())
        if above[top] > best:
            best, ends = int(above[top]), (int(origin_above[top]), top)
    return best / (2 * len(item)), ends[0], ends[1] - 1


def reachable(item: np.ndarray, passage: np.ndarray) -> bool:
    """Whether the passage has so many of the item's words that an alignment may score MIN_SCORE; each matches once at most."""
    return bool(np.isin(item, passage).sum() >= MIN_SCORE * len(item))


def _alignments(block) -> object:
    types = {"doc_id": pa.int64(), "th": pa.int64(), "item_id": pa.int64(), "score": pa.float64(), "first_word": pa.int64(), "last_word": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        number = own.vocabulary.get
        for batch in batches:
            out: dict[str, list] = {name: [] for name in types}
            for doc_id, text, th in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "th"))):
                ids = np.array([number(w, -1) for w in words_of(text)], np.int64)
                at, grams = own.hits(ids)
                best: dict[int, tuple[float, int, int]] = {}
                for item, start, passage in own.passages(ids, at, grams) if len(at) else []:
                    if not reachable(own.words[item], passage):
                        continue
                    score, first, last = align(own.words[item], passage)
                    if score >= (1.0 if own.exact[item] else MIN_SCORE) and score > best.get(item, (0.0,))[0]:
                        best[item] = (score, first + start, last + start)
                if 0 < len(ids) < SEED_WORDS:
                    best.update((item, (1.0, 0, len(ids) - 1)) for item in own.whole.get(tuple(ids.tolist()), ()))
                for item, (score, first, last) in best.items():
                    for name, value in zip(types, (doc_id, th, own.ids[item], score, first, last)):
                        out[name].append(value)
            yield to_batch(out, types)

    return work


def item_blocks(benchmark: DataFrame) -> Iterator[Block]:
    """The test items in blocks, one held by the driver at a time."""
    held: list[tuple[int | None, list[str]]] = []
    n = 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        if not words:
            continue
        held.append((row["item_id"], words))
        n += len(words)
        if n >= BLOCK_WORDS:
            yield Block(held)
            held, n = [], 0
    if held:
        yield Block(held)


def hashed_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, th, item_id, score, first_word, last_word) of the documents that hold a test item; th is the text's hash."""
    spark = documents.sparkSession
    schema = "doc_id long, th long, item_id long, score double, first_word long, last_word long"
    out = spark.createDataFrame([], schema)
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("th"))
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)  # at most BLOCK_WORDS words and one item
        out = out.unionByName(map_batches(texts, _alignments(shared), schema))
    return out


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word) of the documents that hold a test item."""
    return hashed_leaks(documents, benchmark).drop("th")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a test item, with the items."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item, told apart by id and text."""
    mark = f"_{uuid.uuid4().hex}"  # no column of docs has this name
    leaks = hashed_leaks(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = durable(leaks.select(F.col("doc_id").alias(f"{mark}_id"), F.col("th").alias(f"{mark}_th")).distinct())
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col(f"{mark}_id")) & (F.xxhash64("text") == F.col(f"{mark}_th")), "left_anti")
