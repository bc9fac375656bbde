"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets verify them.

A text's words are its runs of word characters, lower-cased; its n-grams are all runs of N words (all its words,
if there are fewer). Texts with the same n-gram set form a class and are joined once. Each class gets
BANDS x ROWS minimum hashes; numbers of bands and rows follow from the threshold and the target recall. Classes
that share a band are candidates; the connected components of those (clusters) are compared in tiles of bounded
size, every pair within a cluster on its full n-gram sets. No pair is emitted: each row returns its number of
links and one edge of a spanning forest.

Result, one row for each row of documents: ``class_id`` is the smallest doc_id of its connected group of
links, ``copy_id`` the smallest with the same n-gram set, ``n_copies`` the number of rows with that set, ``n_links``
the number of other n-gram sets with a Jaccard similarity of THRESHOLD or more.

Defined results: a text without words (or null) has no n-grams, belongs to no class and links to nothing; repeated
rows are copies; a null doc_id takes part, and counts as smallest only if its whole group has no other; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.clusters import compare_tiles, connected_components, first_connected, with_blocks
from tidemark.llm.texts import map_batches, to_batch
from tidemark.session import Scratch, durable

N = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9995
HASHES = 64
_WORD = re.compile(r"\w+")
_VOCABULARY = 400_000
_POWERS = [np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in range(N)]


def choose_bands(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band may have, so that pairs at the threshold are found with the target recall."""
    rows = max((r for r in range(1, hashes + 1) if 1 - (1 - threshold**r) ** (hashes // r) >= recall), default=1)
    return hashes // rows, rows


BANDS, ROWS = choose_bands()


class _Words(dict):
    """63-bit hashes of words; starts afresh when it has grown large."""

    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word) >> 1
        return value


def shingles(text: str | None, words: dict) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's n-grams."""
    found = _WORD.findall((text or "").lower())
    if not found:
        return np.empty(0, np.uint64)
    if len(words) > _VOCABULARY:
        words.clear()
    ids = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = min(N, len(ids))
    grams = np.zeros(len(ids) - n + 1, np.uint64)
    for i in range(n):
        grams += ids[i : len(ids) - n + 1 + i] * _POWERS[i] + np.uint64(n)
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    return np.unique(grams)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def band_hashes(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        np.minimum(least, (grams[at : at + 2048, None] * a + b).min(axis=0), out=least)
    mixed = least.reshape(BANDS, ROWS) * (_POWERS[1] + np.arange(ROWS, dtype=np.uint64) * np.uint64(2))
    return np.bitwise_xor.reduce(mixed ^ (mixed >> np.uint64(31)), axis=1).view(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, (a, b) = _Words(), _multipliers()
    types = {"doc_id": pa.int64(), "th": pa.int64(), "size": pa.int32(), "node": pa.binary(), "bands": pa.list_(pa.int64())}
    for batch in batches:
        nodes, bands, sizes = [], [], []
        for text in batch.column("text"):
            text = text.as_py()
            grams = shingles(text, words)
            sizes.append(len(text or ""))
            nodes.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
            bands.append(band_hashes(grams, a, b) if len(grams) else None)
        yield to_batch({"doc_id": batch.column("doc_id"), "th": batch.column("th"), "size": sizes, "node": nodes, "bands": bands}, types)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by matrix products over the n-grams that some but not all have."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = (counts > 1) & (counts < n)
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.full((n, n), float((counts == n).sum()), np.float32)
    for at in range(0, int(shared.sum()), 4096):
        lo, hi = np.searchsorted(column, (at, at + 4096))
        has = np.zeros((n, 4096), np.float32)
        has[owner[lo:hi], column[lo:hi] - at] = 1.0
        both += has @ has.T
    return both


def compare_texts(rows: list[dict], blocks: list[int], same: bool) -> tuple[np.ndarray, np.ndarray]:
    words = _Words()
    sets = [shingles(row["text"], words) for row in rows]
    sizes = np.array([len(s) for s in sets], np.float64)
    both = overlaps(sets)
    linked = both >= THRESHOLD * (sizes[:, None] + sizes[None, :] - both) - 1e-6
    np.fill_diagonal(linked, False)
    if not same:
        block = np.array(blocks)
        linked &= block[:, None] != block[None, :]
    return linked.sum(axis=1), first_connected(linked)


#: Bits for each wanted row in the bitmap that keeps other texts out of a shuffle, and bits in all at most (8 MB, which are broadcast).
_BITS_EACH, _BITS = 8, 1 << 26
_BUCKET = 1 << 15  # bits of one of Spark's bitmaps


def perhaps_wanted(rows: DataFrame, key: list[str], wanted: DataFrame, wanted_key: list[str]) -> DataFrame:
    """``rows`` without most of those whose key no wanted row has, by a bitmap of hashes of keys; no wanted row goes, and a join has to follow."""
    buckets = max(1, min(wanted.count() * _BITS_EACH, _BITS) // _BUCKET)
    at = lambda columns: F.pmod(F.xxhash64(*columns), F.lit(buckets * _BUCKET))
    bit = F.pmod(at(wanted_key), F.lit(_BUCKET))
    bitmaps = wanted.groupBy(F.shiftright(at(wanted_key), 15).alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bitmap"))
    joined = rows.withColumn("_at", at(key)).withColumn("_bucket", F.shiftright("_at", 15)).join(F.broadcast(bitmaps), "_bucket")
    byte = F.conv(F.hex(F.substring("_bitmap", (F.shiftright(F.pmod("_at", F.lit(_BUCKET)), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return joined.filter(byte.bitwiseAND(F.expr("shiftleft(1, CAST(_at % 8 AS INT))")) != 0).select(*rows.columns)


def join_documents(documents: DataFrame) -> DataFrame:
    """(doc_id, th, class_id, copy_id, n_copies, n_links, root): th is the hash of the text, root the group (null without words)."""
    with Scratch(documents.sparkSession) as scratch:
        return durable(_joined(scratch, documents))


def _joined(scratch: Scratch, documents: DataFrame) -> DataFrame:
    given = documents.select("doc_id", "text", F.xxhash64("text").alias("th"))
    signed = scratch.keep(map_batches(given, _signatures, "doc_id long, th long, size int, node binary, bands array<long>"))
    classes = signed.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"), F.min(F.struct("doc_id", "th")).alias("one"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    classes = scratch.keep(classes)
    bucket = Window.partitionBy("band", "hash")
    met = classes.select("node", F.posexplode("bands").alias("band", "hash")).select("node", F.min("node").over(bucket).alias("least"))
    clusters = connected_components(met.select(F.col("node").alias("a"), F.col("least").alias("b"))).withColumnRenamed("root", "cluster")
    members = scratch.keep(with_blocks(clusters.join(classes.select("node", "one", "size"), "node")))
    texts = perhaps_wanted(given, ["doc_id", "th"], members, ["one.doc_id", "one.th"]).withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    held = members.join(texts, F.col("one.doc_id").eqNullSafe(F.col("_id")) & (F.col("one.th") == F.col("_th")))
    held = scratch.keep(held.groupBy("cluster", "node", "blocks", "block").agg(F.first("text").alias("text")))
    compared = scratch.keep(compare_tiles(held, compare_texts, ["text"]))
    links = compared.groupBy("node").agg(F.sum("links").alias("n_links"))
    groups = connected_components(compared.select(F.col("node").alias("a"), F.col("root").alias("b")))
    ids = classes.select("node", "copy_id", "n_copies").join(groups, "node", "left").join(links, "node", "left")
    ids = ids.withColumn("root", F.coalesce("root", "node"))
    least = ids.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    ids = ids.join(least, "root").select("node", "root", "copy_id", "n_copies", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    out = signed.select("doc_id", "th", "node").join(ids, "node", "left")
    alone = F.col("node").isNull()
    return out.select(
        "doc_id",
        "th",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "root",
    )


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class and number of links."""
    joined = join_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return joined.select("doc_id", "class_id", "copy_id", "n_copies", "n_links")


def stage_ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (a null id goes first). Texts without words stay."""
    mark = f"_{uuid.uuid4().hex}"  # no column of docs has this name
    joined = join_documents(docs)
    copies = joined.filter(F.col("root").isNotNull()).groupBy("root", "doc_id", "th").agg(F.count("*").alias("n"))
    first = copies.groupBy("root").agg(F.min(F.struct("doc_id", "th", "n")).alias("one")).select("one.doc_id", "one.th", (F.col("one.n") > 1).alias("again"))
    bare = joined.filter(F.col("root").isNull()).select("doc_id", "th", F.lit(False).alias("again")).distinct()
    kept = first.unionByName(bare).select(F.col("doc_id").alias(f"{mark}_id"), F.col("th").alias(f"{mark}_th"), F.col("again").alias(f"{mark}_again"))
    keyed = docs.withColumn(mark, F.xxhash64("text"))
    out = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col(f"{mark}_id")) & (F.col(mark) == F.col(f"{mark}_th")))
    again = out.filter(f"{mark}_again").dropDuplicates(["doc_id", mark])  # rows that are repeated as a whole
    return out.filter(f"not {mark}_again").unionByName(again).select(*docs.columns)
