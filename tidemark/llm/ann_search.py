"""Approximate nearest neighbours by cross-polytope hashing with multiprobe and exact reranking.

A hash function turns a unit vector by three rounds of random signs and a fast Hadamard transform (a
pseudo-rotation) and takes the nearest signed axis. A table has one or two functions. Every vector is indexed under its
own bucket in each of TABLES tables; a query probes the buckets whose axes it comes nearest to. Buckets are cut into
blocks of about BLOCK vectors, and a block with the queries that probe it is one tile, so no task's memory
depends on how many vectors share a bucket. Candidates are reranked by their cosine, in double precision on the
original vectors, inside the tile; a tile returns only a query's best K.

How many functions and probes are needed depends on the data. They are fitted on at most SAMPLE_VECTORS indexed vectors
(chosen by hash) and SAMPLE_QUERIES of them as queries: the plan that compares fewest vectors among those that
find TARGET_RECALL of the sample's exact neighbours. Neighbours only get nearer as rows are added, so
recall on all rows is no lower. Memory for fitting and probing grows with the vectors' length, not with its square. Vectors with near neighbours need few probes; for vectors without structure
every method has to compare a large part. A query for which fewer than K rows are found is searched again over all
buckets.

Equal vectors are indexed once, with their K + 1 smallest ids, which is all that a result of K can hold.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, neither
as rows nor as queries; vectors meet only those of the same length; equal scores go to the smaller id; rows that repeat id and
vector count once, and no row with the query's id is its own neighbour; a null id takes no part; other columns are ignored; an empty table gives no
rows. A vector may have any length that a row can hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import map_batches, to_batch
from tidemark.session import durable

K = 5
TABLES = 2
BLOCK = 4096
TARGET_RECALL = 0.95
SAMPLE_VECTORS, SAMPLE_NUMBERS, SAMPLE_QUERIES = 20_000, 2_000_000, 200
MAX_PROBES = 512
QUERY_EVERY = 50


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row; the length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), -1, 2, h)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


@dataclass(frozen=True)
class Plan:
    """Hash functions for vectors of one length."""

    length: int
    functions: int
    probes: int

    def nearness(self, units: np.ndarray, table: int) -> list[np.ndarray]:
        """For each function of a table, how near each vector is to each signed axis."""
        size = 1 << max(1, (self.length - 1).bit_length())
        padded = np.zeros((len(units), size))
        padded[:, : self.length] = units
        out = []
        for f in range(self.functions):
            rng = np.random.default_rng((self.length, table, f))
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice((-1.0, 1.0), size))
            out.append(np.concatenate((y, -y), axis=1))
        return out

    def buckets(self, units: np.ndarray, table: int) -> np.ndarray:
        out = np.zeros(len(units), np.int64)
        for near in self.nearness(units, table):
            out = out * near.shape[1] + near.argmax(axis=1)
        return out

    def probed(self, units: np.ndarray, table: int, probes: int | None = None) -> np.ndarray:
        """The buckets that each query probes, nearest first.

        With two functions a bucket's nearness is a sum. The i-th best axis of one and the j-th best of the other are among the n
        best sums only if (i + 1) * (j + 1) <= n, so n ln n sums are looked at, however many buckets there are.
        """
        n = min(probes or self.probes, self.all_buckets)
        near = self.nearness(units, table)
        orders = [_best_axes(x, min(n, x.shape[1])) for x in near]
        if len(near) == 1:
            return orders[0]
        first, second = (np.take_along_axis(x, o, 1) for x, o in zip(near, orders))
        i, j = np.nonzero(np.outer(np.arange(1, first.shape[1] + 1), np.arange(1, second.shape[1] + 1)) <= n)
        chosen = _best_axes(first[:, i] + second[:, j], min(n, len(i)))
        return np.take_along_axis(orders[0], i[chosen], 1) * near[1].shape[1] + np.take_along_axis(orders[1], j[chosen], 1)

    @property
    def all_buckets(self) -> int:
        return (2 << max(1, (self.length - 1).bit_length())) ** self.functions


def _best_axes(near: np.ndarray, n: int) -> np.ndarray:
    some = np.argpartition(-near, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(-np.take_along_axis(near, some, 1), axis=1, kind="stable"), 1)


def units_of(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def fit_plan(vectors: np.ndarray) -> Plan:
    """The plan of fewest comparisons that reaches TARGET_RECALL on a sample."""
    length = vectors.shape[1]
    exact = Plan(length, 1, 2 << max(1, (length - 1).bit_length()))
    if len(vectors) <= 4 * K:
        return exact
    units = units_of(vectors)
    queries = np.arange(min(SAMPLE_QUERIES, len(units)))
    cosines = units[queries] @ units.T
    cosines[queries, queries] = -2.0
    truth = np.argsort(-cosines, axis=1)[:, :K]
    best, least = exact, 1.0
    for functions in (1, 2):
        plan = Plan(length, functions, 1)
        most = min(plan.all_buckets, MAX_PROBES)
        rank = np.full(truth.shape, most)
        shares = np.zeros(most)
        for table in range(TABLES):
            own = plan.buckets(units, table)
            probed = plan.probed(units[queries], table, most)
            match = probed[:, None, :] == own[truth][:, :, None]
            rank = np.minimum(rank, np.where(match.any(axis=2), match.argmax(axis=2), most))
            held, sizes = np.unique(own, return_counts=True)
            place = np.minimum(np.searchsorted(held, probed), len(held) - 1)
            shares[: probed.shape[1]] += np.cumsum(np.where(held[place] == probed, sizes[place], 0), axis=1).mean(axis=0) / len(units)
        recall = np.array([(rank < n).mean() for n in range(1, most + 1)])
        enough = np.flatnonzero(recall >= TARGET_RECALL)
        if len(enough) and shares[enough[0]] < least * TABLES:
            best, least = Plan(length, functions, int(enough[0]) + 1), shares[enough[0]] / TABLES
    return best


def usable(vector) -> object:
    parts = vector.cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(parts, lambda x: x != 0)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(ids, vector): each distinct vector with its K + 1 smallest ids."""
    within = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("_rank", F.dense_rank().over(within)).filter(F.col("_rank") <= K + 1)
    return few.groupBy("vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _index_batches(plan: Plan, numbers: type):
    types = {"table": pa.int32(), "bucket": pa.int64(), "ids": pa.list_(pa.int64()), "vec": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            units, packed = units_of(vectors), [v.tobytes() for v in vectors.astype(numbers)]
            for table in range(TABLES):
                yield to_batch({"table": [table] * len(units), "bucket": plan.buckets(units, table), "ids": batch.column("ids"), "vec": packed}, types)

    return work


def _query_batches(plan: Plan, numbers: type):
    types = {"table": pa.int32(), "bucket": pa.int64(), "ids": pa.list_(pa.int64()), "vec": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, ids = _matrix(batch.column("vector")), batch.column("vec_id").to_pylist()
            units, packed = units_of(vectors), [v.tobytes() for v in vectors.astype(numbers)]
            for table in range(TABLES):
                for at in range(0, len(units), 64):  # few at a time, as each query becomes many rows
                    probed = plan.probed(units[at : at + 64], table)
                    n = probed.shape[1]
                    own = range(at, min(at + 64, len(units)))
                    columns = {"ids": [[ids[i]] for i in own for _ in range(n)], "vec": [packed[i] for i in own for _ in range(n)]}
                    yield to_batch({"table": [table] * probed.size, "bucket": probed.ravel()} | columns, types)

    return work


def _best_of(index: list[tuple[list[int], np.ndarray]], query_ids: list[int], queries: np.ndarray) -> Iterator[tuple[int, list[tuple[float, int]]]]:
    """Each query's K nearest of a tile as (-cosine, id)."""
    vectors = np.array([v for _, v in index])
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    for at in range(0, len(queries), 256):
        some = queries[at : at + 256]
        lengths = np.sqrt((some * some).sum(axis=1))
        rough = (some @ vectors.T) / norms
        n = min(2 * K + 2, len(vectors))
        chosen = np.argpartition(-rough, n - 1, axis=1)[:, :n]
        floor = np.take_along_axis(rough, chosen, 1).min(axis=1)
        for i, query_id in enumerate(query_ids[at : at + 256]):
            near = chosen[i] if n == len(vectors) else np.flatnonzero(rough[i] >= floor[i] - 1e-12 * abs(floor[i]))
            cosines = (vectors[near] * some[i]).sum(axis=1) / (norms[near] * lengths[i])
            found = [(-c, x) for c, j in zip(cosines.tolist(), near.tolist()) for x in index[j][0] if x != query_id]
            yield query_id, sorted(found)[:K]


def _tile_batches(numbers: type):
    types = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}
        tile, index, ids, queries = None, [], [], []

        def close():
            if index and ids:
                for query_id, found in _best_of(index, ids, np.array(queries)):
                    best[query_id] = sorted(set(best.get(query_id, ())) | set(found))[:K]

        def flush():
            rows = [(q, x, -s) for q, found in best.items() for s, x in found]
            best.clear()
            return to_batch({name: [r[i] for r in rows] for i, name in enumerate(types)}, types)

        for batch in batches:
            for key, is_query, own, vec in zip(*(batch.column(c).to_pylist() for c in ("tile", "is_query", "ids", "vec"))):
                if key != tile or len(ids) >= 2048:
                    close()
                    index = index if key == tile else []
                    tile, ids, queries = key, [], []
                    if len(best) >= 20_000:
                        yield flush()
                vector = np.frombuffer(vec, numbers).astype(np.float64)
                if is_query:
                    ids.append(own[0])
                    queries.append(vector)
                else:
                    index.append((own, vector))
        close()
        yield flush()

    return work


def _search(index: DataFrame, queries: DataFrame, numbers: type) -> DataFrame:
    """(query_id, vec_id, score): the nearest rows that tiles have found."""
    sizes = index.groupBy("table", "bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    tile = F.xxhash64("table", "bucket", "block").alias("tile")
    block = F.pmod(F.xxhash64("vec"), F.col("blocks")).cast("int").alias("block")
    stored = index.join(sizes, ["table", "bucket"]).select("table", "bucket", block, "ids", "vec", F.lit(False).alias("is_query"))
    asked = queries.join(sizes, ["table", "bucket"]).select("table", "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "ids", "vec", F.lit(True).alias("is_query"))
    tiles = stored.unionByName(asked).select(tile, "is_query", "ids", "vec")
    dealt = tiles.repartition(F.col("tile")).sortWithinPartitions("tile", "is_query")
    return map_batches(dealt, _tile_batches(numbers), "query_id long, vec_id long, score double")


def _ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= K)


def nearest(embeddings: DataFrame, query: object, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the K nearest rows of each row for which ``query`` holds."""
    rows = embeddings.filter(F.col("vec_id").isNotNull() & usable(F.col(vector))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    numbers = np.float32 if rows.schema["vector"].dataType.elementType.typeName() == "float" else np.float64
    schema = "table int, bucket long, ids array<long>, vec binary"
    out = embeddings.sparkSession.createDataFrame([], "query_id long, vec_id long, score double, rank int")
    for row in rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"), F.countDistinct("vec_id").alias("ids")).collect():
        length, n = row["length"], row["n"]
        own = rows.filter(F.size("vector") == length)
        share = min(1.0, min(SAMPLE_VECTORS, SAMPLE_NUMBERS // length) / n)
        hashed = F.xxhash64("vector").cast("double") / 2.0**64 + 0.5
        sample = own.filter(hashed <= share).select("vector").toPandas()["vector"]
        sample = np.unique(np.array([np.array(v, np.float64) for v in sample]).reshape(-1, length), axis=0)
        plan = fit_plan(sample[np.random.default_rng(7).permutation(len(sample))])
        index = map_batches(distinct_vectors(own), _index_batches(plan, numbers), schema)
        asked = own.filter(query).distinct()
        found = durable(_ranked(_search(index, map_batches(asked, _query_batches(plan, numbers), schema), numbers)))
        full = found.groupBy("query_id").agg(F.count("*").alias("k")).filter(F.col("k") >= min(K, row["ids"] - 1)).select(F.col("query_id").alias("vec_id"))
        short = asked.join(full, "vec_id", "left_anti")
        if row["ids"] > 1 and not short.isEmpty():
            whole = index.filter(F.col("table") == 0).withColumn("bucket", F.lit(0).cast("long"))  # one bucket of all rows, in blocks
            again = _search(whole, map_batches(short, _query_batches(Plan(length, 1, 1), numbers), schema).filter("table = 0").withColumn("bucket", F.lit(0).cast("long")), numbers)
            found = _ranked(found.drop("rank").unionByName(again))
        out = out.unionByName(found.select(*out.columns))
    return out.select("query_id", "rank", "vec_id", "score")


def op8_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest five rows of every row whose id is divisible by 50."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % QUERY_EVERY == 0)
