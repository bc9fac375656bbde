"""Groups of linked rows without all pairs in one place: connected components, and comparing a cluster in tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.texts import map_batches, to_batch
from tidemark.session import Scratch, durable

#: Rows, and characters on average, of a cluster's block. A tile holds two blocks, so a task's memory doesn't depend on
#: cluster sizes; only a single text of more characters makes a larger tile.
BLOCK = 256
BLOCK_CHARS = 2 << 20
ROUNDS = 60

Compare = Callable[[list[dict], list[int], bool], tuple[np.ndarray, np.ndarray]]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b); the root is the smallest node of the component.

    Alternates large-star and small-star steps, each a minimum by key (combined before the shuffle) and a join
    whose skewed side Spark can split. Every round is written to the shared checkpoint folder and the one before
    deleted; rounds grow with the logarithm of the components' size. Nulls take no part; an empty input gives no rows.
    """
    with Scratch(edges.sparkSession) as scratch:
        links = scratch.keep(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
        for _ in range(ROUNDS):
            if _is_star_forest(links):
                break
            around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = around.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
            large = links.select(F.col("v").alias("lo"), F.col("u").alias("hi")).join(least.withColumnRenamed("u", "lo"), "lo")
            large = scratch.keep(large.select(F.col("hi").alias("u"), F.col("m").alias("v")).distinct())
            scratch.drop(links)
            below = large.groupBy("u").agg(F.min("v").alias("m"))
            moved = large.join(below, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            links = scratch.keep(moved.unionByName(below.select("u", F.col("m").alias("v"))).distinct())
            scratch.drop(large)
        else:
            raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
        return durable(links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _is_star_forest(links: DataFrame) -> bool:
    again = links.groupBy("u").count().filter("count > 1").select("u")
    inner = links.select("u").join(links.select(F.col("v").alias("u")), "u", "left_semi")
    return again.unionByName(inner).isEmpty()


def with_blocks(members: DataFrame) -> DataFrame:
    """(cluster, node, size, ...) with the number of blocks of the cluster and the row's own; clusters of one row go."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("_n"), F.sum(F.coalesce(F.col("size"), F.lit(0)).cast("long")).alias("_size")).filter("_n > 1")
    blocks = F.least(F.col("_n"), F.greatest(F.ceil(F.col("_n") / BLOCK), F.ceil(F.col("_size") / BLOCK_CHARS)))
    return members.join(sizes.select("cluster", blocks.cast("int").alias("blocks")), "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def compare_tiles(members: DataFrame, compare: Compare, columns: list[str], meets: Column | None = None) -> DataFrame:
    """(node, links, root) for every row of every tile.

    ``members`` has cluster, node (binary), blocks, block and ``columns``. Two blocks of a cluster meet in one
    tile, and a block meets itself in one, so each pair of rows is compared once; ``meets`` lists the blocks that a row's block
    meets, if not all. ``compare(rows, blocks, same)`` returns, for the rows of a tile, their number of links and for each the
    position of the first row that it is connected to; ``blocks`` holds each row's block, and unless ``same`` only rows of
    different blocks make pairs. A link is thus counted for both its rows; (node, root) are edges that connect what the tile's
    links connect.
    """
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1) if meets is None else meets).alias("_other")
    placed = members.select("cluster", "node", "block", *columns, other)
    placed = placed.select(
        F.xxhash64("cluster", F.least("block", "_other"), F.greatest("block", "_other")).alias("tile"),
        (F.col("block") == F.col("_other")).alias("same"),
        "node",
        "block",
        *columns,
    )
    return _compared(placed, compare)


def _compared(placed: DataFrame, compare: Compare) -> DataFrame:
    # a number of partitions, as without one Spark joins partitions by their bytes, and a tile's work grows with the square of its rows
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(n, F.col("tile")).sortWithinPartitions("tile", "same", "node")
    types = {"node": pa.binary(), "links": pa.int64(), "root": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, rows = None, []
        out: dict[str, list] = {"node": [], "links": [], "root": []}

        def close():
            distinct = list({row["node"]: row for row in rows}.values())  # repeated rows fetch the same text twice
            if len(distinct) > 1:
                links, first = compare(distinct, [row["block"] for row in distinct], rows[0]["same"])
                out["node"] += [row["node"] for row in distinct]
                out["links"] += links.tolist()
                out["root"] += [distinct[i]["node"] for i in first.tolist()]

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["tile"], row["same"])
                if key != open_key:
                    if rows:
                        close()
                    open_key, rows = key, []
                    if len(out["node"]) >= 5000:
                        yield to_batch(out, types)
                        out = {name: [] for name in out}
                rows.append(row)
        if rows:
            close()
        yield to_batch(out, types)

    return map_batches(dealt, work, "node binary, links long, root binary")


def connect_members(scratch: Scratch, members: DataFrame, compare: Compare, columns: list[str]) -> DataFrame:
    """(a, b) edges that connect what all pairs within the clusters connect, without looking at all pairs of a large cluster.

    ``members`` has cluster, node, blocks, block, size and ``columns``. First every block meets itself and its cluster's first
    block, which is all there is to a small cluster and connects most of a large group of copies. Rows outside
    the largest group so found then meet each other and that group; pairs within it need no comparison.
    """
    meets = F.when(F.col("block") == 0, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0), F.col("block")))
    found = scratch.keep(_edges(compare_tiles(members, compare, columns, meets)))
    large = members.filter("blocks > 1")
    if large.isEmpty():
        return found
    groups = connected_components(found)
    large = scratch.keep(large.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")))
    counted = large.groupBy("cluster", "root").agg(F.countDistinct("node").alias("n"))
    largest = counted.groupBy("cluster").agg(F.max(F.struct("n", "root"))["root"].alias("largest"))
    large = large.join(largest, "cluster").withColumn("inside", F.col("root") == F.col("largest")).drop("root", "largest")
    rest = scratch.keep(with_blocks_again(large.filter("not inside").drop("inside", "blocks", "block")))
    if rest.isEmpty():
        return found
    among = _edges(compare_tiles(rest, compare, columns))
    inside = large.filter("inside").select("cluster", "node", "blocks", "block", *columns)
    n_rest = rest.groupBy("cluster").agg(F.first("blocks").alias("r_blocks"))
    n_inside = inside.groupBy("cluster").agg(F.first("blocks").alias("l_blocks"))
    left = rest.join(n_inside, "cluster").select("cluster", "node", *columns, F.lit(0).alias("block"), F.col("block").alias("r"), F.explode(F.sequence(F.lit(0), F.col("l_blocks") - 1)).alias("l"))
    right = inside.join(n_rest, "cluster").select("cluster", "node", *columns, F.lit(1).alias("block"), F.explode(F.sequence(F.lit(0), F.col("r_blocks") - 1)).alias("r"), F.col("block").alias("l"))
    placed = left.unionByName(right).select(F.xxhash64("cluster", "r", "l").alias("tile"), F.lit(False).alias("same"), "node", "block", *columns)
    known = _edges(groups)  # what the links so far connect, in one step each
    return known.unionByName(among).unionByName(_edges(_compared(placed, compare)))


def with_blocks_again(members: DataFrame) -> DataFrame:
    """As ``with_blocks``, but clusters of one row stay."""
    sizes = members.groupBy("cluster").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.col("size").cast("long")) / BLOCK_CHARS)).cast("int").alias("blocks"))
    return members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))


def _edges(compared: DataFrame) -> DataFrame:
    return compared.filter(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b"))


def first_connected(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the position of the first row of each row's component."""
    n = len(linked)
    label = np.arange(n)
    while True:
        seen = np.where(linked, label[None, :], n).min(axis=1)
        new = np.minimum(label, seen)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new
