"""Connected components over edges, by alternating stars on checkpointed tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.session import cut


#: Edges that a task unites at a time before it passes their stars on; this bounds its memory.
UNITED = 1 << 20


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and the smallest node each is tied to by the edges: labels are lowered along edges and to their labels' labels until none changes."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        # The roots of both ends go to the smaller one, so that whole trees are joined at once.
        for end in (label[x], label[y], x, y):
            np.minimum.at(new, end, least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of a partition as stars: each node with the smallest node it is tied to by UNITED edges at a time."""
    waiting: list[np.ndarray] = []

    def stars() -> pa.RecordBatch:
        nodes, root = _roots(*np.concatenate(waiting, axis=1))
        waiting.clear()
        tied = nodes != root
        return pa.RecordBatch.from_arrays([pa.array(nodes[tied]), pa.array(root[tied])], names=["a", "b"])

    for batch in batches:
        waiting.append(np.stack([np.asarray(batch.column(k)) for k in (0, 1)]))
        if sum(w.shape[1] for w in waiting) >= UNITED:
            yield stars()
    if waiting:
        yield stars()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has edges to larger nodes only, or one edge to a smaller node that has none: then that node is the smallest of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    tied = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return tied.where("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every node of an undirected graph with the smallest node of its component.

    edges: columns a, b (bigint); direction, repeats and loops don't matter, rows with a null are ignored.
    Returns node, label, one row for each node. No edges give no rows. Tasks first unite the edges they hold, so that few
    rounds are left. Each round halves the depth of a component's tree; the rounds end when
    every component is a star. A node of any degree is fine: neighbours are never collected into one list, the minima come from partial
    aggregates, and edges get them by `hot_join`, which doesn't shuffle the edges of nodes with very many.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    nodes_only = e.where("a = b").select("a", "b")
    e = cut(e.where("a > b").mapInArrow(_united, "a bigint, b bigint").distinct())
    for _ in range(max_rounds):
        if _are_stars(e):
            break
        size = e.count()
        # Large star: the larger neighbours of each node go to its smallest neighbour.
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large = hot_join(both.where("b > a"), low, "a", total=2 * size).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: the smaller neighbours of each node, and itself, go to the smallest of them.
        large = cut(large.distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = hot_join(large, least, "a", total=size).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b").where("a > b").distinct()
        e = cut(small)
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    labels = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("label")).union(nodes_only.select(F.col("a").alias("node"), F.col("a").alias("label")))
    return labels.union(roots).groupBy("node").agg(F.min("label").alias("label"))


def hot_join(rows: DataFrame, labels: DataFrame, key: str, share: int = 256, total: int | None = None) -> DataFrame:
    """Inner join of `rows` with `labels`, whose `key` is unique and whose column `n` counts the rows of a key.

    Keys with more than 1/share of all rows (fewer than `share` keys, so a proven bound) are broadcast and their rows
    are never shuffled; the other keys join by a shuffle in which no key is large. `total` is the number of rows, where it is known.
    """
    total = (labels.agg(F.sum("n")).first()[0] or 0) if total is None else total
    labels = labels.withColumn("_hot", F.col("n") > max(1, total // share))
    hot, cold = labels.where("_hot").drop("_hot"), labels.where("NOT _hot").drop("_hot")
    hot_keys = [r[0] for r in hot.select(key).take(share + 1)]
    if not hot_keys:
        return rows.join(cold, key)
    is_hot = F.col(key).isin(hot_keys)
    return rows.where(is_hot).join(F.broadcast(hot), key).unionByName(rows.where(~is_hot).join(cold, key))


#: The most rows of a table that is broadcast; narrow ones, a few MB.
BROADCAST_ROWS = 1 << 18


def small_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint where it has at most `most` rows (narrow ones, a few MB), else `df` as it is, for a join by shuffle."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= most else df


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], share: int = 256, parts: int = 8) -> DataFrame:
    """Inner join on columns both sides have, whose keys may each hold any part of the rows of either side.

    Keys with more than 1/share of a side's rows (fewer than `share` a side) are spread: a row of the left side gets one of
    `parts` numbers and comes once for each number of the right side, and the other way round, so such a key is joined by
    parts * parts tasks. The other keys join as usual. A right side that `small_broadcast` takes is broadcast instead. Null
    keys match nothing. Both sides are read more than once.
    """
    spark = left.sparkSession
    sides = [df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)) for df in (left, right)]
    if sides[1].count() <= BROADCAST_ROWS:
        return sides[0].join(F.broadcast(sides[1]), keys)
    hot = set()
    for df in sides:
        most = max(1, df.count() // share)
        hot |= {tuple(r) for r in df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > max(most, share)).select(*keys).take(share + 1)}
    if not hot:
        return sides[0].join(sides[1], keys)
    named = F.broadcast(spark.createDataFrame(sorted(hot), sides[0].select(*keys).schema).coalesce(1))
    numbers = F.array(*[F.lit(i) for i in range(parts)])
    own = F.pmod(F.monotonically_increasing_id(), F.lit(parts)).cast("int")
    a = sides[0].join(named, keys, "left_semi").withColumn("__a", own).withColumn("__b", F.explode(numbers))
    b = sides[1].join(named, keys, "left_semi").withColumn("__b", own).withColumn("__a", F.explode(numbers))
    spread = a.join(b, [*keys, "__a", "__b"]).drop("__a", "__b")
    return spread.unionByName(sides[0].join(named, keys, "left_anti").join(sides[1].join(named, keys, "left_anti"), keys))
