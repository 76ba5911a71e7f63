"""Seeded order, samples, splits and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomspark.functions.hashing import order_key
from loomspark.sources.readers import with_row_index


def shuffled(df: DataFrame, key: str, seed: int, name: str = "place") -> DataFrame:
    """`df` with each row's place in the seeded order of a unique key."""
    order = order_key(seed, F.col(key))
    return with_row_index(df.withColumn("_order", order), "_order", key, name=name).drop("_order")


def sample(df: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """The first n rows of the seeded order: a top-n, so no full sort is needed."""
    return df.orderBy(order_key(seed, F.col(key)), key).limit(n)


def head_split(df: DataFrame, key: str, seed: int, val_size: int) -> DataFrame:
    """`df` with `place` and `split`: the first min(val_size, rows div 10) rows of the seeded order are 'val', the others 'train'."""
    n = min(val_size, df.count() // 10)
    return shuffled(df, key, seed).withColumn("split", F.when(F.col("place") < n, "val").otherwise("train"))


def chunk_split(chunks: DataFrame, chunk: str, val_chunks: int) -> DataFrame:
    """Chunk names, numbered in order, and their split: the last max(1, min(val_chunks, n div 2)) are 'val', none for val_chunks 0."""
    names = with_row_index(chunks.select(chunk).distinct(), chunk, name="chunk_id")
    n = names.count()
    val = max(1, min(val_chunks, n // 2)) if val_chunks else 0
    ids = names.select(chunk, F.col("chunk_id").cast("int").alias("chunk_id"))
    return ids.withColumn("split", F.when(F.col("chunk_id") >= n - val, "val").otherwise("train"))


def one_each(df: DataFrame, group: str, key: list[str], seed: int, k: int) -> DataFrame:
    """One row of each group, the first in the seeded order of the key, and of those the first k groups in the seeded order of the group."""
    cols = [F.col(c) for c in key]
    w = W.partitionBy(group).orderBy(order_key(seed, F.col(group), *cols), *key)
    picked = df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    return picked.orderBy(order_key(seed, F.col(group)), group).limit(k)


def union_all(parts: list[tuple[str, DataFrame]], source: str = "source") -> DataFrame:
    """Rows of all parts under the union of their columns, with the name and number of the part."""
    tagged = [df.withColumn(source, F.lit(name)).withColumn(f"{source}_ord", F.lit(i)) for i, (name, df) in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of only one of both sides, with the side ('left' or 'right')."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.subtract(right).withColumn("side", F.lit("left")).union(right.subtract(left).withColumn("side", F.lit("right")))


def overlength(length: Column, most: int) -> Column:
    return F.coalesce(length, F.lit(0)) > most


def drop_overlength(df: DataFrame, length: str, most: int, by: str) -> DataFrame:
    """The rows that aren't longer than `most`, with a null column `dropped`, and a row for each value of `by` that lost rows: how many, all else null."""
    long = overlength(F.col(length), most)
    lost = df.where(long).groupBy(by).agg(F.count("*").alias("dropped"))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name != by]
    return df.where(~long).withColumn("dropped", F.lit(None).cast("bigint")).unionByName(lost.select(by, *empty, "dropped"))


def view(df: DataFrame, name: str, strict: bool = False) -> DataFrame:
    """Rows as a source of their own: game and channel are its name. Rows without messages or images are left out; with `strict` they are an error."""
    whole = F.col("messages").isNotNull() & F.col("images").isNotNull()
    if strict:
        whole = F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit(f"{name}: a row lacks messages or images")).cast("boolean"))
    return df.where(whole).withColumns({"game": F.lit(name), "channel": F.lit(name)})
