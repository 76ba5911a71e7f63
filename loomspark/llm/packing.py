"""Problem 4: rows of varying length packed into containers of fixed capacity."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.images import image_tokens
from loomspark.functions.names import with_known_game
from loomspark.operators.graph import small_broadcast
from loomspark.llm.bpe import DEFAULT_TOKENIZER
from loomspark.llm.tokens import bpe_counter, with_tokens
from loomspark.session import cut, small_rows

PACKS = "pack_name string, pack_id bigint, id bigint, piece int, start bigint, length bigint, open boolean"


def row_lengths(train: DataFrame, channels: DataFrame, path: str = DEFAULT_TOKENIZER, default_size: tuple[int, int] = (1280, 720)) -> DataFrame:
    """(train_id, tokens) of each row: the tokens of its messages' contents plus those of its images.

    An image is any path that isn't null or blank and counts by the frame size of the row's channel, of `default_size`
    where no channel is known. Null messages, contents and images count 0.
    """
    sizes = channels.where("channel IS NOT NULL").groupBy("channel").agg(*[F.max(F.nullif(F.col(c), F.lit(0))).alias(c) for c in ("frame_width", "frame_height")])
    frames = train.sparkSession.createDataFrame([tuple(r) for r in small_rows(sizes)], "known string, frame_width int, frame_height int").coalesce(1)
    each = image_tokens(*[F.coalesce(c, F.lit(d)) for c, d in zip(("frame_width", "frame_height"), default_size, strict=True)])
    shown = F.coalesce(F.size(F.filter("images", lambda p: F.trim(p) != "")), F.lit(0))
    shown = F.when(F.col("images").isNull(), 0).otherwise(shown)
    named = with_known_game(train.select("train_id", "channel", "game", "images", "messages"), channels, "known")
    counted = with_tokens(named.join(F.broadcast(frames), "known", "left"), [F.col("train_id"), (shown * each).alias("visual")], F.col("messages.content"), bpe_counter(path))
    return counted.select("train_id", (F.col("tokens") + F.col("visual")).alias("tokens"))


class Windows:
    """A fixed number of open containers; the best fit takes an item, the fullest is closed when none fits."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.free, self.items, self.made = capacity, most, [], {}, 0

    def place(self, item: tuple, length: int) -> tuple[int, list] | None:
        """Place an item; gives (number, items) of the container that was closed for it, if one was."""
        at = bisect.bisect_left(self.free, (length, -1))
        closed = None
        if at < len(self.free):
            room, k = self.free.pop(at)
        else:
            if len(self.free) == self.most:
                _, full = self.free.pop(0)
                closed = full, self.items.pop(full)
            room, k = self.capacity, self.made
            self.made += 1
            self.items[k] = []
        self.items[k].append(item)
        if room == length and length:
            return (k, self.items.pop(k)) if closed is None else self._two(closed, k)
        bisect.insort(self.free, (room - length, k))
        return closed

    def _two(self, closed: tuple[int, list], k: int) -> tuple[int, list]:
        # The new container is full as well: it stays open with no room and is the next to be closed.
        bisect.insort(self.free, (0, k))
        return closed


def _packer(limits: list[tuple[str, int]], windows: int, level: int, last: bool):
    """Packs the rows (shard, id, piece, start, length, pack_name) of a partition, which come sorted by shard and order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, open_, out = None, {}, {k: [] for k in range(7)}

        def emit(name: str, number: int, items: list, still: bool) -> None:
            pack = (level << 58) | (shard << 30) | number
            for i, piece, start, length in items:
                for k, v in enumerate((name, pack, i, piece, start, length, still)):
                    out[k].append(v)

        def flush() -> None:
            for name, w in open_.items():
                for number, items in w.items.items():
                    emit(name, number, items, not last)
            open_.clear()

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            made = pa.RecordBatch.from_arrays([pa.array(out[k], kinds[k]) for k in range(7)], names=["pack_name", "pack_id", "id", "piece", "start", "length", "open"])
            for k in out:
                out[k].clear()
            return made

        for b in batches:
            cols = [b.column(k).to_pylist() for k in range(b.num_columns)]
            for s, i, piece, start, length, name in zip(*cols, strict=True):
                if s != shard:
                    flush()
                    shard = s
                for pack, capacity in limits if name is None else [(name, dict(limits)[name])]:
                    w = open_.get(pack) or open_.setdefault(pack, Windows(capacity, windows))
                    at, rest, part = start, length, piece
                    while rest > capacity:
                        w.made += 1
                        emit(pack, w.made - 1, [(i, part, at, capacity)], False)
                        at, rest, part = at + capacity, rest - capacity, part + 1
                    if closed := w.place((i, part, at, rest), rest):
                        emit(pack, *closed, False)
                if len(out[0]) > 50_000:
                    yield batch()
        flush()
        if out[0]:
            yield batch()

    return run


def pack_items(items: DataFrame, limits: DataFrame, windows: int = 64, shard_rows: int = 50_000, fan_in: int = 32) -> DataFrame:
    """Pack items (id, tokens) into containers of each capacity in `limits` (pack_name, max_tokens).

    Returns pack_name, pack_id, id, piece, start, length: every item once for each limit; an item longer than the
    capacity in pieces of the capacity, the rest (its last piece) like an item; pieces count from 0. Items are dealt to
    shards of about `shard_rows` by a hash of the id, and a shard keeps `windows` open containers: the best fit takes
    an item, the fullest is closed when none fits. The items of containers still open at a shard's end go, from
    `fan_in` shards at a time, to the next level, longest first, until one shard is left; a task never holds more than
    fan_in * windows containers. Null and negative lengths count as 0, items of length 0 lie in any container; a row
    with a null id is packed as well, repeated ids are separate items. Limits that are null or below 1 are left out, of a
    name with several capacities the smallest holds; without limits or items there are no rows. The result depends on the rows only, not on partitions or their order.
    """
    usable = limits.where("pack_name IS NOT NULL AND max_tokens >= 1").groupBy("pack_name").agg(F.min("max_tokens").alias("max_tokens"))
    caps = sorted((r.pack_name, int(r.max_tokens)) for r in small_rows(usable))
    spark = items.sparkSession
    if not caps:
        return spark.createDataFrame([], PACKS).drop("open")
    items = items.select(F.col("id").cast("bigint").alias("id"), F.greatest(F.coalesce("tokens", F.lit(0)), F.lit(0)).cast("bigint").alias("length"))
    shards = max(1, -(-items.count() // shard_rows))
    rows = items.select(_shard(F.col("id"), shards).alias("shard"), "id", F.lit(0).alias("piece"), F.lit(0).cast("bigint").alias("start"), "length", F.lit(None).cast("string").alias("pack_name"))
    order = ["shard", F.xxhash64("id"), "id", "length"]
    done, level = [], 0
    while True:
        last = shards == 1 and level > 0
        made = cut(rows.repartition(min(shards, 4096), "shard").sortWithinPartitions(*order).mapInArrow(_packer(caps, windows, level, last), PACKS))
        done.append(made.where("NOT open"))
        if last:
            break
        shards = -(-shards // fan_in)
        level += 1
        rows = made.where("open").select(_shard(F.col("pack_id"), shards).alias("shard"), "id", "piece", "start", "length", "pack_name")
        order = ["shard", "pack_name", F.desc("length"), "id", "piece"]
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.drop("open")


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("bigint")


def pack_report(packs: DataFrame, limits: DataFrame) -> DataFrame:
    """For each pack_name the containers, items, cut items, tokens, and the share of the capacity that is used."""
    each = packs.groupBy("pack_name", "pack_id").agg(F.sum("length").alias("used"), F.count("*").alias("pieces"), F.sum((F.col("piece") > 0).cast("int")).alias("cuts"))
    total = each.groupBy("pack_name").agg(F.count("*").alias("packs"), F.sum("pieces").alias("pieces"), F.sum("cuts").alias("cuts"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"))
    return total.join(small_broadcast(limits.where("pack_name IS NOT NULL AND max_tokens >= 1").groupBy("pack_name").agg(F.min("max_tokens").alias("max_tokens"))), "pack_name").withColumn("used_share", F.col("tokens") / (F.col("packs") * F.col("max_tokens")))


def pack_train(train: DataFrame, channels: DataFrame, limits: DataFrame, path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Rows of train packed by `row_lengths` into every capacity of `limits`; see `pack_items`."""
    lengths = cut(row_lengths(train, channels, path))
    return pack_items(lengths.select(F.col("train_id").alias("id"), "tokens"), limits).withColumnRenamed("id", "train_id")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The fewest containers that could hold the lengths."""
    return int(-(-int(np.sum(lengths)) // capacity))
