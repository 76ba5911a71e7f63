"""Packing of ordered streams, and the arithmetic of batches and readers."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def next_fit(df: DataFrame, stream: str, order: str, length: str, budget: int) -> DataFrame:
    """(stream, order, length, pack): one open pack a stream, closed when the next row doesn't fit; a row above the budget has a pack of its own.

    Rows of a stream pass in order through one task, batch by batch, as each depends on the ones before; streams run side
    by side.
    """
    rows = df.select(stream, order, F.coalesce(F.col(length).cast("bigint"), F.lit(0)).alias(length))
    ordered = rows.repartition(stream).sortWithinPartitions(stream, order)

    def run(batches):  # noqa: ANN001, ANN202
        now, used, pack = None, 0, -1
        for b in batches:
            packs = []
            for s, n in zip(b[stream], b[length], strict=True):
                if s != now:
                    now, used, pack = s, 0, 0
                elif used + n > budget:
                    used, pack = 0, pack + 1
                used += n
                packs.append(pack)
            yield b.assign(pack=pd.Series(packs, index=b.index, dtype="int64"))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ordered.mapInPandas(run, f"{schema}, pack bigint")


def best_fit_decreasing(lengths: list[int], budget: int) -> list[list[int]]:
    """Packs of places in `lengths`: the longest first, each into the fullest pack that has room."""
    free: list[tuple[int, int]] = []
    packs: list[list[int]] = []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(free, (lengths[i], -1))
        room, k = free.pop(at) if at < len(free) else (budget, len(packs))
        if k == len(packs):
            packs.append([])
        packs[k].append(i)
        insort(free, (room - lengths[i], k))
    return packs


def windowed_packs(df: DataFrame, stream: str, order: str, length: str, budget: int, window: int = 128) -> DataFrame:
    """(stream, order, length, pack, place): best fit decreasing over windows of rows in order.

    Of each window the least filled pack is carried into the next one; at a stream's end everything is emitted. Rows
    longer than the budget are dropped beforehand; a null length counts as 0.
    """
    rows = df.select(stream, order, F.coalesce(F.col(length).cast("bigint"), F.lit(0)).alias(length)).where(F.col(length) <= budget)
    ordered = rows.repartition(stream).sortWithinPartitions(stream, order)

    def run(batches):  # noqa: ANN001, ANN202
        now, held, made = None, [], 0

        def emit(last: bool):  # noqa: ANN202
            nonlocal held, made
            packs = best_fit_decreasing([n for _, n in held], budget)
            packs.sort(key=lambda p: -sum(held[i][1] for i in p))
            keep = [] if last else packs[-1:]
            out = []
            for p in packs[: len(packs) - len(keep)]:
                out += [(now, held[i][0], held[i][1], made, k) for k, i in enumerate(sorted(p))]
                made += 1
            held = [held[i] for p in keep for i in sorted(p)]
            return out

        out, fresh = [], 0
        for b in batches:
            for s, o, n in zip(b[stream], b[order], b[length], strict=True):
                if s != now:
                    if held:
                        out += emit(True)
                    now, held, made, fresh = s, [], 0, 0
                held.append((o, n))
                fresh += 1
                if fresh == window:
                    out += emit(False)
                    fresh = 0
            yield pd.DataFrame(out, columns=[stream, order, length, "pack", "place"])
            out = []
        if held:
            yield pd.DataFrame(emit(True), columns=[stream, order, length, "pack", "place"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ordered.mapInPandas(run, f"{schema}, pack bigint, place bigint")


def offsets(packs: DataFrame, pack: list[str], order: str, length: str) -> DataFrame:
    """The start and end of each row in its pack."""
    w = W.partitionBy(*pack).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(length).over(w)
    return packs.withColumn("end", end).withColumn("start", F.col("end") - F.col(length))


def lock_step(packs: DataFrame, rank: str, ordinal: str, accumulate: int) -> DataFrame:
    """The packs that readers in lock-step use: whole groups of `accumulate`, as many as the shortest reader has."""
    shortest = packs.groupBy(rank).agg(F.count("*").alias("n")).agg(F.min("n")).first()[0] or 0
    used = packs.where(F.col(ordinal) < shortest // accumulate * accumulate)
    return used.withColumn("step", F.expr(f"{ordinal} div {int(accumulate)}"))


def batch_shape(world: int, tensor: int, pipeline: int, micro: int, global_batch: int) -> tuple[int, int]:
    """(readers, accumulation steps); an error where numbers don't divide."""
    if world % (tensor * pipeline):
        raise ValueError("the world size is no multiple of tensor * pipeline")
    readers = world // (tensor * pipeline)
    if global_batch % (micro * readers):
        raise ValueError("the global batch is no multiple of micro batch * readers")
    return readers, global_batch // (micro * readers)


def finite_rounds(batches: DataFrame, rank: str, round_: str, empty: dict[str, object]) -> DataFrame:
    """Batches (rank, round from 0, values) made up to as many rounds as the longest rank has: ranks that have run out replay a batch whose values are `empty`, so it weighs nothing.

    The result has a column `replayed`. A rank without batches has no rows.
    """
    ends = batches.groupBy(rank).agg(F.max(round_).alias("_end"))
    last = ends.agg(F.max("_end")).first()[0]
    more = ends.where(F.col("_end") < (last if last is not None else -1)).select(rank, F.explode(F.sequence(F.col("_end") + 1, F.lit(last or 0).cast("bigint"))).alias(round_))
    kinds = {f.name: f.dataType for f in batches.schema.fields}
    replays = more.select(rank, F.col(round_).cast(kinds[round_]).alias(round_), *[F.lit(v).cast(kinds[c]).alias(c) for c, v in empty.items()], F.lit(True).alias("replayed"))
    return batches.select(rank, round_, *empty, F.lit(False).alias("replayed")).unionByName(replays)


def carried(packs: DataFrame, stream: str, ordinal: str, came: Column) -> DataFrame:
    """The rows of each stream's open pack when its first `came` rows (an expression over the rows) have come in."""
    seen = packs.where(F.col(ordinal) < came)
    open_ = seen.groupBy(stream).agg(F.max("pack").alias("pack"))
    return seen.join(open_, [stream, "pack"], "left_semi")
