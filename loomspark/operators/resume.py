"""Positions in a fixed order: what a reader has used, what comes next, and whether a stored state still fits."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from loomspark.sources import files
from loomspark.sources.sinks import replace_json


@dataclass(frozen=True)
class Identity:
    """What an order depends on; a state made under another one isn't resumed."""

    digest: str
    rank: int
    world: int
    buffer: int = 0
    length: int = 0
    window: int = 0
    strategy: str = "best_fit"


@dataclass
class State:
    """Where a reader stands: the next position and pack, and what follows from them, so that a reader that doesn't hold the order as a table can go on, too.

    cursors: for each dataset the next occurrence, pass, place in the pass and what remains of its target (`cursors`);
    buffer: (cell, dataset, occurrence) of the rows a buffer holds (`mixture.held_rows`); carry: (row, length) in the open
    pack (`packing.carried`).
    """

    identity: Identity
    next_pos: int = 0
    next_pack: int = 0
    cursors: dict[str, dict] = field(default_factory=dict)
    buffer: list[list] = field(default_factory=list)
    carry: list[list] = field(default_factory=list)


def save_state(folder: str, state: State) -> str:
    """Write a reader's state, whole or not at all."""
    path = f"{folder.rstrip('/')}/rank_{state.identity.rank:05d}.json"
    replace_json(path, asdict(state))
    return path


def load_states(folder: str, identities: list[Identity]) -> list[State] | None:
    """The states of all readers; None where one is missing (then replay from what was consumed); ValueError where one belongs to another order."""
    out = []
    for want in identities:
        path = f"{folder.rstrip('/')}/rank_{want.rank:05d}.json"
        if not files.exists(path):
            return None
        raw = json.loads(files.read_whole(path))
        have = Identity(**raw.pop("identity"))
        if have != want:
            different = [k for k, v in asdict(want).items() if asdict(have)[k] != v]
            raise ValueError(f"the state of rank {want.rank} was made with another {', '.join(different)}")
        out.append(State(have, **raw))
    return out


def cursors(ordered: DataFrame, datasets: DataFrame, next_pos: int) -> DataFrame:
    """Each dataset's cursor when the first `next_pos` rows of an order (dataset, pos) are consumed: next occurrence, its pass and place in the pass, and what remains of the target.

    datasets: dataset, size, target. Datasets not met yet are at 0.
    """
    used = ordered.where(F.col("pos") < next_pos).groupBy("dataset").agg(F.count("*").alias("occurrence"))
    c = datasets.select("dataset", "size", "target").join(used, "dataset", "left").withColumn("occurrence", F.coalesce("occurrence", F.lit(0)))
    return c.select("dataset", "occurrence", F.expr("occurrence div size").alias("logical_pass"), F.expr("occurrence % size").alias("emitted_in_pass"), (F.col("target") - F.col("occurrence")).alias("remaining"))


def agrees(consumed: Column, dispatched: Column, iteration: Column, global_batch: int, accumulate: int) -> Column:
    """Whether counters of rows and batches are those of an iteration."""
    return (consumed == iteration * global_batch) & (dispatched == iteration * accumulate)


def remaining(ordered: DataFrame, position: str, next_pos: int) -> DataFrame:
    """The rows of an order from a position on."""
    return ordered.where(F.col(position) >= next_pos)


def consumed_rows(iteration: int, global_batch: int) -> int:
    return iteration * global_batch


def check_lengths(stored: DataFrame, fresh: DataFrame, key: list[str], length: str) -> DataFrame:
    """Rows whose length isn't what the state holds: missing or different ones, none if the state still fits."""
    f = fresh.select(*key, F.col(length).alias("_fresh"))
    return stored.join(f, key, "left").where(~F.col("_fresh").eqNullSafe(F.col(length))).drop("_fresh")


def latest_valid(names: list[str], valid) -> str:  # noqa: ANN001
    """The highest numbered `checkpoint-N` that `valid` accepts; an error with up to three reasons where none is."""
    import re

    numbered = sorted(((int(m[1]), n) for n in names if (m := re.search(r"checkpoint-(\d+)$", n))), reverse=True)
    wrong = []
    for _, name in numbered:
        try:
            valid(name)
            return name
        except (OSError, ValueError, KeyError) as e:
            wrong.append(f"{name}: {e}")
    raise ValueError("no valid checkpoint; " + "; ".join(wrong[:3]))


def latest_valid_of(candidates: DataFrame, run: str, number: str, wrong: str, most: int = 3) -> DataFrame:
    """The same for a table of candidates (run, number, what is wrong or null): for each run the highest valid number (null for none), how many higher ones were skipped, and the reasons of the last `most` of them.

    Partial aggregates find the valid one; of the skipped ones only the highest `most` are gathered.
    """
    best = candidates.groupBy(run).agg(F.max(F.when(F.col(wrong).isNull(), F.col(number))).alias("_best"))
    later = candidates.where(F.col(wrong).isNotNull()).join(best, run).where(F.col("_best").isNull() | (F.col(number) > F.col("_best")))
    place = F.row_number().over(W.partitionBy(run).orderBy(F.desc(number)))
    text = F.concat(F.lit("checkpoint-"), F.col(number).cast("string"), F.lit(": "), wrong)
    why = later.withColumn("_place", place).where(F.col("_place") <= most).groupBy(run).agg(F.sort_array(F.collect_list(F.struct("_place", text.alias("t")))).alias("_why"))
    skipped = later.groupBy(run).agg(F.count("*").alias("skipped"))
    out = best.join(skipped, run, "left").join(why, run, "left")
    return out.select(run, F.col("_best").alias(number), F.coalesce("skipped", F.lit(0)).alias("skipped"), F.array_join(F.col("_why.t"), "; ").alias("reasons"))
