"""Problem 1: train, validation and test splits that keep rows of the same recording together."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.frames import own_frames, recordings, shared_keys
from loomspark.functions.names import channel_keys, with_known_game
from loomspark.operators.graph import connected_components, hot_join, small_broadcast
from loomspark.session import cut, small_rows

#: Groups with more than this share of all rows, and more than LEAST rows, are placed one by one on the driver; there are at most 1 / BIG of them.
BIG, LEAST = 0.001, 64


def recording_ids(train: DataFrame, channels: DataFrame, shared_frames: DataFrame) -> DataFrame:
    """(id, label, recs): the known game of each row and the distinct recordings its own frames come from.

    A recording is a bigint made of game, chunk and row; numbers too large for it give a negative hash. Rows without a
    known game, without images or with shared frames only have no recordings. Rows with a null id are left out.
    """
    games = sorted(set(channel_keys(channels).values()))
    number = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(g) for g in games]), F.coalesce("label", F.lit(""))), F.lit(0)) - 1, F.lit(-1)) if games else F.lit(-1)
    number = number.cast("bigint")
    rows = with_known_game(train.select(F.col("train_id").alias("id"), "channel", "game", "images"), channels, "label").select("id", "label", "images")
    names = recordings(own_frames(F.col("images"), shared_keys(shared_frames)))

    def rec(k: Column) -> Column:
        chunk, row = F.substring_index(k, "/", 1).try_cast("bigint"), F.substring_index(k, "/", -1).try_cast("bigint")
        return F.coalesce(
            F.when((chunk < 1 << 24) & (row < 1 << 25), F.shiftleft(number, 49) + F.shiftleft(chunk, 25) + row),
            F.xxhash64(number, k).bitwiseOR(F.lit(-(1 << 63))),
        )

    return rows.where("id IS NOT NULL").select("id", "label", F.when(F.col("label").isNotNull(), F.transform(names, rec)).otherwise(F.expr("CAST(array() AS ARRAY<BIGINT>)")).alias("recs"))


def tie_rows(rows: DataFrame) -> DataFrame:
    """(id, label, group_id, group_size): rows that share a recording, directly or through others, have the same group.

    rows: id, label, recs. A group is named by its smallest id; a row tied to none is a group of its own. The graph has
    recordings as nodes and, from each row, edges from its first recording to its others, so a recording of any number
    of rows is one node; rows are counted per recording by partial aggregates and get their group by `hot_join`.
    """
    rows = cut(rows.select("id", "label", F.array_sort("recs").alias("recs")))
    edges = rows.where(F.size("recs") > 1).select(F.col("recs")[0].alias("a"), F.explode(F.slice("recs", F.lit(2), F.size("recs"))).alias("b"))
    labels = connected_components(edges)
    tied = rows.where(F.size("recs") > 0).select("id", "label", F.col("recs")[0].alias("rec"))
    per_rec = tied.groupBy("rec").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    per_rec = cut(per_rec.join(labels.withColumnRenamed("node", "rec").withColumnRenamed("label", "root"), "rec", "left").withColumn("root", F.coalesce("root", "rec")))
    groups = per_rec.groupBy("root").agg(F.min("low").alias("group_id"), F.sum("n").alias("group_size"), F.count("*").alias("n"))
    of_rec = hot_join(per_rec.select("rec", "root", F.col("n").alias("rows")), groups, "root").select("rec", "group_id", "group_size", F.col("rows").alias("n"))
    found = hot_join(tied, cut(of_rec), "rec").select("id", "label", "group_id", "group_size")
    alone = rows.where(F.size("recs") == 0).select("id", "label", F.col("id").alias("group_id"), F.lit(1).cast("bigint").alias("group_size"))
    return found.union(alone)


def assign_splits(rows: DataFrame, targets: DataFrame, seed: int = 7, block_groups: int = 20_000, chains: int = 8, steps: int = 12_000) -> DataFrame:
    """Give each group of `rows` (id, label, group_id, group_size) one split of `targets` (split, share).

    Returns the rows with a column split. Sizes and, within each label, counts come near the shares: groups of more than
    BIG of all rows are placed first, largest first, where most is wanting, and what the others should make up for follows from `_rates`; the others start from a split by a hash of
    their name, lie in blocks of about `block_groups` by another hash, and in each block `chains` annealing searches move
    single groups or swap two, with the squared deviations of size and labels, each against what is wanted, as cost; the
    best state that any chain met is kept. Null labels are a label of their own. Shares are scaled to sum 1; without
    a positive share there is a ValueError. No rows give no rows. Only the counts by label and the at most 1 / BIG large
    groups reach the driver; labels have to be a small table.
    """
    shares = {r.split: float(r.share) for r in small_rows(targets.select("split", "share")) if r.split is not None and (r.share or 0) > 0}
    if not shares:
        raise ValueError("no split has a positive share")
    names, share = sorted(shares), np.array([shares[s] for s in sorted(shares)]) / sum(shares.values())
    rows = cut(rows.select("id", "label", "group_id", "group_size"))
    parts = rows.groupBy("group_id", F.coalesce("label", F.lit("")).alias("label")).agg(F.count("*").alias("k"))
    by_label = {r.label: r.k for r in small_rows(parts.groupBy("label").agg(F.sum("k").alias("k")))}
    labels, total = sorted(by_label), sum(by_label.values())
    if not total:
        return rows.withColumn("split", F.lit(names[0]))
    groups = cut(parts.groupBy("group_id").agg(F.sum("k").alias("n"), F.map_from_entries(F.collect_list(F.struct("label", "k"))).alias("counts")))
    want, most = np.outer(share, [by_label[x] for x in labels]), max(BIG * total, LEAST)
    big = sorted(((r.n, r.group_id, r.counts) for r in groups.where(F.col("n") > most).take(int(1 / BIG) + 1)), key=lambda r: (-r[0], r[1]))
    placed = []
    for _, group, counts in big:
        v = np.array([counts.get(x, 0) for x in labels])
        after = [(np.square(want - v * (np.arange(len(names)) == s)[:, None]) / (want.clip(0) + 1)).sum() + np.square((want.sum(1) - v.sum() * (np.arange(len(names)) == s)) / np.sqrt(share * total)).sum() for s in range(len(names))]
        s = int(np.argmin(after))
        want[s] -= v
        placed.append((group, names[s]))
    rate = _rates(want, share)
    small = groups.where(F.col("n") <= most)
    blocks = max(1, -(-small.count() // block_groups))
    index = {x: i for i, x in enumerate(labels)}

    def anneal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("group_id", kind="stable").reset_index(drop=True)
        n, width = len(pdf), len(labels)
        v = np.zeros((n, width))
        for i, counts in enumerate(pdf["counts"]):
            for k, x in counts.items() if isinstance(counts, dict) else counts:
                v[i, index[k]] = x
        best = _search(v, rate, pdf["u"].to_numpy(), chains, min(steps, 400 + 4 * n), seed)
        return pd.DataFrame({"group_id": pdf["group_id"], "split": [names[s] for s in best]})

    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "group_id"), 11) / F.lit(float(1 << 53))
    block = F.pmod(F.xxhash64(F.lit(seed + 1), "group_id"), F.lit(blocks)).alias("block")
    settled = small.select("group_id", "counts", u.alias("u"), block).groupBy("block").applyInPandas(anneal, "group_id bigint, split string")
    chosen = cut(settled)
    if placed:
        chosen = chosen.union(rows.sparkSession.createDataFrame(placed, "group_id bigint, split string").coalesce(1))
    sized = chosen.join(groups.select("group_id", "n"), "group_id")
    return hot_join(rows, cut(sized), "group_id").select("id", "label", "group_id", "group_size", "split")


def _rates(want: np.ndarray, share: np.ndarray, rounds: int = 100) -> np.ndarray:
    """The share of each label's remaining rows that each split should get, so that the splits' sizes come out where large groups have upset the labels.

    want: rows still wanted by split and label, below 0 where a large group was too much. Sizes come before labels: the
    table is scaled by turns to the splits' sizes and the labels' rows.
    """
    columns, rows = want.sum(0), want.sum(1).clip(0)
    table = want.clip(0) + 1e-6
    rows = rows * columns.sum() / max(rows.sum(), 1e-9)
    for _ in range(rounds):
        table *= (rows / table.sum(1).clip(1e-12))[:, None]
        table *= (columns / table.sum(0).clip(1e-12))[None]
    return np.where(columns > 0, table / table.sum(0).clip(1e-12), share[:, None])


def _search(v: np.ndarray, rate: np.ndarray, u: np.ndarray, chains: int, steps: int, seed: int) -> np.ndarray:
    """The best split of each group found by `chains` searches side by side. v: counts by group and label; rate: wanted share by split and label; u: the start."""
    splits, (n, _) = len(rate), v.shape
    rng = np.random.default_rng(seed)
    size = v.sum(1)
    start = np.minimum((u[:, None] >= np.cumsum(rate.mean(1))[None, :]).sum(1), splits - 1)
    state = np.repeat(start[None], chains, 0)
    wanted = rate * v.sum(0)
    scale, scale_all = 1 / (wanted + 1), 1 / (wanted.sum(1) + 1)
    dev = -np.repeat(wanted[None], chains, 0)
    for s in range(splits):
        dev[:, s] += v[start == s].sum(0)
    c = np.arange(chains)

    def cost(d: np.ndarray, s: np.ndarray) -> np.ndarray:
        return (np.square(d) * scale[s]).sum(1) + np.square(d.sum(1)) * scale_all[s]

    now = sum(cost(dev[:, s], np.full(chains, s)) for s in range(splits))
    if splits < 2 or n < 1:
        return start
    # The best state is found again from the moves up to the step at which it was met (-1: the start).
    best, best_at = now.copy(), np.full(chains, -1)
    moved = np.full((steps, 2, chains), -1)
    moved_to = np.zeros((steps, 2, chains), np.int64)
    heat = np.maximum(now / max(n, 1), 1e-6) * np.geomspace(0.3, 3, chains)
    one, two = rng.integers(n, size=(steps, chains)), rng.integers(n, size=(steps, chains))
    shift, swap = rng.integers(1, splits, size=(steps, chains)), rng.random((steps, chains)) < 0.5
    luck = np.log(rng.random((steps, chains)) + 1e-300)
    for t in range(steps):
        g, h = one[t], two[t]
        a = state[c, g]
        b = (a + shift[t]) % splits
        back = swap[t] & (state[c, h] == b)
        move = v[g] - v[h] * back[:, None]
        da, db = dev[c, a], dev[c, b]
        gain = cost(da - move, a) + cost(db + move, b) - cost(da, a) - cost(db, b)
        ok = luck[t] < -gain / (heat * (1 - t / steps) + 1e-12)
        if ok.any():
            k = np.flatnonzero(ok)
            dev[k, a[k]] -= move[k]
            dev[k, b[k]] += move[k]
            state[k, g[k]] = b[k]
            kb = k[back[k]]
            state[kb, h[kb]] = a[kb]
            moved[t, 0, k], moved_to[t, 0, k] = g[k], b[k]
            moved[t, 1, kb], moved_to[t, 1, kb] = h[kb], a[kb]
            now[k] += gain[k]
            better = k[now[k] < best[k] - 1e-9]
            best[better], best_at[better] = now[better], t
    i = int(np.argmin(best))
    out = start.copy()
    groups, to = (x[: best_at[i] + 1, :, i].ravel() for x in (moved, moved_to))
    out[groups[groups >= 0]] = to[groups >= 0]  # in order, so a group's last move counts
    return out


def split_train(train: DataFrame, channels: DataFrame, shared_frames: DataFrame, targets: DataFrame) -> DataFrame:
    """(train_id, label, group_id, group_size, split) of every row of train with an id; see `tie_rows` and `assign_splits`."""
    rows = tie_rows(recording_ids(train, channels, shared_frames))
    return assign_splits(rows, targets).withColumnRenamed("id", "train_id")


def split_report(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows and share of each split, in all (label null) and within each label ('' for none), beside the wanted share."""
    each = assigned.select("split", F.coalesce("label", F.lit("")).alias("label")).groupBy("split", "label").agg(F.count("*").alias("rows"))
    whole = each.groupBy("label").agg(F.sum("rows").alias("all")).union(each.agg(F.lit(None).cast("string"), F.sum("rows")))
    both = each.union(each.groupBy("split").agg(F.lit(None).cast("string").alias("label"), F.sum("rows").alias("rows")).select("split", "label", "rows"))
    return both.alias("b").join(whole.alias("w"), F.col("b.label").eqNullSafe(F.col("w.label"))).join(small_broadcast(targets.select("split", "share")), "split").select(
        "split", F.col("b.label").alias("label"), "rows", (F.col("rows") / F.col("all")).alias("reached"), "share"
    )
