import random

import numpy as np
import pytest

from loomspark.llm import splits

CHANNELS = [("g1", ["one"]), ("g2", [])]


def frame(spark):
    """Rows of train with an extra column that clashes with names used inside."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        game = rng.choice(["g1", "G-1", "g2", None, "?"])
        images = [f"images/chunk_{rng.randrange(3):03d}/row_{rng.randrange(90):04d}/{k:02d}.jpg" for k in range(rng.randrange(3))]
        if rng.random() < 0.3:
            images += ["images/common/black.jpg", "images/chunk_000/row_0000/00.jpg", None, ""]
        rows.append((i, None if rng.random() < 0.1 else images, game, None if rng.random() < 0.5 else game, "x"))
    rows += [(1000 + i, [f"chunk_9/row_9/{i % 40}.jpg"], "g1", "g1", "x") for i in range(150)]  # one recording of a third of the rows
    rows += [(None, ["chunk_1/row_1/1.jpg"], "g1", "g1", "x")]
    return rows, spark.createDataFrame(rows, "train_id bigint, images array<string>, game string, channel string, label string")


def brute(rows):
    known = {"g1": "g1", "one": "g1", "g2": "g2"}
    name = lambda c, g: known.get((c or "").lower().replace("-", "")) or known.get((g or "").lower().replace("-", ""))
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for i, images, game, channel, _ in rows:
        if i is None:
            continue
        find(i)
        for p in images or []:
            parts = [int("".join(c for c in s if c.isdigit())) for s in (p or "").split("/")[-3:]] if p and "chunk" in p else None
            if parts and parts != [0, 0, 0] and name(channel, game):
                a, b = find(i), find((name(channel, game), *parts[:2]))
                parent[a] = b
    groups = {}
    for i, *_ in rows:
        if i is not None:
            groups.setdefault(find(i), []).append(i)
    return {i: min(g) for g in groups.values() for i in g}


def test_groups_and_splits(spark):
    rows, df = frame(spark)
    channels = spark.createDataFrame(CHANNELS, "channel string, aliases array<string>")
    shared = spark.createDataFrame([("images/common/black.jpg",), ("images/chunk_000/row_0000/00.jpg",)], "path string")
    targets = spark.createDataFrame([("train", 0.5), ("validation", 0.3), ("test", 0.2), (None, 1.0), ("none", 0.0)], "split string, share double")
    for parts in (1, 7):
        got = splits.split_train(df.repartition(parts), channels, shared, targets).collect()
        assert {r.train_id: r.group_id for r in got} == brute(rows) and len(got) == len(rows) - 1
        of_group = {}
        for r in got:
            of_group.setdefault(r.group_id, set()).add(r.split)
        assert all(len(s) == 1 for s in of_group.values())
        sizes = {s: sum(r.split == s for r in got) / len(got) for s in ("train", "validation", "test")}
        assert abs(sizes["train"] - 0.5) < 0.05 and abs(sizes["validation"] - 0.3) < 0.05, sizes
    empty = splits.split_train(df.where("false"), channels, shared, targets)
    assert empty.collect() == [] and "split" in empty.columns
    with pytest.raises(ValueError):
        splits.assign_splits(spark.createDataFrame([], "id bigint, label string, group_id bigint, group_size bigint"), targets.where("false"))


def test_numbers_too_large_for_a_packed_id(spark):
    df = spark.createDataFrame([(1, ["chunk_99999999999/row_7/1.jpg"], "g1", None), (2, ["chunk_99999999999/row_7/2.jpg"], None, "g1"), (3, ["chunk_99999999999/row_8/2.jpg"], None, "g1"), (4, ["chunk_123456789012345678901234/row_8/2.jpg"], None, "g1")], "train_id bigint, images array<string>, game string, channel string")
    channels = spark.createDataFrame(CHANNELS, "channel string, aliases array<string>")
    got = splits.tie_rows(splits.recording_ids(df, channels, spark.createDataFrame([], "path string"))).collect()
    assert {r.id: r.group_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_search_comes_near_the_shares_and_beats_its_start():
    rng = np.random.default_rng(0)
    v = np.zeros((500, 4))
    v[np.arange(500), rng.integers(4, size=500)] = rng.integers(1, 9, size=500)
    rate = np.repeat(np.array([[0.9], [0.06], [0.04]]), 4, 1)
    u = rng.random(500)
    best = splits._search(v, rate, u, 8, 4000, 1)
    want = rate * v.sum(0)
    off = lambda state: sum(np.abs(v[state == s].sum(0) - want[s]).sum() for s in range(3))
    start = np.minimum((u[:, None] >= np.cumsum(rate.mean(1))[None]).sum(1), 2)
    assert off(best) < 0.25 * off(start) and off(best) < 20
    assert (splits._search(v, rate[:1] / rate[:1], u, 2, 50, 1) == 0).all()


def test_search_keeps_the_best_state_it_met():
    """Whatever the heat, the result is never worse than the start, and with a longer search no worse than with a shorter one of the same moves."""
    for seed in range(30):
        rng = np.random.default_rng(seed)
        v = np.zeros((12, 3))
        v[np.arange(12), rng.integers(3, size=12)] = rng.integers(1, 30, size=12)
        rate, u = np.repeat(np.array([[0.7], [0.2], [0.1]]), 3, 1), rng.random(12)
        want = rate * v.sum(0)

        def cost(state, v=v, want=want):
            d = np.stack([v[state == s].sum(0) for s in range(3)]) - want
            return (np.square(d) / (want + 1)).sum() + (np.square(d.sum(1)) / (want.sum(1) + 1)).sum()

        start = np.minimum((u[:, None] >= np.cumsum(rate.mean(1))[None]).sum(1), 2)
        for steps in (1, 5, 60, 600):
            assert cost(splits._search(v, rate, u, 8, steps, seed)) <= cost(start) + 1e-9


def test_one_component_of_half_of_all_rows(spark):
    rows = [(i, [f"chunk_1/row_{i % 50}/1.jpg", f"chunk_1/row_{(i + 1) % 50}/1.jpg"], "g1", None) for i in range(300)]
    rows += [(1000 + i, [f"chunk_2/row_{i}/1.jpg"], "g2", None) for i in range(300)]
    df = spark.createDataFrame(rows, "train_id bigint, images array<string>, game string, channel string")
    targets = spark.createDataFrame([("train", 0.6), ("test", 0.4)], "split string, share double")
    got = splits.split_train(df, spark.createDataFrame(CHANNELS, "channel string, aliases array<string>"), spark.createDataFrame([], "path string"), targets).collect()
    assert {r.split for r in got if r.train_id < 1000} == {"train"} and {r.group_size for r in got if r.train_id < 1000} == {300}
    assert abs(sum(r.split == "train" for r in got) / 600 - 0.6) < 0.02
