import random

import pytest
from pyspark.sql import functions as F

from loomspark.operators import graph, hooks, packing, reports, resume, split
from loomspark.operators.intervals import locate
from loomspark.operators.graph import connected_components, hot_join, spread_join


def brute_components(edges):
    label = {}
    for a, b in edges:
        for x in (a, b):
            label.setdefault(x, x)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("kind", ["path", "star", "random", "empty", "dirty"])
def test_connected_components(spark, kind):
    rng = random.Random(3)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 200)], "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(110)], "empty": [], "dirty": [(5, 5), (3, 9), (9, 3), (3, 9), (-4, 9)]}[kind]
    df = spark.createDataFrame([*edges, *([(None, 1), (2, None)] if kind == "dirty" else [])], "a bigint, b bigint")
    got = {r.node: r.label for r in connected_components(df).collect()}
    assert got == brute_components(edges)


def test_hot_join_keeps_every_row(spark):
    rows = spark.createDataFrame([(i, 1 if i % 3 else i) for i in range(900)], "id int, k int")
    labels = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 10)
    out = hot_join(rows, labels, "k")
    assert {(r.id, r.v) for r in out.collect()} == {(i, 10 * (1 if i % 3 else i)) for i in range(900)} and out.count() == 900
    assert hot_join(rows.where("false"), labels.where("false"), "k").count() == 0


def test_locate(spark):
    intervals = spark.createDataFrame([("a", 0, 3), ("b", 3, 1), ("c", 4, 90), ("d", 94, 0), ("e", 100, 7)], "name string, start bigint, n bigint")
    points = spark.createDataFrame([(i,) for i in [-1, 0, 2, 3, 4, 93, 94, 99, 100, 106, 107, None]], "at bigint")
    got = {r.at: r.name for r in locate(points, "at", intervals, "start", "n").collect()}
    assert got == {0: "a", 2: "a", 3: "b", 4: "c", 93: "c", 100: "e", 106: "e"}
    assert locate(points, "at", intervals.where("false"), "start", "n").collect() == []


def test_next_fit_and_best_fit(spark):
    rows = spark.createDataFrame([("s", i, n) for i, n in enumerate([4, 5, 3, 8, 2, 6])] + [("t", 0, None), ("t", 1, 50)], "s string, i int, n int")
    got = packing.next_fit(rows, "s", "i", "n", 10)
    packs = {}
    for r in got.orderBy("s", "i").collect():
        packs.setdefault((r.s, r.pack), []).append(r.n)
    assert packs == {("s", 0): [4, 5], ("s", 1): [3], ("s", 2): [8, 2], ("s", 3): [6], ("t", 0): [0], ("t", 1): [50]}
    best = packing.best_fit_decreasing([4, 5, 3, 8, 2, 6], 10)
    assert len(best) == 3 and sorted(i for p in best for i in p) == list(range(6))
    assert packing.best_fit_decreasing([], 10) == []


def test_windowed_packs_hold_every_row_once(spark):
    rng = random.Random(1)
    data = [(s, i, rng.randrange(1, 60)) for s in "ab" for i in range(300)] + [("b", 300, 200)]
    df = spark.createDataFrame(data, "s string, i int, n bigint")
    for parts in (1, 5):
        out = packing.windowed_packs(df.repartition(parts), "s", "i", "n", 100, 16).collect()
        assert sorted((r.s, r.i) for r in out) == sorted((s, i) for s, i, n in data if n <= 100)
        fill = {}
        for r in out:
            fill[(r.s, r.pack)] = fill.get((r.s, r.pack), 0) + r.n
        assert max(fill.values()) <= 100 and sum(fill.values()) / (100 * len(fill)) > 0.85


def test_windowed_packs_keep_rows_of_null_length(spark):
    df = spark.createDataFrame([("a", i, None if i % 3 == 0 else 40) for i in range(30)], "s string, i int, n bigint")
    out = packing.windowed_packs(df, "s", "i", "n", 100, 8).collect()
    assert sorted((r.i, r.n) for r in out) == [(i, 0 if i % 3 == 0 else 40) for i in range(30)]


def test_lock_step_and_shapes(spark):
    df = spark.createDataFrame([(0, i) for i in range(5)] + [(1, i) for i in range(7)], "rank int, ordinal bigint")
    used = packing.lock_step(df, "rank", "ordinal", 2).groupBy("rank").agg(F.count("*").alias("n"), F.max("step").alias("s")).collect()
    assert {(r.rank, r.n, r.s) for r in used} == {(0, 4, 1), (1, 4, 1)}
    assert packing.batch_shape(128, 4, 1, 1, 256) == (32, 8)
    for bad in ((127, 4, 1, 1, 256), (128, 4, 1, 1, 250)):
        with pytest.raises(ValueError):
            packing.batch_shape(*bad)


def test_splits(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    for n, want in ((1000, 64), (500, 50), (9, 0)):
        assert split.head_split(df.where(F.col("k") < n), "k", 42, 64).where("split = 'val'").count() == want
    chunks = lambda n: spark.createDataFrame([(f"f{i:02d}",) for i in range(n)], "c string")
    for n, want in ((19, 2), (3, 1), (1, 1)):
        assert split.chunk_split(chunks(n), "c", 2).where("split = 'val'").count() == want
    assert split.chunk_split(chunks(5), "c", 0).where("split = 'val'").count() == 0
    one = [r.k for r in split.shuffled(df, "k", 1).orderBy("place").limit(20).collect()]
    assert one == [r.k for r in split.shuffled(df.repartition(13), "k", 1).orderBy("place").limit(20).collect()] != list(range(20))
    assert one == [r.k for r in split.sample(df, "k", 1, 20).collect()]


def test_reports_of_nothing(spark):
    empty = spark.createDataFrame([], "pred_mag int, gt_mag int")
    r = reports.action_summary(empty.agg(*reports.action_sums(empty)), live=True).first()
    assert (r.n, r.pred_mean, r.ratio) == (0, 0.0, 0.0)
    idle = reports.idle_profile(spark.createDataFrame([("no action",), (None,)], "content string")).first()
    assert idle.steps == 0 and idle.zero_pct is None


def test_resume(spark, tmp_path):
    ids = [resume.Identity("d", r, 2) for r in range(2)]
    resume.save_state(str(tmp_path), resume.State(ids[0], 64, 3))
    assert resume.load_states(str(tmp_path), ids) is None
    resume.save_state(str(tmp_path), resume.State(ids[1], 32))
    assert [s.next_pos for s in resume.load_states(str(tmp_path), ids)] == [64, 32]
    with pytest.raises(ValueError, match="world"):
        resume.load_states(str(tmp_path), [resume.Identity("d", 0, 4)])
    order = split.shuffled(spark.range(50).withColumnRenamed("id", "k"), "k", 3)
    whole = [r.k for r in order.orderBy("place").collect()]
    for k in (0, 1, 17, 50):
        assert [r.k for r in resume.remaining(order, "place", k).orderBy("place").collect()] == whole[k:]
    whole = resume.State(ids[0], 9, 2, {"a": {"occurrence": 3}}, [[0, "a", 2]], [[7, 120]])
    resume.save_state(str(tmp_path), whole)
    assert resume.load_states(str(tmp_path), ids)[0] == whole
    a = spark.createDataFrame([(1, 5), (2, 6)], "k int, n int")
    assert resume.check_lengths(a, a, ["k"], "n").count() == 0
    assert resume.check_lengths(a, a.where("k = 1").withColumn("n", F.lit(4)), ["k"], "n").count() == 2

    def valid(name):
        if "30" in name:
            raise ValueError("no weights")

    assert resume.latest_valid(["checkpoint-4", "checkpoint-30", "x/checkpoint-20", "other"], valid) == "x/checkpoint-20"
    with pytest.raises(ValueError, match="no weights"):
        resume.latest_valid(["checkpoint-30"], valid)


@pytest.mark.parametrize("most", [0, 1 << 18])
def test_spread_join_equals_join(spark, monkeypatch, most):
    """A key that half of both sides have, one that only one side has often, nulls, and two key columns."""
    monkeypatch.setattr(graph, "BROADCAST_ROWS", most)
    a = spark.range(4000).selectExpr("id AS x", "IF(id % 2 = 0, 0, IF(id % 5 = 0, NULL, id % 97)) AS k", "'p' AS j")
    b = spark.range(900).selectExpr("id AS y", "IF(id % 2 = 0, 0, IF(id % 3 = 0, 5, id)) AS k", "'p' AS j")
    for keys in (["k"], ["k", "j"]):
        left, right = (a, b) if len(keys) == 2 else (a.drop("j"), b.drop("j"))
        got, want = spread_join(left, right, keys), left.join(right, keys)
        assert sorted(got.columns) == sorted(want.columns)
        order = sorted(want.columns)
        assert sorted(map(tuple, got.select(order).collect())) == sorted(map(tuple, want.select(order).collect()))
    assert spread_join(a.where("false"), b, ["k", "j"]).count() == 0


def test_finite_rounds(spark):
    df = spark.createDataFrame([(0, 0, 8, 5), (0, 1, 8, 6), (0, 2, 3, 1), (1, 0, 2, 9)], "rank int, round bigint, rows bigint, weight bigint")
    got = sorted(map(tuple, packing.finite_rounds(df, "rank", "round", {"rows": 0, "weight": 0}).collect()))
    assert got == [(0, 0, 8, 5, False), (0, 1, 8, 6, False), (0, 2, 3, 1, False), (1, 0, 2, 9, False), (1, 1, 0, 0, True), (1, 2, 0, 0, True)]
    assert packing.finite_rounds(df.where("false"), "rank", "round", {"rows": 0, "weight": 0}).count() == 0


def test_latest_valid_of(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, "x"), ("a", 4, "y"), ("b", 1, "z"), ("b", 5, "q"), ("b", 2, "r"), ("b", 3, "s"), ("c", 1, None)], "run string, n bigint, wrong string")
    got = {r.run: (r.n, r.skipped, r.reasons) for r in resume.latest_valid_of(df, "run", "n", "wrong").collect()}
    assert got == {"a": (2, 2, "checkpoint-4: y; checkpoint-3: x"), "b": (None, 4, "checkpoint-5: q; checkpoint-3: s; checkpoint-2: r"), "c": (1, 0, None)}


def test_view(spark):
    df = spark.createDataFrame([([1], ["a"], "g", None), (None, ["a"], "g", "c"), ([1], None, None, None)], "messages array<int>, images array<string>, game string, channel string")
    assert [(r.game, r.channel) for r in split.view(df, "n").collect()] == [("n", "n")]
    with pytest.raises(Exception, match="lacks messages or images"):
        split.view(df, "n", strict=True).collect()


def test_components_with_a_hub_of_half_of_all_nodes(spark):
    """A star of many nodes, a long chain that ends in it, and pairs apart; the hub's edges come from every partition."""
    star = [(5000, i) for i in range(3000)]
    chain = [(10_000 + i, 10_001 + i) for i in range(60)] + [(10_060, 17)]
    pairs = [(20_000 + 2 * i, 20_001 + 2 * i) for i in range(500)]
    edges = star + chain + pairs
    random.Random(2).shuffle(edges)
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)).collect()}
    assert {n for n, x in got.items() if x == 0} == {*range(3000), 5000, *range(10_000, 10_061)}
    assert all(got[a] == got[b] == a for a, b in pairs) and len(got) == 3062 + 1000


def test_items_of_rows(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, 3), (2, 0), (3, None), (4, -1)], "id bigint, n int")

    def make(row):
        if (row["n"] or 0) < 0:
            raise ValueError("negative")
        return [{"x": i, "other": 1} for i in range(row["n"] or 0)]

    schema = T.StructType([T.StructField("x", T.LongType())])
    got = sorted((r.id, r.item, r.x, r.error) for r in hooks.expand(df, make, schema, ["id"], strict=False).collect() if r.error is None)
    assert got == [(1, 0, 0, None), (1, 1, 1, None), (1, 2, 2, None)]
    assert [(r.id, r.x, r.item) for r in hooks.expand(df, make, schema, ["id"], strict=False).where("error = 'negative'").collect()] == [(4, None, None)]
    with pytest.raises(Exception, match="negative"):
        hooks.expand(df, make, schema, ["id"]).collect()
    with pytest.raises(ValueError, match="isn't declared"):
        hooks.unified([("a", df, {"y": "id"})], schema)
