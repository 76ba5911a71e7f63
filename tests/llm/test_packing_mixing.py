import random

import pytest
from pyspark.sql import functions as F

from loomspark.llm import mixing, packing


def check(out, data, caps):
    per = {}
    for r in out:
        per.setdefault((r.pack_name, r.pack_id), 0)
        per[(r.pack_name, r.pack_id)] += r.length
    for name, cap in caps.items():
        mine = [r for r in out if r.pack_name == name]
        pieces = {}
        for r in mine:
            pieces.setdefault(r.id, []).append((r.piece, r.start, r.length))
        assert set(pieces) == {i for i, _ in data}
        for i, n in data:
            p = sorted(pieces[i])
            n = max(n or 0, 0)
            assert [k for k, _, _ in p] == list(range(len(p))) and sum(x for _, _, x in p) == n
            assert len(p) == 1 if n <= cap else len(p) == -(-n // cap)
            at = 0
            for _, start, length in p:
                assert start == at and length <= cap
                at += length
        fills = [v for (n, _), v in per.items() if n == name]
        assert max(fills) <= cap
    return per


def test_packs(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([None, 0, 5, 90, 300, 5000])) for i in range(200)] + [(1000 + i, int(rng.paretovariate(1.1) * 40)) for i in range(3000)] + [(-1, -7)]
    df = spark.createDataFrame(data, "id bigint, tokens bigint")
    caps = {"s": 400, "l": 4000}
    limits = spark.createDataFrame([*caps.items(), ("none", None), ("zero", 0), (None, 5)], "pack_name string, max_tokens bigint")
    runs = []
    for parts in (1, 9):
        out = packing.pack_items(df.repartition(parts), limits, windows=16, shard_rows=300, fan_in=4).collect()
        runs.append(sorted((r.pack_name, r.pack_id, r.id, r.piece) for r in out))
        per = check(out, data, caps)
        for name, cap in caps.items():
            fills = [v for (n, _), v in per.items() if n == name]
            assert len(fills) <= 1.02 * packing.lower_bound([max(n or 0, 0) for _, n in data], cap) + 2
    assert runs[0] == runs[1]
    assert packing.pack_items(df.where("false"), limits).collect() == []
    assert packing.pack_items(df, limits.where("false")).collect() == []


def test_full_and_equal_items(spark):
    data = [(i, 10) for i in range(40)] + [(100 + i, 5) for i in range(7)] + [(200 + i, 25) for i in range(4)]
    out = packing.pack_items(spark.createDataFrame(data, "id bigint, tokens int"), spark.createDataFrame([("x", 10)], "pack_name string, max_tokens int"), windows=2).collect()
    per = check(out, data, {"x": 10})
    assert len(per) == 40 + 4 + 4 * 2 + 2


def test_report_and_row_lengths(spark):
    channels = spark.createDataFrame([("g", [], 960, 544), ("h", None, None, None)], "channel string, aliases array<string>, frame_width int, frame_height int")
    train = spark.createDataFrame(
        [(1, [("user", "the tokens"), None, (None, None)], ["a.jpg", None, " "], "G", None, 3), (2, None, None, None, None, 3), (3, [], ["x"], None, "h", 3)],
        "train_id bigint, messages array<struct<role string, content string>>, images array<string>, game string, channel string, tokens int",
    )
    got = {r.train_id: r.tokens for r in packing.row_lengths(train, channels).collect()}
    assert got == {1: 2 + 510, 2: 0, 3: 880}
    limits = spark.createDataFrame([("x", 1000)], "pack_name string, max_tokens bigint")
    twice = limits.union(spark.createDataFrame([("x", 900), ("x", None)], limits.schema))
    assert packing.pack_report(packing.pack_train(train, channels, twice), twice).first().max_tokens == 900
    r = packing.pack_report(packing.pack_train(train, channels, limits), limits).first()
    assert (r.packs, r.tokens, r.fullest, r.cuts) == (2, 1392, 880, 0)


def test_rates():
    s = {"a": (0.5, 1.0, 100), "b": (0.3, 9.0, 100), "c": (0.2, 2.0, 0), "d": (0.0, 5.0, 50)}
    assert mixing.draw_rates(s, 1000, fill=False) == {"a": 1.0, "b": 3.0, "c": 0.0, "d": 0.0}
    filled = mixing.draw_rates(s, 900, fill=True)
    assert filled["a"] == 1.0 and filled["b"] == pytest.approx(8.0) and filled["d"] == 0.0
    assert mixing.draw_rates(s, 0) == {"a": 0.0, "b": 0.0, "c": 0.0, "d": 0.0}


def test_mixture(spark):
    rng = random.Random(2)
    word = "the tokens of a text "
    docs = [(i, word * rng.randrange(1, 30), rng.choice(["a", "A ", "b", "c", None, "other"])) for i in range(3000)] + [(5000, None, "a"), (5001, "", "a")]
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s in docs], "doc_id bigint, text string, source string, tokens int")
    targets = spark.createDataFrame([("a", 0.5, 9.0), ("b", 0.3, 1.0), (" C", 0.1, 0.25), ("gone", 0.1, 3.0), (None, 0.5, 1.0), ("d", None, None)], "source string, weight double, max_passes double")
    m = mixing.mix_sources(df, targets, seed=3, fill=False)
    rows = m.rows.collect()
    again = mixing.mix_sources(df.repartition(7), targets, seed=3, fill=False).rows.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and len({(r.doc_id, r["pass"]) for r in rows}) == len(rows)
    shares = {r.source: r for r in m.shares.collect()}
    assert set(shares) == {"a", "b", "c", "gone", "d"} and shares["gone"].drawn_tokens == 0
    assert abs(shares["a"].share_of_wanted - 0.5) < 0.02 and shares["b"].rate == 1.0 and shares["b"].capped and shares["b"].drawn_documents == sum(s == "b" for _, _, s in docs)
    assert abs(shares["c"].drawn_documents / sum(s == "c" for _, _, s in docs) - 0.25) < 0.07
    copies = {}
    for r in rows:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    rate = shares["a"].rate
    assert all(copies.get(i, 0) in (int(rate), int(rate) + 1) for i, _, s in docs if s in ("a", "A "))
    assert sum(r.drawn_tokens for r in shares.values()) == sum(r.tokens for r in rows)
    assert abs(sum(r.share_of_drawn for r in shares.values()) - 1) < 1e-9
    full = {r.source: r for r in mixing.mix_sources(df, targets, seed=3).shares.collect()}
    assert abs(sum(r.drawn_tokens for r in full.values()) / full["a"].wanted_size - 1) < 0.01 and full["b"].rate == 1.0
    empty = mixing.mix_sources(df.where("false"), targets)
    assert empty.rows.collect() == [] and empty.shares.count() == 5
    assert mixing.mix_sources(df, targets.where("false")).rows.collect() == []
    assert df.agg(F.count("*")).first()[0] == len(docs)
