import random

import numpy as np
import pyarrow as pa
import pytest

from loomspark.llm import overlap
from loomspark.llm.words import word_hashes

WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te", "no", "sha", "pe") for b in ("ba", "do", "fin", "gel", "ham", "jor", "ku", "lim", "nox", "per", "qua", "rit", "sel", "tam", "vor", "wex")]
COMMON = ["the", "of", "and", "to", "in", "a", "is"]


def plain_edits(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def text(rng, n):
    return [rng.choice(COMMON) if rng.random() < 0.45 else rng.choice(WORDS) + (str(rng.randrange(10)) if rng.random() < 0.2 else "") for _ in range(n)]


def change(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(3)
        i = rng.randrange(len(out)) if out else 0
        if k == 0 and out:
            out[i] = "x" + str(rng.randrange(10**6))
        elif k == 1 or not out:
            out.insert(i, rng.choice(WORDS))
        else:
            del out[i]
    return out


def test_alignment_equals_the_plain_distance():
    rng = random.Random(1)
    for _ in range(300):
        x = [rng.randrange(9) for _ in range(rng.randrange(60))]
        y = change(rng, x, rng.randrange(8)) if x and rng.random() < 0.7 else [rng.randrange(9) for _ in range(rng.randrange(60))]
        x, y = [hash(str(w)) for w in x], [hash(str(w)) for w in y]
        d = plain_edits(x, y)
        assert overlap.edits(x, y) == d
        found = overlap.align(x, y)
        assert (found is not None) == (d * 10 <= max(len(x), len(y)))
        if found:
            assert d <= found[0] <= max(len(x), len(y)) // 10 and 0 <= found[1] <= len(y)


def test_words():
    same = ["Hello, WORLD! 你好 ｆｕｌｌ", "hello world 你 好 full", "  hel​lo ­world。你、好\nfull﻿"]
    h, off = word_hashes([*same, "", "...", "hello world 你 好 fuller"])
    parts = [h[a:b].tolist() for a, b in zip(off, off[1:])]
    assert parts[0] == parts[1] == parts[2] and len(parts[0]) == 5 and parts[3] == parts[4] == [] and parts[5] != parts[0]


def random_texts(rng, sizes, variety):
    return [[rng.randrange(variety) for _ in range(n)] for n in sizes]


def flat(docs):
    h = np.array([hash(("w", w)) % 2**63 for d in docs for w in d], np.uint64)
    return h, np.concatenate([[0], np.cumsum([len(d) for d in docs])])


def test_every_text_has_the_blocks_wanted():
    n = np.arange(0, 3000)
    block = np.where(n < overlap.SHORT, overlap.SHORT_BLOCK, overlap.BLOCK)
    assert (overlap.blocks_of(n)[9:] <= (n // block)[9:]).all() and (overlap.blocks_of(n)[:9] == 0).all()
    m = n[:, None] + np.arange(400)[None]
    allowed = m // 10 >= m - n[:, None]
    assert ((m // 10 * allowed).max(1) == overlap.most_edits(n)).all()


def test_every_stretch_has_its_least_run():
    rng = random.Random(6)
    for w in (1, 2, 3, 5):
        docs = [[rng.randrange(6) for _ in range(rng.randrange(12))] for _ in range(30)]
        doc = np.repeat(np.arange(30), [len(d) for d in docs])
        flat_ = np.array([x for d in docs for x in d], np.uint64)
        want, at = set(), 0
        for d in docs:
            want |= {at + i + min(range(w), key=lambda j: (d[i + j], j)) for i in range(len(d) - w + 1)}
            at += len(d)
        assert overlap.winnow(doc, flat_, w).tolist() == sorted(want)


@pytest.mark.parametrize("hot", [overlap.HOT, 0])
def test_some_block_meets_whatever_the_edits(hot, monkeypatch):
    """Rows of both sides through `hits_of`: any text within the definition shares the blocks wanted, for random and for evenly spread edits, with and without classes of places."""
    monkeypatch.setattr(overlap, "HOT", hot)
    rng = random.Random(4)
    train = random_texts(rng, [rng.choice([9, 10, 12, 17, 18, 27, 39, 40, 41, 45, 60, 100, 150, 279, 400, 900]) for _ in range(400)], 60)
    val = []
    for i, x in enumerate(train):
        y, d = list(x), len(x) // 9
        if i % 4 == 0:
            y = [10**6 + j if j % 10 == 9 else w for j, w in enumerate(x)]
        elif i % 4 == 1:
            for j in range(d, 0, -1):
                y.insert(j * len(x) // (d + 1), 10**6 + j)
        elif i % 4 == 2:
            y = [w for j, w in enumerate(x) if j % 10 != 9]
        else:
            y = change(rng, x, len(x) // 10)
        assert plain_or_equal(x, y)
        val.append(y)
    (ht, ot), (hv, ov) = flat(train), flat(val)
    every = np.arange(400)
    table = np.zeros(1 << 12, np.uint16)
    np.add.at(table, overlap.cell(overlap.all_runs(hv, ov, every[np.diff(ov) >= 9]), 12), 1)
    t, v = overlap.chosen_rows(ht, ot, every, table), overlap.asked_rows(hv, ov, every[np.diff(ov) >= 9], table)
    rows = np.concatenate([np.stack([t[1], t[2], t[0]]), np.stack([v[1], v[2], v[0]])], axis=1)
    rows = rows[:, np.lexsort((rows[1], rows[0]))]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[k, a : a + 997]) for k in range(3)], names=["key", "meta", "id"]) for a in range(0, rows.shape[1], 997)]
    count, need = {}, {}
    for hits in overlap.hits_of(iter(batches)):
        assert (overlap._unpacked(overlap._packed(hits), hits.shape[1]) == hits[:, np.lexsort((hits[1], hits[0]))]).all()
        for x, y, least in hits.T.tolist():
            count[x, y], need[x, y] = count.get((x, y), 0) + 1, least
    lost = [i for i in range(400) if len(train[i]) >= 9 and train[i] != val[i] and count.get((i, i), 0) < need.get((i, i), 1)]
    assert lost == [] and sum(train[i] != val[i] for i in range(400)) > 300


def rows(rng, n_val, n_train):
    """(train, val) with copies, near copies up to the bound, near misses, short texts and unrelated ones."""
    train, val = [], []
    for v in range(n_val):
        words = text(rng, rng.choice([3, 9, 12, 30, 60, 120, 300]))
        val.append((10**6 + v, words))
        kind = v % 4
        if kind == 0:
            train.append((v, [w.upper() + "!" for w in words]))
        elif kind == 1:
            train.append((v, change(rng, words, rng.randrange(0, len(words) // 12 + 1))))
        elif kind == 2:
            train.append((v, change(rng, words, len(words) // 5 + 1)))
    train += [(5000 + i, text(rng, rng.choice([9, 30, 120]))) for i in range(n_train)]
    train += [(9000 + i, val[0][1]) for i in range(100)]  # one text of a large part of the rows
    return train, val


def test_pairs_equal_brute_force(spark):
    rng = random.Random(8)
    train, val = rows(rng, 160, 80)
    msgs = lambda w: [("System", "be " + str(rng.random())), ("user", " ".join(w[: len(w) // 2])), (None, " ".join(w[len(w) // 2 :])), None]
    schema = "{} bigint, messages array<struct<role string, content string>>, images array<string>, game string, channel string, {} string"
    t = spark.createDataFrame([(i, msgs(w), None, None, None, "p") for i, w in train] + [(None, msgs(["a"]), [], "", "", "p"), (8000, None, None, None, None, "p"), (8001, [("system", "x")], None, None, None, "p")], schema.format("train_id", "h"))
    v = spark.createDataFrame([(i, msgs(w), None, None, None, "p") for i, w in val] + [(8002 + 10**6, [("user", None)], None, None, None, "p")], schema.format("val_id", "package"))
    channels, shared = spark.createDataFrame([("g", [])], "channel string, aliases array<string>"), spark.createDataFrame([], "path string")
    lists = lambda part: {i: h.tolist() for i, h in ((i, word_hashes([" ".join(w)])[0]) for i, w in part)}
    lt, lv = lists(train), lists(val)
    want = {(a, b) for a, x in lt.items() for b, y in lv.items() if abs(len(x) - len(y)) * 10 <= max(len(x), len(y)) and plain_or_equal(x, y)}
    found = overlap.overlaps(t, v, channels, shared)
    got = {(r.train_id, r.val_id) for r in found.collect()}
    assert got == want and len(want) > 100
    assert overlap.overlap_report(found, v, channels).agg({"found": "sum"}).first()[0] == len({b for _, b in want})
    assert overlap.overlaps(t.where("false"), v, channels, shared).collect() == []
    assert overlap.overlaps(t, v.where("false"), channels, shared).collect() == []


def test_families_of_near_copies_and_shared_passages(spark):
    """One text of which a third of the rows are near copies, and one passage that another third shares."""
    rng = random.Random(5)
    rich = lambda n: [w if w in COMMON else w + str(rng.randrange(90)) for w in text(rng, n)]
    base, passage = rich(260), rich(40)
    make = lambda k: change(rng, base, rng.randrange(2, 14)) if k == 0 else (rich(120) + passage + rich(120)) if k == 1 else rich(150)
    val = [(10**6 + i, " ".join(make(min(2, i % 9)))) for i in range(1080)]
    train = [(i, " ".join(make(i % 3))) for i in range(60)]
    df = lambda part: spark.createDataFrame(part, "id bigint, text string")
    got = text_pairs(df(train), df(val))
    words = {i: word_hashes([w])[0].tolist() for i, w in train + val}
    want = {(a, b) for a, _ in train for b, _ in val if words[a] != words[b] and abs(len(words[a]) - len(words[b])) * 10 <= 300 and plain_or_equal(words[a], words[b])}
    assert len(want) > 500 and got == want, (len(got), len(want))


def plain_or_equal(x, y):
    return overlap.edits(x, y) * 10 <= max(len(x), len(y))


def text_pairs(train, val, **how):
    links, t, v = overlap.same_text(train, val, **how)
    ht, hv = {}, {}
    for side, ids in ((t, ht), (v, hv)):
        for r in side.collect():
            ids.setdefault((r.h, r.g), set()).add(r.id)
    return {(a, b) for r in links.collect() for a in ht[r.ht, r.gt] for b in hv[r.hv, r.gv]}


def test_results_dont_depend_on_partitions_or_the_table(spark):
    """Near copies of texts that each lie in the training table four times; one name exchanged throughout; random edits up to the bound."""
    rng = random.Random(13)
    train, val = [], []
    for i in range(60):
        words = [w if w in COMMON else w + str(rng.randrange(90)) for w in text(rng, rng.choice([60, 120, 400]))]
        if i % 2:
            words = ["Mirabel" if j % 10 == 3 else w for j, w in enumerate(words)]
            other = ["Tobias" if w == "Mirabel" else w for w in words]
        else:
            other = change(rng, words, len(words) // 10)
        train += [(4 * i + c, " ".join(words)) for c in range(4)]
        val += [(10**6 + i, " ".join(other))]
    df = lambda part, n: spark.createDataFrame(part, "id bigint, text string").repartition(n)
    words = {i: word_hashes([w])[0].tolist() for i, w in train + val}
    want = {(4 * i + c, 10**6 + i) for i in range(60) for c in range(4) if words[4 * i] != words[10**6 + i] and plain_or_equal(words[4 * i], words[10**6 + i])}
    assert len(want) > 200
    for n, bits in ((1, overlap.TABLE_BITS), (4, 10), (17, overlap.TABLE_BITS)):
        assert text_pairs(df(train, n), df(val, n), table_bits=bits) == want, n


def spaced(words, step):
    return [f"new{i}" if i % step == step - 1 else w for i, w in enumerate(words)]


def test_evenly_spaced_edits_are_all_found(spark):
    """Every tenth to sixteenth word replaced, every tenth left out, or words put in: no pair is lost."""
    rng = random.Random(11)
    rich = lambda n: [w if w in COMMON else w + str(rng.randrange(90)) for w in text(rng, n)]
    train, val = [], []
    for i in range(240):
        words = rich(rng.choice([9, 10, 19, 29, 39, 40, 41, 49, 60, 100, 149, 166, 200, 399, 444, 600]))
        kind, d = i % 3, len(words) // 10
        other = spaced(words, rng.choice([10, 12, 14, 16])) if kind == 0 else [w for j, w in enumerate(words) if j % 10 != 9] if kind == 1 else list(words)
        if kind == 2:  # words put in, evenly spaced, so many that they are a tenth of the longer text
            d = len(words) // 9
            for j in range(d, 0, -1):
                other.insert(j * len(words) // (d + 1), f"put{j}")
        train.append((i, " ".join(words)))
        val.append((10**6 + i, " ".join(other)))
    df = lambda part: spark.createDataFrame(part, "id bigint, text string")
    got = text_pairs(df(train), df(val))
    words = {i: word_hashes([w])[0].tolist() for i, w in train + val}
    want = {(i, 10**6 + i) for i, _ in train if words[i] != words[10**6 + i] and plain_or_equal(words[i], words[10**6 + i])}
    assert len(want) > 210 and want <= got, (len(want), sorted(want - got))


def test_passages_repeated_many_times_share_the_seeds_wanted(spark):
    """Texts that say one passage of rare words 40 times and differ in a word: few different runs, but no pair is lost."""
    rng = random.Random(12)
    train, val = [], []
    for i in range(12):
        passage = [rng.choice(WORDS) + str(rng.randrange(90)) for _ in range(120 if i % 2 else 60)]
        other = passage * 40
        other[rng.randrange(len(other))] = "changed"
        train.append((i, " ".join(passage * 40)))
        val.append((10**6 + i, " ".join(other)))
    val.append((10**7, " ".join(rng.choice(WORDS) + str(rng.randrange(90)) for _ in range(60_000))))  # so that no word is frequent
    df = lambda part: spark.createDataFrame(part, "id bigint, text string")
    assert text_pairs(df(train), df(val)) == {(i, 10**6 + i) for i in range(12)}


def test_frames(spark):
    rng = random.Random(3)
    train = [(i, rng.choice(["a", "b", None]), sorted({f"0/{rng.randrange(4)}/{rng.randrange(5)}" for _ in range(rng.randrange(6))})) for i in range(200)]
    train += [(1000 + i, "a", ["hot"]) for i in range(120)]
    val = [(10**6 + i, rng.choice(["a", "b", None]), sorted({f"0/{rng.randrange(4)}/{rng.randrange(5)}" for _ in range(rng.randrange(6))} | ({"hot"} if i % 5 == 0 else set()) | ({"sample"} if i % 7 == 0 else set()))) for i in range(80)]
    df = lambda part: spark.createDataFrame(part, "id bigint, game string, frames array<string>")
    want = {(a, b): len(set(x) & set(y)) for a, g, x in train for b, h, y in val if g and g == h and y and 2 * len(set(x) & set(y)) >= len(y)}
    got = {(r.train_id, r.val_id): r.frames for r in overlap.same_frames(df(train), df(val)).collect()}
    assert got == want and any(f == 1 for f in want.values())


def hits_by_pair(train, val, contexts=True, copies=1):
    """((it, iv) -> (hits, need), hits in all) of seeds in packets, each side sent `copies` times."""
    (ht, ot), (hv, ov) = flat(train), flat(val)
    table = np.zeros(1 << 12, np.uint16)
    np.add.at(table, overlap.cell(overlap.all_runs(hv, ov, np.flatnonzero(np.diff(ov) >= 9)), 12), 1)
    packets = []
    for side, (doc, key, meta, context) in enumerate((overlap.asked_rows(hv, ov, np.flatnonzero(np.diff(ov) >= 9), table), overlap.chosen_rows(ht, ot, np.arange(len(train)), table))):
        if not contexts:
            context = np.full(len(doc), -1)  # any number of edits
        rows = np.stack([key, meta, doc, context])
        packets += [overlap._packets(rows, (rows[0] >> 1) % 5, 5, side)] * copies
    packets = pa.Table.from_batches(packets).sort_by([("part", "ascending"), ("side", "ascending")])
    pairs = {}
    for x, y, need in (hits := np.concatenate(list(overlap.met(packets.to_batches(max_chunksize=7))), axis=1)).T.tolist():
        pairs[x, y] = pairs.get((x, y), (0, need))[0] + 1, need
    return pairs, hits.shape[1]


@pytest.mark.parametrize("hot", [overlap.HOT, 0])
def test_contexts_lose_no_match(hot, monkeypatch):
    """Edits evenly spread, at random, in one place and at both ends: the hits wanted are left, once each, though all seeds come three times."""
    monkeypatch.setattr(overlap, "HOT", hot)
    rng = random.Random(21)
    train = random_texts(rng, [rng.choice([9, 17, 35, 36, 40, 41, 54, 60, 100, 150, 279, 400, 900]) for _ in range(500)], 60)
    val = []
    for i, x in enumerate(train):
        d, new = len(x) // 10, [10**6 + j for j in range(len(x) // 9)]
        at = rng.randrange(len(x))
        kinds = [
            [10**6 + j if j % 10 == 9 else w for j, w in enumerate(x)],
            [w for j, w in enumerate(x) if j % 10 != 9],
            change(rng, x, d),
            x[:at] + new + x[at:],  # a passage put in
            x[d:] if i % 2 else x[: len(x) - d],
            new[: d // 2] + x[: len(x) - (d - d // 2)],
        ]
        val.append(kinds[i % len(kinds)])
        assert plain_or_equal(x, val[-1])
    once, _ = hits_by_pair(train, val)
    assert [i for i in range(500) if train[i] != val[i] and once.get((i, i), (0, 1))[0] < once.get((i, i), (0, 1))[1]] == []
    assert hits_by_pair(train, val, copies=3)[0] == once


def test_contexts_leave_few_chance_hits():
    """Texts of the same sentences in other orders share many runs, but few of them with what follows."""
    rng = random.Random(22)
    sentences = [[rng.randrange(200) for _ in range(rng.randrange(8, 16))] for _ in range(60)]
    make = lambda: [w if rng.random() < 0.85 else rng.randrange(10**6) for _ in range(22) for w in rng.choice(sentences)]
    train, val = [make() for _ in range(150)], [make() for _ in range(150)]
    assert hits_by_pair(train, val)[1] * 4 < hits_by_pair(train, val, contexts=False)[1]


def test_copies_in_other_tasks_make_no_more_hits(spark):
    """A text of each side in eight partitions is a candidate once."""
    rng = random.Random(23)
    words = [w + str(rng.randrange(90)) for w in text(rng, 200)]
    df = lambda w: spark.createDataFrame([(i, " ".join(w)) for i in range(8)], "id bigint, text string").repartition(8)
    train, val = df(words), df(spaced(words, 20))
    table = spark.sparkContext.broadcast(overlap.run_counts(val, 12))
    assert overlap.candidates(overlap.seeds(train, table, 3, 1), overlap.seeds(val, table, 3, 0), 2).count() == 1
    links, _, _ = overlap.same_text(train, val)
    assert links.count() == 1


def test_rounds_change_nothing(spark):
    """Training texts that take turns in three rounds give the pairs of one."""
    rng = random.Random(24)
    train, val = [], []
    for i in range(60):
        words = [w if w in COMMON else w + str(rng.randrange(90)) for w in text(rng, 100)]
        train.append((i, " ".join(words)))
        val.append((10**6 + i, " ".join(change(rng, words, 1 + i % 9))))
    df = lambda part: spark.createDataFrame(part, "id bigint, text string")
    found = text_pairs(df(train), df(val), in_round=25)
    assert found == text_pairs(df(train), df(val)) and len(found) > 50
