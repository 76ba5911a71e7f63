"""Byte-level BPE, longest match and counts against plain versions and the public library."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.functions.images import image_tokens, image_tokens_np
from loomspark.llm import textvec as tv
from loomspark.llm.bpe import DEFAULT_TOKENIZER, byte_chars, tokenizer
from loomspark.llm.encode import encode_texts
from loomspark.llm.maxmatch import MaxMatch, matcher
from loomspark.llm.tokens import bpe_counter, with_tokens

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_TOKENIZER), reason="no tokenizer files here")

PARTS = ["'", "'s", "'ll", "t", "re", " ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "中文", "1", "²", "!", "...", "\xa0", "　", "😀", "​", "\x1c", "\x85", "\x00", "́", "Ⅷ", "<|endoftext|>", "aaaa", "the", " tokens"]


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(DEFAULT_TOKENIZER)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def texts():
    rng = random.Random(5)
    out = ["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(3000)]
    return [*out, "", "a" * 3000, "中文" * 1500, "".join(rng.choices("abcdef", k=4000)), "x" * 1025 + " y", "<|endoftext|>", " ", "\n\n"]


def test_ids_equal_the_library(reference):
    tt = texts()
    ids, off = tokenizer().encode(tt)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == reference(tt)
    assert tokenizer().count(tt).tolist() == np.diff(off).tolist()


def test_round_trip():
    vocab = json.load(open(DEFAULT_TOKENIZER, encoding="utf-8"))["model"]["vocab"]
    of = {c: b for b, c in enumerate(byte_chars())}
    raw = {i: bytes(of[c] for c in t) for t, i in vocab.items() if all(c in of for c in t)}
    tt = texts()
    ids, off = tokenizer().encode(tt)
    assert [b"".join(raw[i] for i in ids[a:b].tolist()).decode() for a, b in zip(off, off[1:])] == tt


def test_long_texts_are_cut_safely(reference, monkeypatch):
    rng = random.Random(6)
    tt = ["".join(rng.choices(PARTS, k=400)) for _ in range(20)]
    assert all("".join(tv.safe_pieces(t, 37)) == t for t in tt)
    monkeypatch.setattr(tv, "safe_pieces", lambda t, size=37, f=tv.safe_pieces: f(t, size))
    ids, off = tokenizer().encode(tt)
    assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == reference(tt)


def test_longest_match_equals_the_greedy_search():
    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"abcd", b"bc", b"cde", b"abcdefgh", b"hab"]
    m, rng = MaxMatch(tokens), random.Random(2)
    known = set(tokens)

    def plain(w):
        n = 0
        while w:
            k = max(k for k in range(1, 9) if w[:k] in known)
            w, n = w[k:], n + 1
        return n

    for _ in range(3000):
        w = bytes(rng.choices(b"abcdefgh", k=rng.randrange(1, 25)))
        assert m.count_word(w) == plain(w)
    with pytest.raises(ValueError):
        MaxMatch([b"a"])


def test_longest_match_is_near_the_merges():
    tt = [t for t in texts() if t]
    a, b = matcher().count(tt).sum(), tokenizer().count(tt).sum()
    assert abs(a / b - 1) < 0.05


def test_encode_query(spark, reference):
    rows = [(1, "the tokens", 9), (2, None, 9), (3, "", 9), (1, "the tokens", 8), (4, "x" * 5000, 7), (None, "中", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    for parts in (1, 4):
        got = encode_texts(df.repartition(parts)).collect()
        assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), reference([t or ""])[0]) for i, t, _ in rows)
    assert encode_texts(df.where("false")).collect() == []
    assert encode_texts(df).schema["ids"].dataType.simpleString() == "array<int>"


def test_counts_of_lists(spark, reference):
    df = spark.createDataFrame([(1, ["a b", None, ""]), (2, None), (3, []), (4, ["the tokens", "中"])], "id int, tokens array<string>")
    got = {r.id: r.tokens for r in with_tokens(df, [F.col("id")], F.col("tokens"), bpe_counter()).collect()}
    size = lambda *t: sum(map(len, reference(list(t))))
    assert got == {1: size("a b"), 2: 0, 3: 0, 4: size("the tokens", "中")}


def test_image_tokens(spark):
    sizes = [(1280, 720), (960, 544), (1, 1), (20000, 30), (9000, 9000), (336, 672), (33, 47), (5000, 3)]
    df = spark.createDataFrame([*sizes, (None, 5), (0, 5)], "w int, h int")
    got = [r[0] for r in df.select(image_tokens(F.col("w"), F.col("h"))).collect()]
    assert got == [*image_tokens_np(*np.array(sizes).T).tolist(), None, None]
    assert got[:2] == [40 * 22, 30 * 17]
