import random

import pytest
from pyspark.sql import functions as F

from loomspark.llm import census, quality

COMMON = [("en", w) for w in "the a of to and in is that was we you it for with on at as but".split()] + [("de", w) for w in "der die das und in zu den ist nicht für wir".split()] + [("zh", w) for w in "的了在是我有和不就"] + [("es", "más"), (None, "x"), ("en", None)]
RAW = "traj_id bigint, images array<struct<bytes binary, path string>>, conversations array<struct<`from` string, value string>>, dataset string, lang string, shard string, row_index bigint, exported_at timestamp, tokens int"


def jpeg(w, h):
    return bytearray(b"\xff\xd8\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00\xff\xc0\x00\x11\x08" + h.to_bytes(2, "big") + w.to_bytes(2, "big") + b"\x03")


def test_census(spark):
    import datetime as dt

    at = lambda d: dt.datetime(2025, 1, d)
    good = (jpeg(960, 544), "a")
    rows = [
        (1, [good, (bytearray(b""), None), None], [("human", "<image><image><image><image> the tokens of it"), ("gpt", None), None], "Set-A.parquet", "EN_us", "set_a-00000", 0, at(1), 0),
        (2, [good], [("odd", "the tokens")], "hub/set_a ", "zh", "set_a-00000", 0, at(2), 0),  # delivered again, later
        (3, None, None, None, None, "set_a-00001", 1, at(1), 0),
        (4, [(None, None)], [("gpt", "die Truhe ist nicht für den Turm")], None, "und", None, None, None, 0),
        (5, [], [("gpt", "我在和你说话")], "elsewhere", "en", None, 7, at(1), 0),
        (6, [], [("gpt", "我在和你说话")], "elsewhere", "en", None, 7, at(1), 0),
    ]
    raw = spark.createDataFrame(rows, RAW)
    canonical = spark.createDataFrame([("set_a", "open"), ("set_b", None), (None, "x")], "canonical_name string, domain string")
    common = spark.createDataFrame(COMMON, "lang string, word string")
    got = {(r.dataset, r.lang, r.domain): r for r in census.token_census(raw, canonical, common).collect()}
    assert set(got) == {("set_a", "en", "open"), ("set_a", "und", "open"), (None, "de", None), (None, "zh", None)}
    r = got[("set_a", "en", "open")]
    assert (r.conversations, r.images, r.text_tokens, r.visual_tokens, r.tokens) == (1, 1, 2, 510, 512)
    assert got[(None, "zh", None)].conversations == 2 and got[(None, "de", None)].unreadable_images == 1
    first = {r.traj_id: r for r in census.count_conversations(raw, common, ["traj_id"]).collect()}[1]
    assert (first.images, first.unreadable, first.missing, first.visual_tokens, first.lang) == (3, 2, 1, 3 * 510, "en")
    assert census.token_census(raw.where("false"), canonical, common).collect() == []
    assert census.token_census(raw, canonical.where("false"), common.where("false")).agg(F.sum("conversations")).first()[0] == 5


PROSE = [
    "The agent was at the north gate, and it waited for the alarm to go off. We had a key with us.",
    "THE AGENT WAS AT THE NORTH GATE AND IT WAITED FOR THE ALARM TO GO OFF",
    "the agent was at the north gate and it waited for the alarm to go off in the rain",
    "Lio: We had to wait for the lift, but it was late.\nNettle: That is the way of the lift.",
    "# The gate\n\nThe agent was at the north gate, and it waited for the alarm.",
    "<|thought_start|>The agent was at the gate, and we had to wait for it.<|thought_end|>",
    "我在北门的时候，警报就响了。我们不在那里，也不是先去的。",
    "The agent was at the\nnorth gate, and it waited\nfor the alarm to go off.\nWe had a key with us\nand it was in the bag.",
    "Der Agent ist nicht in der Stadt, und wir gehen zu den Brücken.",
    "🎮 The agent was at the gate, and we had to wait for it. 🙂",
]
JUNK = {
    "list": ["- the key\n- a lamp\n- the north gate\n- sell the lamp\n- look back", "1. 信号塔\n2. 雾港码头\n3. 断裂的水渠\n4. 收费桥", "新手岛, 沈微澜, 苏木, 铁匠老魏, 白石老人", "[x] the key / [ ] the lamp / [X] the gate / [ ] the tower", "Tab+F1: Keffer\nW: Lio\nQ+S: Keffer\nM: Bex"],
    "table": ["| a | the key | 3 |\n|---|---|---|\n| b | the lamp | 4 |", "<table><tr><td>the key</td><td>of the gate</td></tr></table>", "place     score     keys\nthe gate     3     W\nthe lamp     4     S", "game\tstep\titem\nx\t3\tthe key\ny\t4\tthe lamp", "item=the key; place=the gate; loss=0.2"],
    "symbols": ["2025-04-23 00:53:23,454 [DEBUG] loader.py:18 rank=18 step=4284 loss=2.5000", "♪◆.○□↑□ ●░♪░.\n●↑☆♪♪", "00000010  8e e3 6f 58 c9 1c 1b f0 48 fc 78", "a,1,2.5,3\nb,4,5.5,6"],
    "actions": ["<|action_start|>5 0 0<|action_sep|> W<|action_sep|> A<|action_end|>\n<|action_start|>1 0 0<|action_sep|> W<|action_end|>"],
    "words": ["score validation wisps still guide means golem clips episodes cog tide instead show set", "amlqdn rrfytaehxm ugsfnpdivlp zsryopfrt guiolfgnakp sgqn uex", "qz52FSGhLqeiT7Rs5gfDRp0kDNIYRXTgDxgx4noG4bgdet22Fc35MoHeBrs5cXRt5CpLFbpy2JA5QPwBJu2cxTXN9"],
    "garbled": ["å½\x95å\x83\x8f3005é\x87\x8cï¼\x8cé\x95\x9cå¤´", "the ���� gate"],
    "repetition": ["The agent was at the north gate, and it waited for us. " * 12, "look north " * 9, "录像里，镜头向右转的同时玩家丢掉了我的滑翔翼。\n" * 9],
    "empty": ["", "   ", "\n\t\n", None],
}


#: Texts of which another reason holds as well, and comes first: a log line has fields, a short phrase has no function words.
OTHER_REASON = {"2025-04-23 00:53:23,454 [DEBUG] loader.py:18 rank=18 step=4284 loss=2.5000": "table", "look north " * 9: "words"}


def test_verdicts(spark):
    rows = [(None, t) for t in PROSE] + [(k, t) for k, ts in JUNK.items() for t in ts]
    df = spark.createDataFrame([(i, t, w, i) for i, (w, t) in enumerate(rows)], "doc_id bigint, text string, want string, reason int")
    common = spark.createDataFrame(COMMON, "lang string, word string")
    got = quality.text_quality(df.repartition(3), common).join(df.select("doc_id", "text", "want"), "doc_id").collect()
    assert [(r.text, r.reason, r.want) for r in got if (r.reason is None) != (r.want is None)] == []
    other = {r.text: r.reason for r in got if r.reason != r.want}
    assert other == OTHER_REASON, other
    empty = [r for r in got if r.want == "empty"]
    assert all(r.n_words == 0 and r.mean_word_length is None and r.not_prose_share is None for r in empty)
    assert quality.text_quality(df.where("false"), common).collect() == [] and len(got) == len(rows)


def test_half_decides(spark):
    prose, table = PROSE[0], "| a | the key | 3 |\n" * 3
    df = spark.createDataFrame([(1, (prose + "\n") + table), (2, (prose + "\n") + table * 4)], "doc_id bigint, text string")
    got = {r.doc_id: r.reason for r in quality.text_quality(df, spark.createDataFrame(COMMON, "lang string, word string")).collect()}
    assert got == {1: None, 2: "table"}


def test_lists_and_repetition_add_up():
    """Neither the table nor the repeated sentence is a half, but both together are; with half as much of each the text is prose."""
    c = quality.Common([w for _, w in COMMON if w])
    prose = " ".join(f"The agent was at the {x} gate, and it waited for the {y} to go off." for x, y in zip("north south east west upper lower outer inner old new".split(), "alarm lamp bell horn light siren whistle clock gong drum".split(), strict=True))
    sentence, rows = "We had a key with us, and it was in the bag of the agent. ", [f"| a{i} | the key{i} | {i} |\n" for i in range(60)]
    make = lambda k, m: prose + "\n" + sentence * k + "\n" + "".join(rows[:m])
    size = lambda t: len("".join(t.split()))
    both, less = make(12, 40), make(5, 15)
    assert size("".join(rows[:40])) < size(both) / 2 and size(sentence * 12) < size(both) / 2
    got = quality.measure([both, less, make(8, 0), make(0, 20)], c)
    assert (got["verdict"] >= 0).tolist() == [True, False, False, False]


def test_statistics():
    c = quality.Common([w for _, w in COMMON if w])
    m = quality.measure(["The key is in a box!\n- lamp", "我在北门。"], c)
    assert m["n_words"].tolist() == [7, 4] and m["mean_word_length"].tolist() == [pytest.approx(18 / 7), 1.0]
    assert m["closed_line_share"].tolist() == [0.5, 1.0] and m["bullet_line_share"].tolist() == [0.5, 0.0]
    assert m["common_word_share"].tolist() == [pytest.approx(4 / 7), 0.5]


def broken(text):
    c = quality.Common([w for _, w in COMMON if w])
    failures = int(quality.measure([text], c)["failures"][0])
    return [r for i, r in enumerate(quality.RULES) if failures >> i & 1]


def test_published_rules():
    said = " ".join(f"The agent was at the {x} gate, and it waited for the {y} to go off." for x, y in zip("north south east west".split(), "alarm lamp bell horn".split(), strict=True))
    assert broken(said) == [] and broken("") == []
    assert broken("the key of it...\nthe lamp is in a box…") == ["too_few_words", "word_length", "signs_per_word", "ellipsis_lines", "short_lines"]
    assert broken("- qqqqqqqqqqqqq 1 2 3\n- wwwwwwwwwwwwwww 4 5 6") == ["too_few_words", "word_length", "bullet_lines", "alphabetic_words", "stop_words", "closed_lines", "short_lines"]
    assert broken((said + "\n") * 2) == ["same_lines", "same_line_signs", "same_tens"]
    assert broken(said + "\n" + "the lamp\n" * 3) == ["same_lines", "short_lines"]
    assert broken(said.replace(".", ";") + "\n" + said.replace("gate", "door").replace(".", ":")) == ["same_tens", "closed_lines"]


#: Kinds of text that none of the rules were made for, with whether they are prose.
HELD_OUT = [
    (False, '{"name": "gate", "keys": [1, 2, 3], "open": false, "at": {"x": 3.5, "y": -2}}\n{"name": "lamp", "keys": [], "open": true, "at": {"x": 0.5, "y": 7}}'),
    (False, "SELECT gate, count(*) FROM keys WHERE open = 1 GROUP BY gate;\nINSERT INTO keys VALUES (1, 'north', 3.5), (2, 'south', 4.5);\nDELETE FROM keys WHERE id = 7;"),
    (False, "  /\\_/\\\n ( o.o )\n  > ^ <\n /|   |\\\n(_|   |_)"),
    (False, "1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 4. Ba4 Nf6 5. O-O Be7 6. Re1 b5 7. Bb3 d6 8. c3 O-O"),
    (False, "def open_gate(keys):\n    for k in keys:\n        if k.fits():\n            return True\n    return False\n\nx = open_gate([1, 2])"),
    (False, "aGVsbG8gd29ybGQgdGhpcyBpcyBhIHRlc3Q=\nU29tZSBvdGhlciB0ZXh0IHRoYXQgaXMgbG9uZw==\nYW5kIHN0aWxsIG1vcmUgdGV4dCBmb3IgaXQ="),
    (False, "key;place;count\nred;north gate;3\nblue;south gate;4\ngreen;old tower;11\nblack;mill;2"),
    (False, "GET /gate/3 200 12ms\nGET /gate/4 404 3ms\nPOST /key 201 44ms\nGET /lamp/9 200 8ms"),
    (False, "😀😀🎮🎮🔥🔥💎💎🗝🗝🗝😀🎮🔥"),
    (False, "ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha ha"),
    (True, "Dear Lio,\n\nI was at the gate for an hour, but you did not come. The lamp was on, and we had to go.\n\nYours,\nBex"),
    (True, "\"Was it you?\" she asked. \"No,\" he said, \"it was the bell in the tower.\" They went on in the rain."),
    (True, "i was at the gate and it was late so we had to wait for you but it is ok"),
    (True, "Der Turm ist nicht in der Stadt. Wir gehen zu den Brücken, und das Licht ist für die Boote."),
    (True, "我们在桥的旁边等了很久，不过他没有来。天黑了，我就回去了。"),
    (True, "He had 3 keys and 12 lamps, of which 4 were lost on 5 May; at 7 it was over, and we had 11 to go."),
]


def test_kinds_of_text_the_rules_have_not_seen():
    c = quality.Common([w for _, w in COMMON if w])
    verdicts = quality.measure([t for _, t in HELD_OUT], c)["verdict"].tolist()
    wrong = [t for (prose, t), v in zip(HELD_OUT, verdicts, strict=True) if (v < 0) != prose]
    assert wrong == []


def test_texts_are_measured_each_for_itself():
    c = quality.Common([w for _, w in COMMON if w])
    rng = random.Random(1)
    tt = [t or "" for t in ["Lio never left two frames of smoke; instead, it waited until the second wave begins.", "It was level 79.", *PROSE, *[t for ts in JUNK.values() for t in ts]]] * 3
    rng.shuffle(tt)
    whole = quality.measure(tt, c)
    for i in range(len(tt)):
        one = quality.measure([tt[i]], c)
        assert all(str(whole[k][i]) == str(one[k][0]) for k in whole), tt[i]
