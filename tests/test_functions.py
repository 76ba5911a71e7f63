import pytest
from pyspark.sql import functions as F

from loomspark.functions import actions as A
from loomspark.functions import chat, frames, images, logs, names, paths

S, P, E = A.START, A.SEP, A.STOP
#: text, start, end, well formed, strict, separator, prefix mouse, single matches, key
CASES = [
    (f"{S}5 -10 0{P} W{E}", True, True, True, True, True, [5, -10, 0], True, True),
    (f"{S}1 2 3 4{P} W{E}", True, True, True, False, True, [1, 2, 3], True, True),
    (f"{S}1 2 3{P} W", True, False, False, False, False, [1, 2, 3], False, False),
    (f"{S} {E}", True, True, False, False, False, None, False, False),
    (f"{S}0 0 0{P} {P} {E}", True, True, True, True, True, [0, 0, 0], True, False),
    (f"{S}\n1  2 3{E}", True, True, True, True, False, [1, 2, 3], False, False),
    ("hello", False, False, False, False, False, None, False, False),
]


@pytest.mark.parametrize("case", CASES)
def test_parsers(spark, case):
    t = F.col("t")
    r = spark.createDataFrame([(case[0],)], "t string").select(
        A.contains_start(t), A.contains_end(t), A.well_formed(t), A.parses_strict(t), A.has_separator(t), A.mouse(t), A.mouse(t, A.SINGLE).isNotNull(), A.has_key(t)
    )
    assert tuple(r.first()) == case[1:]


def test_scores_of_nulls_and_edits(spark):
    df = spark.createDataFrame([(None, "a"), ("kitten", "sitting"), (" é ", "e")], "pred string, gt string")
    got = [(r.exact_match, r.edit_distance) for r in df.select(*A.scores(F.col("pred"), F.col("gt"))).collect()]
    assert got == [(None, None), (False, 3), (False, 1)]
    still = lambda p, g: spark.range(1).select(A.moved_but_still(F.lit(p), F.lit(g))).first()[0]
    assert still(f"{S}0 0 0{E}", f"{S}5 5 0{E}") is False and still(f"{S}0 0 0{E}", f"{S}5 -10 0{E}") is True and still("x", f"{S}5 -10 0{E}") is None


def test_chat(spark):
    turns = [("human", "a"), ("tool", "x"), ("gpt", None), ("gpt", "b"), (None, "c")]
    df = spark.createDataFrame([(1, turns, ["i"]), (2, None, ["i"]), (3, [], ["i"]), (4, [("gpt", "")], ["i"]), (5, turns, None)], "id int, conversations array<struct<from string, value string>>, images array<string>")
    got = {r.id: [tuple(m) for m in r.messages] for r in chat.convert(df).collect()}
    assert got == {1: [("user", "a"), ("assistant", ""), ("assistant", "b")]}
    rows = spark.createDataFrame([(1, [("user", "q"), ("user", "r"), ("assistant", "s"), ("user", "t")]), (2, None), (3, []), (4, [("user", "a"), ("assistant", None), None, ("user", "b"), (None, "c"), ("user", "d"), ("assistant", "e")])], "id int, messages array<struct<role string, content string>>")
    pairs = chat.answered(rows, "id")
    assert [(r.id, r.turn, r.pair, r.users_so_far, r.question, r.answer) for r in pairs.orderBy("id", "pair").collect()] == [(1, 1, 0, 2, "r", "s"), (4, 0, 0, 1, "a", None), (4, 5, 1, 3, "d", "e")]
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert [r.t for r in rows.orderBy("id").select(chat.rendered(F.col("messages")).alias("t")).collect()][1:3] == ["", ""]
    assert rows.where("id = 1").select(chat.rendered(F.slice("messages", 1, 1))).first()[0] == "<|im_start|>user\nq<|im_end|>\n"


def test_normal_and_relative_paths(spark):
    import posixpath

    cases = ["a/b/../c", "/../a//b/./c/", "../../x/y", "a/../..", "/", ".", "", "a/b", "/a/b/c", "/a/x", "//a/./b/../b/c", None]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    got = [tuple(r) for r in df.select("p", paths.normal(F.col("p"))).collect()]
    assert got == [(c, None if c is None else ("/" + posixpath.normpath(c).lstrip("/") if c.startswith("/") else posixpath.normpath(c))) for c in cases]
    for base in ("/a/b", "/"):
        part = [c for c in cases if c and c.startswith("/")]
        rel = [r[0] for r in spark.createDataFrame([(c,) for c in part], "p string").select(paths.relative(F.col("p"), base)).collect()]
        assert rel == [posixpath.relpath("/" + c.lstrip("/"), base) for c in part]


def test_frames(spark):
    same = ["images/chunk_012/row_0034/07.jpg", "./images/chunk_012/row_0034/07.jpg", "images\\chunk_012\\row_0034\\07.jpg", "D:\\rec\\x\\images\\chunk_12\\row_34\\7.jpg", " images/chunk_012/row_0034/07.jpg?v=3",
            "images%2Fchunk_012%2Frow_0034%2F07.jpg", "IMAGES/CHUNK_012/ROW_0034/07.JPG", "images/chunk_011/../chunk_012/row_0034/07.jpeg", "/data/a//chunk_012//row_0034/./07.jpg", "file:///mnt/images//chunk_012/row_0034/07.jpg", "images/chunk_012/row_1/../row_0034/07.jpg"]
    other = [("images/common/Black.JPG", "images/common/black"), ("/data/common_root/images\\common\\black.jpg", "images/common/black"), ("images/sample_000001/00.jpg", "images/sample_000001/00"), ("", None), ("  ", None), (None, None)]
    df = spark.createDataFrame([(p, "12/34/7") for p in same] + other, "p string, want string")
    assert df.withColumn("got", frames.frame_key(F.col("p"))).where("NOT got <=> want").collect() == []
    shared = frames.shared_keys(spark.createDataFrame([("images/chunk_012/row_0034/07.jpg",), ("images/common/black.jpg",)], "path string"))
    rows = spark.createDataFrame([([*same, "images/common/black.jpg", "chunk_1/row_2/3.jpg", None],), (None,), ([],)], "images array<string>")
    got = [r[0] for r in rows.select(frames.own_frames(F.col("images"), shared)).collect()]
    assert got == [["1/2/3"], [], []]
    assert spark.range(1).select(frames.recordings(F.array(F.lit("1/2/3"), F.lit("1/2/4"), F.lit("images/x")))).first()[0] == ["1/2"]


def test_names(spark):
    keys = names.channel_keys(spark.createDataFrame([("ember_fall", ["EF2", "tide watch", None]), ("tide_watch", []), (None, ["x"])], "channel string, aliases array<string>"))
    assert keys == {"emberfall": "ember_fall", "ef2": "ember_fall", "tidewatch": "tide_watch"}
    df = spark.createDataFrame([("Ember-Fall ", None), ("", "ef 2"), ("unknown", "TIDE_WATCH"), (None, None), ("?", "!")], "c string, g string")
    assert [r[0] for r in df.select(names.known_game(keys, F.col("c"), F.col("g"))).collect()] == ["ember_fall", "ember_fall", "tide_watch", None, None]
    assert [r[0] for r in df.select(names.known_game({}, F.col("c"), F.col("g"))).collect()] == [None] * 5


def test_paths(spark):
    df = spark.createDataFrame([("a/./b.jpg",), ("/x//y.jpg",), ("a/../c.jpg",), (None,)], "p string")
    got = [r[0] for r in df.select(paths.normal(paths.absolute(F.col("p"), "/root/"))).collect()]
    assert got == ["/root/a/b.jpg", "/x/y.jpg", "/root/c.jpg", None]
    assert [r[0] for r in df.select(paths.relative(F.col("p"), "/x")).collect()][1] == "y.jpg"
    src = spark.createDataFrame([("", "/d/My_Ember.jsonl/"), ("c", "x"), (None, None)], "c string, d string")
    assert [r[0] for r in src.select(paths.channel_of_source(F.col("c"), F.col("d"), ["ember"], "ember_fall")).collect()] == ["ember_fall", "c", "unknown"]


def test_logs(spark):
    df = spark.createDataFrame([("12/300", None, None), ("7", 1, 2), (None, 0, 5), ("x", None, 0)], "i string, g int, s int")
    assert [r[0] for r in df.select(logs.step_of(F.col("i"), F.col("g"), F.col("s"))).collect()] == [12, 7, 5, None]
    series = spark.createDataFrame([("r", i, float(i)) for i in range(30)], "r string, i int, v double")
    mean = {r.i: r.m for r in series.select("i", logs.trailing_mean(F.col("v"), [F.col("r")], [F.col("i")]).alias("m")).collect()}
    assert mean[5] == 2.5 and mean[29] == 19.0
    log = spark.createDataFrame([("r", 1, 5, None, float("nan"), True)], "run string, step int, trained_tokens_a bigint, trained_tokens_b bigint, loss double, flag boolean")
    assert [tuple(r) for r in logs.counters(log, ["run", "step"]).collect()] == [("r", 1, "a", 5)]
    assert [(r.name, r.value) for r in logs.numeric_pairs(log, ["run", "step"]).collect()] == [("train/trained_tokens_a", 5.0)]


def test_image_heads(spark):
    jpeg = b"\xff\xd8\xff\xe0\x00\x10JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00\xff\xc0\x00\x11\x08\x02\xd0\x05\x00\x03"
    png = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR\x00\x00\x03\xc0\x00\x00\x02 "
    assert [images.image_size(x) for x in (jpeg, png, jpeg[:20], b"", None, b"GIF89a", b"\xff\xd8\xff\xc0\x00\x11\x08\x00\x00\x00\x00\x03")] == [(1280, 720), (960, 544), None, None, None, None, None]
    late = jpeg[:2] + b"\xff\xe1\xff\xff" + b"x" * 0xFFFD + jpeg[2:]
    df = spark.createDataFrame([([bytearray(jpeg), bytearray(late), None],), (None,), ([bytearray(late[:-9]), bytearray(late[:50]), bytearray(png)],), ([],)], "b array<binary>")
    assert [r[0] for r in df.select(images.image_sizes(F.col("b"))).collect()] == [["1280x720", "1280x720", None], None, [None, None, "960x544"], []]


def test_games_by_join_are_those_of_the_map(spark):
    channels = spark.createDataFrame([("ember_fall", ["Ember Fall HD", None]), ("tide_watch", None), (None, ["x"])], "channel string, aliases array<string>")
    df = spark.createDataFrame([("EMBER-fall", None), (" ember fall hd", "tide_watch"), ("?", "Tide Watch"), (None, "nothing"), ("", None)], "channel string, game string")
    keys = names.channel_keys(channels)
    want = [r[0] for r in df.select(names.known_game(keys, F.col("channel"), F.col("game"))).collect()]
    assert want == ["ember_fall", "ember_fall", "tide_watch", None, None]
    assert [r.known for r in names.with_known_game(df, channels, "known").collect()] == want
    assert [r.known for r in names.with_known_game(df, channels.where("false"), "known").collect()] == [None] * 5
