import json
import zipfile

import pytest
from pyspark.sql import functions as F

from loomspark import schemas
from loomspark.sources import readers, sinks


def test_row_index_for_any_partitioning(spark):
    want = [(i * 7 % 101, i) for i in range(101)]
    for parts in (1, 4, 17):
        df = spark.createDataFrame([(k,) for k, _ in want], "k int").repartition(parts)
        assert {(r.k, r.row_index) for r in readers.with_row_index(df, "k").collect()} == {(k, k) for k, _ in want}
    assert readers.with_row_index(spark.createDataFrame([], "k int"), "k").count() == 0


def test_group_index(spark, monkeypatch):
    data = [("a" if i % 3 else None, i % 2, i) for i in range(300)] + [("b", 0, 1000)]
    want = {}
    for g, h, i in data:
        want.setdefault((g, h), []).append(i)
    for parts, most in ((1, 1 << 17), (6, 1 << 17), (6, 2)):
        monkeypatch.setattr(readers, "COUNTED", most)
        got = readers.with_group_index(spark.createDataFrame(data, "g string, h int, i int").repartition(parts), ["g", "h"], ["i"]).collect()
        assert len(got) == len(data) and all(want[(r.g, r.h)][r.row_index] == r.i for r in got)
    assert readers.with_group_index(spark.createDataFrame([], "g string, i int"), ["g"], ["i"]).count() == 0


@pytest.mark.parametrize("most", [1 << 17, 3])
def test_places_of_several_groupings(spark, monkeypatch, most):
    monkeypatch.setattr(readers, "COUNTED", most)
    data = [("a" if i % 3 else None, i % 2, (i * 37) % 300) for i in range(300)]
    for parts in (1, 6):
        got = readers.with_places(spark.createDataFrame(data, "g string, h int, i int").repartition(parts), ["i"], {"x": ["g"], "y": ["g", "h"], "z": ["h"]}).collect()
        for name, key in (("x", lambda r: r.g), ("y", lambda r: (r.g, r.h)), ("z", lambda r: r.h)):
            for k in {key(r) for r in got}:
                assert [r[name] for r in sorted(got, key=lambda r: r.i) if key(r) == k] == list(range(sum(key(r) == k for r in got)))
        assert len(got) == 300
    assert readers.with_places(spark.createDataFrame([], "g string, i int"), ["i"], {"x": ["g"]}).count() == 0


def test_jsonl(spark, tmp_path):
    rows = [{"messages": [{"role": "user", "content": "继续\n\"x\""}], "images": ["a.jpg"], "game": None, "channel": "c"}, {"messages": [], "images": None, "game": "g", "channel": None}]
    df = spark.createDataFrame([(r["messages"], r["images"], r["game"], r["channel"]) for r in rows], schemas.TRAINING_ROW)
    sinks.write_jsonl(df, str(tmp_path / "out"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("*.json"))
    assert "继续" in text and sorted(map(str, map(json.loads, text.splitlines()))) == sorted(map(str, rows))
    f = tmp_path / "in.jsonl"
    f.write_text("\n".join(["", *[json.dumps(r, ensure_ascii=False) for r in rows], "", "  "]), encoding="utf-8")
    back = readers.read_jsonl(spark, str(f), schemas.TRAINING_ROW)
    assert back.where("messages IS NOT NULL").count() == 2
    (tmp_path / "deep" / "x").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        readers.read_jsonl(spark, str(tmp_path / "deep"), schemas.TRAINING_ROW, recursive=True)
    (tmp_path / "deep" / "x" / "a.jsonl").write_text(json.dumps(rows[0]) + "\n")
    assert readers.read_jsonl(spark, str(tmp_path / "deep"), schemas.TRAINING_ROW, recursive=True).count() == 1


def test_lines_from_an_offset(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    f.write_bytes("eins\nzwei\r\ndrei ü\nvier".encode())
    assert [(r.offset, r.value) for r in readers.read_lines(spark, str(f)).orderBy("offset").collect()] == [(0, "eins"), (5, "zwei"), (11, "drei ü"), (19, "vier")]
    assert [r.value for r in readers.read_lines(spark, str(f), 5).orderBy("offset").collect()] == ["zwei", "drei ü", "vier"]
    assert [r.value for r in readers.read_lines(spark, str(f), 6, 19).orderBy("offset").collect()] == ["drei ü"]


def test_segments_of_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "CHUNK", 7)
    for name, text in (("a", "one\ntwo\nthree\n"), ("b", "x\n" * 9 + "no end")):
        (tmp_path / name).write_text(text)
    got = readers.read_segments(spark, [(str(tmp_path / "a"), 4, None), (f"file://{tmp_path}/b", 0, 6), (str(tmp_path / "b"), 18, None)]).collect()
    assert sorted((r.path[-1], r.offset, r.value) for r in got) == [("a", 4, "two"), ("a", 8, "three"), ("b", 0, "x"), ("b", 2, "x"), ("b", 4, "x"), ("b", 18, "no end")]
    assert readers.read_segments(spark, []).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_segments(spark, [(str(tmp_path / "gone"), 0, None)])


def test_lines_by_index(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    f.write_text("".join(f'{{"i": {i}, "t": "ü\u4e2d"}}\n' + ("\n  \n" if i % 3 == 0 else "") for i in range(50)), encoding="utf-8")
    first = readers.line_index(spark, str(f), str(tmp_path / "ix"))
    assert first[1] == 50 and readers.line_index(spark, str(f), str(tmp_path / "ix")) == first
    refs = spark.createDataFrame([(p, r) for p, r in enumerate([49, 0, 7, 7, 13, 50, None])], "pos int, row_index bigint")
    got = readers.rows_at(spark, str(f), str(tmp_path / "ix"), refs).orderBy("pos").collect()
    assert [(r.pos, json.loads(r.value)["i"]) for r in got] == [(0, 49), (1, 0), (2, 7), (3, 7), (4, 13)]
    f.write_text("{}\n{}\n{}\n")
    assert readers.line_index(spark, str(f), str(tmp_path / "ix"))[1] == 3
    with pytest.raises(FileNotFoundError):
        readers.line_index(spark, str(tmp_path / "gone"), str(tmp_path / "ix"))


def test_addresses_and_footers(spark, tmp_path):
    """Rows keep the places they have in the files, in the order of the files' names, and no row is moved."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for k, n in ((2, 5), (0, 7), (1, 4)):
        pq.write_table(pa.table({"x": list(range(100 * k, 100 * k + n))}), tmp_path / f"part {k}.parquet", row_group_size=3)
    want = [*range(7), *range(100, 104), *range(200, 205)]
    rows = readers.row_addresses(spark, str(tmp_path), "x")
    assert [r.x for r in rows.orderBy("row_index").collect()] == want and [r.row_index for r in rows.orderBy("row_index").collect()] == list(range(16))
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().toString() and "rangepartitioning" not in rows._jdf.queryExecution().toString()
    groups = readers.footers(spark, [str(tmp_path)]).orderBy("ordinal").collect()
    assert [(r.row_group, r.rows) for r in groups] == [(0, 3), (1, 3), (2, 1), (0, 3), (1, 1), (0, 3), (1, 2)]


def test_catalog(spark, tmp_path):
    f = tmp_path / "index.json"
    f.write_text(json.dumps({"datasets": [{"canonical_name": "a", "stats": {"output_rows": 5}}, {"canonical_name": None, "stats": {"output_rows": 5}}, {"canonical_name": "b", "stats": {"output_rows": 0}}, {"canonical_name": "c"}]}, indent=1))
    assert [tuple(r) for r in readers.read_catalog(spark, str(f), schemas.CATALOG).collect()] == [("a", 5)]


def test_replacements(spark, tmp_path):
    sinks.replace_json(str(tmp_path / "a" / "s.json"), {"x": "ü"})
    assert json.loads((tmp_path / "a" / "s.json").read_text()) == {"x": "ü"} and len(list((tmp_path / "a").iterdir())) == 1
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    sinks.replace_table(spark.read.parquet(path).withColumn("y", F.col("id") * 2), path)
    assert spark.read.parquet(path).agg(F.sum("y")).first()[0] == 20
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("t")] == ["t"]


def test_images_and_package(spark, tmp_path):
    df = spark.createDataFrame([("chunk_000/row_0000/00.jpg", bytearray(b"abc")), ("x.jpg", None), (None, bytearray(b"q"))], "path string, bytes binary")
    assert [tuple(r) for r in sinks.write_images(df, str(tmp_path / "images")).collect()] == [("chunk_000/row_0000/00.jpg", 3)]
    rows = tmp_path / "rows.jsonl"
    rows.write_text(json.dumps({"images": ["images/chunk_000/row_0000/00.jpg"]}) + "\n")
    assert sinks.package(str(rows), str(tmp_path), str(tmp_path / "p.zip")) == 1
    with zipfile.ZipFile(tmp_path / "p.zip") as z:
        assert sorted(z.namelist()) == ["images/chunk_000/row_0000/00.jpg", "rows.jsonl"] and z.infolist()[1].compress_type == zipfile.ZIP_STORED
    rows.write_text(json.dumps({"images": ["gone.jpg"]}) + "\n")
    with pytest.raises(FileNotFoundError):
        sinks.package(str(rows), str(tmp_path), str(tmp_path / "q.zip"))
    got = spark.range(1).select(sinks.image_path(F.lit(3), F.lit(12), F.lit(7))).first()[0]
    assert got == "chunk_003/row_0012/07.jpg"


def test_missing_files_and_stats(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"x")
    df = spark.createDataFrame([("a.jpg",), ("b.jpg",), ("b.jpg",), (None,), (f"{tmp_path}/a.jpg",)], "p string")
    assert [r.p for r in sinks.missing_files(df, "p", str(tmp_path)).collect()] == ["b.jpg"]
    sinks.write_stats(spark.createDataFrame([(0, 5), (1, None)], "rank int, n int"), str(tmp_path / "stats"), "rank")
    assert (tmp_path / "stats" / "_SUCCESS").exists() and json.loads(next((tmp_path / "stats" / "rank=1").glob("*.json")).read_text()) == {"n": None}


def test_snapshot(spark, tmp_path):
    from loomspark.sources.files import snapshot

    for name in ("a.parquet", "deep/b.parquet", "deep/c.json", "note.txt"):
        (tmp_path / "from" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "from" / name).write_text(name)
    take = lambda: sorted(map(tuple, snapshot(spark, str(tmp_path / "from"), f"file://{tmp_path}/to", ["*.parquet", "note.*"]).collect()))
    assert take() == [("a.parquet", 9, True), ("deep/b.parquet", 14, True), ("note.txt", 8, True)]
    assert (tmp_path / "to" / "deep" / "b.parquet").read_text() == "deep/b.parquet" and not (tmp_path / "to" / "deep" / "c.json").exists()
    (tmp_path / "to" / "a.parquet").write_text("short")
    assert [c for _, _, c in take()] == [True, False, False]
    with pytest.raises(FileNotFoundError):
        snapshot(spark, str(tmp_path / "from"), str(tmp_path / "to"), ["*.csv"])
