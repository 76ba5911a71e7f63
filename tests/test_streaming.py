import json

from pyspark.sql import functions as F

import pytest

from loomspark.streaming.prefetch import Prefetch
from loomspark.streaming.tail import TailReader, TailSource, channel_totals, continued_totals, push_once, pushed


def test_tail_waits_for_whole_lines(spark, tmp_path):
    spark.dataSource.register(TailSource)
    log = tmp_path / "log.jsonl"
    line = lambda s, c, t: json.dumps({"step": s, "channel": c, "tokens": t}) + "\n"
    log.write_text(line(1, "a", 5) + line(2, "b", 7) + '{"step": 3, "cha')
    lines = spark.readStream.format("tail").option("path", str(log)).load()
    rows = lines.select(F.from_json("value", "step int, channel string, tokens bigint").alias("r")).select("r.*")
    out = str(tmp_path / "pushed")

    def run():
        q = rows.writeStream.foreachBatch(push_once(out)).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None

    run()
    assert sorted(r.step for r in pushed(spark, out, "step").collect()) == [1, 2]
    with log.open("a") as f:
        f.write('nnel": null, "tokens": 9}\n\n' + line(4, "a", 1))
    run()
    seen = {r.step: r.tokens for r in pushed(spark, out, "step").collect()}
    assert sorted(seen) == [1, 2, 3, 4] and seen[3] == 9
    push_once(out)(rows_of(spark, [(2, "b", 8)]), 7)
    push_once(out)(rows_of(spark, [(2, "b", 8)]), 7)
    assert {r.step: r.tokens for r in pushed(spark, out, "step").collect()}[2] == 8


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "step int, channel string, tokens bigint")


def test_tail_reads_so_many_bytes_at_a_time(tmp_path):
    f = tmp_path / "log"
    f.write_text("aaaa\nbbbb\n" + "c" * 50 + "\ndd")
    reader, at, batches = TailReader(str(f), 6), {"byte": 0}, []
    while True:
        lines, end = reader.read(at)
        if end == at:
            break
        batches.append([v for _, v in lines])
        assert [v for _, v in reader.readBetweenOffsets(at, end)] == batches[-1]
        at = end
    assert batches == [["aaaa", "bbbb"], ["c" * 50]]
    assert TailReader(str(tmp_path / "gone")).read({"byte": 3})[1] == {"byte": 3}


def test_prefetch_commits_what_was_consumed():
    read = []

    def source(n, error=None):
        for i in range(n):
            read.append(i)
            yield f"batch {i}", i + 1
        if error:
            raise error

    p = Prefetch(source(6), 0, depth=3)
    assert p.committed == 0 and next(p) == "batch 0" and p.committed == 0 and next(p) == "batch 1" and p.committed == 1
    assert len(read) <= 6
    assert list(p) == [f"batch {i}" for i in range(2, 6)] and p.committed == 6 and list(p) == []
    p = Prefetch(source(2, ValueError("broken")), 0, depth=8)
    assert [next(p), next(p)] == ["batch 0", "batch 1"]
    for _ in range(2):
        with pytest.raises(ValueError, match="broken"):
            next(p)
    assert p.committed == 2
    p = Prefetch(iter([]), "start")
    assert list(p) == [] and p.committed == "start"
    p.close()


def test_running_totals_of_a_stream_equal_the_batch(spark, tmp_path):
    data = spark.createDataFrame([("a", 5), (None, 2), ("a", 1), ("b", 4)], "channel string, tokens bigint")
    data.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = channel_totals(stream).writeStream.outputMode("complete").format("memory").queryName("totals").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("totals").collect())) == sorted(map(tuple, channel_totals(data).collect()))


def test_totals_go_on_from_what_was_saved(spark):
    data = spark.createDataFrame([("a", 5), (None, 2), ("a", 1), ("b", 4)], "channel string, tokens bigint")
    saved = channel_totals(data.where("tokens > 2"))
    assert sorted(map(tuple, continued_totals(saved, data.where("tokens <= 2")).collect())) == sorted(map(tuple, channel_totals(data).collect()))
