"""Streams: a file that grows, and running counters."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from loomspark.sources import files

MOST = 1 << 26


class TailSource(DataSource):
    """Lines appended to a file: format `tail`, options path and maxBytes (of a batch, 64 MB unless given).

    The offset is a byte; a last line without its end waits for it. A line longer than maxBytes is a batch of its own.
    """

    @classmethod
    def name(cls) -> str:
        return "tail"

    def schema(self) -> str:
        return "offset bigint, value string"

    def simpleStreamReader(self, schema):  # noqa: ANN001, ANN201, N802
        return TailReader(self.options["path"], int(self.options.get("maxbytes", self.options.get("maxBytes", MOST))))


class TailReader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, most: int = 1 << 26):
        self.path, self.most = path, most

    def initialOffset(self) -> dict:  # noqa: N802
        return {"byte": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        return self._lines(start["byte"], None)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return self._lines(start["byte"], end["byte"])[0]

    def commit(self, end: dict) -> None:
        """Nothing is kept, so there is nothing to release."""

    def _lines(self, at: int, stop: int | None) -> tuple[Iterator[tuple], dict]:
        if not files.exists(self.path):
            return iter(()), {"byte": at}
        out, place = [], at
        with files.open_bytes(self.path) as f:
            f.seek(at)
            while (stop is None and place - at < self.most) or (stop is not None and place < stop):
                line = f.readline()
                if not line.endswith(b"\n"):
                    break
                if line.strip():
                    out.append((place, line.rstrip(b"\r\n").decode("utf-8", "replace")))
                place += len(line)
        return iter(out), {"byte": place}


def channel_totals(events: DataFrame) -> DataFrame:
    """Running tokens of each channel over rows (channel, tokens); null channels as 'unknown'."""
    return events.groupBy(F.coalesce("channel", F.lit("unknown")).alias("channel")).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))


def continued_totals(saved: DataFrame, events: DataFrame) -> DataFrame:
    """Totals saved by `channel_totals`, carried on with later rows (channel, tokens)."""
    both = saved.unionByName(channel_totals(events))
    return both.groupBy("channel").agg(F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows"))


def push_once(path: str):  # noqa: ANN201
    """A foreachBatch function that writes each batch to a folder named by its number: a batch delivered again takes the place of the first delivery."""

    def run(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    return run


def pushed(spark: SparkSession, path: str, key: str) -> DataFrame:
    """What `push_once` wrote, one row for each key: that of the last batch."""
    rows = spark.read.parquet(path)
    names = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), "batch").alias("_r")).select("_r.*")
