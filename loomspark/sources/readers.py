"""Readers: tables with a row index, JSON Lines, recursive folders, catalogs, and counts from footers."""

from __future__ import annotations

import hashlib
from pathlib import Path
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from loomspark.session import cut, small_rows
from loomspark.sources import files

#: The most (range, group) pairs whose counts go to the driver; beyond it, counts are joined by a shuffle.
COUNTED = 1 << 17
LOCAL = (1 << 33) - 1
#: The most files of a table whose row counts go to the driver.
FILES = 1 << 17


def _ranged(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """`df` sorted by ranges and written to the checkpoint folder, with `__id`: the number of the range and the place in it."""
    return cut(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("__id", F.monotonically_increasing_id())


def with_row_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """`df` with the place of each row in an order, from 0.

    Rows are sorted by ranges; only the number of rows of each range goes to the driver, so no task holds all rows. Equal
    rows in `order` are placed in any order among themselves; give an order without ties for a fixed result. No rows give
    no rows.
    """
    ranged = _ranged(df, list(order))
    part = F.shiftright("__id", 33)
    counts = sorted((r["p"], r["n"]) for r in ranged.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    start = df.sparkSession.createDataFrame(starts, "__part bigint, __start bigint").coalesce(1)
    local = F.col("__id").bitwiseAND(F.lit(LOCAL))
    return ranged.join(F.broadcast(start), part == F.col("__part"), "left").withColumn(name, local + F.col("__start")).drop("__id", "__part", "__start")


def with_group_index(df: DataFrame, groups: list[str], order: list[str | Column], name: str = "row_index") -> DataFrame:
    """`df` with the place of each row in its group, from 0.

    A group may hold any part of the rows: ranges are cut by group and order, so a large one is spread over many tasks,
    and a row's place is its place in its range, less that of its group's first there, plus the group's rows in earlier
    ranges. Counts by range and group make that offset: on the driver where there are at most COUNTED of them, else by a
    window over the counts. Null groups are a group.
    """
    ranged = _ranged(df, [*groups, *order])
    part, local = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit(LOCAL))
    keys = [f"__group{i}" for i in range(len(groups))]
    counts = ranged.groupBy(part.alias("__part"), *[F.col(g).alias(k) for g, k in zip(groups, keys, strict=True)]).agg(F.count("*").alias("n"), F.min(local).alias("first"))
    few = counts.take(COUNTED + 1)
    if len(few) <= COUNTED:
        seen: dict[tuple, int] = {}
        rows = []
        for r in sorted(few, key=lambda r: r["__part"]):
            group = tuple(r[k] for k in keys)
            rows.append((r["__part"], *group, seen.get(group, 0) - r["first"]))
            seen[group] = seen.get(group, 0) + r["n"]
        kind = T.StructType([*counts.schema.fields[:-2], T.StructField("__shift", T.LongType())])
        shift = F.broadcast(df.sparkSession.createDataFrame(rows, kind).coalesce(1))
    else:
        before = F.sum("n").over(W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
        shift = cut(counts).select("__part", *keys, (F.coalesce(before, F.lit(0)) - F.col("first")).alias("__shift"))
    same = [part == F.col("__part"), *[ranged[g].eqNullSafe(F.col(k)) for g, k in zip(groups, keys, strict=True)]]
    return ranged.join(shift, same).withColumn(name, local + F.col("__shift")).drop("__id", "__part", "__shift", *keys)


def with_places(df: DataFrame, order: list[str | Column], groups: dict[str, list[str]]) -> DataFrame:
    """`df` with the place of each row among the rows of its group in one order, from 0, for several groupings {name of the place: columns} at once.

    One sort by ranges serves all groupings. Tasks count the rows of each group they have met (so the groups of a range have
    to be few: sources, phases), and counts by range and group give what lies before: on the driver where there are at most
    COUNTED of them, else by a window over the counts.
    """
    ranged = _ranged(df, order)
    names = list(groups)
    keys = {n: F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]) for n, cols in groups.items()}
    coded = ranged.select("*", *[keys[n].alias(f"__of_{n}") for n in names])
    fields = [f for f in coded.schema.fields if f.name not in {f"__of_{n}" for n in names}]
    schema = T.StructType([*fields, *[T.StructField(f"__of_{n}", T.StringType()) for n in names], *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches):  # noqa: ANN001, ANN202
        seen: list[dict[str, int]] = [{} for _ in names]
        now = -1
        for b in batches:
            # A task may read several ranges; each begins anew.
            part = np.asarray(b.column(b.schema.get_field_index("__id"))) >> 33
            for begin in np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])).tolist() if b.num_rows else []:
                end = begin + int(np.searchsorted(part[begin:], part[begin], side="right"))
                piece = b.slice(begin, end - begin)
                if part[begin] != now:
                    now, seen = part[begin], [{} for _ in names]
                places = []
                for n, counts in zip(names, seen, strict=True):
                    code = piece.column(piece.schema.get_field_index(f"__of_{n}")).dictionary_encode()
                    index, words = np.asarray(code.indices), code.dictionary.to_pylist()
                    by = np.argsort(index, kind="stable")
                    first = np.searchsorted(index[by], np.arange(len(words)))
                    place = np.empty(len(index), np.int64)
                    place[by] = np.arange(len(index)) - first[index[by]] + np.array([counts.get(w, 0) for w in words])[index[by]]
                    for w, k in zip(words, np.bincount(index, minlength=len(words)).tolist(), strict=True):
                        counts[w] = counts.get(w, 0) + k
                    places.append(pa.array(place))
                yield pa.RecordBatch.from_arrays([*piece.columns, *places], names=schema.names)

    placed = coded.mapInArrow(run, schema)
    part = F.shiftright("__id", 33)
    for n in names:
        counts = coded.groupBy(part.alias("__p"), F.col(f"__of_{n}").alias("__g")).agg(F.count("*").alias("n"))
        few = counts.take(COUNTED + 1)
        if len(few) <= COUNTED:
            seen: dict[str, int] = {}
            before = []
            for r in sorted(few):
                before.append((r["__p"], r["__g"], seen.get(r["__g"], 0)))
                seen[r["__g"]] = seen.get(r["__g"], 0) + r.n
            shift = F.broadcast(df.sparkSession.createDataFrame(before, "__p bigint, __g string, __before bigint").coalesce(1))
        else:
            earlier = F.sum("n").over(W.partitionBy("__g").orderBy("__p").rowsBetween(W.unboundedPreceding, -1))
            shift = cut(counts).select("__p", "__g", F.coalesce(earlier, F.lit(0)).alias("__before"))
        placed = placed.join(shift, (part == F.col("__p")) & (F.col(f"__of_{n}") == F.col("__g"))).withColumn(n, F.col(n) + F.col("__before")).drop("__p", "__g", "__before")
    return placed.drop("__id", *[f"__of_{n}" for n in names])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, recursive: bool = False) -> DataFrame:
    """Rows of JSON Lines with a declared schema; blank lines are skipped. With `recursive`, all *.jsonl below a folder; none is an error."""
    reader = spark.read.schema(schema)
    if not recursive:
        return reader.json(path)
    if not any(Path(path).rglob("*.jsonl")):
        raise FileNotFoundError(f"no *.jsonl below {path}")
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(path)


#: Bytes of a file that one task reads.
CHUNK = 1 << 25


def read_lines(spark: SparkSession, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """(offset, value) of the lines of a file that begin at byte `start` or later and before `stop`."""
    return read_segments(spark, [(path, start, stop)]).drop("path")


def read_segments(spark: SparkSession, segments: list[tuple[str, int, int | None]]) -> DataFrame:
    """(path, offset, value) of the lines that begin in the byte ranges [start, stop) of files; stop None is the end of the file.

    Ranges are cut into chunks of CHUNK bytes, which tasks read side by side; a line that begins in a chunk is read to its end.
    """
    parts = []
    for path, start, stop in segments:
        size = files.info(path).size
        if size is None:
            raise FileNotFoundError(path)
        stop = size if stop is None else min(stop, size)
        parts += [(path, a, min(a + CHUNK, stop)) for a in range(start, stop, CHUNK)]
    if not parts:
        return spark.createDataFrame([], "path string, offset bigint, value string")

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            for path, a, e in zip(b["path"], b["a"], b["e"], strict=True):
                out = []
                with files.open_bytes(path) as f:
                    f.seek(max(0, a - 1))
                    if a and f.read(1) != b"\n":
                        f.readline()
                    while (at := f.tell()) < e and (line := f.readline()):
                        out.append((path, at, line.rstrip(b"\r\n").decode("utf-8")))
                yield pd.DataFrame(out, columns=["path", "offset", "value"])

    chunks = spark.createDataFrame(parts, "path string, a bigint, e bigint").repartition(min(len(parts), 4096))
    return chunks.mapInPandas(run, "path string, offset bigint, value string")


def read_catalog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(canonical_name, output_rows) of a catalog file; names that are null and counts that aren't positive are left out."""
    entries = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("datasets").alias("d"))
    return catalog_rows(entries.select("d.canonical_name", "d.stats"))


def catalog_rows(entries: DataFrame) -> DataFrame:
    return entries.select("canonical_name", F.col("stats.output_rows").alias("output_rows")).where("canonical_name IS NOT NULL AND output_rows > 0")


def line_index(spark: SparkSession, path: str, index_dir: str) -> tuple[str, int]:
    """(folder of the index, rows) of a JSON Lines file: a table (row_index, offset) of its lines that aren't blank.

    The name holds a hash of path, size and time of the file, so it is made anew when they change, and only then. Tasks find
    the offsets chunk by chunk; a folder counts when its writer has committed it.
    """
    stat = files.info(path)
    if stat.size is None:
        raise FileNotFoundError(path)
    key = hashlib.sha256(f"{path}:{stat.size}:{stat.mtime_ns}".encode()).hexdigest()[:24]
    target = f"{index_dir.rstrip('/')}/{key}"
    if not files.exists(f"{target}/_SUCCESS"):
        lines = read_lines(spark, path).where("trim(value) <> ''").select("offset")
        with_row_index(lines, "offset").select("row_index", "offset").write.mode("overwrite").parquet(target)
    return target, spark.read.parquet(target).count()


def rows_at(spark: SparkSession, path: str, index_dir: str, refs: DataFrame) -> DataFrame:
    """`refs` (row_index and others) with the `value` of that line of a JSON Lines file; refs to lines it hasn't drop out.

    Offsets come from the file's line index; refs are sorted by offset over ranges, so a task opens the file once and reads on.
    """
    index, _ = line_index(spark, path, index_dir)
    wanted = refs.join(spark.read.parquet(index), "row_index").repartitionByRange("offset").sortWithinPartitions("offset")

    def run(batches):  # noqa: ANN001, ANN202
        f = None
        for b in batches:
            f = f or files.open_bytes(path)
            values = []
            for at in b["offset"]:
                f.seek(at)
                values.append(f.readline().rstrip(b"\r\n").decode("utf-8"))
            yield b.drop(columns="offset").assign(value=values)

    fields = [f for f in wanted.schema.fields if f.name != "offset"]
    return wanted.mapInPandas(run, T.StructType([*fields, T.StructField("value", T.StringType())]))


def footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, row_group, rows, ordinal) of the row groups of Parquet files or folders, in the order of the paths, then of file names.

    Tasks read the files' footers, no data. `ordinal` counts the row groups of all files.
    """
    found = [(i, f) for i, path in enumerate(paths) for f in sorted(spark.read.parquet(path).inputFiles())]

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            out = []
            for i, path in zip(b["i"], b["path"], strict=True):
                with files.open_bytes(unquote(path)) as f:
                    meta = pq.ParquetFile(f).metadata
                    out += [(i, path, g, meta.row_group(g).num_rows) for g in range(meta.num_row_groups)]
            yield pd.DataFrame(out, columns=["i", "path", "row_group", "rows"])

    listed = spark.createDataFrame(found, "i int, path string").repartition(min(max(1, len(found)), 4096))
    groups = with_row_index(listed.mapInPandas(run, "i int, path string, row_group int, rows bigint"), "i", "path", "row_group", name="ordinal")
    return groups.select(F.col("path").alias("file"), "row_group", "rows", "ordinal")


def chunks_of(groups: DataFrame, first: int = 0) -> DataFrame:
    """(file, rows, chunk_id) of the files of `footers`: numbered from `first` in the order of their last path parts, then of their paths."""
    each = groups.groupBy("file").agg(F.sum("rows").alias("rows")).withColumn("_name", F.regexp_extract("file", "([^/]*)$", 1))
    return with_row_index(each, "_name", "file", name="chunk_id").select("file", "rows", (F.col("chunk_id") + first).alias("chunk_id"))


def row_addresses(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The columns of a Parquet table with `row_index`, the place of each row in its files taken in the order of their names.

    The place in a file comes from the scan, the rows of earlier files from the footers: no row is moved or sorted. The rows
    of each file go to the driver, at most FILES of them.
    """
    df = spark.read.parquet(path)
    rows = df.select(*columns, F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("row_index"))
    if len(df.inputFiles()) < 2:
        return rows.drop("__file")
    # A scan and a listing write `file:/` with one slash or three.
    plain = lambda c: F.regexp_replace(c, "^([A-Za-z0-9+.-]+):/+", "$1:/")
    starts, at = [], 0
    for r in sorted(small_rows(footers(spark, [path]).groupBy("file").agg(F.sum("rows").alias("rows")), FILES)):
        starts.append((r.file, at))
        at += r.rows
    start = spark.createDataFrame(starts, "__file string, __start bigint").coalesce(1).withColumn("__file", plain("__file"))
    return rows.withColumn("__file", plain("__file")).join(F.broadcast(start), "__file").withColumn("row_index", F.col("row_index") + F.col("__start")).drop("__file", "__start")
