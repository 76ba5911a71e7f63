"""Writers: JSON Lines, images of a row, replacements that are whole or not at all, and portable packages."""

from __future__ import annotations

import json
import os
import uuid
import zipfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.sources import files


def write_jsonl(df: DataFrame, path: str, mode: str = "error") -> None:
    """One object for each row, null fields kept, text unescaped; several files in a folder."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def replace_json(path: str, value: object) -> None:
    """A small value as a JSON file in place of what was there, whole or not at all, on any store."""
    files.write_whole(path, f"{json.dumps(value, ensure_ascii=False, indent=2)}\n".encode())


def write_stats(stats: DataFrame, path: str, *by: str) -> None:
    """Statistics as JSON files, a folder for each value of `by` (a reader, a shard); the folder's _SUCCESS file says that all are done."""
    stats.write.mode("overwrite").partitionBy(*by).option("ignoreNullFields", "false").json(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Overwrite the folder that `df` may itself be read from: the new table is written beside it, then takes its place, by renames of the table's own file system."""
    base = path.rstrip("/")
    fresh, old = f"{base}.{uuid.uuid4().hex}.new", f"{base}.{uuid.uuid4().hex}.old"
    df.write.parquet(fresh)
    spark = df.sparkSession
    at = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = at(base).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(at(base)):
        fs.rename(at(base), at(old))
    if not fs.rename(at(fresh), at(base)):
        raise OSError(f"{fresh} could not take the place of {base}")
    fs.delete(at(old), True)


def image_path(chunk: Column, row: Column, place: Column) -> Column:
    """`chunk_000/row_0000/00.jpg`."""
    return F.format_string("chunk_%03d/row_%04d/%02d.jpg", chunk.cast("int"), row.cast("int"), place.cast("int"))


def write_images(df: DataFrame, root: str) -> DataFrame:
    """Write the bytes of rows (path, bytes) below `root`, a path or URI, on the executors; returns (path, size) of what was written. Null bytes are skipped."""

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            b = b[b["bytes"].notna() & b["path"].notna()]
            for path, data in zip(b["path"], b["bytes"], strict=True):
                files.write_whole(f"{root.rstrip('/')}/{path}", data)
            yield b.assign(size=[len(x) for x in b["bytes"]])[["path", "size"]]

    return df.select("path", "bytes").mapInPandas(run, "path string, size bigint")


def missing_files(df: DataFrame, path: str, root: str) -> DataFrame:
    """The distinct values of the column `path` that name no file below `root`; null is no path. Tasks look, each for its share of the paths."""

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            yield b[[not files.exists(p if p.startswith("/") or "://" in p else f"{root.rstrip('/')}/{p}") for p in b[path]]]

    return df.select(path).where(F.col(path).isNotNull()).distinct().mapInPandas(run, f"`{path}` string")


def package(rows_jsonl: str, source_root: str, out_zip: str) -> int:
    """A stored ZIP of a small JSON Lines file with the images its rows name, with paths relative to `source_root`; returns the images packed. A missing image is an error."""
    seen: set[str] = set()
    lines = []
    with open(rows_jsonl, encoding="utf-8") as f:
        for line in filter(str.strip, f):
            row = json.loads(line)
            row["images"] = [os.path.relpath(os.path.join(source_root, p), source_root) for p in row.get("images") or []]
            seen.update(row["images"])
            lines.append(json.dumps(row, ensure_ascii=False))
    part = f"{out_zip}.{uuid.uuid4().hex}.tmp"
    with zipfile.ZipFile(part, "w", zipfile.ZIP_STORED) as z:
        z.writestr("rows.jsonl", "\n".join(lines) + "\n")
        for p in sorted(seen):
            z.write(os.path.join(source_root, p), p)
    os.replace(part, out_zip)
    return len(seen)
