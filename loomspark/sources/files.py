"""Files on local disks and shared stores alike, by path or URI."""

from __future__ import annotations

import fnmatch
import io
import os
import uuid

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it; a path without a scheme lies on the local disk."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def open_bytes(path: str) -> io.BufferedReader:
    """A file for reading, with seek and readline; FileNotFoundError where there is none."""
    fs, inner = located(path)
    return io.BufferedReader(fs.open_input_file(inner), 1 << 20)


def info(path: str) -> pafs.FileInfo:
    fs, inner = located(path)
    return fs.get_file_info(inner)


def exists(path: str) -> bool:
    return info(path).type != pafs.FileType.NotFound


def read_whole(path: str) -> bytes:
    with open_bytes(path) as f:
        return f.read()


def write_whole(path: str, data: bytes) -> None:
    """Write a file whole or not at all: under a name of its own first, then moved to its place."""
    fs, inner = located(path)
    fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    part = f"{inner}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(part) as f:
        f.write(data)
    fs.move(part, inner)


def snapshot(spark: SparkSession, source: str, target: str, allow: list[str]) -> DataFrame:
    """Copy the files below `source` whose path there fits one of the patterns in `allow` (as in a shell, `*` also crosses folders) to `target`.

    Returns (path, size, copied) of the files that fit; one that `target` has in the same size isn't copied again. The driver
    lists names, tasks copy, each file whole or not at all. A source without a fitting file is an error.
    """
    fs, root = located(source)
    listed = [f for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if f.type == pafs.FileType.File]
    names = [(f.path[len(root.rstrip("/")) + 1 :], f.size) for f in listed]
    wanted = sorted(x for x in names if any(fnmatch.fnmatchcase(x[0], a) for a in allow))
    if not wanted:
        raise FileNotFoundError(f"nothing below {source} fits {', '.join(allow)}")

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            out = []
            for path, size in zip(b["path"], b["size"], strict=True):
                to, there = located(f"{target.rstrip('/')}/{path}")
                fresh = to.get_file_info(there).size != size
                if fresh:
                    to.create_dir(there.rsplit("/", 1)[0], recursive=True)
                    part = f"{there}.{uuid.uuid4().hex}.tmp"
                    with open_bytes(f"{source.rstrip('/')}/{path}") as f, to.open_output_stream(part) as g:
                        while block := f.read(1 << 23):
                            g.write(block)
                    to.move(part, there)
                out.append((path, size, fresh))
            yield pd.DataFrame(out, columns=["path", "size", "copied"])

    files = spark.createDataFrame(wanted, "path string, size bigint").repartition(min(len(wanted), 4096))
    return files.mapInPandas(run, "path string, size bigint, copied boolean")
