"""Paths as strings: nothing is looked up in a file system."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    """The last part, trailing slashes left aside."""
    return F.regexp_replace(F.regexp_replace(path, r"/+$", ""), r"^.*/", "")


def absolute(path: Column, base: str | Column) -> Column:
    """The path under a base, unless it is absolute; `.` parts and doubled slashes go, `..` stay for `normal`. Null for null."""
    base = F.lit(base) if isinstance(base, str) else base
    joined = F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_replace(base, r"/+$", ""), F.lit("/"), path))
    return F.regexp_replace(F.regexp_replace(joined, r"/(?:\./)+", "/"), r"/{2,}", "/")


def parts(path: Column) -> Column:
    """The parts of a path without empty ones and `.`, each `..` taken back with the part before it; at the root it is dropped, in front of a relative path it stays."""

    def step(done: Column, part: Column) -> Column:
        back = (F.size(done) > 0) & (F.coalesce(F.element_at(done, F.when(F.size(done) > 0, F.size(done)).otherwise(1)), F.lit("..")) != "..")
        return (
            F.when((part == "") | (part == "."), done)
            .when((part == "..") & back, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when((part == "..") & path.startswith("/"), done)
            .otherwise(F.concat(done, F.array(part)))
        )

    pieces = F.split(path, "/")
    return F.when(path.isNotNull(), F.aggregate(pieces, F.expr("CAST(array() AS ARRAY<STRING>)"), step))


def _joined(path: Column, inner: Column) -> Column:
    text = F.concat(F.when(path.startswith("/"), "/").otherwise(""), F.array_join(inner, "/"))
    return F.when(text == "", ".").otherwise(text)


def normal(path: Column) -> Column:
    """The normal form of a path: no empty parts, no `.`, and `..` taken back; `.` for an empty one, null for null."""
    return F.when(path.isNotNull(), _joined(path, parts(path)))


def relative(path: Column, base: str | Column) -> Column:
    """The path from a base to it, both normal and of one kind (absolute or not): a `..` for each part of the base that isn't shared, then the rest; `.` for the base itself."""
    base = F.lit(base) if isinstance(base, str) else base
    pair = F.array(F.struct(parts(path).alias("p"), parts(base).alias("b")))

    def way(x: Column) -> Column:
        same = F.transform(F.arrays_zip(x["p"], x["b"]), lambda z: F.coalesce(z["p"] == z["b"], F.lit(False)))
        k = F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)) - 1, F.size(same)).cast("int")
        out = F.array_join(F.concat(F.array_repeat(F.lit(".."), F.size(x["b"]) - k), F.slice(x["p"], k + 1, F.greatest(F.size(x["p"]) - k, F.lit(0)))), "/")
        return F.when(out == "", ".").otherwise(out)

    return F.when(path.isNotNull() & base.isNotNull(), F.element_at(F.transform(pair, way), 1))


def channel_of_source(channel: Column, dataset: Column, joined: list[str], name: str) -> Column:
    """The channel where it isn't empty, else the dataset's last path part, where names that contain one of `joined` become `name`."""
    source = basename(F.coalesce(F.nullif(dataset, F.lit("")), F.lit("unknown")))
    named = F.when(F.lower(source).rlike("|".join(joined)), F.lit(name)).otherwise(source) if joined else source
    return F.coalesce(F.nullif(channel, F.lit("")), named)
