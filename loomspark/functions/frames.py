"""Image paths as exporters write them, reduced to the frame they name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.session import small_rows

#: Fixed pattern: a frame of a recording, in a path in normal form.
FRAME = r"chunk_0*(\d+)/row_0*(\d+)/0*(\d+)(?:\.[a-z0-9]+)?$"
#: The same in a path as it is written, for the spellings that need no normal form.
RAW_FRAME = r"(?i)^.*\bchunk_0*(\d+)(?:/|\\|%2f|%5c)+row_0*(\d+)(?:/|\\|%2f|%5c)+0*(\d+)\.[a-z0-9]+(?:[?#].*)?\s*$"
SHARED_FOLDER = r"(?:^|/)(images/common/[^/]+?)(?:\.[a-z0-9]+)?$"


def plain_path(path: Column) -> Column:
    """Lower case, `/` between parts, without query, doubled separators, `.` and `..`; null for null and blank."""
    p = F.lower(F.regexp_replace(path, r"^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$", ""))
    for code, char in (("%2f", "/"), ("%5c", "/"), ("%20", " "), ("\\", "/")):
        p = F.replace(p, F.lit(code), F.lit(char))
    p = F.regexp_replace(p, r"[?#].*$", "")
    p = F.regexp_replace(p, r"/(?:\./|/)+", "/")
    for _ in range(3):
        p = F.regexp_replace(p, r"(^|/)(?!\.\./)[^/]+/\.\./", "$1")
    return F.nullif(F.regexp_replace(p, r"^(?:\./)+", ""), F.lit(""))


def frame_key(path: Column) -> Column:
    """`chunk/row/frame` as numbers without leading zeros; `common` paths and others keep their plain path without ending.

    Null for null and blank paths.
    """
    return F.when(path.isNotNull(), F.element_at(F.transform(F.array(path), _quick), 1)["k"])


def _quick(path: Column) -> Column:
    """A struct of `k`: the numbers by one pattern where the path is in one of the usual spellings, else by its normal form.

    The numbers are bound to a lambda's variable, so the pattern is tried once for each path, however often they are read.
    """
    one = F.array(F.regexp_replace(path, RAW_FRAME, "$1/$2/$3"))
    return F.element_at(F.transform(one, lambda q: F.struct(F.when(F.substr(q, F.lit(1), F.lit(1)).between("0", "9") & q.rlike(r"^\d+/\d+/\d+$"), q).otherwise(_slow_key(plain_path(path))).alias("k"))), 1)


def _slow_key(path: Column) -> Column:
    return F.element_at(F.transform(F.array(path), _key_of_plain), 1)


def _key_of_plain(p: Column) -> Column:
    inside = F.regexp_extract(p, FRAME, 1)
    common = F.regexp_extract(p, SHARED_FOLDER, 1)
    return (
        F.when(inside != "", F.concat_ws("/", inside, F.regexp_extract(p, FRAME, 2), F.regexp_extract(p, FRAME, 3)))
        .when(common != "", common)
        .otherwise(F.regexp_replace(p, r"\.[a-z0-9]+$", ""))
    )


def frame_keys(images: Column) -> Column:
    """The distinct frame keys of a list of paths; empty for a null list."""
    keys = F.transform(F.filter(images, lambda p: p.isNotNull()), lambda p: _quick(p)["k"])
    return F.coalesce(F.array_distinct(F.filter(keys, lambda k: k.isNotNull())), F.expr("CAST(array() AS ARRAY<STRING>)"))


def shared_keys(shared_frames: DataFrame) -> list[str]:
    """Frame keys of the small table `shared_frames` (column path)."""
    rows = small_rows(shared_frames.select(frame_key(F.col("path")).alias("k")).where("k IS NOT NULL").distinct())
    return sorted(r.k for r in rows)


def own_frames(images: Column, shared: list[str]) -> Column:
    """The distinct frame keys of a list of paths without the shared ones."""
    keys = frame_keys(images)
    return F.array_except(keys, F.array(*[F.lit(k) for k in shared])) if shared else keys


def recordings(frames: Column) -> Column:
    """The distinct `chunk/row` of frame keys that name a recording."""
    inside = F.filter(frames, lambda k: k.rlike(r"^\d+/\d+/\d+$"))
    return F.array_distinct(F.transform(inside, lambda k: F.substring_index(k, "/", 2)))
