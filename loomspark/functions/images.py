"""Sizes of images from the heads of their files, and the tokens they take."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The patch edge, patches merged along an edge, and the pixel bounds of the vision encoder's resizing rule.
PATCH, MERGE, MIN_PIXELS, MAX_PIXELS = 16, 2, 4 * 28 * 28, 16384 * 28 * 28
#: Fixed values of the file formats: the start-of-frame markers of JPEG.
FRAME_MARKERS = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}


#: Bytes of a file's head that are looked at first.
HEAD = 1 << 12
MORE = "more"


def image_size(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) from the head of a JPEG or PNG file; None for anything else, cut heads and sizes of 0."""
    found = _size_in(data)
    return found if isinstance(found, tuple) else None


def _size_in(data: bytes | None) -> tuple[int, int] | str | None:
    """The same, and MORE where the bytes end before the size."""
    if not data:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR" and len(data) >= 24:
        w, h = int.from_bytes(data[16:20], "big"), int.from_bytes(data[20:24], "big")
        return (w, h) if w and h else None
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker == 0x01 or 0xD0 <= marker <= 0xD8:
            at += 2
        elif marker in FRAME_MARKERS:
            h, w = int.from_bytes(data[at + 5 : at + 7], "big"), int.from_bytes(data[at + 7 : at + 9], "big")
            return (w, h) if w and h else None
        else:
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return MORE


def image_tokens(width: Column, height: Column) -> Column:
    """Tokens of an image: both edges rounded (half to even) to whole cells, scaled where the area is out of bounds; null for unknown or non-positive sizes."""
    cell = PATCH * MERGE
    w, h = width.cast("double"), height.cast("double")
    area = F.greatest(F.lit(1.0), F.rint(w / cell)) * F.greatest(F.lit(1.0), F.rint(h / cell)) * cell * cell
    shrink, grow = F.sqrt(w * h / MAX_PIXELS), F.sqrt(F.lit(float(MIN_PIXELS)) / (w * h))
    cells = (
        F.when(area > MAX_PIXELS, F.greatest(F.lit(1.0), F.floor(w / shrink / cell)) * F.greatest(F.lit(1.0), F.floor(h / shrink / cell)))
        .when(area < MIN_PIXELS, F.ceil(w * grow / cell) * F.ceil(h * grow / cell))
        .otherwise(area / (cell * cell))
    )
    return F.when((w > 0) & (h > 0), cells.cast("bigint"))


def image_tokens_np(width: np.ndarray, height: np.ndarray) -> np.ndarray:
    """The same for arrays of positive sizes."""
    cell = PATCH * MERGE
    w, h = width.astype(float), height.astype(float)
    area = np.maximum(1, np.rint(w / cell)) * np.maximum(1, np.rint(h / cell)) * cell * cell
    shrink, grow = np.sqrt(w * h / MAX_PIXELS), np.sqrt(MIN_PIXELS / (w * h))
    small = np.ceil(w * grow / cell) * np.ceil(h * grow / cell)
    large = np.maximum(1, np.floor(w / shrink / cell)) * np.maximum(1, np.floor(h / shrink / cell))
    return np.where(area > MAX_PIXELS, large, np.where(area < MIN_PIXELS, small, area / cell / cell)).astype(np.int64)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _sizes(heads: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """`WxH` of each of a list of files, MORE where it ends too early, null where it can't be read."""

    def one(data: bytes | None) -> str | None:
        found = _size_in(data)
        return f"{found[0]}x{found[1]}" if isinstance(found, tuple) else found

    for s in heads:
        yield s.map(lambda row: None if row is None else [one(x) for x in row])


def image_sizes(files: Column) -> Column:
    """`WxH` of each of a list of image files, null where it can't be read; null for a null list.

    Only the first HEAD bytes of a file go to Python; a file whose size lies further on goes whole, in a second look.
    """
    first = _sizes(F.transform(files, lambda x: F.substring(x, 1, HEAD)))
    rest = F.zip_with(files, first, lambda x, a: F.when((a == MORE) & (F.octet_length(x) > HEAD), x))
    second = _sizes(F.when(F.exists(rest, lambda x: x.isNotNull()), rest))
    return F.zip_with(first, F.coalesce(second, first), lambda a, b: F.nullif(F.when(a == MORE, b).otherwise(a), F.lit(MORE)))
