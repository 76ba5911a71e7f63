"""Order and seeds by SHA-256: the same on every engine and for any partitioning."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int, *columns: Column) -> Column:
    """The hash that puts rows in a seeded random order."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns]), 256)


def seed64(base: int, name: str, index: int) -> int:
    """First 8 bytes of the SHA-256 of `base:name:index`, big-endian."""
    return int.from_bytes(hashlib.sha256(f"{base}:{name}:{index}".encode()).digest()[:8], "big")


def seed64_column(base: int, name: Column, index: Column) -> Column:
    """The same as a decimal column."""
    text = F.concat_ws(":", F.lit(str(base)), name, index.cast("string"))
    return F.conv(F.substr(F.sha2(text, 256), F.lit(1), F.lit(16)), 16, 10).cast("decimal(20,0)")


def digest(value: object) -> str:
    """SHA-256 of the compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
