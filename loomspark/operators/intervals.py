"""Lookup of positions in intervals, without a range join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.operators.graph import small_broadcast


def locate(points: DataFrame, at: str, intervals: DataFrame, start: str, size: str) -> DataFrame:
    """Each point with the columns of the intervals [start, start + size) it lies in; points in none drop out.

    Both sides meet in buckets as wide as an interval is on average, so an interval lies in two or three of them and the
    join is on equality, by broadcast where the intervals are few. Null positions and intervals without a size match nothing.
    """
    s = intervals.where(F.col(size) > 0)
    mean = s.agg(F.avg(size)).first()[0]
    width = max(1, round(mean or 1))
    cut_in = s.withColumn("__bucket", F.explode(F.sequence(F.expr(f"`{start}` div {width}"), F.expr(f"(`{start}` + `{size}` - 1) div {width}"))))
    cut_in = small_broadcast(cut_in)
    p = points.withColumn("__bucket", F.expr(f"`{at}` div {width}"))
    inside = (F.col(at) >= F.col(start)) & (F.col(at) < F.col(start) + F.col(size))
    return p.join(cut_in, "__bucket").where(inside).drop("__bucket")
