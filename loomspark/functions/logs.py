"""Training logs: steps, series, counters, and the warm-up of a rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def step_of(iteration: Column, *others: Column) -> Column:
    """k of `k/N` or `k`; else the first other column that is neither null nor 0."""
    parsed = F.split_part(iteration, F.lit("/"), F.lit(1)).try_cast("bigint")
    return F.coalesce(parsed, *[F.nullif(c.cast("bigint"), F.lit(0)) for c in others])


def warm_up(step: Column, start: float, top: float, steps: int) -> Column:
    """A rate that rises in a line from start to top over so many steps."""
    return F.when(step >= steps, F.lit(top)).otherwise(F.lit(start) + (F.lit(top) - F.lit(start)) * step / F.lit(float(steps)))


def trailing_mean(value: Column, by: list[Column], order: list[Column], rows: int = 21) -> Column:
    """The mean of a row and the rows before it, `rows` in all."""
    return F.avg(value).over(W.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, 0))


def counters(log: DataFrame, keys: list[str], prefix: str = "trained_tokens_") -> DataFrame:
    """Long form of the counter columns: keys, channel, tokens; nulls left out."""
    names = [c for c in log.columns if c.startswith(prefix)]
    long = log.select(*keys, *names).unpivot(keys, names, "channel", "tokens")
    return long.where("tokens IS NOT NULL").withColumn("channel", F.substr("channel", F.lit(len(prefix) + 1)))


def numeric_pairs(log: DataFrame, keys: list[str], prefix: str = "train/") -> DataFrame:
    """Long form of all numeric columns that aren't keys: (keys, name with prefix, value as double), without nulls and NaN."""
    numeric = [f.name for f in log.schema.fields if f.dataType.typeName() in ("long", "integer", "double", "float", "short", "byte", "decimal") and f.name not in keys]
    long = log.select(*keys, *[F.col(c).cast("double").alias(c) for c in numeric]).unpivot(keys, numeric, "name", "value")
    return long.where("value IS NOT NULL AND NOT isnan(value)").withColumn("name", F.concat(F.lit(prefix), "name"))
