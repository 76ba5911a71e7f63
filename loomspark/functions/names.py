"""Names of channels: spelling variants, aliases, and the channel a row belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.session import small_rows


def name_key(name: Column) -> Column:
    """Lower case without blanks, hyphens and underscores; null for null and for names with nothing left."""
    return F.nullif(F.regexp_replace(F.lower(name), r"[\s\p{Z}\p{Cf}_\-]+", ""), F.lit(""))


def channel_keys(channels: DataFrame) -> dict[str, str]:
    """Name key to listed channel, from the small table `channels`; a channel's own name wins over an alias.

    Raises ValueError when the table is larger than `small_rows` allows.
    """
    names = channels.select("channel", name_key(F.col("channel")).alias("k"), F.lit(0).alias("alias")).union(
        channels.select("channel", F.explode("aliases").alias("a")).select("channel", name_key(F.col("a")), F.lit(1))
    )
    out: dict[str, str] = {}
    for row in sorted(small_rows(names.where("k IS NOT NULL AND channel IS NOT NULL")), key=lambda r: (r.alias, r.channel)):
        out.setdefault(row.k, row.channel)
    return out


def literal_map(pairs: dict[str, object]) -> Column:
    """A constant map; an empty one for no pairs."""
    if not pairs:
        return F.expr("CAST(map() AS MAP<STRING, STRING>)")
    return F.create_map(*[F.lit(x) for pair in sorted(pairs.items()) for x in pair])


def known_game(keys: dict[str, str], channel: Column, game: Column) -> Column:
    """The listed channel that `channel` names, else the one that `game` names, else null."""
    names = literal_map(keys)
    return F.coalesce(F.try_element_at(names, F.coalesce(name_key(channel), F.lit(""))), F.try_element_at(names, F.coalesce(name_key(game), F.lit(""))))


def with_known_game(df: DataFrame, channels: DataFrame, out: str, channel: str = "channel", game: str = "game") -> DataFrame:
    """`df` with a column `out`: the listed channel that `channel` names, else the one that `game` names, else null.

    The names (a small table, see `channel_keys`) are broadcast and found by hash; for a literal map each row would search them one by one.
    """
    listed = sorted(channel_keys(channels).items())
    names = df.sparkSession.createDataFrame(listed, "__key string, __name string").coalesce(1)
    one = lambda i: F.broadcast(names.toDF(f"__key{i}", f"__name{i}"))
    keyed = df.withColumns({"__of0": name_key(F.col(channel)), "__of1": name_key(F.col(game))})
    both = keyed.join(one(0), F.col("__of0") == F.col("__key0"), "left").join(one(1), F.col("__of1") == F.col("__key1"), "left")
    return both.withColumn(out, F.coalesce("__name0", "__name1")).drop("__of0", "__of1", "__key0", "__key1", "__name0", "__name1")
