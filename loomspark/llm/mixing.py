"""Problem 6: a mixture of sources with target weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.bpe import DEFAULT_TOKENIZER
from loomspark.llm.tokens import bpe_counter, with_tokens
from loomspark.session import cut, small_rows


def source_key(source: Column) -> Column:
    """Lower case without outer white space; null for null and blank."""
    return F.nullif(F.lower(F.regexp_replace(source, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")), F.lit(""))


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the columns only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def draw_rates(sources: dict[str, tuple[float, float, int]], size: int, fill: bool = True) -> dict[str, float]:
    """How often each source {name: (weight, max_passes, tokens)} is used for a mixture of so many tokens; see `mix_sources`."""
    rates = {n: min(cap, w * size / t) if t else 0.0 for n, (w, cap, t) in sources.items()}
    while fill:
        left = size - sum(rates[n] * t for n, (_, _, t) in sources.items())
        able = {n: w for n, (w, cap, t) in sources.items() if t and w > 0 and rates[n] < cap}
        if left <= 1e-9 * size or not able:
            break
        whole = sum(able.values())
        for n, w in able.items():
            rates[n] = min(sources[n][1], rates[n] + w / whole * left / sources[n][2])
    return rates


@dataclass
class Mixture:
    rows: DataFrame
    shares: DataFrame


def mix_sources(documents: DataFrame, targets: DataFrame, seed: int = 42, fill: bool = True, path: str = DEFAULT_TOKENIZER, id_col: str = "doc_id") -> Mixture:
    """Draw documents so that each source of `targets` (source, weight, max_passes) gets its weight of all documents' tokens.

    A source's rate is weight * all tokens / its tokens, at most max_passes; each of its documents comes out floor(rate)
    times and once more with the rate's fraction as probability, decided by a hash of seed and id. What a capped or
    absent source leaves open the others share by their weights, until the mixture is as large as all documents or all
    sources are capped, so the others have more than their weight. Without `fill` it stays open: every source keeps its
    weight of the wanted size, and the mixture is smaller.
    Sources are compared by `source_key`; documents of a null or unlisted source aren't drawn but count for the size.
    A target with a null or negative weight or cap draws nothing; of a source listed twice the weights are added and the
    larger cap holds. Documents without tokens come out by the same rule. Rows with the same id and source are drawn
    alike. Empty documents or targets give empty rows.

    rows: doc id, source, pass (from 1), tokens. shares: one row for each target, with its tokens, rate and reached share.
    The texts are read once; sources are totalled by partial aggregates and the rates (a row for each target, a small
    table by `small_rows`) are broadcast, so a source of any size is never moved.
    """
    counted = cut(with_tokens(documents, [F.col(id_col).alias("doc_id"), source_key(F.col("source")).alias("source")], F.col("text"), bpe_counter(path)))
    wanted = (
        targets.select(source_key(F.col("source")).alias("source"), F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"), F.greatest(F.coalesce("max_passes", F.lit(0.0)), F.lit(0.0)).alias("max_passes"))
        .where("source IS NOT NULL").groupBy("source").agg(F.sum("weight").alias("weight"), F.max("max_passes").alias("max_passes"))
    )
    spark = documents.sparkSession
    names = [(r.source, r.weight, r.max_passes) for r in small_rows(wanted)]
    wanted = spark.createDataFrame(names, "source string, weight double, max_passes double").coalesce(1)
    size = counted.agg(F.sum("tokens")).first()[0] or 0
    have = counted.join(F.broadcast(wanted), "source", "left_semi").groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    found = small_rows(wanted.join(have, "source", "left"))
    often = draw_rates({r.source: (r.weight, r.max_passes, r.tokens or 0) for r in found}, size, fill)
    rates = [(r.source, r.weight, r.max_passes, r.documents or 0, r.tokens or 0, often[r.source]) for r in found]
    rate = spark.createDataFrame(rates, "source string, weight double, max_passes double, documents bigint, source_tokens bigint, rate double").coalesce(1)
    drawn = counted.join(F.broadcast(rate.select("source", "rate")), "source").select(
        "doc_id", "source", "tokens", (F.floor("rate") + (uniform(seed, F.col("source"), F.col("doc_id")) < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies")
    )
    rows = drawn.where("copies > 0").select("doc_id", "source", F.explode(F.sequence(F.lit(1), "copies")).alias("pass"), "tokens")
    got = cut(drawn.groupBy("source").agg(F.sum("copies").alias("drawn_documents"), F.sum(F.col("copies") * F.col("tokens")).alias("drawn_tokens")))
    all_drawn = got.agg(F.sum("drawn_tokens")).first()[0]
    shares = (
        rate.join(F.broadcast(got), "source", "left")
        .select(
            "source", "weight", "max_passes", "documents", "source_tokens", "rate",
            (F.col("rate") >= F.col("max_passes")).alias("capped"),
            F.lit(size).cast("bigint").alias("wanted_size"),
            F.coalesce("drawn_documents", F.lit(0)).alias("drawn_documents"),
            F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"),
            (F.coalesce("drawn_tokens", F.lit(0)) / F.nullif(F.lit(size), F.lit(0))).alias("share_of_wanted"),
            (F.coalesce("drawn_tokens", F.lit(0)) / F.nullif(F.lit(all_drawn), F.lit(0))).alias("share_of_drawn"),
        )
    )
    return Mixture(rows, shares)
