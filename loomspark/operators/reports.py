"""Reports: counts by channel and shard, token totals, format and action scores, idle steps, checks that return violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions import actions as A


def share(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def counts_with_total(df: DataFrame, by: str) -> DataFrame:
    """Rows of each value (null as 'unknown') and of all together (null)."""
    value = F.coalesce(F.col(by), F.lit("unknown"))
    return df.select(value.alias(by)).rollup(by).agg(F.count("*").alias("rows"))


def token_totals(df: DataFrame, by: list[str], text: Column, visual: Column, most: int) -> DataFrame:
    """Rows and tokens by group: of all rows, and apart of those that fit and those that don't."""
    tokens = text + visual
    t = df.select(*by, text.alias("text_n"), visual.alias("visual_n"), tokens.alias("n"))
    fits = F.col("n") <= most
    total = lambda c, when=None: F.coalesce(F.sum(F.col(c) if when is None else F.when(when, F.col(c))), F.lit(0))
    return t.groupBy(*by).agg(
        F.count("*").alias("rows"), total("n").alias("tokens"), total("visual_n").alias("visual_tokens"), total("text_n").alias("text_tokens"), F.count_if(fits).alias("train_rows"),
        total("n", fits).alias("train_tokens"), F.count_if(~fits).alias("overlength_rows"), total("n", ~fits).alias("overlength_tokens"), F.max("n").alias("longest"),
    )


def format_summary(df: DataFrame, pred: str = "pred", gt: str = "gt") -> DataFrame:
    """Shares of predictions with each property, and the mean edit distance; null predictions count as errors."""
    s = df.select(F.col(pred).alias("p"), *A.scores(F.col(pred), F.col(gt)))
    flags = ["contains_start", "contains_end", "well_formed", "parses_xyz", "has_action_sep", "exact_match"]
    n = F.count("p")
    return s.agg(n.alias("n"), F.count_if(F.col("p").isNull()).alias("errors"), *[F.count_if(f).alias(f) for f in flags], F.round(F.avg("edit_distance"), 6).alias("mean_edit_distance"))


def action_sums(df: DataFrame) -> list[Column]:
    """Sums over rows with pred_mag and gt_mag, null where either doesn't parse."""
    both = F.col("pred_mag").isNotNull() & F.col("gt_mag").isNotNull()
    still, moved = both & (F.col("pred_mag") == 0), both & (F.col("gt_mag") > A.MOVED)
    return [
        F.count("*").alias("n"), F.count_if(both).alias("pairs"), F.coalesce(F.sum(F.when(both, F.col("pred_mag"))), F.lit(0)).alias("pred_sum"),
        F.coalesce(F.sum(F.when(both, F.col("gt_mag"))), F.lit(0)).alias("gt_sum"), F.count_if(still).alias("pred_still"), F.count_if(moved).alias("gt_moved"), F.count_if(moved & still).alias("moved_still"),
    ]


def action_summary(sums: DataFrame, live: bool) -> DataFrame:
    """Means and shares of action sums: the live report divides by all rows, the other by rows where both sides parse; empty groups divide by 1."""
    per = F.greatest(F.col("n" if live else "pairs"), F.lit(1))
    r = lambda c: F.round(c, 6)
    return sums.withColumns({
        "pred_mean": r(F.col("pred_sum") / per), "gt_mean": r(F.col("gt_sum") / per), "ratio": r(F.col("pred_sum") / F.greatest("gt_sum", F.lit(1))),
        "still_share": r(F.col("pred_still") / per), "moved_still_share": r(F.col("moved_still") / F.greatest("gt_moved", F.lit(1))),
    })


def idle_profile(answers: DataFrame, text: str = "content") -> DataFrame:
    """Actions of the single form: without mouse movement with and without keys, and with movement, in counts and percent. Null percents for no actions."""
    a = answers.select(A.single_parts(F.col(text)).alias("m"))
    x, y = (F.col("m")[k].try_cast("int") for k in (0, 1))
    zero, key, step = (x == 0) & (y == 0), A.key_in(F.col("m")[3]), F.col("m").isNotNull()
    s = a.agg(F.count("m").alias("steps"), F.count_if(step & zero).alias("zero"), F.count_if(step & zero & key).alias("zero_key"), F.count_if(step & zero & ~key).alias("zero_empty"), F.count_if(step & ~zero).alias("moving"))
    pct = lambda a, b: F.round(F.lit(100.0) * F.col(a) / F.nullif(F.col(b), F.lit(0)), 4)
    return s.withColumns({"zero_pct": pct("zero", "steps"), "key_of_zero_pct": pct("zero_key", "zero"), "empty_of_zero_pct": pct("zero_empty", "zero"), "moving_pct": pct("moving", "steps")})


def violations(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """(check, violations) for data frames that hold the rows which break a rule."""
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations") for name, df in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def counted_against(union: DataFrame, whole: DataFrame) -> DataFrame:
    """One row: the lines of a union, those expected, and whether they agree."""
    both = union.select(F.lit(1).alias("l"), F.lit(0).alias("e")).unionAll(whole.select(F.lit(0), F.lit(1)))
    return both.agg(F.sum("l").alias("lines"), F.sum("e").alias("expected")).withColumn("ok", F.col("lines") == F.col("expected"))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to one place, halves up, by whole numbers; null where the whole is 0."""
    return F.when(whole > 0, F.floor((2000 * part + whole) / (2 * whole)) / 10)


def weighted_loss(batches: DataFrame, by: str, batch: list[str]) -> DataFrame:
    """By group: loss weighted by `weight`, the weights' sum, the batches, and how many rows were replays (equal in all columns of `batch`, which count once)."""
    b = batches.groupBy(by, *batch).agg(F.count("*").alias("copies"))
    return b.groupBy(by).agg(
        F.round(F.sum(F.col("loss") * F.col("weight")) / F.nullif(F.sum("weight"), F.lit(0)), 9).alias("loss"), F.sum("weight").alias("tokens"), F.count("*").alias("batches"), (F.sum("copies") - F.count("*")).alias("replayed")
    )
