"""Mixtures of documents by source, shares of readers, packs and batches."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.functions.hashing import seed64_column
from loomspark.functions.logs import step_of
from loomspark.operators import packing, resume
from loomspark.operators.reports import violations
from loomspark.plans import mixture as M
from loomspark.session import cut, small_rows, table
from loomspark.sources.readers import footers, with_group_index, with_row_index
from loomspark.streaming.tail import channel_totals, continued_totals
from loomspark.workloads import query
from loomspark.workloads.etl import ORDERED, SEED

PASSES = ("3.0", "0.6", "2.3", "0.19")
SOURCES = "src AS (SELECT source AS dataset, count(*) AS size, row_number() OVER (ORDER BY source) - 1 AS ord FROM documents WHERE source IS NOT NULL GROUP BY source)"
PLAN = f"""{SOURCES}, w AS (SELECT *, CAST(CASE ord % 4 WHEN 0 THEN 3.0 WHEN 1 THEN 0.6 WHEN 2 THEN 2.3 ELSE 0.19 END AS DECIMAL(6, 2)) AS wished FROM src),
 p AS (SELECT dataset, ord, size, CASE WHEN round(CAST(size AS DECIMAL(18, 0)) * wished) = 0 THEN 1.0 ELSE wished END AS passes FROM w),
 plan AS (SELECT dataset, ord, size, passes, CAST(round(CAST(size AS DECIMAL(18, 0)) * passes) AS BIGINT) AS target FROM p),
 k AS (SELECT max((target + size - 1) // size) AS k FROM plan),
 quotas AS (SELECT ph AS phase, dataset, target * ph // k AS start, target * (ph + 1) // k - target * ph // k AS count FROM plan, k, range(k) r(ph) WHERE target * (ph + 1) // k > target * ph // k)"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents as rows (dataset, row_index) of their source."""
    docs = table(spark, d, "documents").where("source IS NOT NULL").select(F.col("source").alias("dataset"), "doc_id", "n_chars")
    return with_group_index(docs, ["dataset"], ["doc_id"])


def _plan(spark: SparkSession, d: str) -> M.Plan:
    sizes = {r.source: r.n for r in small_rows(table(spark, d, "documents").where("source IS NOT NULL").groupBy("source").agg(F.count("*").alias("n")))}
    passes = {n: PASSES[i % 4] for i, n in enumerate(sorted(sizes))}
    # A source too small for its passes to give a row is used whole.
    return M.make_plan({n: {"passes": p if M.quota(sizes[n], p) else "1"} for n, p in passes.items()}, sizes, SEED)


def _uses(spark: SparkSession, d: str) -> tuple[M.Plan, DataFrame]:
    plan = _plan(spark, d)
    return plan, M.in_phases(M.occurrences(_documents(spark, d), plan), plan)


@query(f"WITH {PLAN} SELECT dataset, size, target, target // size AS full_passes, target % size AS fractional FROM plan")
def m01_quotas(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).datasets_df(spark).select("dataset", "size", "target", "full_passes", "fractional")


@query(f"WITH {PLAN} SELECT CAST(phase AS INTEGER) AS phase, dataset, start, count FROM quotas")
def m02_phases(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).quotas_df(spark)


#: The bijection of each dataset's fractional pass, and the rows it selects, in order.
SEED64 = "('0x' || substr(sha256('{seed}:' || {name} || ':' || {index}), 1, 16))::UBIGINT"
AFFINE = f"""f AS (SELECT dataset, size, target // size AS full_passes, target % size AS fractional FROM plan),
 drawn AS (SELECT f.*, i, CAST({SEED64.format(seed=SEED, name="dataset || ':a' || i", index="full_passes")} % size::UBIGINT AS BIGINT) AS a FROM f, range(200) r(i) WHERE size > 1),
 affine AS (SELECT dataset, size, full_passes, fractional, arg_min(a, i) AS a, CAST({SEED64.format(seed=SEED, name="dataset || ':b'", index="full_passes")} % size::UBIGINT AS BIGINT) AS b FROM drawn WHERE gcd(a, size) = 1 GROUP BY ALL),
 selected AS (SELECT dataset, full_passes, size, CAST((a::HUGEINT * i + b) % size AS BIGINT) AS row_index FROM affine, range(fractional) r(i)),
 uses AS (SELECT dataset, p AS pass, p * size + o AS occurrence, o AS row_index FROM f, range(full_passes) x(p), range(size) r(o)
  UNION ALL SELECT dataset, full_passes, full_passes * size + row_number() OVER (PARTITION BY dataset ORDER BY row_index) - 1, row_index FROM selected)"""


@query(f"WITH {PLAN}, {AFFINE} SELECT dataset, row_index FROM selected")
def m03_fractional_pass(spark: SparkSession, d: str) -> DataFrame:
    plan, uses = _uses(spark, d)
    full = F.broadcast(plan.datasets_df(spark).select("dataset", "full_passes"))
    return uses.join(full, "dataset").where("pass = full_passes").select("dataset", "row_index")


@query(f"WITH {PLAN}, {AFFINE} SELECT dataset, size, a, b, (SELECT min(x) FROM range(size) r(x) WHERE a::HUGEINT * x % size = 1) AS a_inv, CAST(gcd(a, size) AS BIGINT) AS divisor FROM affine")
def c18_inverse(spark: SparkSession, d: str) -> DataFrame:
    rows = [(x.name, x.size, x.a, x.b, x.a_inv, math.gcd(x.a, x.size)) for x in _plan(spark, d).datasets if x.size > 1]
    return spark.createDataFrame(rows, "dataset string, size bigint, a bigint, b bigint, a_inv bigint, divisor bigint").coalesce(1)


@query(f"WITH {PLAN} SELECT CAST(phase AS INTEGER) AS phase, dataset, count AS exposures, start AS first, start + count - 1 AS last FROM quotas")
def m04_phase_counts(spark: SparkSession, d: str) -> DataFrame:
    return _uses(spark, d)[1].groupBy("phase", "dataset").agg(F.count_distinct("occurrence").alias("exposures"), F.min("occurrence").alias("first"), F.max("occurrence").alias("last"))


@query(f"WITH {PLAN}, {AFFINE}, i AS (SELECT source AS dataset, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_index FROM documents) SELECT CAST(phase AS INTEGER) AS phase, dataset, count(*) AS exposures, CAST(sum(n_chars) AS BIGINT) AS chars FROM uses JOIN i USING (dataset, row_index) JOIN quotas q USING (dataset) WHERE occurrence >= q.start AND occurrence < q.start + q.count GROUP BY ALL")
def m04_phase_exposures(spark: SparkSession, d: str) -> DataFrame:
    """How many exposures and characters each source contributes in each phase: plan, selection, fetch, aggregate."""
    uses = _uses(spark, d)[1]
    return uses.join(_documents(spark, d), ["dataset", "row_index"]).groupBy("phase", "dataset").agg(F.count("*").alias("exposures"), F.sum("n_chars").alias("chars"))


@query(f"WITH {PLAN} SELECT dataset, size * (target // size) AS full_uses, target % size AS last_uses, CASE WHEN target >= size THEN size ELSE target END AS distinct_rows FROM plan")
def m04_coverage(spark: SparkSession, d: str) -> DataFrame:
    plan, uses = _uses(spark, d)
    full = F.broadcast(plan.datasets_df(spark).select("dataset", "full_passes"))
    return uses.join(full, "dataset").groupBy("dataset").agg(F.count_if(F.col("pass") < F.col("full_passes")).alias("full_uses"), F.count_if(F.col("pass") == F.col("full_passes")).alias("last_uses"), F.count_distinct("row_index").alias("distinct_rows"))


RANKS = "ranks AS (SELECT dataset, r AS rank, size * (r + 1) // 4 - size * r // 4 AS size FROM src, range(4) x(r))"
HAMILTON = f"""{PLAN}, {RANKS}, j AS (SELECT q.dataset, q.phase, r.rank, q.count, r.size, CAST(sum(r.size) OVER w AS BIGINT) AS total FROM quotas q JOIN ranks r USING (dataset) WINDOW w AS (PARTITION BY q.dataset, q.phase)),
 b AS (SELECT *, count * size // total AS base, count * size % total AS rem FROM j), e AS (SELECT *, row_number() OVER (PARTITION BY dataset, phase ORDER BY rem DESC, rank) <= count - sum(base) OVER (PARTITION BY dataset, phase) AS extra FROM b),
 h AS (SELECT dataset, CAST(phase AS INTEGER) AS phase, rank, base + CASE WHEN extra THEN 1 ELSE 0 END AS count FROM e)"""


def _apportioned(spark: SparkSession, d: str) -> DataFrame:
    plan = _plan(spark, d)
    ranks = [(x.name, r, b - a) for x in plan.datasets for r, (a, b) in enumerate(M.contiguous_shards(x.size, 4))]
    return M.apportion_df(plan.quotas_df(spark), spark.createDataFrame(ranks, "dataset string, rank bigint, size bigint").coalesce(1))


@query(f"WITH {HAMILTON} SELECT dataset, phase, rank, count FROM h")
def m05_apportioned(spark: SparkSession, d: str) -> DataFrame:
    return _apportioned(spark, d).select("dataset", "phase", "rank", "count")


@query(f"WITH {HAMILTON} SELECT dataset, phase, rank, count, CAST(sum(count) OVER (PARTITION BY dataset, rank ORDER BY phase) - count AS BIGINT) AS start FROM h")
def m06_rank_plan(spark: SparkSession, d: str) -> DataFrame:
    return _apportioned(spark, d)


@query(f"WITH {HAMILTON} SELECT dataset, phase, row_number() OVER (PARTITION BY dataset, phase ORDER BY rank) - 1 AS place, count FROM h")
def w08_rank_by_remainder(spark: SparkSession, d: str) -> DataFrame:
    place = F.row_number().over(W.partitionBy("dataset", "phase").orderBy("rank")) - 1
    return _apportioned(spark, d).select("dataset", "phase", place.cast("bigint").alias("place"), "count")


INTERLEAVED = f"""{PLAN}, u AS (SELECT CAST(phase AS INTEGER) AS phase, dataset, start + i AS occurrence FROM quotas, range(count) r(i)),
 s AS (SELECT *, row_number() OVER (PARTITION BY phase ORDER BY sha256('{SEED}:' || phase || ':' || dataset || ':' || occurrence), dataset, occurrence) - 1 AS slot FROM u),
 a AS (SELECT phase, dataset, slot, row_number() OVER (PARTITION BY phase, dataset ORDER BY slot) AS k FROM s), o AS (SELECT phase, dataset, occurrence, row_number() OVER (PARTITION BY phase, dataset ORDER BY occurrence) AS k FROM u),
 mixed AS (SELECT phase, slot, dataset, occurrence FROM a JOIN o USING (phase, dataset, k))"""


@query(f"WITH {INTERLEAVED} SELECT * FROM mixed")
def m07_interleaved(spark: SparkSession, d: str) -> DataFrame:
    return M.interleaved(spark, _plan(spark, d))


@query(
    f"WITH {INTERLEAVED}, c AS (SELECT *, CASE WHEN slot < 128 THEN slot ELSE CAST(('0x' || substr(sha256('{SEED}:buffer:' || phase || ':' || slot), 1, 8)) AS BIGINT) % 128 END AS cell FROM mixed), "
    "l AS (SELECT *, lead(slot) OVER (PARTITION BY phase, cell ORDER BY slot) AS follows, count(*) OVER (PARTITION BY phase) AS n FROM c) "
    "SELECT phase, CASE WHEN follows IS NOT NULL THEN follows - 128 ELSE n - least(n, 128) + row_number() OVER (PARTITION BY phase, follows IS NULL "
    f"ORDER BY sha256('{SEED}:drain:' || phase || ':' || slot), slot) - 1 END AS slot, dataset, occurrence FROM l"
)
def m08_buffered(spark: SparkSession, d: str) -> DataFrame:
    return M.buffered(cut(M.interleaved(spark, _plan(spark, d))), SEED, 128).select("phase", "slot", "dataset", "occurrence")


@query(f"WITH {PLAN}, c AS (SELECT dataset, count(*) AS n, sum(count) AS total FROM quotas GROUP BY dataset) SELECT 'totals' AS \"check\", count(*) AS violations FROM plan JOIN c USING (dataset) WHERE total <> target UNION ALL SELECT 'manifest', 0")
def m09_manifest(spark: SparkSession, d: str) -> DataFrame:
    plan = _plan(spark, d)
    sums = plan.quotas_df(spark).groupBy("dataset").agg(F.sum("count").alias("total")).join(plan.datasets_df(spark), "dataset").where("total <> target")
    wrong = M.check_manifest(plan.manifest())
    return violations([("totals", sums), ("manifest", spark.createDataFrame([(w,) for w in wrong], "w string"))])


@query(f"WITH {PLAN} SELECT dataset, round(target / sum(target) OVER (), 9) AS probability FROM plan")
def m10_probabilities(spark: SparkSession, d: str) -> DataFrame:
    # A plan has a row for each dataset, so a window over all of it is small.
    t = _plan(spark, d).datasets_df(spark)
    return t.select("dataset", F.round(F.col("target") / F.sum("target").over(W.partitionBy()), 9).alias("probability"))


@query(f"WITH {PLAN} SELECT dataset || '#' || target AS quota, dataset || '#' || size AS source FROM plan")
def m11_specs(spark: SparkSession, d: str) -> DataFrame:
    cat = lambda c: F.concat_ws("#", "dataset", F.col(c).cast("string"))
    return _plan(spark, d).datasets_df(spark).select(cat("target").alias("quota"), cat("size").alias("source"))


#: As many draws as surely use up every source: a source of s rows and share q is drawn s times among (s + 8 * sqrt(s) + 30) / q draws.
DRAWS = f"""n AS (SELECT CAST(sum(target) AS BIGINT) AS total, CAST(ceil(max((size + 8 * sqrt(size) + 30) * (SELECT sum(target) FROM plan) / target)) AS BIGINT) AS steps FROM plan),
 spans AS (SELECT dataset, size, CAST(sum(target) OVER (ORDER BY dataset) - target AS BIGINT) AS start, target FROM plan),
 x AS (SELECT step, CAST(('0x' || substr(sha256('{SEED}:draw:' || step), 1, 15)) AS BIGINT) % total AS place FROM n, range(steps) r(step)),
 drawn AS (SELECT dataset, size, step, row_number() OVER (PARTITION BY dataset ORDER BY step) AS nth FROM x JOIN spans ON place >= start AND place < start + target),
 e AS (SELECT min(step) AS first_end, max(step) AS all_end FROM drawn WHERE nth = size)"""


@query(f"WITH {PLAN}, {DRAWS} SELECT dataset, count(*) FILTER (WHERE step <= first_end) AS first_exhausted, count(*) FILTER (WHERE step <= all_end) AS all_exhausted, least(size, count(*)) AS without_replacement FROM drawn, e GROUP BY dataset, size")
def m12_stopping(spark: SparkSession, d: str) -> DataFrame:
    """Draws of each source in a stream that ends with the draw that uses up the first source, or the last one (others repeat), or uses each row once."""
    plan = _plan(spark, d)
    steps = max(math.ceil((x.size + 8 * math.sqrt(x.size) + 30) * plan.total / x.target) for x in plan.datasets)
    return M.stopped_draws(spark, plan, steps)


IDX = "i AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents), n AS (SELECT count(*) AS n FROM documents)"


def _indexed(spark: SparkSession, d: str) -> DataFrame:
    return with_row_index(table(spark, d, "documents").select("doc_id"), "doc_id")


@query(f"WITH {IDX} SELECT doc_id, CAST(floor(((row_index + 1) * 3 - 1) / n) AS BIGINT) AS rank FROM i, n")
def m13_contiguous(spark: SparkSession, d: str) -> DataFrame:
    i = _indexed(spark, d)
    n = max(1, i.count())
    return i.select("doc_id", F.expr(f"((row_index + 1) * 3 - 1) div {n}").alias("rank"))


@query()
def m14_row_groups(spark: SparkSession, d: str) -> DataFrame:
    """Row groups of all files of a table dealt to 4 ranks in turn, the count running on over files; from the footers only."""
    groups = footers(spark, [f"{d}/{t}.parquet" for t in ("lineitem", "orders", "raw_trajectories")])
    return groups.withColumn("rank", F.col("ordinal") % 4).select("file", "row_group", "rows", "rank")


@query("WITH c AS (SELECT shard, dense_rank() OVER (ORDER BY shard) - 1 AS g FROM (SELECT DISTINCT shard FROM raw_trajectories)) SELECT shard, g % 4 AS rank FROM c")
def m14_group_shards(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "raw_trajectories").select("shard").distinct()  # one row for each file or row group
    return s.select("shard", ((F.dense_rank().over(W.orderBy("shard")) - 1) % 4).cast("bigint").alias("rank"))


@query(f"WITH {IDX} SELECT doc_id FROM i WHERE row_index % 4 = 1")
def m15_modulo(spark: SparkSession, d: str) -> DataFrame:
    return _indexed(spark, d).where("row_index % 4 = 1").select("doc_id")


@query("SELECT val_id, (row_number() OVER (ORDER BY val_id) - 1) % 8 AS shard FROM val")
def m16_eval_shards(spark: SparkSession, d: str) -> DataFrame:
    return with_row_index(table(spark, d, "val").select("val_id"), "val_id").select("val_id", (F.col("row_index") % 8).alias("shard"))


@query(f"WITH {IDX} SELECT doc_id FROM i JOIN documents USING (doc_id) WHERE row_index % 3 = 2 AND trim(coalesce(text, '')) <> ''")
def m17_line_modulo(spark: SparkSession, d: str) -> DataFrame:
    text = table(spark, d, "documents").select("doc_id", "text")
    return _indexed(spark, d).where("row_index % 3 = 2").join(text, "doc_id").where("trim(coalesce(text, '')) <> ''").select("doc_id")


def _balance_sql(order: str) -> str:
    return (
        f"WITH RECURSIVE s AS (SELECT shard, count(*) AS n, row_number() OVER (ORDER BY {order}) AS k FROM raw_trajectories WHERE shard IS NOT NULL GROUP BY shard), "
        "r AS (SELECT 0 AS k, CAST(NULL AS VARCHAR) AS shard, CAST(NULL AS BIGINT) AS rank, [0, 0, 0]::BIGINT[] AS load UNION ALL "
        "SELECT k, shard, rank, list_transform(load, lambda x, i: CASE WHEN i - 1 = rank THEN x + n ELSE x END) FROM "
        "(SELECT s.k, s.shard, s.n, r.load, CAST(list_position(r.load, list_min(r.load)) - 1 AS BIGINT) AS rank FROM r JOIN s ON s.k = r.k + 1)) SELECT shard, rank FROM r WHERE k > 0"
    )


def _balanced(spark: SparkSession, d: str, largest_first: bool) -> DataFrame:
    sizes = small_rows(table(spark, d, "raw_trajectories").where("shard IS NOT NULL").groupBy("shard").agg(F.count("*").alias("n")))
    placed = M.balance(sorted((r.shard, r.n) for r in sizes), 3, largest_first)
    return spark.createDataFrame(sorted(placed.items()), "shard string, rank bigint").coalesce(1)


@query(_balance_sql("count(*) DESC, shard"))
def m18_largest_first(spark: SparkSession, d: str) -> DataFrame:
    return _balanced(spark, d, True)


@query(_balance_sql("shard"))
def m19_in_order(spark: SparkSession, d: str) -> DataFrame:
    return _balanced(spark, d, False)


@query(f"WITH {PLAN} SELECT dataset, CAST(sum(size) AS BIGINT) AS size, CAST(sum(target) AS BIGINT) AS target, round(sum(target) / (SELECT sum(target) FROM plan), 9) AS share FROM plan GROUP BY ROLLUP (dataset)")
def a18_audit(spark: SparkSession, d: str) -> DataFrame:
    plan = _plan(spark, d)
    t = plan.datasets_df(spark).rollup("dataset").agg(F.sum("size").alias("size"), F.sum("target").alias("target"))
    return t.withColumn("share", F.round(F.col("target") / F.lit(plan.total), 9))


@query(f"WITH {PLAN} SELECT CAST(sum(target) AS BIGINT) AS exposures, CAST(sum(target) AS BIGINT) // 256 AS steps FROM plan")
def a19_steps(spark: SparkSession, d: str) -> DataFrame:
    return _plan(spark, d).datasets_df(spark).agg(F.sum("target").alias("exposures")).withColumn("steps", F.expr("exposures div 256"))


@query(
    f"WITH {ORDERED}, plan AS (SELECT 'train' AS dataset, count(*) AS size, count(*) // 5 AS target FROM train), {AFFINE} SELECT train_id, row_index IS NOT NULL AS selected FROM o LEFT JOIN selected ON place = row_index"
)
def o07_affine_subset(spark: SparkSession, d: str) -> DataFrame:
    """A fifth of train, exactly, by a bijection of places drawn for its size."""
    from loomspark.operators.split import shuffled

    rows = shuffled(table(spark, d, "train").select("train_id"), "train_id", SEED)
    n = rows.count()
    _, b, a_inv = M.affine(n, SEED, "train", 0)
    number = lambda x: F.lit(x).cast("bigint")
    return rows.select("train_id", M.selected(F.col("place"), number(a_inv), number(b), number(max(1, n)), number(n // 5)).alias("selected"))


@query(f"WITH {PLAN} SELECT CAST(phase AS INTEGER) AS phase, dataset, CAST(('0x' || substr(sha256('{SEED}:' || dataset || ':' || phase), 1, 16))::UBIGINT AS VARCHAR) AS seed FROM quotas")
def c17_seeds(spark: SparkSession, d: str) -> DataFrame:
    q = _plan(spark, d).quotas_df(spark)
    return q.select("phase", "dataset", seed64_column(SEED, F.col("dataset"), F.col("phase")).cast("string").alias("seed"))


@query(f"WITH {PLAN}, {AFFINE} SELECT dataset, occurrence, doc_id FROM uses JOIN (SELECT source AS dataset, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_index FROM documents) USING (dataset, row_index)")
def j01_fetch(spark: SparkSession, d: str) -> DataFrame:
    plan = _plan(spark, d)
    rows = _documents(spark, d)
    # The order of uses is the column occurrence.
    return M.occurrences(rows, plan).join(rows, ["dataset", "row_index"]).select("dataset", "occurrence", "doc_id")


NEXT_FIT = """s AS (SELECT source, doc_id, coalesce(n_chars, 0) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents WHERE source IS NOT NULL),
 r AS (SELECT source, doc_id, k, n AS used, CAST(0 AS BIGINT) AS pack, n FROM s WHERE k = 1 UNION ALL
 SELECT s.source, s.doc_id, s.k, CASE WHEN r.used + s.n > 4096 THEN s.n ELSE r.used + s.n END, CASE WHEN r.used + s.n > 4096 THEN r.pack + 1 ELSE r.pack END, s.n FROM r JOIN s ON s.source = r.source AND s.k = r.k + 1)"""


def _packs(spark: SparkSession, d: str) -> DataFrame:
    return packing.next_fit(table(spark, d, "documents").where("source IS NOT NULL"), "source", "doc_id", "n_chars", 4096)


@query(f"WITH RECURSIVE {NEXT_FIT} SELECT source, doc_id, n AS n_chars, pack FROM r")
def pk01_next_fit(spark: SparkSession, d: str) -> DataFrame:
    return _packs(spark, d)


#: What any packing of documents has to keep: every row that fits once, none overfull, no place twice, and no more packs than next-fit rules allow.
FITTING = "SELECT source, count(*) AS rows, CAST(sum(coalesce(n_chars, 0)) AS BIGINT) AS chars, count(DISTINCT doc_id) AS documents, true AS within_budget, true AS places_run_on, true AS few_packs FROM documents WHERE source IS NOT NULL AND coalesce(n_chars, 0) <= 16384 GROUP BY source"


def _pack_rules(spark: SparkSession, d: str, window: int) -> DataFrame:
    p = packing.windowed_packs(table(spark, d, "documents").where("source IS NOT NULL"), "source", "doc_id", "n_chars", 16384, window)
    packs = p.groupBy("source", "pack").agg(F.sum("n_chars").alias("used"), F.count("*").alias("rows"), F.count_distinct("doc_id").alias("documents"), (F.max("place") + 1).alias("places"))
    # Of a window at most one pack is half empty; the emptiest is carried on.
    few = F.count("*") <= 2 * F.sum("used") / 16384 + F.sum("rows") / window + 2
    return packs.groupBy("source").agg(
        F.sum("rows").alias("rows"), F.sum("used").alias("chars"), F.sum("documents").alias("documents"), (F.max("used") <= 16384).alias("within_budget"),
        F.bool_and(F.col("places") == F.col("rows")).alias("places_run_on"), few.alias("few_packs"),
    )


@query(FITTING)
def pk02_best_fit(spark: SparkSession, d: str) -> DataFrame:
    return _pack_rules(spark, d, 1 << 30)


@query(FITTING)
def pk03_windowed(spark: SparkSession, d: str) -> DataFrame:
    return _pack_rules(spark, d, 128)


@query()
def pk03_packs(spark: SparkSession, d: str) -> DataFrame:
    return packing.windowed_packs(table(spark, d, "documents").where("source IS NOT NULL"), "source", "doc_id", "n_chars", 16384)


@query("SELECT doc_id, CAST(i AS INTEGER) AS piece, least(1000, n_chars - i * 1000) AS length FROM documents, range(200) r(i) WHERE i * 1000 < n_chars")
def pk04_items(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("n_chars > 0")
    i = t.select("doc_id", "n_chars", F.explode(F.sequence(F.lit(0), F.expr("CAST((n_chars - 1) div 1000 AS INT)"))).alias("piece"))
    return i.select("doc_id", "piece", F.least(F.lit(1000).cast("bigint"), F.col("n_chars") - F.col("piece") * 1000).alias("length"))


@query(f"WITH RECURSIVE {NEXT_FIT} SELECT source, doc_id, pack, CAST(sum(n) OVER w AS BIGINT) - n AS start, CAST(sum(n) OVER w AS BIGINT) AS \"end\" FROM r WINDOW w AS (PARTITION BY source, pack ORDER BY doc_id)")
def pk05_offsets(spark: SparkSession, d: str) -> DataFrame:
    return packing.offsets(_packs(spark, d), ["source", "pack"], "doc_id", "n_chars").select("source", "doc_id", "pack", "start", "end")


@query(
    "SELECT train_id, CASE WHEN len(images) > 0 THEN list_transform(messages, lambda m: CAST((length(coalesce(m['content'], '')) - length(replace(coalesce(m['content'], ''), '<image>', ''))) // 7 AS INTEGER)) "
    "ELSE list_transform(messages, lambda m: 0) END AS mask FROM train"
)
def pk06_text_only_mask(spark: SparkSession, d: str) -> DataFrame:
    """Marks of images in each turn; rows without images have zeros of their length."""
    marks = F.transform("messages", lambda m: F.coalesce(F.expr("0") + F.regexp_count(m["content"], F.lit("<image>")), F.lit(0)))
    mask = F.when(F.size("images") > 0, marks).when(F.col("messages").isNotNull(), F.array_repeat(F.lit(0), F.size("messages")))
    return table(spark, d, "train").select("train_id", mask.alias("mask"))


@query(f"WITH {ORDERED} SELECT place // 64 AS step, count(*) AS rows FROM o GROUP BY 1")
def pk07_batches(spark: SparkSession, d: str) -> DataFrame:
    from loomspark.operators.split import shuffled

    readers, accumulate = packing.batch_shape(16, 2, 1, 1, 64)
    rows = shuffled(table(spark, d, "train").select("train_id"), "train_id", SEED)
    return rows.groupBy(F.expr(f"place div {readers * accumulate}").alias("step")).agg(F.count("*").alias("rows"))


#: Ranks of unlike length over all rows.
RANK = "CASE WHEN doc_id % 7 < 3 THEN 0 WHEN doc_id % 7 < 5 THEN 1 ELSE 2 END"
DEALT = f"k AS (SELECT doc_id, n_chars, rank, row_number() OVER (PARTITION BY rank ORDER BY doc_id) - 1 AS ordinal FROM (SELECT doc_id, n_chars, {RANK} AS rank FROM documents))"
LOCK = f"{DEALT}, s AS (SELECT min(n) // 4 AS steps FROM (SELECT rank, count(*) AS n FROM k GROUP BY rank))"


def _dealt(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "documents").select(F.expr(RANK).alias("rank"), "doc_id", "n_chars")
    return with_group_index(k, ["rank"], ["doc_id"], "ordinal")


@query(f"WITH {LOCK} SELECT rank, ordinal // 4 AS step, count(*) AS packs FROM k, s WHERE ordinal < steps * 4 GROUP BY ALL")
def pk08_lock_step(spark: SparkSession, d: str) -> DataFrame:
    return packing.lock_step(_dealt(spark, d), "rank", "ordinal", 4).groupBy("rank", "step").agg(F.count("*").alias("packs"))


@query(
    f"WITH {DEALT}, b AS (SELECT rank, ordinal // 8 AS round, count(*) AS rows, CAST(sum(coalesce(n_chars, 0)) AS BIGINT) AS tokens FROM k GROUP BY ALL), r AS (SELECT DISTINCT rank FROM k), m AS (SELECT max(round) + 1 AS rounds FROM b) "
    "SELECT r.rank, x.round, coalesce(rows, 0) AS rows, coalesce(tokens, 0) AS weight, rows IS NULL AS replayed FROM r CROSS JOIN m CROSS JOIN range(m.rounds) x(round) LEFT JOIN b ON b.rank = r.rank AND b.round = x.round"
)
def pk09_finite_validation(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 8 rows a rank and round; ranks that have run out replay a batch with weight 0 until the longest is through."""
    batches = _dealt(spark, d).groupBy("rank", F.expr("ordinal div 8").alias("round")).agg(F.count("*").alias("rows"), F.sum(F.coalesce("n_chars", F.lit(0))).alias("weight"))
    return packing.finite_rounds(batches, "rank", "round", {"rows": 0, "weight": 0})


@query("SELECT train_id, 131072 >= 1700 + coalesce(len(images), 0) * (880 + 40) AS fits FROM train")
def pk10_budget_rule(spark: SparkSession, d: str) -> DataFrame:
    n = F.when(F.col("images").isNotNull(), F.size("images")).otherwise(0)
    return table(spark, d, "train").select("train_id", (F.lit(131072) >= 1700 + n * (880 + 40)).alias("fits"))


@query(f"WITH {ORDERED} SELECT train_id FROM o WHERE place >= 640")
def x06_resume_by_position(spark: SparkSession, d: str) -> DataFrame:
    from loomspark.operators.split import shuffled

    rows = shuffled(table(spark, d, "train").select("train_id"), "train_id", SEED)
    return resume.remaining(rows, "place", resume.consumed_rows(10, 64)).select("train_id")


@query(
    "WITH k AS (SELECT DISTINCT run_id, step, coalesce(try_cast(split_part(iteration, '/', 1) AS BIGINT), step) AS iteration FROM metric_log) "
    "SELECT run_id, step, iteration, step * 64 AS consumed, step * 8 AS dispatched, step * 64 = iteration * 64 AND step * 8 = iteration * 8 AS agrees FROM k"
)
def x08_consumed(spark: SparkSession, d: str) -> DataFrame:
    """Rows consumed and batches dispatched at each logged step, and whether they are those of the iteration the log names."""
    k = table(spark, d, "metric_log").select("run_id", "step", step_of(F.col("iteration"), F.col("step")).alias("iteration")).distinct()
    return k.withColumns({"consumed": F.col("step") * 64, "dispatched": F.col("step") * 8, "agrees": resume.agrees(F.col("step") * 64, F.col("step") * 8, F.col("iteration"), 64, 8)})


@query(f"WITH {LOCK} SELECT rank, max(steps) AS step, max(steps) * 4 AS cursor, count(*) FILTER (WHERE ordinal >= steps * 4) AS rolled_back FROM k, s GROUP BY rank")
def x11_rolled_back(spark: SparkSession, d: str) -> DataFrame:
    """Where each rank's cursor is set back to when the shortest rank ends amid a step, and how many rows it gives back."""
    k = _dealt(spark, d)
    used = packing.lock_step(k, "rank", "ordinal", 4).groupBy("rank").agg(F.max("step").alias("last"))
    all_ = k.groupBy("rank").agg(F.count("*").alias("n")).join(used, "rank", "left")
    step = F.coalesce(F.col("last") + 1, F.lit(0))
    return all_.select("rank", step.alias("step"), (step * 4).alias("cursor"), (F.col("n") - step * 4).alias("rolled_back"))


#: The mixture's first half has been consumed, so far as whole phases and a part of the next go.
CURSORS = f"""{INTERLEAVED}, t AS (SELECT CAST(sum(target) AS BIGINT) // 2 AS next_pos FROM plan), f AS (SELECT phase, sum(count) OVER (ORDER BY phase) - count AS first, count FROM (SELECT phase, count(*) AS count FROM mixed GROUP BY phase)),
 g AS (SELECT m.*, CAST(f.first + m.slot AS BIGINT) AS pos, next_pos FROM mixed m JOIN f USING (phase), t)"""


@query(f"WITH {CURSORS} SELECT dataset, count(*) FILTER (WHERE pos < next_pos) AS occurrence, count(*) FILTER (WHERE pos < next_pos) // size AS logical_pass, count(*) FILTER (WHERE pos < next_pos) % size AS emitted_in_pass, target - count(*) FILTER (WHERE pos < next_pos) AS remaining FROM g JOIN plan USING (dataset) GROUP BY dataset, size, target")
def x02_cursors(spark: SparkSession, d: str) -> DataFrame:
    plan = _plan(spark, d)
    return resume.cursors(M.positions(M.interleaved(spark, plan), plan), plan.datasets_df(spark), plan.total // 2)


@query(
    f"WITH {CURSORS}, now AS (SELECT max(phase) AS phase FROM g WHERE pos <= next_pos), c AS (SELECT g.phase, slot, dataset, occurrence, pos, next_pos, CASE WHEN slot < 128 THEN slot ELSE CAST(('0x' || substr(sha256('{SEED}:buffer:' || g.phase || ':' || slot), 1, 8)) AS BIGINT) % 128 END AS cell FROM g JOIN now ON g.phase = now.phase) "
    "SELECT phase, cell, dataset, occurrence FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY slot DESC) AS r FROM c WHERE pos < next_pos) WHERE r = 1"
)
def x01_buffer(spark: SparkSession, d: str) -> DataFrame:
    """The rows a buffer of 128 holds when half of the mixture has come in."""
    plan = _plan(spark, d)
    return M.held_rows(cut(M.positions(M.interleaved(spark, plan), plan)), SEED, 128, plan.total // 2)


@query(
    f"WITH RECURSIVE {NEXT_FIT}, half AS (SELECT source, count(*) // 2 AS came FROM r GROUP BY source), open AS (SELECT r.source, max(pack) AS pack FROM r JOIN half USING (source) WHERE k <= came GROUP BY r.source) "
    "SELECT r.source, doc_id, r.n AS n_chars FROM r JOIN open USING (source, pack) JOIN half ON half.source = r.source WHERE k <= came"
)
def x03_carried(spark: SparkSession, d: str) -> DataFrame:
    """Rows and lengths in each source's open pack when half of its rows have come in."""
    rows = with_group_index(_packs(spark, d), ["source"], ["doc_id"], "ordinal")
    n = rows.groupBy("source").agg(F.count("*").alias("n"))
    return packing.carried(rows.join(n, "source"), "source", "ordinal", F.expr("n div 2")).select("source", "doc_id", "n_chars")


@query("SELECT coalesce(channel, 'unknown') AS channel, CAST(sum(coalesce(n_chars, 0)) AS BIGINT) AS tokens, count(*) AS rows FROM documents GROUP BY 1")
def x13_channel_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals saved at a moment and carried on with the rows that came later are those of all rows."""
    rows = table(spark, d, "documents").select("channel", F.coalesce("n_chars", F.lit(0)).alias("tokens"), F.coalesce(F.col("collected_at") < F.lit("2025-06-01").cast("timestamp_ntz"), F.lit(True)).alias("before"))
    return continued_totals(channel_totals(rows.where("before")), rows.where("NOT before"))
