"""Action scores, token counts, training logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.functions import actions as A
from loomspark.functions import chat, images, logs, tokens
from loomspark.operators import reports
from loomspark.session import table
from loomspark.workloads import query
from loomspark.workloads.etl import TRAIN_TURNS

S, P, E = A.START, A.SEP, A.STOP
BODY = r"regexp_extract(pred, '<\|action_start\|>(.*?)<\|action_end\|>', 1, 's')"
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
PRE = r"regexp_extract({0}, '<\|action_start\|>\s*(-?\d+)\s+(-?\d+)\s+(-?\d+)', {1})"
ONE = r"regexp_extract({0}, '<\|action_start\|>(-?\d+) (-?\d+) (-?\d+)(.*?)<\|action_end\|>', {1}, 's')"
#: Edits of each pair of texts. DuckDB's levenshtein counts bytes, so for texts with signs beyond ASCII the table of edits is filled row by row.
EDITS = f"""pairs AS (SELECT DISTINCT {STRIP.format("pred")} AS a, {STRIP.format("gt")} AS b FROM eval_records WHERE pred IS NOT NULL AND gt IS NOT NULL),
 wide AS (SELECT a, b, list_transform(range(1, length(b) + 1), lambda j: substr(b, j, 1)) AS y FROM pairs WHERE regexp_matches(a || b, '[^\x01-\x7F]')),
 dp AS (SELECT a, b, y, 0 AS i, range(0, length(b) + 1) AS d FROM wide UNION ALL
  SELECT a, b, y, i + 1, list_reduce(list_prepend([CAST(i + 1 AS BIGINT)], list_transform(range(1, length(b) + 1), lambda j: [least(d[j + 1] + 1, d[j] + CASE WHEN y[j] = substr(a, i + 1, 1) THEN 0 ELSE 1 END)])),
   lambda done, x: list_append(done, least(done[-1] + 1, x[1]))) FROM dp WHERE i < length(a)),
 edits AS (SELECT a, b, levenshtein(a, b) AS e FROM pairs WHERE NOT regexp_matches(a || b, '[^\x01-\x7F]') UNION ALL SELECT a, b, d[-1] FROM dp WHERE i = length(a))"""
FLAGS = f"""contains(pred, '{S}') AS contains_start, contains(pred, '{E}') AS contains_end, {STRIP.format(BODY)} <> '' AS well_formed,
 regexp_matches(split_part({BODY}, '{P}', 1), '^\\s*-?\\d+\\s+-?\\d+\\s+-?\\d+\\s*$') AS parses_xyz, contains({BODY}, '{P}') AS has_action_sep, {STRIP.format("pred")} = {STRIP.format("gt")} AS exact_match"""


def _eval(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "eval_records")



@query(f"SELECT traj, turn, contains(pred, '{S}') AS contains_start, contains(pred, '{E}') AS contains_end FROM eval_records")
def c01_tags(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", A.contains_start(F.col("pred")).alias("contains_start"), A.contains_end(F.col("pred")).alias("contains_end"))


@query(f"SELECT traj, turn, {BODY} AS body FROM eval_records")
def c02_body(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", A.body(F.col("pred")).alias("body"))


@query(f"SELECT traj, turn, {STRIP.format(BODY)} <> '' AS well_formed, contains({BODY}, '{P}') AS has_action_sep FROM eval_records")
def c03_well_formed(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", A.well_formed(F.col("pred")).alias("well_formed"), A.has_separator(F.col("pred")).alias("has_action_sep"))


@query(f"SELECT traj, turn, regexp_matches(split_part({BODY}, '{P}', 1), '^\\s*-?\\d+\\s+-?\\d+\\s+-?\\d+\\s*$') AS parses_xyz FROM eval_records")
def c04_parses_strict(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", A.parses_strict(F.col("pred")).alias("parses_xyz"))


@query(f"SELECT traj, turn, CASE WHEN {PRE.format('pred', 1)} <> '' THEN [CAST({PRE.format('pred', 1)} AS INT), CAST({PRE.format('pred', 2)} AS INT), CAST({PRE.format('pred', 3)} AS INT)] END AS mouse FROM eval_records")
def c05_mouse_prefix(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", A.mouse(F.col("pred")).alias("mouse"))


@query(f"SELECT traj, turn, CASE WHEN {ONE.format('pred', 1)} <> '' THEN [CAST({ONE.format('pred', 1)} AS INT), CAST({ONE.format('pred', 2)} AS INT), CAST({ONE.format('pred', 3)} AS INT)] END AS mouse, {ONE.format('pred', 4)} AS rest FROM eval_records")
def c06_mouse_single(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", A.mouse(F.col("pred"), A.SINGLE).alias("mouse"), F.regexp_extract("pred", A.SINGLE, 4).alias("rest"))


@query(f"SELECT traj, turn, {STRIP.format('pred')} = {STRIP.format('gt')} AS exact_match FROM eval_records")
def c08_exact_match(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", (A.strip(F.col("pred")) == A.strip(F.col("gt"))).alias("exact_match"))


@query(f"WITH RECURSIVE {EDITS} SELECT traj, turn, CAST(e AS INTEGER) AS edits FROM eval_records LEFT JOIN edits ON {STRIP.format('pred')} = a AND {STRIP.format('gt')} = b")
def c09_edit_distance(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", F.levenshtein(A.strip(F.col("pred")), A.strip(F.col("gt"))).alias("edits"))


MAGS = f"""m AS (SELECT *, CASE WHEN {PRE.format('pred', 1)} <> '' AND {PRE.format('gt', 1)} <> '' THEN abs(CAST({PRE.format('pred', 1)} AS INT)) + abs(CAST({PRE.format('pred', 2)} AS INT)) END AS pred_mag,
 CASE WHEN {PRE.format('pred', 1)} <> '' AND {PRE.format('gt', 1)} <> '' THEN abs(CAST({PRE.format('gt', 1)} AS INT)) + abs(CAST({PRE.format('gt', 2)} AS INT)) END AS gt_mag FROM eval_records)"""


def _mags(spark: SparkSession, d: str) -> DataFrame:
    p, g = A.magnitude(A.mouse(F.col("pred"))), A.magnitude(A.mouse(F.col("gt")))
    return _eval(spark, d).withColumns({"pred_mag": F.when(g.isNotNull(), p), "gt_mag": F.when(p.isNotNull(), g)})


@query(f"WITH {MAGS} SELECT traj, turn, pred_mag, gt_mag, gt_mag > 10 AND pred_mag = 0 AS gt_moved_pred_still FROM m")
def c10_magnitudes(spark: SparkSession, d: str) -> DataFrame:
    return _mags(spark, d).select("traj", "turn", "pred_mag", "gt_mag", ((F.col("gt_mag") > A.MOVED) & (F.col("pred_mag") == 0)).alias("gt_moved_pred_still"))


@query(f"SELECT traj, turn, {STRIP.format('replace(' + ONE.format('pred', 4) + f', {P!r}, {chr(39)} {chr(39)})')} <> '' AS has_key FROM eval_records")
def c12_has_key(spark: SparkSession, d: str) -> DataFrame:
    return _eval(spark, d).select("traj", "turn", A.has_key(F.col("pred")).alias("has_key"))


SUMS = """count(*) AS n, count(pred_mag) AS pairs, CAST(coalesce(sum(pred_mag), 0) AS BIGINT) AS pred_sum, CAST(coalesce(sum(gt_mag), 0) AS BIGINT) AS gt_sum,
 count(*) FILTER (WHERE pred_mag = 0) AS pred_still, count(*) FILTER (WHERE gt_mag > 10) AS gt_moved, count(*) FILTER (WHERE gt_mag > 10 AND pred_mag = 0) AS moved_still"""
RATES = "round(pred_sum / greatest({0}, 1), 6) AS pred_mean, round(gt_sum / greatest({0}, 1), 6) AS gt_mean, round(pred_sum / greatest(gt_sum, 1), 6) AS ratio, round(pred_still / greatest({0}, 1), 6) AS still_share, round(moved_still / greatest(gt_moved, 1), 6) AS moved_still_share"


@query(f"WITH RECURSIVE {EDITS} SELECT count(pred) AS n, count(*) FILTER (WHERE pred IS NULL) AS errors, {', '.join(f'count(*) FILTER (WHERE {c}) AS {c}' for c in ('contains_start', 'contains_end', 'well_formed', 'parses_xyz', 'has_action_sep', 'exact_match'))}, round(avg(e), 6) AS mean_edit_distance FROM (SELECT pred, {FLAGS}, e FROM eval_records LEFT JOIN edits ON {STRIP.format('pred')} = a AND {STRIP.format('gt')} = b)")
def a07_format_summary(spark: SparkSession, d: str) -> DataFrame:
    return reports.format_summary(_eval(spark, d))


@query(f"SELECT traj, count(*) AS n, (2000 * count(*) FILTER (WHERE {STRIP.format(BODY)} <> '') + count(pred)) // nullif(2 * count(pred), 0) / 10 AS well_formed_pct FROM eval_records GROUP BY traj")
def c20_percent(spark: SparkSession, d: str) -> DataFrame:
    """Percent of well-formed predictions by trajectory to one place; null where there is no prediction."""
    return _eval(spark, d).groupBy("traj").agg(F.count("*").alias("n"), reports.percent(F.count_if(A.well_formed(F.col("pred"))), F.count("pred")).alias("well_formed_pct"))


@query(f"WITH {MAGS}, s AS (SELECT {SUMS} FROM m WHERE pred IS NOT NULL) SELECT *, {RATES.format('n')} FROM s")
def a08_action_summary_live(spark: SparkSession, d: str) -> DataFrame:
    m = _mags(spark, d).where("pred IS NOT NULL")
    return reports.action_summary(m.agg(*reports.action_sums(m)), live=True)


@query(f"WITH m AS (SELECT traj % 4 AS shard, metrics['pred_mag'] AS pred_mag, metrics['gt_mag'] AS gt_mag FROM eval_records), b AS (SELECT shard, CASE WHEN gt_mag IS NOT NULL THEN pred_mag END AS pred_mag, CASE WHEN pred_mag IS NOT NULL THEN gt_mag END AS gt_mag FROM m), s AS (SELECT shard, {SUMS} FROM b GROUP BY shard) SELECT *, {RATES.format('pairs')} FROM s")
def a09_action_summary_stored(spark: SparkSession, d: str) -> DataFrame:
    m = _eval(spark, d).select((F.col("traj") % 4).alias("shard"), F.col("metrics.pred_mag").alias("pred_mag"), F.col("metrics.gt_mag").alias("gt_mag"))
    return reports.action_summary(m.groupBy("shard").agg(*reports.action_sums(m)), live=False)


@query(f"WITH {MAGS} SELECT traj, round(coalesce(sum(pred_mag), 0) / greatest(coalesce(sum(gt_mag), 0), 1), 6) AS ratio FROM m GROUP BY traj")
def a10_ratio_of_sums(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return _mags(spark, d).groupBy("traj").agg(F.round(s("pred_mag") / F.greatest(s("gt_mag"), F.lit(1)), 6).alias("ratio"))


IDLE = f"""t AS ({TRAIN_TURNS}), a AS (SELECT {ONE.format("m['content']", 1)} AS x, {ONE.format("m['content']", 2)} AS y, {ONE.format("m['content']", 4)} AS rest FROM t WHERE m['role'] = 'assistant'),
 k AS (SELECT CAST(x AS INT) = 0 AND CAST(y AS INT) = 0 AS zero, {STRIP.format(f"replace(rest, '{P}', ' ')")} <> '' AS key FROM a WHERE x <> ''),
 s AS (SELECT count(*) AS steps, count(*) FILTER (WHERE zero) AS zero, count(*) FILTER (WHERE zero AND key) AS zero_key, count(*) FILTER (WHERE zero AND NOT key) AS zero_empty, count(*) FILTER (WHERE NOT zero) AS moving FROM k)"""


@query(f"WITH {IDLE} SELECT *, round(100.0 * zero / nullif(steps, 0), 4) AS zero_pct, round(100.0 * zero_key / nullif(zero, 0), 4) AS key_of_zero_pct, round(100.0 * zero_empty / nullif(zero, 0), 4) AS empty_of_zero_pct, round(100.0 * moving / nullif(steps, 0), 4) AS moving_pct FROM s")
def a11_idle_profile(spark: SparkSession, d: str) -> DataFrame:
    return reports.idle_profile(chat.turns(table(spark, d, "train"), "train_id").where("role = 'assistant'"))


DOCS = "x AS (SELECT source, coalesce(n_chars, 0) AS text_n, 900 * (doc_id % 4) AS visual_n, coalesce(n_chars, 0) + 900 * (doc_id % 4) AS n FROM documents)"


@query(
    f"WITH {DOCS} SELECT source, count(*) AS rows, CAST(sum(n) AS BIGINT) AS tokens, CAST(sum(visual_n) AS BIGINT) AS visual_tokens, CAST(sum(text_n) AS BIGINT) AS text_tokens, count(*) FILTER (WHERE n <= 3000) AS train_rows, "
    "CAST(coalesce(sum(n) FILTER (WHERE n <= 3000), 0) AS BIGINT) AS train_tokens, count(*) FILTER (WHERE n > 3000) AS overlength_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 3000), 0) AS BIGINT) AS overlength_tokens, max(n) AS longest FROM x GROUP BY source"
)
def a04_token_totals(spark: SparkSession, d: str) -> DataFrame:
    return reports.token_totals(table(spark, d, "documents"), ["source"], F.coalesce("n_chars", F.lit(0)), 900 * (F.col("doc_id") % 4), 3000)


HEX = "hex(im['bytes'])"
NUM = "CAST('0x' || substr(h, {0}, {1}) AS INTEGER)"


@query(
    f"WITH i AS (SELECT dataset, unnest(images) AS im FROM raw_trajectories), x AS (SELECT dataset, {HEX} AS h FROM i), "
    f"w AS (SELECT dataset, CASE WHEN h LIKE 'FFD8%' AND length(h) >= 58 AND substr(h, 41, 4) = 'FFC0' THEN {NUM.format(55, 4)} || 'x' || {NUM.format(51, 4)} WHEN h LIKE '89504E47%' AND length(h) >= 48 THEN {NUM.format(33, 8)} || 'x' || {NUM.format(41, 8)} END AS dims FROM x) "
    "SELECT dataset, dims, count(*) AS images FROM w GROUP BY dataset, dims"
)
def a05_image_dimensions(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw_trajectories").select("dataset", images.image_sizes(F.col("images.bytes")).alias("sizes"))
    return raw.select("dataset", F.explode("sizes").alias("dims")).groupBy("dataset", "dims").agg(F.count("*").alias("images"))


@query(
    f"WITH {DOCS}, g AS (SELECT source, sum(n) AS t, sum(visual_n) + sum(text_n) AS u FROM x GROUP BY source) SELECT 'tokens' AS \"check\", count(*) FILTER (WHERE t <> u) AS violations FROM g "
    "UNION ALL SELECT 'chars', count(*) FILTER (WHERE n_chars IS DISTINCT FROM length(text)) FROM documents"
)
def a06_invariants(spark: SparkSession, d: str) -> DataFrame:
    t = a04_token_totals(spark, d).where("tokens <> visual_tokens + text_tokens")
    c = table(spark, d, "documents").where(~F.col("n_chars").eqNullSafe(F.length("text")))
    return reports.violations([("tokens", t), ("chars", c)])


COUNTERS = "c AS (SELECT run_id, step, logged_at, channel, tokens FROM (UNPIVOT (SELECT run_id, step, logged_at, trained_tokens_ember_fall AS ember_fall, trained_tokens_tide_watch AS tide_watch, trained_tokens_scene_counting AS scene_counting FROM metric_log) ON ember_fall, tide_watch, scene_counting INTO NAME channel VALUE tokens)), g AS (SELECT run_id, step, channel, max(tokens) AS tokens FROM c GROUP BY ALL)"


def _counters(spark: SparkSession, d: str) -> DataFrame:
    return logs.counters(table(spark, d, "metric_log"), ["run_id", "step"]).groupBy("run_id", "step", "channel").agg(F.max("tokens").alias("tokens"))


@query(f"WITH {COUNTERS} SELECT run_id, step, channel, CAST(sum(tokens) OVER (PARTITION BY run_id, channel ORDER BY step NULLS FIRST) AS BIGINT) AS running FROM g")
def a12_running_tokens(spark: SparkSession, d: str) -> DataFrame:
    w = W.partitionBy("run_id", "channel").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return _counters(spark, d).select("run_id", "step", "channel", F.sum("tokens").over(w).alias("running"))


@query(f"WITH {COUNTERS}, i AS (SELECT run_id, step, CAST(sum(tokens) AS BIGINT) AS interval_total FROM g GROUP BY ALL) SELECT run_id, step, interval_total, CAST(sum(interval_total) OVER (PARTITION BY run_id ORDER BY step NULLS FIRST) AS BIGINT) AS total FROM i")
def a12_interval_totals(spark: SparkSession, d: str) -> DataFrame:
    i = _counters(spark, d).groupBy("run_id", "step").agg(F.sum("tokens").alias("interval_total"))
    w = W.partitionBy("run_id").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return i.withColumn("total", F.sum("interval_total").over(w))


@query(f"WITH {COUNTERS} SELECT channel, count(*) AS n, CAST(sum(tokens) AS BIGINT) AS tokens FROM g GROUP BY channel")
def a13_two_phase_sum(spark: SparkSession, d: str) -> DataFrame:
    return _counters(spark, d).groupBy("channel").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))


@query("WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cu, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax) AS k FROM lineitem) SELECT l_orderkey, k, cu - coalesce(lag(cu) OVER (PARTITION BY l_orderkey ORDER BY k), 0) AS length FROM c")
def a14_segment_lengths(spark: SparkSession, d: str) -> DataFrame:
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    w = W.partitionBy("l_orderkey").orderBy(*order)
    c = table(spark, d, "lineitem").select("l_orderkey", F.row_number().over(w).cast("bigint").alias("k"), F.sum(F.col("l_quantity").cast("bigint")).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("cu"))
    return c.select("l_orderkey", "k", (F.col("cu") - F.coalesce(F.lag("cu").over(W.partitionBy("l_orderkey").orderBy("k")), F.lit(0))).alias("length"))


@query(f"WITH {COUNTERS} SELECT run_id, channel, max_by(tokens, step) AS tokens FROM g GROUP BY run_id, channel")
def a15_last_values(spark: SparkSession, d: str) -> DataFrame:
    return _counters(spark, d).groupBy("run_id", "channel").agg(F.max_by("tokens", "step").alias("tokens"))


SERIES = "l AS (SELECT run_id, step, max(loss) AS loss, max(grad_norm) AS grad_norm FROM metric_log WHERE loss IS NOT NULL AND NOT isnan(loss) GROUP BY run_id, step)"


def _series(spark: SparkSession, d: str) -> DataFrame:
    ok = table(spark, d, "metric_log").where("loss IS NOT NULL AND NOT isnan(loss)")
    return ok.groupBy("run_id", "step").agg(F.max("loss").alias("loss"), F.max("grad_norm").alias("grad_norm"))


WEIGHT = "coalesce(trained_tokens_ember_fall, 0) + coalesce(trained_tokens_tide_watch, 0) + coalesce(trained_tokens_scene_counting, 0)"


@query(
    f"WITH b AS (SELECT run_id, step, loss, {WEIGHT} AS weight, count(*) AS copies FROM metric_log WHERE loss IS NOT NULL AND NOT isnan(loss) GROUP BY ALL) "
    "SELECT run_id, round(sum(loss * weight) / nullif(sum(weight), 0), 9) AS loss, CAST(sum(weight) AS BIGINT) AS tokens, count(*) AS batches, CAST(sum(copies) - count(*) AS BIGINT) AS replayed FROM b GROUP BY run_id"
)
def a16_weighted_loss(spark: SparkSession, d: str) -> DataFrame:
    """Loss weighted by supervised tokens; a batch logged again is a replay and has weight 0."""
    ok = table(spark, d, "metric_log").where("loss IS NOT NULL AND NOT isnan(loss)").withColumn("weight", F.expr(WEIGHT))
    return reports.weighted_loss(ok, "run_id", ["step", "loss", "weight"])


@query("WITH t AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS step, user_id % 4 AS rank, sum(value) AS whole, sum(value) FILTER (WHERE event_type = 'view') AS part FROM events GROUP BY ALL), m AS (SELECT step, max(whole) AS whole, max(coalesce(part, 0)) AS part FROM t GROUP BY step) SELECT step, round(whole, 6) AS whole, round(greatest(0, whole - part), 6) AS rest, round(greatest(0, whole - part) / nullif(whole, 0), 6) AS share FROM m")
def a17_slowest_rank(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("step"), (F.col("user_id") % 4).alias("rank")).agg(F.sum("value").alias("whole"), F.coalesce(F.sum(F.when(F.col("event_type") == "view", F.col("value"))), F.lit(0.0)).alias("part"))
    m = t.groupBy("step").agg(F.max("whole").alias("whole"), F.max("part").alias("part"))
    rest = F.greatest(F.lit(0.0), F.col("whole") - F.col("part"))
    return m.select("step", F.round("whole", 6).alias("whole"), F.round(rest, 6).alias("rest"), F.round(rest / F.nullif("whole", F.lit(0.0)), 6).alias("share"))


@query(f"WITH {SERIES} SELECT run_id, round(min_by(loss, step), 9) AS first, round(max_by(loss, step), 9) AS last, round(min(loss), 9) AS lowest FROM l GROUP BY run_id")
def a20_endpoints(spark: SparkSession, d: str) -> DataFrame:
    r = lambda c: F.round(c, 9)
    return _series(spark, d).groupBy("run_id").agg(r(F.min_by("loss", "step")).alias("first"), r(F.max_by("loss", "step")).alias("last"), r(F.min("loss")).alias("lowest"))


@query(f"WITH {SERIES} SELECT run_id, step, round(avg(loss) OVER (PARTITION BY run_id ORDER BY step NULLS FIRST ROWS 20 PRECEDING), 9) AS mean FROM l")
def w02_trailing_mean(spark: SparkSession, d: str) -> DataFrame:
    mean: Column = logs.trailing_mean(F.col("loss"), [F.col("run_id")], [F.col("step")])
    return _series(spark, d).select("run_id", "step", F.round(mean, 9).alias("mean"))


STEP = "coalesce(try_cast(split_part(iteration, '/', 1) AS BIGINT), nullif(global_step, 0), nullif(step, 0))"


@query(f"SELECT run_id, iteration, step AS raw_step, {STEP} AS step FROM metric_log")
def f20_step(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "metric_log").select("run_id", "iteration", F.col("step").alias("raw_step"), logs.step_of(F.col("iteration"), F.col("global_step"), F.col("step")).alias("step"))


@query(f"SELECT run_id, step, loss FROM (SELECT run_id, {STEP} AS step, CASE WHEN NOT isnan(loss) THEN round(loss, 9) END AS loss FROM metric_log) WHERE step <= 100")
def f21_first_steps(spark: SparkSession, d: str) -> DataFrame:
    loss = F.when(~F.isnan("loss"), F.round("loss", 9))
    return table(spark, d, "metric_log").select("run_id", logs.step_of(F.col("iteration"), F.col("global_step"), F.col("step")).alias("step"), loss.alias("loss")).where("step <= 100")


@query("SELECT run_id, 'train/' || name AS name, count(*) AS n, round(sum(value), 4) AS total FROM (UNPIVOT (SELECT run_id, loss, eval_loss, grad_norm, CAST(trained_tokens_ember_fall AS DOUBLE) AS trained_tokens_ember_fall FROM metric_log) ON loss, eval_loss, grad_norm, trained_tokens_ember_fall INTO NAME name VALUE value) WHERE NOT isnan(value) GROUP BY ALL")
def f07_numeric_only(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "metric_log").select("run_id", "iteration", "loss", "eval_loss", "grad_norm", "trained_tokens_ember_fall", "logged_at")
    return logs.numeric_pairs(t, ["run_id"]).groupBy("run_id", "name").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("SELECT step, round(CASE WHEN step >= 100 THEN 1e-5 ELSE 1e-7 + (1e-5 - 1e-7) * step / 100.0 END, 12) AS lr FROM (SELECT DISTINCT step FROM metric_log)")
def c23_warm_up(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "metric_log").select("step").distinct().select("step", F.round(logs.warm_up(F.col("step"), 1e-7, 1e-5, 100), 12).alias("lr"))


@query(
    "SELECT run_id, step, 'train/' || name AS name, value FROM (UNPIVOT (SELECT run_id, step, loss, eval_loss, mtp_1_loss, grad_norm, lr, CAST(global_step AS DOUBLE) AS global_step, CAST(trained_tokens_ember_fall AS DOUBLE) AS trained_tokens_ember_fall, "
    "CAST(trained_tokens_tide_watch AS DOUBLE) AS trained_tokens_tide_watch, CAST(trained_tokens_scene_counting AS DOUBLE) AS trained_tokens_scene_counting FROM metric_log) "
    "ON loss, eval_loss, mtp_1_loss, grad_norm, lr, global_step, trained_tokens_ember_fall, trained_tokens_tide_watch, trained_tokens_scene_counting INTO NAME name VALUE value) WHERE NOT isnan(value)"
)
def k09_metric_push(spark: SparkSession, d: str) -> DataFrame:
    """What goes to a tracker: every numeric value of the log under its name with a prefix, with its step."""
    return logs.numeric_pairs(table(spark, d, "metric_log"), ["run_id", "step"])


@query(f"SELECT traj, turn, len(string_split({BODY}, '{P}')) - 1 AS segments FROM eval_records WHERE {STRIP.format(BODY)} <> ''")
def c07_segments(spark: SparkSession, d: str) -> DataFrame:
    e = _eval(spark, d).where(A.well_formed(F.col("pred")))
    return e.select("traj", "turn", F.size(A.keys(F.col("pred"))).cast("bigint").alias("segments"))


CELLS = "greatest(1, round_even({0} / 32.0, 0))"


@query(f"SELECT channel, CAST({CELLS.format('frame_width')} * {CELLS.format('frame_height')} AS BIGINT) AS tokens FROM channels")
def c14_visual_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "channels").select("channel", images.image_tokens(F.col("frame_width"), F.col("frame_height")).alias("tokens"))


@query(r"SELECT doc_id, CASE WHEN regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') = '' THEN 0 ELSE len(regexp_split_to_array(regexp_replace(text, '^\s+|\s+$', '', 'g'), '\s+')) END AS tokens FROM documents")
def c16_words(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", tokens.word_count(F.col("text")).alias("tokens"))


TEMPLATE = "list_transform(messages, lambda m: '<|im_start|>' || coalesce(m['role'], '') || chr(10) || coalesce(m['content'], '') || '<|im_end|>' || chr(10))"


@query(rf"WITH r AS (SELECT train_id, regexp_replace(coalesce(array_to_string({TEMPLATE}, ''), ''), '^\s+|\s+$', '', 'g') AS t FROM train) SELECT train_id, CASE WHEN t = '' THEN 0 ELSE len(regexp_split_to_array(t, '\s+')) END AS tokens FROM r")
def c16_chat_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of each conversation in its chat template, by the proxy of white space; `tokens.token_count` takes a tokenizer instead."""
    return table(spark, d, "train").select("train_id", tokens.word_count(chat.rendered(F.col("messages"))).alias("tokens"))
