"""Scans, conversion, projections, joins of turns, counts, splits and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions import chat, paths
from loomspark.functions.hashing import order_key
from loomspark.operators import hooks, reports, resume, split
from loomspark.operators.graph import small_broadcast
from loomspark.operators.intervals import locate
from loomspark.session import small_rows, table
from loomspark.sources.readers import catalog_rows, chunks_of, footers, row_addresses, with_row_index
from loomspark.sources.sinks import image_path
from loomspark.workloads import query

SEED = 42
ROLE = "CASE {0} WHEN 'system' THEN 'system' WHEN 'human' THEN 'user' WHEN 'user' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'assistant' THEN 'assistant' END"
RAW_TURNS = 'SELECT traj_id, generate_subscripts(conversations, 1) - 1 AS turn, unnest(conversations) AS t FROM raw_trajectories'
TRAIN_TURNS = "SELECT train_id, generate_subscripts(messages, 1) - 1 AS turn, unnest(messages) AS m FROM train"
CONVERTED = f"""turns AS ({RAW_TURNS}),
 mapped AS (SELECT traj_id, turn, {ROLE.format("t['from']")} AS role, coalesce(t['value'], '') AS content FROM turns),
 answers AS (SELECT DISTINCT traj_id FROM mapped WHERE role = 'assistant' AND content <> ''),
 kept AS (SELECT r.* FROM raw_trajectories r JOIN answers USING (traj_id) WHERE len(images) > 0 AND len(conversations) > 0)"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_trajectories")


@query("SELECT traj_id, dataset, CAST(len(images) AS INTEGER) AS n_images, CAST(len(conversations) AS INTEGER) AS n_turns FROM raw_trajectories")
def s01_scan(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    return raw.select("traj_id", "dataset", chat.list_size(raw, "images").alias("n_images"), chat.list_size(raw, "conversations").alias("n_turns"))


@query("SELECT shard, CAST(dense_rank() OVER (ORDER BY shard) - 1 AS INTEGER) AS chunk_id FROM (SELECT DISTINCT shard FROM raw_trajectories)")
def s02_chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    return split.chunk_split(_raw(spark, d), "shard", 0).select("shard", "chunk_id")


@query(
    "SELECT 0::BIGINT AS chunk_id, 'customer' AS name, count(*) AS rows FROM customer UNION ALL SELECT 1, 'nation', count(*) FROM nation UNION ALL SELECT 2, 'part', count(*) FROM part UNION ALL SELECT 3, 'supplier', count(*) FROM supplier"
)
def s02_file_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Files numbered in the order of their names, with their rows."""
    groups = footers(spark, [f"{d}/{t}.parquet" for t in ("supplier", "nation", "part", "customer")])
    return chunks_of(groups).select("chunk_id", F.regexp_extract("file", r"([^/]+)\.parquet$", 1).alias("name"), "rows")


@query("SELECT count(*) AS n, CAST(sum(len(images)) AS BIGINT) AS images, CAST(sum(len(conversations)) AS BIGINT) AS turns FROM raw_trajectories")
def s03_pruned_scan(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    return raw.agg(F.count("*").alias("n"), F.sum(chat.list_size(raw, "images")).alias("images"), F.sum(chat.list_size(raw, "conversations")).alias("turns"))


#: Rows in the order of the files, which DuckDB keeps as well.
PLACED = "(SELECT *, row_number() OVER () - 1 AS row_index FROM documents)"


@query(f"SELECT doc_id, row_index FROM {PLACED} WHERE row_index >= 500")
def s04_resume_scan(spark: SparkSession, d: str) -> DataFrame:
    return row_addresses(spark, f"{d}/documents.parquet", "doc_id").where("row_index >= 500")


@query(f"SELECT row_index // 50 AS pos, doc_id, source FROM {PLACED} WHERE row_index % 50 = 0")
def s05_point_lookup(spark: SparkSession, d: str) -> DataFrame:
    docs = row_addresses(spark, f"{d}/documents.parquet", "doc_id", "source")
    refs = spark.range(0, table(spark, d, "documents").count(), 50).select(F.expr("id div 50").alias("pos"), F.col("id").alias("row_index"))
    return docs.join(small_broadcast(refs), "row_index").select("pos", "doc_id", "source")


@query("SELECT canonical_name, stats['output_rows'] AS output_rows FROM canonical_index WHERE canonical_name IS NOT NULL AND stats['output_rows'] > 0")
def s11_catalog(spark: SparkSession, d: str) -> DataFrame:
    return catalog_rows(table(spark, d, "canonical_index"))


@query("SELECT 'train' AS name, count(*) AS n FROM train UNION ALL SELECT 'val', count(*) FROM val UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def s12_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row counts from the files' footers."""
    named = {f"{d}/{t}.parquet": t for t in ("train", "val", "documents", "lineitem")}
    name = F.regexp_extract("file", r"/([^/]+)\.parquet", 1)
    return footers(spark, list(named)).groupBy(name.alias("name")).agg(F.sum("rows").alias("n"))


@query("SELECT i AS id, 'Return the integer after ' || i || '.' AS question, CAST(i + 1 AS VARCHAR) AS answer FROM range(256) t(i)")
def s18_synthetic(spark: SparkSession, d: str) -> DataFrame:
    return spark.range(256).select("id", F.concat(F.lit("Return the integer after "), "id", F.lit(".")).alias("question"), (F.col("id") + 1).cast("string").alias("answer"))


@query(
    "WITH c AS (SELECT shard, dense_rank() OVER (ORDER BY shard) - 1 AS chunk FROM (SELECT DISTINCT shard FROM raw_trajectories)), "
    "i AS (SELECT traj_id, shard, row_index, generate_subscripts(images, 1) - 1 AS place, unnest(images) AS im FROM raw_trajectories) "
    "SELECT traj_id, place, printf('chunk_%03d/row_%04d/%02d.jpg', chunk, row_index, place) AS path FROM i JOIN c USING (shard) WHERE im['bytes'] IS NOT NULL"
)
def k02_image_paths(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    chunks = split.chunk_split(raw, "shard", 0)
    images = raw.select("traj_id", "shard", "row_index", F.posexplode("images").alias("place", "im")).where("im.bytes IS NOT NULL")
    return images.join(small_broadcast(chunks), "shard").select("traj_id", F.col("place").cast("bigint").alias("place"), image_path(F.col("chunk_id"), F.col("row_index"), F.col("place")).alias("path"))


@query("SELECT dataset, shard, count(*) AS n, CAST(coalesce(sum(len(images)), 0) AS BIGINT) AS images, max(exported_at) AS last FROM raw_trajectories GROUP BY dataset, shard")
def k06_shard_stats(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    n = F.sum(chat.list_size(raw, "images"))
    return raw.groupBy("dataset", "shard").agg(F.count("*").alias("n"), F.coalesce(n, F.lit(0)).alias("images"), F.max("exported_at").alias("last"))


@query(f"SELECT traj_id, turn, {ROLE.format("t['from']")} AS role FROM ({RAW_TURNS}) WHERE {ROLE.format("t['from']")} IS NOT NULL")
def f01_role_map(spark: SparkSession, d: str) -> DataFrame:
    t = _raw(spark, d).select("traj_id", F.posexplode("conversations").alias("turn", "t"))
    return t.select("traj_id", F.col("turn").cast("bigint").alias("turn"), chat.role_of(F.col("t")["from"]).alias("role")).where("role IS NOT NULL")


@query(
    f"SELECT traj_id, turn, coalesce(nullif(t['from'], ''), nullif(lang, ''), '') AS name, coalesce(nullif(t['value'], ''), nullif(dataset, ''), '') AS text FROM (SELECT traj_id, lang, dataset, generate_subscripts(conversations, 1) - 1 AS turn, unnest(conversations) AS t FROM raw_trajectories)"
)
def f02_field_fallback(spark: SparkSession, d: str) -> DataFrame:
    t = _raw(spark, d).select("traj_id", "lang", "dataset", F.posexplode("conversations").alias("turn", "t"))
    return t.select("traj_id", F.col("turn").cast("bigint").alias("turn"), chat.first_filled(F.col("t")["from"], F.col("lang")).alias("name"), chat.first_filled(F.col("t")["value"], F.col("dataset")).alias("text"))


@query("SELECT traj_id FROM raw_trajectories WHERE len(images) > 0 AND len(conversations) > 0")
def f03_has_images_and_turns(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    return raw.where((chat.list_size(raw, "images") > 0) & (chat.list_size(raw, "conversations") > 0)).select("traj_id")


@query(f"WITH {CONVERTED} SELECT traj_id FROM kept")
def f04_has_answer(spark: SparkSession, d: str) -> DataFrame:
    return chat.convert(_raw(spark, d)).select("traj_id")


@query("SELECT train_id, messages, images, game FROM train")
def f05_whitelist(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train").select("train_id", "messages", "images", "game")


@query("SELECT traj_id, 'ember_fall' AS game FROM raw_trajectories")
def f06_constant(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("traj_id", F.lit("ember_fall").alias("game"))


@query("SELECT train_id, coalesce(game, 'unknown') AS channel FROM train")
def f08_channel_by_game(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train").select("train_id", F.coalesce("game", F.lit("unknown")).alias("channel"))


@query(
    "WITH s AS (SELECT train_id, channel, regexp_replace(regexp_replace(coalesce(nullif(game, ''), 'unknown'), '/+$', ''), '^.*/', '') AS source FROM train) "
    "SELECT train_id, coalesce(nullif(channel, ''), CASE WHEN regexp_matches(lower(source), 'ember|余烬') THEN 'ember_fall' ELSE source END) AS channel FROM s"
)
def f09_channel_by_dataset(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train").select("train_id", paths.channel_of_source(F.col("channel"), F.col("game"), ["ember", "余烬"], "ember_fall").alias("channel"))


@query("SELECT traj_id, dataset AS channel FROM raw_trajectories")
def f10_channel_override(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).withColumn("channel", F.col("dataset")).select("traj_id", "channel")


@query("SELECT traj_id, place, CAST(octet_length(im['bytes']) AS INTEGER) AS size, im['path'] AS path FROM (SELECT traj_id, generate_subscripts(images, 1) - 1 AS place, unnest(images) AS im FROM raw_trajectories)")
def f11_image_cells(spark: SparkSession, d: str) -> DataFrame:
    t = _raw(spark, d).select("traj_id", F.posexplode("images").alias("place", "im"))
    return t.select("traj_id", F.col("place").cast("bigint").alias("place"), F.octet_length("im.bytes").alias("size"), F.col("im.path").alias("path"))


TRAIN_PATHS = "SELECT train_id, unnest(images) AS p FROM train"
#: Parts of a path as a fold over its pieces, and a path made of them.
PARTS = "list_reduce(list_prepend([]::VARCHAR[], list_transform(string_split({0}, '/'), lambda x: [x])), lambda a, x: CASE WHEN x[1] IN ('', '.') THEN a WHEN x[1] = '..' AND len(a) > 0 AND a[-1] <> '..' THEN a[:-2] WHEN x[1] = '..' AND {0} LIKE '/%' THEN a ELSE list_concat(a, x) END)"


@query(f"WITH a AS (SELECT train_id, p, CASE WHEN p LIKE '/%' THEN p ELSE '/data/./bc/../bc/' || p END AS q FROM ({TRAIN_PATHS})) SELECT train_id, CASE WHEN p IS NULL THEN NULL ELSE '/' || array_to_string({PARTS.format('q')}, '/') END AS path FROM a")
def f12_absolute(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "train").select("train_id", F.explode("images").alias("p"))
    return p.select("train_id", paths.normal(paths.absolute(F.col("p"), "/data/./bc/../bc")).alias("path"))


@query(
    f"WITH a AS (SELECT train_id, p, {PARTS.format('p')} AS x FROM ({TRAIN_PATHS})), k AS (SELECT *, CASE WHEN x[1] IS DISTINCT FROM 'images' THEN 0 WHEN x[2] IS DISTINCT FROM 'common' THEN 1 ELSE 2 END AS same FROM a) "
    "SELECT train_id, CASE WHEN p IS NULL THEN NULL WHEN len(x) = 2 AND same = 2 THEN '.' ELSE array_to_string(list_concat(['..', '..'][:2 - same], x[same + 1:]), '/') END AS path FROM k"
)
def f13_relative(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "train").select("train_id", F.explode("images").alias("p"))
    return p.select("train_id", paths.relative(F.col("p"), "images/common").alias("path"))


@query("SELECT train_id, list_transform(images, lambda p: replace(p, 'images/chunk_', 'frames/chunk_')) AS images FROM train")
def f14_rewrite(spark: SparkSession, d: str) -> DataFrame:
    new = F.transform("images", lambda p: F.replace(p, F.lit("images/chunk_"), F.lit("frames/chunk_")))
    return table(spark, d, "train").select("train_id", new.alias("images"))


@query(
    f"WITH have AS (SELECT DISTINCT p FROM ({TRAIN_PATHS}) WHERE p IS NOT NULL), asked AS (SELECT val_id, unnest(images) AS p FROM val) "
    "SELECT val_id, count(*) AS missing FROM asked WHERE p IS NOT NULL AND p NOT IN (SELECT p FROM have) GROUP BY val_id"
)
def f15_missing_images(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "train").select(F.explode("images").alias("p")).distinct()
    asked = table(spark, d, "val").select("val_id", F.explode("images").alias("p")).where("p IS NOT NULL")
    return asked.join(have, "p", "left_anti").groupBy("val_id").agg(F.count("*").alias("missing"))


@query(
    "SELECT name AS game, name AS channel, count(*) AS n, CAST(coalesce(sum(len(images)), 0) AS BIGINT) AS images, max(refused) AS refused FROM (SELECT 'train' AS name, messages, images FROM train UNION ALL SELECT 'val', messages, images FROM val) t "
    "JOIN (SELECT 'train' AS name, count(*) FILTER (WHERE messages IS NULL OR images IS NULL) AS refused FROM train UNION ALL SELECT 'val', count(*) FILTER (WHERE messages IS NULL OR images IS NULL) FROM val) r USING (name) WHERE messages IS NOT NULL AND images IS NOT NULL GROUP BY name"
)
def f16_view(spark: SparkSession, d: str) -> DataFrame:
    """Rows and images of each view; rows that lack messages or images aren't in it (with `strict` they are an error) and are counted."""
    seen, lost = [], []
    for name in ("train", "val"):
        rows = table(spark, d, name).select("messages", "images", "game", "channel")
        seen.append(split.view(rows, name).select("game", "channel", F.size("images").alias("k")))
        lost.append(rows.agg(F.count_if(F.col("messages").isNull() | F.col("images").isNull()).alias("refused")).select(F.lit(name).alias("game"), "refused"))
    counts = seen[0].union(seen[1]).groupBy("game", "channel").agg(F.count("*").alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("images"))
    return counts.join(lost[0].union(lost[1]), "game")


@query("SELECT doc_id, source FROM documents WHERE source IS NOT NULL AND source NOT LIKE '%\\_notes' ESCAPE '\\' AND source NOT IN ('run_reports', 'config_dump')")
def f17_exclude_sources(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("source")
    return table(spark, d, "documents").where(s.isNotNull() & ~s.like(r"%\_notes") & ~s.isin("run_reports", "config_dump")).select("doc_id", "source")


@query("SELECT n_chars > 4096 AS over, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE n_chars IS NOT NULL GROUP BY 1")
def f18_overlength(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").where("n_chars IS NOT NULL")
    return t.groupBy(split.overlength(F.col("n_chars"), 4096).alias("over")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(
    "SELECT source, doc_id, n_chars, CAST(NULL AS BIGINT) AS dropped FROM documents WHERE coalesce(n_chars, 0) <= 4096 UNION ALL SELECT source, NULL, NULL, count(*) FROM documents WHERE n_chars > 4096 GROUP BY source"
)
def f19_drop_overlength(spark: SparkSession, d: str) -> DataFrame:
    """The rows that aren't too long (a null length counts as 0) and, for each source that lost some, a line that says how many."""
    return split.drop_overlength(table(spark, d, "documents").select("source", "doc_id", "n_chars"), "n_chars", 4096, "source")


@query("SELECT dataset, shard, row_index, max(exported_at) AS exported_at, count(*) AS deliveries FROM raw_trajectories WHERE shard IS NOT NULL AND row_index IS NOT NULL GROUP BY dataset, shard, row_index")
def f23_public_rows(spark: SparkSession, d: str) -> DataFrame:
    t = _raw(spark, d).where("shard IS NOT NULL AND row_index IS NOT NULL").withColumn("_ref", F.struct("shard", "row_index"))
    return t.groupBy("dataset", "_ref").agg(F.max("exported_at").alias("exported_at"), F.count("*").alias("deliveries")).select("dataset", "_ref.*", "exported_at", "deliveries")


@query("WITH c AS (SELECT DISTINCT dataset FROM raw_trajectories WHERE dataset IS NOT NULL) SELECT dataset, canonical_name IS NOT NULL AS listed, domain FROM c LEFT JOIN canonical_index ON dataset = canonical_name")
def j02_config_catalog(spark: SparkSession, d: str) -> DataFrame:
    names = _raw(spark, d).select("dataset").where("dataset IS NOT NULL").distinct()
    catalog = table(spark, d, "canonical_index").select(F.col("canonical_name").alias("dataset"), "domain", F.lit(True).alias("found"))
    return names.join(small_broadcast(catalog), "dataset", "left").select("dataset", F.coalesce("found", F.lit(False)).alias("listed"), "domain")


@query(
    "WITH m AS (SELECT DISTINCT '/data/' || shard AS path, dataset FROM raw_trajectories WHERE dataset IS NOT NULL), s AS (SELECT DISTINCT shard FROM raw_trajectories), "
    "c AS (SELECT '/data/' || shard AS path, domain FROM s JOIN canonical_index ON regexp_replace(shard, '-[0-9]+$', '') = canonical_name) SELECT m.path, m.dataset, c.domain FROM m JOIN c USING (path)"
)
def j03_source_by_path(spark: SparkSession, d: str) -> DataFrame:
    """Sources joined with a manifest of all shards by path; the manifest names the shards of each catalog entry."""
    path = F.concat(F.lit("/data/"), "shard").alias("path")
    m = _raw(spark, d).where("dataset IS NOT NULL").select(path, "dataset").distinct()
    catalog = table(spark, d, "canonical_index").select("canonical_name", "domain")
    shards = _raw(spark, d).select("shard").distinct().withColumn("canonical_name", F.regexp_replace("shard", "-[0-9]+$", ""))
    manifest = shards.join(small_broadcast(catalog), "canonical_name").select(path, "domain")
    return m.join(manifest, "path").select("path", "dataset", "domain")


PAIRS = f"""t AS ({TRAIN_TURNS}), u AS (SELECT train_id, turn, m['role'] AS role, m['content'] AS content FROM t),
 w AS (SELECT *, lead(role) OVER p AS next_role, lead(content) OVER p AS answer, count(*) FILTER (WHERE role = 'user') OVER (PARTITION BY train_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS users_so_far
  FROM u WINDOW p AS (PARTITION BY train_id ORDER BY turn)),
 pairs AS (SELECT train_id, turn, row_number() OVER (PARTITION BY train_id ORDER BY turn) - 1 AS pair, users_so_far, content AS question, answer FROM w WHERE role = 'user' AND next_role = 'assistant')"""


def _pairs(spark: SparkSession, d: str, *keep: str, texts: bool = False) -> DataFrame:
    return chat.answered(table(spark, d, "train"), "train_id", *keep, texts=texts)


@query(f"WITH {PAIRS} SELECT train_id, turn, question, answer FROM pairs")
def j04_answered_turns(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d, texts=True).select("train_id", F.col("turn").cast("bigint").alias("turn"), "question", "answer")


@query(f"WITH {PAIRS} SELECT train_id, count(*) AS pairs FROM pairs GROUP BY train_id")
def w01_pairs(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.size(chat.answered_in(F.col("messages"), texts=False)).cast("bigint")
    return table(spark, d, "train").select("train_id", pairs.alias("pairs")).where("pairs > 0")


@query(f"WITH {PAIRS} SELECT train_id, turn, pair FROM pairs WHERE pair < 3")
def w03_first_turns(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).where("pair < 3").select("train_id", F.col("turn").cast("bigint").alias("turn"), F.col("pair").cast("bigint").alias("pair"))


@query(f"WITH {PAIRS} SELECT p.train_id, pair, CAST(len(list_slice(images, 1, users_so_far)) AS INTEGER) AS n_images FROM pairs p JOIN train USING (train_id)")
def w04_images_so_far(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "train").withColumn("n", F.when(F.col("images").isNotNull(), F.size("images")))
    n = F.least("n", F.col("users_so_far").cast("int"))
    n = F.when(F.col("n").isNotNull(), n)
    return chat.answered(rows, "train_id", "n", texts=False).select("train_id", F.col("pair").cast("bigint").alias("pair"), n.alias("n_images"))


@query(f"WITH {PAIRS} SELECT p.train_id, pair, list_transform(list_slice(messages, 1, turn + 1), lambda x: x['role']) AS context FROM pairs p JOIN train USING (train_id)")
def w05_context(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "train").withColumn("roles", F.transform("messages", lambda m: m["role"]))
    return chat.answered(rows, "train_id", "roles", texts=False).select("train_id", F.col("pair").cast("bigint").alias("pair"), chat.context(F.col("roles"), F.col("turn")).alias("context"))


@query(
    "SELECT traj, turn, g.gt, p.pred FROM (SELECT DISTINCT traj, turn, pred FROM eval_records WHERE pred IS NOT NULL) p JOIN (SELECT DISTINCT traj, turn, gt FROM eval_records) g USING (traj, turn)"
)
def j05_pred_truth(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "eval_records")
    predictions, truths = e.where("pred IS NOT NULL").select("traj", "turn", "pred").distinct(), e.select("traj", "turn", "gt").distinct()
    return predictions.join(truths, ["traj", "turn"]).select("traj", "turn", "gt", "pred")


SHARDS = "s AS (SELECT shard, count(*) AS n FROM raw_trajectories GROUP BY shard), c AS (SELECT shard, n, CAST(sum(n) OVER (ORDER BY shard) - n AS BIGINT) AS start FROM s)"


def _shards(spark: SparkSession, d: str) -> DataFrame:
    s = _raw(spark, d).groupBy("shard").agg(F.count("*").alias("n"))  # one row for each shard file
    return s.withColumn("start", F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))


@query(f"WITH {SHARDS} SELECT shard, n, start FROM c")
def w06_shard_offsets(spark: SparkSession, d: str) -> DataFrame:
    return _shards(spark, d)


@query(
    f"WITH {SHARDS}, t AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM s), r AS (SELECT r AS rank, total * r // 3 AS a, total * (r + 1) // 3 AS b FROM range(3) x(r), t) "
    "SELECT shard, rank, greatest(start, a) - start AS skip, least(start + n, b) - greatest(start, a) AS take FROM c JOIN r ON start < b AND a < start + n"
)
def j06_rank_overlap(spark: SparkSession, d: str) -> DataFrame:
    c = _shards(spark, d)
    total = c.agg(F.sum("n")).first()[0] or 1
    # The rank of a row is floor arithmetic, so the ranks of a shard are those from its first row's to its last row's.
    rank = lambda at: F.expr(f"(({at} + 1) * 3 - 1) div {total}")
    j = c.where("n > 0").withColumn("rank", F.explode(F.sequence(rank("start"), rank("start + n - 1"))))
    a, b = F.expr(f"{total} * rank div 3"), F.expr(f"{total} * (rank + 1) div 3")
    return j.select("shard", "rank", (F.greatest("start", a) - F.col("start")).alias("skip"), (F.least(F.col("start") + F.col("n"), b) - F.greatest("start", a)).alias("take"))


@query(f"WITH {SHARDS}, t AS (SELECT CAST(sum(n) AS BIGINT) AS total FROM s), q AS (SELECT i * 50 AS idx, i AS pos FROM t, range((total + 49) // 50) x(i)) SELECT pos, idx, shard FROM q JOIN c ON idx >= start AND idx < start + n")
def j07_chunk_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = _shards(spark, d)
    total = c.agg(F.sum("n")).first()[0] or 0
    q = spark.range(0, total, 50).select(F.expr("id div 50").alias("pos"), F.col("id").alias("idx"))
    return locate(q, "idx", c, "start", "n").select("pos", "idx", "shard")


@query(f"WITH h AS (SELECT shard FROM (SELECT DISTINCT shard FROM raw_trajectories WHERE shard IS NOT NULL) ORDER BY sha256('{SEED}:' || shard), shard LIMIT 8) SELECT traj_id FROM raw_trajectories WHERE shard IS NULL OR shard NOT IN (SELECT shard FROM h)")
def j08_held_out(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    held = split.sample(raw.where("shard IS NOT NULL").select("shard").distinct(), "shard", SEED, 8)
    return raw.join(small_broadcast(held), "shard", "left_anti").select("traj_id")


@query("SELECT coalesce(channel, 'unknown') AS channel, count(*) AS n FROM train GROUP BY 1")
def a01_by_channel(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train").groupBy(F.coalesce("channel", F.lit("unknown")).alias("channel")).agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS rows FROM (SELECT coalesce(source, 'unknown') AS source FROM documents) GROUP BY ROLLUP (source)")
def a02_with_total(spark: SparkSession, d: str) -> DataFrame:
    return reports.counts_with_total(table(spark, d, "documents"), "source")


@query(
    f"WITH {CONVERTED} SELECT r.shard, count(*) AS rows, count(k.traj_id) AS converted, CAST(coalesce(sum(CASE WHEN k.traj_id IS NOT NULL THEN len(r.images) END), 0) AS BIGINT) AS images, "
    "CAST(coalesce(sum(u.n), 0) AS BIGINT) AS turns_skipped FROM raw_trajectories r LEFT JOIN kept k USING (traj_id) LEFT JOIN (SELECT traj_id, count(*) AS n FROM mapped WHERE role IS NULL GROUP BY traj_id) u ON u.traj_id = k.traj_id GROUP BY ROLLUP (r.shard)"
)
def a03_conversion_totals(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    images, m = chat.list_size(raw, "images"), chat.to_messages(F.col("conversations"))
    ok = F.coalesce((images > 0) & (F.size("conversations") > 0) & chat.has_answer(m), F.lit(False))
    t = raw.select(
        "shard", ok.alias("ok"), F.when(ok, images).cast("bigint").alias("i"), F.when(ok, F.size("conversations") - F.size(m)).cast("bigint").alias("s")
    )
    return t.rollup("shard").agg(F.count("*").alias("rows"), F.count_if("ok").alias("converted"), F.coalesce(F.sum("i"), F.lit(0)).alias("images"), F.coalesce(F.sum("s"), F.lit(0)).alias("turns_skipped"))


@query(
    "WITH u AS (SELECT package, count(*) AS lines FROM val WHERE package IS NOT NULL GROUP BY package), n AS (SELECT count(*) AS expected FROM val WHERE package IS NOT NULL) "
    "SELECT CAST(sum(lines) AS BIGINT) AS lines, max(expected) AS expected, sum(lines) = max(expected) AS ok FROM u, n"
)
def a21_union_count(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the union of all packages' parts against the lines of the table they were cut from."""
    v = table(spark, d, "val").where("package IS NOT NULL").select("val_id", "package")
    packages = sorted(r.package for r in small_rows(v.select("package").distinct()))
    union = split.union_all([(p, v.where(F.col("package") == p).select("val_id")) for p in packages])
    return reports.counted_against(union, v)


ORDERED = f"o AS (SELECT train_id, channel, row_number() OVER (ORDER BY sha256('{SEED}:' || train_id), train_id) - 1 AS place FROM train)"


@query(f"WITH {ORDERED} SELECT train_id, place FROM o")
def o01_shuffle(spark: SparkSession, d: str) -> DataFrame:
    return split.shuffled(table(spark, d, "train").select("train_id"), "train_id", SEED)


@query(f"WITH {ORDERED}, n AS (SELECT least(64, count(*) // 10) AS v FROM train) SELECT train_id, place, CASE WHEN place < v THEN 'val' ELSE 'train' END AS split FROM o, n")
def o02_head_split(spark: SparkSession, d: str) -> DataFrame:
    return split.head_split(table(spark, d, "train").select("train_id"), "train_id", SEED, 64)


@query(
    "WITH c AS (SELECT DISTINCT shard FROM raw_trajectories), n AS (SELECT count(*) AS n FROM c), i AS (SELECT shard, dense_rank() OVER (ORDER BY shard) - 1 AS chunk_id FROM c) "
    "SELECT shard, CAST(chunk_id AS INTEGER) AS chunk_id, CASE WHEN chunk_id >= n - greatest(1, least(2, n // 2)) THEN 'val' ELSE 'train' END AS split FROM i, n"
)
def o03_chunk_split(spark: SparkSession, d: str) -> DataFrame:
    return split.chunk_split(_raw(spark, d), "shard", 2)


@query(f"SELECT train_id FROM train ORDER BY sha256('{SEED}:' || train_id), train_id LIMIT 500")
def o04_sample(spark: SparkSession, d: str) -> DataFrame:
    return split.sample(table(spark, d, "train").select("train_id"), "train_id", SEED, 500)


@query("SELECT val_id, package FROM val ORDER BY sha256('7:' || val_id), val_id LIMIT 32")
def o05_first_k(spark: SparkSession, d: str) -> DataFrame:
    return split.sample(table(spark, d, "val").select("val_id", "package"), "val_id", 7, 32)


@query(
    f"WITH {PAIRS}, r AS (SELECT train_id, turn, row_number() OVER (PARTITION BY train_id ORDER BY sha256('{SEED}:' || train_id || ':' || turn), turn) AS r FROM pairs) "
    f"SELECT train_id, turn FROM r WHERE r = 1 ORDER BY sha256('{SEED}:' || train_id), train_id LIMIT 100"
)
def o06_one_turn_each(spark: SparkSession, d: str) -> DataFrame:
    return split.one_each(_pairs(spark, d).select("train_id", F.col("turn").cast("bigint").alias("turn")), "train_id", ["turn"], SEED, 100)


@query("WITH c AS (SELECT dataset, shard, count(*) AS n FROM raw_trajectories WHERE dataset IS NOT NULL GROUP BY ALL), s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY dataset ORDER BY shard) AS BIGINT) AS upto, CAST(round(sum(n) OVER (PARTITION BY dataset) * 0.6) AS BIGINT) AS want FROM c) SELECT dataset, shard, least(n, want - (upto - n)) AS take FROM s WHERE upto - n < want")
def o08_fraction_of_shards(spark: SparkSession, d: str) -> DataFrame:
    c = _raw(spark, d).where("dataset IS NOT NULL").groupBy("dataset", "shard").agg(F.count("*").alias("n"))
    w = W.partitionBy("dataset")
    s = c.withColumn("before", F.sum("n").over(w.orderBy("shard")) - F.col("n")).withColumn("want", F.round(F.sum("n").over(w) * F.lit("0.6").cast("decimal(2,1)")).cast("bigint"))
    return s.where("before < want").select("dataset", "shard", F.least(F.col("n"), F.col("want") - F.col("before")).alias("take"))


@query(
    "WITH c AS (SELECT run_id, step, bool_or(loss IS NOT NULL AND NOT isnan(loss)) AS loss, bool_or(grad_norm IS NOT NULL) AS norm FROM metric_log WHERE step IS NOT NULL GROUP BY run_id, step), "
    "v AS (SELECT run_id, max(step) FILTER (WHERE loss AND norm) AS step FROM c GROUP BY run_id), "
    "w AS (SELECT c.run_id, c.step, CASE WHEN NOT loss THEN 'no loss' ELSE 'no gradient norm' END AS reason, row_number() OVER (PARTITION BY c.run_id ORDER BY c.step DESC) AS r FROM c JOIN v ON v.run_id = c.run_id AND (v.step IS NULL OR c.step > v.step)) "
    "SELECT v.run_id, v.step, (SELECT count(*) FROM w WHERE w.run_id = v.run_id) AS skipped, (SELECT string_agg('checkpoint-' || w.step || ': ' || reason, '; ' ORDER BY r) FROM w WHERE w.run_id = v.run_id AND r <= 3) AS reasons FROM v"
)
def o09_latest_valid(spark: SparkSession, d: str) -> DataFrame:
    """The latest checkpoint of each run that is valid, how many later ones aren't, and why the last three of them aren't."""
    log = table(spark, d, "metric_log").where("step IS NOT NULL")
    c = log.groupBy("run_id", "step").agg(F.bool_or(F.col("loss").isNotNull() & ~F.isnan("loss")).alias("loss"), F.bool_or(F.col("grad_norm").isNotNull()).alias("norm"))
    wrong = F.when(~F.col("loss"), "no loss").when(~F.col("norm"), "no gradient norm")
    return resume.latest_valid_of(c.select("run_id", "step", wrong.alias("wrong")), "run_id", "step", "wrong")


@query("SELECT p_partkey, p_size, row_number() OVER (ORDER BY p_size DESC, p_partkey) - 1 AS place FROM part")
def o10_largest_first(spark: SparkSession, d: str) -> DataFrame:
    return with_row_index(table(spark, d, "part").select("p_partkey", "p_size"), F.desc("p_size"), "p_partkey", name="place")


@query("SELECT dataset, min(shard) AS first, max(shard) AS last FROM raw_trajectories WHERE dataset IS NOT NULL GROUP BY dataset")
def o11_first_last(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).where("dataset IS NOT NULL").groupBy("dataset").agg(F.min("shard").alias("first"), F.max("shard").alias("last"))


@query("SELECT train_id AS id, game, channel, NULL AS package, 'train' AS source, 0 AS source_ord FROM train UNION ALL SELECT val_id, game, channel, package, 'val', 1 FROM val")
def u01_union(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "train").select(F.col("train_id").alias("id"), "game", "channel")
    v = table(spark, d, "val").select(F.col("val_id").alias("id"), "game", "channel", "package")
    return split.union_all([("train", t), ("val", v)])


@query("SELECT row_number() OVER (ORDER BY source_ord, id) - 1 AS place, id FROM (SELECT val_id AS id, 0 AS source_ord FROM val WHERE package = 'val_main' UNION ALL SELECT val_id, 1 FROM val WHERE package = 'val_small' UNION ALL SELECT val_id, 2 FROM val WHERE package = 'val_holdout')")
def u02_concatenation(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "val").select(F.col("val_id").alias("id"), "package")
    parts = [(p, v.where(F.col("package") == p).select("id")) for p in ("val_main", "val_small", "val_holdout")]
    return with_row_index(split.union_all(parts), "source_ord", "id", name="place").select("place", "id")


@query("SELECT shard, count(*) AS n FROM (SELECT traj % 4 AS shard FROM eval_records) GROUP BY shard")
def u03_shard_merge(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "eval_records")
    return split.union_all([(str(i), e.where(F.col("traj") % 4 == i).select((F.col("traj") % 4).alias("shard"))) for i in range(4)]).groupBy("shard").agg(F.count("*").alias("n"))


@query("SELECT channel FROM train UNION SELECT channel FROM val UNION SELECT channel FROM documents")
def u04_key_union(spark: SparkSession, d: str) -> DataFrame:
    t = [table(spark, d, x).select("channel") for x in ("train", "val", "documents")]
    return t[0].union(t[1]).union(t[2]).distinct()


@query("(SELECT source, 'left' AS side FROM (SELECT source FROM mix_targets EXCEPT SELECT source FROM documents)) UNION ALL (SELECT source, 'right' FROM (SELECT source FROM documents EXCEPT SELECT source FROM mix_targets))")
def u05_difference(spark: SparkSession, d: str) -> DataFrame:
    return split.difference(table(spark, d, "mix_targets"), table(spark, d, "documents"), "source")


@query("SELECT doc_id, regexp_replace(regexp_replace(coalesce(source, ''), '/+$', ''), '^.*/', '') AS name, length(text) AS n, n_chars FROM documents")
def c13_lengths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", paths.basename(F.coalesce("source", F.lit(""))).alias("name"), F.length("text").cast("bigint").alias("n"), "n_chars")


@query("SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM documents")
def c17_digest(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def c21_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT step, iteration, try_cast(iteration AS BIGINT) AS whole FROM metric_log")
def c22_safe_cast(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "metric_log").select("step", "iteration", F.col("iteration").try_cast("bigint").alias("whole"))


@query("SELECT run_id || '/checkpoint-' || step AS name, CAST(regexp_extract(run_id || '/checkpoint-' || step, 'checkpoint-(\\d+)$', 1) AS BIGINT) AS step FROM metric_log")
def c24_checkpoint_name(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "metric_log").select(F.concat("run_id", F.lit("/checkpoint-"), F.col("step").cast("string")).alias("name"))
    return t.select("name", F.regexp_extract("name", r"checkpoint-(\d+)$", 1).cast("bigint").alias("step"))


@query("SELECT train_id, list_slice(images, 1, 2) AS head, lpad(CAST(len(images) AS VARCHAR), 4, '0') AS n, coalesce(list_contains(images, 'images/common/black.jpg'), false) AS black FROM train")
def c25_arrays(spark: SparkSession, d: str) -> DataFrame:
    n = F.when(F.col("images").isNotNull(), F.lpad(F.size("images").cast("string"), 4, "0"))
    has = F.coalesce(F.exists("images", lambda p: F.coalesce(p == "images/common/black.jpg", F.lit(False))), F.lit(False))
    return table(spark, d, "train").select("train_id", F.slice("images", 1, 2).alias("head"), n.alias("n"), has.alias("black"))


@query(f"SELECT train_id, sha256('{SEED}:' || train_id) AS key FROM train")
def o01_order_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "train").select("train_id", order_key(SEED, F.col("train_id")).alias("key"))


UNIFIED = T.StructType([T.StructField("id", T.LongType()), T.StructField("channel", T.StringType()), T.StructField("turns", T.IntegerType()), T.StructField("images", T.IntegerType()), T.StructField("at", T.TimestampNTZType())])


@query(
    "SELECT train_id AS id, channel, CAST(len(messages) AS INTEGER) AS turns, CAST(len(images) AS INTEGER) AS images, recorded_at AS at, 'train' AS source, 0 AS source_ord FROM train "
    "UNION ALL SELECT traj_id, dataset, CAST(len(conversations) AS INTEGER), CAST(len(images) AS INTEGER), exported_at, 'raw', 1 FROM raw_trajectories "
    "UNION ALL SELECT doc_id, channel, NULL, NULL, collected_at, 'documents', 2 FROM documents"
)
def h01_column_maps(spark: SparkSession, d: str) -> DataFrame:
    """Three sources under one schema, each by its own map of columns."""
    train, raw, docs = table(spark, d, "train"), _raw(spark, d), table(spark, d, "documents")
    size = lambda df, c: chat.list_size(df, c)
    return hooks.unified(
        [
            ("train", train, {"id": "train_id", "channel": "channel", "turns": size(train, "messages"), "images": size(train, "images"), "at": "recorded_at"}),
            ("raw", raw, {"id": "traj_id", "channel": "dataset", "turns": size(raw, "conversations"), "images": size(raw, "images"), "at": "exported_at"}),
            ("documents", docs, {"id": "doc_id", "channel": "channel", "at": "collected_at"}),
        ],
        UNIFIED,
    )


def _windows(row: dict) -> list[dict]:
    """An item for each answered turn: its number and the signs of question and answer."""
    turns = row["messages"] or []
    of = lambda m: (m or {}).get("content") or ""
    role = lambda m: (m or {}).get("role")
    return [{"turn": i, "chars": len(of(a)) + len(of(b))} for i, (a, b) in enumerate(zip(turns, turns[1:], strict=False)) if role(a) == "user" and role(b) == "assistant"]


@query(f"WITH {PAIRS} SELECT train_id, turn, length(coalesce(question, '')) + length(coalesce(answer, '')) AS chars, pair AS item, CAST(NULL AS VARCHAR) AS error FROM pairs")
def h02_items_of_rows(spark: SparkSession, d: str) -> DataFrame:
    """Any number of items of a row by a function of the user's own."""
    items = T.StructType([T.StructField("turn", T.LongType()), T.StructField("chars", T.LongType())])
    return hooks.expand(table(spark, d, "train").select("train_id", "messages"), _windows, items, ["train_id"])
