"""The queries of the training-data problems and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm.census import token_census
from loomspark.llm.encode import encode_texts
from loomspark.llm.mixing import mix_sources
from loomspark.llm.overlap import overlap_report, overlaps
from loomspark.llm.packing import pack_report, pack_train
from loomspark.llm.quality import text_quality
from loomspark.llm.splits import split_report, split_train
from loomspark.operators.graph import small_broadcast
from loomspark.session import table


def _splits(spark: SparkSession, d: str) -> DataFrame:
    return split_train(table(spark, d, "train"), table(spark, d, "channels"), table(spark, d, "shared_frames"), table(spark, d, "split_targets"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _splits(spark, d).where("group_size > 1").select("group_id", "train_id")


def p1_splits(spark: SparkSession, d: str) -> DataFrame:
    return _splits(spark, d).select("train_id", "group_id", "split")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return split_report(_splits(spark, d), table(spark, d, "split_targets"))


def p2_census(spark: SparkSession, d: str) -> DataFrame:
    return token_census(table(spark, d, "raw_trajectories"), table(spark, d, "canonical_index"), table(spark, d, "common_words"))


def p2_deliveries(spark: SparkSession, d: str) -> DataFrame:
    """Conversations and images by dataset and domain: what the census counts but for tokens and languages."""
    return p2_census(spark, d).groupBy("dataset", "domain").agg(F.sum("conversations").alias("conversations"), F.sum("images").alias("images"))


def p2_domains(spark: SparkSession, d: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("conversations", "text_tokens", "visual_tokens", "tokens")]
    return p2_census(spark, d).groupBy("domain", "lang").agg(*sums)


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    return overlaps(table(spark, d, "train"), table(spark, d, "val"), table(spark, d, "channels"), table(spark, d, "shared_frames"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).select("train_id", "val_id")


def p3_frames(spark: SparkSession, d: str) -> DataFrame:
    """Pairs by frames alone, with how many of the val row's frames the train row has."""
    return _overlaps(spark, d).where("frames IS NOT NULL").select("train_id", "val_id", F.col("frames").cast("bigint").alias("frames"))


def p3_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d)


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap_report(_overlaps(spark, d), table(spark, d, "val"), table(spark, d, "channels"))


def p4_packs(spark: SparkSession, d: str) -> DataFrame:
    return pack_train(table(spark, d, "train"), table(spark, d, "channels"), table(spark, d, "pack_limits"))


def p4_rules(spark: SparkSession, d: str) -> DataFrame:
    """By capacity: rows packed, rows that aren't whole (their pieces leave a gap or overlap), overfull packs, and cut rows that would have fitted."""
    packs, limits = p4_packs(spark, d), table(spark, d, "pack_limits").select("pack_name", "max_tokens")
    full = packs.groupBy("pack_name", "pack_id").agg(F.sum("length").alias("used")).join(small_broadcast(limits), "pack_name")
    over = full.groupBy("pack_name").agg(F.count_if(F.col("used") > F.col("max_tokens")).alias("overfull_packs"))
    rows = packs.groupBy("pack_name", "train_id").agg(F.sum("length").alias("n"), F.max(F.col("start") + F.col("length")).alias("end"), F.count("*").alias("pieces"), (F.max("piece") + 1).alias("numbered"))
    rows = rows.join(small_broadcast(limits), "pack_name")
    broken, cut_ = (F.col("n") != F.col("end")) | (F.col("pieces") != F.col("numbered")), (F.col("pieces") > 1) & (F.col("n") <= F.col("max_tokens"))
    return rows.groupBy("pack_name").agg(F.count("*").alias("rows"), F.count_if(broken).alias("broken_rows"), F.count_if(cut_).alias("needless_cuts")).join(over, "pack_name")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return pack_report(p4_packs(spark, d), table(spark, d, "pack_limits"))


def p5_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_texts(table(spark, d, "documents"))


def p6_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets")).rows


def p6_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets")).shares


def p6_rules(spark: SparkSession, d: str) -> DataFrame:
    """By listed source: its documents, whether it is used more than its cap allows, and whether a source below its cap lacks its weight of the wanted size."""
    s = p6_shares(spark, d)
    lacks = ~F.col("capped") & (F.col("documents") > 0) & (F.col("rate") * F.col("source_tokens") < F.col("weight") * F.col("wanted_size") * (1 - 1e-9))
    return s.select("source", "documents", (F.col("rate") > F.col("max_passes")).alias("over_cap"), (F.coalesce(lacks, F.lit(False)) & (F.col("source_tokens") > 0)).alias("lacks"))


def p6_strict_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mix_targets"), fill=False).shares


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_stats(spark, d).where("reason IS NOT NULL AND reason <> 'empty'").select("doc_id")


def p7_published(spark: SparkSession, d: str) -> DataFrame:
    """Documents that break two or more of the published rules for whole texts."""
    return p7_stats(spark, d).where("size(failures) > 1").select("doc_id", "failures")


def p7_stats(spark: SparkSession, d: str) -> DataFrame:
    return text_quality(table(spark, d, "documents"), table(spark, d, "common_words"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_splits, p1_report, p2_census, p2_deliveries, p2_domains, p3_found, p3_frames, p3_coverage, p3_report, p4_packs, p4_rules, p4_report, p5_ids, p6_mixture, p6_rules, p6_shares, p6_strict_shares, p7_found, p7_published, p7_stats)}


#: Frames of recordings as the SQL sees them; it knows the spellings of the test tables, not all that the operator reads.
FRAMES = r"""n AS (SELECT regexp_replace(lower(name), '[\s_-]+', '', 'g') AS k, min(channel) AS game FROM (SELECT channel, channel AS name FROM channels UNION ALL SELECT channel, unnest(aliases) FROM channels) GROUP BY 1),
 p AS (SELECT train_id, channel, game, replace(replace(lower(unnest(images)), '%2f', '/'), chr(92), '/') AS path FROM train),
 f AS (SELECT train_id, coalesce(c.game, g.game) AS game, regexp_extract(path, '.*chunk_0*(\d+)/+row_0*(\d+)/+0*(\d+)[.]', ['chunk', 'row', 'frame']) AS x FROM p
  LEFT JOIN n c ON c.k = regexp_replace(lower(p.channel), '[\s_-]+', '', 'g') LEFT JOIN n g ON g.k = regexp_replace(lower(p.game), '[\s_-]+', '', 'g')),
 s AS (SELECT regexp_extract(path, '.*chunk_0*(\d+)/+row_0*(\d+)/+0*(\d+)[.]', ['chunk', 'row', 'frame']) AS x FROM shared_frames),
 r AS (SELECT DISTINCT train_id, game || '/' || x['chunk'] || '/' || x['row'] AS rec FROM f WHERE game IS NOT NULL AND x['chunk'] <> '' AND x NOT IN (SELECT x FROM s))"""


#: All frames of rows of a table as the SQL sees them: numbers of chunk, row and frame, else the path without its ending.
KEYS = r"""(SELECT DISTINCT id, game, CASE WHEN x['chunk'] <> '' THEN x['chunk'] || '/' || x['row'] || '/' || x['frame'] ELSE regexp_replace(path, '[.][a-z0-9]+$', '') END AS k FROM
 (SELECT t.id, coalesce(c.game, g.game) AS game, path, regexp_extract(path, '.*chunk_0*(\d+)/+row_0*(\d+)/+0*(\d+)[.]', ['chunk', 'row', 'frame']) AS x FROM
  (SELECT {id} AS id, channel, game, regexp_replace(regexp_replace(regexp_replace(trim(replace(replace(replace(lower(unnest(images)), '%2f', '/'), '%5c', '/'), chr(92), '/')), '[?#].*$', ''), '/+([.]/|/)*', '/', 'g'), '^([.]/)+|^.*/(images/common/)', '\2') AS path FROM {table}) t
  LEFT JOIN n c ON c.k = regexp_replace(lower(t.channel), '[\s_-]+', '', 'g') LEFT JOIN n g ON g.k = regexp_replace(lower(t.game), '[\s_-]+', '', 'g')) WHERE game IS NOT NULL AND path <> '')"""
SHARED = r"(SELECT CASE WHEN x['chunk'] <> '' THEN x['chunk'] || '/' || x['row'] || '/' || x['frame'] ELSE regexp_replace(lower(path), '[.][a-z0-9]+$', '') END FROM (SELECT path, regexp_extract(lower(path), '.*chunk_0*(\d+)/+row_0*(\d+)/+0*(\d+)[.]', ['chunk', 'row', 'frame']) AS x FROM shared_frames))"
NAMES = FRAMES.split(",\n")[0]
DATASET = r"regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace({0}, '[/\s]+$', ''), '^.*/', ''), '[.](parquet|jsonl?|csv)\s*$', '', 'i')), '-\d{{5}}$', ''), '[\s_-]+', '', 'g')"


def oracle_sql() -> dict[str, str]:
    return {
        "p2_deliveries": f"WITH c AS (SELECT canonical_name AS dataset, domain, regexp_replace(lower(canonical_name), '[\\s_-]+', '', 'g') AS k FROM canonical_index), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY shard, row_index, CASE WHEN shard IS NULL OR row_index IS NULL THEN traj_id END ORDER BY exported_at DESC NULLS LAST, traj_id DESC) AS r FROM raw_trajectories) "
        f"SELECT coalesce(a.dataset, b.dataset) AS dataset, coalesce(a.domain, b.domain) AS domain, count(*) AS conversations, CAST(coalesce(sum(len(images)), 0) AS BIGINT) AS images FROM r LEFT JOIN c a ON a.k = {DATASET.format('r.dataset')} LEFT JOIN c b ON b.k = {DATASET.format('r.shard')} WHERE r = 1 GROUP BY 1, 2",
        "p3_frames": f"WITH {NAMES}, t AS (SELECT * FROM {KEYS.format(id='train_id', table='train')} WHERE k NOT IN {SHARED}), v AS (SELECT * FROM {KEYS.format(id='val_id', table='val')} WHERE k NOT IN {SHARED}), m AS (SELECT id, count(*) AS m FROM v GROUP BY id) "
        "SELECT t.id AS train_id, v.id AS val_id, count(*) AS frames FROM t JOIN v ON t.game = v.game AND t.k = v.k JOIN m ON m.id = v.id GROUP BY t.id, v.id, m.m HAVING 2 * count(*) >= m.m",
        "p4_rules": "SELECT pack_name, (SELECT count(*) FROM train) AS rows, CAST(0 AS BIGINT) AS broken_rows, CAST(0 AS BIGINT) AS needless_cuts, CAST(0 AS BIGINT) AS overfull_packs FROM pack_limits WHERE max_tokens >= 1",
        "p6_rules": "SELECT source, (SELECT count(*) FROM documents d WHERE lower(trim(d.source)) = m.source) AS documents, false AS over_cap, false AS lacks FROM (SELECT DISTINCT lower(trim(source)) AS source FROM mix_targets) m",
        "p1_found": f"WITH RECURSIVE {FRAMES}, e AS (SELECT DISTINCT a.train_id AS a, b.train_id AS b FROM r a JOIN r b USING (rec)), c AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a) "
        "SELECT min(b) AS group_id, a AS train_id FROM c GROUP BY a HAVING count(*) > 1",
    }
