"""Problem 2: usable tokens of conversations by dataset, language and domain."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions.images import image_sizes, image_tokens_np
from loomspark.functions.names import literal_map, name_key
from loomspark.llm import textvec as tv
from loomspark.llm.bpe import DEFAULT_TOKENIZER
from loomspark.llm.maxmatch import matcher
from loomspark.llm.words import word_hashes, word_kinds
from loomspark.session import cut, small_rows

UNKNOWN = "und"
COUNTED = "text_tokens bigint, visual_tokens bigint, images int, unreadable int, missing int, lang string"


class Languages:
    """The language of a text from its share of Han signs and its frequent function words."""

    def __init__(self, words: dict[str, list[str]]):
        self.names = sorted(lang for lang in words if lang != "zh")
        self.tables = [np.unique(word_hashes([" ".join(words[lang])])[0]) for lang in self.names]

    def of(self, texts: list[str], declared: list[str | None]) -> list[str]:
        """'zh' where Han signs are a tenth or more of the words; else the language most of whose words occur, the declared one among equals; the declared one where none occurs."""
        h, off, han = word_kinds(texts)
        count = lambda hit: np.diff(np.concatenate([[0], np.cumsum(hit)])[off])
        hits = np.stack([count(np.isin(h, t)) for t in self.tables] or [np.zeros(len(texts), np.int64)], axis=1)
        n, han = np.diff(off), count(han)
        own = np.array([self.names.index(x) if x in self.names else 0 for x in declared], np.int64)
        every = np.arange(len(texts))
        best = np.where(hits[every, own] == hits.max(1), own, hits.argmax(1))
        spoken = [self.names[k] if self.names else UNKNOWN for k in best]
        return ["zh" if z else s if some else d or UNKNOWN for z, some, s, d in zip((n > 0) & (han * 10 >= n), hits.max(1) > 0, spoken, declared, strict=True)]


def dataset_name(names: list[str], *columns: Column) -> Column:
    """The canonical name that the first fitting column spells: last part of a path, without ending and shard number, whatever case, blanks, hyphens and underscores; null for none."""
    keys = {re.sub(r"[\s_\-]+", "", n.lower()): n for n in sorted(names, reverse=True)}
    listed = literal_map(keys)

    def one(c: Column) -> Column:
        last = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\\", "/"), r"[/\s]+$", ""), r"^.*/", "")
        bare = F.regexp_replace(F.regexp_replace(last, r"(?i)\.(parquet|jsonl?|csv)\s*$", ""), r"-\d{5}$", "")
        return F.try_element_at(listed, F.coalesce(name_key(bare), F.lit("")))

    return F.coalesce(*[one(c) for c in columns])


def count_conversations(raw: DataFrame, common_words: DataFrame, keep: list[str], path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """The columns `keep` of each row with its text tokens, image tokens, images, unreadable and missing images, and language.

    Text tokens are those of every turn's value, whatever its role, by longest match over the vocabulary `path`. An image
    counts by its size; one that can't be read as much as the row's readable ones on average (rounded), 0 where none can;
    `missing` is how many `<image>` marks lack an image, which counts 0. Null lists, turns, values and images count 0.
    """
    words: dict[str, list[str]] = {}
    for r in small_rows(common_words.where("lang IS NOT NULL AND word IS NOT NULL")):
        words.setdefault(r.lang, []).append(r.word)
    declared = F.lower(F.regexp_extract(F.col("lang"), r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    declared = F.when(declared.isin(["", UNKNOWN]), None).otherwise(declared)
    rows = raw.select(*keep, F.col("conversations")["value"].alias("_values"), image_sizes(F.col("images")["bytes"]).alias("_sizes"), declared.alias("_lang"))
    schema = T.StructType([*rows.schema.fields[:-3], *T.StructType.fromDDL(COUNTED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, langs = matcher(path).count, Languages(words)
        for b in batches:
            n = b.num_columns - 3
            values, images, declared = (b.column(n + k).to_pylist() for k in range(3))
            texts = [[t or "" for t in v or []] for v in values]
            at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            each = np.concatenate([[0], np.cumsum(count([t for ts in texts for t in ts]))])
            sizes = [row or [] for row in images]
            known = sorted({s for row in sizes for s in row if s})
            cost = dict(zip(known, image_tokens_np(*np.array([s.split("x") for s in known], np.int64).T).tolist(), strict=True)) if known else {}
            visual, bad, missing = [], [], []
            for ts, row in zip(texts, sizes, strict=True):
                read = [cost[s] for s in row if s]
                visual.append(sum(read) + (round(sum(read) / len(read)) * (len(row) - len(read)) if read else 0))
                bad.append(len(row) - len(read))
                missing.append(max(0, sum(t.count("<image>") for t in ts) - len(row)))
            joined = [" ".join(ts) for ts in texts]
            found = [x for a, e in tv.groups([len(t) for t in joined]) for x in langs.of(joined[a:e], declared[a:e])]
            new = [pa.array(np.diff(each[at])), pa.array(visual, pa.int64()), *(pa.array(x, pa.int32()) for x in ([len(r) for r in sizes], bad, missing)), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *new], names=[*b.schema.names[:n], *(f.split(" ")[0] for f in COUNTED.split(", "))])

    return rows.mapInArrow(run, schema)


def token_census(raw: DataFrame, canonical: DataFrame, common_words: DataFrame, path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """Usable conversations, images and tokens by dataset, language and domain.

    A row delivered again (same shard and row_index, neither null) counts once, as exported last (the larger traj_id among
    equals). The dataset is what `dataset` spells, else what the shard's name spells, else null with a null domain; the
    language comes from the texts (see `Languages`). The rows are counted where they lie; only numbers are shuffled, and
    pre-aggregated. No rows give no rows.
    """
    names = [r.canonical_name for r in small_rows(canonical.select("canonical_name")) if r.canonical_name]
    counted = cut(count_conversations(raw, common_words, ["traj_id", "dataset", "shard", "row_index", "exported_at"], path))
    row = F.struct("exported_at", "traj_id", "dataset", "text_tokens", "visual_tokens", "images", "unreadable", "missing", "lang")
    alone = F.when(F.col("shard").isNull() | F.col("row_index").isNull(), F.col("traj_id"))
    last = counted.groupBy("shard", "row_index", alone.alias("alone")).agg(F.max(row).alias("r")).select("shard", "r.*")
    named = last.withColumn("dataset", dataset_name(names, F.col("dataset"), F.col("shard")))
    total = named.groupBy("dataset", "lang").agg(
        F.count("*").alias("conversations"), F.sum("images").alias("images"), F.sum("unreadable").alias("unreadable_images"), F.sum("missing").alias("missing_images"),
        F.sum("text_tokens").alias("text_tokens"), F.sum("visual_tokens").alias("visual_tokens"), F.sum(F.col("text_tokens") + F.col("visual_tokens")).alias("tokens"),
    )
    domains = {r.canonical_name: r.domain for r in small_rows(canonical.select("canonical_name", "domain")) if r.canonical_name and r.domain}
    return total.withColumn("domain", F.try_element_at(literal_map(domains), F.coalesce("dataset", F.lit("")))).select("dataset", "lang", "domain", *total.columns[2:])
