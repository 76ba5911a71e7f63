"""Problem 5: the ids of every text by a public byte-level BPE tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.llm.bpe import DEFAULT_TOKENIZER, tokenizer


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, ids array<int>) of every row, by the tokenizer file `path`, without special tokens.

    Null and empty texts have an empty list. Strings of special tokens in a text are ordinary text. The rows of an
    Arrow batch are encoded together: their distinct words are merged in numpy rounds and spread to where they occur.
    There is no shuffle; a row never leaves its partition. Repeated ids and other columns don't matter.
    """
    rows = df.select(F.col(id_col), F.col(text_col).alias("ids"))
    schema = T.StructType([rows.schema[0], T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
    name = rows.schema[0].name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for b in batches:
            # A part of a batch at a time, so that its ids stay small however long the texts are.
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= 1 << 22):
                    size += len(texts[end] or "")
                    end += 1
                ids, off = bpe.encode([t or "" for t in texts[at:end]])
                lists = pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), lists], names=[name, "ids"])
                at = end

    return rows.mapInArrow(run, schema)
