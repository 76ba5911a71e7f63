"""Token counts of a column of texts or lists of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from loomspark.llm.bpe import DEFAULT_TOKENIZER, tokenizer

def count_column(texts: pa.Array, count: Callable[[list[str]], np.ndarray]) -> np.ndarray:
    """Tokens of each row of a string column or a list<string> column; 0 for nulls."""
    if pa.types.is_list(texts.type):
        n = np.zeros(len(texts), np.int64)
        inside = texts.flatten()
        if len(inside):
            each = count([t or "" for t in inside.to_pylist()])
            cum = np.concatenate([[0], np.cumsum(each)])
            lens = np.array(texts.value_lengths().fill_null(0))
            ends = np.cumsum(lens)
            n = cum[ends] - cum[ends - lens]
        return n
    return count([t or "" for t in texts.to_pylist()])


def with_tokens(df: DataFrame, keep: list[Column], text: Column, counter: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """The columns `keep` of each row and its `tokens` (bigint), 0 for a null text, an empty one or an empty list.

    `counter` is called in the Python worker and gives a function from texts to their counts. Columns of `df` that
    aren't in `keep` play no part, whatever their names.
    """
    rows = df.select(*keep, text.alias("tokens"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("tokens", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter()
        for b in batches:
            n = count_column(b.column(b.num_columns - 1), count)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "tokens"])

    return rows.mapInArrow(run, schema)


def bpe_counter(path: str = DEFAULT_TOKENIZER) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    return lambda: tokenizer(path).count
