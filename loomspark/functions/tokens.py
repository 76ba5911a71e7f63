"""Token counts of texts by any tokenizer, or by a proxy without one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def word_count(text: Column) -> Column:
    """Runs of signs that aren't white space: the proxy where no tokenizer is given. 0 for null."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(F.coalesce(bare, F.lit("")) == "", 0).otherwise(F.size(F.split(bare, r"\s+"))).cast("bigint")


def token_count(text: Column, make: Callable[[], Callable[[list[str]], list[int]]]) -> Column:
    """Tokens by a tokenizer: `make` is called in the worker and gives a function from texts to counts. Nulls count as empty texts."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = make()
        for s in batches:
            yield pd.Series(tokens([t or "" for t in s]), index=s.index, dtype="int64")

    return count(text)
