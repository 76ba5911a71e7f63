"""Where a user's own functions come in: column maps by source, and functions that make any number of items of a row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from loomspark.operators.split import union_all


def unified(sources: list[tuple[str, DataFrame, dict[str, Column | str]]], schema: T.StructType) -> DataFrame:
    """Rows of several sources under one declared schema, with the source's name and number.

    Each source comes with a map from declared columns to its own columns or expressions; a declared column that a map
    lacks is null. Everything stays in expressions, so unused columns aren't read.
    """
    parts = []
    for name, df, columns in sources:
        if unknown := set(columns) - set(schema.names):
            raise ValueError(f"{name}: {', '.join(sorted(unknown))} isn't declared")
        of = {k: F.col(v) if isinstance(v, str) else v for k, v in columns.items()}
        parts.append((name, df.select(*[of.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])))
    return union_all(parts)


def expand(rows: DataFrame, make: Callable[[dict], Iterable[dict]], schema: T.StructType, keep: list[str], strict: bool = True) -> DataFrame:
    """The columns `keep` of each row with the items that `make` gives for it (0 to any number): columns of `schema`, `item` (from 0) and `error`.

    `make` gets the whole row as a dict and runs in Python workers, batch by batch. A ValueError says that a row can't be
    used: with `strict` it ends the job, else the row comes out once, with a null item and the error's text. Other errors end
    the job in any case. Missing and null fields are null.
    """
    own = T.StructType([rows.schema[k] for k in keep])
    out = T.StructType([*own.fields, *schema.fields, T.StructField("item", T.LongType()), T.StructField("error", T.StringType())])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for row in b.to_pylist():
                kept = {k: row[k] for k in keep}
                try:
                    made += [kept | {f.name: x.get(f.name) for f in schema.fields} | {"item": i, "error": None} for i, x in enumerate(make(row))]
                except ValueError as e:
                    if strict:
                        raise
                    made.append(kept | {"error": str(e)})
            yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return rows.mapInArrow(run, out)
