"""Adds one struct column, computed in Arrow batches, to all columns of a table."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from driftwood.llm.text import SLICE_BYTES, lean, slices


def annotate(df: DataFrame, out: str, kind: str, make: Callable[[], Callable[[pa.RecordBatch], pa.Array]],
             text: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """``df`` and a struct column ``out`` of type ``kind`` (DDL), which replaces a column of that name.

    ``make`` runs once in each task and returns the function that turns a piece of a batch
    into the struct array. Rows, their other columns and repeated rows pass through unchanged.
    """
    base = df.drop(out)
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.StructType.fromDDL(kind))])

    def run(batches):
        f = make()
        for piece in slices(batches, text, limit):
            yield pa.RecordBatch.from_arrays([*piece.columns, f(piece)], names=[*piece.schema.names, out])

    return base.mapInArrow(lean(run), schema)
