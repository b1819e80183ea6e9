"""Running numpy code over a text column, slice by slice, on the executors."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..session import ship, spread
from .arrays import slices, tidy


def map_text(docs: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable], fields: str, slice_bytes: int = 2 << 20) -> DataFrame:
    """(id, *fields) for each row, in one narrow pass over two columns.

    ``make()`` runs once in each task and returns ``f(column, bytes, offsets)``,
    which gives one Arrow array or list for each field.  Other columns of ``docs``
    aren't read, so that clashing names do no harm.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", kind)] + T._parse_datatype_string(fields).fields)

    def run(batches):
        f = make()
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            if isinstance(column, pa.ChunkedArray):
                column = column.combine_chunks()
            for first, last, buf, offs in slices(column, slice_bytes):
                out = f(column.slice(first, last - first), buf, offs)
                yield pa.RecordBatch.from_arrays([ids.slice(first, last - first), *[x if isinstance(x, pa.Array) else pa.array(x) for x in out]], names=schema.names)

    return spread(docs.select(docs[id_col], docs[text_col].cast("string")).toDF("id", "text")).mapInArrow(tidy(run), schema)
