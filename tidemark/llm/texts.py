"""Passing whole texts through Python in batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Bounds of an Arrow batch: a task holds one batch of texts at a time, however long they are.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """mapInArrow with bounded batches.

    The bounds hold for the session, as Spark reads them when a plan is made; they change no result.
    """
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(work, schema)


def to_batch(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """A record batch with the columns in the order of ``types``."""
    return pa.RecordBatch.from_arrays([pa.array(columns[name], type=kind) for name, kind in types.items()], names=list(types))
