"""Run a function over bounded pieces of a text column inside Spark's Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmill.functions.columns import q

class Shared:
    """A value for all tasks, sent as a broadcast of its pickled form.

    Like the functions of this package it carries its classes with it, so that workers need no copy of the package.
    """

    def __init__(self, spark: SparkSession, value: object):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        """The value, built anew at every call: once per task."""
        return cloudpickle.loads(self._sent.value)


#: Bytes of rows that Spark hands to a Python worker at a time. Its own bound of 64 MB holds 10,000 long texts.
BATCH_BYTES = 4 << 20
_BATCH_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches end at ``BATCH_BYTES`` or with a larger row, unless it has a bound already.

    A batch lies in buffers of the JVM, beside its heap, and in the worker. Which rows are handed over does not change.
    """
    if spark.conf.get(_BATCH_BOUND, None) is None:
        spark.conf.set(_BATCH_BOUND, str(BATCH_BYTES))


#: Bytes of text handed to a function at a time. A longer text is a piece of its own and is never cut.
PIECE_BYTES = 1 << 20


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold at most ``most`` bytes together, or one row."""
    texts = batch.column(column)
    ends = np.cumsum(np.asarray(pa.compute.binary_length(texts).fill_null(0), np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + most, side="right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


def per_text(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: str,
    start: Callable[[], Callable[[pa.Array], Sequence]],
    most: int = PIECE_BYTES,
) -> DataFrame:
    """``keep`` columns of ``df`` and the ``fields`` that a function finds for each text.

    ``start`` is called once per task and returns the function, which gets an Arrow array of texts and returns one
    sequence per field. A kept column with the name of a field gives way to the field. Rows are neither added nor lost.
    """
    found = T.StructType.fromDDL(fields)
    keep = [c for c in dict.fromkeys(keep) if c not in found.names]
    names = [f"k{i}" for i in range(len(keep))]
    source = df.select(*(q(c).alias(n) for c, n in zip(keep, names, strict=True)), q(text).cast("string").alias("text"))
    schema = T.StructType([*(T.StructField(n, source.schema[n].dataType) for n in names), *found.fields])
    kinds = [_arrow(f.dataType) for f in found.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for piece in pieces(batch, "text", most):
                results = compute(piece.column("text"))
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, k) for x, k in zip(results, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in names), *arrays], schema.names)

    out = source.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)), *found.names)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
