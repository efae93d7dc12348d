"""Functions over blocks of texts on executors, fed from Arrow batches without turning a whole batch into Python objects."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text in a block, about (more only for a single longer text).
BLOCK_BYTES = 1 << 19

#: Rows that go to a worker at once while a long pass over texts runs. Spark's default of 10,000 rows is tens of
#: megabytes of text, held by the executor and by the worker.
ARROW_ROWS = 500

Blocks = Iterator[tuple[list, list[str]]]
_TYPES = {
    "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()),
}


@contextmanager
def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> Iterator[None]:
    """Smaller Arrow batches for the jobs that run inside the block; the session's setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_schema(text: str) -> pa.Schema:
    """The Arrow schema of a schema text such as ``"doc_id long, ids binary"``."""
    return pa.schema([(name, _TYPES[kind]) for name, kind in (part.split() for part in text.split(","))])


def text_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Blocks:
    """(doc_id of each row, text of each row); null texts as empty ones."""
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        start = 0
        while start < len(ends):
            before = int(ends[start] - lengths[start])
            end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield ids.slice(start, end - start).to_pylist(), [t or "" for t in texts.slice(start, end - start).to_pylist()]
            start = end


def map_blocks(
    docs: DataFrame, run: Callable[[Blocks], Iterator[pd.DataFrame]], schema: str, size: int = BLOCK_BYTES
) -> DataFrame:
    """``run`` over the blocks of each partition of ``docs`` (doc_id, text); it yields frames of ``schema``."""
    arrow = arrow_schema(schema)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in run(text_blocks(batches, size)):
            yield pa.RecordBatch.from_pandas(frame, schema=arrow, preserve_index=False)

    return docs.mapInArrow(mapped, schema)
