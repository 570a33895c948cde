"""Running functions of this library over Arrow batches in the tasks that hold the rows."""

from __future__ import annotations

import os
import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Bytes of an Arrow batch. Whole texts make large batches, of which a task has several outside the heap.
BATCH_BYTES = 8 * 1024 * 1024
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def mapped(df: DataFrame, function: Callable[..., Iterator[pa.RecordBatch]], schema: str, *args) -> DataFrame:
    """``mapInArrow`` with a module-level function of this library and its further arguments.

    The function is found by name in the worker, so that what its module keeps
    between calls serves all tasks of a worker. The session's limit of a batch is lowered to ``BATCH_BYTES``.
    """
    spark = df.sparkSession
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(LIMIT))
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set(LIMIT, BATCH_BYTES)
    module, name, root, values = function.__module__, function.__qualname__, ROOT, pickle.dumps(args)

    def run(batches):
        import importlib
        import pickle
        import sys

        if root not in sys.path:
            sys.path.append(root)
        return getattr(importlib.import_module(module), name)(batches, *pickle.loads(values))

    return df.mapInArrow(run, schema)
