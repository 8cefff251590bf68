"""Memory of executors: of Python workers, which live on from task to task and from stage to stage, and of the batches sent to them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import pyarrow as pa
from pyspark.sql import DataFrame

from epiweave.llm.words import SLICE_BYTES

#: Bytes of an Arrow batch on its way to a worker: most batches are one slice. Spark's own limits, 10,000 rows and 64 MB, let every task
#: build and copy tens of MB of long texts outside of the JVM's heap, and hold as much again in the worker.
BATCH_BYTES = SLICE_BYTES * 7 // 8
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


@lru_cache(maxsize=1)
def _trim():
    """The C library's function that gives freed memory back to the system, where it has one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give back what numpy and Arrow have freed but keep for later."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


def lean(step: Step) -> Step:
    """``step`` for ``mapInArrow``, after which the worker holds no more than it needs."""

    @wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from step(batches)
        finally:
            release()

    return run


def map_lean(rows: DataFrame, step: Step, schema: str) -> DataFrame:
    """``rows.mapInArrow`` of a lean ``step``. Batches have ``BATCH_BYTES`` bytes, or one longer row, unless the session sets a limit of
    its own. Spark reads the limit when the result is computed, so it stays set in the session."""
    conf = rows.sparkSession.conf
    if conf.get(_BATCH_BYTES, None) is None:
        conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    return rows.mapInArrow(lean(step), schema)
