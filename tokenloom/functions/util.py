"""Small Column helpers."""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and bind it for ``body``.

    Catalyst does not share sub-expressions inside higher-order lambdas, so
    an expensive array used inside ``transform``/``exists`` would be
    recomputed for every element. Binding it through a one-element
    ``transform`` keeps it to a single evaluation.
    """
    return F.get(F.transform(F.array(value), body), 0)


def md5_ids(ids: Column) -> Column:
    """Stable fingerprint of an int array (same text form as DuckDB)."""
    return F.md5(F.array_join(ids, ","))


def empty_int_array() -> Column:
    return F.array().cast("array<int>")


#: Ids, or bytes of text, that a Python step turns into objects at a time.
SLICE_SIZE = 1 << 18


def bounded_slices(batch: pa.RecordBatch, col: str, most: int = SLICE_SIZE) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts (in bytes) or arrays of ``col`` add up
    to ``most`` at most; a row that is larger is a slice of its own.

    Spark bounds the rows of an Arrow batch, not what Python makes of them:
    objects take many times the space of the columns.
    """
    values = batch.column(batch.schema.get_field_index(col))
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    ends = np.cumsum(length(values).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end


_INSTANCES: dict = {}


def worker_instance(factory):
    """Build ``factory()`` once per Python worker process.

    Tasks receive a fresh copy of the factory, so the cache key is a digest
    of its pickled form rather than its identity; Python workers are reused
    across tasks, so a model or tokenizer is loaded once per worker.
    """
    import hashlib

    from pyspark import cloudpickle
    try:
        key = hashlib.sha1(cloudpickle.dumps(factory)).hexdigest()
    except Exception:  # noqa: BLE001 - unpicklable here: fall back to identity
        key = str(id(factory))
    if key not in _INSTANCES:
        _INSTANCES[key] = factory()
    return _INSTANCES[key]
