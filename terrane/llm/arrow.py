"""Running a function over Arrow slices of bounded size inside Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Bytes of the measured column in one slice; one longer value makes a slice of its own.
SLICE_BYTES = 4 << 20


_state: dict[str, object] = {}


def worker_state(name: str, make: Callable[[], object]) -> object:
    """What an operator keeps between the tasks of one Python worker. A worker serves one operator after another and
    holds the state of the latest alone."""
    if name not in _state:
        _state.clear()
        _state[name] = make()
    return _state[name]


def shielding(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator that uses names with two underscores inside: columns of its table that have such names keep out of
    its way under others, and get theirs back."""

    @wraps(operator)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        own = {c: f"own {i} {c}" for i, c in enumerate(df.columns) if c.startswith("__")}
        return operator(df.withColumnsRenamed(own), *args, **options).withColumnsRenamed({v: k for k, v in own.items()})

    return run


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the values of `column` in each slice hold at most `limit` bytes, or one value."""
    size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def extend(df: DataFrame, column: str, fields: list[T.StructField], make: Callable[[], Callable[[pa.RecordBatch], list]], limit: int = SLICE_BYTES) -> DataFrame:
    """Add `fields`, computed from slices, to all other columns of `df`.

    `make` runs once in each task and gives the function from a slice to the new columns' values.
    A column of `df` that has the name of a new one is replaced.
    """
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    kept_names = [f.name for f in kept]
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(T.StructType([*kept, *fields]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for piece in slices(batch, column, limit):
                made = work(piece)
                arrays = [piece.column(n) for n in kept_names]
                arrays += [v if isinstance(v, pa.Array) else pa.array(v, type=out.field(f.name).type) for f, v in zip(fields, made, strict=True)]
                yield pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, out, strict=True)], names=out.names)

    return df.mapInArrow(run, T.StructType([*kept, *fields]))
