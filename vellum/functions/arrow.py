"""Streaming helpers for ``mapInArrow``: consecutive groups out, record batches back, without pandas."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[tuple]]]:
    """(key, rows) of each run of equal keys.  The input has to be sorted by ``key`` within its partition;
    a group may span batches.  Rows are tuples in the batch's column order."""
    now, rows, started = None, [], False
    for batch in batches:
        k = batch.schema.get_field_index(key)
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns):
            if not started or row[k] != now:
                if started:
                    yield now, rows
                now, rows, started = row[k], [], True
            rows.append(row)
    if started:
        yield now, rows


def points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A column of outlines without NULLs as (x, y) of all their points, one after the other, and the points of each.
    NULL coordinates become NaN."""
    flat = column.flatten()
    parts = dict(zip((f.name for f in flat.type), flat.flatten()))
    return np.stack([parts[k].to_numpy(zero_copy_only=False) for k in ("x", "y")], axis=1), column.value_lengths().to_numpy(zero_copy_only=False)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of up to ``size`` rows."""
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat DDL string such as ``page_id BIGINT, text STRING``."""
    return pa.schema([(n, _TYPES[t.lower()]) for n, t in (x.split() for x in ddl.split(","))])


def map_rows(fn: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]], ddl: str):
    """A ``mapInArrow`` function from one that turns batches into row tuples of ``ddl``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(fn(batches), arrow_schema(ddl))

    return run
