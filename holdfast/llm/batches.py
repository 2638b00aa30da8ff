"""Python over Arrow batches: computed columns beside carried ones, and runs of equal keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows whose Python objects exist at one time; a batch is worked off in such slices.
SLICE = 128


#: Rows of whole texts that go to Python at once.
BATCH_ROWS = 2_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(df: DataFrame) -> None:
    """Lower the session's batch size to ``BATCH_ROWS`` if it is larger or unlimited: the
    default of 10,000 rows is made for numbers, and long texts in it would fill a task's
    memory on both sides."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def column(name: str):
    """The column of exactly this name, whatever characters it holds."""
    return F.col(f"`{name.replace('`', '``')}`")


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def annotate(
    df: DataFrame,
    needs: Sequence[str],
    carry: Sequence[str],
    result: str,
    fields: T.StructType,
    start: Callable[[], Callable[..., list]],
) -> DataFrame:
    """The ``carry`` columns and a struct column ``result`` computed from ``needs``.

    ``start`` runs once in each task and returns a function from the values of ``needs``
    (lists, one per column) to one list of tuples, the struct's fields in order.
    """
    limit_batches(df)
    source = df.select(*[column(c).alias(f"c{i}") for i, c in enumerate([*carry, *needs])])
    carried_fields = [
        T.StructField(c, f.dataType, f.nullable) for c, f in zip(carry, source.schema.fields)
    ]
    schema = T.StructType([*carried_fields, T.StructField(result, fields, False)])
    arrow = to_arrow_schema(schema)
    struct = arrow.field(len(carry)).type
    kept = len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                rows = compute(*(c.to_pylist() for c in part.columns[kept:]))
                columns = zip(*rows) if rows else [()] * struct.num_fields
                arrays = [pa.array(c, struct.field(i).type) for i, c in enumerate(columns)]
                made = pa.StructArray.from_arrays(arrays, fields=[*struct])
                carried = [c.cast(arrow.field(i).type) for i, c in enumerate(part.columns[:kept])]
                yield pa.RecordBatch.from_arrays([*carried, made], schema=arrow)

    return source.mapInArrow(run, schema)


def expand(
    df: DataFrame, schema: T.StructType, start: Callable[[], Callable[..., dict]]
) -> DataFrame:
    """Rows made from rows: ``start`` runs once in each task and returns a function from a
    record batch to the arrays of a new batch, in the order of ``schema``."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            arrays = compute(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, arrow.field(i).type) for i, a in enumerate(arrays)], schema=arrow
            )

    return df.mapInArrow(run, schema)


def by_runs(
    df: DataFrame,
    keys: Sequence[str],
    schema: T.StructType,
    start: Callable[[], Callable[[pa.Table], Sequence | None]],
) -> DataFrame:
    """Apply a function to the rows of each combination of ``keys`` (never null) that has two
    rows or more.

    Rows are dealt by the keys and sorted, so a task streams over its groups; only one group
    is in memory besides the batch.  Unlike a grouped map this costs nothing for the many
    groups of one row, which are skipped.
    """
    arrow = to_arrow_schema(schema)
    dealt = df.repartition(*[column(k) for k in keys]).sortWithinPartitions(
        *[column(k) for k in keys]
    )
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        held: list[pa.RecordBatch] = []  # the last group so far
        held_key: tuple | None = None

        def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(parts)
            made = compute(table) if table.num_rows > 1 else None
            if made is not None and len(made[0]):
                arrays = [pa.array(a, arrow.field(i).type) for i, a in enumerate(made)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            values = [np.asarray(batch.column(batch.schema.get_field_index(k))) for k in names]
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for v in values:
                new[1:] |= v[1:] != v[:-1]
            starts = np.flatnonzero(new)
            ends = np.append(starts[1:], batch.num_rows)
            first = tuple(v[0].item() for v in values)
            if held and held_key != first:
                yield from done(held)
                held = []
            elif held:
                held.append(batch.slice(0, ends[0]))
                starts, ends = starts[1:], ends[1:]
                if len(starts):
                    yield from done(held)
                    held = []
            if len(starts):
                for s in np.flatnonzero(ends[:-1] - starts[:-1] > 1):
                    yield from done([batch.slice(starts[s], ends[s] - starts[s])])
                held = [batch.slice(starts[-1], ends[-1] - starts[-1])]
            held_key = tuple(v[-1].item() for v in values)
        if held:
            yield from done(held)

    return dealt.mapInArrow(run, schema)
