"""Folds over sorted rows whose state decides where the next run begins.

Such a fold can't be split where its state matters, so components that no run crosses are dealt to tasks and
sorted, and each streams through in Arrow batches: the state is handed from batch to batch, and a
finished run leaves at once. Memory is one batch and one run, whatever the size of a component or a chromosome.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Runs in a batch of results.
EMITTED = 5_000


def fold_runs(df: DataFrame, component: Sequence[str], order: Sequence[str], keep: Sequence[str], begin: Callable[[dict], dict], add: Callable[[dict, dict], bool], fields: Sequence[StructField]) -> DataFrame:
    """`keep` and `fields` of each run, in which rows of a component come in `order`.

    begin: a row to the state of a run of it alone, a dict with the fields; add: takes a row into a state, or says
    that it doesn't fit, whereupon the run ends. `keep` names columns of the component that stay.
    """
    schema = StructType([*(df.schema[c] for c in keep), *fields])
    arrow = to_arrow_schema(schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple | None = None
        state: dict[str, Any] = {}
        done: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                here = tuple(row[c] for c in component)
                if here == at and add(state, row):
                    continue
                if at is not None:
                    done.append(state)
                at, state = here, {c: row[c] for c in keep} | begin(row)
            if len(done) >= EMITTED:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if at is not None:
            yield pa.RecordBatch.from_pylist([*done, state], schema=arrow)

    return df.repartition(*component).sortWithinPartitions(*component, *order).mapInArrow(stream, schema)
