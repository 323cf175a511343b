"""Small help for tasks that work on Arrow batches."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: Rows and bytes handed to Python code at a time, and rows sent back at a time.
STEP_ROWS = 512


def kept_by_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in each Python worker process: tasks that follow one another share it.

    Only for what can be made again from ``key`` alone and is of bounded size.
    """
    kept = vars(sys.modules.setdefault("_kept_by_worker", ModuleType("_kept_by_worker")))
    if key not in kept:
        kept[key] = make()
    return kept[key]


def map_rows(
    df: DataFrame, schema: str, work: Callable[[], Callable[..., Iterable[tuple]]], keep: Sequence[str] = (),
) -> DataFrame:
    """Rows that ``work()`` makes from each group of up to ``STEP_ROWS`` rows, given as one list per column.

    ``work`` is called once in each task and may build what the task needs (a tokenizer, say). The last columns of ``df``
    can be named in ``keep``: then one row must be made of each, and these columns follow it as they are; of made columns
    with their names they take the place.
    """
    # Arrow batches as small as the steps: with Spark's default a batch of long texts would take much of an executor.
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", STEP_ROWS)
    # Parquet's vectored reads leave a direct buffer as large as a column of texts on each thread that has read one.
    df.sparkSession.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    made = _parse_datatype_string(schema)
    assert isinstance(made, StructType)
    arrow = to_arrow_schema(made)
    own = len(df.columns) - len(keep)
    shown = [i for i, name in enumerate(made.names) if name not in keep]
    kept = [StructField(name, field.dataType, True) for name, field in zip(keep, df.schema.fields[own:])]
    kind = StructType([made.fields[i] for i in shown] + kept)
    full = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for batch in batches:
            for start in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(start, STEP_ROWS)
                rows = list(step(*(column.to_pylist() for column in part.columns[:own])))
                if keep and len(rows) != part.num_rows:
                    raise ValueError("one row must be made of each")
                size = part.num_rows if keep else 8 * STEP_ROWS
                for first in range(0, len(rows), size):
                    columns = list(zip(*rows[first : first + size]))
                    arrays = [pa.array(columns[i], type=arrow.field(i).type) for i in shown]
                    follow = [c.cast(full.field(len(shown) + i).type) for i, c in enumerate(part.columns[own:])]
                    yield pa.RecordBatch.from_arrays(arrays + follow, schema=full)

    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(run, kind)
