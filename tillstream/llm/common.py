"""What the operators share: the tables, and work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillstream.session import durable

__all__ = [
    "Memo", "append", "durable", "emit", "found_by_workers", "span_text", "table",
]

#: Rows that a Python function gets at once.
SLICE_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def found_by_workers(rows: DataFrame) -> None:
    """Workers on this machine look for this package where the driver found it.

    A cluster gets the package by ``--py-files`` or as an installed one.
    """
    context = rows.sparkSession.sparkContext
    if context.master.startswith("local"):
        root, paths = str(Path(__file__).parents[2]), context.environment.get("PYTHONPATH", "")
        if root not in paths.split(":"):
            context.environment["PYTHONPATH"] = f"{root}:{paths}".rstrip(":")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def append(
    rows: DataFrame,
    keep: Sequence[str],
    inputs: Sequence[str],
    function: Callable[..., list[pa.Array]],
    fields: Sequence[StructField],
) -> DataFrame:
    """``keep`` and the new ``fields``, a row for each row.

    ``function`` gets a list of values for each of ``inputs`` and returns an Arrow array for each
    field. It sees a few rows at a time, so what it holds does not grow with a partition.
    """
    names = [*keep, *(f.name for f in fields)]
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            values = [part.column(n + i).to_pylist() for i in range(len(inputs))]
            kept = [part.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*kept, *function(*values)], names=names)

    found_by_workers(rows)
    schema = StructType([*(rows.schema[k] for k in keep), *fields])
    selected = rows.select(
        *(F.col(f"`{k}`") for k in keep),
        *(F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(inputs)),
    )
    return selected.mapInArrow(run, schema)


def emit(
    rows: DataFrame,
    inputs: Sequence[str],
    function: Callable[[Iterator[tuple[list, ...]]], Iterator[list[pa.Array]]],
    schema: StructType,
) -> DataFrame:
    """Rows of ``schema`` from a function over a task's rows, given a few at a time."""
    names = schema.fieldNames()
    n = len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = (
            tuple(part.column(i).to_pylist() for i in range(n)) for part in _slices(batches)
        )
        for arrays in function(values):
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    found_by_workers(rows)
    return rows.select(*(F.col(f"`{c}`") for c in inputs)).mapInArrow(run, schema)


class Memo:
    """What a function gives for each key, remembered for the keys in use of late.

    Two generations of at most ``limit`` keys and those of one call: when the younger is full it
    becomes the older, from which keys come back when they are asked for again.
    """

    def __init__(self, learn: Callable[[list], dict], limit: int):
        self.learn, self.limit = learn, limit
        self.young: dict = {}
        self.old: dict = {}

    def of(self, keys: set) -> dict:
        """A mapping that has all the keys."""
        young = self.young
        missing = keys.difference(young)
        if missing:
            back = {k: self.old[k] for k in missing if k in self.old}
            young.update(back)
            if len(back) < len(missing):
                young.update(self.learn([k for k in missing if k not in back]))
            if len(young) > self.limit:
                self.old, self.young = young, {k: young[k] for k in keys}
        return young


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of an array of structs with these fields, comma-joined, as ordered."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )
