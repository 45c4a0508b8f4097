"""Helpers shared by the operators: table access, batches in Python tasks, reliable cut points."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from feedlens.session import ensure_checkpoint_dir, scratch_path

#: Rows of one Arrow batch handed back by a Python task.
OUT_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def compact(df: DataFrame, rows: int = 200_000) -> tuple[DataFrame, int]:
    """``cut``, then as many partitions as its rows (of a few numbers each) fill; also the number of rows."""
    done = cut(df)
    n = done.count()
    return done.coalesce(max(1, -(-n // rows))), n


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A never-used path in the shared folder, as a URI with a scheme."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def records(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, so many at a time as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, size).columns))


def arrow_schema(schema: str | StructType) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def out_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = OUT_ROWS,
                max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Tuples packed into Arrow batches bounded by rows and by bytes of text."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) * (8 if isinstance(v, list) else 1) for v in row if isinstance(v, (str, bytes, list)))
        if len(held) >= size or weight >= max_bytes:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, type=field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def sample(df: DataFrame, key: Column, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest keys (a hash, as a long), in order of the key.

    Rows are counted first, so that tasks send the driver about twice as many as are kept in all, not ``n`` each.
    """
    rows = df.count()
    most = -(2**63) + int(min(1.0, 2 * n / max(1, rows)) * (2**64 - 1))
    return df.where(key <= min(most, 2**63 - 1)).orderBy(key).limit(n)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand the package to Spark once per application, which gives it to every executor's Python workers."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def map_rows(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` for a generator that takes and gives tuples, one per row."""
    fields = arrow_schema(schema)
    ship(df.sparkSession)

    def run(batches):
        yield from out_batches(function(records(batches)), fields)

    return df.mapInArrow(run, schema)
