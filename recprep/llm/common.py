"""Helpers that the operators of this package share.

Rules all of them follow:

* A row operator keeps every input row and column and appends its results;
  an input column whose name clashes with a result column is replaced.
* A null text counts as empty unless an operator says otherwise.
* Intermediate tables go to the folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recprep.session import ship_package, staging_path

#: bytes of text that a Python task holds at once (about; one text may be longer)
SLICE_BYTES = 4 << 20


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, so that a lost executor costs a re-read and not a re-run."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body`` (a one-element
    ``transform``); Catalyst cannot inline it into every use."""
    return F.transform(F.array(value), body)[0]


def append_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField],
                   make: Callable[[], Callable[..., list]], raw: bool = False) -> DataFrame:
    """Keep ``df``'s rows and columns and append ``fields``.

    ``make()`` runs once per task and returns a function from the input
    columns (lists of Python values, or Arrow arrays if ``raw``; a slice of a
    batch at a time) to one Arrow array or list per field. Slices are cut at about SLICE_BYTES.
    """
    spark = df.sparkSession
    ship_package(spark)
    new = {f.name for f in fields}
    passed = [c for c in df.columns if c not in new]
    # inputs travel under their own names unless a result replaces them
    tmp = {c: f"__in_{i}" for i, c in enumerate(inputs) if c in new}
    src = df.select(*[F.col(f"`{c}`") for c in passed],
                    *[F.col(f"`{c}`").alias(t) for c, t in tmp.items()])
    names = [tmp.get(c, c) for c in inputs]
    out = T.StructType([f for f in src.schema if f.name in passed] + list(fields))
    kinds = [_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for b in slices(whole, names):
                cols = [b.column(b.schema.get_field_index(n)) for n in names]
                res = fn(*(cols if raw else [c.to_pylist() for c in cols]))
                cols = [b.column(b.schema.get_field_index(c)) for c in passed]
                cols += [r if isinstance(r, pa.Array) else pa.array(r, type=k)
                         for r, k in zip(res, kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=passed + [f.name for f in fields])

    return src.mapInArrow(run, out)


def slices(batch: pa.RecordBatch, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about SLICE_BYTES of the named
    columns; a single larger row is a part of its own."""
    n = batch.num_rows
    size = sum(batch.column(batch.schema.get_field_index(c)).nbytes for c in names)
    if size <= SLICE_BYTES or n <= 1:
        if n:
            yield batch
        return
    half = n // 2
    yield from slices(batch.slice(0, half), names)
    yield from slices(batch.slice(half), names)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
