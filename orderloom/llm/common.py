"""What the operators share: scratch tables, the package on the executors, texts in slices."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderloom.session import work_dir
from orderloom.sinks.tables import remove_folder

#: Rows and text that a task holds as Python objects at once.
SLICE_ROWS, SLICE_BYTES = 256, 2_000_000
_shipped: set[str] = set()
_scratch: list[str] = []
_memory: dict[str, dict] = {}
TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
         "boolean": T.BooleanType(), "double": T.DoubleType(), "binary": T.BinaryType(),
         "bigints": T.ArrayType(T.LongType()), "ints": T.ArrayType(T.IntegerType()),
         "strings": T.ArrayType(T.StringType()),
         "bigint_lists": T.ArrayType(T.ArrayType(T.LongType()))}


def columns(text: str) -> T.StructType:
    """Schema from "name type, ...", without a session."""
    return T.StructType([T.StructField(name, TYPES[kind])
                         for name, kind in (x.split() for x in text.split(","))])


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python tasks can import it."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="orderloom-package-"), "orderloom_package.zip")
    with open(path, "wb") as f:  # on the driver only; Spark serves it to the executors
        f.write(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(spark.sparkContext.applicationId)


def written(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and not again if an executor is lost. `by`
    is a column, the last one, of which every value gets a folder of its own.

    The shuffle files of the plan are of no use any more. Spark deletes them when its driver collects
    garbage, which a driver with little to do hardly does by itself, so it is asked to.
    """
    path = work_dir(df.sparkSession, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    _scratch.append(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """One table of several frames of like columns, written one after the other, so that the shuffle
    files of one are gone when the next is computed."""
    paths = []
    for part in parts:
        made = written(part, label)
        paths.append(_scratch[-1])
    return made.sparkSession.read.schema(made.schema).parquet(*paths)


def scratch_path() -> str:
    """The folder of the table written last."""
    return _scratch[-1]


def scratch_mark() -> int:
    """Where the tables written from now on begin; see `discard`."""
    return len(_scratch)


def drop_scratch(spark: SparkSession, since: int, upto: int) -> None:
    """Removes the scratch tables between two marks; for whoever wrote them and reads them no more."""
    for i in range(since, upto):
        if _scratch[i]:
            remove_folder(spark, _scratch[i])
            _scratch[i] = ""


def discard(docs: DataFrame, since: int, upto: int) -> None:
    """Removes the scratch tables between two marks, but for those that `docs` still reads."""
    files = docs.inputFiles()
    for i in range(since, upto):
        name = _scratch[i].rsplit("/", 1)[-1]  # unique by itself
        if name and not any(f"/{name}/" in f for f in files):
            remove_folder(docs.sparkSession, _scratch[i])
            _scratch[i] = ""
    gc.collect()
    docs.sparkSession.sparkContext._jvm.System.gc()


def fresh(name: str, taken: list[str]) -> str:
    """`name`, lengthened until no column of that name is there."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def per_slice(df: DataFrame, task: Callable[[dict[str, list]], dict[str, list]], schema: T.StructType,
              rows: int = SLICE_ROWS) -> DataFrame:
    """Applies `task` to slices of the rows, columns as lists in and out."""
    ship(df.sparkSession)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches, rows):
            made = task(columns)
            if made[schema.names[0]]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def attached(df: DataFrame, needs: list[str], task: Callable[[dict[str, list]], list[dict]],
             name: str, kind: T.StructType) -> DataFrame:
    """All columns of `df` and a struct `name`, made by `task` from slices of the columns `needs`."""
    ship(df.sparkSession)
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    kept = [c for c in df.columns if c != name]
    plain = by_position(df)
    schema = T.StructType([*[plain.schema[at[c]] for c in kept], T.StructField("made", kind)])
    fields = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = pa.RecordBatch.from_arrays([batch.column(at[c]) for c in needs], names=needs)
            made = [x for part in slices([asked]) for x in task(part)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(made, f.type) if f.name == "made" else batch.column(f.name)
                 for f in fields], schema=fields)

    return plain.mapInArrow(run, schema).toDF(*kept, name)


def by_position(df: DataFrame) -> DataFrame:
    """The columns named c0, c1, ...: Arrow functions do not take names with dots, and no new column
    can clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[dict[str, list]]:
    """Columns as lists, of at most `rows` rows and about `SLICE_BYTES` of text (or one row)."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, "i8")
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        upto, first = np.cumsum(sizes), 0
        while first < batch.num_rows:
            before = upto[first] - sizes[first]
            end = int(np.searchsorted(upto, before + SLICE_BYTES, side="right"))
            part = batch.slice(first, max(1, min(end - first, rows)))
            yield {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
            first += part.num_rows


def worker_memory(owner: str) -> dict:
    """What one operator keeps in a Python worker between tasks. Workers serve one task after another;
    when another operator comes, what the one before kept is dropped.
    """
    if owner not in _memory:
        _memory.clear()
        _memory[owner] = {}
    return _memory[owner]


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
