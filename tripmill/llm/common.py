"""What several operators share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.sources.parquet import read_written, write_lake
from tripmill.sources.scratch import scratch_dir

# Bytes per Arrow batch that goes to a Python worker.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns of ``docs`` as one struct ``row``, so that no name of theirs can clash
    with one an operator uses, and ``more`` columns beside it."""
    whole = F.struct(*[column(name).alias(name) for name in docs.columns]).alias("row")
    return docs.select(whole, *[value.alias(name) for name, value in more.items()])


def unpacked(df: DataFrame, docs: DataFrame, **added: Column) -> DataFrame:
    """The columns of ``docs`` out of ``row`` again, with ``added`` columns: in the place
    of a column of that name, or else after the others."""
    own = {name: F.col("row").getField(name) for name in docs.columns}
    return df.select(*[value.alias(name) for name, value in {**own, **added}.items()])


def with_fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row, whatever is done with them above.

    They come out of a generator of one row, which no filter is pushed through and no
    projection merged into: without it a filter on a result, or a use within a lambda
    function, makes Spark work the expression out anew, for every element at worst.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per Spark application, as
    ``--py-files`` would: the operators' functions are loaded from it there."""
    context = spark.sparkContext
    if getattr(context, "_tripmill_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    # The driver serves the file to the executors for as long as the application runs.
    packed = Path(tempfile.mkdtemp(prefix="tripmill-")) / "tripmill.zip"
    with zipfile.ZipFile(packed, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(str(packed))
    context._tripmill_shipped = True


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers, batches of bounded size
    (the session's bound is lowered to :data:`BATCH_BYTES` if it is larger), and memory
    given back when a task ends: workers live on. The lowered bound stays with the session,
    as the frame that is returned runs later."""
    spark = df.sparkSession
    ship_package(spark)
    if _bytes(spark.conf.get(_BATCH_CONF)) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return df.mapInArrow(run, schema)


def _bytes(text: str) -> int:
    """A size setting as a number; without a bound it is as good as infinite."""
    digits = text.rstrip("bBkKmMgG")
    unit = text[len(digits) :].lower().rstrip("b")
    size = int(digits) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]
    return size if size > 0 else 1 << 62


# Scratch tables that are removed when the innermost scope ends.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch tables", default=None)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, its lineage cut,
    and safe from lost executors. A table at a given ``path`` outlives the scope."""
    scope = _SCOPE.get()
    if path is None:
        path = scratch_dir(df.sparkSession, name)
        if scope is not None:
            scope.append(path)
    write_lake(df, path)
    return read_written(df, path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables written within, once what was made of them is written too."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        remove_tables(spark, _SCOPE.get())
        _SCOPE.reset(token)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders from the file system they are in."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def in_batches(
    rows: Iterator[tuple], schema: pa.Schema, most_rows: int = 2_000, most_bytes: int = 4 << 20,
    size: Callable[[tuple], int] = lambda row: 64,
) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size, so that a task holds one batch at a
    time however long its texts are."""
    held: list[tuple] = []
    held_bytes = 0
    for row in rows:
        held.append(row)
        held_bytes += size(row)
        if len(held) >= most_rows or held_bytes >= most_bytes:
            yield _batch(held, schema)
            held, held_bytes = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    arrays = [pa.array(values, type=field.type) for values, field in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
