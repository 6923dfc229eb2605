"""Parquet scans and sinks."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.errors import MissingInputError, SchemaConflictError
from tripmill.operators.standardize import standardize, union_by_name

_MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
_INFER_PARTITIONS = "spark.sql.sources.partitionColumnTypeInference.enabled"


@contextmanager
def missing_input(path: str):
    """Turn Spark's two ways to say 'nothing there', and its ways to say that part files
    disagree, into one error each that names the path."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() in _MISSING:
            raise MissingInputError(f"no parquet files at {path}") from error
        raise
    except Exception as error:
        if "CANNOT_MERGE" in str(error) or "Failed merging schema" in str(error):
            raise SchemaConflictError(f"the part files of {path} have conflicting types") from error
        raise


@contextmanager
def text_partitions(spark: SparkSession):
    """Partition values are read as the texts they are: ``007`` is not 7."""
    before = spark.conf.get(_INFER_PARTITIONS)
    if before == "false":
        yield
        return
    spark.conf.set(_INFER_PARTITIONS, "false")
    try:
        yield
    finally:
        spark.conf.set(_INFER_PARTITIONS, before)


def base_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """One parquet file, or one directory of files, with the columns of all of them."""
    with missing_input(path), text_partitions(spark):
        return spark.read.option("mergeSchema", "true").parquet(path)


def read_written(df: DataFrame, path: str) -> DataFrame:
    """What was just written from ``df``, without a look at its footers for the schema."""
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_months(
    spark: SparkSession,
    paths: Sequence[str],
    transform: Callable[[DataFrame], DataFrame] = standardize,
    batch_column: str | None = None,
    parallel: int = 8,
) -> DataFrame:
    """The union of monthly inputs whose schemas differ.

    One scan over all files fails when a column's type changes between them, so
    each is brought to one schema before the union. Inputs that share a schema
    are read by one scan: the plan grows with the number of distinct schemas,
    not of inputs. Only footers are read here, some at a time; an input that is a
    directory has the columns of all its part files.

    ``batch_column`` adds the input's name, taken from the path each row was read
    from; see :func:`tripmill.sources.warehouse.write_fact`. ``transform`` has to
    let it pass.
    """
    if not paths:
        raise MissingInputError("no input paths given")
    names = [base_name(path) for path in paths]
    if batch_column and len(set(names)) < len(names):
        raise ValueError("two inputs have the same name")
    with text_partitions(spark), ThreadPoolExecutor(max_workers=parallel) as pool:
        schemas = list(pool.map(lambda path: read_file(spark, path).schema, paths))
    groups: dict[str, tuple] = {}
    for path, schema in zip(paths, schemas):
        groups.setdefault(schema.json(), (schema, []))[1].append(path)
    frames = []
    for schema, same in groups.values():
        frame = spark.read.schema(schema).parquet(*same)
        if batch_column:
            frame = frame.select("*", _input_name(list(map(base_name, same))).alias(batch_column))
        frames.append(transform(frame))
    return union_by_name(frames)


def _input_name(names: Sequence[str]) -> Column:
    """Which of the inputs a row was read from: the last part of its file's path that is
    the name of one."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    last = F.substring_index(path, "/", -1)
    among = F.element_at(F.filter(F.split(path, "/"), lambda part: part.isin(*names)), -1)
    return F.when(last.isin(*names), last).otherwise(among)


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The part files of a directory another job wrote, as the outer union of their
    columns; markers and strays are left out. The cluster reads every footer."""
    with missing_input(path), text_partitions(spark):
        return (
            spark.read.option("pathGlobFilter", "part-*.parquet")
            .option("mergeSchema", "true")
            .parquet(path)
        )


def write_lake(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write a parquet directory, replacing it by default. No shuffle: every task
    writes its own rows."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def replace_batches(df: DataFrame, path: str, column: str, names: Sequence[str]) -> None:
    """Write a directory partitioned by ``column``, replacing the partitions of
    ``names`` and no other. A batch that has no rows any more is emptied."""
    strange = [name for name in names if not re.fullmatch(r"[\w.+-]+", name)]
    if strange:
        raise ValueError(f"not usable as a directory name: {strange}")
    # Which batches have rows is counted by the write itself.
    counted = Observation()
    counts = [F.count_if(F.col(column) == name).alias(str(i)) for i, name in enumerate(names)]
    (
        (df.observe(counted, *counts) if names else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )
    found = counted.get if names else {}
    for i, name in enumerate(names):
        if not found[str(i)]:
            nothing = df.sparkSession.createDataFrame([], df.drop(column).schema)
            write_lake(nothing, f"{path.rstrip('/')}/{column}={name}")


def at_once(*jobs: Callable[[], object]) -> None:
    """Run independent jobs together; the first error is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a written directory. No column is read, only footers."""
    return read_file(spark, path).count()
