"""Copy raw files into the lake."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.errors import TripmillError
from tripmill.sources.parquet import base_name, missing_input, read_file, row_count, write_lake
from tripmill.sources.versioned import current_version, read_version, replace_version

STATUS_SCHEMA = "file string, ok boolean, rows long, error string"


def land_file(spark: SparkSession, source: str, target: str) -> tuple[str, bool, int | None, str | None]:
    """Read and rewrite one file, under its own name. Errors are reported, not raised."""
    name = base_name(source)
    destination = f"{target.rstrip('/')}/{name}"
    try:
        write_lake(read_file(spark, source), destination)
        return name, True, row_count(spark, destination), None
    except TripmillError as error:
        return name, False, None, str(error)
    except Exception as error:  # a broken file must not stop the others
        first = str(error).partition("\n")[0]
        return name, False, None, f"{type(error).__name__}: {first}"


def land_files(
    spark: SparkSession, sources: Sequence[str], target: str, parallel: int = 4
) -> DataFrame:
    """Land each file; a bad one does not stop the rest. Eager.

    Returns one status row per file: file, ok, rows, error. Several copies run at
    a time, so that the tail of one file does not leave the executors idle.
    """
    names = [base_name(source) for source in sources]
    if len(set(names)) < len(names):
        raise ValueError("two sources would land under one name")
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        status = list(pool.map(lambda source: land_file(spark, source, target), sources))
    return spark.createDataFrame(status, STATUS_SCHEMA)


# The manifest's folder; its name hides it from readers of the target.
LANDED = "_landed"
_LISTED = "file string, source string, bytes long, print long, error string"


def _listed(spark: SparkSession, source: str) -> tuple[str, str, int | None, int | None, str | None]:
    """What a source is made of: its bytes, and a fingerprint of its files' names, sizes and
    times. No file is opened."""
    name = base_name(source)
    try:
        with missing_input(source):
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
        row = files.agg(
            F.sum("length").alias("bytes"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("print")
        ).first()
        if row["bytes"] is None:
            return name, source, None, None, f"no parquet files at {source}"
        return name, source, row["bytes"], row["print"], None
    except TripmillError as error:
        return name, source, None, None, str(error)


def land_new(
    spark: SparkSession, sources: Sequence[str], target: str, parallel: int = 4
) -> DataFrame:
    """Land the files that are not landed yet, or have changed since. Eager.

    A manifest beside the copies says which sources are there: name, size and a fingerprint
    of their files' names, sizes and times. Sources are listed, not read, and joined against
    it; only the others are copied, over the copy of that name if there is one. Returns one
    row per source: file, action (``landed``, ``skipped`` or ``failed``), rows, error. A file
    that failed is tried again the next time, and its old copy counts no more.
    """
    names = [base_name(source) for source in sources]
    if len(set(names)) < len(names):
        raise ValueError("two sources would land under one name")
    manifest = f"{target.rstrip('/')}/{LANDED}"
    known = current_version(spark, manifest) is not None
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        listed = spark.createDataFrame(list(pool.map(lambda s: _listed(spark, s), sources)), _LISTED)
        if known:
            before = read_version(spark, manifest)
        else:
            before = spark.createDataFrame([], "file string, bytes long, print long, rows long")
        new = listed.filter("error IS NULL").join(before, ["file", "bytes", "print"], "left_anti").collect()
        done = list(pool.map(lambda row: land_file(spark, row["source"], target), new))
    landed = spark.createDataFrame(done, STATUS_SCHEMA)
    prints = listed.select("file", "bytes", "print")
    kept = before.join(landed, "file", "left_anti")
    added = landed.filter("ok").join(prints, "file").select("file", "bytes", "print", "rows")
    if done:
        replace_version(kept.unionByName(added).coalesce(1), manifest)
        before = read_version(spark, manifest)
    status = (
        listed.select("file", F.col("error").alias("listing"))
        .join(landed.select("file", "ok", F.col("error").alias("copying")), "file", "left")
        .join(before.select("file", "rows"), "file", "left")
    )
    error = F.coalesce("listing", "copying")
    action = F.when(error.isNotNull(), "failed").when(F.col("ok"), "landed").otherwise("skipped")
    # A source that is not there now says nothing of its copy's rows.
    return status.select("file", action.alias("action"), F.when(error.isNull(), F.col("rows")).alias("rows"), error.alias("error"))
