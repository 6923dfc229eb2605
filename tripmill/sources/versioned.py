"""Tables that are replaced as a whole or not at all.

A table is a folder of data, of which nothing is ever changed, and of versions. A version is
a small file that names the data folders it is made of, one per batch, and it is put in its
place, in one step, when they are all written. Readers follow the newest version; a job that
dies before that leaves the old one as it was. Replacing some batches writes only these: the
new version names the others' folders again.

    <table>/data/write=<id>/[<batch column>=<batch>/]part-*.parquet
    <table>/versions/<number>.json
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.errors import ConflictError, MissingInputError
from tripmill.sources.parquet import text_partitions, write_lake

WRITE = "write"
_NUMBER = re.compile(r"(\d{10})\.json")


@dataclass(frozen=True)
class Version:
    """What a table is made of: ``parts`` maps a batch's name (or "" for a table without
    batches) to its folder below ``data``."""

    number: int
    schema: T.StructType
    batch_column: str | None
    parts: dict[str, str]


class _Files:
    """The table's small files, in whatever file system the cluster keeps it."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        jvm = spark.sparkContext._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.jvm, self.root = jvm, root.rstrip("/")
        self.system = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        if not self.system.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(path))

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A new file, whole from the moment it is there; an error if it is there already."""
        draft = self.path(f"versions/_draft-{uuid.uuid4().hex}")
        stream = self.system.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.system.getUri(), self.conf)
        # Without an option to overwrite: of two jobs that replace one version, one fails.
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, self.path(name), options)
        except Py4JJavaError as error:
            self.system.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception.getClass().getName()):
                raise ConflictError(f"another job has written {name} of {self.root} meanwhile") from error
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def _versions(files: _Files) -> list[int]:
    found = [_NUMBER.fullmatch(name) for name in files.names("versions")]
    return [int(match[1]) for match in found if match]


def _load(files: _Files, number: int) -> Version:
    held = json.loads(files.read(f"versions/{number:010d}.json"))
    return Version(number, T.StructType.fromJson(held["schema"]), held["batch_column"], held["parts"])


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of the versions there are, oldest first."""
    return _versions(_Files(spark, root))


def current_version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The newest version, or the one of that number; None if there is none."""
    files = _Files(spark, root)
    known = _versions(files)
    if number is None:
        return _load(files, known[-1]) if known else None
    return _load(files, number) if number in known else None


def read_version(
    spark: SparkSession, root: str, number: int | None = None, batches: Sequence[str] | None = None
) -> DataFrame:
    """The table as of its newest version, or an earlier one; of all batches, or only of
    these, whose files alone are opened."""
    version = current_version(spark, root, number)
    if version is None:
        raise MissingInputError(f"no version {'' if number is None else number} of a table at {root}")
    return _frame(spark, root, version, batches)


def _frame(spark: SparkSession, root: str, version: Version, batches: Sequence[str] | None = None) -> DataFrame:
    wanted = [folder for name, folder in version.parts.items() if batches is None or name in batches]
    if not wanted:
        return spark.createDataFrame([], version.schema)
    data = f"{root.rstrip('/')}/data"
    schema = T.StructType([*version.schema.fields, T.StructField(WRITE, T.StringType())])
    with text_partitions(spark):
        frame = spark.read.schema(schema).option("basePath", data).parquet(*[f"{data}/{folder}" for folder in wanted])
    return frame.select(*[f"`{name}`" for name in version.schema.names])


def replace_version(
    df: DataFrame, root: str, batch_column: str | None = None, batches: Sequence[str] = ()
) -> Version:
    """Write ``df`` as the table's next version. Eager; the old version is read by others,
    and may be read by ``df`` itself, until the new one is whole.

    Without ``batch_column`` the whole table is replaced. With it the table is kept in a
    folder per batch, and ``batches`` are replaced and no others; a batch of them without
    rows is gone afterwards. Their columns are the other batches', in any order. Rows of
    other batches are an error. Data that no version names
    (a dead job's) do no harm; :func:`expire_versions` removes them.
    """
    spark = df.sparkSession
    files = _Files(spark, root)
    known = _versions(files)
    before = _load(files, known[-1]) if known else None
    strange = [name for name in batches if not re.fullmatch(r"[\w.+-]+", name)]
    if strange:
        raise ValueError(f"not usable as a directory name: {strange}")
    if WRITE in df.columns:
        raise ValueError(f"a column may not be named {WRITE}")
    if before is not None and batches and before.batch_column != batch_column:
        raise ValueError(f"the table's batches are told apart by {before.batch_column}")
    if before is not None and batch_column is not None and set(df.columns) == set(before.schema.names):
        df = df.select(*[f"`{name}`" for name in before.schema.names])
    folder = f"{WRITE}={uuid.uuid4().hex}"
    schema = df.schema
    if batch_column is None:
        write_lake(df, f"{files.root}/data/{folder}")
        parts = {"": folder}
    else:
        schema = T.StructType(
            [f for f in schema.fields if f.name != batch_column] + [T.StructField(batch_column, T.StringType())]
        )
        inside = F.col(batch_column).isin(list(batches)) if batches else F.lit(False)
        wrong = F.raise_error(F.concat(F.lit("a row of no given batch: "), F.coalesce(F.col(batch_column), F.lit("NULL"))))
        checked = df.withColumn(batch_column, F.when(inside, F.col(batch_column)).otherwise(wrong.cast("string")))
        write_lake(checked, f"{files.root}/data/{folder}", partition_by=[batch_column])
        prefix = f"{batch_column}="
        written = {n[len(prefix) :] for n in files.names(f"data/{folder}") if n.startswith(prefix)}
        kept = before.parts if before is not None else {}
        parts = {name: where for name, where in kept.items() if name not in batches}
        parts |= {name: f"{folder}/{prefix}{name}" for name in batches if name in written}
        if before is not None and kept and _types(before.schema) != _types(schema):
            raise ValueError("the new batches' columns are not those of the others")
    number = known[-1] + 1 if known else 0
    version = Version(number, schema, batch_column, parts)
    text = json.dumps({"schema": schema.jsonValue(), "batch_column": batch_column, "parts": parts})
    files.system.mkdirs(files.path("versions"))
    files.put(f"versions/{number:010d}.json", text)
    return version


def _types(schema: T.StructType) -> list[tuple[str, T.DataType]]:
    return [(field.name, field.dataType) for field in schema.fields]


def is_versioned(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, root))


def expire_versions(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove all but the newest ``keep`` versions, and the data that none of these names.
    Not to be run while another job writes the table. Returns the folders removed."""
    if keep < 1:
        raise ValueError("the newest version stays")
    files = _Files(spark, root)
    known = _versions(files)
    named = {folder for number in known[-keep:] for folder in _load(files, number).parts.values()}
    for number in known[:-keep]:
        files.delete(f"versions/{number:010d}.json")
    removed = []
    for write in files.names("data"):
        inside = {folder for folder in named if folder.split("/")[0] == write}
        if write in inside:
            continue
        if not inside:
            files.delete(f"data/{write}")
            removed.append(write)
            continue
        for part in files.names(f"data/{write}"):
            if "=" in part and f"{write}/{part}" not in inside:
                files.delete(f"data/{write}/{part}")
                removed.append(f"{write}/{part}")
    return removed
