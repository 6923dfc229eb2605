"""Stored models: one row of parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.errors import MissingInputError
from tripmill.sources.parquet import read_file, write_lake


def save_model(model: DataFrame, path: str) -> None:
    write_lake(model.coalesce(1), path)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    try:
        return read_file(spark, path)
    except MissingInputError as error:
        raise MissingInputError(f"no model at {path}: train one first") from error
