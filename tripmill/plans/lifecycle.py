"""All stages in one application: landing, ETL, warehouse, report tables, model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripmill.plans.etl import run_etl
from tripmill.plans.marts import build_marts
from tripmill.plans.training import train_fare_model
from tripmill.sources.landing import land_files
from tripmill.sources.parquet import base_name, read_parts
from tripmill.sources.warehouse import FACT, create_dimensions, read_table, write_fact


@dataclass(frozen=True)
class LifecycleResult:
    landed: DataFrame
    clean_rows: int
    lake: str
    warehouse: str
    marts: dict[str, str]
    model: DataFrame


def run_lifecycle(spark: SparkSession, sources: Sequence[str], root: str) -> LifecycleResult:
    """Run the stages below ``root``. A rerun replaces what an earlier one wrote.

    A file that did not land stops the chain at the ETL, which needs all of them.
    """
    base = root.rstrip("/")
    raw, lake, warehouse = f"{base}/raw", f"{base}/lake/trips_clean", f"{base}/warehouse"
    landed = land_files(spark, sources, raw)
    create_dimensions(spark, warehouse)
    rows = run_etl(
        spark,
        [f"{raw}/{base_name(source)}" for source in sources],
        lake,
        warehouse=lambda fact: write_fact(fact, warehouse, mode="overwrite"),
    )
    marts = build_marts(read_table(spark, warehouse, FACT), f"{base}/marts")
    model = train_fare_model(read_parts(spark, lake), f"{base}/model")
    return LifecycleResult(landed, rows, lake, warehouse, marts, model)
