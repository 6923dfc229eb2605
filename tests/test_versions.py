"""Versioned tables: what readers see while, after and instead of a replacement."""

import threading
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripmill.bindings import fixture as X
from tripmill.bindings.queries import clean
from tripmill.errors import ConflictError, ConstraintError, MissingInputError
from tripmill.operators import quality as Q
from tripmill.operators.star import to_warehouse
from tripmill.operators.standardize import standardize
from tripmill.operators.clean import clean_trips
from tripmill.plans.etl import run_etl
from tripmill.sources import versioned as V
from tripmill.sources import dimensions as D
from tripmill.sources import parquet, warehouse


@pytest.fixture
def months(spark):
    return spark.range(100).select("id", F.concat(F.lit("0"), (F.col("id") % 4).cast("string")).alias("month"))


def total(df):
    return df.agg(F.sum("id")).first()[0]


def dies(df, column="id"):
    return df.withColumn(column, F.when(F.col(column) == 57, F.raise_error(F.lit("dies")).cast("long")).otherwise(F.col(column)))


def test_a_replacement_that_dies_changes_nothing(spark, months, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(MissingInputError):
        V.read_version(spark, root)
    with pytest.raises(PySparkException):
        V.replace_version(dies(months), root)
    assert V.versions(spark, root) == [] and not V.is_versioned(spark, root)
    V.replace_version(months, root)
    with pytest.raises(PySparkException):
        V.replace_version(dies(months.withColumn("id", F.col("id") + 0)), root)
    assert V.versions(spark, root) == [0] and total(V.read_version(spark, root)) == 4950
    V.replace_version(V.read_version(spark, root).filter("id < 10"), root)  # from itself
    assert total(V.read_version(spark, root)) == 45 and total(V.read_version(spark, root, 0)) == 4950
    with pytest.raises(MissingInputError):
        V.read_version(spark, root, 7)


def test_a_pointer_that_is_not_put_in_place_changes_nothing(spark, months, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    V.replace_version(months, root)

    def dead(*_):
        raise RuntimeError("the driver died")

    with monkeypatch.context() as patch:
        patch.setattr(V._Files, "put", dead)
        with pytest.raises(RuntimeError):
            V.replace_version(months.filter("id < 3"), root)
    assert total(V.read_version(spark, root)) == 4950
    left = V.expire_versions(spark, root)
    assert len(left) == 1 and total(V.read_version(spark, root)) == 4950


def test_batches_are_replaced_alone(spark, months, tmp_path):
    root = str(tmp_path / "t")
    V.replace_version(months, root, "month", ["00", "01", "02", "03"])
    files = set(V.read_version(spark, root, batches=["00"]).inputFiles())
    V.replace_version(months.filter("month = '01' AND id < 50"), root, "month", ["01", "02"])
    now = V.read_version(spark, root)
    assert sorted(r["month"] for r in now.select("month").distinct().collect()) == ["00", "01", "03"]
    assert total(now.filter("month = '01'")) == sum(i for i in range(50) if i % 4 == 1)
    assert set(V.read_version(spark, root, batches=["00"]).inputFiles()) == files
    assert V.read_version(spark, root, batches=["02", "none"]).collect() == []
    assert total(V.read_version(spark, root, 0)) == 4950
    with pytest.raises(PySparkException, match="no given batch"):
        V.replace_version(months, root, "month", ["01"])
    with pytest.raises(ValueError):
        V.replace_version(months, root, "month", ["a/b"])
    with pytest.raises(ValueError):
        V.replace_version(months.withColumn("more", F.lit(1)).filter("month = '01'"), root, "month", ["01"])
    with pytest.raises(ValueError):
        V.replace_version(months.withColumnRenamed("month", "m"), root, "m", ["01"])


def test_a_filter_on_the_batch_opens_its_files_only(spark, months, tmp_path, plan):
    root = str(tmp_path / "t")
    V.replace_version(months, root, "month", ["00", "01", "02", "03"])
    text = plan(V.read_version(spark, root).filter("month = '02'").select("id"))
    assert "PartitionFilters: [isnotnull(month" in text
    assert all("/month=02/" in name for name in V.read_version(spark, root, batches=["02"]).inputFiles())


def test_of_two_jobs_at_once_one_fails(spark, months, tmp_path):
    root = str(tmp_path / "t")
    V.replace_version(months, root)
    outcome, waiting = [], threading.Barrier(2)
    put = V._Files.put

    def together(self, name, text):
        waiting.wait(60)
        put(self, name, text)

    def job(rows):
        try:
            V.replace_version(rows, root)
            outcome.append(total(rows))
        except ConflictError:
            outcome.append("conflict")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(V._Files, "put", together)
        jobs = [threading.Thread(target=job, args=(months.filter(f"id < {n}"),)) for n in (5, 9)]
        for one in jobs:
            one.start()
        for one in jobs:
            one.join()
    assert outcome.count("conflict") == 1 and V.versions(spark, root) == [0, 1]
    assert total(V.read_version(spark, root)) in outcome


def test_old_versions_and_left_over_data_go_on_request(spark, months, tmp_path):
    root = str(tmp_path / "t")
    V.replace_version(months, root, "month", ["00", "01", "02", "03"])
    V.replace_version(months.filter("month = '01'"), root, "month", ["01"])
    with pytest.raises(PySparkException):
        V.replace_version(dies(months.filter("month = '01'")), root, "month", ["01"])
    with pytest.raises(ValueError):
        V.expire_versions(spark, root, 0)
    assert len(V.expire_versions(spark, root, keep=2)) == 1  # what the dead job left
    assert total(V.read_version(spark, root, 0)) == 4950
    removed = V.expire_versions(spark, root)
    assert [name.split("/")[1] for name in removed] == ["month=01"]
    assert V.versions(spark, root) == [1] and total(V.read_version(spark, root)) == 4950
    assert not [p for p in Path(root, "versions").iterdir() if "draft" in p.name]


def test_no_rows_and_no_batches(spark, months, tmp_path):
    root = str(tmp_path / "t")
    V.replace_version(months.filter("false"), root, "month", ["00"])
    assert V.read_version(spark, root).collect() == []
    assert V.read_version(spark, root).columns == ["id", "month"]
    other = str(tmp_path / "u")
    V.replace_version(months.filter("false"), other)
    assert V.read_version(spark, other).schema.names == ["id", "month"]
    with pytest.raises(ValueError):
        V.replace_version(months.withColumnRenamed("id", V.WRITE), other)


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    months = X.raw_months(spark, sf_dir)
    for fk, dim, pk in (("payment_type", D.dim_payment_type(spark), "payment_type_id"), ("RatecodeID", D.dim_rate_code(spark), "rate_code_id")):
        months = [Q.fk_accepted(month, fk, dim, pk) for month in months]
    return X.write_raw_months(months, str(tmp_path_factory.mktemp("raw")))


def test_a_versioned_warehouse_survives_a_bad_month(spark, raw, tmp_path):
    lake, root = str(tmp_path / "lake"), str(tmp_path / "wh")

    def load(paths):
        names = [parquet.base_name(path) for path in paths]
        return run_etl(
            spark, paths, lake, batch_column="batch", versioned=True,
            warehouse=lambda fact: warehouse.write_fact(fact, root, "overwrite", "batch", names, versioned=True),
        )

    rows = load(raw)
    fact = warehouse.read_table(spark, root, warehouse.FACT)
    assert fact.count() == rows and fact.select("trip_id").distinct().count() == rows
    again = load(raw[1:2])
    fact = warehouse.read_table(spark, root, warehouse.FACT)
    assert fact.count() == rows and fact.select("trip_id").distinct().count() == rows
    assert fact.filter(F.col("batch") == parquet.base_name(raw[1])).count() == again
    orphan = to_warehouse(clean_trips(standardize(spark.read.parquet(raw[0])))).withColumns(
        {"payment_type_id": F.lit(99), "batch": F.lit(parquet.base_name(raw[0]))}
    )
    with pytest.raises(ConstraintError):
        warehouse.write_fact(orphan, root, "overwrite", "batch", [parquet.base_name(raw[0])], versioned=True)
    assert warehouse.read_table(spark, root, warehouse.FACT).count() == rows
    with pytest.raises(ValueError):
        warehouse.write_fact(orphan, root, "append", versioned=True)


def test_a_versioned_fact_is_replaced_whole(spark, sf_dir, tmp_path):
    trips = clean(spark, sf_dir).filter("trip_id < 300").select("trip_id", "payment_type_id", "rate_code_id")
    known = Q.fk_accepted(trips, "payment_type_id", D.dim_payment_type(spark), "payment_type_id")
    known = Q.fk_accepted(known, "rate_code_id", D.dim_rate_code(spark), "rate_code_id")
    root = str(tmp_path / "wh")
    for rows in (known.filter("trip_id < 99"), known):
        warehouse.write_fact(rows.drop("trip_id"), root, "overwrite", versioned=True)
        assert warehouse.read_table(spark, root, warehouse.FACT).count() == rows.count()
