"""Rejects with reasons, dense keys, landing again, catalog tables, ML pipeline, readable bins."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripmill.bindings import fixture as X
from tripmill.bindings.queries import TRIP_KEY, clean, standard
from tripmill.errors import MissingInputError, QualityError
from tripmill.operators import aggregate as A
from tripmill.operators import judge as J
from tripmill.operators import ml
from tripmill.operators import regression as R
from tripmill.operators.star import to_warehouse
from tripmill.operators.clean import clean_trips
from tripmill.operators.standardize import standardize
from tripmill.schema import FACT_TRIPS
from tripmill.sources import catalog, landing, numbering, parquet
from tripmill.sources import dimensions as D

# --- judged rows

ROWS = [
    (1, 1.0, 5.0, 1.0, "N", 1), (2, 0.0, 5.0, 1.0, "N", 1), (3, None, -1.0, 0.0, "too long", 99), (4, 1.0, 0.0, 2.0, None, None),
    (5, float("nan"), 1.0, 1.0, "N", 2), (6, 1.0, None, 1.0, "N", 99),
]


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(
        ROWS, "id int, trip_distance double, total_amount double, passenger_count double, flag string, payment int"
    )


@pytest.fixture(scope="module")
def labelled(spark, trips):
    dim = D.dim_payment_type(spark)
    return J.label_rows(trips, J.trip_rules({"flag": 5}), [("fk", "payment", dim.unionByName(dim), "payment_type_id")])


def test_every_broken_rule_is_named(labelled, trips):
    got = {r["id"]: r["broken"] for r in labelled.collect()}
    assert got == {
        1: [], 2: ["distance"], 3: ["distance", "amount", "passengers", "length:flag", "fk"], 4: [], 5: [], 6: ["amount", "fk"],
    }
    assert labelled.columns == [*trips.columns, "broken"]
    assert J.label_rows(trips, {}).select("broken").distinct().collect() == [([],)]


def test_rows_are_written_apart_and_counted_by_the_write(spark, labelled, tmp_path, plan):
    path = str(tmp_path / "t")
    report = J.write_judged(labelled, path, ["distance", "fk", "never"])
    assert [tuple(r) for r in report.collect()] == [("distance", 2), ("fk", 2), ("never", 0), ("accepted", 3), ("rejected", 3)]
    assert sorted(r["id"] for r in J.read_accepted(spark, path).collect()) == [1, 4, 5]
    rejected = J.read_rejected(spark, path)
    assert {r["id"]: len(r["broken"]) for r in rejected.collect()} == {2: 1, 3: 5, 6: 2}
    assert all("accepted=false" in name for name in rejected.inputFiles())
    assert "accepted" not in J.read_accepted(spark, path).columns


def test_labelling_shuffles_no_fact_rows(labelled, plan):
    text = plan(labelled)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_no_rows_are_no_rejects(spark, labelled, tmp_path):
    report = J.write_judged(labelled.filter("false"), str(tmp_path / "t"), ["fk"])
    assert [r["rows"] for r in report.collect()] == [0, 0, 0]
    assert J.read_accepted(spark, str(tmp_path / "t")).collect() == []


# --- dense keys


@pytest.mark.parametrize("start", [0, 1000])
def test_keys_are_dense_and_in_order(spark, start):
    chance = random.Random(1)
    rows = [(chance.choice([None, *range(50)]), chance.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a int, b double").repartition(9)
    got = numbering.with_dense_key(df, ["a", F.desc("b")], "k", start)
    assert got.columns == ["k", "a", "b"]
    found = [(r["k"], r["a"], r["b"]) for r in got.orderBy("k").collect()]
    assert [k for k, _, _ in found] == list(range(start, start + 3000))
    assert [(a, b) for _, a, b in found] == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))


def test_a_hot_order_value_is_dealt_to_many_ranges(spark, monkeypatch):
    paths, write = [], numbering.write_lake
    monkeypatch.setattr(numbering, "write_lake", lambda df, path: paths.append(path) or write(df, path))
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("a"), F.lit("x").alias("c"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbering.with_dense_key(df, ["a"], "k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["k"] for r in got.select("k").orderBy("k").collect()] == list(range(40_000))
    ranges = spark.read.parquet(paths[0]).groupBy(F.shiftright("__id", 33)).count()
    assert ranges.agg(F.max("count")).first()[0] < 13_000


def test_no_rows_get_no_key(spark):
    assert numbering.with_dense_key(spark.range(0), ["id"], "k").collect() == []


def test_no_window_over_all_rows(spark, plan):
    text = plan(numbering.with_dense_key(spark.range(1000), ["id"], "k"))
    assert "SinglePartition" in text  # of the sizes
    window = text[text.index("Window") :]
    assert "Aggregate" in window and text.count("Window [") + text.count(") Window") <= 3


# --- landing again


def actions(status):
    return {r["file"]: (r["action"], r["rows"]) for r in status.collect()}


def test_only_new_and_changed_files_are_copied(spark, tmp_path, monkeypatch):
    paths = [str(tmp_path / f"in/{name}.parquet") for name in "abc"]
    for n, path in enumerate(paths[:2], 1):
        spark.range(n * 10).write.parquet(path)
    target = str(tmp_path / "raw")
    copied = []
    land = landing.land_file
    monkeypatch.setattr(landing, "land_file", lambda s, source, t: copied.append(source) or land(s, source, t))
    first = actions(landing.land_new(spark, paths, target))
    assert first["a.parquet"] == ("landed", 10) and first["b.parquet"] == ("landed", 20) and first["c.parquet"] == ("failed", None)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "raw").rglob("part-*")}
    assert actions(landing.land_new(spark, paths[:2], target)) == {"a.parquet": ("skipped", 10), "b.parquet": ("skipped", 20)}
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "raw").rglob("part-*")} == before
    spark.range(7).write.mode("overwrite").parquet(paths[0])
    spark.range(5).write.parquet(paths[2])
    third = actions(landing.land_new(spark, paths, target))
    assert third == {"a.parquet": ("landed", 7), "b.parquet": ("skipped", 20), "c.parquet": ("landed", 5)}
    assert sorted(copied) == sorted([*paths[:2], paths[0], paths[2]])
    assert [parquet.row_count(spark, f"{target}/{name}.parquet") for name in "abc"] == [7, 20, 5]


def test_a_broken_file_is_tried_again(spark, tmp_path):
    path = tmp_path / "in/x.parquet"
    path.parent.mkdir()
    path.write_bytes(b"no parquet")
    target = str(tmp_path / "raw")
    assert actions(landing.land_new(spark, [str(path)], target)) == {"x.parquet": ("failed", None)}
    assert actions(landing.land_new(spark, [str(path)], target)) == {"x.parquet": ("failed", None)}
    path.unlink()
    spark.range(3).coalesce(1).write.parquet(str(path))
    assert actions(landing.land_new(spark, [str(path)], target)) == {"x.parquet": ("landed", 3)}
    with pytest.raises(ValueError):
        landing.land_new(spark, ["a/x.parquet", "b/x.parquet"], target)


# --- catalog


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{tmp_path.name}".replace("-", "_")
    catalog.create_star_schema(spark, name, str(tmp_path / "db"))
    yield name
    catalog.drop_star_schema(spark, name)


def test_tables_are_declared_with_their_types(spark, database):
    columns = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {database}.fact_trips").collect()}
    assert list(columns) == FACT_TRIPS.names
    assert columns["store_and_fwd_flag"] == "varchar(5)" and columns["trip_id"] == "bigint"
    assert spark.conf.get("spark.sql.catalogImplementation") == "in-memory"
    for _ in range(2):  # seeds are not doubled by a second run
        catalog.create_star_schema(spark, database, "unused")
        rows = spark.table(f"{database}.dim_payment_type").collect()
        assert sorted(map(tuple, rows)) == sorted(D.PAYMENT_TYPES)


def test_inserts_are_checked_and_panels_follow(spark, sf_dir, database):
    fact = to_warehouse(clean_trips(standardize(X.raw_trips(spark, sf_dir)))).filter("trip_id < 500")
    catalog.insert_fact(fact, database)
    assert catalog.panel(spark, database, "kpi").first()["total_trips"] == fact.count()
    with pytest.raises(PySparkException, match="LENGTH"):
        catalog.insert_fact(fact.withColumn("store_and_fwd_flag", F.lit("too long")), database)
    catalog.insert_fact(fact.limit(7), database, overwrite=True)
    assert catalog.panel(spark, database, "kpi").first()["total_trips"] == 7
    assert sum(r["counts"] for r in catalog.panel(spark, database, "amount_histogram").collect()) <= 7
    with pytest.raises(ValueError):
        catalog.panel(spark, "a b", "kpi")


# --- ML pipeline


def test_pipeline_is_the_line(spark, sf_dir, tmp_path):
    train, test = R.split(standard(spark, sf_dir), TRIP_KEY)
    model = ml.fit_pipeline(train)
    line = R.fit(train).first()
    path = str(tmp_path / "model")
    ml.save_pipeline(model, path)
    ml.save_pipeline(model, path)  # again, over the old one
    row = ml.as_row(spark, ml.load_pipeline(path), ml.rmse(model, test)).first()
    assert math.isclose(row["coef"], line["coef"], rel_tol=1e-9) and math.isclose(row["intercept"], line["intercept"], rel_tol=1e-8)
    error = R.rmse(R.predict(test, R.fit(train))).first()["rmse"]
    assert math.isclose(row["rmse"], error, rel_tol=1e-9) and row["passed"]
    curve = R.regression_curve(ml.as_row(spark, model, error))
    assert curve.count() == 100


def test_pipeline_of_nothing_and_no_pipeline(spark, sf_dir, tmp_path):
    with pytest.raises(QualityError):
        ml.fit_pipeline(clean(spark, sf_dir).filter("false"))
    with pytest.raises(MissingInputError):
        ml.load_pipeline(str(tmp_path / "none"))


# --- readable bins


@pytest.mark.parametrize("low, high, most, width", [
    (0.0, 200.0, 50, 5.0), (0.0, 199.0, 50, 5.0), (0.0, 1.0, 20, 0.1), (3.0, 7.0, 4, 2.0), (-7.5, 7.5, 3, 10.0), (0.0, 0.07, 10, 0.01),
    (1e6, 9e6, 9, 1e6), (5.0, 5.0, 50, 1.0), (0.0, 100.0, 1, 200.0), (1.0, 1e9, 50, 5e7),
])
def test_widths_are_1_2_or_5_and_bins_few_enough(spark, low, high, most, width):
    df = spark.createDataFrame([(low,), (high,), ((low + high) / 2,), (None,), (float("nan"),)], "v double")
    bins = A.nice_histogram(df, "v", most).collect()
    assert len(bins) <= most and sum(r["counts"] for r in bins) == 3
    assert math.isclose(bins[0]["bin_high"] - bins[0]["bin_low"], width, rel_tol=1e-9)
    assert bins[0]["bin_low"] <= low and bins[-1]["bin_high"] > high and [r["bin"] for r in bins] == list(range(len(bins)))


def test_bins_of_nothing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert A.nice_histogram(df, "v").collect() == []
    with pytest.raises(ValueError):
        A.nice_histogram(df, "v", 0)
