"""Drifting files: names, types, missing columns, values that do not convert."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.errors import MissingInputError
from tripmill.operators.standardize import standardize, union_by_name
from tripmill.operators.star import to_warehouse, with_surrogate_key
from tripmill.schema import FACT_TRIPS, TRIP_CASTS
from tripmill.sources import parquet

NAN = float("nan")


def month(spark, **columns):
    """A one-row file with the columns given as name -> (type, value)."""
    schema = T.StructType([T.StructField(name, kind) for name, (kind, _) in columns.items()])
    return spark.createDataFrame([tuple(value for _, value in columns.values())], schema)


def test_types_and_spelling(spark):
    df = month(
        spark,
        vendorid=(T.IntegerType(), 2),
        PASSENGER_COUNT=(T.LongType(), 3),
        Airport_fee=(T.FloatType(), 1.25),
        store_and_fwd_flag=(T.StringType(), "N"),
    )
    out = standardize(df)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [
        ("VendorID", T.LongType()),
        ("passenger_count", T.DoubleType()),
        ("airport_fee", T.DoubleType()),
        ("store_and_fwd_flag", T.StringType()),
    ]
    assert tuple(out.first()) == (2, 3.0, 1.25, "N")


@pytest.mark.parametrize("name", ["airport_fee", "Airport_fee", "AIRPORT_FEE"])
def test_any_spelling_of_the_fee_keeps_its_data(spark, name):
    assert standardize(month(spark, **{name: (T.DoubleType(), 2.5)})).first()["airport_fee"] == 2.5


def test_absent_fee_is_zero_and_null_fee_stays_null(spark):
    absent = standardize(month(spark, VendorID=(T.LongType(), 1)))
    null = standardize(month(spark, airport_fee=(T.DoubleType(), None)))
    assert absent.first()["airport_fee"] == 0.0
    assert absent.schema["airport_fee"].dataType == T.DoubleType()
    assert null.first()["airport_fee"] is None


def test_texts_that_are_no_numbers_become_null(spark):
    df = month(spark, tip_amount=(T.StringType(), "n/a"), VendorID=(T.DoubleType(), 1e30))
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    row = standardize(df).first()
    assert (row["tip_amount"], row["VendorID"]) == (None, None)


def test_columns_that_differ_by_case_are_an_error(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        df = spark.range(1).select(F.lit(1.0).alias("extra"), F.lit(2.0).alias("Extra"))
        with pytest.raises(ValueError, match="extra"):
            standardize(df)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_other_casts_are_parameters(spark):
    df = spark.createDataFrame([("7", "x")], "CODE string, b string")
    out = standardize(df, casts={"code": T.IntegerType()}, defaults={"c": 1})
    assert out.columns == ["code", "b", "c"] and tuple(out.first()) == (7, "x", 1)


def test_union_matches_names_and_keeps_duplicates(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a")], "x long, y string")
    right = spark.createDataFrame([("a", 1)], "y string, x long")
    assert [tuple(r) for r in union_by_name([left, right]).collect()] == [(1, "a")] * 3


def test_union_of_a_missing_column(spark):
    left = spark.createDataFrame([(1, "a")], "x long, y string")
    right = spark.createDataFrame([(2,)], "x long")
    with pytest.raises(AnalysisException):
        union_by_name([left, right])
    both = union_by_name([left, right], allow_missing=True)
    assert {tuple(r) for r in both.collect()} == {(1, "a"), (2, None)}


def drifting_files(spark, root):
    base = {name: (kind, 1) for name, kind in TRIP_CASTS.items() if name != "airport_fee"}
    base = {n: (k, 1.0 if k == T.DoubleType() else 1) for n, (k, _) in base.items()}
    files = {
        "m1.parquet": {**base, "airport_fee": (T.DoubleType(), 1.0)},
        "m2.parquet": {
            "Airport_fee": (T.DoubleType(), 2.0),
            **base,
            "passenger_count": (T.LongType(), 1),
            "VendorID": (T.IntegerType(), 1),
        },
        "m3.parquet": base,
        "m4.parquet": {**base, "airport_fee": (T.DoubleType(), 4.0)},
    }
    for name, columns in files.items():
        month(spark, **columns).write.parquet(f"{root}/{name}")
    return [f"{root}/{name}" for name in files]


def test_months_are_read_by_one_scan_per_schema(spark, tmp_path, plan):
    paths = drifting_files(spark, str(tmp_path))
    df = parquet.read_months(spark, paths)
    assert sorted(row["airport_fee"] for row in df.collect()) == [0.0, 1.0, 2.0, 4.0]
    assert plan(df).count("Scan parquet") == 2 * 3  # in the tree and in the details


def test_months_with_their_file_name(spark, tmp_path):
    paths = drifting_files(spark, str(tmp_path))
    df = parquet.read_months(spark, paths, batch_column="batch")
    assert {(r["batch"], r["airport_fee"]) for r in df.collect()} == {
        ("m1.parquet", 1.0), ("m2.parquet", 2.0), ("m3.parquet", 0.0), ("m4.parquet", 4.0),
    }


def test_months_of_one_name_are_refused_as_batches(spark, tmp_path):
    paths = drifting_files(spark, str(tmp_path))
    with pytest.raises(ValueError, match="same name"):
        parquet.read_months(spark, [paths[0], paths[0]], batch_column="batch")


def test_a_month_without_a_required_column_stops_the_union(spark, tmp_path):
    paths = drifting_files(spark, str(tmp_path))
    spark.read.parquet(paths[0]).drop("tip_amount").write.parquet(f"{tmp_path}/m5.parquet")
    with pytest.raises(AnalysisException):
        parquet.read_months(spark, [*paths, f"{tmp_path}/m5.parquet"])


def test_missing_inputs(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for path in (str(tmp_path / "nothing"), str(tmp_path / "empty")):
        with pytest.raises(MissingInputError):
            parquet.read_file(spark, path)
        with pytest.raises(MissingInputError):
            parquet.read_parts(spark, path)
    with pytest.raises(MissingInputError):
        parquet.read_months(spark, [])


def test_only_part_files_are_read(spark, tmp_path):
    path = str(tmp_path / "out")
    spark.range(5).write.parquet(path)
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "other"))
    stray = next((tmp_path / "other").glob("part-*.parquet"))
    (tmp_path / "out" / "stray.parquet").write_bytes(stray.read_bytes())
    assert parquet.read_parts(spark, path).count() == 5


def warehouse_row(spark, **values):
    columns = {
        "VendorID": (T.LongType(), 1),
        "RatecodeID": (T.DoubleType(), 1.0),
        "PULocationID": (T.LongType(), 1),
        "DOLocationID": (T.LongType(), 1),
        "payment_type": (T.LongType(), 1),
    }
    taken = {"vendor_id", "rate_code_id", "pulocationid", "dolocationid", "payment_type_id", "trip_id"}
    for field in FACT_TRIPS.fields:
        if field.name not in taken:
            kind = T.DoubleType() if field.name == "passenger_count" else field.dataType
            columns[field.name] = (kind, None)
    for name, value in values.items():
        columns[name] = (columns[name][0], value)
    return month(spark, **columns)


def test_warehouse_names_types_and_order(spark):
    out = to_warehouse(warehouse_row(spark))
    assert [(f.name, f.dataType) for f in out.schema.fields] == [
        (f.name, f.dataType) for f in FACT_TRIPS.fields if f.name != "trip_id"
    ]


@pytest.mark.parametrize("value,stored", [(1.5, 2), (2.5, 2), (0.4, 0), (3.0, 3), (None, None)])
def test_integers_are_rounded_like_the_database_does(spark, value, stored):
    row = to_warehouse(warehouse_row(spark, passenger_count=value)).first()
    assert row["passenger_count"] == stored


def test_integer_overflow_is_an_error(spark):
    with pytest.raises(Exception, match="OVERFLOW"):
        to_warehouse(warehouse_row(spark, PULocationID=2**40)).collect()


def test_missing_warehouse_column_is_an_error(spark):
    with pytest.raises(ValueError, match="tip_amount"):
        to_warehouse(warehouse_row(spark).drop("tip_amount"))


def test_surrogate_key_is_unique_across_partitions(spark):
    keyed = with_surrogate_key(spark.range(1000, numPartitions=7), "key", start=10)
    keys = [row["key"] for row in keyed.collect()]
    assert len(set(keys)) == 1000 and min(keys) == 10


def test_whole_numbers_written_as_decimals(spark):
    rows = [("1.0", "2.0", "263.0"), ("n/a", "", "7"), ("-3.9", " 4 ", "9007199254740993.0")]
    df = spark.createDataFrame(rows, "VendorID string, payment_type string, PULocationID string")
    got = standardize(df).select("VendorID", "payment_type", "PULocationID").collect()
    assert [tuple(r) for r in got] == [
        (1, 2, 263), (None, None, 7), (-3, 4, 9007199254740993),
    ]
