"""Validation rules and key constraints on hand-made rows."""

import pytest

from tripmill.errors import QualityError
from tripmill.operators import quality as Q
from tripmill.sources import dimensions as D

NAN = float("nan")
REQUIRED = ["trip_distance", "total_amount"]


def failing(report):
    return {r["rule"]: r["bad_rows"] for r in report.collect() if not r["ok"]}


@pytest.mark.parametrize(
    "rows,schema,expected",
    [
        ([(1.0, 2.0)], "trip_distance double, total_amount double", {}),
        ([(1, 2)], "trip_distance int, total_amount decimal(8,2)", {}),
        ([], "trip_distance double, total_amount double", {"not_empty": 0}),
        ([(1.0,)], "trip_distance double", {"present:total_amount": 1}),
        (
            [(None, 1.0), (NAN, 1.0), (1.0, None)],
            "trip_distance double, total_amount double",
            {"not_null:trip_distance": 2, "not_null:total_amount": 1},
        ),
        ([("1", 2.0)], "trip_distance string, total_amount double", {"numeric:trip_distance": 1}),
    ],
)
def test_rules(spark, rows, schema, expected):
    from decimal import Decimal

    if "decimal" in schema:
        rows = [(a, Decimal(b)) for a, b in rows]
    assert failing(Q.validate(spark.createDataFrame(rows, schema), REQUIRED)) == expected


def test_first_failing_rule_stops(spark):
    df = spark.createDataFrame([], "trip_distance double")
    with pytest.raises(QualityError, match="not_empty"):
        Q.require(Q.validate(df, REQUIRED))
    Q.require(Q.validate(spark.createDataFrame([(1.0, 2.0)], "trip_distance double, total_amount double"), REQUIRED))


def test_text_bounds(spark):
    df = spark.createDataFrame([("N",), ("toolong",), (None,)], "flag string")
    assert failing(Q.text_report(df, {"flag": 5})) == {"max_length:flag<=5": 1}


@pytest.fixture(scope="module")
def fact(spark):
    return spark.createDataFrame(
        [(1, 1), (2, 0), (3, None), (4, 9), (5, 9), (6, 6), (7, None)], "id int, payment_type_id int"
    )


def test_null_keys_pass_and_unknown_ones_do_not(spark, fact):
    dim = D.dim_payment_type(spark)
    args = (fact, "payment_type_id", dim, "payment_type_id")
    assert sorted(r["id"] for r in Q.fk_orphans(*args).collect()) == [4, 5]
    assert sorted(r["id"] for r in Q.fk_accepted(*args).collect()) == [1, 2, 3, 6, 7]
    assert tuple(Q.fk_report([("fk", *args)]).first()) == ("fk", False, 2)


def test_accepted_rows_do_not_multiply(spark, fact):
    dim = D.dim_payment_type(spark)
    twice = dim.unionByName(dim)
    assert Q.fk_accepted(fact, "payment_type_id", twice, "payment_type_id").count() == 5


def test_primary_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    assert [tuple(r) for r in Q.pk_duplicates(df, "a", "b").collect()] == [(1, 1, 2)]
    assert tuple(Q.pk_report(df, "a", "b").first()) == ("primary_key", False, 3)
    assert tuple(Q.pk_report(df.limit(0), "a").first()) == ("primary_key", True, 0)


def test_seeds(spark):
    for make, key, size in (
        (D.dim_payment_type, "payment_type_id", 7),
        (D.dim_rate_code, "rate_code_id", 8),
        (D.dim_vendor, "vendor_id", 2),
    ):
        dim = make(spark)
        assert dim.count() == size and Q.pk_report(dim, key).first()["ok"]
    assert dict(D.dim_payment_type(spark).collect())[6] == "Voided trip"
    assert dict(D.dim_rate_code(spark).collect())[99] == "Unknown"
    assert D.status_row(spark, "ok").collect() == [("ok",)]
