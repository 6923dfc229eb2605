"""Known results over the derived trips at sf0.01."""

import pytest

from tripmill.bindings.queries import QUERIES


def rows(spark, sf_dir, name):
    return [tuple(row) for row in QUERIES[name](spark, sf_dir).collect()]


def test_cleaning(spark, sf_dir):
    assert rows(spark, sf_dir, "clean_counts") == [(10_000, 9_344, 9_030, 8_576)]


def test_kpi(spark, sf_dir):
    revenue, distance, trips = rows(spark, sf_dir, "kpi")[0]
    assert (round(revenue, 2), distance, trips) == (369_191.96, 14.503964, 8_576)


def test_hours(spark, sf_dir):
    hours = dict(rows(spark, sf_dir, "hourly_counts"))
    assert (len(hours), hours[0], hours[13], hours[23]) == (24, 341, 385, 335)


def test_payments(spark, sf_dir):
    counts = dict(rows(spark, sf_dir, "payment_counts"))
    assert counts == {
        0: 1196, 1: 1197, 2: 1204, 3: 1201, 4: 1199, 5: 1194, 6: 1202, 9: 87, None: 96,
    }
    assert dict(rows(spark, sf_dir, "payment_labels")) == {
        "Autre": 1385,
        "Cash": 1204,
        "Credit Card": 1197,
        "Dispute": 1199,
        "No Charge": 1201,
        "Unknown": 2390,
    }


def test_foreign_keys(spark, sf_dir):
    assert rows(spark, sf_dir, "fk_report") == [("fk_payment", False, 87), ("fk_rate", False, 83)]
    assert QUERIES["fk_accepted"](spark, sf_dir).count() == 8_407


def test_primary_keys(spark, sf_dir):
    assert QUERIES["pk_duplicates"](spark, sf_dir).count() == 11_785


def test_ranges(spark, sf_dir):
    assert QUERIES["range_closed"](spark, sf_dir).count() == 8_534
    assert QUERIES["range_open"](spark, sf_dir).count() == 8_004


def test_histogram(spark, sf_dir):
    bins = {row["bin"]: row["counts"] for row in QUERIES["amount_histogram"](spark, sf_dir).collect()}
    assert (len(bins), bins[0], bins[1], bins[49]) == (50, 511, 680, 181)


def test_model(spark, sf_dir):
    model = QUERIES["fit_and_score"](spark, sf_dir).first()
    assert (model["n_train"], model["n_test"]) == (6_431, 1_573)
    assert model["coef"] == pytest.approx(2.994696)
    assert model["intercept"] == pytest.approx(3.116685)
    assert model["rmse"] == pytest.approx(3.184546)
    assert model["passed"]


def test_enrichment(spark, sf_dir):
    assert QUERIES["enrich_counts"](spark, sf_dir).count() == 64
