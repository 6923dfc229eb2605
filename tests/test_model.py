"""The regression against closed forms and Spark's own estimator."""

import math

import pytest
from pyspark.sql import functions as F

from tripmill.bindings.queries import TRIP_KEY, clean, standard
from tripmill.errors import MissingInputError, QualityError
from tripmill.operators import regression as R
from tripmill.plans.training import train_fare_model
from tripmill.sources.models import load_model


def points(spark, rows):
    return spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(rows)],
        "trip_id long, trip_distance double, total_amount double",
    )


def test_exact_line(spark):
    model = R.fit(points(spark, [(x, 2.5 * x + 3) for x in range(1, 20)])).first()
    assert (model["n"], model["r2"]) == (19, pytest.approx(1.0))
    assert (model["coef"], model["intercept"]) == (pytest.approx(2.5), pytest.approx(3.0))


def test_feature_without_spread_gives_the_mean(spark):
    model = R.fit(points(spark, [(2, 1), (2, 3), (2, 8)])).first()
    assert (model["coef"], model["intercept"], model["r2"]) == (0.0, 4.0, None)


def test_fit_of_nothing(spark):
    model = R.fit(points(spark, [])).first()
    assert (model["coef"], model["intercept"], model["n"]) == (None, None, 0)


def test_same_as_the_ml_library(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df = standard(spark, sf_dir)
    features = VectorAssembler(inputCols=["trip_distance"], outputCol="f").transform(df)
    theirs = LinearRegression(featuresCol="f", labelCol="total_amount", solver="normal").fit(features)
    ours = R.fit(df).first()
    assert ours["coef"] == pytest.approx(theirs.coefficients[0], rel=1e-9)
    assert ours["intercept"] == pytest.approx(theirs.intercept, rel=1e-9)
    assert ours["r2"] == pytest.approx(theirs.summary.r2, rel=1e-9)


def test_one_pass_equals_split_fit_predict_score(spark, sf_dir):
    df = standard(spark, sf_dir)
    train, test = R.split(df, TRIP_KEY)
    model = R.fit(train)
    steps = R.gate(R.rmse(R.predict(test, model))).first()
    at_once = R.fit_and_score(df, TRIP_KEY).first()
    assert at_once["rmse"] == pytest.approx(steps["rmse"], rel=1e-9)
    assert at_once["coef"] == pytest.approx(model.first()["coef"], rel=1e-12)
    assert (at_once["n_test"], at_once["passed"]) == (steps["n"], steps["passed"])


def test_one_pass_score_of_an_exact_line_is_zero(spark):
    model = R.fit_and_score(points(spark, [(x, 2 * x + 1) for x in range(1, 90)]), TRIP_KEY).first()
    assert model["rmse"] == pytest.approx(0.0, abs=1e-6) and model["passed"]


def test_no_test_rows_give_no_score(spark):
    model = R.fit_and_score(points(spark, [(1, 1), (2, 2)]), TRIP_KEY, test_fraction=1e-9).first()
    assert (model["n_test"], model["rmse"], model["passed"]) == (0, None, None)


def test_split_is_stable_and_complete(spark, sf_dir):
    df = standard(spark, sf_dir)
    train, test = R.split(df, TRIP_KEY)
    again, _ = R.split(df.repartition(5, "total_amount"), TRIP_KEY)
    assert train.count() + test.count() == df.count()
    assert train.select("trip_id").exceptAll(again.select("trip_id")).isEmpty()


def test_curve_goes_beyond_the_data(spark):
    model = R.fit(points(spark, [(1, 3), (2, 5)]))
    curve = [tuple(r) for r in R.regression_curve(model).orderBy("x").collect()]
    assert len(curve) == 100 and curve[0] == (0.0, 1.0)
    assert curve[-1] == (25.0, pytest.approx(51.0))


def test_single_price_and_explanation(spark):
    model = R.fit(points(spark, [(1, 3), (2, 5)]))
    assert R.predict_one(model, 2.5).first()["price"] == pytest.approx(6.0)
    assert R.explain_model(model).first()["formula"] == "2.00 x distance + 1.00"


def test_pipeline_validates_first(spark, tmp_path):
    path = str(tmp_path / "model")
    bad = points(spark, [(1, 1), (2, 2)]).withColumn(
        "total_amount", F.when(F.col("trip_id") > 0, F.col("total_amount"))
    )
    with pytest.raises(QualityError, match="not_null:total_amount"):
        train_fare_model(bad, path, key=TRIP_KEY)
    with pytest.raises(QualityError, match="not_empty"):
        train_fare_model(points(spark, []), path, key=TRIP_KEY)
    with pytest.raises(QualityError, match="present:total_amount"):
        train_fare_model(points(spark, [(1, 1)]).drop("total_amount"), path, key=TRIP_KEY)
    with pytest.raises(QualityError, match="numeric:total_amount"):
        text = points(spark, [(1, 1)]).withColumn("total_amount", F.lit("1"))
        train_fare_model(text, path, key=TRIP_KEY)
    with pytest.raises(MissingInputError, match="train one first"):
        load_model(spark, path)


def test_failed_gate_still_stores_the_model(spark, sf_dir, tmp_path):
    path = str(tmp_path / "model")
    model = train_fare_model(clean(spark, sf_dir), path, key=TRIP_KEY, threshold=3.0, method="md5").first()
    stored = load_model(spark, path).first()
    assert not model["passed"] and stored == model
    assert math.isclose(stored["rmse"], 3.184546, abs_tol=1e-6)
