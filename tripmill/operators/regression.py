"""One-feature least squares, its evaluation and its use.

A model is a one-row frame: coef, intercept and, from training, its metrics.
Moments are merged the numerically stable way by Spark's own regr_* aggregates,
so a fit over any number of rows is one partial and one final aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions import expressions as X
from tripmill.functions import keys as K


def split(
    df: DataFrame,
    key: Sequence[str],
    test_fraction: float = 0.2,
    seed: int = 42,
    method: str = "md5",
) -> tuple[DataFrame, DataFrame]:
    """(train, test), by hash of the key. The fraction holds on average."""
    test = K.in_fraction(key, test_fraction, seed, method)
    return df.filter(~test), df.filter(test)


def _moments(x: Column, y: Column, prefix: str) -> list[Column]:
    return [
        F.regr_count(y, x).alias(f"{prefix}_n"),
        F.regr_avgx(y, x).alias(f"{prefix}_avgx"),
        F.regr_avgy(y, x).alias(f"{prefix}_avgy"),
        F.regr_sxx(y, x).alias(f"{prefix}_sxx"),
        F.regr_sxy(y, x).alias(f"{prefix}_sxy"),
        F.regr_syy(y, x).alias(f"{prefix}_syy"),
    ]


def _slope(prefix: str) -> Column:
    """A feature without spread gets slope 0: the line is then the mean."""
    sxx, sxy = F.col(f"{prefix}_sxx"), F.col(f"{prefix}_sxy")
    return F.when(sxx > 0, sxy / sxx).when(sxx == 0, F.lit(0.0))


def _intercept(prefix: str, coef: Column) -> Column:
    return F.col(f"{prefix}_avgy") - coef * F.col(f"{prefix}_avgx")


def fit(df: DataFrame, x: str = "trip_distance", y: str = "total_amount") -> DataFrame:
    """The model of a frame: coef, intercept, n, r2. NULL coefficients if empty."""
    moments = df.agg(*_moments(F.col(x), F.col(y), "fit"))
    coef = _slope("fit")
    explained = F.col("fit_sxx") * F.col("fit_syy")
    return moments.select(
        coef.alias("coef"),
        _intercept("fit", coef).alias("intercept"),
        F.col("fit_n").alias("n"),
        F.when(explained > 0, F.col("fit_sxy") * F.col("fit_sxy") / explained).alias("r2"),
    )


def split_moments(x: str, y: str, keep: Column, test: Column) -> list[Column]:
    """Aggregates over the kept rows, for train and test side at once."""
    train_y = F.when(keep & ~test, F.col(y))
    test_y = F.when(keep & test, F.col(y))
    return [
        *_moments(F.col(x), train_y, "train"),
        *_moments(F.col(x), test_y, "test"),
    ]


MOMENTS = ("n", "avgx", "avgy", "sxx", "sxy", "syy")


def merge_moments(parts: DataFrame, prefixes: Sequence[str] = ("train", "test")) -> DataFrame:
    """One row of moments from those of disjoint parts of the rows, a row each.

    Squares are about each part's own mean; about the common mean they grow by the part's
    rows times the squared distance of the means (the pairwise formula, for any number of
    parts). Nothing large is subtracted from anything large. A part without rows counts
    for nothing.
    """
    centers = []
    for p in prefixes:
        n = F.sum(f"{p}_n")
        centers += [
            F.try_divide(F.sum(F.col(f"{p}_n") * F.col(f"{p}_avg{v}")), n).alias(f"{p}_avg{v}") for v in "xy"
        ]
    center = parts.agg(F.struct(*centers)).scalar()
    merged = []
    for p in prefixes:
        n = F.col(f"{p}_n")
        away = {v: F.col(f"{p}_avg{v}") - F.col(f"__center.{p}_avg{v}") for v in "xy"}
        merged.append(F.coalesce(F.sum(n), F.lit(0).cast("long")).alias(f"{p}_n"))
        merged += [F.first(f"__center.{p}_avg{v}").alias(f"{p}_avg{v}") for v in "xy"]
        merged += [
            F.sum(F.col(f"{p}_s{a}{b}") + n * away[a] * away[b]).alias(f"{p}_s{a}{b}") for a, b in ("xx", "xy", "yy")
        ]
    return parts.withColumn("__center", center).agg(*merged)


def model_of_moments(moments: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Model and test metrics of a row of :func:`split_moments`.

    The squared error of a line is a polynomial in the test side's moments, so
    train and test need one pass over the data together, not one each.
    """
    coef = _slope("train")
    lines = moments.select("*", coef.alias("coef"), _intercept("train", coef).alias("intercept"))
    bias = F.col("test_avgy") - F.col("intercept") - F.col("coef") * F.col("test_avgx")
    squares = (
        F.col("test_syy")
        - 2 * F.col("coef") * F.col("test_sxy")
        + F.col("coef") * F.col("coef") * F.col("test_sxx")
    )
    mean_square = F.when(
        F.col("test_n") > 0, F.greatest(squares, F.lit(0.0)) / F.col("test_n") + bias * bias
    )
    return lines.select(
        "coef",
        "intercept",
        F.col("train_n").alias("n_train"),
        F.col("test_n").alias("n_test"),
        F.sqrt(mean_square).alias("rmse"),
    ).withColumn("passed", F.col("rmse") < F.lit(threshold))


def fit_and_score(
    df: DataFrame,
    key: Sequence[str],
    x: str = "trip_distance",
    y: str = "total_amount",
    keep: Column | None = None,
    test_fraction: float = 0.2,
    seed: int = 42,
    threshold: float = 10.0,
    method: str = "md5",
) -> DataFrame:
    """Split, fit on train and score on test in one pass over the data:
    coef, intercept, n_train, n_test, rmse, passed."""
    kept = F.lit(True) if keep is None else keep
    test = K.in_fraction(key, test_fraction, seed, method)
    moments = df.agg(*split_moments(x, y, kept, test))
    return model_of_moments(moments, threshold)


def predict(
    df: DataFrame, model: DataFrame, x: str = "trip_distance", out: str = "prediction"
) -> DataFrame:
    """Add the model's value for every row. The model is a scalar subquery: it is
    computed once and the rows stay in one narrow stage."""
    scored = df.withColumn("__model", model.select(F.struct("coef", "intercept")).scalar())
    value = X.line(F.col(x), F.col("__model.coef"), F.col("__model.intercept"))
    return scored.withColumn(out, value).drop("__model")


def rmse(df: DataFrame, y: str = "total_amount", prediction: str = "prediction") -> DataFrame:
    """One row: rmse, n."""
    error = F.col(y) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count(error).alias("n"))


def gate(metrics: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Add whether the error is below the threshold. It does not stop the job."""
    return metrics.withColumn("passed", F.col("rmse") < F.lit(threshold))


def predict_one(model: DataFrame, distance: float) -> DataFrame:
    """The price of one trip: trip_distance, price."""
    price = X.line(F.lit(float(distance)), F.col("coef"), F.col("intercept"))
    return model.select(F.lit(float(distance)).alias("trip_distance"), price.alias("price"))


def regression_curve(
    model: DataFrame, low: float = 0.0, high: float = 25.0, points: int = 100
) -> DataFrame:
    """The line at evenly spaced distances, beyond the data too: x, y."""
    spark: SparkSession = model.sparkSession
    grid = spark.range(points).select(X.grid_point(F.col("id"), low, high, points).alias("x"))
    return predict(grid, model, x="x", out="y")


def explain_model(model: DataFrame) -> DataFrame:
    """The model in words: base_price, price_per_mile and the formula."""
    return model.select(
        F.col("intercept").alias("base_price"),
        F.col("coef").alias("price_per_mile"),
        F.format_string("%.2f x distance + %.2f", "coef", "intercept").alias("formula"),
    )
