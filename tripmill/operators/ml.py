"""The fare model as a pipeline of Spark's ML library, in that library's format."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession

from tripmill.errors import MissingInputError, QualityError

FEATURES = "features"


def fit_pipeline(df: DataFrame, x: str = "trip_distance", y: str = "total_amount") -> PipelineModel:
    """Least squares by the normal equations: one pass, whose sums alone are brought
    together. Without regularisation it is the line of
    :func:`tripmill.operators.regression.fit`. Rows with NULL or NaN in ``x`` are an error
    of Spark's, no rows are one of ours."""
    if df.isEmpty():
        raise QualityError("not_empty does not hold")
    assemble = VectorAssembler(inputCols=[x], outputCol=FEATURES, handleInvalid="error")
    line = LinearRegression(
        featuresCol=FEATURES, labelCol=y, predictionCol="prediction", solver="normal", regParam=0.0,
        fitIntercept=True, standardization=False,
    )
    return Pipeline(stages=[assemble, line]).fit(df.select(x, y))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """All columns, and ``prediction``."""
    return model.transform(df).drop(FEATURES)


def rmse(model: PipelineModel, df: DataFrame, y: str = "total_amount") -> float:
    return RegressionEvaluator(labelCol=y, predictionCol="prediction", metricName="rmse").evaluate(score(model, df))


def as_row(spark: SparkSession, model: PipelineModel, error: float, threshold: float = 10.0) -> DataFrame:
    """The model as the one-row table other steps take: coef, intercept, rmse, passed."""
    line = model.stages[-1]
    row = (float(line.coefficients[0]), float(line.intercept), float(error), bool(error < threshold))
    return spark.createDataFrame([row], "coef double, intercept double, rmse double, passed boolean")


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as error:
        if "does not exist" in str(error) or "PATH_NOT_FOUND" in str(error) or "InvalidInput" in str(error):
            raise MissingInputError(f"no model at {path}: train one first") from error
        raise
