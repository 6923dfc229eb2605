"""Validate, trim, split, fit, score and store the fare model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripmill.errors import QualityError
from tripmill.functions import keys as K
from tripmill.functions import predicates as P
from tripmill.operators import quality as Q
from tripmill.operators import regression as R
from tripmill.sources.models import save_model

# What tells trips apart in the lake, where they have no key of their own. Trips
# equal in all of it fall on the same side. Two of the columns are read anyway.
LAKE_KEY = ("tpep_pickup_datetime", "PULocationID", "trip_distance", "total_amount")


def train_fare_model(
    trips: DataFrame,
    path: str | None = None,
    key: Sequence[str] = LAKE_KEY,
    x: str = "trip_distance",
    y: str = "total_amount",
    test_fraction: float = 0.2,
    seed: int = 42,
    threshold: float = 10.0,
    method: str = "xxhash64",
) -> DataFrame:
    """Train on ``trips`` and store the model at ``path``. Eager.

    Raises QualityError on empty input, a missing or non-numeric column, NULL or
    NaN. An error above ``threshold`` only shows as ``passed = false``: the model
    is stored all the same. Returns its row: coef, intercept, n_train, n_test,
    rmse, passed.

    Validation, fit and score are aggregates of one pass over the trips; one row
    of moments reaches the driver.
    """
    required = [x, y]
    types = {field.name.lower(): field.dataType for field in trips.schema.fields}
    for name in required:  # known without a look at the data
        if name.lower() not in types:
            raise QualityError(f"present:{name} does not hold")
        if not isinstance(types[name.lower()], T.NumericType):
            raise QualityError(f"numeric:{name} does not hold")
    metrics = trips.agg(
        *Q.validation_metrics(trips, required),
        *R.split_moments(
            x, y, keep=P.standard_trip(x, y), test=K.in_fraction(key, test_fraction, seed, method)
        ),
    )
    row = trips.sparkSession.createDataFrame(metrics.collect(), metrics.schema)
    Q.require(Q.rules_as_rows(row, Q.validation_rules(trips, required)))
    model = R.model_of_moments(row, threshold)
    if path is not None:
        save_model(model, path)
    return model
