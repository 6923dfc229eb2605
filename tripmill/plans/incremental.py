"""Report tables and model of a growing fact, at the cost of what is new.

Of every batch (a month) a small state is kept: its partial panels, its own samples, its
moments. A batch that comes, or comes again, has its state worked out from its rows alone;
the results are merged from all states, exactly as if they had been made from all rows.
States and results are versioned tables: a refresh that dies leaves the results of the one
before, whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.errors import QualityError
from tripmill.functions import keys as K
from tripmill.functions import predicates as P
from tripmill.operators import quality as Q
from tripmill.operators import regression as R
from tripmill.operators import sample as S
from tripmill.plans import marts as M
from tripmill.plans.training import LAKE_KEY
from tripmill.sources.parquet import at_once
from tripmill.sources.versioned import read_version, replace_version

PANELS, SAMPLES, MOMENTS = "state/panels", "state/samples", "state/moments"


def _of(fact: DataFrame, batch_column: str, batches: Sequence[str]) -> DataFrame:
    """The batches' rows: a filter on the partition column, which reads no other files."""
    return fact.filter(F.col(batch_column).isin(list(batches)))


def refresh_panel_state(fact: DataFrame, root: str, batch_column: str, batches: Sequence[str]) -> DataFrame:
    """Replace the partial panels of these batches; returns those of all, a few hundred rows
    each."""
    path = f"{root.rstrip('/')}/{PANELS}"
    panels = M.trip_panels(_of(fact, batch_column, batches), batch=batch_column)
    # One file per batch is enough for so few rows.
    replace_version(panels.repartition(batch_column), path, batch_column, batches)
    return read_version(fact.sparkSession, path)


def refresh_sample_state(
    fact: DataFrame, root: str, batch_column: str, batches: Sequence[str],
    wanted: Sequence[tuple[int, object]], key: Sequence[str], columns: Sequence[str], method: str = "xxhash64",
) -> DataFrame:
    """Replace the samples kept of these batches; returns those of all. The state belongs to
    one choice of samples, key and hash."""
    path = f"{root.rstrip('/')}/{SAMPLES}"
    kept = S.batch_samples(_of(fact, batch_column, batches), batch_column, wanted, key, columns, method=method)
    replace_version(kept, path, batch_column, batches)
    return read_version(fact.sparkSession, path)


def refresh_marts(
    fact: DataFrame,
    root: str,
    batch_column: str,
    batches: Sequence[str],
    key: Sequence[str] = M.SAMPLE_KEY,
    method: str = "xxhash64",
) -> dict[str, str]:
    """Bring the report tables below ``root`` up to date after ``batches`` of the fact were
    written, replaced or emptied. Returns their paths, tables with versions. Eager.

    The tables are those of :func:`tripmill.plans.marts.build_marts` over all batches whose
    state is kept; of the fact only the given batches are read.
    """
    spark = fact.sparkSession
    base = root.rstrip("/")
    columns, wanted = M.SAMPLE_COLUMNS, M.mart_samples()
    names = ["trip_panels", "kpi", "hourly_counts", "payment_counts", "payment_labels", "amount_histogram", *wanted, "preview"]
    paths = {name: f"{base}/{name}" for name in names}

    def write(name: str, frame: DataFrame) -> DataFrame:
        replace_version(frame, paths[name])
        return read_version(spark, paths[name])

    def reports() -> None:
        partial_panels = refresh_panel_state(fact, base, batch_column, batches)
        panels = write("trip_panels", M.merge_panels(partial_panels))
        small = M.panel_reports(panels)
        at_once(*[partial(write, name, frame.coalesce(1)) for name, frame in small.items()])

    def samples() -> None:
        state = refresh_sample_state(
            fact, base, batch_column, batches, [(n, kept) for n, kept, _ in wanted.values()], key, columns, method
        )
        at_once(
            *[
                partial(write, name, S.merge_samples(state, n, kept, key, columns, taken, method=method))
                for name, (n, kept, taken) in wanted.items()
            ]
        )

    def preview() -> None:
        shown = _of(fact, batch_column, batches).take(M.PREVIEW_ROWS)
        if shown:
            write("preview", spark.createDataFrame(shown, fact.schema).coalesce(1))

    at_once(reports, samples, preview)
    return paths


def batch_moments(
    trips: DataFrame,
    batch_column: str,
    key: Sequence[str] = LAKE_KEY,
    x: str = "trip_distance",
    y: str = "total_amount",
    test_fraction: float = 0.2,
    seed: int = 42,
    method: str = "xxhash64",
) -> DataFrame:
    """Of every batch, in one pass, what validation counts and the moments of both sides."""
    return trips.groupBy(batch_column).agg(
        *Q.validation_metrics(trips, [x, y]),
        *R.split_moments(
            x, y, keep=P.standard_trip(x, y), test=K.in_fraction(key, test_fraction, seed, method)
        ),
    )


def refresh_model(
    trips: DataFrame,
    root: str,
    batch_column: str,
    batches: Sequence[str],
    key: Sequence[str] = LAKE_KEY,
    x: str = "trip_distance",
    y: str = "total_amount",
    test_fraction: float = 0.2,
    seed: int = 42,
    threshold: float = 10.0,
    method: str = "xxhash64",
) -> DataFrame:
    """Refit the fare model after ``batches`` of the trips were written, replaced or emptied:
    their moments are worked out anew, those of all batches merged, and the model is stored
    at ``root``/model. Returns its row, as
    :func:`tripmill.plans.training.train_fare_model` would over all batches. Eager.

    Raises QualityError, and leaves moments and model as they were, if the trips of the new
    batches break a rule; no batch with rows at all is an error as well.
    """
    spark = trips.sparkSession
    base = root.rstrip("/")
    fields = {field.name.lower(): field.dataType for field in trips.schema.fields}
    for name in (x, y):
        if not isinstance(fields.get(name.lower()), T.NumericType):
            raise QualityError(f"{'numeric' if name.lower() in fields else 'present'}:{name} does not hold")
    new = batch_moments(_of(trips, batch_column, batches), batch_column, key, x, y, test_fraction, seed, method)
    # A row per batch, which the call names one by one.
    fresh = spark.createDataFrame(new.collect(), new.schema)
    for row in fresh.select(batch_column, f"missing_{x}", f"missing_{y}").collect():
        for name in (x, y):
            if row[f"missing_{name}"]:
                raise QualityError(f"not_null:{name} does not hold ({row[f'missing_{name}']} rows of {row[0]})")
    path = f"{base}/{MOMENTS}"
    replace_version(fresh.coalesce(1), path, batch_column, batches)
    state = read_version(spark, path)
    model = R.model_of_moments(R.merge_moments(state), threshold)
    row = spark.createDataFrame(model.collect(), model.schema)
    if not row.filter("n_train > 0").take(1):
        raise QualityError("not_empty does not hold")
    replace_version(row.coalesce(1), f"{base}/model")
    return row


def current_model(spark: SparkSession, root: str) -> DataFrame:
    """The model that the last refresh stored."""
    return read_version(spark, f"{root.rstrip('/')}/model")
