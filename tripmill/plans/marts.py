"""The report tables of a fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import expressions as X
from tripmill.functions import predicates as P
from tripmill.operators import aggregate as A
from tripmill.operators import sample as S
from tripmill.sources.parquet import at_once, read_written, write_lake

# The report's histogram range, sample sizes and preview size.
AMOUNT_LOW = 0.0
AMOUNT_HIGH = 200.0
AMOUNT_BINS = 50
AMOUNT_SAMPLE = 100_000
SCATTER_SAMPLE = 10_000
PREVIEW_ROWS = 5

# Columns of a trip that rank it in the samples; the trips' generated key depends on how
# they were stored.
SAMPLE_KEY = ("tpep_pickup_datetime", "trip_distance", "total_amount")


def trip_panels(
    fact: DataFrame,
    ts: str = "tpep_pickup_datetime",
    payment: str = "payment_type_id",
    amount: str = "total_amount",
    distance: str = "trip_distance",
    batch: str | None = None,
) -> DataFrame:
    """What all aggregate panels need, in one pass over four columns of the fact.

    The grouping sets (hour), (payment code) and (amount bin) are separate rows,
    told apart by ``panel``: a task sends some 90 rows to the shuffle, where one
    group-by of the three together would send thousands. With ``batch`` there are rows of
    every batch, which :func:`merge_panels` adds up.
    """
    of_batch = [F.col(batch)] if batch else []
    narrow = fact.select(
        *of_batch,
        A.hour_of_day(ts).alias("hour"),
        F.col(payment).alias("payment_type_id"),
        X.bin_index(F.col(amount), AMOUNT_LOW, AMOUNT_HIGH, AMOUNT_BINS).alias("bin"),
        F.col(amount).alias("amount"),
        F.col(distance).alias("distance"),
    )
    hour, code, bin_ = F.col("hour"), F.col("payment_type_id"), F.col("bin")
    sets = [[*of_batch, hour], [*of_batch, code], [*of_batch, bin_]]
    return narrow.groupingSets(sets, *of_batch, hour, code, bin_).agg(
        F.when(F.grouping("hour") == 0, F.lit("hour"))
        .when(F.grouping("payment_type_id") == 0, F.lit("payment"))
        .otherwise(F.lit("bin"))
        .alias("panel"),
        F.count(F.lit(1)).alias("counts"),
        F.sum("amount").alias("amount_sum"),
        F.sum("distance").alias("distance_sum"),
        F.count("distance").alias("distance_counts"),
    )


def merge_panels(partial: DataFrame) -> DataFrame:
    """The panels of all batches, from the batches' own."""
    return partial.groupBy("hour", "payment_type_id", "bin", "panel").agg(
        *[F.sum(name).alias(name) for name in ("counts", "amount_sum", "distance_sum", "distance_counts")]
    )


def _panel(panels: DataFrame, name: str) -> DataFrame:
    return panels.filter(F.col("panel") == name)


def kpi_of_panels(panels: DataFrame) -> DataFrame:
    """The KPI row; the hours together are all trips."""
    return _panel(panels, "hour").agg(
        F.sum("amount_sum").alias("total_revenue"),
        F.try_divide(F.sum("distance_sum"), F.sum("distance_counts")).alias("avg_distance"),
        F.coalesce(F.sum("counts"), F.lit(0).cast("long")).alias("total_trips"),
    )


def hourly_of_panels(panels: DataFrame) -> DataFrame:
    return _panel(panels, "hour").select("hour", "counts").orderBy("hour")


def payment_of_panels(panels: DataFrame) -> DataFrame:
    return _panel(panels, "payment").select("payment_type_id", "counts")


def histogram_of_panels(panels: DataFrame) -> DataFrame:
    found = _panel(panels, "bin").filter(F.col("bin").isNotNull()).select("bin", "counts")
    return A.fill_bins(found, AMOUNT_LOW, AMOUNT_HIGH, AMOUNT_BINS)


def payment_labels(counts: DataFrame) -> DataFrame:
    """The pie: counts and share per chart label."""
    return A.share_of_total(A.roll_up(A.label_counts(counts)))


def sample_amounts(
    fact: DataFrame,
    key: Sequence[str],
    n: int = AMOUNT_SAMPLE,
    amount: str = "total_amount",
    method: str = "md5",
) -> DataFrame:
    """Random amounts within the histogram's range."""
    kept = fact.filter(P.within_closed(amount, AMOUNT_LOW, AMOUNT_HIGH))
    return S.sample_n(kept, n, key, [amount], method=method)


def sample_scatter(
    fact: DataFrame,
    key: Sequence[str],
    n: int = SCATTER_SAMPLE,
    distance: str = "trip_distance",
    amount: str = "total_amount",
    method: str = "md5",
) -> DataFrame:
    """Random (distance, amount) pairs of the trips without outliers."""
    kept = fact.filter(P.standard_trip(distance, amount))
    return S.sample_n(kept, n, key, [distance, amount], method=method)


def panel_reports(panels: DataFrame) -> dict[str, DataFrame]:
    """The small report tables that come from the panels."""
    payments = A.label_counts(payment_of_panels(panels))
    return {
        "kpi": kpi_of_panels(panels),
        "hourly_counts": hourly_of_panels(panels),
        "payment_counts": payments,
        "payment_labels": payment_labels(payments),
        "amount_histogram": histogram_of_panels(panels),
    }


SAMPLE_COLUMNS = ["trip_distance", "total_amount"]


def mart_samples() -> dict[str, tuple[int, Column, list[str]]]:
    """Of each sample its size, the rows it is drawn from, and the columns it shows."""
    closed = P.within_closed("total_amount", AMOUNT_LOW, AMOUNT_HIGH)
    return {
        "sample_amounts": (AMOUNT_SAMPLE, closed, ["total_amount"]),
        "sample_scatter": (SCATTER_SAMPLE, P.standard_trip(), SAMPLE_COLUMNS),
    }


def build_marts(
    fact: DataFrame, root: str, key: Sequence[str] = SAMPLE_KEY, method: str = "xxhash64"
) -> dict[str, str]:
    """Write one table per report panel below ``root``; returns their paths. Eager.

    The fact is read three times: once for all aggregates, and twice for both
    samples together. Every other step reads the small tables written before. Steps
    that do not wait for each other run at once. The samples are ranked by columns of
    the rows, so they do not depend on how the fact is stored.
    """
    spark = fact.sparkSession
    names = [
        "trip_panels", "kpi", "hourly_counts", "payment_counts", "payment_labels",
        "amount_histogram", "sample_candidates", "sample_amounts", "sample_scatter", "preview",
    ]
    paths = {name: f"{root.rstrip('/')}/{name}" for name in names}

    def write(name: str, frame: DataFrame) -> DataFrame:
        write_lake(frame, paths[name])
        return read_written(frame, paths[name])

    def reports() -> None:
        small = panel_reports(write("trip_panels", trip_panels(fact)))
        at_once(*[partial(write, name, frame.coalesce(1)) for name, frame in small.items()])

    def samples() -> None:
        columns, wanted = SAMPLE_COLUMNS, mart_samples()
        drawn = S.sample_candidates(
            fact, [(n, kept) for n, kept, _ in wanted.values()], key, columns, method=method
        )
        drawn = write("sample_candidates", drawn)
        at_once(
            *[
                partial(
                    write,
                    name,
                    S.take_sample(drawn.filter(kept), n, key, taken, method=method, ranked_by=columns),
                )
                for name, (n, kept, taken) in wanted.items()
            ]
        )

    def preview() -> None:
        # A limit would open every file of the fact for its five rows; take stops early.
        write("preview", spark.createDataFrame(fact.take(PREVIEW_ROWS), fact.schema).coalesce(1))

    at_once(reports, samples, preview)
    return paths
