"""The registered queries: each operator over the test tables, whole.

Sums and averages of doubles depend on the order of addition in their last
digits, so they are rounded here, and only here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.bindings import fixture as X
from tripmill.functions import keys as K
from tripmill.functions import predicates as P
from tripmill.operators import aggregate as A
from tripmill.operators import clean as C
from tripmill.operators import judge as J
from tripmill.operators import ml
from tripmill.operators import quality as Q
from tripmill.operators import regression as R
from tripmill.operators import sample as S
from tripmill.operators import standardize as Z
from tripmill.operators import star
from tripmill.plans import etl, incremental, lifecycle, marts, training
from tripmill.schema import TEXT_BOUNDS
from tripmill.sources import catalog, landing, models, numbering, parquet, versioned, warehouse
from tripmill.sources import dimensions as D
from tripmill.sources.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TRIP_KEY = ("trip_id",)
AMOUNT_RANGE = (marts.AMOUNT_LOW, marts.AMOUNT_HIGH)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, places in digits.items()})


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_trips(X.trips(spark, sf_dir))


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.union_by_name([Z.standardize(month) for month in X.raw_months(spark, sf_dir)])


def standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir).filter(P.standard_trip())


# --- reading, one schema, cleaning


@query
def standardize_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardized(spark, sf_dir)


@query
def read_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from files, with the file each row came from."""
    paths = X.write_raw_months(X.raw_months(spark, sf_dir), scratch_dir(spark, "raw"))
    return parquet.read_months(spark, paths, batch_column="batch")


@query
def concat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files of which some lack a column."""
    events = X.table(spark, sf_dir, "events")
    path = scratch_dir(spark, "parts")
    late = F.col("ts") >= F.to_timestamp_ntz(F.lit(X.STARTS[1]))
    events.filter(~late).select("event_id", "value").write.parquet(path)
    events.filter(late).select("event_id", "value", "event_type").write.mode("append").parquet(path)
    return parquet.read_parts(spark, path)


@query
def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(spark, sf_dir)


@query
def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    far, paid = P.positive("trip_distance"), P.non_negative("total_amount")
    filled = C.fill_missing(X.trips(spark, sf_dir), "passenger_count", 1)
    return filled.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(far).alias("after_distance"),
        F.count_if(far & paid).alias("after_amount"),
        F.count_if(far & paid & P.positive("passenger_count")).alias("clean_rows"),
    )


@query
def null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.fill_missing(X.trips(spark, sf_dir), "passenger_count", 1).select(
        "trip_id", "passenger_count"
    )


@query
def range_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = clean(spark, sf_dir).filter(P.within_closed("total_amount", *AMOUNT_RANGE))
    return kept.select("trip_id", "total_amount")


@query
def range_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standard(spark, sf_dir).select("trip_id", "trip_distance", "total_amount")


@query
def range_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = X.table(spark, sf_dir, "lineitem")
    kept = items.filter(
        P.within_closed("l_quantity", 10.0, 40.0) & P.within_open("l_discount", 0.0, 0.05)
    )
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("counts"))


# --- landing and ETL


@query
def land_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tables and one that does not exist; the missing one is only reported. Each
    landed copy is summed up over a column."""
    columns = {
        "events": "event_id", "orders": "o_custkey", "customer": "c_nationkey",
        "lineitem": "l_partkey", "no_such_table": None, "nation": "n_regionkey",
    }
    root = scratch_dir(spark, "landing")
    sources = [f"{sf_dir}/{name}.parquet" for name in columns]
    status = landing.land_files(spark, sources, root).select("file", "ok", "rows")
    sums = [
        parquet.read_file(spark, f"{root}/{name}.parquet")
        .agg(F.sum(F.col(column).cast("long")).alias("content"))
        .select(F.lit(f"{name}.parquet").alias("file"), "content")
        for name, column in columns.items()
        if column
    ]
    return status.join(reduce(DataFrame.unionByName, sums), "file", "left")


@query
def etl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifting files in, clean lake out."""
    root = scratch_dir(spark, "etl")
    paths = X.write_raw_months(X.raw_months(spark, sf_dir), f"{root}/raw")
    etl.run_etl(spark, paths, f"{root}/lake")
    return parquet.read_parts(spark, f"{root}/lake")


def lived(spark: SparkSession, sf_dir: str) -> tuple[lifecycle.LifecycleResult, str]:
    """All stages, from files whose codes are all known to the dimensions."""
    root = scratch_dir(spark, "lifecycle")
    payment, rate = D.dim_payment_type(spark), D.dim_rate_code(spark)
    months = [
        Q.fk_accepted(
            Q.fk_accepted(month, "payment_type", payment, "payment_type_id"),
            "RatecodeID",
            rate,
            "rate_code_id",
        )
        for month in X.raw_months(spark, sf_dir)
    ]
    return lifecycle.run_lifecycle(spark, X.write_raw_months(months, f"{root}/in"), f"{root}/out"), root


@query
def lifecycle_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every table the life-cycle writes, in one layout: place, key, and two
    values. Of the model, the rows it was trained and tested on."""
    result, root = lived(spark, sf_dir)
    none = F.lit(None)
    trip = F.concat_ws(":", "PULocationID", "DOLocationID", "payment_type_id", "rate_code_id")
    names = [f"trips-{number}.parquet" for number in range(1, 5)]
    raw = parquet.read_months(spark, [f"{root}/out/raw/{name}" for name in names], batch_column="batch")
    tables = [
        ("landed", result.landed, F.col("file"), F.col("rows"), none),
        ("raw", raw, F.concat_ws(":", "batch", "PULocationID", "DOLocationID"), F.col("trip_distance"), F.col("total_amount")),
        (
            "lake", parquet.read_parts(spark, result.lake).withColumnsRenamed(
                {"payment_type": "payment_type_id", "RatecodeID": "rate_code_id"}
            ).withColumn("rate_code_id", F.col("rate_code_id").cast("int")),
            trip, F.col("trip_distance"), F.col("total_amount"),
        ),
        (
            "fact", warehouse.read_table(spark, result.warehouse, warehouse.FACT), trip,
            F.col("trip_distance"), F.col("total_amount"),
        ),
        (
            "model", result.model, F.concat_ws(":", F.lit("rows"), F.col("passed").cast("string")),
            F.col("n_train") + F.col("n_test"), none,
        ),
    ]
    for table, (key, _) in warehouse.DIMENSIONS.items():
        dim = warehouse.read_table(spark, result.warehouse, table)
        tables.append((table, dim, F.concat_ws(":", key, dim.columns[1]), none, none))
    frames = [
        frame.select(
            F.lit(name).alias("place"), key.cast("string").alias("key"), a.cast("double").alias("a"), b.cast("double").alias("b")
        )
        for name, frame, key, a, b in tables
    ]
    fact = warehouse.read_table(spark, result.warehouse, warehouse.FACT)
    written = mart_rows({name: spark.read.parquet(path) for name, path in result.marts.items()}, fact)
    written = written.select(
        F.concat(F.lit("mart:"), "mart").alias("place"),
        F.concat_ws("|", "key", "counts").alias("key"), "a", "b",
    )
    return reduce(DataFrame.unionByName, [*frames, written])


@query
def lifecycle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of what the life-cycle writes."""
    result, _ = lived(spark, sf_dir)
    landed = result.landed.agg(F.sum("rows").alias("landed_rows")).scalar()
    trained = result.model.select(F.col("n_train") + F.col("n_test")).scalar()
    kpi = spark.read.parquet(result.marts["kpi"]).select(
        landed.alias("landed_rows"),
        F.lit(result.clean_rows).cast("long").alias("clean_rows"),
        F.col("total_trips").alias("fact_rows"),
        "total_revenue",
        "avg_distance",
        trained.alias("model_rows"),
    )
    return rounded(kpi, total_revenue=4, avg_distance=6)


# --- replacing and adding, batch by batch

BATCH = "batch"
BATCHES = ("trips-1", "trips-2", "trips-3", "trips-4")


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean trips, each with the monthly file it would come in."""
    name = F.lit(BATCHES[0])
    for start, batch in zip(X.STARTS, BATCHES[1:]):
        late = F.col("tpep_pickup_datetime") >= F.to_timestamp_ntz(F.lit(start))
        name = F.when(late, batch).otherwise(name)
    return clean(spark, sf_dir).withColumn(BATCH, name)


def grown_fact(spark: SparkSession, sf_dir: str, root: str, refresh: Callable[[DataFrame, list[str]], object]) -> None:
    """A fact that comes in three runs, with a refresh after each: two batches, one of them
    only half there; that one again, whole; the others."""
    trips = batched(spark, sf_dir)
    half = (F.col(BATCH) == BATCHES[0]) | (F.col("trip_id") % 2 == 0)
    for now, rows in ((BATCHES[:2], trips.filter(half)), (BATCHES[1:2], trips), (BATCHES[2:], trips)):
        own = rows.filter(F.col(BATCH).isin(list(now)))
        versioned.replace_version(own, f"{root}/fact", BATCH, now)
        refresh(versioned.read_version(spark, f"{root}/fact"), list(now))


@query
def atomic_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's rows as readers see them: first half of the trips, then after a replacement
    that dies while it writes, then after one that does not, and the first version again."""
    path = f"{scratch_dir(spark, 'atomic')}/trips"
    trips = clean(spark, sf_dir)
    first = trips.filter("trip_id % 2 = 0")
    versioned.replace_version(first, path)
    broken = F.when(F.col("trip_id") % 997 == 5, F.raise_error(F.lit("dies here")).cast("double"))
    try:
        versioned.replace_version(
            trips.withColumn("total_amount", F.coalesce(broken, F.col("total_amount"))), path
        )
        raise AssertionError("the replacement was to die")
    except PySparkException:
        after_failure = versioned.read_version(spark, path)
    versioned.replace_version(trips, path)
    phases = {
        "after failure": after_failure,
        "replaced": versioned.read_version(spark, path),
        "as it was": versioned.read_version(spark, path, versioned.versions(spark, path)[0]),
    }
    shown = [frame.select(F.lit(name).alias("phase"), "trip_id", "total_amount") for name, frame in phases.items()]
    return reduce(DataFrame.unionByName, shown)


@query
def replace_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact in batches, one of them written again, one emptied: the rows that stay."""
    path = f"{scratch_dir(spark, 'months')}/fact"
    trips = batched(spark, sf_dir)
    versioned.replace_version(trips, path, BATCH, BATCHES)
    again = trips.filter(F.col(BATCH) == BATCHES[1]).withColumn("total_amount", F.col("total_amount") + 1)
    versioned.replace_version(again, path, BATCH, [BATCHES[1], BATCHES[2]])
    return versioned.read_version(spark, path).select(BATCH, "trip_id", "total_amount")


@query
def marts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report tables, refreshed batch by batch: those of ``mart_tables``."""
    root = scratch_dir(spark, "incremental")
    paths: dict[str, str] = {}

    def refresh(fact: DataFrame, now: list[str]) -> None:
        paths.update(incremental.refresh_marts(fact, f"{root}/marts", BATCH, now, TRIP_KEY, method="md5"))

    grown_fact(spark, sf_dir, root, refresh)
    tables = {name: versioned.read_version(spark, path) for name, path in paths.items()}
    tables["preview"] = tables["preview"].drop(BATCH)
    return mart_rows(tables, clean(spark, sf_dir))


def merged_sample(spark: SparkSession, sf_dir: str, name: str, n: int) -> DataFrame:
    root = scratch_dir(spark, "samples")
    _, condition, taken = marts.mart_samples()[name]
    columns = marts.SAMPLE_COLUMNS

    def refresh(fact: DataFrame, now: list[str]) -> None:
        incremental.refresh_sample_state(fact, root, BATCH, now, [(n, condition)], TRIP_KEY, columns, "md5")

    grown_fact(spark, sf_dir, root, refresh)
    state = versioned.read_version(spark, f"{root}/{incremental.SAMPLES}")
    return S.merge_samples(state, n, condition, TRIP_KEY, columns, taken)


@query
def sample_amounts_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of all trips, from 500 rows kept of each batch."""
    return merged_sample(spark, sf_dir, "sample_amounts", 500)


@query
def sample_scatter_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged_sample(spark, sf_dir, "sample_scatter", 500)


@query
def train_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model of all trips, refitted from the moments of each batch."""
    root = scratch_dir(spark, "training")

    def refresh(fact: DataFrame, now: list[str]) -> None:
        incremental.refresh_model(fact, root, BATCH, now, key=TRIP_KEY, method="md5")

    grown_fact(spark, sf_dir, root, refresh)
    return rounded(incremental.current_model(spark, root), coef=6, intercept=6, rmse=6)


# --- star schema


@query
def warehouse_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.to_warehouse(C.clean_trips(standardized(spark, sf_dir)))


@query
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct generated keys: the same number."""
    keyed = star.with_surrogate_key(clean(spark, sf_dir).drop("trip_id"))
    return A.counts_by(keyed, "trip_id").agg(
        F.sum("counts").alias("rows"), F.count(F.lit(1)).alias("keys")
    )


@query
def warehouse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows both foreign keys accept, written to and read from the fact table."""
    root = scratch_dir(spark, "warehouse")
    fact = star.to_warehouse(C.clean_trips(standardized(spark, sf_dir)))
    warehouse.create_dimensions(spark, root)
    for _, _, fk, dim, pk in warehouse.foreign_keys(fact):
        fact = Q.fk_accepted(fact, fk, dim, pk)
    warehouse.write_fact(fact, root, mode="overwrite")
    return warehouse.read_table(spark, root, warehouse.FACT).drop("trip_id")


@query
def warehouse_source_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that bring their own key, written in two appends and read back."""
    root = scratch_dir(spark, "warehouse")
    raw = X.raw_trips(spark, sf_dir)
    fact = star.to_warehouse(C.clean_trips(Z.standardize(raw)))
    for _, _, fk, dim, pk in warehouse.foreign_keys(fact):
        fact = Q.fk_accepted(fact, fk, dim, pk)
    for side in (F.col("trip_id") % 2 == 0, F.col("trip_id") % 2 == 1):
        warehouse.write_fact(fact.filter(side), root)
    return warehouse.read_table(spark, root, warehouse.FACT)


@query
def warehouse_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status row of the written dimensions, with the trips of code 0."""
    status = warehouse.create_dimensions(spark, scratch_dir(spark, "warehouse"))
    trips = clean(spark, sf_dir).filter("payment_type_id = 0")
    return status.withColumn("counts", trips.agg(F.count(F.lit(1))).scalar())


@query
def enrich_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.enrich_trips(
        clean(spark, sf_dir), D.dim_payment_type(spark), D.dim_rate_code(spark), D.dim_vendor(spark)
    )


@query
def enrich_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counts_by(enrich_trips(spark, sf_dir), "payment_name", "rate_description")


@query
def dim_payment_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each payment type with its trips, also if there are none."""
    return dimension_usage(D.dim_payment_type(spark), clean(spark, sf_dir), "payment_type_id")


@query
def dim_rate_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_usage(D.dim_rate_code(spark), clean(spark, sf_dir), "rate_code_id")


@query
def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_usage(D.dim_vendor(spark), clean(spark, sf_dir), "vendor_id")


def dimension_usage(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    used = A.counts_by(fact.select(F.col(key).cast("int").alias(key)), key)
    return dim.join(used, key, "left").withColumn(
        "counts", F.coalesce("counts", F.lit(0).cast("long"))
    )


# --- rows that are refused, dense keys, landing again, tables of the catalog


def judged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """All trips, their flag too, with the rules they break."""
    raw = X.raw_trips(spark, sf_dir)
    filled = C.fill_missing(Z.standardize(raw), "passenger_count", 1).withColumns(
        {"store_and_fwd_flag": F.when(F.col("trip_id") % 83 == 0, "too long").otherwise(F.col("store_and_fwd_flag"))}
    )
    rules = J.trip_rules({"store_and_fwd_flag": TEXT_BOUNDS["store_and_fwd_flag"]})
    foreign = [
        ("fk_payment", "payment_type", D.dim_payment_type(spark), "payment_type_id"),
        ("fk_rate", "RatecodeID", D.dim_rate_code(spark), "rate_code_id"),
    ]
    return J.label_rows(filled, rules, foreign), [*rules, *(rule for rule, *_ in foreign)]


@query
def judged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trip with the rules it breaks, written apart and read back."""
    labelled, rules = judged(spark, sf_dir)
    path = f"{scratch_dir(spark, 'judged')}/trips"
    J.write_judged(labelled, path, rules)
    shown = ["trip_id", "trip_distance", "total_amount", "passenger_count"]
    accepted = J.read_accepted(spark, path).select(*shown, F.lit(True).alias("accepted"), F.lit("").alias("broken"))
    rejected = J.read_rejected(spark, path).select(
        *shown, F.lit(False).alias("accepted"), F.array_join("broken", ",").alias("broken")
    )
    return accepted.unionByName(rejected)


@query
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per rule broken, as the write itself counted them."""
    labelled, rules = judged(spark, sf_dir)
    return J.write_judged(labelled, f"{scratch_dir(spark, 'judged')}/trips", rules)


@query
def reject_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.broken_counts(judged(spark, sf_dir)[0])


@query
def dense_trip_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips numbered from 0 by their time of pick-up, then by amount and source key."""
    trips = clean(spark, sf_dir).withColumnRenamed("trip_id", "source_id")
    order = ["tpep_pickup_datetime", F.desc("total_amount"), "source_id"]
    return numbering.with_dense_key(trips, order).select("trip_id", "source_id", "tpep_pickup_datetime", "total_amount")


@query
def land_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a folder of files: three are new; nothing is; one has changed and one
    is new, one is not there."""
    root = scratch_dir(spark, "landing")
    months = X.raw_months(spark, sf_dir)
    paths = X.write_raw_months(months[:3], f"{root}/in")
    runs = [landing.land_new(spark, paths, f"{root}/raw"), landing.land_new(spark, paths, f"{root}/raw")]
    months[1].filter("VendorID = 1").write.mode("overwrite").parquet(paths[1])
    paths.append(f"{root}/in/trips-4.parquet")
    months[3].write.parquet(paths[3])
    runs.append(landing.land_new(spark, [*paths, f"{root}/in/trips-5.parquet"], f"{root}/raw"))
    copies = [
        F.lit(parquet.row_count(spark, f"{root}/raw/trips-{number}.parquet")) for number in range(1, 5)
    ]
    shown = [run.select(F.lit(number).alias("run"), "file", "action", "rows") for number, run in enumerate(runs, 1)]
    everything = reduce(DataFrame.unionByName, shown)
    there = spark.range(1).select(
        F.lit(4).alias("run"), F.lit("all").alias("file"), F.lit("there").alias("action"),
        reduce(lambda a, b: a + b, copies).cast("long").alias("rows"),
    )
    return everything.unionByName(there)


@query
def sql_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panels as SQL over tables of the catalog, whose rows both foreign keys accept:
    panel, key, counts, value."""
    root = scratch_dir(spark, "catalog")
    database = "trips_" + root.rsplit("-", 1)[-1]
    catalog.create_star_schema(spark, database, root)
    fact = star.to_warehouse(C.clean_trips(standardized(spark, sf_dir)))
    for _, _, fk, dim, pk in warehouse.foreign_keys(fact):
        fact = Q.fk_accepted(fact, fk, dim, pk)
    catalog.insert_fact(star.with_surrogate_key(fact), database, overwrite=True)
    none = F.lit(None)
    layouts = {
        "kpi": (F.lit("all"), F.col("total_trips"), F.round("total_revenue", 4)),
        "hourly_counts": (F.col("hour"), F.col("counts"), none),
        "payment_counts": (F.concat_ws(":", "payment_type_id", "payment_name"), F.col("counts"), none),
        "rate_counts": (F.concat_ws(":", "rate_code_id", "rate_description"), F.col("counts"), F.round("avg_amount", 6)),
        "vendor_counts": (F.col("vendor_name"), F.col("counts"), none),
        "amount_histogram": (F.col("bin"), F.col("counts"), none),
        "scatter": (F.col("trip_distance").cast("decimal(18,6)"), none, F.col("total_amount")),
        "unknown_codes": (F.lit("both"), F.col("payment") + F.col("rate"), none),
    }
    frames = [
        catalog.panel(spark, database, name).select(
            F.lit(name).alias("panel"), key.cast("string").alias("key"), counts.cast("long").alias("counts"),
            value.cast("double").alias("value"),
        )
        for name, (key, counts, value) in layouts.items()
    ]
    return reduce(DataFrame.unionByName, frames)


# --- reports


@query
def kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(A.kpi(clean(spark, sf_dir)), total_revenue=4, avg_distance=6)


@query
def kpi_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = A.kpi(X.table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity")
    return rounded(report, total_revenue=2, avg_distance=6)


@query
def kpi_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.kpi_text(A.kpi(clean(spark, sf_dir)))


@query
def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.hourly_counts(clean(spark, sf_dir))


@query
def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.hourly_counts(X.table(spark, sf_dir, "events"), "ts")


@query
def payment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counts_by(clean(spark, sf_dir), "payment_type_id")


@query
def priority_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.counts_by(X.table(spark, sf_dir, "orders"), "o_orderpriority")


@query
def payment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.label_counts(A.counts_by(clean(spark, sf_dir), "payment_type_id"))


@query
def payment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.roll_up(payment_names(spark, sf_dir))


@query
def payment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(A.share_of_total(payment_labels(spark, sf_dir)), share=6)


@query
def priority_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(A.share_of_total(priority_counts(spark, sf_dir)), share=6)


@query
def amount_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.histogram(clean(spark, sf_dir), "total_amount", *AMOUNT_RANGE, marts.AMOUNT_BINS)


@query
def quantity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of 51 and more do not occur: the last bins are empty."""
    return A.histogram(X.table(spark, sf_dir, "lineitem"), "l_quantity", 0.0, 64.0, 16)


@query
def nice_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most 50 bins over whatever range the clean amounts have."""
    return A.nice_histogram(clean(spark, sf_dir), "total_amount", 50)


@query
def nice_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.nice_histogram(X.table(spark, sf_dir, "lineitem"), "l_extendedprice", 50)


@query
def nice_discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range below one."""
    return A.nice_histogram(X.table(spark, sf_dir, "lineitem"), "l_discount", 20)


@query
def trip_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.trip_panels(clean(spark, sf_dir)), amount_sum=4, distance_sum=4)


@query
def panel_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = marts.kpi_of_panels(marts.trip_panels(clean(spark, sf_dir)))
    return rounded(report, total_revenue=4, avg_distance=6)


@query
def panel_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.hourly_of_panels(marts.trip_panels(clean(spark, sf_dir)))


@query
def panel_payment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = marts.payment_of_panels(marts.trip_panels(clean(spark, sf_dir)))
    return rounded(marts.payment_labels(counts), share=6)


@query
def panel_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.histogram_of_panels(marts.trip_panels(clean(spark, sf_dir)))


@query
def mart_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all report tables, written and read back, in one layout: mart, key,
    counts, and two values. Of the preview's rows, how many are trips."""
    trips = clean(spark, sf_dir)
    paths = marts.build_marts(trips, scratch_dir(spark, "marts"), TRIP_KEY, method="md5")
    return mart_rows({name: spark.read.parquet(path) for name, path in paths.items()}, trips)


def mart_rows(tables: dict[str, DataFrame], trips: DataFrame) -> DataFrame:
    none = F.lit(None)
    layouts = {
        "trip_panels": (
            F.concat_ws(":", "panel", F.coalesce("hour", "payment_type_id", "bin")),
            F.col("counts"), F.round("amount_sum", 4), F.round("distance_sum", 4),
        ),
        "kpi": (
            F.lit("all"), F.col("total_trips"), F.round("total_revenue", 4), F.round("avg_distance", 6),
        ),
        "hourly_counts": (F.col("hour"), F.col("counts"), none, none),
        "payment_counts": (F.concat_ws(":", "payment_type_id", "payment_name"), F.col("counts"), none, none),
        "payment_labels": (F.col("payment_name"), F.col("counts"), F.round("share", 6), none),
        "amount_histogram": (F.col("bin"), F.col("counts"), F.col("bin_low"), none),
        "sample_amounts": (F.lit("row"), none, F.col("total_amount"), none),
        "sample_scatter": (F.lit("row"), none, F.col("total_amount"), F.col("trip_distance")),
    }

    def laid_out(frame: DataFrame, name: str, key: Column, counts: Column, a: Column, b: Column) -> DataFrame:
        return frame.select(
            F.lit(name).alias("mart"), key.cast("string").alias("key"), counts.cast("long").alias("counts"),
            a.cast("double").alias("a"), b.cast("double").alias("b"),
        )

    frames = [laid_out(tables[name], name, *layout) for name, layout in layouts.items()]
    shown = tables["preview"].join(trips, trips.columns, "left_semi")
    shown = shown.agg(F.count(F.lit(1)).alias("n"))
    frames.append(laid_out(shown, "preview", F.lit("rows"), F.col("n"), none, none))
    return reduce(DataFrame.unionByName, frames)


# --- samples


@query
def sample_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sample_amounts(clean(spark, sf_dir), TRIP_KEY)


@query
def sample_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sample_scatter(clean(spark, sf_dir), TRIP_KEY)


@query
def sample_amounts_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample smaller than the small test tables."""
    return marts.sample_amounts(clean(spark, sf_dir), TRIP_KEY, n=500)


@query
def sample_scatter_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.sample_scatter(clean(spark, sf_dir), TRIP_KEY, n=500)


@query
def sample_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    items = X.table(spark, sf_dir, "lineitem")
    return S.sample_n(items, marts.SCATTER_SAMPLE, key, ["l_quantity", "l_extendedprice"])


@query
def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = X.table(spark, sf_dir, "orders")
    return S.sample_fraction(orders, 0.1, ("o_orderkey",)).select("o_orderkey", "o_totalprice")


@query
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.preview(clean(spark, sf_dir), order_by="trip_id")


# --- quality


@query
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.validate(clean(spark, sf_dir), ["trip_distance", "total_amount"])


@query
def quality_report_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes are missing, and a column is absent."""
    return Q.validate(
        X.trips(spark, sf_dir), ["passenger_count", "rate_code_id", "fare", "payment_type_id"]
    )


@query
def text_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts against a bound that holds and one that does not."""
    return Q.text_report(
        X.table(spark, sf_dir, "orders"), {"o_orderstatus": 5, "o_orderpriority": 8}
    )


@query
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = clean(spark, sf_dir)
    found = [
        Q.fk_orphans(fact, fk, dim, pk).select(F.lit(rule).alias("rule"), "trip_id")
        for rule, _, fk, dim, pk in warehouse.foreign_keys(fact)
    ]
    return reduce(DataFrame.unionByName, found)


@query
def fk_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = clean(spark, sf_dir)
    for _, _, fk, dim, pk in warehouse.foreign_keys(fact):
        fact = Q.fk_accepted(fact, fk, dim, pk)
    return fact


@query
def fk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.fk_report(warehouse.foreign_keys(clean(spark, sf_dir)))


@query
def fk_report_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys between tables that both grow with the data."""
    names = ["lineitem", "orders", "supplier", "customer", "nation"]
    tables = {name: X.table(spark, sf_dir, name) for name in names}
    keys = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
    ]
    return Q.fk_report(
        [(f"{fact}.{fk}", tables[fact], fk, tables[dim], pk) for fact, fk, dim, pk in keys]
    )


@query
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.pk_duplicates(X.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def pk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = X.table(spark, sf_dir, "lineitem"), X.table(spark, sf_dir, "orders")
    return Q.pk_report(items, "l_orderkey", "l_linenumber", rule="lineitem").unionByName(
        Q.pk_report(orders, "o_orderkey", rule="orders")
    )


# --- model


def fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    train, test = R.split(standard(spark, sf_dir), TRIP_KEY)
    return R.fit(train), test


@query
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(K.in_fraction(TRIP_KEY, 0.2), "test").otherwise("train")
    return A.counts_by(standard(spark, sf_dir).withColumn("side", side), "side")


@query
def fit_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(fitted(spark, sf_dir)[0], coef=6, intercept=6, r2=6)


@query
def fit_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = R.fit(X.table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(model, coef=4, intercept=4, r2=8)


@query
def predict_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = fitted(spark, sf_dir)
    predicted = R.predict(test, model).select("trip_id", "total_amount", "prediction")
    return rounded(predicted, prediction=6)


@query
def rmse_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = fitted(spark, sf_dir)
    return rounded(R.gate(R.rmse(R.predict(test, model))), rmse=6)


@query
def rmse_gate_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = fitted(spark, sf_dir)
    return rounded(R.gate(R.rmse(R.predict(test, model)), threshold=3.0), rmse=6)


@query
def fit_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split, fit and score in one pass over the trips."""
    model = R.fit_and_score(clean(spark, sf_dir), TRIP_KEY, keep=P.standard_trip())
    return rounded(model, coef=6, intercept=6, rmse=6)


@query
def train_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validate, trim, split, fit, score, store, and load the stored model."""
    path = scratch_dir(spark, "model")
    training.train_fare_model(clean(spark, sf_dir), path, key=TRIP_KEY, method="md5")
    return rounded(models.load_model(spark, path), coef=6, intercept=6, rmse=6)


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a stored and loaded model for every clean trip, summed."""
    path = scratch_dir(spark, "model")
    models.save_model(fitted(spark, sf_dir)[0], path)
    predicted = R.predict(clean(spark, sf_dir), models.load_model(spark, path))
    report = predicted.groupBy("payment_type_id").agg(F.sum("prediction").alias("predicted_revenue"))
    return rounded(report, predicted_revenue=4)


@query
def ml_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line as an ML pipeline: fitted, stored, loaded and scored."""
    train, test = R.split(standard(spark, sf_dir), TRIP_KEY)
    path = scratch_dir(spark, "pipeline")
    ml.save_pipeline(ml.fit_pipeline(train), path)
    model = ml.load_pipeline(path)
    return rounded(ml.as_row(spark, model, ml.rmse(model, test)), coef=6, intercept=6, rmse=6)


@query
def ml_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = R.split(standard(spark, sf_dir), TRIP_KEY)
    predicted = ml.score(ml.fit_pipeline(train), test).select("trip_id", "total_amount", "prediction")
    return rounded(predicted, prediction=6)


@query
def regression_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.regression_curve(fitted(spark, sf_dir)[0]), x=6, y=6)


@query
def predict_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(R.predict_one(fitted(spark, sf_dir)[0], 2.5), price=2)


@query
def explain_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = R.explain_model(fitted(spark, sf_dir)[0])
    return rounded(report, base_price=2, price_per_mile=2)
