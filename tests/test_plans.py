"""The physical plans that the design relies on."""

import pytest
from pyspark.sql import functions as F

from tripmill.bindings import fixture as X
from tripmill.operators import aggregate as A
from tripmill.operators import quality as Q
from tripmill.operators import regression as R
from tripmill.operators.clean import clean_trips
from tripmill.operators.sample import sample_n
from tripmill.operators.standardize import standardize, union_by_name
from tripmill.operators.star import enrich_trips, to_warehouse
from tripmill.plans import marts
from tripmill.sources import dimensions as D
from tripmill.sources import parquet
from tripmill.sources.warehouse import foreign_keys


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Two monthly files in different layouts, and a stored fact."""
    root = str(tmp_path_factory.mktemp("plans"))
    paths = X.write_raw_months(X.raw_months(spark, sf_dir)[:2], f"{root}/raw")
    X.trips(spark, sf_dir).write.parquet(f"{root}/fact")
    return paths, spark.read.parquet(f"{root}/fact")


def exchanges(text):
    tree = text.split("\n\n\n")[0]
    return tree.count("Exchange")


def test_cleaning_reaches_every_scan(spark, stored, plan):
    paths, _ = stored
    text = plan(clean_trips(parquet.read_months(spark, paths)).select("trip_distance"))
    assert text.count("GreaterThan(trip_distance,0.0)") == 2
    assert text.count("GreaterThanOrEqual(total_amount,0.0)") == 2
    assert exchanges(text) == 0
    reads = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert len(reads) == 2
    assert all(line.count(":") == 4 for line in reads)  # three columns and the label


def test_widened_columns_still_push_their_filter(spark, plan, tmp_path):
    path = str(tmp_path / "ints")
    spark.range(10).select(F.col("id").cast("int").alias("trip_distance")).write.parquet(path)
    df = standardize(spark.read.parquet(path)).filter(F.col("trip_distance") > 0)
    assert df.count() == 9


def test_grouped_report_has_one_combined_shuffle(stored, plan):
    text = plan(A.counts_by(stored[1], "payment_type_id"))
    assert exchanges(text) == 1 and "partial_count" in text


def test_panels_scan_once_with_four_columns(stored, plan):
    text = plan(marts.trip_panels(stored[1]))
    assert text.count("Scan parquet") == 2 and exchanges(text) == 1
    read = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "passenger_count" not in read and "rate_code_id" not in read


def test_share_reads_its_source_once(stored, plan):
    df = marts.payment_labels(A.counts_by(stored[1], "payment_type_id"))
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "Join" not in final
    assert "ReusedExchange" in plan(df)


def test_sample_keeps_a_bounded_top_n(stored, plan):
    text = plan(sample_n(stored[1], 100, ["trip_id"], ["total_amount"]))
    assert "TakeOrderedAndProject" in text and "Subquery" in text
    assert "Scan parquet" in text and "passenger_count" not in text


def test_seed_dimensions_are_broadcast_by_their_size(spark, stored, plan):
    dims = (D.dim_payment_type(spark), D.dim_rate_code(spark), D.dim_vendor(spark))
    text = plan(enrich_trips(stored[1], *dims))
    assert text.count("BroadcastHashJoin LeftOuter") == 3
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


@pytest.fixture
def no_broadcast(spark):
    """As if every side were too large to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_large_foreign_key_check_counts_keys_before_it_joins(spark, sf_dir, plan, no_broadcast):
    items, orders = X.table(spark, sf_dir, "lineitem"), X.table(spark, sf_dir, "orders")
    df = Q.fk_report([("fk", items, "l_orderkey", orders, "o_orderkey")])
    tree = plan(df).split("\n\n\n")[0].splitlines()
    join = next(i for i, line in enumerate(tree) if "SortMergeJoin" in line)
    first_aggregate = next(i for i, line in enumerate(tree) if i > join and "HashAggregate" in line)
    assert join < first_aggregate  # the aggregate is below the join
    assert df.first()["ok"]


def test_skewed_foreign_key_is_split(spark, plan, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 100_000)
        fact = spark.range(600_000, numPartitions=16).select(hot.alias("fk"), F.hash("id").alias("v"))
        dim = spark.range(100_000).withColumnRenamed("id", "pk")
        df = Q.fk_accepted(fact, "fk", dim, "pk")
        assert df.agg(F.count("v")).first()[0] == 600_000
        probe = df.groupBy().agg(F.sum("v"))
        probe.collect()
        assert "SortMergeJoin(skew=true)" in plan(probe)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value else spark.conf.unset(name)


def test_prediction_is_one_narrow_stage(stored, plan):
    fact = stored[1]
    text = plan(R.predict(fact.select("trip_distance"), R.fit(fact)))
    main = text.split("===== Subqueries =====")[0]
    assert "Join" not in main and "Exchange" not in main
    assert text.count("Subquery:1") == 1 and "Subquery:2" not in text


def test_training_is_one_scan(stored, plan):
    text = plan(R.fit_and_score(stored[1], ["trip_id"]))
    assert text.count("Scan parquet") == 2 and exchanges(text) == 1


def test_constraints_scan_the_fact_once(spark, sf_dir, plan, tmp_path):
    X.raw_trips(spark, sf_dir).write.parquet(str(tmp_path / "raw"))
    fact = to_warehouse(standardize(spark.read.parquet(str(tmp_path / "raw"))))
    foreign = [(rule, fk, dim, pk) for rule, _, fk, dim, pk in foreign_keys(fact)]
    report = Q.constraint_report(fact, foreign, {"store_and_fwd_flag": 1})
    assert plan(report).count("Location: InMemoryFileIndex") == 1
    separate = Q.fk_report(foreign_keys(fact)).unionByName(
        Q.text_report(fact, {"store_and_fwd_flag": 1})
    )
    assert report.collect() == separate.collect()
    assert [row["bad_rows"] > 0 for row in report.collect()] == [True, True, False]


def test_union_prunes_columns(spark, sf_dir, plan):
    months = [standardize(m) for m in X.raw_months(spark, sf_dir)]
    text = plan(union_by_name(months).select("VendorID"))
    reads = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert reads and all("value" not in line and "user_id" not in line for line in reads)
