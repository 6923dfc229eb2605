"""Sinks and whole jobs: what they write, replace, refuse and report."""

import pytest
from pyspark.sql import functions as F

from tripmill.bindings import fixture as X
from tripmill.bindings.queries import clean
from tripmill.errors import ConstraintError, MissingInputError, SchemaConflictError
from tripmill.operators import quality as Q
from tripmill.operators.aggregate import hourly_counts
from tripmill.operators.clean import clean_trips
from tripmill.operators.standardize import standardize
from tripmill.operators.star import to_warehouse
from tripmill.plans.etl import run_etl
from tripmill.plans import marts
from tripmill.plans.lifecycle import run_lifecycle
from tripmill.sources import dimensions as D
from tripmill.sources import jdbc, landing, parquet, scratch, warehouse
from tripmill.session import s3a_conf


@pytest.fixture(scope="module")
def raw(spark, sf_dir, tmp_path_factory):
    """Monthly files whose codes the dimensions all know."""
    months = [
        Q.fk_accepted(
            Q.fk_accepted(m, "payment_type", D.dim_payment_type(spark), "payment_type_id"),
            "RatecodeID",
            D.dim_rate_code(spark),
            "rate_code_id",
        )
        for m in X.raw_months(spark, sf_dir)
    ]
    return X.write_raw_months(months, str(tmp_path_factory.mktemp("raw")))


def test_landing_reports_bad_files_and_goes_on(spark, tmp_path):
    good, broken = tmp_path / "good.parquet", tmp_path / "broken.parquet"
    spark.range(10).write.parquet(str(good))
    broken.write_bytes(b"not parquet at all")
    sources = [str(broken), str(tmp_path / "absent.parquet"), str(good)]
    status = {r["file"]: r for r in landing.land_files(spark, sources, str(tmp_path / "lake")).collect()}
    assert (status["good.parquet"]["ok"], status["good.parquet"]["rows"]) == (True, 10)
    for name in ("broken.parquet", "absent.parquet"):
        assert not status[name]["ok"] and status[name]["error"]
    assert parquet.row_count(spark, str(tmp_path / "lake/good.parquet")) == 10


def test_an_error_without_a_message_is_reported(spark, monkeypatch):
    def broken(*_):
        raise RuntimeError

    monkeypatch.setattr(landing, "read_file", broken)
    assert landing.land_file(spark, "a.parquet", "x")[3] == "RuntimeError: "


@pytest.mark.parametrize("late", range(5))
@pytest.mark.parametrize("reader", ["read_parts", "read_months", "read_file"])
def test_no_column_of_a_directory_is_lost(spark, tmp_path, late, reader):
    path = str(tmp_path / f"parts-{late}")
    one, two = spark.range(3), spark.range(3, 6).withColumn("extra", F.lit(late))
    for frame in (one, two) if late % 2 else (two, one):
        frame.coalesce(1).write.mode("append").parquet(path)
    if reader == "read_months":
        df = parquet.read_months(spark, [path], transform=lambda month: month)
    else:
        df = getattr(parquet, reader)(spark, path)
    assert set(df.columns) == {"id", "extra"}
    assert df.filter("extra IS NOT NULL").count() == 3 and df.count() == 6


def test_conflicting_types_within_a_directory_name_it(spark, tmp_path):
    path = str(tmp_path / "mixed")
    spark.range(3).coalesce(1).write.parquet(path)
    spark.range(3).selectExpr("CAST(id AS STRING) AS id").coalesce(1).write.mode("append").parquet(path)
    for read in (
        lambda: parquet.read_parts(spark, path),
        lambda: parquet.read_months(spark, [path]),
    ):
        with pytest.raises(SchemaConflictError, match="mixed"):
            read()


def test_batch_names_stay_texts(spark, tmp_path):
    path = str(tmp_path / "batches")
    df = spark.range(4).withColumn("batch", F.when(F.col("id") < 2, "007").otherwise("1e3"))
    parquet.replace_batches(df, path, "batch", ["007", "1e3", "none"])
    for back in (parquet.read_parts(spark, path), parquet.read_file(spark, path)):
        assert {r["batch"] for r in back.collect()} == {"007", "1e3"}
    parquet.replace_batches(df.filter("batch = '007'"), path, "batch", ["007", "1e3"])
    assert {r["batch"] for r in parquet.read_parts(spark, path).collect()} == {"007"}


def test_batches_are_read_by_one_scan_per_schema(spark, tmp_path, plan):
    paths = [f"{tmp_path}/in {i}+%/m{i}.parquet" for i in range(6)]
    for i, path in enumerate(paths):
        frame = spark.range(2).withColumn("v", F.lit(i) if i < 4 else F.lit(str(i)))
        frame.write.parquet(path)
    cast = lambda month: month.withColumn("v", F.col("v").cast("long"))
    df = parquet.read_months(spark, paths, transform=cast, batch_column="batch")
    assert plan(df).count("Location: InMemoryFileIndex") == 2
    assert {(r["v"], r["batch"]) for r in df.collect()} == {(i, f"m{i}.parquet") for i in range(6)}


def test_landing_refuses_two_files_of_one_name(spark, tmp_path):
    with pytest.raises(ValueError):
        landing.land_files(spark, ["a/x.parquet", "b/x.parquet"], str(tmp_path))


def test_etl_can_run_again(spark, raw, tmp_path):
    lake, root = str(tmp_path / "lake"), str(tmp_path / "warehouse")
    write = lambda fact: warehouse.write_fact(fact, root, mode="overwrite")
    first = run_etl(spark, raw, lake, write)
    again = run_etl(spark, raw, lake, write)
    assert first == again == parquet.row_count(spark, lake)
    assert warehouse.read_table(spark, root, warehouse.FACT).count() == first


def test_etl_replaces_single_months(spark, raw, tmp_path):
    lake, root = str(tmp_path / "lake"), str(tmp_path / "warehouse")

    def write(paths):
        names = [parquet.base_name(p) for p in paths]
        return lambda fact: warehouse.write_fact(fact, root, batch_column="batch", batches=names)

    total = run_etl(spark, raw, lake, write(raw), batch_column="batch")
    second = run_etl(spark, raw[1:2], lake, write(raw[1:2]), batch_column="batch")
    assert 0 < second < total
    fact = warehouse.read_table(spark, root, warehouse.FACT)
    assert parquet.row_count(spark, lake) == fact.count() == total
    assert parquet.read_parts(spark, lake).count() == total
    assert Q.pk_report(fact, "trip_id").first()["ok"]

    # The same file, now without a clean row, leaves nothing of its old rows.
    emptied = str(tmp_path / "new" / parquet.base_name(raw[1]))
    spark.read.parquet(raw[1]).withColumn("trip_distance", F.lit(0.0)).write.parquet(emptied)
    assert run_etl(spark, [emptied], lake, write([emptied]), batch_column="batch") == 0
    fact = warehouse.read_table(spark, root, warehouse.FACT)
    assert parquet.row_count(spark, lake) == fact.count() == total - second


def test_appending_the_fact_again_duplicates_rows_but_no_key(spark, raw, tmp_path):
    root = str(tmp_path / "warehouse")
    fact = to_warehouse(parquet.read_months(spark, raw[:1]))
    for _ in range(3):
        warehouse.write_fact(fact, root)
    stored = warehouse.read_table(spark, root, warehouse.FACT)
    assert stored.count() == 3 * fact.count()
    assert Q.pk_report(stored, "trip_id").first()["ok"]
    largest = stored.agg(F.max("trip_id")).first()[0]
    assert warehouse.next_trip_id(spark, root) == largest + 1


def test_next_key_without_or_after_a_record(spark, raw, tmp_path):
    root = str(tmp_path / "warehouse")
    assert warehouse.next_trip_id(spark, root) == 0
    spark.range(5).withColumnRenamed("id", "trip_id").write.parquet(f"{root}/{warehouse.FACT}")
    assert warehouse.next_trip_id(spark, root) == 5
    # A write that recorded its first key and then failed.
    spark.range(9, 10).withColumnRenamed("id", "start").write.parquet(f"{root}/{warehouse.FACT_KEYS}")
    assert warehouse.next_trip_id(spark, root) == 9


@pytest.fixture(scope="module")
def keyed(spark, sf_dir):
    """Trips with keys of their own that meet all constraints."""
    fact = to_warehouse(clean_trips(standardize(X.raw_trips(spark, sf_dir))))
    for _, _, fk, dim, pk in warehouse.foreign_keys(fact):
        fact = Q.fk_accepted(fact, fk, dim, pk)
    return fact


def test_source_keys_are_kept_and_checked(spark, keyed, tmp_path):
    root = str(tmp_path / "warehouse")
    some = keyed.filter("trip_id % 10 = 3")
    copies = some.unionByName(some.limit(1))
    unknown = some.withColumn("trip_id", F.when(F.col("trip_id") > 13, F.col("trip_id")))
    for bad in (copies, unknown):
        with pytest.raises(ConstraintError, match="is a key"):
            warehouse.write_fact(bad, root)
    assert not (tmp_path / "warehouse").exists()
    warehouse.write_fact(some, root)
    with pytest.raises(ConstraintError, match="is new"):
        warehouse.write_fact(keyed.filter("trip_id IN (13, 14, 15)"), root)
    warehouse.write_fact(keyed.filter("trip_id % 10 = 4"), root)
    stored = warehouse.read_table(spark, root, warehouse.FACT)
    expected = keyed.filter("trip_id % 10 IN (3, 4)")
    assert sorted(r[0] for r in stored.select("trip_id").collect()) == sorted(
        r[0] for r in expected.select("trip_id").collect()
    )
    assert not (tmp_path / "warehouse" / warehouse.FACT_KEYS).exists()
    # A batch that is written again replaces its own keys.
    other = str(tmp_path / "batches")
    batch = some.withColumn("batch", F.lit("a"))
    for _ in range(2):
        warehouse.write_fact(batch, other, batch_column="batch", batches=["a"])
    assert warehouse.read_table(spark, other, warehouse.FACT).count() == some.count()


def orphaned(spark, sf_dir):
    months = X.raw_months(spark, sf_dir)
    return to_warehouse(parquet.standardize(months[0]))


def test_nothing_is_written_when_a_constraint_fails(spark, sf_dir, raw, tmp_path):
    root = str(tmp_path / "warehouse")
    with pytest.raises(ConstraintError, match="fk_payment"):
        warehouse.write_fact(orphaned(spark, sf_dir), root)
    long_flag = to_warehouse(parquet.read_months(spark, raw[:1])).withColumn(
        "store_and_fwd_flag", F.lit("too long")
    )
    with pytest.raises(ConstraintError, match="max_length:store_and_fwd_flag"):
        warehouse.write_fact(long_flag, root)
    assert not (tmp_path / "warehouse").exists()


def test_jdbc_checks_constraints_before_it_connects(spark, sf_dir, raw):
    target = jdbc.JdbcTarget("jdbc:none://nowhere/db", "me", "secret")
    with pytest.raises(ConstraintError):
        jdbc.append_fact(orphaned(spark, sf_dir), target)
    with pytest.raises(Exception, match="[Dd]river"):
        jdbc.append_fact(to_warehouse(parquet.read_months(spark, raw[:1])), target)


def test_jdbc_options(spark):
    target = jdbc.JdbcTarget("jdbc:none://nowhere/db", user="me", password="secret", driver="d.D")
    assert target.options() == {
        "url": "jdbc:none://nowhere/db", "user": "me", "password": "secret", "driver": "d.D",
    }
    assert jdbc.JdbcTarget("u").options() == {"url": "u"}
    assert "secret" not in repr(target)
    with pytest.raises(ValueError, match="partition_column"):
        jdbc.read_table(spark, jdbc.JdbcTarget("jdbc:none://nowhere/db"))


def test_jdbc_bounds():
    assert jdbc.bounds_query("t", "c") == "SELECT min(c) AS lower_bound, max(c) AS upper_bound FROM t"
    assert jdbc._bounds(None, None, 3, 90) == (3, 90)
    assert jdbc._bounds(5, None, 3, 90) == (5, 90)
    assert jdbc._bounds(None, 7, 3, 90) == (3, 7)
    assert jdbc._bounds(None, None, None, None) == (0, 1)
    assert jdbc._bounds(None, None, 4, 4) == (4, 5)
    assert jdbc.partition_options("c", 1, 9, 4) == {
        "partitionColumn": "c", "lowerBound": "1", "upperBound": "9", "numPartitions": "4",
    }


def test_star_schema_as_views(spark, raw, tmp_path):
    root = str(tmp_path / "warehouse")
    assert warehouse.create_dimensions(spark, root).first()["status"].startswith("Star schema ready")
    warehouse.register_views(spark, root)
    assert not spark.catalog.tableExists("fact_trips")
    warehouse.write_fact(to_warehouse(parquet.read_months(spark, raw)), root)
    warehouse.register_views(spark, root)
    named = spark.sql(
        "SELECT payment_name, count(*) AS n FROM fact_trips LEFT JOIN dim_payment_type"
        " USING (payment_type_id) GROUP BY payment_name"
    )
    assert {r["payment_name"] for r in named.collect()} >= {"Cash", "Voided trip", None}
    fact = warehouse.read_table(spark, root, warehouse.FACT)
    hours = spark.sql(
        "SELECT extract(HOUR FROM tpep_pickup_datetime) AS hour, count(*) AS counts"
        " FROM fact_trips GROUP BY hour ORDER BY hour"
    )
    assert [tuple(r) for r in hours.collect()] == [tuple(r) for r in hourly_counts(fact).collect()]
    sampled = spark.sql(
        "SELECT total_amount FROM fact_trips WHERE total_amount BETWEEN 0 AND 200"
        " ORDER BY random() LIMIT 100"
    )
    assert sampled.count() == 100
    for view in ("fact_trips", *warehouse.DIMENSIONS):
        spark.catalog.dropTempView(view)


def test_lifecycle(spark, raw, tmp_path):
    result = run_lifecycle(spark, raw, str(tmp_path))
    assert all(r["ok"] for r in result.landed.collect())
    assert set(result.marts) == {
        "trip_panels", "kpi", "hourly_counts", "payment_counts", "payment_labels",
        "amount_histogram", "sample_candidates", "sample_amounts", "sample_scatter", "preview",
    }
    kpi = spark.read.parquet(result.marts["kpi"]).first()
    assert kpi["total_trips"] == result.clean_rows
    assert result.model.first()["passed"]
    assert spark.read.parquet(str(tmp_path / "model")).count() == 1


def test_lifecycle_stops_when_a_file_did_not_land(spark, raw, tmp_path):
    with pytest.raises(MissingInputError):
        run_lifecycle(spark, [*raw[:1], str(tmp_path / "absent.parquet")], str(tmp_path / "out"))
    assert not (tmp_path / "out" / "lake").exists()


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch.scratch_dir(spark, "x"), scratch.scratch_dir(spark, "x")
    assert one.startswith(shared) and one != other


def test_scratch_is_in_a_folder_all_executors_share():
    class Session:
        def __init__(self, shared):
            self.conf = self
            self.values = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": "hdfs:/wh"}

        def get(self, key, default=None):
            return self.values[key] or default

    assert scratch.scratch_dir(Session("s3a://b/ck/"), "x").startswith("s3a://b/ck/tripmill/x-")
    assert scratch.scratch_dir(Session(None), "x").startswith("hdfs:/wh/tripmill/x-")


def test_session_settings():
    conf = s3a_conf("http://store:9000", ssl=False)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert not any("key" in name for name in conf)
    assert any("secret" in name for name in s3a_conf(access_key="a", secret_key="b"))


def test_clean_rows_at_other_scales(spark):
    assert clean(spark, "/root/testdata/sf0.001").count() == 854
    assert clean(spark, "/root/testdata/sf0.1").count() == 85_805


def test_samples_do_not_depend_on_file_layout(spark, raw, tmp_path):
    fact = to_warehouse(parquet.read_months(spark, raw))
    found = []
    for parts in (1, 3):
        path = str(tmp_path / f"fact-{parts}")
        warehouse.with_surrogate_key(fact.repartition(parts)).write.parquet(path)
        paths = marts.build_marts(spark.read.parquet(path), str(tmp_path / f"marts-{parts}"))
        found.append(
            [
                sorted(map(tuple, spark.read.parquet(paths[name]).collect()))
                for name in ("sample_amounts", "sample_scatter")
            ]
        )
    assert found[0] == found[1]
