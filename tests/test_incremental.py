"""Panels, samples and moments of batches against those of all rows at once."""

import math

import pytest
from pyspark.sql import functions as F

from tests.test_samples import brute_force
from tripmill.bindings.queries import BATCH, BATCHES, TRIP_KEY, batched, clean
from tripmill.errors import QualityError
from tripmill.functions import predicates as P
from tripmill.operators import regression as R
from tripmill.operators import sample as S
from tripmill.plans import incremental as I
from tripmill.plans import marts as M
from tripmill.plans.training import train_fare_model
from tripmill.sources import versioned as V


@pytest.fixture(scope="module")
def fact(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("fact"))
    V.replace_version(batched(spark, sf_dir), root, BATCH, BATCHES)
    return V.read_version(spark, root)


def scans(text):
    return [line for line in text.splitlines() if line.startswith("PartitionFilters")]


def test_only_the_given_batches_are_scanned(fact, plan):
    """A refresh reads the fact through one filter on the partition column."""
    own = I._of(fact, BATCH, [BATCHES[1]])
    frames = [
        M.trip_panels(own, batch=BATCH),
        I.batch_moments(own, BATCH, key=TRIP_KEY, method="md5"),
        S.batch_samples(own, BATCH, [(5, P.standard_trip())], TRIP_KEY, M.SAMPLE_COLUMNS),
    ]
    for frame in frames:
        found = scans(plan(frame))
        assert found and all(f"({BATCH}" in line and f"= {BATCHES[1]})" in line for line in found), found


def test_a_refresh_opens_no_file_of_another_batch(spark, sf_dir, tmp_path):
    """The other batches' files are gone: the refresh does not miss them."""
    root = tmp_path / "fact"
    V.replace_version(batched(spark, sf_dir), str(root), BATCH, BATCHES)
    whole = V.read_version(spark, str(root))
    paths = I.refresh_marts(whole, str(tmp_path / "marts"), BATCH, BATCHES, TRIP_KEY, "md5")
    before = V.read_version(spark, paths["kpi"]).collect()
    model = I.refresh_model(whole, str(tmp_path / "model"), BATCH, BATCHES, TRIP_KEY, method="md5").collect()
    for other in root.glob(f"data/*/{BATCH}=*/*.parquet"):
        if BATCHES[2] not in str(other):
            other.write_bytes(b"unreadable")
    I.refresh_marts(whole, str(tmp_path / "marts"), BATCH, [BATCHES[2]], TRIP_KEY, "md5")
    again = I.refresh_model(whole, str(tmp_path / "model"), BATCH, [BATCHES[2]], TRIP_KEY, method="md5").collect()
    after = V.read_version(spark, paths["kpi"]).collect()
    assert after[0]["total_trips"] == before[0]["total_trips"]
    assert math.isclose(after[0]["total_revenue"], before[0]["total_revenue"])
    assert math.isclose(again[0]["coef"], model[0]["coef"]) and again[0]["n_train"] == model[0]["n_train"]


def test_an_emptied_batch_counts_no_more(spark, fact, tmp_path):
    paths = I.refresh_marts(fact, str(tmp_path), BATCH, BATCHES, TRIP_KEY, "md5")
    less = fact.filter(F.col(BATCH) != BATCHES[0])
    I.refresh_marts(less, str(tmp_path), BATCH, [BATCHES[0]], TRIP_KEY, "md5")
    kpi = V.read_version(spark, paths["kpi"]).first()
    assert kpi["total_trips"] == less.count()
    assert len(V.versions(spark, paths["kpi"])) == 2


@pytest.mark.parametrize("n", [0, 1, 7, 300, 4000])
@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_merged_samples_are_the_samples_of_all(spark, n, method):
    rows = [(i, i % 17, f"b{i % 5}" if i % 3 else "b0") for i in range(3000)] + [(0, 0, f"b{i % 4}") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, v long, b string").repartition(7)
    condition = F.col("v") < 12
    state = S.batch_samples(df, "b", [(n, condition), (3, F.lit(True))], ["id"], ["v"], method=method)
    got = S.merge_samples(state, n, condition, ["id"], ["v"], method=method)
    whole = S.sample_n(df.filter(condition), n, ["id"], ["v"], method=method)
    assert sorted(r["v"] for r in got.collect()) == sorted(r["v"] for r in whole.collect())
    if method == "md5":
        assert sorted(r["v"] for r in got.collect()) == brute_force([r[:2] for r in rows if r[1] < 12], n)
    kept = state.groupBy("b").agg(F.count_if(condition).alias("n")).collect()
    assert all(r["n"] <= n + 3 for r in kept)


def test_samples_merge_from_any_batches(spark):
    """Merging what was kept of two halves equals keeping of both at once."""
    df = spark.range(5000).select("id", (F.col("id") % 23).alias("v"), F.concat(F.lit("b"), F.col("id") % 9).alias("b"))
    state = S.batch_samples(df, "b", [(50, F.lit(True))], ["id"], ["v"])
    for some in (["b1"], ["b2", "b5"], ["b0", "b3", "b4", "b8"]):
        got = S.merge_samples(state.filter(F.col("b").isin(some)), 50, F.lit(True), ["id"], ["v"]).collect()
        own = S.sample_n(df.filter(F.col("b").isin(some)), 50, ["id"], ["v"]).collect()
        assert sorted(got) == sorted(own)


def test_merged_moments_are_stable(spark):
    """Means far from zero, where sums of squares would lose every digit."""
    rows = [(float(i % 10) + 1e9, float(3 * (i % 10)) + 1e9 + (i % 3), f"b{i % 7}") for i in range(5000)]
    df = spark.createDataFrame(rows, "x double, y double, b string")
    both = R.split_moments("x", "y", F.lit(True), F.col("x") % 2 == 0)
    merged = R.merge_moments(df.groupBy("b").agg(*both)).first()
    whole = df.agg(*both).first()
    for name in merged.asDict():
        assert math.isclose(merged[name], whole[name], rel_tol=1e-9), name


def test_moments_of_parts_without_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (3.0, 5.0, "a"), (9.0, 9.0, "b")], "x double, y double, b string")
    both = R.split_moments("x", "y", F.col("b") == "a", F.lit(False))
    merged = R.merge_moments(df.groupBy("b").agg(*both)).first()
    assert (merged["train_n"], merged["train_avgx"], merged["train_sxx"]) == (2, 2.0, 2.0)
    assert (merged["test_n"], merged["test_avgx"]) == (0, None)
    none = R.merge_moments(df.filter("false").groupBy("b").agg(*both)).first()
    assert none["train_n"] == 0


def test_refits_equal_training_at_once(spark, sf_dir, fact, tmp_path):
    for now in (BATCHES[:1], BATCHES[1:3], BATCHES[3:]):
        model = I.refresh_model(fact, str(tmp_path), BATCH, now, TRIP_KEY, method="md5")
    whole = train_fare_model(clean(spark, sf_dir), key=TRIP_KEY, method="md5").first()
    for row in (model.first(), I.current_model(spark, str(tmp_path)).first()):
        assert (row["n_train"], row["n_test"], row["passed"]) == (whole["n_train"], whole["n_test"], whole["passed"])
        assert all(math.isclose(row[c], whole[c], rel_tol=1e-9) for c in ("coef", "intercept", "rmse"))


def test_a_bad_batch_changes_neither_moments_nor_model(spark, fact, tmp_path):
    root = str(tmp_path)
    I.refresh_model(fact, root, BATCH, BATCHES, TRIP_KEY, method="md5")
    hole = fact.withColumn("total_amount", F.when(F.col("trip_id") % 50 != 3, F.col("total_amount")))
    with pytest.raises(QualityError, match="not_null:total_amount"):
        I.refresh_model(hole, root, BATCH, [BATCHES[0]], TRIP_KEY, method="md5")
    with pytest.raises(QualityError, match="present:total_amount"):
        I.refresh_model(fact.drop("total_amount"), root, BATCH, [BATCHES[0]], TRIP_KEY)
    with pytest.raises(QualityError, match="numeric:total_amount"):
        I.refresh_model(fact.withColumn("total_amount", F.lit("x")), root, BATCH, [BATCHES[0]], TRIP_KEY)
    assert V.versions(spark, f"{root}/{I.MOMENTS}") == [0] == V.versions(spark, f"{root}/model")
    with pytest.raises(QualityError, match="not_empty"):
        I.refresh_model(fact.filter("false"), f"{root}/none", BATCH, [BATCHES[0]], TRIP_KEY)
