"""Samples: exact, by brute force, and the same however the rows are partitioned."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tripmill.functions import keys as K
from tripmill.operators import sample as S


def brute_force(rows, n, seed=42):
    ranked = sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0], r[1]))
    return sorted(value for _, value in ranked[:n])


@pytest.fixture(scope="module")
def rows():
    return [(i, i % 17) for i in range(5000)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v long").repartition(6).cache()


@pytest.mark.parametrize("n,seed", [(0, 42), (1, 42), (10, 7), (333, 42), (333, 7), (5000, 42), (9999, 42)])
def test_sample_is_the_brute_force_one(frame, rows, n, seed):
    got = S.sample_n(frame, n, ["id"], ["v"], seed)
    assert sorted(r["v"] for r in got.collect()) == brute_force(rows, n, seed)


def test_sample_does_not_depend_on_partitions(frame):
    once = S.sample_n(frame, 100, ["id"], ["id", "v"]).collect()
    again = S.sample_n(frame.repartition(13, "v"), 100, ["id"], ["id", "v"]).collect()
    assert once == again


def test_sample_of_nothing(frame):
    assert S.sample_n(frame.filter("id < 0"), 10, ["id"], ["v"]).collect() == []


def test_one_hot_key(spark):
    """All rows share a rank: the bound lets them all through, the size holds."""
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id"))
    got = [r["id"] for r in S.sample_n(df, 10, ["k"], ["id"]).collect()]
    assert got == list(range(10))


@pytest.mark.parametrize("n", [5, 200, 1500, 4000])
def test_a_third_of_the_rows_are_copies_of_one(spark, n):
    rows = [(i, i % 17) if i % 3 else (0, 0) for i in range(3000)]
    got = S.sample_n(spark.createDataFrame(rows, "id long, v long"), n, ["id"], ["v"]).collect()
    assert sorted(r["v"] for r in got) == brute_force(rows, n)


def test_copies_are_counted_before_they_are_shuffled(spark, plan):
    copies = spark.range(2, 100_000, numPartitions=4).select(
        F.least("id", F.lit(0)).alias("id"), F.least("id", F.lit(1)).alias("v")
    )
    text = plan(S.take_sample(copies, 50, ["id"], ["v"]))
    tree = text.split("\n\n\n")[0]
    assert tree.index("TakeOrderedAndProject") < tree.index("Exchange")
    assert "partial_count" in text
    assert S.take_sample(copies, 50, ["id"], ["v"]).count() == 50


def test_few_rows_reach_the_last_task(frame):
    for n in (10, 100, 1000):
        candidates = S.sample_candidates(frame, [(n, F.lit(True))], ["id"], ["v"]).count()
        assert n <= candidates <= 4 * n + 20


def test_two_samples_from_one_pair_of_passes(frame):
    wanted = [(50, F.col("v") < 10), (20, F.col("v") > 5)]
    candidates = S.sample_candidates(frame, wanted, ["id"], ["v"])
    for n, condition in wanted:
        together = S.take_sample(candidates.filter(condition), n, ["id"], ["v"]).collect()
        alone = S.sample_n(frame.filter(condition), n, ["id"], ["v"]).collect()
        assert together == alone


def test_two_samples_count_their_classes_once(spark, frame):
    context = spark.sparkContext

    def jobs(wanted):
        group = f"samples-{len(wanted)}"
        context.setJobGroup(group, group)
        S.sample_candidates(frame, wanted, ["id"], ["v"]).collect()
        return len(context.statusTracker().getJobIdsForGroup(group))

    one, other = (50, F.col("v") < 10), (20, F.col("v") > 5)
    assert jobs([one, other]) == jobs([one])


@pytest.mark.parametrize("method", ["md5", "xxhash64"])
def test_magnitude_follows_the_ranks(frame, method):
    rank = K.rank(["id"], method=method)
    ranked = frame.select(rank.alias("r")).withColumn("m", K.magnitude("r", method))
    found = [r["m"] for r in ranked.orderBy("r").collect()]
    assert found == sorted(found) and 0 <= found[0] and found[-1] == K.CLASSES
    below = F.col("r") < K.ceiling(F.col("m"), method)
    not_lower = (F.col("m") == 0) | (F.col("r") >= K.ceiling(F.col("m") - 1, method))
    assert ranked.filter(~(below & not_lower)).isEmpty()


def test_magnitude_counts_leading_zero_bits(spark):
    texts = {"8" * 32: 40, "4" + "f" * 31: 39, "1" * 32: 37, "0f" * 16: 36, "0" * 10 + "f" * 22: 0}
    df = spark.createDataFrame(list(texts.items()), "d string, m int")
    assert all(a == b for a, b in df.select("m", K.magnitude("d")).collect())


def test_number_ranks_give_exact_samples_too(frame):
    """Against a plain sort by the same rank."""
    rank = K.rank(["id"], 42, "xxhash64")
    for n in (1, 40, 700, 6000):
        got = S.sample_n(frame, n, ["id"], ["id"], method="xxhash64").collect()
        assert got == frame.orderBy(rank).limit(n).select("id").collect()
    assert 900 < S.sample_fraction(frame, 0.2, ["id"], method="xxhash64").count() < 1100
    with pytest.raises(ValueError, match="hash"):
        K.rank(["id"], method="crc")


def test_fraction(frame):
    assert 900 < S.sample_fraction(frame, 0.2, ["id"]).count() < 1100
    for bad in (0.0, 1.0):
        with pytest.raises(ValueError):
            K.in_fraction(["id"], bad)


def test_small_fractions_select_something():
    for method, bits in (("md5", 128), ("xxhash64", 62)):
        bound = K.fraction_bound(1e-10, method)
        number = int(bound, 16) if method == "md5" else bound
        assert 0 < number and abs(number / 2**bits - 1e-10) < 1e-18
        with pytest.raises(ValueError, match="below"):
            K.in_fraction(["id"], 2.0 ** -(bits + 1), method=method)
    assert len(K.fraction_bound(1e-10)) == 32


def test_rows_of_one_hot_key_are_spread_by_their_columns(spark):
    df = spark.range(20_000, numPartitions=4).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    few = S.sample_candidates(df, [(50, F.lit(True))], ["k"], ["v"], method="xxhash64")
    assert 50 <= few.count() <= 300
    assert S.sample_n(df, 50, ["k"], ["v"], method="xxhash64").distinct().count() == 50
