import pytest
from pyspark.sql import functions as F

from tablewright.functions.hashing import key_hash, multiplicative_hash
from tablewright.operators.sampling import SAMPLE_SEED, bernoulli_sample, hash_sample, hash_split, random_split, sample_n, with_fold


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(20_000).withColumnRenamed("id", "k")


@pytest.mark.parametrize("method", ["xxhash64", "multiplicative"])
def test_sample_does_not_depend_on_partitioning(keyed, rows, method):
    one = rows(hash_sample(keyed.repartition(1), "k", 0.2, method=method))
    many = rows(hash_sample(keyed.repartition(13), "k", 0.2, method=method))
    assert one == many
    assert 0.18 < len(one) / 20_000 < 0.22


@pytest.mark.parametrize("method", ["xxhash64", "multiplicative"])
def test_split_is_disjoint_and_complete(keyed, method):
    a, b, c = hash_split(keyed, "k", [6, 2, 2], method=method)
    assert a.count() + b.count() + c.count() == 20_000
    assert a.union(b).union(c).distinct().count() == 20_000
    assert 0.57 < a.count() / 20_000 < 0.63


def test_folds_are_even_also_inside_a_split(keyed):
    training, _ = hash_split(keyed, "k", [0.8, 0.2])
    counts = [r["count"] for r in with_fold(training, "k", 3).groupBy("fold").count().collect()]
    assert len(counts) == 3
    assert max(counts) / min(counts) < 1.1


def test_sample_n_is_exact_and_stable(keyed, rows):
    first = rows(sample_n(keyed.repartition(3), "k", 150))
    assert len(first) == 150
    assert first == rows(sample_n(keyed.repartition(9), "k", 150))
    assert sample_n(keyed.limit(10), "k", 150).count() == 10


def test_text_keys(spark):
    df = spark.range(5000).selectExpr("concat('key', id) AS k")
    assert 0.16 < hash_sample(df, "k", 0.2).count() / 5000 < 0.24
    with pytest.raises(ValueError):
        hash_sample(df, "k", 0.2, method="other")


def test_keyless_sample_and_split(keyed):
    assert 0.17 < bernoulli_sample(keyed, 0.2).count() / 20_000 < 0.23
    first, second = random_split(keyed, [0.8, 0.2])
    assert first.count() + second.count() == 20_000


@pytest.mark.parametrize("n", [1, 777, 10_000, 19_999, 20_000, 30_000, 0])
@pytest.mark.parametrize("method", ["xxhash64", "multiplicative"])
def test_samples_of_any_size_hold_the_smallest_hashes(spark, keyed, n, method):
    hashed = key_hash("k", seed=SAMPLE_SEED) if method == "xxhash64" else multiplicative_hash("k", SAMPLE_SEED)
    expected = sorted((r["h"], r["k"]) for r in keyed.select("k", hashed.alias("h")).collect())[:n]
    found = sample_n(keyed.repartition(5), "k", n, method=method, few=50)
    assert sorted(r["k"] for r in found.collect()) == sorted(k for _, k in expected)


def test_samples_that_cut_through_equal_keys_and_rows(spark, rows):
    """A hot key, null keys and equal rows: always exactly n rows, by the given order."""
    df = spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 5 = 0 THEN NULL ELSE id END AS k", "id % 100 AS v", "id % 2 AS _place")
    for method in ("xxhash64", "multiplicative"):
        for n in (50, 300, 450, 899):
            found = sample_n(df, "k", n, method=method, order_by=["v"], few=10)
            assert found.columns == df.columns and found.count() == n and found.exceptAll(df).isEmpty()
            assert rows(found) == rows(sample_n(df.repartition(7), "k", n, method=method, order_by=["v"], few=100_000))
    assert sample_n(df.where("false"), "k", 5).count() == 0


def test_no_task_gathers_a_large_sample(spark):
    parts = sample_n(spark.range(40_000).repartition(8), "id", 20_000, few=100).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 4_000


def test_draws_of_different_seeds_differ_under_either_hash(keyed):
    for method in ("xxhash64", "multiplicative"):
        training, _ = hash_split(keyed, "k", [0.8, 0.2], method=method)
        counts = [r["count"] for r in with_fold(training, "k", 3, method=method).groupBy("fold").count().collect()]
        assert len(counts) == 3 and max(counts) / min(counts) < 1.1
        sampled = hash_sample(keyed, "k", 0.2, method=method)
        kept = hash_split(sampled, "k", [0.5, 0.5], method=method)[0].count()
        assert 0.45 < kept / sampled.count() < 0.55
