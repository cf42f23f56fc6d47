import hashlib

import pytest
from pyspark.sql import functions as F

from txnguard.operators import profile, sampling


def digest(key):
    return int(hashlib.md5(str(key).encode()).hexdigest()[:8], 16)


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(4000).select(F.col("id").alias("txn_id"), (F.col("id") % 20 == 0).cast("double").alias("label"))


def test_hash_split_is_independent_of_partitioning(labelled):
    one = sampling.with_hash_split(labelled.coalesce(1))
    many = sampling.with_hash_split(labelled.repartition(13, "label"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    for row in one.limit(50).collect():
        place = digest(row.txn_id) % 10_000
        assert row.split == ("train" if place < 7000 else "validation" if place < 8500 else "test")


def test_splits_cover_all_rows_once(labelled):
    parts = sampling.hash_split(labelled)
    drawn = {r.split: r["count"] for r in sampling.with_random_split(labelled).groupBy("split").count().collect()}
    for counts in ({name: part.count() for name, part in parts.items()}, drawn):
        assert set(counts) == {"train", "validation", "test"}
        assert sum(counts.values()) == 4000
        assert 0.65 < counts["train"] / 4000 < 0.75


@pytest.mark.parametrize("fraction", [0, -0.1, 1.5])
def test_bad_fraction_is_an_error(labelled, fraction):
    with pytest.raises(ValueError):
        sampling.stratified_sample(labelled, fraction)


def test_whole_fraction_keeps_everything(labelled):
    assert sampling.stratified_sample(labelled, None) is labelled
    assert sampling.stratified_sample(labelled, 1) is labelled
    assert 0 < sampling.stratified_sample(labelled, 0.5).count() < 4000


def test_each_split_is_sampled_with_its_own_seed(labelled):
    found = sampling.sample_splits({n: labelled for n in ("train", "validation", "test")}, 0.3, 42)
    rows = [frozenset(r.txn_id for r in part.collect()) for part in found.values()]
    assert len(set(rows)) == 3
    assert rows[1] == frozenset(r.txn_id for r in sampling.stratified_sample(labelled, 0.3, 43).collect())


@pytest.mark.parametrize("per_label", [1, 150, 10_000])
def test_bounded_sample_matches_brute_force(labelled, per_label):
    found = {(r.label, r.txn_id) for r in sampling.bounded_sample(labelled, per_label).collect()}
    wanted = set()
    for label in (0.0, 1.0):
        keys = [i for i in range(4000) if (i % 20 == 0) == (label == 1.0)]
        wanted |= {(label, k) for k in sorted(keys, key=lambda k: (digest(k), k))[:per_label]}
    assert found == wanted


def test_bounded_sample_with_a_hot_group_of_copies(spark):
    copies = spark.range(3000).select(F.lit(7).cast("bigint").alias("txn_id"), F.lit(0.0).alias("label"))
    others = spark.range(100, 500).select(F.col("id").alias("txn_id"), F.lit(0.0).alias("label"))
    found = [r.txn_id for r in sampling.bounded_sample(copies.union(others), 250).collect()]
    pool = [7] * 3000 + list(range(100, 500))
    assert sorted(found) == sorted(sorted(pool, key=lambda k: (digest(k), k))[:250])


def test_bounded_sample_takes_any_number_of_classes(spark):
    many = spark.range(3000).select(F.col("id").alias("txn_id"), (F.col("id") % 1500).alias("label"))
    assert sampling.bounded_sample(many, 1).count() == 1500


def test_sample_keeps_every_class(spark):
    rows = spark.range(9000).select(
        F.col("id").alias("txn_id"), F.when(F.col("id") % 3 < 2, F.col("id") % 3).cast("double").alias("label")
    )
    found = {r.label: r["count"] for r in sampling.stratified_sample(rows, 0.3).groupBy("label").count().collect()}
    assert set(found) == {0.0, 1.0, None} and all(780 < n < 1020 for n in found.values())


def test_first_rows_cut_between_equal_keys(spark):
    rows = spark.range(40).select((F.col("id") % 4).alias("k"), F.col("id"))
    assert [(r.k, r.id) for r in sampling.first_rows(rows, 14, ["k"]).orderBy("k", "id").collect()] == [
        *[(0, i) for i in range(0, 40, 4)],
        *[(1, i) for i in (1, 5, 9, 13)],
    ]


def test_class_weights(labelled):
    found = sampling.class_weights(labelled).first()
    assert (found.total, found.fraud_count) == (4000, 200)
    assert found.weight_fraud == 10.0
    assert found.weight_non_fraud == pytest.approx(4000 / 7600)
    weighted = sampling.add_class_weights(labelled).groupBy("label").agg(F.sum("weight").alias("w"))
    assert [round(r.w, 6) for r in weighted.collect()] == [2000.0, 2000.0]


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_absent_class_has_weight_one(labelled, label):
    found = sampling.class_weights(labelled.withColumn("label", F.lit(label))).first()
    assert {found.weight_fraud, found.weight_non_fraud} == {0.5, 1.0}


def test_first_rows(labelled):
    assert [r.txn_id for r in sampling.first_rows(labelled, 3, ["txn_id"]).collect()] == [0, 1, 2]
    assert sampling.first_rows(labelled, 0, ["txn_id"]).count() == 4000
    with pytest.raises(ValueError):
        sampling.first_rows(labelled, -1, ["txn_id"])


def test_profiles(rows):
    raw = rows({"amount": 10.0}, {"type": None, "amount": 30.0, "isFraud": 1}, {"nameDest": "  ", "amount": None})
    assert profile.null_counts(raw).first().asDict()["amount"] == 1
    assert tuple(profile.blank_counts(raw).first()) == (1, 0, 1)
    assert profile.fraud_rate(raw).first()[0] == pytest.approx(33.333333)
    assert [tuple(r) for r in profile.counts_by_type(raw).collect()] == [(None, 1), ("PAYMENT", 2)]
    assert [tuple(r) for r in profile.fraud_by_type(raw).collect()] == [(None, 1, 30.0), ("PAYMENT", 0, 10.0)]
    assert tuple(profile.dataset_summary(raw).first()) == (3, 1, 2, 0.0)


def test_blacklist_profile_counts_transfers_only(rows):
    raw = rows({"type": " transfer ", "nameDest": " c5 ", "isFraud": 1}, {"type": "DEBIT", "nameDest": "C5"}, {})
    found = [tuple(r)[:3] for r in profile.blacklist_profile(raw, ["c5"]).collect()]
    assert found == [(0, 2, 0), (1, 1, 1)]


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10_001).select(F.col("id").cast("double").alias("amount"))
    found = profile.amount_quantiles_approx(df).first()
    for name, level in profile.AMOUNT_LEVELS.items():
        assert abs(found[name] - level * 10_000) <= 100


def test_file_check(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(3).write.parquet(path)
    found = profile.file_check(spark.read.parquet(path), path).first()
    assert (found.file_count, found.row_count, found.empty_files) == (3, 100, 0)
    spark.range(0).coalesce(1).write.mode("append").parquet(path)
    found = profile.file_check(spark.read.parquet(path), path, ["id", "other"]).first()
    assert (found.file_count, found.row_count, found.empty_files, found.missing_columns) == (4, 100, 1, "other")
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(f"{path}0")
    assert tuple(profile.file_check(spark.read.parquet(f"{path}0"), f"{path}0").first()) == (1, 1, 0, 0, "")
    found = profile.file_check(spark.read.parquet(path).filter("id >= 0"), path).first()
    assert found.total_bytes == sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet") if spark.read.parquet(str(f)).count())
