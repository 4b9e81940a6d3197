"""Splits and folds against a driver-side ranking, also with one row copied very often."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditloom.operators import splits


def frame(spark, hot=0, n=500):
    rows = [(f"k{i}", i % 7, int(i % 3 == 0)) for i in range(n)] + [("hot", 1, 1)] * hot
    return spark.createDataFrame(rows, "k string, x int, label int"), rows


def ranked(rows, label, seed):
    def place(row):
        return hashlib.md5(f"{row[0]}|{row[1]}|{seed}".encode()).hexdigest(), row
    return sorted((r for r in rows if r[2] == label), key=place)


@pytest.mark.parametrize("hot", [0, 300])
def test_split_is_exact(spark, hot):
    df, rows = frame(spark, hot)
    got = splits.stratified_split(df, ["k", "x"], train_ratio=0.8, seed=88)
    sizes = Counter(r[2] for r in rows)
    total = len(rows)
    train_total = total - math.ceil(total * (1 - 0.8))
    ideal = {c: n * train_total / total for c, n in sizes.items()}
    cut = {c: math.floor(v) for c, v in ideal.items()}
    for c in sorted(cut, key=lambda c: (-(ideal[c] - cut[c]), c))[: train_total - sum(cut.values())]:
        cut[c] += 1
    expected = Counter()
    for c in sizes:
        for i, row in enumerate(ranked(rows, c, 88)):
            expected[(*row, "train" if i < cut[c] else "test")] += 1
    assert Counter(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("hot", [0, 700])
def test_folds_are_exact(spark, hot, monkeypatch):
    monkeypatch.setattr(splits, "COPIES_PER_TASK", 16)
    df, rows = frame(spark, hot)
    got = Counter(map(tuple, splits.stratified_folds(df, ["k", "x"], folds=5, seed=1).collect()))
    expected = Counter()
    for c in (0, 1):
        order = ranked(rows, c, 1)
        n, start = len(order), 0
        for fold in range(5):
            size = n // 5 + (fold < n % 5)
            for row in order[start : start + size]:
                expected[(*row, fold)] += 1
            start += size
    assert got == expected


def test_tiny_strata(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 1, 0), ("c", 1, 0)], "k string, x int, label int")
    assert splits.stratified_split(df, ["k", "x"], train_ratio=0.5).count() == 3
    one = splits.stratified_split(df.where("label = 1"), ["k", "x"], train_ratio=0.5).first()
    assert one["split"] == "test"
    assert {r.fold for r in splits.stratified_folds(df, ["k", "x"], folds=3).collect()} <= {0, 1, 2}


def test_sample(spark):
    df, rows = frame(spark, n=5000)
    assert splits.stratified_sample(df, "label", 1.0).count() == 5000
    got = Counter(r.label for r in splits.stratified_sample(df, "label", 0.3, 42).collect())
    assert abs(got[0] / 3333 - 0.3) < 0.05 and abs(got[1] / 1667 - 0.3) < 0.05
    single = splits.stratified_sample(df.where(F.col("label") == 1), "label", 0.3).count()
    assert 300 < single < 700


def test_rows_without_stratum_are_split_too(spark):
    df = spark.range(60).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") < 40, F.lit(1)).alias("label"))
    got = splits.stratified_split(df, ["k"], train_ratio=0.8)
    sizes = {(r.label, r.split): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert sizes == {(1, "train"): 32, (1, "test"): 8, (None, "train"): 16, (None, "test"): 4}
    folds = splits.stratified_folds(df, ["k"], folds=5).where("label is null").groupBy("fold").count().collect()
    assert [r["count"] for r in folds] == [4] * 5
    assert 0 < splits.stratified_sample(df, "label", 0.5).where("label is null").count() < 20
