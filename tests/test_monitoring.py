"""Quantiles, PSI, KS and AUC against numpy and brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import distribution, drift, metrics


def scores(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "model_predictions double")


def numpy_psi(expected, actual, eps=1e-8):
    breaks = np.unique(np.quantile(expected, np.linspace(0, 1, 11)))
    if len(breaks) == 1:
        breaks = np.repeat(breaks, 2)
    b, _ = np.histogram(expected, breaks)
    c, _ = np.histogram(actual, breaks)
    b, c = b / (b.sum() + eps), c / (c.sum() + eps)
    b, c = np.where(b == 0, eps, b), np.where(c == 0, eps, c)
    return float(np.sum((b - c) * np.log(b / c)))


rng = np.random.default_rng(5)
SAMPLES = {
    "plain": (rng.random(700), rng.random(300) ** 1.3),
    "ties": (rng.integers(0, 6, 500) / 5, rng.integers(0, 9, 400) / 8),
    "hot": (np.r_[np.full(400, 0.25), rng.random(200)], np.r_[np.full(10, 0.25), rng.random(200)]),
    "constant": (np.full(50, 0.5), np.full(20, 0.5)),
    "apart": (np.full(50, 0.5), np.full(20, 0.7)),
    "outside": (rng.random(100), rng.random(100) * 3 - 1),
    "small": (np.array([0.1, 0.4, 0.2]), np.array([0.3, 0.35])),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_drift_matches_numpy(spark, name):
    base, current = SAMPLES[name]
    totals = drift.paired_totals(scores(spark, base), scores(spark, current))
    assert drift.psi(totals).first().psi == pytest.approx(numpy_psi(base, current), abs=1e-9)
    grid = np.unique(np.r_[base, current])
    gap = max(abs((base <= v).mean() - (current <= v).mean()) for v in grid)
    ks = drift.ks(totals).first()
    assert ks.ks_stat == pytest.approx(gap, abs=1e-12) and 0 <= ks.ks_pvalue <= 1
    rows = drift.decile_diff(totals).orderBy("decile").collect()
    assert [r.base for r in rows] == pytest.approx(np.quantile(base, np.linspace(0, 1, 11)))
    assert [r.current for r in rows] == pytest.approx(np.quantile(current, np.linspace(0, 1, 11)))


def test_same_scores_do_not_drift(spark):
    same = scores(spark, SAMPLES["plain"][0])
    totals = drift.paired_totals(same, same)
    assert drift.psi(totals).first().psi == pytest.approx(0)
    assert drift.ks(totals).first().ks_stat == 0


def test_empty_side_gives_no_index_and_unknown_alert(spark):
    totals = drift.paired_totals(scores(spark, [0.1, 0.2]), scores(spark, []))
    row = drift.alert(drift.psi(totals)).first()
    assert np.isnan(row.psi) and (row.alert, row.exit_code) == ("unknown", 0)
    assert drift.ks(totals).first().ks_stat is None


def test_alert_levels(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.29,), (0.3,), (None,)], "psi double")
    rows = [(r.alert, r.exit_code) for r in drift.alert(df).collect()]
    assert rows == [("ok", 0), ("warning", 1), ("warning", 1), ("critical", 2), ("unknown", 0)]


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + (pos[:, None] == neg).sum() / 2) / (len(pos) * len(neg))


def test_auc_with_ties_by_group(spark):
    y, s, g = rng.integers(0, 2, 600), rng.integers(0, 20, 600) / 19, rng.integers(0, 3, 600)
    df = spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, s, g)], "label int, score double, g int")
    for r in distribution.roc_auc(df, "score", "label", ("g",)).collect():
        assert r.roc_auc == pytest.approx(brute_auc(y[g == r.g], s[g == r.g]))
    whole = distribution.roc_auc(df, "score", "label").first().roc_auc
    flipped = distribution.roc_auc(df.withColumn("score", 1 - F.col("score")), "score", "label").first().roc_auc
    assert whole == pytest.approx(brute_auc(y, s)) and flipped == pytest.approx(1 - whole)
    row = metrics.classification_metrics(df, "score", "label").first()
    hit = s >= 0.5
    assert row.true_positives == int((hit & (y == 1)).sum()) and row.true_negatives == int((~hit & (y == 0)).sum())
    assert row.balanced_accuracy == pytest.approx(brute_auc(y, hit.astype(float)))


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.8)], "label int, score double")
    row = metrics.classification_metrics(df, "score", "label").first()
    assert row.roc_auc is None and row.recall == 0.5 and row.precision == 1.0


def test_label_metrics_counts_every_label_and_the_unlabelled(spark):
    day = dt.date(2024, 1, 1)
    p = spark.createDataFrame([("a", day, 0.9), ("b", day, 0.2), ("z", day, 0.5)],
                              "Customer_ID string, snapshot_date date, model_predictions double")
    t = spark.createDataFrame([("a", day, 1)] * 3 + [("a", day, 0), ("b", day, 0)],
                              "Customer_ID string, snapshot_date date, label int")
    row = metrics.label_metrics(p, t, "model_predictions").first()
    assert (row.precision, row.recall, row.unlabelled) == (0.75, 1.0, 1)
    assert row.roc_auc == pytest.approx((1 + 0.5) / 2)


def test_score_column_choice(spark):
    def chosen(columns):
        return drift.score_column(spark.createDataFrame([], columns))

    assert chosen("Customer_ID string, prob_x double, Score double") == "prob_x"
    assert chosen("a string, Model_Predictions double, proba double") == "Model_Predictions"
    assert chosen("id int, Customer_ID string, x string, y float") == "y"
    with pytest.raises(KeyError):
        chosen("id int, x string")
    with pytest.raises(ValueError):
        drift.read_scores(spark.createDataFrame([("a",)], "score string"))


def test_prediction_lookup(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("m", day, 0.1), ("m.pkl", day, 0.2)], "model_name string, snapshot_date date, p double")
    assert drift.find_predictions(df, "m.pkl", "2024-01-01").first().p == 0.2
    assert drift.find_predictions(df.where("p < 0.15"), "m.pkl", "2024-01-01").first().p == 0.1
    with pytest.raises(FileNotFoundError):
        drift.find_predictions(df, "m.pkl", "2024-02-01")


def test_retrain(spark):
    runs = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2023, 1, 1),)], "start_time timestamp")
    assert drift.retrain_needed(runs, "2024-03-01").first().retrain is False
    assert drift.retrain_needed(runs, "2024-05-01").first().retrain is True
    assert drift.retrain_needed(runs.limit(0), "2024-05-01").first().retrain is True


def test_lookup_never_takes_another_model(spark):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("m_gbt", day, 0.1), ("mm", day, 0.2)], "model_name string, snapshot_date date, p double")
    with pytest.raises(FileNotFoundError):
        drift.find_predictions(df, "m", "2024-01-01")


def test_unscored_rows_count_as_below_the_threshold(spark):
    rows = [(1, 0.9, "a"), (0, 0.1, "a"), (1, None, None), (1, float("nan"), None), (None, 0.3, "a")]
    df = spark.createDataFrame(rows, "label int, score double, g string")
    row = metrics.classification_metrics(df, "score", "label").first()
    assert (row.true_positives, row.true_negatives, row.false_negatives, row.unscored) == (1, 1, 2, 2)
    assert row.recall == pytest.approx(1 / 3) and row.roc_auc == 1.0
    by = {r.g: r for r in metrics.classification_metrics(df, "score", "label", by=("g",)).collect()}
    assert by[None].false_negatives == 2 and by[None].roc_auc is None and by["a"].unscored == 0


def test_ranges_are_even_however_rows_are_shared(spark):
    """Nearly all rows on few values: the cuts still part the distinct values evenly."""
    few = spark.range(40_000).select((F.col("id") % 7 / 1000).alias("v"))
    many = spark.range(10_000).select((F.col("id") / 10_000 + 0.01).alias("v"))
    distinct = few.unionByName(many).distinct()
    cuts = distribution.range_cuts(distinct, "v")
    sizes = np.histogram([r.v for r in distinct.collect()], [-np.inf, *cuts, np.inf])[0]
    assert sizes.max() <= 2 * 10_007 / 64
    totals = distribution.running_totals(few.unionByName(many), "v", {"n": F.lit(1)})
    assert tuple(totals.agg(F.max(F.col("n_below") + F.col("n")), F.max("n_total")).first()) == (50_000, 50_000)
