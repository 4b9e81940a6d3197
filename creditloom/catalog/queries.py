"""The registered queries: name -> function of (spark, warehouse folder)."""

from collections.abc import Callable
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.catalog.lake import Lake, settle
from creditloom.operators import (
    boosting, distribution, drift, features, labels, metrics, modelling, profile, silver, splits,
)
from creditloom.operators.joins import many_to_one
from creditloom.plans import monitoring, scoring, training
from creditloom.sources import calendar, footers, tables
from creditloom.sources.raw import SCORE_MODEL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered runs.
TRAIN_DATE = "1998-12-01"
SNAPSHOT = "1998-12-01"
BASELINE = "1998-06-01"
FIRST_MONTH, LAST_MONTH = "1997-01-01", "1998-12-01"
ROW_KEY = ["loan_id", "Customer_ID", "snapshot_date", "mob", "dpd"]
LABEL_KEYS = ["loan_id", "Customer_ID", "snapshot_date"]


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Register under the function's name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Lake(spark, sf_dir))
    return build


# -- sources, sinks, snapshots ----------------------------------------------------------------


@query
def csv_round_trip(lake: Lake) -> DataFrame:
    path = tables.shared_dir(lake.spark, "csv")
    tables.write_csv(lake.raw["financials"], path, "financials")
    return tables.read_csv(lake.spark, path, "financials")


@query
def bronze_ingest(lake: Lake) -> DataFrame:
    """All four sources written as text by one job each, counted from the written copy."""
    root = tables.shared_dir(lake.spark, "bronze")
    written = {}
    for name, df in lake.raw.items():
        tables.write_csv(df, f"{root}/{name}", name)
        written[name] = tables.read_csv(lake.spark, f"{root}/{name}", name)
    return profile.table_profile(written)


@query
def bronze_snapshot_filter(lake: Lake) -> DataFrame:
    return tables.at_snapshot(lake.raw["loan_daily"], SNAPSHOT)


@query
def parquet_partition_scan(lake: Lake) -> DataFrame:
    path = tables.shared_dir(lake.spark, "silver-loan")
    tables.write_snapshots(lake.strip_first["loan_daily"], path)
    return tables.read_table(lake.spark, path, SNAPSHOT).select(*lake.strip_first["loan_daily"].columns)


@query
def multi_path_scan(lake: Lake) -> DataFrame:
    path = tables.shared_dir(lake.spark, "labels")
    tables.write_snapshots(lake.labels, path)
    months = [f"{path}/snapshot_date={month}" for month in (BASELINE, SNAPSHOT)]
    return tables.read_paths(lake.spark, months, root=path).select(*lake.labels.columns)


@query
def partition_overwrite(lake: Lake) -> DataFrame:
    """Write every snapshot, then rewrite one of them; the others stay."""
    path = tables.shared_dir(lake.spark, "predictions")
    by = ("model_name", "snapshot_date")
    tables.write_snapshots(lake.predictions, path, by)
    revised = tables.at_snapshot(lake.predictions, SNAPSHOT).withColumn(
        "model_predictions", 1 - F.col("model_predictions")
    )
    tables.write_snapshots(revised, path, by)
    return settle(tables.read_table(lake.spark, path).select(*lake.predictions.columns), 6)


@query
def full_overwrite(lake: Lake) -> DataFrame:
    """A second write replaces the whole table."""
    path = tables.shared_dir(lake.spark, "labels")
    tables.write_table(lake.labels, path)
    tables.write_table(tables.between_snapshots(lake.labels, FIRST_MONTH, LAST_MONTH), path)
    return tables.read_table(lake.spark, path).select(*lake.labels.columns)


@query
def month_spine(lake: Lake) -> DataFrame:
    return calendar.months_covered(lake.raw["loan_daily"], "loan_start_date", "snapshot_date")


@query
def backfill_all_snapshots(lake: Lake) -> DataFrame:
    """Labels of every month of the spine, written by one job, counted per snapshot."""
    spine = calendar.month_spine(lake.spark, FIRST_MONTH, LAST_MONTH)
    path = tables.shared_dir(lake.spark, "backfill")
    tables.write_snapshots(lake.labels.join(F.broadcast(spine), "snapshot_date", "left_semi"), path)
    return (
        tables.read_table(lake.spark, path)
        .groupBy("snapshot_date")
        .agg(F.count("*").alias("n_rows"), F.sum("label").alias("n_defaults"))
    )


@query
def available_tables(lake: Lake) -> DataFrame:
    return tables.availability(lake.strip_first, SNAPSHOT)


@query
def prediction_lookup(lake: Lake) -> DataFrame:
    return settle(drift.find_predictions(lake.predictions, SCORE_MODEL, SNAPSHOT), 6)


@query
def table_profile(lake: Lake) -> DataFrame:
    return profile.table_profile(lake.strip_first)


@query
def stored_profile(lake: Lake) -> DataFrame:
    """Counts, NULLs and extremes of the stored ledger, from footers."""
    path = tables.shared_dir(lake.spark, "silver-loan")
    tables.write_snapshots(lake.strip_first["loan_daily"], path)
    return settle(footers.stored_profile(lake.spark, path), 6)


@query
def table_head(lake: Lake) -> DataFrame:
    order = ["snapshot_date", "Customer_ID", "loan_id", "mob", "dpd"]
    return profile.head(lake.labels, 10, order)


# -- cleansing --------------------------------------------------------------------------------


@query
def schema_enforce_v1(lake: Lake) -> DataFrame:
    return silver.enforce_early(lake.raw["financials"], "financials")


@query
def schema_enforce_v2(lake: Lake) -> DataFrame:
    return silver.enforce_late(lake.raw["financials"], "financials")


@query
def silver_clickstream(lake: Lake) -> DataFrame:
    return lake.strip_first["clickstream"]


@query
def silver_attributes(lake: Lake) -> DataFrame:
    return lake.strip_first["attributes"]


@query
def silver_age_v1(lake: Lake) -> DataFrame:
    return lake.cast_first["attributes"].select("Customer_ID", "snapshot_date", "Age")


@query
def silver_age_v2(lake: Lake) -> DataFrame:
    return lake.strip_first["attributes"].select("Customer_ID", "snapshot_date", "Age")


@query
def silver_financials_v1(lake: Lake) -> DataFrame:
    return lake.cast_first["financials"]


@query
def silver_financials_v2(lake: Lake) -> DataFrame:
    return lake.strip_first["financials"]


@query
def silver_financials_clean(lake: Lake) -> DataFrame:
    return silver.financials_clean(lake.raw["financials"])


@query
def credit_history_months(lake: Lake) -> DataFrame:
    return lake.strip_first["financials"].select("Customer_ID", "snapshot_date", "Credit_History_Age")


@query
def impute_median(lake: Lake) -> DataFrame:
    wanted = ["Monthly_Inhand_Salary", "Num_of_Delayed_Payment", "Changed_Credit_Limit"]
    typed = silver.enforce_early(lake.raw["financials"], "financials")
    return silver.impute_median(typed.select("Customer_ID", "snapshot_date", *wanted), wanted)


@query
def loan_mob(lake: Lake) -> DataFrame:
    return silver.on_book(lake.raw["loan_daily"]).select("loan_id", "Customer_ID", "snapshot_date", "mob")


@query
def loan_dpd_calendar(lake: Lake) -> DataFrame:
    dated = silver.with_calendar_dpd(silver.on_book(lake.raw["loan_daily"]))
    return dated.select("loan_id", "Customer_ID", "snapshot_date", "installments_missed", "first_missed_date", "dpd")


@query
def loan_dpd_payment(lake: Lake) -> DataFrame:
    paid = silver.with_payment_dpd(silver.on_book(lake.raw["loan_daily"]))
    return paid.select("loan_id", "Customer_ID", "snapshot_date", "monthly_payment", "dpd")


@query
def silver_loan_v1(lake: Lake) -> DataFrame:
    return lake.cast_first["loan_daily"]


@query
def silver_loan_v2(lake: Lake) -> DataFrame:
    return lake.strip_first["loan_daily"]


# -- labels and features ----------------------------------------------------------------------


@query
def label_store(lake: Lake) -> DataFrame:
    return lake.labels


@query
def label_store_v1(lake: Lake) -> DataFrame:
    return lake.calendar_labels


@query
def label_distribution(lake: Lake) -> DataFrame:
    return labels.label_distribution(lake.labels)


@query
def customer_base(lake: Lake) -> DataFrame:
    return features.customer_base(lake.strip_first)


@query
def loan_type_multihot(lake: Lake) -> DataFrame:
    hot = features.multi_hot(lake.strip_first["financials"], features.LOAN_PRODUCTS)
    return hot.select("Customer_ID", "snapshot_date", *features.product_columns(hot))


@query
def loan_type_multihot_v1(lake: Lake) -> DataFrame:
    hot = features.multi_hot(lake.strip_first["financials"], features.LOAN_PRODUCTS_SHORT)
    return hot.select("Customer_ID", "snapshot_date", *features.product_columns(hot))


@query
def loan_features(lake: Lake) -> DataFrame:
    return settle(features.loan_features(lake.strip_first["loan_daily"]))


@query
def loan_features_v1(lake: Lake) -> DataFrame:
    return settle(features.loan_features_with_spread(lake.cast_first["loan_daily"]))


@query
def dpd_std_window(lake: Lake) -> DataFrame:
    spread = features.dpd_spread(lake.cast_first["loan_daily"])
    return settle(spread.select("loan_id", "Customer_ID", "snapshot_date", "dpd", "loan_days_past_due_std"))


@query
def clickstream_features(lake: Lake) -> DataFrame:
    return settle(features.click_features(lake.strip_first["clickstream"]))


@query
def clickstream_features_v1(lake: Lake) -> DataFrame:
    return settle(features.click_features_short(lake.cast_first["clickstream"]))


@query
def feature_store(lake: Lake) -> DataFrame:
    return settle(lake.features)


@query
def feature_store_v1(lake: Lake) -> DataFrame:
    return settle(features.labelled_feature_store(lake.cast_first, lake.calendar_labels))


@query
def dedup_features(lake: Lake) -> DataFrame:
    """Clickstream rows repeat keys; one row per key is kept."""
    return features.dedup_features(lake.strip_first["clickstream"])


# -- profiling --------------------------------------------------------------------------------


@query
def null_profile(lake: Lake) -> DataFrame:
    return profile.null_profile(lake.features)


@query
def date_coverage(lake: Lake) -> DataFrame:
    return profile.date_coverage(lake.labels)


@query
def bad_rate_by_mob(lake: Lake) -> DataFrame:
    return settle(labels.bad_rate_by_mob(lake.strip_first["loan_daily"], started_before="1998-01-01"), 6)


@query
def installment_bads(lake: Lake) -> DataFrame:
    """Instalment numbers run to 7 here, so the last one stands for the tenth."""
    bads = labels.instalment_bads(lake.strip_first["loan_daily"], installment=7, started_before="1998-01-01")
    return bads.select("loan_id", "Customer_ID", "snapshot_date", "installment_num", "dpd", "dpd_flag")


# -- datasets ---------------------------------------------------------------------------------


@query
def training_set(lake: Lake) -> DataFrame:
    return settle(modelling.training_set(lake.labels, lake.features))


@query
def snapshot_range_filter(lake: Lake) -> DataFrame:
    return tables.between_snapshots(lake.labels, FIRST_MONTH, LAST_MONTH)


@query
def feature_snapshot(lake: Lake) -> DataFrame:
    return settle(tables.at_snapshot(lake.features, SNAPSHOT))


@query
def time_splits(lake: Lake) -> DataFrame:
    tagged = calendar.tag_windows(lake.labels, calendar.four_windows(TRAIN_DATE))
    return tagged.select(*LABEL_KEYS, "label", "split")


@query
def oot_split(lake: Lake) -> DataFrame:
    tagged = calendar.tag_windows(lake.labels, calendar.month_windows(TRAIN_DATE))
    return tagged.select(*LABEL_KEYS, "label", "split")


def train_test_rows(lake: Lake) -> DataFrame:
    window = calendar.month_windows(TRAIN_DATE)[1]
    rows = lake.labels.where(window.covers(F.col("snapshot_date"))).select(*ROW_KEY, "label")
    return tables.materialise(rows, "train-test-rows")


@query
def stratified_split(lake: Lake) -> DataFrame:
    return splits.stratified_split(train_test_rows(lake), ROW_KEY)


@query
def stratified_folds(lake: Lake) -> DataFrame:
    return splits.stratified_folds(tables.materialise(lake.labels.select(*ROW_KEY, "label"), "fold-rows"), ROW_KEY)


@query
def stratified_sample(lake: Lake) -> DataFrame:
    return splits.stratified_sample(lake.labels, "label", 0.3)


def monthly_splits(lake: Lake) -> DataFrame:
    """Labels of the monthly model tagged train, test or oot."""
    oot = calendar.month_windows(TRAIN_DATE)[0]
    held_out = lake.labels.where(oot.covers(F.col("snapshot_date"))).select(*ROW_KEY, "label", F.lit("oot").alias("split"))
    return splits.stratified_split(train_test_rows(lake), ROW_KEY).unionByName(held_out)


@query
def split_stats(lake: Lake) -> DataFrame:
    return settle(splits.split_stats(monthly_splits(lake)), 6)


@query
def label_normalise(lake: Lake) -> DataFrame:
    """Labels kept as day values 0 and 30 under another name, brought back to 0/1."""
    days = lake.labels.select(*LABEL_KEYS, (F.col("label") * 30).alias("is_default"))
    return labels.normalise_label(days)


@query
def model_matrix(lake: Lake) -> DataFrame:
    data = modelling.training_set(lake.labels, lake.features)
    matrix = modelling.model_matrix(data, modelling.monthly_features(data), keep=LABEL_KEYS)
    return settle(matrix)


# -- monitoring -------------------------------------------------------------------------------


def score_pair(lake: Lake) -> tuple[DataFrame, DataFrame]:
    both = lake.predictions.where(F.col("snapshot_date").isin(BASELINE, SNAPSHOT))
    stored = tables.materialise(both, "score-pair")
    return tables.at_snapshot(stored, BASELINE), tables.at_snapshot(stored, SNAPSHOT)


@query
def prediction_column(lake: Lake) -> DataFrame:
    """Scores as text under another name, recognised and brought back."""
    odd = lake.predictions.select(
        "Customer_ID", "snapshot_date", F.round("model_predictions", 6).cast("string").alias("Default_Probability_v2")
    )
    return settle(drift.read_scores(odd), 6)


@query
def prediction_summary(lake: Lake) -> DataFrame:
    summary = drift.summarise(drift.paired(*score_pair(lake)))
    deciles = [F.col("deciles")[i].alias(name) for i, name in enumerate(drift.decile_names())]
    return settle(summary.select("side", "count", "mean", "std", "min", "max", "median", *deciles), 6)


@query
def decile_diff(lake: Lake) -> DataFrame:
    return settle(drift.decile_diff(drift.paired_totals(*score_pair(lake))), 6)


@query
def psi(lake: Lake) -> DataFrame:
    return settle(drift.psi(drift.paired_totals(*score_pair(lake))), 6)


@query
def ks_statistic(lake: Lake) -> DataFrame:
    return settle(drift.ks(drift.paired_totals(*score_pair(lake))), 6)


@query
def ks_limit(lake: Lake) -> DataFrame:
    """The same with the limit's p-value, as for samples too large for the exact one."""
    return settle(drift.ks(drift.paired_totals(*score_pair(lake)), exact_rows=0), 6)


@query
def drift_alert(lake: Lake) -> DataFrame:
    return settle(drift.alert(drift.psi(drift.paired_totals(*score_pair(lake)))), 6)


def scored_labels(lake: Lake) -> DataFrame:
    scored = many_to_one(lake.labels.select(*LABEL_KEYS, "label"), lake.predictions)
    return tables.materialise(scored.select("snapshot_date", "label", "model_predictions"), "scored-labels")


@query
def roc_auc(lake: Lake) -> DataFrame:
    return settle(distribution.roc_auc(scored_labels(lake), "model_predictions", "label"), 6)


@query
def classification_metrics(lake: Lake) -> DataFrame:
    return settle(metrics.classification_metrics(scored_labels(lake), "model_predictions", "label"), 6)


@query
def auc_gini_by_split(lake: Lake) -> DataFrame:
    tagged = calendar.tag_windows(scored_labels(lake), calendar.four_windows(TRAIN_DATE))
    return settle(metrics.auc_gini(tagged, "model_predictions", "label"), 6)


@query
def label_metrics(lake: Lake) -> DataFrame:
    current = tables.materialise(tables.at_snapshot(lake.predictions, SNAPSHOT), "current-scores")
    return settle(metrics.label_metrics(current, tables.at_snapshot(lake.labels, SNAPSHOT), "model_predictions"), 6)


@query
def retrain_needed(lake: Lake) -> DataFrame:
    """Every scored month counts as a run of its model."""
    runs = lake.predictions.select("model_name", F.col("snapshot_date").alias("start_time"))
    return drift.retrain_needed(runs, as_of="1999-03-15")


# -- model inputs -----------------------------------------------------------------------------


def tuned_data(lake: Lake) -> DataFrame:
    """Training set of the tuned models, tagged train, val, test or oot."""
    windows = calendar.four_windows(TRAIN_DATE)
    return modelling.training_set(
        calendar.tag_windows(lake.labels, windows), calendar.tag_windows(lake.features, windows).drop("split")
    )


@query
def scaled_features(lake: Lake) -> DataFrame:
    """Inputs of the monthly model, standardised with the parameters of the train window."""
    data = tables.materialise(tuned_data(lake), "tuned-rows")
    inputs = modelling.monthly_features(data)
    parameters = modelling.scale_parameters(data.where(F.col("split") == "train"), inputs)
    scaled = modelling.scale(data, parameters)
    return settle(scaled.select(*LABEL_KEYS, "split", *[modelling.named(c) for c in inputs]), 5)


@query
def one_hot(lake: Lake) -> DataFrame:
    rows = lake.features.select("Customer_ID", "snapshot_date", "Occupation")
    return modelling.one_hot(rows, "Occupation", modelling.categories(rows, "Occupation"))


@query
def class_weights(lake: Lake) -> DataFrame:
    return settle(modelling.class_weights(lake.labels), 6)


# -- models -----------------------------------------------------------------------------------
#
# Single fits: 100 rounds of boosting, forests of 100 trees, 10 deep (values inside the search spaces).  Searches go over the whole space;
# their effort is that of a smoke run (2 draws, 2 folds), where ``training.Search`` has 10 and 5.

FOREST = {"numTrees": 100, "maxDepth": 10}
BOOSTING = {"maxIter": 100}
BOOSTED = {"n_estimators": 25, "max_depth": 3, "reg_alpha": 0.5}  # the fewest trees and the depth of MONTHLY_SPACE
SMOKE_SEARCH = training.Search(n_iter=2, folds=2)


def assembled(lake: Lake, inputs: training.Inputs) -> DataFrame:
    data = tables.materialise(tuned_data(lake), "tuned-rows")
    prepared = training.preprocessing(data.where(F.col("split") == "train"), inputs)
    return prepared.transform(data).select(*ROW_KEY, "split", "label", vector_to_array("features").alias("features"))


def best_input(rows: DataFrame) -> DataFrame:
    """One number: the ROC-AUC of the number that alone ranks the train rows best, up or down."""
    train = rows.where(F.col("split") == "train")
    filled = modelling.fill_missing(train, modelling.TUNED_NUMERICS)
    each = F.array(*[F.struct(F.lit(c).alias("input"), modelling.named(c).alias("x")) for c in modelling.TUNED_NUMERICS])
    long = filled.select("label", F.explode(each).alias("v")).select("label", "v.*")
    found = distribution.roc_auc(long, "x", "label", by=("input",))
    return found.agg(F.max(F.greatest("roc_auc", 1 - F.col("roc_auc"))).alias("best"))


def quality(trained: training.Trained, rows: DataFrame) -> DataFrame:
    """Rows per class and split, all of them scored, every rate a share; and on the train rows, on which
    a model that learned nothing has a ROC-AUC of a half: the best single input's, and whether the
    model's is at least that.
    """
    rates = [F.col(c).between(0, 1) for c in ("accuracy", "recall", "precision", "f1", "balanced_accuracy", "roc_auc")]
    fitted_on, best = F.col("split") == "train", best_input(rows).scalar()
    return trained.metrics.select(
        "split",
        (F.col("true_negatives") + F.col("false_positives")).alias("negatives"),
        (F.col("false_negatives") + F.col("true_positives")).alias("positives"),
        "unscored",
        reduce(lambda x, y: x & y, rates).alias("rates_in_range"),
        F.when(fitted_on, F.round(best, 6)).alias("best_input_auc"),
        F.when(fitted_on, F.col("roc_auc") >= best).alias("beats_inputs"),
    )


def tuned_model(lake: Lake, recipe: training.Recipe, params: dict | None = None, search=None) -> tuple[training.Trained, DataFrame]:
    rows = tables.materialise(tuned_data(lake), "tuned-rows")
    return training.train(rows, recipe, ROW_KEY, params, search, stored=True), rows


def monthly_model(lake: Lake) -> training.Trained:
    windows = calendar.month_windows(TRAIN_DATE)  # no label lies outside
    features_then = calendar.tag_windows(lake.features, windows).drop("split")
    data = modelling.training_set(monthly_splits(lake), features_then)
    return training.train(data, training.MONTHLY, ROW_KEY, search=SMOKE_SEARCH)


@query
def tree_features(lake: Lake) -> DataFrame:
    return assembled(lake, training.TREE_INPUTS)


@query
def linear_features(lake: Lake) -> DataFrame:
    return assembled(lake, training.LINEAR_INPUTS)


def input_values(lake: Lake, inputs: training.Inputs) -> DataFrame:
    """The assembled vectors entry by entry."""
    values = F.posexplode("features").alias("i", "value")
    return settle(assembled(lake, inputs).select(*ROW_KEY, "split", values), 5)


@query
def tree_inputs(lake: Lake) -> DataFrame:
    return input_values(lake, training.TREE_INPUTS)


@query
def linear_inputs(lake: Lake) -> DataFrame:
    return input_values(lake, training.LINEAR_INPUTS)


@query
def boosted_inputs(lake: Lake) -> DataFrame:
    """The inputs of second-order boosting, by name."""
    data = tables.materialise(tuned_data(lake), "tuned-rows")
    prepared, names = training.tree_preprocessing(data.where(F.col("split") == "train"), training.TREE_INPUTS)
    values = F.posexplode(F.col(training.MODEL_INPUTS)).alias("i", "value")
    found = prepared.transform(data).select(*ROW_KEY, "split", values)
    return settle(found.select(*ROW_KEY, "split", F.array(*map(F.lit, names))[F.col("i")].alias("input"), "value"), 5)


@query
def train_random_forest(lake: Lake) -> DataFrame:
    return quality(*tuned_model(lake, training.RANDOM_FOREST, FOREST))


@query
def train_random_forest_scaled(lake: Lake) -> DataFrame:
    return quality(*tuned_model(lake, training.RANDOM_FOREST_SCALED, FOREST))


@query
def train_gbt(lake: Lake) -> DataFrame:
    return quality(*tuned_model(lake, training.GRADIENT_BOOSTING, BOOSTING))


@query
def train_logistic(lake: Lake) -> DataFrame:
    """Also whether the fit is one: the weighted errors, times each input, add up to nothing."""
    trained, rows = tuned_model(lake, training.LOGISTIC)
    train = rows.where(F.col("split") == "train")
    weights = modelling.class_weights(train)
    scored = training.weighted(trained.model.transform(train), weights, training.LOGISTIC.weight)
    error = F.col("weight") * (training.probability(scored) - F.col("label"))
    inputs = F.posexplode(vector_to_array("features")).alias("i", "x")
    sums = scored.select(error.alias("error"), "weight", inputs).groupBy("i").agg(F.abs(F.sum(F.col("error") * F.col("x")) / F.sum("weight")).alias("g"))
    largest = sums.agg(F.max("g")).scalar()
    return quality(trained, rows).withColumn("stationary", F.when(F.col("split") == "train", largest < 1e-3))


@query
def train_boosted(lake: Lake) -> DataFrame:
    return quality(*tuned_model(lake, training.BOOSTED, BOOSTED))


def boosting_bins(lake: Lake) -> tuple[DataFrame, list[str], list[list[float]]]:
    """Weighted train rows with their bins, and the inputs' names and cut points."""
    inputs = training.Inputs(modelling.TUNED_NUMERICS)
    data = tables.materialise(tuned_data(lake).where(F.col("split") == "train"), "tuned-rows")
    prepared, names = training.tree_preprocessing(data, inputs)
    rows = training.weighted(prepared.transform(data), modelling.class_weights(data), "positive_weight")
    cuts = boosting.cut_points(rows, training.MODEL_INPUTS)
    return rows.select("label", "weight", boosting.binned(cuts, training.MODEL_INPUTS).alias("bins")), names, cuts


def first_sums(rows: DataFrame, models: int) -> DataFrame:
    """Sums of the first round's root, the same for every model."""
    g, h = boosting.gradients(F.lit(0.0))
    return boosting.histograms(rows, F.array(*[
        F.struct(F.lit(k).alias("model"), F.lit(0).alias("node"), g.alias("g"), h.alias("h")) for k in range(models)
    ]))


@query
def boosting_histogram(lake: Lake) -> DataFrame:
    rows, names, _ = boosting_bins(lake)
    name = F.array(*map(F.lit, names))[F.col("input")]
    return settle(first_sums(rows, 1).select(name.alias("input"), "bin", "n", "g", "h"), 6)


ROOTS = [
    boosting.Setting(), boosting.Setting(reg_alpha=20.0, reg_lambda=0.5), boosting.Setting(min_child_weight=200.0, gamma=0.1),
    boosting.Setting(gamma=1e9),
]


@query
def boosting_root_splits(lake: Lake) -> DataFrame:
    """The first split under four settings, of which the last allows none."""
    rows, names, cuts = boosting_bins(lake)
    best = boosting.best_splits(first_sums(rows, len(ROOTS)), ROOTS)
    name = F.array(*map(F.lit, names))[F.col("input")]
    at = F.array(*[F.array(*map(F.lit, own or [0.0])) for own in cuts])[F.col("input")][F.col("cut") - 1]
    return settle(best.select("model", name.alias("input"), at.alias("cut"), "gain", "g_left", "h_left", "g_right", "h_right"), 4)


@query
def random_search(lake: Lake) -> DataFrame:
    """Metrics of the best of the drawn settings: its parameters, and whether its cross-validated recall is a share."""
    trained, rows = tuned_model(lake, training.RANDOM_FOREST, search=SMOKE_SEARCH)
    return quality(trained, rows).withColumns(
        {"cv_in_range": F.lit(0 <= trained.cv_score <= 1), "searched": F.lit(", ".join(sorted(trained.params)))}
    )


@query
def model_round_trip(lake: Lake) -> DataFrame:
    """Scores of a stored and reloaded model against those of the model in memory."""
    trained = monthly_model(lake)
    path = tables.shared_dir(lake.spark, "model")
    windows = calendar.month_windows(TRAIN_DATE)
    training.save(trained, path, TRAIN_DATE, windows, lake.spark)
    loaded, facts = training.load(lake.spark, path)
    rows = tables.at_snapshot(lake.features, SNAPSHOT)
    before = training.score(trained.model, rows).select("Customer_ID", "snapshot_date", "model_predictions")
    after = scoring.predictions(loaded, rows, SCORE_MODEL).select(
        "Customer_ID", "snapshot_date", F.col("model_predictions").alias("reloaded")
    )
    same = F.count_if(F.col("model_predictions") == F.col("reloaded"))
    compared = before.join(after, ["Customer_ID", "snapshot_date"]).agg(F.count("*").alias("n_rows"), same.alias("n_equal"))
    return compared.withColumn("model_version", facts.select("model_version").scalar())


@query
def score_snapshot(lake: Lake) -> DataFrame:
    scores = scoring.score_snapshot(monthly_model(lake).model, lake.features, SNAPSHOT, SCORE_MODEL)
    return scores.select("Customer_ID", "snapshot_date", "model_name", F.col("model_predictions").between(0, 1).alias("in_range"))


@query
def feature_importance_topk(lake: Lake) -> DataFrame:
    trained = training.train(tuned_data(lake), training.RANDOM_FOREST, ROW_KEY, FOREST)
    return settle(training.top_features(lake.spark, trained), 6)


@query
def model_runs(lake: Lake) -> DataFrame:
    """Two runs appended to one table."""
    path = tables.shared_dir(lake.spark, "runs")
    rows = tables.materialise(tuned_data(lake), "tuned-rows")
    for recipe, params in ((training.RANDOM_FOREST, FOREST), (training.LOGISTIC, {})):
        trained = training.train(rows, recipe, ROW_KEY, params)
        training.append_runs(training.run_log(trained, TRAIN_DATE), path)
    return settle(lake.spark.read.parquet(path).select("model_type", "train_date", "split", "metric", "value"), 6)


@query
def monitor_values(lake: Lake) -> DataFrame:
    """What the stored report says, read back from its JSON."""
    base, current = score_pair(lake)
    path = tables.shared_dir(lake.spark, "monitoring")
    report = monitoring.report(base.unionByName(current), SCORE_MODEL, SNAPSHOT, BASELINE, lake.labels)
    monitoring.write_report(report, path)
    row = lake.spark.read.schema(report.schema).json(f"{path}/monitor_report")
    summaries = [
        F.col(f"{side}_summary.{c}").alias(f"{side}_{c}")
        for side in ("baseline", "current") for c in ("count", "mean", "std", "min", "max", "median")
    ]
    deciles = [F.col("current_summary.deciles")[name].alias(f"current_{name}") for name in drift.decile_names()]
    shifts = F.aggregate("deciles", F.lit(0.0), lambda total, d: total + F.abs(d["diff"])).alias("decile_shift")
    truth = [F.col("label_metrics")[c].alias(c) for c in ("roc_auc", "precision", "recall", "f1", "unlabelled", "unscored")]
    return settle(row.select(
        "model_label", "snapshotdate", "baseline_date", *summaries, *deciles, shifts, "ks_stat", "ks_pvalue", "psi", "alert", "exit_code",
        *truth, "label_note",
    ), 6)


@query
def drift_by_month(lake: Lake) -> DataFrame:
    """Every month of the scores against one baseline, in one plan."""
    found = drift.by_month(lake.predictions, BASELINE)
    deciles = [F.col("deciles")[k].alias(name) for k, name in enumerate(drift.decile_names())]
    return settle(found.select(
        "model_name", "snapshot_date", "count", "mean", "std", "min", "max", "median", *deciles, "psi", "alert", "ks_stat", "ks_pvalue"
    ), 6)


@query
def monitor_report(lake: Lake) -> DataFrame:
    base, current = score_pair(lake)
    row = monitoring.report(base.unionByName(current), SCORE_MODEL, SNAPSHOT, BASELINE, lake.labels)
    monitoring.write_report(row, tables.shared_dir(lake.spark, "monitoring"))
    return row
