"""Supervised quality of scores: confusion counts, rates, ROC-AUC and Gini."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.distribution import rank_auc, running_totals
from creditloom.sources.schemas import KEYS

# Fixed value: the decision threshold.
THRESHOLD = 0.5


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def rates() -> dict[str, Column]:
    """Rates from the confusion counts; a zero denominator gives 0."""
    tn, fp, fn, tp = (
        F.col(c).cast("double")
        for c in ("true_negatives", "false_positives", "false_negatives", "true_positives")
    )
    return {
        "accuracy": _ratio(tp + tn, tn + fp + fn + tp),
        "recall": _ratio(tp, tp + fn),
        "precision": _ratio(tp, tp + fp),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": (_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2,
    }


def classification_metrics(
    df: DataFrame, score: str, label: str, by: tuple[str, ...] = (),
    threshold: float = THRESHOLD, weight: Column | None = None,
) -> DataFrame:
    """Confusion counts, rates and exact ROC-AUC per group.

    A labelled row without a score (NULL or NaN) is below the threshold; ``unscored`` counts such
    rows.  The ROC-AUC is that of the scored rows.  ``balanced_accuracy`` is the ROC-AUC of the hard
    decisions.
    """
    judged = df.where(F.col(label).isNotNull())
    truth = F.col(label) == 1
    each, none = F.lit(1) if weight is None else weight, F.lit(0)
    totals = running_totals(
        judged, score, {"pos": F.when(truth, each).otherwise(none), "neg": F.when(truth, none).otherwise(each)}, by
    )
    number = F.col(score).cast("double")
    scored = number.isNotNull() & ~F.isnan(number)
    hit = scored & (number >= threshold)

    def counted(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, each).otherwise(none)), none).cast("long").alias(name)

    counts = judged.groupBy(*by).agg(
        counted(~truth & ~hit, "true_negatives"),
        counted(~truth & hit, "false_positives"),
        counted(truth & ~hit, "false_negatives"),
        counted(truth & hit, "true_positives"),
        counted(~scored, "unscored"),
    )
    areas = totals.groupBy(*by).agg(rank_auc().alias("roc_auc"))
    if by:  # few rows on either side; a group may be NULL
        named = areas.select(*[F.col(c).alias(f"_{c}") for c in by], "roc_auc")
        same = [counts[c].eqNullSafe(named[f"_{c}"]) for c in by]
        summary = counts.join(named, same, "left").drop(*[f"_{c}" for c in by])
    else:
        summary = counts.withColumn("roc_auc", areas.scalar())
    return summary.withColumns(rates())


def auc_gini(df: DataFrame, score: str, label: str, by: tuple[str, ...] = ("split",)) -> DataFrame:
    """ROC-AUC and Gini (three decimals) per group."""
    metrics = classification_metrics(df, score, label, by)
    return metrics.select(*by, "roc_auc", F.round(2 * F.col("roc_auc") - 1, 3).alias("gini"))


def labelled(predictions: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """Predictions left-joined to their labels, as (prediction, label, ``n_labels``).

    Labels are counted per key and value first, so a key has at most one row per label value,
    however many loans a customer has.  A prediction without label stays, with NULL.
    """
    counted = labels.groupBy(*KEYS, label).agg(F.count("*").alias("n_labels"))
    return predictions.join(counted, KEYS, "left")


def label_metrics(predictions: DataFrame, labels: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Quality over the labelled predictions, and how many predictions had no label."""
    merged = labelled(predictions, labels, label)
    missing = merged.agg(F.count_if(F.col(label).isNull()).alias("unlabelled"))
    quality = classification_metrics(merged, score, label, weight=F.col("n_labels"))
    return quality.select("roc_auc", "precision", "recall", "f1", missing.scalar().alias("unlabelled"), "unscored")
