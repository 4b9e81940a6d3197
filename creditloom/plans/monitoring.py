"""The monitoring report: drift, summaries, deciles and supervised quality in one record."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.operators import drift
from creditloom.operators.metrics import label_metrics
from creditloom.sources.tables import at_snapshot


def _supervised(current: DataFrame, labels: DataFrame | None, label: str, snapshot: str) -> DataFrame:
    """One row with a map of metrics, and a text that says why there are none."""
    spark, nothing = current.sparkSession, F.lit(None).cast("map<string,double>")

    def absent(note: str) -> DataFrame:
        return spark.range(1).select(nothing.alias("label_metrics"), F.lit(note).alias("label_note"))

    if labels is None:
        return absent("no_labels_provided")
    if label not in labels.columns:
        return absent("label_column_missing")
    if labels.isEmpty():
        return absent("label_store_empty")
    # the join is on the snapshot too: read only its partition of the label store
    quality = label_metrics(current, at_snapshot(labels, snapshot), drift.SCORE, label)
    pairs = [x for c in quality.columns for x in (F.lit(c), F.col(c).cast("double"))]
    return quality.select(F.create_map(*pairs).alias("label_metrics"), F.lit(None).cast("string").alias("label_note"))


def report(
    predictions: DataFrame, model_label: str, snapshot: str, baseline: str,
    labels: DataFrame | None = None, label: str = "label",
    warn: float = drift.PSI_WARN, critical: float = drift.PSI_CRITICAL, now: datetime | None = None,
) -> DataFrame:
    """One row: the report on ``snapshot`` against ``baseline``.

    Each part is a single row; they are put together as scalars.
    """
    spark = predictions.sparkSession
    current = drift.read_scores(drift.find_predictions(predictions, model_label, snapshot))
    base = drift.read_scores(drift.find_predictions(predictions, model_label, baseline))
    totals = drift.paired_totals(base, current)

    names = drift.decile_names()
    deciles = F.map_from_arrays(F.array(*map(F.lit, names)), F.col("deciles"))
    summary = F.struct("count", "mean", "std", "min", "max", "median", deciles.alias("deciles"))
    sides = {side: drift.summary_of(totals, side).select(summary) for side in ("base", "current")}
    shifts = drift.decile_diff(totals).agg(
        F.array_sort(F.collect_list(F.struct("decile", "base", "current", "diff"))).alias("d")
    )
    index = drift.alert(drift.psi(totals), warn, critical).select(F.struct("psi", "alert", "exit_code"))
    distance = drift.ks(totals).select(F.struct("ks_stat", "ks_pvalue"))
    supervised = _supervised(current, labels, label, snapshot).select(F.struct("label_metrics", "label_note"))

    row = spark.range(1).select(
        F.lit(model_label).alias("model_label"),
        F.lit(snapshot).alias("snapshotdate"),
        F.lit(baseline).alias("baseline_date"),
        F.lit((now or datetime.now(timezone.utc)).isoformat()).alias("timestamp"),
        sides["base"].scalar().alias("baseline_summary"),
        sides["current"].scalar().alias("current_summary"),
        distance.scalar().alias("k"),
        index.scalar().alias("i"),
        shifts.scalar().alias("deciles"),
        supervised.scalar().alias("m"),
    )
    return row.select(
        "model_label", "snapshotdate", "baseline_date", "timestamp", "baseline_summary", "current_summary",
        "k.ks_stat", "k.ks_pvalue", "i.psi", "i.alert", "i.exit_code", "deciles", "m.label_metrics", "m.label_note",
    )


def write_report(row: DataFrame, out_dir: str) -> None:
    """The record as JSON and its decile table as CSV."""
    row.write.mode("overwrite").json(f"{out_dir}/monitor_report")
    table = row.select(F.explode("deciles").alias("d")).select("d.*")
    table.write.mode("overwrite").option("header", True).csv(f"{out_dir}/monitor_table")
