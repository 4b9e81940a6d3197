"""Batch scoring of snapshots."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.plans.training import SCORE, score
from creditloom.sources.tables import at_snapshot, read_table, write_snapshots


def predictions(model: PipelineModel, features: DataFrame, model_name: str) -> DataFrame:
    """Scores beside their keys; features never leave the executors."""
    return score(model, features).select(
        "Customer_ID", "snapshot_date", F.lit(model_name).alias("model_name"), SCORE
    )


def score_snapshot(model: PipelineModel, features: DataFrame, snapshot: str, model_name: str) -> DataFrame | None:
    """Scores of one snapshot; None when the feature store does not hold it."""
    chosen = at_snapshot(features, snapshot)
    return None if chosen.isEmpty() else predictions(model, chosen, model_name)


def write_predictions(scores: DataFrame, path: str) -> int:
    """Replace the scores of the (model, snapshot) pairs present, and count what was read back."""
    write_snapshots(scores, path, ("model_name", "snapshot_date"))
    pairs = scores.select("model_name", "snapshot_date").distinct()
    written = read_table(scores.sparkSession, path)
    return written.join(pairs, ["model_name", "snapshot_date"], "left_semi").count()
