"""Exact order statistics of a numeric column, spread over the cluster.

A window without a partition, or an exact percentile aggregate, brings every value to one task.
Here copies of a value collapse first; the distinct values are then cut into ranges of about equal
size, as many as the session has shuffle partitions, running totals are taken inside each range in
parallel, and only the totals per range are accumulated in order.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.sources.tables import materialise

# Ranges at least, whatever the session asks for.
MIN_RANGES = 64
DECILES = [i / 10 for i in range(11)]


def range_cuts(df: DataFrame, value: str) -> list[float]:
    """Approximate equi-depth cut points of ``df``'s rows, one fewer than there are ranges.

    Any cut points give exact results downstream; those of the distinct values give even tasks,
    however many rows share a few values.
    """
    ranges = max(MIN_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = df.approxQuantile(value, [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    return sorted(set(found)) or [0.0]


def running_totals(df: DataFrame, value: str, weights: dict[str, Column], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per distinct value (per group) with, for each weight ``w``: ``w`` its sum at the
    value, ``w_below`` its sum over smaller values, ``w_total`` its sum over the group.

    NULL and NaN values are left out.
    """
    by = list(by)
    number = F.col(value).cast("double")
    usable = df.where(number.isNotNull() & ~F.isnan(number)).withColumn(value, number)
    distinct = materialise(
        usable.groupBy(*by, value).agg(*[F.sum(c).alias(w) for w, c in weights.items()]), "distinct-values"
    )
    cuts = range_cuts(distinct, value)
    ranged = Bucketizer(
        splits=[float("-inf"), *cuts, float("inf")], inputCol=value, outputCol="_range"
    ).transform(distinct)

    earlier = Window.partitionBy(*by, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumns({f"{w}_below": F.coalesce(F.sum(w).over(earlier), F.lit(0)) for w in weights})

    sums = ranged.groupBy(*by, "_range").agg(*[F.sum(w).alias(w) for w in weights])
    lower = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(w).over(lower), F.lit(0)).alias(f"{w}_offset") for w in weights],
        *[F.sum(w).over(Window.partitionBy(*by)).alias(f"{w}_total") for w in weights],
    )
    placed = local.join(offsets, [*by, "_range"])
    columns = [value]
    for w in weights:
        columns += [w, (F.col(f"{w}_below") + F.col(f"{w}_offset")).alias(f"{w}_below"), f"{w}_total"]
    return placed.select(*by, *columns)


def quantile(value: str, weight: str, p: float) -> Column:
    """Aggregate over ``running_totals``: the linearly interpolated quantile under a count weight."""
    n, below, total = F.col(weight), F.col(f"{weight}_below"), F.col(f"{weight}_total")
    position = (total - 1) * F.lit(p)
    low, high = F.floor(position), F.ceil(position)

    def at(rank: Column) -> Column:
        return F.max(F.when((below <= rank) & (rank < below + n), F.col(value)))

    share = F.max(position - low)
    return at(low) + (at(high) - at(low)) * share


def quantiles(value: str, weight: str, probs=tuple(DECILES)) -> Column:
    return F.array(*[quantile(value, weight, p) for p in probs])


def rank_auc(positive: str = "pos", negative: str = "neg") -> Column:
    """Aggregate over ``running_totals``: area under the ROC curve, ties counted half.

    NULL when one of the classes is absent.
    """
    pos, neg = F.col(positive), F.col(negative)
    wins = F.sum(pos * (F.col(f"{negative}_below") + neg / 2.0))
    pairs = F.max(F.col(f"{positive}_total").cast("double") * F.col(f"{negative}_total"))
    return F.try_divide(wins, pairs)


def roc_auc(df: DataFrame, score: str, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact ROC-AUC per group (one row when there is no group)."""
    weights = {
        "pos": F.when(F.col(label) == 1, 1).otherwise(0),
        "neg": F.when(F.col(label) == 0, 1).otherwise(0),
    }
    totals = running_totals(df.where(F.col(label).isNotNull()), score, weights, by)
    return totals.groupBy(*by).agg(rank_auc().alias("roc_auc"))
