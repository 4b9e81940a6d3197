"""Score drift between a baseline and a current snapshot, and the monitoring report."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators import kolmogorov
from creditloom.operators.distribution import DECILES, quantiles, running_totals
from creditloom.sources.tables import materialise

SCORE = "model_predictions"

# Column names that mark a score, in order of preference, and names that never do.
SCORE_NAMES = [
    "model_predictions", "model_prediction_proba", "churn_proba", "proba", "probability",
    "prob", "score", "prediction", "pred",
]
NOT_SCORES = {"Customer_ID", "snapshot_date", "id", "member_id", "userid"}
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

# Alert thresholds, and the guard against empty bins.
PSI_WARN, PSI_CRITICAL = 0.2, 0.3
EPSILON = 1e-8


def score_column(df: DataFrame) -> str:
    """The column that holds the scores, by name (exact before partial), else the first number."""
    for name in SCORE_NAMES:
        exact = [c for c in df.columns if c.lower() == name]
        partial = [c for c in df.columns if name in c.lower()]
        if exact or partial:
            return (exact or partial)[0]
    numeric = [c for c, t in df.dtypes if t.startswith(NUMERIC_TYPES) and c not in NOT_SCORES]
    if not numeric:
        raise KeyError(f"no score column: looked for {', '.join(SCORE_NAMES)}, then for any number")
    return numeric[0]


def read_scores(df: DataFrame) -> DataFrame:
    """Scores under their usual name as double; text that is no number becomes NULL."""
    chosen = score_column(df)
    scores = df.withColumn(chosen, F.col(f"`{chosen}`").try_cast("double")).withColumnRenamed(chosen, SCORE)
    if scores.where(F.col(SCORE).isNotNull()).isEmpty():
        raise ValueError(f"column {chosen} holds no numbers")
    return scores


def find_predictions(df: DataFrame, model_label: str, snapshot: str) -> DataFrame:
    """The scores of a model at a snapshot: by exact name, else by the name with or without ``.pkl``.

    Never another model's, however much its name begins alike.
    """
    stem = model_label.removesuffix(".pkl")
    dated = df.where(F.col("snapshot_date") == F.lit(snapshot).cast("date"))
    exact = dated.where(F.col("model_name") == model_label)
    if not exact.isEmpty():
        return exact
    loose = dated.where(F.col("model_name").isin(stem, f"{stem}.pkl"))
    if loose.isEmpty():
        raise FileNotFoundError(f"no predictions of {model_label} at {snapshot}")
    chosen = loose.agg(F.min("model_name").alias("m"))
    return loose.where(F.col("model_name") == chosen.scalar())


def paired(baseline: DataFrame, current: DataFrame, value: str = SCORE) -> DataFrame:
    """Both sides in one frame, told apart by ``side``."""
    return baseline.select(F.lit("base").alias("side"), value).unionByName(
        current.select(F.lit("current").alias("side"), value)
    )


def paired_totals(baseline: DataFrame, current: DataFrame, value: str = SCORE) -> DataFrame:
    """Running totals over the distinct scores of both sides, stored: several statistics read them."""
    on = {s: F.when(F.col("side") == s, 1).otherwise(0) for s in ("base", "current")}
    return materialise(running_totals(paired(baseline, current, value), value, on), "score-totals")


def summarise(df: DataFrame, value: str = SCORE, by: tuple[str, ...] = ("side",)) -> DataFrame:
    """Count, mean, population deviation, extremes, median and deciles per group."""
    present = df.where(F.col(value).isNotNull())
    basic = present.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    ordered = running_totals(present, value, {"n": F.lit(1)}, by).groupBy(*by).agg(
        quantiles(value, "n").alias("deciles")
    )
    return basic.join(ordered, list(by)).withColumn("median", F.col("deciles")[5])


def summary_of(totals: DataFrame, side: str, value: str = SCORE, by: tuple[str, ...] = ()) -> DataFrame:
    """``summarise`` for one side of running totals, which hold all it takes: no further pass over the scores."""
    n, x = F.col(side), F.col(value)
    mean = F.try_divide(F.sum(x * n), F.max(f"{side}_total"))
    spread = F.try_divide(F.sum(x * x * n), F.max(f"{side}_total")) - mean * mean
    present = F.when(n > 0, x)
    return totals.groupBy(*by).agg(
        F.coalesce(F.max(f"{side}_total"), F.lit(0)).alias("count"), mean.alias("mean"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std"),
        F.min(present).alias("min"), F.max(present).alias("max"), quantiles(value, side).alias("deciles"),
    ).withColumn("median", F.col("deciles")[5])


MODEL_MONTH = ("model_name", "snapshot_date")


def totals_by_month(predictions: DataFrame, baseline: str, value: str = SCORE, by: tuple[str, str] = MODEL_MONTH) -> DataFrame:
    """Running totals of every (model, snapshot) paired with its model's scores at ``baseline``, stored.

    Copies of a score collapse before the baseline's are repeated for each month, so that side is as
    large as the months' own.
    """
    model, month = by
    counted = predictions.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    counted = materialise(counted, "score-counts")
    base = counted.where(F.col(month) == F.lit(baseline).cast("date")).drop(month)
    months = counted.select(*by).distinct()
    sides = base.join(months, model).select(*by, value, F.lit("base").alias("side"), "n").unionByName(
        counted.select(*by, value, F.lit("current").alias("side"), "n")
    )
    on = {s: F.when(F.col("side") == s, F.col("n")).otherwise(0) for s in ("base", "current")}
    return materialise(running_totals(sides, value, on, by), "score-totals")


def psi_by(totals: DataFrame, by: tuple[str, ...], value: str = SCORE, bins: int = 10) -> DataFrame:
    """``psi`` for each group of running totals; the bins' edges, a few numbers a group, are joined to its scores."""
    probs = [i / bins for i in range(bins + 1)]
    edges = totals.groupBy(*by).agg(
        F.filter(F.array_distinct(quantiles(value, "base", probs)), lambda e: e.isNotNull()).alias("edges"),
        F.max("base_total").alias("bt"), F.max("current_total").alias("ct"),
    )
    x = F.col(value)
    placed = totals.select(*by, value, "base", "current").join(edges, list(by))
    inside = placed.where((F.size("edges") > 0) & (x >= F.element_at("edges", 1)) & (x <= F.element_at("edges", -1)))
    reached = F.size(F.filter("edges", lambda e: x >= e))
    bin_ = F.least(reached, F.greatest(F.size("edges") - 1, F.lit(1)))
    binned = inside.groupBy(*by, bin_.alias("bin")).agg(F.sum("base").alias("b"), F.sum("current").alias("c"))
    gathered = binned.groupBy(*by).agg(
        F.collect_list(F.struct("b", "c")).alias("bins"), F.sum("b").alias("bs"), F.sum("c").alias("cs")
    )
    total = F.aggregate("bins", F.lit(0.0), lambda acc, r: acc + _index_term(r["b"], r["c"]))
    found = edges.join(gathered, list(by), "left")
    both = (F.col("bt") > 0) & (F.col("ct") > 0)
    return found.select(*by, F.when(both, total).otherwise(F.lit(float("nan"))).alias("psi"))


def _index_term(base: Column, current: Column) -> Column:
    """A bin's share of the index, of its counts; ``bs`` and ``cs`` are the sums over the bins."""
    b, c = (F.when(n == 0, F.lit(EPSILON)).otherwise(n / (F.col(s) + EPSILON)) for n, s in ((base, "bs"), (current, "cs")))
    return (b - c) * F.ln(b / c)


def by_month(
    predictions: DataFrame, baseline: str, value: str = SCORE, by: tuple[str, str] = MODEL_MONTH,
    warn: float = PSI_WARN, critical: float = PSI_CRITICAL, exact_rows: int = kolmogorov.EXACT_ROWS,
) -> DataFrame:
    """Drift of every (model, snapshot) against its model's ``baseline``: summary, psi, alert and KS, a row each.

    Models without scores at the baseline are left out, and so are snapshots without a score.
    """
    totals = totals_by_month(predictions, baseline, value, by)
    totals = totals.where((F.col("base_total") > 0) & (F.col("current_total") > 0))
    # collected per group are at most ``exact_rows`` scores of either side
    found = totals.groupBy(*by).agg(
        *ks_columns(value), kolmogorov.ties_if_few(value, most=exact_rows).alias("ties"), kolmogorov.farthest(most=exact_rows).alias("far")
    )
    sizes = (F.col("n_base"), F.col("n_current"))
    exact = kolmogorov.exact_pvalue(F.col("ties"), *sizes, F.col("far"))
    distance = found.select(*by, "ks_stat", F.coalesce(exact, ks_pvalue(F.col("ks_stat"), *sizes)).alias("ks_pvalue"))
    summary = summary_of(totals, "current", value, by)
    index = alert(psi_by(totals, by, value), warn, critical)
    return summary.join(index, list(by)).join(distance, list(by))


def decile_diff(totals: DataFrame, value: str = SCORE) -> DataFrame:
    """Eleven rows: each decile of both sides and the shift."""
    both = totals.agg(quantiles(value, "base").alias("b"), quantiles(value, "current").alias("c"))
    rows = both.select(F.posexplode(F.arrays_zip("b", "c")).alias("decile", "pair"))
    return rows.select(
        "decile",
        F.col("pair.b").alias("base"),
        F.col("pair.c").alias("current"),
        (F.col("pair.c") - F.col("pair.b")).alias("diff"),
    )


def psi(totals: DataFrame, value: str = SCORE, bins: int = 10) -> DataFrame:
    """Population stability index of the current side against bins of the baseline.

    The bins are the distinct baseline quantiles, the last one closed on the right; values outside
    are left out.  A bin empty on one side counts a tiny share, on both sides nothing.  NaN when a
    side has no rows.
    """
    probs = [i / bins for i in range(bins + 1)]
    # at most ``bins`` + 1 numbers, and what follows compares with literals
    found = totals.agg(F.array_distinct(quantiles(value, "base", probs)).alias("edges")).first().edges
    edges = [e for e in found if e is not None]
    reached = F.lit(0)
    for edge in edges:
        reached = reached + (F.col(value) >= F.lit(edge)).cast("int")
    inside = (
        totals.where(F.col(value).between(F.lit(edges[0]), F.lit(edges[-1])) if edges else F.lit(False))
        .withColumn("bin", F.least(reached, F.lit(max(len(edges) - 1, 1))))
    )
    binned = inside.groupBy("bin").agg(
        F.sum("base").alias("b"), F.sum("current").alias("c"),
        F.max("base_total").alias("bt"), F.max("current_total").alias("ct"),
    )
    # at most ``bins`` rows from here on
    gathered = binned.agg(
        F.collect_list(F.struct("b", "c")).alias("bins"),
        F.sum("b").alias("bs"), F.sum("c").alias("cs"), F.max("bt").alias("bt"), F.max("ct").alias("ct"),
    )

    total = F.aggregate("bins", F.lit(0.0), lambda acc, r: acc + _index_term(r["b"], r["c"]))
    return gathered.select(
        F.when((F.col("bt") > 0) & (F.col("ct") > 0), total).otherwise(F.lit(float("nan"))).alias("psi")
    )


def ks_columns(value: str = SCORE) -> list[Column]:
    gap = F.abs(
        (F.col("base_below") + F.col("base")) / F.col("base_total")
        - (F.col("current_below") + F.col("current")) / F.col("current_total")
    )
    return [
        F.max(gap).alias("ks_stat"),
        F.max("base_total").alias("n_base"),
        F.max("current_total").alias("n_current"),
    ]


def ks_pvalue(stat: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sided p-value: the tail of the Kolmogorov distribution."""
    reach = stat * F.sqrt(n.cast("double") * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(-2.0 * k * k * reach * reach),
    )
    return F.when(reach < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks(totals: DataFrame, value: str = SCORE, exact_rows: int = kolmogorov.EXACT_ROWS) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic and p-value.

    The p-value is exact, ties included, where both samples have up to ``exact_rows`` rows, and the
    limit's beyond.
    """
    both = totals.where((F.col("base_total") > 0) & (F.col("current_total") > 0))
    found = both.agg(
        *ks_columns(value),
        kolmogorov.ties_if_few(value, most=exact_rows).alias("ties"), kolmogorov.farthest(most=exact_rows).alias("far"),
    )
    sizes = (F.col("n_base"), F.col("n_current"))
    exact = kolmogorov.exact_pvalue(F.col("ties"), *sizes, F.col("far"))
    return found.select(
        "ks_stat", "n_base", "n_current", F.coalesce(exact, ks_pvalue(F.col("ks_stat"), *sizes)).alias("ks_pvalue")
    )


def alert(psi_frame: DataFrame, warn: float = PSI_WARN, critical: float = PSI_CRITICAL) -> DataFrame:
    """Alert level and process exit code for an index; no usable index gives ``unknown``."""
    value = F.col("psi")
    usable = value.isNotNull() & ~F.isnan(value)
    return psi_frame.withColumns(
        {
            "alert": F.when(~usable, "unknown").when(value >= critical, "critical")
            .when(value >= warn, "warning").otherwise("ok"),
            "exit_code": F.when(~usable, 0).when(value >= critical, 2).when(value >= warn, 1).otherwise(0),
        }
    )


def retrain_needed(runs: DataFrame, as_of: str, max_age_days: int = 90) -> DataFrame:
    """True when the newest run is older than ``max_age_days``, or when there is no run."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), max_age_days)
    newest = runs.agg(F.max("start_time").cast("date").alias("latest_run"))
    return newest.select(
        "latest_run", cutoff.alias("cutoff"), F.coalesce(F.col("latest_run") < cutoff, F.lit(True)).alias("retrain")
    )


def decile_names() -> list[str]:
    return [f"p{round(p * 100)}" for p in DECILES]
