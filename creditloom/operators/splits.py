"""Exact stratified splits, folds and samples.

Rows of a stratum are put in the order of a hash of their key, and cut at exact ranks.  The rank of
a row is never computed: a histogram over hash prefixes finds the prefix that holds each cut, and
only the keys under those prefixes are ranked.  What reaches the driver is one hash per cut.  The
split itself is then a projection, without shuffle, whatever the size of a stratum.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash prefix: 65,536 prefixes per stratum.
PREFIX = 4
# Copies of a row emitted by one task when a cut falls between copies.
COPIES_PER_TASK = 100_000


@dataclass(frozen=True)
class Cut:
    """The first ``part`` parts of a stratum end inside the copies of ``key``: ``quota`` of its
    ``copies`` rows belong before the cut."""

    stratum: object
    part: int
    key: str
    quota: int
    copies: int


def order_key(key: list[str], seed: int) -> Column:
    """Hash order of rows; NULLs count as empty text."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key]
    return F.md5(F.concat_ws("|", *texts, F.lit(str(seed))))


def find_cuts(df: DataFrame, stratum: str, key: list[str], ranks: DataFrame, seed: int) -> list[Cut]:
    """Resolve cut ranks, given as (stratum, part, rank), to keys."""
    keyed = df.select(F.col(stratum).alias("_s"), order_key(key, seed).alias("_k"))
    prefix = F.substring("_k", 1, PREFIX)
    ordered = Window.partitionBy("_s").orderBy("_p")
    histogram = (
        keyed.groupBy("_s", prefix.alias("_p")).agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    )
    wanted = ranks.select(F.col(stratum).alias("_s"), F.col("part").alias("_part"), F.col("rank").alias("_rank"))
    holding = (
        histogram.join(wanted.withColumnRenamed("_s", "_w"), F.col("_s").eqNullSafe(F.col("_w")))
        .where((F.col("_rank") > F.col("_upto") - F.col("_n")) & (F.col("_rank") <= F.col("_upto")))
        .select("_s", "_p", "_part", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    # one row per cut: strata times parts
    near = (
        keyed.withColumn("_p", prefix)
        .join(F.broadcast(holding.select(F.col("_s").alias("_w"), F.col("_p").alias("_q"), "_part", "_need")),
              F.col("_s").eqNullSafe(F.col("_w")) & (F.col("_p") == F.col("_q")))
        .groupBy("_s", "_part", "_need", "_k").agg(F.count("*").alias("_c"))
    )
    within = Window.partitionBy("_s", "_part").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    found = near.withColumn("_upto", F.sum("_c").over(within)).where(
        (F.col("_need") > F.col("_upto") - F.col("_c")) & (F.col("_need") <= F.col("_upto"))
    )
    resolved = found.select("_s", "_part", "_k", (F.col("_need") - F.col("_upto") + F.col("_c")).alias("_q"), "_c")
    # a part without rows ends before every key
    empty = wanted.where(F.col("_rank") <= 0).select(
        "_s", "_part", F.lit("").alias("_k"), F.lit(0).alias("_q"), F.lit(0).alias("_c")
    )
    rows = resolved.unionByName(empty).collect()
    return sorted((Cut(*row) for row in rows), key=lambda c: (str(c.stratum), c.part))


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, the copies spread over tasks."""
    blocks = F.sequence(F.lit(0), F.floor((F.col(times) - 1) / COPIES_PER_TASK).cast("long"))
    spread = df.where(F.col(times) > 0).withColumn("_block", F.explode(blocks))
    left = F.col(times) - F.col("_block") * COPIES_PER_TASK
    size = F.least(F.lit(COPIES_PER_TASK).cast("long"), left)
    sized = spread.withColumn("_size", size).repartition("_block", *df.columns)
    return sized.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_size")))).select(
        *[c for c in df.columns if c != times]
    )


def cut_rows(df: DataFrame, stratum: str, key: list[str], ranks: DataFrame, seed: int, column: str) -> DataFrame:
    """Add the part number (from 0) of every row: how many cuts of its stratum lie before it."""
    cuts = find_cuts(df, stratum, key, ranks, seed)
    hashed, here = df.withColumn("_k", order_key(key, seed)), F.col("_k")

    def same(cut: Cut) -> Column:
        return F.col(stratum).eqNullSafe(F.lit(cut.stratum))

    def passed(beyond) -> Column:
        steps = [F.when(same(c) & beyond(c), 1).otherwise(0) for c in cuts]
        return sum(steps[1:], steps[0]) if steps else F.lit(0)

    inside = [c for c in cuts if c.quota < c.copies]
    tied = F.lit(False)
    for cut in inside:
        tied = tied | (same(cut) & (here == F.lit(cut.key)))
    clear = hashed.where(~tied) if inside else hashed
    plain = clear.withColumn(column, passed(lambda c: here > F.lit(c.key))).drop("_k")
    if not inside:
        return plain

    # A cut falls between rows of equal key: count equal rows, share the counts out, emit copies.
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = hashed.where(tied).groupBy(*columns, "_k").agg(F.count("*").alias("_copies"))
    before = Window.partitionBy(stratum, "_k").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_from", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    settled = passed(lambda c: here > F.lit(c.key))
    edges = F.array_compact(
        F.array(*[F.when(same(c) & (here == F.lit(c.key)), F.lit(c.quota).cast("long")) for c in inside])
    )
    bounds = F.concat(F.array(F.lit(0).cast("long")), edges, F.array(F.lit(2**62).cast("long")))
    shares = (
        placed.withColumn("_bounds", bounds)
        .withColumn("_step", F.explode(F.sequence(F.lit(1), F.size("_bounds") - 1)))
        .withColumn(
            "_take",
            F.least(F.col("_from") + F.col("_copies"), F.element_at("_bounds", F.col("_step") + 1))
            - F.greatest(F.col("_from"), F.element_at("_bounds", F.col("_step"))),
        )
        .withColumn(column, settled + F.col("_step") - 1)
        .where(F.col("_take") > 0)
        .select(*columns, column, "_take")
    )
    return plain.unionByName(repeat_rows(shares, "_take"))


def stratum_sizes(df: DataFrame, stratum: str) -> DataFrame:
    return df.groupBy(stratum).agg(F.count("*").alias("n"))


def train_ranks(df: DataFrame, stratum: str, train_ratio: float) -> DataFrame:
    """Training rows per stratum: proportional shares of the total, remainders to the strata with
    the largest fractional parts."""
    everything = Window.partitionBy()
    total = F.sum("n").over(everything)
    train_total = total - F.ceil(total * F.lit(1 - train_ratio))
    ideal = F.col("n") * train_total / total
    shares = stratum_sizes(df, stratum).select(
        stratum, F.floor(ideal).alias("base"), (ideal - F.floor(ideal)).alias("rest"), train_total.alias("train_total")
    )
    # one row per stratum
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc("rest"), stratum))
    extra = F.col("train_total") - F.sum("base").over(everything)
    return shares.select(
        stratum, F.lit(1).alias("part"), (F.col("base") + F.when(place <= extra, 1).otherwise(0)).alias("rank")
    )


def fold_ranks(df: DataFrame, stratum: str, folds: int) -> DataFrame:
    """Fold ends per stratum; fold sizes differ by one row at most, larger folds first."""
    n, part = F.col("n"), F.col("part")
    sized = stratum_sizes(df, stratum).withColumn("part", F.explode(F.sequence(F.lit(1), F.lit(folds - 1))))
    rank = part * F.floor(n / folds) + F.least(part, n % folds)
    return sized.select(stratum, "part", rank.cast("long").alias("rank"))


def stratified_split(
    df: DataFrame, key: list[str], label: str = "label", train_ratio: float = 0.8, seed: int = 88, column: str = "split"
) -> DataFrame:
    """Exact stratified train/test split, in hash order of ``key``."""
    parts = cut_rows(df, label, key, train_ranks(df, label, train_ratio), seed, column)
    return parts.withColumn(column, F.when(F.col(column) == 0, F.lit("train")).otherwise(F.lit("test")))


def stratified_folds(
    df: DataFrame, key: list[str], label: str = "label", folds: int = 5, seed: int = 42, column: str = "fold"
) -> DataFrame:
    """Fold number 0..folds-1 per row, each class spread evenly over the folds."""
    return cut_rows(df, label, key, fold_ranks(df, label, folds), seed, column)


def stratified_sample(df: DataFrame, label: str, fraction: float, seed: int = 42) -> DataFrame:
    """The same fraction of every class, rows without class being one; all rows from 1 on.

    One value per class reaches the driver: for label columns, not for wide ones.
    """
    if fraction >= 1.0:
        return df
    classes = [row[0] for row in df.select(label).distinct().collect()]
    if len(classes) <= 1:
        return df.sample(fraction, seed)
    known = df.sampleBy(label, {c: float(fraction) for c in classes if c is not None}, seed)
    return known.unionByName(df.where(F.col(label).isNull()).sample(fraction, seed)) if None in classes else known


def split_stats(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    """Rows and rounded label mean per split."""
    return df.groupBy(split).agg(F.count("*").alias("n_rows"), F.round(F.avg(label), 2).alias("label_mean"))
