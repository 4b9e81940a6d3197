"""Row counts, NULL counts and date coverage of tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.sources.schemas import KEYS


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: rows, columns, first and last snapshot.  One aggregate per table."""
    rows = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.lit(len(df.columns)).alias("n_columns"),
            F.min("snapshot_date").alias("first_snapshot"),
            F.max("snapshot_date").alias("last_snapshot"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def head(df: DataFrame, n: int = 10, order=tuple(KEYS)) -> DataFrame:
    """The first rows under a stated order."""
    return df.orderBy(*order).limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """NULLs per column over the whole table, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count")) for c in df.columns]
    )
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def date_coverage(df: DataFrame) -> DataFrame:
    """Distinct snapshots in order, beside the first and last of the table."""
    dates = df.select("snapshot_date").distinct()
    ends = dates.agg(F.struct(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b"))).scalar()
    return (
        dates.withColumn("e", ends)
        .select("snapshot_date", F.col("e.a").alias("first_snapshot"), F.col("e.b").alias("last_snapshot"))
        .orderBy("snapshot_date")
    )
