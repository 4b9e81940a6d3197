"""Counts, NULLs and extremes of stored tables from the footers of their files.

Parquet keeps row counts, NULL counts and extremes of each column in a file's footer.  Spark's own
aggregate push-down answers from there, without reading a row, if the table is read through the
newer source and all that is asked for is kept: counts of any plain column, extremes of numbers,
booleans and dates, in groups of the partition columns.  Texts have no exact extremes in a footer,
so none are asked for.

A session of its own carries the two settings, so the caller's plans are left alone.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, MapType, NumericType, StructType, DecimalType,
)

from creditloom.sources.tables import PARTITION

SETTINGS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_session(spark: SparkSession) -> SparkSession:
    other = spark.newSession()
    for name, value in SETTINGS.items():
        other.conf.set(name, value)
    return other


def counts(spark: SparkSession, path: str, partition: str = PARTITION) -> tuple[DataFrame, list[str], list[str]]:
    """Per partition: n, ``n <column>`` of values that are not NULL, ``min`` and ``max <column>``; and the columns of both kinds."""
    table = footer_session(spark).read.parquet(path)
    plain = [f for f in table.schema if f.name != partition and not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    ordered = [f.name for f in plain if isinstance(f.dataType, (NumericType, BooleanType, DateType)) and not isinstance(f.dataType, DecimalType)]
    asked = [F.count("*").alias("n")] + [F.count(F.col(f"`{f.name}`")).alias(f"n {f.name}") for f in plain]
    asked += [g(F.col(f"`{c}`")).alias(f"{n} {c}") for c in ordered for n, g in (("min", F.min), ("max", F.max))]
    keys = [partition] if partition in table.columns else []
    return table.groupBy(*keys).agg(*asked), [f.name for f in plain], ordered


def stored_profile(spark: SparkSession, path: str, partition: str = PARTITION) -> DataFrame:
    """A row per column of a stored table: n_rows, n_nulls, and the extremes of ordered columns as double or days."""
    by_partition, plain, ordered = counts(spark, path, partition)
    whole = [F.coalesce(F.sum("n"), F.lit(0)).alias("n")]
    whole += [F.coalesce(F.sum(f"`n {c}`"), F.lit(0)).alias(f"n {c}") for c in plain]
    whole += [g(F.col(f"`{n} {c}`")).alias(f"{n} {c}") for c in ordered for n, g in (("min", F.min), ("max", F.max))]
    has_partition = partition in by_partition.columns
    if has_partition:
        whole += [F.min(partition).alias("first"), F.max(partition).alias("last"), F.count_if(F.col(partition).isNull()).alias("odd")]
    row = by_partition.agg(*whole).first()  # one row, as wide as the table

    def number(value):
        return None if value is None else float(value.toordinal() - 719163 if hasattr(value, "toordinal") else value)

    rows = [
        (c, row["n"], row["n"] - row[f"n {c}"], number(row[f"min {c}"]) if c in ordered else None, number(row[f"max {c}"]) if c in ordered else None)
        for c in plain
    ]
    if has_partition:
        rows.append((partition, row["n"], 0 if not row["odd"] else None, number(row["first"]), number(row["last"])))
    return spark.createDataFrame(rows, "column_name string, n_rows long, n_nulls long, least double, greatest double")
