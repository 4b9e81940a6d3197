from pyspark.sql import functions as F

from creditloom.sources import footers, tables


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_profile_reads_footers_alone(spark, tmp_path):
    df = spark.range(1000).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("a b"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("text"),
        (F.col("id") / 3).alias("ratio"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("day"),
        F.array("id").alias("list"), F.add_months(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("snapshot_date"),
    )
    path = str(tmp_path / "t")
    tables.write_snapshots(df, path)
    by_month, plain, ordered = footers.counts(spark, path)
    assert "PushedAggregation: [COUNT(*), COUNT(`a b`)" in _plan(by_month).replace("COUNT(a b)", "COUNT(`a b`)")
    assert plain == ["a b", "text", "ratio", "day"] and ordered == ["a b", "ratio", "day"]
    got = {r.column_name: tuple(r)[1:] for r in footers.stored_profile(spark, path).collect()}
    assert got["a b"] == (1000, 143, 1.0, 999.0) and got["text"] == (1000, 500, None, None)
    assert got["ratio"] == (1000, 0, 0.0, 333.0) and got["day"] == (1000, 0, 19723.0, 19762.0)
    assert got["snapshot_date"] == (1000, 0, 19723.0, 19783.0)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was
