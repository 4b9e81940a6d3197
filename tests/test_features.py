import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.catalog.lake import Lake
from creditloom.operators import features, labels, modelling
from creditloom.operators.joins import many_to_one, one_per_key

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 1)
KEYED = "Customer_ID string, snapshot_date date"


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, SF)


def test_one_row_per_key_also_with_repeated_attributes(spark, lake):
    tables = dict(lake.strip_first)
    people = tables["attributes"]
    tables["attributes"] = people.unionByName(people.withColumn("Age", F.col("Age") + 1))
    got = features.feature_store(tables)
    assert got.count() == 2639
    assert got.exceptAll(features.feature_store(dict(lake.strip_first))).isEmpty()


def test_bigint_features_keep_nulls(lake):
    missing = lake.features.where(F.col("clickstream_total_events").isNull())
    assert missing.count() > 0
    assert missing.where("clickstream_fe_5_mean <> 0 or clickstream_fe_9_min <> 0 or clickstream_fe_5_sum is not null").isEmpty()


def test_missing_tables(lake):
    only = features.feature_store({"clickstream": lake.strip_first["clickstream"], "loan_daily": None})
    assert only.count() == lake.strip_first["clickstream"].select("Customer_ID", "snapshot_date").distinct().count()
    with pytest.raises(ValueError):
        features.feature_store({"loan_daily": None})


def test_grouped_spread_equals_window(lake):
    loans = lake.cast_first["loan_daily"]
    window = F.stddev_samp("dpd").over(Window.partitionBy("Customer_ID", "snapshot_date"))
    columns = ["loan_id", "Customer_ID", "snapshot_date", "dpd", F.round("s", 6).alias("s")]
    a = loans.withColumn("s", window).select(*columns)
    b = features.dpd_spread(loans).withColumnRenamed("loan_days_past_due_std", "s").select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_label_store_treats_unknown_dpd_as_good(spark):
    loans = spark.createDataFrame(
        [("l", "c", DAY, 6, None), ("l", "c", DAY, 6, 30), ("l", "c", DAY, 5, 99)],
        f"loan_id string, {KEYED}, mob int, dpd int",
    )
    rows = labels.label_store(loans).orderBy("dpd").collect()
    assert [r.label for r in rows] == [0, 1]
    assert rows[0].label_definition == "DPD_30+_MOB_6+" and rows[0].label_snapshot_date == "2024-01-01"


def test_labels_are_normalised_only_for_exactly_0_and_30(spark):
    def run(values):
        df = spark.createDataFrame([(v,) for v in values], "is_default int")
        return [r.is_default for r in labels.normalise_label(df).collect()]

    assert run([0, 30, 30]) == [0, 1, 1]
    assert run([0, 30, 60]) == [0, 30, 60]
    assert run([30, 30]) == [30, 30]
    assert run([0, 1]) == [0, 1]
    assert run([0, 30, None]) == [0, 30, None]
    with pytest.raises(ValueError):
        labels.label_column(spark.createDataFrame([], "x int"))


def test_one_per_key_puts_nulls_first(spark):
    df = spark.createDataFrame([("a", DAY, 2, "x"), ("a", DAY, None, "z"), ("b", DAY, 1, "q")], f"{KEYED}, n int, t string")
    assert sorted((r.Customer_ID, r.n, r.t) for r in one_per_key(df).collect()) == [("a", None, "z"), ("b", 1, "q")]


def test_hot_key_join_is_split(spark):
    """Adaptive execution splits the partition of a key that holds a third of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(0, 60000, 1, 8)
        hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 5000))
        many = rows.select(hot.alias("Customer_ID"), F.lit(DAY).alias("snapshot_date"), "id", F.sha2(F.col("id").cast("string"), 256).alias("p"))
        one = many.groupBy("Customer_ID", "snapshot_date").agg(F.count("*").alias("n"))
        joined = many_to_one(many, one, how="left")
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 60000
        frame = many_to_one(many, one, how="left")
        frame.foreach(lambda row: None)
        frame.collect()
        assert "skew=true" in frame._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_scaling_and_weights(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (2.0, 5.0, 0), (3.0, 5.0, 1), (None, 5.0, 1)], "a double, b double, label int")
    parameters = modelling.scale_parameters(df, ["a", "b"])
    assert parameters["a"] == (1.5, pytest.approx(1.25**0.5)) and parameters["b"] == (5.0, 1.0)
    assert [r.a for r in modelling.scale(df, parameters).collect()][3] == pytest.approx(-1.5 / 1.25**0.5)
    weights = {r.label: r for r in modelling.class_weights(df.limit(3)).collect()}
    assert weights[1].positive_weight == 2.0 and weights[0].balanced_weight == 0.75
    single = modelling.class_weights(df.where("label = 0")).first()
    assert (single.balanced_weight, single.positive_weight) == (1.0, 1.0)


def test_one_hot_rejects_unknown_values(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    values = modelling.categories(df, "x")
    assert [tuple(r) for r in modelling.one_hot(df, "x", values).collect()] == [("b", 1, 0), ("a", 0, 0), ("c", 0, 1)]
    with pytest.raises(Exception, match="unknown x"):
        modelling.one_hot(df, "x", ["a", "b"]).collect()
