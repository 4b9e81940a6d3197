import datetime as dt
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from creditloom.catalog.lake import Lake
from creditloom.operators import features, labels
from creditloom.plans import cli, stages
from creditloom.sources import calendar, schemas, tables

SF = "/root/testdata/sf0.001"


def days(*texts):
    return [(dt.date.fromisoformat(t), i) for i, t in enumerate(texts)]


def test_rewriting_a_snapshot_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(days("2024-01-01", "2024-02-01", "2024-02-01"), "snapshot_date date, v int")
    tables.write_snapshots(df, path)
    again = df.where("snapshot_date = '2024-02-01'").withColumn("v", F.col("v") + 10)
    for _ in range(2):
        tables.write_snapshots(again, path)
        assert sorted(r.v for r in tables.read_table(spark, path).collect()) == [0, 11, 12]
    tables.write_snapshots(df.limit(0), path)
    assert tables.read_table(spark, path).count() == 3
    assert tables.read_table(spark, path, "2024-02-01").count() == 2
    tables.write_table(again, path)
    assert tables.read_table(spark, path).count() == 2
    assert tables.read_matching(spark, path, "*.parquet").count() == 2


def test_snapshot_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshots(spark.createDataFrame(days("2024-01-01", "2024-02-01"), "snapshot_date date, v int"), path)
    plan = tables.read_table(spark, path, "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_table_without_snapshots_passes_whole(spark):
    df = spark.createDataFrame([(1,)], "v int")
    assert tables.at_snapshot(df, "2024-01-01").count() == 1


def test_missing_table_is_none(spark, tmp_path):
    assert stages.optional(lambda: spark.read.parquet(str(tmp_path / "none"))) is None
    layout = stages.Layout(str(tmp_path))
    assert stages.cleansed(spark, layout) == {} and stages.build_gold(spark, layout) is False


def test_shared_dir_follows_the_session(spark):
    class Session:
        def __init__(self, master, **settings):
            self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": staticmethod(lambda: None)})
            self.conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: settings.get(k.replace(".", "_"), d))})

    assert tables.shared_dir(Session("yarn", spark_checkpoint_dir="hdfs://x/ckpt/"), "t").startswith("hdfs://x/ckpt/t-")
    assert "creditloom-" in tables.shared_dir(Session("local[8]"), "t")
    with pytest.raises(ValueError):
        tables.shared_dir(Session("yarn"), "t")
    assert spark.conf.get("spark.master") == spark.sparkContext.master


def test_stored_frames_release_their_disk(spark, tmp_path):
    """Shuffle files go with the write that made them, the copy with ``forget``, and the setting is as before."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {n for f in blocks.localDirsString() for _, _, names in os.walk(f) for n in names if n.startswith("shuffle_")}
    before, setting = shuffled(), spark.conf.get(tables.CLEANUP)
    stored = tables.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before and spark.conf.get(tables.CLEANUP) == setting
    assert stored.count() == 7
    folder = os.path.dirname(stored.inputFiles()[0].removeprefix("file://"))
    tables.forget(None, spark.range(1), stored)
    assert not os.path.exists(folder)
    before = shuffled()
    names = [c for c in schemas.TABLE_TYPES["attributes"] if c != "snapshot_date"]
    texts = spark.range(100).select(*[F.concat(F.lit(c), "id").alias(c) for c in names], F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    tables.write_csv(texts, str(tmp_path / "a"), "attributes")
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    assert tables.read_csv(spark, str(tmp_path / "a"), "attributes").count() == 100


def test_source_columns_are_found_by_name(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame([("2024-01-01", "x", "c1")], "snapshot_date string, Name string, Customer_ID string") \
        .write.option("header", True).csv(path)
    row = tables.read_source_csv(spark, path, "attributes").first()
    assert (row.Customer_ID, row.Name, row.Age, str(row.snapshot_date)) == ("c1", "x", None, "2024-01-01")
    tables.write_csv(tables.read_source_csv(spark, path, "attributes"), str(tmp_path / "b"), "attributes")
    back = tables.read_csv(spark, str(tmp_path / "b"), "attributes").first()
    assert back == row


def test_calendar(spark):
    spine = calendar.month_spine(spark, "2023-11-15", "2024-02-01")
    got = sorted(str(r.snapshot_date) for r in spine.collect())
    assert got == ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]
    assert calendar.month_spine(spark, "2024-03-01", "2024-02-01").isEmpty()
    spans = {w.name: (str(w.start), str(w.end)) for w in calendar.four_windows("2024-12-01")}
    assert spans == {
        "oot": ("2024-10-01", "2024-11-30"), "test": ("2024-08-01", "2024-09-30"),
        "val": ("2024-06-01", "2024-07-31"), "train": ("2023-10-01", "2024-05-31"),
    }
    spans = {w.name: (str(w.start), str(w.end)) for w in calendar.month_windows("2024-06-20")}
    assert spans == {"oot": ("2024-04-01", "2024-05-01"), "train_test": ("2023-04-01", "2024-03-01")}
    assert calendar.shift_month(dt.date(2024, 3, 31), -1) == dt.date(2024, 2, 29)
    assert calendar.shift_month(dt.date(2024, 1, 31), -2) == dt.date(2023, 11, 30)


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """The raw tables as source CSV extracts."""
    root = tmp_path_factory.mktemp("sources")
    paths = {}
    for name, df in Lake(spark, SF).raw.items():
        paths[name] = str(root / name)
        df.write.option("header", True).csv(paths[name])
    return paths


def test_command_line_from_sources_to_report(spark, sources, tmp_path):
    root, given = str(tmp_path / uuid.uuid4().hex), [x for n, p in sources.items() for x in (f"--{n}", p)]
    layout = stages.Layout(root)
    assert cli.main(["backfill", "--root", root, "--start", "1997-08-01", "--end", "1998-12-01", *given]) == 0
    lake = Lake(spark, SF)
    in_range = F.col("snapshot_date").between("1997-08-01", "1998-12-01")
    expected = lake.labels.where(in_range)
    stored = tables.read_table(spark, layout.labels).select(*expected.columns)
    assert stored.count() == expected.count() and stored.exceptAll(expected).isEmpty()
    assert tables.read_table(spark, layout.features).count() == lake.features.where(in_range).count()

    # one more snapshot on its own, and the same one twice
    one = ["--root", root, "--snapshotdate", "1999-01-01"]
    for _ in range(2):
        cli.main(["bronze", *one, *given])
        cli.main(["silver", *one])
        cli.main(["gold", *one])
    month = lake.labels.where("snapshot_date = '1999-01-01'")
    assert tables.read_table(spark, layout.labels, "1999-01-01").count() == month.count()
    assert tables.read_table(spark, layout.labels).where(in_range).count() == expected.count()

    train = ["--root", root, "--train_date", "1998-12-01", "--n_iter", "1", "--cv_folds", "2"]
    assert cli.main(["train-monthly", *train]) == 0
    assert cli.main(["train", *train, "--recipe", "logistic", "--label_col", "label", "--sample_frac", "0.9"]) == 0
    name = "credit_model_1998_12_01"
    assert cli.main(["score", "--root", root, "--model_name", name, "--start", "1998-06-01", "--end", "1998-12-01"]) == 0
    code = cli.main(["monitor", "--root", root, "--model_label", name, "--snapshotdate", "1998-12-01",
                     "--baseline_date", "1998-06-01", "--with_labels"])
    assert code in (0, 1, 2)
    assert cli.main(["retrain-check", "--root", root, "--as_of", "2000-01-01"]) == 1
    runs = tables.read_table(spark, layout.runs)
    assert {r.model_type for r in runs.select("model_type").distinct().collect()} == {"monthly_gbt", "logistic"}


def test_labelled_gold_keeps_its_own_folder(spark, sources, tmp_path):
    root = str(tmp_path)
    layout = stages.Layout(root)
    files = stages.source_files(spark, sources)
    span = stages.Span("1998-11-01", "1998-12-01")
    stages.ingest(files, layout, span)
    stages.refine(spark, layout, cli.RULES["cast_first"], span)
    assert stages.build_labelled_gold(spark, layout, span=span)
    lake = Lake(spark, SF)
    recent = lake.calendar_labels.where("snapshot_date between '1998-11-01' and '1998-12-01'")
    store = tables.read_table(spark, layout.labelled_features)
    assert tables.read_table(spark, layout.labels).count() == recent.count() == store.count()
    assert set(store.columns) == set(features.labelled_feature_store(lake.cast_first, lake.calendar_labels).columns)
    assert labels.CALENDAR_RULE.definition == store.first().label_definition


def test_text_survives_csv(spark, tmp_path):
    odd = ' a "quoted", text\nwith \\ and blanks '
    names = [c for c in schemas.TABLE_TYPES["attributes"] if c != "snapshot_date"]
    df = spark.createDataFrame([(odd,) * len(names)], ", ".join(f"`{c}` string" for c in names))
    df.write.options(**tables.CSV_TEXT).csv(str(tmp_path / "b"))
    found = tables.read_source_csv(spark, str(tmp_path / "b"), "attributes", multi_line=True).collect()
    assert len(found) == 1 and all(found[0][c] == odd for c in names)
    tables.write_csv(df.withColumn("snapshot_date", F.lit("2024-01-01").cast("date")), str(tmp_path / "a"), "attributes")
    back = tables.read_csv(spark, str(tmp_path / "a"), "attributes").collect()
    assert len(back) == 1 and all(back[0][c] == odd for c in names)


def test_text_is_gathered_as_lines(spark, tmp_path):
    """Text of all kinds comes back from the lines it was shuffled as, and the copy is compressed."""
    odd = [None, "", " ", "a,b", '"', '""', "a\nb", "a\r\nb", "\r", "\\", "\\\"", "#c", "null", "é", "'", "\t", "a\"b,c\"\n"]
    columns = [c for c in schemas.TABLE_TYPES["attributes"] if c != "snapshot_date"]
    rows = [tuple(odd[(i + j * k) % len(odd)] for j in range(len(columns))) for k in range(3) for i in range(len(odd))]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    ordered = lambda some: sorted(map(repr, some))
    assert ordered(tables._gathered_as_text(df).collect()) == ordered(df.collect())
    tables.write_csv(df, str(tmp_path / "a"), "attributes")
    assert list((tmp_path / "a").glob("*/*.csv.gz")) and not list((tmp_path / "a").glob("*/*.csv"))
    direct = tables._gathered(df.select(*schemas.TABLE_TYPES["attributes"])).write.options(**tables.CSV_TEXT).partitionBy("snapshot_date")
    direct.csv(str(tmp_path / "b"))
    read = [ordered(tables.read_csv(spark, str(tmp_path / x), "attributes").collect()) for x in "ab"]
    assert read[0] == read[1]
