"""Reading and writing snapshot tables.

One Parquet dataset per table, partitioned by snapshot.  Writing a snapshot replaces only the
partitions it holds (dynamic overwrite), so a rerun after a lost job is safe.  Executors write; no
rows pass through the driver.  A table with a commit log (``versions``) is read and written through
it, so that readers never see half a write.
"""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.schemas import TABLE_TYPES

PARTITION = "snapshot_date"

# Session setting: shuffle files go when the job that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Text comes back as it was: quotes are doubled and outer blanks kept.
CSV_TEXT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the session's shared checkpoint folder.

    Falls back to a local temporary folder only for a local session, where every task sees it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="creditloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each ends.

    Otherwise they stay until the driver happens to collect its garbage: a run of many steps then
    keeps on disk what all of them shuffled, and not only the step at work.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # of stored frames


def materialise(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back; without ``compression``, as the session writes.

    For frames that several jobs go over: they neither repeat the joins behind it nor depend on
    blocks of an executor that may be lost.  ``forget`` removes the copy.
    """
    path = shared_dir(df.sparkSession, purpose)
    with releasing_shuffles(df.sparkSession):
        df.write.parquet(path, compression=compression)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[stored] = path
    return stored


def forget(*stored: DataFrame | None) -> None:
    """Remove the copies of frames that ``materialise`` returned, once nothing reads them any more."""
    for df in stored:
        if df is not None and (path := _FOLDERS.pop(df, None)):
            discard(df.sparkSession, path)


def filesystem(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = filesystem(spark, path)
    return files.exists(place)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run wrote, if it is there."""
    files, place = filesystem(spark, path)
    files.delete(place, True)


class Kept:
    """One stored frame at a time: writing the next removes the copy before."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.purpose, self.path = spark, purpose, None

    def replace(self, df: DataFrame) -> DataFrame:
        path = shared_dir(self.spark, self.purpose)
        with releasing_shuffles(self.spark):
            df.write.parquet(path)
        self.drop()
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        if self.path:
            discard(self.spark, self.path)
        self.path = None


def _gathered(df: DataFrame, partition_by=(PARTITION,)) -> DataFrame:
    """Rows of a snapshot brought together before a partitioned write.

    Without it every task writes a file into every snapshot.  ``rebalance`` lets adaptive execution
    aim for files of even size: small snapshots share a task, a huge one is split over many.
    """
    return df.hint("rebalance", *partition_by)


def write_snapshots(df: DataFrame, path: str, partition_by=(PARTITION,)) -> None:
    """Replace the partitions present in ``df``; other snapshots stay."""
    from creditloom.sources import versions

    if versions.is_versioned(df.sparkSession, path):
        return versions.VersionedTable(df.sparkSession, path, partition_by).write(df)
    (
        _gathered(df, partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    """Replace the whole table, still partitioned by snapshot."""
    from creditloom.sources import versions

    if versions.is_versioned(df.sparkSession, path):
        return versions.VersionedTable(df.sparkSession, path).write(df, whole=True)
    (
        _gathered(df).write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(PARTITION)
        .parquet(path)
    )


def read_table(spark: SparkSession, path: str, snapshot: str | None = None) -> DataFrame:
    """A whole table, or one snapshot of it by partition pruning."""
    from creditloom.sources import versions

    if versions.is_versioned(spark, path):
        return versions.VersionedTable(spark, path).read(**({PARTITION: snapshot} if snapshot else {}))
    return at_snapshot(spark.read.parquet(path), snapshot) if snapshot else spark.read.parquet(path)


def read_paths(spark: SparkSession, paths: list[str], root: str | None = None) -> DataFrame:
    """Several partition folders of one table as one frame."""
    reader = spark.read.option("mergeSchema", "false")
    return (reader.option("basePath", root) if root else reader).parquet(*paths)


def read_matching(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files below ``path`` whose name matches a glob pattern."""
    return spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").parquet(path)


def at_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of one snapshot; a table without snapshots passes whole."""
    return df.where(F.col(PARTITION) == F.lit(snapshot).cast("date")) if PARTITION in df.columns else df


def between_snapshots(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col(PARTITION).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def _gathered_as_text(df: DataFrame) -> DataFrame:
    """``_gathered``, with the text columns shuffled as one line if most columns are text.

    Twenty short texts take more than twice the bytes of a line that holds them.
    """
    texts = [c for c, t in df.dtypes if t == "string"]
    if 2 * len(texts) <= len(df.columns):
        return _gathered(df)
    line = F.to_json(F.array(*[F.col(f"`{c}`") for c in texts])).alias("_line")
    rest = [F.col(f"`{c}`") for c in df.columns if c not in texts]
    gathered = _gathered(df.select(line, *rest)).select(F.from_json("_line", "array<string>").alias("_texts"), *rest)
    return gathered.select(*[F.col("_texts")[texts.index(c)].alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def write_csv(df: DataFrame, path: str, table: str) -> None:
    """Text copy with a header, columns in declared order, one folder per snapshot, compressed.

    As values may hold line breaks, a file is read by one task in any case: compression costs no
    task, and leaves a fraction of the text to be written.
    """
    text = _gathered_as_text(df.select(*TABLE_TYPES[table]))
    with releasing_shuffles(df.sparkSession):
        (
            text.write.mode("overwrite")
            .options(**CSV_TEXT, compression="gzip")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(PARTITION)
            .csv(path)
        )


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw text table under its explicit schema, checked against the header; the snapshot comes
    from the folder name.

    Values may hold line breaks, so a file is read by one task; ``write_csv`` keeps files small.
    """
    names = list(TABLE_TYPES[table])
    body = ", ".join(f"`{c}` string" for c in names if c != PARTITION)
    reader = spark.read.options(**CSV_TEXT, multiLine=True).option("enforceSchema", False).schema(f"{body}, {PARTITION} date")
    return reader.csv(path).select(*names)


def read_source_csv(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """A source extract as text: columns are found by their header names, in any order, and a
    declared column the extract lacks is NULL.

    ``multi_line`` is for extracts whose values hold line breaks; they are split by records.
    """
    if multi_line:
        from creditloom.sources import csv_blocks

        found = csv_blocks.read(spark, path, list(TABLE_TYPES[table]))
    else:
        found = spark.read.options(**CSV_TEXT).csv(path)
    present = set(found.columns)
    text = {c: F.col(c) if c in present else F.lit(None).cast("string") for c in TABLE_TYPES[table]}
    return found.select(*[(v.try_cast("date") if c == PARTITION else v).alias(c) for c, v in text.items()])


def availability(tables: dict[str, DataFrame], snapshot: str) -> DataFrame:
    """One row per table: does it hold the snapshot?  A single row per table is ever read."""
    checks = [
        at_snapshot(df, snapshot).select(F.lit(1)).limit(1)
        .agg(F.lit(name).alias("table_name"), (F.count("*") > 0).alias("available"))
        for name, df in tables.items()
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result
