"""CSV extracts whose values hold line breaks, read by many tasks.

A quoted value may run over lines, so where a record begins depends on every quote before it, and the
usual reader gives such a file to one task.  Here the file is split like any text, into blocks:

1. each line counts its quotes; a block's count is odd or even;
2. running over the blocks of a file, which are few, that gives the parity at each block's start;
3. inside a block, running over its lines, the parity at each line's start: where it is even a record
   begins;
4. lines in the middle of a record go to the record that began last, in their block or in an earlier
   one.  A record of one line, which nearly all are, goes nowhere: only the others are put together
   by a shuffle.

Records are then parsed one by one.  Quotes inside values are doubled (``CSV_TEXT``), so they do not
change the parity.  The first record of each file names the columns.

Edge cases: an empty file, or one with a header alone, gives no rows; blank lines between records
are left out, as the usual reader does; a missing last line break, Windows line ends, and quotes,
commas and blank lines inside values come out as they are; a column that the header lacks is NULL.
"""

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from creditloom.sources.tables import CSV_TEXT, materialise


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, line, quotes): the lines of all files; ``block`` is where a split begins, ``seq`` orders its lines."""
    text = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value").alias("line"),
    )
    return text.withColumn("quotes", F.length("line") - F.length(F.translate("line", '"', "")))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, record): every record's text and the place where it begins."""
    # written once: all steps agree on the blocks
    found = materialise(lines(spark, path), "csv-lines")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = found.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
    starts = totals.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # a block is as long as a split, so its lines are ordered by one task
    inside = Window.partitionBy("file", "block").orderBy("seq")
    placed = found.join(starts, ["file", "block"]).withColumn(
        "open", (F.col("before") + F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("quotes")) % 2
    )
    placed = placed.withColumn("ends", (F.col("open") + F.col("quotes")) % 2 == 0)
    begin = F.when(F.col("open") == 0, F.struct("block", "seq"))
    placed = placed.withColumn("begin", F.last(begin, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    placed = materialise(placed.select("file", "block", "seq", "line", "open", "ends", "begin"), "csv-places")
    last = placed.groupBy("file", "block").agg(F.max("begin").alias("last"))
    inherited = last.select("file", "block", F.max("last").over(earlier).alias("inherited"))

    single = placed.filter((F.col("open") == 0) & F.col("ends")).select("file", "block", "seq", F.col("line").alias("record"))
    parts = placed.filter((F.col("open") == 1) | ~F.col("ends")).join(inherited, ["file", "block"])
    parts = parts.withColumn("begin", F.coalesce("begin", "inherited"))
    joined = parts.groupBy("file", "begin").agg(F.array_sort(F.collect_list(F.struct("block", "seq", "line"))).alias("lines"))
    longer = joined.select("file", "begin.block", "begin.seq", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"))
    whole = single.unionByName(longer)
    return whole.select("file", "block", "seq", F.regexp_replace("record", "\r$", "").alias("record"))


def read(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``columns`` of the extracts below ``path`` as text, found by each file's header."""
    every = records(spark, path).filter("record <> ''")
    first = every.groupBy("file").agg(F.min(F.struct("block", "seq", "record")).alias("first"))
    first = materialise(first.select("file", "first.*"), "csv-headers")
    headers = first.select("record").distinct().collect()  # as many as the extracts have layouts
    parts = []
    for (header,) in headers:
        names = next(csv.reader(io.StringIO(header)))
        schema = StructType([StructField(f"c{k}", StringType()) for k in range(len(names))])
        own = first.filter(F.col("record") == header).select("file", F.col("block").alias("b"), F.col("seq").alias("s"))
        body = every.join(own, "file").filter((F.col("block") != F.col("b")) | (F.col("seq") != F.col("s")))
        options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in CSV_TEXT.items() if k != "header"}
        parsed = body.select(F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), options).alias("r"))
        at = {name: k for k, name in reversed(list(enumerate(names)))}
        parts.append(parsed.select(*[(F.col(f"r.c{at[c]}") if c in at else F.lit(None).cast("string")).alias(c) for c in columns]))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out
