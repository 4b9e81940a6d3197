"""Month spine and date windows."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def months_between(start: Column, end: Column) -> Column:
    """Array of first-of-month dates from the month of ``start`` up to ``end``."""
    first = F.trunc(start, "MM")
    return F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def month_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return bounds.select(F.explode(months_between(F.col("a"), F.col("b"))).alias("snapshot_date"))


def months_covered(df: DataFrame, first: str = "snapshot_date", last: str = "snapshot_date") -> DataFrame:
    """Spine from the earliest ``first`` to the latest ``last`` of a table."""
    bounds = df.agg(F.min(first).alias("a"), F.max(last).alias("b"))
    return bounds.select(F.explode(months_between(F.col("a"), F.col("b"))).alias("snapshot_date"))


def shift_month(day: date, months: int) -> date:
    """The same day ``months`` later, clipped to the length of the month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    length = (following - date(year, month + 1, 1)).days
    return date(year, month + 1, min(day.day, length))


@dataclass(frozen=True)
class Window:
    name: str
    start: date
    end: date

    def covers(self, day: Column) -> Column:
        return day.between(F.lit(self.start), F.lit(self.end))


def _day_before(day: date) -> date:
    return date.fromordinal(day.toordinal() - 1)


def four_windows(train_date: str, train=8, val=2, test=2, oot=2) -> list[Window]:
    """Adjacent windows walking back from the training date: oot, test, val, train."""
    edge, windows = date.fromisoformat(train_date), []
    for name, months in (("oot", oot), ("test", test), ("val", val), ("train", train)):
        begin = shift_month(edge, -months)
        windows.append(Window(name, begin, _day_before(edge)))
        edge = begin
    return windows


def month_windows(train_date: str, train_test=12, oot=2) -> list[Window]:
    """Windows of whole months; both ends are first-of-month snapshots."""
    this_month = date.fromisoformat(train_date).replace(day=1)
    oot_start = shift_month(this_month, -oot)
    return [
        Window("oot", oot_start, shift_month(this_month, -1)),
        Window("train_test", shift_month(oot_start, -train_test), shift_month(oot_start, -1)),
    ]


def tag_windows(df: DataFrame, windows: list[Window], column: str = "split") -> DataFrame:
    """Rows inside any window, with the window name; one pass for all splits."""
    day = F.col("snapshot_date")
    tag = F.coalesce(*[F.when(w.covers(day), F.lit(w.name)) for w in windows])
    span = day.between(F.lit(min(w.start for w in windows)), F.lit(max(w.end for w in windows)))
    return df.where(span).withColumn(column, tag).where(F.col(column).isNotNull())
