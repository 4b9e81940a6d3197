"""The raw, cleansed and gold stages as jobs over a folder of partitioned tables.

A stage handles one snapshot, a range of months, or everything in one job per table; there is no
loop over months.  Snapshots written again replace themselves and leave the others alone.
"""

import hashlib
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators import features, labels, silver
from creditloom.sources import calendar, tables
from creditloom.sources.schemas import TABLE_TYPES


@dataclass(frozen=True)
class Layout:
    """Where the tables live below one root."""

    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    @property
    def labels(self) -> str:
        return f"{self.root}/gold/label_store"

    @property
    def features(self) -> str:
        return f"{self.root}/gold/feature_store"

    @property
    def labelled_features(self) -> str:
        return f"{self.root}/gold/labelled_feature_store"

    @property
    def predictions(self) -> str:
        return f"{self.root}/gold/model_predictions"

    @property
    def runs(self) -> str:
        return f"{self.root}/gold/model_runs"

    def snapshot_tables(self) -> list[tuple[str, tuple[str, ...]]]:
        """The tables that can keep versions, with their partition columns."""
        day = (tables.PARTITION,)
        stores = [*map(self.silver, TABLE_TYPES), self.labels, self.features, self.labelled_features]
        return [(path, day) for path in stores] + [(self.predictions, ("model_name", *day))]

    def monitoring(self, model: str, snapshot: str) -> str:
        return f"{self.root}/gold/model_monitoring/{model}/{snapshot}"

    @property
    def digests(self) -> str:
        return f"{self.root}/input_digests"

    def search(self, name: str) -> str:
        return f"{self.root}/models/_search/{name}"

    def model(self, version: str) -> str:
        return f"{self.root}/models/{version}"


@dataclass(frozen=True)
class Span:
    """The snapshots a stage works on: both ends included, open where None."""

    start: str | None = None
    end: str | None = None
    #: Of those, only these; all where None.
    months: tuple[str, ...] | None = None

    @staticmethod
    def of(snapshot: str) -> "Span":
        return Span(snapshot, snapshot)

    def apply(self, df: DataFrame) -> DataFrame:
        """Prune to the span; a table without snapshots passes whole."""
        if tables.PARTITION not in df.columns:
            return df
        day = F.col(tables.PARTITION)
        if self.start:
            df = df.where(day >= F.lit(self.start).cast("date"))
        if self.end:
            df = df.where(day <= F.lit(self.end).cast("date"))
        if self.months is not None:
            df = df.where(day.isin([date.fromisoformat(m) for m in self.months]))
        return df


def months(spark: SparkSession, df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows on the first-of-month spine of a range.  The spine has one row per month."""
    spine = calendar.month_spine(spark, start, end)
    return df.join(F.broadcast(spine), tables.PARTITION, "left_semi")


def optional(read) -> DataFrame | None:
    """A table, or None where its folder does not exist or holds no file yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    except FileNotFoundError:  # a versioned table without a commit
        return None


def ingest(sources: dict[str, DataFrame], layout: Layout, span: Span = Span()) -> None:
    """Source tables to raw text, partitioned by snapshot."""
    for name, df in sources.items():
        tables.write_csv(span.apply(df), layout.bronze(name), name)


def source_files(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: tables.read_source_csv(spark, path, name) for name, path in paths.items()}


def _write(df: DataFrame, path: str, whole: bool) -> None:
    (tables.write_table if whole else tables.write_snapshots)(df, path)


def refine(
    spark: SparkSession, layout: Layout, rules: dict = silver.STRIP_FIRST, span: Span = Span(), whole: bool = False
) -> None:
    """Raw text to cleansed tables.  ``whole`` replaces the tables instead of the snapshots."""
    for name in TABLE_TYPES:
        raw = optional(lambda n=name: tables.read_csv(spark, layout.bronze(n), n))
        if raw is not None:
            _write(span.apply(raw).transform(rules[name]), layout.silver(name), whole)


def cleansed(spark: SparkSession, layout: Layout, span: Span = Span()) -> dict[str, DataFrame]:
    """The cleansed tables that exist and hold rows of the span."""
    found = {name: optional(lambda n=name: tables.read_table(spark, layout.silver(n))) for name in TABLE_TYPES}
    pruned = {name: span.apply(df) for name, df in found.items() if df is not None}
    return {name: df for name, df in pruned.items() if not df.isEmpty()}


def build_gold(
    spark: SparkSession, layout: Layout, rule: labels.LabelRule = labels.PAYMENT_RULE, span: Span = Span(),
    whole: bool = False,
) -> bool:
    """Label and feature store of the span; False, with nothing written, when it has no rows.

    An empty result writes no partition.
    """
    present = cleansed(spark, layout, span)
    if not present:
        return False
    if "loan_daily" in present:
        _write(labels.label_store(present["loan_daily"], rule), layout.labels, whole)
    _write(features.feature_store(present), layout.features, whole)
    return True


def build_labelled_gold(
    spark: SparkSession, layout: Layout, rule: labels.LabelRule = labels.CALENDAR_RULE, span: Span = Span()
) -> bool:
    """Label store and the feature store that carries the labels, each in a folder of its own."""
    present = cleansed(spark, layout, span)
    if "loan_daily" not in present:
        return False
    store = labels.label_store(present["loan_daily"], rule)
    tables.write_snapshots(store, layout.labels)
    tables.write_snapshots(features.labelled_feature_store(present, store), layout.labelled_features)
    return True


def input_digests(sources: dict[str, DataFrame], rules: str) -> DataFrame:
    """(snapshot_date, table_name, rules, n_rows, digest): what each month's input of each table is.

    A sum over hashes of rows: one aggregate a table, whatever the order of rows and files.
    """
    parts = []
    for name, df in sources.items():
        row = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
        sums = df.groupBy(tables.PARTITION).agg(F.count("*").alias("n_rows"), F.sum(row.cast("decimal(20,0)")).cast("string").alias("digest"))
        parts.append(sums.select(tables.PARTITION, F.lit(name).alias("table_name"), F.lit(rules).alias("rules"), "n_rows", "digest"))
    return reduce(DataFrame.unionByName, parts)


def changed_months(spark: SparkSession, now: DataFrame, layout: Layout) -> list[str]:
    """Months whose digests are not those that the last backfill stored."""
    stored = optional(lambda: tables.read_table(spark, layout.digests))
    columns = [tables.PARTITION, "table_name", "rules", "n_rows", "digest"]
    new = now if stored is None else now.select(columns).exceptAll(stored.select(columns))
    return sorted(str(r[0]) for r in new.select(tables.PARTITION).distinct().collect())


def rule_text(rules: dict, rule: labels.LabelRule) -> str:
    """A name for the rules that a month was made with."""
    return hashlib.sha256(repr((sorted((k, getattr(f, "__qualname__", repr(f))) for k, f in rules.items()), rule)).encode()).hexdigest()[:16]


def backfill(
    spark: SparkSession, sources: dict[str, DataFrame], layout: Layout, start: str, end: str,
    rules: dict = silver.STRIP_FIRST, rule: labels.LabelRule = labels.PAYMENT_RULE, force: bool = True,
) -> list[str]:
    """All three stages for the months of a range, one job per table; the months that were made.

    Unless ``force``, only months whose input, or whose rules, are not those of the last backfill.
    Digests are stored last, so what was cut off is made again.
    """
    spine_rows = {name: months(spark, df, start, end) for name, df in sources.items()}
    digests = tables.materialise(input_digests(spine_rows, rule_text(rules, rule)), "digests")
    if force:
        wanted = sorted(str(r[0]) for r in digests.select(tables.PARTITION).distinct().collect())
    else:
        wanted = changed_months(spark, digests, layout)
    if not wanted:
        return []
    span = Span(start, end, tuple(wanted))
    ingest(spine_rows, layout, span)
    refine(spark, layout, rules, span)
    build_gold(spark, layout, rule, span)
    tables.write_snapshots(span.apply(digests), layout.digests)
    return wanted
