"""Lazy tables shared by the registered queries."""

from collections.abc import Callable, Mapping
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators import features, labels, silver
from creditloom.sources import raw
from creditloom.sources.session import tune

# Added before rounding: lifts exact decimal ties, on which engines differ, off the edge.
TIE_LIFT = 1e-9


def settle(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round doubles for comparison: sums depend on row order in their last bits."""
    return df.select(
        *[
            F.round(F.col(f"`{c}`") + F.lit(TIE_LIFT), digits).alias(c) if t == "double" else F.col(f"`{c}`")
            for c, t in df.dtypes
        ]
    )


class LazyTables(Mapping):
    """Named tables, each built on first use: a query on one table builds no other."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


class Lake:
    """The raw, cleansed and gold tables over one warehouse folder; nothing runs until an action."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    @cached_property
    def raw(self) -> LazyTables:
        return LazyTables({n: partial(build, self.spark, self.sf_dir) for n, build in raw.RAW_TABLES.items()})

    def _cleansed(self, rules: dict) -> LazyTables:
        return LazyTables({name: (lambda n=name: self.raw[n].transform(rules[n])) for name in self.raw})

    @cached_property
    def cast_first(self) -> LazyTables:
        return self._cleansed(silver.CAST_FIRST)

    @cached_property
    def strip_first(self) -> LazyTables:
        return self._cleansed(silver.STRIP_FIRST)

    @cached_property
    def labels(self) -> DataFrame:
        return labels.label_store(self.strip_first["loan_daily"], labels.PAYMENT_RULE)

    @cached_property
    def calendar_labels(self) -> DataFrame:
        return labels.label_store(self.cast_first["loan_daily"], labels.CALENDAR_RULE)

    @cached_property
    def features(self) -> DataFrame:
        return features.feature_store(self.strip_first)

    @cached_property
    def predictions(self) -> DataFrame:
        return raw.predictions(self.spark, self.sf_dir)
