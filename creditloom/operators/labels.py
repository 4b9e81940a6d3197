"""The default label and its distribution."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LabelRule:
    """Default = at least ``dpd`` days past due, looked at from month ``mob`` on."""

    dpd: int
    mob: int = 6

    @property
    def definition(self) -> str:
        return f"DPD_{self.dpd}+_MOB_{self.mob}+"


# The thresholds in use.
PAYMENT_RULE = LabelRule(dpd=30)
CALENDAR_RULE = LabelRule(dpd=1)

# Layout of the label store and names a label column may have.
LABEL_COLUMNS = [
    "loan_id", "Customer_ID", "label", "label_definition", "label_snapshot_date", "snapshot_date", "mob", "dpd",
]
LABEL_NAMES = ["label", "default", "is_default"]


def at_least(value: Column, threshold: int) -> Column:
    """1 from the threshold on, else 0; NULL counts 0."""
    return F.when(value >= threshold, F.lit(1)).otherwise(F.lit(0))


def keep_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def label_store(loans: DataFrame, rule: LabelRule = PAYMENT_RULE) -> DataFrame:
    """One row per loan snapshot old enough to judge, for every snapshot in ``loans``."""
    judged = loans.where(F.col("mob") >= rule.mob).withColumns(
        {
            "label": at_least(F.col("dpd"), rule.dpd),
            "label_definition": F.lit(rule.definition),
            "label_snapshot_date": F.date_format("snapshot_date", "yyyy-MM-dd"),
        }
    )
    return keep_existing(judged, LABEL_COLUMNS)


def label_distribution(df: DataFrame, label: str = "label", by=()) -> DataFrame:
    return df.groupBy(*by, label).agg(F.count("*").alias("n_rows"))


def label_column(df: DataFrame, requested: str = "default") -> str:
    """The requested column, else the first usual label name present."""
    for name in [requested, *LABEL_NAMES]:
        if name in df.columns:
            return name
    raise ValueError(f"no label column: looked for {requested} and {LABEL_NAMES}")


def normalise_label(df: DataFrame, requested: str = "default") -> DataFrame:
    """Binary labels from a column that may hold the day values {0, 30}.

    Only a column whose distinct values are exactly 0 and 30 is converted.  The test is one
    aggregate with a single row, used as a scalar subquery.
    """
    name = label_column(df, requested)
    value = F.col(name)
    days = df.agg(
        (
            F.bool_and((value == 0) | (value == 30)) & F.bool_or(value == 0) & F.bool_or(value == 30)
            & (F.count("*") == F.count(value))
        ).alias("days")
    )
    binary = F.when(days.scalar(), F.when(value > 0, F.lit(1)).otherwise(F.lit(0))).otherwise(value.cast("int"))
    return df.withColumn(name, binary)


def bad_rate_by_mob(loans: DataFrame, dpd: int = 30, started_before: str = "2024-01-01") -> DataFrame:
    """Share of rows past due, by month on book, for loans started before a date."""
    started = loans.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    flagged = started.withColumn("dpd_flag", at_least(F.col("dpd"), dpd))
    return flagged.groupBy("mob").agg(F.avg("dpd_flag").alias("bad_rate")).orderBy("mob")


def instalment_bads(loans: DataFrame, installment: int = 10, dpd: int = 30, started_before: str = "2024-01-01") -> DataFrame:
    """Flagged rows of one instalment number."""
    started = loans.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))
    flagged = started.withColumn("dpd_flag", at_least(F.col("dpd"), dpd))
    return flagged.where(F.col("installment_num") == installment)
