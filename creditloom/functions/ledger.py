"""Expressions on the loan ledger: time on book, missed instalments, days past due."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a month counts 30 days.
DAYS_PER_MONTH = 30


def months_on_book(snapshot: Column, start: Column) -> Column:
    """Days over 30, rounded half away from zero; in whole numbers, as ``round`` is slow."""
    days, half = F.datediff(snapshot, start), DAYS_PER_MONTH // 2
    magnitude = F.floor((F.abs(days) + half) / DAYS_PER_MONTH).cast("int")
    return F.when(days < 0, -magnitude).otherwise(magnitude)


def instalments_missed(overdue: Column, due: Column) -> Column:
    """Whole instalments behind; nothing due counts 0."""
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed)).otherwise(snapshot)


def dpd_by_calendar(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days between the first missed due date and the snapshot."""
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def monthly_payment(amount: Column, tenure: Column) -> Column:
    return F.when((amount > 0) & (tenure > 0), amount / tenure).otherwise(F.lit(0.0))


def dpd_by_payment(overdue: Column, payment: Column) -> Column:
    """Days past due as the share of a monthly payment that is overdue; never negative."""
    days = F.when(payment > 0, F.try_divide(overdue, payment) * DAYS_PER_MONTH).otherwise(F.lit(0.0))
    return F.when(days < 0, F.lit(0)).otherwise(F.round(days).try_cast("int"))
