"""Cleansing of the four raw tables.

Two rule sets exist.  ``cast_first`` types the raw text before cleansing it, so dirty numbers are
lost and then imputed; ``strip_first`` cleanses the text and types the result.  They differ in more
than that (bounds, imputation, days past due), so each table states its rule set in full.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions import cleansing as cl
from creditloom.functions import ledger
from creditloom.sources.schemas import CLICKSTREAM_COUNTERS, FINANCIAL_NUMERICS, TABLE_TYPES
from creditloom.sources.tables import materialise

# What counts as an implausible number.
CAST_FIRST_BOUNDS = {
    "Num_Bank_Accounts": {"missing": -1, "above": 100},
    "Num_Credit_Card": {"above": 100},
    "Interest_Rate": {"above": 100},
    "Num_of_Loan": {"missing": -1, "above": 100},
    "Delay_from_due_date": {"below": 0},
    "Num_of_Delayed_Payment": {"below": 0},
}
STRIP_FIRST_BOUNDS = {
    "Num_Bank_Accounts": {"missing": -1, "above": 100},
    "Num_Credit_Card": {"above": 100},
}

# Categories that default to "Unknown".
FINANCIAL_CATEGORIES = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Type_of_Loan"]

# Ledger columns whose NULLs become 0.
LEDGER_AMOUNTS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]

# Columns whose medians one aggregate takes; a task holds so many sketches for each snapshot.
SKETCHES_AT_ONCE = 3


def replace(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One projection that replaces the given columns, where the frame has them."""
    return df.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in df.columns])


def enforce(df: DataFrame, table: str, caster=cl.early_cast) -> DataFrame:
    """Cast every declared column that is present; others pass unchanged."""
    present = set(df.columns)
    return replace(df, {c: caster(F.col(c), t) for c, t in TABLE_TYPES[table].items() if c in present})


def enforce_early(df: DataFrame, table: str) -> DataFrame:
    """Types applied to the raw text."""
    return enforce(df, table, cl.early_cast)


def enforce_late(df: DataFrame, table: str) -> DataFrame:
    """Types applied to cleansed values; what does not convert is NULL."""
    return enforce(df, table, lambda c, t: c.try_cast(t))


def with_customer(df: DataFrame) -> DataFrame:
    return df.where(F.col("Customer_ID").isNotNull())


# -- clickstream ------------------------------------------------------------------------------


def clickstream(df: DataFrame) -> DataFrame:
    """Counters without a value count 0."""
    typed = enforce_late(df, "clickstream")
    present = set(typed.columns)
    return with_customer(typed.fillna(0, subset=[c for c in CLICKSTREAM_COUNTERS if c in present]))


# -- attributes -------------------------------------------------------------------------------


def _attributes(df: DataFrame, age: Column) -> DataFrame:
    cleansed = replace(
        df,
        {
            "Age": age,
            "SSN": cl.null_if_contains(F.col("SSN"), cl.SSN_JUNK),
            "Occupation": cl.or_unknown(cl.null_if_contains(F.col("Occupation"), cl.OCCUPATION_JUNK)),
            "snapshot_date": F.col("snapshot_date").try_cast("date"),
        },
    )
    return with_customer(cleansed)


def attributes_cast_first(df: DataFrame) -> DataFrame:
    return _attributes(df, cl.age_cast_first(F.col("Age")))


def attributes_strip_first(df: DataFrame) -> DataFrame:
    return _attributes(df, cl.age_strip_first(F.col("Age")))


# -- financials -------------------------------------------------------------------------------


def _bounded(columns: list[str], bounds: dict[str, dict], value) -> dict[str, Column]:
    return {c: cl.reject(value(c), **bounds.get(c, {})) for c in columns}


def _categories(df: DataFrame) -> dict[str, Column]:
    present = set(df.columns)
    return {c: cl.or_unknown(F.col(c)) for c in FINANCIAL_CATEGORIES if c in present}


def _scrub_categories(df: DataFrame) -> DataFrame:
    return replace(
        df,
        {
            "Credit_Mix": F.nullif(F.col("Credit_Mix"), F.lit(cl.CREDIT_MIX_JUNK)),
            "Payment_Behaviour": cl.null_if_contains(F.col("Payment_Behaviour"), cl.PAYMENT_BEHAVIOUR_JUNK),
        },
    )


def medians(df: DataFrame, columns: list[str], by: str = "snapshot_date", accuracy: int = 10_000) -> DataFrame:
    """(_by, and ``<column>__median`` for each column): each column's median in each snapshot.

    They come from mergeable sketches, so a snapshot that holds most of the rows is reduced before the
    shuffle.  A task holds a sketch for each snapshot and column, each over 1 MB once it has seen many
    rows, so SKETCHES_AT_ONCE columns make an aggregate of their own: a task's memory does not grow
    with the number of columns, and each aggregate reads only its own.
    """
    parts = [columns[k : k + SKETCHES_AT_ONCE] for k in range(0, len(columns), SKETCHES_AT_ONCE)]
    found = [
        df.groupBy(F.col(by).alias("_by")).agg(
            *[F.percentile_approx(c, 0.5, accuracy).cast("double").alias(f"{c}__median") for c in part]
        )
        for part in parts
    ]
    if len(found) == 1:
        return found[0]
    # a snapshot is one row in each part, which has no value for the columns of the others
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), found)
    return rows.groupBy("_by").agg(*[F.max(f"{c}__median").alias(f"{c}__median") for c in columns])


def impute_median(df: DataFrame, columns: list[str], by: str = "snapshot_date", accuracy: int = 10_000) -> DataFrame:
    """Fill NULLs with the column's median in the same snapshot, 0 where a snapshot has no value.

    The medians are one row per month, a size the calendar bounds, hence the broadcast.  ``df`` is read
    once for each SKETCHES_AT_ONCE columns.
    """
    found = medians(df, columns, by, accuracy)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"{c}__median"), F.lit(0.0)) for c in columns}
    joined = df.join(F.broadcast(found), F.col(by).eqNullSafe(F.col("_by")), "left")
    return replace(joined, filled).select(*df.columns)


def financials_cast_first(df: DataFrame) -> DataFrame:
    """Typed raw, bounded, median per snapshot; every number ends as double."""
    typed = enforce_early(df, "financials")
    present = set(typed.columns)
    numerics = [c for c in FINANCIAL_NUMERICS if c in present]
    bounded = replace(typed, _bounded(numerics, CAST_FIRST_BOUNDS, lambda c: F.col(c).cast("double")))
    scrubbed = _scrub_categories(bounded)
    # the medians and the rows both read it
    imputed = impute_median(materialise(scrubbed, "typed-financials"), numerics)
    return with_customer(replace(imputed, _categories(imputed)))


def financials_clean(df: DataFrame) -> DataFrame:
    """As ``financials_cast_first``, but underscores are stripped before typing and the history
    text is parsed, so that readable values survive."""
    present = set(df.columns)
    texts = [c for c in FINANCIAL_NUMERICS if c in present and c != "Credit_History_Age"]
    readable = {c: cl.strip_underscores(F.col(c)) for c in texts}
    if "Credit_History_Age" in present:
        history = F.col("Credit_History_Age")
        readable["Credit_History_Age"] = F.when(
            history.rlike(cl.HISTORY_YEARS) | history.rlike(cl.HISTORY_MONTHS), cl.history_months(history)
        ).cast("string")
    return financials_cast_first(replace(df, readable))


def financials_strip_first(df: DataFrame) -> DataFrame:
    """Safe casts of the raw text, two bounds, zeros for what is missing, then declared types."""
    present = set(df.columns)
    numerics = [c for c in FINANCIAL_NUMERICS if c in present and c != "Credit_History_Age"]
    bounded = _bounded(numerics, STRIP_FIRST_BOUNDS, lambda c: cl.safe_cast(F.col(c).cast("string"), "double"))
    columns = {c: F.coalesce(v, F.lit(0.0)) for c, v in bounded.items()}
    if "Credit_History_Age" in present:
        columns["Credit_History_Age"] = cl.history_months(F.col("Credit_History_Age").cast("string"))
    return with_customer(enforce_late(replace(df, {**columns, **_categories(df)}), "financials"))


# -- loan ledger ------------------------------------------------------------------------------


def on_book(df: DataFrame) -> DataFrame:
    """Typed ledger rows with months on book; rows before the loan start (or undated) go."""
    typed = enforce_late(df, "loan_daily")
    mob = ledger.months_on_book(F.col("snapshot_date"), F.col("loan_start_date"))
    return typed.withColumn("mob", mob).where(F.col("mob") >= 0)


def _identified(df: DataFrame) -> DataFrame:
    return df.dropna(how="any", subset=["Customer_ID", "loan_id", "loan_start_date"])


def with_calendar_dpd(df: DataFrame) -> DataFrame:
    """Missed instalments, first missed date and calendar days past due.

    Every numeric NULL counts 0 once the instalments are known.
    """
    missed = ledger.instalments_missed(F.col("overdue_amt"), F.col("due_amt"))
    filled = df.withColumn("installments_missed", missed).fillna(0)
    dated = filled.withColumn(
        "first_missed_date", ledger.first_missed_date(F.col("snapshot_date"), F.col("installments_missed"))
    )
    return dated.withColumn(
        "dpd", ledger.dpd_by_calendar(F.col("overdue_amt"), F.col("snapshot_date"), F.col("first_missed_date"))
    )


def with_payment_dpd(df: DataFrame) -> DataFrame:
    """Monthly payment and days past due as a share of it."""
    paid = df.withColumn("monthly_payment", ledger.monthly_payment(F.col("loan_amt"), F.col("tenure")))
    return paid.withColumn("dpd", ledger.dpd_by_payment(F.col("overdue_amt"), F.col("monthly_payment")))


def loan_by_calendar(df: DataFrame) -> DataFrame:
    return _identified(with_calendar_dpd(on_book(df))).fillna(0, subset=[*LEDGER_AMOUNTS, "tenure"])


def loan_by_payment(df: DataFrame) -> DataFrame:
    filled = with_payment_dpd(on_book(df)).fillna(0, subset=[*LEDGER_AMOUNTS, "tenure", "monthly_payment"])
    return _identified(filled)


CAST_FIRST = {
    "clickstream": clickstream,
    "attributes": attributes_cast_first,
    "financials": financials_cast_first,
    "loan_daily": loan_by_calendar,
}
STRIP_FIRST = {
    "clickstream": clickstream,
    "attributes": attributes_strip_first,
    "financials": financials_strip_first,
    "loan_daily": loan_by_payment,
}
