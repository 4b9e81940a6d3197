"""Feature store: one row per customer and snapshot, from the four cleansed tables.

Each table is reduced to one row per (customer, snapshot) before any join.  All inputs of the joins
are then unique on the same two keys and already partitioned by them, so the joins need no further
exchange and a busy customer costs no more than any other.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.cleansing import UNKNOWN
from creditloom.operators.joins import many_to_one, one_per_key
from creditloom.sources.schemas import KEYS

# Loan products looked for in Type_of_Loan.
LOAN_PRODUCTS_SHORT = ["Home Loan", "Personal Loan", "Student Loan", "Auto Loan", "Business Loan"]
LOAN_PRODUCTS = [
    "Home Loan", "Personal Loan", "Student Loan", "Auto Loan", "Business Loan",
    "Credit-Builder Loan", "Home Equity Loan", "Debt Consolidation Loan",
    "Mortgage Loan", "Not Specified", "Payday Loan",
]
PRODUCT_PREFIX = "Loan_Type_"

# Columns taken over from the cleansed tables.
ATTRIBUTE_FEATURES = ["Age", "Occupation"]
FINANCIAL_FEATURES = [
    "Delay_from_due_date", "Outstanding_Debt", "Amount_invested_monthly",
    "Interest_Rate", "Num_Bank_Accounts", "Num_Credit_Card",
]
FINANCIAL_FEATURES_SHORT = [c for c in FINANCIAL_FEATURES if c != "Outstanding_Debt"]

_STATS = {"sum": F.sum, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}

# Aggregate features as (column, name stem, statistics).
LOAN_STATS = [
    ("loan_amt", "Loan_amt", ["sum", "mean", "std"]),
    ("tenure", "Loan_tenure", ["mean", "max"]),
    ("overdue_amt", "Loan_overdue_amt", ["sum", "mean", "max"]),
    ("balance", "Loan_balance", ["sum", "mean"]),
    ("dpd", "dpd", ["mean", "max"]),
]
CLICK_STATS = [
    ("fe_5", "clickstream_fe_5", ["mean", "sum", "std"]),
    ("fe_9", "clickstream_fe_9", ["mean", "min"]),
    ("fe_4", "clickstream_fe_4", ["mean", "min"]),
    ("fe_10", "clickstream_fe_10", ["mean", "min"]),
]
CLICK_STATS_SHORT = [
    ("fe_5", "fe_5", ["mean", "min"]),
    ("fe_10", "fe_10", ["mean"]),
    ("fe_9", "fe_9", ["min"]),
    ("fe_4", "fe_4", ["min"]),
]


def statistics(spec: list[tuple[str, str, list[str]]]) -> list[Column]:
    return [_STATS[s](column).alias(f"{stem}_{s}") for column, stem, stats in spec for s in stats]


def product_column(product: str) -> str:
    return PRODUCT_PREFIX + product.replace(" ", "_")


def multi_hot(df: DataFrame, products: list[str] = LOAN_PRODUCTS) -> DataFrame:
    """A 0/1 column per loan product named in Type_of_Loan."""
    named = F.col("Type_of_Loan")
    return df.withColumns(
        {product_column(p): F.when(named.contains(p), F.lit(1)).otherwise(F.lit(0)) for p in products}
    )


def product_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(PRODUCT_PREFIX)]


def customer_base(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct keys of the ledger, else of the first table that has both key columns."""
    for name in ["loan_daily", *tables]:
        table = tables.get(name)
        if table is not None and set(KEYS) <= set(table.columns):
            return table.select(*KEYS).distinct()
    raise ValueError("no table with Customer_ID and snapshot_date")


def attribute_features(attributes: DataFrame) -> DataFrame:
    present = set(attributes.columns)
    return attributes.select(*KEYS, *[c for c in ATTRIBUTE_FEATURES if c in present])


def financial_features(financials: DataFrame, products=tuple(LOAN_PRODUCTS), columns=tuple(FINANCIAL_FEATURES)) -> DataFrame:
    hot = multi_hot(financials, list(products)) if "Type_of_Loan" in financials.columns else financials
    present = hot.columns
    return hot.select(*KEYS, *[c for c in columns if c in present], *[c for c in present if c.startswith(PRODUCT_PREFIX)])


def loan_features(loans: DataFrame) -> DataFrame:
    return loans.groupBy(*KEYS).agg(*statistics(LOAN_STATS), F.count("loan_id").alias("loan_count"))


def loan_features_with_spread(loans: DataFrame) -> DataFrame:
    """As ``loan_features``, with the spread of days past due instead of the count.

    The spread is a plain grouped deviation: it equals the deviation over a window of the group.
    """
    return loans.groupBy(*KEYS).agg(
        *statistics(LOAN_STATS), F.stddev_samp("dpd").alias("loan_days_past_due_std")
    )


def dpd_spread(loans: DataFrame) -> DataFrame:
    """Ledger rows with the deviation of days past due over their customer and snapshot.

    Grouped and joined back rather than a window, which would bring a whole customer to one task.
    """
    spread = loans.groupBy(*KEYS).agg(F.stddev_samp("dpd").alias("loan_days_past_due_std"))
    return many_to_one(loans, spread, how="left")


def click_features(clicks: DataFrame) -> DataFrame:
    return clicks.groupBy(*KEYS).agg(F.count("*").alias("clickstream_total_events"), *statistics(CLICK_STATS))


def click_features_short(clicks: DataFrame) -> DataFrame:
    """Five counters.  Always aggregated: for customers with a single row the values are the same
    as taking the row over, and the mean of fe_5 is there as well."""
    return clicks.groupBy(*KEYS).agg(*statistics(CLICK_STATS_SHORT))


def fill_features(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """0 for int and floating columns, "Unknown" for text; bigint columns keep their NULLs."""
    numeric = [c for c, t in df.dtypes if t in ("int", "float", "double")]
    present = set(df.columns)
    return df.fillna(0, subset=numeric).fillna(UNKNOWN, subset=[c for c in text_columns if c in present])


def _snapshot_text() -> Column:
    return F.date_format("snapshot_date", "yyyy-MM-dd")


def feature_store(tables: dict[str, DataFrame | None]) -> DataFrame:
    """One row per customer and snapshot of the ledger, 42 features, no labels.

    Tables may be missing.  The ledger aggregate doubles as the key base, as it has exactly the
    distinct keys.  Attribute and financial rows that repeat a key are reduced to the smallest one,
    which makes the surviving row definite.
    """
    present = {name: df for name, df in tables.items() if df is not None}
    parts = {}
    if "attributes" in present:
        parts["attributes"] = one_per_key(attribute_features(present["attributes"]))
    if "financials" in present:
        parts["financials"] = one_per_key(financial_features(present["financials"]))
    if "loan_daily" in present:
        parts["loan_daily"] = loan_features(present["loan_daily"])
    if "clickstream" in present:
        parts["clickstream"] = click_features(present["clickstream"])

    base = parts["loan_daily"] if "loan_daily" in parts else customer_base(present)
    joined = base
    for name in ("attributes", "financials", "clickstream"):
        if name in parts:
            joined = joined.join(parts[name], KEYS, "left")
    filled = fill_features(joined, ["Occupation"])
    features = [c for part in parts.values() for c in part.columns if c not in KEYS]
    return filled.select(*KEYS, _snapshot_text().alias("feature_snapshot_date"), *[F.col(f"`{c}`") for c in features])


def labelled_feature_store(tables: dict[str, DataFrame | None], labels: DataFrame) -> DataFrame:
    """Features beside every label row: one row per labelled loan.

    The feature tables are unique per key and joined first; the label rows, of which one customer
    may have very many, take part in a single join only.
    """
    present = {name: df for name, df in tables.items() if df is not None}
    base = labels.select(*KEYS, "label", "label_definition")
    if "loan_daily" in present:
        wide = loan_features_with_spread(present["loan_daily"])
    else:
        wide = base.select(*KEYS).distinct()
    if "attributes" in present:
        wide = wide.join(attribute_features(present["attributes"]), KEYS, "left")
    if "financials" in present:
        short = financial_features(present["financials"], LOAN_PRODUCTS_SHORT, FINANCIAL_FEATURES_SHORT)
        wide = wide.join(short, KEYS, "left")
    if "clickstream" in present:
        wide = wide.join(click_features_short(present["clickstream"]), KEYS, "left")
    joined = many_to_one(base, wide, how="left")
    filled = fill_features(joined, [c for c, t in joined.dtypes if t == "string" and c not in ("Customer_ID", "label_definition")])
    return filled.withColumn("feature_snapshot_date", _snapshot_text())


def dedup_features(features: DataFrame) -> DataFrame:
    """Drop rows that repeat a (customer, snapshot) key, keeping the smallest."""
    return one_per_key(features)
