"""From label and feature stores to model inputs: training set, matrix, scaling, encoding, weights."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.features import LOAN_PRODUCTS, product_column
from creditloom.operators.joins import many_to_one

# Columns that are no model inputs (keys, label metadata, leaking features).
NOT_FEATURES = [
    "Customer_ID", "snapshot_date", "label", "loan_id",
    "label_definition", "label_snapshot_date", "feature_snapshot_date", "Occupation",
    "mob", "dpd", "dpd_mean", "dpd_max", "Loan_overdue_amt_sum", "Loan_overdue_amt_mean",
    "Loan_overdue_amt_max", "Loan_amt_sum", "Loan_amt_mean", "Loan_amt_std",
    "Loan_balance_sum", "Loan_balance_mean", "loan_count", "Delay_from_due_date",
    "clickstream_total_events", "Age",
]

# The inputs of the tuned models.
PRODUCT_FLAGS = [product_column(p) for p in LOAN_PRODUCTS]
TUNED_FEATURES = [
    "Age", "Occupation", "Delay_from_due_date", "Outstanding_Debt", "Amount_invested_monthly",
    "Interest_Rate", "Num_Bank_Accounts", "Num_Credit_Card", *PRODUCT_FLAGS,
    "Loan_amt_sum", "Loan_amt_mean", "Loan_amt_std", "Loan_tenure_mean", "Loan_tenure_max",
    "Loan_overdue_amt_sum", "Loan_overdue_amt_mean", "Loan_overdue_amt_max",
    "Loan_balance_sum", "Loan_balance_mean", "dpd_mean", "dpd_max", "loan_count",
    "clickstream_total_events", "clickstream_fe_5_mean", "clickstream_fe_5_sum",
    "clickstream_fe_5_std", "clickstream_fe_9_mean", "clickstream_fe_9_min",
    "clickstream_fe_4_mean", "clickstream_fe_4_min", "clickstream_fe_10_mean",
    "clickstream_fe_10_min",
]
TUNED_CATEGORIES = ["Occupation", *PRODUCT_FLAGS]
TUNED_NUMERICS = [c for c in TUNED_FEATURES if c not in TUNED_CATEGORIES]


def named(column: str) -> Column:
    return F.col(f"`{column}`")


def training_set(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Labels with the features of their customer and snapshot."""
    return many_to_one(labels, features, how="inner")


def monthly_features(df: DataFrame) -> list[str]:
    """Model inputs of the monthly model: every column that is not excluded."""
    return [c for c in df.columns if c not in NOT_FEATURES and c != "split"]


def model_matrix(df: DataFrame, columns: list[str], label: str = "label", keep=()) -> DataFrame:
    """Chosen inputs and the label as int."""
    return df.select(*keep, *[named(c) for c in columns], F.col(label).cast("int").alias(label))


def fill_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """0 for NULL or NaN inputs, as double."""
    chosen = set(columns)

    def value(c: str) -> Column:
        number = named(c).cast("double")
        return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0)).alias(c)

    return df.select(*[value(c) if c in chosen else named(c) for c in df.columns])


def scale_parameters(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column: two numbers per column, from one pass.

    A column without spread is divided by 1.
    """
    filled = fill_missing(train, columns)
    stats = [F.avg(named(c)).alias(f"m{i}") for i, c in enumerate(columns)]
    stats += [F.stddev_pop(named(c)).alias(f"s{i}") for i, c in enumerate(columns)]
    row = filled.agg(*stats).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def scale(df: DataFrame, parameters: dict[str, tuple[float, float]]) -> DataFrame:
    """Standardise with parameters of the training rows."""
    filled = fill_missing(df, list(parameters))
    return filled.select(
        *[
            ((named(c) - parameters[c][0]) / parameters[c][1]).alias(c) if c in parameters else named(c)
            for c in filled.columns
        ]
    )


def categories(train: DataFrame, column: str) -> list[str]:
    """The distinct values of a category column, in text order (few: one model input each)."""
    rows = train.select(named(column).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct().collect()
    return sorted(r.v for r in rows)


def one_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """A 0/1 column for each value but the first; a value not listed is an error."""
    text = named(column).cast("string")
    known = F.when(text.isin(*values), text).otherwise(
        F.raise_error(F.concat(F.lit(f"unknown {column}: "), F.coalesce(text, F.lit("NULL"))))
    )
    return df.withColumns({f"{column}_{v}": (known == v).cast("int") for v in values[1:]})


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Per class: rows, balanced weight n/(k*n_c), and the weight neg/pos for positives.

    Without positives the latter is 1.
    """
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n_rows"))
    overall = counts.agg(
        F.sum("n_rows").alias("n"),
        F.count("*").alias("k"),
        F.coalesce(
            F.try_divide(
                F.sum(F.when(F.col("label") == 0, F.col("n_rows"))).cast("double"),
                F.sum(F.when(F.col("label") == 1, F.col("n_rows"))),
            ),
            F.lit(1.0),
        ).alias("ratio"),
    )
    # one row, looked up as a scalar
    totals = overall.select(F.struct("n", "k", "ratio")).scalar()
    return counts.withColumn("t", totals).select(
        "label",
        "n_rows",
        (F.col("t.n") / (F.col("t.k") * F.col("n_rows"))).alias("balanced_weight"),
        F.when(F.col("label") == 1, F.col("t.ratio")).otherwise(F.lit(1.0)).alias("positive_weight"),
    )
