"""The four raw domain tables and the score table, as views over the warehouse tables.

The warehouse (orders, lineitem, customer, events) stands in for the lending systems.  Each table
is a lazy frame over every row; joins use the numeric customer key and give text keys at the end.
"""

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.schemas import CLICKSTREAM_COUNTERS

# Fixed value: the model that wrote the scores of the score table.
SCORE_MODEL = "credit_model_1998_12_01.pkl"

# Text rules that make the customer columns dirty (c = customer number).
ATTRIBUTE_RULES = {
    "Name": "c_name",
    "Age": """concat(cast(case when c_custkey % 50 = 13 then -500 else c_custkey % 130 end as string),
              case when c_custkey % 7 = 0 then '_' else '' end)""",
    "SSN": "case when c_custkey % 13 = 0 then '#F%$D@*&8' else concat('SSN-', cast(c_custkey as string)) end",
    "Occupation": "case when c_custkey % 11 = 0 then '_______' else c_mktsegment end",
}
FINANCIAL_RULES = {
    "Annual_Income": """concat(cast(20000 + (c_custkey * 37) % 90000 as string),
                        case when c_custkey % 8 = 0 then '_' else '' end)""",
    "Monthly_Inhand_Salary": """case when c_custkey % 14 = 3 then null
                                else cast(1500 + (c_custkey * 13) % 9000 as string) end""",
    "Num_Bank_Accounts": """case when c_custkey % 40 = 1 then '1500' when c_custkey % 41 = 0 then '-1'
                            else cast(c_custkey % 12 as string) end""",
    "Num_Credit_Card": "case when c_custkey % 43 = 0 then '1200' else cast(c_custkey % 11 as string) end",
    "Interest_Rate": "case when c_custkey % 47 = 0 then '5800' else cast(1 + c_custkey % 34 as string) end",
    "Num_of_Loan": """case when c_custkey % 41 = 1 then '-1' when c_custkey % 53 = 0 then '1496'
                      else concat(cast(c_custkey % 10 as string),
                                  case when c_custkey % 22 = 0 then '_' else '' end) end""",
    "Type_of_Loan": """case c_custkey % 6 when 0 then 'Auto Loan, and Home Equity Loan'
                       when 1 then 'Personal Loan, Student Loan' when 2 then 'Mortgage Loan'
                       when 3 then 'Not Specified, and Payday Loan' when 4 then null
                       else 'Credit-Builder Loan, Debt Consolidation Loan, and Business Loan' end""",
    "Delay_from_due_date": "cast(c_custkey % 67 - 5 as string)",
    "Num_of_Delayed_Payment": """concat(cast(c_custkey % 28 - 3 as string),
                                 case when c_custkey % 15 = 1 then '_' else '' end)""",
    "Changed_Credit_Limit": "case when c_custkey % 19 = 0 then '_' else cast(c_custkey % 30 as string) end",
    "Num_Credit_Inquiries": "cast(c_custkey % 17 as string)",
    "Credit_Mix": """case c_custkey % 5 when 0 then '_' when 1 then 'Standard' when 2 then 'Standard'
                     when 3 then 'Good' else 'Bad' end""",
    "Outstanding_Debt": """concat(cast((c_custkey * 17) % 5000 as string),
                           case when c_custkey % 21 = 0 then '_' else '' end)""",
    "Credit_Utilization_Ratio": "cast(20 + c_custkey % 30 as string)",
    "Credit_History_Age": """case when c_custkey % 17 = 0 then 'NA' when c_custkey % 16 = 0 then null
                             else concat(cast(c_custkey % 30 as string), ' Years and ',
                                         cast(c_custkey % 12 as string), ' Months') end""",
    "Payment_of_Min_Amount": "case c_custkey % 3 when 0 then 'Yes' when 1 then 'No' else 'NM' end",
    "Total_EMI_per_month": "cast((c_custkey * 7) % 1800 as string)",
    "Amount_invested_monthly": "case when c_custkey % 23 = 0 then '__10000__' else cast((c_custkey * 11) % 900 as string) end",
    "Payment_Behaviour": "case when c_custkey % 6 = 0 then '!@9#%8' else 'High_spent_Small_value_payments' end",
    "Monthly_Balance": "cast((c_custkey * 3) % 1200 as string)",
}


@lru_cache(maxsize=64)
def warehouse(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A warehouse table; its footers are read once per session."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their order: one row per loan instalment, numeric customer key."""
    lines = warehouse(spark, sf_dir, "lineitem").withColumn(
        "snapshot_date", F.trunc(F.col("l_shipdate").cast("date"), "MM")
    )
    orders = warehouse(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def loan_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return _shipments(spark, sf_dir).select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("loan_id"),
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.col("o_orderdate").cast("date").alias("loan_start_date"),
        (F.col("l_quantity").cast("int") - 1).alias("tenure"),
        F.col("l_linenumber").alias("installment_num"),
        price.alias("loan_amt"),
        (price * discount).alias("due_amt"),
        (price * discount * (1 - tax)).alias("paid_amt"),
        (price * discount * (tax * 33)).alias("overdue_amt"),
        (price * (1 - discount)).alias("balance"),
        "snapshot_date",
    )


def _customer_months(spark: SparkSession, sf_dir: str, rules: dict[str, str]) -> DataFrame:
    """One row per customer and month with a loan, carrying columns derived from the customer."""
    months = _shipments(spark, sf_dir).select("o_custkey", "snapshot_date").distinct()
    profiles = warehouse(spark, sf_dir, "customer").select(
        "c_custkey", *[F.expr(rule).alias(name) for name, rule in rules.items()]
    )
    return months.join(profiles, months.o_custkey == profiles.c_custkey).select(
        F.col("o_custkey").cast("string").alias("Customer_ID"), *rules, "snapshot_date"
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_months(spark, sf_dir, ATTRIBUTE_RULES)


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_months(spark, sf_dir, FINANCIAL_RULES)


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    level = F.floor("value").cast("int")
    month = F.make_date(
        F.lit(1996) + F.floor((event % 48) / 12).cast("int"), F.lit(1) + (event % 12).cast("int"), F.lit(1)
    )
    counters = [
        F.when((event + i) % 9 != 0, level + i - 20).alias(name)
        for i, name in enumerate(CLICKSTREAM_COUNTERS, start=1)
    ]
    return warehouse(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("Customer_ID"), month.alias("snapshot_date"), *counters
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in [0, 1] per customer and month, all under one model name.

    Kept to nine decimals, so that equal scores stay equal in whatever order their parts were added.
    """
    due, overdue = F.col("due_amt"), F.col("overdue_amt")
    return (
        loan_daily(spark, sf_dir)
        .groupBy("Customer_ID", "snapshot_date")
        .agg(F.round(F.avg(F.when(due > 0, overdue / due / 3).otherwise(0.0)), 9).alias("model_predictions"))
        .select("Customer_ID", "snapshot_date", F.lit(SCORE_MODEL).alias("model_name"), "model_predictions")
    )


RAW_TABLES = {
    "clickstream": clickstream,
    "attributes": attributes,
    "financials": financials,
    "loan_daily": loan_daily,
}
