"""Column names and types of the raw and cleansed tables.

Raw sources are read as text wherever a value can be dirty, so that nothing is lost before the
cleansing step decides what a value means.  Amounts are double from the cleansed layer on.
"""

KEYS = ["Customer_ID", "snapshot_date"]

# The column names of the input tables and their declared types.
CLICKSTREAM_COUNTERS = [f"fe_{i}" for i in range(1, 21)]

ATTRIBUTE_TYPES = {
    "Customer_ID": "string",
    "Name": "string",
    "Age": "int",
    "SSN": "string",
    "Occupation": "string",
    "snapshot_date": "date",
}

FINANCIAL_TYPES = {
    "Customer_ID": "string",
    "Annual_Income": "double",
    "Monthly_Inhand_Salary": "double",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "double",
    "Num_of_Loan": "int",
    "Type_of_Loan": "string",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "double",
    "Num_Credit_Inquiries": "int",
    "Credit_Mix": "string",
    "Outstanding_Debt": "double",
    "Credit_Utilization_Ratio": "double",
    "Credit_History_Age": "double",
    "Payment_of_Min_Amount": "string",
    "Total_EMI_per_month": "double",
    "Amount_invested_monthly": "double",
    "Payment_Behaviour": "string",
    "Monthly_Balance": "double",
    "snapshot_date": "date",
}

LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "double",
    "due_amt": "double",
    "paid_amt": "double",
    "overdue_amt": "double",
    "balance": "double",
    "snapshot_date": "date",
}

CLICKSTREAM_TYPES = {
    **{name: "int" for name in CLICKSTREAM_COUNTERS},
    "Customer_ID": "string",
    "snapshot_date": "date",
}

TABLE_TYPES = {
    "clickstream": CLICKSTREAM_TYPES,
    "attributes": ATTRIBUTE_TYPES,
    "financials": FINANCIAL_TYPES,
    "loan_daily": LOAN_TYPES,
}

FINANCIAL_NUMERICS = [c for c, t in FINANCIAL_TYPES.items() if t in ("int", "double")]

