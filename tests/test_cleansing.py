import datetime as dt

from pyspark.sql import functions as F

from creditloom.functions import cleansing as cl
from creditloom.functions import ledger
from creditloom.operators import silver


def values(spark, column, inputs, type_name="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {type_name}")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_age_rule_sets_differ_on_underscores(spark):
    ages = ["23", "23_", "-500", "101", "100", "17", "18", "", "_", "abc", None, "23.9", "99999999999"]
    assert values(spark, cl.age_cast_first, ages) == [23, 0, 0, 0, 100, 0, 18, 0, 0, 0, 0, 23, 0]
    assert values(spark, cl.age_strip_first, ages) == [23, 23, 0, 0, 100, 0, 18, 0, 0, 0, 0, 0, 0]


def test_safe_cast_gives_null_on_junk(spark):
    texts = ["1.5", " 2 ", "3_", "", "NA", "1 2", None, "-4e2"]
    assert values(spark, lambda c: cl.safe_cast(c, "double"), texts) == [1.5, 2.0, None, None, None, None, None, -400.0]


def test_history_months(spark):
    texts = ["10 Years and 3 Months", "2 Years", "and 5 Months", "NA", None, "", "x 1 Years"]
    assert values(spark, cl.history_months, texts) == [123.0, 24.0, 5.0, 0.0, 0.0, 0.0, 0.0]


def test_reject_keeps_null_and_bounds(spark):
    got = values(spark, lambda c: cl.reject(c, missing=-1, above=100), [-1, 101, 100, -5, None], "int")
    assert got == [None, None, 100, -5, None]


def test_months_on_book_rounds_half_away_from_zero(spark):
    start = dt.date(2024, 3, 1)
    days = [0, 14, 15, 44, 45, 75, -14, -15, -45]
    df = spark.createDataFrame([(d, start, start + dt.timedelta(days=d)) for d in days], "d int, a date, b date")
    rounded = F.round(F.datediff("b", "a") / 30).cast("int")
    rows = df.select("d", ledger.months_on_book(F.col("b"), F.col("a")).alias("m"), rounded.alias("r")).collect()
    assert {r.d: r.m for r in rows} == {0: 0, 14: 0, 15: 1, 44: 1, 45: 2, 75: 3, -14: 0, -15: -1, -45: -2}
    assert all(r.m == r.r for r in rows)


LOAN = (
    "loan_id string, Customer_ID string, loan_start_date date, tenure int, installment_num int, loan_amt double, "
    "due_amt double, paid_amt double, overdue_amt double, balance double, snapshot_date date"
)


def loans(spark, **changes):
    row = dict(
        loan_id="l", Customer_ID="c", loan_start_date=dt.date(2024, 1, 1), tenure=10, installment_num=1, loan_amt=1000.0,
        due_amt=100.0, paid_amt=0.0, overdue_amt=150.0, balance=1000.0, snapshot_date=dt.date(2024, 5, 31),
    )
    row.update(changes)
    return spark.createDataFrame([tuple(row.values())], LOAN)


def test_calendar_dpd(spark):
    row = silver.loan_by_calendar(loans(spark)).first()
    assert (row.mob, row.installments_missed, row.first_missed_date) == (5, 2, dt.date(2024, 3, 31))
    assert row.dpd == 61
    nothing_due = silver.loan_by_calendar(loans(spark, due_amt=0.0)).first()
    assert (nothing_due.installments_missed, nothing_due.dpd) == (0, 0)
    unknown = silver.loan_by_calendar(loans(spark, overdue_amt=None, tenure=None)).first()
    assert (unknown.overdue_amt, unknown.tenure, unknown.dpd) == (0.0, 0, 0)


def test_payment_dpd(spark):
    row = silver.loan_by_payment(loans(spark)).first()
    assert (row.monthly_payment, row.dpd) == (100.0, 45)
    assert silver.loan_by_payment(loans(spark, tenure=0)).first().dpd == 0
    assert silver.loan_by_payment(loans(spark, overdue_amt=-50.0)).first().dpd == 0
    unknown = silver.loan_by_payment(loans(spark, overdue_amt=None)).first()
    assert unknown.dpd is None and unknown.overdue_amt == 0.0


def test_rows_without_dates_or_keys_go(spark):
    for gap in ({"loan_start_date": None}, {"snapshot_date": None}, {"Customer_ID": None}, {"loan_id": None}):
        assert silver.loan_by_payment(loans(spark, **gap)).isEmpty()
        assert silver.loan_by_calendar(loans(spark, **gap)).isEmpty()


def test_attributes_junk_and_missing_customer(spark):
    raw = spark.createDataFrame(
        [("a", "n", "30", "#F%$D@*&8", "_______", "2024-01-01"), ("b", "n", "30_", "123", "Nurse", "bad date"),
         (None, "n", "30", "1", "x", "2024-01-01"), ("c", None, None, None, None, None)],
        "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date string",
    )
    rows = {r.Customer_ID: r for r in silver.attributes_strip_first(raw).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].SSN, rows["a"].Occupation, rows["a"].snapshot_date) == (None, "Unknown", dt.date(2024, 1, 1))
    assert (rows["b"].Age, rows["b"].SSN, rows["b"].snapshot_date) == (30, "123", None)
    assert (rows["c"].Age, rows["c"].SSN, rows["c"].Occupation) == (0, None, "Unknown")


def test_median_is_per_snapshot_and_zero_without_values(spark):
    rows = [("2024-01-01", 1.0), ("2024-01-01", 3.0), ("2024-01-01", 9.0), ("2024-01-01", None),
            ("2024-02-01", None), (None, 4.0), (None, None)]
    df = spark.createDataFrame(rows, "snapshot_date string, x double")
    got = sorted((r.snapshot_date or "", r.x) for r in silver.impute_median(df, ["x"]).collect())
    assert got == [("", 4.0), ("", 4.0), ("2024-01-01", 1.0), ("2024-01-01", 3.0), ("2024-01-01", 3.0),
                   ("2024-01-01", 9.0), ("2024-02-01", 0.0)]


def test_medians_are_taken_a_few_columns_at_a_time(spark):
    """Seven columns, one of them without values: as by hand, and no aggregate keeps the sketches of all."""
    names = [f"x{k}" for k in range(7)]
    rows = [("a" if i % 3 else "b", *[None if k == 6 or (i + k) % 4 == 0 else float((i * (k + 3)) % 11) for k in range(7)]) for i in range(40)]
    rows += [(None, *[2.0] * 7), ("c", *[None] * 7)]
    df = spark.createDataFrame(rows, "snapshot_date string, " + ", ".join(f"{c} double" for c in names))

    def median(month, k):
        known = sorted(r[1 + k] for r in rows if r[0] == month and r[1 + k] is not None)
        return known[(len(known) - 1) // 2] if known else 0.0

    filled = silver.impute_median(df, names)
    by_text = lambda some: sorted(map(str, some))
    expected = [(r[0], *[median(r[0], k) if r[1 + k] is None else r[1 + k] for k in range(7)]) for r in rows]
    assert by_text(tuple(r) for r in filled.collect()) == by_text(expected)
    plan = filled._jdf.queryExecution().optimizedPlan().toString().split("\n")
    sketches = [line.count("percentile_approx(") for line in plan if "percentile_approx(" in line]
    assert len(sketches) == 3 and max(sketches) <= silver.SKETCHES_AT_ONCE
