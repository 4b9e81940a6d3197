"""Independent SQL for the registered queries, run by DuckDB over the same Parquet tables.

Written from the definitions, not generated from the Spark code.  ``statement`` puts the named
common table expressions a body mentions in front of it.
"""

import re

from creditloom.operators.features import LOAN_PRODUCTS, LOAN_PRODUCTS_SHORT
from creditloom.operators.modelling import NOT_FEATURES
from creditloom.sources.raw import ATTRIBUTE_RULES, FINANCIAL_RULES
from creditloom.sources.schemas import CLICKSTREAM_COUNTERS, FINANCIAL_NUMERICS, FINANCIAL_TYPES

COUNTERS = CLICKSTREAM_COUNTERS
CATEGORIES = ["Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Type_of_Loan"]
NUMBERS = [c for c in FINANCIAL_NUMERICS if c != "Credit_History_Age"]
FINANCIALS = list(FINANCIAL_TYPES)
LOAN = """loan_id, Customer_ID, loan_start_date, tenure, installment_num, loan_amt, due_amt, paid_amt,
  overdue_amt, balance, snapshot_date"""


def r(expression: str, digits: int = 4) -> str:
    return f"round({expression} + 1e-9, {digits})"


def listed(items) -> str:
    return ",\n  ".join(items)


def product(name: str) -> str:
    return '"Loan_Type_' + name.replace(" ", "_") + '"'


CTES: dict[str, str] = {}

CTES["loan"] = """
select concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) as loan_id,
  cast(o_custkey as string) as Customer_ID, cast(o_orderdate as date) as loan_start_date,
  cast(l_quantity as int) - 1 as tenure, l_linenumber as installment_num, l_extendedprice as loan_amt,
  l_extendedprice * l_discount as due_amt, l_extendedprice * l_discount * (1 - l_tax) as paid_amt,
  l_extendedprice * l_discount * (l_tax * 33) as overdue_amt, l_extendedprice * (1 - l_discount) as balance,
  cast(date_trunc('month', l_shipdate) as date) as snapshot_date
from lineitem join orders on l_orderkey = o_orderkey"""

CTES["loan_keys"] = "select distinct Customer_ID, snapshot_date from loan"

CTES["attributes"] = f"""
select b.Customer_ID, {listed(f"{rule} as {c}" for c, rule in ATTRIBUTE_RULES.items())}, b.snapshot_date
from loan_keys b join customer on b.Customer_ID = cast(c_custkey as string)"""

CTES["financials"] = f"""
select b.Customer_ID, {listed(f"{rule} as {c}" for c, rule in FINANCIAL_RULES.items())}, b.snapshot_date
from loan_keys b join customer on b.Customer_ID = cast(c_custkey as string)"""

CTES["clickstream"] = f"""
select cast(user_id as string) as Customer_ID,
  make_date(1996 + cast(floor((event_id % 48) / 12) as int), 1 + cast(event_id % 12 as int), 1) as snapshot_date,
  {listed(f"case when (event_id + {i}) % 9 = 0 then null else cast(floor(value) as int) + {i} - 20 end as fe_{i}"
          for i in range(1, 21))}
from events"""

CTES["predictions"] = """
select Customer_ID, snapshot_date, 'credit_model_1998_12_01.pkl' as model_name,
  round(avg(case when due_amt > 0 then overdue_amt / due_amt / 3 else 0 end), 9) as model_predictions
from loan group by Customer_ID, snapshot_date"""

CTES["on_book"] = f"""
select * from (
  select {LOAN}, cast(round(datediff('day', loan_start_date, snapshot_date) / 30) as int) as mob from loan
) where mob >= 0"""

CTES["loan_calendar"] = f"""
select *, cast(case when overdue_amt > 0 then datediff('day', first_missed_date, snapshot_date) else 0 end as int) as dpd
from (
  select *, cast(case when installments_missed > 0
    then snapshot_date - to_months(installments_missed) else snapshot_date end as date) as first_missed_date
  from (
    select *, case when due_amt = 0 then 0 else cast(ceil(overdue_amt / due_amt) as int) end as installments_missed
    from on_book))"""

CTES["loan_payment"] = """
select *, cast(greatest(round(case when monthly_payment > 0 then overdue_amt / monthly_payment * 30 else 0 end), 0) as int) as dpd
from (
  select *, case when loan_amt > 0 and tenure > 0 then loan_amt / tenure else 0 end as monthly_payment from on_book)"""

CTES["clicks"] = f"""
select Customer_ID, snapshot_date, {listed(f"coalesce({c}, 0) as {c}" for c in COUNTERS)}
from clickstream where Customer_ID is not null"""

_PERSON = """Customer_ID, Name, {age} as Age,
  case when contains(SSN, '#F%$D@*&8') then null else SSN end as SSN,
  case when Occupation is null or contains(Occupation, '_______') then 'Unknown' else Occupation end as Occupation,
  snapshot_date"""
CTES["people_v1"] = "select " + _PERSON.format(
    age="case when try_cast(Age as int) between 18 and 100 then try_cast(Age as int) else 0 end"
) + " from attributes"
CTES["people_v2"] = "select " + _PERSON.format(
    age="""case when regexp_full_match(replace(Age, '_', ''), '[0-9]+')
      and try_cast(replace(Age, '_', '') as int) between 18 and 100 then cast(replace(Age, '_', '') as int) else 0 end"""
) + " from attributes"


def typed(column: str, value: str | None = None) -> str:
    target = FINANCIAL_TYPES[column]
    value = value or column
    return value if target == "string" else f"try_cast({value} as {target})"


CTES["money_typed"] = f"select {listed(f'{typed(c)} as {c}' for c in FINANCIALS)} from financials"

_V1_BAD = {
    "Num_Bank_Accounts": "{0} = -1 or {0} > 100",
    "Num_Credit_Card": "{0} > 100",
    "Interest_Rate": "{0} > 100",
    "Num_of_Loan": "{0} = -1 or {0} > 100",
    "Delay_from_due_date": "{0} < 0",
    "Num_of_Delayed_Payment": "{0} < 0",
}
_V1_TEXT = {
    "Credit_Mix": "nullif(Credit_Mix, '_')",
    "Payment_Behaviour": "case when contains(Payment_Behaviour, '!@9#%8') then null else Payment_Behaviour end",
}


def _bounded(column: str) -> str:
    number = f"cast({column} as double)"
    return f"case when {_V1_BAD[column].format(column)} then null else {number} end" if column in _V1_BAD else number


def median_filled(source: str) -> str:
    medians = listed(f"quantile_disc({c}, 0.5) as m_{c}" for c in FINANCIAL_NUMERICS)

    def value(c: str) -> str:
        if c in FINANCIAL_NUMERICS:
            return f"coalesce({c}, m_{c}, 0.0) as {c}"
        return f"coalesce({c}, 'Unknown') as {c}" if c in CATEGORIES else c

    return f"""with bounded as (
  select {listed(f"{_bounded(c) if c in FINANCIAL_NUMERICS else _V1_TEXT.get(c, c)} as {c}" for c in FINANCIALS)}
  from {source}),
medians as (select snapshot_date, {medians} from bounded group by snapshot_date)
select {listed(value(c) for c in FINANCIALS)} from bounded join medians using (snapshot_date)"""


HISTORY = r"""coalesce(try_cast(regexp_extract({0}, '^(\d+)\s*Years', 1) as double), 0) * 12
  + coalesce(try_cast(regexp_extract({0}, 'and\s*(\d+)\s*Months', 1) as double), 0)"""

CTES["money_v1"] = median_filled("money_typed")


def _readable(column: str) -> str:
    if column == "Credit_History_Age":
        parses = r"regexp_matches({0}, '^(\d+)\s*Years') or regexp_matches({0}, 'and\s*(\d+)\s*Months')"
        return f"case when {parses.format(column)} then {HISTORY.format(column)} end"
    return typed(column, f"replace({column}, '_', '')" if column in NUMBERS else None)


CTES["money_readable"] = f"select {listed(f'{_readable(c)} as {c}' for c in FINANCIALS)} from financials"
CTES["money_clean"] = median_filled("money_readable")

_V2_BAD = {c: _V1_BAD[c] for c in ("Num_Bank_Accounts", "Num_Credit_Card")}


def _v2(column: str) -> str:
    if column == "Credit_History_Age":
        return HISTORY.format(f"coalesce({column}, '')")
    if column in CATEGORIES:
        return f"coalesce({column}, 'Unknown')"
    if column not in NUMBERS:
        return column
    number = f"try_cast({column} as double)"
    kept = f"case when {_V2_BAD[column].format(number)} then null else {number} end" if column in _V2_BAD else number
    return f"cast(coalesce({kept}, 0) as {FINANCIAL_TYPES[column]})"


CTES["money_v2"] = f"select {listed(f'{_v2(c)} as {c}' for c in FINANCIALS)} from financials"


def labels(source: str, dpd: int) -> str:
    return f"""select loan_id, Customer_ID, cast(dpd >= {dpd} as int) as label, 'DPD_{dpd}+_MOB_6+' as label_definition,
  strftime(snapshot_date, '%Y-%m-%d') as label_snapshot_date, snapshot_date, mob, dpd
from {source} where mob >= 6"""


CTES["labels_v2"] = labels("loan_payment", 30)
CTES["labels_v1"] = labels("loan_calendar", 1)


def hot(products: list[str]) -> str:
    return listed(f"cast(contains(Type_of_Loan, '{p}') as int) as {product(p)}" for p in products)


_LOAN_AGG = """sum(loan_amt) as Loan_amt_sum, avg(loan_amt) as Loan_amt_mean, stddev_samp(loan_amt) as Loan_amt_std,
  avg(tenure) as Loan_tenure_mean, max(tenure) as Loan_tenure_max,
  sum(overdue_amt) as Loan_overdue_amt_sum, avg(overdue_amt) as Loan_overdue_amt_mean,
  max(overdue_amt) as Loan_overdue_amt_max, sum(balance) as Loan_balance_sum, avg(balance) as Loan_balance_mean,
  avg(dpd) as dpd_mean, max(dpd) as dpd_max"""
LOAN_FLOATS = [
    "Loan_amt_sum", "Loan_amt_mean", "Loan_amt_std", "Loan_tenure_mean", "Loan_overdue_amt_sum",
    "Loan_overdue_amt_mean", "Loan_overdue_amt_max", "Loan_balance_sum", "Loan_balance_mean", "dpd_mean",
]
CTES["loan_agg"] = f"""select Customer_ID, snapshot_date, {_LOAN_AGG}, count(loan_id) as loan_count
from loan_payment group by all"""
CTES["loan_agg_v1"] = f"""select Customer_ID, snapshot_date, {_LOAN_AGG}, stddev_samp(dpd) as loan_days_past_due_std
from loan_calendar group by all"""
CTES["click_agg"] = """select Customer_ID, snapshot_date, count(*) as clickstream_total_events,
  avg(fe_5) as clickstream_fe_5_mean, cast(sum(fe_5) as bigint) as clickstream_fe_5_sum,
  stddev_samp(fe_5) as clickstream_fe_5_std, avg(fe_9) as clickstream_fe_9_mean, min(fe_9) as clickstream_fe_9_min,
  avg(fe_4) as clickstream_fe_4_mean, min(fe_4) as clickstream_fe_4_min,
  avg(fe_10) as clickstream_fe_10_mean, min(fe_10) as clickstream_fe_10_min
from clicks group by all"""
CLICK_FLOATS = ["clickstream_fe_5_mean", "clickstream_fe_5_std", "clickstream_fe_9_mean", "clickstream_fe_4_mean",
                "clickstream_fe_10_mean"]
CTES["click_agg_v1"] = """select Customer_ID, snapshot_date, avg(fe_5) as fe_5_mean, min(fe_5) as fe_5_min,
  avg(fe_10) as fe_10_mean, min(fe_9) as fe_9_min, min(fe_4) as fe_4_min from clicks group by all"""

_MONEY = ["Delay_from_due_date", "Outstanding_Debt", "Amount_invested_monthly", "Interest_Rate",
          "Num_Bank_Accounts", "Num_Credit_Card"]
_MONEY_FLOATS = ["Outstanding_Debt", "Amount_invested_monthly", "Interest_Rate"]


def filled(column: str) -> str:
    return f"coalesce({column}, 0) as {column}"


CTES["feats"] = f"""select Customer_ID, snapshot_date, strftime(snapshot_date, '%Y-%m-%d') as feature_snapshot_date,
  {filled("Age")}, coalesce(Occupation, 'Unknown') as Occupation, {listed(filled(c) for c in _MONEY)},
  {listed(filled(product(p)) for p in LOAN_PRODUCTS)},
  {listed(filled(c) for c in LOAN_FLOATS)}, Loan_tenure_max, dpd_max, loan_count,
  {listed(filled(c) for c in CLICK_FLOATS)}, {filled("clickstream_fe_9_min")}, {filled("clickstream_fe_4_min")},
  {filled("clickstream_fe_10_min")}, clickstream_total_events, clickstream_fe_5_sum
from loan_agg left join people_v2 using (Customer_ID, snapshot_date)
  left join (select Customer_ID, snapshot_date, {listed(_MONEY)}, {hot(LOAN_PRODUCTS)} from money_v2)
    using (Customer_ID, snapshot_date)
  left join click_agg using (Customer_ID, snapshot_date)"""

FEATURE_INTS = ["Age", "Delay_from_due_date", "Num_Bank_Accounts", "Num_Credit_Card",
                *[product(p) for p in LOAN_PRODUCTS], "Loan_tenure_max", "dpd_max", "loan_count",
                "clickstream_fe_9_min", "clickstream_fe_4_min", "clickstream_fe_10_min", "clickstream_total_events",
                "clickstream_fe_5_sum"]
FEATURE_FLOATS = [*_MONEY_FLOATS, *LOAN_FLOATS, *CLICK_FLOATS]
FEATURES_OUT = listed(["Occupation", *FEATURE_INTS, *[f"{r(c)} as {c}" for c in FEATURE_FLOATS]])
MATRIX = [c for c in [*FEATURE_INTS, *FEATURE_FLOATS] if c.strip('"') not in NOT_FEATURES]

CTES["train_test"] = """select loan_id, Customer_ID, snapshot_date, mob, dpd, label from labels_v2
where snapshot_date between date '1997-10-01' and date '1998-09-01'"""


def hashed(seed: int) -> str:
    return f"""md5(concat_ws('|', loan_id, Customer_ID, cast(snapshot_date as string), cast(mob as string),
      cast(dpd as string), '{seed}'))"""


CTES["split_rows"] = f"""
select loan_id, Customer_ID, snapshot_date, mob, dpd, label, case when place <= cut then 'train' else 'test' end as split
from (select *, row_number() over (partition by label order by {hashed(88)}) as place from train_test)
join (
  select label, base + cast(row_number() over (order by ideal - base desc, label) <= need - sum(base) over () as int) as cut
  from (select label, need, ideal, floor(ideal) as base from (
    select label, need, count(*) * need / sum(count(*)) over () as ideal from train_test,
      (select count(*) - ceil(count(*) * (1 - 0.8::double)) as need from train_test) group by label, need))
) using (label)"""

CTES["base_scores"] = "select model_predictions as s from predictions where snapshot_date = date '1998-06-01'"
CTES["current_scores"] = "select model_predictions as s from predictions where snapshot_date = date '1998-12-01'"
_PROBS = ", ".join(f"{i / 10}" for i in range(11))
CTES["deciles"] = f"""select (select quantile_cont(s, [{_PROBS}]) from base_scores) as b,
  (select quantile_cont(s, [{_PROBS}]) from current_scores) as c"""
CTES["edges"] = "select list_sort(list_distinct(b)) as e from deciles"


def binned(side: str) -> str:
    return f"""select least(len(list_filter(e, lambda x: x <= s)), greatest(len(e) - 1, 1)) as bin, count(*) as n
    from {side}, edges where s between e[1] and e[len(e)] group by 1"""


CTES["psi_value"] = f"""
select sum((b - c) * ln(b / c)) as psi from (
  select case when coalesce(x.n, 0) = 0 then 1e-8 else x.n / (sum(x.n) over () + 1e-8) end as b,
    case when coalesce(y.n, 0) = 0 then 1e-8 else y.n / (sum(y.n) over () + 1e-8) end as c
  from ({binned("base_scores")}) x full join ({binned("current_scores")}) y on x.bin = y.bin)"""

CTES["ks_value"] = """
select max(abs(b / nb - c / nc)) as d, max(nb) as n, max(nc) as m from (
  select s, sum(sum(is_b)) over (order by s) as b, sum(sum(1 - is_b)) over (order by s) as c,
    sum(sum(is_b)) over () as nb, sum(sum(1 - is_b)) over () as nc
  from (select s, 1 as is_b from base_scores union all select s, 0 from current_scores) group by s)"""

CTES["scored"] = """select l.*, p.model_predictions as score from labels_v2 l join predictions p
using (Customer_ID, snapshot_date)"""


def auc(source: str, group: str = "") -> str:
    """Rank-sum form of the area under the ROC curve."""
    by = f"partition by {group} " if group else ""
    return f"""select {group + ',' if group else ''} count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg,
    (sum(place) filter (label = 1) - count(*) filter (label = 1) * (count(*) filter (label = 1) + 1) / 2.0)
      / (count(*) filter (label = 1) * count(*) filter (label = 0)) as auc
  from (select *, rank() over ({by}order by score) + (count(*) over (partition by {group + ',' if group else ''} score) - 1) / 2.0 as place
    from {source}) {('group by ' + group) if group else ''}"""


CTES["confusion"] = """select count(*) filter (score < 0.5 and label = 0) as tn, count(*) filter (score >= 0.5 and label = 0) as fp,
  count(*) filter (score < 0.5 and label = 1) as fn, count(*) filter (score >= 0.5 and label = 1) as tp from scored"""
CTES["scored_now"] = "select * from scored where snapshot_date = date '1998-12-01'"


def window_tag(*windows: tuple[str, str, str]) -> str:
    cases = " ".join(f"when snapshot_date between date '{a}' and date '{b}' then '{n}'" for n, a, b in windows)
    return f"case {cases} end"


FOUR = window_tag(("oot", "1998-10-01", "1998-11-30"), ("test", "1998-08-01", "1998-09-30"),
                  ("val", "1998-06-01", "1998-07-31"), ("train", "1997-10-01", "1998-05-31"))
MONTHS = window_tag(("oot", "1998-10-01", "1998-11-01"), ("train_test", "1997-10-01", "1998-09-01"))

CTES["tuned"] = f"""select * from (select *, {FOUR} as split from labels_v2) join feats using (Customer_ID, snapshot_date)
where split is not null"""
CTES["scale_stats"] = f"""select {listed(f'avg({c}) as "m{i}", stddev_pop({c}) as "d{i}"' for i, c in enumerate(
    f"coalesce({c}, 0)" for c in MATRIX))} from tuned where split = 'train'"""


def statement(body: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit_name(name)

    def visit_name(name: str) -> None:
        for other in CTES:
            if other != name and other not in needed and re.search(rf"\b{other}\b", CTES[name]):
                visit_name(other)
        needed.append(name)

    visit(body)
    if not needed:
        return body
    heads = ",\n".join(f"{name} as ({CTES[name].strip()})" for name in needed)
    return f"with {heads}\n{body.strip()}"


BODIES: dict[str, str] = {}
BODIES["csv_round_trip"] = f"select {listed(FINANCIALS)} from financials"
BODIES["bronze_ingest"] = "\nunion all\n".join(
    f"select '{name}' as table_name, count(*) as n_rows, {n} as n_columns, min(snapshot_date) as first_snapshot,"
    f" max(snapshot_date) as last_snapshot from {table}"
    for name, table, n in [("clickstream", "clickstream", 22), ("attributes", "attributes", 6),
                           ("financials", "financials", 22), ("loan_daily", "loan", 11)]
)
BODIES["bronze_snapshot_filter"] = "select * from loan where snapshot_date = date '1998-12-01'"
BODIES["parquet_partition_scan"] = "select * from loan_payment where snapshot_date = date '1998-12-01'"
BODIES["multi_path_scan"] = "select * from labels_v2 where snapshot_date in (date '1998-06-01', date '1998-12-01')"
BODIES["partition_overwrite"] = f"""select Customer_ID, snapshot_date, model_name,
  {r("case when snapshot_date = date '1998-12-01' then 1 - model_predictions else model_predictions end", 6)} as model_predictions
from predictions"""
BODIES["full_overwrite"] = "select * from labels_v2 where snapshot_date between date '1997-01-01' and date '1998-12-01'"
BODIES["month_spine"] = """select cast(unnest(generate_series(date_trunc('month', min(loan_start_date)), max(snapshot_date)::timestamp,
  interval 1 month)) as date) as snapshot_date from loan"""
BODIES["backfill_all_snapshots"] = """select snapshot_date, count(*) as n_rows, cast(sum(label) as bigint) as n_defaults
from labels_v2 where snapshot_date between date '1997-01-01' and date '1998-12-01' group by 1"""
BODIES["available_tables"] = "\nunion all\n".join(
    f"select '{name}' as table_name, count(*) > 0 as available from {table} where snapshot_date = date '1998-12-01'"
    for name, table in [("clickstream", "clicks"), ("attributes", "people_v2"), ("financials", "money_v2"),
                        ("loan_daily", "loan_payment")]
)
BODIES["prediction_lookup"] = f"""select Customer_ID, snapshot_date, model_name, {r("model_predictions", 6)} as model_predictions
from predictions where model_name = 'credit_model_1998_12_01.pkl' and snapshot_date = date '1998-12-01'"""
BODIES["table_profile"] = "\nunion all\n".join(
    f"select '{name}' as table_name, count(*) as n_rows, {n} as n_columns, min(snapshot_date) as first_snapshot,"
    f" max(snapshot_date) as last_snapshot from {table}"
    for name, table, n in [("clickstream", "clicks", 22), ("attributes", "people_v2", 6),
                           ("financials", "money_v2", 22), ("loan_daily", "loan_payment", 14)]
)
BODIES["table_head"] = "select * from labels_v2 order by snapshot_date, Customer_ID, loan_id, mob, dpd limit 10"

BODIES["schema_enforce_v1"] = "select * from money_typed"
BODIES["schema_enforce_v2"] = "select * from money_typed"
BODIES["silver_clickstream"] = "select * from clicks"
BODIES["silver_attributes"] = "select * from people_v2"
BODIES["silver_age_v1"] = "select Customer_ID, snapshot_date, Age from people_v1"
BODIES["silver_age_v2"] = "select Customer_ID, snapshot_date, Age from people_v2"
BODIES["silver_financials_v1"] = "select * from money_v1"
BODIES["silver_financials_v2"] = "select * from money_v2"
BODIES["silver_financials_clean"] = "select * from money_clean"
BODIES["credit_history_months"] = "select Customer_ID, snapshot_date, Credit_History_Age from money_v2"
_IMPUTED = ["Monthly_Inhand_Salary", "Num_of_Delayed_Payment", "Changed_Credit_Limit"]
BODIES["impute_median"] = f"""select Customer_ID, snapshot_date,
  {listed(f"cast(coalesce({c}, m_{c}, 0) as double) as {c}" for c in _IMPUTED)}
from money_typed join (select snapshot_date, {listed(f"quantile_disc({c}, 0.5) as m_{c}" for c in _IMPUTED)}
  from money_typed group by 1) using (snapshot_date)"""
BODIES["loan_mob"] = "select loan_id, Customer_ID, snapshot_date, mob from on_book"
BODIES["loan_dpd_calendar"] = """select loan_id, Customer_ID, snapshot_date, installments_missed, first_missed_date, dpd
from loan_calendar"""
BODIES["loan_dpd_payment"] = "select loan_id, Customer_ID, snapshot_date, monthly_payment, dpd from loan_payment"
BODIES["silver_loan_v1"] = "select * from loan_calendar"
BODIES["silver_loan_v2"] = "select * from loan_payment"

BODIES["label_store"] = "select * from labels_v2"
BODIES["label_store_v1"] = "select * from labels_v1"
BODIES["label_distribution"] = "select label, count(*) as n_rows from labels_v2 group by 1"
BODIES["customer_base"] = "select distinct Customer_ID, snapshot_date from loan_payment"
BODIES["loan_type_multihot"] = f"select Customer_ID, snapshot_date, {hot(LOAN_PRODUCTS)} from money_v2"
BODIES["loan_type_multihot_v1"] = f"select Customer_ID, snapshot_date, {hot(LOAN_PRODUCTS_SHORT)} from money_v2"
BODIES["loan_features"] = f"""select Customer_ID, snapshot_date, Loan_tenure_max, dpd_max, loan_count,
  {listed(f"{r(c)} as {c}" for c in LOAN_FLOATS)} from loan_agg"""
BODIES["loan_features_v1"] = f"""select Customer_ID, snapshot_date, Loan_tenure_max, dpd_max,
  {listed(f"{r(c)} as {c}" for c in [*LOAN_FLOATS, "loan_days_past_due_std"])} from loan_agg_v1"""
BODIES["dpd_std_window"] = f"""select loan_id, Customer_ID, snapshot_date, dpd,
  {r("stddev_samp(dpd) over (partition by Customer_ID, snapshot_date)")} as loan_days_past_due_std from loan_calendar"""
BODIES["clickstream_features"] = f"""select Customer_ID, snapshot_date, clickstream_total_events, clickstream_fe_5_sum,
  clickstream_fe_9_min, clickstream_fe_4_min, clickstream_fe_10_min, {listed(f"{r(c)} as {c}" for c in CLICK_FLOATS)}
from click_agg"""
BODIES["clickstream_features_v1"] = f"""select Customer_ID, snapshot_date, {r("fe_5_mean")} as fe_5_mean,
  {r("fe_10_mean")} as fe_10_mean, fe_5_min, fe_9_min, fe_4_min from click_agg_v1"""
BODIES["feature_store"] = f"select Customer_ID, snapshot_date, feature_snapshot_date, {FEATURES_OUT} from feats"
_V1_MONEY = [c for c in _MONEY if c != "Outstanding_Debt"]
_V1_FLOATS = [*LOAN_FLOATS, "loan_days_past_due_std", "fe_5_mean", "fe_10_mean"]
BODIES["feature_store_v1"] = f"""select Customer_ID, snapshot_date, label, label_definition,
  strftime(snapshot_date, '%Y-%m-%d') as feature_snapshot_date, {filled("Age")},
  coalesce(Occupation, 'Unknown') as Occupation, {listed(f"{r(f'coalesce({c}, 0)')} as {c}" for c in _V1_MONEY)},
  {listed(filled(product(p)) for p in LOAN_PRODUCTS_SHORT)},
  {listed(f"{r(f'coalesce({c}, 0)')} as {c}" for c in _V1_FLOATS)}, {filled("Loan_tenure_max")}, {filled("dpd_max")},
  {filled("fe_5_min")}, {filled("fe_9_min")}, {filled("fe_4_min")}
from labels_v1 left join people_v1 using (Customer_ID, snapshot_date)
  left join (select Customer_ID, snapshot_date, {listed(_V1_MONEY)}, {hot(LOAN_PRODUCTS_SHORT)} from money_v1)
    using (Customer_ID, snapshot_date)
  left join loan_agg_v1 using (Customer_ID, snapshot_date)
  left join click_agg_v1 using (Customer_ID, snapshot_date)"""
BODIES["dedup_features"] = f"""select Customer_ID, snapshot_date, {listed(COUNTERS)} from (
  select *, row_number() over (partition by Customer_ID, snapshot_date order by {listed(COUNTERS)}) as place from clicks
) where place = 1"""

_FEATURE_ALL = ["Customer_ID", "snapshot_date", "feature_snapshot_date", "Occupation", *FEATURE_INTS, *FEATURE_FLOATS]
BODIES["null_profile"] = "\nunion all\n".join(
    f"select '{c.strip(chr(34))}' as column_name, count(*) - count({c}) as null_count from feats" for c in _FEATURE_ALL
)
BODIES["date_coverage"] = """select distinct snapshot_date, min(snapshot_date) over () as first_snapshot,
  max(snapshot_date) over () as last_snapshot from labels_v2"""
BODIES["bad_rate_by_mob"] = f"""select mob, {r("avg(cast(dpd >= 30 as int))", 6)} as bad_rate from loan_payment
where loan_start_date < date '1998-01-01' group by mob"""
BODIES["installment_bads"] = """select loan_id, Customer_ID, snapshot_date, installment_num, dpd, cast(dpd >= 30 as int) as dpd_flag
from loan_payment where installment_num = 7 and loan_start_date < date '1998-01-01'"""

_LEDGER = {
    "loan_id": None, "Customer_ID": None, "loan_start_date": "epoch", "tenure": "", "installment_num": "", "loan_amt": "", "due_amt": "",
    "paid_amt": "", "overdue_amt": "", "balance": "", "snapshot_date": "epoch", "mob": "", "monthly_payment": "", "dpd": "",
}


def _extreme(which: str, column: str, kind: str | None) -> str:
    if kind is None:
        return "null::double"
    return r(f"{which}({column})::double" if not kind else f"date_diff('day', date '1970-01-01', {which}({column}))::double", 6)


BODIES["stored_profile"] = "\nunion all\n".join(
    f"""select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_nulls, {_extreme("min", c, k)} as least,
  {_extreme("max", c, k)} as greatest from loan_payment""" for c, k in _LEDGER.items())
BODIES["training_set"] = f"""select Customer_ID, snapshot_date, loan_id, label, label_definition, label_snapshot_date, mob, dpd,
  feature_snapshot_date, {FEATURES_OUT} from labels_v2 join feats using (Customer_ID, snapshot_date)"""
BODIES["snapshot_range_filter"] = BODIES["full_overwrite"]
BODIES["feature_snapshot"] = BODIES["feature_store"] + " where snapshot_date = date '1998-12-01'"
BODIES["time_splits"] = f"""select * from (
  select loan_id, Customer_ID, snapshot_date, label, {FOUR} as split from labels_v2) where split is not null"""
BODIES["oot_split"] = f"""select * from (
  select loan_id, Customer_ID, snapshot_date, label, {MONTHS} as split from labels_v2) where split is not null"""
BODIES["stratified_split"] = "select * from split_rows"
BODIES["stratified_folds"] = f"""select loan_id, Customer_ID, snapshot_date, mob, dpd, label,
  cast(ntile(5) over (partition by label order by {hashed(42)}) - 1 as int) as fold from labels_v2"""
BODIES["split_stats"] = f"""select split, count(*) as n_rows, {r("round(avg(label), 2)", 6)} as label_mean from (
  select label, split from split_rows
  union all select label, 'oot' from labels_v2 where snapshot_date between date '1998-10-01' and date '1998-11-01')
group by 1"""
BODIES["label_normalise"] = "select loan_id, Customer_ID, snapshot_date, label as is_default from labels_v2"
_MATRIX_OUT = listed(c if c in FEATURE_INTS else f"{r(c)} as {c}" for c in MATRIX)
BODIES["model_matrix"] = f"""select loan_id, Customer_ID, snapshot_date, label, {_MATRIX_OUT}
from labels_v2 join feats using (Customer_ID, snapshot_date)"""

BODIES["prediction_column"] = f"""select Customer_ID, snapshot_date, {r("round(model_predictions, 6)", 6)} as model_predictions
from predictions"""


def summary(side: str, source: str) -> str:
    deciles = listed(f"{r(f'quantile_cont(s, {i / 10})', 6)} as p{i * 10}" for i in range(11))
    return f"""select '{side}' as side, count(*) as count, {r("avg(s)", 6)} as mean, {r("stddev_pop(s)", 6)} as std,
  {r("min(s)", 6)} as min, {r("max(s)", 6)} as max, {r("median(s)", 6)} as median, {deciles} from {source}"""


BODIES["prediction_summary"] = summary("base", "base_scores") + "\nunion all\n" + summary("current", "current_scores")
BODIES["decile_diff"] = f"""select cast(i as int) as decile, {r("b[i + 1]", 6)} as base, {r("c[i + 1]", 6)} as current,
  {r("c[i + 1] - b[i + 1]", 6)} as diff from deciles, range(11) t(i)"""
BODIES["psi"] = f"select {r('psi', 6)} as psi from psi_value"
BODIES["ks_limit"] = f"""select {r("d", 6)} as ks_stat, cast(n as bigint) as n_base, cast(m as bigint) as n_current,
  {r("case when w < 0.2 then 1.0 else greatest(0.0, least(1.0, p)) end", 6)} as ks_pvalue
from (select d, n, m, any_value(w) as w, sum(case when k % 2 = 1 then 2 else -2 end * exp(-2 * k * k * w * w)) as p
  from (select *, d * sqrt(n * m / (n + m)) as w from ks_value), range(1, 101) t(k) group by d, n, m)"""
# Exact: probability moves along the lattice paths row by row (``mass``, by rows of the base so far), and what is far
# off at the end of a tie is taken out and added up.  For each group of ``sides`` (g, s, is_b).


def lattice(sides: str) -> str:
    return f"""with recursive pooled as (
    select g, s, is_b, row_number() over (partition by g, s) = count(*) over (partition by g, s) as last from ({sides})
  ), ordered as (select g, s, is_b, last, row_number() over (partition by g order by s, last) as k from pooled
  ), running as (
    select g, last, k, sum(is_b) over w as i, k - sum(is_b) over w as j,
      sum(is_b) over (partition by g) as n, count(*) over (partition by g) - sum(is_b) over (partition by g) as m
    from ordered window w as (partition by g order by k)
  ), far as (
    select g, any_value(n)::bigint as n, any_value(m)::bigint as m, max(abs(i * m - j * n)) filter (last) as far from running group by g
  ), path as (
    select g, 0::bigint as k, list_transform(range(0, n + 1), lambda i: if(i = 0, 1.0::double, 0.0::double)) as mass, 0.0::double as p from far
    union all
    select g, k, if(last, list_transform(moved, lambda x, i: if(abs((i - 1) * m - (k - i + 1) * n) >= far, 0.0::double, x)), moved),
      p + if(last, coalesce(list_sum(list_transform(moved, lambda x, i: if(abs((i - 1) * m - (k - i + 1) * n) >= far, x, 0.0::double))), 0), 0)
    from (
      select g, path.k + 1 as k, p, last, n, m, far, list_transform(mass, lambda x, i:
          x * greatest(m - (path.k - i + 1), 0) / (n + m - path.k)
          + if(i > 1, mass[i - 1] * (n - i + 2) / (n + m - path.k), 0)) as moved
      from path join (select g, k, last from ordered) o using (g) join far using (g) where o.k = path.k + 1)
  )
  select g, p, far / (n * m) as d from path join far using (g) where k = n + m"""


BODIES["ks_statistic"] = f"""select {r("ks_value.d", 6)} as ks_stat, cast(n as bigint) as n_base, cast(m as bigint) as n_current,
  {r("least(1.0, p)", 6)} as ks_pvalue
from ks_value, ({lattice("select 1 as g, s, 1 as is_b from base_scores union all select 1, s, 0 from current_scores")})"""


def index_sql(sides: str) -> str:
    """The stability index of each group of ``sides`` (g, s, is_b)."""
    return f"""select g, sum((b - c) * ln(b / c)) as psi from (
      select g, case when b = 0 then 1e-8 else b / (sum(b) over (partition by g) + 1e-8) end as b,
        case when c = 0 then 1e-8 else c / (sum(c) over (partition by g) + 1e-8) end as c
      from (select g, least(len(list_filter(e, lambda x: x <= s)), greatest(len(e) - 1, 1)) as bin, sum(is_b) as b, sum(1 - is_b) as c
        from ({sides}) join (select g, list_sort(list_distinct(quantile_cont(s, [{_PROBS}]))) as e from ({sides}) where is_b = 1 group by g) using (g)
        where s between e[1] and e[len(e)] group by g, bin)) group by g"""


_MONTHS = """select m.snapshot_date as g, b.s, 1 as is_b from base_scores b, (select distinct snapshot_date from predictions) m
  union all select snapshot_date, model_predictions, 0 from predictions"""
_DECILES_BY = listed(f"{r(f'quantile_cont(s, {i / 10})', 6)} as p{i * 10}" for i in range(11))
BODIES["drift_by_month"] = f"""select 'credit_model_1998_12_01.pkl' as model_name, g as snapshot_date, w.* exclude (g), {r("psi", 6)} as psi,
  case when psi >= 0.3 then 'critical' when psi >= 0.2 then 'warning' else 'ok' end as alert,
  {r("d", 6)} as ks_stat, {r("least(1.0, p)", 6)} as ks_pvalue
from (select snapshot_date as g, count(*) as count, {r("avg(s)", 6)} as mean, {r("stddev_pop(s)", 6)} as std, {r("min(s)", 6)} as min,
    {r("max(s)", 6)} as max, {r("median(s)", 6)} as median, {_DECILES_BY}
  from (select snapshot_date, model_predictions as s from predictions) group by 1) w
join ({index_sql(_MONTHS)}) using (g) join ({lattice(_MONTHS)}) using (g)"""
BODIES["drift_alert"] = f"""select {r("psi", 6)} as psi,
  case when psi >= 0.3 then 'critical' when psi >= 0.2 then 'warning' else 'ok' end as alert,
  cast(case when psi >= 0.3 then 2 when psi >= 0.2 then 1 else 0 end as int) as exit_code from psi_value"""
BODIES["roc_auc"] = f"select {r('auc', 6)} as roc_auc from ({auc('scored')})"
_RATES = f"""tn as true_negatives, fp as false_positives, fn as false_negatives, tp as true_positives,
  {r("(tp + tn) / (tn + fp + fn + tp)", 6)} as accuracy, {r("tp / (tp + fn)", 6)} as recall,
  {r("tp / (tp + fp)", 6)} as precision, {r("2 * tp / (2 * tp + fp + fn)", 6)} as f1,
  {r("(tp / (tp + fn) + tn / (tn + fp)) / 2", 6)} as balanced_accuracy,
  (select count(*) filter (score is null or isnan(score)) from scored where label is not null) as unscored"""
BODIES["classification_metrics"] = f"select {_RATES}, {r('auc', 6)} as roc_auc from confusion, ({auc('scored')})"
BODIES["auc_gini_by_split"] = f"""select split, {r("auc", 6)} as roc_auc, {r("round(2 * auc - 1, 3)", 6)} as gini
from ({auc(f"(select *, {FOUR} as split from scored where {FOUR} is not null)", "split")})"""
BODIES["label_metrics"] = f"""select {r("auc", 6)} as roc_auc, {r("tp / (tp + fp)", 6)} as precision, {r("tp / (tp + fn)", 6)} as recall,
  {r("2 * tp / (2 * tp + fp + fn)", 6)} as f1, unlabelled,
  (select count(*) filter (score is null or isnan(score)) from scored_now) as unscored
from ({auc("scored_now")}), (
  select count(*) filter (score < 0.5 and label = 0) as tn, count(*) filter (score >= 0.5 and label = 0) as fp,
    count(*) filter (score < 0.5 and label = 1) as fn, count(*) filter (score >= 0.5 and label = 1) as tp from scored_now), (
  select count(*) as unlabelled from predictions p where snapshot_date = date '1998-12-01' and not exists (
    select 1 from labels_v2 l where l.Customer_ID = p.Customer_ID and l.snapshot_date = p.snapshot_date))"""
_REPORTED = ("count", "mean", "std", "min", "max", "median")
BODIES["monitor_values"] = f"""select 'credit_model_1998_12_01.pkl' as model_label, '1998-12-01' as snapshotdate, '1998-06-01' as baseline_date,
  {listed(f"b.{c} as baseline_{c}" for c in _REPORTED)}, {listed(f"c.{c} as current_{c}" for c in _REPORTED)},
  {listed(f"c.p{i * 10} as current_p{i * 10}" for i in range(11))},
  (select {r("sum(abs(c[i + 1] - b[i + 1]))", 6)} from deciles, range(11) t(i)) as decile_shift,
  k.ks_stat, k.ks_pvalue, a.psi, a.alert, a.exit_code,
  l.roc_auc, l.precision, l.recall, l.f1, l.unlabelled::double as unlabelled, l.unscored::double as unscored, null::varchar as label_note
from ({summary("base", "base_scores")}) b, ({summary("current", "current_scores")}) c, ({BODIES["ks_statistic"]}) k,
  ({BODIES["drift_alert"]}) a, ({BODIES["label_metrics"]}) l"""
BODIES["retrain_needed"] = """select max(snapshot_date) as latest_run, date '1998-12-15' as cutoff,
  max(snapshot_date) < date '1998-12-15' as retrain from predictions"""

_SCALED = listed(
    f"{r(f'(coalesce({c}, 0) - m{i}) / case when d{i} = 0 then 1 else d{i} end', 5)} as {c}" for i, c in enumerate(MATRIX)
)
BODIES["scaled_features"] = f"select loan_id, Customer_ID, snapshot_date, split, {_SCALED} from tuned, scale_stats"
_JOBS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "Unknown"]
BODIES["one_hot"] = f"""select Customer_ID, snapshot_date, Occupation,
  {listed(f"cast(Occupation = '{j}' as int) as Occupation_{j}" for j in _JOBS)} from feats"""
BODIES["class_weights"] = f"""select label, n_rows, {r("sum(n_rows) over () / (count(*) over () * n_rows)", 6)} as balanced_weight,
  {r('''case when label = 1 then coalesce(sum(n_rows) filter (label = 0) over () / sum(n_rows) filter (label = 1) over (), 1)
     else 1 end''', 6)} as positive_weight
from (select label, count(*) as n_rows from labels_v2 group by 1)"""

_NUMBERS = [
    "Delay_from_due_date", "Outstanding_Debt", "Amount_invested_monthly", "Interest_Rate", "Num_Bank_Accounts",
    "Num_Credit_Card", "Loan_amt_sum", "Loan_amt_mean", "Loan_amt_std", "Loan_tenure_mean", "Loan_tenure_max",
    "Loan_overdue_amt_sum", "Loan_overdue_amt_mean", "Loan_overdue_amt_max", "Loan_balance_sum", "Loan_balance_mean",
    "dpd_mean", "dpd_max", "loan_count", "clickstream_total_events", "clickstream_fe_5_mean", "clickstream_fe_5_sum",
    "clickstream_fe_5_std", "clickstream_fe_9_mean", "clickstream_fe_9_min", "clickstream_fe_4_mean", "clickstream_fe_4_min",
    "clickstream_fe_10_mean", "clickstream_fe_10_min",
]
_NUMBERS = ["Age", *_NUMBERS]
CTES["train_numbers"] = f"""select label, case when label = 1 then w else 1 end as w, v.i, v.name, v.x from (
  select label, count(*) filter (label = 0) over () / count(*) filter (label = 1) over () as w,
    unnest([{listed(f"{{'i': {k}, 'name': '{c}', 'x': coalesce({c}, 0)::double}}" for k, c in enumerate(_NUMBERS))}]) as v
  from tuned where split = 'train')"""
_FLAGS = [
    "Home_Loan", "Personal_Loan", "Student_Loan", "Auto_Loan", "Business_Loan", "Credit-Builder_Loan", "Home_Equity_Loan",
    "Debt_Consolidation_Loan", "Mortgage_Loan", "Not_Specified", "Payday_Loan",
]
_GROUPS = ["Occupation", *[f'"Loan_Type_{f}"' for f in _FLAGS]]
# The values that a category has in training but the first, in falling order; none for a category of one value.
CTES["known"] = f"""select {listed(f"list_reverse_sort(list(distinct {c}::varchar)) as k{i}" for i, c in enumerate(_GROUPS))}
from tuned where split = 'train'"""


def vectors(number) -> str:
    hot = [f"list_transform(k{i}[1:len(k{i}) - 1], lambda v: (v = {c}::varchar)::int::double)" for i, c in enumerate(_GROUPS)]
    return f"""select loan_id, Customer_ID, snapshot_date, mob, dpd, split, unnest(range(0, len(f)))::int as i, round(unnest(f) + 1e-9, 5) as value
    from (select *, flatten([[{listed(number(c, k) for k, c in enumerate(_NUMBERS))}], {listed(hot)}]) as f from tuned, known{{}})"""


BODIES["tree_inputs"] = vectors(lambda c, k: f"coalesce({c}, 0)::double").format("")
CTES["number_stats"] = f"""select {listed(f'avg(coalesce({c}, 0)) as "a{i}", stddev_pop(coalesce({c}, 0)) as "b{i}"' for i, c in enumerate(_NUMBERS))}
from tuned where split = 'train'"""
BODIES["linear_inputs"] = vectors(lambda c, k: f"(coalesce({c}, 0) - a{k}) / case when b{k} = 0 then 1 else b{k} end").format(", number_stats")
BODIES["boosted_inputs"] = f"""select loan_id, Customer_ID, snapshot_date, mob, dpd, split, v.name as input, {r("v.x", 5)} as value
from (select *, unnest(flatten([[{listed(f"{{'name': '{c}', 'x': coalesce({c}, 0)::double}}" for c in _NUMBERS)}],
  {listed(f"list_transform(k{i}[1:len(k{i}) - 1], lambda v: {{'name': '{c.strip(chr(34))}_' || v, 'x': (v = {c}::varchar)::int::double}})" for i, c in enumerate(_GROUPS))}])) as v
  from tuned, known)"""
_CUTS = ", ".join(f"{k / 32}" for k in range(1, 32))
CTES["cut_points"] = f"""select i, list_filter(list_sort(list_distinct(q)), lambda c: c > m) as cuts from (
  select i, quantile_disc(x, [{_CUTS}]) as q, min(x) as m from train_numbers group by i)"""
CTES["root_sums"] = """select i, name, len(list_filter(cuts, lambda c: c <= x)) as bin, count(*) as n,
  sum(w * (0.5 - label)) as g, sum(w * 0.25) as h from train_numbers join cut_points using (i) group by 1, 2, 3"""
BODIES["boosting_histogram"] = f"""select name as input, bin::int as bin, n, {r("g", 6)} as g, {r("h", 6)} as h from root_sums"""
BODIES["boosting_root_splits"] = f"""select * from (with setting(model, alpha, ridge, least, gamma) as (
  values (0, 0.0, 1.0, 1.0, 0.0), (1, 20.0, 0.5, 1.0, 0.0), (2, 0.0, 1.0, 200.0, 0.1), (3, 0.0, 1.0, 1.0, 1e9)
), cut as (
  select i, name, bin, sum(g) over before as gl, sum(h) over before as hl, sum(g) over (partition by i) as ga, sum(h) over (partition by i) as ha
  from root_sums window before as (partition by i order by bin rows between unbounded preceding and 1 preceding)
), scored as (
  select *, power(greatest(abs(gl) - alpha, 0), 2) / (hl + ridge) + power(greatest(abs(ga - gl) - alpha, 0), 2) / (ha - hl + ridge)
    - power(greatest(abs(ga) - alpha, 0), 2) / (ha + ridge) as gain
  from cut, setting where gl is not null and least(hl, ha - hl) >= setting.least
)
select model, name as input, {r("cuts[bin]")} as cut, {r("gain")} as gain, {r("gl")} as g_left, {r("hl")} as h_left,
  {r("ga - gl")} as g_right, {r("ha - hl")} as h_right
from (select *, row_number() over (partition by model order by round(gain, 6) desc, i, bin) as k from scored
  where gain > 0 and gain >= gamma) join cut_points using (i) where k = 1)"""

# Of models, what is exact: rows per class and split, keys, and that shares are shares; and on the train rows the best
# single input's ROC-AUC, which the model must reach.
CTES["best_input"] = f"""select max(greatest(auc, 1 - auc)) as best from ({auc("(select name, label, x as score from train_numbers)", "name")})"""
_JUDGED = f"""select split, count(*) filter (label = 0) as negatives, count(*) filter (label = 1) as positives,
  cast(0 as bigint) as unscored, true as rates_in_range,
  case when split = 'train' then (select round(best, 6) from best_input) end as best_input_auc,
  case when split = 'train' then true end as beats_inputs"""
for _name in ("train_random_forest", "train_random_forest_scaled", "train_gbt", "train_boosted"):
    BODIES[_name] = f"{_JUDGED} from tuned group by split"
BODIES["train_logistic"] = f"""{_JUDGED}, case when split = 'train' then true end as stationary from tuned group by split"""
BODIES["random_search"] = f"""{_JUDGED}, true as cv_in_range,
  'bootstrap, featureSubsetStrategy, maxDepth, minInstancesPerNode, numTrees' as searched from tuned group by split"""
BODIES["score_snapshot"] = """select Customer_ID, snapshot_date, 'credit_model_1998_12_01.pkl' as model_name, true as in_range
from feats where snapshot_date = date '1998-12-01'"""
BODIES["model_round_trip"] = """select count(*) as n_rows, count(*) as n_equal, 'credit_model_1998_12_01' as model_version
from feats where snapshot_date = date '1998-12-01'"""

SQL = {name: statement(body) for name, body in BODIES.items()}
