"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from creditmart import fixed_values as fixed
from creditmart.sources import roles

AS_OF = "DATE '2024-12-31'"

FE = fixed.CLICK_FEATURES


def _lines(parts: list[str]) -> str:
    return ",\n  ".join(parts)


# ---- role views -----------------------------------------------------------------

def _month_start(months: str) -> str:
    return f"make_date(2020 + CAST(floor(({months})/12.0) AS INT), CAST(({months}) % 12 AS INT) + 1, 1)"


_CUSTOMER_SNAPSHOT = f"CAST({_month_start('months')} AS STRING) AS snapshot_date"


def _snapshots(ks: str) -> str:
    return f"""
      SELECT c_custkey AS id_key, c_custkey + 7*k AS c_custkey, c_name, (c_custkey*7 + 13*(k % 3)) % 60 AS months
      FROM customer, (SELECT unnest([{ks}]) AS k) WHERE c_custkey % 29 <> 0"""



RAW = {
    "raw_loans": f"""
      WITH b AS (SELECT o_orderkey ok, o_custkey ck, CAST(floor(o_totalprice) AS BIGINT) amt,
          (year(o_orderdate)-1995)*12 + month(o_orderdate)-1 m0 FROM orders),
      e AS (SELECT *, CAST(floor(amt/10.0) AS BIGINT) inst, {_month_start('m0 + k')} sd
        FROM (SELECT *, CAST(unnest(range(0, 11)) AS INT) AS k FROM b)),
      f AS (SELECT *, CASE WHEN k=0 THEN 0 ELSE inst END due,
          CASE WHEN k>0 AND ok % 5 = 0 THEN inst * ((ok + k*k) % 4) + ok % 3 ELSE 0 END od FROM e)
      SELECT concat('LN_', CAST(ok AS STRING)) loan_id,
        CASE WHEN ok % 97 = 0 THEN concat('BAD_', CAST(ck AS STRING)) WHEN ok % 101 = 0 THEN NULL
          ELSE concat('CUS_0x', lower(hex(ck))) END Customer_ID,
        CAST({_month_start('m0')} AS STRING) loan_start_date, '10' tenure, CAST(k AS STRING) installment_num,
        CASE ok % 11 WHEN 0 THEN concat('_', CAST(amt AS STRING)) WHEN 1 THEN concat('$', CAST(amt AS STRING))
          WHEN 2 THEN '0' WHEN 3 THEN 'n/a' ELSE CAST(amt AS STRING) END loan_amt,
        CAST(due AS STRING) due_amt, CAST(CASE WHEN od >= due THEN 0 ELSE due - od END AS STRING) paid_amt,
        CAST(od AS STRING) overdue_amt, CAST(amt - k*inst AS STRING) balance,
        CASE WHEN ok % 2 = 0 THEN CAST(sd AS STRING)
          ELSE concat(CAST(day(sd) AS STRING),'/',CAST(month(sd) AS STRING),'/',CAST(year(sd) % 100 AS STRING))
          END snapshot_date FROM f""",
    "raw_attributes": f"SELECT {_lines(roles.ATTRIBUTES)}, {_CUSTOMER_SNAPSHOT} FROM ({_snapshots('0, 1, 2, 3')})",
    "raw_financials": f"SELECT {_lines(roles.FINANCIALS)}, {_CUSTOMER_SNAPSHOT} FROM ({_snapshots('0, 1, 2')})",
    "raw_clickstream": f"""
      SELECT {_lines(roles.CLICKSTREAM)}, CAST({_month_start('event_id*11 % 84')} AS STRING) AS snapshot_date
      FROM events""",
}

# ---- typed values ---------------------------------------------------------------


def _text(column: str) -> str:
    return rf"regexp_replace({column}, '[_,$\s]', '', 'g')"


def _float(column: str) -> str:
    return f"CAST(TRY_CAST({_text(column)} AS FLOAT) AS DOUBLE)"


def _int(column: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({_text(column)}, '^[+-]?\d+(\.\d*)?$')"
        f" THEN TRY_CAST(trunc(TRY_CAST({_text(column)} AS DOUBLE)) AS INTEGER) END"
    )


def _date(column: str) -> str:
    return (
        f"CASE WHEN contains({column}, '/') THEN CAST(try_strptime({column}, '%d/%m/%y') AS DATE)"
        f" ELSE TRY_CAST({column} AS DATE) END"
    )


def _numbers(columns: list[str], read) -> list[str]:
    return [f"{read(c)} AS {c}" for c in columns] + [f"{c} AS {c}_original" for c in columns]


LOAN_AMOUNTS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
FIN_FLOATS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Interest_Rate",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
]
FIN_INTS = [
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
]

ID_FLAG = r"regexp_matches(Customer_ID, '^CUS_0x[0-9A-Fa-f]+$') AS valid_customer_id"
DATE_FLAG = (
    f"snapshot_date IS NOT NULL AND snapshot_date >= DATE '2020-01-01' AND snapshot_date <= {AS_OF}"
    " AS valid_snapshot_date"
)


def _non_negative(column: str) -> str:
    return f"{column} IS NOT NULL AND {column} >= 0"


def _between(column: str, low: float, high: float) -> str:
    return f"{column} IS NOT NULL AND {column} >= {low} AND {column} <= {high}"


TYPED = {
    "typed_loans": f"""
      SELECT loan_id, Customer_ID, {_date('loan_start_date')} AS loan_start_date,
        {_date('snapshot_date')} AS snapshot_date,
        {_lines(_numbers(['tenure', 'installment_num'], _int) + _numbers(LOAN_AMOUNTS, _float))}
      FROM raw_loans""",
    "typed_attributes": f"""
      SELECT Customer_ID, Name, SSN, Occupation, {_date('snapshot_date')} AS snapshot_date,
        {_lines(_numbers(['Age'], _int))}
      FROM raw_attributes""",
    "typed_financials": f"""
      SELECT Customer_ID, CASE WHEN Type_of_Loan <> '' THEN trim(Type_of_Loan) END AS Type_of_Loan,
        CASE WHEN Credit_Mix <> '_' THEN upper(trim(Credit_Mix)) END AS Credit_Mix,
        upper(trim(Payment_of_Min_Amount)) AS Payment_of_Min_Amount,
        upper(trim(Payment_Behaviour)) AS Payment_Behaviour, Credit_History_Age,
        {_date('snapshot_date')} AS snapshot_date,
        {_lines(_numbers(FIN_INTS, _int) + _numbers(FIN_FLOATS, _float))}
      FROM raw_financials""",
    "typed_clickstream": f"""
      SELECT Customer_ID, {_date('snapshot_date')} AS snapshot_date, {_lines(_numbers(FE, _int))}
      FROM raw_clickstream""",
}

# ---- silver tables --------------------------------------------------------------

FLAGGED = {
    "flagged_loans": f"""
      SELECT *, {ID_FLAG}, {DATE_FLAG},
        loan_amt IS NOT NULL AND loan_amt > 0 AS valid_loan_amt,
        {_lines([f'{_non_negative(c)} AS valid_{c}' for c in LOAN_AMOUNTS[1:]])}
      FROM typed_loans""",
    "flagged_attributes": f"""
      SELECT * REPLACE (CASE WHEN valid_snapshot_date THEN snapshot_date END AS snapshot_date)
      FROM (SELECT *, {ID_FLAG}, {DATE_FLAG}, {_between('Age', 18, 100)} AS valid_age,
        regexp_matches(SSN, '^\\d{{3}}-\\d{{2}}-\\d{{4}}$') AS valid_ssn
      FROM typed_attributes)""",
    "flagged_financials": f"""
      SELECT * REPLACE (
        CASE WHEN valid_Total_EMI_per_month THEN Total_EMI_per_month ELSE 0 END AS Total_EMI_per_month,
        CASE WHEN valid_Amount_invested_monthly THEN Amount_invested_monthly ELSE 0 END
          AS Amount_invested_monthly)
      FROM (SELECT *, {ID_FLAG}, {DATE_FLAG},
        {_between('Annual_Income', 10000, 10000000)} AS valid_annual_income,
        {_between('Monthly_Inhand_Salary', 1000, 100000)} AS valid_monthly_salary,
        {_between('Credit_Utilization_Ratio', 0, 1)} AS valid_credit_utilization,
        {_between('Interest_Rate', 0, 100)} AS valid_interest_rate,
        {_non_negative('Outstanding_Debt')} AS valid_Outstanding_Debt,
        {_non_negative('Monthly_Balance')} AS valid_Monthly_Balance,
        {_non_negative('Total_EMI_per_month')} AS valid_Total_EMI_per_month,
        {_non_negative('Amount_invested_monthly')} AS valid_Amount_invested_monthly,
        Payment_Behaviour IS NOT NULL AND Payment_Behaviour IN (
          'HIGH_SPENT_MEDIUM_VALUE_PAYMENTS', 'HIGH_SPENT_SMALL_VALUE_PAYMENTS',
          'LOW_SPENT_MEDIUM_VALUE_PAYMENTS', 'LOW_SPENT_SMALL_VALUE_PAYMENTS',
          'HIGH_SPENT_LARGE_VALUE_PAYMENTS', 'LOW_SPENT_LARGE_VALUE_PAYMENTS') AS valid_payment_behaviour,
        Payment_of_Min_Amount IS NOT NULL AND Payment_of_Min_Amount IN ('YES', 'NO')
          AS valid_payment_of_min_amount,
        Credit_Mix IS NOT NULL AND Credit_Mix IN ('BAD', 'GOOD', 'STANDARD') AS valid_credit_mix,
        Type_of_Loan IS NOT NULL AND Type_of_Loan <> 'Not Specified' AND length(Type_of_Loan) > 0
          AS valid_type_of_loan,
        CASE WHEN NOT coalesce({ID_FLAG.split(' AS ')[0]}, false) THEN 'dropped'
          WHEN NOT ({DATE_FLAG.rsplit(' AS ', 1)[0]}) THEN 'dropped'
          WHEN Annual_Income < 1000 OR Annual_Income > 10000000 THEN 'Annual_Income'
          WHEN Monthly_Inhand_Salary < 100 OR Monthly_Inhand_Salary > 1000000 THEN 'Monthly_Inhand_Salary'
          ELSE 'kept' END AS fate
      FROM typed_financials)""",
    "flagged_clickstream": f"""
      SELECT * REPLACE (CASE WHEN valid_snapshot_date THEN snapshot_date END AS snapshot_date,
        {_lines([f'CASE WHEN valid_{f} THEN {f} ELSE 0 END AS {f}' for f in FE])})
      FROM (SELECT *, {ID_FLAG}, {DATE_FLAG}, {_lines([f'{_non_negative(f)} AS valid_{f}' for f in FE])}
      FROM typed_clickstream)""",
}

LOAN_TYPES = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Payday Loan",
    "Student Loan",
]
HAS = {t: "has_" + t.lower().replace(" ", "_").replace("-", "_") for t in LOAN_TYPES}

SILVER = {
    "loans": """
      SELECT *, CASE WHEN overdue_amt > 0 AND first_missed_date IS NOT NULL
          THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER) ELSE 0 END AS dpd
      FROM (SELECT *, CASE WHEN installments_missed > 0
          THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
        FROM (SELECT *, installment_num AS mob,
            CASE WHEN overdue_amt IS NOT NULL AND due_amt > 0
              THEN CAST(ceil(overdue_amt / due_amt) AS INTEGER) ELSE 0 END AS installments_missed
          FROM flagged_loans WHERE valid_customer_id AND valid_snapshot_date))""",
    "attributes": """
      SELECT * REPLACE (upper(trim(Occupation)) AS Occupation),
        CASE WHEN Age < 0 THEN 18 WHEN Age > 150 THEN 65 ELSE Age END AS Age_capped
      FROM flagged_attributes""",
    "financials": f"""
      SELECT *, coalesce(Credit_History_Age_Months BETWEEN 0 AND 600, false) AS valid_credit_history_age
      FROM (SELECT * EXCLUDE (fate),
        {_lines([rf"CASE WHEN regexp_matches(Type_of_Loan, '\b{t}\b') THEN 1 ELSE 0 END AS {h}" for t, h in HAS.items()])},
        CAST(valid_type_of_loan AS INTEGER) AS has_any_loan,
        CASE WHEN Credit_History_Age IS NOT NULL THEN
          coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Years?', 1) AS INTEGER), 0) * 12
          + coalesce(TRY_CAST(regexp_extract(Credit_History_Age, '(\\d+)\\s+Months?', 1) AS INTEGER), 0)
          END AS Credit_History_Age_Months
      FROM flagged_financials WHERE fate = 'kept')""",
    "clickstream": "SELECT * FROM flagged_clickstream",
}

# ---- gold -----------------------------------------------------------------------

PMET = ", ".join(f"'{o}'" for o in fixed.PMET_OCCUPATIONS)
PMET_FLAG = f"CASE WHEN Occupation IN ({PMET}) THEN 1 ELSE 0 END AS is_PMET"
PAYMENT = """CASE WHEN Payment_Behaviour LIKE '%HIGH\\_SPENT%' ESCAPE '\\' THEN 1 ELSE 0 END AS spending_level,
  CASE WHEN Payment_Behaviour LIKE '%LARGE\\_VALUE%' ESCAPE '\\' THEN 2
    WHEN Payment_Behaviour LIKE '%MEDIUM\\_VALUE%' ESCAPE '\\' THEN 1 ELSE 0 END AS value_size"""
MIN_PAYMENT = """CASE WHEN Payment_of_Min_Amount = 'YES' THEN 1 ELSE 0 END AS payment_min_yes,
  CASE WHEN Payment_of_Min_Amount = 'NM' THEN 1 ELSE 0 END AS payment_min_nm"""
MIX = _lines([
    f"CASE WHEN Credit_Mix = '{m.upper()}' THEN 1 ELSE 0 END AS credit_mix_{m}"
    for m in ("good", "standard", "bad")
])

ATTRIBUTE_FEATURES = ["Age", "Occupation", "Age_capped", "is_PMET"]
FINANCIAL_FEATURES = [
    *FIN_FLOATS,
    *FIN_INTS,
    "Payment_Behaviour",
    *HAS.values(),
    "has_any_loan",
    "Credit_History_Age_Months",
    "spending_level",
    "value_size",
    "payment_min_yes",
    "payment_min_nm",
    "credit_mix_good",
    "credit_mix_standard",
    "credit_mix_bad",
]

GOLD = {
    "applications": "SELECT DISTINCT loan_id, Customer_ID, snapshot_date, mob FROM loans WHERE mob = 0",
    "labels": """
      SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
        '30dpd_6mob' AS label_def, snapshot_date
      FROM loans WHERE mob = 6""",
    "sweep": """
      SELECT loan_id, Customer_ID, CASE WHEN dpd >= t.theta THEN 1 ELSE 0 END AS label,
        concat(t.theta, 'dpd_', mob, 'mob') AS label_def, snapshot_date
      FROM loans, (VALUES (30), (60), (90)) AS t(theta) WHERE mob IN (3, 6, 9)""",
    # of several rows of a customer on one day the greatest counts
    "attribute_features": f"""
      SELECT *, {PMET_FLAG} FROM attributes
      QUALIFY row_number() OVER (PARTITION BY Customer_ID, snapshot_date
        ORDER BY Age DESC NULLS LAST, Occupation DESC NULLS LAST) = 1""",
    "financial_features": f"SELECT *, {PAYMENT}, {MIN_PAYMENT}, {MIX} FROM financials",
    "click_windows": f"""
      SELECT a.loan_id, a.Customer_ID, a.snapshot_date,
        {_lines([f'avg(c.{f}) AS avg_{f}_last_6m' for f in FE])},
        count(c.snapshot_date) AS clickstream_snapshot_count
      FROM applications a LEFT JOIN clickstream c ON a.Customer_ID = c.Customer_ID
        AND c.snapshot_date >= a.snapshot_date - 180 AND c.snapshot_date <= a.snapshot_date
      GROUP BY ALL""",
    "features": f"""
      SELECT a.loan_id, a.Customer_ID, a.snapshot_date, a.mob,
        {_lines([f't.{c}' for c in ATTRIBUTE_FEATURES] + [f'f.{c}' for c in FINANCIAL_FEATURES])},
        {_lines([f'w.avg_{f}_last_6m' for f in FE])}, w.clickstream_snapshot_count,
        CAST(a.snapshot_date AS VARCHAR) AS feature_snapshot_date,
        f.valid_customer_id AND f.valid_annual_income AND f.valid_credit_mix AS high_quality
      FROM applications a
      ASOF LEFT JOIN attribute_features t
        ON a.Customer_ID = t.Customer_ID AND a.snapshot_date >= t.snapshot_date
      ASOF LEFT JOIN financial_features f
        ON a.Customer_ID = f.Customer_ID AND a.snapshot_date >= f.snapshot_date
      JOIN click_windows w
        ON a.loan_id = w.loan_id AND a.Customer_ID = w.Customer_ID AND a.snapshot_date = w.snapshot_date""",
}

CTES = {**RAW, **TYPED, **FLAGGED, **SILVER, **GOLD}

_DATES = ["snapshot_date", "loan_start_date", "first_missed_date", "source_date"]


def _with(sql: str) -> str:
    """Put the tables a query needs, and those they need, in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in CTES.keys() & words - needed:
            needed.add(name)
            visit(CTES[name])

    visit(sql)
    tables = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items() if name in needed)
    return f"WITH {tables}\n{sql}" if tables else sql


def _texts(*dates: str) -> str:
    """Dates as ISO text in the result."""
    return "* REPLACE (" + ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates) + ")"


SNAPSHOT = "CAST(snapshot_date AS VARCHAR) AS snapshot_date"


def _quality(table: str, flags: list[str]) -> str:
    source = "loan_daily" if table == "loans" else table
    parts = [
        f"""
      SELECT '{source}' AS source, {SNAPSHOT}, '{flag}' AS flag,
        count(*) FILTER (WHERE {flag}) AS rows_valid,
        count(*) FILTER (WHERE NOT {flag}) AS rows_invalid,
        count(*) FILTER (WHERE {flag} IS NULL) AS rows_unknown,
        CASE WHEN count({flag}) > 0
          THEN CAST(count(*) FILTER (WHERE {flag}) AS DOUBLE) / count({flag}) END AS share_valid
      FROM {table} GROUP BY snapshot_date"""
        for flag in flags
    ]
    return " UNION ALL ".join(parts)


COMMON_FLAGS = ["valid_customer_id", "valid_snapshot_date"]
FIN_FLAGS = [
    "valid_annual_income",
    "valid_monthly_salary",
    "valid_credit_utilization",
    "valid_interest_rate",
    "valid_Outstanding_Debt",
    "valid_Monthly_Balance",
    "valid_Total_EMI_per_month",
    "valid_Amount_invested_monthly",
    "valid_payment_behaviour",
    "valid_payment_of_min_amount",
    "valid_credit_mix",
    "valid_type_of_loan",
    "valid_credit_history_age",
]

_KEPT = "SELECT * FROM flagged_financials WHERE fate = 'kept'"
_IN_DATE = f"snapshot_date IS NOT NULL AND snapshot_date BETWEEN DATE '2020-01-01' AND {AS_OF}"
_BAD_ROW = f"NOT (coalesce(valid_customer_id, false) AND {_IN_DATE})"

BODIES = {
    # ingest
    "bronze_snapshot_rows": f"""
      SELECT * REPLACE (CAST({_date('snapshot_date')} AS VARCHAR) AS snapshot_date) FROM raw_loans
      WHERE {_date('snapshot_date')} BETWEEN DATE '2023-01-01' AND DATE '2024-12-01'
        AND day({_date('snapshot_date')}) = 1""",
    "loan_partition_scan": f"""
      SELECT loan_id, Customer_ID, mob, balance, dpd, {SNAPSHOT} FROM loans
      WHERE snapshot_date = DATE '2023-01-01'""",
    "month_calendar": """
      SELECT CAST(m.d AS VARCHAR) AS snapshot_date, count(l.snapshot_date) AS rows
      FROM (SELECT CAST(unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) AS DATE) AS d
        FROM typed_loans WHERE snapshot_date BETWEEN DATE '2020-01-01' AND DATE '2024-12-31') m LEFT JOIN typed_loans l ON l.snapshot_date = m.d GROUP BY m.d""",
    "partition_counts": "\nUNION ALL ".join(
        f"SELECT '{source}' AS source, {SNAPSHOT}, count(*) AS rows FROM {table} GROUP BY snapshot_date"
        for source, table in [
            ("loan_daily", "typed_loans"),
            ("clickstream", "typed_clickstream"),
            ("attributes", "typed_attributes"),
            ("financials", "typed_financials"),
        ]
    ),
    # validation
    "v_clean_numeric": f"""
      SELECT Customer_ID, {_lines([c for n in FIN_FLOATS + FIN_INTS for c in (n, f'{n}_original')])}
      FROM typed_financials""",
    "v_parse_dates": f"""
      SELECT loan_id, installment_num, snapshot_date AS snapshot_text,
        CAST({_date('snapshot_date')} AS VARCHAR) AS snapshot_date,
        CAST({_date('loan_start_date')} AS VARCHAR) AS loan_start_date FROM raw_loans""",
    "v_customer_id": "SELECT loan_id, installment_num, Customer_ID, valid_customer_id FROM flagged_loans",
    "v_date_range": f"SELECT loan_id, installment_num, {SNAPSHOT}, valid_snapshot_date FROM flagged_loans",
    "v_drop_row_loans": f"""
      SELECT loan_id, installment_num, Customer_ID, {SNAPSHOT} FROM flagged_loans
      WHERE valid_customer_id AND valid_snapshot_date""",
    "v_flag_only_amounts": f"""
      SELECT loan_id, installment_num, {_lines([c for a in LOAN_AMOUNTS for c in (a, f'valid_{a}')])}
      FROM flagged_loans""",
    "v_default_clickstream": f"""
      SELECT Customer_ID, {_lines([c for f in FE for c in (f, f'valid_{f}')])} FROM flagged_clickstream""",
    "v_null_dates_clickstream": f"SELECT Customer_ID, {SNAPSHOT}, valid_snapshot_date FROM flagged_clickstream",
    "v_categoricals": """
      SELECT Customer_ID, Payment_Behaviour, valid_payment_behaviour, Payment_of_Min_Amount,
        valid_payment_of_min_amount, Credit_Mix, valid_credit_mix FROM flagged_financials""",
    "age_flags": "SELECT Customer_ID, Age, Age_original, Age_capped, valid_age FROM attributes",
    "ssn_flags": "SELECT Customer_ID, SSN, valid_ssn FROM attributes",
    "income_flags": f"""
      SELECT Customer_ID, Annual_Income, valid_annual_income, Monthly_Inhand_Salary, valid_monthly_salary
      FROM ({_KEPT})""",
    "credit_ranges": """
      SELECT Customer_ID, Credit_Utilization_Ratio, valid_credit_utilization, Interest_Rate, valid_interest_rate
      FROM flagged_financials""",
    "financial_amounts": """
      SELECT Customer_ID, Outstanding_Debt, valid_Outstanding_Debt, Monthly_Balance, valid_Monthly_Balance,
        Total_EMI_per_month, valid_Total_EMI_per_month, Amount_invested_monthly, valid_Amount_invested_monthly
      FROM flagged_financials""",
    "quarantine_financials": f"""
      SELECT 'financials' AS source, fate AS rule, Customer_ID, Annual_Income, Monthly_Inhand_Salary, {SNAPSHOT}
      FROM flagged_financials WHERE fate NOT IN ('kept', 'dropped')""",
    # silver tables
    "silver_loan_daily": f"SELECT {_texts('snapshot_date', 'loan_start_date', 'first_missed_date')} FROM loans",
    "silver_attributes": f"SELECT {_texts('snapshot_date')} FROM attributes",
    "silver_financials": f"SELECT {_texts('snapshot_date')} FROM financials",
    "silver_clickstream": f"SELECT {_texts('snapshot_date')} FROM clickstream",
    # derivations
    "loan_dpd": f"""
      SELECT loan_id, mob, due_amt, overdue_amt, {SNAPSHOT}, installments_missed,
        CAST(first_missed_date AS VARCHAR) AS first_missed_date, dpd FROM loans""",
    "loan_type_vocab": f"""
      SELECT loan_type, count(*) AS customers FROM (
        SELECT DISTINCT row_id, trim(unnest(string_split(replace(Type_of_Loan, ' and ', ','), ','))) AS loan_type
        FROM (SELECT *, row_number() OVER () AS row_id FROM ({_KEPT}))) WHERE contains(loan_type, 'Loan') GROUP BY loan_type""",
    "loan_type_flags": "SELECT Customer_ID, Type_of_Loan, valid_type_of_loan, has_any_loan FROM financials",
    "loan_type_pivot": f"SELECT Customer_ID, {_lines(list(HAS.values()))}, has_any_loan FROM financials",
    "credit_history_months": """
      SELECT Customer_ID, Credit_History_Age, Credit_History_Age_Months, valid_credit_history_age FROM financials""",
    # encodings
    "occupation_pmet": f"SELECT Customer_ID, Occupation, {PMET_FLAG} FROM attributes",
    "payment_behaviour_split": f"SELECT Customer_ID, Payment_Behaviour, {PAYMENT} FROM flagged_financials",
    "onehot_payment_min": f"SELECT Customer_ID, Payment_of_Min_Amount, {MIN_PAYMENT} FROM flagged_financials",
    "onehot_credit_mix": f"SELECT Customer_ID, Credit_Mix, {MIX} FROM flagged_financials",
    "gold_attributes_columns": f"""
      SELECT Customer_ID, Age, Age_original, Occupation, {SNAPSHOT}, valid_customer_id, valid_snapshot_date,
        valid_age, Age_capped FROM attributes""",
    # point in time
    "applications_mob0": f"SELECT loan_id, Customer_ID, {SNAPSHOT}, mob FROM applications",
    "left_join_customer": """
      SELECT a.loan_id, a.Customer_ID, CAST(a.snapshot_date AS VARCHAR) AS snapshot_date, a.mob, t.Age, t.Occupation
      FROM applications a LEFT JOIN (
        SELECT * FROM attributes QUALIFY row_number() OVER (PARTITION BY Customer_ID
          ORDER BY Age DESC NULLS LAST, Occupation DESC NULLS LAST) = 1) t ON a.Customer_ID = t.Customer_ID""",
    "left_join_customer_rows": """
      SELECT a.loan_id, a.Customer_ID, CAST(a.snapshot_date AS VARCHAR) AS snapshot_date, a.mob, t.Age, t.Occupation
      FROM applications a LEFT JOIN attributes t ON a.Customer_ID = t.Customer_ID""",
    "pit_join_attributes": """
      SELECT a.loan_id, a.Customer_ID, CAST(a.snapshot_date AS VARCHAR) AS snapshot_date, a.mob, t.Age, t.Occupation,
        CAST(t.snapshot_date AS VARCHAR) AS source_date
      FROM applications a LEFT JOIN attributes t
        ON a.Customer_ID = t.Customer_ID AND t.snapshot_date <= a.snapshot_date""",
    "asof_attributes": """
      SELECT a.loan_id, a.Customer_ID, CAST(a.snapshot_date AS VARCHAR) AS snapshot_date, a.mob, t.Age, t.Occupation,
        CAST(t.snapshot_date AS VARCHAR) AS source_date
      FROM applications a ASOF LEFT JOIN attribute_features t
        ON a.Customer_ID = t.Customer_ID AND a.snapshot_date >= t.snapshot_date""",
    "asof_financials": """
      SELECT a.loan_id, a.Customer_ID, CAST(a.snapshot_date AS VARCHAR) AS snapshot_date, a.mob,
        t.Annual_Income, t.Outstanding_Debt, t.Credit_Mix, CAST(t.snapshot_date AS VARCHAR) AS source_date
      FROM applications a ASOF LEFT JOIN financials t
        ON a.Customer_ID = t.Customer_ID AND a.snapshot_date >= t.snapshot_date""",
    "clickstream_window": f"""
      SELECT a.mob, w.* REPLACE (CAST(w.snapshot_date AS VARCHAR) AS snapshot_date)
      FROM applications a JOIN click_windows w USING (loan_id, Customer_ID, snapshot_date)""",
    # gold
    "label_store": f"SELECT {_texts('snapshot_date')} FROM labels",
    "label_store_all": """
      SELECT label_def, count(*) AS rows, CAST(sum(label) AS BIGINT) AS defaults,
        CAST(min(snapshot_date) AS VARCHAR) AS first_snapshot, CAST(max(snapshot_date) AS VARCHAR) AS last_snapshot
      FROM labels GROUP BY label_def""",
    "label_definitions": f"SELECT {_texts('snapshot_date')} FROM sweep",
    "label_distribution": "SELECT label_def, label, count(*) AS loans FROM sweep GROUP BY label_def, label",
    "feature_store": f"SELECT {_texts('snapshot_date')} FROM (SELECT * EXCLUDE (high_quality) FROM features )",
    "feature_preview": f"""
      SELECT {_texts('snapshot_date')} FROM (SELECT * EXCLUDE (high_quality) FROM features )
      ORDER BY loan_id LIMIT 10""",
    "training_set": """
      SELECT f.* EXCLUDE (high_quality) REPLACE (CAST(f.snapshot_date AS VARCHAR) AS snapshot_date),
        l.label, l.label_def, CAST(l.snapshot_date AS VARCHAR) AS label_snapshot_date
      FROM features f JOIN labels l ON f.loan_id = l.loan_id""",
    "temporal_split": f"""
      SELECT {_texts('snapshot_date')},
        CASE WHEN snapshot_date BETWEEN DATE '2023-01-01' AND DATE '2023-09-01' THEN 'train'
          WHEN snapshot_date BETWEEN DATE '2023-10-01' AND DATE '2023-11-01' THEN 'validation'
          WHEN snapshot_date BETWEEN DATE '2023-12-01' AND DATE '2024-01-01' THEN 'test'
          WHEN snapshot_date > DATE '2024-01-01' THEN 'oot' END AS split
      FROM applications""",
    # quality
    "high_quality_subset": f"""
      SELECT loan_id, Customer_ID, {SNAPSHOT}, Annual_Income, is_PMET, clickstream_snapshot_count
      FROM features WHERE high_quality""",
    "quality_report": "\nUNION ALL ".join([
        _quality("loans", COMMON_FLAGS + [f"valid_{a}" for a in LOAN_AMOUNTS]),
        _quality("attributes", COMMON_FLAGS + ["valid_age", "valid_ssn"]),
        _quality("financials", COMMON_FLAGS + FIN_FLAGS),
        _quality("clickstream", COMMON_FLAGS + [f"valid_{f}" for f in FE]),
    ]),
    "retention_report": f"""
      SELECT source, count(*) AS rows_in, count(*) FILTER (fate = 'kept') AS rows_kept,
        count(*) FILTER (fate = 'dropped') AS rows_dropped, count(*) FILTER (fate = 'quarantined') AS rows_quarantined,
        count(*) FILTER (fate = 'kept') / count(*) AS pct_kept
      FROM (
        SELECT 'loan_daily' AS source, CASE WHEN {_BAD_ROW} THEN 'dropped' ELSE 'kept' END AS fate FROM flagged_loans
        UNION ALL SELECT 'attributes', 'kept' FROM flagged_attributes
        UNION ALL SELECT 'clickstream', 'kept' FROM flagged_clickstream
        UNION ALL SELECT 'financials', CASE WHEN fate IN ('kept', 'dropped') THEN fate ELSE 'quarantined' END
          FROM flagged_financials )
      GROUP BY source""",
    "quarantine_counts": """
      SELECT 'financials' AS source, fate AS rule, count(*) AS rows FROM flagged_financials
      WHERE fate NOT IN ('kept', 'dropped') GROUP BY fate""",
}

BODIES["clickstream_window_totals"] = BODIES["clickstream_window"]
BODIES["pit_join_bucketed"] = BODIES["pit_join_attributes"]

# ---- metrics --------------------------------------------------------------------


def _metrics(table: str, flagged: str, typed: str, kept: str, quarantined: str, silver: str, flags: list[str]) -> str:
    def rows(metric: str, flag: str, counted: str, source: str) -> str:
        return (
            f"SELECT '{table}' AS table, CAST(snapshot_date AS VARCHAR) AS period, '{metric}' AS metric,"
            f" {flag} AS flag, {counted} AS rows FROM {source} GROUP BY snapshot_date"
        )

    left = f"(SELECT snapshot_date, {kept} AS is_kept FROM {flagged} WHERE {kept} OR {quarantined})"
    parts = [
        rows("in", "CAST(NULL AS VARCHAR)", "count(*)", typed),
        rows("kept", "CAST(NULL AS VARCHAR)", "count(*) FILTER (is_kept)", left),
        rows("quarantined", "CAST(NULL AS VARCHAR)", "count(*) FILTER (NOT is_kept)", left),
    ]
    for state, test in (("valid", "{}"), ("invalid", "NOT {}"), ("unknown", "{} IS NULL")):
        parts += [
            f"SELECT '{table}' AS table, CAST(p.snapshot_date AS VARCHAR) AS period, '{state}' AS metric, '{flag}' AS flag,"
            f" count(*) FILTER ({test.format('s.' + flag)} AND s.snapshot_date IS NOT NULL) AS rows"
            f" FROM (SELECT DISTINCT snapshot_date FROM {left}) p LEFT JOIN {silver} s ON p.snapshot_date = s.snapshot_date"
            " GROUP BY p.snapshot_date"
            for flag in flags
        ]
    return "\nUNION ALL ".join(parts)


BODIES["table_metrics"] = "\nUNION ALL ".join([
    _metrics("loan_daily", "flagged_loans", "typed_loans", f"(NOT {_BAD_ROW})", "false", "loans",
             COMMON_FLAGS + [f"valid_{a}" for a in LOAN_AMOUNTS]),
    _metrics("financials", "flagged_financials", "typed_financials", "(fate = 'kept')",
             "(fate NOT IN ('kept', 'dropped'))", "financials", COMMON_FLAGS + FIN_FLAGS),
])
BODIES["quality_off_metrics"] = (
    "SELECT * EXCLUDE (snapshot_date), snapshot_date AS period FROM ("
    + _quality("loans", COMMON_FLAGS + [f"valid_{a}" for a in LOAN_AMOUNTS]) + " )"
)

# ---- increments -----------------------------------------------------------------


def _digest(columns: list[str]) -> str:
    values = " || '|' || ".join(f"coalesce(CAST(length({c}) AS VARCHAR) || ':' || {c}, '-')" for c in columns)
    return f"CAST(sum(CAST('0x' || substr(md5({values}), 1, 15) AS BIGINT)) AS VARCHAR)"


ATTRIBUTE_VALUES = ["Customer_ID", "Name", "Age", "SSN", "Occupation"]


def _before(raw: str, value: str) -> str:
    return f"""SELECT * REPLACE (CASE WHEN snapshot_date LIKE '2021%' AND Customer_ID LIKE '%7' THEN '77' ELSE {value} END AS {value})
      FROM {raw} WHERE NOT (snapshot_date LIKE '2022%' AND Customer_ID LIKE '%a')"""


def _changed(raw: str, by: list[str], values: list[str], value: str) -> str:
    def side(rows: str) -> str:
        return f"(SELECT {', '.join(by)}, count(*) AS rows, {_digest(values)} AS digest FROM ({rows} ) GROUP BY {', '.join(by)})"

    names = ", ".join(f"coalesce(o.{c}, n.{c}) AS {c}" for c in by)
    same = " AND ".join(f"o.{c} = n.{c}" for c in by)
    return f"""SELECT {names} FROM {side(_before(raw, value))} o FULL JOIN {side('SELECT * FROM ' + raw)} n ON {same}
      WHERE o.rows IS DISTINCT FROM n.rows OR o.digest IS DISTINCT FROM n.digest"""


BODIES["month_fingerprints"] = "\nUNION ALL ".join(
    f"SELECT '{source}' AS source, snapshot_date, count(*) AS rows, {_digest(values)} AS digest FROM {raw} GROUP BY snapshot_date"
    for source, raw, values in (
        ("attributes", "raw_attributes", ATTRIBUTE_VALUES),
        ("clickstream", "raw_clickstream", ["Customer_ID", *FE]),
    )
)
BODIES["changed_months"] = _changed("raw_attributes", ["snapshot_date"], ATTRIBUTE_VALUES, "Age")
_CUSTOMERS = ["Customer_ID", "snapshot_date"]
BODIES["changed_customers"] = _changed("raw_attributes", _CUSTOMERS, ATTRIBUTE_VALUES[1:], "Age")
BODIES["touched_as_of"] = f"""
  SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS applications FROM (
    SELECT DISTINCT a.Customer_ID, a.snapshot_date FROM applications a
    JOIN ({BODIES["changed_customers"]} ) c ON a.Customer_ID = c.Customer_ID AND a.snapshot_date >= CAST(c.snapshot_date AS DATE)
    WHERE NOT EXISTS (SELECT 1 FROM attributes t WHERE t.Customer_ID = c.Customer_ID
      AND t.snapshot_date > CAST(c.snapshot_date AS DATE) AND t.snapshot_date <= a.snapshot_date))
  GROUP BY snapshot_date"""
BODIES["touched_look_back"] = f"""
  SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS applications FROM (
    SELECT DISTINCT a.Customer_ID, a.snapshot_date FROM applications a
    JOIN ({_changed("raw_clickstream", _CUSTOMERS, FE, FE[0])} ) c ON a.Customer_ID = c.Customer_ID
      AND a.snapshot_date - CAST(c.snapshot_date AS DATE) BETWEEN 0 AND 180)
  GROUP BY snapshot_date"""
BODIES["vocabulary_by_period"] = f"""
  SELECT loan_type, CAST(min(snapshot_date) AS VARCHAR) AS first_period FROM (
    SELECT snapshot_date, trim(unnest(string_split(replace(Type_of_Loan, ' and ', ','), ','))) AS loan_type
    FROM ({_KEPT})) WHERE contains(loan_type, 'Loan') GROUP BY loan_type"""
BODIES["click_daily_totals"] = f"""
  SELECT Customer_ID, CAST(snapshot_date AS VARCHAR) AS snapshot_date, count(*) AS _rows,
    {_lines([f"CAST(sum({f}) AS BIGINT) AS _sum_{f}" for f in FE] + [f"count({f}) AS _n_{f}" for f in FE])}
  FROM clickstream WHERE Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL GROUP BY Customer_ID, clickstream.snapshot_date"""

ORACLE_SQL = {name: _with(body) for name, body in BODIES.items()}
