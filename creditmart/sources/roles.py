"""Raw extracts played by the retail test tables.

Orders play loan snapshots, customers play attributes and financials, events
play clickstream. They plant the dirty values the rules are there for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditmart import fixed_values as fixed

MONTHS_PER_LOAN = 11


def _month_start(months: str) -> str:
    """First day of the month ``months`` after January 2020."""
    return f"add_months(DATE '2020-01-01', CAST({months} AS INT))"


_CUSTOMER_ID = "concat('CUS_0x', lower(hex({key})))"
_CUSTOMER_SNAPSHOT = f"CAST({_month_start('months')} AS STRING) AS snapshot_date"
_CLICK_SNAPSHOT = f"CAST({_month_start('event_id*11 % 84')} AS STRING) AS snapshot_date"

# ---- loans: one order gives one row per month on book k -------------------------

LOAN_BASE = [
    "o_orderkey AS ok",
    "o_custkey AS ck",
    "CAST(floor(o_totalprice) AS BIGINT) AS amt",
    "(year(o_orderdate)-1995)*12 + month(o_orderdate)-1 AS m0",
]
LOAN_MONTHS = [
    "ok",
    "ck",
    "amt",
    "m0",
    "k",
    "CAST(floor(amt/10.0) AS BIGINT) AS inst",
    f"{_month_start('m0 + k')} AS sd",
]
LOAN_AMOUNTS = [
    "*",
    "CASE WHEN k=0 THEN 0 ELSE inst END AS due",
    "CASE WHEN k>0 AND ok % 5 = 0 THEN inst * ((ok + k*k) % 4) + ok % 3 ELSE 0 END AS od",
]
LOANS = [
    "concat('LN_', CAST(ok AS STRING)) AS loan_id",
    "CASE WHEN ok % 97 = 0 THEN concat('BAD_', CAST(ck AS STRING)) WHEN ok % 101 = 0 THEN NULL"
    f" ELSE {_CUSTOMER_ID.format(key='ck')} END AS Customer_ID",
    f"CAST({_month_start('m0')} AS STRING) AS loan_start_date",
    "'10' AS tenure",
    "CAST(k AS STRING) AS installment_num",
    "CASE ok % 11 WHEN 0 THEN concat('_', CAST(amt AS STRING)) WHEN 1 THEN concat('$', CAST(amt AS STRING))"
    " WHEN 2 THEN '0' WHEN 3 THEN 'n/a' ELSE CAST(amt AS STRING) END AS loan_amt",
    "CAST(due AS STRING) AS due_amt",
    "CAST(CASE WHEN od >= due THEN 0 ELSE due - od END AS STRING) AS paid_amt",
    "CAST(od AS STRING) AS overdue_amt",
    "CAST(amt - k*inst AS STRING) AS balance",
    "CASE WHEN ok % 2 = 0 THEN CAST(sd AS STRING)"
    " ELSE concat(day(sd), '/', month(sd), '/', year(sd) % 100) END AS snapshot_date",
]

# ---- snapshots of customers: one customer gives several, some give none ------------

# k = 3 falls on the day of k = 0, with other values
ATTRIBUTE_SNAPSHOTS, FINANCIAL_SNAPSHOTS = 4, 3
WITHOUT_SNAPSHOTS = "c_custkey % 29 = 0"
SNAPSHOTS = [
    "c_custkey AS id_key",
    "c_custkey + 7*k AS c_custkey",
    "c_name",
    "(c_custkey*7 + 13*(k % 3)) % 60 AS months",
]

# ---- attributes -----------------------------------------------------------------

ATTRIBUTES = [
    f"{_CUSTOMER_ID.format(key='id_key')} AS Customer_ID",
    "c_name AS Name",
    "CASE c_custkey % 50 WHEN 1 THEN '-500' WHEN 2 THEN '8698' WHEN 3 THEN NULL WHEN 4 THEN '120'"
    " WHEN 5 THEN concat(CAST(18 + c_custkey*13 % 60 AS STRING),'_')"
    " ELSE CAST(18 + c_custkey*13 % 60 AS STRING) END AS Age",
    "CASE WHEN c_custkey % 17 = 0 THEN '#F%$D@*&8' ELSE concat(lpad(CAST(c_custkey % 1000 AS STRING),3,'0'),'-',"
    "lpad(CAST(c_custkey % 100 AS STRING),2,'0'),'-',lpad(CAST(c_custkey % 10000 AS STRING),4,'0')) END AS SSN",
    "CASE c_custkey % 8 WHEN 0 THEN ' Lawyer' WHEN 1 THEN 'Media_Manager' WHEN 2 THEN '_______'"
    " WHEN 3 THEN 'mechanic ' WHEN 4 THEN 'Engineer' WHEN 5 THEN NULL WHEN 6 THEN 'Writer'"
    " ELSE 'Teacher' END AS Occupation",
]

# ---- financials -----------------------------------------------------------------

FINANCIALS = [
    f"{_CUSTOMER_ID.format(key='id_key')} AS Customer_ID",
    "CASE c_custkey % 40 WHEN 0 THEN '500' WHEN 1 THEN '24000000' WHEN 2 THEN NULL WHEN 3 THEN '5000'"
    " WHEN 4 THEN '1,250_00' ELSE concat(CAST(15000 + c_custkey*37 % 90000 AS STRING),'_') END AS Annual_Income",
    "CASE c_custkey % 41 WHEN 0 THEN '50' WHEN 1 THEN '2000000' WHEN 2 THEN NULL"
    " ELSE CAST(900 + c_custkey*29 % 9000 AS STRING) END AS Monthly_Inhand_Salary",
    "CAST(c_custkey % 9 AS STRING) AS Num_Bank_Accounts",
    "CAST(c_custkey % 7 AS STRING) AS Num_Credit_Card",
    "CAST(c_custkey % 130 AS STRING) AS Interest_Rate",
    "CAST(c_custkey % 5 AS STRING) AS Num_of_Loan",
    "CASE c_custkey % 6 WHEN 0 THEN 'Auto Loan, Payday Loan, and Credit-Builder Loan' WHEN 1 THEN 'Not Specified'"
    " WHEN 2 THEN '' WHEN 3 THEN ' Mortgage Loan and Home Equity Loan ' WHEN 4 THEN 'Payday Loan, Payday Loan'"
    " ELSE 'Not Specified, Student Loan' END AS Type_of_Loan",
    "CAST(c_custkey % 60 - 5 AS STRING) AS Delay_from_due_date",
    "concat(CAST(c_custkey % 25 AS STRING), '_') AS Num_of_Delayed_Payment",
    "CASE WHEN c_custkey % 12 = 0 THEN '_' ELSE CAST(c_custkey % 30 AS STRING) END AS Changed_Credit_Limit",
    "CAST(c_custkey % 14 AS STRING) AS Num_Credit_Inquiries",
    "CASE c_custkey % 5 WHEN 0 THEN '_' WHEN 1 THEN 'Bad' WHEN 2 THEN 'Good' ELSE 'Standard' END AS Credit_Mix",
    "CASE WHEN c_custkey % 9 = 0 THEN '-10' ELSE CAST(c_custkey*17 % 5000 AS STRING) END AS Outstanding_Debt",
    "CASE WHEN c_custkey % 3 = 0 THEN '0.5' ELSE CAST(20 + c_custkey % 20 AS STRING) END AS Credit_Utilization_Ratio",
    "CASE c_custkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN NULL WHEN 2 THEN '1 Year and 1 Month'"
    " WHEN 3 THEN '60 Years and 0 Months' ELSE concat(CAST(c_custkey % 30 AS STRING),' Years and ',"
    "CAST(c_custkey % 12 AS STRING),' Months') END AS Credit_History_Age",
    "CASE c_custkey % 4 WHEN 0 THEN 'No' WHEN 1 THEN 'NM' ELSE 'Yes' END AS Payment_of_Min_Amount",
    "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE CAST(c_custkey % 300 AS STRING) END AS Total_EMI_per_month",
    "CASE WHEN c_custkey % 10 = 0 THEN '__10000__' ELSE CAST(c_custkey % 500 - 3 AS STRING) END"
    " AS Amount_invested_monthly",
    "CASE c_custkey % 7 WHEN 0 THEN '!@9#%8' WHEN 1 THEN 'High_spent_Small_value_payments'"
    " WHEN 2 THEN 'Low_spent_Large_value_payments' WHEN 3 THEN 'High_spent_Medium_value_payments'"
    " WHEN 4 THEN 'High_spent_Large_value_payments' WHEN 5 THEN 'Low_spent_Medium_value_payments'"
    " ELSE 'Low_spent_Small_value_payments' END AS Payment_Behaviour",
    "CASE WHEN c_custkey % 31 = 0 THEN '__-333333333333333333333333333__'"
    " ELSE CAST(c_custkey*19 % 1000 AS STRING) END AS Monthly_Balance",
]

# ---- clickstream ----------------------------------------------------------------

CLICKSTREAM = [
    f"{_CUSTOMER_ID.format(key='user_id')} AS Customer_ID",
    *(
        f"CASE WHEN event_id % {30 + i} = 0 THEN NULL ELSE CAST(event_id*{3 + i} % 211 - 5 AS STRING) END AS {feature}"
        for i, feature in enumerate(fixed.CLICK_FEATURES, start=1)
    ),
]


def _table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A test table, dealt out by its key.

    The tables come as one file each, which one task would read and multiply. There are as
    many shares as any shuffle of the session has. Their number is named, because small shares
    would be merged again for their size before each row is multiplied.
    """
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.parquet(f"{folder}/{name}.parquet").repartition(shares, key)


def raw_loans(spark: SparkSession, folder: str) -> DataFrame:
    orders = _table(spark, folder, "orders", "o_orderkey").selectExpr(*LOAN_BASE)
    months = orders.selectExpr("*", f"explode(sequence(0, {MONTHS_PER_LOAN - 1})) AS k")
    return months.selectExpr(*LOAN_MONTHS).selectExpr(*LOAN_AMOUNTS).selectExpr(*LOANS)


def _customer_snapshots(spark: SparkSession, folder: str, number: int) -> DataFrame:
    customers = _table(spark, folder, "customer", "c_custkey").where(f"NOT {WITHOUT_SNAPSHOTS}")
    return customers.selectExpr("c_custkey", "c_name", f"explode(sequence(0, {number - 1})) AS k").selectExpr(*SNAPSHOTS)


def raw_attributes(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_snapshots(spark, folder, ATTRIBUTE_SNAPSHOTS).selectExpr(*ATTRIBUTES, _CUSTOMER_SNAPSHOT)


def raw_financials(spark: SparkSession, folder: str) -> DataFrame:
    return _customer_snapshots(spark, folder, FINANCIAL_SNAPSHOTS).selectExpr(*FINANCIALS, _CUSTOMER_SNAPSHOT)


def raw_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events", "event_id").selectExpr(*CLICKSTREAM, _CLICK_SNAPSHOT)


RAW = {
    "loan_daily": raw_loans,
    "attributes": raw_attributes,
    "financials": raw_financials,
    "clickstream": raw_clickstream,
}
