"""One query per operator, over the role views of the retail tables.

Money comes out as double and dates as ISO text, so that values compare across
engines as they are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmart import fixed_values as fixed
from creditmart.functions import checks, parsing, project, quoted
from creditmart.operators import changes, derivations, encodings, labels, metrics, pointintime, quality
from creditmart.operators.validation import kept_rows, quarantined_rows, type_columns
from creditmart.plans import layers, vocabulary
from creditmart.plans.specs import ATTRIBUTES, CLICKSTREAM, FINANCIALS, LOAN_DAILY, TABLES
from creditmart.session import tune
from creditmart.sources import roles, tables

Query = Callable[[SparkSession, str], DataFrame]

# The role views run into the future; rows after this day fail the date check.
AS_OF = dt.date(2024, 12, 31)
FIRST = dt.date.fromisoformat(fixed.FIRST_MONTH)
LAST = dt.date.fromisoformat(fixed.LAST_MONTH)

# the types that the role views name
LOAN_TYPES = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Payday Loan",
    "Student Loan",
]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def comparable(spark: SparkSession, folder: str) -> DataFrame:
        result = build(tune(spark), folder)
        casts = {"float": "double", "date": "string"}
        return project(
            result,
            {name: f"CAST({quoted(name)} AS {casts[kind]})" for name, kind in result.dtypes if kind in casts},
        )

    QUERIES[build.__name__] = comparable
    return comparable


def typed(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return type_columns(roles.RAW[name](spark, folder), TABLES[name].types)


def flagged(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return layers.flagged(TABLES[name], roles.RAW[name](spark, folder), AS_OF)


def loans(spark: SparkSession, folder: str) -> DataFrame:
    return layers.silver(LOAN_DAILY, roles.raw_loans(spark, folder), AS_OF)


def loans_on_book(spark: SparkSession, folder: str, *mobs: int) -> DataFrame:
    return layers.loans_on_book(roles.raw_loans(spark, folder), mobs, AS_OF)


def applications(spark: SparkSession, folder: str) -> DataFrame:
    # loans without customer or date are dropped by their rules
    return layers.shared_applications(loans_on_book(spark, folder, 0))


def attributes(spark: SparkSession, folder: str) -> DataFrame:
    return layers.silver(ATTRIBUTES, roles.raw_attributes(spark, folder), AS_OF)


def clickstream(spark: SparkSession, folder: str) -> DataFrame:
    return layers.silver(CLICKSTREAM, roles.raw_clickstream(spark, folder), AS_OF)


def financials(spark: SparkSession, folder: str) -> DataFrame:
    silver = layers.silver(FINANCIALS, roles.raw_financials(spark, folder), AS_OF)
    return derivations.loan_type_indicators(silver, LOAN_TYPES).drop(derivations.LOAN_TYPES)


def features(
    spark: SparkSession, folder: str, with_flags: bool = False, of: DataFrame | None = None
) -> DataFrame:
    return layers.feature_store(
        applications(spark, folder) if of is None else of,
        attributes(spark, folder),
        financials(spark, folder),
        clickstream(spark, folder),
        with_flags,
    )


# ---- ingest -------------------------------------------------------------------


@query
def bronze_snapshot_rows(spark, folder):
    """Raw loan rows of the calendar's snapshots, all months at once."""
    return layers.bronze(roles.raw_loans(spark, folder), FIRST, LAST)


@query
def loan_partition_scan(spark, folder):
    """Loans of one snapshot."""
    return (
        loans(spark, folder)
        .where(F.col("snapshot_date") == F.lit(FIRST))
        .select("loan_id", "Customer_ID", "mob", "balance", "dpd", "snapshot_date")
    )


@query
def month_calendar(spark, folder):
    """Every month of the span of the loans' valid dates with its rows, gaps included."""
    days = typed("loan_daily", spark, folder).select("snapshot_date")
    days = days.where(checks.snapshot_in_range(AS_OF)("snapshot_date"))
    span = days.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))
    counts = quality.partition_counts(days)
    return (
        layers.month_calendar(span)
        .join(counts, "snapshot_date", "left")
        .select("snapshot_date", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))
    )


@query
def partition_counts(spark, folder):
    """Rows per source and snapshot."""
    counts = [
        quality.partition_counts(typed(name, spark, folder)).withColumn("source", F.lit(name))
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


# ---- validation ---------------------------------------------------------------


@query
def v_clean_numeric(spark, folder):
    """Every number of the financials, cleaned and as it was."""
    numbers = [c for c, kind in FINANCIALS.types.items() if kind in ("int", "float")]
    return typed("financials", spark, folder).select(
        "Customer_ID", *numbers, *(f"{c}_original" for c in numbers)
    )


@query
def v_parse_dates(spark, folder):
    return roles.raw_loans(spark, folder).selectExpr(
        "loan_id",
        "installment_num",
        "snapshot_date AS snapshot_text",
        f"{parsing.to_date('snapshot_date')} AS snapshot_date",
        f"{parsing.to_date('loan_start_date')} AS loan_start_date",
    )


@query
def v_customer_id(spark, folder):
    return flagged("loan_daily", spark, folder).select(
        "loan_id", "installment_num", "Customer_ID", "valid_customer_id"
    )


@query
def v_date_range(spark, folder):
    return flagged("loan_daily", spark, folder).select(
        "loan_id", "installment_num", "snapshot_date", "valid_snapshot_date"
    )


@query
def v_drop_row_loans(spark, folder):
    return kept_rows(flagged("loan_daily", spark, folder)).select(
        "loan_id", "installment_num", "Customer_ID", "snapshot_date"
    )


@query
def v_flag_only_amounts(spark, folder):
    amounts = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
    return flagged("loan_daily", spark, folder).select(
        "loan_id", "installment_num", *amounts, *(f"valid_{a}" for a in amounts)
    )


@query
def v_default_clickstream(spark, folder):
    return flagged("clickstream", spark, folder).select(
        "Customer_ID", *fixed.CLICK_FEATURES, *(f"valid_{f}" for f in fixed.CLICK_FEATURES)
    )


@query
def v_null_dates_clickstream(spark, folder):
    return flagged("clickstream", spark, folder).select(
        "Customer_ID", "snapshot_date", "valid_snapshot_date"
    )


@query
def v_categoricals(spark, folder):
    names = ["Payment_Behaviour", "Payment_of_Min_Amount", "Credit_Mix"]
    return flagged("financials", spark, folder).select(
        "Customer_ID", *names, *(f"valid_{name.lower()}" for name in names)
    )


@query
def age_flags(spark, folder):
    return attributes(spark, folder).select("Customer_ID", "Age", "Age_original", "Age_capped", "valid_age")


@query
def ssn_flags(spark, folder):
    return attributes(spark, folder).select("Customer_ID", "SSN", "valid_ssn")


@query
def income_flags(spark, folder):
    return kept_rows(flagged("financials", spark, folder)).select(
        "Customer_ID",
        "Annual_Income",
        "valid_annual_income",
        "Monthly_Inhand_Salary",
        "valid_monthly_salary",
    )


@query
def credit_ranges(spark, folder):
    return flagged("financials", spark, folder).select(
        "Customer_ID",
        "Credit_Utilization_Ratio",
        "valid_credit_utilization",
        "Interest_Rate",
        "valid_interest_rate",
    )


@query
def financial_amounts(spark, folder):
    names = ["Outstanding_Debt", "Monthly_Balance", "Total_EMI_per_month", "Amount_invested_monthly"]
    return flagged("financials", spark, folder).select(
        "Customer_ID", *names, *(f"valid_{name}" for name in names)
    )


@query
def quarantine_financials(spark, folder):
    return quarantined_rows(flagged("financials", spark, folder), "financials").select(
        "source", "rule", "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "snapshot_date"
    )


# ---- silver tables ------------------------------------------------------------


@query
def silver_loan_daily(spark, folder):
    return loans(spark, folder)


@query
def silver_attributes(spark, folder):
    return attributes(spark, folder)


@query
def silver_financials(spark, folder):
    return financials(spark, folder)


@query
def silver_clickstream(spark, folder):
    return clickstream(spark, folder)


# ---- derivations --------------------------------------------------------------


@query
def loan_dpd(spark, folder):
    return loans(spark, folder).select(
        "loan_id",
        "mob",
        "due_amt",
        "overdue_amt",
        "snapshot_date",
        "installments_missed",
        "first_missed_date",
        "dpd",
    )


@query
def loan_type_vocab(spark, folder):
    return layers.loan_type_vocabulary(roles.raw_financials(spark, folder), AS_OF)


@query
def loan_type_flags(spark, folder):
    """Which customers name any loan type, and what they wrote."""
    return financials(spark, folder).select(
        "Customer_ID", "Type_of_Loan", "valid_type_of_loan", "has_any_loan"
    )


@query
def loan_type_pivot(spark, folder):
    """One indicator column per loan type."""
    table = financials(spark, folder)
    return table.select("Customer_ID", *(c for c in table.columns if c.startswith("has_")))


@query
def credit_history_months(spark, folder):
    return financials(spark, folder).select(
        "Customer_ID", "Credit_History_Age", "Credit_History_Age_Months", "valid_credit_history_age"
    )


# ---- encodings ----------------------------------------------------------------


@query
def occupation_pmet(spark, folder):
    return encodings.occupation_group(attributes(spark, folder)).select(
        "Customer_ID", "Occupation", "is_PMET"
    )


@query
def payment_behaviour_split(spark, folder):
    return encodings.payment_behaviour(flagged("financials", spark, folder)).select(
        "Customer_ID", "Payment_Behaviour", "spending_level", "value_size"
    )


@query
def onehot_payment_min(spark, folder):
    return encodings.minimum_payment(flagged("financials", spark, folder)).select(
        "Customer_ID", "Payment_of_Min_Amount", "payment_min_yes", "payment_min_nm"
    )


@query
def onehot_credit_mix(spark, folder):
    return encodings.credit_mix(flagged("financials", spark, folder)).select(
        "Customer_ID", "Credit_Mix", "credit_mix_good", "credit_mix_standard", "credit_mix_bad"
    )


@query
def gold_attributes_columns(spark, folder):
    """Attributes without the columns of no use to a model."""
    return encodings.drop_non_predictive(attributes(spark, folder))


# ---- point in time ------------------------------------------------------------


@query
def applications_mob0(spark, folder):
    return applications(spark, folder)


@query
def left_join_customer(spark, folder):
    return pointintime.customer_join(
        applications(spark, folder),
        attributes(spark, folder).select("Customer_ID", "Age", "Occupation"),
    )


@query
def left_join_customer_rows(spark, folder):
    """Every application with each attribute row of its customer, whatever its date."""
    return pointintime.customer_join(
        applications(spark, folder),
        attributes(spark, folder).select("Customer_ID", "Age", "Occupation"),
        every_row=True,
    )


@query
def pit_join_attributes(spark, folder):
    """Every earlier attribute row of each application's customer."""
    return pointintime.history_join(
        applications(spark, folder),
        attributes(spark, folder).select("Customer_ID", "snapshot_date", "Age", "Occupation"),
    )


@query
def asof_attributes(spark, folder):
    """The latest earlier attribute row of each application's customer."""
    return pointintime.as_of_join(
        applications(spark, folder),
        attributes(spark, folder).select("Customer_ID", "snapshot_date", "Age", "Occupation"),
    )


@query
def asof_financials(spark, folder):
    return pointintime.as_of_join(
        applications(spark, folder),
        kept_rows(flagged("financials", spark, folder)).select(
            "Customer_ID", "snapshot_date", "Annual_Income", "Outstanding_Debt", "Credit_Mix"
        ),
    )


@query
def clickstream_window(spark, folder):
    return pointintime.look_back_join(
        applications(spark, folder), clickstream(spark, folder)
    )


# ---- gold ---------------------------------------------------------------------


@query
def label_store(spark, folder):
    return labels.label_loans(loans_on_book(spark, folder, fixed.LABEL_MOB))


@query
def label_store_all(spark, folder):
    """All months' labels as one frame: rows, defaults and span per definition."""
    return (
        labels.label_loans(loans_on_book(spark, folder, fixed.LABEL_MOB))
        .groupBy("label_def")
        .agg(
            F.count("*").alias("rows"),
            F.sum("label").alias("defaults"),
            F.min("snapshot_date").alias("first_snapshot"),
            F.max("snapshot_date").alias("last_snapshot"),
        )
    )


@query
def label_definitions(spark, folder):
    return labels.label_sweep(loans_on_book(spark, folder, *fixed.SWEEP_MOB))


@query
def label_distribution(spark, folder):
    return labels.label_distribution(labels.label_sweep(loans_on_book(spark, folder, *fixed.SWEEP_MOB)))


@query
def feature_store(spark, folder):
    return features(spark, folder)


@query
def feature_preview(spark, folder):
    """The first ten rows of the feature store."""
    # one row per application, so the first ten applications have the first ten rows
    first = tables.preview(applications(spark, folder), 10, "loan_id").select("loan_id").distinct()
    # a semi-join would move below the shuffle, and the loans would be read for it once more
    chosen = applications(spark, folder).join(first, "loan_id")
    return tables.preview(features(spark, folder, of=chosen), 10, "loan_id")


@query
def training_set(spark, folder):
    # only loans with an id have an outcome to be joined with
    named = applications(spark, folder).where("loan_id IS NOT NULL")
    return labels.training_set(features(spark, folder, of=named), labels.label_loans(loans_on_book(spark, folder, fixed.LABEL_MOB)))


@query
def temporal_split(spark, folder):
    """Applications with the split their date puts them in."""
    return labels.time_split(applications(spark, folder))


# ---- quality ------------------------------------------------------------------


@query
def high_quality_subset(spark, folder):
    """Features whose id, income and credit mix were all valid."""
    flags = ["financials_valid_customer_id", "valid_annual_income", "valid_credit_mix"]
    return quality.high_quality(features(spark, folder, with_flags=True), flags).select(
        "loan_id", "Customer_ID", "snapshot_date", "Annual_Income", "is_PMET", "clickstream_snapshot_count"
    )


@query
def quality_report(spark, folder):
    """Valid, invalid and unknown values per table, snapshot and flag."""
    silver = {"loan_daily": loans, "attributes": attributes, "financials": financials, "clickstream": clickstream}
    reports = [
        quality.quality_report(table(spark, folder), name, "snapshot_date")
        for name, table in silver.items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def retention_report(spark, folder):
    return quality.retention_report({name: flagged(name, spark, folder) for name in TABLES})


@query
def quarantine_counts(spark, folder):
    return quality.quarantine_counts(quarantined_rows(flagged("financials", spark, folder), "financials"))


@query
def table_metrics(spark, folder):
    """Counts of two tables by month: rows that came in, stayed, were quarantined, and states of flags."""
    counted = []
    for name in ("loan_daily", "financials"):
        day, spec = F.col("snapshot_date"), TABLES[name]
        counted.append(metrics.of_rows(typed(name, spark, folder).select(day), name, day, metrics.IN))
        counted.append(metrics.of_sorted_out(layers.sorted_out(spec, flagged(name, spark, folder)), name, day))
    return metrics.together(counted)


@query
def quality_off_metrics(spark, folder):
    """The quality report of the loans, read off their metrics."""
    day = F.col("snapshot_date")
    rows = layers.sorted_out(LOAN_DAILY, flagged("loan_daily", spark, folder))
    return metrics.quality_report(metrics.of_sorted_out(rows, "loan_daily", day))


# ---- increments ---------------------------------------------------------------


def _before(rows: DataFrame) -> DataFrame:
    """The delivery of a source before: some customers' rows of a year differ, others lack."""
    rows = rows.where("NOT (snapshot_date LIKE '2022%' AND Customer_ID LIKE '%a')")
    value = next(c for c in rows.columns if c not in ("Customer_ID", "snapshot_date", "Name"))
    changed = "snapshot_date LIKE '2021%' AND Customer_ID LIKE '%7'"
    return project(rows, {value: f"CASE WHEN {changed} THEN '77' ELSE {quoted(value)} END"})


def _changed(raw: DataFrame) -> DataFrame:
    versions = [project(rows, {"snapshot_date": parsing.to_date("snapshot_date")}) for rows in (_before(raw), raw)]
    return changes.changed_customers(*versions)


@query
def month_fingerprints(spark, folder):
    """Rows and digest of every month of the attributes and the clicks."""
    found = []
    for name in ("attributes", "clickstream"):
        counted = changes.fingerprints(roles.RAW[name](spark, folder), ["snapshot_date"])
        found.append(counted.withColumn("source", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


@query
def changed_months(spark, folder):
    """Months of the attributes that differ from the delivery before."""
    raw = roles.raw_attributes(spark, folder)
    versions = [changes.fingerprints(rows, ["snapshot_date"]) for rows in (_before(raw), raw)]
    return changes.differing(*versions, ["snapshot_date"])


@query
def changed_customers(spark, folder):
    """Customers and days of the attributes that differ from the delivery before."""
    return _changed(roles.raw_attributes(spark, folder))


@query
def touched_as_of(spark, folder):
    """Applications that see a changed attribute row, by month."""
    touched = changes.touched_as_of(
        applications(spark, folder),
        _changed(roles.raw_attributes(spark, folder)),
        attributes(spark, folder).where("snapshot_date IS NOT NULL"),
    )
    return touched.groupBy("snapshot_date").agg(F.count("*").alias("applications"))


@query
def touched_look_back(spark, folder):
    """Applications that look back on changed clicks, by month."""
    touched = changes.touched_look_back(
        applications(spark, folder), _changed(roles.raw_clickstream(spark, folder))
    )
    return touched.groupBy("snapshot_date").agg(F.count("*").alias("applications"))


@query
def vocabulary_by_period(spark, folder):
    """Loan types and the first month that names each."""
    return vocabulary.named(layers.silver(FINANCIALS, roles.raw_financials(spark, folder), AS_OF), F.col("snapshot_date"))


# ---- other ways to the same rows ------------------------------------------------


@query
def click_daily_totals(spark, folder):
    return pointintime.daily_totals(clickstream(spark, folder))


@query
def clickstream_window_totals(spark, folder):
    """The look-back averages, from daily totals."""
    return pointintime.look_back_join(
        applications(spark, folder),
        pointintime.daily_totals(clickstream(spark, folder)),
        of_totals=True,
    )


@query
def pit_join_bucketed(spark, folder):
    """Every earlier attribute row of each application's customer, joined by customer and month."""
    return pointintime.bucketed_history_join(
        applications(spark, folder),
        attributes(spark, folder).select("Customer_ID", "snapshot_date", "Age", "Occupation"),
    )
