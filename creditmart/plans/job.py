"""The job: raw extracts to bronze, silver and gold tables of one run.

Every layer reads the tables of the layer before, so each can run by itself,
for any range of months, and a range that runs again replaces its months. All
months that a layer writes become visible together, see ``publication``.

    <base>/<run_id>/bronze/...                          raw text, by snapshot_date
    <base>/<run_id>/silver/<table>/period=<month>       typed rows, by bronze month
    <base>/<run_id>/silver/click_totals/period=<month>  clicks summed by customer and day
    <base>/<run_id>/quarantine/source=/rule=/period=    rows taken out, and malformed lines
    <base>/<run_id>/gold/label_store, feature_store     by snapshot month
    <base>/<run_id>/vocabulary/version=<n>              loan types named so far
    <base>/<run_id>/metrics/table=/period=              counts of every month written
    <base>/<run_id>/manifest                            what the extracts held, see ``refresh``
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditmart import fixed_values as fixed
from creditmart.functions import quoted
from creditmart.operators import changes, derivations, labels, metrics, pointintime
from creditmart.operators.pointintime import KEY, TIME
from creditmart.operators.validation import DROPPED, KEPT, OUTCOME, QUARANTINED
from creditmart.plans import layers, manifest, vocabulary
from creditmart.plans.layers import FATE, RULE
from creditmart.plans.specs import BY_SOURCE, CLICKSTREAM, FINANCIALS, LOAN_DAILY, TABLES, TableSpec
from creditmart.sources import bucketed, extracts, files, tables
from creditmart.sources.publication import Publication, discard_unpublished, folder, recover

LAYERS = ("bronze", "silver", "gold")
PERIOD = "period"
TOTALS = "click_totals"
UNDATED = manifest.UNDATED
MALFORMED_RULE = "malformed_line"

Months = Callable[[str], bool]


@dataclass
class Run:
    """One run of the datamart and the counts its writes observed.

    Without ``first`` and ``last`` it takes all months there are. ``loan_types`` are the
    types that get an indicator in gold, by default those of the stored vocabulary; silver
    keeps all types of every row.
    """

    spark: SparkSession
    base: str
    run_id: str
    first: dt.date | None = None
    last: dt.date | None = None
    as_of: dt.date | None = None
    dpd: int = fixed.LABEL_DPD
    mob: int = fixed.LABEL_MOB
    loan_types: Sequence[str] | None = None
    #: parts into which silver tables are cut by customer, so that features shuffle less; a run keeps its number
    buckets: int | None = None
    rows: dict[str, int] = field(default_factory=dict)
    #: by table, the months that the last refresh wrote
    rewritten: dict[str, list[str]] = field(default_factory=dict)

    def path(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), self.run_id, *parts])

    def covers(self, month: str) -> bool:
        """Does the run take a month? A table's part without a month goes with any."""
        after = self.first is None or self.first.replace(day=1).isoformat() <= month
        return after and (self.last is None or month <= self.last.isoformat())

    def _publication(self) -> Publication:
        discard_unpublished(self.spark, self.path())
        return Publication(self.spark, self.path())

    # ---- bronze ---------------------------------------------------------------

    def bronze(self, raw_folder: str) -> None:
        """All extracts found in a folder, each in one pass over all its months."""
        published = self._publication()
        for source, path in extracts.discover(self.spark, raw_folder).items():
            self._bronze_source(published, source, extracts.read_lines(self.spark, path))
        published.commit()

    def _bronze_source(self, published: Publication, source: str, lines: DataFrame) -> None:
        """Stage the covered months of a source, and its malformed lines."""
        found, number = Observation(), F.count(F.lit(1)).alias("lines")
        malformed = F.count_if(F.col(extracts.MALFORMED).isNotNull()).alias("malformed")
        _, kept = self._stage_bronze(published, source, extracts.well_formed(lines.observe(found, number, malformed)))
        # where no row stays, the plan may drop the scan and with it the counts; Spark refuses to
        # read the malformed lines' text alone
        counted = found.get if kept else lines.agg(number, malformed, F.count(quoted(lines.columns[0]))).first().asDict()
        if TIME in lines.columns:
            self.rows[f"bronze.{source}.left_out"] = counted["lines"] - counted["malformed"] - kept
        self._quarantine_lines(published, source, lines, counted["malformed"])

    def _stage_bronze(
        self, published: Publication, source: str, rows: DataFrame, months: set[str] | None = None
    ) -> tuple[str, int]:
        """Stage the months of a source that the run covers, or those given; folder and row count."""
        target = self.path("bronze", extracts.bronze_folder(source))
        if TIME in rows.columns:
            dated = layers.bronze(rows, self.first, self.last)
            if months is not None:
                dated = dated.where(F.col(TIME).isin([dt.date.fromisoformat(month) for month in sorted(months)]))
            staged, kept = published.write(dated.hint("rebalance", TIME), [TIME])
            covers = self.covers if months is None else months.__contains__
            published.replace_folders(staged, target, [TIME], lambda partition: covers(partition[TIME]))
        else:
            staged, kept = published.write(rows)
            published.moves.append((staged, target))
        self.rows[f"bronze.{source}"] = kept
        return staged, kept

    def _quarantine_lines(self, published: Publication, source: str, lines: DataFrame, number: int) -> None:
        """Malformed lines as text: a pass of their own, where there are some."""
        self.rows[f"bronze.{source}.{MALFORMED_RULE}"] = number
        path, values = self.path("quarantine"), {"source": source, "rule": MALFORMED_RULE, PERIOD: UNDATED}
        if number:
            staged, _ = published.write(extracts.malformed(lines))
            published.moves.append((staged, folder(path, values)))
        elif files.exists(self.spark, folder(path, values)):
            published.moves.append((None, folder(path, values)))

    def bronze_rows(self, spec: TableSpec, covers: Months | None = None) -> DataFrame | None:
        """Bronze rows of the run's months with their month as ``period``; None if there are none."""
        covers = covers or self.covers
        path = self.path("bronze", spec.bronze_folder)
        partitions = tables.partition_values(self.spark, path, [TIME])
        months = [p[TIME] for p in partitions if covers(p[TIME])]
        if not partitions and files.exists(self.spark, path):
            # a source without dates is one table, whatever months the run has
            return self.spark.read.parquet(path)
        rows = tables.read_partitions(self.spark, path, TIME, months)
        return rows and rows.withColumn(PERIOD, F.col(TIME))

    # ---- silver ---------------------------------------------------------------

    def silver(self) -> None:
        """All tables with bronze rows in the run's months; loans must have some."""
        if self.bronze_rows(LOAN_DAILY) is None:
            raise FileNotFoundError(f"no bronze loans from {self.first} to {self.last}")
        self._silver({spec.name: self.covers for spec in TABLES.values()})

    def _silver(self, wanted: dict[str, Months]) -> None:
        published = self._publication()
        for name, covers in wanted.items():
            spec = TABLES[name]
            raw = self.bronze_rows(spec, covers)
            if raw is not None:
                self._silver_table(published, spec, raw, covers)
            else:
                self._remove_months(published, spec, covers)
        published.commit()

    def _silver_table(self, published: Publication, spec: TableSpec, raw: DataFrame, covers: Months) -> None:
        """Stage a table's months: one scan and one write for kept and quarantined rows."""
        dated = PERIOD in raw.columns
        period = F.col(PERIOD).cast("string") if dated else F.lit(UNDATED)
        fates, outcome = Observation(), F.substring_index(OUTCOME, ":", 1)
        counted = layers.flagged(spec, raw, self.as_of).observe(
            fates,
            F.count(F.lit(1)).alias("in"),
            *(F.count_if(outcome == fate).alias(fate) for fate in (DROPPED, QUARANTINED)),
        )
        sorted_out = layers.sorted_out(spec, counted).withColumn(PERIOD, period)
        # bronze files hold one month each, so tasks do too: no shuffle needed.
        # gold asks for single months on book
        cut = self._buckets() if dated and TIME in sorted_out.columns else None
        staged, _ = published.write(sorted_out, [FATE, RULE, PERIOD], ["mob"] if spec is LOAN_DAILY else [], cut)
        seen = fates.get
        self.rows[f"silver.{spec.name}"] = seen["in"] - seen[DROPPED] - seen[QUARANTINED]
        self.rows.update({f"silver.{spec.name}.{fate}": rows for fate, rows in seen.items()})

        schema = sorted_out.drop(FATE, RULE, PERIOD).schema
        mine = covers if dated else (lambda month: month == UNDATED)
        kept_folder = f"{staged}/{FATE}={KEPT}/{RULE}=-"
        if dated:
            published.replace_folders(kept_folder, self.path("silver", spec.name), [PERIOD], lambda p: mine(p[PERIOD]))
        elif self.rows[f"silver.{spec.name}"]:
            published.moves.append((folder(kept_folder, {PERIOD: UNDATED}), self.path("silver", spec.name)))
        else:
            published.replace_table(self.spark.createDataFrame([], schema), self.path("silver", spec.name))
        written = self._staged(staged, schema, [FATE, RULE, PERIOD])
        self._quarantine(published, spec, written.where(F.col(FATE) == QUARANTINED).drop(FATE), mine)
        incoming = metrics.of_rows(raw.select(period.alias(PERIOD)), spec.name, F.col(PERIOD), metrics.IN)
        self._store_metrics(
            published, incoming.unionByName(metrics.of_sorted_out(written, spec.name, F.col(PERIOD))), spec.name, mine
        )
        if spec is CLICKSTREAM and dated:
            # later months look back on these totals and read no clicks of this one again
            totals = pointintime.daily_totals(written.where(F.col(FATE) == KEPT).withColumn(TIME, F.col(PERIOD).cast("date")))
            totals = totals.withColumn(PERIOD, F.col(TIME).cast("string"))
            target = self.path("silver", TOTALS)
            published.replace_partitions(totals, target, [PERIOD], lambda p: mine(p[PERIOD]), gather=True, buckets=cut)
        if spec is FINANCIALS:
            named = vocabulary.named(written.where(F.col(FATE) == KEPT), F.col(PERIOD))
            vocabulary.merge(published, self.path("vocabulary"), named)

    def _buckets(self) -> int | None:
        return bucketed.agreed(self.spark, self.path("buckets"), self.buckets)

    def _months_of(self, path: str, schema, months: Months) -> DataFrame | None:
        """The wanted months of a silver table, in its buckets if it has some; None if there are none."""
        wanted = [p[PERIOD] for p in tables.partition_values(self.spark, path, [PERIOD]) if months(p[PERIOD])]
        buckets = self._buckets()
        if not wanted or not buckets:
            return tables.read_partitions(self.spark, path, PERIOD, wanted, schema)
        rows = bucketed.read(self.spark, path, schema, [PERIOD], buckets)
        return rows.where(F.col(PERIOD).isin([dt.date.fromisoformat(month) for month in wanted])).select(*map(quoted, schema.names))

    def _staged(self, staged: str, schema, partition_by: Sequence[str]) -> DataFrame:
        """Rows as they are staged, with the columns that their folders name."""
        for column in partition_by:
            schema = schema.add(column, "string")
        return self.spark.read.schema(schema).parquet(staged)

    def _quarantine(self, published: Publication, spec: TableSpec, taken_out: DataFrame, covers: Months) -> None:
        """Quarantined rows, of which the write has told the number, in few files."""

        def replaces(partition: dict[str, str]) -> bool:
            return partition["source"] == spec.name and partition["rule"] != MALFORMED_RULE and covers(partition[PERIOD])

        path, partition_by = self.path("quarantine"), ["source", "rule", PERIOD]
        there = any(map(replaces, tables.partition_values(self.spark, path, partition_by)))
        if self.rows[f"silver.{spec.name}.{QUARANTINED}"] or there:
            named = taken_out.withColumn("source", F.lit(spec.name))
            published.replace_partitions(named, path, partition_by, replaces, gather=True)

    def _remove_months(self, published: Publication, spec: TableSpec, covers: Months) -> None:
        """Months that bronze has no rows of any more leave silver, quarantine and metrics."""
        for path, partition_by, of_table in (
            (self.path("silver", spec.name), [PERIOD], {}),
            *([(self.path("silver", TOTALS), [PERIOD], {})] if spec is CLICKSTREAM else []),
            (self.path("quarantine"), ["source", "rule", PERIOD], {"source": spec.name}),
            (self.path("metrics"), ["table", PERIOD], {"table": spec.name}),
        ):
            for values in tables.partition_values(self.spark, path, partition_by):
                if of_table.items() <= values.items() and values[PERIOD] != UNDATED and covers(values[PERIOD]):
                    published.moves.append((None, folder(path, values)))

    def _store_metrics(self, published: Publication, counted: DataFrame, table: str, covers: Months) -> None:
        published.replace_partitions(
            counted,
            self.path("metrics"),
            ["table", PERIOD],
            lambda partition: partition["table"] == table and covers(partition[PERIOD]),
            gather=True,
        )

    def vocabulary(self) -> DataFrame:
        """(loan_type, first_period): the loan types named so far, what indicators are made of."""
        recover(self.spark, self.path())
        return vocabulary.read(self.spark, self.path("vocabulary"))

    def indicated_types(self) -> list[str]:
        """The loan types that get an indicator."""
        return vocabulary.types(self.vocabulary()) if self.loan_types is None else list(self.loan_types)

    def silver_table(self, spec: TableSpec, months: Months = lambda month: True) -> DataFrame:
        """The wanted months of a silver table, under the same schema for every month.

        A month that was never written is empty. A table whose source has no dates
        comes whole and without them. Financials have an indicator for each loan type
        of the run, made from what silver keeps, so all months have the same.
        """
        rows = self._stored(spec, months)
        return derivations.loan_type_indicators(rows, self.indicated_types()) if spec is FINANCIALS else rows

    def _stored(self, spec: TableSpec, months: Months = lambda month: True) -> DataFrame:
        recover(self.spark, self.path())
        empty = layers.silver(spec, spec.empty_raw(self.spark), self.as_of)
        dated = empty.withColumn(PERIOD, F.lit(None).cast("date"))
        path = self.path("silver", spec.name)
        written = [p[PERIOD] for p in tables.partition_values(self.spark, path, [PERIOD])]
        if not written and files.exists(self.spark, path):
            return self.spark.read.schema(empty.drop(TIME, f"valid_{TIME}").schema).parquet(path)
        rows = self._months_of(path, dated.schema, months)
        return dated if rows is None else rows

    def click_totals(self, months: Months = lambda month: True) -> DataFrame:
        """Daily totals of the wanted months' clicks."""
        empty = pointintime.daily_totals(layers.silver(CLICKSTREAM, CLICKSTREAM.empty_raw(self.spark), self.as_of))
        rows = self._months_of(self.path("silver", TOTALS), empty.schema.add(PERIOD, "date"), months)
        return empty if rows is None else rows.drop(PERIOD)

    # ---- gold -----------------------------------------------------------------

    def gold(self) -> None:
        if not files.exists(self.spark, self.path("silver", LOAN_DAILY.name)):
            raise FileNotFoundError("no silver loans: features and labels need them")
        published = self._publication()
        self._labels(published, self.covers)
        self._features(published, self.covers)
        published.commit()

    def _labels(self, published: Publication, covers: Months) -> None:
        labelled = labels.label_loans(self._stored(LOAN_DAILY, covers), self.dpd, self.mob)
        self.rows["gold.label_store"] = published.replace_partitions(
            labelled, self.path("gold", "label_store"), [TIME], lambda partition: covers(partition[TIME])
        )

    def _features(self, published: Publication, covers: Months) -> None:
        """Features of the covered months.

        Stored with the array of loan types; readers make the indicators, so that all months
        have those of the newest vocabulary.
        """
        loans = self._stored(LOAN_DAILY, covers)
        periods = [p[PERIOD] for p in tables.partition_values(self.spark, self.path("silver", LOAN_DAILY.name), [PERIOD])]
        chosen = sorted(filter(covers, periods))
        latest = chosen[-1] if chosen else ""
        oldest = (dt.date.fromisoformat(chosen[0]) - dt.timedelta(fixed.LOOK_BACK_DAYS)).isoformat() if chosen else ""

        # the state of a customer may date from any earlier month
        def past(month: str) -> bool:
            return month <= latest

        def recent(month: str) -> bool:
            return oldest <= month <= latest

        features = layers.feature_store(
            loans.drop(PERIOD),
            self._stored(TABLES["attributes"], past).drop(PERIOD),
            self._stored(FINANCIALS, past).drop(PERIOD),
            self.click_totals(recent),
            with_loan_types=True,
            clicks_are_totals=True,
        )
        self.rows["gold.feature_store"] = published.replace_partitions(
            features,
            self.path("gold", "feature_store"),
            ["feature_snapshot_date"],
            lambda partition: covers(partition["feature_snapshot_date"]),
            gather=True,
        )

    def label_store(self) -> DataFrame:
        """All labels of the run as one frame."""
        recover(self.spark, self.path())
        schema = "loan_id string, Customer_ID string, label int, label_def string, snapshot_date date"
        return self.spark.read.schema(schema).parquet(self.path("gold", "label_store"))

    def feature_store(self) -> DataFrame:
        """All features of the run as one frame, with an indicator for each loan type of the run."""
        recover(self.spark, self.path())
        features = self.spark.read.parquet(self.path("gold", "feature_store"))
        day = F.col("feature_snapshot_date").cast("string")
        features = features.withColumn("feature_snapshot_date", day)
        if derivations.LOAN_TYPES not in features.columns:
            return features
        indicated = derivations.loan_type_indicators(features, self.indicated_types())
        new = [c for c in indicated.columns if c not in features.columns]
        columns: list[str] = []
        for name in features.columns:
            columns += new if name == derivations.LOAN_TYPES else [name]
        return indicated.select(*map(quoted, columns))

    # ---- reports --------------------------------------------------------------

    def metrics(self) -> DataFrame:
        """(table, period, metric, flag, rows): counts of all months that were written."""
        recover(self.spark, self.path())
        return self.spark.read.schema(metrics.SCHEMA).parquet(self.path("metrics"))

    def quality_report(self) -> DataFrame:
        """Valid, invalid and unknown values per table, period and flag, off the metrics."""
        return metrics.quality_report(self.metrics())

    def partition_counts(self) -> DataFrame:
        """Bronze rows per table and period, off the metrics."""
        return self.metrics().where(F.col("metric") == metrics.IN).select("table", PERIOD, "rows")

    def retention_report(self) -> DataFrame:
        """Rows in, kept, dropped and quarantined per table, off the metrics."""
        return metrics.retention_report(self.metrics())

    # ---- increments -----------------------------------------------------------

    def refresh(self, raw_folder: str) -> None:
        """Take in what changed in the extracts since the last refresh, and nothing else.

        Files with the size and time of the manifest are not read. Months whose content
        changed are written again in bronze and silver, labels of changed loan months, and
        features of the months in which an application can see a change: of its own loans, of
        attributes or financials until the customer's next row, of clicks for the days that are
        looked back. What changed is kept until the features are there, so a refresh after
        a lost one finishes its work. The first refresh of a run writes everything.
        """
        if self.first or self.last:
            raise ValueError("a refresh takes all months")
        self.rewritten = {}
        published = self._publication()
        old = manifest.read(self.spark, self.path("manifest"))
        held, _ = published.write(manifest.scan(self.spark, raw_folder, old))
        new = self.spark.read.schema(manifest.SCHEMA).parquet(held)
        pending = self._pending_months()
        customers = self._pending_customers()
        for source, months in manifest.changed_months(old, new).items():
            pending.setdefault(source, set()).update(months)
            changed = self._refresh_bronze(published, raw_folder, source, months, new)
            customers = customers if changed is None else customers.unionByName(changed)
        rows = [(source, month) for source, months in pending.items() for month in sorted(months)]
        published.replace_table(self.spark.createDataFrame(rows, _PENDING_MONTHS), self.path("pending", "months"))
        published.replace_table(customers.distinct(), self.path("pending", "customers"))
        # the manifest goes with the last publication: until then the changes count as not taken in
        published.moves.append((held, self.path("pending", "manifest")))
        published.commit()
        if rows:
            self._refresh_silver(pending)
            self._refresh_gold(pending)
        published = self._publication()
        published.moves += [(self.path("pending", "manifest"), self.path("manifest")), (None, self.path("pending"))]
        published.commit()

    def _pending_months(self) -> dict[str, set[str]]:
        """What a lost refresh has taken in, by source, and not carried to the features."""
        path, found = self.path("pending", "months"), {}
        if files.exists(self.spark, path):
            for row in self.spark.read.schema(_PENDING_MONTHS).parquet(path).collect():
                found.setdefault(row.source, set()).add(row.month)
        return found

    def _pending_customers(self) -> DataFrame:
        path = self.path("pending", "customers")
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], _PENDING_CUSTOMERS)
        return self.spark.read.schema(_PENDING_CUSTOMERS).parquet(path)

    def _refresh_bronze(
        self, published: Publication, raw_folder: str, source: str, months: set[str], new: DataFrame
    ) -> DataFrame | None:
        """Stage a source's changed months; its customers whose rows changed, if it is one of the tables."""
        path = extracts.discover(self.spark, raw_folder).get(source)
        at = {part.uri: part.path for part in files.parts(self.spark, path)} if path else {}

        def lines(of: set[str]) -> DataFrame | None:
            holding = [at[uri] for uri in manifest.files_with(new, source, of)]
            return extracts.read_lines(self.spark, holding) if holding else None

        if manifest.MALFORMED in months:
            bad = lines({manifest.MALFORMED})
            number = bad.where(F.col(extracts.MALFORMED).isNotNull()).agg(F.count(bad.columns[0])) if bad else None
            self._quarantine_lines(published, source, bad, 0 if bad is None else max(1, number.first()[0]))
        wanted = months - {manifest.MALFORMED, manifest.LEFT_OUT}
        self.rewritten[f"bronze.{source}"] = sorted(wanted)
        if not wanted:
            return None
        target = self.path("bronze", extracts.bronze_folder(source))
        there = {values[TIME] for values in tables.partition_values(self.spark, target, [TIME])}
        if (UNDATED in wanted) and (there or len(wanted) > 1):
            raise ValueError(f"{source} has dates in one delivery and none in another: start a new run")
        if UNDATED in wanted:
            before = self.spark.read.parquet(target) if files.exists(self.spark, target) else None
        else:
            before = tables.read_partitions(self.spark, target, TIME, sorted(wanted & there))
        rows, after = lines(wanted), None
        if rows is not None:
            staged, kept = self._stage_bronze(published, source, extracts.well_formed(rows), wanted)
            after = self.spark.read.parquet(staged) if kept else None
        else:
            gone = [folder(target, {TIME: month}) for month in sorted(wanted & there)]
            published.moves += [(None, path) for path in ([target] if UNDATED in wanted else gone)]
        if source not in BY_SOURCE:
            return None
        by = [KEY] if UNDATED in wanted else [KEY, TIME]
        frame = before if before is not None else after
        if frame is None or KEY not in frame.columns:
            return None
        sides = [side if side is not None else frame.limit(0) for side in (before, after)]
        changed = changes.changed_customers(*sides, by)
        return changed.select(F.lit(source).alias("source"), KEY, (F.col(TIME) if TIME in by else F.lit(None)).cast("date").alias(TIME))

    def _refresh_silver(self, pending: dict[str, set[str]]) -> None:
        wanted = {}
        for source, months in pending.items():
            real = months - {manifest.MALFORMED, manifest.LEFT_OUT}
            if source in BY_SOURCE and real:
                name = BY_SOURCE[source].name
                wanted[name] = real.__contains__
                self.rewritten[f"silver.{name}"] = sorted(real)
        self._silver(wanted)

    def _refresh_gold(self, pending: dict[str, set[str]]) -> None:
        if not files.exists(self.spark, self.path("silver", LOAN_DAILY.name)):
            raise FileNotFoundError("no silver loans: features and labels need them")
        of_loans = pending.get(LOAN_DAILY.source, set()) - {manifest.MALFORMED, manifest.LEFT_OUT}
        touched = of_loans | self._touched_months()
        published = self._publication()
        if of_loans:
            self._labels(published, of_loans.__contains__)
        if touched:
            self._features(published, touched.__contains__)
        published.commit()
        self.rewritten["gold.label_store"], self.rewritten["gold.feature_store"] = sorted(of_loans), sorted(touched)

    def _touched_months(self) -> set[str]:
        """Months with applications that can see the pending changes; there are few months."""
        applications = layers.applications(self._stored(LOAN_DAILY))
        customers = self._pending_customers()
        found = []
        for spec in (TABLES["attributes"], FINANCIALS):
            changed = customers.where(F.col("source") == spec.source)
            found.append(changes.touched_as_of(applications, changed.where(f"{TIME} IS NOT NULL"), self._dates(spec)))
            found.append(changes.touched_undated(applications, changed.where(f"{TIME} IS NULL")))
        clicked = customers.where(F.col("source") == TABLES["clickstream"].source)
        found.append(changes.touched_look_back(applications, clicked.where(f"{TIME} IS NOT NULL")))
        months = reduce(DataFrame.unionByName, found).select(F.trunc(TIME, "month").cast("string").alias("month"))
        return {row.month for row in months.distinct().collect()}

    def _dates(self, spec: TableSpec) -> DataFrame:
        """(Customer_ID, snapshot_date) of a silver table; none where it has no dates."""
        rows = self._stored(spec)
        if TIME not in rows.columns:
            return rows.select(KEY, F.lit(None).cast("date").alias(TIME)).limit(0)
        return rows.select(KEY, TIME)


_PENDING_MONTHS = "source string, month string"
_PENDING_CUSTOMERS = f"source string, {KEY} string, {TIME} date"


def run(
    spark: SparkSession,
    raw_folder: str,
    base: str,
    *,
    run_id: str | None = None,
    only: Sequence[str] = LAYERS,
    **settings,
) -> Run:
    """Run the layers named in ``only``, in order.

    Without a ``run_id`` a new run is started, which has to begin with bronze.
    """
    unknown = set(only) - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    if run_id is None and "bronze" not in only:
        raise ValueError("silver and gold alone need the run_id of an existing run")
    run_id = run_id or dt.datetime.now().strftime("%Y%m%d_%H%M%S")
    job = Run(spark, base, run_id, **settings)
    if "bronze" in only:
        job.bronze(raw_folder)
    if "silver" in only:
        job.silver()
    if "gold" in only:
        job.gold()
    return job


def refresh(spark: SparkSession, raw_folder: str, base: str, run_id: str, **settings) -> Run:
    """Bring a run up to date with the extracts, see ``Run.refresh``."""
    job = Run(spark, base, run_id, **settings)
    job.refresh(raw_folder)
    return job
