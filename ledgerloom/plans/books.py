"""Closing pending days into books: lines, the results behind them and the runs appear in one published state.

The day frames, what a close reads, are tables of the books stored by business day, or by month where days are small. A close reads
the folders of its pending days only: the days are a small written table, and Spark prunes the scans with it while it runs. What it posts becomes visible together
with the run that posted it, so a close that breaks off anywhere leaves its days pending and the books as they were, and the next
close does them again.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import batch_id
from ledgerloom.operators import controls as C
from ledgerloom.operators import match as M
from ledgerloom.operators import publish as P
from ledgerloom.operators.relational import union
from ledgerloom.plans import daily_close as D
from ledgerloom.plans import journals as J
from ledgerloom.session import scratch_path, stage
from ledgerloom.sources.snapshots import Snapshot, Snapshots, Written, merge_partitions, replace_batches

HISTORY = "run_id INT, start_date TIMESTAMP, stop_date TIMESTAMP, date_run DATE, brand_table STRING"
EXCEPTION_HISTORY = HISTORY + ", run_type STRING"
RESULT = (
    "report STRING, business_date DATE, company STRING, ledger_key STRING, proc_key STRING, ledger_currency STRING, proc_currency STRING, "
    "trans_usd DECIMAL(25,3), proc_gross_usd DECIMAL(25,2), fx_diff DECIMAL(15,2), other_diff DECIMAL(15,2)"
)
MATCHES = RESULT + ", status STRING, business_month STRING"
EXCEPTIONS = RESULT + ", exception_num BIGINT, exception_id STRING, business_month STRING"
JOURNAL = D.STAGED + ", business_month STRING"

#: Folders of the day frames: one for each day, or by ``MONTHS`` for each month.
DAYS, MONTHS = "yyyy-MM-dd", "yyyy-MM"

#: Gates an exception run leaves out.
EXCEPTION_SKIPS = frozenset({"suspense", "placeholder", "completeness"})


@dataclass(frozen=True)
class DayFrames:
    """What a close reads, each with business_date and company."""

    ledger: DataFrame
    sales: DataFrame
    settlement: DataFrame
    wallet: DataFrame
    card: DataFrame

    def of_days(self, days: DataFrame, period: str = DAYS) -> DayFrames:
        """The rows of these days and companies. Rows of these days without a company stay, for a gate to report."""
        named = days.select(
            F.date_format("business_date", period).alias("__period"), F.col("business_date").alias("__day"), F.col("company").alias("__company")
        )
        wanted = named.unionByName(named.withColumn("__company", F.lit(None).cast("string")))
        same = (F.col("business_period") == F.col("__period")) & (F.col("business_date") == F.col("__day"))
        same &= F.col("company").eqNullSafe(F.col("__company"))
        return DayFrames(*[getattr(self, f.name).join(wanted, same, "left_semi").drop("business_period") for f in fields(self)])


@dataclass(frozen=True)
class Stamps:
    """What a run writes into its lines and its history."""

    started: Column
    stopped: Column
    receipt: str
    long_receipt: str


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def store_frames(books: Snapshots, frames: DayFrames, period: str = DAYS) -> Snapshot:
    """Store day frames by period. Periods delivered again replace what was there; others keep their files."""
    written = []
    for f in fields(frames):
        df = getattr(frames, f.name).withColumn("business_period", F.date_format("business_date", period))
        written.append(books.write(df, f.name, _ddl(df), ["business_period"]))
    return books.publish(books.latest(), written)


def merge_ledger(books: Snapshots, changed: DataFrame, key: Collection[str] = ("order_key",), period: str = DAYS) -> Snapshot:
    """Merge changed ledger rows into the periods they fall in; the files of all others stay."""
    base = books.latest()
    table = base.tables["ledger"]
    changed = changed.withColumn("business_period", F.date_format("business_date", period))
    written, _ = merge_partitions(books, base, "ledger", table.schema, table.partition_by, changed, list(key))
    return books.publish(base, [written])


def load_frames(books: Snapshots, snapshot: Snapshot) -> DayFrames:
    return DayFrames(*[books.read(f.name, snapshot.tables[f.name].schema, snapshot) for f in fields(DayFrames)])


def journal_lines(frames: DayFrames, matrix: DataFrame, stamps: Stamps) -> DataFrame:
    """The lines of all journals, tagged."""
    journals = {
        "a_cash": J.journal_cash(frames.settlement, stamps.long_receipt),
        "wallet": J.journal_b(frames.ledger, frames.wallet, matrix, stamps.receipt),
        "a_sales": J.journal_a(frames.ledger, frames.sales, matrix),
        "card": J.journal_c(frames.ledger, frames.card, matrix, stamps.receipt),
        "overpayment": J.journal_overpayment(frames.ledger, matrix),
    }
    return union([df.withColumns({"journal": F.lit(n), "merchant": F.lit(J.MERCHANT_TAGS[n])}) for n, df in journals.items()])


def results(frames: DayFrames) -> tuple[DataFrame, DataFrame]:
    """Matches and exceptions of the three reports."""
    recon = {
        "a": J.reconciled_a(frames.ledger, frames.sales), "b": J.reconciled_b(frames.ledger, frames.wallet),
        "c": J.reconciled_c(frames.ledger, frames.card),
    }
    shown = [c.split()[0] for c in RESULT.split(", ")]
    month = {"business_month": F.date_format("business_date", "yyyy-MM")}
    recon = {n: df.withColumns({"report": F.lit(n), **month}) for n, df in recon.items()}
    matches = union([df.withColumn("status", M.match_status()).select(*shown, "status", "business_month") for df in recon.values()])
    numbered = M.number_exceptions(recon["a"].select(*shown, "ledger_date", "business_month"), "LEDGER VERSUS PROCESSOR A EXCEPTION# - ", require_no_fx=True)
    none = {"exception_num": F.lit(None).cast("bigint"), "exception_id": F.lit(None).cast("string")}
    plain = [M.exceptions(recon[n]).withColumns(none) for n in ("b", "c")]
    named = [*shown, "exception_num", "exception_id", "business_month"]
    return matches, union([df.select(*named) for df in (numbered, *plain)])


def agenda(history: DataFrame, days: DataFrame) -> DataFrame:
    """Each day and company to close, with its state: done if a run of it has finished, else pending."""
    done = P.finished_days(history).withColumn("state", F.lit("done"))
    named = days.select("business_date", "company").distinct()
    return named.join(done, ["business_date", "company"], "left").fillna("pending", ["state"])


@dataclass(frozen=True)
class Closed:
    """The decision for each day and company, and the state that holds what was posted."""

    status: DataFrame
    snapshot: Snapshot


def close(
    books: Snapshots, days: DataFrame, source: DataFrame, matrix: DataFrame, stamps: Stamps, exception_run: bool = False,
    limits: Mapping[str, int] | None = None, skip_gates: Collection[str] | None = None, period: str = DAYS,
) -> Closed:
    """Close the days and companies without a finished run, from the day frames stored in the books.

    Days a gate stops get no run and stay pending; nothing of them is posted, and what an earlier run posted of them goes. An
    exception run has its own limits and gates, and writes its own history beside the common one. Lines without a company fail a gate of
    their own. Closing again without new days changes nothing.
    """
    limits = limits or (C.EXCEPTION_BALANCE_LIMITS if exception_run else C.BALANCE_LIMITS)
    skip = EXCEPTION_SKIPS if skip_gates is None and exception_run else (skip_gates or ())
    spark, base = books.spark, books.latest()
    history = books.read("history", HISTORY, base)
    todo = stage(agenda(history, days), "agenda").filter(F.col("state") == "pending").drop("state")
    if todo.isEmpty():
        return Closed(C.no_status(spark), base)
    frames = load_frames(books, base).of_days(todo, period)
    staged = D.with_balance_entries(D.stage_lines(journal_lines(frames, matrix, stamps), scratch_path(spark, "lines")), limits)
    gates = C.gate_results(staged, todo, source, J.SUSPENSE_ACCOUNT, limits, skip)
    # a day without any line has nothing to be judged by; it is done as well
    asked = todo.select(F.lit("agenda").alias("gate"), "business_date", "company", F.lit("all").alias("journal"), F.lit(0).cast("decimal(15,2)").alias("value"), F.lit("ok").alias("status"))
    status = stage(C.gate_status(gates.unionByName(asked)), "status")
    posted = D.publishable(staged, status)

    month = F.date_format("business_date", "yyyy-MM")
    batches = todo.select(F.col("company").alias("brand"), batch_id("business_date").alias("batchid"), month.alias("batch_month"))
    results_of = todo.select("business_date", "company", month.alias("business_month"))
    by_day = {"batch_keys": ("business_date", "company"), "partition_by": ("business_month",)}
    matches, exceptions = (D.publishable(df, status) for df in results(frames))
    runs = P.finished_runs(history, status, stamps.started, stamps.stopped)
    written: list[Written] = []
    gone = {}
    for table, rows, schema, closed, how in (
        ("common", D.common_rows(posted), D.COMMON, batches, {}),
        ("matches", matches, MATCHES, results_of, by_day),
        ("exceptions", exceptions, EXCEPTIONS, results_of, by_day),
    ):
        part, gone[table] = replace_batches(books, base, rows, table, schema, closed, **how)
        written.append(part)
    written.append(books.write(history.unionByName(runs), "history", HISTORY))
    if exception_run:
        before = books.read("exception_history", EXCEPTION_HISTORY, base)
        own = P.finished_runs(before, status, stamps.started, stamps.stopped, "EXCEPTION")
        written.append(books.write(before.unionByName(own), "exception_history", EXCEPTION_HISTORY))
    snapshot = books.publish(base, written, gone)
    books.clean()
    return Closed(status, snapshot)


def backfill(books: Snapshots, days: DataFrame, matrix: DataFrame, stamps: Stamps, period: str = DAYS) -> Snapshot:
    """Accumulate journals, matches and exceptions of these days, without gates or history.

    One pass over the day frames; days done before are replaced, so a backfill that broke off is repeated or continued by day.
    """
    base = books.latest()
    wanted = stage(days.select("business_date", "company").distinct().withColumn("state", F.lit("pending")), "agenda")
    wanted = wanted.filter(F.col("state") == "pending").drop("state")
    frames = load_frames(books, base).of_days(wanted, period)
    matches, exceptions = results(frames)
    month = F.date_format("business_date", "yyyy-MM")
    lines = journal_lines(frames, matrix, stamps).withColumn("business_month", month)
    closed = wanted.withColumn("business_month", month)
    written, gone = [], {}
    for table, rows, schema in (("journals", lines, JOURNAL), ("matches", matches, MATCHES), ("exceptions", exceptions, EXCEPTIONS)):
        part, gone[table] = replace_batches(books, base, rows, table, schema, closed, ("business_date", "company"), ("business_month",))
        written.append(part)
    return books.publish(base, written, gone)
