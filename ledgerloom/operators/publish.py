"""Publishing to the common journal, run history and the choice of what to run next."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.relational import union

COMMON_COLUMNS = [
    "checkbookid", "batchid", "trantype", "trandate", "srcdoc", "currid", "reference", "account", "debit", "credit",
    "distref", "key1", "reversedate", "uniqueid", "docamt", "cashrcpt", "distype", "brand", "merchant",
]


def journal_shape(lines: DataFrame, merchant: str, keep_receipt: bool) -> DataFrame:
    """Journal lines in the common shape. Only the cash journal carries its receipt over."""
    receipt = F.col("cashrcpt") if keep_receipt else F.lit(None).cast("string")
    shaped = lines.withColumns({"cashrcpt": receipt, "brand": F.col("company"), "merchant": F.lit(merchant)})
    return shaped.select(*COMMON_COLUMNS)


def common_journal(journals: Mapping[str, DataFrame], tags: Mapping[str, str], receipts: tuple = ("a_cash",)) -> DataFrame:
    return union([journal_shape(df, tags[name], name in receipts) for name, df in journals.items()])


def next_run_id(history: DataFrame) -> DataFrame:
    return history.agg((F.max("run_id") + 1).alias("run_id"))


def run_history_rows(
    history: DataFrame, days: DataFrame, brand_table: str, started: Column, stopped: Column, run_type: str | None = None
) -> DataFrame:
    """New history rows for finished days, numbered on from the highest run id.

    ``days`` has one row per finished business date, so it is small and the
    numbering runs over calendar days, never over transactions.
    """
    order = F.row_number().over(Window.partitionBy(F.lit(brand_table)).orderBy("business_date"))
    top = history.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("m"))
    rows = days.select("business_date").distinct().select(
        (order + top.scalar()).cast("int").alias("run_id"),
        started.alias("start_date"),
        stopped.alias("stop_date"),
        F.col("business_date").alias("date_run"),
        F.lit(brand_table).alias("brand_table"),
    )
    return rows if run_type is None else rows.withColumn("run_type", F.lit(run_type))


def finished_runs(
    history: DataFrame, status: DataFrame, started: Column, stopped: Column, run_type: str | None = None
) -> DataFrame:
    """History rows of the days and companies a close has published, numbered on from the highest run id.

    A day that was stopped gets no row, so it stays pending. Daily and
    exception runs have histories of their own, each numbered from its own
    highest id. There is one row per day and company, never per transaction.
    """
    done = status.filter(F.col("decision") == "publish").select("business_date", F.col("company").alias("brand_table"))
    order = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("business_date", "brand_table"))
    top = history.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("m"))
    rows = done.select(
        (order + top.scalar()).cast("int").alias("run_id"), started.alias("start_date"), stopped.alias("stop_date"),
        F.col("business_date").alias("date_run"), "brand_table",
    )
    return rows if run_type is None else rows.withColumn("run_type", F.lit(run_type))


def finished_days(history: DataFrame) -> DataFrame:
    """Days and companies with a finished run."""
    done = history.filter(F.col("stop_date").isNotNull())
    return done.select(F.to_date("date_run").alias("business_date"), F.col("brand_table").alias("company")).distinct()


def pending_days(history: DataFrame, days: DataFrame) -> DataFrame:
    """Days and companies without a finished run, however early: a day that once failed comes back until it passes."""
    return days.select("business_date", "company").distinct().join(finished_days(history), ["business_date", "company"], "left_anti")


def next_dates(history: DataFrame, brand_table: str, source: DataFrame, source_ts: str) -> DataFrame:
    """Days still to run: after the last finished one, up to the day before the latest source day."""
    done = history.filter(F.col("stop_date").isNotNull() & (F.col("brand_table") == brand_table))
    first = done.agg(F.date_add(F.max(F.to_date("date_run")), 1).alias("first"))
    last = source.agg(F.date_sub(F.max(F.to_date(source_ts)), 1).alias("last"))
    span = last.select(F.col("last"), first.scalar().alias("first"))
    days = span.filter(F.col("first") <= F.col("last"))
    return days.select(F.explode(F.sequence("first", "last")).alias("business_date"))
