"""The daily close: journals, balance entries, gates, publication, run history.

Every step covers all business days it is given. The journals are staged as
one table in the shared folder, a few lines per day, so the gates and the
publication read that table instead of computing the journals again, and a
lost executor costs one stage of one journal at most.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import ci_equals
from ledgerloom.functions.scalars import batch_id
from ledgerloom.operators import controls as C
from ledgerloom.operators import publish as P
from ledgerloom.operators.relational import union
from ledgerloom.plans import journals as J
from ledgerloom.sources.sinks import conform, replace_batches

STAGED = (
    "business_date DATE, company STRING, checkbookid STRING, batchid STRING, trantype STRING, trandate STRING, "
    "srcdoc STRING, currid STRING, reference STRING, account STRING, debit DECIMAL(15,2), credit DECIMAL(15,2), "
    "distref STRING, key1 STRING, reversedate STRING, uniqueid STRING, table_name STRING, docamt DECIMAL(15,2), "
    "distype STRING, cashrcpt STRING, journal STRING, merchant STRING"
)
COMMON = (
    "checkbookid STRING, batchid STRING, trantype STRING, trandate STRING, srcdoc STRING, currid STRING, "
    "reference STRING, account STRING, debit DECIMAL(15,2), credit DECIMAL(15,2), distref STRING, key1 STRING, "
    "reversedate STRING, uniqueid STRING, docamt DECIMAL(15,2), cashrcpt STRING, distype STRING, brand STRING, "
    "merchant STRING, batch_month STRING"
)


def stage_lines(lines: DataFrame, path: str) -> DataFrame:
    """Write posted lines once and read them from there on."""
    conform(lines, STAGED).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return lines.sparkSession.read.schema(STAGED).parquet(path)


def with_balance_entries(lines: DataFrame, limits: Mapping[str, int] = C.BALANCE_LIMITS) -> DataFrame:
    """Lines plus one suspense line for each journal that is out of balance within its limit.

    The entry takes its header from any one line of its journal and day.
    """
    entries = C.balance_entries(lines, J.SUSPENSE_ACCOUNT, limits)
    key = ["business_date", "company", "journal", "checkbookid"]
    shared = ["batchid", "trantype", "trandate", "srcdoc", "currid", "reference", "key1", "reversedate", "merchant"]
    headers = lines.groupBy(*key).agg(*[F.max(c).alias(c) for c in shared])
    added = entries.join(headers, key).withColumns(
        {"distref": F.concat("company", F.lit(" BALANCE ENTRY")), "table_name": F.lit("balance_entry")}
    )
    return union([lines, added]).select(*lines.columns)


def publishable(lines: DataFrame, status: DataFrame) -> DataFrame:
    """Lines of the days and companies every gate lets through."""
    return lines.join(status.filter(F.col("decision") == "publish"), ["business_date", "company"], "left_semi")


def common_rows(lines: DataFrame) -> DataFrame:
    """Staged lines in the common journal's shape, with its partition column."""
    receipt = F.when(ci_equals("journal", "a_cash"), F.col("cashrcpt"))
    shaped = lines.withColumns(
        {"cashrcpt": receipt, "brand": F.col("company"), "batch_month": F.date_format("business_date", "yyyy-MM")}
    )
    return shaped.select(*P.COMMON_COLUMNS, "batch_month")


def close_days(
    lines: DataFrame, days: DataFrame, source: DataFrame, staging: str, common: str,
    limits: Mapping[str, int] = C.BALANCE_LIMITS, skip_gates: Collection[str] = (),
) -> DataFrame:
    """Run the close and return the gate decision per day and company.

    ``skip_gates`` names the gates an override run leaves out. The batches of
    all days closed are replaced: a day that passes gets its new lines, and
    one that is stopped keeps none from an earlier run.
    """
    staged = with_balance_entries(stage_lines(lines, staging), limits)
    gates = C.gate_results(staged, days, source, J.SUSPENSE_ACCOUNT, limits, skip_gates)
    status = C.gate_status(gates)
    closed = days.select(
        F.col("company").alias("brand"), batch_id("business_date").alias("batchid"),
        F.date_format("business_date", "yyyy-MM").alias("batch_month"),
    )
    rows = common_rows(publishable(staged, status))
    replace_batches(rows, common, COMMON, partition_by=["brand", "batch_month"], cleared=closed)
    return status


def close_pending(
    lines: DataFrame, days: DataFrame, source: DataFrame, history: DataFrame, staging: str, common: str,
    started: Column, stopped: Column, limits: Mapping[str, int] = C.BALANCE_LIMITS, skip_gates: Collection[str] = (),
    run_type: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Close the days and companies that have no finished run yet; the decisions, and the history rows to append.

    A day that a gate stops is not in the new rows and so is pending again;
    later days are not held up by it. Lines without a company belong to no
    day that can be closed: ``orphan_lines`` counts them.
    """
    todo = P.pending_days(history, days)
    own = lines.join(todo, ["business_date", "company"], "left_semi")
    status = close_days(own, todo, source, staging, common, limits, skip_gates)
    return status, P.finished_runs(history, status, started, stopped, run_type)


def orphan_lines(lines: DataFrame) -> DataFrame:
    """Lines without a day or company, by journal: no gate and no batch can hold them, so they are reported."""
    lost = lines.filter(F.col("company").isNull() | F.col("business_date").isNull())
    return lost.groupBy("journal").agg(F.count("*").alias("lines"), F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))


