"""Gates over posted journals. Every gate is a frame of rows, one per day and journal it judges."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.keys import MONEY, ci_key
from ledgerloom.operators.posting import debit_credit
from ledgerloom.operators.relational import union

# Limits in USD and the order in which the gates are asked.
BALANCE_LIMITS = {"card": 100, "a_cash": 100, "a_sales": 100, "wallet": 100, "overpayment": 50}
EXCEPTION_BALANCE_LIMITS = {**BALANCE_LIMITS, "overpayment": 100}
SUSPENSE_LIMIT = 2500
SUSPENSE_JOURNALS = ["card", "wallet", "a_sales", "a_cash"]
MINIMUM_SOURCE_ROWS = 1
GATE_ORDER = ["identity", "balance", "placeholder", "completeness", "suspense"]

GATE_COLUMNS = ["gate", "business_date", "company", "journal", "value", "status"]


def balance(lines: DataFrame, limits: Mapping[str, int] = BALANCE_LIMITS) -> DataFrame:
    """Debit less credit per journal and checkbook against the journal's limit."""
    limit = None
    for journal, usd in limits.items():
        test = F.col("journal") == journal
        limit = F.when(test, usd) if limit is None else limit.when(test, usd)
    totals = lines.groupBy("business_date", "company", "journal", "checkbookid").agg(
        (F.sum("debit") - F.sum("credit")).alias("value")
    )
    gap = F.abs("value")
    status = (
        F.when(gap > limit, "fail").when(gap > 0, "needs balancing").when(gap.isNull(), "no_data").otherwise("ok")
    )
    return totals.withColumn("status", status)


def balance_entries(lines: DataFrame, suspense_account: str, limits: Mapping[str, int] = BALANCE_LIMITS) -> DataFrame:
    """A suspense line for every journal that is out of balance within its limit."""
    open_ = balance(lines, limits).filter(F.col("status") == "needs balancing")
    debit, credit = debit_credit("value", "CN0")
    return open_.select(
        "business_date", "company", "journal", "checkbookid",
        F.lit(suspense_account).alias("account"), debit.alias("debit"), credit.alias("credit"),
    )


def placeholder_accounts(lines: DataFrame, mark: str = "XX", dedupe: bool = True) -> DataFrame:
    """Lines without a real account per day: marked, blank or missing."""
    rows = lines.select("business_date", "company", "credit", "debit", "account")
    rows = rows.distinct() if dedupe else rows
    account = ci_key("account")
    unmapped = account.isNull() | (account == "") | account.contains(mark)
    by_day = rows.groupBy("business_date", "company").agg(F.count(F.when(unmapped, 1)).alias("value"))
    return by_day.withColumn("status", F.when(F.col("value") > 0, "fail").otherwise("ok"))


def source_completeness(days: DataFrame, source: DataFrame, minimum: int = MINIMUM_SOURCE_ROWS) -> DataFrame:
    """Source rows per required day and company; a required day on which a company's own source has no rows fails."""
    key = ["business_date", "company"]
    counts = source.groupBy(*key).agg(F.count("*").alias("value"))
    out = days.select(*key).join(counts, key, "left").withColumn("value", F.coalesce("value", F.lit(0)))
    return out.withColumn("status", F.when(F.col("value") < minimum, "fail").otherwise("ok"))


def suspense_limit(
    lines: DataFrame, suspense_account: str, limit: int = SUSPENSE_LIMIT, dedupe: bool = True
) -> DataFrame:
    """Net suspense of the sales and cash journals per day against the limit.

    Equal lines of different journals count once, as in a distinct union;
    ``dedupe=False`` counts each.
    """
    rows = lines.filter(F.col("journal").isin(*SUSPENSE_JOURNALS) & (ci_key("account") == suspense_account))
    rows = rows.select("business_date", "company", "credit", "debit", "account")
    rows = rows.distinct() if dedupe else rows
    by_day = rows.groupBy("business_date", "company").agg((F.sum("debit") - F.sum("credit")).alias("value"))
    return by_day.withColumn("status", F.when(F.abs("value") > limit, "fail").otherwise("ok"))


def identity(lines: DataFrame) -> DataFrame:
    """Lines without a day or company: no batch can hold them, so each such group is a failing gate row."""
    lost = lines.filter(F.col("company").isNull() | F.col("business_date").isNull())
    return lost.groupBy("business_date", "company").agg(F.count("*").alias("value")).withColumn("status", F.lit("fail"))


def gate_results(
    lines: DataFrame, days: DataFrame, source: DataFrame, suspense_account: str,
    limits: Mapping[str, int] = BALANCE_LIMITS, skip: Collection[str] = (),
) -> DataFrame:
    """Every gate's rows in one shape; ``skip`` leaves gates out of an override run."""
    per_day = {
        "identity": lambda: identity(lines),
        "placeholder": lambda: placeholder_accounts(lines),
        "completeness": lambda: source_completeness(days.select("business_date", "company").distinct(), source),
        "suspense": lambda: suspense_limit(lines, suspense_account),
    }
    parts = []
    if "balance" not in skip:
        parts.append(balance(lines, limits).withColumn("gate", F.lit("balance")))
    for gate, build in per_day.items():
        if gate not in skip:
            parts.append(build().withColumns({"gate": F.lit(gate), "journal": F.lit("all")}))
    return union([p.select(*GATE_COLUMNS[:4], F.col("value").cast(MONEY).alias("value"), "status") for p in parts])


def gate_status(gates: DataFrame) -> DataFrame:
    """Per day and company the first failing gate, and whether the day may be published."""
    rank = F.array_position(F.array(*[F.lit(g) for g in GATE_ORDER]), F.col("gate"))
    failed = F.min(F.when(F.col("status") == "fail", F.struct(rank.alias("rank"), "gate", "journal")))
    out = gates.groupBy("business_date", "company").agg(failed.alias("first"))
    stop = F.col("first").isNotNull()
    subject = F.when(
        stop, F.concat(F.coalesce("company", F.lit("no company")), F.lit(" "), F.col("first.gate"), F.lit(" "), F.col("first.journal"),
                       F.lit(" "), F.coalesce(F.date_format("business_date", "yyyyMMdd"), F.lit("no day")))
    )
    return out.select(
        "business_date", "company",
        F.when(stop, "stop").otherwise("publish").alias("decision"),
        F.col("first.gate").alias("failed_gate"), F.col("first.journal").alias("failed_journal"),
        subject.alias("alert"),
    )


def no_status(spark: SparkSession) -> DataFrame:
    """The decisions of a close that had nothing to do."""
    return spark.createDataFrame([], "business_date date, company string, decision string, failed_gate string, failed_journal string, alert string")
