"""Cross-day reports over posted lines, reconciled rows and sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.aggregates import pivot_max
from ledgerloom.operators.joins import chain_by_key
from ledgerloom.operators.match import match_status
from ledgerloom.operators.relational import union

# Merchant ids looked for in file names, in this order.
MERCHANT_IDS = ["153400", "173300", "176100", "48500", "60100", "60600", "60700", "69100", "71900", "83700"]


def suspense_lines(lines: DataFrame, mark: str = "11045") -> DataFrame:
    return lines.filter(F.col("account").contains(mark))


def suspense_by_merchant(lines: DataFrame) -> DataFrame:
    net = F.sum(F.col("debit") - F.col("credit")).alias("suspense")
    return suspense_lines(lines).groupBy("merchant").agg(net)


def suspense_by_day(lines: DataFrame, merchants: Mapping[str, str], anchor: str) -> DataFrame:
    """Suspense per day, one column per merchant, for the anchor merchant's days.

    One grouped pass with a conditional sum per merchant; the days are those on
    which the anchor merchant has suspense lines.
    """
    net = F.col("debit") - F.col("credit")
    sums = [
        F.coalesce(F.sum(F.when(F.col("merchant") == m, net)), F.lit(0)).alias(name) for m, name in merchants.items()
    ]
    anchored = F.count(F.when(F.col("merchant") == anchor, 1)).alias("__anchor")
    out = suspense_lines(lines).groupBy("business_date").agg(*sums, anchored)
    return out.filter(F.col("__anchor") > 0).drop("__anchor").orderBy("business_date")


def revenue_by_merchant(lines: DataFrame) -> DataFrame:
    """Credit less debit on revenue accounts, whose fifth character is 4."""
    rows = lines.filter(F.substring("account", 5, 1) == "4")
    return rows.groupBy("merchant").agg(F.sum(F.col("credit") - F.col("debit")).alias("revenue"))


def unbalanced_days(lines: DataFrame) -> DataFrame:
    out = lines.groupBy("business_date").agg(F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
    out = out.withColumn("difference", F.col("debit") - F.col("credit"))
    return out.orderBy(F.col("difference").desc_nulls_last(), "business_date")


def match_rate(joined: DataFrame) -> DataFrame:
    """Counts per day by match status and the share of unmatched rows, in one pass."""
    status = joined.select("business_date", match_status().alias("status"))
    is_ = lambda s: F.count(F.when(F.col("status") == s, 1))
    out = status.groupBy("business_date").agg(
        is_("processor only").alias("not_in_ledger"),
        is_("ledger only").alias("not_in_processor"),
        is_("matched").alias("matched"),
        F.count("*").alias("total"),
    )
    unmatched = F.col("not_in_ledger") + F.col("not_in_processor")
    return out.withColumns({"unmatched": unmatched, "unmatched_share": unmatched / F.col("total").cast("double")})


def match_rate_chain(joined: DataFrame) -> DataFrame:
    """The same counts as a chain of full joins of per-day counts onto the total.

    The rows are counted once per day and status; the chain only reads those
    few counts.
    """
    status = match_status().alias("status")
    counts = joined.groupBy("business_date", status).agg(F.count("*").alias("n"))

    def counted(wanted: str, name: str) -> DataFrame:
        return counts.filter(F.col("status") == wanted).select("business_date", F.col("n").alias(name))

    total = counts.groupBy("business_date").agg(F.sum("n").alias("total"))
    parts = [
        counted("processor only", "not_in_ledger"), counted("ledger only", "not_in_processor"),
        counted("matched", "matched"),
    ]
    return chain_by_key(total, parts, "business_date", "full")


def latest_file_counts(
    sources: DataFrame, history: DataFrame, since: Column, key: str = "brand_table", date: str = "report_date",
    file_name: str = "file_name",
) -> DataFrame:
    """Per source: latest report date and rows of the file named for it, with the last run date.

    Rows are first counted per source, date and file, in one pass over all
    sources; the latest date is then looked up among those counts.
    """
    files = sources.groupBy(key, date, file_name).agg(F.count("*").alias("rows"))
    latest = F.max(date).over(Window.partitionBy(key))
    files = files.withColumn("latest", latest).filter(F.col(date) > since)
    stamps = [F.date_format("latest", p) for p in ("yyyy-MM-dd", "yyyyMMdd")]
    named = F.col(file_name).contains(stamps[0]) | F.col(file_name).contains(stamps[1])
    counts = files.filter(named).groupBy(key).agg(
        F.sum("rows").alias("n"), F.max(date).cast("date").alias("report_date")
    )
    runs = history.groupBy(key).agg(F.max("date_run").alias("latest_run"))
    return counts.join(runs, key)


def merchant_id(file_name: Column | str, ids: Sequence[str] = MERCHANT_IDS) -> Column:
    """First listed merchant id found in the file name, NULL when there is none."""
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    out = F.when(c.contains(ids[0]), ids[0])
    for m in ids[1:]:
        out = out.when(c.contains(m), m)
    return out


def merchant_freshness(reports: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Latest activity per merchant id, one column per report type."""
    rows = reports.withColumn("mid", merchant_id("file_name")).filter(F.col("mid").isNotNull())
    grouped = rows.groupBy("mid", "report_type").agg(F.max("activity_date").cast("date").alias("activity_date"))
    return pivot_max(grouped, ["mid"], "report_type", types, "activity_date")


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    return union([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "n") for name, df in stages.items()])


def matched_summary(joined: DataFrame) -> DataFrame:
    """Count and sums of rows with and without a ledger id, stacked; one pass over the rows."""
    has = F.col("ledger_key").isNotNull()
    measures = ["trans_usd", "proc_gross_usd"]
    arms = []
    sums = [F.count("ledger_key").alias("n")]
    for side, test in (("with ledger id", has), ("without ledger id", ~has)):
        tag = side.split()[0]
        sums += [F.sum(F.when(test, F.col(m))).alias(f"{tag}_{m}") for m in measures]
        n = F.col("n") if side == "with ledger id" else F.lit(0).cast("bigint")
        arms.append(F.struct(F.lit(side).alias("side"), n.alias("n"), *[F.col(f"{tag}_{m}").alias(m) for m in measures]))
    return joined.agg(*sums).select(F.inline(F.array(*arms)))
