"""Scans and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions.keys import ci_equals, ci_in
from ledgerloom.operators.aggregates import sum_by
from ledgerloom.queries.registry import query
from ledgerloom.session import scratch_path
from ledgerloom.sources import deliveries, files, scans, sinks
from ledgerloom.sources.roles import BANK_MID

c = F.col


@query("scan_filter", """
SELECT order_key, l_linenumber, company, type, processing_currency, processing_amount FROM x_lines
WHERE row_type = 'TX' AND (lower(status) = 'cleared' OR status IS NULL) AND bank_mid = 'MID-A'""",
       money="processing_amount")
def scan_filter(r):
    rows = scans.scan_filter(
        r.report_lines, ci_in("row_type", ["TX"]), scans.cleared("status"), ci_equals("bank_mid", BANK_MID)
    )
    return rows.select("order_key", "l_linenumber", "company", "type", "processing_currency", "processing_amount")


@query("scan_file_prefix", """
SELECT CAST(strptime(substr(file_name, 1, 8), '%Y%m%d') AS DATE) - 1 AS business_date, count(*) AS n,
  sum(processing_amount) AS amount
FROM x_lines
WHERE CAST(processing_date AS DATE) = CAST(strptime(substr(file_name, 1, 8), '%Y%m%d') AS DATE) - 1 GROUP BY 1""",
       money="amount", dates="business_date")
def scan_file_prefix(r):
    rows = scans.scan_file_prefix(r.report_lines, activity="processing_date")
    return rows.groupBy("business_date").agg(F.count("*").alias("n"), F.sum("processing_amount").alias("amount"))


@query("scan_file_exact", """
SELECT CAST(initiation_date AS DATE) AS business_date, company, count(*) AS n, sum(gross_minor) AS gross_minor
FROM (SELECT *, 'STL-' || strftime(initiation_date, '%Y%m%d') || '.01.009.CSV' AS wanted FROM x_stmt_b) AS b
WHERE ch = 'SB' AND file_name = wanted GROUP BY 1, 2""",
       money="gross_minor", dates="business_date")
def scan_file_exact(r):
    rows = scans.scan_file_exact(r.statement_b)
    return rows.groupBy("business_date", "company").agg(
        F.count("*").alias("n"), F.sum("gross_minor").alias("gross_minor")
    )


DELIVERED = "company STRING, row_type STRING, processing_currency STRING, processing_amount DECIMAL(15,2)"


@query("scan_delivery_files", """
SELECT make_date(year(processing_date), 12, 31) AS business_date, company, row_type, processing_currency, count(*) AS n,
  sum(processing_amount) AS amount
FROM x_lines WHERE processing_date IS NOT NULL GROUP BY 1, 2, 3, 4""",
       money="amount", dates="business_date")
def scan_delivery_files(r):
    """The report arrives once a year, in files named by the day after; all are read."""
    folder = scratch_path(r.spark, "deliveries")
    first, last = r.report_lines.agg(F.year(F.min("processing_date")), F.year(F.max("processing_date"))).first()
    for year in range(first, last + 1) if first else ():
        rows = scans.scan_date_range(r.report_lines, "processing_date", between=(dt.date(year, 1, 1), dt.date(year, 12, 31)))
        named = f"{year + 1}0101_settlement"
        deliveries.write_delivery(rows.select("company", "row_type", "processing_currency", "processing_amount"), folder, named)
    files.make_folder(r.spark, folder)
    files.remove_at_exit(r.spark, folder)
    rows = scans.scan_file_prefix(deliveries.read_deliveries(r.spark, folder, DELIVERED))
    return rows.groupBy("business_date", "company", "row_type", "processing_currency").agg(
        F.count("*").alias("n"), F.sum("processing_amount").alias("amount")
    )


@query("scan_business_day", """
SELECT CASE WHEN event_type = 'purchase' THEN CAST(ts + INTERVAL 3 HOUR AS DATE) ELSE CAST(ts AS DATE) END AS business_date,
  event_type, count(*) AS n, sum(CAST(value AS DECIMAL(15,2))) AS amount
FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2""",
       money="amount", dates="business_date")
def scan_business_day(r):
    rows = scans.scan_business_day(r.events, "ts", "event_type", cutoff_channel="Purchase")
    return rows.groupBy("business_date", "event_type").agg(
        F.count("*").alias("n"), F.sum(c("value").cast("decimal(15,2)")).alias("amount")
    )


DAYS = (dt.date(1997, 3, 1), dt.date(1997, 3, 31))
IN_DAYS = "BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'"


@query("scan_business_day_range", f"SELECT order_key, business_date, settled_by FROM x_days WHERE business_date {IN_DAYS}", dates="business_date")
def scan_business_day_range(r):
    return scans.scan_business_day(r.ledger, days=DAYS).select("order_key", "business_date", "settled_by")


@query("scan_file_prefix_range", f"""
SELECT order_key, l_linenumber, CAST(strptime(substr(file_name, 1, 8), '%Y%m%d') AS DATE) - 1 AS business_date FROM x_lines
WHERE CAST(strptime(substr(file_name, 1, 8), '%Y%m%d') AS DATE) - 1 {IN_DAYS}""", dates="business_date")
def scan_file_prefix_range(r):
    return scans.scan_file_prefix(r.report_lines, days=DAYS).select("order_key", "l_linenumber", "business_date")


@query("scan_file_exact_range", f"""
SELECT order_key, CAST(initiation_date AS DATE) AS business_date, gross_minor
FROM (SELECT *, 'STL-' || strftime(initiation_date, '%Y%m%d') || '.01.009.CSV' AS wanted FROM x_stmt_b) AS b
WHERE ch = 'SB' AND file_name = wanted AND CAST(initiation_date AS DATE) {IN_DAYS}""", money="gross_minor", dates="business_date")
def scan_file_exact_range(r):
    return scans.scan_file_exact(r.statement_b, days=DAYS).select("order_key", "business_date", "gross_minor")


@query("rejected_rows", """
SELECT 'file name' AS reason, count(*) FILTER (order_key % 29 = 0) AS n FROM x_stmt_c
UNION ALL SELECT 'amount', count(*) FILTER (order_key % 23 = 0) FROM x_stmt_c
UNION ALL SELECT 'no company', count(*) FILTER (order_key % 37 = 0) FROM x_stmt_c""")
def rejected_rows(r):
    """Odd names, amounts and keys put into the card report are counted by reason, each."""
    odd = r.statement_c.withColumns({
        "file_name": F.when(c("order_key") % 29 == 0, "readme.txt").otherwise("20200101_report.csv"),
        "processing_value": F.when(c("order_key") % 23 == 0, "abc").otherwise(c("processing_value")),
        "company": F.when(c("order_key") % 37 != 0, c("company")),
    })
    return scans.rejected_rows(odd, {
        "file name": scans.file_date("file_name").isNull(), "amount": scans.is_no_amount("processing_value"), "no company": c("company").isNull(),
    })


@query("scan_calendar_day", """
SELECT event_id, event_type, CAST(value AS DECIMAL(15,2)) AS amount FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'""",
       money="amount")
def scan_calendar_day(r):
    rows = scans.scan_calendar_day(r.events, dt.date(2024, 1, 5), "ts")
    return rows.select("event_id", "event_type", c("value").cast("decimal(15,2)").alias("amount"))


@query("scan_date_range", """
SELECT 'after' AS kind, o_orderkey, o_orderstatus FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2000-12-31'
UNION ALL
SELECT 'between' AS kind, o_orderkey, o_orderstatus FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'""")
def scan_date_range(r):
    after = scans.scan_date_range(r.orders, "o_orderdate", after=dt.date(2000, 12, 31))
    between = scans.scan_date_range(r.orders, "o_orderdate", between=(dt.date(1997, 1, 1), dt.date(1997, 6, 30)))
    shown = [(df, kind) for df, kind in ((after, "after"), (between, "between"))]
    first, second = (df.select(F.lit(k).alias("kind"), "o_orderkey", "o_orderstatus") for df, k in shown)
    return first.unionByName(second)


@query("scan_approved_update_date", """
SELECT CAST(update_date AS DATE) AS business_date, company, count(*) AS n,
  sum(CAST(processing_value AS DECIMAL(15,2))) AS amount
FROM x_stmt_c WHERE status = 'APPROVED' GROUP BY 1, 2""",
       money="amount", dates="business_date")
def scan_approved_update_date(r):
    rows = scans.scan_approved(r.statement_c, "update_date", "status")
    value = c("processing_value").try_cast("decimal(15,2)")
    return rows.groupBy("business_date", "company").agg(F.count("*").alias("n"), F.sum(value).alias("amount"))


HISTORY_SQL = """
SELECT strftime(business_date, '%Y-%m') AS business_month, business_date, company, settled_by, sum(revenue_usd) AS revenue_usd
FROM x_days GROUP BY 1, 2, 3, 4"""
HISTORY_TABLE = "business_date DATE, company STRING, settled_by STRING, revenue_usd DECIMAL(25,3), business_month STRING"
COMMON_TABLE = "brand STRING, batchid STRING, distref STRING, amount DECIMAL(25,3), version STRING, batch_month STRING"


def daily_revenue(r):
    out = sum_by(r.ledger_days, ["business_date", "company", "settled_by"], {"revenue_usd": "revenue_usd"})
    return out.withColumn("business_month", F.date_format("business_date", "yyyy-MM"))


def read_back(r, path, schema):
    """Read a written table by its declared schema, which keeps partition columns as text."""
    return r.spark.read.schema(schema).parquet(path)


@query("sink_append_history", HISTORY_SQL, money="revenue_usd", dates="business_date")
def sink_append_history(r):
    """Two appends, one per company, make up the whole history."""
    path = scratch_path(r.spark, "history")
    daily = daily_revenue(r)
    for company in ("LMX1", "LBR2"):
        part = daily.filter(c("company") == company)
        sinks.append_history(part, path, HISTORY_TABLE, ["business_month"])
    return read_back(r, path, HISTORY_TABLE)


@query("sink_truncate_reload", HISTORY_SQL, money="revenue_usd", dates="business_date")
def sink_truncate_reload(r):
    """A reload over an already filled table leaves one copy."""
    path = scratch_path(r.spark, "reload")
    daily = daily_revenue(r)
    sinks.append_history(daily, path, HISTORY_TABLE, ["business_month"])
    sinks.truncate_reload(daily, path, HISTORY_TABLE, ["business_month"])
    return read_back(r, path, HISTORY_TABLE)


@query("sink_replace_batch", """
SELECT company AS brand, 'ACL_' || strftime(business_date, '%m%d%Y') AS batchid, company || ' ' || settled_by AS distref,
  CASE WHEN company = 'LMX1' THEN 2 ELSE 1 END * sum(revenue_usd) AS amount,
  CASE WHEN company = 'LMX1' THEN 'second' ELSE 'first' END AS version, strftime(business_date, '%Y-%m') AS batch_month
FROM x_days GROUP BY business_date, company, settled_by""", money="amount")
def sink_replace_batch(r):
    """All batches are published, then one brand's batches are replaced, twice."""
    path, daily = scratch_path(r.spark, "common"), scratch_path(r.spark, "daily")
    sinks.append_history(daily_revenue(r), daily, HISTORY_TABLE, ["business_month"])
    first = read_back(r, daily, HISTORY_TABLE).select(
        c("company").alias("brand"),
        F.concat(F.lit("ACL_"), F.date_format("business_date", "MMddyyyy")).alias("batchid"),
        F.concat("company", F.lit(" "), "settled_by").alias("distref"),
        c("revenue_usd").alias("amount"),
        F.lit("first").alias("version"),
        c("business_month").alias("batch_month"),
    )
    second = first.filter(c("brand") == "LMX1").withColumns({"amount": c("amount") * 2, "version": F.lit("second")})
    by_month = {"schema": COMMON_TABLE, "partition_by": ["brand", "batch_month"]}
    sinks.replace_batches(first, path, **by_month)
    for _ in range(2):
        sinks.replace_batches(second, path, **by_month)
    return read_back(r, path, COMMON_TABLE)
