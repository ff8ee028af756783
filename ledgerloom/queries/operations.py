"""Controls, publication, increments, the stream and the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import controls as C
from ledgerloom.operators import enrich as E
from ledgerloom.operators import incremental as I
from ledgerloom.operators import publish as P
from ledgerloom.operators import reports as RP
from ledgerloom.operators.aggregates import sum_by_label
from ledgerloom.operators.joins import inner_join
from ledgerloom.operators.match import exceptions
from ledgerloom.operators.processor import route_row_types
from ledgerloom.operators.relational import union
from ledgerloom.plans import books as B
from ledgerloom.plans import daily_close as D
from ledgerloom.plans import journals as J
from ledgerloom.queries.registry import query
from ledgerloom.queries.scans import read_back
from ledgerloom.session import scratch_path
from ledgerloom.sources import files
from ledgerloom.sources.roles import BRAND_MIDS, BRAND_TABLES, RUN_STAMP, RUN_STAMP_LONG, Roles, pick
from ledgerloom.sources.snapshots import Snapshots
from ledgerloom.streaming.enrich import file_stream, write_available
from ledgerloom.streaming.post import post_available, post_batch

c = F.col


def cols(names: str) -> str:
    return ", ".join(names.split())


# --- controls --------------------------------------------------------------

LIMIT_SQL = "CASE journal WHEN 'overpayment' THEN 50 ELSE 100 END"
BALANCE_SQL = f"""
SELECT business_date, company, journal, checkbookid, value,
  CASE WHEN value IS NULL THEN 'no_data' WHEN abs(value) > {LIMIT_SQL} THEN 'fail' WHEN abs(value) > 0 THEN 'needs balancing' ELSE 'ok' END AS status
FROM (SELECT business_date, company, journal, checkbookid, sum(debit) - sum(credit) AS value FROM x_all GROUP BY 1, 2, 3, 4) AS t"""
PLACEHOLDER_SQL = """
SELECT business_date, company, count(*) FILTER (WHERE account IS NULL OR account = '' OR account LIKE '%XX%') AS value,
  CASE WHEN count(*) FILTER (WHERE account IS NULL OR account = '' OR account LIKE '%XX%') > 0 THEN 'fail' ELSE 'ok' END AS status
FROM (SELECT DISTINCT business_date, company, credit, debit, account FROM x_all) AS u GROUP BY 1, 2"""
COMPLETE_SQL = """
SELECT d.business_date, d.company, coalesce(n, 0) AS value, CASE WHEN coalesce(n, 0) < 1 THEN 'fail' ELSE 'ok' END AS status
FROM (SELECT DISTINCT business_date, company FROM x_days) AS d
LEFT JOIN (SELECT CAST(update_date AS DATE) AS day, company, count(*) AS n FROM x_stmt_c GROUP BY 1, 2) AS s
  ON s.day = d.business_date AND s.company = d.company"""
SUSPENSE_SQL = """
SELECT business_date, company, value, CASE WHEN abs(value) > 2500 THEN 'fail' ELSE 'ok' END AS status FROM (
  SELECT business_date, company, sum(debit) - sum(credit) AS value FROM (
    SELECT DISTINCT business_date, company, credit, debit, account FROM x_all
    WHERE journal <> 'overpayment' AND account = '061-11045-000') AS u GROUP BY 1, 2) AS s"""


@query("control_balance", BALANCE_SQL, money="value", dates="business_date")
def control_balance(r):
    return C.balance(r.staged.all_lines)


@query("control_balance_entry", f"""
SELECT business_date, company, journal, checkbookid, '061-11045-000' AS account,
  CASE WHEN value < 0 THEN -value ELSE 0 END AS debit, CASE WHEN value > 0 THEN value ELSE 0 END AS credit
FROM ({BALANCE_SQL}) AS b WHERE status = 'needs balancing'""", money="debit credit", dates="business_date")
def control_balance_entry(r):
    return C.balance_entries(r.staged.all_lines, J.SUSPENSE_ACCOUNT)


@query("control_placeholder_accounts", PLACEHOLDER_SQL, dates="business_date")
def control_placeholder_accounts(r):
    return C.placeholder_accounts(r.staged.all_lines)


def card_days(r):
    return r.statement_c.select(F.to_date("update_date").alias("business_date"), "company")


@query("control_source_completeness", COMPLETE_SQL, dates="business_date")
def control_source_completeness(r):
    return C.source_completeness(required_days(r), card_days(r))


@query("control_suspense_limit", SUSPENSE_SQL, money="value", dates="business_date")
def control_suspense_limit(r):
    return C.suspense_limit(r.staged.all_lines, J.SUSPENSE_ACCOUNT)


@query("control_gate_status", f"""
SELECT business_date, company, CASE WHEN count(first_rank) > 0 THEN 'stop' ELSE 'publish' END AS decision,
  arg_min(CASE WHEN failed THEN gate END, first_rank) AS failed_gate, arg_min(CASE WHEN failed THEN journal END, first_rank) AS failed_journal,
  arg_min(CASE WHEN failed THEN company || ' ' || gate || ' ' || journal || ' ' || strftime(business_date, '%Y%m%d') END, first_rank) AS alert
FROM (SELECT *, status = 'fail' AS failed,
        CASE WHEN status = 'fail' THEN CASE gate WHEN 'balance' THEN '1' WHEN 'placeholder' THEN '2' WHEN 'completeness' THEN '3' ELSE '4' END || journal END AS first_rank
  FROM (SELECT 'balance' AS gate, business_date, company, journal, status FROM ({BALANCE_SQL}) AS b
        UNION ALL SELECT 'placeholder', business_date, company, 'all', status FROM ({PLACEHOLDER_SQL}) AS p
        UNION ALL SELECT 'completeness', business_date, company, 'all', status FROM ({COMPLETE_SQL}) AS k
        UNION ALL SELECT 'suspense', business_date, company, 'all', status FROM ({SUSPENSE_SQL}) AS s) AS g) AS h
GROUP BY 1, 2""", dates="business_date")
def control_gate_status(r):
    s = r.staged
    lines = D.stage_lines(s.all_lines, scratch_path(r.spark, "lines"))
    return C.gate_status(C.gate_results(lines, required_days(s), card_days(s), J.SUSPENSE_ACCOUNT))


def required_days(r):
    return r.ledger_days.select("business_date", "company").distinct()


COMMON_NAMES = "checkbookid batchid trandate reference account debit credit distref uniqueid docamt distype brand merchant"


CLOSE_SQL = f"""
z_balance AS ({BALANCE_SQL}),
z_lines AS (
  SELECT business_date, company, journal, checkbookid, batchid, trandate, reference, account, debit, credit, distref, uniqueid, docamt, distype, merchant FROM x_all
  UNION ALL
  SELECT b.business_date, b.company, b.journal, b.checkbookid, h.batchid, h.trandate, h.reference, '061-11045-000',
    CASE WHEN value < 0 THEN -value ELSE 0 END, CASE WHEN value > 0 THEN value ELSE 0 END, b.company || ' BALANCE ENTRY', NULL, NULL, NULL, h.merchant
  FROM z_balance AS b JOIN (SELECT business_date, company, journal, checkbookid, max(batchid) AS batchid, max(trandate) AS trandate,
      max(reference) AS reference, max(merchant) AS merchant FROM x_all GROUP BY 1, 2, 3, 4) AS h
    ON h.business_date = b.business_date AND h.company = b.company AND h.journal = b.journal AND h.checkbookid = b.checkbookid
  WHERE status = 'needs balancing'),
z_fail AS (
  SELECT business_date, company FROM z_balance WHERE status = 'fail'
  UNION SELECT business_date, company FROM z_lines WHERE account IS NULL OR account = '' OR account LIKE '%XX%'
  UNION SELECT d.business_date, d.company FROM (SELECT DISTINCT business_date, company FROM x_days) AS d
    WHERE (d.business_date, d.company) NOT IN (SELECT (CAST(update_date AS DATE), company) FROM x_stmt_c)
  UNION SELECT business_date, company FROM (SELECT DISTINCT business_date, company, credit, debit, account FROM z_lines
      WHERE journal <> 'overpayment' AND account = '061-11045-000') AS u
    GROUP BY 1, 2 HAVING abs(sum(debit) - sum(credit)) > 2500)"""
CLOSE_LINE = ("checkbookid, batchid, trandate, reference, account, debit, credit, distref, uniqueid, docamt, distype, l.company AS brand, merchant")


@query("daily_close", f"""
WITH {CLOSE_SQL}
SELECT {CLOSE_LINE} FROM z_lines AS l LEFT JOIN z_fail AS f ON f.business_date = l.business_date AND f.company = l.company WHERE f.company IS NULL""",
       money="debit credit docamt")
def daily_close(r):
    """Close all days twice into one common journal, from lines computed once; the second run replaces the first."""
    s = r.staged
    common, lines = scratch_path(r.spark, "common"), D.stage_lines(s.all_lines, scratch_path(r.spark, "lines"))
    for _ in range(2):
        D.close_days(lines, required_days(s), card_days(s), scratch_path(r.spark, "staged"), common)
    return read_back(r, common, D.COMMON).select(*COMMON_NAMES.split())


# --- the books ---------------------------------------------------------------

FIRST_CLOSE = dt.date(1996, 12, 31)  # the first close has the days up to here, the second all of them
RUN_DAY = "2026-01-01 09:30:00"


def day_frames(r):
    s = r.staged
    return B.DayFrames(s.ledger_days, s.rows_a, s.rows_settlement, s.rows_b, s.rows_c)


def stamps():
    at = F.lit(RUN_DAY).cast("timestamp")
    return B.Stamps(at, at, RUN_STAMP, RUN_STAMP_LONG)


def stored_books(r):
    books = Snapshots(r.spark, scratch_path(r.spark, "books"))
    B.store_frames(books, day_frames(r), B.MONTHS)
    files.remove_at_exit(r.spark, books.root)
    return books


def posted_and_runs(books, histories):
    """What the books hold after a close: lines of the common journal, and runs by history."""
    lines = books.read("common", D.COMMON).select(F.lit("line").alias("kind"), *COMMON_NAMES.split())
    runs = [
        books.read(h, B.HISTORY).select(F.lit(h).alias("kind"), "run_id", F.date_format("date_run", "yyyy-MM-dd").alias("date_run"), c("brand_table").alias("brand"))
        for h in histories
    ]
    out = lines
    for df in runs:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


POSTED_SQL = f"""
SELECT 'line' AS kind, {CLOSE_LINE}, CAST(NULL AS INTEGER) AS run_id, CAST(NULL AS VARCHAR) AS date_run FROM z_lines AS l
JOIN z_done AS d ON d.business_date = l.business_date AND d.company = l.company"""


def runs_sql(history: str) -> str:
    empty = " ".join(f"NULL AS {n}," for n in COMMON_NAMES.split() if n not in ("brand", "merchant"))
    return f"SELECT '{history}' AS kind, {empty} company AS brand, NULL AS merchant, CAST(row_number() OVER (ORDER BY phase, business_date, company) AS INTEGER) AS run_id, strftime(business_date, '%Y-%m-%d') AS date_run FROM z_done"


@query("close_pending", f"""
WITH {CLOSE_SQL},
z_done AS (SELECT d.business_date, d.company, d.business_date > DATE '{FIRST_CLOSE}' AS phase FROM (SELECT DISTINCT business_date, company FROM x_days) AS d
  LEFT JOIN z_fail AS f ON f.business_date = d.business_date AND f.company = d.company WHERE f.company IS NULL)
{POSTED_SQL} UNION ALL {runs_sql("history")}""", money="debit credit docamt")
def close_pending(r):
    """Close the days up to a date, then all that are pending: lines and runs as one state of the books."""
    books, days = stored_books(r), required_days(r.staged)
    for due in (days.filter(c("business_date") <= F.lit(FIRST_CLOSE)), days):
        B.close(books, due, card_days(r.staged), r.matrix, stamps(), period=B.MONTHS)
    return posted_and_runs(books, ["history"])


@query("close_exception_run", f"""
WITH {CLOSE_SQL.replace(LIMIT_SQL, "100")},
z_done AS (SELECT d.business_date, d.company, 1 AS phase FROM (SELECT DISTINCT business_date, company FROM x_days) AS d
  WHERE (d.business_date, d.company) NOT IN (SELECT (business_date, company) FROM z_balance WHERE status = 'fail'))
{POSTED_SQL} UNION ALL {runs_sql("history")} UNION ALL {runs_sql("exception_history")}""", money="debit credit docamt")
def close_exception_run(r):
    """An exception run asks the balance gate only, by its own limits, and writes both histories."""
    books = stored_books(r)
    B.close(books, required_days(r.staged), card_days(r.staged), r.matrix, stamps(), exception_run=True, period=B.MONTHS)
    return posted_and_runs(books, ["history", "exception_history"])


# --- publication -----------------------------------------------------------


@query("publish_common_journal", f"""
SELECT {cols(' '.join(x for x in P.COMMON_COLUMNS if x not in ('cashrcpt', 'brand', 'merchant')))},
  CASE WHEN journal = 'a_cash' THEN cashrcpt END AS cashrcpt, company AS brand, merchant FROM x_all""", money="debit credit docamt")
def publish_common_journal(r):
    return P.common_journal({n: r.staged.journal(n) for n in J.MERCHANT_TAGS}, J.MERCHANT_TAGS)


BRAND = "SRC_LEDGER"
LAST_RUN = dt.date(2001, 5, 31)
RUNS_SQL = f"""
SELECT DISTINCT CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) + 1 AS run_id,
  CAST(o_orderdate AS DATE) AS date_run, CAST(o_orderdate AS DATE) <= DATE '{LAST_RUN}' AS finished FROM orders"""
PENDING_SQL = f"""
SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS business_date FROM (
  SELECT (SELECT max(date_run) + 1 FROM ({RUNS_SQL}) AS h WHERE finished) AS first,
         (SELECT max(CAST(update_date AS DATE)) - 1 FROM x_stmt_c) AS last) AS s"""


def run_history(r):
    """One run per order date; those after the last finished run never stopped."""
    day = F.to_date("o_orderdate")
    runs = r.orders.select(day.alias("date_run")).distinct()
    return runs.select(
        (F.datediff("date_run", F.lit("1995-01-01").cast("date")) + 1).alias("run_id"),
        c("date_run").cast("timestamp").alias("start_date"),
        F.when(c("date_run") <= F.lit(LAST_RUN), c("date_run").cast("timestamp")).alias("stop_date"),
        "date_run",
        F.lit(BRAND).alias("brand_table"),
    )


@query("incremental_next_dates", PENDING_SQL, dates="business_date")
def incremental_next_dates(r):
    return P.next_dates(run_history(r), BRAND, r.statement_c, "update_date")


@query("incremental_pending_days", """
SELECT DISTINCT business_date, company FROM x_days WHERE extract(day FROM business_date) = 13""", dates="business_date")
def incremental_pending_days(r):
    """All days but the 13th of each month have finished; an earlier failure is pending however late the last run was."""
    days = required_days(r)
    stamp = c("business_date").cast("timestamp")
    done = days.select(
        F.lit(1).alias("run_id"), stamp.alias("start_date"), F.when(F.dayofmonth("business_date") != 13, stamp).alias("stop_date"),
        c("business_date").alias("date_run"), c("company").alias("brand_table"),
    )
    return P.pending_days(done, days)


@query("publish_run_history", f"""
SELECT kind, CAST(top + row_number() OVER (PARTITION BY kind ORDER BY business_date) AS INTEGER) AS run_id, business_date AS date_run,
  '{BRAND}' AS brand_table, CASE kind WHEN 'exception' THEN 'EXCEPTION' END AS run_type
FROM ({PENDING_SQL}) AS p, (SELECT 'daily' AS kind, max(run_id) AS top FROM ({RUNS_SQL}) AS h
  UNION ALL SELECT 'exception', max(run_id) FROM ({RUNS_SQL}) AS h WHERE extract(day FROM date_run) = 7) AS m""",
       dates="date_run")
def publish_run_history(r):
    """An override run writes both histories, each numbered from its own highest id."""
    history = run_history(r)
    overrides = history.filter(F.dayofmonth("date_run") == 7)
    pending = P.next_dates(history, BRAND, r.statement_c, "update_date")
    started = c("business_date").cast("timestamp")
    stopped = F.timestamp_add("HOUR", F.lit(1), started)
    daily = P.run_history_rows(history, pending, BRAND, started, stopped).withColumn("run_type", F.lit(None).cast("string"))
    override = P.run_history_rows(overrides, pending, BRAND, started, stopped, run_type="EXCEPTION")
    shown = ["run_id", "date_run", "brand_table", "run_type"]
    return union([daily.select(F.lit("daily").alias("kind"), *shown), override.select(F.lit("exception").alias("kind"), *shown)])


# --- increments ------------------------------------------------------------

MARK_DAY = "2001-01-01"
STATE = "order_key ts fx_rate txn_type settled_by revenue_usd"


@query("incremental_high_water_mark", f"""
SELECT {cols(STATE.replace(' ts', ''))},
  CASE WHEN ts >= (SELECT max(ts) FROM x_ledger WHERE date < DATE '{MARK_DAY}') THEN 'new' ELSE 'old' END AS run
FROM x_ledger""", money="fx_rate revenue_usd")
def incremental_high_water_mark(r):
    """Rows of the last months are not enriched yet; the mark is the latest enriched row's time."""
    derived = ["fx_rate", "txn_type", "business_line", "settled_by", "tax_type", "revenue_usd"]
    done = c("date") < F.lit(MARK_DAY).cast("date")
    state = r.ledger.select(*r.ledger_raw.columns, *derived).withColumns({d: F.when(done, c(d)) for d in derived})
    state = state.withColumn("run", F.lit("old"))

    def enrich(rows):
        raw = rows.select(*r.ledger_raw.columns)
        return E.enrich_ledger(raw, r.rates).withColumn("run", F.lit("new"))

    out = I.refresh_since_mark(state, enrich, created="ts", done="fx_rate")
    return out.select(*[x for x in STATE.split() if x != "ts"], "run")


@query("incremental_merge", f"""
SELECT {cols(STATE.replace(' ts', ''))},
  CASE WHEN ts >= (SELECT max(ts) FROM x_days WHERE date < DATE '{MARK_DAY}') THEN 'new' ELSE 'old' END AS run
FROM x_days""", money="fx_rate revenue_usd")
def incremental_merge(r):
    """The same increment as a merge: only the months in which rows are enriched again are written, all others keep their files."""
    derived = ["fx_rate", "txn_type", "business_line", "settled_by", "tax_type", "revenue_usd"]
    done = c("date") < F.lit(MARK_DAY).cast("date")
    state = r.ledger_days.select(*r.ledger_raw.columns, "business_date", *derived).withColumns({d: F.when(done, c(d)) for d in derived})
    state = state.withColumn("run", F.lit("old")).withColumn("business_period", F.date_format("business_date", B.MONTHS))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in state.schema)
    books = Snapshots(r.spark, scratch_path(r.spark, "ledger"))
    books.publish(books.latest(), [books.write(state, "ledger", schema, ["business_period"])])

    def enrich(rows):
        raw = rows.select(*r.ledger_raw.columns, "business_date")
        return E.enrich_ledger(raw, r.rates).withColumn("run", F.lit("new"))

    stored = books.read("ledger", schema)
    B.merge_ledger(books, I.changed_since_mark(stored, enrich, created="ts").select(*stored.columns[:-1]), period=B.MONTHS)
    return books.read("ledger", schema).select(*[x for x in STATE.split() if x != "ts"], "run")


@query("incremental_first_run", f"SELECT {cols(STATE.replace(' ts', ''))}, 'new' AS run FROM x_ledger", money="fx_rate revenue_usd")
def incremental_first_run(r):
    """Nothing is enriched yet, so there is no mark: the increment is a full run, and rows without a time are in it too."""
    derived = ["fx_rate", "txn_type", "business_line", "settled_by", "tax_type", "revenue_usd"]
    state = r.ledger.select(*r.ledger_raw.columns, *derived).withColumns({d: F.when(F.lit(False), c(d)) for d in derived})
    state = state.withColumn("run", F.lit("old"))

    def enrich(rows):
        return E.enrich_ledger(rows.select(*r.ledger_raw.columns), r.rates).withColumn("run", F.lit("new"))

    out = I.refresh_since_mark(state, enrich, created="ts", done="fx_rate")
    return out.select(*[x for x in STATE.split() if x != "ts"], "run")


FIRST, LAST = dt.date(1997, 1, 1), dt.date(1997, 12, 31)
LAG_DAYS = 4  # reports of this binding are at most three days late
BACKFILL = "business_date company journal account debit credit distref uniqueid docamt"


@query("backfill_date_range", f"SELECT {cols(BACKFILL)} FROM x_all WHERE business_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'",
       money="debit credit docamt", dates="business_date")
def backfill_date_range(r):
    return Roles.for_days(r, FIRST, LAST, LAG_DAYS).all_lines.select(*BACKFILL.split())


ACCUMULATED = """
SELECT 'journal' AS kind, business_date, company, journal AS name, NULL AS ledger_key, NULL AS proc_key, debit, credit, NULL AS other_diff, NULL AS exception_num
FROM x_all WHERE {days}
UNION ALL SELECT 'match', business_date, company, CASE WHEN ledger_key IS NULL THEN 'processor only' WHEN proc_key IS NULL THEN 'ledger only' ELSE 'matched' END,
  ledger_key, proc_key, NULL, NULL, other_diff, NULL FROM (SELECT business_date, company, ledger_key, proc_key, other_diff FROM x_rec_a
    UNION ALL SELECT business_date, company, ledger_key, proc_key, other_diff FROM x_rec_b UNION ALL SELECT business_date, company, ledger_key, proc_key, other_diff FROM x_rec_c) AS m WHERE {days}
UNION ALL SELECT 'exception', business_date, company, report, ledger_key, proc_key, NULL, NULL, other_diff, exception_num FROM (
  SELECT 'a' AS report, business_date, company, ledger_key, proc_key, other_diff, row_number() OVER (PARTITION BY business_date, company
      ORDER BY left(md5(coalesce(ledger_key, '') || '|' || coalesce(proc_key, '')), 2), ledger_key NULLS FIRST, proc_key NULLS FIRST,
      ledger_currency NULLS FIRST, proc_currency NULLS FIRST, ledger_date NULLS FIRST, fx_diff, other_diff) AS exception_num
    FROM x_rec_a WHERE fx_diff = 0 AND other_diff <> 0
  UNION ALL SELECT 'b', business_date, company, ledger_key, proc_key, other_diff, NULL FROM x_rec_b WHERE other_diff <> 0
  UNION ALL SELECT 'c', business_date, company, ledger_key, proc_key, other_diff, NULL FROM x_rec_c WHERE other_diff <> 0) AS e WHERE {days}"""


@query("backfill_results", ACCUMULATED.format(days=f"business_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}' AND (business_date, company) IN (SELECT (business_date, company) FROM x_days)"),
       money="debit credit other_diff", dates="business_date")
def backfill_results(r):
    """Journals, matches and exceptions of a range accumulated in two parts, the second repeating days of the first."""
    books, days = stored_books(r), required_days(r.staged).filter(c("business_date").between(F.lit(FIRST), F.lit(LAST)))
    for since in (FIRST, dt.date(1997, 9, 1)):
        until = dt.date(1997, 10, 15) if since == FIRST else LAST
        B.backfill(books, days.filter(c("business_date").between(F.lit(since), F.lit(until))), r.matrix, stamps(), B.MONTHS)
    kept = ["business_date", "company", "name", "ledger_key", "proc_key", "debit", "credit", "other_diff", "exception_num"]
    parts = [
        books.read("journals", B.JOURNAL).withColumn("name", c("journal")).withColumn("kind", F.lit("journal")),
        books.read("matches", B.MATCHES).withColumn("name", c("status")).withColumn("kind", F.lit("match")),
        books.read("exceptions", B.EXCEPTIONS).withColumn("name", c("report")).withColumn("kind", F.lit("exception")),
    ]
    out = None
    for df in parts:
        df = df.select("kind", *[n for n in kept if n in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.select("kind", *kept)


@query("stream_enrich", """
SELECT strftime(date, '%Y-%m') AS month, company, settled_by, max(txn_type) AS txn_type, count(*) AS n, sum(revenue_usd) AS revenue_usd, sum(tax_usd) AS tax_usd
FROM x_ledger GROUP BY 1, 2, 3, upper(txn_type)""", money="n revenue_usd tax_usd")
def stream_enrich(r):
    path, checkpoint = scratch_path(r.spark, "stream"), scratch_path(r.spark, "stream-log")
    live = Roles(r.spark, r.data_dir)
    live.rates = r.rates  # the days of the rates come from the stored orders, not from the stream
    live.orders = file_stream(r.spark, r.data_dir, r.orders.schema, "orders.parquet")
    enriched = live.ledger.withColumn("month", F.date_format("date", "yyyy-MM"))
    kept = ["order_key", "company", "settled_by", "txn_type", "revenue_usd", "tax_usd", "month"]
    write_available(enriched.select(*kept), path, checkpoint, ["month"]).awaitTermination()
    rows = read_back(r, path, enriched.select(*kept).schema)
    sums = {"n": F.lit(1), "revenue_usd": "revenue_usd", "tax_usd": "tax_usd"}
    return sum_by_label(rows, ["month", "company", "settled_by"], ["txn_type"], sums)


DAILY = "business_month STRING, business_date DATE, company STRING, settled_by STRING, n BIGINT, revenue_usd DECIMAL(25,3)"


@query("stream_post", """
SELECT business_date, company, max(settled_by) AS settled_by, count(*) AS n, sum(revenue_usd) AS revenue_usd FROM x_days
GROUP BY 1, 2, upper(settled_by)""", money="revenue_usd", dates="business_date")
def stream_post(r):
    """Daily revenue posted from arriving files into the books, a few files a micro-batch; the last one arrives twice."""
    arriving, checkpoint = scratch_path(r.spark, "arriving"), scratch_path(r.spark, "stream-log")
    r.orders.repartition(6, "o_orderkey").write.parquet(arriving)
    live = Roles(r.spark, r.data_dir)
    live.rates = r.rates
    live.orders = file_stream(r.spark, arriving, r.orders.schema, "*.parquet", max_files=2)
    keys = ["business_month", "business_date", "company", "settled_by"]

    def lines(batch):
        rows = batch.withColumn("business_month", F.date_format("business_date", "yyyy-MM"))
        return sum_by_label(rows, keys[:3], keys[3:], {"n": F.lit(1), "revenue_usd": "revenue_usd"})

    def merge(old, new):
        return sum_by_label(old.unionByName(new.select(*old.columns)), keys[:3], keys[3:], {"n": "n", "revenue_usd": "revenue_usd"})

    books = Snapshots(r.spark, scratch_path(r.spark, "books"))
    post = post_batch(books, "ledger", "daily", DAILY, ["business_month"], lines, merge)
    last = []

    def post_and_note(batch, number):
        post(batch, number)
        last[:] = [number]

    post_available(live.ledger_days, post_and_note, checkpoint).awaitTermination()
    post(r.ledger_days, last[0])  # a replay, even with other rows, is no new posting
    return books.read("daily", DAILY).drop("business_month")


# --- reports ---------------------------------------------------------------

SALES = ["a_sales", "wallet", "card"]
SALES_SQL = "(SELECT * FROM x_all WHERE journal IN ('a_sales', 'wallet', 'card')) AS s"


def sales_lines(r):
    return r.staged.tagged(*SALES)


@query("report_suspense_by_merchant", f"SELECT merchant, sum(debit - credit) AS suspense FROM {SALES_SQL} WHERE account LIKE '%11045%' GROUP BY 1",
       money="suspense")
def report_suspense_by_merchant(r):
    return RP.suspense_by_merchant(sales_lines(r))


@query("report_suspense_by_day", """
SELECT a.business_date, a.s AS suspense_a, coalesce(b.s, 0) AS suspense_b, coalesce(c.s, 0) AS suspense_c FROM
  (SELECT business_date, sum(debit - credit) AS s FROM x_journal_a WHERE account LIKE '%11045%' GROUP BY 1) AS a
LEFT JOIN (SELECT business_date, sum(debit - credit) AS s FROM x_journal_b WHERE account LIKE '%11045%' GROUP BY 1) AS b ON b.business_date = a.business_date
LEFT JOIN (SELECT business_date, sum(debit - credit) AS s FROM x_journal_c WHERE account LIKE '%11045%' GROUP BY 1) AS c ON c.business_date = a.business_date
ORDER BY 1""", money="suspense_a suspense_b suspense_c", dates="business_date")
def report_suspense_by_day(r):
    names = {"DLOCAL": "suspense_a", "Paypal": "suspense_b", "PayU": "suspense_c"}
    return RP.suspense_by_day(sales_lines(r), names, anchor="DLOCAL")


@query("report_revenue_by_merchant", f"SELECT merchant, sum(credit - debit) AS revenue FROM {SALES_SQL} WHERE substr(account, 5, 1) = '4' GROUP BY 1",
       money="revenue")
def report_revenue_by_merchant(r):
    return RP.revenue_by_merchant(sales_lines(r))


@query("report_unbalanced_days", """
SELECT business_date, sum(debit) AS debit, sum(credit) AS credit, sum(debit) - sum(credit) AS difference FROM x_journal_a
GROUP BY 1 ORDER BY 4 DESC, 1""", money="debit credit difference", dates="business_date")
def report_unbalanced_days(r):
    return RP.unbalanced_days(r.journal("a_sales"))


@query("report_match_rate", """
SELECT business_date, not_in_ledger, not_in_processor, matched, total, not_in_ledger + not_in_processor AS unmatched,
  CAST(not_in_ledger + not_in_processor AS DOUBLE) / CAST(total AS DOUBLE) AS unmatched_share FROM (
  SELECT business_date, count(*) FILTER (WHERE ledger_key IS NULL) AS not_in_ledger,
    count(*) FILTER (WHERE ledger_key IS NOT NULL AND proc_key IS NULL) AS not_in_processor,
    count(*) FILTER (WHERE ledger_key IS NOT NULL AND proc_key IS NOT NULL) AS matched, count(*) AS total
  FROM x_join_a GROUP BY 1) AS m""", dates="business_date")
def report_match_rate(r):
    return RP.match_rate(r.recon_a)


FILES_SQL = f"""
SELECT *, CASE WHEN n_regionkey < 3 THEN 'ledger_' || strftime(report_date, '%Y-%m-%d') ELSE 'ledger_' || strftime(report_date, '%Y%m%d') END || '.csv' AS file_name
FROM (SELECT n_regionkey, ([{', '.join(f"'{b}'" for b in BRAND_TABLES)}])[n_regionkey + 1] AS brand_table, CAST(o_orderdate AS DATE) AS report_date
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) AS b"""
FRESH_SQL = f"""
SELECT f.brand_table, count(*) AS n, max(f.report_date) AS report_date, max(f.latest) - 1 AS latest_run FROM (
  SELECT *, max(report_date) OVER (PARTITION BY brand_table) AS latest FROM ({FILES_SQL}) AS a) AS f
WHERE report_date > DATE '1995-06-01' AND (contains(file_name, strftime(latest, '%Y-%m-%d')) OR contains(file_name, strftime(latest, '%Y%m%d')))
GROUP BY 1"""


def brand_sources(r):
    o = r.orders.select("o_custkey", F.to_date("o_orderdate").alias("report_date"))
    cu, n = r.customer.select("c_custkey", "c_nationkey"), r.nation.select("n_nationkey", "n_regionkey")
    rows = o.join(cu, c("o_custkey") == c("c_custkey")).join(n, c("c_nationkey") == c("n_nationkey"))
    pattern = F.when(c("n_regionkey") < 3, F.date_format("report_date", "yyyy-MM-dd")).otherwise(
        F.date_format("report_date", "yyyyMMdd")
    )
    return rows.select(
        pick(BRAND_TABLES, c("n_regionkey")).alias("brand_table"), "report_date",
        F.concat(F.lit("ledger_"), pattern, F.lit(".csv")).alias("file_name"),
    )


def freshness(r):
    sources = brand_sources(r)
    history = sources.select("brand_table", F.date_sub("report_date", 1).alias("date_run"))
    return RP.latest_file_counts(sources, history, F.lit("1995-06-01").cast("date"))


@query("report_source_freshness", FRESH_SQL, dates="report_date latest_run")
def report_source_freshness(r):
    return freshness(r)


TYPES = {"Transaction Activity": "transaction_activity", "Activity Summary": "activity_summary", "Settlement Summary": "settlement_summary"}
MERCHANT_FILES = [f"rep_{m}_x.csv" for m in RP.MERCHANT_IDS] + ["rep_none.csv", "rep_other.csv"]
MERCHANT_SQL = f"""
SELECT mid, max(CASE event_type WHEN 'view' THEN day END) AS transaction_activity, max(CASE event_type WHEN 'click' THEN day END) AS activity_summary,
  max(CASE event_type WHEN 'purchase' THEN day END) AS settlement_summary
FROM (SELECT ([{', '.join(f"'{m}'" for m in RP.MERCHANT_IDS)}, NULL, NULL])[CAST(user_id % 12 AS INTEGER) + 1] AS mid, event_type, CAST(ts AS DATE) AS day
  FROM events WHERE event_type IN ('view', 'click', 'purchase')) AS e WHERE mid IS NOT NULL GROUP BY 1"""


def merchant_reports(r):
    kinds = F.create_map(
        *[F.lit(x) for x in ("view", "Transaction Activity", "click", "Activity Summary", "purchase", "Settlement Summary")]
    )
    rows = r.events.filter(c("event_type").isin("view", "click", "purchase"))
    return rows.select(
        F.try_element_at(kinds, c("event_type")).alias("report_type"), F.to_date("ts").alias("activity_date"),
        pick(MERCHANT_FILES, c("user_id") % len(MERCHANT_FILES)).alias("file_name"),
    )


@query("report_merchant_freshness_pivot", f"""
SELECT f.brand_table, f.mid, f.n, f.latest_run, f.report_date, m.transaction_activity, m.activity_summary, m.settlement_summary
FROM (SELECT *, CASE brand_table {' '.join(f"WHEN '{b}' THEN '{m}'" for b, m in zip(BRAND_TABLES, BRAND_MIDS))} END AS mid FROM ({FRESH_SQL}) AS q) AS f
JOIN ({MERCHANT_SQL}) AS m ON m.mid = f.mid""",
       dates="latest_run report_date transaction_activity activity_summary settlement_summary")
def report_merchant_freshness_pivot(r):
    brand_mid = F.create_map(*[F.lit(x) for pair in zip(BRAND_TABLES, BRAND_MIDS) for x in pair])
    brands = freshness(r).withColumn("mid", F.try_element_at(brand_mid, c("brand_table")))
    return inner_join(brands, RP.merchant_freshness(merchant_reports(r), TYPES), ["mid"])


@query("report_adhoc_counts", """
SELECT 'ledger' AS stage, NULL AS company, NULL AS txn_type, count(*) AS n, CAST(NULL AS DECIMAL(15,2)) AS invoiced FROM x_days
UNION ALL SELECT 'report a', NULL, NULL, count(*), NULL FROM x_rows_a WHERE row_type = 'TX'
UNION ALL SELECT 'joined a', NULL, NULL, count(*), NULL FROM x_join_a
UNION ALL SELECT 'exceptions a', NULL, NULL, count(*), NULL FROM x_rec_a WHERE fx_diff = 0 AND other_diff <> 0
UNION ALL SELECT 'by brand and type', company, max(txn_type), count(*), sum(invoice_total) FROM x_days GROUP BY company, upper(txn_type)""",
       money="invoiced")
def report_adhoc_counts(r):
    stages = RP.stage_counts(
        {
            "ledger": r.ledger_days, "report a": route_row_types(r.rows_a)[0], "joined a": r.recon_a,
            "exceptions a": exceptions(r.recon_a, require_no_fx=True),
        }
    )
    by_type = sum_by_label(r.ledger_days, ["company"], ["txn_type"], {"n": F.lit(1), "invoiced": "invoice_total"})
    return union([stages, by_type.withColumn("stage", F.lit("by brand and type"))]).select(
        "stage", "company", "txn_type", "n", "invoiced"
    )


@query("report_matched_summary", """
SELECT 'with ledger id' AS side, count(ledger_key) AS n, sum(trans_usd) AS trans_usd, sum(proc_gross_usd) AS proc_gross_usd FROM x_join_c WHERE ledger_key IS NOT NULL
UNION ALL SELECT 'without ledger id', count(ledger_key), sum(trans_usd), sum(proc_gross_usd) FROM x_join_c WHERE ledger_key IS NULL""",
       money="trans_usd proc_gross_usd")
def report_matched_summary(r):
    return RP.matched_summary(r.recon_c)
