"""Projections, filters, joins, aggregates, sorting, sets, scalars and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.functions.keys import MONEY, PROCESSOR_RATE, ci_contains, ci_key
from ledgerloom.operators import aggregates as A
from ledgerloom.operators import joins as JN
from ledgerloom.operators import match as M
from ledgerloom.operators import processor as R
from ledgerloom.operators import publish as P
from ledgerloom.operators import relational as L
from ledgerloom.operators import reports as RP
from ledgerloom.plans.journals import settlement_summary
from ledgerloom.queries.registry import query
from ledgerloom.sources.buckets import bucketed_id_lookup, store_bucketed, store_ids

c = F.col

# --- projections -----------------------------------------------------------


@query("project_derive", """
SELECT order_key, l_linenumber, type, CAST(CASE type WHEN 'CREDIT' THEN -net_settlement_amount ELSE net_settlement_amount END AS DECIMAL(15,2)) AS net_usd,
  CAST(CASE type WHEN 'CREDIT' THEN processing_fee_amount ELSE -processing_fee_amount END AS DECIMAL(15,2)) AS fees, company AS company_calc
FROM x_lines""", money="net_usd fees")
def project_derive(r):
    credit = R.is_credit()
    out = L.derive(
        r.report_lines,
        {
            "net_usd": (F.when(credit, -c("net_settlement_amount")).otherwise(c("net_settlement_amount")), MONEY),
            "fees": (F.when(credit, c("processing_fee_amount")).otherwise(-c("processing_fee_amount")), MONEY),
            "company_calc": (c("company"), "string"),
        },
    )
    return out.select("order_key", "l_linenumber", "type", "net_usd", "fees", "company_calc")


@query("project_rename", """
SELECT o_orderkey AS order_key, CAST(o_totalprice AS DECIMAL(15,2)) AS revenue_amount, o_orderstatus AS status, o_orderpriority AS channel
FROM orders""", money="revenue_amount")
def project_rename(r):
    legacy = r.orders.select("o_orderkey", c("o_totalprice").cast(MONEY).alias("sales_amount"), "o_orderstatus", "o_orderpriority")
    return L.rename(
        legacy,
        {"o_orderkey": "order_key", "sales_amount": "revenue_amount", "o_orderstatus": "status", "o_orderpriority": "channel"},
    )


@query("project_literals", "SELECT order_key, '20210104' AS import_date, 'LMX1' AS brand FROM x_raw")
def project_literals(r):
    return L.literals(r.ledger_raw.select("order_key"), {"import_date": "20210104", "brand": "LMX1"})


@query("project_star_two_sides", """
SELECT l.order_key AS order_key, l.company AS gt_company, l.currency AS gt_currency, l.total AS gt_total,
  s.company AS pp_company, s.currency AS pp_currency, s.gross AS pp_gross
FROM x_ledger AS l JOIN x_stmt AS s ON l.order_key = s.order_key""", money="gt_total pp_gross")
def project_star_two_sides(r):
    gt = L.prefixed(r.ledger_raw.select("order_key", "company", "currency", "total"), "gt_", keep=["order_key"])
    pp = L.prefixed(r.statement.select("order_key", "company", "currency", "gross"), "pp_", keep=["order_key"])
    return JN.inner_join(gt, pp, ["order_key"])


@query("project_journal_shape", """
SELECT checkbookid, batchid, trantype, trandate, srcdoc, currid, reference, account, debit, credit, distref, key1, reversedate,
  uniqueid, docamt, CAST(NULL AS VARCHAR) AS cashrcpt, distype, company AS brand, 'Overpayment_JE' AS merchant
FROM x_journal_over""", money="debit credit docamt")
def project_journal_shape(r):
    return P.journal_shape(r.journal("overpayment"), "Overpayment_JE", keep_receipt=False)


@query("project_row_identity", """
SELECT business_date, company, ledger_key, other_diff, n AS exception_num, 'LEDGER VERSUS PROCESSOR EXCEPTION# - ' || CAST(n AS VARCHAR) AS exception_id
FROM (SELECT *, row_number() OVER (PARTITION BY business_date, company ORDER BY left(md5(coalesce(ledger_key, '') || '|' || coalesce(proc_key, '')), 2),
        ledger_key NULLS FIRST, proc_key NULLS FIRST, ledger_currency NULLS FIRST, proc_currency NULLS FIRST, ledger_date NULLS FIRST,
        fx_diff, other_diff) AS n FROM x_rec_a WHERE other_diff <> 0) AS e""", money="other_diff", dates="business_date")
def project_row_identity(r):
    rows = M.exceptions(r.recon_a).select(*M.EXCEPTION_COLUMNS)
    out = L.row_identity(
        rows, ["business_date", "company"], ["ledger_key", "proc_key"], "LEDGER VERSUS PROCESSOR EXCEPTION# - "
    )
    return out.select("business_date", "company", "ledger_key", "other_diff", "exception_num", "exception_id")


# --- filters ---------------------------------------------------------------


@query("filter_boolean_mix", """
SELECT event_id FROM events WHERE (extract(hour FROM ts) < 21 OR value > 100) AND event_type = 'purchase'
  OR event_type <> 'purchase' AND extract(hour FROM ts) >= 21""")
def filter_boolean_mix(r):
    late, buys = F.hour("ts") >= 21, c("event_type") == "purchase"
    return r.events.filter(((~late | (c("value") > 100)) & buys) | (~buys & late)).select("event_id")


@query("filter_null_tests", """
SELECT order_key, processor, grouping_ AS "grouping" FROM x_raw WHERE processor IS NULL AND grouping_ IS NULL
   OR txn_id IS NULL OR (rebill_or_new = 'New' OR rebill_or_new IS NULL) AND grouping_ IS NOT NULL""")
def filter_null_tests(r):
    open_ = (c("rebill_or_new") == "New") | c("rebill_or_new").isNull()
    keep = (c("processor").isNull() & c("grouping").isNull()) | c("txn_id").isNull() | (open_ & c("grouping").isNotNull())
    return r.ledger_raw.filter(keep).select("order_key", "processor", "grouping")


@query("filter_in_not_in", """
SELECT order_key, processor, country FROM x_raw WHERE country IN ('US', 'India', 'Japan') AND processor NOT IN ('NULL', 'Credit')""")
def filter_in_not_in(r):
    keep = c("country").isin("US", "India", "Japan") & ~c("processor").isin("NULL", "Credit")
    return r.ledger_raw.filter(keep).select("order_key", "processor", "country")


@query("filter_like", """
SELECT order_key, txn_id FROM x_raw WHERE txn_id LIKE '%MANUALTRANS%' OR txn_id LIKE '%99' OR txn_id LIKE '12%'
   OR regexp_matches(lower(country), '[a-z]{5}') AND txn_id NOT LIKE '%1%'""")
def filter_like(r):
    any_of = ci_contains("txn_id", "manualtrans") | c("txn_id").like("%99") | c("txn_id").like("12%")
    return r.ledger_raw.filter(any_of | (c("country").rlike("(?i)[a-z]{5}") & ~c("txn_id").like("%1%"))).select(
        "order_key", "txn_id"
    )


@query("filter_nonzero", "SELECT order_key, l_linenumber, processing_fee_amount FROM x_lines WHERE abs(processing_fee_amount) > 0",
       money="processing_fee_amount")
def filter_nonzero(r):
    rows = r.report_lines.select("order_key", "l_linenumber", "processing_fee_amount")
    return L.filter_not_zero(rows, "processing_fee_amount")


@query("filter_column_compare", "SELECT order_key, total, invoice_total FROM x_raw WHERE total > invoice_total",
       money="total invoice_total")
def filter_column_compare(r):
    return L.filter_column_greater(r.ledger_raw.select("order_key", "total", "invoice_total"), "total", "invoice_total")


@query("filter_ci_equals", "SELECT order_key, processor FROM x_raw WHERE lower(processor) = 'dlocal'")
def filter_ci_equals(r):
    return L.filter_ci_equals(r.ledger_raw, "processor", "DLOCAL ").select("order_key", "processor")


# --- joins -----------------------------------------------------------------


@query("join_inner", """
SELECT a.currency, a.company, a.ledger_n, b.report_n FROM
  (SELECT currency, company, count(*) AS ledger_n FROM x_raw GROUP BY 1, 2) AS a
JOIN (SELECT processing_currency AS currency, row_type, count(*) AS report_n FROM x_lines GROUP BY 1, 2) AS b
  ON a.currency = b.currency""")
def join_inner(r):
    ledger = r.ledger_raw.groupBy("currency", "company").agg(F.count("*").alias("ledger_n"))
    report = r.report_lines.groupBy(c("processing_currency").alias("currency"), "row_type").agg(F.count("*").alias("report_n"))
    return JN.inner_join(ledger, report, ["currency"]).select("currency", "company", "ledger_n", "report_n")


@query("join_left_lookup", """
SELECT s.s_suppkey, coalesce(n.n_name, 'unknown') AS nation_name FROM supplier AS s
LEFT JOIN (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey <> 2) AS n ON s.s_nationkey = n.n_nationkey""")
def join_left_lookup(r):
    known = r.nation.filter(c("n_regionkey") != 2)
    out = JN.left_lookup(r.supplier, known, [(c("s_nationkey"), c("n_nationkey"))], "n_name", "unknown", "nation_name")
    return out.select("s_suppkey", "nation_name")


@query("join_fx_rate", """
SELECT s.order_key, CAST(coalesce(f.rate, 1) AS DECIMAL(10,4)) AS rate
FROM x_stmt_c AS s LEFT JOIN x_rates AS f
  ON upper(s.transaction_currency) = f.rate_currency AND CAST(s.creation_date AS DATE) = f.rate_date""", money="rate")
def join_fx_rate(r):
    rows = r.statement_c.select("order_key", "transaction_currency", "creation_date")
    out = JN.fx_lookup(rows, r.rates, "transaction_currency", "creation_date", "rate", PROCESSOR_RATE)
    return out.select("order_key", "rate")


@query("join_account_matrix", """
SELECT l.order_key, coalesce(a.account, '') AS by_three, coalesce(b.account, 'XXX-XXXXX-XXX') AS by_two, coalesce(d.account, '') AS deposit
FROM x_ledger AS l LEFT JOIN x_matrix3 AS a ON a.mc = l.company AND a.mt = upper(l.txn_type) AND a.ml = upper(l.business_line)
LEFT JOIN x_matrix2 AS b ON b.mt = upper(l.txn_type) AND b.ml = upper(l.business_line)
LEFT JOIN x_deposit AS d ON d.mc = l.company""")
def join_account_matrix(r):
    rows = r.ledger.select("order_key", "company", "txn_type", "business_line")
    rows = JN.account_lookup(rows, r.matrix, alias="by_three")
    rows = JN.account_lookup(rows, r.matrix, ["txn_type", "business_line"], default="XXX-XXXXX-XXX", alias="by_two")
    rows = JN.account_lookup(rows, r.matrix, ["company"], constant_line=S.DEPOSIT_LINE, alias="deposit")
    return rows.select("order_key", "by_three", "by_two", "deposit")


#: Buckets of the stored tables of the test data; a warehouse takes as many as its largest table has files of some hundred MB.
ID_BUCKETS = 8

TXN_ID_SQL = """
SELECT l.order_key, coalesce(t.transaction_id, '') AS processor_txn_id FROM x_raw AS l
LEFT JOIN (SELECT DISTINCT transaction_id FROM x_lines) AS t ON l.invoice_id = t.transaction_id"""


@query("join_txn_id_lookup", TXN_ID_SQL)
def join_txn_id_lookup(r):
    out = JN.processor_id_lookup(r.ledger_raw.select("order_key", "invoice_id"), r.report_lines, "invoice_id", "transaction_id")
    return out.select("order_key", "processor_txn_id")


@query("join_bucketed_lookup", TXN_ID_SQL)
def join_bucketed_lookup(r):
    """The same over tables stored in buckets of the id."""
    ledger = store_bucketed(r.ledger_raw.select("order_key", "invoice_id"), "ledger", "invoice_id", ID_BUCKETS)
    ids = store_ids(r.report_lines, "report_ids", "transaction_id", ID_BUCKETS)
    return bucketed_id_lookup(ledger, ids, "invoice_id").select("order_key", "processor_txn_id")


PAIR = ["business_date", "company", "ledger_key", "proc_key", "ledger_currency", "proc_currency", "trans_usd", "proc_gross_usd"]
PAIR_SQL = "SELECT " + ", ".join(PAIR) + " FROM "


@query("join_full_outer", PAIR_SQL + "x_join_c", money="trans_usd proc_gross_usd", dates="business_date")
def join_full_outer(r):
    left = R.summarise_ledger(r.ledger_days, "txn_id", S.CHANNEL_C, "1")
    return M.reconcile(left, R.summarise_card_report(r.rows_c)).select(*PAIR)


@query("join_full_outer_conditional", "SELECT ledger_flag, " + ", ".join(PAIR) + " FROM x_join_a",
       money="trans_usd proc_gross_usd", dates="business_date")
def join_full_outer_conditional(r):
    left = R.summarise_ledger(r.ledger_days, "invoice_id", S.CHANNEL_A, "", chargeback_flag=True)
    return M.reconcile_flagged(left, R.summarise_sales_report(r.rows_a)).select("ledger_flag", *PAIR)


@query("join_full_outer_filtered", "SELECT event_code, " + ", ".join(PAIR) + " FROM x_join_b",
       money="trans_usd proc_gross_usd", dates="business_date")
def join_full_outer_filtered(r):
    left = R.summarise_ledger(r.ledger_days, "txn_id", S.CHANNEL_B, "1")
    return M.reconcile(left, R.summarise_wallet_report(r.rows_b)).select("event_code", *PAIR)


@query("join_full_coalesce_keys", "SELECT business_date, company, activity_date, settled, disputed FROM x_settle",
       money="settled disputed", dates="business_date activity_date")
def join_full_coalesce_keys(r):
    return settlement_summary(r.rows_settlement).select("business_date", "company", "activity_date", "settled", "disputed")


@query("join_multi_full_by_date", """
SELECT t.business_date, n1 AS not_in_ledger, n2 AS not_in_processor, n3 AS matched, total FROM
  (SELECT business_date, count(*) AS total FROM x_join_b GROUP BY 1) AS t
FULL JOIN (SELECT business_date, count(*) AS n1 FROM x_join_b WHERE ledger_key IS NULL GROUP BY 1) AS a ON t.business_date = a.business_date
FULL JOIN (SELECT business_date, count(*) AS n2 FROM x_join_b WHERE proc_key IS NULL GROUP BY 1) AS b ON t.business_date = b.business_date
FULL JOIN (SELECT business_date, count(*) AS n3 FROM x_join_b WHERE ledger_key IS NOT NULL AND proc_key IS NOT NULL GROUP BY 1) AS m
  ON t.business_date = m.business_date""", dates="business_date")
def join_multi_full_by_date(r):
    return RP.match_rate_chain(r.recon_b)


@query("join_multi_left_by_date", """
SELECT a.business_date, a.revenue AS revenue_a, coalesce(b.revenue, 0) AS revenue_b, coalesce(c.revenue, 0) AS revenue_c FROM
  (SELECT business_date, sum(revenue_usd) AS revenue FROM x_days WHERE settled_by = 'Dlocal' GROUP BY 1) AS a
LEFT JOIN (SELECT business_date, sum(revenue_usd) AS revenue FROM x_days WHERE settled_by = 'Paypal' GROUP BY 1) AS b ON a.business_date = b.business_date
LEFT JOIN (SELECT business_date, sum(revenue_usd) AS revenue FROM x_days WHERE settled_by = 'PayU' GROUP BY 1) AS c ON a.business_date = c.business_date""",
       money="revenue_a revenue_b revenue_c", dates="business_date")
def join_multi_left_by_date(r):
    daily = A.sum_by(r.ledger_days, ["business_date", "settled_by"], {"revenue": "revenue_usd"})

    def one(channel, name):
        return daily.filter(c("settled_by") == channel).select("business_date", c("revenue").alias(name))

    return JN.chain_by_key(
        one(S.CHANNEL_A, "revenue_a"), [one(S.CHANNEL_B, "revenue_b"), one(S.CHANNEL_C, "revenue_c")], "business_date",
        "left", ["revenue_b", "revenue_c"],
    )


# --- aggregates ------------------------------------------------------------


@query("agg_sum_by_keys", """
SELECT company, max(txn_type) AS txn_type, business_line, settled_by, sum(revenue_usd) AS revenue_usd, sum(tax_usd) AS tax_usd
FROM x_ledger GROUP BY company, upper(txn_type), business_line, settled_by""", money="revenue_usd tax_usd")
def agg_sum_by_keys(r):
    return A.sum_by_label(
        r.ledger, ["company"], ["txn_type", "business_line", "settled_by"],
        {"revenue_usd": "revenue_usd", "tax_usd": "tax_usd"},
    )


@query("agg_sum_signed", """
SELECT order_key, sum(CASE type WHEN 'CREDIT' THEN -coalesce(processing_amount, 0) ELSE coalesce(processing_amount, 0) END) AS amount,
  sum(CASE type WHEN 'CREDIT' THEN -coalesce(net_settlement_amount, 0) ELSE coalesce(net_settlement_amount, 0) END) AS net
FROM x_lines GROUP BY 1""", money="amount net")
def agg_sum_signed(r):
    return A.sum_signed(
        r.report_lines, ["order_key"], R.is_credit(), {"amount": "processing_amount", "net": "net_settlement_amount"}
    )


@query("agg_group_by_expr", """
SELECT CASE WHEN type = 'CREDIT' THEN 'back' ELSE 'out' END AS direction, CAST(processing_date AS DATE) AS day,
  coalesce(status, 'none') AS status, sum(processing_amount) AS amount FROM x_lines GROUP BY 1, 2, 3""",
       money="amount", dates="day")
def agg_group_by_expr(r):
    keys = [
        F.when(R.is_credit(), "back").otherwise("out").alias("direction"),
        F.to_date("processing_date").alias("day"),
        F.coalesce("status", F.lit("none")).alias("status"),
    ]
    return A.sum_by(r.report_lines, keys, {"amount": "processing_amount"})


@query("agg_sum_product_cast", """
SELECT business_date, company, CAST(sum(gross * proc_rate) AS DECIMAL(15,2)) AS gross_usd FROM x_rows_c GROUP BY 1, 2""",
       money="gross_usd", dates="business_date")
def agg_sum_product_cast(r):
    out = A.sum_by(r.rows_c, ["business_date", "company"], {"gross_usd": c("gross") * c("proc_rate")})
    return out.withColumn("gross_usd", c("gross_usd").cast(MONEY))


@query("agg_count_max", """
SELECT bank_mid, row_type, count(*) AS n, max(CAST(processing_date AS DATE)) AS latest FROM x_lines GROUP BY 1, 2
UNION ALL SELECT 'all', 'all', count(*), max(CAST(processing_date AS DATE)) FROM x_lines""", dates="latest")
def agg_count_max(r):
    rows = r.report_lines.withColumn("day", F.to_date("processing_date"))
    grouped = A.count_and_max(rows, ["bank_mid", "row_type"], "day")
    every = A.count_and_max(rows, [], "day").select(F.lit("all").alias("bank_mid"), F.lit("all").alias("row_type"), "n", "latest")
    return grouped.unionByName(every)


@query("agg_count_filtered", """
SELECT business_date, count(*) FILTER (WHERE ledger_key IS NULL) AS not_in_ledger, count(*) FILTER (WHERE proc_key IS NULL) AS not_in_processor
FROM x_join_c GROUP BY 1""", dates="business_date")
def agg_count_filtered(r):
    return A.count_filtered(
        r.recon_c, ["business_date"],
        {"not_in_ledger": c("ledger_key").isNull(), "not_in_processor": c("proc_key").isNull()},
    )


@query("agg_debit_credit_totals", """
SELECT business_date, company, checkbookid, sum(debit) AS debit, sum(credit) AS credit, sum(debit) - sum(credit) AS docamt
FROM x_journal_b WHERE starts_with(distref, 'LMX1 CASH') GROUP BY 1, 2, 3""", money="debit credit docamt", dates="business_date")
def agg_debit_credit_totals(r):
    return A.debit_credit_totals(r.journal("wallet"), ["business_date", "company", "checkbookid"], "LMX1 CASH")


@query("agg_sum_difference", """
SELECT business_date, company, sum(settled) - sum(disputed) AS apart, sum(settled - disputed) AS rowwise, sum(settled) + sum(disputed) AS together
FROM x_settle GROUP BY 1, 2""", money="apart rowwise together", dates="business_date")
def agg_sum_difference(r):
    s, d = c("settled"), c("disputed")
    return settlement_summary(r.rows_settlement).groupBy("business_date", "company").agg(
        (F.sum(s) - F.sum(d)).alias("apart"), F.sum(s - d).alias("rowwise"), (F.sum(s) + F.sum(d)).alias("together")
    )


@query("agg_distinct_values", "SELECT DISTINCT txn_type FROM x_types")
def agg_distinct_values(r):
    return A.distinct_values(r.ledger, "txn_type")


@query("agg_order_by_aggregate", """
SELECT business_date, sum(settled) AS settled, sum(disputed) AS disputed FROM x_settle GROUP BY 1 ORDER BY sum(settled) - sum(disputed) DESC, 1""",
       money="settled disputed", dates="business_date")
def agg_order_by_aggregate(r):
    order = (c("settled") - c("disputed")).desc()
    return A.ordered_by_aggregate(
        settlement_summary(r.rows_settlement), ["business_date"], {"settled": "settled", "disputed": "disputed"}, order
    )


@query("agg_pivot_max", """
SELECT user_id, max(CASE WHEN event_type = 'view' THEN CAST(ts AS DATE) END) AS last_view,
  max(CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) END) AS last_click,
  max(CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS last_purchase FROM events GROUP BY 1""",
       dates="last_view last_click last_purchase")
def agg_pivot_max(r):
    rows = r.events.select("user_id", "event_type", F.to_date("ts").alias("day"))
    values = {"view": "last_view", "click": "last_click", "purchase": "last_purchase"}
    return A.pivot_max(rows, ["user_id"], "event_type", values, "day")


# --- sort, limit, sets -----------------------------------------------------


@query("sort_asc_desc", """
SELECT order_key, date, total FROM x_raw ORDER BY date ASC, total DESC, order_key""", money="total", dates="date")
def sort_asc_desc(r):
    return L.sort(r.ledger_raw.select("order_key", "date", "total"), c("date").asc(), c("total").desc(), c("order_key").asc())


@query("limit_top_n", "SELECT order_key, date, total FROM x_raw ORDER BY date DESC, order_key LIMIT 1000", money="total", dates="date")
def limit_top_n(r):
    return L.top_n(r.ledger_raw.select("order_key", "date", "total"), [c("date").desc(), c("order_key").asc()], 1000)


UNION_SQL = "SELECT credit, debit, account FROM x_journal_c UNION{all} SELECT credit, debit, account FROM x_journal_cash"


@query("set_union_distinct", UNION_SQL.format(all=""), money="credit debit")
def set_union_distinct(r):
    parts = [r.journal(j).select("credit", "debit", "account") for j in ("card", "a_cash")]
    return L.union(parts, distinct=True)


@query("set_union_all", UNION_SQL.format(all=" ALL"), money="credit debit")
def set_union_all(r):
    return L.union([r.journal(j).select("credit", "debit", "account") for j in ("card", "a_cash")])


# --- scalars ---------------------------------------------------------------


@query("scalar_null", """
SELECT order_key, coalesce(txn_id, '1') AS id_or_one, coalesce(taxes, 0) AS taxes, coalesce(grouping_, processor, country) AS first_known
FROM x_raw""", money="taxes")
def scalar_null(r):
    return r.ledger_raw.select(
        "order_key", F.coalesce("txn_id", F.lit("1")).alias("id_or_one"), F.coalesce("taxes", F.lit(0)).alias("taxes"),
        S.first_non_null("grouping", "processor", "country").alias("first_known"),
    )


@query("scalar_case", """
SELECT order_key, CASE WHEN total > 0 THEN 'in' WHEN total < 0 THEN 'out' ELSE 'none' END AS direction, tax_type,
  CASE currency WHEN 'MXN' THEN 'home' WHEN 'USD' THEN 'dollar' ELSE 'other' END AS zone FROM x_types""")
def scalar_case(r):
    zone = F.coalesce(
        F.try_element_at(F.create_map(F.lit("MXN"), F.lit("home"), F.lit("USD"), F.lit("dollar")), c("currency")), F.lit("other")
    )
    direction = F.when(c("total") > 0, "in").when(c("total") < 0, "out").otherwise("none")
    return r.ledger_raw.select("order_key", direction.alias("direction"), S.tax_type("country").alias("tax_type"), zone.alias("zone"))


@query("scalar_string", """
SELECT order_key, left(txn_id, 6) AS head, right(txn_id, 3) AS tail, substr(txn_id, 2, 4) AS middle, CAST(length(rtrim(txn_id || '  ')) AS INTEGER) AS len,
  replace(CAST(date AS VARCHAR), '-', '') AS compact, company || ' ' || grouping_ || ' SALES' AS label FROM x_raw""")
def scalar_string(r):
    label = F.concat("company", F.lit(" "), "grouping", F.lit(" SALES"))
    return r.ledger_raw.select(
        "order_key", F.left("txn_id", F.lit(6)).alias("head"), F.right("txn_id", F.lit(3)).alias("tail"),
        F.substring("txn_id", 2, 4).alias("middle"), S.visible_length(F.concat("txn_id", F.lit("  "))).alias("len"),
        F.replace(c("date").cast("string"), F.lit("-"), F.lit("")).alias("compact"), label.alias("label"),
    )


@query("scalar_date", """
SELECT order_key, strftime(date, '%Y%m%d') AS ymd, strftime(date, '%m%d%Y') AS mdy, date + 1 AS next_day, CAST(ts AS DATE) AS day,
  CAST(date_diff('day', DATE '1995-01-01', date) AS INTEGER) AS days, extract(hour FROM date_trunc('day', ts)) AS midnight,
  CAST(strptime(strftime(date, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed FROM x_raw""", dates="next_day day parsed")
def scalar_date(r):
    return r.ledger_raw.select(
        "order_key", S.yyyymmdd("date").alias("ymd"), S.mmddyyyy("date").alias("mdy"), F.date_add("date", 1).alias("next_day"),
        F.to_date("ts").alias("day"), F.datediff("date", F.lit("1995-01-01").cast("date")).alias("days"),
        F.hour(F.date_trunc("day", "ts")).cast("bigint").alias("midnight"),
        S.date_from_yyyymmdd(S.yyyymmdd("date")).alias("parsed"),
    )


@query("scalar_math", """
SELECT order_key, abs(total) AS size, -total AS turned, total * -1 AS times, CAST(CAST(o_minor AS DECIMAL(15,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS major,
  CAST(total * fx_rate AS DECIMAL(15,2)) AS usd FROM (SELECT *, CAST(total * 100 AS BIGINT) AS o_minor FROM x_fx) AS m""",
       money="size turned times major usd")
def scalar_math(r):
    minor = (c("total") * 100).cast("bigint")
    return r.ledger.select(
        "order_key", F.abs("total").alias("size"), (-c("total")).alias("turned"), (c("total") * -1).alias("times"),
        R.minor_to_major(minor, F.lit("CR")).alias("major"), (c("total") * c("fx_rate")).cast(MONEY).alias("usd"),
    )


@query("scalar_rekey_date", """
SELECT order_key, strftime(date, '%Y%m%d') AS day_key, 'ACL_' || strftime(date, '%m%d%Y') AS batchid FROM x_raw""")
def scalar_rekey_date(r):
    day_key = S.swap_date_halves(S.mmddyyyy("date"))
    batch = F.concat(F.lit("ACL_"), S.swap_date_halves(S.yyyymmdd("date")))
    return r.ledger_raw.select("order_key", day_key.alias("day_key"), batch.alias("batchid"))


# --- subqueries ------------------------------------------------------------


@query("subquery_scalar", """
SELECT order_key, date, total FROM x_raw WHERE date = (SELECT max(date) FROM x_raw)""", money="total", dates="date")
def subquery_scalar(r):
    latest = r.orders.agg(F.max(F.to_date("o_orderdate"))).scalar()
    return r.ledger_raw.filter(c("date") == latest).select("order_key", "date", "total")


@query("subquery_derived_table", """
SELECT company, mid, max(day) AS latest, sum(n) AS n FROM (
  SELECT company, mid, day, count(*) AS n FROM (
    SELECT company, bank_mid AS mid, CAST(processing_date AS DATE) AS day FROM x_lines WHERE row_type = 'TX') AS a
  GROUP BY 1, 2, 3) AS b GROUP BY 1, 2""", money="n", dates="latest")
def subquery_derived_table(r):
    inner = R.route_row_types(r.report_lines)[0].select("company", c("bank_mid").alias("mid"), F.to_date("processing_date").alias("day"))
    daily = inner.groupBy("company", "mid", "day").agg(F.count("*").alias("n"))
    return daily.groupBy("company", "mid").agg(F.max("day").alias("latest"), F.sum("n").alias("n"))


@query("subquery_cte_chain", """
SELECT company, channel, n, usd, CAST(n AS DOUBLE) / CAST(total AS DOUBLE) AS share FROM
  (SELECT company, coalesce(upper(settled_by), 'NONE') AS channel, count(*) AS n, sum(trans_usd) AS usd FROM x_ledger GROUP BY 1, 2) AS a
JOIN (SELECT company, count(*) AS total FROM x_ledger GROUP BY 1) AS b USING (company)""", money="usd share")
def subquery_cte_chain(r):
    channel = F.coalesce(ci_key("settled_by"), F.lit("NONE")).alias("channel")
    by_channel = r.ledger.groupBy("company", channel).agg(F.count("*").alias("n"), F.sum("trans_usd").alias("usd"))
    totals = by_channel.groupBy("company").agg(F.sum("n").alias("total"))
    joined = JN.inner_join(by_channel, totals, ["company"])
    return joined.select("company", "channel", "n", "usd", (c("n").cast("double") / c("total").cast("double")).alias("share"))
