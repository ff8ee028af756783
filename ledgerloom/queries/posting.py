"""Reconciliation, debit/credit rules and journals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.scalars import CHANNEL_A, CHANNEL_B, CHANNEL_C
from ledgerloom.operators import match as M
from ledgerloom.operators import posting as P
from ledgerloom.operators.aggregates import sum_by, sum_by_label
from ledgerloom.operators.processor import sign_by_type
from ledgerloom.operators.relational import union
from ledgerloom.plans import journals as J
from ledgerloom.queries.ctes import A_LINES, B_LINES, C_LINES, HEAD_A, HEAD_B, HEAD_C, sides
from ledgerloom.queries.registry import query

c = F.col


def cols(names: str) -> str:
    return ", ".join(names.split())


# --- reconciliation --------------------------------------------------------

SPLIT = "business_date company currency ledger_key proc_key is_chargeback chargeback_diff total_diff fx_diff other_diff"
SPLIT_MONEY = "chargeback_diff total_diff fx_diff other_diff"


@query("recon_variance_split", f"SELECT 'wallet' AS report, {cols(SPLIT)} FROM x_rec_b UNION ALL SELECT 'card', {cols(SPLIT)} FROM x_rec_c",
       money=SPLIT_MONEY, dates="business_date")
def recon_variance_split(r):
    parts = [df.select(F.lit(n).alias("report"), *SPLIT.split()) for n, df in (("wallet", r.recon_b), ("card", r.recon_c))]
    return union(parts)


HIDDEN = (
    "business_date company ledger_key proc_key ledger_flag ledger_currency proc_currency trans_usd trans_local proc_amount "
    "proc_gross_usd hidden_fee_rate hidden_fee total_diff abs_diff fx_diff other_diff"
)
HIDDEN_MONEY = "trans_usd trans_local proc_amount proc_gross_usd hidden_fee_rate hidden_fee total_diff abs_diff fx_diff other_diff"


@query("recon_variance_hidden_fee", f"SELECT {cols(HIDDEN)} FROM x_rec_a", money=HIDDEN_MONEY, dates="business_date")
def recon_variance_hidden_fee(r):
    return r.recon_a.select(*HIDDEN.split())


@query("recon_coalesced_dims", """
SELECT business_date, coalesce(ledger_company, proc_company) AS company, coalesce(ledger_currency, proc_currency) AS currency,
  count(*) AS n FROM x_join_c GROUP BY 1, 2, 3""", dates="business_date")
def recon_coalesced_dims(r):
    return r.recon_c.groupBy("business_date", "company", "currency").agg(F.count("*").alias("n"))


EXC = "business_date company ledger_key proc_key fx_diff other_diff"


@query("recon_exceptions", f"""
SELECT 'a' AS report, {cols(EXC)}, row_number() OVER (PARTITION BY business_date, company
  ORDER BY left(md5(coalesce(ledger_key, '') || '|' || coalesce(proc_key, '')), 2), ledger_key NULLS FIRST, proc_key NULLS FIRST,
  ledger_currency NULLS FIRST, proc_currency NULLS FIRST, ledger_date NULLS FIRST, fx_diff, other_diff) AS exception_num
FROM x_rec_a WHERE fx_diff = 0 AND other_diff <> 0
UNION ALL SELECT 'b', {cols(EXC)}, NULL FROM x_rec_b WHERE other_diff <> 0
UNION ALL SELECT 'c', {cols(EXC)}, NULL FROM x_rec_c WHERE other_diff <> 0""", money="fx_diff other_diff", dates="business_date")
def recon_exceptions(r):
    numbered = M.numbered_exceptions(r.recon_a, "LEDGER VERSUS PROCESSOR A EXCEPTION# - ", require_no_fx=True)
    none = F.lit(None).cast("bigint")
    return union(
        [
            numbered.select(F.lit("a").alias("report"), *EXC.split(), "exception_num"),
            M.exceptions(r.recon_b).select(F.lit("b").alias("report"), *EXC.split(), none.alias("exception_num")),
            M.exceptions(r.recon_c).select(F.lit("c").alias("report"), *EXC.split(), none.alias("exception_num")),
        ]
    )


@query("recon_match_status", """
SELECT business_date, company, CASE WHEN ledger_key IS NULL THEN 'processor only' WHEN proc_key IS NULL THEN 'ledger only' ELSE 'matched' END AS status,
  count(*) AS n, sum(other_diff) AS other_diff FROM x_rec_a GROUP BY 1, 2, 3""", money="other_diff", dates="business_date")
def recon_match_status(r):
    return r.recon_a.groupBy("business_date", "company", M.match_status().alias("status")).agg(
        F.count("*").alias("n"), F.sum("other_diff").alias("other_diff")
    )


@query("recon_exception_summary", """
SELECT business_date, company, coalesce(ledger_flag, 'N/A') AS flag, sum(other_diff) AS other_diff FROM x_rec_a
WHERE fx_diff = 0 AND other_diff <> 0 GROUP BY 1, 2, 3""", money="other_diff", dates="business_date")
def recon_exception_summary(r):
    keys = ["business_date", "company", F.coalesce("ledger_flag", F.lit("N/A")).alias("flag")]
    return sum_by(M.exceptions(r.recon_a, require_no_fx=True), keys, {"other_diff": "other_diff"})


@query("recon_suspense_summary", """
SELECT business_date, company, currency, sum(other_diff) AS suspense, sum(fx_diff) AS fx, sum(chargeback_diff) AS chargebacks,
  sum(proc_fee_usd) AS fees FROM x_rec_b GROUP BY 1, 2, 3""", money="suspense fx chargebacks fees", dates="business_date")
def recon_suspense_summary(r):
    sums = {"suspense": "other_diff", "fx": "fx_diff", "chargebacks": "chargeback_diff", "fees": "proc_fee_usd"}
    return sum_by_label(r.recon_b, ["business_date", "company"], ["currency"], sums)


# --- debit / credit rules --------------------------------------------------


def rule_query(key: str, rule: str) -> None:
    @query(key, f"SELECT order_key, l_linenumber, type, signed, {sides(rule, 'signed')} FROM ("
           "SELECT *, CASE type WHEN 'CREDIT' THEN -net_settlement_amount ELSE net_settlement_amount END AS signed FROM x_lines) AS s",
           money="signed debit credit")
    def build(r):
        rows = sign_by_type(r.report_lines, {"signed": "net_settlement_amount"})
        return P.post(rows, "signed", rule).select("order_key", "l_linenumber", "type", "signed", "debit", "credit")


rule_query("dc_credit_normal", "CN")
rule_query("dc_debit_normal", "DN")
rule_query("dc_debit_normal_zero", "DN0")
rule_query("dc_credit_normal_zero", "CN0")


@query("dc_mirror", f"""
SELECT business_date, company, activity_date, 'line' AS side, {sides('DN0', 'net')} FROM x_settle
UNION ALL SELECT business_date, company, activity_date, 'mirror' AS side, {sides('CN0', 'net')} FROM x_settle""",
       money="debit credit", dates="business_date activity_date")
def dc_mirror(r):
    return P.post_mirrored(
        J.settlement_summary(r.rows_settlement), "net", "DN0", ["business_date", "company", "activity_date"]
    )


# --- single journal lines --------------------------------------------------

LINE = (
    "business_date company checkbookid batchid trantype trandate srcdoc currid reference account debit credit distref key1 "
    "reversedate uniqueid table_name"
)
HEADS = {"a": HEAD_A, "b": HEAD_B, "c": HEAD_C}
SQL_LINES = {"a": A_LINES, "b": B_LINES, "c": C_LINES}


def line_sql(*wanted: tuple[str, str]) -> str:
    """SQL of the named lines of the named journals, with their headers."""
    return "\nUNION ALL\n".join(
        f"SELECT {cols(LINE)} FROM (SELECT l.*, {HEADS[j]} FROM ({SQL_LINES[j][name]}) AS l) AS w_{j}_{name}" for j, name in wanted
    )


def frames(r, journal: str):
    """Frames of a journal's lines by line name."""
    if journal == "a":
        ledger = J.channel_slice(r.ledger_days, CHANNEL_A)
        joined, report = J.joined_posting_view(r.recon_a), J.report_posting_view(r.rows_a)
        spec = J.spec_a()
    elif journal == "b":
        ledger, joined, report, spec = J.channel_slice(r.ledger_days, CHANNEL_B), r.recon_b, None, J.spec_b()
    else:
        ledger, joined, report, spec = J.channel_slice(r.ledger_days, CHANNEL_C), r.recon_c, None, J.spec_c()
    by_line = {"revenue": ledger, "tax": ledger, "fx_adjustment": joined, "hidden_fees": joined, "suspense": joined}
    by_line["fees"] = by_line["chargebacks"] = report if report is not None else joined
    by_line["receivable"] = report
    return by_line, spec


def lines_of(r, *wanted: tuple[str, str]):
    out = []
    for journal, name in wanted:
        by_line, spec = frames(r, journal)
        out.append(P.build_lines(by_line[name], spec, spec.line(name), r.matrix))
    return union(out)


def line_query(key: str, *wanted: tuple[str, str]) -> None:
    @query(key, line_sql(*wanted), money="debit credit", dates="business_date")
    def build(r):
        return lines_of(r, *wanted)


line_query("journal_revenue", ("a", "revenue"), ("b", "revenue"), ("c", "revenue"))
line_query("journal_tax", ("a", "tax"), ("b", "tax"), ("c", "tax"))
line_query("journal_fees", ("a", "fees"), ("b", "fees"))
line_query("journal_fx_adjustment", ("a", "fx_adjustment"))
line_query("journal_hidden_fees", ("a", "hidden_fees"))
line_query("journal_suspense", ("a", "suspense"), ("b", "suspense"), ("c", "suspense"))
line_query("journal_chargebacks", ("a", "chargebacks"), ("b", "chargebacks"))
line_query("journal_receivable", ("a", "receivable"))


@query("journal_header", f"""
SELECT business_date, company, settled_by, revenue_usd, checkbookid, batchid, trantype, trandate, srcdoc, currid, reference, key1, reversedate, uniqueid
FROM (SELECT d.*, 'revenue' AS table_name, {HEAD_A.replace("table_name", "'revenue'")}
  FROM (SELECT business_date, company, settled_by, sum(revenue_usd) AS revenue_usd FROM x_days GROUP BY 1, 2, 3) AS d) AS h""",
       money="revenue_usd", dates="business_date")
def journal_header(r):
    out = sum_by(r.ledger_days, ["business_date", "company", "settled_by"], {"revenue_usd": "revenue_usd"})
    spec = J.spec_a()
    return out.withColumns({**P.header(spec), "uniqueid": P.unique_id(spec.uniqueid_prefix, False)})


@query("journal_cash_plug", f"""
SELECT {cols(LINE)} FROM x_journal_b WHERE table_name = 'cash' UNION ALL SELECT {cols(LINE)} FROM x_journal_c WHERE table_name = 'receivable'""",
       money="debit credit", dates="business_date")
def journal_cash_plug(r):
    wallet = r.journal("wallet").filter(c("table_name") == "cash")
    card = r.journal("card").filter(c("table_name") == "receivable")
    return union([wallet.select(*LINE.split()), card.select(*LINE.split())])


DOC = "business_date company account distref docamt distype"


@query("journal_docamt_distype", " UNION ALL ".join(
    f"SELECT '{n}' AS journal, {cols(DOC)}, {receipt} AS cashrcpt FROM x_journal_{t}"
    for n, t, receipt in (("a_sales", "a", "NULL"), ("wallet", "b", "cashrcpt"), ("card", "c", "cashrcpt"), ("a_cash", "cash", "cashrcpt"))),
       money="docamt", dates="business_date")
def journal_docamt_distype(r):
    s = r.staged
    parts = {n: s.journal(n).withColumn("journal", F.lit(n)) for n in ("a_sales", "wallet", "card", "a_cash")}
    parts["a_sales"] = parts["a_sales"].withColumn("cashrcpt", F.lit(None).cast("string"))
    return union([df.select("journal", *DOC.split(), "cashrcpt") for df in parts.values()])


FULL = LINE + " docamt distype"
RECEIPT = FULL + " cashrcpt"


def journal_query(key: str, name: str, table: str, columns: str) -> None:
    @query(key, f"SELECT {cols(columns)} FROM {table}", money="debit credit docamt", dates="business_date")
    def build(r):
        return r.journal(name).select(*columns.split())


journal_query("journal_settlement_cash", "a_cash", "x_journal_cash", RECEIPT)
journal_query("journal_overpayment", "overpayment", "x_journal_over", FULL)
journal_query("journal_processor_a", "a_sales", "x_journal_a", FULL)
journal_query("journal_wallet", "wallet", "x_journal_b", RECEIPT)
journal_query("journal_card", "card", "x_journal_c", RECEIPT)
