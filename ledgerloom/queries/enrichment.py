"""Ledger enrichment and processor-report normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import scalars as S
from ledgerloom.operators import enrich as E
from ledgerloom.operators import processor as R
from ledgerloom.queries.registry import query

c = F.col

ID = ["order_key"]


def with_class(r, name):
    return r.ledger_raw.withColumn(name, E.classifications()[name]).select("order_key", "txn_id", name)


@query("enrich_fx", "SELECT order_key, currency, date, fx_rate FROM x_fx", money="fx_rate", dates="date")
def enrich_fx(r):
    return E.enrich_fx(r.ledger_raw, r.rates).select("order_key", "currency", "date", "fx_rate")


@query("classify_txn_type", "SELECT order_key, txn_id, txn_type FROM x_types")
def classify_txn_type(r):
    return with_class(r, "txn_type")


@query("classify_business_line", "SELECT order_key, txn_id, business_line FROM x_types")
def classify_business_line(r):
    return with_class(r, "business_line")


@query("classify_settled_by", "SELECT order_key, txn_id, settled_by FROM x_types")
def classify_settled_by(r):
    return with_class(r, "settled_by")


@query("classify_tax_type", "SELECT order_key, txn_id, tax_type FROM x_types")
def classify_tax_type(r):
    return with_class(r, "tax_type")


AMOUNTS = "trans_local trans_usd tax_local tax_usd revenue_local revenue_usd"


@query("enrich_amounts", f"SELECT order_key, {AMOUNTS.replace(' ', ', ')} FROM x_ledger", money=AMOUNTS)
def enrich_amounts(r):
    return E.enrich_amounts(E.enrich_fx(r.ledger_raw, r.rates)).select("order_key", *AMOUNTS.split())


@query("enrich_inclusion_flags", "SELECT order_key, cash_included, gaap_included FROM x_ledger")
def enrich_inclusion_flags(r):
    rows = r.ledger_raw.withColumns(E.classifications())
    return rows.withColumns(E.inclusion_flags()).select("order_key", "cash_included", "gaap_included")


LEDGER = f"order_key company date currency fx_rate txn_type business_line settled_by tax_type {AMOUNTS} cash_included gaap_included"


@query("enrich_ledger", f"SELECT {LEDGER.replace(' ', ', ')} FROM x_ledger", money=f"fx_rate {AMOUNTS}", dates="date")
def enrich_ledger(r):
    return E.enrich_ledger(r.ledger_raw, r.rates).select(*LEDGER.split())


@query("flag_overpayment_prepaid", """
SELECT order_key, CASE WHEN total - invoice_total - CAST(vat_tax AS DECIMAL(15,2)) > 0 THEN 'X' ELSE '' END AS overpayment_flag,
  CASE WHEN settled_by = 'Credit' THEN 'X' ELSE '' END AS prepaid_flag FROM x_types""")
def flag_overpayment_prepaid(r):
    rows = r.ledger_raw.withColumn("settled_by", E.classifications()["settled_by"])
    return E.flag_overpayment_prepaid(rows).select("order_key", "overpayment_flag", "prepaid_flag")


# --- processor reports -----------------------------------------------------

LINE = ["order_key", "l_linenumber", "type"]


@query("sign_by_type", """
SELECT order_key, l_linenumber, type, CASE type WHEN 'CREDIT' THEN -processing_amount ELSE processing_amount END AS gross_local,
  CASE type WHEN 'CREDIT' THEN -net_settlement_amount ELSE net_settlement_amount END AS net,
  CASE type WHEN 'CREDIT' THEN -processing_fee_amount ELSE processing_fee_amount END AS fee FROM x_lines""",
       money="gross_local net fee")
def sign_by_type(r):
    names = {"gross_local": "processing_amount", "net": "net_settlement_amount", "fee": "processing_fee_amount"}
    return R.sign_by_type(r.report_lines, names).select(*LINE, *names)


@query("sign_fee_inverse", """
SELECT order_key, l_linenumber, type, CASE type WHEN 'CREDIT' THEN processing_fee_amount ELSE -processing_fee_amount END AS fee_signed
FROM x_lines""", money="fee_signed")
def sign_fee_inverse(r):
    return R.sign_fee_inverse(r.report_lines, "processing_fee_amount").select(*LINE, "fee_signed")


@query("sign_dispute_net", """
SELECT order_key, l_linenumber, type, CASE type WHEN 'CREDIT' THEN -1 ELSE 1 END
  * (coalesce(dispute_settlement_amount, 0) + coalesce(dispute_fee, 0)) AS net_usd FROM x_lines""", money="net_usd")
def sign_dispute_net(r):
    return R.sign_dispute_net(r.report_lines, "dispute_settlement_amount", "dispute_fee").select(*LINE, "net_usd")


@query("scale_minor_units", """
SELECT order_key, CAST(CASE debit_or_credit WHEN 'DR' THEN -1 ELSE 1 END * gross_minor * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS gross,
  CAST(CASE debit_or_credit WHEN 'DR' THEN -1 ELSE 1 END * fee_minor * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS fee
FROM x_stmt_b""", money="gross fee")
def scale_minor_units(r):
    out = R.scale_minor_units(r.statement_b, {"gross": "gross_minor", "fee": "fee_minor"}, "debit_or_credit")
    return out.select("order_key", "gross", "fee")


EVENT = "order_key event_code"


@query("map_event_type", """
SELECT order_key, event_code, CASE left(event_code, 3) WHEN 'T00' THEN 'Paypal to Paypal Payment' WHEN 'T02' THEN 'Currency Conversion'
  WHEN 'T03' THEN 'Bank Deposit into Paypal Acct' WHEN 'T04' THEN 'Bank Withdrawal from Paypal Acct' WHEN 'T11' THEN 'Reversal'
  WHEN 'T12' THEN 'Adjustment' WHEN 'T15' THEN 'Hold For Dispute' ELSE '<Undefined>' END AS event_type FROM x_stmt_b""")
def map_event_type(r):
    return r.statement_b.select("order_key", "event_code", R.event_type("event_code").alias("event_type"))


@query("flag_excluded_events", """
SELECT order_key, event_code, CASE WHEN event_code IN ('T0200', 'T0403', 'T0001', 'T1503') THEN 'X' ELSE '' END AS excluded FROM x_stmt_b""")
def flag_excluded_events(r):
    return r.statement_b.select("order_key", "event_code", R.excluded_event("event_code").alias("excluded"))


@query("flag_chargeback_events", """
SELECT order_key, event_code, CASE WHEN event_code IN ('T1106', 'T1201') THEN 'Yes' ELSE 'No' END AS is_chargeback FROM x_stmt_b""")
def flag_chargeback_events(r):
    return r.statement_b.select("order_key", "event_code", R.chargeback_event("event_code").alias("is_chargeback"))


@query("coalesce_txn_id", "SELECT order_key, coalesce(transaction_id, reference_id, '') AS proc_id FROM x_stmt_b")
def coalesce_txn_id(r):
    return r.statement_b.select("order_key", R.coalesce_txn_id("transaction_id", "reference_id").alias("proc_id"))


@query("route_row_types", """
SELECT order_key, 'transaction' AS kind, bank_reference AS match_id, active_day AS activity_date, processing_currency AS local_currency
FROM x_stmt_a WHERE row_type = 'TX'
UNION ALL SELECT order_key, 'chargeback', processor_reference, active_day, dispute_settlement_currency FROM x_stmt_a WHERE row_type = 'CB'""",
       dates="activity_date")
def route_row_types(r):
    tx, cb = R.route_row_types(r.rows_settlement)
    shown = ["match_id", "activity_date", "local_currency"]
    first = tx.select("order_key", F.lit("transaction").alias("kind"), *shown)
    return first.unionByName(cb.select("order_key", F.lit("chargeback").alias("kind"), *shown))


@query("summarise_processor", """
SELECT pb AS business_date, proc_company, proc_key, proc_currency, event_code, proc_rate, proc_date, proc_amount, proc_fee_usd, proc_gross_usd
FROM x_right_b""", money="proc_rate proc_amount proc_fee_usd proc_gross_usd", dates="business_date proc_date")
def summarise_processor(r):
    return R.summarise_wallet_report(r.rows_b).withColumnRenamed("proc_business_date", "business_date")


@query("summarise_ledger", """
SELECT lb AS business_date, ledger_company, ledger_key, ledger_currency, ledger_date, ledger_flag, trans_usd, trans_local, revenue_usd, revenue_local
FROM x_left_a""", money="trans_usd trans_local revenue_usd revenue_local", dates="business_date ledger_date")
def summarise_ledger(r):
    out = R.summarise_ledger(r.ledger_days, "invoice_id", S.CHANNEL_A, "", chargeback_flag=True)
    return out.withColumnRenamed("ledger_business_date", "business_date")
