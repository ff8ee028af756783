"""SQL of the role bindings and of the journals, as named common table expressions.

``compose`` puts those a query names in front of it. The SQL is written on its
own, not generated from the DataFrame code; both sides share only the inline
dimension values.
"""

from __future__ import annotations

import re

from ledgerloom.sources.roles import EVENT_CODES, RATE_BASES, matrix_rows

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def compose(body: str) -> str:
    order: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b{name}\b", sql):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(body)
    if not order:
        return body
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    return f"WITH {head}\n{body}"


_values = ", ".join(str(r) for r in RATE_BASES)
_codes = ", ".join(f"'{c}'" for c in EVENT_CODES)

cte("x_rates", f"""
SELECT b.cur AS rate_currency, CAST(g.d AS DATE) AS rate_date,
  CAST(CAST(b.base AS DECIMAL(15,8))
     * CAST(1 + CAST(extract(day FROM g.d) AS INTEGER) * 0.001 AS DECIMAL(6,3)) AS DECIMAL(15,8)) AS rate
FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)) - 31, max(CAST(o_orderdate AS DATE)) + 31, INTERVAL 1 DAY)) FROM orders) AS g(d)
CROSS JOIN (VALUES {_values}) AS b(cur, base)
WHERE extract(day FROM g.d) <> 15""")

cte("x_matrix", f"""
SELECT * FROM (VALUES {', '.join(str(r) for r in matrix_rows())}) AS m(company, txn_type, business_line, account)""")
cte("x_matrix3", """
SELECT upper(company) AS mc, upper(txn_type) AS mt, upper(business_line) AS ml, max(account) AS account
FROM x_matrix GROUP BY 1, 2, 3""")
cte("x_matrix2", """
SELECT upper(txn_type) AS mt, upper(business_line) AS ml, max(account) AS account FROM x_matrix GROUP BY 1, 2""")
cte("x_deposit", """
SELECT upper(company) AS mc, max(account) AS account FROM x_matrix
WHERE upper(business_line) = 'CUST DEPOSIT' GROUP BY 1""")

cte("x_raw", """
SELECT r.*, CASE WHEN order_key % 2 = 0 THEN CAST(total * CAST(0.16 AS DECIMAL(3,2)) AS DECIMAL(15,2)) END AS taxes,
  CAST(CASE WHEN order_key % 11 = 0 THEN total - 5 ELSE total END AS DECIMAL(15,2)) AS invoice_total
FROM (
  SELECT o_orderkey AS order_key, o_orderstatus,
    CASE WHEN o_orderkey % 4 = 3 THEN 'LBR2' ELSE 'LMX1' END AS company,
    CAST(o_orderdate AS DATE) AS date,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS ts,
    CAST(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS total,
    CASE n_regionkey WHEN 0 THEN 'MXN' WHEN 1 THEN 'COP' WHEN 2 THEN 'CLP' WHEN 3 THEN 'USD' WHEN 4 THEN 'BRL' END AS currency,
    CASE n_nationkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'India' WHEN 2 THEN 'Japan' WHEN 3 THEN 'MX' ELSE 'BR' END AS country,
    CASE substr(o_orderpriority, 1, 1)
      WHEN '1' THEN CASE WHEN o_orderkey % 2 = 1 THEN 'PAYPAL' ELSE 'Paypal' END
      WHEN '2' THEN CASE WHEN o_orderkey % 2 = 1 THEN 'DLocal' ELSE 'Dlocal' END
      WHEN '3' THEN 'PayU' WHEN '5' THEN 'Credit' END AS processor,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'shared' WHEN 'AUTOMOBILE' THEN 'addon'
      WHEN 'MACHINERY' THEN 'domain' WHEN 'FURNITURE' THEN 'services' END AS grouping_,
    CASE o_orderstatus WHEN 'F' THEN 'payment' WHEN 'O' THEN 'payment|cash deposit' ELSE 'chargeback' END AS transaction_type,
    CASE o_orderkey % 3 WHEN 0 THEN 'New' WHEN 1 THEN 'Renew' END AS rebill_or_new,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN ''
      ELSE CAST(o_orderkey AS VARCHAR) END AS invoice_id,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN ''
      WHEN o_orderkey % 10 = 0 THEN 'MANUALTRANS' || CASE WHEN o_orderkey < 1000000
        THEN lpad(CAST(o_orderkey AS VARCHAR), 6, '0') ELSE CAST(o_orderkey AS VARCHAR) END
      ELSE CAST(o_orderkey AS VARCHAR) END AS txn_id,
    CASE WHEN o_orderkey % 22 = 0 THEN '1.50' ELSE '0' END AS vat_tax
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) AS r""")

cte("x_fx", """
SELECT r.*, CAST(coalesce(f.rate, 1) AS DECIMAL(15,8)) AS fx_rate
FROM x_raw AS r LEFT JOIN x_rates AS f ON f.rate_currency = upper(r.currency) AND f.rate_date = r.date""")

cte("x_types", """
SELECT f.*,
  CASE WHEN transaction_type = 'chargeback' AND txn_id IS NULL THEN 'Rebill'
       WHEN transaction_type = 'chargeback' AND contains(txn_id, 'MANUALTRANS') THEN 'CHARGEBACK'
       WHEN transaction_type = 'chargeback' THEN 'REFUND'
       WHEN rebill_or_new = 'New' THEN 'NEW'
       WHEN rebill_or_new = 'Renew' THEN 'REBILL' ELSE 'Rebill' END AS txn_type,
  CASE grouping_ WHEN 'shared' THEN 'Hosting' WHEN 'addon' THEN 'Add On' WHEN 'domain' THEN 'Domain'
       WHEN 'services' THEN 'Professional Services'
       ELSE CASE WHEN transaction_type = 'payment|cash deposit' OR processor = 'Credit'
                   OR (processor IS NULL AND length(txn_id) = 17 AND regexp_matches(lower(txn_id), '[a-z]'))
                 THEN 'Cust Deposit' ELSE 'Hosting' END END AS business_line,
  CASE WHEN lower(processor) = 'paypal' THEN 'Paypal'
       WHEN lower(processor) = 'dlocal' OR contains(txn_id, 'MANUALTRANS') THEN 'Dlocal'
       WHEN processor = 'PayU' THEN CASE currency WHEN 'MXN' THEN 'PayU' ELSE 'Dlocal' END
       ELSE processor END AS settled_by,
  CASE country WHEN 'US' THEN 'UST' WHEN 'India' THEN 'GST' WHEN 'Japan' THEN 'GST' ELSE 'VAT' END AS tax_type
FROM x_fx AS f""")

cte("x_ledger", """
SELECT a.*, CAST(revenue_local * fx_rate AS DECIMAL(15,3)) AS revenue_usd,
  CASE WHEN settled_by = 'Credit' THEN 0 ELSE 1 END AS cash_included,
  CASE WHEN business_line = 'Cust Deposit' AND settled_by <> 'Credit' THEN 0 ELSE 1 END AS gaap_included
FROM (
  SELECT t.*,
    CAST(coalesce(total, 0) AS DECIMAL(15,3)) AS trans_local,
    CAST(coalesce(taxes, 0) AS DECIMAL(15,3)) AS tax_local,
    CAST(coalesce(total, 0) - coalesce(taxes, 0) AS DECIMAL(15,3)) AS revenue_local,
    CAST(CAST(coalesce(total, 0) AS DECIMAL(15,3)) * fx_rate AS DECIMAL(15,3)) AS trans_usd,
    CAST(CAST(coalesce(taxes, 0) AS DECIMAL(15,3)) * fx_rate AS DECIMAL(15,3)) AS tax_usd
  FROM x_types AS t) AS a""")

cte("x_days", """
SELECT l.*, CASE WHEN settled_by = 'Dlocal' THEN CAST(ts + INTERVAL 3 HOUR AS DATE) ELSE CAST(ts AS DATE) END AS business_date
FROM x_ledger AS l WHERE settled_by IS NOT NULL""")

cte("x_lines", """
SELECT l_orderkey AS order_key, l_linenumber,
  CASE WHEN l_orderkey % 4 = 3 THEN 'LBR2' ELSE 'LMX1' END AS company,
  CASE WHEN l_returnflag = 'R' THEN 'CREDIT' ELSE 'DEBIT' END AS type,
  CASE WHEN l_linestatus = 'F' THEN 'TX' ELSE 'CB' END AS row_type,
  CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS transaction_id,
  CASE l_suppkey % 4 WHEN 0 THEN 'MXN' WHEN 1 THEN 'COP' WHEN 2 THEN 'CLP' ELSE 'USD' END AS processing_currency,
  CAST(l_extendedprice AS DECIMAL(15,2)) AS processing_amount,
  CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS processing_fee_amount,
  CASE WHEN l_tax > 0 THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2))
    - CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(15,2)) AS DECIMAL(15,2)) END
    AS net_settlement_amount,
  CASE WHEN l_quantity > 5 THEN CAST(l_extendedprice AS DECIMAL(15,2)) END AS dispute_settlement_amount,
  CASE WHEN l_linenumber > 2 THEN CAST(15 AS DECIMAL(15,2)) END AS dispute_fee,
  l_shipdate AS processing_date,
  strftime(CAST(l_shipdate AS DATE) + 1, '%Y%m%d') || '_settlement.csv' AS file_name,
  CASE WHEN l_orderkey % 31 = 0 THEN 'rejected' WHEN l_orderkey % 4 = 1 THEN NULL ELSE 'Cleared' END AS status,
  CASE WHEN l_orderkey % 41 = 0 THEN 'MID-Z' ELSE 'MID-A' END AS bank_mid
FROM lineitem""")

cte("x_stmt", """
SELECT l.*, CAST(CASE WHEN l.order_key % 5 <> 0 THEN total WHEN total < 0 THEN -line_total ELSE line_total END
  AS DECIMAL(15,2)) AS gross
FROM x_ledger AS l JOIN (
  SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS line_total FROM lineitem GROUP BY 1) AS s
ON l.order_key = s.l_orderkey""")

cte("x_stmt_a", """
SELECT order_key, company, invoice_id AS transaction_id, invoice_id AS bank_reference, txn_id AS processor_reference,
  strftime(active + CASE WHEN order_key % 53 = 0 THEN 2 ELSE 1 END, '%Y%m%d') || '_settlement.csv' AS file_name,
  CASE WHEN o_orderstatus = 'P' AND order_key % 3 = 0 THEN 'CB' ELSE 'TX' END AS row_type,
  CASE WHEN order_key % 31 = 0 THEN 'rejected' WHEN order_key % 4 = 1 THEN NULL ELSE 'Cleared' END AS status,
  CASE WHEN order_key % 41 = 0 THEN 'MID-Z' ELSE 'MID-A' END AS bank_mid,
  CASE WHEN gross < 0 THEN 'CREDIT' ELSE 'DEBIT' END AS type,
  currency AS processing_currency, 'USD' AS dispute_settlement_currency,
  CAST(abs(gross) AS DECIMAL(15,2)) AS processing_amount, usd AS gross_settlement_amount,
  CAST(usd * CAST(0.03 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS processing_fee_amount,
  CASE WHEN order_key % 101 <> 0 THEN CAST(usd - CAST(usd * CAST(0.03 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS DECIMAL(15,2)) END
    AS net_settlement_amount,
  usd AS dispute_settlement_amount, CASE WHEN order_key % 2 = 0 THEN CAST(15 AS DECIMAL(15,2)) END AS dispute_fee,
  active AS active_day
FROM (
  SELECT s.*, CAST(ts + INTERVAL 3 HOUR AS DATE) + CASE WHEN order_key % 50 = 0 THEN 1 ELSE 0 END AS active,
    CAST(CAST(abs(gross) AS DECIMAL(24,2)) * CAST(fx_rate AS DECIMAL(10,4)) * CAST(0.93 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS usd
  FROM x_stmt AS s WHERE settled_by IN ('Dlocal', 'Credit')) AS s""")

cte("x_stmt_b", f"""
SELECT order_key, company, 'STL-' || strftime(date, '%Y%m%d') || '.01.009.CSV' AS file_name,
  CASE WHEN order_key % 13 = 0 THEN 'SF' ELSE 'SB' END AS ch, txn_id AS transaction_id,
  CASE WHEN order_key % 97 = 0 AND order_key % 2 = 0 THEN 'REF' || CAST(order_key AS VARCHAR) END AS reference_id,
  (ARRAY[{_codes}])[1 + CAST(order_key % {len(EVENT_CODES)} AS INTEGER)] AS event_code,
  CASE WHEN gross < 0 THEN 'DR' ELSE 'CR' END AS debit_or_credit,
  CAST(abs(gross) * 100 AS BIGINT) AS gross_minor,
  CASE WHEN order_key % 19 <> 0 THEN CAST(floor(abs(gross) * 3) AS BIGINT) END AS fee_minor,
  currency AS gross_currency, ts AS initiation_date, ts + INTERVAL 1 DAY AS completion_date, date AS file_day
FROM x_stmt WHERE lower(processor) = 'paypal' OR processor IS NULL""")

cte("x_stmt_c", """
SELECT order_key, company, txn_id AS id, CASE WHEN order_key % 17 = 0 THEN 'DECLINED' ELSE 'APPROVED' END AS status,
  ts AS update_date, ts + INTERVAL 1 DAY AS creation_date, CAST(gross AS VARCHAR) AS processing_value,
  currency AS transaction_currency
FROM x_stmt WHERE processor = 'PayU'""")

cte("x_rows_a", """
SELECT s.*, active_day AS business_date,
  CASE type WHEN 'CREDIT' THEN -processing_amount ELSE processing_amount END AS signed_amount,
  CASE type WHEN 'CREDIT' THEN -gross_settlement_amount ELSE gross_settlement_amount END AS signed_gross,
  CASE type WHEN 'CREDIT' THEN -net_settlement_amount ELSE net_settlement_amount END AS signed_net,
  CASE type WHEN 'CREDIT' THEN processing_fee_amount ELSE -processing_fee_amount END AS fee_signed,
  CASE type WHEN 'CREDIT' THEN -1 ELSE 1 END * (coalesce(dispute_settlement_amount, 0) + coalesce(dispute_fee, 0)) AS dispute_net
FROM x_stmt_a AS s
WHERE bank_mid = 'MID-A' AND (row_type = 'CB' OR lower(status) = 'cleared' OR status IS NULL)
  AND substr(file_name, 1, 8) = strftime(active_day + 1, '%Y%m%d')""")

cte("x_rows_b", """
SELECT s.*, file_day AS business_date, CAST(initiation_date AS DATE) AS proc_date,
  CAST(coalesce(f.rate, 1) AS DECIMAL(10,4)) AS proc_rate,
  CAST(CASE WHEN debit_or_credit = 'DR' THEN -1 ELSE 1 END * gross_minor * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS gross,
  CAST(CASE WHEN debit_or_credit = 'DR' THEN -1 ELSE 1 END * fee_minor * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS fee,
  coalesce(transaction_id, reference_id, '') AS proc_id,
  CASE WHEN event_code LIKE 'T02%' OR event_code LIKE 'T04%' OR event_code IN ('T0000', 'T0001', 'T0104', 'T0600', 'T1105',
    'T1116', 'T1503', 'T2001', 'T2103', 'T2104', 'T2105', 'T2106') THEN 'X' ELSE '' END AS excluded
FROM x_stmt_b AS s LEFT JOIN x_rates AS f
  ON f.rate_currency = s.gross_currency AND f.rate_date = CAST(s.completion_date AS DATE)
WHERE ch = 'SB'""")

cte("x_rows_c", """
SELECT s.*, CAST(update_date AS DATE) AS business_date, CAST(creation_date AS DATE) AS proc_date,
  CAST(coalesce(f.rate, 1) AS DECIMAL(10,4)) AS proc_rate, CAST(processing_value AS DECIMAL(15,2)) AS gross
FROM x_stmt_c AS s LEFT JOIN x_rates AS f
  ON f.rate_currency = s.transaction_currency AND f.rate_date = CAST(s.creation_date AS DATE)
WHERE status = 'APPROVED'""")

_ledger_sum = """
SELECT business_date AS lb, company AS ledger_company, coalesce(k, '{default}') AS ledger_key, currency AS ledger_currency,
  date AS ledger_date, {flag} sum(trans_usd) AS trans_usd, sum(trans_local) AS trans_local, sum(revenue_usd) AS revenue_usd,
  sum(revenue_local) AS revenue_local
FROM (SELECT *, upper(rtrim({id})) AS k FROM x_days WHERE settled_by = '{channel}') AS d
GROUP BY business_date, company, k, currency, date {group}"""

cte("x_left_a", _ledger_sum.format(
    default="", id="invoice_id", channel="Dlocal", group=", CASE WHEN txn_type = 'CHARGEBACK' THEN 'CHARGEBACK' ELSE 'N/A' END",
    flag="CASE WHEN txn_type = 'CHARGEBACK' THEN 'CHARGEBACK' ELSE 'N/A' END AS ledger_flag,"))
cte("x_left_b", _ledger_sum.format(default="1", id="txn_id", channel="Paypal", group="", flag=""))
cte("x_left_c", _ledger_sum.format(default="1", id="txn_id", channel="PayU", group="", flag=""))

cte("x_right_a", """
SELECT business_date AS pb, company AS proc_company, coalesce(transaction_id, '') AS proc_key,
  processing_currency AS proc_currency, sum(coalesce(signed_amount, 0)) AS proc_amount,
  sum(coalesce(signed_net, 0)) AS proc_net, sum(coalesce(signed_gross, 0)) AS proc_gross_usd
FROM x_rows_a WHERE row_type = 'TX' GROUP BY business_date, company, transaction_id, processing_currency""")
cte("x_right_b", """
SELECT business_date AS pb, company AS proc_company, upper(proc_id) AS proc_key, gross_currency AS proc_currency, event_code,
  proc_rate, proc_date, sum(gross) AS proc_amount, sum(coalesce(fee, 0) * proc_rate) AS proc_fee_usd,
  CAST(sum(gross * proc_rate) AS DECIMAL(15,2)) AS proc_gross_usd
FROM x_rows_b WHERE excluded <> 'X' GROUP BY ALL""")
cte("x_right_c", """
SELECT business_date AS pb, company AS proc_company, upper(id) AS proc_key, transaction_currency AS proc_currency,
  proc_rate, proc_date, sum(gross) AS proc_amount, CAST(sum(gross * proc_rate) AS DECIMAL(15,2)) AS proc_gross_usd
FROM x_rows_c GROUP BY ALL""")

for side, extra in (("a", "AND l.ledger_flag = 'N/A'"), ("b", ""), ("c", "")):
    cte(f"x_join_{side}", f"""
SELECT coalesce(lb, pb) AS business_date, coalesce(ledger_company, proc_company) AS company,
  coalesce(ledger_currency, proc_currency) AS currency, l.* EXCLUDE (lb), r.* EXCLUDE (pb)
FROM x_left_{side} AS l FULL JOIN x_right_{side} AS r
  ON l.lb = r.pb AND l.ledger_company = r.proc_company AND l.ledger_key = r.proc_key {extra}""")

cte("x_rec_a", """
SELECT z.*, abs(total_diff) AS abs_diff, CAST(total_diff - fx_diff AS DECIMAL(15,2)) AS other_diff FROM (
  SELECT y.* EXCLUDE (tu, tl, pa, pg, pn), tu AS trans_usd, tl AS trans_local, pa AS proc_amount, pg AS proc_gross_usd,
    pn AS proc_net, CAST(tu - pg AS DECIMAL(15,2)) AS total_diff,
    CAST(CASE WHEN tl = pa THEN tu * (1 - hidden_fee_rate) - pg ELSE 0 END AS DECIMAL(15,2)) AS fx_diff FROM (
    SELECT j.* EXCLUDE (trans_usd, trans_local, proc_amount, proc_gross_usd, proc_net), hidden_fee_rate,
      CAST(CASE WHEN trans_local = proc_amount THEN trans_usd * hidden_fee_rate ELSE 0 END AS DECIMAL(15,2)) AS hidden_fee,
      coalesce(trans_usd, 0) AS tu, coalesce(trans_local, 0) AS tl, coalesce(proc_amount, 0) AS pa,
      coalesce(proc_gross_usd, 0) AS pg, coalesce(proc_net, 0) AS pn
    FROM (SELECT *, CAST(CASE ledger_currency WHEN 'COP' THEN 0.10 WHEN 'CLP' THEN 0.09 WHEN 'MXN' THEN 0.07 END
            AS DECIMAL(10,2)) AS hidden_fee_rate FROM x_join_a) AS j) AS y) AS z""")

for side, flag in (("b", "CASE WHEN event_code IN ('T1106', 'T1110', 'T1111', 'T1114', 'T1201', 'T1202') THEN 'Yes' ELSE 'No' END"),
                   ("c", "'No'")):
    cte(f"x_rec_{side}", f"""
SELECT y.*, CAST(total_diff - fx_diff AS DECIMAL(15,2)) AS other_diff FROM (
  SELECT j.* EXCLUDE (gap),
    CAST(CASE WHEN is_chargeback = 'Yes' THEN gap ELSE 0 END AS DECIMAL(15,2)) AS chargeback_diff,
    CAST(CASE WHEN is_chargeback = 'No' THEN gap ELSE 0 END AS DECIMAL(15,2)) AS total_diff,
    CAST(CASE WHEN is_chargeback = 'No' AND trans_local = proc_amount THEN gap ELSE 0 END AS DECIMAL(15,2)) AS fx_diff
  FROM (SELECT *, {flag} AS is_chargeback,
          CAST(coalesce(trans_usd, 0) - coalesce(proc_gross_usd, 0) AS DECIMAL(15,2)) AS gap FROM x_join_{side}) AS j) AS y""")

# --- journals --------------------------------------------------------------

SIDES = {
    "CN": ("CASE WHEN {x} > 0 THEN 0 ELSE -({x}) END", "CASE WHEN {x} < 0 THEN 0 ELSE {x} END"),
    "DN": ("CASE WHEN {x} < 0 THEN 0 ELSE {x} END", "CASE WHEN {x} > 0 THEN 0 ELSE -({x}) END"),
    "DN0": ("CASE WHEN {x} > 0 THEN {x} ELSE 0 END", "CASE WHEN {x} < 0 THEN -({x}) ELSE 0 END"),
    "CN0": ("CASE WHEN {x} < 0 THEN -({x}) ELSE 0 END", "CASE WHEN {x} > 0 THEN {x} ELSE 0 END"),
}


def sides(rule: str, x: str = "amount") -> str:
    debit, credit = (s.format(x=x) for s in SIDES[rule])
    return f"CAST({debit} AS DECIMAL(15,2)) AS debit, CAST({credit} AS DECIMAL(15,2)) AS credit"


def line(name: str, rule: str, account: str, label: str, source: str) -> str:
    return f"""SELECT business_date, company, '{name}' AS table_name, {account} AS account, {label} AS distref, {sides(rule)}
FROM ({source}) AS s"""


def summed(frame: str, amount: str, keys: str = "", where: str = "TRUE", having: str = "TRUE") -> str:
    """Sum per day and company; text keys are grouped without case and shown in their largest spelling."""
    names = keys.split()
    shown = "".join(f", max({k}) AS {k}" for k in names)
    by = "".join(f", upper({k})" for k in names)
    return f"""SELECT business_date, company{shown}, sum({amount}) AS amount FROM {frame} WHERE {where}
GROUP BY business_date, company{by} HAVING {having}"""


def header(checkbook: str, reference: str, uniqueid: str) -> str:
    return f"""'{checkbook}' AS checkbookid, 'ACL_' || strftime(business_date, '%m%d%Y') AS batchid, '5' AS trantype,
  strftime(business_date, '%m%d%Y') AS trandate, 'ACL' AS srcdoc, 'Z-US$' AS currid,
  strftime(business_date, '%m%d%Y') || '{reference}' AS reference, '' AS key1, '' AS reversedate, {uniqueid} AS uniqueid"""


def known(account: str) -> str:
    return f"CASE WHEN company = 'LMX1' THEN {account} ELSE 'XXX-XXXXX-XXX' END"


A_LINES = {
    "revenue": line(
        "revenue", "CN", "coalesce(account, '')",
        "company || ' ' || txn_type || ' ' || business_line || ' - ' || settled_by || ' SALES'",
        "SELECT q.*, account FROM ("
        + summed("x_days", "revenue_usd", "txn_type business_line settled_by", "settled_by = 'Dlocal'")
        + ") AS q LEFT JOIN x_matrix3 ON mc = company AND mt = upper(txn_type) AND ml = upper(business_line)"),
    "tax": line(
        "tax", "CN",
        known("CASE tax_type WHEN 'VAT' THEN '042-24910-000' WHEN 'GST' THEN '042-24940-000' WHEN 'UST' THEN '042-21120-000' END"),
        "company || ' ' || settled_by || ' - ' || tax_type || ' PAYABLE'",
        summed("x_days", "tax_usd", "settled_by tax_type", "settled_by = 'Dlocal'", "abs(sum(tax_usd)) > 0")),
    "fees": line(
        "fees", "CN0", known("'061-57000-590'"), "company || ' - DLOCAL PROCESSING FEES'",
        summed("x_rows_a", "fee_signed", "", "row_type = 'TX' AND fee_signed <> 0")),
    "fx_adjustment": line(
        "fx_adjustment", "DN", known("'061-82700-950'"), "company || ' (REALIZED (GAIN) LOSS) ' || proc_currency",
        summed("x_rec_a", "fx_diff", "proc_currency", "TRUE", "abs(sum(fx_diff)) > 0")),
    "hidden_fees": line(
        "hidden_fees", "DN", known("'061-57000-590'"), "company || ' Hidden Fees ' || proc_currency",
        summed("x_rec_a", "hidden_fee", "proc_currency", "abs(hidden_fee) <> 0")),
    "suspense": line(
        "suspense", "DN", "CASE WHEN flag = 'CHARGEBACK' THEN '061-11035-000' ELSE '061-11045-000' END",
        "CASE WHEN flag = 'CHARGEBACK' THEN company || ' CHARGEBACK SUSPENSE (DLOCAL)' ELSE company || ' A/R SUSPENSE (DLOCAL)' END",
        "SELECT business_date, company, coalesce(ledger_flag, 'N/A') AS flag, sum(other_diff) AS amount FROM x_rec_a "
        "WHERE fx_diff = 0 AND other_diff <> 0 GROUP BY 1, 2, 3"),
    "chargebacks": line(
        "chargebacks", "CN0", known("'061-11035-000'"), "company || ' - CHARGEBACK SUSPENSE'",
        summed("x_rows_a", "dispute_net", "", "row_type = 'CB'")),
    "receivable": line(
        "receivable", "DN0", "'061-11001-000'",
        "CASE WHEN company = 'LMX1' THEN company || ' - ACCOUNTS RECEIVABLE (DLOCAL)' ELSE 'XXX - OTHER' END",
        """SELECT coalesce(t.business_date, d.business_date) AS business_date, coalesce(t.company, d.company) AS company,
  coalesce(t.amount, 0) + coalesce(d.amount, 0) AS amount
FROM (""" + summed("x_rows_a", "coalesce(signed_net, 0)", "", "row_type = 'TX'") + """) AS t
FULL JOIN (""" + summed("x_rows_a", "dispute_net", "", "row_type = 'CB'") + """) AS d
  ON t.company = d.company AND t.business_date = d.business_date"""),
}
B_LINES = {
    "revenue": line(
        "revenue", "CN", "coalesce(account, 'XXX-XXXXX-XXX')",
        "company || ' ' || txn_type || ' ' || business_line || ' ' || currency || ' - PAYPAL SALES'",
        "SELECT q.*, account FROM (" + summed("x_days", "revenue_usd", "txn_type business_line currency", "settled_by = 'Paypal'")
        + ") AS q LEFT JOIN x_matrix3 ON mc = upper(q.company) AND mt = upper(txn_type) AND ml = upper(business_line)"),
    "tax": line(
        "tax", "CN", "CASE tax_type WHEN 'VAT' THEN CASE company WHEN 'LMX1' THEN '042-24910-000' ELSE '061-24910-000' END "
        "WHEN 'UST' THEN '061-21120-000' ELSE '061-24940-000' END",
        "company || ' PAYPAL ' || currency || ' - ' || tax_type || ' PAYABLE'",
        summed("x_days", "tax_usd", "currency tax_type", "settled_by = 'Paypal' AND tax_usd <> 0")),
    "suspense": "SELECT * EXCLUDE (moved) FROM (SELECT *, sum(debit + credit) OVER (PARTITION BY business_date, company) AS moved FROM ("
    + line("suspense", "DN0", "'061-11045-000'", "company || ' PAYPAL ' || currency || ' SUSPENSE - PAYPAL SALES'",
           summed("x_rec_b", "other_diff", "currency")) + ") AS g) AS h WHERE moved > 0",
    "chargebacks": line(
        "chargebacks", "DN0", "'061-11035-000'", "company || ' CHARGEBACKS - PAYPAL ' || currency || ' SALES'",
        summed("x_rec_b", "chargeback_diff", "currency", "is_chargeback = 'Yes'")),
    "fees": line(
        "fees", "DN0", "'061-57000-590'", "company || ' - PAYPAL ' || currency || ' PROCESSING FEES'",
        summed("x_rec_b", "proc_fee_usd", "currency", "proc_fee_usd <> 0")),
}
C_LINES = {
    "revenue": line(
        "revenue", "CN", "coalesce(account, 'XXX-XXXXX-XXX')",
        "company || ' ' || txn_type || ' ' || business_line || ' ' || currency || ' - PAYU SALES'",
        "SELECT q.*, account FROM (" + summed("x_days", "revenue_usd", "txn_type business_line currency", "settled_by = 'PayU'")
        + ") AS q LEFT JOIN x_matrix3 ON mc = upper(q.company) AND mt = upper(txn_type) AND ml = upper(business_line)"),
    "tax": line(
        "tax", "CN", "CASE tax_type WHEN 'VAT' THEN '042-24910-000' WHEN 'UST' THEN '042-21120-000' ELSE '042-24940-000' END",
        "company || ' PAYU ' || currency || ' - ' || tax_type || ' PAYABLE'",
        summed("x_days", "tax_usd", "currency tax_type", "settled_by = 'PayU' AND tax_usd <> 0")),
    "suspense": "SELECT * EXCLUDE (moved) FROM (SELECT *, sum(debit + credit) OVER (PARTITION BY business_date, company) AS moved FROM ("
    + line("suspense", "DN0", "'061-11045-000'", "company || ' PAYU ' || currency || ' SUSPENSE - PAYU SALES'",
           summed("x_rec_c", "other_diff", "currency")) + ") AS g) AS h WHERE moved > 0",
}

HEAD_A = header(
    "Operating", " REVENUE DLOCAL",
    "company || CASE WHEN table_name = 'hidden_fees' THEN 'DLF' ELSE 'DL' END || strftime(business_date, '%m%d%Y')")
HEAD_B = header("PAYPAL", " CASH PAYPAL", "company || 'PP' || strftime(business_date, '%m%d%Y') || strftime(business_date, '%m%d%Y')")
HEAD_C = header("PAYU", " SALES PAYU", "company || 'PU' || strftime(business_date, '%m%d%Y') || strftime(business_date, '%m%d%Y')")


def stack(lines: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({sql}) AS t_{name}" for name, sql in lines.items())


def plug(frame: str, account: str, label: str, name: str) -> str:
    return f"""SELECT * FROM {frame} UNION ALL BY NAME
SELECT business_date, company, '{name}' AS table_name, {account} AS account, company || '{label}' AS distref, {sides('DN0')}
FROM (SELECT business_date, company, CAST(sum(credit) - sum(debit) AS DECIMAL(15,2)) AS amount FROM {frame}
  WHERE starts_with(distref, company) GROUP BY 1, 2) AS p"""


WALLET_CASH = "CASE company WHEN 'LMX1' THEN '042-10030-000' ELSE '061-10030-000' END"

cte("x_lines_a", stack(A_LINES))
cte("x_journal_a", f"""
SELECT t.*, {HEAD_A},
  CAST(sum(CASE WHEN distref = company || ' - ACCOUNTS RECEIVABLE (DLOCAL)' THEN debit - credit END)
    OVER (PARTITION BY business_date, company) AS DECIMAL(15,2)) AS docamt,
  CASE WHEN account <> '061-11001-000' THEN '9' ELSE '3' END AS distype FROM x_lines_a AS t""")
cte("x_part_b", stack(B_LINES))
cte("x_lines_b", plug("x_part_b", WALLET_CASH, " CASH USD - PAYPAL SALES", "cash"))
cte("x_journal_b", f"""
SELECT t.*, {HEAD_B},
  CAST(sum(CASE WHEN starts_with(distref, company || ' CASH') THEN debit - credit END)
    OVER (PARTITION BY business_date, company) AS DECIMAL(15,2)) AS docamt,
  CASE WHEN account = {WALLET_CASH} THEN '1' ELSE '3' END AS distype,
  company || 'PPCR0101260930' AS cashrcpt FROM x_lines_b AS t""")
cte("x_part_c", stack(C_LINES))
cte("x_lines_c", plug("x_part_c", "'061-11001-000'", " A/R (USD) - PAYU SALES", "receivable"))
cte("x_journal_c", f"""
SELECT t.*, {HEAD_C},
  CAST(sum(CASE WHEN starts_with(distref, company || ' A/R') THEN debit - credit END)
    OVER (PARTITION BY business_date, company) AS DECIMAL(15,2)) AS docamt,
  CASE WHEN account = '061-11001-000' THEN '3' ELSE '9' END AS distype,
  company || 'PUCR0101260930' AS cashrcpt FROM x_lines_c AS t""")

cte("x_settle", """
SELECT coalesce(a.business_date, b.business_date) AS business_date, coalesce(a.company, b.company) AS company,
  coalesce(a.activity_date, b.activity_date) AS activity_date, coalesce(settled, 0) AS settled, coalesce(disputed, 0) AS disputed,
  CAST(coalesce(settled, 0) + coalesce(disputed, 0) AS DECIMAL(15,2)) AS net
FROM (SELECT strptime(substr(file_name, 1, 8), '%Y%m%d')::DATE - 1 AS business_date, company, active_day AS activity_date,
        sum(CASE type WHEN 'CREDIT' THEN -net_settlement_amount ELSE net_settlement_amount END) AS settled
      FROM x_stmt_a WHERE row_type = 'TX' GROUP BY 1, 2, 3) AS a
FULL JOIN (SELECT strptime(substr(file_name, 1, 8), '%Y%m%d')::DATE - 1 AS business_date, company, active_day AS activity_date,
        sum(CASE type WHEN 'CREDIT' THEN -1 ELSE 1 END * (coalesce(dispute_settlement_amount, 0) + coalesce(dispute_fee, 0))) AS disputed
      FROM x_stmt_a WHERE row_type = 'CB' GROUP BY 1, 2, 3) AS b
  ON a.business_date = b.business_date AND a.company = b.company AND a.activity_date = b.activity_date""")
cte("x_lines_cash", f"""
SELECT business_date, company, activity_date, 'cash' AS table_name, '061-10005-000' AS account, company || ' - CASH' AS distref,
  {sides('DN0', 'net')} FROM x_settle
UNION ALL
SELECT business_date, company, activity_date, 'receivable' AS table_name, '061-11001-000' AS account,
  company || ' - ACCOUNTS RECEIVABLE' AS distref, {sides('CN0', 'net')} FROM x_settle""")
cte("x_journal_cash", f"""
SELECT t.* EXCLUDE (activity_date),
  {header("Operating", " CASH DLOCAL", "company || 'DL' || strftime(activity_date, '%Y%m%d')")},
  CAST(sum(CASE WHEN distref = company || ' - CASH' THEN debit - credit END)
    OVER (PARTITION BY business_date, company) AS DECIMAL(15,2)) AS docamt,
  CASE WHEN account = '061-10005-000' THEN '1' ELSE '3' END AS distype, 'DCM010120260930' AS cashrcpt
FROM x_lines_cash AS t""")

cte("x_overpaid", """
SELECT * FROM (
  SELECT d.*, CAST(coalesce(total, 0) - coalesce(invoice_total, 0) - coalesce(CAST(vat_tax AS DECIMAL(15,2)), 0) AS DECIMAL(15,2)) AS overpayment,
    CAST((coalesce(total, 0) - coalesce(invoice_total, 0) - coalesce(CAST(vat_tax AS DECIMAL(15,2)), 0)) * fx_rate AS DECIMAL(15,2)) AS overpayment_usd
  FROM x_days AS d WHERE total > invoice_total) AS o
WHERE settled_by <> 'Credit' AND overpayment_usd <> 0""")
cte("x_over", "SELECT q.*, m.account AS sales, d.account AS deposit FROM (" + summed("x_overpaid", "overpayment_usd", "txn_type business_line")
    + """) AS q LEFT JOIN x_matrix3 AS m ON m.mc = company AND m.mt = upper(txn_type) AND m.ml = upper(business_line)
LEFT JOIN x_deposit AS d ON d.mc = company""")
cte("x_lines_over", f"""
SELECT business_date, company, 'overpayment' AS table_name, coalesce(sales, '') AS account,
  company || ' ' || txn_type || ' ' || business_line || ' -  SALES' AS distref, {sides('DN')} FROM x_over
UNION ALL
SELECT business_date, company, 'overpayment' AS table_name, coalesce(deposit, '') AS account,
  company || ' Prepaid Deposit' AS distref, {sides('CN')} FROM x_over""")
cte("x_journal_over", f"""
SELECT t.*, {header("Operating", " REVENUE", "company || 'OP' || strftime(business_date, '%m%d%Y')")},
  CAST(sum(debit) OVER (PARTITION BY business_date, company) AS DECIMAL(15,2)) AS docamt, '9' AS distype FROM x_lines_over AS t""")

cte("x_all", """
SELECT *, 'a_cash' AS journal, 'DLOCAL CASH' AS merchant FROM x_journal_cash
UNION ALL BY NAME SELECT *, 'wallet' AS journal, 'Paypal' AS merchant FROM x_journal_b
UNION ALL BY NAME SELECT *, 'a_sales' AS journal, 'DLOCAL' AS merchant FROM x_journal_a
UNION ALL BY NAME SELECT *, 'card' AS journal, 'PayU' AS merchant FROM x_journal_c
UNION ALL BY NAME SELECT *, 'overpayment' AS journal, 'Overpayment_JE' AS merchant FROM x_journal_over""")
